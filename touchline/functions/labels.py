"""Names, bands and thresholds that the results must carry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from touchline.functions.exprs import band, col

# Value bands in EUR, left-closed.
VALUE_CUTS = [(1_000_000, "under_1m"), (5_000_000, "1m_to_5m"), (20_000_000, "5m_to_20m")]
VALUE_TOP = "20m_plus"

# Age bands of a transfer.
TRANSFER_AGE_CUTS = [(21, "under_21"), (25, "21_to_24"), (29, "25_to_28"), (33, "29_to_32")]
TRANSFER_AGE_TOP = "33_plus"

# Age bands of the model evaluation.
MODEL_AGE_CUTS = [(21, "under_21"), (24, "21_to_23"), (28, "24_to_27"), (32, "28_to_31")]
MODEL_AGE_TOP = "32_plus"

# Age groups of the report layer (plain year difference).
REPORT_AGE_CUTS = [(22, "18-21"), (26, "22-25"), (30, "26-29"), (34, "30-33")]
REPORT_AGE_TOP = "34+"

# Translated labels.
POSITION_TR = {
    "Attack": "Forvet",
    "Defender": "Defans",
    "Goalkeeper": "Kaleci",
    "Midfield": "Orta Saha",
    "Missing": "Bilinmiyor",
}
UNKNOWN_TR = "Bilinmiyor"
DIRECTION_TR = {
    "increase": "Arttı",
    "decrease": "Düştü",
    "unchanged": "Değişmedi",
    "unavailable": "Belirsiz",
}
QUALITY_TR = {"high": "Yüksek", "medium": "Orta", "limited": "Sınırlı"}
FEE_RANGE_TR = [
    (50_000_000, "Mega Transfer (≥50M€)"),
    (20_000_000, "Büyük Transfer (20-50M€)"),
    (5_000_000, "Orta Transfer (5-20M€)"),
]
FEE_RANGE_SMALL_TR = "Küçük Transfer (<5M€)"
FEE_RANGE_UNKNOWN_TR = "Ücretsiz/Bilinmiyor"
FEE_RANGE_NONE_TR = "Veri Yok"

FOLLOW_UP_SHORT = {
    "missing_baseline": "No baseline",
    "missing_followup": "No follow-up",
    "missing_follow_up": "No follow-up",
    "not_yet_observed": "Too early",
    "not_yet_observable": "Too early",
    "observed": "Observed",
}

COMPETITION_SHORT = {
    "IT1": "Serie A (IT)", "ES1": "La Liga (ES)", "GB1": "Premier L. (ENG)",
    "FR1": "Ligue 1 (FR)", "TR1": "Super Lig (TR)", "L1": "Bundesliga (DE)",
    "NL1": "Eredivisie (NL)", "PO1": "Liga Portugal", "BE1": "Jupiler Pro",
    "RU1": "Premier L. (RU)", "GR1": "Super L. (GR)", "SC1": "Scottish Prem.",
    "UKR1": "Premier L. (UA)", "ELQ": "Europa L. Qual.", "EL": "Europa League",
    "DK1": "Danish Superliga", "FAC": "FA Cup", "CL": "Champions L.",
    "CDR": "Copa del Rey", "RUP": "Russian Cup", "SFA": "Scottish FA Cup",
    "ECLQ": "Conference Qual.", "NLP": "KNVB Cup", "CLQ": "Champions Qual.",
    "GRP": "Greek Cup", "DKP": "Danish Cup", "CIT": "Coppa Italia",
    "DFB": "DFB-Pokal", "UCOL": "Conference L.", "MLS1": "MLS",
    "UKRP": "Ukrainian Cup", "PL1": "Ekstraklasa", "SA1": "Saudi Pro L.",
    "BRA1": "Brazil Serie A", "SER1": "Serbian Super L.", "RO1": "Romanian Super L.",
    "TS1": "Czech Chance L.", "C1": "Swiss Super L.", "ARG1": "Argentine Apertura",
    "FIWC": "World Cup", "A1": "Bundesliga (AT)", "KR1": "Croatian HNL",
    "NO1": "Eliteserien", "SE1": "Allsvenskan", "AUS1": "A-League (AU)",
    "JAP1": "J1 League", "MEX1": "Liga MX Claus.", "RSK1": "K League 1",
    "EURO": "UEFA Euro", "AFCN": "AFCON", "AFAC": "AFC Asian Cup",
    "SUC": "Spanish Supercup", "COPA": "Copa America", "EJPL": "Jupiler Playoff I",
    "POBE": "Jupiler Europe PO", "SCI": "Italian Supercup", "GBCS": "Community Shield",
    "RUSS": "Russian Supercup", "DFL": "German Supercup", "USC": "UEFA Supercup",
}


def lookup(values: dict[str, str], c: Column | str, default: Column | str | None) -> Column:
    """Map a column through a small constant table."""
    pairs = [F.lit(x) for kv in values.items() for x in kv]
    default = F.lit(default) if default is None or isinstance(default, str) else default
    return F.coalesce(F.try_element_at(F.create_map(*pairs), col(c)), default)


def value_band(c: Column | str, missing: str | None = None) -> Column:
    return band(c, VALUE_CUTS, VALUE_TOP, missing)


def report_age_group(birth: Column | str, as_of) -> Column:
    years = F.year(F.lit(as_of)) - F.year(col(birth))
    # A blank birth date counts as zero years in the report layer's language.
    return band(F.coalesce(years, F.lit(0)), REPORT_AGE_CUTS, REPORT_AGE_TOP, None)


def fee_range(fee: Column | str, known: Column | str) -> Column:
    fee, known = col(fee), col(known)
    out = F.when(fee >= FEE_RANGE_TR[0][0], FEE_RANGE_TR[0][1])
    for floor, label in FEE_RANGE_TR[1:]:
        out = out.when(fee >= floor, label)
    return (
        out.when(fee > 0, FEE_RANGE_SMALL_TR)
        .when(~known, FEE_RANGE_UNKNOWN_TR)
        .otherwise(FEE_RANGE_NONE_TR)
    )


def follow_up_label(status: Column | str) -> Column:
    return lookup(FOLLOW_UP_SHORT, status, col(status))


def competition_label(code: Column | str, name: Column | str) -> Column:
    fallback = F.concat(
        F.substring(F.replace(col(name), F.lit("-"), F.lit(" ")), 1, 18),
        F.lit(" ("), col(code), F.lit(")"),
    )
    return lookup(COMPETITION_SHORT, code, fallback)
