"""Personal data: patterns propose spans, checksums confirm them, context words adjust a score.

Only DataFrame functions are used.  Kinds: email, ip, card (Luhn), phone and, beyond the base
kinds, iban (mod 97; in one run or in groups of four).  Spans are in code points, the end exclusive.

Java's matcher retries a failed run from each of its characters and recurses into repeated
groups.  So every pattern here starts only where a run starts or the last match ended, uses
possessive quantifiers, and sees inner separators (a dot between domain characters, a space or
hyphen between digits) as one private character, which turns repeated groups into plain runs.
Matches are the same; long texts cost time in proportion to their length.

Null text counts as empty.  Every row has its result, rows without or with repeated doc_id too.
Other columns are ignored, by ``redact`` kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE, SAFE = "\x01", "\x02", "\x04"
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban")
#: Inner separators: where each stands, and its private character.
INNER = {
    "email": [(r"(?<=[A-Za-z0-9-])\.(?=[A-Za-z0-9-])", ".", "\x03")],
    "card": [(r"(?<=[0-9])\x20(?=[0-9])", " ", "\x03"), (r"(?<=[0-9])-(?=[0-9])", "-", "\x05")],
}
PATTERN = {
    "email": r"(?:(?<![A-Za-z0-9._%+\x03-])|\G)[A-Za-z0-9._%+\x03-]++@[A-Za-z0-9-]++\x03[A-Za-z0-9\x03-]++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9][0-9\x03\x05]{15,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    # in one run, or in groups of four after single spaces; from the third on a group holds a digit, unlike most words
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}+|\x20[A-Z0-9]{4}(?:\x20(?=[A-Z]{0,3}[0-9])[A-Z0-9]{4}(?![A-Za-z0-9])){1,6}"
            r"(?:\x20(?=[A-Z]{0,2}[0-9])[A-Z0-9]{1,3}(?![A-Za-z0-9]))?)(?![A-Za-z0-9])",
}
#: A text without this character has no match.
NEEDS = {"email": "@", "phone": "+", "ip": "."}
CONTEXT = {
    "email": r"(?i)\b(e-?mail|contact|write)\b", "ip": r"(?i)\b(ip|host|server|address)\b",
    "card": r"(?i)\b(card|visa|credit|payment)\b", "phone": r"(?i)\b(phone|tel|call|mobile)\b",
    "iban": r"(?i)\b(iban|account|bank|konto)\b",
}
NEAR, BLOCK = 40, 256
CHECKED = {"email": 0.6, "ip": 0.4, "card": 0.8, "phone": 0.5, "iban": 0.9}


def digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(s: Column) -> Column:
    """Whether a string of digits has a Luhn sum divisible by ten."""
    n = F.length(s)

    def value(i: Column) -> Column:
        d = F.substring(s, n - i, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d))

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda a, i: a + value(i)) % 10 == 0


def mod97(s: Column) -> Column:
    """Whether an account number's check digits hold; spaces don't count."""
    s = F.translate(s, " ", "")
    turned = F.concat(F.substring(s, F.lit(5), F.length(s)), F.substring(s, 1, 4))

    def step(a: Column, c: Column) -> Column:
        return F.when(c.between("0", "9"), (a * 10 + c.cast("int")) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97)

    return F.aggregate(F.split(turned, ""), F.lit(0), lambda a, c: F.when(c == "", a).otherwise(step(a, c))) == 1


def valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        parts = F.transform(F.split(m, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.substring(p, 1, 3).cast("int") <= 255))
    if kind == "card":
        return F.length(digits(m)).between(16, 19) & luhn(digits(m))
    if kind == "phone":
        return F.length(digits(m)).between(8, 15)
    return mod97(m) if kind == "iban" else F.lit(True)


def pieces(kind: str, text: Column) -> Column:
    """Text cut at its matches: other, match, other, ...; null where there is none."""
    seen = text
    for place, _, private in INNER.get(kind, []):
        seen = F.regexp_replace(seen, place, private)
    marked = F.regexp_replace(seen, PATTERN[kind], f"{OPEN}$0{CLOSE}")
    marked = F.when(F.instr(text, NEEDS[kind]) > 0, marked) if kind in NEEDS else marked
    return F.when(F.instr(marked, OPEN) > 0, F.split(marked, f"[{OPEN}{CLOSE}]", -1))


def with_starts(df: DataFrame, cut: str, at: str) -> DataFrame:
    """``df`` with the start of every piece: sums of all lengths before, built in blocks.

    No long array is grown element by element, and every array a lambda reads is a column.
    """

    def grow(acc: Column, x: Column) -> Column:
        return F.array_append(acc, F.element_at(acc, -1) + x)

    df = df.withColumn("_len", F.transform(cut, lambda p: F.length(p)))
    df = df.withColumn("_blocks", F.transform(
        F.sequence(F.lit(0), F.floor((F.size("_len") - 1) / BLOCK).cast("int")),
        lambda b: F.slice("_len", b * BLOCK + 1, F.lit(BLOCK))))
    sums = F.transform("_blocks", lambda b: F.aggregate(b, F.lit(0), lambda a, x: a + x))
    df = df.withColumn("_before", F.aggregate(sums, F.array(F.lit(0)), grow))
    inner = F.zip_with("_blocks", F.slice("_before", F.lit(1), F.size("_blocks")), lambda b, p: F.aggregate(b, F.array(p), grow))
    starts = F.flatten(F.transform(inner, lambda s: F.slice(s, F.lit(1), F.size(s) - 1)))
    return df.withColumn(at, F.when(F.col(cut).isNotNull(), starts)).drop("_len", "_blocks", "_before")


def safe(text: Column) -> Column:
    """Text in which the private characters are free."""
    return F.translate(F.coalesce(text, F.lit("")), OPEN + CLOSE + "\x03\x05", SAFE * 4)


def spans(df: DataFrame, text: str) -> DataFrame:
    """``df`` with a column for each kind: array of (start, end), confirmed and in order."""
    for kind in KINDS:
        cut, at = f"_cut_{kind}", f"_at_{kind}"
        df = df.withColumn(cut, pieces(kind, F.col(text)))
        df = with_starts(df, cut, at)
        found = F.transform(cut, lambda p, i: F.struct(
            F.get(F.col(at), i).alias("start"), (F.get(F.col(at), i) + F.length(p)).alias("end"),  # noqa: B023
            ((i % 2 == 1) & valid(kind, p)).alias("ok")))  # noqa: B023
        good = F.transform(F.filter(found, lambda s: s["ok"]), lambda s: F.struct(s["start"], s["end"]))
        df = df.withColumn(f"_{kind}", F.coalesce(good, F.array().cast("array<struct<start:int,end:int>>"))).drop(cut, at)
    return df


def detect(docs: DataFrame) -> DataFrame:
    """Counts, digests and scored spans of every row."""
    docs = spans(docs.select(F.col("doc_id"), safe(F.col("text")).alias("_text")), "_text")

    def told(kind: str) -> Column:
        return F.transform(f"_{kind}", lambda s: F.concat_ws(":", F.lit(kind), s["start"], s["end"]))

    def scored(kind: str) -> Column:
        def score(s: Column) -> Column:
            lo = F.greatest(s["start"] - NEAR, F.lit(0))
            around = F.substring(F.col("_text"), lo + 1, s["end"] + NEAR - lo)
            return F.lit(CHECKED[kind]) + F.when(around.rlike(CONTEXT[kind]), 0.1).otherwise(0.0)

        return F.transform(f"_{kind}", lambda s: F.struct(
            F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), F.round(score(s), 2).alias("score")))

    def joined(kinds: tuple[str, ...]) -> Column:
        return F.array_join(F.concat(*[told(k) for k in kinds]), ",")

    return docs.select(
        "doc_id", *[F.size(f"_{k}").cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(joined(BASE).cast("binary"), 256).alias("base_sha256"), joined(KINDS).alias("spans"),
        F.concat(*[scored(k) for k in KINDS]).alias("scores"))


def merged(df: DataFrame, last: str) -> DataFrame:
    """``df`` with ``_all``, the spans of all kinds by start, longest first, and ``last``, the end reached before each.

    Running maxima are taken in blocks, as the sums of ``with_starts``.
    """
    every = [F.transform(f"_{kind}", lambda s: F.struct(s["start"], (-s["end"]).alias("back"), F.lit(k).alias("kind")))  # noqa: B023
             for k, kind in enumerate(KINDS)]
    df = df.withColumn("_all", F.array_sort(F.concat(*every)))

    def grow(acc: Column, x: Column) -> Column:
        return F.array_append(acc, F.greatest(F.element_at(acc, -1), x))

    df = df.withColumn("_ends", F.transform("_all", lambda s: -s["back"]))
    df = df.withColumn("_blocks", F.transform(
        F.sequence(F.lit(0), F.floor(F.greatest(F.size("_ends") - 1, F.lit(0)) / BLOCK).cast("int")),
        lambda b: F.slice("_ends", b * BLOCK + 1, F.lit(BLOCK))))
    tops = F.transform("_blocks", lambda b: F.coalesce(F.array_max(b), F.lit(0)))
    df = df.withColumn("_before", F.aggregate(tops, F.array(F.lit(0)), grow))
    inner = F.zip_with("_blocks", F.slice("_before", F.lit(1), F.size("_blocks")), lambda b, p: F.aggregate(b, F.array(p), grow))
    df = df.withColumn(last, F.flatten(F.transform(inner, lambda s: F.slice(s, F.lit(1), F.size(s) - 1))))
    return df.withColumn("_reached", F.element_at("_before", -1)).drop("_ends", "_blocks", "_before")


def redact(docs: DataFrame) -> DataFrame:
    """The documents with every confirmed span replaced by its kind in angle brackets.

    The spans are those of ``detect``, all found in the text as given.  Spans that overlap are
    replaced as one, by the kind that starts first, of these the longest.  All other text stays as
    it is.  ``n_chars``, where there, is counted anew in documents with spans.
    """
    columns = docs.columns
    df = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row"))
    df = merged(spans(df.withColumn("_text", safe(F.col("_row.text"))), "_text"), "_last")
    opens = F.filter(
        F.transform("_all", lambda s, i: F.struct(s["start"], F.get(F.col("_last"), i).alias("last"), s["kind"])),
        lambda s: s["start"] >= s["last"])
    df = df.withColumn("_opens", opens)
    tags = F.array(*[F.lit(f"<{kind.upper()}>") for kind in KINDS])
    told = F.transform("_opens", lambda s: F.concat(
        F.substring(F.col("_row.text"), s["last"] + 1, s["start"] - s["last"]), F.get(tags, s["kind"])))
    rest = F.substring(F.col("_row.text"), F.col("_reached") + 1, F.length("_row.text"))
    df = df.withColumn("_new", F.when(F.size("_all") > 0, F.concat(F.array_join(told, ""), rest)))
    new = {"text": F.coalesce("_new", "_row.text")}
    if "n_chars" in columns:
        new["n_chars"] = F.when(F.col("_new").isNotNull(), F.length("_new").cast("long")).otherwise(F.col("_row.n_chars"))
    return df.select(*[new.get(c, F.col("_row")[c]).alias(c) for c in columns])
