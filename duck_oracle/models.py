"""DuckDB statements of the model chain: the position-median run, its scores, reports and gates."""

from duck_oracle.common import AS_OF, exact_mean

_T = "ml_player_market_value_training"
VERSION = "position_median_run"
HOLD_OUT = ["training_row_key", "player_id", "player_name", "season", "competition_id", "target_market_value_date",
            "target_market_value_eur", "previous_market_value_eur", "position", "sub_position", "age_at_target_date",
            "competition_country_name"]
GAP = "abs(target_market_value_eur::double - predicted_market_value_eur)"
BASE_GAP = "abs(target_market_value_eur::double - baseline_prediction_eur)"
HIT = "target_market_value_eur between prediction_lower_eur and prediction_upper_eur"
WIDTH = "prediction_upper_eur - prediction_lower_eur"


def exact(x: str, where: str = "true") -> str:
    """Sum at six decimals; through text, as the engine's own casts can be one bit off."""
    return f"(sum(cast(cast(cast({x} as double) as varchar) as decimal(28,6))) filter ({where}))::varchar::double"


def median(x: str) -> str:
    """Mean of the two middle values, each halved first."""
    s = f"list_sort(list({x}) filter ({x} is not null))"
    return (f"case when count({x}) % 2 = 1 then {s}[((count({x}) + 1) // 2)::int] "
            f"else {s}[(count({x}) // 2)::int] * 0.5::double + {s}[(count({x}) // 2 + 1)::int] * 0.5::double end")


def band(x: str) -> str:
    return (f"case when {x} is null then null when {x} < 1000000 then 'under_1m' when {x} < 5000000 then '1m_to_5m' "
            f"when {x} < 20000000 then '5m_to_20m' else '20m_plus' end")


def status(alias: str = "") -> str:
    return f"""case when previous_market_value_eur is not null and age_at_target_date is not null and competition_id is not null
            and minutes_before_target >= 450 then 'high'
        when previous_market_value_eur is not null and age_at_target_date is not null and minutes_before_target > 0 then 'medium'
        else 'limited' end"""


def predicted(rows: str, where: str, medians: str, extra: str = "") -> str:
    """Rows with the position median, the persistence baseline and the quality status."""
    return f"""select r.*, coalesce(m.m, a.m) as ml, coalesce(r.previous_market_value_eur::double, a.m) as base, {status()} as prediction_quality_status{extra}
        from {rows} r left join (select position as mp, m from {medians} where position is not null) m on m.mp = r.position,
            (select m from {medians} where position is null) a where {where}"""


def medians(where: str) -> str:
    """Median target by position, and of all rows under a null position."""
    y = "target_market_value_eur::double"
    return f"""select position, {median(y)} as m from {_T}, m_times where {where} and position is not null group by 1
        union all select null, {median(y)} from {_T}, m_times where {where}"""


_W = [i / 20 for i in range(21)]
_MIX = "selected_ml_blend_weight * ml + (1 - selected_ml_blend_weight) * base"


def totals(p: str, prefix: str = "") -> str:
    gap = f"abs(y - {p})"
    return (f"{exact(gap)} as {prefix}abs, {exact(f'{gap} * {gap}')} as {prefix}sq, {exact(f'{p} - y')} as {prefix}err, "
            f"count(*) filter ({gap} / y <= 0.25) as {prefix}near")


def scores() -> str:
    """The seven error metrics from totals."""
    return """abs / row_count as mae_eur, sqrt(sq / row_count) as rmse_eur,
        case when row_count >= 2 then case when a2 - a * a / row_count = 0 then case when sq = 0 then 1.0 else 0.0 end
            else 1 - sq / (a2 - a * a / row_count) end end as r2,
        abs / nullif(a, 0) * 100 as wape_pct, m * 100 as median_absolute_percentage_error_pct, err / row_count as mean_error_eur,
        near / row_count * 100 as within_25_pct"""


def metrics(source: str, p: str, keys: str = "") -> str:
    cols = f"{keys}, " if keys else ""
    group = f"group by {keys}" if keys else ""
    return f"""select {cols} count(*)::double as row_count, {exact('y')} as a, {exact('y * y')} as a2, {totals(p)},
        {median(f"abs(y - {p}) / y")} as m from {source} {group}"""


PARTS = {
    "m_times": f"""select max(season) filter (back = 4) as tuning, max(season) filter (back = 3) as calibration, min(season) filter (back <= 2) as test,
            max(season) as newest
        from (select season, row_number() over (order by season desc) as back from (select distinct season from {_T} where season is not null))""",
    "m_dev": medians("season < tuning"),
    "m_fit": medians("season <= tuning"),
    "m_all": medians("true"),
    "m_tuned": predicted(f"(select t.* from {_T} t, m_times where season = tuning)", "true", "m_dev"),
    "m_errors": " union all ".join(
        f"select prediction_quality_status as s, {w!r}::double as w, abs(target_market_value_eur - ({w!r}::double * ml + {1 - w!r}::double * base)) as e from m_tuned"
        for w in _W),
    "m_best": f"""
        select s, w, n from (select *, row_number() over (partition by s order by e, w) as r from (
            select s, w, sum(cast(cast(e as varchar) as decimal(28,6))) as e, count(*) as n from m_errors group by 1, 2
            union all select 'default', w, sum(cast(cast(e as varchar) as decimal(28,6))), count(*) from m_errors group by 2)) where r = 1""",
    "m_weights": """
        select s as prediction_quality_status, case when s = 'limited' then 0.0::double when s = 'default' or coalesce(n, 0) < 100 then d else w end as weight
        from (select unnest(['default', 'high', 'medium', 'limited']) as s) left join m_best using (s), (select w as d from m_best where s = 'default')""",
    "m_blended": f"""
        select *, {_MIX} as blended, target_market_value_eur::double as y from (
            select p.*, weight as selected_ml_blend_weight from ({predicted(_T, "true", "m_fit")}) p join m_weights using (prediction_quality_status))""",
    "m_widths": f"""
        select b as band, g as width from (
            select b, g, row_number() over (partition by b order by g) as r, count(*) over (partition by b) as n
            from (select {band('blended')} as b, abs(y - blended) as g from m_blended, m_times where season = calibration
                  union all select null, abs(y - blended) from m_blended, m_times where season = calibration))
        where r = ceil((n - 1) * 0.9::double) + 1""",
    "m_scored": f"""
        select b.*, {band('blended')} as prediction_interval_band, coalesce(w.width, d.width) as prediction_width
        from (select x.* from m_blended x, m_times where season >= test) b left join (select * from m_widths where band is not null) w on w.band = {band('blended')},
            (select width from m_widths where band is null) d""",
    "m_hold_out": f"""
        select {', '.join(HOLD_OUT)}, round_even(ml, 0) as ml_only_prediction_eur, round_even(base, 0) as baseline_prediction_eur,
            round_even(blended, 0) as predicted_market_value_eur, round_even(abs(y - blended), 0) as absolute_error_eur,
            prediction_interval_band, round_even(prediction_width, 0) as prediction_interval_eur,
            round_even(greatest(blended - prediction_width, 0), 0) as prediction_lower_eur, round_even(blended + prediction_width, 0) as prediction_upper_eur,
            prediction_quality_status, selected_ml_blend_weight, '{VERSION}' as model_version
        from m_scored""",
    "m_held": f"select *, target_market_value_eur::double as y, predicted_market_value_eur as p, baseline_prediction_eur as b, {HIT} as hit, {WIDTH} as width from m_hold_out",
    "m_current": f"""
        select * exclude (ml, base, predicted, w, prediction_width, newest, band, own, def), round_even(ml, 0) as ml_only_prediction_eur, round_even(base, 0) as baseline_prediction_eur,
            predicted as predicted_market_value_eur, {band('predicted')} as prediction_interval_band, round_even(prediction_width, 0) as prediction_interval_eur,
            round_even(greatest(predicted - prediction_width, 0), 0) as prediction_lower_eur, round_even(predicted + prediction_width, 0) as prediction_upper_eur,
            round_even(predicted - previous_market_value_eur, 0) as prediction_delta_vs_previous_eur,
            round(cast(cast(round_even(predicted - previous_market_value_eur, 0) / nullif(previous_market_value_eur::double, 0) * 100 as varchar) as decimal(38,20)), 2)::double as prediction_delta_vs_previous_pct,
            case prediction_quality_status when 'high' then 'Yüksek' when 'medium' then 'Orta' else 'Sınırlı' end as kalite_etiketi_tr,
            case position when 'Attack' then 'Forvet' when 'Defender' then 'Defans' when 'Goalkeeper' then 'Kaleci' when 'Midfield' then 'Orta Saha'
                else 'Bilinmiyor' end as pozisyon_tr,
            season > newest as prediction_is_out_of_time, w as selected_ml_blend_weight, '{VERSION}' as model_version
        from (select s.*, round_even(w * ml + (1 - w) * base, 0) as predicted, newest from (
                  select p.*, weight as w from ({predicted("ml_player_market_value_scoring", "true", "m_all")}) p join m_weights using (prediction_quality_status)) s, m_times) c
            left join (select band, width as own from m_widths where band is not null) o on o.band = {band('predicted')},
            (select width as def from m_widths where band is null) d,
            lateral (select coalesce(own, def) as prediction_width)""",
    "m_segments": " union all ".join(
        f"select 'overall' as segment_type, 'all' as segment_value, * from m_held" if kind == "overall" else
        f"select '{kind}', {expr}, * from m_held where {expr} is not null"
        for kind, expr in {
            "overall": "", "season": "season::bigint::varchar", "position": "position", "sub_position": "sub_position",
            "age_band": """case when age_at_target_date is null then 'nan' when age_at_target_date < 21 then 'under_21' when age_at_target_date < 24 then '21_to_23'
                when age_at_target_date < 28 then '24_to_27' when age_at_target_date < 32 then '28_to_31' else '32_plus' end""",
            "competition_id": "competition_id", "competition_country_name": "competition_country_name", "value_band": band("target_market_value_eur"),
            "has_previous_market_value": "case when previous_market_value_eur is not null then 'True' else 'False' end",
            "prediction_quality_status": "prediction_quality_status"}.items()),
    "m_evaluation": f"""
        select '{VERSION}' as model_version, segment_type, segment_value, row_count, 30 as minimum_sample_size, row_count >= 30 as meets_minimum_sample_size,
            {scores()}, b_abs / row_count as baseline_mae_eur,
            case when b_abs = 0 then 0.0 else (b_abs / row_count - abs / row_count) / (b_abs / row_count) * 100 end as mae_improvement_vs_baseline_pct,
            hits / row_count * 100 as interval_coverage_pct
        from (select segment_type, segment_value, count(*) as row_count, {exact('y')} as a, {exact('y * y')} as a2, {totals('p')}, {totals('b', 'b_')},
                  count(*) filter (hit) as hits, {median('abs(y - p) / y')} as m from m_segments group by 1, 2)""",
}

NUMERIC = ["season", "height_in_cm", "age_at_target_date", "matches_before_target", "competitions_played_before_target",
           "minutes_before_target", "goals_before_target", "assists_before_target", "yellow_cards_before_target",
           "red_cards_before_target", "goals_per_90_before_target", "assists_per_90_before_target", "previous_market_value_eur",
           "days_since_previous_market_value", "prior_valuation_count", "prior_highest_market_value_eur"]
CATEGORICAL = ["position", "sub_position", "preferred_foot", "country_of_citizenship", "competition_id",
               "competition_type", "competition_country_name", "confederation"]
_SIDES = {"ref": f"(select t.* from {_T} t, m_times where season = newest)", "cur": "ml_player_market_value_scoring"}
_SPOT = "(len(l) - 1) * (i / 10::double)"
_SHARE = "greatest(coalesce({0}::double / nullif(sum({0}) over (partition by feature)::double, 0), 0), 1e-6::double)"

PARTS |= {
    "d_numbers": " union all ".join(f"select '{f}' as feature, '{side}' as side, {f}::double as value from {src}"
                                    for f in NUMERIC for side, src in _SIDES.items()),
    "d_words": " union all ".join(f"select '{f}' as feature, '{side}' as side, coalesce({f}::varchar, '__missing__') as cell from {src}"
                                  for f in CATEGORICAL for side, src in _SIDES.items()),
    "d_edges": f"""
        select feature, list_sort(list_distinct(list(e))) as edges from (
            select feature, case when {_SPOT} = floor({_SPOT}) then l[floor({_SPOT})::int + 1]
                else l[floor({_SPOT})::int + 1] * (1 - ({_SPOT} - floor({_SPOT}))) + l[ceil({_SPOT})::int + 1] * ({_SPOT} - floor({_SPOT})) end as e
            from (select feature, list_sort(list(value)) as l from d_numbers where side = 'ref' and value is not null group by 1), range(0, 11) as x(i))
        group by 1""",
    "d_cells": """
        select feature, (select count(*) from (select unnest(edges[2:len(edges) - 1]) as e) where e < value)::varchar as cell, side
        from d_numbers join d_edges using (feature) where value is not null and len(edges) >= 2
        union all select feature, cell, side from d_words""",
    "d_psi": f"""
        select feature, sum(cast(cast((c - r) * ln(c / r) as varchar) as decimal(28,15)))::varchar::double as psi from (
            select feature, {_SHARE.format('n_ref')} as r, {_SHARE.format('n_cur')} as c from (
                select feature, cell, count(*) filter (side = 'ref') as n_ref, count(*) filter (side = 'cur') as n_cur from d_cells group by 1, 2))
        group by 1""",
    "d_missing": " union all ".join(
        f"select '{f}' as feature, '{kind}' as feature_type, a.x as reference_missing_pct, b.x as current_missing_pct from "
        f"(select count(*) filter ({f} is null) / count(*) * 100 as x from {_SIDES['ref']}) a, (select count(*) filter ({f} is null) / count(*) * 100 as x from {_SIDES['cur']}) b"
        for kind, names in (("numeric", NUMERIC), ("categorical", CATEGORICAL)) for f in names),
    "m_drift": f"""
        select '{VERSION}' as model_version, feature, feature_type, coalesce(psi, 0) as psi,
            case when coalesce(psi, 0) < 0.1 then 'stable' when psi < 0.25 then 'monitor' else 'significant' end as drift_status,
            r.n as reference_row_count, c.n as current_row_count, r.lo as reference_season_min, r.hi as reference_season_max,
            c.lo as current_season_min, c.hi as current_season_max, reference_missing_pct, current_missing_pct
        from d_missing left join d_psi using (feature), (select count(*) as n, min(season) as lo, max(season) as hi from {_SIDES['ref']}) r,
            (select count(*) as n, min(season) as lo, max(season) as hi from {_SIDES['cur']}) c""",
    "m_three": " union all ".join(
        f"select '{n}' as model, row_count, {scores()} from ({metrics('m_scored', c)})"
        for n, c in {"ensemble_model": "blended", "ml_only_model": "ml", "previous_value_baseline": "base"}.items()),
    "m_gate_values": """
        select e.mae_eur as mae, e.wape_pct as wape, e.r2 as r2, b.mae_eur as base_mae,
            (select max(interval_coverage_pct) from m_evaluation where segment_type = 'overall') as cover_all,
            coalesce((select max(interval_coverage_pct) from m_evaluation where segment_type = 'value_band' and segment_value = '20m_plus'), 0) as cover_elite,
            coalesce((select min(mae_improvement_vs_baseline_pct) from m_evaluation where segment_type = 'prediction_quality_status'), -100) as worst,
            (select count(*) filter (prediction_quality_status = 'limited') / count(*) * 100 from m_current) as limited_pct,
            (select count(*) filter (drift_status = 'significant') from m_drift) as drifted
        from (select * from m_three where model = 'ensemble_model') e, (select * from m_three where model = 'previous_value_baseline') b""",
    "m_gates": " union all ".join(
        f"select '{VERSION}' as model_version, '{name}' as gate_name, ({value})::double as actual_value, '{op}' as threshold_operator, "
        f"{limit}::double as threshold_value, coalesce(({value}) {op} {limit}, false) as passed, '{severity}' as severity from m_gate_values"
        for name, value, op, limit, severity in [
            ("mae_improvement_vs_baseline_pct", "(base_mae - mae) / nullif(base_mae, 0) * 100", ">", 0.0, "blocking"),
            ("held_out_wape_pct", "wape", "<=", 15.0, "blocking"),
            ("held_out_r2", "r2", ">=", 0.95, "blocking"),
            ("overall_interval_coverage_pct", "cover_all", ">=", 85.0, "blocking"),
            ("elite_interval_coverage_pct", "cover_elite", ">=", 80.0, "blocking"),
            ("worst_quality_segment_mae_improvement_vs_baseline_pct", "worst", ">=", 0.0, "blocking"),
            ("champion_mae_regression_pct", "(mae - base_mae) / nullif(base_mae, 0) * 100", "<=", 2.0, "blocking"),
            ("current_limited_prediction_pct", "limited_pct", "<=", 25.0, "warning"),
            ("significant_drift_feature_count", "drifted", "<=", 0, "warning")]),
}

_COVERAGE = " union all ".join(
    f"""select '{g}' as segment_type, coalesce({g}::varchar, 'unavailable') as segment_value, count(*) as row_count, 30 as minimum_rows, count(*) >= 30 as meets_minimum_rows,
        case when count(*) >= 30 then count(*) filter (hit) / count(*) * 100 end as interval_coverage_pct,
        case when count(*) >= 30 then {median('width')} end as median_interval_width_eur from m_held group by 2"""
    for g in ("prediction_quality_status", "season"))
_SUMMARY = " union all ".join(
    f"""select '{g}' as segment_type, coalesce({e}::varchar, 'unavailable') as segment_value, count(*) as n, count(distinct player_id) as players,
        {exact('y')} as a, {exact('abs(y - p)')} as m, {exact('abs(y - b)')} as b, count(*) filter (hit) as hits, {median('width')} as w from m_held group by 2"""
    for g, e in {"season": "season", "position": "position", "prediction_quality_status": "prediction_quality_status",
                 "actual_value_band": f"({band('target_market_value_eur')})"}.items())

_READY = "prediction_quality_status in ('high', 'medium')"
_DELTA = "prediction_delta_vs_previous_pct"


def _players(cond: str = "true") -> str:
    return f"count(distinct player_id) filter ({cond})"


def _violations(source: str, rules: dict[str, str]) -> str:
    return " union all ".join(f"select '{n}' as rule, ({r})::bigint as violations from {source}" for n, r in rules.items())


_KEYS = {"blank_keys": "count(*) filter (training_row_key is null or trim(training_row_key) = '')",
         "repeated_keys": "count(training_row_key) - count(distinct training_row_key)"}
_NUMBERS = ["target_market_value_eur", "predicted_market_value_eur", "baseline_prediction_eur", "prediction_lower_eur", "prediction_upper_eur"]


def _odd(names: list[str]) -> str:
    return " or ".join(f"{c} is null or not isfinite({c}::double)" for c in names)


SQL = {
    "metrics_predictions": f"""
        select *, average_prediction_interval / nullif(average_predicted_market_value, 0) as average_relative_prediction_interval,
            1 - coalesce(average_prediction_interval / nullif(average_predicted_market_value, 0), 0) as average_prediction_confidence from (
            select position, {_players()} as scored_player_count, {_players(_READY)} as decision_ready_player_count,
                coalesce({_players(_READY)}::double / nullif({_players()}, 0), 0) as decision_ready_rate, avg(predicted_market_value_eur) as average_predicted_market_value,
                avg(previous_market_value_eur) as average_previous_market_value, {exact_mean(_DELTA)} / 100 as average_prediction_upside,
                {_players(f'{_DELTA} > 0')} as positive_upside_player_count, coalesce({_players(f'{_DELTA} > 0')}::double / nullif({_players()}, 0), 0) as positive_upside_rate,
                {_players(f'{_DELTA} > 20')} as high_upside_player_count, {_players(f'{_READY} and {_DELTA} > 0')} as high_upside_decision_ready_count,
                avg(prediction_interval_eur) as average_prediction_interval from m_current group by 1)""",
    "metrics_predictions_selected": f"""
        select player_id, avg(previous_market_value_eur) as selected_player_previous_value, avg(predicted_market_value_eur) as selected_player_prediction_value,
            {exact_mean(_DELTA)} / 100 as selected_player_prediction_change from m_current group by 1""",
    "metrics_audit_label": f"""
        select case when date_diff('day', {AS_OF}, DATE '2002-06-01') > 90 then 'HISTORICAL / ' else 'QUALITY AUDIT / ' end
            || upper(strftime({AS_OF}, '%d %b %Y')) as audit_label""",
    "model_prediction_violations": _violations("m_hold_out", _KEYS | {
        "invalid_prediction": f"count(*) filter ({_odd(['predicted_market_value_eur'])} or predicted_market_value_eur < 0)",
        "invalid_interval": f"""count(*) filter ({_odd(['prediction_interval_eur', 'prediction_lower_eur', 'prediction_upper_eur'])} or prediction_interval_eur <= 0
            or prediction_interval_band is null or prediction_lower_eur < 0 or prediction_lower_eur > predicted_market_value_eur or prediction_upper_eur < predicted_market_value_eur)"""}),
    "model_evaluation_violations": _violations("m_hold_out", {"empty_frame": "case when count(*) = 0 then 1 else 0 end"} | _KEYS | {
        "missing_player_or_season": "count(*) filter (player_id is null or season is null)",
        "missing_version": "count(*) filter (model_version is null or trim(model_version) = '')",
        "not_finite": f"count(*) filter ({_odd([*_NUMBERS, 'season'])})",
        "bad_sign": f"count(*) filter (target_market_value_eur <= 0 or {' or '.join(f'{c} < 0' for c in _NUMBERS[1:])})",
        "outside_interval": "count(*) filter (prediction_lower_eur > predicted_market_value_eur or predicted_market_value_eur > prediction_upper_eur)",
        "fractional_season": "count(*) filter (season <> floor(season))",
        "several_versions": "count(distinct model_version) - 1"}),
    "model_blend_weights": "select * from m_weights",
    "model_interval_widths": "select * from m_widths",
    "model_hold_out": "select * from m_hold_out",
    "model_current_predictions": "select * from m_current",
    "model_metrics": "select * from m_three",
    "model_drift": "select * from m_drift",
    "model_release_gates": "select * from m_gates",
    "model_release_status": """
        select blocking as blocking_gates_failed, warning as warning_gates_failed,
            case when blocking > 0 then 'rejected' when warning > 0 then 'approved_with_monitoring' else 'approved' end as release_status
        from (select count(*) filter (not passed and severity = 'blocking') as blocking, count(*) filter (not passed and severity = 'warning') as warning from m_gates)""",
    "model_champion": "select 'previous_value' as model_version, mae_eur as test_mae_eur from m_three where model = 'previous_value_baseline'",
    "scan_highest_targets": f"""
        select training_row_key, player_id, season, target_market_value_eur from {_T}
        order by target_market_value_eur desc, training_row_key limit 100""",
    "model_evaluation_metrics": "select * from m_evaluation",
    "model_interval_coverage": _COVERAGE,
    "model_segment_summary": f"""
        select segment_type, segment_value, n as row_count, players as unique_players, n >= 30 as meets_minimum_rows,
            case when n >= 30 then m / n end as model_mae_eur, case when n >= 30 then b / n end as baseline_mae_eur,
            case when n >= 30 and b > 0 then 100 * (1 - (m / n) / (b / n)) end as mae_skill_vs_persistence_pct,
            case when n >= 30 then 100 * m / a end as model_wape_pct, case when n >= 30 then hits / n * 100 end as observed_interval_coverage_pct,
            case when n >= 30 then w end as median_interval_width_eur from ({_SUMMARY})""",
    "model_evaluation_summary": f"""
        select '{VERSION}' as model_version, min(season) as min_test_season, max(season) as max_test_season, {exact('abs(y - p)')} / count(*) as model_mae_eur,
            {exact('abs(y - b)')} / count(*) as baseline_mae_eur, {exact('abs(y - p)')} / {exact('y')} * 100 as model_wape_pct,
            {exact('abs(y - b)')} / {exact('y')} * 100 as baseline_wape_pct, count(*) filter (hit) / count(*) * 100 as empirical_interval_coverage_pct,
            {median('width')} as median_interval_width_eur from m_held""",
}
# The same summary, over hold-out rows that went through a CSV file; the gates, through a JSON file.
SQL["model_export_summary"] = SQL["model_evaluation_summary"]
SQL["model_export_gates"] = SQL["model_release_gates"]
