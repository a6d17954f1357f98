"""Every operator as a query over one folder of the given tables."""

from __future__ import annotations

import uuid
from datetime import date, datetime
from typing import Callable
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline import session
from touchline.ml import blend, bootstrap, drift, gates, importance, intervals, scores, splits, train, validate, walk_forward
from touchline.ml.contract import CATEGORICAL, NUMERIC, TARGET
from touchline.ml.forecast import BoostedTrees, PositionMedian
from touchline.plans import analyses, audit, metrics
from touchline.plans.warehouse import MODELS, SHARED, Warehouse
from touchline.quality import checks, invariants, profile, rule_set, rules
from touchline.sources import raw, sinks
from touchline.sources.driver_tables import DriverTables
from touchline.streaming import history

AS_OF = date(2001, 12, 31)
# An earlier reporting date, at which late transfers are not yet observable.
MIDWAY = date(2000, 6, 30)
# The reporting date of the earlier audit row.
EARLY = date(1997, 6, 30)
RUN_AT = datetime(2002, 1, 1)
RUN_NAME = "position_median_run"

Query = Callable[[SparkSession, str], DataFrame]

# Plans are lazy, so queries of one session share their frames.
_WAREHOUSES: WeakKeyDictionary = WeakKeyDictionary()


def warehouse(spark: SparkSession, root: str, as_of: date = AS_OF) -> Warehouse:
    made = _WAREHOUSES.setdefault(spark, {})
    if (root, as_of) not in made:
        later = warehouse(spark, root) if as_of < AS_OF else None
        tables = later.raw if later else DriverTables(spark, root)
        if not later:
            session.bound_queries(spark)
            session.size_shuffles(spark, tables.most_rows())
        made[root, as_of] = Warehouse(spark, tables, as_of, shared=SHARED, later=later)
    return made[root, as_of]


_PORTABLE = {"int": "bigint", "smallint": "bigint", "tinyint": "bigint", "float": "double"}


def plain(df: DataFrame) -> DataFrame:
    """Portable column types: integers as long, exact money as double."""
    def cast(name: str, kind: str) -> str:
        target = "double" if kind.startswith("decimal") else _PORTABLE.get(kind)
        return f"cast({name} as {target}) as {name}" if target else name

    return df.selectExpr(*[cast(name, kind) for name, kind in df.dtypes])


def _on(build: Callable[[Warehouse], DataFrame], as_of: date = AS_OF) -> Query:
    return lambda spark, root: plain(build(warehouse(spark, root, as_of)))


# -- model runs ---------------------------------------------------------------

_RUNS: WeakKeyDictionary = WeakKeyDictionary()


def _kept(wh: Warehouse, name: str, build: Callable[[], object]):
    """Build once per warehouse; a frame is stored in the shared folder, so later plans start there."""
    made = _RUNS.setdefault(wh, {})
    if name not in made:
        value = build()
        made[name] = session.stored(value, name) if isinstance(value, DataFrame) else value
    return made[name]


def features_of(wh: Warehouse, kind: str) -> DataFrame:
    """Feature table shared by the model queries of a session."""
    return _kept(wh, kind, lambda: wh[f"ml_player_market_value_{kind}"])


def median_run(wh: Warehouse) -> train.Run:
    """Evaluated run of the position-median forecaster on this warehouse."""
    return _kept(wh, "run", lambda: train.evaluate_model(
        features_of(wh, "training"), PositionMedian(), RUN_NAME, RUN_AT))


def hold_out(wh: Warehouse) -> DataFrame:
    return _kept(wh, "hold_out", lambda: median_run(wh).hold_out().drop("model_generated_at_utc"))


def current_predictions(wh: Warehouse) -> DataFrame:
    def build() -> DataFrame:
        run = median_run(wh)
        refitted = PositionMedian().fit(run.frame)
        return run.score_current(features_of(wh, "scoring"), refitted).drop("model_generated_at_utc")

    return _kept(wh, "current", build)


def model_metrics(wh: Warehouse) -> DataFrame:
    """The seven error metrics of blend, model and baseline on the hold-out."""
    return _kept(wh, "metrics", lambda: _model_metrics(wh))


def _model_metrics(wh: Warehouse) -> DataFrame:
    parts = {"ensemble_model": "blended", "ml_only_model": blend.ML, "previous_value_baseline": blend.BASE}
    told = F.array(*[F.struct(F.lit(name).alias("model"), F.col(c).alias("predicted")) for name, c in parts.items()])
    rows = median_run(wh).hold_out_scores().select(TARGET, F.explode(told).alias("t")).select(TARGET, "t.*")
    return scores.regression_metrics(rows, TARGET, "predicted", ["model"])


def evaluation_metrics(wh: Warehouse) -> DataFrame:
    return _kept(wh, "evaluation", lambda: scores.evaluation_metrics(hold_out(wh)))


def run_importance(wh: Warehouse) -> DataFrame:
    """Importance of the features to the evaluated forecaster."""
    def build() -> DataFrame:
        run = median_run(wh)
        return importance.permutation_importance(run.model, run.times.test_rows(run.frame), RUN_NAME)

    return _kept(wh, "importance", build)


def feature_drift(wh: Warehouse) -> DataFrame:
    return _kept(wh, "drift", lambda: _feature_drift(wh))


def _feature_drift(wh: Warehouse) -> DataFrame:
    frame = features_of(wh, "training")
    newest = splits.seasons_of(frame)[-1]
    reference = frame.where(F.col("season") == newest)
    return drift.feature_drift(reference, features_of(wh, "scoring"), RUN_NAME)


def release_gates(wh: Warehouse) -> DataFrame:
    return _kept(wh, "gates", lambda: _release_gates(wh))


def _release_gates(wh: Warehouse) -> DataFrame:
    measured = model_metrics(wh)
    ensemble = measured.where("model = 'ensemble_model'")
    baseline = measured.where("model = 'previous_value_baseline'")
    return gates.quality_gates(
        ensemble, baseline, evaluation_metrics(wh), RUN_NAME, RUN_AT, champion(wh),
        current_predictions(wh), feature_drift(wh)).drop("model_generated_at_utc", "details")


def past_releases(wh: Warehouse) -> DataFrame:
    """Registry rows before this run: the persistence baseline, approved, and the bare model, rejected later."""
    rows = {"previous_value_baseline": ("previous_value", "approved", datetime(2000, 1, 1)),
            "ml_only_model": ("bare_median", "rejected", datetime(2001, 1, 1))}
    pick = F.create_map(*[F.lit(x) for k, (name, _, _) in rows.items() for x in (k, name)])
    state = F.create_map(*[F.lit(x) for k, (_, status, _) in rows.items() for x in (k, status)])
    made = F.create_map(*[F.lit(x) for k, (_, _, when) in rows.items() for x in (k, when)])
    return model_metrics(wh).where(F.col("model").isin(*rows)).select(
        F.try_element_at(pick, "model").alias("model_version"), F.try_element_at(state, "model").alias("release_status"),
        F.try_element_at(made, "model").cast("timestamp").alias("model_generated_at_utc"), F.col("mae_eur").alias("test_mae_eur"))


def champion(wh: Warehouse) -> DataFrame:
    """Newest approved release before this run."""
    return raw.latest_approved(past_releases(wh)).select("model_version", "test_mae_eur")


def _file(wh: Warehouse, name: str) -> str:
    return f"{session.shared_folder(wh.spark)}/{name}-{uuid.uuid4().hex}"


def export_summary(wh: Warehouse) -> DataFrame:
    """Summary of a hold-out export, read back from its CSV files with the declared types."""
    def build() -> DataFrame:
        sinks.export_csv(hold_out(wh), path := _file(wh, "hold_out.csv"))
        return scores.evaluation_summary(raw.read_csv(wh.spark, path, hold_out(wh).schema))

    return _kept(wh, "export_summary", build)


def export_gates(wh: Warehouse) -> DataFrame:
    """Release gates read back from their JSON artifact."""
    def build() -> DataFrame:
        sinks.export_json(release_gates(wh), path := _file(wh, "gates.json"))
        return wh.spark.read.schema(release_gates(wh).schema).json(path)

    return _kept(wh, "export_gates", build)


def conformal_radius(wh: Warehouse) -> DataFrame:
    run = median_run(wh)
    rows = blend.with_baseline(run.model.predict(run.times.calibration_rows(run.frame)), run.fitted)
    return intervals.finite_sample_radius(rows, TARGET, blend.BASE)


def rolling_folds(wh: Warehouse) -> DataFrame:
    folds = splits.rolling_origin(features_of(wh, "training").select("season", "player_id"), 4)
    return folds.groupBy("fold", "role", "season").agg(
        F.count("*").alias("row_count"), F.count_distinct("player_id").alias("players"))


def _boosted(wh: Warehouse) -> train.Run:
    """The boosted-tree run, with its 300 rounds."""
    return _kept(wh, "boosted", lambda: train.evaluate_model(
        features_of(wh, "training"), BoostedTrees(), "boosted_run", RUN_AT))


def boosted_hold_out(wh: Warehouse) -> DataFrame:
    return _boosted(wh).hold_out().drop("model_generated_at_utc")


def boosted_importance(wh: Warehouse) -> DataFrame:
    run = _boosted(wh)
    return importance.permutation_importance(run.model, run.times.test_rows(run.frame), run.version)


def registry_row(wh: Warehouse) -> DataFrame:
    run = median_run(wh)
    ensemble = model_metrics(wh).where("model = 'ensemble_model'").drop("model")
    return train.registry_row(run, gates.release_status(release_gates(wh)), ensemble).drop("model_generated_at_utc")


def published_outputs(wh: Warehouse) -> DataFrame:
    stamp = F.lit(RUN_AT).cast("timestamp").alias("model_generated_at_utc")
    status = gates.release_status(release_gates(wh)).select("release_status", F.lit(RUN_NAME).alias("model_version"), stamp)
    return rules.published_outputs(
        status, release_gates(wh), current_predictions(wh), hold_out(wh), evaluation_metrics(wh),
        feature_drift(wh), run_importance(wh))


def provenance(wh: Warehouse) -> DataFrame:
    return validate.provenance_violations(hold_out(wh), median_run(wh).run_metadata())


# -- run-over-run tables ------------------------------------------------------

VALUED_PROFILE = history.HistorySpec(
    "int_player_market_value_summary", "player_id", ("club_id", "club_name", "market_value_in_eur"))


def valued_profile(wh: Warehouse, until: date) -> DataFrame:
    """Club and value of each player from valuations up to a day."""
    newest = F.max(F.struct("valuation_date", "market_value_in_eur", "current_club_id", "current_club_name"))
    return (
        wh["stg_player_valuations"].where(F.col("valuation_date") <= F.lit(until))
        .groupBy("player_id").agg(newest.alias("v"))
        .select("player_id", F.col("v.current_club_id").alias("club_id"), F.col("v.current_club_name").alias("club_name"),
                F.col("v.market_value_in_eur").alias("market_value_in_eur")))


STATE_DAYS = (date(1996, 12, 31), date(1999, 12, 31), date(2001, 12, 31))


def _history(states: Callable[[date], DataFrame], spec: history.HistorySpec) -> DataFrame:
    """Type-2 history over the states of three days."""
    at = [datetime(day.year, day.month, day.day) for day in STATE_DAYS]
    out = history.first_history(states(STATE_DAYS[0]), spec, at[0])
    for day, when in zip(STATE_DAYS[1:], at[1:], strict=True):
        out = history.next_history(out, states(day), spec, when)
    return out.withColumns({c: F.to_date(c) for c in (history.FROM, history.TO)})


def profile_history(wh: Warehouse) -> DataFrame:
    return _history(lambda day: valued_profile(wh, day), VALUED_PROFILE)


def player_profile(wh: Warehouse, until: date) -> DataFrame:
    """Player profiles with the club and value known on a day."""
    known = valued_profile(wh, until).select(
        "player_id", F.col("club_id").alias("current_club_id"), "market_value_in_eur")
    fixed = wh["stg_players"].drop("current_club_id", "market_value_in_eur")
    return fixed.join(known, "player_id", "left").select("player_id", *history.PLAYER_PROFILES.checked)


def club_profile(wh: Warehouse, until: date) -> DataFrame:
    """Club profiles with the manager of the newest game up to a day as coach."""
    games = wh["stg_games"].where(F.col("game_date") <= F.lit(until)).select("game_id", "game_date")
    coach = wh["stg_club_games"].join(games, "game_id").groupBy("club_id").agg(
        F.max(F.struct("game_date", "game_id", "own_manager_name")).alias("g")).select(
        "club_id", F.col("g.own_manager_name").alias("coach_name"))
    return wh["stg_clubs"].drop("coach_name").join(coach, "club_id", "left").select("club_id", *history.CLUB_PROFILES.checked)


def refresh_audit(spark: SparkSession, root: str) -> DataFrame:
    """Audit rows of an earlier and of the final reporting date."""
    rows = [audit.audit_row(warehouse(spark, root, day), f"run-{day}", datetime(day.year, day.month, day.day))
            for day in (EARLY, AS_OF)]
    return rows[0].unionByName(rows[1])


def _declared_rules(*kinds: str) -> Query:
    """Violations of the declared column rules; of one kind under the names (table.column)."""
    def build(spark: SparkSession, root: str) -> DataFrame:
        wh = warehouse(spark, root)

        def frame(name: str) -> DataFrame:
            if name == "fct_analytics_refresh_audit":
                return refresh_audit(spark, root)
            return wh.raw[name.removeprefix("source.")] if name.startswith("source.") else wh[name]

        rules = rule_set.declared(*kinds)
        if any(r.table == "fct_transfer_market_value_analysis" for r in rules):
            # First, so that the outcomes take their columns from its files.
            wh["fct_transfer_market_value_analysis"]
        found = rule_set.violations(spark, frame, rules)
        return plain(found.select(F.concat_ws(".", "table_name", "column_name").alias("check_name"), "violations") if kinds else found)

    return build


def _audit_query(spark: SparkSession, root: str) -> DataFrame:
    return plain(refresh_audit(spark, root).drop("audit_generated_at_utc"))


def _volume_query(spark: SparkSession, root: str) -> DataFrame:
    return plain(invariants.volume_changes(refresh_audit(spark, root)))


def _audit_label(spark: SparkSession, root: str) -> DataFrame:
    return metrics.audit_age_label(refresh_audit(spark, root), datetime(2002, 6, 1))


def _assess(spark: SparkSession, root: str) -> DataFrame:
    wh = warehouse(spark, root)
    return plain(rules.assess(rules.domain_checks(wh), refresh_audit(spark, root), datetime(2002, 2, 1)))


def _scan_query(wh: Warehouse) -> DataFrame:
    """Feature-table scan: projection, filter and order."""
    return raw.scan(
        features_of(wh, "training"),
        ["training_row_key", "season", *[c for c in NUMERIC if c != "season"], TARGET],
        where=(F.col("season") >= 1998) & F.col("has_previous_market_value"),
        order=["season", "training_row_key"])


def _reference_metrics(wh: Warehouse) -> DataFrame:
    """Single-value report measures, one row each."""
    out = None
    for name in ("observed_transfer_outcomes", "cohort_outcome_coverage", "average_reliable_cohort_median_change",
                 "segment_known_fee_coverage", "net_transfer_spend", "reliable_club_success_rate", "rolling_5_goals_per_90"):
        one = metrics.metric(wh, name).select(F.lit(name).alias("metric"), F.col(name).cast("double").alias("value"))
        out = one if out is None else out.unionByName(one)
    return out


def _all_metrics(fact: str, by: list[str], selected: bool = False) -> Callable[[Warehouse], DataFrame]:
    """All metrics of a fact; ``selected`` takes the single-player ones."""
    def build(wh: Warehouse) -> DataFrame:
        names = [n for n in metrics.metrics_of(fact) if n.startswith("selected_player") == selected]
        source = current_predictions(wh) if fact == metrics.PREDICTIONS else wh[fact]
        return metrics.metric(wh, names, by, fact_df=source)

    return build


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {name: _on(lambda wh, n=name: wh[n]) for name in MODELS}
    out["fct_transfer_fixed_horizon_outcomes_midway"] = _on(lambda wh: wh["fct_transfer_fixed_horizon_outcomes"], MIDWAY)
    out["fct_transfer_cohort_performance_midway"] = _on(lambda wh: wh["fct_transfer_cohort_performance"], MIDWAY)
    for name, build in analyses.ANALYSES.items():
        out[name] = _on(build)
    out["audit_transfer_365d_capture_midway"] = _on(lambda wh: analyses.audit_transfer_365d_capture(wh, MIDWAY))

    governed = ["transfers", "observed_365d_transfers", "transfer_365d_outcome_coverage",
                "average_365d_market_value_change_pct", "average_transfer_fee_premium_pct"]
    out.update({
        "scan_training_features": _on(_scan_query),
        "scan_highest_targets": _on(lambda wh: raw.scan(
            features_of(wh, "training"), ["training_row_key", "player_id", "season", TARGET],
            order=[F.desc(TARGET), "training_row_key"], limit=100)),
        "metrics_governed_transfers": _on(lambda wh: metrics.metric(wh, governed, ["position", "age_band_at_transfer"])),
        "metrics_governed_clubs": _on(lambda wh: metrics.metric(wh, ["club_matches", "club_points"], ["season"])),
        "metrics_transfers_by_year": _on(_all_metrics("fct_transfer_market_value_analysis", ["transfer_year"])),
        "metrics_transfers_selected": _on(_all_metrics("fct_transfer_market_value_analysis", ["player_id"], True)),
        "metrics_fee_year_over_year": _on(metrics.fee_year_over_year),
        "metrics_predictions": _on(_all_metrics(metrics.PREDICTIONS, ["position"])),
        "metrics_predictions_selected": _on(_all_metrics(metrics.PREDICTIONS, ["player_id"], True)),
        "metrics_performance": _on(_all_metrics("fct_player_performance", ["position"])),
        "metrics_labels": _on(_all_metrics("fct_transfer_success_labels", ["position"])),
        "metrics_matured_outcomes": _on(lambda wh: metrics.matured_outcomes(wh, ["transfer_year"])),
        "metrics_outcome_status": _on(metrics.transfers_by_status),
        "metrics_median_change": _on(lambda wh: metrics.median_outcome_change(wh, ["position"])),
        "metrics_reference": _on(_reference_metrics),
        "metrics_audit_label": _audit_label,
        "report_age_groups": _on(metrics.report_columns_players),
        "report_fee_ranges": _on(metrics.report_columns_fees),
        "report_competition_labels": _on(metrics.report_columns_competitions),
        "check_nulls": _on(invariants.nulls),
        "check_grains": _on(lambda wh: checks.tally(invariants.grains(wh))),
        "check_declared_rules": _declared_rules(),
        "check_foreign_keys": _declared_rules(rule_set.KEY),
        "check_accepted_values": _declared_rules(rule_set.ACCEPTED),
        "check_recomputed": _on(lambda wh: checks.tally(invariants.recomputed(wh))),
        "check_reconciled": _on(lambda wh: checks.tally(invariants.reconciled(wh))),
        "check_row_rules": _on(lambda wh: checks.tally(invariants.row_rules(wh))),
        "check_leakage": _on(lambda wh: checks.tally(invariants.leakage(wh))),
        "check_row_counts": _on(invariants.coverage),
        "check_ml_coverage": _on(invariants.ml_coverage),
        "check_scoring_readiness": _on(invariants.scoring_readiness),
        "check_sequence": _on(lambda wh: checks.tally({"transfer_sequence": invariants.sequence_proof(wh)})),
        "check_calendar": _on(lambda wh: checks.tally({"calendar": invariants.calendar_continuity(wh)})),
        "check_history": _on(lambda wh: checks.tally({"history": invariants.history_validity(profile_history(wh), "player_id")})),
        "check_volumes": _volume_query,
        "check_domains": _on(rules.domain_checks),
        "check_assessment": _assess,
        "check_export": _on(lambda wh: rules.export_violations(analyses.audit_transfer_365d_row_level(wh, MIDWAY), MIDWAY)),
        "check_published_outputs": _on(published_outputs),
        "source_profile": _on(lambda wh: profile.source_profile(wh.raw, MIDWAY)),
        "source_issues": _on(lambda wh: profile.source_issues(profile.source_profile(wh.raw, MIDWAY))),
        "profile_history": _on(profile_history),
        "player_profile_history": _on(lambda wh: _history(lambda day: player_profile(wh, day), history.PLAYER_PROFILES)),
        "club_profile_history": _on(lambda wh: _history(lambda day: club_profile(wh, day), history.CLUB_PROFILES)),
        "refresh_audit": _audit_query,
        "model_training_violations": _on(lambda wh: validate.input_violations(features_of(wh, "training"), "training")),
        "model_scoring_violations": _on(lambda wh: validate.input_violations(features_of(wh, "scoring"), "scoring")),
        "model_research_violations": _on(lambda wh: validate.research_violations(
            features_of(wh, "training"), NUMERIC, CATEGORICAL)),
        "model_prediction_violations": _on(lambda wh: validate.prediction_violations(
            hold_out(wh), "training_row_key", "predicted_market_value_eur")),
        "model_evaluation_violations": _on(lambda wh: validate.evaluation_violations(hold_out(wh))),
        "model_provenance_violations": _on(provenance),
        "model_rolling_folds": _on(rolling_folds),
        "model_blend_weights": _on(lambda wh: median_run(wh).weights),
        "model_interval_widths": _on(lambda wh: median_run(wh).widths),
        "model_conformal_radius": _on(conformal_radius),
        "model_hold_out": _on(hold_out),
        "model_current_predictions": _on(current_predictions),
        "model_metrics": _on(model_metrics),
        "model_evaluation_metrics": _on(evaluation_metrics),
        "model_segment_summary": _on(lambda wh: scores.segment_summary(hold_out(wh))),
        "model_evaluation_summary": _on(lambda wh: scores.evaluation_summary(hold_out(wh))),
        "model_interval_coverage": _on(lambda wh: scores.interval_coverage(hold_out(wh), "prediction_quality_status")
                                       .unionByName(scores.interval_coverage(hold_out(wh), "season"))),
        "model_drift": _on(feature_drift),
        "model_release_gates": _on(release_gates),
        "model_release_status": _on(lambda wh: gates.release_status(release_gates(wh))),
        "model_champion": _on(champion),
        "model_export_summary": _on(export_summary),
        "model_export_gates": _on(export_gates),
        "model_registry_row": _on(registry_row),
        "model_bootstrap": _on(lambda wh: bootstrap.mae_skill_bootstrap(hold_out(wh))),
        "model_walk_forward": _on(lambda wh: walk_forward.walk_forward(features_of(wh, "training"), PositionMedian())),
        "model_boosted_hold_out": _on(boosted_hold_out),
        "model_boosted_importance": _on(boosted_importance),
    })
    return out
