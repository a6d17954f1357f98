"""Published hand cases of the model and evaluation operators."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from touchline.functions.exprs import clean, full_years, least_known
from touchline.ml import blend, bootstrap, drift, gates, importance, intervals, scores, splits, train
from touchline.ml.forecast import PositionMedian
from touchline.plans.features import valuation_events
from touchline.streaming import history
from touchline.streaming.incremental import append_new_keys
from touchline.sources import sinks


def _events(spark, rows):
    df = spark.createDataFrame(rows, "player_id long, valuation_date date, market_value_in_eur long,"
                                     " player_club_domestic_competition_id string")
    return sorted(map(tuple, valuation_events({"stg_player_valuations": df}).collect()))


def test_valuation_events(spark):
    d = date(2024, 1, 1)
    assert _events(spark, [(1, d, 120000, "D1"), (1, d, 120000, "D1")]) == [(1, d, 120000, "D1")]
    early = date(2023, 1, 1)
    assert _events(spark, [(1, d, 100000, "D1"), (1, d, 200000, "D1"), (1, early, 50000, "D1")]) == [(1, early, 50000, "D1")]
    assert _events(spark, [(1, d, 7, "D1"), (1, d, 7, "D2")]) == [(1, d, 7, None)]
    assert _events(spark, [(1, d, None, "D"), (2, d, 0, "D"), (3, d, -1, "D"), (4, None, 5, "D"), (5, d, 300, "D")]) == [(5, d, 300, "D")]


def test_expressions(spark):
    one = spark.createDataFrame([("\t  a b \n", date(2000, 2, 29))], "s string, born date").select(
        clean("s"), full_years(date(2021, 2, 28), "born"), full_years(date(2021, 3, 1), "born"),
        least_known(F.lit(date(2020, 1, 1)), F.lit(None).cast("date"))).first()
    assert tuple(one) == ("a b", 20, 21, None)


def test_rolling_origin(spark):
    df = spark.createDataFrame([(s,) for s in (2019, 2021, 2020, 2021, 2022, 2023, 2024)], "season long")
    folds = splits.rolling_origin(df, 3)
    assert sorted(r[0] for r in folds.select("fold").distinct().collect()) == [2022, 2023, 2024]
    assert folds.where("role = 'train' and season >= fold").count() == 0
    with pytest.raises(ValueError):
        splits.rolling_origin(df, 0)


def _predictions(spark, rows):
    return spark.createDataFrame(rows, "player_id long, season long, target_market_value_eur double,"
                                       " predicted_market_value_eur double, baseline_prediction_eur double,"
                                       " prediction_lower_eur double, prediction_upper_eur double")


def test_interval_coverage(spark):
    df = _predictions(spark, [(1, 2024, 100., 0., 0., 90., 110.), (2, 2024, 200., 0., 0., 190., 210.),
                              (3, 2024, 300., 0., 0., 310., 330.), (4, 2025, 50., 0., 0., 40., 60.)])
    rows = {r.segment_value: r for r in scores.interval_coverage(df, "season", 2).collect()}
    assert rows["2024"].interval_coverage_pct == pytest.approx(200 / 3)
    assert rows["2024"].median_interval_width_eur == 20
    assert rows["2025"].interval_coverage_pct is None


def test_conformal_radius(spark):
    df = spark.createDataFrame([(float(i), 0.0) for i in range(10)], "y double, p double")
    assert intervals.finite_sample_radius(df, "y", "p").first().radius == 9.0
    few = df.limit(5)
    assert intervals.finite_sample_radius(few, "y", "p").first().radius is None


def test_bootstrap_undefined(spark):
    df = _predictions(spark, [(1, 2024, 100., 90., 50., 0., 0.), (2, 2024, 100., 100., 100., 0., 0.)])
    r = bootstrap.mae_skill_bootstrap(df, replicates=200).first()
    assert r.bootstrap_ci_status == "not_estimable_undefined_resamples" and r.bootstrap_ci_lower_pct is None
    assert r.mae_skill_vs_persistence_pct == pytest.approx(80)


@pytest.mark.parametrize("block", [10_000, 7])
def test_bootstrap_draws_add_up(spark, monkeypatch, block):
    monkeypatch.setattr(bootstrap, "BLOCK", block)
    players = spark.createDataFrame([(i, i / 8, 1.0) for i in range(100)], "player_id long, m double, b double")
    got = {r.replicate: (r.draws, r.m, r.b) for r in bootstrap.player_draws(players, "player_id", 150, 5).collect()}
    assert set(got) == set(range(150)) and all(d == b == 100 for d, _, b in got.values())
    again = {r.replicate: (r.draws, r.m, r.b) for r in bootstrap.player_draws(players.repartition(6), "player_id", 150, 5).collect()}
    assert got == again and len({m for _, m, _ in got.values()}) > 100
    mean = sum(m for _, m, _ in got.values()) / 150
    assert abs(mean - sum(range(100)) / 8) < 4 * 12.5 * 29 / 8 / 12  # four standard errors or so


def test_donors_are_permutations(spark):
    for n in (1, 2, 6, 97, 360):
        for step, start in importance.donors(n, 4, 3):
            assert sorted((step * i + start) % n for i in range(n)) == list(range(n))
    assert len(importance.donors(0, 2, 1)) == 2


def test_numbers_are_dense(spark, monkeypatch):
    df = spark.range(500).selectExpr("concat('k', id) as k", "id as v")
    monkeypatch.setattr(importance, "PART", 40)
    rows, n = importance.numbered(df.repartition(1), "k", 9)
    more, _ = importance.numbered(df.repartition(64), "k", 9)
    assert n == 500 and sorted(r.no for r in rows.collect()) == list(range(500))
    assert {(r.k, r.no) for r in rows.collect()} == {(r.k, r.no) for r in more.collect()}


def test_bootstrap_interval_holds_estimate(spark):
    df = _predictions(spark, [(i, 2024, 100. + i, 100., 90. - i % 7, 0., 0.) for i in range(300)])
    r = bootstrap.mae_skill_bootstrap(df, replicates=200).first()
    assert r.bootstrap_ci_lower_pct < r.mae_skill_vs_persistence_pct < r.bootstrap_ci_upper_pct


def test_blend_weights(spark):
    rows = [("high", 100., 100., 50.)] * 3 + [("limited", 100., 100., 50.)] * 3
    df = spark.createDataFrame(rows, "prediction_quality_status string, target_market_value_eur double,"
                                     " ml_prediction double, baseline_prediction double")
    weights = {r[0]: r[1] for r in blend.blend_weights(df, 2).collect()}
    assert weights == {"default": 1.0, "high": 1.0, "medium": 1.0, "limited": 0.0}


def test_psi_is_zero_for_equal_populations(spark):
    df = spark.createDataFrame([(float(i % 50),) for i in range(500)], "x double")
    assert drift.numeric_psi(df, df, ["x"]).first().psi == pytest.approx(0)
    moved = df.select((F.col("x") + 1000).alias("x"))
    assert drift.numeric_psi(df, moved, ["x"]).first().psi > 0.25


def test_release_status(spark):
    rows = [("blocking", True), ("warning", False)]
    df = spark.createDataFrame(rows, "severity string, passed boolean")
    assert gates.release_status(df).first().release_status == "approved_with_monitoring"


SPEC = history.HistorySpec("s", "k", ("v",))


def test_history_opens_closes_and_reopens(spark, tmp_path):
    def state(rows):
        return spark.createDataFrame(rows, "k long, v string")

    path = str(tmp_path / "h")
    history.update_history(state([(1, "a"), (2, "b")]), SPEC, path, datetime(2020, 1, 1))
    history.update_history(state([(1, "c")]), SPEC, path, datetime(2020, 1, 2))
    same = history.update_history(state([(1, "c")]), SPEC, path, datetime(2020, 1, 3))
    assert same.count() == 3
    last = history.update_history(state([(1, "c"), (2, "b")]), SPEC, path, datetime(2020, 1, 4))
    got = sorted((r.k, r.v, r.valid_from.day, r.valid_to and r.valid_to.day) for r in last.collect())
    assert got == [(1, "a", 1, 2), (1, "c", 2, None), (2, "b", 1, 2), (2, "b", 4, None)]


def test_keyed_append_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "audit")
    row = spark.createDataFrame([("run-1", 5)], "audit_key string, n long")
    append_new_keys(row, path, "audit_key")
    append_new_keys(row, path, "audit_key")
    append_new_keys(spark.createDataFrame([("run-2", 6, 1)], "audit_key string, n long, extra long"), path, "audit_key")
    assert sorted((r.audit_key, r.n, r.extra) for r in sinks.read_table(spark, path, appended=True).collect()) == [("run-1", 5, None), ("run-2", 6, 1)]


def test_yearly_sink_prunes(spark, tmp_path):
    df = spark.createDataFrame([(date(2000 + i % 3, 1, 1), i) for i in range(30)], "d date, n long")
    path = str(tmp_path / "t")
    sinks.write_by_year(df, path, "d", ["n"])
    part = sinks.read_years(spark, path, "d", date(2001, 1, 1), date(2001, 12, 31))
    assert part.count() == 10 and sinks.read_table(spark, path).count() == 30


def test_plans_of_summaries_start_at_stored_rows(spark):
    rows = [(f"{p}-{s}", p, f"p{p}", s, "D1", date(s, 6, 1), 100.0 + p + s % 7, 90.0 + p if p % 3 else None, "Attack" if p % 2 else "Defender",
             "x", 20 + p % 9, "C", 1000 + p) for s in range(2015, 2022) for p in range(20)]
    frame = spark.createDataFrame(rows, "training_row_key string, player_id long, player_name string, season long, competition_id string,"
                                        " target_market_value_date date, target_market_value_eur double, previous_market_value_eur double,"
                                        " position string, sub_position string, age_at_target_date long, competition_country_name string,"
                                        " minutes_before_target long")
    run = train.evaluate_model(frame, PositionMedian(), "v", datetime(2022, 1, 1))
    assert run.hold_out_scores() is run.hold_out_scores() and run.hold_out_scores().count() == 40
    plan = run.hold_out()._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("parquet") == 1
    assert blend.median_target(run.fitted) is blend.median_target(run.fitted)
    wide = frame.select("season", F.col("player_id").cast("double").alias("a"), F.col("minutes_before_target").cast("double").alias("b"))
    psi = drift.numeric_psi(wide.where("season = 2020"), wide.where("season = 2021"), ["a", "b"])
    assert [(r.feature, r.psi) for r in psi.orderBy("feature").collect()] == [("a", 0.0), ("b", 0.0)]
    # the deciles' passes stand in no plan of what uses them
    assert len(psi._jdf.queryExecution().optimizedPlan().toString()) < 10_000 and "Window" not in psi._jdf.queryExecution().optimizedPlan().toString()
