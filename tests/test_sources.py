"""Scans, sinks, freshness and stored tables on files."""

import os
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from touchline.plans import transfers
from touchline.plans.warehouse import MODELS, Warehouse
from touchline.session import size_shuffles
from touchline.sources import raw, sinks
from touchline.sources.freshness import source_freshness


@pytest.fixture()
def rows(spark):
    return spark.createDataFrame([(3, "c", 1.5, date(2020, 1, 2)), (1, "a,b", None, date(2021, 5, 6)), (2, None, -2.0, None)],
                                 "id long, name string, x double, day date")


def test_csv_and_json_round_trip(spark, rows, tmp_path):
    sinks.export_csv(rows, f"{tmp_path}/csv")
    assert sorted(raw.read_csv(spark, f"{tmp_path}/csv", rows.schema).collect()) == sorted(rows.collect())
    sinks.export_json(rows, f"{tmp_path}/json")
    assert sorted(spark.read.schema(rows.schema).json(f"{tmp_path}/json").collect()) == sorted(rows.collect())
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        raw.read_csv(spark, f"{tmp_path}/csv", "id long, name long, x double, day date").collect()


def test_overwrite_replaces(spark, rows, tmp_path):
    sinks.overwrite(rows, f"{tmp_path}/t", ["id"])
    sinks.overwrite(rows.where("id > 1"), f"{tmp_path}/t")
    assert sorted(r.id for r in sinks.read_table(spark, f"{tmp_path}/t").collect()) == [2, 3]


def test_scan_orders_and_limits(rows):
    assert [r.id for r in raw.scan(rows, ["id"], order=[F.desc("id")], limit=2).collect()] == [3, 2]
    assert [tuple(r) for r in raw.scan(rows, ["name"], where=F.col("x") > 0).collect()] == [("c",)]


def test_latest_approved(spark):
    schema = "model_version string, release_status string, model_generated_at_utc timestamp, test_mae_eur double"
    at = [datetime(2020, 1, d) for d in range(1, 6)]
    history = [("a", "approved", at[0], 1.0), ("b", "approved_with_monitoring", at[2], 2.0), ("c", "rejected", at[3], 3.0), ("d", None, at[4], 4.0)]
    assert [r.model_version for r in raw.latest_approved(spark.createDataFrame(history, schema)).collect()] == ["b"]
    assert raw.latest_approved(spark.createDataFrame(history[2:], schema)).count() == 0


def test_freshness(spark, rows, tmp_path):
    now = datetime(2024, 6, 30, tzinfo=timezone.utc)
    for name, age in (("new", 1), ("older", 10), ("old", 30)):
        sinks.overwrite(rows, f"{tmp_path}/{name}")
        for f in os.listdir(f"{tmp_path}/{name}"):
            os.utime(f"{tmp_path}/{name}/{f}", (now.timestamp() - age * 86400,) * 2)
    got = {r.table_name: (r.status, round(r.age_days)) for r in source_freshness(
        spark, {n: f"{tmp_path}/{n}" for n in ("new", "older", "old")}, now.replace(tzinfo=None)).collect()}
    assert got == {"new": ("pass", 1), "older": ("warn", 10), "old": ("error", 30)}


def test_stored_and_shared_tables(spark, rows, tmp_path, monkeypatch):
    built = []
    monkeypatch.setitem(MODELS, "fct_probe", lambda wh: built.append(1) or rows)
    monkeypatch.setitem(MODELS, "fct_probe_report", lambda wh: wh["fct_probe"].where("id > 1"))
    wh = Warehouse(spark, {}, date(2020, 1, 1), location=str(tmp_path), shared={"fct_probe"})
    assert wh["fct_probe_report"].count() == 2 and wh["fct_probe"].count() == 3 and built == [1]
    assert "parquet" in wh["fct_probe_report"]._jdf.queryExecution().executedPlan().toString().lower()
    assert sorted(wh.store("fct_probe_report").collect()) == sorted(rows.where("id > 1").collect())
    assert os.path.isdir(f"{tmp_path}/fct_probe_report")
    with pytest.raises(ValueError):
        Warehouse(spark, {}, date(2020, 1, 1)).store("fct_probe")


def test_an_earlier_warehouse_takes_the_tables_of_a_later_one(spark, monkeypatch):
    built = []

    def outcomes(wh):
        built.append(wh.as_of)
        day = F.col("transfer_date")
        rows = spark.createDataFrame(
            [(1, date(2000, 1, 1), 5, date(2000, 12, 20)), (2, date(2000, 1, 1), None, None), (3, date(2001, 3, 1), 5, None),
             (4, date(2001, 8, 1), 5, None), (5, date(2002, 5, 1), 5, None), (6, None, 5, None)],
            "k long, transfer_date date, market_value_baseline long, seen date")
        rows = rows.where(day <= F.lit(wh.as_of)).withColumn("source_latest_valuation_date", F.lit(date(2002, 1, 15)))
        cutoff = F.least(F.lit(wh.as_of), "source_latest_valuation_date")
        for h in transfers.HORIZONS:
            rows = rows.withColumn(f"valuation_{h}d_date", F.col("seen")).withColumn(
                f"outcome_{h}d_status", transfers._outcome_status(h, F.col("market_value_baseline"), F.col("seen"), cutoff))
        return rows

    monkeypatch.setitem(MODELS, "fct_transfer_fixed_horizon_outcomes", outcomes)
    name, late, early = "fct_transfer_fixed_horizon_outcomes", date(2002, 12, 31), date(2001, 12, 31)
    later = Warehouse(spark, {}, late, shared={name})
    got = Warehouse(spark, {}, early, shared={name}, later=later)[name]
    assert built == [late]
    want = Warehouse(spark, {}, early)[name]
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() == 4
    assert len({r.outcome_180d_status for r in got.collect()}) > 2
    assert Warehouse(spark, {}, early, shared={name}, later=later).unstored(name).count() == 4
    with pytest.raises(ValueError):
        Warehouse(spark, {}, late, later=Warehouse(spark, {}, early))


def test_shuffles_of_many_rows_start_with_more_partitions(spark):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    try:
        size_shuffles(spark, 400_000)
        assert spark.conf.get(key, None) is None
        size_shuffles(spark, 2_000_001)
        assert spark.conf.get(key) == "21"
        size_shuffles(spark, 500_000)
        assert spark.conf.get(key) == "21"
    finally:
        spark.conf.unset(key)


def test_a_use_of_few_columns_does_not_store_the_wide_table(spark, monkeypatch):
    monkeypatch.setitem(MODELS, "fct_probe", lambda wh: spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string"))
    wh = Warehouse(spark, {}, date(2020, 1, 1), shared={"fct_probe"})
    part = wh.columns("fct_probe", "k")
    assert part.columns == ["k"] and part.inputFiles() and "fct_probe" not in wh._made
    assert wh["fct_probe"].count() == 2 and set(wh.columns("fct_probe", "v").inputFiles()) <= set(wh["fct_probe"].inputFiles())


def test_partitions_joined_by_size_stay_small_unless_the_session_sets_them(spark):
    first, size = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    have = spark.conf.get(size, None)
    try:
        spark.conf.unset(size)
        size_shuffles(spark, 1)
        assert spark.conf.get(size) == "16m"
        spark.conf.set(size, "8m")
        size_shuffles(spark, 1)
        assert spark.conf.get(size) == "8m"
    finally:
        spark.conf.unset(first)
        spark.conf.unset(size) if have is None else spark.conf.set(size, have)
