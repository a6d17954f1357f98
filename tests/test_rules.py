"""Declared rules and release gates: each is shown to fail on planted rows."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from touchline.ml import gates
from touchline.quality import rule_set
from touchline.quality.rule_set import Rule


def test_declared_rules_are_complete():
    kinds = [r.kind for r in rule_set.declared()]
    assert [kinds.count(k) for k in (rule_set.NOT_NULL, rule_set.UNIQUE, rule_set.KEY, rule_set.ACCEPTED)] == [103, 37, 37, 16]


@pytest.fixture(scope="module")
def tables(spark):
    day = date(2020, 1, 1)
    child = spark.createDataFrame(
        [(1, 10, day, "a", 0), (2, 11, day, "b", 1), (2, 99, date(2021, 1, 1), None, 2), (None, 99, None, "c", None), (None, 98, day, "c", 0), (None, None, day, "c", 0)],
        "id long, parent_id int, day date, kind string, flag int")
    parent = spark.createDataFrame([(10, 1), (11, 1), (12, 1), (12, None)], "parent_id long, other long")
    days = spark.createDataFrame([(day,)], "d date")
    return {"child": child, "parent": parent, "days": days, "none": child.limit(0)}


def found(spark, tables, rules):
    rows = rule_set.violations(spark, tables.__getitem__, rules).collect()
    return {(r.kind, r.table_name, r.column_name): r.violations for r in rows}


def test_one_planted_violation_a_rule(spark, tables):
    rules = [Rule("not_null", "child", "id"), Rule("not_null", "child", "parent_id"), Rule("not_null", "parent", "parent_id"),
             Rule("unique", "child", "id"), Rule("unique", "child", "parent_id"), Rule("unique", "days", "d"),
             Rule("foreign_key", "child", "parent_id", "parent", "parent_id"), Rule("foreign_key", "child", "day", "days", "d"),
             Rule("foreign_key", "parent", "other", "child", "id"), Rule("foreign_key", "child", "id", "parent", "parent_id"),
             Rule("accepted_values", "child", "kind", accepted=("a", "b")), Rule("accepted_values", "child", "flag", accepted=(0, 1)),
             Rule("not_null", "none", "id"), Rule("unique", "none", "id"), Rule("foreign_key", "none", "parent_id", "parent", "parent_id")]
    assert list(found(spark, tables, rules).values()) != [] and found(spark, tables, rules) == {
        ("not_null", "child", "id"): 3, ("not_null", "child", "parent_id"): 1, ("not_null", "parent", "parent_id"): 0,
        ("unique", "child", "id"): 1, ("unique", "child", "parent_id"): 1, ("unique", "days", "d"): 0,
        ("foreign_key", "child", "parent_id"): 2, ("foreign_key", "child", "day"): 1, ("foreign_key", "parent", "other"): 0,
        ("foreign_key", "child", "id"): 2, ("accepted_values", "child", "kind"): 3, ("accepted_values", "child", "flag"): 1,
        ("not_null", "none", "id"): 0, ("unique", "none", "id"): 0, ("foreign_key", "none", "parent_id"): 0}


@pytest.mark.parametrize("rule", rule_set.declared(), ids=lambda r: f"{r.kind}-{r.table}-{r.column}")
def test_declared_rules_are_well_formed(rule):
    assert bool(rule.parent) == bool(rule.parent_column) == (rule.kind == rule_set.KEY)
    assert bool(rule.accepted) == (rule.kind == rule_set.ACCEPTED)


def test_a_table_is_read_once(spark, tables):
    rules = [Rule("not_null", "child", "id"), Rule("unique", "child", "id"), Rule("foreign_key", "child", "parent_id", "parent", "parent_id"),
             Rule("accepted_values", "child", "kind", accepted=("a",)), Rule("unique", "parent", "parent_id")]
    seen = []
    rule_set.violations(spark, lambda t: seen.append(t) or tables[t], rules)
    assert sorted(seen) == ["child", "parent"]


METRICS = "mae_eur double, wape_pct double, r2 double"
SEGMENTS = "segment_type string, segment_value string, interval_coverage_pct double, mae_improvement_vs_baseline_pct double"
CHAMPION = "test_mae_eur double, model_version string"


def status(spark, mae=80.0, wape=10.0, r2=0.97, cover=92.0, champion=((81.0, "old"),), limited=0, drifted=0, ensemble=True):
    one = spark.createDataFrame([(mae, wape, r2)] if ensemble else [], METRICS)
    segments = spark.createDataFrame([("overall", "all", cover, 5.0), ("value_band", "20m_plus", cover, 5.0), ("prediction_quality_status", "high", cover, 5.0)], SEGMENTS)
    current = spark.createDataFrame([("limited",)] * limited + [("high",)] * (100 - limited), "prediction_quality_status string")
    drift = spark.createDataFrame([("significant",)] * drifted + [("stable",)], "drift_status string")
    past = None if champion is None else spark.createDataFrame(list(champion), CHAMPION)
    made = gates.quality_gates(one, spark.createDataFrame([(100.0, 20.0, 0.9)], METRICS), segments, "v", datetime(2020, 1, 1), past, current, drift)
    names = [r.gate_name for r in made.collect()]
    return names, gates.release_status(made).first(), made


def test_gates_pass_and_fail(spark):
    names, row, made = status(spark)
    assert len(names) == 9 and row.release_status == "approved"
    gates.assert_blocking_gates(made)
    for bad in ({"mae": 200.0}, {"wape": 90.0}, {"r2": 0.1}, {"cover": 10.0}, {"champion": [(10.0, "old")]}):
        _, row, made = status(spark, **bad)
        assert row.release_status == "rejected" and row.blocking_gates_failed >= 1, bad
        with pytest.raises(ValueError):
            gates.assert_blocking_gates(made)
    for odd in ({"limited": 90}, {"drifted": 1}):
        assert status(spark, **odd)[1].release_status == "approved_with_monitoring", odd


def test_only_the_champion_gate_is_left_out(spark):
    for champion in (None, []):
        names, row, _ = status(spark, champion=champion)
        assert len(names) == 8 and gates.CHAMPION not in names and row.release_status == "approved"
        names, row, _ = status(spark, champion=champion, mae=200.0, wape=90.0, r2=0.0, cover=0.0)
        assert len(names) == 8 and row.release_status == "rejected" and row.blocking_gates_failed >= 5
    # a champion whose error is unknown fails its gate
    assert status(spark, champion=[(None, "old")])[1].release_status == "rejected"
    # no metrics at all: every gate is there and fails
    names, row, _ = status(spark, ensemble=False)
    assert len(names) == 9 and row.release_status == "rejected"


def test_no_gates_are_no_approval(spark):
    none = status(spark)[2].where(F.lit(False))
    assert gates.release_status(none).first().release_status == "rejected"
    with pytest.raises(ValueError):
        gates.assert_blocking_gates(none)
