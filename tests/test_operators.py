"""Operators against brute force on small fixtures."""

import math
import random
from datetime import date, timedelta
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from touchline.operators import timeline
from touchline.operators.compare import keyed_mismatches, symmetric_difference
from touchline.operators.order_stats import Want, order_statistics, sortable
from touchline.operators.rolling import trailing_rows
from touchline.operators.segments import unpivot
from touchline.plans import transfers

D0 = date(2000, 1, 1)


@pytest.fixture(scope="module")
def facts(spark):
    rng = random.Random(7)
    # Player 1 holds most of the rows.
    who = [1] * 60 + [2] * 10 + [3] * 5
    moves = [(rng.choice(who), D0 + timedelta(rng.randrange(400))) for _ in range(80)]
    values = [(rng.choice(who), D0 + timedelta(rng.randrange(900)), rng.randrange(1, 9)) for _ in range(120)]
    left = spark.createDataFrame(moves, "k long, at date").withColumn("n", F.monotonically_increasing_id())
    right = spark.createDataFrame(values, "k long, d date, v long")
    return moves, values, left, right


def _best_per_day(values):
    best = {}
    for k, d, v in values:
        best[k, d] = max(v, best.get((k, d), v))
    return best


@pytest.mark.parametrize("direction,strict", [("backward", False), ("backward", True), ("forward", False), ("forward", True)])
def test_asof_join(facts, direction, strict):
    _, values, left, right = facts
    best = _best_per_day(values)
    out = timeline.asof_join(left, right, "k", "at", "d", ["v"], "m", direction, strict).collect()
    assert len(out) == left.count()
    for r in out:
        if direction == "backward":
            days = [d for (k, d) in best if k == r.k and (d < r["at"] or (not strict and d == r["at"]))]
            want = max(days, default=None)
        else:
            days = [d for (k, d) in best if k == r.k and (d > r["at"] or (not strict and d == r["at"]))]
            want = min(days, default=None)
        assert (r.m and r.m.on) == want
        assert (r.m and r.m.v) == (best[r.k, want] if want else None)


def test_asof_needs_key(facts):
    with pytest.raises(ValueError):
        timeline.asof_join(facts[2], facts[3], "", "at", "d", ["v"])


def test_nearest_within(facts):
    moves, values, left, right = facts
    out = {(r.k, r["at"]): r for r in timeline.nearest_within(
        left, right, "k", "at", "d", ["v"], {"a": 90, "b": 365}, 30).collect()}
    assert set(out) == set(moves)
    for (k, at), r in out.items():
        for name, days in (("a", 90), ("b", 365)):
            target = at + timedelta(days)
            near = sorted((abs((d - target).days), d) for kk, d, _ in values if kk == k and abs((d - target).days) <= 30)
            assert (r[name] and r[name].on) == (near[0][1] if near else None)


def test_window_sums(facts):
    moves, values, left, right = facts
    out = timeline.window_sums(left, right, "k", "at", "d", {"n": F.lit(1), "v": F.col("v")},
                               {"pre": (-180, -1), "post": (0, 180)}).collect()
    for r in out:
        for name, lo, hi in (("pre", -180, -1), ("post", 0, 180)):
            inside = [v for k, d, v in values if k == r.k and lo <= (d - r["at"]).days <= hi]
            assert (r[name + "_n"], r[name + "_v"]) == (len(inside), sum(inside))


@pytest.mark.parametrize("block_rows", [7, 100_000])
def test_trailing_rows_in_blocks_equal_one_window(spark, facts, block_rows):
    rows = facts[3].withColumn("id", F.monotonically_increasing_id())
    measures = lambda w: {"s": F.sum("v").over(w), "c": F.count("*").over(w)}
    plain = rows.withColumns(measures(W.partitionBy("k").orderBy("d", "id").rowsBetween(-4, 0)))
    split = trailing_rows(rows, "k", "d", ["id"], 5, measures, block_rows=block_rows)
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, split.select(*plain.columns).collect()))


def test_order_statistics(spark):
    rng = np.random.default_rng(3)
    groups = {"a": rng.integers(0, 500, 2000).astype(float), "b": rng.normal(size=37), "c": np.array([4.0]),
              "d": np.array([-0.0, 0.0, 5e-324, -5e-324, 1e308, -1e308, 1.0, np.nextafter(1, 2), np.nextafter(1, 0), 2.0 ** -1022, np.inf, -np.inf]),
              None: rng.normal(size=90) * 10.0 ** rng.integers(-300, 300, 90)}
    df = spark.createDataFrame([(g, float(x)) for g, xs in groups.items() for x in xs] + [("a", None), ("e", None)], "g string, x double")
    wants = {"med": Want(0.5), "q9": Want(0.9), "hi": Want(0.9, "higher"), "least": Want(0.0, "discrete"), "low": Want(0.3, "discrete"),
             "all": Want(1.0), "sure": Want(0.9, "conformal")}
    got = order_statistics(df, ["g"], "x", wants).collect()
    assert {r.g for r in got} == set(groups)
    for r in got:
        xs = np.sort(groups[r.g])
        n = len(xs)
        assert r.n == n and r.hi == xs[math.ceil(0.9 * (n - 1))] and r.all == xs[-1] and r.least == xs[0]
        assert r.low == xs[max(math.ceil(0.3 * n), 1) - 1]
        assert r.sure == (xs[math.ceil((n + 1) * 0.9) - 1] if math.ceil((n + 1) * 0.9) <= n else None)
        if r.g != "d":
            assert r.med == pytest.approx(np.quantile(xs, 0.5), rel=1e-12) and r.q9 == pytest.approx(np.quantile(xs, 0.9), rel=1e-12)
    assert [r.med for r in order_statistics(df.where("g = 'c'"), [], "x", {"med": Want(0.5)}).collect()] == [4.0]
    assert order_statistics(df.where("x is null"), [], "x", {"med": Want(0.5)}).count() == 0


def test_order_of_doubles_is_kept(spark):
    rng = np.random.default_rng(8)
    bits = rng.integers(-(1 << 63), 1 << 63, 4000)
    xs = bits.view(np.float64)
    powers = [2.0 ** e for e in range(-1074, 1024)]
    xs = np.concatenate([xs[np.isfinite(xs)], powers, np.nextafter(powers, 0), np.nextafter(powers, np.inf), [np.inf, -np.inf, 0.0]])
    df = spark.createDataFrame([(float(x),) for x in xs], "x double").select("x", sortable(F.col("x")).alias("k"))
    rows = sorted(set(map(tuple, df.collect())))
    assert all(k < m for (_, k), (_, m) in zip(rows, rows[1:], strict=False))
    assert all(k == np.float64(x).view(np.int64) for x, k in rows if x > 0)
    assert spark.sql("select double('nan') x").select(sortable(F.col("x")).alias("k")).first().k > rows[-1][1]


@pytest.mark.parametrize("values", ["pmod(id * 7919, 5)", "pmod(id * 7919, 1000003) / 7"])
def test_order_statistics_of_a_large_group(spark, values):
    n = 1_000_000
    df = spark.range(n).selectExpr("1 as g", f"double({values}) as x")
    plan = (stats := order_statistics(df, ["g"], "x", {"q": Want(0.25, "discrete"), "med": Want(0.5)}))._jdf.queryExecution().executedPlan().toString()
    ids = np.arange(n, dtype=np.int64) * 7919
    xs = np.sort(ids % 5.0 if values.endswith("5)") else (ids % 1000003) / 7)
    assert tuple(stats.first()) == (1, n, xs[n // 4 - 1], pytest.approx(np.quantile(xs, 0.5), rel=1e-12))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_differences(spark):
    a = spark.createDataFrame([(1, "x"), (2, None), (2, None), (3, "z")], "k long, v string")
    b = spark.createDataFrame([(1, "x"), (2, None), (3, "y")], "k long, v string")
    assert sorted(tuple(r) for r in symmetric_difference(a, b).collect()) == [(3, "y", "right"), (3, "z", "left")]
    assert [r.k for r in keyed_mismatches(a.distinct(), b, ["k"], ["v"]).collect()] == [3]


def test_reconciliation_finds_planted_rows(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice(["x", "y", None]), float(rng.randint(0, 5)), i % 7) for i in range(3000)]
    left = spark.createDataFrame(rows, "k long, v string, d double, n int").repartition(5)
    right = spark.createDataFrame(rows[::-1], "k long, v string, d double, n long").repartition(3)
    assert symmetric_difference(left, right).count() == 0
    assert keyed_mismatches(left, right, ["k"], ["v", "d", "n"]).count() == 0
    assert symmetric_difference(left.union(left), right).count() == 0  # a repeated row is no difference
    for planted in ((5000, "x", 1.0, 1), (17, None, 9.0, 3)):
        other = right.union(spark.createDataFrame([planted], right.schema))
        assert [tuple(r) for r in symmetric_difference(left, other).collect()] == [(*planted, "right")]
    changed = right.withColumn("v", F.when(F.col("k") == 40, F.lit("z")).otherwise(F.col("v")))
    assert {(r.k, r.only_in) for r in symmetric_difference(left, changed).collect()} == {(40, "left"), (40, "right")}
    assert [r.k for r in keyed_mismatches(left, changed, ["k"], ["v", "d", "n"]).collect()] == [40]
    assert [r.k for r in keyed_mismatches(left, right.where("k <> 90"), ["k"], ["v", "d"]).collect()] == [90]
    swapped = right.select("k", F.when(F.col("k") == 3, F.lit(None).cast("string")).otherwise(F.col("v")).alias("v"), "d", "n")
    assert [r.k for r in keyed_mismatches(left, swapped, ["k"], ["v"]).collect()] == ([3] if rows[3][1] else [])
    none = left.limit(0)
    assert symmetric_difference(none, none).count() == 0 and symmetric_difference(left, none).count() == 3000
    blank = spark.createDataFrame([(None, "x")], "k long, v string")
    assert keyed_mismatches(blank, blank, ["k"], ["v"]).count() == 2


def test_nothing_is_joined_where_tables_agree(spark):
    left = spark.range(5000).selectExpr("id as k", "id % 11 as v").repartition(4)
    found = keyed_mismatches(left, left.repartition(3), ["k"], ["v"])
    assert found.collect() == []
    found = keyed_mismatches(left, left.repartition(3), ["k"], ["v"])
    execution = found._jdf.queryExecution()
    execution.executedPlan().executeCollect()
    final = execution.executedPlan().toString().split("Initial Plan")[0]
    assert "FullOuter" not in final


def test_unpivot_keeps_nulls(spark):
    df = spark.createDataFrame([(1, 10, None)], "id long, a long, b long")
    out = unpivot(df, ["id"], "h", {90: {"x": "a"}, 180: {"x": "b"}}).collect()
    assert sorted(map(tuple, out), key=lambda r: r[1]) == [(1, 90, 10), (1, 180, None)]


def test_discrete_quantiles_of_a_large_group(spark):
    from touchline.plans.governance import with_quantiles

    n = 250_001
    rows = spark.range(n).selectExpr("'a' as g", "pmod(id * 7919, 250001) as v").unionByName(
        spark.createDataFrame([(None, 3), (None, 1), ("b", None)], "g string, v long"))
    groups = rows.select("g").distinct()
    got = {r.g: (r.low, r.mid, r.high) for r in with_quantiles(groups, rows, ["g"], "v", {"low": 0.25, "mid": 0.5, "high": 0.75}).collect()}
    assert got == {"a": (62_500, 125_000, 187_500), None: (1, 1, 3), "b": (None, None, None)}


def test_probe_days_are_made_after_the_shuffle(facts):
    left, right = facts[2], facts[3]
    for out in (
        timeline.nearest_within(left, right, "k", "at", "d", ["v"], {"a": 10, "b": 400}, 30),
        timeline.window_sums(left, right, "k", "at", "d", {"n": F.lit(1)}, {"pre": (-3, -1), "post": (0, 3)}),
    ):
        lines = out._jdf.queryExecution().optimizedPlan().toString().splitlines()
        made = [i for i, line in enumerate(lines) if "Generate explode" in line]
        dealt = [i for i, line in enumerate(lines) if "RepartitionByExpression [k" in line]
        assert len(made) == len(dealt) == 1 and made[0] < dealt[0]  # a plan is printed from its top


def test_transfer_numbers_with_copies_undated_rows_and_repeated_clubs(spark):
    def rows(schema, *data):
        return spark.createDataFrame(list(data), schema)

    money = "decimal(38,9)"
    move = ("player_id long, transfer_date date, transfer_season string, from_club_id long, to_club_id long, from_club_name string,"
            f" to_club_name string, transfer_fee {money}, market_value_in_eur {money}, player_name string")
    day, later = date(2001, 1, 5), date(2001, 2, 5)
    one, two = Decimal(1), Decimal(2)
    wh = {
        "stg_transfers": rows(
            move, *[(1, day, "s", 7, 8, None, None, one, None, "p")] * 3, (1, later, "s", 8, 9, None, None, two, None, "p"),
            (1, None, "s", 8, 9, None, None, None, None, "p"), (2, None, "s", 7, 7, None, None, two, None, "q"),
            (1, date(1970, 1, 1), "s", 9, 8, None, None, None, None, "p")),
        "stg_player_valuations": rows(
            "player_id long, valuation_date date, market_value_in_eur long, current_club_id long, current_club_name string,"
            " player_club_domestic_competition_id string", (1, date(2001, 1, 1), 5, 7, "c", "x"), (1, date(2001, 2, 1), 6, 7, "c", "x")),
        "dim_players": rows("player_id long, player_name string, position string, sub_position string, birth_date date,"
                            " country_of_citizenship string", (1, "p", "a", "b", None, None)),
        "int_player_market_value_summary": rows(
            "player_id long, first_valuation_date date, latest_valuation_date date, first_market_value long, current_market_value long,"
            " highest_market_value long, market_value_growth long, market_value_growth_pct double"),
        "int_transfer_summary": rows(f"player_id long, total_transfer_fee {money}, avg_transfer_fee double, max_transfer_fee {money}"),
        "dim_clubs": rows("club_id long, club_name string", (7, "seven"), (9, "nine"), (9, "nine")),
    }
    out = transfers._sequenced(wh)
    got = sorted(((r.player_id, str(r.transfer_date), r.transfer_sequence_number, r.player_transfer_count, r.cumulative_known_transfer_fee,
                  str(r.previous_transfer_date), r.prior and r.prior["on"].day) for r in out.collect()), key=str)
    # Numbers count a transfer once, also where a club is there twice; an undated row comes first, the first of 1970 is a day.
    assert got == sorted([
        *[(1, "None", 1, 6, None, "None", None)] * 2, *[(1, "1970-01-01", 2, 6, None, "None", None)] * 2,
        (1, "2001-01-05", 3, 6, one, "1970-01-01", 1), (1, "2001-01-05", 4, 6, one * 2, "2001-01-05", 1),
        (1, "2001-01-05", 5, 6, one * 3, "2001-01-05", 1), *[(1, "2001-02-05", 6, 6, one * 5, "2001-01-05", 1)] * 2,
        (2, "None", 1, 1, two, "None", None)], key=str)
    assert "<=>" not in out._jdf.queryExecution().optimizedPlan().toString()
