"""What queries leave on disk while they run."""

import glob

from pyspark.sql import functions as F

from touchline import session
from touchline.operators.rolling import trailing_rows
from touchline.quality import checks, rule_set


class _Settings(dict):
    def set(self, key, value):
        self[key] = value


class _Session:
    def __init__(self, **settings):
        self.conf = _Settings(settings)


FREED, UNPACKED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "spark.sql.sources.fileCompressionFactor"


def test_queries_are_bounded_unless_the_session_says_otherwise():
    plain, own = _Session(), _Session(**{FREED: "false", UNPACKED: "1.0"})
    session.bound_queries(plain)
    session.bound_queries(own)
    assert plain.conf == {FREED: "true", UNPACKED: "8.0"} and own.conf == {FREED: "false", UNPACKED: "1.0"}


def test_a_well_compressed_file_is_not_broadcast(spark):
    rows = session.stored(spark.range(1_500_000).selectExpr("id", "id % 5 as kind"), "narrow")
    joined = spark.range(20_000_000).join(rows, "id")
    assert "BroadcastHashJoin" not in joined._jdf.queryExecution().sparkPlan().toString()


def test_stored_files_are_compressed_with_zstd(spark):
    path = session.stored(spark.range(10), "numbers").inputFiles()[0]
    assert path.endswith(".zstd.parquet")


def test_rules_store_only_cells_that_one_table_does_not_settle(spark, monkeypatch):
    made = []

    def stored(df, name):
        made.append(session.stored(df, name))
        return made[-1]

    monkeypatch.setattr(rule_set, "stored", stored)
    tables = {
        "child": spark.createDataFrame([(1, 10), (2, 10), (2, 11), (None, 12)], "id int, up int"),
        "parent": spark.createDataFrame([(10,), (11,), (13,)], "id int"),
    }
    rules = [rule_set.Rule(rule_set.UNIQUE, "child", "id"), rule_set.Rule(rule_set.NOT_NULL, "child", "id"),
             rule_set.Rule(rule_set.KEY, "child", "up", "parent", "id"),
             rule_set.Rule(rule_set.ACCEPTED, "child", "up", accepted=(10, 11)), rule_set.Rule(rule_set.UNIQUE, "parent", "id")]
    found = [(r.kind, r.table_name, r.violations) for r in rule_set.violations(spark, tables.__getitem__, rules).collect()]
    assert sorted(found) == [("accepted_values", "child", 1), ("foreign_key", "child", 1), ("not_null", "child", 1),
                             ("unique", "child", 1), ("unique", "parent", 0)]
    # The child keeps its repeated id, its null, its unknown value and three keys; the parent its three keys.
    assert [df.count() for df in made] == [6, 3]


def test_a_tally_stores_each_count_by_itself(spark, monkeypatch):
    made = []

    def stored(df, name):
        made.append(session.stored(df, name))
        return made[-1]

    monkeypatch.setattr(checks, "stored", stored)
    out = checks.tally({"a": spark.range(3), "b": spark.range(0)})
    assert len(made) == 2 and sorted(map(tuple, out.collect())) == [("a", 3), ("b", 0)]
    assert all(glob.glob(f.removeprefix("file://")) for df in made for f in df.inputFiles())


def test_trailing_rows_are_numbered_before_they_are_shuffled_again(spark):
    rows = [(k, d, i) for i, (k, d) in enumerate([(1, 3), (1, 1), (None, 2), (1, None), (1, 2), (None, None), (2, 1), (1, 3), (None, 2)])]
    df = spark.createDataFrame(rows, "k int, d int, i int")
    kept = []

    def between(numbered):
        kept.append(session.stored(numbered, "numbered"))
        return kept[-1]

    out = trailing_rows(df, "k", "d", ["i"], 2, lambda w: {"s": F.sum("i").over(w)}, block_rows=2, between=between)
    want = []
    for key in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        want += [(*r, r[2] + (own[n - 1][2] if n else 0)) for n, r in enumerate(own)]
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, want))
    assert kept[0].columns == ["k", "d", "i", "_seq"]
