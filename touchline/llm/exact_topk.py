"""Exact top-k inner products by a three-phase uniform threshold.

Components become integers, floor(1024 * x).  Every vector is cut into ``SLICES`` parts of its
dimensions; a node holds one part of a block of vectors, and a node's local score of a query and
a vector is the inner product of their parts, so that the score is the sum of the local ones.

1. *Gather.*  Every node lists its best k + 1 local scores of each query.  The best of a slice are
   scored in full; the (k + 1)-th best of these scores is a safe cutoff: no answer is below it.
2. *Collect.*  A vector that reaches the cutoff has in some slice at least its even share, the
   cutoff over ``SLICES``.  Every node sends what reaches it, a packed list a query.
3. *Resolve.*  Vectors whose known local scores, with less than the share for each slice not
   sent, can still reach the cutoff get their missing scores exactly.  Each block names its best
   k + 1, and the best of these are the answer.

Equal vectors are one entry with its k + 1 smallest ids, so that a vector held by a third of all
rows is scored once; each distinct query vector is searched once.  Blocks of ``BLOCK`` entries meet
``QUERY_BLOCK`` queries in a task, which bounds its memory whatever passes the share.

Vectors that are null, empty, or hold a null or non-finite component take no part, nor do rows
without vec_id or, where lengths differ, vectors of any but the most frequent length (the shorter
on a tie).  Of rows that repeat a vec_id the greatest vector counts, as bytes.  Integers beyond
the root of 2**62 / length, 2**28 for 64 components, are held there, so that no score leaves the
long range.  Equal scores go to the smaller vec_id.  Fewer candidates than k give fewer rows; an
empty table none.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import isqrt

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .permutation_index import first_copies
from .staging import Staging

SCALE = 1024
SLICES = 2
BLOCK, QUERY_BLOCK = 4096, 512
EXACT = 1 << 53


def integers(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Usable vectors as bytes of longs."""
    for frame in frames:
        rows = []
        for i, e in zip(frame["vec_id"], frame["embedding"], strict=True):
            if e is None or pd.isna(i):
                continue
            v = np.array([np.nan if x is None else x for x in e], np.float64)
            if len(v) and np.isfinite(v).all():
                most = isqrt((1 << 62) // len(v))
                with np.errstate(over="ignore"):
                    rows.append((int(i), np.clip(np.floor(SCALE * v), -most, most).astype("<i8").tobytes()))
        yield pd.DataFrame(rows, columns=["vec_id", "vec"])


def matrix(vectors: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(vectors), "<i8").reshape(len(vectors), -1)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of a with the rows of b."""
    size = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    if size < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def score(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([int((x * y).sum()) for x, y in zip(matrix(a), matrix(b), strict=True)], dtype="int64")


def best_of(score: np.ndarray, first: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller first id."""
    if len(score) > k:
        least = np.partition(score, len(score) - k)[len(score) - k]
        at = np.flatnonzero(score >= least)
    else:
        at = np.arange(len(score))
    return at[np.lexsort((first[at], -score[at]))[:k]]


def gather(k: int):
    def lists(node: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        """Best local scores of one node for each query."""
        out = [pd.DataFrame({"q": [], "slice": [], "entry": [], "local": []}, dtype="int64")]
        if len(node) and len(queries):
            entry, place = node["entry"].to_numpy(), int(node["slice"].iloc[0])
            for q, s in zip(queries["q"], products(matrix(queries["vec"]), matrix(node["vec"])), strict=True):
                at = best_of(s, entry, k)
                out.append(pd.DataFrame({"q": q, "slice": place, "entry": entry[at], "local": s[at]}))
        return pd.concat(out)

    return lambda node, queries: lists(node, queries)


def collect(node: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
    """What reaches the share of one node, by place in the block's order of entries."""
    rows = []
    if len(node) and len(queries):
        node = node.sort_values("entry")
        block, place = int(node["block"].iloc[0]), int(node["slice"].iloc[0])
        scores = products(matrix(queries["vec"]), matrix(node["vec"]))
        for q, share, s in zip(queries["q"], queries["share"], scores, strict=True):
            at = np.flatnonzero(s >= share)
            if len(at):
                rows.append((q, block, place, at.astype("<i4").tobytes(), s[at].astype("<i8").tobytes()))
    return pd.DataFrame(rows, columns=["q", "block", "slice", "places", "locals"])


def resolve(k: int, slices: int):
    def finish(block: pd.DataFrame, lists: pd.DataFrame) -> pd.DataFrame:
        """The best entries of one block for each query, among those sent."""
        rows = []
        if len(block) and len(lists):
            block = block.sort_values("entry")
            vectors, ids = matrix(block["vec"]), block["ids"].to_list()
            first = np.array([i[0] for i in ids])
            for q, mine in lists.groupby("q"):
                cutoff, share = int(mine["cutoff"].iloc[0]), int(mine["share"].iloc[0])
                known, seen = np.zeros(len(block), np.int64), np.zeros(len(block), np.int64)
                for places, local in zip(mine["places"], mine["locals"], strict=True):
                    at = np.frombuffer(places, "<i4")
                    known[at] += np.frombuffer(local, "<i8")
                    seen[at] += 1
                # an unknown cutoff is the least long: nothing can be left out
                bound = known + (slices - seen) * (share - 1) if cutoff > -EXACT else np.full(len(block), cutoff)
                at = np.flatnonzero((seen > 0) & (bound >= cutoff))
                part = at[seen[at] < slices]
                known[part] = products(vectors[part], matrix(mine["query"].iloc[:1]))[:, 0]
                at = at[known[at] >= cutoff]
                at = at[best_of(known[at], first[at], k)]
                rows += [(q, list(ids[i]), int(known[i])) for i in at]
        return pd.DataFrame(rows, columns=["q", "ids", "score"])

    return lambda block, lists: finish(block, lists)


def top(df: DataFrame, keys: list[str], n: int, *order: Column) -> DataFrame:
    """The first n rows of each key, with their ``rank``."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= n)


def exact_top(vectors: DataFrame, is_query: Callable[[Column], Column], k: int = 10) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` of the k highest scores of every query row."""
    staging = Staging(vectors.sparkSession, "threshold")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    rows = rows.mapInPandas(integers, "vec_id long, vec binary")
    rows = staging.put("rows", rows)
    size = rows.groupBy(F.length("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    width = size[0] // 8 if size else 1
    rows = rows.where(F.length("vec") == 8 * width)
    twice = staging.put("twice", rows.groupBy("vec_id").count().where("count > 1").select("vec_id"))
    rows = rows.join(twice, "vec_id", "left_anti").union(
        rows.join(twice, "vec_id", "left_semi").groupBy("vec_id").agg(F.max("vec").alias("vec")))
    rows = staging.put("single", rows)
    n, slices = k + 1, min(SLICES, width)
    merged = (rows.mapInPandas(first_copies(n), "vec binary, ids array<long>").groupBy("vec")
              .agg(F.slice(F.array_sort(F.flatten(F.collect_list("ids"))), 1, n).alias("ids")))
    entries = staging.put("merged", merged.withColumn("entry", F.monotonically_increasing_id()))
    blocks = max(1, -(-entries.count() // BLOCK))
    entries = entries.withColumn("block", F.pmod(F.xxhash64("entry"), F.lit(blocks)).cast("int"))
    asked = rows.where(is_query(F.col("vec_id"))).join(entries.select("vec", F.col("entry").alias("q")), "vec")
    asked = staging.put("asked", asked.select(F.col("vec_id").alias("query_id"), "q"))
    queries = staging.put("queries", entries.withColumnRenamed("entry", "q").join(asked.select("q").distinct(), "q", "left_semi").select("q", "vec"))
    parts = max(1, -(-queries.count() // QUERY_BLOCK))
    queries = queries.withColumn("part", F.pmod(F.xxhash64("q"), F.lit(parts)).cast("int"))

    def cut(df: DataFrame) -> DataFrame:
        edge = [width * s // slices for s in range(slices + 1)]
        parts_of = F.array(*[F.struct(F.lit(s).alias("slice"), F.substring("vec", 8 * edge[s] + 1, 8 * (edge[s + 1] - edge[s])).alias("vec"))
                             for s in range(slices)])
        return df.withColumn("p", F.explode(parts_of)).select(*[c for c in df.columns if c != "vec"], "p.*")

    node = ["block", "slice", "part"]
    every_part = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    every_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    held = cut(entries.select("entry", "block", "vec")).withColumn("part", every_part).groupBy(node)
    sent = cut(queries).withColumn("block", every_block).groupBy(node)
    first = held.cogroup(sent).applyInPandas(gather(n), "q long, slice int, entry long, local long")
    first = top(first, ["q", "slice"], n, F.desc("local"), F.col("entry")).select("q", "entry").distinct()
    known = (staging.put("first", first).join(entries.select("entry", F.col("vec").alias("other")), "entry").join(queries, "q")
             .select("q", F.pandas_udf(score, "long")("vec", "other").alias("score")))
    cutoff = top(known, ["q"], n, F.desc("score")).where(F.col("rank") == n).select("q", F.col("score").alias("cutoff"))
    lowest = F.lit(-(1 << 63)).cast("long")
    asking = staging.put("cutoffs", queries.join(cutoff, "q", "left").withColumn("cutoff", F.coalesce("cutoff", lowest))
                         .withColumn("share", F.when(F.col("cutoff") == lowest, lowest).otherwise(
                             F.expr(f"(cutoff + pmod(-cutoff, {slices}L)) div {slices}L"))))
    sent = cut(asking).withColumn("block", every_block).groupBy(node)
    lists = staging.put("lists", held.cogroup(sent).applyInPandas(collect, "q long, block int, slice int, places binary, locals binary"))
    lists = lists.join(asking.select("q", "part", "cutoff", "share", F.col("vec").alias("query")), "q").groupBy("block", "part")
    found = entries.withColumn("part", every_part).groupBy("block", "part").cogroup(lists).applyInPandas(
        resolve(n, slices), "q long, ids array<long>, score long")
    found = top(found, ["q"], n, F.desc("score"), F.element_at("ids", 1)).select("q", F.explode("ids").alias("vec_id"), "score")
    found = staging.put("found", top(found, ["q"], n, F.desc("score"), F.col("vec_id")).drop("rank"))
    answers = asked.join(found, "q").where("query_id <> vec_id")
    return top(answers, ["query_id"], k, F.desc("score"), F.col("vec_id")).select("query_id", "rank", "vec_id", "score")
