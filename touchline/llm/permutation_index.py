"""Nearest neighbours by inner product with a permutation index.

A vector is represented by its ``PREFIX`` nearest of ``PIVOTS`` pivots, in order.  Equal vectors
are one entry with their smallest ids.  Entries are dealt to blocks of about ``BLOCK``; a block
posts them in one inverted file a pivot, with the pivot's rank.  A query walks the files of its
own pivots and gets the footrule distance of all entries met, as the sum over shared pivots of
PREFIX - max(rank, rank'), which differs from the distance by a constant.  The nearest
``SHARE`` of each block, at least ``LEAST``, are ranked again by inner products of the original
vectors in double precision, and the best of all blocks are the answer.

Queries are searched in blocks against all blocks; nothing larger than a block of entries and one
of queries meets in a task, and a block gives no more rows than the answer holds.  Pivots are the ``PIVOTS`` entries of least hash, a fixed number.  Each distinct query
vector is searched once; its copies are joined to the answer.

Vectors that are null, zero, or hold a null or non-finite component take no part, nor do rows
without vec_id or, where lengths differ, vectors of any but the most frequent length (the
shorter on a tie).  Rows that repeat id and vector count once; rows that repeat an id with
another vector are entries of their own, and a query never returns its own id.  Equal scores
go to the smaller vec_id.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .staging import Staging

PIVOTS, PREFIX = 256, 64
BLOCK, QUERY_BLOCK = 16_384, 512
SHARE, LEAST = 0.12, 512


def clean(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Usable vectors as bytes of doubles."""
    for frame in frames:
        rows = []
        for i, e in zip(frame["vec_id"], frame["embedding"], strict=True):
            if e is None or pd.isna(i):
                continue
            v = np.array([np.nan if x is None else x for x in e], np.float64)
            if len(v) and np.isfinite(v).all() and v.any():
                rows.append((int(i), (v + 0.0).tobytes()))
        yield pd.DataFrame(rows, columns=["vec_id", "vec"])


def first_copies(keep: int):
    """The smallest ids of each vector of a frame, so that a hot vector leaves few rows."""

    def shrink(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            least = frame.drop_duplicates().sort_values("vec_id").groupby("vec").head(keep).groupby("vec")["vec_id"]
            rows = [(vec, ids.to_list()) for vec, ids in least]
            yield pd.DataFrame(rows, columns=["vec", "ids"])

    return shrink


def matrix(vectors: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(vectors), np.float64).reshape(len(vectors), -1)


def permuted(pivots: np.ndarray):
    def permute(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = min(PREFIX, len(pivots))
        for frame in frames:
            if len(frame):
                order = np.argsort(-(matrix(frame["vec"]) @ pivots.T), axis=1, kind="stable")[:, :n].astype(np.int16)
                yield frame.assign(perm=[p.tobytes() for p in order])

    return permute


def searcher(k: int, n_pivots: int):
    def search(block: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        """The best entries of one block for each query of another."""
        names = ["rep", "vec_id", "score"]
        if not len(block) or not len(queries):
            return pd.DataFrame({c: [] for c in names})
        m, vectors = len(block), matrix(block["vec"])
        perm = np.frombuffer(b"".join(block["perm"]), np.int16).reshape(m, -1)
        width = perm.shape[1]
        # One inverted file a pivot, as the nearness of its rank for every entry: a quarter are posted.
        files = np.zeros((n_pivots, m), np.uint16)
        files[perm, np.arange(m)[:, None]] = np.arange(width, 0, -1, dtype=np.uint16)
        own = np.arange(width, 0, -1, dtype=np.uint16)[:, None]
        take = min(m, max(LEAST, k, int(np.ceil(SHARE * m))))
        ids = [np.asarray(x) for x in block["ids"]]
        out = []
        asked = np.frombuffer(b"".join(queries["perm"]), np.int16).reshape(len(queries), -1)
        for rep, q, mine in zip(queries["rep"], matrix(queries["vec"]), asked, strict=True):
            total = np.minimum(files[mine], own).sum(axis=0, dtype=np.uint16)
            c = np.argpartition(total, m - take)[m - take :]
            score = vectors[c] @ q
            best = np.argsort(-score, kind="stable")
            best = best[score[best] >= score[best[min(k, len(best)) - 1]]]  # with ties
            found = np.concatenate([ids[i] for i in c[best]])
            value = np.repeat(score[best], [len(ids[i]) for i in c[best]])
            top = np.lexsort((found, -value))[:k]
            out.append(pd.DataFrame({"rep": rep, "vec_id": found[top], "score": value[top]}))
        return pd.concat(out)

    return lambda block, queries: search(block, queries)


def nearest(vectors: DataFrame, is_query: Callable[[Column], Column], k: int = 20) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` of the k nearest of every query row."""
    spark = vectors.sparkSession
    staging = Staging(spark, "permutation")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    rows = rows.mapInPandas(clean, "vec_id long, vec binary")
    size = rows.groupBy(F.length("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    rows = staging.put("rows", rows.where(F.length("vec") == (size[0] if size else 0)))
    merged = (rows.mapInPandas(first_copies(k + 1), "vec binary, ids array<long>").groupBy("vec")
              .agg(F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, k + 1).alias("ids")))
    merged = staging.put("merged", merged)
    chosen = merged.orderBy(F.xxhash64("vec"), "vec").limit(PIVOTS).select("vec").toPandas()["vec"]
    pivots = matrix(chosen) if len(chosen) else np.zeros((0, 1))
    blocks = max(1, -(-merged.count() // BLOCK))
    schema = "vec binary, ids array<long>, perm binary"
    index = staging.put("index", merged.mapInPandas(permuted(pivots), schema).withColumn(
        "block", F.pmod(F.xxhash64("vec"), F.lit(blocks)).cast("int")))
    asked = rows.where(is_query(F.col("vec_id"))).distinct()
    reps = staging.put("reps", asked.groupBy("vec").agg(F.min("vec_id").alias("rep")))
    parts = max(1, -(-reps.count() // QUERY_BLOCK))
    queries = staging.put("queries", index.join(reps, "vec").select(
        "rep", "vec", "perm", F.pmod(F.xxhash64("rep"), F.lit(parts)).cast("int").alias("part")))
    left = index.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    right = queries.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    found = left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInPandas(
        searcher(k + 1, len(pivots)), "rep long, vec_id long, score double")

    def best(df: DataFrame, key: str, n: int) -> DataFrame:
        order = Window.partitionBy(key).orderBy(F.desc("score"), "vec_id")
        return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)

    # An id may have several entries; its best score counts.
    found = found.groupBy("rep", "vec_id").agg(F.max("score").alias("score"))
    found = staging.put("found", best(found, "rep", k + 1).drop("rank"))
    named = asked.join(reps, "vec").select(F.col("vec_id").alias("query_id"), "rep")
    answers = named.join(found, "rep").where("query_id <> vec_id").select("query_id", "vec_id", "score")
    answers = answers.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return best(answers, "query_id", k).select("query_id", "rank", "vec_id", "score")
