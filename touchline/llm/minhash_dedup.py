"""Near-duplicate documents by MinHash, banding, verification and connected components.

Two documents are linked when their sets of distinct five-word shingles have a Jaccard
similarity of 0.75 or more.  The steps:

1. Each document gets its set size, a 128-bit digest of its set and 512 universal hash minima:
   one byte of each is the signature, the first 128 make 32 bands of four.  A pair at the
   threshold meets in no band with a probability of 5e-6.
2. Documents with equal sets collapse to the one with the smallest id; only these go on.
3. Every member of a band bucket is compared with the bucket's smallest member, by signature
   first, then on the full sets.  Large-star and small-star join what is confirmed.
4. Buckets that still hold several components are compared across components, in cells of
   bounded size, by signature and then on the full sets; a pair that shares several buckets is
   looked at in the first one only.  So no link between different sets is lost and no pair
   inside a component is formed.

Null, empty and blank texts have an empty set and are linked with nothing.  Rows without a
doc_id are left out.  Rows that repeat a doc_id count as one document, the one with the
largest set, of equally large ones the one with the greatest digest.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T
from .components import components
from .staging import Staging

BANDS, ROWS, SHINGLE = 32, 4, 5
HASHES = 512
#: Least share of equal signature bytes: the threshold less four standard deviations of the estimate.
SURE = 0.673
CELL = 256

_rng = np.random.default_rng(75)
FACTOR = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SHIFT = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64)
FEATURES = "doc_id long, n_shingles long, d1 long, d2 long, bands array<long>, signature binary"


def minima(shingles: np.ndarray) -> np.ndarray:
    """Least value of each universal hash a*x+b over a set."""
    low = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 256):
        np.minimum(low, (FACTOR[:, None] * shingles[None, i : i + 256] + SHIFT[:, None]).min(axis=1), out=low)
    return low


def sketch(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    salt = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)
    for frame in frames:
        raw, ids = T.encode(frame["text"]), frame["doc_id"].to_numpy()
        for a, b in T.batches(raw, T.CACHED):
            rows = []
            for doc, s in zip(ids[a:b], T.Words(raw[a:b]).shingles(SHINGLE), strict=True):
                if not len(s):
                    rows.append((doc, 0, 0, 0, None, None))
                    continue
                low = minima(s)
                bands = T.mix((low[: BANDS * ROWS].reshape(BANDS, ROWS) * T.WORD_FACTORS[:ROWS]).sum(axis=1) + salt)
                rows.append((doc, len(s), *digest(s), bands.view(np.int64),
                             (T.mix(low) & np.uint64(255)).astype(np.uint8).tobytes()))
            yield pd.DataFrame(rows, columns=["doc_id", "n_shingles", "d1", "d2", "bands", "signature"])


def digest(s: np.ndarray) -> np.ndarray:
    """128 bits of a set."""
    return np.array([s.sum(dtype=np.uint64), T.mix(s + np.uint64(1)).sum(dtype=np.uint64)]).view(np.int64)


def shingle_sets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The sets of the texts whose digest is asked for; a doc_id may come with other texts."""
    for frame in frames:
        raw, ids = T.encode(frame["text"]), frame["doc_id"].to_numpy()
        asked = frame[["d1", "d2"]].to_numpy()
        for a, b in T.batches(raw, T.CACHED):
            sets = [(i, s.view(np.int64)) for i, s, d in zip(ids[a:b], T.Words(raw[a:b]).shingles(SHINGLE), asked[a:b], strict=True)
                    if (digest(s) == d).all()]
            yield pd.DataFrame(sets, columns=["doc_id", "shingles"])


def alike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal bytes of two blocks of signatures."""
    return (a == b).mean(axis=-1)


def promising(a: pd.Series, b: pd.Series) -> pd.Series:
    x, y = (np.frombuffer(b"".join(s), np.uint8).reshape(-1, HASHES) for s in (a, b))
    return pd.Series(alike(x, y) >= SURE)


def cell_pairs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Promising pairs between components, of cells that lie in consecutive rows."""
    key = ["bucket", "i", "j"]

    def pairs(cell: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        sig = np.frombuffer(b"".join(cell["signature"]), np.uint8).reshape(-1, HASHES)
        bands = np.stack(cell["bands"].to_list())
        doc, comp, n, block = (cell[c].to_numpy() for c in ("doc_id", "comp", "n_shingles", "block"))
        bucket, i, j = cell[key].iloc[0]
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for x in np.flatnonzero(block == i):
            may = (comp != comp[x]) & (4 * np.minimum(n, n[x]) >= 3 * np.maximum(n, n[x]))
            y = np.flatnonzero(may & (doc > doc[x] if i == j else block == j))
            y = y[bands[y, (bands[y] == bands[x]).argmax(axis=1)] == bucket]
            y = y[alike(sig[y], sig[x]) >= SURE]
            found.append((np.minimum(doc[x], doc[y]), np.maximum(doc[x], doc[y])))
        return tuple(np.concatenate(p) for p in zip(*found, strict=True)) if found else (np.zeros(0, int),) * 2

    held: list[pd.DataFrame] = []
    last = None
    for frame in frames:
        if not len(frame):
            continue
        change = (frame[key] != frame[key].shift()).any(axis=1).to_numpy()
        change[0] = last is not None and tuple(frame[key].iloc[0]) != last
        bounds = [0, *np.flatnonzero(change), len(frame)]
        out = []
        for a, b in zip(bounds, bounds[1:], strict=False):
            if a and held or a == 0 and change[0] and held:
                out.append(pairs(pd.concat(held)))
                held = []
            if b > a:
                held.append(frame.iloc[a:b])
        last = tuple(frame[key].iloc[-1])
        if out:
            yield pd.DataFrame({"a": np.concatenate([o[0] for o in out]), "b": np.concatenate([o[1] for o in out])})
    if held:
        x, y = pairs(pd.concat(held))
        yield pd.DataFrame({"a": x, "b": y})


def confirm(docs: DataFrame, chosen: DataFrame, pairs: DataFrame, staging: Staging, name: str) -> DataFrame:
    """Those pairs (a, b) of documents whose full sets reach the threshold.

    ``chosen`` has the digest of the set that stands for a doc_id.
    """
    sides = [pairs.select(F.col(c).alias("doc_id")).distinct() for c in ("a", "b")]
    needed = chosen.select("doc_id", "d1", "d2").join(sides[0].union(sides[1]).distinct(), "doc_id", "left_semi")
    sets = staging.put(f"{name}sets", docs.join(needed.hint("merge"), "doc_id").mapInPandas(
        shingle_sets, "doc_id long, shingles array<long>").dropDuplicates(["doc_id"]))
    left = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x")), "a")
    both = left.join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y")), "b")
    common = F.size(F.array_intersect("x", "y"))
    union = F.size("x") + F.size("y") - common
    linked = both.where(100 * common >= 75 * union).select(F.col("a").alias("u"), F.col("b").alias("v"))
    linked = staging.put(f"{name}linked", linked)
    staging.drop(f"{name}sets")
    return linked


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` of every document."""
    staging = Staging(docs.sparkSession, "minhash")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")
    all_docs = staging.put("sketches", docs.mapInPandas(sketch, FEATURES))
    size = all_docs.groupBy("doc_id").agg(F.max(F.struct("n_shingles", "d1", "d2")).alias("s")).select("doc_id", "s.*")
    digest_columns = ["n_shingles", "d1", "d2"]
    # Minima are written before they are joined: the join can then split a hot key.
    least = staging.put("least", size.where("n_shingles > 0").groupBy(*digest_columns).agg(F.min("doc_id").alias("rep")))
    members = staging.put("members", size.join(least, digest_columns, "left").select(
        "doc_id", *digest_columns, F.coalesce("rep", "doc_id").alias("rep")))
    reps = members.where("rep = doc_id and n_shingles > 0").select("doc_id", *digest_columns)
    reps = staging.put("reps", all_docs.join(reps, ["doc_id", *digest_columns], "left_semi").dropDuplicates(["doc_id"])
                       .select("doc_id", *digest_columns, "bands", "signature"))
    staging.drop("sketches")
    posted = reps.select("doc_id", F.explode("bands").alias("bucket"))
    leaders = staging.put("leaders", posted.groupBy("bucket").agg(
        F.min("doc_id").alias("a"), F.count("*").alias("m")).where("m > 1"))
    met = posted.join(leaders, "bucket").where("doc_id <> a").select("a", F.col("doc_id").alias("b")).distinct()

    def side(c: str) -> DataFrame:
        return reps.select(F.col("doc_id").alias(c), F.col("n_shingles").alias(f"n_{c}"),
                           F.col("signature").alias(f"s_{c}"))

    met = staging.put("met", met.join(side("b"), "b").join(side("a"), "a")
                      .where("4 * least(n_a, n_b) >= 3 * greatest(n_a, n_b)")
                      .where(F.pandas_udf(promising, "boolean")("s_a", "s_b")).select("a", "b"))
    links = confirm(docs, reps, met, staging, "first")
    roots = components(links, staging, "first")

    # Buckets of three and more that still hold several components.
    placed = reps.join(roots.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
        "doc_id", "n_shingles", "signature", "bands", F.coalesce("root", "doc_id").alias("comp"))
    open_ = (placed.select("comp", F.explode("bands").alias("bucket")).groupBy("bucket")
             .agg(F.count("*").alias("m"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
             .where("m > 2 and lo < hi").select("bucket", F.ceil(F.col("m") / CELL).cast("int").alias("blocks")))
    cells = (placed.select("doc_id", "comp", F.explode("bands").alias("bucket")).join(open_, "bucket")
             .withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
             .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("bucket", "doc_id", "comp", "block", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j")))
    cells = cells.join(placed.select("doc_id", "n_shingles", "signature", "bands"), "doc_id")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    across = (cells.repartition(n, "bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
              .mapInPandas(cell_pairs, "a long, b long").distinct())
    across = staging.put("across", across)
    more = confirm(docs, reps, across, staging, "second")
    if not more.isEmpty():
        stars = roots.where("node <> root").select(F.col("node").alias("u"), F.col("root").alias("v"))
        roots = components(stars.union(more), staging, "second")
    out = members.join(roots.withColumnRenamed("node", "rep"), "rep", "left").select(
        "doc_id", "n_shingles", F.coalesce("root", "rep").alias("component_id"))
    return out.withColumn("kept", F.col("doc_id") == F.col("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents without those that a smaller near-duplicate stands for; rows without id stay."""
    gone = near_duplicates(docs).where("not kept").select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)
