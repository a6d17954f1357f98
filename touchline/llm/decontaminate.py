"""Benchmark items inside documents, by size-partitioned MinHash containment search.

Only DataFrame functions are used.  Words are runs without ASCII white space, A-Z lower-cased;
a set holds the distinct five-word shingles of a text, or the whole text as one if it is
shorter.  An item is found in a document that holds 75 % or more of the item's shingles.

* Items are partitioned by size into powers of two.  The sketch of an item holds its least
  shingle hashes, one more than the largest item of its partition may miss.  So a document that
  reaches the threshold holds at least one of them, and nothing is lost.
* Documents with fewer shingles than a partition asks for are not searched for its items.
* Candidates are verified on the shingles themselves, not their hashes.

The sketches are broadcast only while they have at most ``BROADCAST_ROWS`` rows; beyond it they
are joined by hash, where Spark splits skewed keys.

Null or blank texts hold nothing and are held nowhere.  Documents without doc_id are not
searched.  Rows that repeat a doc_id are one document (an item counts where one of the texts
holds it); rows that repeat an item_id are items of their own, of which the best result counts.
Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .staging import Staging

SHINGLE = 5
BROADCAST_ROWS = 200_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, UPPER, LOWER), r"[\x20\x09-\x0D]+"), "")


def shingles(items: Column, join) -> Column:
    """``join`` of every five neighbours of an array, or of the whole of a shorter one."""
    n = F.size(items)
    runs = F.transform(F.sequence(F.lit(0), n - SHINGLE),
                       lambda i: join([F.get(items, i + j) for j in range(SHINGLE)]))
    short = F.array(F.coalesce(*[F.when(n == k, join([F.get(items, F.lit(j)) for j in range(k)])) for k in range(1, SHINGLE)]))
    none = F.filter(short, lambda x: F.lit(False))
    return F.when(n >= SHINGLE, runs).when(n > 0, short).otherwise(none)


def hashes(df: DataFrame, text: str, *keep: str) -> DataFrame:
    """Hashes of all shingles of a text, repeats included.

    Filters on the result would be pushed down with the array inlined into every step of its own
    lambda, so explode it with ``explode_outer``, which adds none.
    """
    coded = df.select(*keep, F.transform(words(F.col(text)), lambda w: F.xxhash64(w)).alias("codes"))
    return coded.select(*keep, shingles(F.col("codes"), lambda c: F.xxhash64(*c)).alias("codes"))


def strings(words_column: str) -> Column:
    """Distinct shingles of an array of words; it must be a column, as every step reads it."""
    return F.array_distinct(shingles(F.col(words_column), lambda c: F.concat_ws(" ", *c)))


def find(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id``, ``item_id``, ``n_item``, ``n_found`` and ``containment`` of every item found."""
    spark = docs.sparkSession
    staging = Staging(spark, "containment")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null and text is not null")
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("item_text")).where(
        "item_text is not null").distinct()
    items = items.select("item_id", "item_text", F.xxhash64("item_id", "item_text").alias("item"))
    sketch = hashes(items, "item_text", "item").select("item", F.array_sort(F.array_distinct("codes")).alias("codes"))
    part = F.floor(F.log2(F.size("codes"))).cast("int")
    sketch = sketch.withColumn("least", F.pow(F.lit(2), part).cast("int"))
    missing = F.floor((2 * F.col("least") - 1) / 4).cast("int")
    sketch = staging.put("sketch", sketch.select(
        "item", F.ceil(F.col("least") * 0.75).alias("needs"),
        F.explode_outer(F.slice("codes", F.lit(1), F.greatest(missing, F.lit(0)) + 1)).alias("code")))
    if sketch.count() <= BROADCAST_ROWS:
        sketch = F.broadcast(sketch)
    coded = hashes(docs, "text", "doc_id").select("doc_id", F.coalesce(F.size("codes"), F.lit(0)).alias("n"), F.explode_outer("codes").alias("code"))
    met = staging.put("met", coded.join(sketch, "code").where("n >= needs").select("doc_id", "item").distinct())
    pairs = docs.join(met, "doc_id").join(items, "item").select(
        "doc_id", "item_id", words(F.col("item_text")).alias("item_words"), words(F.col("text")).alias("words"))
    sized = pairs.select("doc_id", "item_id", strings("item_words").alias("wanted"), strings("words").alias("held")).select(
        "doc_id", "item_id", F.size("wanted").cast("long").alias("n_item"),
        F.size(F.array_intersect("wanted", "held")).cast("long").alias("n_found"))
    found = staging.put("sized", sized).where("100 * n_found >= 75 * n_item").withColumn("containment", F.col("n_found") / F.col("n_item"))
    best = F.max(F.struct("containment", "n_item", "n_found")).alias("b")
    return found.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", "b.n_item", "b.n_found", F.round("b.containment", 6).alias("containment"))


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark item; rows without id stay."""
    gone = find(docs, benchmark).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)
