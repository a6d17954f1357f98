"""Queries over the given tables, and their DuckDB statements where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    chain_dedup, decontaminate, exact_topk, language, minhash_dedup, packing, permutation_index, pii, prefix_trie, quality, quotations,
    substring_exact, whitening,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation_index.nearest(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 20 == 0)


def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op3_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotations.link(table(spark, sf_dir, "conversations"))


def remainder(n: int):
    """crc32(doc_id as text) mod n; a row without doc_id is not held out."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(n)), F.lit(n))


def op4_language_bitmasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    filters = language.train(docs.where(remainder(5) != 0))
    out = language.predict(docs.drop("lang"), filters)
    return out.select("doc_id", (remainder(5) == 0).alias("held_out"), "lang_pred", "score")


def op5_suffix_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_exact.remove_repeats(table(spark, sf_dir, "documents"))


def op6_line_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    field = quality.train(docs, labels.where(remainder(3) != 1))
    return quality.score(docs, field).select("doc_id", (remainder(3) == 1).alias("held_out"), "score", "predicted")


def op7_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op8_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(table(spark, sf_dir, "documents"))


def op10_collinear_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chain_dedup.fuzzy_passages(table(spark, sf_dir, "documents")).drop("passage")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.build(table(spark, sf_dir, "conversations"))


def op12_uniform_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk.exact_top(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 100 == 0)


def op13_spectrum_slicing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_permutation_index": op1_permutation_index,
    "op2_minhash_dedup": op2_minhash_dedup,
    "op3_quotation_linking": op3_quotation_linking,
    "op4_language_bitmasks": op4_language_bitmasks,
    "op5_suffix_buckets": op5_suffix_buckets,
    "op6_line_field": op6_line_field,
    "op7_harmonic_packing": op7_harmonic_packing,
    "op8_containment": op8_containment,
    "op9_personal_data": op9_personal_data,
    "op10_collinear_chains": op10_collinear_chains,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_uniform_threshold": op12_uniform_threshold,
    "op13_spectrum_slicing": op13_spectrum_slicing,
}
_WORDS = """list_filter(regexp_split_to_array(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"""


def _shingles(source: str, key: str) -> str:
    """Distinct five-word shingles (the whole of a shorter text) of a table's rows, with the size of each set."""
    return f"""
    select *, count(*) over (partition by {key}) as n from (
        select distinct {key}, unnest(case
            when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))
            when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as s
        from (select {key}, {_WORDS.format("text")} as w from {source} where text is not null))"""


ORACLE_SQL: dict[str, str] = {
    "op2_minhash_dedup": f"""
with recursive sets as ({_shingles("documents", "doc_id")}),
links as (
    select a.doc_id as u, b.doc_id as v from sets a join sets b on a.s = b.s and a.doc_id <> b.doc_id
    group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 75 * (a.n + b.n - count(*))),
reach as (select doc_id as node, doc_id as seen from documents union select r.node, l.v from reach r join links l on r.seen = l.u),
roots as (select node as doc_id, min(seen) as component_id from reach group by node),
sizes as (select doc_id, count(*) as n_shingles from sets group by doc_id)
select r.doc_id, coalesce(z.n_shingles, 0) as n_shingles, r.component_id, r.doc_id = r.component_id as kept
from roots r left join sizes z using (doc_id)""",
    "op8_containment": f"""
with docs as ({_shingles("documents", "doc_id")}), items as ({_shingles("benchmark", "item_id")})
select d.doc_id, i.item_id, i.n as n_item, count(*) as n_found, round(count(*) / i.n, 6) as containment
from items i join docs d using (s) group by d.doc_id, i.item_id, i.n having 100 * count(*) >= 75 * i.n""",
}
