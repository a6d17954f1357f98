"""The corpus pipeline on tables with every kind of edge row."""

import os
import random

import pytest

pytest.importorskip("touchline.llm")

import corpus_pipeline  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(n))


def tables(spark, folder, docs, benchmark, labels):
    spark.createDataFrame(docs, DOCS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(benchmark, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def test_edge_rows(spark, tmp_path):
    rng = random.Random(1)
    leak, base = words(rng, 30), words(rng, 80)
    rows = [(1, base), (2, base), (3, base + " end"), (4, words(rng, 40) + " " + leak + " " + words(rng, 10)), (5, None), (6, ""), (7, " \n "),
            (8, words(rng, 50) + " mail a.b@c.de or DE89 3704 0044 0532 0130 00"), (None, words(rng, 20)), (None, None), (9, words(rng, 60)), (9, words(rng, 70)),
            (10, words(rng, 9000))]
    at = tables(spark, tmp_path, [(i, t, "en", "s", len(t or "")) for i, t in rows], [(1, leak), (2, None)], [(100, 1, 0), (None, 0, 0), (1, None, 0)])
    docs = spark.read.parquet(f"{at}/documents.parquet")
    kept, seen = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        path = f"{tmp_path}/out_{name}"
        stage(spark, kept, at).write.parquet(path)
        kept = spark.read.parquet(path)
        seen[name] = kept
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert seen[name].columns == docs.columns
    # without usable labels nothing is rejected; copies go, with their leader kept; leaks go
    assert seen["quality_classifier"].count() == len(rows)
    left = sorted((r.doc_id for r in seen["benchmark_decontamination"].collect()), key=str)
    assert left == sorted([1, 5, 6, 7, 8, 9, 9, 10, None, None], key=str)
    text = {r.doc_id: r.text for r in seen["personal_data"].collect()}
    assert text[8].endswith("mail <EMAIL> or <IBAN>") and text[5] is None
    packed = seen["packing"].collect()
    assert {r.doc_id for r in packed} == {1, 5, 6, 7, 8, 9, 10, None}
    assert sum(r.length for r in packed) == sum({(r.doc_id, r.doc_tokens, r.ids_crc32 if r.start == 0 else None): r.doc_tokens for r in packed if r.start == 0}.values())


def test_empty_tables(spark, tmp_path):
    at = tables(spark, tmp_path, [], [], [])
    out = corpus_pipeline.run(spark, at)
    assert out.count() == 0 and "sequence_id" in out.columns
    assert os.path.isdir(f"{at}/documents.parquet")
