"""The pipeline's stages against the same stages done by hand."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from signalroot.llm import decontaminate, exact_dedup, jaccard_join, quality

SF = "/root/testdata/sf0.001"


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels, benchmark = spark.read.parquet(f"{SF}/labels.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    left = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id for r in left.collect()}
        after = stage(spark, left, SF)
        assert after.columns == docs.columns, name
        ids = {r.doc_id for r in after.collect()}
        if name == "quality":
            want = {r.doc_id for r in quality.quality_scores(left, labels).collect() if r.kept}
        elif name == "exact_dedup":
            want = {r.doc_id for r in exact_dedup.exact_dedup(left).collect() if r.kept}
        elif name == "jaccard_join":
            want = {r.component_id for r in jaccard_join.jaccard_join(left).collect()}
        else:
            want = {r.doc_id for r in decontaminate.leaks(left, benchmark).collect() if not r.contaminated}
        assert ids == want and ids <= before and ids, name
        left = spark.createDataFrame(after.collect(), docs.schema)
    packed = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in left.collect()}


def test_benchmark_stage_learns_from_every_row(spark, monkeypatch):
    """Of 24,000 rows of one word each all are counted, and all are in the sketch of the axes."""
    seen, made = [], decontaminate.latent_space
    monkeypatch.setattr(decontaminate, "latent_space", lambda *x: seen.append(x) or made(*x))
    docs = spark.range(24_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("word"), F.pmod("id", F.lit(5)).cast("string")).alias("text"))
    assert corpus_pipeline.benchmark(spark, docs, SF).count() == 24_000
    ((n, df, sketch),) = seen
    assert n == 24_000
    for k in range(5):
        term = decontaminate.bucket(decontaminate.terms_of(f"word{k}"))[0]
        assert df[term] == 4_800 and np.allclose(sketch[term], 4_800 * decontaminate.random_matrix()[term].astype(float))


def test_exact_stage_keeps_one_of_repeated_rows(spark):
    rows = [(1, "a b"), (2, "a b"), (2, "a b"), (3, "c"), (3, "c"), (None, "d"), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.text) for r in corpus_pipeline.exact(spark, docs, SF).collect()), key=str)
    assert got == sorted([(2, "a b"), (3, "c"), (None, "d"), (4, None)], key=str)


def test_stages_on_awkward_tables(spark):
    """Nulls, repeated rows, a long text, columns named like those the stages work with, and no rows."""
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    base = " ".join(f"word{k % 37} is {k}" for k in range(60))
    rows = [(1, base), (2, base), (2, base), (3, base + " more"), (4, None), (5, ""), (6, f"{base[:100]} {item} {base[:100]}"), (None, base), (None, None), (7, "long " * 50_000), (8, "ß é　x")]
    clash = "other_id string, dropped_id int, again_id int, id string, a int, component_id int, keep_id int, kept string, label_id int, cand int, fp int, sha string"
    docs = spark.createDataFrame([(i, t, *["x" if " string" in c else 1 for c in clash.split(",")]) for i, t in rows], f"doc_id long, text string, {clash}")
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, SF)
        if name == "packing":
            assert {r.doc_id for r in got.collect()} == {i for i, _ in rows}
        else:
            assert got.columns == docs.columns, name
            ids = [r.doc_id for r in got.collect()]
            want = {
                "exact_dedup": [2, 3, 5, 6, None, None, 7, 8],
                "jaccard_join": [1, 4, 5, 6, None, None, 7, 8],
                "decontaminate": [1, 2, 2, 3, 4, 5, None, None, 7, 8],
            }.get(name, ids)
            assert sorted(ids, key=str) == sorted(want, key=str), name
        empty = stage(spark, docs.limit(0), SF)
        assert empty.count() == 0 and empty.columns == got.columns
