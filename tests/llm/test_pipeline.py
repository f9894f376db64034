from __future__ import annotations

import ast
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quillmatch.llm import queries

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    sf_dir, folder = "/root/testdata/sf0.01", tmp_path_factory.mktemp("stages")
    out = [spark.read.parquet(f"{sf_dir}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, out[-1], sf_dir).write.parquet(f"{folder}/{name}")
        out.append(spark.read.parquet(f"{folder}/{name}"))
    return out


def test_stages_filter_and_keep_columns(stages):
    docs, language, quality, near, _ = stages
    for before, after in ((docs, language), (language, quality), (quality, near)):
        assert after.columns == before.columns and 0 < after.count() <= before.count()
        assert after.join(before, "doc_id", "left_anti").count() == 0
    assert near.count() < quality.count() < docs.count()


def test_quality_stage_follows_labels(spark, stages):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    kept = {r["doc_id"] for r in stages[2].select("doc_id").collect()}
    seen = {r["doc_id"] for r in stages[1].select("doc_id").collect()}
    good = [i in kept for i in seen if labels.get(i) == 1]
    bad = [i in kept for i in seen if labels.get(i) == 0]
    assert np.mean(good) > 0.95 and np.mean(bad) < 0.1


def test_near_copies_stage_against_all_pairs(stages):
    """One document of each class of the true Jaccard similarity stays, by comparing all pairs."""
    rows = sorted((r["doc_id"], r["text"] or "") for r in stages[2].select("doc_id", "text").collect())
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if (w := x.encode().lower().split()) else set() for _, x in rows]
    first = list(range(len(rows)))
    for i, x in enumerate(sets):
        for j in range(i):
            y = sets[j]
            if first[i] != first[j] and 5 * min(len(x), len(y)) >= 4 * max(len(x), len(y)) and 5 * len(x & y) >= 4 * len(x | y):
                low, high = sorted((first[i], first[j]))
                first = [low if k == high else k for k in first]
    kept = {r["doc_id"] for r in stages[3].select("doc_id").collect()}
    want = {rows[i][0] for i in set(first)}
    assert want <= kept and len(kept) <= 1.005 * len(want)


def test_packing_stage_keeps_all_documents(stages):
    pieces = stages[4]
    assert pieces.select("doc_id").distinct().count() == stages[3].count()
    uneven = pieces.groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).filter("`sum(length)` <> `max(doc_tokens)`")
    assert uneven.count() == 0


def test_run_equals_its_stages(spark, stages):
    found = corpus_pipeline.run(spark, "/root/testdata/sf0.01")
    assert found.columns == stages[-1].columns and found.count() == stages[-1].count()


def test_registered():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert "pipeline" in names and set(queries.QUERIES) <= names
    assert sorted({int(n[2:].split("_")[0]) for n in queries.QUERIES}) == list(range(1, 11))


def test_nothing_else_imports_the_subpackage():
    for folder, _, names in os.walk(f"{ROOT}/quillmatch"):
        if "/llm" in folder:
            continue
        for name in names:
            if name.endswith(".py"):
                tree = ast.parse(open(f"{folder}/{name}").read())
                modules = [n.module or "" for n in ast.walk(tree) if isinstance(n, ast.ImportFrom)] + [a.name for n in ast.walk(tree) if isinstance(n, ast.Import) for a in n.names]
                assert not any("llm" in m for m in modules)


def test_stages_on_odd_tables(spark, tmp_path):
    """Nulls in every column, repeats, a very long text, clashing names, and no rows at all."""
    rows = [
        (1, "the quick brown fox jumps over the lazy dog again", "en", "a", 9), (1, "the quick brown fox jumps over the lazy dog again", "en", "a", 9), (None, "le renard brun saute encore", "fr", None, None),
        (2, None, None, None, None), (3, "", "en", "a", 0), (4, "12 34 !!", None, "b", 8), (5, "word " * 30_000, "en", "c", 150_000), (None, None, None, None, None),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumns({c: F.lit("taken") for c in ("Score", "words", "fp", "label", "ids", "start", "component_id", "lang_pred")})
    spark.createDataFrame([(1, 1, 0), (None, 0, 1), (5, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for table in (docs, docs.limit(0)):
        out = table
        for name, stage in corpus_pipeline.STAGES:
            columns = out.columns
            out = stage(spark, out, str(tmp_path))
            if name != "packing":
                assert out.columns == columns
            out = spark.createDataFrame(out.collect(), out.schema)
        if table is docs:
            assert {r["doc_id"] for r in out.collect()} >= {1, 5}
        else:
            assert out.count() == 0
