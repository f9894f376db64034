from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from quillmatch.config import RetrievalConfig, SamplingConfig, TrainConfig
from quillmatch.functions import features, ids, scores, text
from quillmatch.operators import evaluation, output, retrieval, training

RECORD = "entity_id string, business_name string, business_address string, country string, row_ord long"


def _normalized(spark, rows):
    return text.normalize(spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], RECORD))


@pytest.fixture(scope="module")
def fixture(spark):
    s1 = [
        ("S1-MULTI", "Maple Street Bakery", "12 Maple Street", "US"), ("S1-SINGLE", "Quiet Harbor Books", "", "US"),
        ("S1-FRANCE", "Café Étoile Bleue", "3 rue Neuve", "France"), ("S1-UNICODE", "東京 商店", "千代田 1", "Japan"),
    ]
    corpus = [
        ("S2-HARD", "Maple Bakery", "99 Oak Road", "US"), ("S2-MATCH", "Maple Street Bakery Inc", "12 Maple Street", "US"), ("S2-UNI", "東京 商店", "千代田 1", "Japan"),
        ("S3-MATCH", "Maple Street Bakers", "12 Maple St", "US"), ("S3-FR", "CAFÉ étoile", "3 rue neuve", "France"),
    ]
    return _normalized(spark, s1), _normalized(spark, corpus)


def test_retrieval_fixture(fixture):
    q, c = fixture
    index = retrieval.build(c)
    pairs = retrieval.candidates(q, index)
    got = {r["s1"]: r["ids"] for r in retrieval.groups(q, pairs).collect()}
    assert set(got) == {"S1-MULTI", "S1-SINGLE", "S1-FRANCE", "S1-UNICODE"}
    assert got["S1-SINGLE"] == [] and got["S1-UNICODE"] == ["S2-UNI"] and got["S1-FRANCE"] == ["S3-FR"]
    assert got["S1-MULTI"][0] == "S2-MATCH" and set(got["S1-MULTI"]) == {"S2-HARD", "S2-MATCH", "S3-MATCH"}
    routes = {r["cand"]: r["routes"] for r in pairs.filter("s1 = 'S1-UNICODE'").collect()}
    assert routes == {"S2-UNI": ["exact_name", "name_token"]}
    capped = retrieval.candidates(q, index, RetrievalConfig(max_candidates=1)).filter("s1 = 'S1-MULTI'").collect()
    assert [r["cand"] for r in capped] == ["S2-MATCH"]
    exact = retrieval.candidates(q, index, RetrievalConfig(name_token=False)).collect()
    assert [r["cand"] for r in exact] == ["S2-UNI"]
    none = retrieval.candidates(q, index, RetrievalConfig(exact_name=False, name_token=False))
    assert none.count() == 0 and retrieval.groups(q, none).count() == 4


def test_oversized_blocks(spark):
    q = _normalized(spark, [("S1-1", "alpha beta beta", "x1 x2 x3", "US")])
    c = _normalized(spark, [(f"S2-{i}", "alpha beta" if i < 2 else "alpha", "x1 x2" if i < 2 else "x1", "US") for i in range(5)] + [("S2-9", "alpha beta beta", "", "US"), ("S3-9", "alpha beta beta", "", "US")])
    index = retrieval.build(c)
    config = RetrievalConfig(max_block=4, address=True)
    hits = {(r["route"], r["cand"]): r["score"] for r in retrieval.hits(q, index, config).collect()}
    # alpha has seven postings and leaves the name route with its share of the denominator; beta counts twice of two
    assert hits["name_token", "S2-0"] == 1.0 and ("name_token", "S2-3") not in hits
    # x1 has five postings: it stays below the line, so nobody reaches two shared tokens
    assert not [k for k in hits if k[0] == "address"]
    one = retrieval.exact_name(q, index, RetrievalConfig(max_block=1)).collect()
    assert [r["cand"] for r in one] == ["S2-9"]


def test_normalization(spark):
    cases = {
        "Straße": "strasse", "Ａｂｃ １２": "abc 12", "A&B": "a and b", "＆": "and", "étude": "étude", "తెలుగు కేఫ్": "తెలుగు కేఫ్",
        "  x--y__z ": "x y z", "": "", None: "", "İ": "i̇", "½": "1 2", "a\nb\tc": "a b c",
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string").select("t", text.text_key(F.col("t")).alias("k"), text.country_key(F.col("t")).alias("c"))
    rows = df.collect()
    for r in rows:
        assert r["k"] == cases[r["t"]], r
    assert {r["t"]: r["c"] for r in rows}["  x--y__z "] == "x--y__z"
    toks = spark.createDataFrame([("a b a",), ("",)], "k string").select(text.tokens(F.col("k")).alias("t")).collect()
    assert [r["t"] for r in toks] == [["a", "b", "a"], []]


def test_split_goldens():
    assert ids.residue_of("S1-FIXTURE") == 5 and ids.residue_of("S1-24") == 0
    for bad in ("S2-24", "S3-24", "S1-", "junk"):
        with pytest.raises(ValueError):
            ids.residue_of(bad)


def test_split_column(spark):
    rows = spark.createDataFrame([("S1-FIXTURE",), ("S1-24",)], "i string").select(ids.split_residue(F.col("i")).alias("r"), ids.is_validation(F.col("i")).alias("v")).collect()
    assert [tuple(r) for r in rows] == [(5, False), (0, True)]
    with pytest.raises(Exception, match="invalid entity id"):
        spark.createDataFrame([("S2-24",)], "i string").select(ids.is_validation(F.col("i"))).collect()


def test_detect_split():
    cases = {
        "a/fixtures/train/x.tsv": "fixture", "a/test/train/x.tsv": "train", "a/training/x.tsv": "train", "d/test_source2.tsv": "test", "d/train_source2.tsv": "train",
        "d/my_fixture.tsv": "fixture", "d/tests/x.tsv": "unspecified", "x.tsv": "unspecified", "data/x_test.tsv": "test",
    }
    assert {k: ids.detect_split(k) for k in cases} == cases


def test_guards(spark):
    schema = "c string, r array<string>, s map<string,double>"
    rows = [
        ("S2-1", ["a", "b"], {"a": 1.0}), ("S1-1", ["a"], {}), ("S2-1", ["b", "a"], {}), ("S2-1", ["a"], {"b": 1.0}), ("S2-1", ["a"], {"a": float("nan")}), ("S2-1", [], {}),
        ("S2-1", ["a"], {"a": float("inf")}), ("S2-", ["a"], {}),
    ]
    got = spark.createDataFrame(rows, schema).select(ids.valid_candidate(F.col("c"), F.col("r"), F.col("s")).alias("v")).collect()
    assert [r["v"] for r in got] == [True] + [False] * 7
    lists = spark.createDataFrame([(["S2-1", "S3-1"],), (["S2-1", "S2-1"],), (["S1-1"],), ([],)], "i array<string>").select(ids.valid_ids(F.col("i")).alias("v")).collect()
    assert [r["v"] for r in lists] == [True, False, False, True]
    for bad in (lambda: SamplingConfig(0), lambda: SamplingConfig(3, 2), lambda: TrainConfig(rounds=0), lambda: RetrievalConfig(df_ratio=0)):
        with pytest.raises(ValueError):
            bad()
    assert RetrievalConfig.from_dict({"max_candidates": 4, "unknown": 1}).max_candidates == 4


def test_measures(spark):
    rows = spark.createDataFrame([(0, 0, 0), (1, 0, 0), (0, 1, 0), (2, 1, 1), (1, 2, 1), (2, 2, 0)], "t int, p int, c int")
    got = rows.select(*[f(F.col("t"), F.col("p"), F.col("c")) for f in (scores.f_half, scores.precision, scores.recall)]).collect()
    assert [round(r[0], 4) for r in got] == [1, 0, 0, 0.8333, 0.5556, 0]
    assert [tuple(r[1:]) for r in got][:4] == [(1, 1), (0, 0), (0, 0), (1, 0.5)]


def _lists(spark, rows):
    return spark.createDataFrame(rows, "s1 string, ids array<string>")


def test_evaluation_fixture(spark):
    truth = _lists(spark, [("S1-1", ["S2-1", "S3-1"]), ("S1-2", ["S2-2", "S3-2"]), ("S1-3", []), ("S1-4", ["S2-4"]), ("S1-5", ["S3-5"])])
    pred = _lists(spark, [("S1-1", ["S2-1", "S3-1"]), ("S1-2", ["S2-2", "S2-2"]), ("S1-3", []), ("S1-4", []), ("S1-5", ["S3-5"])])
    cand = _lists(spark, [("S1-1", ["S2-1", "S3-1"]), ("S1-2", ["S2-2", "S3-2", "S2-9"]), ("S1-3", ["S2-9"]), ("S1-4", []), ("S1-5", ["S3-5"])])
    m = evaluation.macro(evaluation.counts(truth, pred)).first()
    assert m["macro_f_half"] == pytest.approx((1 + 0.8333333 + 1 + 0 + 1) / 5) and m["singleton_accuracy"] == 1.0 and m["false_negatives"] == 2
    c = evaluation.candidate_measures(truth, cand).first()
    assert (c["true_edges"], c["edges_recalled"], c["complete_recall"]) == (6, 5, 0.75)
    e = {r["category"]: r["errors"] for r in evaluation.error_counts(evaluation.errors(truth, pred, cand)).collect()}
    assert e == {"retrieval_miss": 1, "scoring_false_negative": 1, "multi_match_partial": 1}
    assert evaluation.oracle_check(m["macro_f_half"], c["oracle_macro_f_half"])[0]
    assert evaluation.oracle_check(float("nan"), 0.1)[0] and not evaluation.oracle_check(0.2, 0.1)[0]
    none = evaluation.candidate_measures(_lists(spark, [("S1-1", [])]), _lists(spark, [("S1-1", [])])).first()
    assert math.isnan(none["edge_recall"]) and none["oracle_macro_f_half"] == 1.0
    for other, word in ((pred.filter("s1 <> 'S1-1'"), "missing"), (pred.unionByName(_lists(spark, [("S1-9", [])])), "unexpected"), (pred.unionByName(pred), "repeated")):
        with pytest.raises(ValueError, match=word):
            evaluation.require_same_queries(truth, other, "predictions")
    ghost = evaluation.errors(truth, _lists(spark, [("S1-3", ["S2-7"])]), cand).filter("s1 = 'S1-3'").collect()
    assert [r["category"] for r in ghost] == ["empty_case_false_positive"]
    d = evaluation.distribution(_lists(spark, [(f"S1-{i}", [f"S2-{j}" for j in range(i)]) for i in range(1, 21)])).first()
    assert (d["p50"], d["p95"], d["p99"], d["median"]) == (10, 19, 20, 10.5)


def test_benchmark_statistics(spark):
    from quillmatch.operators import benchmark

    lists = _lists(spark, [("S1-1", ["S2-1", "S3-1"]), ("S1-2", []), ("S1-3", ["S2-3"]), ("S1-4", [])])
    got = benchmark.statistics(_lists(spark, [("S1-1", ["S2-1"]), ("S1-2", ["S2-2"])]), lists, 5).first()
    assert (got["pairs"], got["mean_n"], got["median_n"], got["reduction_ratio"], got["edge_recall"], got["complete_coverage"]) == (3, 0.75, 0.5, 1 - 3 / 20, 0.5, 0.5)
    assert benchmark.statistics(_lists(spark, []), lists, 0).first()["edge_recall"] == 1.0


def test_findings(spark):
    q = spark.createDataFrame([("S1-1",), ("S1-2",), ("S1-3",)], "s1 string")
    corpus = spark.createDataFrame([("S2-1",), ("S3-1",)], "entity_id string")
    good = _lists(spark, [("S1-1", ["S2-1", "S3-1"]), ("S1-2", []), ("S1-3", ["S2-1"])])
    assert output.table_findings(q, good, good, corpus).count() == 0
    bad = _lists(spark, [("S1-1", ["S2-1", "S2-1", "X"]), ("S1-2", ["S2-9"]), ("S1-2", []), ("S1-8", [])])
    kinds = {r["problem_type"] for r in output.table_findings(q, bad, good, corpus, spark.createDataFrame([("S1-3", " France ")], "s1 string, country string")).collect()}
    assert kinds == {
        "DUPLICATE_IDS", "INVALID_ID_PREFIX", "UNKNOWN_S2S3_IDS", "DUPLICATE_S1_ROW", "MISSING_S1_ROWS", "EXTRA_S1_ROWS", "PREDICTION_NOT_SUBSET_OF_CANDIDATES", "FRANCE_COVERAGE",
    }


def test_features_edge_cases(spark):
    pairs = spark.createDataFrame([("a", "abc"), ("abc", "abd"), ("", "x"), ("", ""), ("😀a", "😀b"), ("same", "same")], "a string, b string")
    got = pairs.select(features.exact(F.col("a"), F.col("b")), features.length_ratio(F.col("a"), F.col("b")), features.prefix_ratio(F.col("a"), F.col("b"))).collect()
    assert [tuple(round(v, 4) for v in r) for r in got] == [(0, 0.3333, 1), (0, 1, 0.6667), (0, 0, 0), (0, 0, 0), (0, 1, 0.5), (1, 1, 1)]
    ratio = {(r["a"], r["b"]): r["r"] for r in pairs.withColumn("r", features.char_ratio(F.col("a"), F.col("b"))).collect()}
    assert ratio["same", "same"] == 1.0 and ratio["", ""] == 0.0 and ratio["abc", "abd"] == pytest.approx(2 / 3)
    nums = spark.createDataFrame([(["unit42", "7"], ["４２"])], "n array<string>, a array<string>").select(features.numbers(F.col("n"), F.col("a")).alias("x")).first()
    assert nums["x"] == ["42", "7", "４２"]


def _groups(spark):
    names = [f"S1-{i}" for i in range(200) if ids.residue_of(f"S1-{i}")][:16]
    rows, links = [], []
    for n in names:
        rows += [(n, f"S2-{n}-{k}", k + 1, 2 if k == 1 else 1) for k in range(4)]
        links.append((n, f"S2-{n}-1"))
    pairs = spark.createDataFrame(rows, "s1 string, cand string, rank long, n_routes long")
    return names, pairs, spark.createDataFrame(links, "s1 string, cand string")


def test_training_pairs(spark):
    names, pairs, links = _groups(spark)
    held = next(f"S1-{i}" for i in range(1000) if not ids.residue_of(f"S1-{i}"))
    pairs = pairs.unionByName(spark.createDataFrame([(held, "S2-h", 1, 1)], pairs.schema))
    links = links.unionByName(spark.createDataFrame([(names[0], "S3-unseen"), (held, "S2-h")], links.schema))
    chosen = training.training_pairs(pairs, links, SamplingConfig(2, 3))
    again = training.training_pairs(pairs.orderBy(F.desc("cand")).repartition(3), links, SamplingConfig(2, 3))
    key = lambda df: sorted((r["s1"], r["cand"], r["label"]) for r in df.collect())
    assert key(chosen) == key(again) and all(k[0] != held and k[1] != "S3-unseen" for k in key(chosen))
    queries = spark.createDataFrame([(n,) for n in [*names, held]], "entity_id string")
    counts = training.pair_counts(queries, pairs, links, chosen).first()
    assert tuple(counts) == (16, 16, 1, 32, 1)


def test_model_round_trip(spark, tmp_path):
    names, pairs, links = _groups(spark)
    rng = {n: i for i, n in enumerate(features.NAMES)}
    rows = training.training_pairs(pairs, links, SamplingConfig(2, 3)).withColumns({n: (F.col("label") * 0.5 + F.lit(i % 3) * 0.1 + F.col("rank") * 0.01).cast("double") for n, i in rng.items()})
    training.train(rows, str(tmp_path), TrainConfig(rounds=3), candidate_config={"cap": 4})
    loaded = training.load(spark, f"{tmp_path}/model.json")
    first = {(r["s1"], r["cand"]): r["score"] for r in training.score(rows, loaded, candidate_config={"cap": 4}).collect()}
    second = {(r["s1"], r["cand"]): r["score"] for r in training.score(rows.orderBy(F.desc("cand")), training.load(spark, f"{tmp_path}/model.json")).collect()}
    assert first == second and all(0 <= v <= 1 for v in first.values())
    for bad in (lambda: training.score(rows, loaded, index_version="0"), lambda: training.score(rows, loaded, candidate_config={"cap": 5}), lambda: training.train(rows.filter("label = 1"), str(tmp_path / "x"))):
        with pytest.raises(ValueError):
            bad()
    with pytest.raises(ValueError, match="other part"):
        training.check_partition(rows, True)
    extra = next((tmp_path / "model").rglob("part-*"))
    extra.write_bytes(extra.read_bytes() + b"x")
    with pytest.raises(ValueError, match="changed"):
        training.load(spark, f"{tmp_path}/model.json")
