"""Retrieval in blocks against loops, over several blocks, parts and pieces."""

from __future__ import annotations

import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from quillmatch.config import RetrievalConfig
from quillmatch.functions import text
from quillmatch.operators import blocks, retrieval
from quillmatch.plans import catalogue

CONFIG = RetrievalConfig(address=True, max_candidates=4, max_block=25, df_ratio=0.9)
RECORD = "entity_id string, business_name string, business_address string, country string, row_ord long"


def _loops(queries, corpus, config):
    """{(s1, cand): {route: score}} by the definitions of the routes."""
    posted = {c: Counter(t for r in corpus for t in set(r[c].split())) for c in (1, 2)}
    most = min(config.max_block, max(10, int(len(corpus) * config.df_ratio)))
    exact = {}
    for r in sorted(corpus):
        for key in {(r[1], r[3]), (r[1],)} if r[1] else ():
            exact.setdefault(key, []).append(r[0])
    out = {}
    for q in queries:
        names = [t for t in q[1].split() if len(t) >= 2 and 0 < posted[1][t] <= most]
        line = {t for t in q[2].split() if len(t) >= 2}
        first = exact.get((q[1], q[3]) if q[3] else (q[1],), [])[: config.max_block] if q[1] else []
        for c in corpus:
            found = {}
            if c[0] in first:
                found["exact_name"] = 1.0
            if shared := sum(t in c[1].split() for t in names):
                found["name_token"] = shared / len(names)
            if (shared := sum(t in c[2].split() and posted[2][t] <= config.max_block for t in line)) >= 2:
                found["address"] = shared / len(line)
            if found:
                out[q[0], c[0]] = found
    return out


@pytest.fixture(scope="module")
def tables(spark):
    r = random.Random(7)
    words = [f"w{i}" for i in range(14)]
    some = lambda k: " ".join(r.choice(words[: r.choice((3, 14))]) for _ in range(r.randrange(k)))
    rows = lambda s, n: [(f"S{s}-{i}", some(4), some(7), r.choice(("", "us", "fr"))) for i in range(n)]
    queries, corpus = rows(1, 60), rows(2, 45) + rows(3, 45)
    frames = [text.normalize(spark.createDataFrame([(*x, i) for i, x in enumerate(t)], RECORD)) for t in (queries, corpus)]
    return queries, corpus, *frames


@pytest.fixture
def small(monkeypatch):
    for name, value in (("PART_BITS", 4), ("BLOCK", 9), ("NAMES", 5)):
        monkeypatch.setattr(blocks, name, value)


def _ranked(pairs, cap):
    out = {}
    for (s1, cand), scores in pairs.items():
        total = round(sum(scores.get(x, 0.0) for x in ("address", "exact_name", "name_token")), 12)
        out.setdefault(s1, []).append((-len(scores), -total, cand))
    return {(s1, c): (i + 1, -n, -t) for s1, rows in out.items() for i, (n, t, c) in enumerate(sorted(rows)[:cap])}


def test_candidates_by_blocks_and_parts(tables, small):
    queries, corpus, q, c = tables
    index, pairs = retrieval.build(c), _loops(queries, corpus, CONFIG)
    got = {(r["s1"], r["cand"]): (r["rank"], r["n_routes"], r["total"]) for r in retrieval.candidates(q, index, CONFIG).collect()}
    want = _ranked(pairs, CONFIG.max_candidates)
    assert len(want) > 100 and got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k]) for k in want)
    before = Counter(s1 for s1, _ in pairs)
    stats = retrieval.statistics(q, index, CONFIG).first()
    assert (stats["pairs"], stats["over_cap"], stats["empty_s1"]) == (sum(min(n, 4) for n in before.values()), sum(n > 4 for n in before.values()), len(queries) - len(before))


def test_routes_by_blocks_and_parts(tables, small):
    queries, corpus, q, c = tables
    index, pairs = retrieval.build(c), _loops(queries, corpus, CONFIG)
    for route in ("name_token", "address"):
        got = {(r["s1"], r["cand"]): r["score"] for r in retrieval.ROUTES[route](q, index, CONFIG).collect()}
        assert got and got == pytest.approx({k: s[route] for k, s in pairs.items() if route in s})
    both = {k: (s["name_token"] + s["address"]) / 2 for k, s in pairs.items() if {"name_token", "address"} <= s.keys()}
    assert {(r["s1"], r["cand"]): r["score"] for r in retrieval.combined(q, index, CONFIG).collect()} == pytest.approx(both)


def test_pieces_of_a_cell_give_the_same(monkeypatch):
    r = random.Random(3)
    schema = pa.schema([("cell", pa.int64()), ("side", pa.int32()), ("s1", pa.string()), ("route", pa.int32()), ("key", pa.string()), ("n", pa.int32()), ("usable", pa.int32()), ("ids", pa.list_(pa.int32())), ("names", pa.list_(pa.string()))])
    rows = [(0, 0, None, None, None, 0, None, None, [f"c{i:02}" for i in range(50)])]
    rows += [(0, 1, None, None, f"{k}k{i}", None, None, r.sample(range(50), 20), None) for k in (0, 1, 2) for i in range(6)]
    rows += [(0, 2, f"q{j}", k, f"{k}k{i}", 1, 4, None, None) for j in range(30) for k in (0, 1, 2) for i in r.sample(range(7), 1 if k == 0 else 4)]
    table = pa.table([pa.array(v, t.type) for v, t in zip(zip(*rows), schema)], schema=schema)
    whole = [x for b in blocks._cell(table, blocks.ROUTES, 5, False) for x in b.to_pylist()]
    monkeypatch.setattr(blocks, "HITS", 90)
    pieces = list(blocks._cell(table, blocks.ROUTES, 5, False))
    assert len(pieces) > 10 and [x for b in pieces for x in b.to_pylist()] == whole and len(whole) == 150
    every = [x for b in blocks._cell(table, blocks.ROUTES, None, False) for x in b.to_pylist()]
    order = lambda x: (-sum(x[f"__{n}"] is not None for n in blocks.ROUTES), -round(sum(x[f"__{n}"] or 0 for n in ("address", "exact_name", "name_token")), 12), x["cand"])
    for s1 in {x["s1"] for x in whole}:
        best = sorted((x for x in every if x["s1"] == s1), key=order)[:5]
        assert sorted(x["cand"] for x in best) == [x["cand"] for x in whole if x["s1"] == s1]


@pytest.mark.parametrize("name", ["candidate_groups", "retrieval_stats", "route_address", "route_combined"])
def test_pairs_found_are_not_shuffled(name, spark, sf_dir):
    plan = catalogue.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"hashpartitioning\((s1#\d+, cand#\d+|cand#\d+, s1#\d+)", plan)


HOT = [*[(f"one hot head of a text that is long {i} and its own last words {i % 3}", i) for i in range(60)], *[(f"own head {i} of many words with the hot last eight words of them all", i) for i in range(60, 120)], ("", 120), ("", 121), ("a lone text", 122)]


@pytest.fixture(scope="module")
def hot_dir(spark, tmp_path_factory):
    """Documents with heads and tails that many share."""
    where = str(tmp_path_factory.mktemp("hot"))
    rows = [(i, t, ("en", None)[i % 2]) for t, i in HOT]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{where}/documents.parquet")
    return where


def test_links_by_number_are_those_listed(spark, hot_dir):
    from quillmatch.sources import documents

    ends = documents.ends(spark, hot_dir)
    links = {(r["s1"], r["cand"]) for r in documents.link_pairs(ends).collect()}
    assert len(links) > 800
    want = {f"S1-{i}": tuple(sum(s1 == f"S1-{i}" and c.startswith(k) for s1, c in links) for k in ("S", "S2", "S3")) for i in range(123) if i % 3 == 0}
    assert {r["s1"]: (r["t"], r["t2"], r["t3"]) for r in documents.degrees(ends).collect()} == want
    ids = spark.createDataFrame([(a, f"S{i % 3 + 1}-{i}") for a in want for i in range(123) if i % 3], "s1 string, cand string")
    assert {(r["s1"], r["cand"]) for r in documents.marked(ids, ends).filter("hit").collect()} == links


LINKED = ["training_pairs_hash", "candidate_eval", "benchmark_stats", "cap_sweep", "error_counts", "eval_macro", "eval_by_country", "eval_per_entity", "oracle_check", "pair_counts", "error_examples"]


@pytest.mark.parametrize("name", LINKED)
def test_links_are_not_listed(name, spark, hot_dir, monkeypatch):
    """The queries on links of hot heads and tails give the rows of their SQL, and list the links of a few queries at most."""
    import duckdb

    from quillmatch.sources import documents

    listed, whole = [], documents.link_pairs
    monkeypatch.setattr(documents, "link_pairs", lambda rows: listed.append(rows.filter("entity_id like 'S1-%'").count()) or whole(rows))
    ours = catalogue.QUERIES[name](spark, hot_dir).toPandas()
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{hot_dir}/documents.parquet/*.parquet'")
    theirs = connection.execute(catalogue.ORACLE_SQL[name]).df()
    columns = sorted(ours.columns)
    ours, theirs = (x[columns].sort_values(columns).reset_index(drop=True) for x in (ours, theirs))
    assert len(ours) and ours.equals(theirs), (ours, theirs)
    assert not listed or name == "error_examples" and max(listed) < 41
