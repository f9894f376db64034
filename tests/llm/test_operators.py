"""Each operator against brute force, and on tables with nulls, empty and long texts, ties, repeats and clashing names."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quillmatch.llm import bpe, ctw, embeddings, encoding, flac, langid, licenses, packing, quality, queries, simhash, tokencounts
from quillmatch.llm.common import Scratch, tokenizer_path
from quillmatch.llm.components import components

ODD = [
    (1, "the quick brown fox jumps over the lazy dog", "en"), (1, "the quick brown fox jumps over the lazy dog", "en"), (None, "le renard brun saute", "fr"), (2, None, None), (3, "", "en"),
    (4, " \n\t ", None), (5, "word " * 30_000, "en"), (6, "x" * 40_000, "en"), (7, "日本語 <|endoftext|> ½ ４２ é\x1c\x00!", None), (8, "Released under the MIT License.\nText.", "en"),
]


@pytest.fixture(scope="module")
def odd(spark):
    """Also has columns whose names clash with those that operators add, in other cases too."""
    df = spark.createDataFrame(ODD, "doc_id long, text string, lang string")
    return df.withColumns({c: F.lit("taken") for c in ("Score", "lang_pred", "predicted", "fp", "component_id", "n_tokens", "media", "ids", "licenses", "matches", "leaves", "edits", "start", "tail")}).repartition(3)


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}


def _rows(df):
    return df.collect()


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(5, 5), (7, None), (None, 7)] + [(1000, 1000 + i) for i in range(1, 3000)] + [(i, i + 1) for i in range(5000, 5060)]
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            a, b = find(a), find(b)
            up[max(a, b)] = min(a, b)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "t")).collect()}
    want = {x: find(x) for x in up}
    assert got == {k: v for k, v in want.items() if k in got} and all(want[k] == k for k in want if k not in got)
    assert components(spark.createDataFrame([], "a long, b long"), Scratch(spark, "t")).count() == 0


# 1 quality


def test_quality_held_out(spark):
    found = queries.op1_quality(spark, "/root/testdata/sf0.01").collect()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    assert len(found) == 1000 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in found)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in found)
    held = [(r["score"], labels[r["doc_id"]]) for r in found if r["held_out"] and r["doc_id"] in labels]
    good, bad = [s for s, y in held if y], [s for s, y in held if not y]
    assert np.mean([g > b for g in good for b in bad]) > 0.95


def test_quality_odd_tables(spark, odd):
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (5, 0, None), (6, None, 1), (None, 0, 0), (3, 7, 0)], "doc_id long, quality int, toxic int")
    out = _rows(quality.score(odd, quality.train(odd, labels)))
    assert len(out) == len(ODD) and all(0 <= r["score"] <= 1 for r in out) and "Score" not in out[0].asDict()
    assert len({r["score"] for r in out if r["doc_id"] in (2, 3, 4)}) == 1
    none = quality.train(odd, labels.limit(0))
    assert {(r["score"], r["predicted"]) for r in _rows(quality.score(odd, none))} == {(0.5, 1)}
    assert quality.score(odd.limit(0), none).count() == 0


def test_quality_is_a_preference_model():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, len(quality.NAMES)))
    y = (x[:, 3] > 0).astype(int)
    m = quality.fit(x, y, pairs=4000)
    s = m.raw(x)
    assert np.mean((s >= m.cut) == y) > 0.95 and np.mean(s >= m.cut) == pytest.approx(y.mean(), abs=0.01)


def test_quality_fit_against_a_plain_loop():
    """The same binned features and pairs, fitted by plain gradient ascent on the sum over pairs of log P(a over b)."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(120, len(quality.NAMES)))
    y = (x[:, 0] + 0.5 * x[:, 5] + rng.normal(size=120) > 0).astype(int)
    m = quality.fit(x, y, pairs=400, bins=2, ridge=5.0, steps=30)
    edges = [sorted(np.quantile(x[:, j], [1 / 3, 2 / 3])) for j in range(x.shape[1])]
    b = [[float(row[j] > e) for j in range(len(row)) for e in edges[j]] for row in x]
    draw = np.random.default_rng(7)
    better, worse = [i for i in range(120) if y[i] == 1], [i for i in range(120) if y[i] == 0]
    pairs = list(zip(draw.choice(better, 400), draw.choice(worse, 400), strict=True))
    d = [[p - q for p, q in zip(b[i], b[j], strict=True)] for i, j in pairs]
    w = [0.0] * len(b[0])
    for _ in range(400):
        gradient = [-5.0 * v for v in w]
        for row in d:
            wrong = 1 / (1 + math.exp(sum(u * v for u, v in zip(row, w, strict=True))))
            gradient = [g + wrong * u for g, u in zip(gradient, row, strict=True)]
        w = [v + 0.01 * g for v, g in zip(w, gradient, strict=True)]
    assert m.weights == pytest.approx(w, abs=2e-3)
    raw = sorted(sum(u * v for u, v in zip(row, m.weights, strict=True)) for row in b)
    at = (1 - y.mean()) * 119
    assert m.cut == pytest.approx(raw[int(at)] + (at - int(at)) * (raw[min(int(at) + 1, 119)] - raw[int(at)]))


# 2 language


def test_language_held_out(spark):
    found = queries.op2_language(spark, "/root/testdata/sf0.01").collect()
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").collect()}
    held = [r["lang_pred"] == truth[r["doc_id"]] for r in found if r["held_out"]]
    assert len(found) == 1000 and np.mean(held) > 0.97


def test_forward_sums_all_segmentations():
    pieces = {"▁": 1, "▁a": 2, "a": 3, "b": 4, "ab": 5, "▁ab": 6}
    p = np.array([[0], [0.1], [0.2], [0.1], [0.2], [0.1], [0.3]])
    m = langid.LanguageModel(["x"], pieces, p, np.zeros(1))

    def brute(word):
        total = 0.0
        for cut in range(1 << (len(word) - 1)):
            parts, last = [], 0
            for i in range(1, len(word) + 1):
                if i == len(word) or cut >> (i - 1) & 1:
                    parts.append(word[last:i])
                    last = i
            total += math.prod(p[pieces[x]][0] if x in pieces else math.exp(langid.OTHER) if len(x) == 1 else 0 for x in parts)
        return total

    for w in ("ab", "abab", "ba", "azb", "z"):
        assert m.word_scores([w])[0, 0] == pytest.approx(math.log(brute("▁" + w)))


def _segmentations(word, pieces):
    """Every way to cut a word into pieces or single letters."""
    if not word:
        yield []
    for k in range(1, len(word) + 1):
        if k == 1 or word[:k] in pieces:
            for rest in _segmentations(word[k:], pieces):
                yield [word[:k], *rest]


def test_language_fit_and_scores_against_enumeration(spark):
    """Two rounds of expectation maximisation, then whole texts, all by listing each segmentation."""
    pieces = {x: i for i, x in enumerate(["▁", "▁a", "a", "b", "ab", "▁ab", "ba", "abab", "c"], 1)}
    counts = [("x", "abab", 3), ("x", "ba", 2), ("x", "caz", 1), ("y", "ba", 5), ("y", "cab", 2), ("x", "ab" * 20, 1)]
    got = langid.fit([c for c in counts if len(c[1]) < 9], {"x": 6, "y": 3}, pieces, rounds=2, smoothing=0.05)
    p = {lang: {piece: 1 / (len(pieces) + 1) for piece in pieces} for lang in "xy"}

    def cost(lang, cut):
        return math.prod(p[lang].get(piece, math.exp(langid.OTHER)) for piece in cut)

    for _ in range(2):
        expected = {lang: dict.fromkeys(pieces, 0.05) for lang in "xy"}
        for lang, word, n in counts[:-1]:
            cuts = list(_segmentations("▁" + word, pieces))
            total = sum(cost(lang, c) for c in cuts)
            for c in cuts:
                for piece in c:
                    if piece in pieces:
                        expected[lang][piece] += n * cost(lang, c) / total
        p = {lang: {k: v / sum(e.values()) for k, v in e.items()} for lang, e in expected.items()}
    for j, lang in enumerate("xy"):
        assert [got.p[i, j] for i in pieces.values()] == pytest.approx(list(p[lang].values()), rel=1e-9)
    texts = ["abab ba", "Caz! ba", "cab", "zz ab", "12 !", None]
    for r in _rows(langid.predict(spark.createDataFrame([(t,) for t in texts], "text string"), got)):
        words = langid.runs(r["text"] or "")
        whole = {lang: math.log((n + 1) / 11) + sum(math.log(sum(cost(lang, c) for c in _segmentations("▁" + w, pieces))) for w in words) for lang, n in (("x", 6), ("y", 3))}
        best = max(whole, key=whole.get)
        assert r["lang_pred"] == (best if words else "und")
        assert r["score"] == pytest.approx(1 / sum(math.exp(v - whole[best]) for v in whole.values()) if words else 0, rel=1e-9)


def test_language_long_words_are_not_cut():
    """Long runs give the same sums in logarithms as short ones do, pieces of all lengths take part, and the fit is the same."""
    pieces = langid.vocabulary()
    assert max(map(len, pieces)) > 12
    rng = np.random.default_rng(5)
    p = rng.random((len(pieces) + 1, 2)) ** 3
    p[0] = 0
    ids = langid.lattice(["▁internationalization"], pieces, 16)
    assert np.allclose(langid.log_forward(ids[0], langid._log_table(p)), np.log(langid.forward(ids, p)[:, 0]))
    assert np.allclose(langid.log_backward(ids[0], langid._log_table(p)), np.log(langid.backward(ids, p)[:, 0]))
    short, long = np.zeros_like(p), np.zeros_like(p)
    langid._expect(ids, np.array([[2.0, 1.0]]), p, short)
    langid._expect_long(ids[0], np.array([2.0, 1.0]), langid._log_table(p), long)
    assert np.allclose(short, long)
    m = langid.LanguageModel(["a", "b"], pieces, p / p.sum(0), np.zeros(2))
    one, many = m.word_scores(["straßenbahn" * 100])[0], m.word_scores(["straßenbahn" * 2000])[0]
    assert np.isfinite(many).all() and many[-1] == 22_000 and np.allclose(many[:2] / 20, one[:2], rtol=0.02)


def test_language_marks_what_was_not_learnt(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.train(docs)
    rng = random.Random(2)
    junk = [" ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randrange(4, 10))) for _ in range(n)) for n in (1, 2, 5, 50, 500)]
    junk += ["это русский текст о разных вещах", "zażółć gęślą jaźń oraz jeszcze kilka innych słów"]
    assert not any(r["usual"] for r in _rows(langid.predict(spark.createDataFrame([(t,) for t in junk], "text string"), model)))
    clean = _rows(langid.predict(docs.filter("text is not null"), model))
    assert np.mean([r["usual"] for r in clean if r["lang_pred"] != "und"]) == 1
    short = [" ".join((r["text"] or "").split()[:2]) for r in clean if r["source"] is not None][:300]
    found = _rows(langid.predict(spark.createDataFrame([(t,) for t in short], "text string"), model))
    assert np.mean([r["usual"] for r in found if r["lang_pred"] != "und"]) > 0.98


def test_language_odd_tables(spark, odd):
    model = langid.train(odd)
    out = _rows(langid.predict(odd, model))
    assert len(out) == len(ODD) and model.langs == ["en"]
    for r in out:
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in r["text"] or "")) and 0 <= r["score"] <= 1
    empty = langid.train(odd.limit(0))
    assert {r["lang_pred"] for r in _rows(langid.predict(odd, empty))} == {"und"}


# 3 context trees


def _ctw_brute(texts, text, depth):
    """Mixtures along the paths from the definition, without tables; every context is known."""
    counts = defaultdict(lambda: [0, 0])
    for t in texts:
        line = b"\n" * depth + ctw.line(t)[1]
        for i in range(depth, len(line)):
            for d in range(depth + 1):
                for k in range(8):
                    counts[line[i - d : i], line[i] >> (8 - k) | 1 << k][line[i] >> (7 - k) & 1] += 1
    kids = defaultdict(set)
    for c, node in counts:
        if c:
            kids[c[1:], node].add(c)
    logs = {}
    for c, node in sorted(counts, key=lambda x: -len(x[0])):
        a, b = counts[c, node]
        own = math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1)
        below = sum(logs[k, node][0] for k in kids[c, node])
        logs[c, node] = (own, 0.0) if len(c) == depth else (np.logaddexp(own, below) - math.log(2), own - below)
    line, out = b"\n" * depth + ctw.line(text)[1], 0.0
    for i in range(depth, len(line)):
        known = max((d for d in range(depth + 1) if (line[i - d : i], 1) in counts), default=-1)
        for k in range(8):
            node, bit, p = line[i] >> (8 - k) | 1 << k, line[i] >> (7 - k) & 1, 0.5
            for d in range(known, -1, -1):
                key = (line[i - d : i], node)
                a, b = counts[key] if key in counts else (0, 0)
                e = (b + 0.5) / (a + b + 1)
                if d == depth:
                    p = e
                else:
                    w = 1 / (1 + math.exp(-logs[key][1])) if key in logs else 0.5
                    p = w * e + (1 - w) * p
            out += math.log10(p if bit else 1 - p)
    return out


def _whole_tree(texts, depth):
    """The tree of some texts in one piece."""
    keys, counts = np.unique(ctw.windows([ctw.line(t)[1] for t in texts], depth), return_counts=True)
    return ctw.Tree(depth, ctw._subtree(keys, counts, 0, depth)[0])


def test_ctw_probabilities_sum_to_one():
    tree = _whole_tree([b"to be or not to be that is the question"] * 3, 3)
    known = [set((keys >> np.uint64(8)).tolist()) for keys, *_ in tree.nodes]
    for context in (b"\n\n\n", b" be", b"zzz", b"zth"):
        base = int.from_bytes(context, "big")
        deepest = max(d for d in range(4) if base & ((1 << 8 * d) - 1) in known[d])
        window = np.array([base << 8 | b for b in range(256)], np.uint64)
        assert np.exp(ctw.log_probability(tree, window, np.full(256, deepest))).sum() == pytest.approx(1, abs=1e-9)


def test_ctw_blocks_round_trip():
    rng = np.random.default_rng(3)
    keys = np.unique(rng.integers(0, 1 << 56, 5000).astype(np.uint64))
    counts = rng.integers(0, 1 << 40, (len(keys), 2))
    cuts = [0, 1, 700, len(keys)]
    for block, lo, hi in zip(ctw.pack_blocks(keys, counts, cuts), cuts, cuts[1:], strict=False):
        k, c = ctw.unpack_block(block)
        assert (k == keys[lo:hi]).all() and (c == counts[lo:hi]).all()


@pytest.mark.parametrize(("depth", "grams"), [(1, 10), (2, 20), (5, 40), (5, 10_000)])
def test_ctw_scores_keep_every_context(spark, depth, grams):
    """However few windows are broadcast, texts are scored by the tree of all contexts of the training texts."""
    learnt = ["Abc abd abc.", "bcd abc", "", "abc abc", None, "to be or not to be that is the question"]
    held = ["abc zzz", "qq", "ABC abx \xe9", "that is not the question", "abd abc bcd abc abc", ""]
    rows = spark.createDataFrame([(i, t, i >= len(learnt)) for i, t in enumerate(learnt + held)], "doc_id long, text string, out boolean").repartition(3)
    found = {r["doc_id"]: r["score"] for r in ctw.score(rows, F.col("out"), depth=depth, grams=grams).collect()}
    data = [(t or "").encode() for t in learnt + held]
    for i, t in enumerate(data):
        assert found[i] == pytest.approx(_ctw_brute(data[: len(learnt)], t, depth), rel=1e-6)


def test_ctw_estimates_of_small_counts_are_looked_up(monkeypatch):
    plain, asked = ctw._lgamma, []
    zeros, ones = np.array([0, 3, 4095, 4096, 2_000_000, 7.0]), np.array([0, 9, 1, 70_000, 5, 4093.0])
    want = plain(zeros + 0.5) + plain(ones + 0.5) - np.log(np.pi) - plain(zeros + ones + 1.0)
    monkeypatch.setattr(ctw, "_lgamma", lambda x: asked.append(len(x)) or plain(x))
    np.testing.assert_allclose(ctw.log_estimate(zeros, ones), want, rtol=0, atol=1e-9)
    assert sum(asked) == 2 + 1 + 4


@pytest.mark.parametrize("lines,depth", [(200, 6), (300, 6), (200, 7), (0, 6)])
def test_ctw_windows_by_line(lines, depth):
    rng = np.random.default_rng(lines + depth)
    which = np.repeat(np.arange(lines), 5)
    lacked = rng.integers(0, 3, len(which)).astype(np.uint64) << np.uint64(8 * depth)
    got, windows, starts = ctw._by_line(which, lacked, depth)
    want = sorted(zip(which.tolist(), lacked.tolist(), strict=True))
    assert list(zip(got.tolist(), windows.tolist(), strict=True)) == want
    assert starts.tolist() == [i for i, x in enumerate(want) if not i or x != want[i - 1]]


def test_ctw_default_depth_is_six(spark):
    learnt = ["to be or not to be that is the question", "not to be", "the question is that"]
    rows = spark.createDataFrame(list(enumerate(learnt)), "doc_id long, text string")
    data = [t.encode() for t in learnt]
    for r in ctw.score(rows, F.lit(False)).collect():
        assert r["score"] == pytest.approx(_ctw_brute(data, data[r["doc_id"]], 6), rel=1e-6)


@pytest.mark.parametrize("head", [5, 100_000])
def test_ctw_base_scores(spark, sf_dir, docs, head):
    found = ctw.score(spark.read.parquet(f"{sf_dir}/documents.parquet"), queries.remainder_is_one("doc_id", 5), head=head).collect()
    counts = Counter()
    for i, t in docs.items():
        if zlib.crc32(str(i).encode()) % 5 != 1:
            counts.update([*t.encode().lower().split(), None])
    n, v = sum(counts.values()), len(counts)
    assert len(found) == len(docs)
    for r in found:
        words = [*docs[r["doc_id"]].encode().lower().split(), None]
        assert (r["n_tokens"], r["train_tokens"], r["n_known"]) == (len(words), n, sum(counts[w] > 0 for w in words))
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words))
        assert r["score"] < 0 and math.isfinite(r["score"])


def test_ctw_odd_tables(spark, odd):
    out = _rows(ctw.score(odd, F.lit(False)))
    assert len(out) == len(ODD) and all(math.isfinite(r["score"]) for r in out)
    assert len({round(r["score"], 9) for r in out if r["doc_id"] in (2, 3, 4)}) == 1
    nothing = _rows(ctw.score(odd, F.lit(True)))
    assert all(r["base_score"] == pytest.approx(0) and r["code_length"] == pytest.approx(8) and r["n_known"] == 0 for r in nothing)
    assert ctw.score(odd.limit(0), F.lit(False)).count() == 0


# 4 licences


def test_licenses_sql(compare):
    compare(queries.op4_licenses, queries.ORACLE_SQL["op4_licenses"])


def test_license_rules():
    for text in licenses.SENTENCES.values():
        assert any(m in text for m in licenses.MARKS) and licenses._OTHER.sub(" ", text).strip() == text
    apache = "# Licensed under the Apache License, Version 2.0 (the \"License\");\n# you may not use this file except in\n# compliance with the License.\n# You may obtain a copy of the License at\n\n"
    assert {f[0] for f in licenses.scan("x = 1\n" + apache)} == {"Apache-2.0"}
    mit = licenses.SENTENCES
    order = ". ".join(mit[k].capitalize() for k in ("mit-grant", "mit-notice", "mit-as-is", "mit-liable")) + "."
    assert len(licenses.scan(order)) == 2
    assert licenses.scan(". ".join(mit[k].capitalize() for k in ("mit-notice", "mit-grant")) + ".") == []
    assert [f[0] for f in licenses.scan("Text.\nLicensed under CC BY-NC 4.0.\nMore.")] == ["CC-BY-NC-4.0"]
    assert licenses.scan("The license was granted to nobody.") == []


LGPL = """// This library is free software; you can redistribute it and/or
// modify it under the terms of the GNU Lesser General Public
// License as published by the Free Software Foundation; either
// version 2.1 of the License, or (at your option) any later version.
//
// This library is distributed in the hope that it will be useful,
// but WITHOUT ANY WARRANTY; without even the implied warranty of
// MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU
// Lesser General Public License for more details.
"""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE.
"""


def test_licenses_of_whole_wrapped_texts():
    whole = lambda text: {(name, len(licenses.RULES[rule][1])) for name, rule, _, _ in licenses.scan(text)}
    assert whole(LGPL) == {("LGPL-2.1-or-later", 3)} | ({("LGPL-2.1-or-later", 7)} if "received" in LGPL else set())
    received = "//\n// You should have received a copy of the GNU Lesser General Public\n// License along with this library.\n"
    assert ("LGPL-2.1-or-later", 7) in whole(LGPL + received)
    assert whole(ISC) == {("ISC", 1), ("ISC", 3)}
    # out of order the sentences are known, and no rule of several holds
    parts = ISC.split("\n\n")
    assert whole(parts[1] + "\n\n" + parts[0]) == {("ISC", 1)}
    # one rule for each licence that the sentences name, all of them reachable
    used = {i for _, rule in licenses.RULES for i in rule}
    assert used == set(licenses.SENTENCES) and len(set(licenses.SENTENCES.values())) == len(licenses.SENTENCES)
    for name, rule in licenses.RULES:
        assert name in {x[0] for x in licenses.scan(". ".join(licenses.SENTENCES[i] for i in rule) + ".")}


def test_licenses_odd_tables(odd):
    out = _rows(licenses.recognise(odd))
    assert {r["doc_id"]: r["licenses"] for r in out if r["licenses"]} == {8: ["MIT"]} and len(out) == len(ODD)
    assert licenses.recognise(odd.limit(0)).count() == 0


# 5 SimHash


def _fingerprint(text, n):
    w = text.encode().lower().split()
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + n]), 42) for i in range(max(1, len(w) - n + 1))] if w else []
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def _classes(fps, radius):
    """Smallest index reachable of each fingerprint."""
    up = list(range(len(fps)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_simhash_query(spark, sf_dir, docs):
    found = {r["doc_id"]: r for r in queries.op5_simhash(spark, sf_dir).collect()}
    order = sorted(docs)
    fps = [_fingerprint(docs[i], 4) for i in order]
    for i, fp, c in zip(order, fps, _classes(fps, 4), strict=True):
        assert found[i]["fingerprint"] == f"{fp:016x}" and found[i]["component_id"] == order[c]


@pytest.mark.parametrize("radius,cell_rows", [(4, 6), (4, 4096), (8, 5), (8, 4096), (0, 3)])
def test_simhash_join_is_exact(spark, radius, cell_rows):
    rng = np.random.default_rng(radius)
    values = set()
    for base in rng.integers(0, 1 << 63, 25):
        for _ in range(10):
            values.add(int(base) ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, radius + 3), replace=False)))
    fps = sorted(values)
    want = _classes(fps, radius)
    signed = [v - (1 << 64) if v >> 63 else v for v in fps]
    label = dict(simhash.link_components(spark.createDataFrame([(v,) for v in signed], "fp long"), Scratch(spark, "t"), radius, cell_rows).collect())
    groups = defaultdict(set)
    for s, w in zip(signed, want, strict=True):
        groups[label.get(s, s)].add(w)
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(want))


def _edited(rng, words, share):
    """Words of which so many of the five-word shingles are changed."""
    out = list(words)
    for i in range(0, round(len(words) * share / 5)):
        out[rng.randrange(len(out))] = f"new{i}"
    return " ".join(out)


@pytest.mark.parametrize("cell_rows", [7, 4096])
def test_near_copies_are_found_and_others_stay(spark, cell_rows):
    rng = random.Random(9)
    base = [[f"w{rng.randrange(4000)}" for _ in range(300)] for _ in range(60)]
    texts = [" ".join(b) for b in base]
    groups = list(range(60))
    for g in range(20):
        for _ in range(3):
            texts.append(_edited(rng, base[g], 0.08))
            groups.append(g)
    far = [_edited(rng, base[g], 0.9) for g in range(40, 50)]
    rows = [(i, t) for i, t in enumerate(texts + far)]
    kept = {r["doc_id"] for r in simhash.keep_first(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), cell_rows=cell_rows).collect()}
    assert kept == {*range(60), *range(120, 130)}


@pytest.mark.parametrize("cell_rows", [7, 4096])
def test_near_copies_equal_all_pairs_by_jaccard(spark, cell_rows):
    """Around 0.8, short texts and repeated shingles too."""
    rng = random.Random(3)
    texts = []
    for n in [8, 9, 10, 14, 20, 40, 100, 300] * 12:
        base = [f"w{rng.randrange(4000)}" for _ in range(n)]
        texts += [" ".join(base), " ".join(base[: rng.randrange(n * 7 // 10, n)]), " ".join(base[1:] + ["z"]), " ".join(base * 3), _edited(rng, base, rng.choice([0.08, 0.1, 0.12, 0.15]))]
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in map(str.split, texts)]
    first = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if first[i] != first[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                low, high = sorted((first[i], first[j]))
                first = [low if x == high else x for x in first]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert {r["doc_id"] for r in simhash.keep_first(df, cell_rows=cell_rows).collect()} == set(first)


def _bands_of_similarity(rng, count):
    """Pairs of sets of hashes of 4 to 400 shingles with a Jaccard similarity in each hundredth from 0.70 to 0.99."""
    for _ in range(count):
        both = int(rng.integers(4, 400))
        total = round(both / rng.uniform(0.7, 1))
        x = rng.integers(0, 1 << 63, total).astype(np.uint64)
        only = int(rng.integers(0, total - both + 1))
        yield both / total, np.sort(x[: both + only]), np.sort(np.concatenate([x[:both], x[both + only :]]))


@pytest.mark.parametrize("rows", [200, 200_000])
def test_candidates_of_near_copies_by_similarity(rows):
    """The share of pairs that meet in a grid and pass the sieve, in bands of their true Jaccard similarity."""
    rng = np.random.default_rng(12)
    segments, radius, found = simhash.wide_grids(0.8, rows), simhash.sieve_radius(0.8), defaultdict(list)
    for similarity, x, y in _bands_of_similarity(rng, 4000):
        hit = False
        for small in (True, False):
            if all(0 < len(z) <= simhash.SMALL if small else len(z) >= simhash.LARGE for z in (x, y)):
                prints = np.stack([simhash.wide_print(z, small) for z in (x, y)])
                digits = simhash.counts_of(prints)[:, segments]
                meet = (digits[0] == digits[1]).all(1).any()
                hit |= bool(meet and np.bitwise_count(prints[0, simhash.GRID_WORDS :] ^ prints[1, simhash.GRID_WORDS :]).sum() <= radius)
        found[int(similarity * 20 + 1e-9) / 20].append(hit)
    recall = {band: round(float(np.mean(v)), 3) for band, v in sorted(found.items())}
    print(rows, len(segments), segments.shape[1], recall)
    assert recall[0.8] >= 0.97 and all(recall[b] >= 0.99 for b in (0.85, 0.9, 0.95))


@pytest.mark.parametrize("side", [False, True])
def test_similar_sets_against_all_pairs(side):
    rng = np.random.default_rng(6)
    pool = [s for _, x, y in _bands_of_similarity(rng, 60) for s in (x, y)]
    base = rng.integers(0, 1 << 63, 60).astype(np.uint64)
    pool += [np.unique(rng.choice(base, 52)) for _ in range(80)] + [np.zeros(0, np.uint64)] * 2
    sides = rng.integers(0, 2, len(pool)).tolist() if side else None
    want = []
    for i, x in enumerate(pool):
        for j, y in enumerate(pool[:i]):
            both = len(np.intersect1d(x, y))
            if len(x) and 5 * both >= 4 * (len(x) + len(y) - both) and (not side or sides[i] != sides[j]):
                want.append((i, j))
    got = simhash.similar(pool, 0.8, sides)
    assert {tuple(sorted(e)) for e in got} <= {tuple(sorted(e)) for e in want}

    def classes(edges):
        label = list(range(len(pool)))
        for i, j in edges:
            a, b = sorted((label[i], label[j]))
            label = [a if v == b else v for v in label]
        return label

    assert classes(got) == classes(want)


def test_grids_follow_the_count():
    chosen = [simhash.chosen_blocks(4, n) for n in (100, 10**5, 10**7, 10**9, 10**12)]
    assert chosen == sorted(chosen) and chosen[0] == 1 and len(set(chosen)) > 3
    for n, c in zip((100, 10**5, 10**7, 10**9), chosen, strict=False):
        assert n * simhash.AGREE ** (32 * c / (4 + c)) <= simhash.NEIGHBOURS
    for n in (10**4, 10**6, 10**8):
        assert n * simhash.AGREE ** simhash.wide_grids(0.8, n).shape[1] <= simhash.CROWD


def test_embedding_bounds_the_distance():
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 1 << 63, 2000).astype(np.uint64), rng.integers(0, 1 << 63, 2000).astype(np.uint64)
    near = simhash._manhattan(simhash._pack(a), simhash._pack(b))
    want = [sum(abs((int(x) >> i & 3).bit_count() - (int(y) >> i & 3).bit_count()) for i in range(0, 64, 2)) for x, y in zip(a, b, strict=True)]
    assert near.tolist() == want and (near <= np.bitwise_count(a ^ b)).all()


def test_simhash_odd_tables(odd):
    out = _rows(simhash.near_duplicates(odd))
    assert len(out) == len(ODD)
    by = {r["doc_id"]: r for r in out if r["doc_id"] is not None}
    assert by[2]["fp"] == 0 and by[2]["component_id"] == by[3]["component_id"] == by[4]["component_id"] == 2
    assert [r["component_id"] for r in out if r["doc_id"] is None] == [None]
    kept = _rows(simhash.keep_first(odd))
    assert sorted(r["doc_id"] or 0 for r in kept) == [0, 1, 2, 5, 6, 7, 8] and "Score" in kept[0].asDict()
    assert simhash.near_duplicates(odd.limit(0)).count() == 0


# 6 packing


def _check_packing(pieces, encoded, window=1024):
    seen, sequences = defaultdict(list), defaultdict(list)
    for r in pieces:
        seen[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, ids in encoded.items():
        at = 0
        for r in sorted(seen[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[at : at + r["length"]], "<u4").tobytes())
            at += r["length"]
        assert at == len(ids)
    sizes = []
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= window
        sizes.append(at)
    return sizes


def test_packing_query(spark, sf_dir, docs):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    encoded = {i: [*own.encode(t, add_special_tokens=False).ids, 0] for i, t in docs.items()}
    sizes = _check_packing(queries.op6_packing(spark, sf_dir).collect(), encoded)
    assert all(n & (n - 1) == 0 for n in sizes)


def test_sum_of_squares_choice():
    packer = packing.SumOfSquares(16)
    for h, n in ((3, 2), (5, 4), (9, 1)):
        packer.counts[h] = n
        packer.open[h] = [[(0, 0, b"\0" * 4 * h, h)] for _ in range(n)]
    for size in range(1, 17):
        def cost(h, size=size):
            c = packer.counts.copy()
            c[h] -= h > 0
            c[h + size] += 1
            c[16] = 0
            return int((c**2).sum())

        levels = [h for h in (0, 3, 5, 9) if h + size <= 16]
        best = min(map(cost, levels))
        assert packer.level(size) == max(h for h in levels if cost(h) == best)


def test_packing_odd_tables(odd):
    out = _rows(packing.pack(odd, window=64))
    end = [r for r in out if r["doc_id"] in (2, 3)]
    assert [(r["doc_tokens"], r["ids"]) for r in end] == [(1, [0]), (1, [0])]
    assert all(r["length"] == len(r["ids"]) and zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in out)
    whole = _rows(packing.pack(odd.coalesce(1), window=64, split_open=False))
    sizes = Counter()
    for r in whole:
        sizes[r["sequence_id"]] += r["length"]
    short = sorted(n for n in sizes.values() if n < 64)
    assert len(short) < 2 or short[0] + short[1] > 64  # no two of the windows left open fit together
    assert packing.pack(odd.limit(0)).count() == 0


@pytest.mark.parametrize("parts", [1, 7, 40])
def test_packing_windows_are_the_level_arrays(spark, sf_dir, parts):
    """Every remainder lies whole in one window, but for the cuts at powers of two; nothing is padded."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(parts, "doc_id")
    kept = _rows(packing.pack(docs, split_open=False, with_ids=False))
    remainder = [r for r in kept if r["doc_tokens"] - r["start"] < 1024]
    assert all(r["start"] % 1024 == 0 and r["start"] + r["length"] == r["doc_tokens"] for r in remainder)
    chosen = {(r["doc_id"], r["start"]): r["sequence_id"] >> 36 for r in remainder}
    cut, sizes, task = _rows(packing.pack(docs, with_ids=False)), Counter(), {}
    for r in cut:
        sizes[r["sequence_id"]] += r["length"]
        task.setdefault((r["doc_id"], r["start"] // 1024 * 1024), set()).add(r["sequence_id"] >> 36)
    assert all(n & (n - 1) == 0 for n in sizes.values())
    assert all(task[k] == {t} for k, t in chosen.items())
    tokens = sum(r["length"] for r in cut)
    short = sum(n for n in sizes.values() if n < 64)
    print(f"{parts} tasks: {tokens} tokens, {short / tokens:.4f} of them in sequences under 64, {len(sizes)} sequences")
    assert short < 0.05 * tokens


# 7 token counts


def test_token_counts_query(spark, sf_dir, docs):
    own = encoding.encoder(tokenizer_path("byte_bpe_50k.json"))
    for r in queries.op7_token_counts(spark, sf_dir).collect():
        text = docs[r["doc_id"]]
        after = tokencounts.PERSONAL.sub("[removed]", text)
        assert (r["n_tokens"], r["tokens_after"], r["chars_after"]) == (own.count(text), own.count(after), len(after))
        assert r["text_sha256"] == hashlib.sha256(after.encode()).hexdigest()


@pytest.mark.parametrize("size", [1, 7, 400])
def test_edits_against_whole_texts(size):
    own, rng = encoding.encoder(tokenizer_path("byte_bpe_50k.json")), random.Random(size)
    letters = "ab c\n\n  de'fs1 2.,!é日"
    make = lambda n: "".join(rng.choice(letters) for _ in range(rng.randrange(n)))
    for _ in range(60):
        text = make(300)
        tree = tokencounts.TokenTree(own.count, text, size)
        for _ in range(6):
            a = rng.randrange(len(text) + 4)
            b, new = a + rng.randrange(12), make(15)
            tree.edit(a, b, new)
            text = text[:a] + new + text[b:]
            assert (tree.text, tree.tokens, tree.chars) == (text, own.count(text), len(text))
        assert tokencounts.TokenTree(own.count, text, size, tree.leaves()).tokens == tree.tokens


def test_edits_encode_little():
    own = encoding.encoder(tokenizer_path("byte_bpe_50k.json"))
    tree = tokencounts.TokenTree(own.count, "some words here " * 50_000)
    before = tree.encoded
    tree.edit(400_000, 400_004, "other")
    assert tree.encoded - before < 4 * tokencounts.SEGMENT


def test_edits_without_safe_places():
    """A text that no place cuts is one segment: counts stay right, and an edit costs the segment that it touches."""
    own, rng = encoding.encoder(tokenizer_path("byte_bpe_50k.json")), random.Random(5)
    text = "".join(rng.choices("abcdefgh", k=20_000))
    tree = tokencounts.TokenTree(own.count, text)
    assert len(list(tree.leaves())) == 1 and tree.tokens == own.count(text)
    for _ in range(5):
        at, new = rng.randrange(len(text)), rng.choice(["", "xyz", " a b "])
        text, before = text[:at] + new + text[at + 4 :], tree.encoded
        tree.edit(at, at + 4, new)
        assert tree.text == text and tree.tokens == own.count(text) and tree.encoded - before <= len(text)


def test_token_counts_odd_tables(spark, odd):
    edits = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.lit(3).cast("long").alias("end"), F.lit("Zz").alias("text")), F.struct(F.lit(None).cast("long").alias("start"), F.lit(3).cast("long").alias("end"), F.lit(None).cast("string").alias("text")))
    out = _rows(tokencounts.recount(tokencounts.count(odd).withColumn("edits", F.when(F.col("doc_id") == 8, edits)), keep=["doc_id", "text"]))
    own = encoding.encoder(tokenizer_path("byte_bpe_50k.json"))
    assert len(out) == len(ODD)
    for r in out:
        text = r["text"] or ""
        after = "Zz" + text[3:] if r["doc_id"] == 8 else text
        assert (r["edited_text"], r["tokens_after"], r["n_edits"]) == (after, own.count(after), int(r["doc_id"] == 8))
    assert tokencounts.count(odd.limit(0)).count() == 0


# 8 BPE


def test_fast_encoder_equals_library_on_all_code_points():
    own = encoding.ByteEncoder(tokenizer_path("byte_bpe_50k.json"))
    for low in range(0, 0x110000, 64):
        points = [chr(c) for c in range(low, low + 64) if not 0xD800 <= c < 0xE000]
        text = "".join(f"a{c}b 1{c} {c}  !{c}\n{c}" for c in points)
        assert own.encode(text) == own.exact(text)


def _library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))


def test_bpe_equals_library(spark, docs):
    own, lib, rng = bpe.SpeculativeBPE(tokenizer_path("word_bpe_49k.json")), _library(), random.Random(3)
    letters = " \n\t\r'sdtrevml1²½éßÀ_-.!<|>\x0b\x1c\x85\xa0 　日本ก็🙂́abcZΣςİ"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(3000)]
    texts += [*docs.values(), "<|endoftext|>x<|startoftext|> y<|ENDOFTEXT|>", "a</w>b", "x" * 5000, "ΣΑΣ ΟΔΟΣ", ""]
    for text, got, want in zip(texts, own.rendered(texts), lib.encode_batch(texts, add_special_tokens=False), strict=True):
        assert got == (len(want.ids), " ".join(map(str, want.ids)), lib.decode(want.ids, skip_special_tokens=False)), text
        assert own.encode(text) == want.ids
    assert 0 < own.exact_merges < own.proposed


def test_bpe_caches_keep_results(docs):
    small = bpe.SpeculativeBPE(tokenizer_path("word_bpe_49k.json"))
    small.strings.size = small.cache.size = 50
    whole = bpe.SpeculativeBPE(tokenizer_path("word_bpe_49k.json"))
    texts = list(docs.values())
    assert [small.rendered([t])[0] for t in texts] == whole.rendered(texts)


def test_bpe_long_words_equal_library():
    """Exact merging of words whose proposals fail takes n log n steps: a million random letters take seconds."""
    own, lib, rng = bpe.SpeculativeBPE(tokenizer_path("word_bpe_49k.json")), _library(), random.Random(8)
    for n in (2, 63, 4096, 1_000_000):
        word = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=n))
        assert own.encode(word) == lib.encode(word, add_special_tokens=False).ids
    for _ in range(2000):
        word = "".join(rng.choices("abé", k=rng.randrange(1, 40)))
        assert own.merge(own.symbols(word)) == [t for w in own.words(word) for t in lib.encode(w, add_special_tokens=False).ids]


def test_bpe_query_and_odd_tables(spark, sf_dir, docs, odd):
    lib = _library()
    for r in queries.op8_bpe(spark, sf_dir).collect():
        ids = lib.encode(docs[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    for r in _rows(bpe.encode(odd)):
        assert r["ids"] == lib.encode(r["text"] or "", add_special_tokens=False).ids
    assert bpe.digests(odd.limit(0)).count() == 0


# 9 FLAC


def _signals():
    rng = np.random.default_rng(0)
    ramp = np.zeros(12_800, np.uint8)
    ramp[::511] = 255
    return [
        flac.payload(b""), flac.payload(b"a"), rng.integers(0, 256, 5000, dtype=np.uint8).tobytes(), bytes([7]) * 4096, (np.sin(np.arange(19_200) / 20) * 100 + 128).astype(np.uint8).tobytes(),
        (np.cumsum(rng.integers(-2, 3, 12_800)) % 256).astype(np.uint8).tobytes(), ramp.tobytes(), bytes(200 * 1024), ("é" * 999).encode(),
    ]


def test_flac_round_trip():
    data = _signals()
    streams = flac.encode_streams(data)
    assert [b"".join(p for _, p in x) for x in flac.decode_blocks(streams)] == data
    assert [flac.encode_streams([d])[0] for d in data] == streams
    for d, s in zip(data, streams, strict=True):
        assert flac.read_range(s, 1000, 1500) == d[1000:2500] and flac.read_range(s, 0, 1 << 30) == d and flac.read_range(s, len(d), 5) == b""
        o = flac.open_stream(s)
        bare = s[:4] + b"\x80" + s[5:42] + s[o.first :]
        assert b"".join(p for _, p in flac.decode_blocks([bare])[0]) == d


def test_flac_finds_damage():
    stream = bytearray(flac.encode_streams([_signals()[4]])[0])
    first = flac.open_stream(bytes(stream)).first
    for at in (0, first, first + 2, first + 40, len(stream) - 1, 30):
        bad = bytearray(stream)
        bad[at] ^= 5
        with pytest.raises(ValueError):
            flac.decode_blocks([bytes(bad)])
    with pytest.raises(ValueError):
        flac.decode_blocks([bytes(stream[:-9])])


def test_flac_escaped_partition_and_known_frame():
    """A frame put together by hand: fixed predictor of order 1, one escaped partition of 5-bit residuals."""
    samples = [10, 12, 9, 9, 20, 18, 18, 3, 4, 5, 6, 7, 8, 9, 10, 11]
    bits = f"{0b00010010:08b}" + f"{samples[0] & 255:08b}" + "00" + "0000" + "1111" + f"{5:05b}"
    for a, b in zip(samples, samples[1:], strict=False):
        bits += f"{(b - a) & 31:05b}"
    bits += "0" * (-len(bits) % 8)
    head = bytes([0xFF, 0xF8, 0x65, 0x02, 0x00, 15])
    frame = head + bytes([flac.crc8(head)]) + int(bits, 2).to_bytes(len(bits) // 8, "big")
    frame += int(flac.crc16(np.frombuffer(frame, np.uint8), np.array([0]), np.array([len(frame)]))[0]).to_bytes(2, "big")
    info = (16).to_bytes(2, "big") * 2 + bytes(6) + (16_000 << 44 | 7 << 36 | 16).to_bytes(8, "big") + bytes(16)
    stream = b"fLaC\x80" + len(info).to_bytes(3, "big") + info + frame
    assert [x - 128 for x in flac.decode_blocks([stream])[0][0][1]] == samples
    assert flac.crc8(b"123456789") == 0xF4 and flac.crc16(np.frombuffer(b"123456789", np.uint8), np.array([0]), np.array([9]))[0] == 0xFEE8


def test_flac_query_and_odd_tables(spark, sf_dir, docs, odd):
    for r in queries.op9_flac(spark, sf_dir).collect():
        p = flac.payload(docs[r["doc_id"]].encode())
        assert (r["n_bytes"], r["payload_bytes"]) == (len(docs[r["doc_id"]].encode()), len(p)) and len(p) % 64 == 0
        assert r["payload_sha256"] == hashlib.sha256(p).hexdigest() and r["tail_crc32"] == zlib.crc32(p[-64:])
    media = flac.write_media(odd)
    out = _rows(flac.read_media(media.withColumn("media", F.when(F.coalesce(F.col("doc_id"), F.lit(0)) != 8, F.col("media"))), with_pcm=True))
    for r in out:
        if r["doc_id"] == 8:
            assert r["payload_bytes"] is None and r["pcm"] is None
        else:
            assert bytes(r["pcm"]) == flac.payload((r["text"] or "").encode())
    blocks = _rows(flac.pcm_blocks(media.filter("doc_id = 6"), keep=["doc_id"]))
    assert [b["sample_offset"] for b in sorted(blocks, key=lambda b: b["block"])] == list(range(0, 40_000, flac.BLOCK)) and sum(b["n_samples"] for b in blocks) == 40_000
    assert flac.read_media(media.limit(0)).count() == 0


# 10 embeddings


def _embedding_rows():
    rng = np.random.default_rng(0)
    base, rows = rng.normal(size=(30, 8)), []
    for i in range(500):
        v = base[rng.integers(30)] + rng.normal(size=8) * 0.25
        rows.append((i, [float(np.float32(x)) for x in v], int(rng.integers(3)) if rng.random() > 0.05 else None))
    rows += [(600 + i, rows[5][1], rows[5][2]) for i in range(20)]
    return rows + [(700, None, 1), (701, [], 1), (702, [0.0] * 8, 1), (703, [float("nan")] * 8, 1), (704, [1.0, 2.0], 1), (705, [1.0, 2.0], 1), (706, [None] * 8, 0), (707, [float("inf")] * 8, 0), (None, rows[7][1], rows[7][2])]


@pytest.mark.parametrize("block,cells", [(4096, None), (2048, 16), (40, 5), (7, 3)])
def test_embeddings_against_brute_force(spark, block, cells):
    rows = _embedding_rows()
    good = [r for r in rows if r[1] and r[2] is not None and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1])]
    links = defaultdict(list)
    for a in range(len(good)):
        for b in range(a):
            x, y = np.array(good[a][1]), np.array(good[b][1])
            if good[a][2] == good[b][2] and len(x) == len(y) and x @ y / math.sqrt((x @ x) * (y @ y)) >= 0.93:
                links[a].append(b)
                links[b].append(a)
    want = {}
    for a in range(len(good)):
        seen, todo = {a}, [a]
        while todo:
            for b in links[todo.pop()]:
                if b not in seen:
                    seen.add(b)
                    todo.append(b)
        want[good[a][0]] = (len(links[a]), min(good[b][0] for b in seen if good[b][0] is not None))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumns({"nid": F.lit(1), "kept": F.lit(2), "copies": F.lit(3)})
    found = embeddings.near_duplicates(df, block=block, cells=cells).collect()
    assert len(found) == len(rows)
    for r in found:
        n, c = want.get(r["vec_id"], (0, r["vec_id"]))
        assert (r["n_links"], r["component_id"], r["kept"]) == (n, c, r["vec_id"] is not None and r["vec_id"] == c)


def test_embeddings_sql_and_empty(spark, compare):
    compare(queries.op10_embeddings, queries.ORACLE_SQL["op10_embeddings"])
    assert embeddings.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_cells_follow_the_table():
    """More cells where clustered vectors grow, so that the products of each row stay about as many; one where nothing can be passed over."""
    rng = np.random.default_rng(8)
    work = []
    for n in (10_000, 100_000):
        centres = rng.normal(size=(n // 100, 32))
        x = embeddings.unit(centres[rng.integers(0, len(centres), max(2000, n // 32))] + rng.normal(size=(max(2000, n // 32), 32)) * 0.05)
        c = embeddings.choose_centroids(x, n, n * n, 0.93)
        home, angle = embeddings._home(x, c)
        radius = np.array([angle[home == j].max(initial=0) for j in range(len(c))])
        goes = embeddings._visits(x, c, home, radius, math.acos(0.93))
        share = np.bincount(home, minlength=len(c)) / len(x)
        work.append((len(c), n * float((share * (share / 2 + goes.mean(0))).sum()), float(goes.sum(1).mean())))
    assert work[0][0] >= 16 and work[1][0] >= 64 and work[1][1] < 4 * work[0][1] and max(w[2] for w in work) < 8, work
    assert len(embeddings.choose_centroids(embeddings.unit(rng.normal(size=(4000, 64))), 100_000, 10**10, 0.93)) == 1


def test_cells_pass_over_only_what_cannot_link():
    rng = np.random.default_rng(5)
    centres = embeddings.unit(rng.normal(size=(6, 16)))
    x = embeddings.unit(np.concatenate([c + rng.normal(size=(40, 16)) * 0.05 for c in centres]))
    c = embeddings.spherical_kmeans(x, 6)
    home, angle = embeddings._home(x, c)
    radius = np.array([angle[home == j].max(initial=0) for j in range(6)])
    assert np.mean(radius) < 0.8 and len(set(home.tolist())) == 6
