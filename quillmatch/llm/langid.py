"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary.
A word's probability is the sum over all its segmentations into pieces, by the
forward algorithm; a text's is the product over its words.

Words are maximal runs of letters of any length, lower-cased, with the
vocabulary's mark for a word's start before the first letter; all of its pieces
take part.  Words of over ``LINEAR`` letters are summed in logarithms, since
their probabilities would be too small for a double.  A letter outside the
vocabulary has a small probability of its own.

Fit: expectation maximisation on the word counts of a bounded sample, at most
``sample_per_lang`` rows of each language and ``sample_rows`` in all, chosen by
a hash of the id.  Scoring is one pass over the texts without a shuffle.

``rate`` is the text's log probability per letter in the predicted language,
``usual`` whether that is not far below what the words of the training texts of
this language make likely: random letters and languages that were not learnt
are unusual in all languages, though one of them is the most probable.

Null or letterless texts get ``und``, score and rate 0 and are not usual.  An
empty training table gives ``und`` for all.  Rows with a null id are scored but
never learnt from.  Ties go to the language that sorts first.  Repeated rows are
scored alike.  Texts of any length are scored whole.  Columns whose names clash
with the results', in any case, are replaced.
"""

from __future__ import annotations

import itertools
import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import append_columns, as_bytes, texts, tokenizer_path

WORD = re.compile(r"[^\W\d_]+")
LINEAR = 32
CACHE = 200_000
OTHER = -18.0
SLACK, FAR = 4.0, 4.0
START = "▁"


def vocabulary(path: str | None = None) -> dict[str, int]:
    """All lower-case pieces of letters of a sentencepiece model; 0 is for none."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path or tokenizer_path("piece_bpe_32k.model"))
    pieces = {model.id_to_piece(i).lower() for i in range(model.get_piece_size()) if not model.is_control(i) and not model.is_byte(i)}
    good = sorted(p for p in pieces if p and (p.lstrip(START) or START).replace(START, "a").isalpha())
    return {p: i for i, p in enumerate(good, 1)}


def runs(text: str) -> list[str]:
    return WORD.findall(text.lower())


def letters(words: list[str]) -> list[str]:
    """The words without signs that are not letters, such as fractions."""
    return ["".join(c for c in w if c.isalpha()) if not w.isalpha() else w for w in words]


def lattice(words: list[str], pieces: dict[str, int], longest: int) -> np.ndarray:
    """ids[word, start, length - 1] of words of one length, 0 where there is no such piece."""
    n, get = len(words[0]), pieces.get
    ids = np.zeros((len(words), n, longest), np.int32)
    for i in range(n):
        for k in range(1, min(longest, n - i) + 1):
            ids[:, i, k - 1] = [get(w[i : i + k], 0) for w in words]
    return ids


def _steps(ids: np.ndarray, p: np.ndarray, i: int, k: int) -> np.ndarray | None:
    """The probability of the piece of k letters from i on, for each word and language; None where no word has one."""
    use = ids[:, i, k - 1]
    if k > 1:
        return p[use] if use.any() else None
    return np.where(use[:, None] == 0, np.exp(OTHER), p[use])


def forward(ids: np.ndarray, p: np.ndarray) -> np.ndarray:
    """alpha[position, word, language]; p[0] is 0, a letter that no piece covers costs exp(OTHER)."""
    m, n, longest = ids.shape
    alpha = np.zeros((n + 1, m, p.shape[1]))
    alpha[0] = 1
    for j in range(1, n + 1):
        for k in range(1, min(longest, j) + 1):
            if (step := _steps(ids, p, j - k, k)) is not None:
                alpha[j] += alpha[j - k] * step
    return alpha


def backward(ids: np.ndarray, p: np.ndarray) -> np.ndarray:
    m, n, longest = ids.shape
    beta = np.zeros((n + 1, m, p.shape[1]))
    beta[n] = 1
    for i in range(n - 1, -1, -1):
        for k in range(1, min(longest, n - i) + 1):
            if (step := _steps(ids, p, i, k)) is not None:
                beta[i] += beta[i + k] * step
    return beta


def _log_table(p: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.log(p)


def _log_sum(x: np.ndarray) -> np.ndarray:
    """log of the sum of exp over the first axis; a sum of none is minus infinity."""
    top = np.maximum(x.max(0), -1e300)
    with np.errstate(divide="ignore"):
        return top + np.log(np.exp(x - top).sum(0))


def log_forward(ids: np.ndarray, log_p: np.ndarray) -> np.ndarray:
    """forward() of one word, ids[start, length - 1], in logarithms: alpha[position, language]."""
    n, longest = ids.shape
    alpha = np.full((n + 1, log_p.shape[1]), -np.inf)
    alpha[0] = 0
    for j in range(1, n + 1):
        k = np.arange(1, min(longest, j) + 1)
        step = log_p[ids[j - k, k - 1]]
        if ids[j - 1, 0] == 0:
            step[0] = OTHER
        alpha[j] = _log_sum(alpha[j - k] + step)
    return alpha


def log_backward(ids: np.ndarray, log_p: np.ndarray) -> np.ndarray:
    n, longest = ids.shape
    beta = np.full((n + 1, log_p.shape[1]), -np.inf)
    beta[n] = 0
    for i in range(n - 1, -1, -1):
        k = np.arange(1, min(longest, n - i) + 1)
        step = log_p[ids[i, k - 1]]
        if ids[i, 0] == 0:
            step[0] = OTHER
        beta[i] = _log_sum(beta[i + k] + step)
    return beta


def by_length(words: list[str]) -> dict[int, list[int]]:
    out: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        out.setdefault(len(w), []).append(i)
    return out


@dataclass
class LanguageModel:
    """p[piece, language]; rate and spread: mean and deviation of the training words' log probability per letter in their language,
    each word by its letters and the root of its count, so that a word that fills a text does not stand for all."""

    langs: list[str]
    pieces: dict[str, int]
    p: np.ndarray
    prior: np.ndarray
    rate: np.ndarray | None = None
    spread: np.ndarray | None = None

    def __post_init__(self):
        self.longest = max(map(len, self.pieces), default=1)
        self.log_p = _log_table(self.p)

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Log probability of each word in each language, and in the last column its letters."""
        out = np.zeros((len(words), len(self.langs) + 1))
        clean = letters(words)
        for n, where in by_length(clean).items():
            if n > LINEAR:
                for i in where:
                    out[i, :-1] = log_forward(lattice([START + clean[i]], self.pieces, self.longest)[0], self.log_p)[-1]
            elif n:
                for at in range(0, len(where), 4096):
                    part = where[at : at + 4096]
                    alpha = forward(lattice([START + clean[i] for i in part], self.pieces, self.longest), self.p)[-1]
                    out[part, :-1] = np.log(alpha)
            out[where, -1] = n
        return out


def _expect(ids: np.ndarray, n: np.ndarray, p: np.ndarray, expected: np.ndarray) -> None:
    """Adds the expected uses of each piece in words of one length that occur n[word, language] times."""
    alpha, beta = forward(ids, p), backward(ids, p)
    weight = n / alpha[-1]
    for i in range(ids.shape[1]):
        for k in range(1, min(ids.shape[2], ids.shape[1] - i) + 1):
            use = ids[:, i, k - 1]
            hit = np.flatnonzero(use)
            if len(hit):
                np.add.at(expected, use[hit], alpha[i, hit] * p[use[hit]] * beta[i + k, hit] * weight[hit])


def _expect_long(ids: np.ndarray, n: np.ndarray, log_p: np.ndarray, expected: np.ndarray) -> None:
    """As _expect for one long word."""
    alpha, beta = log_forward(ids, log_p), log_backward(ids, log_p)
    for i in range(len(ids)):
        k = np.arange(1, min(ids.shape[1], len(ids) - i) + 1)
        use = ids[i, k - 1]
        k, use = k[use > 0], use[use > 0]
        np.add.at(expected, use, np.exp(alpha[i] + log_p[use] + beta[i + k] - alpha[-1]) * n)


def fit(counts: list[tuple[str, str, int]], rows: dict[str, int], pieces: dict[str, int], rounds: int = 4, smoothing: float = 0.05) -> LanguageModel:
    """counts: (lang, word, n); rows: the documents of each language."""
    langs = sorted(rows)
    at = {x: i for i, x in enumerate(langs)}
    table: dict[str, np.ndarray] = {}
    for lang, word, n in counts:
        table.setdefault(word, np.zeros(len(langs)))[at[lang]] += n
    words = sorted(w for w in table if w)
    seen = np.array([table[w] for w in words]).reshape(len(words), len(langs))
    size, longest = len(pieces) + 1, max(map(len, pieces), default=1)
    p = np.full((size, len(langs)), 1 / size)
    p[0] = 0
    blocks = []
    for length, where in sorted(by_length(words).items()):
        step = 8192 if length <= LINEAR else 1
        for i in range(0, len(where), step):
            blocks.append((lattice([START + words[j] for j in where[i : i + step]], pieces, longest), seen[where[i : i + step]]))
    for _ in range(rounds):
        expected, log_p = np.zeros_like(p), _log_table(p)
        for ids, n in blocks:
            if ids.shape[1] <= LINEAR + 1:
                _expect(ids, n, p, expected)
            else:
                _expect_long(ids[0], n[0], log_p, expected)
        expected += smoothing
        expected[0] = 0
        p = expected / expected.sum(0)
    total = np.array([rows[x] for x in langs], float)
    model = LanguageModel(langs, pieces, p, np.log((total + 1) / (total + 1).sum()))
    scores = model.word_scores(words)
    size = scores[:, -1:]
    share = np.sqrt(seen) * size
    share /= np.maximum(share.sum(0), 1)
    rates = scores[:, :-1] / np.maximum(size, 1)
    model.rate = (share * rates).sum(0)
    model.spread = np.sqrt((share * (rates - model.rate) ** 2).sum(0))
    return model


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_per_lang: int = 250, sample_rows: int = 10_000, vocabulary_path: str | None = None) -> LanguageModel:
    """Learns from rows whose id, text and language are not null."""
    known = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).filter("id is not null and text is not null and lang is not null")
    by_hash = W.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    ids = known.select("id", "lang").withColumn("rank", F.row_number().over(by_hash)).filter(F.col("rank") <= sample_per_lang)
    ids = ids.orderBy("rank", "lang").limit(sample_rows).select("id", F.col("lang").alias("chosen")).distinct()
    sample = known.join(F.broadcast(ids), ["id"]).filter("lang = chosen").select("lang", "text")

    def count(batches):
        for batch in batches:
            found: dict[tuple[str, str], int] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found[lang, ""] = found.get((lang, ""), 0) + 1
                for w in letters(runs(text)):
                    if w:
                        found[lang, w] = found.get((lang, w), 0) + 1
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in found], pa.string()), pa.array([k[1] for k in found], pa.string()), pa.array(list(found.values()), pa.int64())], names=["lang", "word", "n"])

    got = [tuple(r) for r in sample.mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n")).collect()]
    rows = {lang: n for lang, word, n in got if not word}
    return fit([x for x in got if x[1]], rows, vocabulary(vocabulary_path))


def predict(docs: DataFrame, model: LanguageModel, text_col: str = "text", keep: list[str] | None = None, named: tuple[str, ...] = ("lang_pred", "score", "rate", "usual")) -> DataFrame:
    """Appends the predicted language, its posterior probability, the log probability per letter and whether that is usual; columns of these names are replaced.

    Usual is a rate of no less than the training words' mean less SLACK deviations and FAR deviations of a mean of so many words."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def kernel():
        m: LanguageModel = shared.value
        index: dict[str, int] = {}
        rows = np.zeros((0, len(m.langs) + 1))

        def work(batch: pa.RecordBatch) -> list:
            nonlocal rows
            langs: list[str] = []
            scores: list[float] = []
            rates: list[float] = []
            usual: list[bool] = []
            data = texts(batch.column(0))
            at = 0
            while at < len(data):
                end, size = at, 0
                while end < len(data) and (end == at or size + len(data[end]) <= 2_000_000):
                    size += len(data[end])
                    end += 1
                words: list[str] = []
                ends = [0]
                for x in data[at:end]:
                    words += runs(x.decode("utf-8", "replace"))
                    ends.append(len(words))
                at = end
                distinct = set(words)
                if len(index) > CACHE:
                    index.clear()
                    rows = rows[:0]
                if new := [w for w in distinct if w not in index]:
                    index.update(zip(new, range(len(rows), len(rows) + len(new)), strict=True))
                    rows = np.concatenate([rows, m.word_scores(new)])
                found = np.fromiter(map(index.__getitem__, words), np.int64, len(words))
                for lo, hi in itertools.pairwise(ends):
                    x = rows[found[lo:hi]].sum(0) if hi > lo else np.zeros(rows.shape[1])
                    if not x[-1] or not m.langs:
                        langs.append("und")
                        scores.append(0.0)
                        rates.append(0.0)
                        usual.append(False)
                    else:
                        z = x[:-1] + m.prior
                        best = int(np.argmax(z))
                        langs.append(m.langs[best])
                        scores.append(float(1 / np.exp(z - z[best]).sum()))
                        rates.append(float(x[best] / x[-1]))
                        usual.append(bool(m.rate is None or rates[-1] >= m.rate[best] - (SLACK + FAR / math.sqrt(hi - lo)) * m.spread[best]))
            return [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rates, pa.float64()), pa.array(usual, pa.bool_())]

        return work

    columns: list[Column] = [as_bytes(text_col)]
    return append_columns(docs, kernel, columns, "{} string, {} double, {} double, {} boolean".format(*named), docs.columns if keep is None else keep)


