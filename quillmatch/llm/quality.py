"""Quality classifier: Bradley-Terry ranking of documents, cut at a score quantile.

A document has a vector of features of its whole text.  A preference pair is a
training document of label 1 over one of label 0; the model's score s of a
document is linear in (binned) features, and P(a over b) = 1 / (1 + exp(-(s_a -
s_b))).  It is fitted by Newton steps on the logistic loss of feature
differences.  The cut is the quantile of the training scores at the share of
label 0; ``score`` is 1 / (1 + exp(cut - s)), so ``predicted`` is 1 from the
cut upwards.

The fit reads a bounded sample: at most ``sample_rows`` labelled documents, those
with the smallest hash of the id, and ``pairs`` pairs of them.  Scoring is one
pass over all texts without a shuffle.

Null texts count as empty; empty texts are scored from their (zero) features.
Null labels, labels other than 0 and 1, and rows with a null id are not learnt
from.  If one of the labels is absent, every score is 0.5 and ``predicted`` 1.
Repeated rows are scored alike.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import append_columns, as_bytes, sample_by_hash, texts

NAMES = (
    "log_bytes", "log_words", "bytes_per_word", "upper", "lower", "digit", "space", "newline", "stop", "clause", "mark", "symbol",
    "high", "distinct_words", "repeated_neighbours", "top_word", "lines_distinct", "words_per_line", "longest_word", "byte_entropy",
    "bangs", "pipes", "capital_words", "short_words",
)

_CLASS = np.zeros(256, np.int64)
for _b in range(256):
    _c = chr(_b)
    _CLASS[_b] = (
        1 if "A" <= _c <= "Z" else 2 if "a" <= _c <= "z" else 3 if _c.isdigit() and _b < 128 else 4 if _c in " \t\r" else 5 if _c == "\n"
        else 6 if _c == "." else 7 if _c in ",;:" else 8 if _c in "!?'\"-()" else 9 if 32 < _b < 127 else 10 if _b > 127 else 0
    )
_ONE_HOT = np.zeros((256, 11))
_ONE_HOT[np.arange(256), _CLASS] = 1


def features(text: bytes) -> list[float]:
    """One number for each of NAMES; all zero for a text without words."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(NAMES)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    size = len(text)
    share = (counts @ _ONE_HOT) / size
    p = counts[counts > 0] / size
    kinds: dict[bytes, int] = {}
    for w in words:
        kinds[w] = kinds.get(w, 0) + 1
    lines = [x for x in text.split(b"\n") if x]
    return [
        math.log1p(size), math.log1p(n), size / n, *share[1:6], *share[6:11], len(kinds) / n, sum(map(eq, words, words[1:])) / n,
        max(kinds.values()) / n, len(set(lines)) / len(lines), math.log1p(n / len(lines)), math.log1p(max(map(len, kinds))),
        float(-(p * np.log2(p)).sum()), counts[33] / n, counts[124] / n, sum(k for w, k in kinds.items() if w.isupper()) / n,
        sum(k for w, k in kinds.items() if len(w) < 3) / n,
    ]


@dataclass
class QualityModel:
    edges: np.ndarray
    weights: np.ndarray
    cut: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return binned(x, self.edges) @ self.weights


def binned(x: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Each feature as indicators of the quantile edges that it passes."""
    return (x[:, :, None] > edges[None]).reshape(len(x), -1).astype(np.float64)


def fit(x: np.ndarray, y: np.ndarray, pairs: int = 40_000, bins: int = 12, ridge: float = 20.0, steps: int = 12) -> QualityModel:
    if not len(x) or y.min() == y.max():
        return QualityModel(np.zeros((len(NAMES), 1)), np.zeros(len(NAMES)), 0.0)
    edges = np.quantile(x, np.linspace(0, 1, bins + 2)[1:-1], axis=0).T
    rng = np.random.default_rng(7)
    better, worse = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    b = binned(x, edges)
    d = b[rng.choice(better, pairs)] - b[rng.choice(worse, pairs)]
    w = np.zeros(d.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(d @ w, -30, 30)))
        gradient = d.T @ (1 - p) - ridge * w
        hessian = (d * (p * (1 - p))[:, None]).T @ d + ridge * np.eye(len(w))
        w += np.linalg.solve(hessian, gradient)
    return QualityModel(edges, w, float(np.quantile(b @ w, float((y == 0).mean()))))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample_rows: int = 6_000, pairs: int = 40_000) -> QualityModel:
    """Learns from the documents that labels names; both tables carry id_col."""
    given = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).filter("id is not null and label in (0, 1)")
    given = sample_by_hash(given, "id", sample_rows).distinct()
    sample = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(given), "id")

    def kernel():
        return lambda batch: [pa.array([features(t) for t in texts(batch.column(0))], pa.list_(pa.float64()))]

    vectors = append_columns(sample, kernel, [as_bytes("text")], "x array<double>", ["id", "label"])
    got = vectors.orderBy(F.xxhash64("id"), "id", "label", "x").limit(sample_rows).collect()
    return fit(np.array([r["x"] for r in got]).reshape(len(got), len(NAMES)), np.array([r["label"] for r in got], int), pairs)


def score(docs: DataFrame, model: QualityModel, text_col: str = "text", keep: list[str] | None = None, named: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """Appends the score (0 to 1) and the decision; columns of these names are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def kernel():
        m: QualityModel = shared.value

        def work(batch: pa.RecordBatch) -> list:
            x = np.array([features(t) for t in texts(batch.column(0))])
            s = np.concatenate([m.raw(x[i : i + 1024]) for i in range(0, len(x), 1024)])
            p = 1 / (1 + np.exp(-np.clip(s - m.cut, -500, 500)))
            return [pa.array(p), pa.array((p >= 0.5).astype(np.int32))]

        return work

    return append_columns(docs, kernel, [as_bytes(text_col)], f"{named[0]} double, {named[1]} int", docs.columns if keep is None else keep)
