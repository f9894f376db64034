"""BPE encoding by speculation and verification, and decoding.

Proposal: a word is cut greedily into the longest tokens of the vocabulary.
Verification: a sequence of tokens is the word's BPE encoding exactly if every
two neighbours are the encoding of their own concatenation.  All neighbouring
pairs of a batch of words are tested at once against a table of pairs; a pair
that the table lacks is merged exactly once and added.  Only words with a
failing pair are merged exactly.

Texts are normalised and cut into words as the tokenizer's file says (NFC,
white-space runs to a space, lower case; contractions, letter runs, single
digits, other runs).  The strings of added tokens are matched in the raw text.
Words never influence one another, so their encodings are kept in a bounded
cache of each worker.

Null texts count as empty.  An empty text has no ids and decodes to the empty
text; an empty table gives an empty one.  Rows with a null id and repeated rows
are encoded each.  Equal ranks of overlapping pairs merge from the left.  Texts
and words of any length are encoded whole: exact merging takes n log n steps for
a word of n letters, and a batch's texts are taken some megabytes at a time.
Columns whose names clash with the results', in any case, are replaced.
"""

from __future__ import annotations

import gc
import hashlib
import json
import os
import re
import unicodedata
from collections.abc import Iterable
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import append_columns, as_bytes, texts, tokenizer_path
from .encoding import by_bytes

CACHE = 150_000
PAIRS = 400_000


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 for itself, the others from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, spare = [], 256
    for b in range(256):
        if b in own:
            out.append(chr(b))
        else:
            out.append(chr(spare))
            spare += 1
    return out


class TwoGenerations(dict):
    """A cache of at most twice ``size`` entries and those of the last call; what is in use outlives a change of generation."""

    def __init__(self, size: int):
        super().__init__()
        self.size, self.old = size, {}

    def prepare(self, wanted: set, compute) -> None:
        """Makes all of wanted present; compute maps a list of keys to their values."""
        if len(self) > self.size:
            self.old = dict(self)
            self.clear()
        missing = wanted.difference(self)
        known = missing.intersection(self.old)
        self.update((k, self.old[k]) for k in known)
        new = list(missing.difference(known))
        for i in range(0, len(new), 50_000):
            part = new[i : i + 50_000]
            self.update(zip(part, compute(part), strict=True))


class SpeculativeBPE:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model = file["model"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.vocab: dict[str, int] = model["vocab"]
        self.tokens: dict[int, str] = {i: t for t, i in self.vocab.items()}
        self.added = {a["content"]: a["id"] for a in file["added_tokens"]}
        self.tokens.update({i: t for t, i in self.added.items()})
        self.merges: dict[int, int] = {}  # two packed ids -> rank
        self.merged: list[int] = []  # rank -> id
        for rank, m in enumerate(model["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            self.merges.setdefault(self.vocab[a] << 32 | self.vocab[b], rank)
            self.merged.append(self.vocab[a + b])
        self.sign = os.path.commonprefix(list(self.added))  # in every string of an added token
        self.added_at = regex.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        split = next(p["pattern"]["Regex"] for p in file["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words_of = regex.compile(split).findall
        self.ascii_words = re.compile(split.replace("\\p{L}", "a-z").replace("\\p{N}", "0-9"), re.A).findall  # of lower-case ASCII texts
        self.letters = byte_letters()
        self.single = [self.vocab[c] for c in self.letters]
        self.final = [self.vocab[c + self.suffix] for c in self.letters] if self.suffix else self.single
        self.longest = max(map(len, self.vocab))
        self.reach: dict[str, int] = {}  # the longest token by its first three letters
        for t in self.vocab:
            self.reach[t[:3]] = max(len(t), self.reach.get(t[:3], 2))
        self.pair_ok: dict[int, bool] = {}
        self.spelled: dict[int, list[int]] = {}
        self.cache: TwoGenerations = TwoGenerations(CACHE)
        self.strings: TwoGenerations = TwoGenerations(CACHE)
        self.exact_merges = self.proposed = 0

    def symbols(self, word: str) -> list[int]:
        """A word's first symbols: one for each byte, the last with the mark of the word's end."""
        data = word.encode("utf-8")
        s = list(map(self.single.__getitem__, data))
        if self.suffix:
            s[-1] = self.final[data[-1]]
        return s

    def merge(self, symbols: list[int]) -> list[int]:
        """Exact BPE: always the leftmost pair of the lowest rank.

        Pairs wait in a heap by rank and place, and merged symbols leave a linked list, so n symbols take n log n steps."""
        s, rank, after, n = list(symbols), self.merges.get, self.merged, len(symbols)
        if n < 2:
            return s
        heap = [r << 32 | i for i in range(n - 1) if (r := rank(s[i] << 32 | s[i + 1])) is not None]
        heapify(heap)
        following, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while heap:
            low, i = divmod(heappop(heap), 1 << 32)
            j = following[i]
            # a pair that was merged or changed since it was pushed is passed over; its successor has an entry of its own
            if s[i] < 0 or j == n or rank(s[i] << 32 | s[j]) != low:
                continue
            s[i], s[j] = after[low], -1
            k = following[i] = following[j]
            if k < n:
                before[k] = i
                if (r := rank(s[i] << 32 | s[k])) is not None:
                    heappush(heap, r << 32 | i)
            h = before[i]
            if h >= 0 and (r := rank(s[h] << 32 | s[i])) is not None:
                heappush(heap, r << 32 | h)
        return [x for x in s if x >= 0]

    def propose(self, word: str) -> list[int]:
        """The longest token at each place; the last one carries the mark of the word's end."""
        s = word if word.isascii() and word.isprintable() else "".join([self.letters[b] for b in word.encode("utf-8")])
        n, get, reach, suffix, out, i = len(s), self.vocab.get, self.reach, self.suffix, [], 0
        most = n - 1 if suffix else n
        while i < n:
            if n - i <= self.longest and (t := get(s[i:] + suffix)) is not None:
                out.append(t)
                break
            j = i + reach.get(s[i : i + 3], 2)
            if j > most:
                j = most
            while j > i:
                t = get(s[i:j])
                if t is not None:
                    out.append(t)
                    i = j
                    break
                j -= 1
            else:
                return []
        return out

    def spell(self, token: int) -> list[int]:
        """The first symbols of a token."""
        if token not in self.spelled:
            t = self.tokens[token]
            core = t[: -len(self.suffix)] if self.suffix and t.endswith(self.suffix) else t
            out = [self.vocab[c] for c in core]
            if core != t:
                out[-1] = self.vocab[core[-1] + self.suffix]
            self.spelled[token] = out
        return self.spelled[token]

    def compatible(self, pairs: np.ndarray) -> np.ndarray:
        """If each packed pair is the encoding of its own concatenation; new ones are merged once."""
        kinds, back = np.unique(pairs, return_inverse=True)
        if len(self.pair_ok) > PAIRS:
            self.pair_ok.clear()
        known, size = self.pair_ok, 1 << 32
        for k in kinds.tolist():
            if k not in known:
                a, b = divmod(k, size)
                known[k] = self.merge(self.spell(a) + self.spell(b)) == [a, b]
        return np.fromiter(map(known.__getitem__, kinds.tolist()), bool, len(kinds))[back]

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Ids of distinct words."""
        if self.added.keys() & set(words):
            plain = [w for w in words if w not in self.added]
            known = dict(zip(plain, self.encode_words(plain), strict=True))
            return [[self.added[w]] if w in self.added else known[w] for w in words]
        out = [self.propose(w) for w in words]
        self.proposed += len(words)
        sizes = np.fromiter(map(len, out), np.int64, len(out))
        flat = np.fromiter((t for x in out for t in x), np.int64, int(sizes.sum()))
        owner = np.repeat(np.arange(len(out)), sizes)
        same = owner[1:] == owner[:-1]
        pairs = (flat[:-1] << 32 | flat[1:])[same]
        failing = np.zeros(len(out), bool)
        failing[sizes == 0] = True
        if len(pairs):
            failing[owner[1:][same][~self.compatible(pairs)]] = True
        for i in np.flatnonzero(failing).tolist():
            out[i] = self.merge(self.symbols(words[i]))
            self.exact_merges += 1
        return out

    def _plain(self, text: str) -> list[str]:
        """The words of a text without added tokens."""
        if text.isascii():
            return self.ascii_words(text.lower())
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        # the file lowers character by character: no sigma is final
        return self.words_of(text.lower() if "Σ" not in text else "".join([c.lower() for c in text]))

    def words(self, text: str) -> list[str]:
        """The words of a text, and the strings of added tokens, which no word equals."""
        if self.sign not in text or self.added_at is None:
            return self._plain(text)
        out: list[str] = []
        at = 0
        for m in self.added_at.finditer(text):
            out += self._plain(text[at : m.start()])
            out.append(m[0])
            at = m.end()
        return out + self._plain(text[at:])

    def encode(self, text: str) -> list[int]:
        """A text's ids as a list."""
        words = self.words(text)
        self.cache.prepare(set(words), self.encode_words)
        return [i for w in words for i in self.cache[w]]

    def decode(self, ids: Iterable[int]) -> str:
        """The tokens joined by one space: the file names no decoder."""
        return " ".join([self.tokens[i] for i in ids])

    def rendered(self, data: list[str]) -> list[tuple[int, str, str]]:
        """Of each text: the number of ids, the ids and the tokens, each joined by one space."""
        split = [self.words(t) for t in data]
        distinct: set[str] = set()
        for s in split:
            distinct.update(s)
        self.strings.prepare(distinct, lambda new: [(" ".join(map(str, ids)), self.decode(ids)) for ids in self.encode_words(new)])
        get, out = self.strings.__getitem__, []
        for s in split:
            if not s:
                out.append((0, "", ""))
                continue
            ids, tokens = map(" ".join, zip(*map(get, s), strict=True))
            out.append((ids.count(" ") + 1, ids, tokens))
        return out


_SHARED: dict[str, SpeculativeBPE] = {}


def coder(path: str) -> SpeculativeBPE:
    """One coder for each worker process and file."""
    if path not in _SHARED:
        _SHARED[path] = SpeculativeBPE(path)
    return _SHARED[path]


def encode(docs: DataFrame, text_col: str = "text", tokenizer: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """Appends ``ids`` and ``decoded``, the text that they decode to; columns of these names are replaced."""
    path = tokenizer or tokenizer_path("word_bpe_49k.json")

    def kernel():
        own = coder(path)

        def work(batch: pa.RecordBatch) -> list:
            ids = [own.encode(x.decode("utf-8", "replace")) for x in texts(batch.column(0))]
            return [pa.array(ids, pa.list_(pa.int32())), pa.array([own.decode(i) for i in ids], pa.string())]

        return work

    return append_columns(docs, kernel, [as_bytes(text_col)], "ids array<int>, decoded string", docs.columns if keep is None else keep)


def digests(docs: DataFrame, text_col: str = "text", tokenizer: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """Appends n_tokens and the SHA-256 of the ids (in decimal, joined by a space) and of the decoded text."""
    path = tokenizer or tokenizer_path("word_bpe_49k.json")

    def kernel():
        own = coder(path)

        def work(batch: pa.RecordBatch) -> list:
            data = texts(batch.column(0))
            rows = []
            gc.disable()  # the caches are large and hold no cycles
            try:
                for lo, hi in by_bytes(data):
                    for n, ids, back in own.rendered([x.decode("utf-8", "replace") for x in data[lo:hi]]):
                        rows.append((n, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
            finally:
                gc.enable()
            return [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.string(), pa.string()))]

        return work

    return append_columns(docs, kernel, [as_bytes(text_col)], "n_tokens long, ids_sha256 string, decoded_sha256 string", docs.columns if keep is None else keep)
