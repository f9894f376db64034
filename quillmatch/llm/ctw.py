"""Language-model scoring by context-tree weighting over bytes.

A text's letters A-Z are lower-cased and its words (runs of anything but ASCII
white space) joined by one space and closed by a line feed.  Each byte is eight
binary decisions, each with a context tree of its own over the bytes before it.
A node of depth d holds the zeros and ones seen after its d bytes and predicts
by the Krichevsky-Trofimov estimate; context-tree weighting mixes the estimates
of all depths along the path with the weights that the training data give:
P_w = 1/2 P_e + 1/2 prod P_w(children), from the counts alone, so the order of
the data does not matter.  ``score`` is the log10 probability of all bytes,
``code_length`` their bits a byte.

What is learnt covers every training text: counts of all windows of depth + 1
bytes and of all words, and no context is left out.  Windows are dealt to
``PARTS`` parts by a hash of the last ``SHARED`` bytes of their context.  A task
sums its windows and writes them sorted by part, a compressed block for each
part, so the one shuffle carries a few bytes a window; a part's blocks are summed
one after the other.  Contexts with the same last bytes form a subtree, weighed
within their part; what is above the subtrees is bounded by the bytes there are,
weighed on the driver and broadcast.  With both, every window of any text gets
its probability.  The windows used most, at most ``grams`` by a threshold on
their uses, are broadcast; all others meet theirs in a shuffle, so ``grams``
bounds memory and changes no score.

The base is a unigram model of words: log10((c + 0.5) / (N + 0.5 (V + 1))).  The
most frequent words, at most ``head`` by a threshold on their counts, are
broadcast; the counts of all others meet their words in a shuffle, so the sum is exact at any size of the vocabulary.

Null texts count as empty: they have one token, the end.  Rows with a null id
are learnt from.  Repeated rows count each.  With nothing to learn from, every
bit has probability 1/2 and the base score is 0.  Texts of any length are
counted and scored whole, some megabytes at a time.  Words and windows that are
used equally often are all broadcast or none.  Of the input only the id and the
text are read, so other columns can't clash.  An empty table gives no rows.
"""

from __future__ import annotations

import itertools
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, as_bytes, slices, texts

DEPTH = 6
GRAMS = 1_000_000
SHARED = 3
PARTS = 4096
CHUNK = 100_000
#: Distinct windows that a task sums before it writes them.
HELD = 1_500_000
HEAD = 262_144
END = b"\n"
_LN10 = math.log(10)


def line(text: bytes) -> tuple[list[bytes], bytes]:
    """The words and the bytes that are scored."""
    words = text.lower().split()
    return words, b" ".join(words) + END


def windows(data: list[bytes], depth: int) -> np.ndarray:
    """For each byte of the lines the depth bytes before it and itself, the last lowest; line feeds stand before a line."""
    gap = END * depth
    x = np.frombuffer(gap + gap.join(data), np.uint8).astype(np.uint64) if data else np.zeros(0, np.uint64)
    if not len(x):
        return x
    out = x[depth:].copy()
    for i in range(1, depth + 1):
        out |= x[depth - i : len(x) - i] << np.uint64(8 * i)
    own = np.ones(len(out), bool)
    at = 0
    for d in data[:-1]:
        at += len(d)
        own[at : at + depth] = False
        at += depth
    return out[own]


# Learning


def part_of(grams: np.ndarray, depth: int) -> np.ndarray:
    """The part of each window: a hash of the last SHARED bytes of its context."""
    shared = (grams >> np.uint64(8)) & np.uint64((1 << (8 * min(SHARED, depth))) - 1)
    return ((shared * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) % PARTS


def pack_blocks(keys: np.ndarray, counts: np.ndarray, cuts: list[int]) -> list[bytes]:
    """Windows, sorted between the cuts, with n and uses, as a block for each cut: differences and counts, byte by byte, compressed."""
    rows = np.empty((3, len(keys)), np.uint64)
    rows[0] = np.diff(keys, prepend=np.uint64(0))
    rows[0, cuts[:-1]] = keys[cuts[:-1]]
    rows[1:] = counts.T
    planes = np.ascontiguousarray(rows.view(np.uint8).reshape(3, -1, 8).transpose(2, 0, 1))
    views, squeeze = [memoryview(p) for p in planes.reshape(24, -1)], zstandard.ZstdCompressor(1).compress
    return [squeeze(b"".join([v[lo:hi] for v in views])) for lo, hi in itertools.pairwise(cuts)]


def unpack_block(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zstandard.decompress(block), np.uint8).reshape(8, 3, -1)
    rows = np.ascontiguousarray(planes.transpose(1, 2, 0)).view(np.uint64)[..., 0]
    return np.cumsum(rows[0], dtype=np.uint64), rows[1:].T.astype(np.int64)


def _count(depth: int):
    """(text, held_out) -> blocks of windows, with n in training texts and uses in all, by part, and words with n in training texts (the end is the empty word)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter = Counter()
        grams: list[tuple[np.ndarray, np.ndarray]] = []
        held = 0

        def flush(end: bool) -> pa.RecordBatch:
            """The windows so far, and the words at the end or where they are many."""
            nonlocal held, words
            given, words = (words, Counter()) if end or len(words) > 300_000 else ({}, words)
            keys, counts = _sum(grams) if grams else (np.zeros(0, np.uint64), np.zeros((0, 2), np.int64))
            part = part_of(keys, depth)
            order = np.argsort(part.astype(np.uint16), kind="stable")  # by radix; PARTS fit
            keys, counts, part = keys[order], counts[order], part[order]
            cuts = np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(part))
            blocks = pack_blocks(keys, counts, cuts.tolist())
            n, m = len(given), len(blocks)
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array([*given.keys(), *[None] * m], pa.binary()),
                    pa.array([*given.values(), *[None] * m], pa.int64()),
                    pa.array([*[None] * n, *part[cuts[:-1]].tolist()], pa.int64()),
                    pa.array([*[None] * n, *blocks], pa.binary()),
                ],
                names=["word", "n", "part", "block"],
            )
            grams.clear()
            held = 0
            return out

        for batch in slices(batches):
            data, out = texts(batch.column(0)), batch.column(1).to_pylist()
            at = 0
            while at < len(data):
                lines: tuple[list[bytes], list[bytes]] = [], []
                size = 0
                while at < len(data) and size < 2_000_000:
                    w, x = line(data[at])
                    # null is neither learnt from nor held out
                    if out[at] is False:
                        words.update(w)
                        words[b""] += 1
                    lines[out[at] is False].append(x)
                    size += len(x)
                    at += 1
                for learnt, some in enumerate(lines):
                    keys, counts = np.unique(windows(some, depth), return_counts=True)
                    grams.append((keys, np.stack([counts * learnt, counts], 1).astype(np.int64)))
                    held += len(keys)
                if held > HELD:
                    grams[:] = [_sum(grams)]
                    held = len(grams[0][0])
                if held > HELD * 2 // 3 or len(words) > 300_000:
                    yield flush(False)
        yield flush(True)

    return run


def _merge(least: int, depth: int):
    """(part, block) sorted by part -> (block, and what its subtrees give to the nodes above them) of whole parts, some CHUNK windows at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held, size = None, [], 0

        def close() -> pa.RecordBatch:
            keys, counts = _sum(held)
            key, *values = _subtree(keys, counts[:, 0], least, depth)[1]
            kinds, back = np.unique(_parent(key, least - 1) if least else key, return_inverse=True)
            roots = [kinds.view(np.int64), *[np.bincount(back, v, len(kinds)) for v in values]]
            return pa.RecordBatch.from_arrays([pa.array(pack_blocks(keys, counts, [0, len(keys)])), *[pa.array([r], f.type) for r, f in zip(roots, list(_MERGED)[1:], strict=True)]], schema=_MERGED)

        for batch in batches:
            for part, block in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if part != last and size > CHUNK:
                    held[:] = [_sum(held)]
                    size = len(held[0][0])
                    if size > CHUNK:
                        yield close()
                        held, size = [], 0
                last = part
                held.append(unpack_block(block.as_py()))
                size += len(held[-1][0])
                if size > HELD:
                    held[:] = [_sum(held)]
                    size = len(held[0][0])
        if held:
            yield close()

    return run


_MERGED = pa.schema([("block", pa.binary()), ("node", pa.list_(pa.int64())), *[(c, pa.list_(pa.float64())) for c in ("zeros", "ones", "weighted")]])


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(block) -> windows and counts of whole parts, some CHUNK windows at a time."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0
    for batch in batches:
        for block in batch.column(0):
            held.append(unpack_block(block.as_py()))
            size += len(held[-1][0])
            if size >= CHUNK:
                yield tuple(map(np.concatenate, zip(*held, strict=True)))
                held, size = [], 0
    if held:
        yield tuple(map(np.concatenate, zip(*held, strict=True)))


def _sum(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    keys = np.concatenate([k for k, _ in parts])
    counts = np.concatenate([c for _, c in parts])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, int)
    return keys[starts], np.add.reduceat(counts, starts) if len(keys) else counts


def _lgamma(x: np.ndarray) -> np.ndarray:
    shifted = x + 8
    low = np.log(x)
    for i in range(1, 8):
        low += np.log(x + i)
    return (shifted - 0.5) * np.log(shifted) - shifted + 0.5 * math.log(2 * math.pi) + 1 / (12 * shifted) - 1 / (360 * shifted**3) - low


#: _lgamma of n + 1/2 and of n + 1 for the counts that nearly all nodes have.
_HALVES, _WHOLES = (_lgamma(np.arange(4096) + x) for x in (0.5, 1.0))


def _lgamma_of(counts: np.ndarray, more: float, known: np.ndarray) -> np.ndarray:
    """_lgamma(counts + more) of whole numbers, by the table as far as it goes."""
    out = known[np.minimum(counts, len(known) - 1).astype(np.int64)]
    large = np.flatnonzero(counts >= len(known))
    out[large] = _lgamma(counts[large] + more)
    return out


def log_estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of a block."""
    return _lgamma_of(zeros, 0.5, _HALVES) + _lgamma_of(ones, 0.5, _HALVES) - math.log(math.pi) - _lgamma_of(zeros + ones, 1.0, _WHOLES)


@dataclass
class Tree:
    """nodes[d]: sorted keys context << 8 | bit prefix of depth d, with the weight, the estimate of a one, and that of the
    remaining contexts below."""

    depth: int
    nodes: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


def _bits(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts of bytes by context -> (context << 8 | prefix, zeros, ones), sorted."""
    context, byte = keys >> np.uint64(8), keys & np.uint64(255)
    nodes, ones = [], []
    for i in range(8):
        prefix = (np.uint64(1) << np.uint64(i)) | (byte >> np.uint64(8 - i))
        nodes.append(context << np.uint64(8) | prefix)
        ones.append(counts * ((byte >> np.uint64(7 - i)) & np.uint64(1)).astype(np.int64))
    node, one, total = np.concatenate(nodes), np.concatenate(ones), np.tile(counts, 8)
    kinds, back = np.unique(node, return_inverse=True)
    one = np.bincount(back, one, len(kinds))
    return kinds, np.bincount(back, total, len(kinds)) - one, one


def _parent(node: np.ndarray, depth: int) -> np.ndarray:
    """The nodes of this depth on the paths of deeper ones."""
    return ((node >> np.uint64(8)) & np.uint64((1 << (8 * depth)) - 1)) << np.uint64(8) | (node & np.uint64(255))


def _weigh(bits: list[tuple[np.ndarray, np.ndarray, np.ndarray]], least: int = 0, below: tuple | None = None) -> tuple[list, tuple]:
    """bits[i]: sorted nodes of depth least + i with zeros and ones; below: the nodes under the last with their weighted probability.

    Returns the nodes as Tree has them and those of depth least as ``below`` is."""
    nodes: list = [None] * len(bits)
    for d in range(least + len(bits) - 1, least - 1, -1):
        key, zeros, ones = bits[d - least]
        own = log_estimate(zeros, ones)
        estimate = (ones + 0.5) / (zeros + ones + 1)
        if below is None:
            odds, rest = np.full(len(key), np.inf), estimate
            weighted = own
        else:
            child, child_zeros, child_ones, child_weighted = below
            at = np.searchsorted(key, _parent(child, d))
            less = lambda w, at=at, n=len(key): np.bincount(at, w, n)
            rest0, rest1 = np.maximum(zeros - less(child_zeros), 0), np.maximum(ones - less(child_ones), 0)
            split = less(child_weighted) + log_estimate(rest0, rest1)
            odds = own - split
            rest = (rest1 + 0.5) / (rest0 + rest1 + 1)
            weighted = np.logaddexp(own, split) - math.log(2)
        weight = 1 / (1 + np.exp(-np.clip(odds, -700, 700)))
        nodes[d - least] = (key, weight, estimate, rest)
        below = (key, zeros, ones, weighted)
    return nodes, below


def log_probability(tree: Tree, window: np.ndarray, deepest: np.ndarray) -> np.ndarray:
    """Natural log of the byte's probability; deepest: the depth of the longest known context of each window (-1: none)."""
    out = np.zeros(len(window))
    byte = window & np.uint64(255)
    levels = []
    for d in range(tree.depth, -1, -1):
        rows = np.flatnonzero(deepest >= d)
        if len(rows):  # windows with the same last bytes are looked up once
            kinds, back = np.unique(window[rows] & np.uint64((1 << (8 * (d + 1))) - 1), return_inverse=True)
            levels.append((tree.nodes[d], rows if len(rows) < len(window) else slice(None), kinds, back, np.flatnonzero(deepest[rows] == d)))
    for i in range(8):
        prefix = lambda x, i=i: (np.uint64(1) << np.uint64(i)) | (x & np.uint64(255)) >> np.uint64(8 - i)
        bit = ((byte >> np.uint64(7 - i)) & np.uint64(1)).astype(bool)
        p = np.full(len(window), 0.5)
        for (key, weight, estimate, rest), rows, kinds, back, last in levels:
            want = kinds & ~np.uint64(255) | prefix(kinds)
            at = np.minimum(np.searchsorted(key, want), len(key) - 1)
            hit = key[at] == want
            under = p[rows]
            under[last] = np.where(hit, rest[at], 0.5)[back[last]]
            w = np.where(hit, weight[at], 0.5)
            p[rows] = (w * np.where(hit, estimate[at], 0.5))[back] + (1 - w)[back] * under
        out += np.log(np.where(bit, p, 1 - p))
    return out


class _Table:
    """Open addressing over 64-bit keys."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.size = max(4, 1 << (2 * len(keys)).bit_length())
        self.shift = np.uint64(64 - (self.size.bit_length() - 1))
        self.keys = np.zeros(self.size, np.uint64)
        self.used = np.zeros(self.size, bool)
        self.values = np.zeros(self.size)
        slot = self._slot(keys)
        left = np.arange(len(keys))
        while len(left):
            free = ~self.used[slot[left]]
            some, first = np.unique(slot[left[free]], return_index=True)
            put = left[free][first]
            self.used[some], self.keys[some], self.values[some] = True, keys[put], values[put]
            done = np.zeros(len(keys), bool)
            done[put] = True
            left = left[~done[left]]
            slot[left] = (slot[left] + 1) & (self.size - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        slot = self._slot(keys)
        hit = self.keys[slot] == keys
        zero = np.flatnonzero(hit & (keys == 0))  # as empty slots are
        hit[zero] = self.used[slot[zero]]
        left = np.flatnonzero(~hit)
        left = left[self.used[slot[left]]]
        while len(left):
            slot[left] = (slot[left] + 1) & (self.size - 1)
            now = slot[left]
            found = (self.keys[now] == keys[left]) & self.used[now]
            hit[left[found]] = True
            left = left[~found & self.used[now]]
        return hit, self.values[slot]


def _least(sizes: list, most: int) -> int:
    """(level, rows) of every level -> the lowest level from which on there are at most so many rows."""
    least, held = 1 << 30, 0
    for level, n in sorted(map(tuple, sizes), reverse=True):
        if held + n > most:
            break
        held, least = held + n, level
    return least


def count(source: DataFrame, scratch: Scratch, depth: int) -> tuple[DataFrame, DataFrame]:
    """source(text binary, held_out boolean) -> (word, n), and (block, node, zeros, ones, weighted): the windows of each part and its roots."""
    least = min(SHARED, depth)
    counted = scratch.save(source.mapInArrow(_count(depth), "word binary, n long, part long, block binary"), "counts")
    words = counted.filter("word is not null").groupBy("word").agg(F.sum("n").alias("n"))
    blocks = counted.filter("part is not null").select("part", "block").repartition("part").sortWithinPartitions("part")
    merged = blocks.mapInArrow(_merge(least, depth), "block binary, node array<long>, zeros array<double>, ones array<double>, weighted array<double>")
    out = scratch.save(words, "words"), scratch.save(merged, "parts")
    scratch.drop(counted)
    return out


def _subtree(gram: np.ndarray, n: np.ndarray, least: int, depth: int) -> tuple[list, tuple]:
    """_weigh for the windows of whole parts, from depth least on."""
    keys, counts, bits = gram[n > 0], n[n > 0], []
    for d in range(depth, least - 1, -1):
        keys, counts = _sum([(keys & np.uint64((1 << (8 * (d + 1))) - 1), counts)])
        bits.append(_bits(keys, counts))
    return _weigh(bits[::-1], least)


def _top(node: np.ndarray, zeros: np.ndarray, ones: np.ndarray, weighted: np.ndarray, least: int) -> list:
    """The nodes above the subtrees, from what _merge gives to those of depth least - 1."""
    order = np.argsort(node)
    below = tuple(x[order] for x in (node, zeros, ones, weighted))
    bits = [below[:3]]
    for d in range(least - 2, -1, -1):
        key, back = np.unique(_parent(bits[0][0], d), return_inverse=True)
        bits.insert(0, (key, *[np.bincount(back, x, len(key)) for x in bits[0][1:]]))
    return _weigh(bits, 0, below)[0]


def _price(least: int, depth: int, top):
    """(block) -> (gram, uses, p)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for window, counts in _chunks(batches):
            tree = Tree(depth, [*top.value, *_subtree(window, counts[:, 0], least, depth)[0]])
            deepest = np.full(len(window), -1)
            for d, (key, *_) in enumerate(tree.nodes):
                if len(key):
                    root = (window >> np.uint64(8) & np.uint64((1 << (8 * d)) - 1)) << np.uint64(8) | np.uint64(1)
                    deepest[key[np.minimum(np.searchsorted(key, root), len(key) - 1)] == root] = d
            yield pa.RecordBatch.from_arrays([pa.array(window.view(np.int64)), pa.array(counts[:, 1]), pa.array(log_probability(tree, window, deepest))], names=["gram", "uses", "p"])

    return run


def price(merged: DataFrame, scratch: Scratch, depth: int) -> DataFrame:
    """count()'s parts -> (gram, uses, p): the natural log of each window's last byte after the others, in the tree of all windows."""
    least = min(SHARED, depth)
    roots = merged.select(F.inline(F.arrays_zip("node", "zeros", "ones", "weighted")))
    roots = roots.groupBy("node").agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "weighted")]).toArrow()
    node, *values = (np.array(roots.column(i).to_numpy()) for i in range(4))
    top = merged.sparkSession.sparkContext.broadcast(_top(node.astype(np.uint64), *values, least))
    return scratch.save(merged.select("block").mapInArrow(_price(least, depth, top), "gram long, uses long, p double"), "priced")


def _by_line(which: np.ndarray, lacked: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of ascending lines, sorted in each line, and where runs of equal ones begin.

    Where the line's number fits above a window the two are sorted as one number."""
    free = 64 - 8 * (depth + 1)
    if len(which) and which[-1] < 1 << free:
        both = np.sort(which.astype(np.uint64) << np.uint64(64 - free) | lacked)
        starts = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]]))
        return which, both & np.uint64((1 << (64 - free)) - 1), starts
    order = np.lexsort((lacked, which))
    which, lacked = which[order], lacked[order]
    new = np.ones(len(which), bool)
    new[1:] = (which[1:] != which[:-1]) | (lacked[1:] != lacked[:-1])
    return which, lacked, np.flatnonzero(new)


def _score(name: str, depth: int, grams, head, n_total: int, kinds: int):
    """(id, text, held) -> a row per text, with the words and the windows that the heads lack."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prices, logs = _shared(name, grams, head, n_total, kinds)
        rid = TaskContext.get().partitionId() << 36
        for whole in batches:
            step = max(1, whole.num_rows * 4_000_000 // max(1, whole.nbytes))
            for begin in range(0, whole.num_rows, step):
                batch = whole.slice(begin, step)
                data = texts(batch.column(1))
                tokens, known, base, tails, lines = [], [], [], [], []
                for text in data:
                    words, x = line(text)
                    lines.append(x)
                    got = list(map(logs.get, words))
                    tail = Counter([w for w, p in zip(words, got, strict=True) if p is None]) if None in got else {}
                    tails.append([{"word": w, "k": k} for w, k in tail.items()])
                    found = [p for p in got if p is not None]
                    end = logs.get(b"")
                    tokens.append(len(words) + 1)
                    known.append(len(found) + (end is not None))
                    base.append(math.fsum(found) + (end if end is not None else math.log10(0.5 / (n_total + 0.5 * (kinds + 1)))))
                scores = np.zeros(len(lines))
                rare, rare_uses, rare_ends = [], [], [np.zeros(1, np.int64)]
                at = 0
                while at < len(lines):
                    stop, size = at, 0
                    while stop < len(lines) and (stop == at or size < 500_000 and stop - at < 256):
                        size += len(lines[stop])
                        stop += 1
                    window = windows(lines[at:stop], depth)
                    hit, p = prices.get(window)
                    sizes = [len(x) for x in lines[at:stop]]
                    scores[at:stop] = np.add.reduceat(np.where(hit, p, 0), np.cumsum([0, *sizes[:-1]])) / _LN10
                    which, lacked = np.repeat(np.arange(stop - at), sizes)[~hit], window[~hit]
                    which, lacked, starts = _by_line(which, lacked, depth)
                    rare.append(lacked[starts].view(np.int64))
                    rare_uses.append(np.diff(np.append(starts, len(which))))
                    rare_ends.append(rare_ends[-1][-1] + np.cumsum(np.bincount(which[starts], minlength=stop - at)))
                    at = stop
                pairs = pa.StructArray.from_arrays([pa.array(np.concatenate([np.zeros(0, np.int64), *x])) for x in (rare, rare_uses)], names=["gram", "k"])
                ends = pa.array(np.concatenate(rare_ends).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(rid, rid + len(data))), batch.column(0), batch.column(2), pa.array(tokens, pa.int64()), pa.array(known, pa.int64()), pa.array(base, pa.float64()),
                        pa.array(scores), pa.array([len(x) for x in lines], pa.int64()), pa.array(tails, pa.list_(pa.struct([("word", pa.binary()), ("k", pa.int64())]))),
                        pa.ListArray.from_arrays(ends, pairs),
                    ],
                    names=["rid", "id", "held_out", "n_tokens", "known", "base", "score", "n_bytes", "tail", "rare"],
                )
                rid += len(data)

    return run


_SHARED: dict[str, tuple] = {}


def _shared(name: str, grams, head, n_total: int, kinds: int) -> tuple[_Table, dict[bytes, float]]:
    """One table of each head for each worker process and model."""
    if name not in _SHARED:
        _SHARED.clear()
        words, counts = head.value
        whole = n_total + 0.5 * (kinds + 1)
        _SHARED[name] = _Table(*grams.value), dict(zip(words, np.log10((counts + 0.5) / whole).tolist(), strict=True))
    return _SHARED[name]


def score(
    docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH, grams: int = GRAMS, head: int = HEAD
) -> DataFrame:
    """id_col, held_out, n_tokens, n_known, train_tokens, base_score, score, code_length (bits a byte) of every row.

    The model learns from the rows for which held_out is false."""
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "ctw")
    source = docs.select(F.col(id_col).alias("id"), as_bytes(text_col).alias("text"), held_out.alias("held_out"))
    words, merged = count(source.select("text", "held_out"), scratch, depth)
    priced = price(merged, scratch, depth)
    scratch.drop(merged)
    used = F.floor(8 * F.log2("uses"))
    often = _least(priced.groupBy(used).count().collect(), grams)
    known = priced.filter(used >= often).select("gram", "p").toArrow()
    known_prices = known.column(0).to_numpy().astype(np.uint64), known.column(1).to_numpy()
    n_total, kinds = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    eighth = F.floor(8 * F.log2("n"))
    top = words.filter(eighth >= _least(words.groupBy(eighth).count().collect(), head)).toArrow()
    ends = words.filter(F.length("word") == 0).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    names, counts = top.column(0).to_pylist(), top.column(1).to_numpy()
    at_head = (names, counts) if not ends or b"" in names else ([*names, b""], np.append(counts, ends))
    context = spark.sparkContext
    kind = source.schema["id"].dataType.simpleString()
    ddl = f"rid long, id {kind}, held_out boolean, n_tokens long, known long, base double, score double, n_bytes long, tail array<struct<word: binary, k: long>>, rare array<struct<gram: long, k: long>>"
    scored = source.mapInArrow(_score(scratch.root, depth, context.broadcast(known_prices), context.broadcast(at_head), n_total, kinds), ddl)
    scored = scratch.save(scored, "scored")
    tail = scored.select("rid", F.inline("tail")).join(words, "word", "left")
    seen = F.coalesce("n", F.lit(0))
    p = F.log10((seen + 0.5) / F.lit(n_total + 0.5 * (kinds + 1)))
    sums = tail.groupBy("rid").agg(F.sum(F.when(seen > 0, F.col("k")).otherwise(0)).alias("more"), F.sum(F.col("k") * p).alias("rest"))
    rare = scored.select("rid", F.inline("rare")).join(priced.filter(used < often).select("gram", "p"), "gram")
    rare = rare.groupBy("rid").agg((F.sum(F.col("k") * F.col("p")) / _LN10).alias("lacked"))
    scored = scored.join(rare, "rid", "left").withColumn("score", F.col("score") + F.coalesce("lacked", F.lit(0.0)))
    return scored.drop("tail", "rare", "lacked").join(sums, "rid", "left").select(
        F.col("id").alias(id_col), "held_out", "n_tokens", (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"), F.lit(n_total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rest", F.lit(0.0))).alias("base_score"), "score", (-F.col("score") * math.log2(10) / F.col("n_bytes")).alias("code_length"),
    )
