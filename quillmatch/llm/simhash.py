"""SimHash near-dedup by a segment-popcount embedding and an exact grid range join.

Fingerprint: bit b is 1 if it is set in over half of the XXH64 hashes (seed 42)
of the text's word shingles, repeats included.  A text with fewer words than a
shingle has one shingle, its whole word sequence; one without words (null too)
has fingerprint zero.

Join: the 64 bits are cut into 32 segments of two bits, and a fingerprint is
embedded as its 32 bit counts, packed two bits each in one long.  The Manhattan
distance of two embeddings is at most the Hamming distance of the fingerprints.
The counts are dealt to ``radius + chosen`` blocks; at most ``radius`` blocks of
a pair within the radius can differ, so some ``chosen`` blocks of it agree.
Each choice of so many blocks is a grid, and a cell of it holds the fingerprints
with the same counts there: every link lies in at least one cell.  ``chosen``
follows from the number of fingerprints, so that by chance a cell holds at most
``NEIGHBOURS``, however many there are; any choice finds the same links.

Within a cell all pairs are compared, but no pair is emitted: the Manhattan
bound sieves, the Hamming distance decides, and a union-find of the cell yields
at most one edge for each fingerprint.  A cell of over ``cell_rows``
fingerprints is dealt to several tasks by a hash, each linked within itself.
Once the components of these edges are known, only fingerprints of different
components in such a cell can lack a link: all but those of the cell's largest
component are compared to the whole cell, again in bounded blocks.  So a group
of near copies of any size costs about its size, and nothing is left out.

Equal fingerprints count once.  Rows with a null id are fingerprinted and take
part as links, have no id to offer, and get the component of their group.  Texts
of any length are fingerprinted whole.  Repeated rows and ties change nothing:
the smallest id counts.  Columns whose names clash with the results', in any
case, are replaced.  An empty table gives an empty one.

Near copies (``keep_first``) are pairs of texts whose sets of shingles have a
Jaccard similarity of 0.8 or more.  They have wide fingerprints of the same kind,
over sets and embedded alike; grids on their bit counts make candidates, the
Manhattan bound and the Hamming distance sieve them, and the sets of shingles
decide each link exactly.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, append_columns, as_bytes, join_hot, texts, without
from .components import components, spanning_edges

NEIGHBOURS = 16
CELL_ROWS = 4096
#: Two random segments of two bits have the same count with this chance.
AGREE = 0.375
_SEED = 42


def _mixed(h: np.ndarray, word: int) -> np.ndarray:
    """Word 0 is the hash itself, each further one a mix of it that is as good as another hash."""
    if not word:
        return h
    z = h + np.uint64(word * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def fingerprint_array(data: list[bytes], words: int) -> np.ndarray:
    """Fingerprints of whole texts as signed 64-bit numbers."""
    out = np.zeros(len(data), np.uint64)
    hashes: list[int] = []
    ends: list[int] = []
    which: list[int] = []

    def flush() -> None:
        bits = np.unpackbits(np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        for i, start, end in zip(which, [0, *ends], ends, strict=False):
            up = bits[start:end].sum(0, dtype=np.int32) * 2 > end - start
            out[i] = np.packbits(up, bitorder="little").view(np.uint64)[0]
        hashes.clear()
        ends.clear()
        which.clear()

    for i, text in enumerate(data):
        w = text.lower().split()
        if not w:
            continue
        hashes += shingle_hashes(w, words)
        ends.append(len(hashes))
        which.append(i)
        if len(hashes) > 200_000:
            flush()
    if ends:
        flush()
    return out.view(np.int64)


def shingle_hashes(w: list[bytes], words: int) -> list[int]:
    """XXH64 of each shingle of a text's words, of all of them together if they are fewer."""
    digest, line = xxhash.xxh64_intdigest, b" ".join(w)
    if len(w) <= words:
        return [digest(line, _SEED)]
    sizes = np.fromiter(map(len, w), np.int64, len(w))
    stop = np.cumsum(sizes + 1) - 1
    first = (stop - sizes)[: len(w) - words + 1].tolist()
    return [digest(line[a:b], _SEED) for a, b in zip(first, stop[words - 1 :].tolist(), strict=True)]


def shingle_set(text: bytes, words: int) -> np.ndarray:
    """The distinct hashes of the text's shingles, sorted; a text without words has none."""
    w = text.lower().split()
    return np.unique(np.array(shingle_hashes(w, words) if w else [], np.uint64))


def fingerprints(docs: DataFrame, text_col: str = "text", words: int = 5, keep: list[str] | None = None, named: str = "fp") -> DataFrame:
    """Appends the fingerprint as a long; a column of this name is replaced."""

    def kernel():
        return lambda batch: [pa.array(fingerprint_array(texts(batch.column(0)), words))]

    return append_columns(docs, kernel, [as_bytes(text_col)], f"{named} long", docs.columns if keep is None else keep)


_EVEN = 0x5555555555555555


def embedding(fp: Column) -> Column:
    """Two-bit bit counts of the 32 segments, packed in a long."""
    high, low = F.shiftrightunsigned(fp, 1).bitwiseAND(F.lit(_EVEN)), fp.bitwiseAND(F.lit(_EVEN))
    return high.bitwiseXOR(low).bitwiseOR(F.shiftleft(high.bitwiseAND(low), 1))


def chosen_blocks(radius: int, rows: int) -> int:
    """The least number of blocks in which a pair must agree that leaves at most NEIGHBOURS of so many fingerprints in a cell by chance."""
    return next((c for c in range(1, 9) if rows * AGREE ** (32 * c / (radius + c)) <= NEIGHBOURS), 9)


def grids(radius: int, chosen: int) -> list[int]:
    """Signed masks over the packed counts, one for each choice of so many of radius + chosen blocks."""
    blocks = [0] * (radius + chosen)
    for segment in range(32):
        blocks[segment * len(blocks) // 32] |= 3 << (2 * segment)
    masks = [sum(c) for c in itertools.combinations(blocks, chosen)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _manhattan(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of packed two-bit counts 0, 1, 2, broadcast: the fields differ by 0, 1 or 2."""
    high, low = np.uint64(0xAAAAAAAAAAAAAAAA), np.uint64(_EVEN)
    x = a ^ b
    # 0-1: 01, 1-2: 11, 0-2: 10 after xor; the low bit marks a distance of 1, the high bit alone one of 2
    ones = x & low
    twos = (x & high) & ~(ones << np.uint64(1))
    return np.bitwise_count(ones) + 2 * np.bitwise_count(twos)


def _pack(fp: np.ndarray) -> np.ndarray:
    return fp - ((fp >> np.uint64(1)) & np.uint64(_EVEN))


def _near(a: np.ndarray, b: np.ndarray, radius: int) -> np.ndarray:
    """Row by row: the Manhattan bound sieves, the Hamming distance decides."""
    near = _manhattan(_pack(a), _pack(b)) <= radius
    near[near] = np.bitwise_count(a[near] ^ b[near]) <= radius
    return near


def linked(left: np.ndarray, right: np.ndarray | None, radius: int) -> np.ndarray:
    """A spanning forest of the links within left, or between left and right, as rows (a, b); values are unsigned.

    Compares blocks of 512.
    """
    both = left if right is None else np.concatenate([left, right])
    split = 0 if right is None else len(left)
    packed, label = _pack(both), np.arange(len(both))
    edges: list[tuple[int, int]] = []
    for i in range(0, len(left), 512):
        for j in range(i if right is None else split, len(both), 512):
            near = _manhattan(packed[i : min(i + 512, len(left)), None], packed[None, j : j + 512]) <= radius
            a, b = np.nonzero(near)
            a, b = a + i, b + j
            good = np.bitwise_count(both[a] ^ both[b]) <= radius
            if right is None:
                good &= a < b
            edges += spanning_edges(a[good], b[good], label)
    return both.view(np.int64)[np.array(edges, np.int64).reshape(-1, 2)]


def _cells_to_edges(radius: int):
    """Rows sorted by key: those of side 0 are linked among themselves if they are alone, else with those of side 1."""

    def close(fp: np.ndarray, side: np.ndarray) -> np.ndarray:
        fp = fp.view(np.uint64)
        if side.max() == 0:
            return linked(fp, None, radius)
        return linked(fp[side == 0], fp[side == 1], radius)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            *key, fp, side = (np.array(c.to_numpy(zero_copy_only=False)) for c in batch.columns)
            new = np.zeros(len(fp), bool)
            for k in key:
                new[1:] |= k[1:] != k[:-1]
            starts = np.concatenate([[0], np.flatnonzero(new), [len(fp)]])
            edges: list[np.ndarray] = []
            if held and last != tuple(int(k[0]) for k in key):
                edges.append(close(*map(np.concatenate, zip(*held, strict=True))))
                held = []
            first = 0
            if held:  # the run goes on
                held.append((fp[: starts[1]], side[: starts[1]]))
                first = 1
                if len(starts) > 2:
                    edges.append(close(*map(np.concatenate, zip(*held, strict=True))))
                    held = []
            lo, hi = starts[first:-2], starts[first + 1 : -1]
            two = lo[(hi - lo == 2) & (side[lo] == 0)]
            a, b = fp[two], fp[two + 1]
            near = _near(a.view(np.uint64), b.view(np.uint64), radius)
            edges.append(np.stack([a[near], b[near]], 1))
            for x, y in zip(lo[hi - lo > 2].tolist(), hi[hi - lo > 2].tolist(), strict=True):
                edges.append(close(fp[x:y], side[x:y]))
            if not held:
                held = [(fp[starts[-2] :], side[starts[-2] :])]
            last = tuple(int(k[-1]) for k in key)
            yield _edge_batch(np.concatenate(edges))
        if held:
            yield _edge_batch(close(*map(np.concatenate, zip(*held, strict=True))))

    return run


def _edge_batch(edges: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(edges[:, 0], pa.int64()), pa.array(edges[:, 1], pa.int64())], names=["a", "b"])


#: A cell is looked for among one of so many of its rows, chosen by a hash.
LOOK = 16


def _link(cells: DataFrame, payload: list[str], run, scratch: Scratch, cell_rows: int, size: Column | None = None) -> DataFrame:
    """cells(grid, cell, nid, payload...) -> (node, root) of the nids that have a link in some cell.

    Cells that seem to have over cell_rows rows, weighed by size, are dealt to several tasks.  Which ones are is judged by a sixteenth
    of the rows: a misjudged cell is dealt otherwise, and its links are the same."""

    def verify(rows: DataFrame, keys: list[str]) -> DataFrame:
        dealt = rows.repartition(*keys).sortWithinPartitions(*keys, "side")
        return dealt.select(*keys, "nid", *payload, "side").mapInArrow(run(len(keys)), "a long, b long")

    weight = F.lit(1) if size is None else size
    looked = cells if size is not None else cells.filter(F.pmod(F.xxhash64("nid", F.lit(1)), F.lit(LOOK)) == 0)
    full = looked.groupBy("grid", "cell").agg((F.sum(weight) * (1 if size is not None else LOOK)).alias("rows")).filter(F.col("rows") > cell_rows)
    full = scratch.save(full.withColumn("parts", F.ceil(F.col("rows") / cell_rows)).drop("rows"), "full")
    if full.isEmpty():
        return components(verify(cells.withColumn("side", F.lit(0)), ["grid", "cell"]), scratch)
    part = F.pmod(F.xxhash64("nid"), F.coalesce("parts", F.lit(1)))
    first = cells.join(full, ["grid", "cell"], "left").withColumn("part", part).withColumn("side", F.lit(0))
    edges = scratch.save(verify(first, ["grid", "cell", "part"]), "within")
    labels = components(edges, scratch)
    crowd = cells.join(full, ["grid", "cell"]).join(labels.withColumnRenamed("node", "nid"), "nid", "left")
    crowd = scratch.save(crowd.withColumn("root", F.coalesce("root", "nid")).withColumn("weight", weight), "crowd")
    sizes = crowd.groupBy("grid", "cell", "root").agg(F.sum("weight").alias("count"))
    largest = sizes.groupBy("grid", "cell").agg(F.max_by("root", F.struct("count", "root")).alias("largest"), (F.sum("count") - F.max("count")).alias("others"))
    mixed = scratch.save(largest.filter("others > 0").withColumn("bands", F.ceil(F.col("others") / cell_rows)), "mixed")
    if mixed.isEmpty():
        scratch.drop(crowd, edges, mixed, full)
        return labels
    whole_crowd = crowd
    crowd = crowd.join(mixed, ["grid", "cell"])
    spread = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n).cast("long") - 1))
    mine = lambda n: F.pmod(F.xxhash64("nid"), F.col(n)).cast("long")
    kept = ["grid", "cell", "nid", *payload]
    queries = crowd.filter("root <> largest").select(*kept, mine("bands").alias("band"), "parts").select(*kept, "band", spread("parts").alias("part"), F.lit(0).alias("side"))
    whole = crowd.select(*kept, mine("parts").alias("part"), "bands").select(*kept, spread("bands").alias("band"), "part", F.lit(1).alias("side"))
    across = verify(queries.unionByName(whole), ["grid", "cell", "band", "part"])
    # what is linked already is a star by now
    stars = labels.select(F.col("node").alias("a"), F.col("root").alias("b"))
    out = components(stars.unionByName(across), scratch)
    scratch.drop(whole_crowd, edges, mixed, full)
    return out


def link_components(fps: DataFrame, scratch: Scratch, radius: int = 4, cell_rows: int = CELL_ROWS) -> DataFrame:
    """fps(fp long, distinct) -> (node, root) of those that have a link within the radius."""
    masks = grids(radius, chosen_blocks(radius, fps.count()))
    cells = fps.select(F.col("fp").alias("nid"), F.posexplode(F.array(*map(F.lit, masks))).alias("grid", "mask"))
    cells = cells.select("nid", "grid", embedding(F.col("nid")).bitwiseAND(F.col("mask")).alias("cell"))
    return _link(cells, [], lambda keys: _cells_to_edges(radius), scratch, cell_rows)


# Near copies by their sets of shingles

#: Words of 64 bits of a wide fingerprint: the first ones for grids, the last two for the sieve.
GRID_WORDS, SIEVE_WORDS = 8, 2
#: Of pairs at the least similarity, the share that meets in some grid; it grows with the similarity.
RECALL = 0.98
#: Other texts in a cell by chance; more of them mean fewer grids.
CROWD = 64
#: Sets of up to SMALL shingles have fingerprints of a kind of their own, those of both kinds if they have LARGE or more.
SMALL, LARGE, COPIES = 20, 16, 25
#: Rows and shingles of sets that are compared at once.
SET_ROWS = 1024
SET_SIZE = 2_000_000


def differing(similarity: float) -> float:
    """The chance that a bit of two sets of this Jaccard similarity differs."""
    return math.acos(2 * similarity / (1 + similarity)) / math.pi


def sieve_radius(similarity: float) -> int:
    """Bits of the sieve in which a pair may differ: the mean and three deviations."""
    bits, p = 64 * SIEVE_WORDS, differing(similarity)
    return round(bits * p + 3 * math.sqrt(bits * p * (1 - p)))


def wide_grids(similarity: float, rows: int) -> np.ndarray:
    """segments[grid, i]: the segments whose counts make a cell.

    Each grid takes so many that by chance a cell holds CROWD of the rows; there are so many grids that a pair of the similarity
    agrees in one with the chance RECALL."""
    p = differing(similarity)
    agree = (1 - p) ** 2 + p * p / 2
    chosen = min(24, max(1, math.ceil(math.log(max(1, rows / CROWD)) / -math.log(AGREE))))
    number = math.ceil(math.log(1 - RECALL) / math.log1p(-(agree**chosen)))
    rng = np.random.default_rng(1)
    return np.array([rng.choice(32 * GRID_WORDS, chosen, replace=False) for _ in range(number)])


def wide_print(hashes: np.ndarray, small: bool) -> np.ndarray:
    """The wide fingerprint of a set of shingles; a tie goes to the bit of the lowest hash.

    Few shingles give few different sums, and their bits differ more often than the similarity says.  So each shingle of a small
    set is counted as COPIES hashes made from it, whose sum is nearly normal."""
    if small:
        hashes = np.concatenate([_mixed(hashes, 1000 + i) for i in range(COPIES)])
    n, out = len(hashes), np.zeros(GRID_WORDS + SIEVE_WORDS, np.uint64)
    for word in range(len(out)):
        bits = np.unpackbits(_mixed(hashes, word).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total = 2 * bits.sum(0, dtype=np.int64)
        out[word] = np.packbits((total > n) | ((total == n) & (bits[0] == 1)), bitorder="little").view(np.uint64)[0]
    return out


def counts_of(prints: np.ndarray) -> np.ndarray:
    """The embedding of the words for grids: digits[row, segment], the bit count of each segment of two bits."""
    packed = _pack(np.ascontiguousarray(prints[:, :GRID_WORDS]))
    digits = (packed[:, :, None] >> np.arange(0, 64, 2, dtype=np.uint64)) & np.uint64(3)
    return digits.reshape(len(prints), -1).astype(np.int64)


def _cells_of(segments: np.ndarray):
    """(nid, kind, words) -> (nid, cells, a, b): the cell of each grid and the words of the sieve."""
    weights = 4 ** np.arange(segments.shape[1], dtype=np.int64)
    grid = np.arange(len(segments), dtype=np.int64) << 49

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(batch.num_rows, -1).view(np.uint64)
            kind = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64) << 48
            for lo in range(0, batch.num_rows, 512):
                digits = counts_of(words[lo : lo + 512])
                cells = digits[:, segments] @ weights + grid + kind[lo : lo + 512, None]
                ends = pa.array(np.arange(0, cells.size + 1, len(segments), dtype=np.int32))
                last = words[lo : lo + 512, GRID_WORDS:].view(np.int64)
                listed = pa.ListArray.from_arrays(ends, pa.array(cells.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, 512), listed, pa.array(last[:, 0]), pa.array(last[:, 1])], names=["nid", "cells", "a", "b"])

    return run


def whole_runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[np.ndarray]]:
    """Rows sorted by their first columns -> columns of whole runs of equal keys; the last run waits for the next batch."""
    held: list[list[np.ndarray]] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [np.array(c.to_numpy(zero_copy_only=False)) for c in batch.columns]
        other = np.zeros(batch.num_rows, bool)
        for k in columns[:keys]:
            other |= k != k[-1]
        cut = int(np.flatnonzero(other)[-1]) + 1 if other.any() else 0
        if held and not cut and all(k[0] == h[-1] for k, h in zip(columns[:keys], held[-1], strict=False)):
            held.append(columns)
            continue
        if held or cut:
            yield list(map(np.concatenate, zip(*held, [c[:cut] for c in columns], strict=True)))
        held = [[c[cut:] for c in columns]]
    if held:
        yield list(map(np.concatenate, zip(*held, strict=True)))


def _starts(columns: list[np.ndarray], keys: int) -> np.ndarray:
    """Where runs of equal keys begin, and the end."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = False
    for k in columns[:keys]:
        new[1:] |= k[1:] != k[:-1]
    return np.append(np.flatnonzero(new), len(new))


def _sieved(x: np.ndarray, packed: np.ndarray, i: np.ndarray, j: np.ndarray, radius: int) -> np.ndarray:
    """Pairs of rows: the Manhattan distance of the counts is a lower bound, the Hamming distance decides."""
    near = sum(_manhattan(p[i], p[j]).astype(np.int64) for p in packed) <= radius
    near[near] = sum(np.bitwise_count(w[i[near]] ^ w[j[near]]).astype(np.int64) for w in x) <= radius
    return near


def _wide_cells_to_edges(radius: int, keys: int):
    """(keys..., nid, a, b, side) sorted by the keys -> candidates, at most one for each text of a cell.

    In a cell with both sides only pairs across count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in whole_runs(batches, keys):
            starts = _starts(columns, keys)
            nid, a, b, side = columns[keys:]
            x = a.view(np.uint64), b.view(np.uint64)
            packed = _pack(x[0]), _pack(x[1])
            end = np.repeat(starts[1:], np.diff(starts))
            sided = np.repeat(np.logical_or.reduceat(side > 0, starts[:-1]), np.diff(starts))
            up, edges, rows, step = np.arange(len(nid)), [np.zeros((0, 2), np.int64)], np.arange(len(nid)), 1
            while True:
                rows = rows[rows + step < end[rows]]
                if not len(rows):
                    break
                apart = rows[up[rows] != up[rows + step]]  # what is linked already needs no look
                for lo in range(0, len(apart), 1 << 16):
                    i = apart[lo : lo + (1 << 16)]
                    j = i + step
                    good = (~sided[i] | (side[i] != side[j])) & _sieved(x, packed, i, j, radius)
                    edges.append(_join(up, i[good], j[good]))
                step += 1
            yield _edge_batch(nid[np.concatenate(edges)])

    return run


def _join(up: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Those pairs that join two components; up holds the root of each row and is updated."""
    out, moved = [], {}
    for a, b in zip(i.tolist(), j.tolist(), strict=True):
        x, y = int(up[a]), int(up[b])
        while x in moved:
            x = moved[x]
        while y in moved:
            y = moved[y]
        if x != y:
            moved[max(x, y)] = min(x, y)
            out.append((a, b))
    if moved:
        up[list(moved)] = list(moved.values())
        while (further := up[up] != up).any():
            up[further] = up[up[further]]
    return np.array(out, np.int64).reshape(-1, 2)


def similar(sets: list[np.ndarray], similarity: float, side: list[int] | None = None) -> list[tuple[int, int]]:
    """A spanning forest of the pairs of sets (sorted, distinct) with at least this Jaccard similarity, across sides if there are any.

    Of two such sets of n hashes and more, each has one of the other's among its n - ceil(similarity n) + 1 lowest.  An index of
    those holds the sets of each component together, so that one that has joined a component passes over the rest of it."""
    up, edges = list(range(len(sets))), []
    index: dict[int, dict[int, list[int]]] = {}

    def find(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for i in sorted(range(len(sets)), key=lambda i: len(sets[i])):
        n = len(sets[i])
        prefix = sets[i][: n - math.ceil(similarity * n - 1e-9) + 1].tolist()
        tried: set[int] = set()
        for h in prefix:
            known = index.get(h, {})
            for root in [r for r in known if up[r] != r]:  # it has become part of another component
                known.setdefault(find(root), []).extend(known.pop(root))
            for root in list(known):
                for j in known[root]:
                    if find(i) == find(root):
                        break
                    if j in tried or (side and side[i] == side[j]) or len(sets[j]) < similarity * n - 1e-9:
                        continue
                    tried.add(j)
                    both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                    if both >= similarity * (n + len(sets[j]) - both) - 1e-9:
                        up[find(i)] = find(j)
                        edges.append((i, j))
        for h in prefix:
            index.setdefault(h, {}).setdefault(find(i), []).append(i)
    return edges


def _verified(words: int, similarity: float, keys: int):
    """(keys..., nid, text, side) sorted by the keys -> the links among the texts of a key, by their sets of shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in whole_runs(batches, keys):
            edges = [np.zeros((0, 2), np.int64)]
            nid, text, side = columns[keys:]
            for lo, hi in itertools.pairwise(_starts(columns, keys).tolist()):
                sets = [shingle_set(x, words) for x in text[lo:hi]]
                found = similar(sets, similarity, side[lo:hi].tolist() if side[lo:hi].any() else None)
                edges.append(nid[lo:hi][np.array(found, np.int64).reshape(-1, 2)])
            yield _edge_batch(np.concatenate(edges))

    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, radius: int = 4, cell_rows: int = CELL_ROWS, keep: list[str] | None = None) -> DataFrame:
    """Appends ``fp`` long and ``component_id``: the smallest id whose fingerprint is reachable; such columns are replaced.

    A component whose ids are all null has a null component_id.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    columns = docs.columns if keep is None else keep
    base = scratch.save(fingerprints(docs, text_col, words, columns if id_col in columns else [*columns, id_col]), "fingerprints")
    nodes = scratch.save(base.groupBy("fp").agg(F.min(id_col).alias("first"), F.count("*").alias("copies")), "nodes")
    linked_to = link_components(nodes.select("fp"), scratch, radius, cell_rows)
    rooted = nodes.join(linked_to.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = scratch.save(rooted.join(smallest, "root").select("fp", "component_id", "copies"), "named")
    out = join_hot(base.drop("component_id"), named, ["fp"], "copies", ["component_id"])
    return out.select(*without(base.select(*columns) if columns else base, ["fp", "component_id"]), "fp", "component_id")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, similarity: float = 0.8, cell_rows: int = CELL_ROWS) -> DataFrame:
    """One row of each group of near copies stays: the one with the smallest id; one with a null id only where the group has no other.

    Two texts are linked if their sets of shingles (XXH64, repeats once) have a Jaccard similarity of ``similarity`` or more, and no
    others are.  Candidates are found with wide fingerprints, with a chance of RECALL where the similarity is just reached, nearer 1
    above; groups of candidates are closed, and within each the sets decide.  Large groups are dealt to blocks of bounded size.
    Groups are closed over all links.  Texts without words are copies of each other.

    Repeated rows of that id count as copies too: one of them stays.  Texts of any length are read whole.  The columns are those of
    docs, whatever their names.
    """
    scratch = Scratch(docs.sparkSession, "simhash-keep")
    rows = scratch.save(docs.withColumn("__row", F.monotonically_increasing_id()), "rows")

    def kernel():
        def work(batch: pa.RecordBatch) -> list:
            sets = [shingle_set(x, words) for x in texts(batch.column(0))]
            key = pa.array([hashlib.blake2b(x.tobytes(), digest_size=16).digest() for x in sets], pa.binary())
            small = [wide_print(x, True).view(np.int64) if 0 < len(x) <= SMALL else None for x in sets]
            large = [wide_print(x, False).view(np.int64) if len(x) >= LARGE else None for x in sets]
            return [key, *[pa.array(p, pa.list_(pa.int64())) for p in (small, large)], pa.array([len(x) for x in sets], pa.int64())]

        return work

    outputs = "key binary, small array<long>, large array<long>, shingles long"
    prints = append_columns(rows.select("__row", F.col(id_col).alias("__id"), text_col), kernel, [as_bytes(text_col)], outputs, ["__row", "__id"])
    prints = scratch.save(prints, "prints")
    best = F.min(F.struct(F.col("__id").isNull().alias("n"), F.col("__id").alias("i"), F.col("__row").alias("r"))).alias("s")
    nodes = prints.groupBy("key").agg(best, *[F.first(c).alias(c) for c in ("small", "large", "shingles")]).drop("key")
    nodes = scratch.save(nodes.withColumn("nid", F.monotonically_increasing_id()), "nodes")
    scratch.drop(prints)
    segments = wide_grids(similarity, nodes.count())
    both = [nodes.filter(F.col(c).isNotNull()).select("nid", F.lit(kind).cast("long").alias("kind"), F.col(c).alias("words")) for kind, c in enumerate(("small", "large"))]
    cells = both[0].unionByName(both[1]).mapInArrow(_cells_of(segments), "nid long, cells array<long>, a long, b long")
    cells = cells.select(F.lit(0).alias("grid"), F.explode("cells").alias("cell"), "nid", "a", "b")
    group = _link(cells, ["a", "b"], lambda keys: _wide_cells_to_edges(sieve_radius(similarity), keys), scratch, cell_rows)
    group = group.select("root", F.col("node").alias("nid")).union(group.select("root", "root")).distinct()  # roots may lack rows of their own
    members = nodes.join(group, "nid").select(F.col("root").alias("cell"), "nid", "shingles", F.col("s.r").alias("__row"))
    members = members.join(rows.select("__row", as_bytes(text_col).alias("text")), "__row")
    members = scratch.save(members.select(F.lit(0).alias("grid"), "cell", "nid", "text", "shingles"), "members")
    size = F.lit(1) + F.col("shingles") * F.lit(min(cell_rows, SET_ROWS) / SET_SIZE)
    root = _link(members, ["text"], lambda keys: _verified(words, similarity, keys), scratch, min(cell_rows, SET_ROWS), size)
    scratch.drop(members)
    rooted = nodes.select("nid", "s").join(root.withColumnRenamed("node", "nid"), "nid", "left")
    chosen = rooted.groupBy(F.coalesce("root", "nid").alias("root")).agg(F.min("s").alias("s"))
    return rows.join(chosen.select(F.col("s.r").alias("__row")), "__row", "left_semi").select(*docs.columns)
