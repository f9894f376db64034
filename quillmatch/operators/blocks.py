"""Pairs of queries and records that share keys, counted where blocks of queries meet parts of the corpus.

Every cell, a block of queries and a part of the corpus, gets its queries' keys and the postings of these keys as lists
of numbers, once.  It expands and sorts the shared keys of a few queries at a time in memory, so pairs are neither
shuffled nor spilled: what leaves a cell is what is asked of it, all pairs, the best of each query, or their number.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Records of a part, in bits; queries of a block at most; names of a row that carries names.
PART_BITS, BLOCK, NAMES = 20, 65_536, 1_024
#: Shared keys and queries that are expanded at a time, the queries in bits: with the part's and two bits for the route a pair has 32.
HITS, QUERY_BITS = 2_000_000, 10
#: The routes that cells count, by the number that their keys have.
ROUTES = ("exact_name", "name_token", "address")
SCORES = (*ROUTES, "combined")

INPUT = "cell long, side int, s1 string, route int, key string, n int, usable int, ids array<int>, names array<string>"
PAIRS = "s1 string, cand string, " + ", ".join(f"__{r} double" for r in SCORES)
SIZES = "s1 string, pairs long"


def cells(asked: DataFrame, n_queries: int, postings: DataFrame, names: DataFrame, n_records: int) -> tuple[DataFrame, int]:
    """All that cells read, and their number.

    asked(s1, route, key, n, usable): the queries' keys; postings(key, part, ids): records by their places in a part;
    names(part, first, names): the parts' names in order.
    """
    parallel = asked.sparkSession.sparkContext.defaultParallelism
    blocks = max(1, -(-n_queries // BLOCK), min(4 * parallel, n_queries // NAMES))
    parts = max(1, -(-n_records >> PART_BITS)) if n_records else 1
    block = F.pmod(F.xxhash64("s1"), F.lit(blocks))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    cell = (F.col("block") * parts + F.col("part")).alias("cell")
    of = {c.split()[0]: F.lit(None).cast(c.split(" ", 1)[1]).alias(c.split()[0]) for c in INPUT.split(", ")[1:]}

    def row(side: int, **values) -> list:
        return [cell, F.lit(side).alias("side"), *[values[c].alias(c) if c in values else of[c] for c in of if c != "side"]]

    met = asked.select("key", block.alias("block")).distinct().join(postings, "key")
    rows = names.withColumn("block", every(blocks)).select(*row(0, n=F.col("first").cast("int"), names=F.col("names")))
    rows = rows.unionByName(met.select(*row(1, key=F.col("key"), ids=F.col("ids"))))
    own = asked.withColumns({"block": block, "part": every(parts)})
    values = {c: F.col(c).cast("int") for c in ("route", "n", "usable")}
    return rows.unionByName(own.select(*row(2, s1=F.col("s1"), key=F.col("key"), **values))), blocks * parts


def meet(rows: DataFrame, n_cells: int, on: tuple[str, ...], best: int | None = None, counted: bool = False) -> DataFrame:
    """s1, cand and the scores of all pairs found by a route of ``on``; only the best of each query and cell, or counted (SIZES).

    Best are more routes, then the higher sum of scores at 12 decimals, then the smaller name, as in retrieval.ranked.
    """
    dealt = rows.repartition(min(4 * n_cells, 100_000), "cell").sortWithinPartitions("cell", "side", "n", "s1")
    return dealt.mapInArrow(_worker(on, best, counted), SIZES if counted else PAIRS)


def _worker(on: tuple[str, ...], best: int | None, counted: bool) -> Callable:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in _by_cell(batches):
            yield from _cell(cell, on, best, counted)

    return work


def _by_cell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, last = [], None
    for batch in batches:
        at = batch.column("cell").to_numpy()
        for piece in np.split(np.arange(len(at)), np.flatnonzero(np.diff(at)) + 1) if len(at) else []:
            if held and at[piece[0]] != last:
                yield pa.Table.from_batches(held)
                held = []
            last = at[piece[0]]
            held.append(batch.slice(piece[0], len(piece)))
    if held:
        yield pa.Table.from_batches(held)


def _whole(column: pa.ChunkedArray) -> pa.Array:
    out = column.combine_chunks()
    return out if isinstance(out, pa.Array) else pa.concat_arrays(out.chunks)


def _cell(table: pa.Table, on: tuple[str, ...], best: int | None, counted: bool) -> Iterator[pa.RecordBatch]:
    side = table.column("side").to_numpy()
    a, b = np.searchsorted(side, [1, 2])
    names, posted, asked = table.slice(0, a), table.slice(a, b - a), table.slice(b)
    if not len(posted) or not len(asked):
        return
    cands = _whole(pc.list_flatten(names.column("names")))
    lists = _whole(posted.column("ids"))
    values, length = pc.list_flatten(lists).to_numpy(zero_copy_only=False).astype(np.uint32), pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    first = np.cumsum(length) - length

    found = pc.index_in(_whole(asked.column("key")), value_set=_whole(posted.column("key")))
    queries = _whole(asked.column("s1")).dictionary_encode()
    q, route = queries.indices.to_numpy(zero_copy_only=False).astype(np.int64), asked.column("route").to_numpy().astype(np.int64)
    usable = np.ones((len(ROUTES), len(queries.dictionary)))
    usable[route, q] = asked.column("usable").to_numpy()
    known = found.is_valid().to_numpy(zero_copy_only=False)
    # a key that a query has n times counts n times
    rows = np.repeat(np.flatnonzero(known), asked.column("n").to_numpy()[known])
    rows = rows[np.argsort(q[rows], kind="stable")]
    q, route, posting = q[rows], route[rows], found.fill_null(0).to_numpy(zero_copy_only=False)[rows]
    length, first = length[posting], first[posting]

    ends = np.flatnonzero(np.diff(q, append=-1)) + 1  # of each query's rows
    hits = np.cumsum(length)[ends - 1]
    begin, done = 0, 0
    for i in range(len(ends)):
        if i + 1 < len(ends) and hits[i + 1] - done <= HITS and i + 2 - begin <= 1 << QUERY_BITS:
            continue
        at = slice(ends[begin - 1] if begin else 0, ends[i])
        own = q[ends[begin : i + 1] - 1]
        local = np.repeat(np.arange(i + 1 - begin), np.diff(ends[begin : i + 1], prepend=at.start))
        pairs = _pairs(local, route[at], first[at], length[at], values, usable[:, own], on)
        begin, done = i + 1, hits[i]
        if counted:
            number = np.bincount(pairs[0], minlength=len(own))
            some = np.flatnonzero(number)
            yield pa.RecordBatch.from_arrays([queries.dictionary.take(pa.array(own[some])), pa.array(number[some])], ["s1", "pairs"])
            continue
        if best is not None:
            kept = _best(pairs, len(own), on, best)
            pairs = (pairs[0][kept], pairs[1][kept], {r: s[kept] for r, s in pairs[2].items()})
        for k in range(0, len(pairs[0]), 1 << 18):
            part = slice(k, k + (1 << 18))
            columns = [queries.dictionary.take(pa.array(own[pairs[0][part]])), cands.take(pa.array(pairs[1][part]))]
            scores = [pa.array(pairs[2][r][part], from_pandas=True) if r in on else pa.nulls(len(columns[0]), pa.float64()) for r in SCORES]
            yield pa.RecordBatch.from_arrays([*columns, *scores], ["s1", "cand", *[f"__{r}" for r in SCORES]])


def _runs(sorted_values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.concatenate([np.ones(min(1, len(sorted_values)), bool), sorted_values[1:] != sorted_values[:-1]]))


def _pairs(q, route, first, length, values, usable, on) -> tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]:
    """Query, record and scores (NaN: not found by the route) of the pairs, by query and record."""
    start = np.cumsum(length) - length
    at = np.repeat(first - start, length)
    at += np.arange(len(at))
    keys = values[at]
    del at
    keys <<= np.uint32(2)
    keys |= np.repeat((q << (PART_BITS + 2) | route).astype(np.uint32), length)
    keys.sort()
    runs = _runs(keys)
    count = np.diff(runs, append=len(keys))
    runs = keys[runs]
    if "address" in on or "combined" in on:
        kept = (runs & 3 != 2) | (count >= 2)  # at least two address tokens must agree
        runs, count = runs[kept], count[kept]
    kind, pair = runs & 3, runs >> 2
    new = _runs(pair)
    number = np.repeat(np.arange(len(new)), np.diff(new, append=len(pair)))
    pair = pair[new]
    q, record = (pair >> PART_BITS).astype(np.int64), (pair & ((1 << PART_BITS) - 1)).astype(np.int64)
    scores = {}
    for k, name in enumerate(ROUTES):
        own = kind == k
        scores[name] = np.full(len(pair), np.nan)
        scores[name][number[own]] = count[own] / usable[k, q[number[own]]] if k else 1.0
    if "combined" in on:
        scores["combined"] = (scores["name_token"] + scores["address"]) / 2
    found = np.zeros(len(pair), bool)
    for r in on:
        found |= ~np.isnan(scores[r])
    if found.all():
        return q, record, scores
    return q[found], record[found], {r: s[found] for r, s in scores.items()}


def _best(pairs: tuple, n: int, on: tuple[str, ...], best: int) -> np.ndarray:
    """Places of the best pairs of each of n queries; of equal ones those of the first records."""
    q, _, scores = pairs
    total, routes = np.zeros(len(q)), np.zeros(len(q), np.int64)
    for r in sorted(on):
        some = ~np.isnan(scores[r])
        total += np.where(some, scores[r], 0.0)
        routes += some
    # up to four routes and a sum of at most four, in 46 bits; the best are the smallest
    order = (q << 46) | ((1 << 46) - 1 - ((routes << 43) + np.rint(total * 1e12).astype(np.int64)))
    size = np.bincount(q, minlength=n)
    last = np.sort(order)[np.maximum(np.cumsum(size) - size + np.minimum(size, best) - 1, 0)] if len(q) else order
    if not len(q):
        return np.zeros(0, np.int64)
    better, equal = order < last[q], np.flatnonzero(order == last[q])
    room = np.minimum(size, best) - np.bincount(q[better], minlength=n)
    ties = np.bincount(q[equal], minlength=n)
    place = np.arange(len(equal)) - (np.cumsum(ties) - ties)[q[equal]]
    better[equal[place < room[q[equal]]]] = True
    return np.flatnonzero(better)
