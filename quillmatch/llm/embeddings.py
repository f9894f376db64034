"""Embedding near-dedup: spherical k-means cells, blocked cosine products, one row of each group kept.

Two vectors of one label are linked if their cosine, in double precision, is at
least the threshold.  Equal vectors of a label are one node that counts its
copies.  Spherical k-means on a sample of at most ``sample`` nodes gives the
centroids; every node is at home in the cell of its nearest centroid.  How many
there are follows from the number of nodes and the sample: of the numbers in
``CELLS`` with CELL_ROWS nodes to a cell, the one with the least work, that is
rows sent to cells and products within them, so that clustered vectors take work
in proportion to their number.  So that no link across a
border is lost, a node also visits each later cell that a neighbour of it can
be at home in.  With t the threshold's angle, a neighbour y of x that is at
home in cell d rather than in x's own cell c fulfils both

    <x, c - d> <= |c - d| sin t          (y is on d's side of the bisector)
    angle(x, d) <= t + the largest angle of a vector at home in d

so other cells are passed over.  In tight clusters few nodes visit.  Where
vectors lie in all directions, as at random, nodes would visit most cells; one
cell is chosen then, and the work is that of all pairs of a label, done as
matrix products of large blocks.

Within a cell blocks of about ``block`` rows (fewer where vectors are long) are
compared, each pair of blocks in a task of its own, so no group grows a task.  A pair of blocks yields
the number of links of each node and a spanning forest of the links, never the
links themselves.

Nothing links to vectors whose label is null, that are null, empty or zero, or
that have a null or non-finite component, nor do vectors of different length.
Rows with a null id take part and have no id to offer; ``kept`` is false for
them.  Repeated rows are copies of each other.  A cosine just at the threshold,
as the exact sum of the products gives it, links.  Only the id, the vector and
the label are read, so other columns can't clash.  An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, join_hot, sample_by_hash
from .components import components, spanning_edges

CELLS = (1, 4, 16, 64, 256, 1024)
CELL_ROWS = 256
SAMPLE = 16_384
BLOCK = 4_096
#: A block of longer vectors has fewer rows, so that it holds no more values than this.
BLOCK_VALUES = 1 << 20
#: Seconds that a row costs on its way to a cell, and a product of two values, for choosing the number of cells.
ROW_COST, VALUE_COST = 2e-5, 3e-10


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, without overflow."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """Unit centroids of the unit rows x; a cell that runs empty takes the row that fits its own cell least."""
    c = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)].copy()
    for _ in range(rounds):
        s = x @ c.T
        home = s.argmax(1)
        for j in range(len(c)):
            own = x[home == j]
            total = own.sum(0) if len(own) else x[s.max(1).argmin()]
            norm = np.sqrt((total * total).sum())
            if norm > 0:
                c[j] = total / norm
    return c


def choose_centroids(x: np.ndarray, rows: int, pairs: int, threshold: float) -> np.ndarray:
    """Centroids for a table of so many nodes and pairs of one label, of which the unit vectors x are a sample."""
    best, least = np.zeros((0, 0)), math.inf
    angle = math.acos(threshold) + 1e-9
    for k in CELLS:
        if k > 1 and (k * CELL_ROWS > rows or 8 * k > len(x)):
            break
        c = spherical_kmeans(x, k)
        home, own_angle = _home(x, c)
        radius = np.zeros(len(c))
        np.maximum.at(radius, home, own_angle)
        goes = _visits(x, c, home, radius, angle)
        share, visiting = np.bincount(home, minlength=len(c)) / len(x), goes.mean(0)
        compared = pairs * float((share * (share / 2 + visiting)).sum())
        cost = rows * (1 + visiting.sum()) * ROW_COST + (compared + rows * k) * x.shape[1] * VALUE_COST
        if cost < least:
            best, least = c, cost
    return best


def _visits(x: np.ndarray, centroids: np.ndarray, home: np.ndarray, radius: np.ndarray, angle: float) -> np.ndarray:
    """[row, cell]: a later cell than the row's own that a neighbour within the angle may be at home in."""
    gap = np.sqrt(np.maximum(0, 2 - 2 * centroids @ centroids.T))
    s = x @ centroids.T
    own = s[np.arange(len(x)), home][:, None]
    goes = (own - s <= gap[home] * math.sin(min(angle, math.pi / 2)) + 1e-7) & (np.arccos(np.clip(s, -1, 1)) <= angle + radius[None] + 1e-7)
    return goes & (np.arange(len(centroids))[None] > home[:, None])


def _arrays(column: pa.Array) -> np.ndarray:
    """Vectors of one length as a matrix of doubles."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _by_size(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix) of each length among the vectors."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    return [(rows := np.flatnonzero(sizes == n), _arrays(column.take(pa.array(rows)))) for n in np.unique(sizes)]


def _home(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cell and angle to its centroid; vectors of another length than the centroids' are all in cell 0."""
    if centroids.size == 0 or x.shape[1] != centroids.shape[1]:
        return np.zeros(len(x), np.int64), np.zeros(len(x))
    s = x @ centroids.T
    return s.argmax(1), np.arccos(np.clip(s.max(1), -1, 1))


def _radii(centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = np.zeros(max(1, len(centroids)))
        for batch in batches:
            for _, x in _by_size(batch.column(0)):
                home, angle = _home(unit(x), centroids)
                np.maximum.at(most, home, angle)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(most))), pa.array(most)], names=["cell", "radius"])

    return run


def _deal(centroids: np.ndarray, radius: np.ndarray, threshold: float):
    """(nid, copies, label, vector) -> a row for the home cell and for each later cell that a neighbour may be at home in."""
    angle = math.acos(threshold) + 1e-9

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, raw in _by_size(batch.column(3)) if batch.num_rows else []:
                x = unit(raw)
                home, _ = _home(x, centroids)
                goes = np.zeros((len(x), max(1, len(centroids))), bool)
                if centroids.size and x.shape[1] == centroids.shape[1]:
                    goes = _visits(x, centroids, home, radius, angle)
                who, cell = np.nonzero(goes)
                take = np.concatenate([np.arange(len(x)), who])
                cell = np.concatenate([home, cell])
                side = np.repeat([0, 1], [len(x), len(who)])
                picked = pa.array(rows[take])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(picked), batch.column(1).take(picked), batch.column(2).take(picked), batch.column(3).take(picked), pa.array(np.full(len(take), raw.shape[1])), pa.array(cell), pa.array(side)],
                    names=["nid", "copies", "label", "vector", "size", "cell", "side"],
                )

    return run


def _compare(threshold: float):
    """Rows sorted by key -> (a, b, null) for edges and (a, null, n) for links counted."""

    def block(nid: np.ndarray, copies: np.ndarray, x: np.ndarray, left: np.ndarray, right: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
        count = np.zeros(len(nid), np.int64)
        label = np.arange(len(nid))
        edges: list[tuple[int, int]] = []
        for i in range(0, len(left), 512):
            a = left[i : i + 512]
            b = right[i:] if same else right
            s = x[a] @ x[b].T
            near = s >= threshold
            for r, c in zip(*np.nonzero(np.abs(s - threshold) < 1e-12), strict=True):
                near[r, c] = math.fsum(x[a[r]] * x[b[c]]) >= threshold
            if same:
                near &= np.arange(len(b))[None] > np.arange(len(a))[:, None]
            count[a] += near @ copies[b]
            count[b] += copies[a] @ near
            r, c = np.nonzero(near)
            edges += spanning_edges(a[r], b[c], label)
        return np.array(edges, np.int64).reshape(-1, 2), count

    def close(held: list[tuple], key: tuple) -> pa.RecordBatch:
        nid, copies, side = (np.concatenate([h[i] for h in held]) for i in (0, 1, 3))
        x = np.concatenate([h[2] for h in held])
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        i, j, visit = key[-3:]
        edges, count = block(nid, copies, x, left, right, False)
        if i == j and not visit:
            more, counted = block(nid, copies, x, left, left, True)
            edges, count = np.concatenate([edges, more]), count + counted
        hit = np.flatnonzero(count)
        a = np.concatenate([nid[edges[:, 0]], nid[hit]])
        b = pa.array(np.concatenate([nid[edges[:, 1]], hit]), mask=np.repeat([False, True], [len(edges), len(hit)]))
        n = pa.array(np.concatenate([edges[:, 0], count[hit]]), mask=np.repeat([True, False], [len(edges), len(hit)]))
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), b.cast(pa.int64()), n.cast(pa.int64())], names=["a", "b", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = list(zip(*(c.to_pylist() for c in batch.columns[4:]), strict=True))
            cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
            nid, copies, side = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 3))
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if held and keys[lo] != last:
                    if sum(len(h[0]) for h in held) > 1:
                        yield close(held, last)
                    held = []
                held.append((nid[lo:hi].copy(), copies[lo:hi].copy(), unit(_arrays(batch.column(2).slice(lo, hi - lo))), side[lo:hi].copy()))
                last = keys[lo]
        if held and sum(len(h[0]) for h in held) > 1:
            yield close(held, last)

    return run


def near_duplicates(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = 0.93,
    cells: int | None = None, sample: int = SAMPLE, block: int = BLOCK,
) -> DataFrame:
    """One row per row: id_col, n_links (other rows linked directly), component_id (smallest id reachable, itself included), kept.

    cells: the number of centroids, where it is not to be chosen from the table."""
    scratch = Scratch(rows.sparkSession, "embeddings")
    base = rows.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"), F.col(label_col).alias("label"))
    inf = float("inf")
    good = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf)) & F.exists("vector", lambda x: x != 0)
    base = base.withColumn("ok", F.coalesce(F.col("label").isNotNull() & F.col("vector").isNotNull() & good, F.lit(False)))
    nodes = base.filter("ok").groupBy("label", "vector").agg(F.min("id").alias("first"), F.count("*").alias("copies"))
    nodes = scratch.save(nodes.withColumn("nid", F.monotonically_increasing_id()), "nodes")

    sizes_by_label = nodes.groupBy("label").count()
    total, pairs = sizes_by_label.agg(F.coalesce(F.sum("count"), F.lit(0)), F.coalesce(F.sum(F.col("count").cast("double") * F.col("count")), F.lit(0.0))).first()
    picked = sample_by_hash(nodes.select("vector", "nid"), "nid", min(sample, max(2_000, total // 32))).select("vector").toArrow().column(0).combine_chunks()
    sized = _by_size(picked) if len(picked) else []
    points = max((x for _, x in sized), key=len, default=np.zeros((0, 0)))
    centroids = np.zeros((0, 0))
    if len(points):
        centroids = choose_centroids(unit(points), total, pairs, threshold) if cells is None else spherical_kmeans(unit(points), cells)
        block = min(block, max(256, BLOCK_VALUES // points.shape[1]))
    radius = np.zeros(max(1, len(centroids)))
    for r in nodes.select("vector").mapInArrow(_radii(centroids), "cell long, radius double").groupBy("cell").agg(F.max("radius")).collect():
        radius[r[0]] = r[1]

    kind = nodes.schema["label"].dataType.simpleString()
    dealt = nodes.select("nid", "copies", "label", "vector").mapInArrow(
        _deal(centroids, radius, threshold), f"nid long, copies long, label {kind}, vector array<double>, size long, cell long, side long"
    )
    dealt = scratch.save(dealt, "dealt")
    key = ["label", "size", "cell"]
    full = dealt.groupBy(*key, "side").count().filter(F.col("count") > block).groupBy(*key).pivot("side", [0, 1]).sum("count")
    full = full.select(*key, *[F.ceil(F.coalesce(str(s), F.lit(1)) / block).alias(f"parts{s}") for s in (0, 1)])
    full = scratch.save(full, "full")
    marked = dealt.join(full, key, "left").na.fill(1, ["parts0", "parts1"])
    hashed = lambda n: F.pmod(F.xxhash64("nid"), F.col(n)).cast("long")
    upto = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n).cast("long") - 1)
    own = marked.withColumn("at", F.when(F.col("side") == 0, hashed("parts0")).otherwise(hashed("parts1")))
    # a task (i, j, visit) compares block i of a cell's own rows with block j or, if they are the same, with itself and a block of visitors
    zero = F.lit(0).cast("long")
    home, guest = own.filter("side = 0"), own.filter("side = 1")
    columns = [*key, "i", "j", "visit", "nid", "copies", "vector", "which"]
    pairs = home.filter("parts0 > 1").withColumn("other", F.explode(upto("parts0"))).filter("at <> other")
    pairs = pairs.select(*key, F.least("at", "other").alias("i"), F.greatest("at", "other").alias("j"), zero.alias("visit"), "nid", "copies", "vector", (F.col("at") > F.col("other")).cast("int").alias("which")).select(columns)
    alone = home.withColumn("visit", F.explode(upto("parts1"))).withColumns({"i": F.col("at"), "j": F.col("at"), "which": F.lit(0)}).select(columns)
    visits = guest.withColumn("i", F.explode(upto("parts0"))).withColumns({"j": F.col("i"), "visit": F.col("at"), "which": F.lit(1)}).select(columns)
    task = [*key, "i", "j", "visit"]
    pairs = pairs.unionByName(alone).unionByName(visits).repartition(*task).sortWithinPartitions(*task)
    pairs = pairs.select("nid", "copies", "vector", "which", *task)
    found = scratch.save(pairs.mapInArrow(_compare(threshold), "a long, b long, n long"), "found")

    links = found.filter("n is not null").groupBy(F.col("a").alias("nid")).agg(F.sum("n").alias("linked"))
    root = components(found.filter("b is not null").select("a", "b"), scratch).withColumnRenamed("node", "nid")
    scratch.drop(dealt, full)
    named = nodes.select("nid", "label", "vector", "first", "copies").join(links, "nid", "left").join(root, "nid", "left").withColumn("root", F.coalesce("root", "nid"))
    named = scratch.save(named.drop("nid"), "named")
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    named = scratch.save(named.join(smallest, "root").select("label", "vector", "copies", (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"), "answers")
    answered = join_hot(base.filter("ok").drop("ok"), named, ["label", "vector"], "copies", ["n_links", "component_id"]).select("id", "n_links", "component_id")
    rest = base.filter("not ok").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return answered.unionByName(rest).select(F.col("id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
