"""Connected components of an edge table by alternating large and small stars.

Every round is two shuffles of the edge list.  Nothing but counters and a
bounded list of hub nodes reaches the driver, and each round's edges are
written to the shared folder.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch



def spanning_edges(a: np.ndarray, b: np.ndarray, label: np.ndarray) -> list[tuple[int, int]]:
    """Those links (a, b) that join two components; label holds the components so far and is updated.

    a is sorted.  All links of one row are merged at once, and links within a component are passed
    over, so a dense group takes a few merges.
    """
    edges: list[tuple[int, int]] = []
    while True:
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]
        if not len(a):
            return edges
        x = a[0]
        others = b[: np.searchsorted(a, x, "right")]
        roots, first = np.unique(label[others], return_index=True)
        edges += [(x, y) for y in others[first]]
        merged = np.append(roots, label[x])
        label[np.isin(label, merged)] = merged.min()


#: A node is a hub if it has over 100 and over 1/HUB_SHARE of all edge ends, so there are fewer than HUB_SHARE hubs.
HUB_SHARE = 1000


def _with_minimum(edges: DataFrame, minima: DataFrame, ends: int) -> DataFrame:
    """edges(u, v) with the m of each u; the rows of hubs meet theirs by a bounded broadcast, all others by a shuffle."""
    hubs = minima.filter(F.col("d") > max(100, ends // HUB_SHARE)).select("u", F.col("m").alias("hub_m"))
    marked = edges.join(F.broadcast(hubs), "u", "left")
    rest = marked.filter("hub_m is null").select("u", "v").join(minima.select("u", "m"), "u")
    return marked.filter("hub_m is not null").select("u", "v", F.col("hub_m").alias("m")).unionByName(rest)


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """edges(a, b long) -> (node, root): root is the smallest node reachable; nodes without a link are absent.

    Nulls and loops are ignored, repeated edges count once, an empty table gives an empty result.
    """
    now = scratch.save(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    state = mark(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("d"))
        large = (
            _with_minimum(both, low, 2 * state[0]).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        large = scratch.save(large, "large")
        low = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("d"))
        small = _with_minimum(large, low, state[0])
        small = small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v"))
        )
        after = scratch.save(small.distinct(), "small")
        scratch.drop(now)
        scratch.drop(large)
        now, before, state = after, state, mark(after)
        if state == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
