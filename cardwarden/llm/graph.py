"""Connected components of a graph whose links are rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.llm.storage import drop, stored

#: Links that a task holds at a time, up to twice so many; what fewer are left by all tasks is one task's.
LINKS = 1 << 18


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """One row (node, root) per node that has a link to another one; root is its component's smallest node.

    First every task links the nodes it reads to the smallest that its own links reach, which leaves
    fewer links than nodes. Of these, up to ``LINKS`` are joined by one task. With more, large-star
    and small-star steps take turns: each node's larger neighbours are linked to its smallest
    neighbour, then its smaller ones are. Both only shorten paths, so the number of
    rounds grows with the logarithm of the longest path. A step is a map-side combined minimum
    and a join that adaptive execution can split at a node with very many links. Links in
    either direction, repeated, or from a node to itself do no harm. Nulls are not allowed.
    """
    low, high = F.least(F.col(a), F.col(b)), F.greatest(F.col(a), F.col(b))
    pairs = links.select(high.alias("u"), low.alias("v")).where("u > v")
    stars = stored(pairs.mapInArrow(_contracted, pairs.schema), "links")
    seen = _mark(stars)
    if seen[0] <= LINKS:
        whole = stars.coalesce(1).select(F.col("u").alias("node"), F.col("v").alias("root"))
        roots = stored(whole.mapInArrow(_rooted, whole.schema), "roots")
        drop(stars)
        return roots
    while True:
        ends = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = ends.groupBy("u").agg(F.min("v").alias("m"))
        large = ends.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        large = stored(large, "large-stars")
        parent = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(parent, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        before, stars = stars, stored(small.unionByName(parent.select("u", F.col("m").alias("v"))).distinct(), "small-stars")
        drop(before, large)
        now = _mark(stars)
        if now == seen:
            roots = stars.select("v").distinct()
            return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                roots.select(F.col("v").alias("node"), F.col("v").alias("root"))
            )
        seen = now


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (u, v) with the components of those of a partition, at most one for each u among some ``LINKS``."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= 2 * LINKS:
            held = [_stars(held)]
            if held[0].num_rows > LINKS:
                yield held.pop()
    if held:
        yield _stars(held)


def _rooted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every node of a partition's links with its root, for no more than ``LINKS`` links."""
    held = list(batches)
    if held:
        nodes, root = _roots(held)
        yield pa.record_batch([nodes, nodes.take(pa.array(root))], names=["node", "root"])


def _stars(links: list[pa.RecordBatch]) -> pa.RecordBatch:
    """Links of each node to the smallest of its component."""
    nodes, root = _roots(links)
    linked = np.flatnonzero(root != np.arange(len(nodes)))
    return pa.record_batch([nodes.take(pa.array(x)) for x in (linked, root[linked])], names=["u", "v"])


def _roots(links: list[pa.RecordBatch]) -> tuple[pa.Array, np.ndarray]:
    """The distinct nodes in ascending order, and the position of the smallest of each one's component."""
    ends = pa.concat_arrays([batch.column(k) for k in (0, 1) for batch in links]).dictionary_encode()
    nodes = ends.dictionary.take(order := pa.compute.sort_indices(ends.dictionary))
    rank = np.empty(len(nodes), np.int64)
    rank[order.to_numpy()] = root = np.arange(len(nodes))
    u, v = rank[ends.indices.to_numpy()].reshape(2, -1)
    while len(u):
        root = root.copy()
        np.minimum.at(root, np.maximum(u, v), np.minimum(u, v))
        while (root != root[root]).any():
            root = root[root]
        u, v = root[u], root[v]
        apart = u != v
        u, v = u[apart], v[apart]
    return nodes, root


def _mark(links: DataFrame) -> tuple[int, int]:
    """Tells two sets of links apart: their number and the sum of their hashes."""
    row = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return int(row[0]), int(row[1] or 0)
