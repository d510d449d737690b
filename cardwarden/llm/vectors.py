"""Near-duplicate vectors by comparing tiles in the order of principal components.

Unit vectors are rotated so that their leading coordinates hold most of the variance. The dot
products of a pair of tiles are summed up from the leading coordinates on; what is missing is
at most the product of the suffix norms, so that pairs drop out as soon as their cosine can't
reach the threshold. A coordinate of two linked vectors differs by no more than their distance,
so only tiles of neighbouring cells of the first coordinates are compared at all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwarden.llm.graph import components
from cardwarden.llm.storage import stored

THRESHOLD = 0.98
#: Coordinates that are summed up before pairs are looked at again.
STEPS = (8, 16, 32)
#: Vectors of a tile on average, and those of a tile that are compared with another one at a time.
TILE, BLOCK = 4096, 512
#: Vectors that the rotation is fitted on at most. Any rotation gives the same links.
FIT_ROWS = 8192
#: Pairs whose rotated cosine is so near to the threshold, or above it, are computed again from the vectors as given.
SLACK = 1e-9
#: First coordinates that make a cell at most.
CELL_DIMS = 3


def _usable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with a finite vector other than zero, with its length; those with nulls inside go."""
    for batch in batches:
        column = batch.column("embedding")
        flat = column.flatten()
        sizes = np.array([0 if n is None else n for n in pa.compute.list_value_length(column).to_pylist()], np.int64)
        values = flat.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
        with np.errstate(all="ignore"):
            at = np.concatenate([[0], np.cumsum(sizes)])
            finite = np.concatenate([[0], np.cumsum(np.isfinite(values))])
            good = (finite[at[1:]] - finite[at[:-1]] == sizes) & (sizes > 0)
            some = np.concatenate([[0], np.cumsum(np.nan_to_num(values) != 0)])
            good &= some[at[1:]] > some[at[:-1]]
        good &= batch.column("label").is_valid().to_numpy(zero_copy_only=False)
        yield batch.append_column("usable", pa.array(good))


def _unit_rows(column: pa.Array, dim: int) -> np.ndarray:
    rows = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(len(column), dim)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # so that no square over- or underflows
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def rotations(usable: DataFrame) -> dict[int, np.ndarray]:
    """For each length of vector, the principal axes as columns, the largest variance first.

    Fitted on the ``FIT_ROWS`` vectors whose ids have the smallest hash.
    """
    chosen = usable.orderBy(F.xxhash64(F.lit(5), "vec_id"), "vec_id").limit(FIT_ROWS).select("dim", "embedding").toArrow()
    found = {}
    for dim in set(chosen["dim"].to_pylist()):
        own = chosen.filter(pa.compute.equal(chosen["dim"], dim))["embedding"]
        rows = _unit_rows(pa.concat_arrays(own.chunks), dim)
        found[dim] = np.linalg.eigh(np.cov(rows.T).reshape(dim, dim) if len(rows) > 1 else np.eye(dim))[1][:, ::-1]
    return found


def _rotated(rows: np.ndarray, axes: np.ndarray | None) -> np.ndarray:
    return rows if axes is None else rows @ axes


def compare_tiles(x: np.ndarray, y: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows whose dot product may reach the threshold, for rotated unit vectors."""
    dim = x.shape[1]
    steps = [s for s in STEPS if s < dim]
    rest_x, rest_y = ({s: np.sqrt((r[:, s:] ** 2).sum(axis=1)) for s in steps} for r in (x, y))
    low = threshold - SLACK
    if not steps:
        return np.nonzero(x @ y.T >= low)
    total = x[:, : steps[0]] @ y[:, : steps[0]].T
    i, j = np.nonzero(total + rest_x[steps[0]][:, None] * rest_y[steps[0]][None, :] >= low)
    sums, at = total[i, j], steps[0]
    for s in [*steps[1:], dim]:
        sums = sums + _dots(x, y, i, j, slice(at, s))
        bound = sums + rest_x[s][i] * rest_y[s][j] if s < dim else sums
        keep = bound >= low
        i, j, sums, at = i[keep], j[keep], sums[keep], s
    return i, j


def _dots(x: np.ndarray, y: np.ndarray, i: np.ndarray, j: np.ndarray, span: slice) -> np.ndarray:
    """Products of chosen pairs over some coordinates, some pairs at a time to bound memory."""
    out = np.empty(len(i))
    for a in range(0, len(i), 1 << 16):
        own = slice(a, a + (1 << 16))
        out[own] = np.einsum("ij,ij->i", x[i[own], span], y[j[own], span])
    return out


def exact_cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of rows in double precision, scaled by powers of two so that no square over- or underflows."""
    a, b = (r * np.exp2(-np.frexp(np.abs(r).max(axis=1, keepdims=True))[1]) for r in (a, b))
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def _spanning(count: int, i: np.ndarray, j: np.ndarray) -> list[tuple[int, int]]:
    """Pairs that connect the same of ``count`` things as all the given ones, fewer than things."""
    parent = np.arange(count)
    while True:  # every root takes the smallest root that it has a link to
        a, b = parent[i], parent[j]
        low, high = np.minimum(a, b), np.maximum(a, b)
        if not (low < high).any():
            break
        np.minimum.at(parent, high, low)
        while (parent[parent] != parent).any():
            parent = parent[parent]
    return [(int(parent[k]), k) for k in range(count) if parent[k] != k]


def _tile_links(shipped, threshold: float):
    def linked(table: pa.Table) -> pa.Table:
        """For the rows of two tiles: (a, null, links) for each vector with links, (a, b, null) for spanning pairs."""
        axes = shipped.value
        table = table.combine_chunks()
        dim = table["dim"][0].as_py()
        column = pa.concat_arrays(table["embedding"].chunks)
        given = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(len(column), dim)
        rows = _rotated(_unit_rows(column, dim), axes.get(dim))
        tile = np.array(table["tile"].to_pylist(), object)
        is_first = tile == table["first"][0].as_py()
        one = table["first"][0].as_py() == table["second"][0].as_py()
        a, b = np.flatnonzero(is_first), np.flatnonzero(is_first if one else ~is_first)
        blocks = [compare_tiles(rows[a[s : s + BLOCK]], rows[b], threshold) for s in range(0, len(a), BLOCK)]
        nothing = np.zeros(0, np.int64)
        i = a[np.concatenate([nothing, *(x + s * BLOCK for s, (x, _) in enumerate(blocks))])]
        j = b[np.concatenate([nothing, *(y for _, y in blocks)])]
        if one:
            i, j = i[i < j], j[i < j]
        kept = [exact_cosine(given[i[s : s + 65536]], given[j[s : s + 65536]]) >= threshold for s in range(0, len(i), 65536)]
        kept = np.concatenate(kept) if kept else np.zeros(0, bool)
        i, j = i[kept], j[kept]
        weight = table["copies"].to_numpy()
        links = np.bincount(i, weights=weight[j], minlength=len(rows)) + np.bincount(j, weights=weight[i], minlength=len(rows))
        ids = table["rep"].to_numpy()
        edges = _spanning(len(rows), i, j)
        found = np.flatnonzero(links)
        return pa.table(
            {
                "a": pa.array([*ids[found], *(ids[p] for p, _ in edges)], pa.int64()),
                "b": pa.array([*[None] * len(found), *(ids[q] for _, q in edges)], pa.int64()),
                "links": pa.array([*links[found].astype(np.int64), *[None] * len(edges)], pa.int64()),
            }
        )

    return linked


def near_duplicate_vectors(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept), one for each of the vectors (vec_id, embedding, label).

    Vectors of the same label and length are linked if their cosine, in double precision, is
    at least ``threshold`` (above -1). A vector that is null, empty or zero, holds null or a non-finite number, or
    has no label is linked with nothing. Equal vectors are compared once and counted as often as
    they occur; rows that share an id are told apart by their vectors for ``n_links`` and share a component.
    ``component_id`` is the smallest id that links reach, itself included. Other columns are
    ignored, an empty table gives none; an id that is null is linked with nothing.

    Every vector is sent once for each tile of its own and the neighbouring cells. A task
    returns a count for each vector and links that span its tiles' components, never all pairs.
    """
    rows = vectors.select(F.col("vec_id").cast("bigint"), "embedding", F.col("label").cast("string").alias("label"))
    marked = rows.mapInArrow(_usable, rows.withColumn("usable", F.lit(True)).schema)
    good = F.col("usable") & F.col("vec_id").isNotNull()
    keyed = marked.select("vec_id", "label", "embedding", good.alias("usable"), F.size("embedding").alias("dim"), *[F.xxhash64(F.lit(k), "embedding").alias(f"key{k}") for k in (1, 2)])
    keyed = stored(keyed, "vectors")
    usable = keyed.where("usable")
    axes = rotations(usable)
    shipped = vectors.sparkSession.sparkContext.broadcast(axes)

    same = ["label", "dim", "key1", "key2"]
    reps = usable.groupBy(*same).agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.first("embedding").alias("embedding"))
    reps = reps.withColumn("rep", F.xxhash64("label", "dim", "key1", "key2"))
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-6)

    def celled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = np.zeros((batch.num_rows, CELL_DIMS), np.int32)
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                own = np.flatnonzero(dims == dim)
                first = _rotated(_unit_rows(batch.column("embedding").take(pa.array(own)), int(dim)), shipped.value.get(int(dim)))[:, :CELL_DIMS]
                cells[own, : first.shape[1]] = np.floor(first / reach)
            yield pa.record_batch([*batch.columns, *(pa.array(cells[:, k]) for k in range(CELL_DIMS))], names=[*batch.schema.names, *(f"c{k}" for k in range(CELL_DIMS))])

    kinds = reps.select("*", *[F.lit(0).alias(f"c{k}") for k in range(CELL_DIMS)]).schema
    placed = stored(reps.mapInArrow(celled, kinds), "cells")

    # as many coordinates make a label's cells as its size is worth; the others count as 0
    sizes = placed.groupBy("label", "dim").agg(F.count("*").alias("n"))
    used = F.lit(0)
    for k in range(CELL_DIMS):
        used = used + (F.col("n") > 8 * TILE * 8**k).cast("int")
    celled_rows = placed.join(sizes.select("label", "dim", used.alias("used")), ["label", "dim"])
    cell = [F.when(F.col("used") > k, F.col(f"c{k}")).otherwise(0).alias(f"c{k}") for k in range(CELL_DIMS)]
    spot = ["label", "dim", *(f"c{k}" for k in range(CELL_DIMS))]
    celled_rows = celled_rows.select("label", "dim", "rep", "copies", "embedding", "used", *cell)
    counts = stored(celled_rows.groupBy(*spot, "used").agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles")), "cell-counts")
    step = [F.explode(F.when(F.col("used") > k, F.array(*map(F.lit, (-1, 0, 1)))).otherwise(F.array(F.lit(0)))).alias(f"d{k}") for k in range(CELL_DIMS)]
    around = counts.select(*spot, "used")
    for k in range(CELL_DIMS):
        around = around.select("*", step[k])
    around = around.select(*spot, *[(F.col(f"c{k}") + F.col(f"d{k}")).alias(f"n{k}") for k in range(CELL_DIMS)])
    there = counts.select(F.col("label").alias("_label"), F.col("dim").alias("_dim"), *[F.col(f"c{k}").alias(f"_c{k}") for k in range(CELL_DIMS)], "tiles")
    match = (F.col("label") == F.col("_label")) & (F.col("dim") == F.col("_dim"))
    for k in range(CELL_DIMS):
        match = match & (F.col(f"n{k}") == F.col(f"_c{k}"))
    near = around.join(there, match).select(*spot, *[f"n{k}" for k in range(CELL_DIMS)], F.col("tiles").alias("other_tiles"))

    def name(prefix: str, number: Column) -> Column:
        return F.concat_ws(":", *[F.col(f"{prefix}{k}").cast("string") for k in range(CELL_DIMS)], number.cast("string"))

    own_tiles = counts.select(*spot, "tiles")
    tiled = celled_rows.drop("used").join(own_tiles, spot).withColumn("tile", name("c", F.pmod("rep", "tiles"))).drop("tiles")
    sent = tiled.join(near, spot).withColumn("u", F.explode(F.sequence(F.lit(0), F.col("other_tiles") - 1))).withColumn("other", name("n", F.col("u")))
    sent = sent.select("label", "dim", F.least("tile", "other").alias("first"), F.greatest("tile", "other").alias("second"), "tile", "rep", "copies", "embedding")
    found = sent.groupBy("label", "dim", "first", "second").applyInArrow(_tile_links(shipped, threshold), "a bigint, b bigint, links bigint")
    found = stored(found, "vector-links")

    counted = found.where("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    ids = keyed.where("usable").select("vec_id", F.xxhash64("label", "dim", "key1", "key2").alias("rep"))
    totals = placed.select("rep", "copies", "least").join(counted, "rep", "left").select("rep", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    # vectors are linked by their least ids, so that rows that share an id share a component
    least = placed.select("rep", "least")
    edges = found.where("b is not null").join(least.toDF("a", "x"), "a").join(least.toDF("b", "y"), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    own = ids.join(least, "rep")
    more = own.where("vec_id != least").select(F.col("vec_id").alias("a"), F.col("least").alias("b"))
    roots = components(edges.unionByName(more))
    result = keyed.select("vec_id", "usable", F.xxhash64("label", "dim", "key1", "key2").alias("rep"))
    result = result.join(totals.withColumnRenamed("rep", "_rep"), F.col("usable") & (F.col("rep") == F.col("_rep")), "left")
    result = result.join(roots, F.col("vec_id") == F.col("node"), "left")
    component = F.coalesce("root", "vec_id")
    return result.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
