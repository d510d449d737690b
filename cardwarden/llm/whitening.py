"""Whitening of vectors with an exact covariance from bit planes.

An entry becomes an integer, and the integers of a dimension, less the smallest one at hand, are
sliced into bit planes, which are packed across rows into 64-bit words. The scatter of two dimensions is the sum of
2^(p + q) times the number of common bits of plane p of one and plane q of the other, so that
cross-products come exactly from ANDs and bit counts. They are centred as integers, and only
then become floating-point numbers for the eigenvectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.llm.naming import unused
from cardwarden.llm.storage import stored

#: An entry c becomes floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 64, 1_000_000
#: Entries beyond this are taken as this, so that every integer fits into 64 bits.
LIMIT = 2.0**55
#: Rows whose planes are held at a time, as a multiple of 64.
CHUNK = 1 << 14
COMPONENTS = 16
#: An eigenvalue of no more than this times the largest is none: its component isn't whitened.
RELATIVE_ZERO = 1e-12
#: Exact integers travel as sums of 2^(LIMB * k) times their k-th part.
LIMB, LIMBS = 40, 4


def _integers(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries of the usable vectors as integers one after the other, which vectors those are, and their lengths."""
    sizes = pa.compute.fill_null(pa.compute.list_value_length(column), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    ends = np.cumsum(np.maximum(sizes, 0))
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    good = (sizes >= 0) & (bad[ends] == bad[ends - np.maximum(sizes, 0)])
    used = values[np.repeat(good, np.maximum(sizes, 0))]
    return np.floor(np.clip(used, -LIMIT, LIMIT) * SCALE).astype(np.int64) + OFFSET, good, sizes


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The integer vectors of a column of vectors, as bytes: width and little-endian differences to the offset."""
    for batch in batches:
        flat, good, sizes = _integers(batch.column("embedding"))
        ends = np.cumsum(sizes[good])
        moved = flat - OFFSET
        small = np.abs(moved)
        rows, dims = [], []
        for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True):
            if b > a:
                top = small[a:b].max()
                kind = "<i1" if top < 1 << 7 else "<i2" if top < 1 << 15 else "<i4" if top < 1 << 31 else "<i8"
                rows.append(kind[-1:].encode() + moved[a:b].astype(kind).tobytes())
                dims.append(b - a)
        yield pa.record_batch([pa.array(dims, pa.int32()), pa.array(rows, pa.binary())], names=["dim", "packed"])


def _unpacked(rows: list[bytes], dim: int) -> np.ndarray:
    out = np.empty((len(rows), dim), np.int64)
    for kind in {r[:1] for r in rows}:
        own = [i for i, r in enumerate(rows) if r[:1] == kind]
        out[own] = np.frombuffer(b"".join(rows[i][1:] for i in own), f"<i{kind.decode()}").reshape(len(own), dim)
    return out


def bit_planes(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bit planes of the columns of non-negative integers, packed into words: an array (dimensions, planes, words)."""
    planes = max(1, int(rows.max(initial=0)).bit_length())
    filled = np.zeros((-(-len(rows) // 64) * 64, rows.shape[1]), np.uint64)
    filled[: len(rows)] = rows
    bits = np.stack([(filled >> np.uint64(p)) & np.uint64(1) for p in range(planes)], axis=1).astype(np.uint8)
    return np.ascontiguousarray(np.packbits(bits, axis=0).transpose(2, 1, 0)).view(np.uint64)


def bit_sliced_scatter(rows: np.ndarray) -> np.ndarray:
    """Sums of products of each two columns of non-negative integers, exactly, as Python integers."""
    planes = bit_planes(rows)
    dim, depth = planes.shape[:2]
    flat = planes.reshape(dim * depth, -1)
    total = np.zeros((dim, dim), object if 2 * depth + len(rows).bit_length() > 62 else np.int64)
    weight = np.array([1 << p for p in range(depth)], total.dtype)
    for i in range(dim):
        for p in range(depth):
            common = np.bitwise_count(flat[i * depth + p] & flat[i * depth :]).sum(axis=1, dtype=np.int64)
            total[i, i:] += (common.reshape(-1, depth).astype(total.dtype) * weight).sum(axis=1) * weight[p]
    lower = np.tril_indices(dim, -1)
    total[lower] = total.T[lower]
    return total.astype(object)


def _limbs(values: list[int]) -> list[np.ndarray]:
    """The parts of integers; the last one has the sign."""
    parts = [[v >> (LIMB * k) & ((1 << LIMB) - 1) for v in values] for k in range(LIMBS - 1)]
    return [np.array(p, np.int64) for p in [*parts, [v >> (LIMB * (LIMBS - 1)) for v in values]]]


def _scatters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each length of vector: number, sums (j is -1) and cross-products (i <= j) of a task's integers less the offset."""
    sums: dict[int, tuple[int, np.ndarray, np.ndarray]] = {}

    def take(dim: int, rows: list[bytes]) -> None:
        moved = _unpacked(rows, dim)
        low = moved.min(axis=0)
        raised = (moved.astype(object) - low).astype(np.uint64) if int(moved.max()) - int(moved.min()) >= 1 << 62 else (moved - low).astype(np.uint64)
        low, each = low.astype(object), raised.astype(object).sum(axis=0) if raised.max(initial=0) >= 1 << 48 else raised.sum(axis=0, dtype=np.uint64).astype(object)
        n = len(rows)
        cross = bit_sliced_scatter(raised) + np.outer(low, each) + np.outer(each, low) + n * np.outer(low, low)
        before = sums.get(dim, (0, 0, 0))
        sums[dim] = (before[0] + n, before[1] + each + n * low, before[2] + cross)

    held: dict[int, list[bytes]] = {}
    for batch in batches:
        for dim, row in zip(batch.column("dim").to_pylist(), batch.column("packed").to_pylist(), strict=True):
            held.setdefault(dim, []).append(row)
            if len(held[dim]) == CHUNK:
                take(dim, held.pop(dim))
    for dim, rows in held.items():
        take(dim, rows)
    for dim, (n, each, cross) in sums.items():
        i, j = np.triu_indices(dim)
        values = [n, *each.tolist(), *cross[i, j].tolist()]
        where = [np.concatenate([[-1], np.arange(dim), i]), np.concatenate([[-1], np.full(dim, -1), j])]
        columns = [np.full(len(values), dim), *where, *_limbs(values)]
        yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=["dim", "i", "j", *(f"limb{k}" for k in range(LIMBS))])


@dataclass
class Model:
    """Whitening of vectors of one length: fitted vectors, sums of x, components as columns, their eigenvalues and shares."""

    n: int
    sums: list[int]
    components: np.ndarray
    values: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exactly; an array of Python integers where 64 bits may not do."""
        wide = self.n * max(int(np.abs(x).max(initial=0)), 1) + max(map(abs, self.sums), default=0) >= 1 << 62
        return x.astype(object) * self.n - np.array(self.sums, object) if wide else x * self.n - np.array(self.sums, np.int64)

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        """Rows projected on the components, over the roots of the eigenvalues; nan where there is no variance."""
        with np.errstate(divide="ignore", invalid="ignore"):
            scale = np.where(self.values > 0, 1 / np.sqrt(self.values), np.nan)
        return (centred.astype(np.float64) / self.n) @ self.components * scale


def _model(n: int, moved_sums: list[int], moved_cross: np.ndarray) -> Model:
    """The model from sums of the integers less the offset, which changes no covariance."""
    centred = n * moved_cross - np.outer(np.array(moved_sums, object), np.array(moved_sums, object))
    cov = np.array([[v / (n * n) for v in row] for row in centred.tolist()], np.float64)
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(-values, kind="stable")[:COMPONENTS]
    vectors, trace = vectors[:, order], float(np.trace(cov))
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))] < 0, -1, 1)
    top = np.where(values[order] > RELATIVE_ZERO * max(values.max(initial=0), 0), values[order], 0.0)
    shares = top / trace if trace > 0 else np.full(len(top), np.nan)
    return Model(n, [s + n * OFFSET for s in moved_sums], vectors, top, shares)


def _moments(shipped):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums of the whitened values of a task's fitted vectors (i is -1) and of their products."""
        models = {d: Model(**m) for d, m in shipped.value.items()}
        sums: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                own = batch.column("packed").take(pa.array(np.flatnonzero(dims == dim))).to_pylist()
                model = models[dim]
                w = model.whitened(model.centred(_unpacked(own, dim) + OFFSET))
                part = [w.sum(axis=0), w.T @ w]
                sums[dim] = [a + b for a, b in zip(sums[dim], part, strict=True)] if dim in sums else part
        for dim, (each, cross) in sums.items():
            k = len(each)
            i, j = (np.concatenate([a, b.ravel()]) for a, b in zip((np.full(k, -1), np.arange(k)), np.indices((k, k)), strict=True))
            yield pa.record_batch([pa.array(np.full(len(i), dim)), pa.array(i), pa.array(j), pa.array(np.concatenate([each, cross.ravel()]))], names=["dim", "i", "j", "sum"])

    return rows


def _identity_errors(fit: DataFrame, models: dict[int, Model], shipped) -> dict[int, float]:
    """Largest deviation of the whitened fit list's covariance from the identity, for components with variance."""
    moments = fit.mapInArrow(_moments(shipped), "dim bigint, i bigint, j bigint, sum double").groupBy("dim", "i", "j").agg(F.sum("sum")).collect()
    by_dim: dict[int, dict] = {}
    for dim, i, j, value in moments:
        by_dim.setdefault(dim, {})[i, j] = value
    errors = {}
    for dim, found in by_dim.items():
        n, some = models[dim].n, np.flatnonzero(models[dim].values > 0).tolist()
        errors[dim] = max((abs(found[i, j] / n - found[-1, i] / n * found[-1, j] / n - (i == j)) for i in some for j in some), default=0.0)
    return errors


def fit_list(vectors: DataFrame) -> DataFrame:
    """Each distinct integer vector once, as (dim, packed). Partial aggregation takes the weight out of frequent ones."""
    return vectors.select("embedding").mapInArrow(_packed, "dim int, packed binary").distinct()


def fit(fitted: DataFrame) -> dict[int, Model]:
    """A model for each length of vector, from the rows of ``fit_list``.

    A task sends one row for each two dimensions, and Spark adds them up, so that the driver gets
    as many numbers as the covariance has, whatever the size of the table.
    """
    limbs = [f"limb{k}" for k in range(LIMBS)]
    kinds = ", ".join(f"{c} bigint" for c in ("dim", "i", "j", *limbs))
    rows = fitted.mapInArrow(_scatters, kinds).groupBy("dim", "i", "j").agg(*[F.sum(c) for c in limbs]).collect()
    values: dict[int, dict] = {}
    for dim, i, j, *parts in rows:
        values.setdefault(dim, {})[i, j] = sum(p << (LIMB * k) for k, p in enumerate(parts))
    models = {}
    for dim, own in values.items():
        cross = np.zeros((dim, dim), object)
        for (i, j), v in own.items():
            if j >= 0:
                cross[i, j] = cross[j, i] = v
        models[dim] = _model(own[-1, -1], [own[i, -1] for i in range(dim)], cross)
    return models


def _applied(shipped, columns: list[str], made: str):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = {d: Model(**m) for d, m in shipped.value.items()}
        for batch in batches:
            flat, good, sizes = _integers(batch.column("embedding"))
            at = np.flatnonzero(good)
            starts = np.cumsum(sizes[at]) - sizes[at]
            out: list[dict | None] = [None] * len(at)
            for dim in np.unique(sizes[at]).tolist():
                own = np.flatnonzero(sizes[at] == dim)
                if dim == 0:
                    for i in own.tolist():
                        out[i] = {"dim": 0, "n": 0, "deviation": "0", "whitened": [], "explained": [], "identity_error": None}
                    continue
                model = models[dim]
                centred = model.centred(flat[starts[own][:, None] + np.arange(dim)])
                wide = centred.dtype == object or dim * float(np.abs(centred).max(initial=0)) ** 2 >= 2.0**62
                deviation = ((centred.astype(object) if wide else centred) ** 2).sum(axis=1)
                shares = [None if np.isnan(s) else s for s in model.explained.tolist()]
                for i, total, values in zip(own.tolist(), deviation.tolist(), model.whitened(centred).tolist(), strict=True):
                    values = [None if v != v else v for v in values]
                    out[i] = {"dim": dim, "n": model.n, "deviation": str(total), "whitened": values, "explained": shares, "identity_error": model.identity_error}
            kept = batch.select(columns).take(pa.array(at))
            kind = pa.struct([("dim", pa.int32()), ("n", pa.int64()), ("deviation", pa.string()), ("whitened", pa.list_(pa.float64())), ("explained", pa.list_(pa.float64())), ("identity_error", pa.float64())])
            yield pa.record_batch([*kept.columns, pa.array(out, kind)], names=[*columns, made])

    return rows


def whitened(vectors: DataFrame) -> DataFrame:
    """The rows with a usable vector, with ``whitening``, a struct of dim, n, deviation, whitened, explained and identity_error.

    ``vectors`` has a column embedding, an array of float or double; an extra column of the name ``whitening`` is
    replaced, others are kept. Rows whose vector is null or holds null or a non-finite number
    go. An entry c counts as floor(64 * c) + 1000000; entries beyond 2^55 count as 2^55. Vectors
    of different lengths are fitted apart. The fit list has each distinct integer vector once.

    ``whitened`` has a value for each of the first 16 components, by falling eigenvalue; the
    entry of largest size of a component is positive. A component without variance has null
    instead, also where there is one distinct vector only; ``explained`` is null where nothing
    varies. ``deviation``, exact, is text, since it outgrows 64 bits. An empty vector has no
    components. An empty table stays empty.
    """
    spark = vectors.sparkSession
    fitted = stored(fit_list(vectors), "fit-list")
    models = fit(fitted)
    plain = lambda: {d: m.__dict__ for d, m in models.items()}
    errors = _identity_errors(fitted, models, spark.sparkContext.broadcast(plain()))
    for dim, error in errors.items():
        models[dim].identity_error = error
    kept = [c for c in vectors.columns if c != "whitening"]
    (made,) = unused(vectors.drop("whitening"), "_whitening")
    kind = "struct<dim:int,n:bigint,deviation:string,whitened:array<double>,explained:array<double>,identity_error:double>"
    schema = vectors.select(*kept, F.lit(None).cast(kind).alias(made)).schema
    rows = vectors.select(*kept).mapInArrow(_applied(spark.sparkContext.broadcast(plain()), kept, made), schema)
    return rows.withColumnRenamed(made, "whitening")
