"""What the trained operators share: folds, bounded samples of labelled rows, and gradient steps."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwarden.llm.storage import stored


def fold(doc_id: Column, folds: int) -> Column:
    """Remainder of the CRC-32 of the id as text; null for a null id."""
    return F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % folds


def held_out(doc_id: Column, folds: int, which: int) -> Column:
    return F.coalesce(fold(doc_id, folds) == which, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int, letters: int, per_label: bool = False, seed: int = 3) -> tuple[pa.Array, list]:
    """Whole texts and labels of a bounded sample for fitting a model.

    ``labels`` has (doc_id, label), one row per id. The ``rows`` ids with the smallest seeded
    hash are chosen, with ``per_label`` about as many of each label, so that a rare one isn't
    left out. Of these, the first ones are taken whose texts have ``letters`` characters in all, since the driver must
    hold the sample; texts are neither cut nor chosen by length. Null texts are left out; of
    several rows with one id, one is taken.
    """
    known = labels.where("doc_id is not null and label is not null")
    mark = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 53)).cast("double")
    if per_label:
        counts = known.groupBy("label").agg(F.count("*").alias("_n"))
        known, mark = known.join(counts, "label"), mark * F.col("_n")
    chosen = known.select(F.col("doc_id").alias("_chosen"), F.col("label").alias("_label"), mark.alias("mark")).orderBy("mark", "_chosen").limit(rows)
    found = docs.where("text is not null").select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_chosen"))
    single = found.groupBy("mark", "doc_id").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"), F.first("_label").alias("_label"))
    single = stored(single, "labelled")
    sizes = sorted((r[0], r[1], r[2]) for r in single.select("mark", "doc_id", F.length("text")).collect())
    taken = int(np.searchsorted(np.cumsum([n for _, _, n in sizes]), letters, side="right"))
    if taken == 0:
        return pa.array([], pa.large_string()), []
    last = sizes[taken - 1]
    kept = (F.col("mark") < last[0]) | (F.col("mark") == last[0]) & (F.col("doc_id") <= F.lit(last[1]))
    texts = single.where(kept).toArrow().sort_by([("mark", "ascending"), ("doc_id", "ascending")])
    column = texts["text"].cast(pa.large_string()).combine_chunks()
    return column.chunk(0) if isinstance(column, pa.ChunkedArray) else column, texts["_label"].to_pylist()


def fitted(fit: Callable, sample: tuple[pa.Array, list]):
    """What ``fit`` returns for a sample; the memory that Arrow took for it goes back to the system, as the driver runs on."""
    model = fit(*sample)
    del sample
    pa.default_memory_pool().release_unused()
    return model


class Adagrad:
    """Steps for one array of weights, each weight with a rate of its own."""

    def __init__(self, weights: np.ndarray, rate: float):
        self.weights, self.rate, self.squares = weights, rate, np.full(weights.shape, 1e-8)

    def step(self, at, gradient: np.ndarray) -> None:
        """Changes the weights ``at``, an index without repeats, against the gradient."""
        self.squares[at] += gradient * gradient
        self.weights[at] -= self.rate * gradient / np.sqrt(self.squares[at])


class Ftrl:
    """Follow-the-regularised-leader steps (FTRL-Proximal): a weight stays 0 until its summed gradient exceeds ``sparse``.

    Features of a few documents so get no weight, and the others get rates of their own.
    """

    def __init__(self, n: int, rate: float, sparse: float, shrink: float):
        self.rate, self.sparse, self.shrink = rate, sparse, shrink
        self.weights, self.sums, self.squares = np.zeros(n), np.zeros(n), np.zeros(n)

    def step(self, at: np.ndarray, gradient: np.ndarray) -> None:
        """Takes in the gradient of the weights ``at``, an index without repeats."""
        squares = self.squares[at] + gradient * gradient
        self.sums[at] += gradient - (np.sqrt(squares) - np.sqrt(self.squares[at])) / self.rate * self.weights[at]
        self.squares[at] = squares
        over = np.maximum(np.abs(self.sums[at]) - self.sparse, 0) * -np.sign(self.sums[at])
        self.weights[at] = over / ((1 + np.sqrt(squares)) / self.rate + self.shrink)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def softplus(x: np.ndarray) -> np.ndarray:
    return np.maximum(x, 0) + np.log1p(np.exp(-np.abs(x)))
