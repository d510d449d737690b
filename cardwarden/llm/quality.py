"""Quality grades by ordinal regression on hashed text.

One set of weights gives every text a place on a line, and ordered thresholds cut the line into
grades: the probability of a grade of at least k is logistic in the place less threshold k. The
place is the damped sum of the weights of a text's tokens, each of which has its word, its shape (runs of
letters, digits, capitals and single signs), the pair with the shape before it, and whether it
repeats the token before it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.llm.learning import Ftrl, fitted, labelled_sample, sigmoid
from cardwarden.llm.words import SOLID, ByteHashes, Words, bucket, filled, runs, slices

BITS = 18
#: Labelled rows that the model is fitted on at most, and their characters in all.
SAMPLE_ROWS, SAMPLE_CHARS = 8000, 32_000_000
EPOCHS, BATCH, RATE, SPARSE, SHRINK = 10, 8, 1.0, 1.0, 0.1
#: A text's place is the sum over its tokens divided by this power of their number: a mean would hide a few telling words.
DAMPING = 0.5
#: Rows weigh by this power of how rare their grade is.
BALANCE = 0.5
SLICE_BYTES = 2 << 20

_SHAPES = np.arange(256, dtype=np.uint8)
_SHAPES[0x30:0x3A] = ord("0")
_SHAPES[0x41:0x5B] = 1  # ASCII letters are told apart by case, and hashes ignore it
_SHAPES[0x61:0x7B] = 2
_SHAPES[0x80:] = 2


def token_buckets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of every token, one column for each kind of feature, and where each text's tokens start."""
    words = Words(column, SOLID)
    n = len(words.hash)
    if n == 0:
        return np.zeros((0, 4), np.int64), words.at
    shapes = _SHAPES[words.data]
    kept = np.ones(len(shapes), bool)
    kept[1:] = shapes[1:] != shapes[:-1]
    kept[words.start] = True
    place = np.concatenate([[0], np.cumsum(kept)])
    shape = ByteHashes(shapes[kept]).of(place[words.start], place[words.end])
    first = np.zeros(n, bool)
    first[words.at[:-1][np.diff(words.at) > 0]] = True
    before = np.where(first, np.uint64(1), np.roll(shape, 1))
    again = ~first & (words.hash == np.roll(words.hash, 1))
    pair = shape * np.uint64(3) + before
    kinds = (words.hash, shape, pair, again.astype(np.uint64) + np.uint64(7))
    return np.stack([bucket(h, k, BITS) for k, h in enumerate(kinds)], axis=1), words.at


def _damped(sizes: np.ndarray) -> np.ndarray:
    return np.maximum(1, sizes) ** DAMPING


def _places(weights: np.ndarray, buckets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Place of each text; 0 for one without tokens."""
    return runs(weights[buckets].sum(axis=1, dtype=np.float64), at) / _damped(np.diff(at))


def fit(texts: pa.Array, grades: list) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the buckets and the thresholds of grades 1 and up, in ascending order.

    With one grade only, or without rows, there are no weights, and the thresholds make the
    highest known grade (or 0) as good as certain.
    """
    y = np.array([int(g) for g in grades], np.int64)
    top = int(y.max(initial=0))
    if len(np.unique(y)) < 2:
        return np.zeros(1 << BITS, np.float32), np.full(max(1, top), -20.0 if top else 20.0)
    pieces = [token_buckets(p.column(0)) for p in slices([pa.record_batch([texts], ["text"])], "text", SLICE_BYTES)]
    docs = [b[at[i] : at[i + 1]].astype(np.int32) for b, at in pieces for i in range(len(at) - 1)]
    share = np.array([(y >= k).mean() for k in range(1, top + 1)]).clip(1e-3, 1 - 1e-3)
    gaps = -np.log(share / (1 - share))
    thresholds = np.maximum.accumulate(gaps + np.arange(top) * 1e-3)
    weigh = (len(y) / (top + 1) / np.maximum(1, np.bincount(y, minlength=top + 1))) ** BALANCE
    model = Ftrl(1 << BITS, RATE, SPARSE, SHRINK)
    draw, squares = np.random.default_rng(9), np.full(top, 1e-2)
    for _ in range(EPOCHS):
        for chosen in np.array_split(draw.permutation(len(y)), max(1, len(y) // BATCH)):
            own = [docs[i] for i in chosen]
            sizes = np.array([len(x) for x in own])
            buckets = np.concatenate(own)
            place = _places(model.weights, buckets, np.concatenate([[0], np.cumsum(sizes)]))
            above = np.hstack([np.ones((len(own), 1)), sigmoid(place[:, None] - thresholds), np.zeros((len(own), 1))])
            row, grade = np.arange(len(own)), y[chosen]
            low, high = above[row, grade], above[row, grade + 1]  # at least this grade; more than it
            p = np.maximum(low - high, 1e-9)
            slope_low, slope_high = low * (1 - low), high * (1 - high)
            by_place = -(slope_low - slope_high) / p * weigh[grade]
            by_threshold = np.zeros(top + 2)
            np.add.at(by_threshold, grade, slope_low / p * weigh[grade])
            np.add.at(by_threshold, grade + 1, -slope_high / p * weigh[grade])
            used, where = np.unique(buckets, return_inverse=True)
            by_token = np.repeat(by_place / _damped(sizes), sizes)
            model.step(used, np.bincount(where.ravel(), weights=np.repeat(by_token, 4), minlength=len(used)))
            squares += by_threshold[1:-1] ** 2
            thresholds = np.maximum.accumulate(thresholds - 0.1 * by_threshold[1:-1] / np.sqrt(squares) + np.arange(top) * 1e-9)
    return model.weights.astype(np.float32), thresholds


def with_grade(docs: DataFrame, ratings: DataFrame, tail: int = 1) -> DataFrame:
    """The documents' columns and ``grade``, a struct of expected and tail.

    ``docs`` has doc_id and text, ``ratings`` (doc_id, rating) with ratings from 0 up; of several
    for one document the highest counts, null ones don't. An extra column ``grade`` is replaced,
    others are kept. ``expected`` is the expected grade, ``tail`` the probability of a grade of at
    least ``tail``. A null or blank text lies at 0 on the line. Repeated documents get the same.

    The model is fitted on at most ``SAMPLE_ROWS`` rated rows; every row is graded, in its task.
    """
    known = ratings.where("rating is not null").groupBy("doc_id").agg(F.max("rating").alias("label"))
    model = docs.sparkSession.sparkContext.broadcast(fitted(fit, labelled_sample(docs, known, SAMPLE_ROWS, SAMPLE_CHARS)))
    columns = [c for c in docs.columns if c != "grade"]

    def graded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_BYTES):
            weights, thresholds = model.value
            place = _places(weights, *token_buckets(filled(batch.column("text"))))
            above = sigmoid(place[:, None] - thresholds)
            chance = above[:, tail - 1] if tail <= len(thresholds) else np.zeros(len(place))
            made = pa.StructArray.from_arrays([pa.array(above.sum(axis=1)), pa.array(chance)], ["expected", "tail"])
            yield pa.record_batch([*[batch.column(c) for c in columns], made], names=[*columns, "grade"])

    rows = docs.select(*columns)
    return rows.mapInArrow(graded, rows.withColumn("grade", F.lit(None).cast("struct<expected: double, tail: double>")).schema)
