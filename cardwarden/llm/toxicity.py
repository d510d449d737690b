"""Toxicity by multiple-instance learning: documents have labels, sentences get scores.

A sentence's score is logistic in the hashed words and affixes that it holds. A document is
toxic unless each of its sentences is harmless (noisy-or), and the weights are fitted to the
documents' labels through that. What made a document toxic can so be located.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.llm.learning import Adagrad, Ftrl, fitted, labelled_sample, sigmoid, softplus
from cardwarden.llm.words import LETTER, Words, bucket, filled, runs, slices

BITS = 18
#: Bytes of the prefixes (above 0) and suffixes (below 0) that count besides the word.
AFFIXES = (5, 7)
#: Documents with at least this score are toxic.
THRESHOLD = 0.3
#: Labelled rows that the model is fitted on at most, and their characters in all.
SAMPLE_ROWS, SAMPLE_CHARS = 8000, 32_000_000
EPOCHS, BATCH, RATE, SPARSE, SHRINK, BIAS_RATE = 10, 8, 1.0, 2.0, 0.1, 0.05
#: Bytes of text worked on at a time.
SLICE_BYTES = 2 << 20

_ENDS = np.zeros(256, bool)
_ENDS[[0x0A, 0x0D, *b".!?"]] = True


class Sentences:
    """Sentences of a column of texts, which end at . ! ? or a line break; only those with a letter.

    ``word_at`` and ``at`` bound each sentence's words and each text's sentences. A sentence's
    first and last byte are those of its words.
    """

    def __init__(self, column: pa.Array):
        self.words = words = Words(column, LETTER)
        ends = np.concatenate([[0], np.cumsum(_ENDS[words.data])])
        number = ends[words.start] + words.text_of()
        first = np.ones(len(number), bool)
        first[1:] = np.diff(number) != 0
        starts = np.flatnonzero(first)
        self.word_at = np.concatenate([starts, [len(number)]])
        self.at = np.searchsorted(starts, words.at)
        self.start, self.end = words.start[starts], words.end[self.word_at[1:] - 1]


def _vocabulary(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each distinct word, and the distinct word of each word."""
    _, first, inverse = np.unique(words.hash, return_index=True, return_inverse=True)
    hashes = [words.hash[first], *words.affixes(first, AFFIXES)]
    return np.stack([bucket(h, k, BITS) for k, h in enumerate(hashes)], axis=1), inverse


def fit(texts: pa.Array, labels: list) -> tuple[np.ndarray, float]:
    """Weights of the buckets and the score of a sentence without any.

    Without labels of both kinds there are no weights, and every score is about 0.
    """
    y = np.array([int(v) > 0 for v in labels], bool)
    if not (y.any() and (~y).any()):
        return np.zeros(1 << BITS, np.float32), -20.0
    features, inverse, sizes, counts = _sample_features(texts)
    sentence_at, starts = (np.concatenate([[0], np.cumsum(x)]) for x in (counts, sizes))
    model = Ftrl(1 << BITS, RATE, SPARSE, SHRINK)
    bias = np.array([np.log(y.mean() / max(1.0, len(sizes) / len(y)))])
    shift = Adagrad(bias, BIAS_RATE)
    draw = np.random.default_rng(5)
    for _ in range(EPOCHS):
        for chosen in np.array_split(draw.permutation(len(y)), max(1, len(y) // BATCH)):
            own = _ranges(sentence_at[chosen], counts[chosen])
            if len(own) == 0:
                continue
            buckets = features[inverse[_ranges(starts[own], sizes[own])]]
            at = np.concatenate([[0], np.cumsum(counts[chosen])])
            word_at = np.concatenate([[0], np.cumsum(sizes[own])])
            z = runs(model.weights[buckets].sum(axis=1), word_at) + bias[0]
            harmless = runs(softplus(z), at)  # minus the log of the probability that all sentences are
            pull = np.where(y[chosen], np.exp(-harmless) / np.maximum(-np.expm1(-harmless), 1e-9), -1.0)
            gradient = -np.repeat(pull, counts[chosen]) * sigmoid(z)
            used, where = np.unique(buckets, return_inverse=True)
            by_word = np.repeat(gradient, sizes[own])
            model.step(used, np.bincount(where.ravel(), weights=np.repeat(by_word, buckets.shape[1]), minlength=len(used)))
            shift.step(slice(None), np.array([gradient.sum()]))
    return model.weights.astype(np.float32), float(bias[0])


def _sample_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of distinct words, the distinct word of each word, words of each sentence, sentences of each text."""
    parts, known = [], 0
    for piece in slices([pa.record_batch([texts], ["text"])], "text", SLICE_BYTES):
        sentences = Sentences(piece.column(0))
        features, inverse = _vocabulary(sentences.words)
        parts.append((features.astype(np.int32), (inverse + known).astype(np.int32), np.diff(sentences.word_at), np.diff(sentences.at)))
        known += len(features)
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as counted, one stretch after the other."""
    before = np.cumsum(counts) - counts
    return np.arange(counts.sum()) + np.repeat(starts - before, counts)


def score(sentences: Sentences, weights: np.ndarray, bias: float) -> tuple[np.ndarray, np.ndarray]:
    """Score of each text and of each sentence."""
    features, inverse = _vocabulary(sentences.words)
    by_word = weights[features].sum(axis=1, dtype=np.float64)[inverse]
    z = runs(by_word, sentences.word_at) + bias
    return -np.expm1(-runs(softplus(z), sentences.at)), sigmoid(z)


def with_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents' columns and ``toxicity``, a struct of score, predicted and sentences.

    ``docs`` has doc_id and text, ``labels`` (doc_id, toxic) the rows to learn from; a document with several
    labels counts as toxic if one says so, null labels don't count. An extra column ``toxicity`` is
    replaced, others are kept. ``sentences`` has start (byte), text and score of every sentence
    that alone would make its document toxic, in order. A text that is null or has no letter has
    score 0. Repeated documents score alike. Without labels of both kinds every score is about 0.

    The model is fitted on at most ``SAMPLE_ROWS`` labelled rows; every row is scored, in its task.
    """
    known = labels.where("toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("label"))
    model = docs.sparkSession.sparkContext.broadcast(fitted(fit, labelled_sample(docs, known, SAMPLE_ROWS, SAMPLE_CHARS)))
    columns = [c for c in docs.columns if c != "toxicity"]
    kind = "struct<score: double, predicted: int, sentences: array<struct<start: bigint, text: string, score: double>>>"

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_BYTES):
            sentences = Sentences(filled(batch.column("text")))
            whole, each = score(sentences, *model.value)
            bad = np.flatnonzero(each >= threshold)
            data = sentences.words.data
            base = sentences.words.offsets[np.searchsorted(sentences.words.offsets, sentences.start[bad], side="right") - 1]
            located = pa.StructArray.from_arrays(
                [
                    pa.array(sentences.start[bad] - base, pa.int64()),
                    pa.array([data[a:b].tobytes().decode() for a, b in zip(sentences.start[bad], sentences.end[bad], strict=True)], pa.string()),
                    pa.array(each[bad], pa.float64()),
                ],
                ["start", "text", "score"],
            )
            lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(bad, sentences.at), pa.int32()), located)
            made = pa.StructArray.from_arrays([pa.array(whole), pa.array((whole >= threshold).astype(np.int32)), lists], ["score", "predicted", "sentences"])
            yield pa.record_batch([*[batch.column(c) for c in columns], made], names=[*columns, "toxicity"])

    rows = docs.select(*columns)
    return rows.mapInArrow(scored, rows.withColumn("toxicity", F.lit(None).cast(kind)).schema)


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below the threshold, with their own columns."""
    return with_toxicity(docs, labels, threshold).where("toxicity.predicted = 0").select(*docs.columns)
