"""Language of texts, also mixed ones, by a linear-chain conditional random field over words.

Each word's emission is the sum of learned weights of its affixes, its character n-grams (all
hashed bytes), itself, and the lexicons that hold it; learned transitions link neighbouring words. The forward
and backward passes give each word the probabilities of the languages, and a text has the
language with the largest expected share of its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.llm.learning import Adagrad, fitted, labelled_sample
from cardwarden.llm.words import LETTER, Words, bucket, filled, runs, slices

BITS = 16
#: Bytes of the prefixes (above 0) and suffixes (below 0), and of the n-grams inside words.
AFFIXES, NGRAM = (2, 4, -2, -4), 3
#: A lexicon holds the words that occur so often in the sample, nearly always in one language.
LEXICON_COUNT, LEXICON_SHARE = 5, 0.95
#: Labelled rows that the model is fitted on at most, as many of each language as there are, and their characters in all.
SAMPLE_ROWS, SAMPLE_CHARS = 2000, 8_000_000
#: Words of a training sequence; every second one is made of two texts, as in code-switching.
SEQUENCE, EPOCHS, BATCH, RATE = 32, 2, 128, 0.1
#: Words that are passed over one by one, for all stretches of all texts at a time.
STRETCH = 64
SLICE_BYTES = 2 << 20
UNKNOWN = "und"


def word_features(words: Words, lexicon: tuple[np.ndarray, np.ndarray], languages: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of the distinct words: flat, where each one's start, and the distinct word of each word.

    Features below 2^BITS are hashed; those from there on stand for the lexicon that holds the
    word, the last one for none.
    """
    _, first, inverse = np.unique(words.hash, return_index=True, return_inverse=True)
    hashes = [words.hash[first], *words.affixes(first, AFFIXES)]
    fixed = [bucket(h, k, BITS) for k, h in enumerate(hashes)]
    known, member = lexicon
    at = np.searchsorted(known, words.hash[first])
    inside = at < len(known)
    inside[inside] = known[at[inside]] == words.hash[first][inside]
    which = np.full(len(first), languages, np.int64)
    which[inside] = member[at[inside]]
    fixed.append((1 << BITS) + which)
    fixed = np.stack(fixed, axis=1)
    grams = np.maximum(0, words.end[first] - words.start[first] - NGRAM + 1)
    starts = np.concatenate([[0], np.cumsum(grams)])
    place = np.arange(starts[-1]) + np.repeat(words.start[first] - starts[:-1], grams)
    inner = bucket(words.hashes.of(place, place + NGRAM), 50, BITS)
    per_word = fixed.shape[1] + grams
    begin = np.concatenate([[0], np.cumsum(per_word)])
    flat = np.empty(begin[-1], np.int64)
    flat[(begin[:-1, None] + np.arange(fixed.shape[1])).ravel()] = fixed.ravel()
    flat[np.arange(starts[-1]) + np.repeat(begin[:-1] + fixed.shape[1] - starts[:-1], grams)] = inner
    return flat, begin, inverse


def posteriors(emission: np.ndarray, transition: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Probabilities of the languages of every word, by forward-backward over each text's words.

    Texts are cut into stretches. The product of a stretch's matrices carries both passes over
    it, so that only the stretches of a text follow each other, and the words of all stretches
    are passed over side by side.
    """
    n, k = emission.shape
    if n == 0:
        return np.zeros((0, k))
    move = np.exp(transition - transition.max())
    counts = -(-np.diff(at) // STRETCH)
    text_at = np.concatenate([[0], np.cumsum(counts)])
    order = np.arange(text_at[-1]) - np.repeat(text_at[:-1], counts)
    start = np.repeat(at[:-1], counts) + order * STRETCH
    size = np.minimum(STRETCH, np.repeat(at[1:], counts) - start)
    by_size = np.argsort(-size, kind="stable")  # so that those that go on are the first ones
    size, rank = size[by_size], np.empty(len(size), np.int64)
    rank[by_size] = np.arange(len(size))
    active = [int(x) for x in np.searchsorted(-size, -np.arange(STRETCH), side="left")]
    places = [start[by_size[: active[t]]] + t for t in range(STRETCH)]
    odds = np.exp(emission - emission.max(axis=1, keepdims=True))
    odds = [odds[p] for p in places]
    product = np.tile(np.eye(k), (len(start), 1, 1))
    for t, m in enumerate(active):
        product[:m] = (product[:m].reshape(-1, k) @ move).reshape(m, k, k) * odds[t][:, None, :]
        if t % 4 == 3:
            product[:m] /= product[:m].max(axis=(1, 2), keepdims=True)
    forward, backward = np.ones((len(start), k)), np.ones((len(start), k))
    for j in range(1, int(counts.max())):
        own = text_at[:-1][counts > j] + j
        forward[rank[own]] = _unit(np.einsum("si,sij->sj", forward[rank[own - 1]], product[rank[own - 1]]))
        own = text_at[1:][counts > j] - 1 - j
        backward[rank[own]] = _unit(np.einsum("sij,sj->si", product[rank[own + 1]], backward[rank[own + 1]]))
    alpha = []
    for t, m in enumerate(active):
        forward[:m] = _unit((forward[:m] @ move) * odds[t])
        alpha.append(forward[:m].copy())
    out = np.empty((n, k))
    for t in range(STRETCH - 1, -1, -1):
        m = active[t]
        out[places[t]] = alpha[t] * backward[:m]
        backward[:m] = _unit((backward[:m] * odds[t]) @ move.T)
    return _unit(out)


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(rows.sum(axis=-1, keepdims=True), 1e-300)


def _lexicon(hashes: np.ndarray, labels: np.ndarray, languages: int) -> tuple[np.ndarray, np.ndarray]:
    known, inverse = np.unique(hashes, return_inverse=True)
    counts = np.bincount(inverse * languages + labels, minlength=len(known) * languages).reshape(-1, languages)
    total = counts.sum(axis=1)
    chosen = (total >= LEXICON_COUNT) & (counts.max(axis=1, initial=0) >= LEXICON_SHARE * total)
    return known[chosen], counts[chosen].argmax(axis=1)


def fit(texts: pa.Array, labels: list) -> tuple:
    """Languages, weights of the features, transitions and lexicon, by maximum conditional likelihood.

    Every word of a training text has the text's label. Sequences of words are cut from the
    texts; half of them are spliced from two, so that transitions between languages occur.
    """
    languages = sorted(set(labels))
    k = len(languages)
    if len(texts) == 0:
        return [], np.zeros((0, 0), np.float32), np.zeros((0, 0)), (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    number = {name: i for i, name in enumerate(languages)}
    words = Words(texts, LETTER)
    label = np.array([number[x] for x in labels], np.int64)[words.text_of()]
    lexicon = _lexicon(words.hash, label, k)
    flat, begin, inverse = word_features(words, lexicon, k)
    weights = np.zeros(((1 << BITS) + k + 1, k))
    transition = np.zeros((k, k))
    steps, moves = Adagrad(weights, RATE), Adagrad(transition, RATE)
    draw = np.random.default_rng(21)
    whole = len(words.hash) // SEQUENCE * SEQUENCE
    sequences = np.arange(whole).reshape(-1, SEQUENCE)
    cut = np.arange(SEQUENCE) < SEQUENCE // 2
    for _ in range(EPOCHS if whole else 0):
        order = draw.permutation(len(sequences))
        for chosen in np.array_split(order, max(1, len(order) // BATCH)):
            rows = sequences[chosen]
            spliced = rows[draw.permutation(len(rows))]
            mixed = (np.arange(len(rows)) % 2 == 1)[:, None] & cut
            rows = np.where(mixed, spliced, rows)
            _step(rows, label[rows], flat, begin, inverse, steps, moves)
    return languages, weights.astype(np.float32), transition, lexicon


def _step(rows: np.ndarray, truth: np.ndarray, flat: np.ndarray, begin: np.ndarray, inverse: np.ndarray, steps: Adagrad, moves: Adagrad) -> None:
    """One gradient step of the log-likelihood for some sequences of the same length."""
    n, length = rows.shape
    k = moves.weights.shape[0]
    used, where = np.unique(inverse[rows], return_inverse=True)
    where = where.reshape(rows.shape)
    sizes = begin[used + 1] - begin[used]
    at = np.concatenate([[0], np.cumsum(sizes)])
    features = flat[np.arange(at[-1]) + np.repeat(begin[used] - at[:-1], sizes)]
    emission = runs(steps.weights[features], at)[where]
    odds = np.exp(emission - emission.max(axis=2, keepdims=True))
    move = np.exp(moves.weights - moves.weights.max())
    alpha, beta = np.empty((length, n, k)), np.ones((length, n, k))
    alpha[0] = _unit(move.sum(axis=0) * odds[:, 0])
    for t in range(1, length):
        alpha[t] = _unit((alpha[t - 1] @ move) * odds[:, t])
    for t in range(length - 2, -1, -1):
        beta[t] = _unit((beta[t + 1] * odds[:, t + 1]) @ move.T)
    marginal = _unit(alpha * beta).transpose(1, 0, 2)
    pairs = np.zeros((k, k))
    for t in range(1, length):
        joint = alpha[t - 1][:, :, None] * move * (odds[:, t] * beta[t])[:, None, :]
        pairs += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
    np.add.at(pairs, (truth[:, :-1].ravel(), truth[:, 1:].ravel()), -1.0)
    marginal[np.arange(n)[:, None], np.arange(length), truth] -= 1.0
    by_word = np.stack([np.bincount(where.ravel(), weights=marginal[:, :, j].ravel(), minlength=len(used)) for j in range(k)], axis=1)
    distinct, spot = np.unique(features, return_inverse=True)
    spread = np.repeat(np.arange(len(used)), sizes)
    gradient = np.stack([np.bincount(spot, weights=by_word[spread, j], minlength=len(distinct)) for j in range(k)], axis=1)
    steps.step(distinct, gradient / n)
    moves.step(slice(None), pairs / n)


def word_languages(column: pa.Array, model: tuple) -> tuple[Words, np.ndarray]:
    """Words of the texts, and the probabilities of the learned languages for each one."""
    languages, weights, transition, lexicon = model
    words = Words(column, LETTER)
    flat, begin, inverse = word_features(words, lexicon, len(languages))
    emission = runs(weights[flat].astype(np.float64), begin)[inverse]
    return words, posteriors(emission, transition, words.at)


def with_language(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents' columns and ``language``, a struct of predicted, score and shares.

    ``docs`` has doc_id and text, ``labels`` (doc_id, lang) the rows to learn from; of several
    languages for one document the first by name counts, null ones don't. An extra column
    ``language`` is replaced, others are kept. ``predicted`` is ``und``, with score 0 and no shares, if the
    text is null or has no letter, or if nothing could be learned; of equal shares the first
    language by name wins. ``score`` is the predicted language's expected share of the words,
    ``shares`` has those of all languages. Repeated documents get the same.

    The model is fitted on at most ``SAMPLE_ROWS`` labelled rows; every row is predicted from
    its whole text, in its task.
    """
    known = labels.where("lang is not null").groupBy("doc_id").agg(F.min("lang").alias("label"))
    model = docs.sparkSession.sparkContext.broadcast(fitted(fit, labelled_sample(docs, known, SAMPLE_ROWS, SAMPLE_CHARS, per_label=True)))
    columns = [c for c in docs.columns if c != "language"]
    kind = "struct<predicted: string, score: double, shares: map<string, double>>"

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages = model.value[0]
        for batch in slices(batches, "text", SLICE_BYTES):
            texts = filled(batch.column("text"))
            if languages:
                words, each = word_languages(texts, model.value)
                shares = _unit(runs(each, words.at))
                lettered = pa.compute.match_substring_regex(texts, r"\p{L}").to_numpy(zero_copy_only=False) & (np.diff(words.at) > 0)
            else:
                shares, lettered = np.zeros((batch.num_rows, 1)), np.zeros(batch.num_rows, bool)
            best = shares.argmax(axis=1)
            names = [languages[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), lettered.tolist(), strict=True)]
            score = np.where(lettered, np.minimum(1.0, shares.max(axis=1)), 0.0)
            maps = pa.array([list(zip(languages, row, strict=True)) if ok else [] for row, ok in zip(shares.tolist(), lettered.tolist(), strict=True)], pa.map_(pa.string(), pa.float64()))
            made = pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(score), maps], ["predicted", "score", "shares"])
            yield pa.record_batch([*[batch.column(c) for c in columns], made], names=[*columns, "language"])

    rows = docs.select(*columns)
    return rows.mapInArrow(predicted, rows.withColumn("language", F.lit(None).cast(kind)).schema)
