"""Benchmark decontamination: suffix arrays of the documents, searched for every suffix of the benchmark.

Each task turns its documents, a shard of some megabytes at a time, into one sequence of word
numbers and sorts its suffixes. Words that no benchmark item has get number 0; no suffix that
begins with one can match, so only the others are sorted. Several word numbers are packed into
one 64-bit key, and suffixes are sorted by as many keys as the longest item needs to be told
apart. Every suffix of every item is then looked up by binary search, all of them at once, and
its matches are extended to the longest verbatim ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.llm.naming import unused
from cardwarden.llm.words import ALNUM, Words, filled, slices

#: Consecutive words that must agree; an item with fewer must occur whole.
WINDOW = 10
#: Bytes of text in a shard.
SHARD_BYTES = 2 << 20
#: Words of benchmark that are searched for at a time; a larger benchmark takes several passes.
BLOCK_WORDS = 1 << 20


@dataclass(frozen=True)
class Benchmark:
    """Items one after the other as word numbers (1, 2, ... in the order of ``vocabulary``), a 0 after each."""

    vocabulary: np.ndarray
    codes: np.ndarray
    item: np.ndarray
    #: For every place: words to compare there, 0 where no window begins.
    need: np.ndarray
    names: list


def benchmark_index(names: list, texts: list, window: int = WINDOW) -> Benchmark:
    words = Words(pa.array([t or "" for t in texts], pa.large_string()), ALNUM)
    vocabulary = np.unique(words.hash)
    counts = np.diff(words.at)
    places = np.arange(len(words.hash)) + np.repeat(np.arange(len(counts)), counts)
    codes = np.zeros(len(words.hash) + len(counts) + 1, np.int64)
    codes[places] = np.searchsorted(vocabulary, words.hash) + 1
    item = np.zeros(len(codes), np.int64)
    item[places] = np.repeat(np.arange(len(counts)), counts)
    left = np.zeros(len(codes), np.int64)
    left[places] = np.repeat(words.at[1:], counts) - np.arange(len(words.hash))
    first = np.zeros(len(codes), bool)
    first[places] = np.arange(len(words.hash)) == np.repeat(words.at[:-1], counts)
    need = np.where(left >= window, window, np.where(first, left, 0))
    return Benchmark(vocabulary, codes, item, need, names)


class SuffixArray:
    """Sorted suffixes of a sequence of word numbers that begin with a number above 0."""

    def __init__(self, codes: np.ndarray, top: int, depth: int):
        self.bits = max(1, int(top + 1).bit_length())
        self.per_key = max(1, 62 // self.bits)
        self.keys = -(-depth // self.per_key)
        self.packed = self._pack(codes)
        self.order = self._sort(np.flatnonzero(codes))

    def _pack(self, codes: np.ndarray) -> np.ndarray:
        """The next ``per_key`` numbers at every place, as one number; nothing but zeros lies beyond the end."""
        padded = np.concatenate([codes, np.zeros(self.per_key * self.keys + 1, np.int64)])
        packed = np.zeros(len(padded), np.int64)
        for k in range(self.per_key):
            packed[: len(padded) - k] |= padded[k:] << (self.bits * (self.per_key - 1 - k))
        return packed

    def _sort(self, places: np.ndarray) -> np.ndarray:
        """Sorts by the first key; ties, and only they, by the next ones."""
        order = places[np.argsort(self.packed[places], kind="stable")]
        tied = np.zeros(len(order), np.int64)
        if len(order):
            tied[1:] = np.cumsum(np.diff(self.packed[order]) != 0)
        for k in range(1, self.keys):
            sizes = np.bincount(tied)
            open_at = np.flatnonzero(sizes[tied] > 1)
            if len(open_at) == 0:
                break
            part = order[open_at]
            key = self.packed[part + k * self.per_key]
            again = np.lexsort((key, tied[open_at]))
            order[open_at] = part[again]
            key, group = key[again], tied[open_at]
            new = np.ones(len(open_at), bool)
            new[1:] = (np.diff(key) != 0) | (np.diff(group) != 0)
            starts = np.ones(len(order), bool)
            starts[open_at] = new
            tied = np.cumsum(starts) - 1
        return order

    def ranges(self, codes: np.ndarray, starts: np.ndarray, need: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last (excluded) suffix that agrees with ``codes`` from each start on, for ``need`` words."""
        wanted = self._pack(codes)
        columns = [wanted[starts + k * self.per_key] for k in range(self.keys)]
        for k in range(self.keys):
            inside = np.clip(need - k * self.per_key, 0, self.per_key)
            columns[k] = columns[k] >> (self.bits * (self.per_key - inside)) << (self.bits * (self.per_key - inside))
        low = self._search(columns)
        # the smallest sequence above all that begin with these words
        for k in range(self.keys):
            inside = np.clip(need - k * self.per_key, 0, self.per_key)
            ends = (need > k * self.per_key) & (need <= (k + 1) * self.per_key)
            columns[k] = columns[k] + np.where(ends, np.int64(1) << (self.bits * (self.per_key - inside)), 0)
        return low, self._search(columns)

    def _search(self, columns: list[np.ndarray]) -> np.ndarray:
        """Number of suffixes that are smaller than each of the wanted ones: one binary search for all at once."""
        low = np.zeros(len(columns[0]), np.int64)
        high = np.full(len(low), len(self.order), np.int64)
        while len(self.order) and (low < high).any():
            middle = (low + high) // 2
            at = self.order[np.minimum(middle, len(self.order) - 1)]
            less = np.zeros(len(low), bool)
            equal = np.ones(len(low), bool)
            for k, column in enumerate(columns):
                key = self.packed[at + k * self.per_key]
                less |= equal & (key < column)
                equal &= key == column
            go = low < high
            low = np.where(go & less, middle + 1, low)
            high = np.where(go & ~less, middle, high)
        return low


@dataclass(frozen=True)
class Matches:
    """Occurrences of windows: document and word in the shard, place in the benchmark, words that agree."""

    doc: np.ndarray
    word: np.ndarray
    place: np.ndarray
    length: np.ndarray


def find_matches(words: Words, benchmark: Benchmark, window: int = WINDOW) -> Matches:
    """Every occurrence of every window in a shard of documents."""
    counts = np.diff(words.at)
    codes = np.zeros(len(words.hash) + len(counts) + 1, np.int64)
    places = np.arange(len(words.hash)) + np.repeat(np.arange(len(counts)), counts)
    at = np.searchsorted(benchmark.vocabulary, words.hash)
    known = at < len(benchmark.vocabulary)
    known[known] = benchmark.vocabulary[at[known]] == words.hash[known]
    codes[places] = np.where(known, at + 1, 0)
    starts = np.flatnonzero(benchmark.need)
    if len(starts) == 0 or not known.any():
        return Matches(*[np.zeros(0, np.int64)] * 4)
    array = SuffixArray(codes, len(benchmark.vocabulary), window)
    low, high = array.ranges(benchmark.codes, starts, benchmark.need[starts])
    found = high - low
    rank = np.arange(found.sum()) - np.repeat(np.cumsum(found) - found, found)
    place = np.repeat(starts, found)
    where = array.order[np.repeat(low, found) + rank]
    doc = np.searchsorted(words.at + np.arange(len(words.at)), where, side="right") - 1
    return Matches(doc, where - doc, place, benchmark.need[place])


def longest(words: Words, benchmark: Benchmark, matches: Matches) -> Matches:
    """Matches that can't be extended to the left, each with all the words that agree from there on.

    Overlapping windows of one passage become one match: they lie on one diagonal, next to each other.
    """
    diagonal = matches.word - matches.place
    order = np.lexsort((matches.word, diagonal, matches.doc))
    doc, word, place, length = (x[order] for x in (matches.doc, matches.word, matches.place, matches.length))
    new = np.ones(len(doc), bool)
    new[1:] = (np.diff(doc) != 0) | (np.diff(diagonal[order]) != 0) | (np.diff(word) != 1)
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(doc)]]) - 1 if len(first) else first
    return Matches(doc[first], word[first] - words.at[doc[first]], place[first], word[last] + length[last] - word[first])


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Words]]:
    for batch in slices(batches, "text", SHARD_BYTES):
        yield batch, Words(filled(batch.column("text")), ALNUM)


def _blocks(benchmark: DataFrame, window: int) -> Iterator[tuple]:
    """The benchmark in blocks of whole items with at most ``BLOCK_WORDS`` words, or one item; one block at least.

    The rows come one partition at a time, so that the driver holds one block besides. Blocks
    are plain tuples of the fields of ``Benchmark``, as broadcasts can't hold classes of this package.
    """
    names, texts, words = [], [], 0
    for name, text in benchmark.select("item_id", "text").orderBy("item_id", "text").toLocalIterator():
        count = len(text or "") // 2 + 1
        if names and words + count > BLOCK_WORDS:
            yield _fields(benchmark_index(names, texts, window))
            names, texts, words = [], [], 0
        names.append(name)
        texts.append(text)
        words += count
    yield _fields(benchmark_index(names, texts, window))


def _fields(index: Benchmark) -> tuple:
    return index.vocabulary, index.codes, index.item, index.need, index.names


def _merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Intervals of words that cover the same words and don't overlap. Those that only touch stay apart."""
    if len(starts) == 0:
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    first = np.flatnonzero(np.concatenate([[True], starts[1:] >= ends[:-1]]))
    return starts[first], ends[np.concatenate([first[1:] - 1, [len(ends) - 1]])]


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents' columns and ``overlap``, a struct of n_words, n_hit, n_items, items_sha256 and contaminated.

    ``docs`` has text; ``benchmark`` has item_id and text. An extra column ``overlap`` is
    replaced, others are kept. Null and wordless texts have no words; such items never occur,
    and such documents are clean. An item with a null id hits words, but is not counted as an
    item. Items with the same id are one item, repeated documents are judged alike, and an empty
    benchmark leaves all clean.

    No shuffle: the documents are read once, in their own tasks. Each block of the benchmark is
    broadcast by itself and adds a pass over what the one before gave (intervals of hit words
    and the items of each document), so that a pass never holds more than one block.
    """
    columns = [c for c in docs.columns if c != "overlap"]
    (found,) = unused(docs, "_found")
    partial = "struct<starts: array<bigint>, ends: array<bigint>, items: array<string>>"
    final = "struct<n_words: bigint, n_hit: bigint, n_items: bigint, items_sha256: string, contaminated: boolean>"
    rows = docs.select(*columns)
    blocks = _blocks(benchmark, window)
    block = next(blocks)
    while block is not None:
        after = next(blocks, None)
        name, kind = (found, partial) if after else ("overlap", final)
        search = _search_pass(docs.sparkSession.sparkContext.broadcast(block), columns, found, name, window)
        rows = rows.mapInArrow(search, rows.select(*columns, F.lit(None).cast(kind).alias(name)).schema)
        block = after
    return rows


def _search_pass(block, columns: list[str], found: str, name: str, window: int):
    """A pass over the documents for one block; the last one, which makes ``overlap``, sums up."""

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Benchmark(*block.value)
        for batch, words in _shards(batches):
            n = batch.num_rows
            m = find_matches(words, index, window)
            before = batch.column(found).to_pylist() if found in batch.schema.names else [None] * n
            items = [set(b["items"]) if b else set() for b in before]
            for doc, item in set(zip(m.doc.tolist(), index.item[m.place].tolist(), strict=True)):
                if index.names[item] is not None:
                    items[doc].add(str(index.names[item]))
            own = [(b["starts"], b["ends"]) if b else ([], []) for b in before]
            shift = np.repeat(words.at[:-1], [len(x[0]) for x in own])
            starts = np.concatenate([m.word, shift + np.array([v for x in own for v in x[0]], np.int64)])
            ends = np.concatenate([m.word + m.length, shift + np.array([v for x in own for v in x[1]], np.int64)])
            starts, ends = _merged(starts, ends)
            cuts = np.searchsorted(starts, words.at)
            if name == "overlap":
                hit = np.diff(np.concatenate([[0], np.cumsum(ends - starts)])[cuts])
                made = {
                    "n_words": pa.array(np.diff(words.at), pa.int64()),
                    "n_hit": pa.array(hit, pa.int64()),
                    "n_items": pa.array([len(x) for x in items], pa.int64()),
                    "items_sha256": pa.array([sha256(",".join(sorted(x)).encode()).hexdigest() for x in items], pa.string()),
                    "contaminated": pa.array(hit > 0),
                }
            else:
                doc_start = np.repeat(words.at[:-1], np.diff(cuts))
                offsets = pa.array(cuts, pa.int32())
                made = {
                    "starts": pa.ListArray.from_arrays(offsets, pa.array(starts - doc_start)),
                    "ends": pa.ListArray.from_arrays(offsets, pa.array(ends - doc_start)),
                    "items": pa.array([sorted(x) for x in items], pa.list_(pa.string())),
                }
            struct = pa.StructArray.from_arrays(list(made.values()), list(made))
            yield pa.record_batch([*[batch.column(c) for c in columns], struct], names=[*columns, name])

    return judged


def longest_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Longest verbatim matches: (doc_id, word, item_id, item_word, n_words), words counted from 0.

    A row for each passage of a document that agrees with a passage of an item for at least
    ``window`` words, or with a whole shorter item, and agrees no further on either side. A
    passage that several items or places share has a row for each.
    """
    kinds = f"doc_id {dict(docs.dtypes)['doc_id']}, word bigint, item_id string, item_word bigint, n_words bigint"

    def located(block):
        def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = Benchmark(*block.value)
            first = np.concatenate([[0], np.flatnonzero(index.codes == 0) + 1])
            for batch, words in _shards(batches):
                m = longest(words, index, find_matches(words, index, window))
                item = index.item[m.place]
                names = [None if index.names[i] is None else str(index.names[i]) for i in item]
                yield pa.record_batch(
                    {
                        "doc_id": batch.column("doc_id").take(pa.array(m.doc, pa.int64())),
                        "word": pa.array(m.word, pa.int64()),
                        "item_id": pa.array(names, pa.string()),
                        "item_word": pa.array(m.place - first[item], pa.int64()),
                        "n_words": pa.array(m.length, pa.int64()),
                    }
                )

        return found

    context = docs.sparkSession.sparkContext
    parts = [docs.select("doc_id", "text").mapInArrow(located(context.broadcast(b)), kinds) for b in _blocks(benchmark, window)]
    return reduce(DataFrame.unionByName, parts)


def decontaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents in which no window of the benchmark occurs, with their own columns."""
    return contamination(docs, benchmark, window).where("not overlap.contaminated").select(*docs.columns)
