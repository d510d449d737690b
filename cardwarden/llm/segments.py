"""Token ids of whole texts, where each distinct segment of a task's texts is encoded once.

A segment is a stretch that a tokenizer can't look across, so that the ids of a text are those
of its segments one after the other. ``SegmentIds`` keeps the ids of the segments that it has
seen, up to a bound; results don't depend on what it holds.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain, islice, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.llm.storage import stored

#: Segments and their bytes that are kept at most, beside those known beforehand and those of the texts at hand.
MOST_SEGMENTS, MOST_BYTES = 1 << 17, 1 << 23
#: New segments that are encoded as one text.
TOGETHER = 4096

#: For a list of segments: their ids one after the other, and how many each has.
Ids = tuple[np.ndarray, np.ndarray]
#: Segments joined, their sizes, and their ids by each tokenizer.
State = tuple[bytes, np.ndarray, list[Ids]]
#: Texts that tasks know the segments of beforehand: those with the smallest hashes of their ids, at most so many with so many bytes.
SAMPLE_ROWS, SAMPLE_BYTES = 4000, 8 << 20


def gathered(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Positions of the runs that begin at each start and have so many items, one run after the other."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - counts), counts)


def flat(lists: list[list[int]]) -> Ids:
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.int64, int(counts.sum())), counts


def split_ids(ids: np.ndarray, id_bytes: np.ndarray, sizes: np.ndarray) -> np.ndarray | None:
    """How many ids each of some segments has that were encoded as one text, given their bytes; None if ids go over a border."""
    ends, borders = np.cumsum(id_bytes[ids]), np.cumsum(sizes)
    if len(ends) == 0 or ends[-1] != borders[-1]:
        return None
    last = np.searchsorted(ends, borders)
    return np.diff(last, prepend=-1) if (ends[last] == borders).all() else None


def encode_together(segments: list[bytes], glue: bytes, id_bytes: np.ndarray, encode: Callable[[list[bytes]], list[list[int]]], sizes: list[int] | None = None) -> Ids:
    """Ids of segments by encoding many as one text; one by one where the ids don't show the borders.

    ``sizes`` are the bytes that the ids of each segment stand for, where those aren't its own.
    """
    ids, counts = [], []
    sizes = list(map(len, segments)) if sizes is None else sizes
    for a in range(0, len(segments), TOGETHER):
        some = segments[a : a + TOGETHER]
        found = np.array(encode([glue.join(some)])[0], np.int64)
        split = split_ids(found, id_bytes, np.array(sizes[a : a + TOGETHER], np.int64))
        if split is None:
            found, split = flat(encode(some))
        ids.append(found)
        counts.append(split)
    return (np.concatenate(ids), np.concatenate(counts)) if ids else (np.zeros(0, np.int64), np.zeros(0, np.int64))


class SegmentIds:
    """Ids of segments by one or more tokenizers; ``encode`` gives those of a list of segments for each tokenizer.

    ``encode`` may put the segments in another order, which it returns beside the ids. ``room``
    times the module's bounds are kept.
    """

    def __init__(self, encode: Callable[[list[bytes]], tuple[list[bytes], list[Ids]]], tokenizers: int = 1, room: int = 1):
        self.encode, self.room, self.base, self.bytes = encode, room, 0, 0
        self.number: dict[bytes, int] = {}
        self.ids = [np.zeros(0, np.int32)] * tokenizers
        self.at = [np.zeros(1, np.int64)] * tokenizers

    def _forget(self) -> None:
        """Keeps what was known beforehand."""
        self.number = dict(islice(self.number.items(), self.base))
        self.ids = [ids[: at[self.base]] for ids, at in zip(self.ids, self.at, strict=True)]
        self.at = [at[: self.base + 1] for at in self.at]
        self.bytes = 0

    def numbers(self, segments: list[bytes]) -> np.ndarray:
        """A number for each segment; it holds until the next call."""
        if len(self.number) > self.base + self.room * MOST_SEGMENTS or self.bytes > self.room * MOST_BYTES:
            self._forget()
        numbers = np.fromiter(map(self.number.get, segments, repeat(-1)), np.int64, len(segments))
        missing = np.flatnonzero(numbers < 0)
        if len(missing):
            unseen = [segments[i] for i in missing.tolist()]
            new, found = self.encode(list(dict.fromkeys(unseen)))
            self._add(new, found)
            numbers[missing] = [self.number[s] for s in unseen]
        return numbers

    def _add(self, new: list[bytes], found: list[Ids]) -> None:
        self.number.update(zip(new, range(len(self.number), len(self.number) + len(new)), strict=True))
        self.bytes += sum(map(len, new))
        for k, (ids, counts) in enumerate(found):
            self.ids[k] = np.concatenate([self.ids[k], ids.astype(np.int32)])
            self.at[k] = np.concatenate([self.at[k], self.at[k][-1] + np.cumsum(counts)])

    def state(self) -> State:
        """What was seen, as plain bytes and arrays to send to tasks."""
        sizes = np.fromiter(map(len, self.number), np.int64, len(self.number))
        return b"".join(self.number), sizes, [(ids, np.diff(at)) for ids, at in zip(self.ids, self.at, strict=True)]

    def learn(self, state: State) -> None:
        """Begins with what another has seen, and keeps it. Nothing may have been seen before."""
        joined, sizes, found = state
        ends = np.cumsum(sizes).tolist()
        self._add([joined[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)], found)
        self.base, self.bytes = len(self.number), 0

    def of(self, numbers: np.ndarray, k: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the numbered segments one after the other by the k-th tokenizer, and how many each has."""
        start = self.at[k][numbers]
        counts = self.at[k][numbers + 1] - start
        return self.ids[k][gathered(start, counts)], counts


def sample_texts(docs: DataFrame) -> tuple[pa.Table, int]:
    """Whole texts of a bounded sample of the documents (doc_id, text), and the bytes of all texts.

    The sample is bounded by its number and bytes, which never cut a text or prefer short ones.
    """
    mark = F.xxhash64(F.lit(13), "doc_id")
    sizes = stored(docs.select(mark.alias("mark"), F.octet_length("text").cast("bigint").alias("size")), "sizes")
    total = sizes.agg(F.sum("size")).first()[0] or 0
    first = sizes.where("size > 0").orderBy("mark", "size").limit(SAMPLE_ROWS).collect()
    taken = int(np.searchsorted(np.cumsum([r["size"] for r in first]), SAMPLE_BYTES, side="right"))
    if taken == 0:
        return pa.table({"text": pa.array([], pa.large_string())}), total
    first = first[:taken]
    chosen = F.broadcast(sizes.sparkSession.createDataFrame([(r["mark"],) for r in first], "m bigint").distinct())
    texts = docs.where(F.octet_length("text") <= max(r["size"] for r in first)).select("text", mark.alias("mark"))
    found = texts.join(chosen, F.col("mark") == F.col("m"), "left_semi")
    return found.orderBy("mark", F.octet_length("text"), "text").limit(taken).select("text").toArrow(), total
