"""Links between the tokens of two tokenizers, from the byte offsets where tokens of both end.

The tokens of a text by both tokenizers are cut at shared ends by divide and conquer: of an
interval of tokens, the shared end nearest to its middle is located by bisection among the
other tokenizer's ends, and both halves are cut further; an interval without a shared end
inside is a group. All intervals of a slice of texts are cut at the same time.

Every token of a group is linked with every token of the other tokenizer in it. How many
documents hold a pair of ids linked is counted over the corpus, and each document gets sums over
its links. The commonest pairs, a bounded number, are looked up in the tasks; rare ones are joined.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.llm.segments import Ids, SegmentIds, State, encode_together, flat, gathered, sample_texts
from cardwarden.llm.storage import stored
from cardwarden.llm.words import filled, slices

SLICE_BYTES = 1 << 19
#: Pairs of ids that are sent to every task at most, 16 bytes each.
COMMON_PAIRS = 1 << 19
#: Links of a group from which on its distinct ids are paired instead of its tokens.
LARGE_GROUP = 1 << 12

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
#: White space beyond ASCII's, and separators that some take for it, in UTF-8.
_ODD_BLANK = rb"[\x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe1\xa0\x8e|\xe2\x80[\x80-\x8d\xa8\xa9\xaf]|\xe2\x81[\x9f\xa0]|\xe3\x80\x80|\xef\xbb\xbf"


@dataclass(frozen=True)
class Tokenizers:
    """The files of both tokenizers: the first by the tokenizers library (byte-level JSON), the second by sentencepiece."""

    byte_level_json: str
    pieces: bytes


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies: printable ones for themselves, others from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Pair:
    """Both tokenizers, for texts given as a space and the text, and the bytes of their ids."""

    def __init__(self, files: Tokenizers):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer

        self.first = Tokenizer.from_str(files.byte_level_json)
        self.first.encode_special_tokens = True  # their strings in a text are ordinary text
        self.second = sentencepiece.SentencePieceProcessor(model_proto=files.pieces)
        alphabet, vocab = byte_alphabet(), self.first.get_vocab()
        self.first_bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.first_bytes[i] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
        names = [self.second.id_to_piece(i) for i in range(self.second.get_piece_size())]
        self.second_bytes = [bytes([int(n[3:5], 16)]) if self.second.is_byte(i) else n.replace("▁", " ").encode() for i, n in enumerate(names)]
        self.sizes = [np.array([len(b) for b in own], np.int64) for own in (self.first_bytes, self.second_bytes)]
        # what makes a space after other characters the border of a segment
        state, kind = self.first.normalizer, type(self.first.pre_tokenizer).__name__
        self.separable = state is None and kind == "ByteLevel" and not any(re.search("[^▁]▁", n) for n in names)
        self.blank = self.second.piece_to_id("▁")
        self.known = SegmentIds(self._encode, 2)
        self.good = np.zeros(0, bool)

    def _first(self, parts: list[bytes]) -> list[list[int]]:
        return [e.ids for e in self.first.encode_batch_fast([p.decode() for p in parts], add_special_tokens=False)]

    def _second(self, parts: list[bytes]) -> list[list[int]]:
        # the tokenizer adds the first space, but not to an empty text
        found = self.second.encode([p[1:].decode() for p in parts], num_threads=1)
        return [ids if len(p) > 1 else [self.blank] for ids, p in zip(found, parts, strict=True)]

    def _encode(self, parts: list[bytes]) -> tuple[list[bytes], list[Ids]]:
        odd = re.search(_ODD_BLANK, b"".join(parts))
        plain = [p for p in parts if p[-1] > 0x20 and not (odd and re.search(_ODD_BLANK, p))] if self.separable else []
        rest = list(set(parts).difference(plain)) if plain else parts
        parts, found = plain + rest, []
        for encode, sizes in ((self._first, self.sizes[0]), (self._second, self.sizes[1])):
            ids, counts = encode_together(plain, b"", sizes, encode)
            more_ids, more_counts = flat(encode(rest))
            found.append((np.concatenate([ids, more_ids]), np.concatenate([counts, more_counts])))
        self._judge(parts, found)
        return parts, found

    def _judge(self, parts: list[bytes], found: list[Ids]) -> None:
        """Notes which of the new segments both tokenizers give back."""
        good = np.ones(len(parts), bool)
        lengths = np.fromiter(map(len, parts), np.int64, len(parts))
        for (ids, counts), table, sizes in zip(found, (self.first_bytes, self.second_bytes), self.sizes, strict=True):
            joined, ends = [table[i] for i in ids.tolist()], np.concatenate([[0], np.cumsum(counts)])
            same = np.diff(np.concatenate([[0], np.cumsum(sizes[ids])])[ends]) == lengths
            ends = ends.tolist()
            for a in range(0, len(parts), 4096):
                b = min(a + 4096, len(parts))
                if not same[a:b].all() or b"".join(joined[ends[a] : ends[b]]) != b"".join(parts[a:b]):
                    good[a:b] &= [b"".join(joined[ends[i] : ends[i + 1]]) == parts[i] for i in range(a, b)]
        self.good = np.concatenate([self.good[: len(self.known.number)], good])

    def state(self) -> tuple[State, np.ndarray]:
        return self.known.state(), self.good

    def learn(self, state: tuple[State, np.ndarray]) -> None:
        self.known.learn(state[0])
        self.good = state[1]

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, list[Ids]]:
        """Which texts both tokenizers give back byte by byte, and the ids of all by both; an empty text isn't given back."""
        whole = b"".join(b" " + t for t in texts)
        data = np.frombuffer(whole, np.uint8)
        starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
        cut = np.zeros(len(data) + 1, bool)
        if self.separable and len(data):
            cut[1:-1] = (data[1:] == 0x20) & ~_BLANK[data[:-1]]
            if re.search(_ODD_BLANK, whole):
                for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                    if re.search(_ODD_BLANK, whole[a:b]):
                        cut[a:b] = False
        cut[starts] = True
        at = np.flatnonzero(cut)
        segments = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(whole)]).dictionary_encode()
        numbers = self.known.numbers(segments.dictionary.to_pylist())[segments.indices.to_numpy()]
        of_text = np.searchsorted(at, starts)
        good = np.add.reduceat(~self.good[numbers], of_text[:-1]) == 0 if len(texts) else np.zeros(0, bool)
        found = []
        for k in (0, 1):
            ids, counts = self.known.of(numbers, k)
            found.append((ids, np.diff(np.concatenate([[0], np.cumsum(counts)])[of_text])))
        return good & (np.diff(starts) > 1), found


def _near_middle(ends: np.ndarray, others: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """For each interval of tokens, one whose end is among the others' ends, the nearest to the middle but not the last; else -1.

    The distances looked at double from round to round, so that an interval costs no more than
    its tokens, and one with a shared end near the middle a few.
    """
    found, open_ = np.full(len(low), -1), np.arange(len(low))
    middle, near, far = (low + high - 1) // 2, 0, 1
    while len(open_):
        lo, hi, mid = low[open_], high[open_] - 1, middle[open_]
        best = np.full(len(open_), np.iinfo(np.int64).max)
        for side in (-1, 1) if near else (1,):
            first = mid + near if side > 0 else np.maximum(mid - far + 1, lo)
            last = np.minimum(mid + far - 1, hi) if side > 0 else mid - near
            counts = np.maximum(last - first + 1, 0)
            tokens, of = gathered(first, counts), np.repeat(np.arange(len(open_)), counts)
            place = np.searchsorted(others, ends[tokens])
            hit = others[np.minimum(place, len(others) - 1)] == ends[tokens]
            np.minimum.at(best, of[hit], 2 * np.abs(tokens[hit] - mid[of[hit]]) + (side > 0))
        got = best < np.iinfo(np.int64).max
        found[open_[got]] = mid[got] + np.where(best[got] % 2 == 1, 1, -1) * (best[got] // 2)
        more = ~got & ((mid + far <= hi) | (mid - far >= lo))
        open_, near, far = open_[more], far, 4 * far
    return found


def shared_ends(ends: np.ndarray, others: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Tokens that end where one of the others does, for rising ends of several texts whose last tokens are given and shared."""
    shared = np.zeros(len(ends), bool)
    shared[last] = True
    low, high = np.concatenate([[0], last[:-1] + 1]), last
    while True:
        wide = high > low
        low, high = low[wide], high[wide]
        if len(low) == 0:
            return np.flatnonzero(shared)
        cut = _near_middle(ends, others, low, high)
        some = cut >= 0
        low, high, cut = low[some], high[some], cut[some]
        shared[cut] = True
        # both halves of an interval beside each other, so that bisection goes through memory in order
        low, high = np.stack([low, cut + 1], axis=1).ravel(), np.stack([cut, high], axis=1).ravel()


def _pairs(first: np.ndarray, second: np.ndarray, ends: list[np.ndarray], text: np.ndarray, ids: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Linked pairs of ids of each text, sorted: number of the text, pair as ``a * ids + b``, and how often they are linked."""
    starts = [np.concatenate([[0], e[:-1]]) for e in ends]
    counts = [e - s for e, s in zip(ends, starts, strict=True)]
    links = counts[0] * counts[1]
    small = np.flatnonzero(links <= LARGE_GROUP)
    within = gathered(np.zeros(len(small), np.int64), links[small])
    group = np.repeat(small, links[small])
    a, b = starts[0][group] + within // counts[1][group], starts[1][group] + within % counts[1][group]
    span = np.int64(ids) * np.int64(ids)
    keys, times = np.unique(text[group] * span + first[a] * np.int64(ids) + second[b], return_counts=True)
    large = [(keys, times)]
    for g in np.flatnonzero(links > LARGE_GROUP).tolist():
        (x, m), (y, n) = (np.unique(i[s[g] : e[g]].astype(np.int64), return_counts=True) for i, s, e in zip((first, second), starts, ends, strict=True))
        large.append(((text[g] * span + x[:, None] * ids + y[None, :]).ravel(), (m[:, None] * n[None, :]).ravel()))
    if len(large) > 1:
        keys, at = np.unique(np.concatenate([k for k, _ in large]), return_inverse=True)
        times = np.bincount(at, weights=np.concatenate([t for _, t in large]), minlength=len(keys)).astype(np.int64)
    return keys // span, keys % span, times


def _written(first: np.ndarray, second: np.ndarray, ends: list[np.ndarray], last: np.ndarray, names: np.ndarray) -> list[str]:
    """The groups of each text as ``a1,a2|b1;a3|b2``; ``last`` has the last group of each text."""
    starts = [np.concatenate([[0], e[:-1]]) for e in ends]
    after = [np.zeros(len(first), np.int64), np.zeros(len(second), np.int64)]
    after[0][ends[0] - 1] = 1
    after[1][ends[1] - 1] = 2
    after[1][ends[1][last] - 1] = 3
    counts = [e - s for e, s in zip(ends, starts, strict=True)]
    order = np.empty(len(first) + len(second), np.int64)
    order[np.arange(len(first)) + np.repeat(starts[1], counts[0])] = first * np.int64(4) + after[0]
    order[np.arange(len(second)) + np.repeat(ends[0], counts[1])] = second * np.int64(4) + after[1]
    parts = names[order].tolist()
    at = [0, *(ends[0] + ends[1])[last].tolist()]
    return ["".join(parts[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]


_FACTS = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"


def _aligned(shipped):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each text's figures and its linked pairs of ids."""
        files, known = shipped.value
        pair = Pair(Tokenizers(*files))
        pair.learn(known)
        ids = max(map(len, pair.sizes))
        names = np.array([f"{i}{s}" for i in range(ids) for s in (",", "|", ";", "")], object)
        for batch in slices(batches, "text", SLICE_BYTES):
            texts = filled(batch.column("text")).cast(pa.large_binary()).to_pylist()
            good, found = pair.encode(texts)
            counts = [np.where(good, n, 0) for _, n in found]
            (a, b), sizes = ([i[np.repeat(good, n)].astype(np.int64) for i, n in found], pair.sizes)
            own = np.flatnonzero(good)
            figures = np.zeros((2, len(texts)), np.int64)
            pairs, hashes = [np.zeros(0, np.int64)] * 3, [""] * len(texts)
            if len(own):
                end_a, end_b = np.cumsum(sizes[0][a]), np.cumsum(sizes[1][b])
                last = np.cumsum(counts[0][own]) - 1
                cut = shared_ends(end_a, end_b, last)
                ends = [cut + 1, np.searchsorted(end_b, end_a[cut]) + 1]
                last = np.searchsorted(cut, last)
                text = np.repeat(own, np.diff(last, prepend=-1))
                sides = [np.diff(e, prepend=0) for e in ends]
                figures[0] = np.bincount(text, minlength=len(texts))
                figures[1] = np.bincount(text, weights=sides[0] * sides[1], minlength=len(texts)).astype(np.int64)
                pairs = _pairs(a, b, ends, text, ids)
                for i, w in zip(own.tolist(), _written(a, b, ends, last, names), strict=True):
                    hashes[i] = sha256(w.encode()).hexdigest()
            at = pa.array(np.searchsorted(pairs[0], np.arange(len(texts) + 1)), pa.int32())
            lists = [pa.ListArray.from_arrays(at, pa.array(x, kind)) for x, kind in ((pairs[1] // ids, pa.int32()), (pairs[1] % ids, pa.int32()), (pairs[2], pa.int64()))]
            made = [*map(pa.array, (*counts, *figures)), pa.array(hashes), *lists]
            yield pa.record_batch([batch.column("doc_id"), *made], names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "a", "b", "times"])

    return rows


def _sums(shipped):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums over each row's common pairs; the other pairs are passed on."""
        keys, counts, best = shipped.value
        for batch in batches:
            lists = [batch.column(c) for c in ("a", "b", "times")]
            a, b, times = (x.flatten().to_numpy() for x in lists)
            of = np.repeat(np.arange(batch.num_rows), np.diff(lists[0].offsets.to_numpy()))
            pair = a.astype(np.int64) << 32 | b
            place = np.minimum(np.searchsorted(keys, pair), max(len(keys) - 1, 0))
            known = keys[place] == pair if len(keys) else np.zeros(len(pair), bool)
            place, rest = place[known], np.flatnonzero(~known)
            sums = [np.zeros(batch.num_rows, np.int64) for _ in range(2)]
            for total, value in zip(sums, (best[place].astype(np.int64), counts[place]), strict=True):
                np.add.at(total, of[known], times[known] * value)
            at = pa.array(np.searchsorted(of[rest], np.arange(batch.num_rows + 1)), pa.int32())
            made = [pa.array(x) for x in sums] + [pa.ListArray.from_arrays(at, pa.array(x[rest])) for x in (a, b, times)]
            kept = [c for c in batch.schema.names if c not in ("a", "b", "times")]
            yield pa.record_batch([*map(batch.column, kept), *made], names=[*kept, "n_best", "count_sum", "a", "b", "times"])

    return rows


def _common(counts: DataFrame, most: int) -> tuple[DataFrame, DataFrame | None]:
    """The pairs of at least some number of documents, at most ``most`` pairs, and the others, None where there are none.

    The number is a power of two, found from the pairs per power.
    """
    power = F.floor(F.log2(F.col("n").cast("double"))).cast("int")
    sizes = {r[0]: r[1] for r in counts.groupBy(power.alias("power")).agg(F.count("*")).collect()}
    cut, total = 64, 0
    while cut > 0 and total + sizes.get(cut - 1, 0) <= most:
        cut -= 1
        total += sizes.get(cut, 0)
    return counts.where(power >= cut), counts.where(power < cut) if cut else None


def aligned(docs: DataFrame, files: Tokenizers, common_pairs: int = COMMON_PAIRS) -> DataFrame:
    """Rows (doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum), one for each of the documents (doc_id, text).

    A text is encoded as a space and the text by both tokenizers. Null and empty texts, and
    those that one of the tokenizers doesn't give back byte by byte, have no tokens: their
    figures are 0 and their hash is ''. A pair's count is the number of rows that hold it
    linked, so repeated rows count each. ``n_best`` are the links whose pair is the most
    frequent one of its first id, ties included; ``count_sum`` adds up the counts of all links.
    Other columns are ignored; an empty table gives none.

    The segments of a bounded sample of texts are sent to the tasks beforehand, which changes no
    result. A text's tokens are held by one task, some 100 bytes a token, and its distinct pairs are an
    array of one row. Pairs are counted with partial sums on the map side. Of their counts, at
    most ``common_pairs`` are sent to the tasks, and the others, each of which is rare, are joined.
    """
    spark = docs.sparkSession
    kind = dict(docs.dtypes)["doc_id"]
    lists = "a array<int>, b array<int>, times array<bigint>"
    pair = Pair(files)
    pair.encode(sample_texts(docs)[0]["text"].cast(pa.large_binary()).to_pylist())
    send = spark.sparkContext.broadcast
    made = docs.select("doc_id", "text").mapInArrow(_aligned(send(((files.byte_level_json, files.pieces), pair.state()))), f"doc_id {kind}, {_FACTS}, {lists}")
    rows = stored(made.withColumn("row", F.monotonically_increasing_id()), "aligned")

    linked = rows.select(F.explode(F.arrays_zip("a", "b")).alias("p")).select("p.a", "p.b")
    counted = stored(linked.groupBy("a", "b").agg(F.count("*").alias("n")), "pair-counts")
    most = counted.groupBy("a").agg(F.max("n").alias("most"))  # no more rows than the first vocabulary has ids
    counts = counted.join(F.broadcast(most), "a").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))
    common, rare = _common(counts, common_pairs)
    table = common.select((F.shiftleft(F.col("a").cast("bigint"), 32) + F.col("b")).alias("key"), "n", "best").toArrow()
    order = np.argsort(table["key"].to_numpy())
    common = send(tuple(table[c].to_numpy()[order] for c in ("key", "n", "best")))
    sums = rows.mapInArrow(_sums(common), f"doc_id {kind}, {_FACTS}, row bigint, n_best bigint, count_sum bigint, {lists}")
    figures = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    if rare is None:
        return sums.select(*figures, "n_best", "count_sum")
    sums = stored(sums, "common-sums")
    open_links = sums.select("row", F.explode(F.arrays_zip("a", "b", "times")).alias("p")).select("row", "p.a", "p.b", "p.times")
    more = open_links.join(rare, ["a", "b"]).groupBy("row").agg(F.sum(F.col("times") * F.col("n")).alias("sum"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("found"))
    whole = sums.join(more, "row", "left")
    add = [(F.col(c) + F.coalesce(x, F.lit(0))).alias(c) for c, x in (("n_best", "found"), ("count_sum", "sum"))]
    return whole.select(*figures, *add)
