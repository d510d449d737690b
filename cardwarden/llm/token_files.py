"""Token ids in files: zstandard frames of single documents with a shared dictionary, a dictionary hash and an offset index.

A folder holds ``dictionary/`` (one file) and ``ids/`` (files in the order of doc_id). A file of
ids is, each part ended by a line feed:

* header: 8 bytes magic, SHA-256 of the dictionary, file number and bytes per id as unsigned 32-bit numbers;
* a zstandard frame for each document, of its ids as little-endian unsigned numbers;
* index: compressed columns doc_id, offset, length, number of ids (signed 64-bit) and whether the id is null (a byte);
* trailer: offset and length of the index and number of documents (unsigned 64-bit), 8 bytes magic.

All numbers are little-endian. A document is read by its index entry, without decompressing any
other. The files are written by Spark's text writer, one part a row, so that its commit protocol
holds in any store that Spark can write: tasks that are run again leave no traces.
"""

from __future__ import annotations

import os
import struct
from collections.abc import Callable, Iterator
from hashlib import sha256
from unicodedata import normalize
from zlib import crc32

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardwarden.llm.segments import Ids, SegmentIds, State, encode_together, flat, gathered, sample_texts
from cardwarden.llm.storage import stored, work_folder
from cardwarden.llm.words import buffers, filled, slices

MAGIC = b"CWTOKEN1"
_HEADER, _TRAILER = "<8s32sII", "<QQQ8s"
LEVEL = 3
#: Bytes of text encoded at a time; a task holds about 50 times so much besides the parts it knows.
SLICE_BYTES = 1 << 21
#: Parts that a task keeps, times the bounds of ``segments``: words are short.
ROOM = 4
#: Text of one file at most, on average.
FILE_BYTES = 256 << 20
#: The dictionary is trained on the sample of ``segments.sample_texts``.
DICTIONARY_BYTES = 64 << 10

_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_LETTER = np.zeros(256, bool)
_LETTER[0x61:0x7B] = True



class Encoder:
    """Ids of whole texts by a tokenizer of the tokenizers library, given as its JSON, without added special tokens.

    ``by_word`` encodes each distinct run of other than ASCII white space once, without the
    punctuation behind it and in lower case where it is ASCII. It gives the same ids for
    tokenizers that lower-case, drop white space, look at nothing across it, and always split
    between a letter and punctuation that follows. ``known`` are parts that another encoder has
    seen, which spares encoding them again.
    """

    def __init__(self, tokenizer_json: str, by_word: bool, known: State | None = None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer, self.by_word = Tokenizer.from_str(tokenizer_json), by_word
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        names = sorted((i, token) for token, i in self.tokenizer.get_vocab().items())
        self.id_bytes = np.zeros(names[-1][0] + 1, np.int64)
        for i, token in names:
            self.id_bytes[i] = len(token.removesuffix("</w>"))  # a byte is one character of a token
        self.known = SegmentIds(self._encode_parts, room=ROOM)
        if known is not None:
            self.known.learn(known)

    def _encode(self, texts: list[bytes]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)]

    def _encode_parts(self, parts: list[bytes]) -> tuple[list[bytes], list[Ids]]:
        special = [s.encode() for s in self.special]
        groups: list[list[bytes]] = [[p for p in parts if p.isascii() and b"<" not in p], [], []]  # ASCII; other words; those that may not be one word
        sizes = []
        for part in [p for p in parts if not p.isascii() or b"<" in p] if len(groups[0]) < len(parts) else ():
            kind = 2 if b"<" in part and any(s in part for s in special) else 0
            if kind == 0 and not part.isascii():
                lower = normalize("NFC", part.decode()).lower()
                kind = 1 if len(lower.split()) == 1 else 2
                if kind == 1:
                    sizes.append(len(lower.encode()))
            groups[kind].append(part)
        found = [
            encode_together(groups[0], b" ", self.id_bytes, self._encode),
            encode_together(groups[1], b" ", self.id_bytes, self._encode, sizes),
            flat(self._encode(groups[2])),
        ]
        return [p for g in groups for p in g], [(np.concatenate([ids for ids, _ in found]), np.concatenate([counts for _, counts in found]))]

    def _stems(self, words: pa.Array) -> tuple[pa.Array, list[bytes], np.ndarray]:
        """Words without punctuation behind their last letter; what distinct punctuation stands there, and which of it each word has."""
        compute = pa.compute
        lower = compute.ascii_lower(words)
        ordinary = compute.string_is_ascii(words)
        for s in self.special:
            ordinary = compute.and_not(ordinary, compute.match_substring(lower, s.lower()))
        lower = compute.if_else(ordinary, lower, words)
        stems = compute.ascii_rtrim(lower, characters=_PUNCTUATION)
        data, at = buffers(stems)
        letter = _LETTER[data[np.maximum(at[1:] - 1, 0)]] if len(data) else np.zeros(len(stems), bool)
        cut = ordinary.to_numpy(zero_copy_only=False) & letter & (np.diff(at) > 0)
        stems = compute.if_else(pa.array(cut), stems, lower)
        tails, tail = {b"": 0}, np.zeros(len(words), np.int64)
        sizes, whole = compute.binary_length(stems).to_numpy(), compute.binary_length(words).to_numpy()
        some = np.flatnonzero(sizes < whole)
        cut_off = zip(sizes[some].tolist(), words.take(pa.array(some)).cast(pa.large_binary()).to_pylist(), strict=True)
        tail[some] = [tails.setdefault(word[size:], len(tails)) for size, word in cut_off]
        return stems, list(tails), tail

    def __call__(self, texts: pa.Array) -> Ids:
        """Ids of a column of texts one after the other, and how many each has."""
        if not self.by_word:
            return flat(self._encode(texts.cast(pa.large_binary()).to_pylist()))
        lists = pa.compute.ascii_split_whitespace(texts)
        words = lists.flatten().dictionary_encode()
        stems, tails, tail = self._stems(words.dictionary)
        stems = stems.dictionary_encode()
        parts = stems.dictionary.cast(pa.large_binary()).to_pylist()
        numbers = self.known.numbers(parts + tails)
        pairs = np.stack([numbers[: len(parts)][stems.indices.to_numpy()], numbers[len(parts) :][tail]], axis=1)
        found, sizes = self.known.of(pairs.ravel())
        sizes = sizes[::2] + sizes[1::2]  # of each distinct word
        used = words.indices.to_numpy()
        counts = sizes[used]
        ids = found[gathered((np.cumsum(sizes) - sizes)[used], counts)]
        upto = np.concatenate([[0], np.cumsum(counts)])[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
        return ids.astype(np.int64), np.diff(upto)


def _with_end(ids: np.ndarray, counts: np.ndarray, end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
    if end_id is None:
        return ids, counts
    more = counts + 1
    out = np.full(int(more.sum()), end_id, np.int64)
    out[gathered(np.cumsum(more) - more, counts)] = ids
    return out, more


def _dictionary(samples: list[bytes]) -> bytes:
    """A dictionary for documents like the samples; where they are too few to train one, their own bytes."""
    samples = [s for s in samples if len(s) >= 8]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES]


def train_dictionary(docs: DataFrame, tokenizer_json: str, by_word: bool, width: int) -> tuple[bytes, State | None, int]:
    """Dictionary for the serialized ids of documents like these, the words of the sample, and the bytes of all texts.

    The sample changes the size of the files and the time alone.
    """
    found, total = sample_texts(docs)
    encode, samples = Encoder(tokenizer_json, by_word), []
    for batch in found.to_batches():
        ids, counts = encode(filled(batch.column(0)))
        samples += [x.tobytes() for x in np.split(ids.astype(f"<u{width}"), np.cumsum(counts)[:-1])]
    return _dictionary(samples), encode.known.state() if by_word else None, total


def _compressor(dictionary: bytes):
    if not dictionary:
        return zstandard.ZstdCompressor(level=LEVEL)
    given = zstandard.ZstdCompressionDict(dictionary)
    given.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=given)


def _decompressor(dictionary: bytes):
    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary)) if dictionary else zstandard.ZstdDecompressor()


def _file_parts(tokenizer_json, by_word: bool, end_id: int | None, width: int, shipped) -> Callable:
    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The parts of a partition's file, for rows (doc_id, text) in their order; none for no rows."""
        dictionary, known = shipped.value
        encode, packer = Encoder(tokenizer_json.value, by_word, known), _compressor(dictionary)
        at, index = 0, []

        def row(values: list[bytes]) -> pa.RecordBatch:
            return pa.record_batch([pa.array(values, pa.binary())], names=["value"])

        for batch in slices(batches, "text", SLICE_BYTES):
            if at == 0:
                head = struct.pack(_HEADER, MAGIC, sha256(dictionary).digest(), TaskContext.get().partitionId(), width)
                at = len(head) + 1
                yield row([head])
            ids, counts = _with_end(*encode(filled(batch.column("text"))), end_id)
            data, ends = ids.astype(f"<u{width}").tobytes(), (np.cumsum(counts) * width).tolist()
            frames = [packer.compress(data[a:b]) for a, b in zip([0, *ends[:-1]], ends, strict=True)]
            lengths = np.fromiter(map(len, frames), np.int64, len(frames))
            doc_ids = batch.column("doc_id")
            index.append((pa.compute.fill_null(doc_ids, 0).to_numpy(), at + np.cumsum(lengths + 1) - lengths - 1, lengths, counts, doc_ids.is_null().to_numpy(zero_copy_only=False)))
            at += int((lengths + 1).sum())
            yield row(frames)
        if index:
            columns = [np.concatenate(c) for c in zip(*index, strict=True)]
            table = zstandard.ZstdCompressor(level=LEVEL).compress(b"".join(np.ascontiguousarray(c.astype("<i8" if k < 4 else "u1")).tobytes() for k, c in enumerate(columns)))
            yield row([table, struct.pack(_TRAILER, at, len(table), len(columns[0]), MAGIC)])

    return parts


def write_token_files(docs: DataFrame, folder: str, tokenizer_json: str, end_id: int | None = None, by_word: bool = False, width: int = 4) -> None:
    """Writes the ids of the documents (doc_id bigint, text) in ascending order of doc_id under ``folder``.

    A null text is empty; a null doc_id comes last; rows that share an id come in the order of a
    hash of their texts. ``end_id`` is appended to each document. An id has ``width`` bytes, so
    2 do for up to 65 536 ids. Other columns are ignored; an empty table gives a folder without
    files of ids.

    Texts are shuffled once, by ranges of the id, as many as there are shuffle partitions or
    more, so that a file has ``FILE_BYTES`` of text on average. A task holds a slice of texts and its
    file's index.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    dictionary, known, total = train_dictionary(rows, tokenizer_json, by_word, width)
    spark.createDataFrame([(bytearray(dictionary.hex().encode()),)], "value binary").select(F.col("value").cast("string")).coalesce(1).write.text(f"{folder}/dictionary")
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text").asc()]
    files = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // FILE_BYTES))
    ranged = rows.repartitionByRange(files, *order).sortWithinPartitions(*order)
    send = spark.sparkContext.broadcast
    parts = ranged.mapInArrow(_file_parts(send(tokenizer_json), by_word, end_id, width, send((dictionary, known))), "value binary")
    parts.select(F.col("value").cast("string")).write.option("lineSep", "\n").option("compression", "none").option("maxRecordsPerFile", 0).text(f"{folder}/ids")


def read_dictionary(spark: SparkSession, folder: str) -> bytes:
    return bytes.fromhex(spark.read.text(f"{folder}/dictionary").first()[0])


class TokenFile:
    """One file's bytes: its number, its index, and the ids of single documents."""

    def __init__(self, content: bytes, dictionary: bytes):
        magic, digest, self.number, self.width = struct.unpack_from(_HEADER, content)
        at, length, n, end = struct.unpack_from(_TRAILER, content, len(content) - struct.calcsize(_TRAILER) - 1)
        if magic != MAGIC or end != MAGIC or digest != sha256(dictionary).digest():
            raise ValueError("not a file of token ids that were written with this dictionary")
        table = zstandard.ZstdDecompressor().decompress(content[at : at + length])
        self.doc_id, self.offset, self.length, self.count = np.frombuffer(table, "<i8", 4 * n).reshape(4, n)
        self.null = np.frombuffer(table, "u1", n, 32 * n).astype(bool)
        self.content, self.unpacker = content, _decompressor(dictionary)

    def ids(self, i: int) -> np.ndarray:
        """Ids of the i-th document."""
        at = int(self.offset[i])
        data = self.unpacker.decompress(self.content[at : at + int(self.length[i])], max_output_size=int(self.count[i]) * self.width)
        return np.frombuffer(data, f"<u{self.width}")


def _opened(batches: Iterator[pa.RecordBatch], dictionary: bytes) -> Iterator[TokenFile]:
    for batch in batches:
        for value in batch.column("content"):
            if len(content := value.as_buffer().to_pybytes()):
                yield TokenFile(content, dictionary)


def _files(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{folder}/ids").select("content")


def _doc_ids(file: TokenFile, at: slice | np.ndarray) -> pa.Array:
    return pa.array(file.doc_id[at], pa.int64(), mask=file.null[at])


def read_token_digests(spark: SparkSession, folder: str) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids_crc32) of all documents, read from the files.

    ``start`` counts the ids of all documents before. The checksum is of the ids as
    little-endian unsigned 32-bit numbers. Totals of files, one row each, are summed up apart.
    """
    shipped = spark.sparkContext.broadcast(read_dictionary(spark, folder))

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file in _opened(batches, shipped.value):
            before = np.cumsum(file.count) - file.count
            for a in range(0, len(file.count), 8192):
                own = slice(a, a + 8192)
                sums = [crc32(file.ids(i).astype("<u4").tobytes()) for i in range(len(file.count))[own]]
                made = [pa.array(np.full(len(sums), file.number), pa.int64()), _doc_ids(file, own), pa.array(before[own]), pa.array(file.count[own]), pa.array(sums, pa.int64())]
                yield pa.record_batch(made, names=["file", "doc_id", "within", "n_tokens", "ids_crc32"])

    found = stored(_files(spark, folder).mapInArrow(digests, "file bigint, doc_id bigint, within bigint, n_tokens bigint, ids_crc32 bigint"), "token-digests")
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    totals = found.groupBy("file").agg(F.sum("n_tokens").alias("n")).select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return found.join(totals, "file").select("doc_id", (F.col("base") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")


def read_documents(spark: SparkSession, folder: str, doc_ids: list[int]) -> DataFrame:
    """Rows (doc_id, ids) of the documents with these ids; only their frames are decompressed."""
    dictionary, wanted = read_dictionary(spark, folder), np.unique(np.array(doc_ids, np.int64))

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file in _opened(batches, dictionary):
            at = np.flatnonzero(np.isin(file.doc_id, wanted) & ~file.null)
            yield pa.record_batch([_doc_ids(file, at), pa.array([file.ids(i).astype(np.int64) for i in at], pa.list_(pa.int64()))], names=["doc_id", "ids"])

    return _files(spark, folder).mapInArrow(chosen, "doc_id bigint, ids array<bigint>")


def token_digests(docs: DataFrame, tokenizer_json: str, end_id: int | None = None, by_word: bool = False, width: int = 4) -> DataFrame:
    """Writes the documents' ids to a fresh folder and returns what ``read_token_digests`` reads there."""
    folder = work_folder(docs.sparkSession, "token-files")
    write_token_files(docs, folder, tokenizer_json, end_id, by_word, width)
    return read_token_digests(docs.sparkSession, folder)
