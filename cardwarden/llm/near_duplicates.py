"""Near-duplicate documents by MinHash bands and sequential Bayesian verification.

A document is the set of its shingles of five words. Documents with equal sets are one node.
Nodes that agree in a band of their signature are candidates. Signatures are compared a batch
of hashes at a time, and a pair goes as soon as the probability that it is similar enough,
given the matches so far, is below a chosen miss probability. What is left is verified exactly
on the full sets, and verified links make components.

Pairs inside a group are never written out. Each node is first compared with the smallest node
of its buckets. Likely pairs make clusters, which nodes of one bucket that are in different
clusters may still join: their signatures are compared in tiles, and a tile returns pairs that
span what it has found, fewer than nodes. Then the most promising pair of each node is verified
on the texts. Within a cluster only nodes of different components are compared further: tiles of signatures tell which
nodes of two tiles are in a likely pair, and only those send their texts, to tiles that return
verified links that span theirs.

Only the texts of clustered nodes are shuffled: a bitmap of row keys, of bounded size, goes to
the tasks that read the documents, and the few rows that it lets through wrongly go afterwards.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import blake2b
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwarden.llm.graph import components
from cardwarden.llm.naming import unused
from cardwarden.llm.storage import drop, stored
from cardwarden.llm.words import SOLID, Words, filled, mix, shingle_hashes, slices

SHINGLE = 5
#: Linked are documents with 100 * intersection >= percent * union; this is the percent unless another is given.
PERCENT = 85
#: With 32 bands of 5 hashes, a pair of similarity 0.85 shares no band with a probability of 7e-9, one of 0.80 with 3e-6.
BANDS, ROWS = 32, 5
HASHES = BANDS * ROWS
#: Hashes compared at a time, and the probability at which a pair is given up.
BATCH, MISS = 32, 1e-7
#: Nodes of a tile, text bytes of a tile that is compared by its texts, and nodes that are compared with a tile at a time.
TILE, TILE_BYTES, BLOCK = 4096, 8 << 20, 128
#: Pairs that one copy of a node's text is compared in.
FAN = 256
SLICE_BYTES = 1 << 20
#: Bits of the bitmap of rows whose texts are read; 4 MB.
MAP_BITS = 25

#: What ``mapInArrow`` runs on the batches of a partition.
Task = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]

_RANDOM = np.random.default_rng(77)
_A = _RANDOM.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RANDOM.integers(0, 1 << 63, HASHES, dtype=np.uint64)


def least_matches(percent: int = PERCENT, miss: float = MISS) -> list[int]:
    """Matches that a pair needs after each batch of hashes.

    With every similarity equally likely beforehand, the probability of a similarity of at least
    t after m matches in n hashes is that of at most m successes in n + 1 trials at t.
    """
    t, needed = percent / 100, []
    for n in range(BATCH, HASHES + 1, BATCH):
        total = 0.0
        for m in range(n + 1):
            total += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if total >= miss:
                needed.append(m)
                break
    return needed


def signature(shingles: np.ndarray) -> np.ndarray:
    """16 bits of the smallest value of each hash function over the set."""
    low = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 2048):
        part = shingles[at : at + 2048, None] * _A + _B
        np.minimum(low, part.min(axis=0), out=low)
    return (low >> np.uint64(40)).astype(np.uint16)


def _shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """Sorted distinct shingles of each text."""
    words = Words(texts, SOLID)
    for a, b in zip(words.at[:-1], words.at[1:], strict=True):
        yield np.unique(shingle_hashes(words.hash[a:b], SHINGLE))


def _node(shingles: np.ndarray) -> bytes | None:
    return blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", SLICE_BYTES):
        sizes, nodes, signatures = [], [], []
        for shingles in _shingle_sets(filled(batch.column("text"))):
            sizes.append(len(shingles))
            nodes.append(_node(shingles))
            signatures.append(signature(shingles).tobytes() if len(shingles) else None)
        lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column("text")), 0).cast(pa.int64())
        made = [pa.array(sizes, pa.int64()), pa.array(nodes, pa.binary()), pa.array(signatures, pa.binary()), lengths]
        yield pa.record_batch([batch.column("doc_id"), batch.column("key1"), batch.column("key2"), *made], names=["doc_id", "key1", "key2", "n_shingles", "node", "signature", "size"])


def _matrix(column: pa.Array) -> np.ndarray:
    """Signatures of a column as rows."""
    column = column.cast(pa.large_binary())
    if len(column) == 0:
        return np.zeros((0, HASHES), np.uint16)
    data = np.frombuffer(column.buffers()[2], np.uint8)
    at = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    return data[at[0] : at[-1]].view(np.uint16).reshape(len(column), HASHES)


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = _matrix(batch.column("signature")).reshape(-1, BANDS, ROWS).astype(np.uint64)
        key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), rows.shape[:2]).copy()
        for k in range(ROWS):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, :, k])
        again = pa.array(np.repeat(np.arange(len(rows)), BANDS))
        yield pa.record_batch([pa.array(key.ravel().view(np.int64)), batch.column("node").take(again)], names=["key", "node"])


def _compare(percent: int) -> Task:
    """Pairs whose signatures agree often enough after every batch of hashes, with their matches."""
    needed = least_matches(percent)

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = _matrix(batch.column("x")), _matrix(batch.column("y"))
            left, matches = np.arange(len(x)), np.zeros(len(x), np.int64)
            for k, need in enumerate(needed):
                span = slice(k * BATCH, (k + 1) * BATCH)
                matches = matches + (x[left, span] == y[left, span]).sum(axis=1)
                keep = matches >= need
                left, matches = left[keep], matches[keep]
            at = pa.array(left)
            yield pa.record_batch([batch.column("a").take(at), batch.column("b").take(at), pa.array(matches, pa.int64())], names=["a", "b", "matches"])

    return compared


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of the rows of each group, for rows sorted by the keys; a group may go over several batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        values = list(zip(*(batch.column(k).to_pylist() for k in keys), strict=True))
        start = 0
        for i, value in enumerate(values):
            if value != last:
                if i > start:
                    held.append(batch.slice(start, i - start))
                if held:
                    yield pa.Table.from_batches(held)
                held, last, start = [], value, i
        held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


class _Forest:
    """Sets of things that were joined."""

    def __init__(self, of: np.ndarray):
        self.parent = {int(x): int(x) for x in of}

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, x: int, y: int) -> None:
        self.parent[self.find(y)] = self.find(x)


class _Tiles:
    """The rows of two tiles (or of one), and the likely pairs of different roots among them."""

    def __init__(self, table: pa.Table, percent: int):
        self.table, self.needed = table, least_matches(percent)
        self.rows = _matrix(pa.concat_arrays(table["signature"].chunks))
        _, self.root = np.unique(np.array(table["root"].to_pylist(), object), return_inverse=True)
        sides, (first, second) = table["tile"].to_numpy(), (table[c][0].as_py() for c in ("first", "second"))
        self.x, self.y, self.one = np.flatnonzero(sides == first), np.flatnonzero(sides == second), first == second
        self.forest = _Forest(np.unique(self.root))
        self.trees: np.ndarray | None = None  # of the roots, until the next join

    def likely(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs that agree often enough and that no join has put into one tree yet, a block at a time, the best of a block first."""
        for a in range(0, len(self.x), BLOCK):
            if self.trees is None:
                self.trees = np.array([self.forest.find(r) for r in range(len(self.forest.parent))])[self.root]
            trees = self.trees
            own = self.x[a : a + BLOCK]
            open_pairs = trees[own][:, None] != trees[self.y][None, :]
            if self.one:
                open_pairs &= own[:, None] < self.y[None, :]
            i, j = np.nonzero(open_pairs)
            i, j, matches = own[i], self.y[j], np.zeros(len(i), np.int64)
            for k, need in enumerate(self.needed):
                span = slice(k * BATCH, (k + 1) * BATCH)
                matches = matches + np.concatenate([(self.rows[i[c : c + 65536], span] == self.rows[j[c : c + 65536], span]).sum(axis=1) for c in range(0, len(i), 65536)] or [np.zeros(0, np.int64)])
                keep = matches >= need
                i, j, matches = i[keep], j[keep], matches[keep]
            order = np.argsort(-matches, kind="stable")
            yield i[order], j[order]

    def join(self, test: Callable[[int, int], bool] | None = None) -> pa.RecordBatch:
        """Likely pairs that pass the test and join what those before left apart; others are not tested."""
        found = []
        for x, y in self.likely():
            for i, j in zip(x.tolist(), y.tolist(), strict=True):
                a, b = self.forest.find(int(self.root[i])), self.forest.find(int(self.root[j]))
                if a != b and (test is None or test(i, j)):
                    self.forest.join(a, b)
                    self.trees = None
                    found.append((i, j))
        return _node_pairs(self.table, found)


def _spanning_likely(percent: int) -> Task:
    """Likely pairs that join the roots of each pair of tiles as all of them do."""

    def spanning(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, ["key", "first", "second"]):
            yield _Tiles(table, percent).join()

    return spanning


def _in_likely_pairs(percent: int) -> Task:
    """The nodes of each pair of tiles that are in a likely pair of different roots there."""

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, ["key", "first", "second"]):
            used = np.zeros(len(table), bool)
            for x, y in _Tiles(table, percent).likely():
                used[x] = used[y] = True
            for batch in table.take(pa.array(np.flatnonzero(used))).to_batches():
                yield batch

    return nodes


def _spanning_links(percent: int) -> Task:
    """Verified links that join the roots of each pair of tiles as all links do."""

    def spanning(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, ["key", "first", "second"]):
            sets: list[np.ndarray] = []
            for rows in range(0, len(table), 64):
                sets += _shingle_sets(filled(pa.concat_arrays(table["text"].slice(rows, 64).chunks)))
            yield _Tiles(table, percent).join(lambda i, j, sets=sets: _linked(sets[i], sets[j], percent))

    return spanning


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets are similar enough."""
    at = np.searchsorted(x, y)
    common = int((x[np.minimum(at, len(x) - 1)] == y).sum())
    return 100 * common >= percent * (len(x) + len(y) - common)


def _node_pairs(table: pa.Table, found: list[tuple[int, int]]) -> pa.RecordBatch:
    nodes = pa.concat_arrays(table["node"].chunks)
    return pa.record_batch([nodes.take(pa.array([p[k] for p in found], pa.int64())) for k in (0, 1)], names=["a", "b"])


def _verify(percent: int) -> Task:
    """Links among pairs (a, b), for rows sorted so that the text of a, with no b, stands before those of its partners."""

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, own = None, np.zeros(0, np.uint64)
        for batch in slices(batches, "text", SLICE_BYTES):
            a, salt, b = (batch.column(c).to_pylist() for c in ("a", "salt", "b"))
            links = []
            for i, shingles in enumerate(_shingle_sets(filled(batch.column("text")))):
                if b[i] is None:
                    key, own = (a[i], salt[i]), shingles
                elif key != (a[i], salt[i]):
                    raise ValueError("the text of a candidate is missing")
                elif _linked(own, shingles, percent):
                    links.append((a[i], b[i]))
            yield pa.record_batch([pa.array([x[k] for x in links], pa.binary()) for k in (0, 1)], names=["a", "b"])

    return verified


def _verified(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The links among distinct pairs (a, b). Each b's text is sent once per pair, each a's once per ``FAN`` pairs."""
    counts = pairs.groupBy("a").agg(F.ceil(F.count("*") / FAN).alias("fans"))
    dealt = pairs.join(counts, "a").select("a", "b", F.pmod(F.xxhash64("b"), "fans").alias("salt"))
    dealt = stored(dealt, "pairs")
    partners = dealt.join(texts, dealt["b"] == texts["node"]).select("a", "salt", "b", "text")
    centers = dealt.select("a", "salt").distinct().join(texts, F.col("a") == texts["node"])
    both = partners.unionByName(centers.select("a", "salt", F.lit(None).cast("binary").alias("b"), "text"))
    sorted_rows = both.repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
    return stored(sorted_rows.mapInArrow(_verify(percent), "a binary, b binary"), "verified")


def _with_roots(nodes: DataFrame, roots: DataFrame, name: str = "root") -> DataFrame:
    """Adds to rows with ``node`` the component's root, or the node itself."""
    found = roots.select(F.col("node").alias("_node"), F.col("root").alias(name))
    return nodes.join(found, nodes["node"] == F.col("_node"), "left").drop("_node").withColumn(name, F.coalesce(name, "node"))


def _tiled(rows: DataFrame) -> DataFrame:
    """Rows (key, node, root, size) for each pair of tiles that they are compared in: (key, first, second, tile, node, root).

    Keys whose rows have one root go. The root with the most rows of a key has tiles of its own,
    which are not compared among themselves; what fits into one tile by rows and by the sum of ``size`` is one.
    """

    def parts(count: Column, size: Column) -> Column:
        return F.greatest(F.ceil(count / TILE), F.ceil(size / TILE_BYTES), F.lit(1))

    sizes = rows.groupBy("key", "root").agg(F.count("*").alias("n"), F.sum("size").alias("s"))
    most = F.max(F.struct("n", "root", "s")).alias("most")
    keys = sizes.groupBy("key").agg(most, F.sum("n").alias("n"), F.sum("s").alias("s")).where("n > most.n")
    small = parts(F.col("n"), F.col("s")) == 1
    big_tiles = F.when(small, 0).otherwise(parts(F.col("most.n"), F.col("most.s"))).cast("int")
    tiles = F.when(small, 1).otherwise(parts(F.col("n") - F.col("most.n"), F.col("s") - F.col("most.s"))).cast("int")
    keys = stored(keys.select("key", F.col("most.root").alias("big"), big_tiles.alias("big_tiles"), tiles.alias("tiles")), "tiles")
    found = rows.join(keys, "key")
    in_big = (F.col("root") == F.col("big")) & (F.col("big_tiles") > 0)
    number = F.xxhash64("node")
    tile = F.when(in_big, F.pmod(number, F.greatest("big_tiles", F.lit(1)))).otherwise(F.col("big_tiles") + F.pmod(number, "tiles")).cast("int")
    other = F.explode(F.sequence(F.when(in_big, F.col("big_tiles")).otherwise(0), F.col("big_tiles") + F.col("tiles") - 1))
    found = found.select("key", "node", "root", tile.alias("tile"), other.alias("other"))
    return found.select("key", F.least("tile", "other").alias("first"), F.greatest("tile", "other").alias("second"), "tile", "node", "root")


def _key_bitmap(keys: DataFrame) -> np.ndarray:
    """Bitmap of the leading bits of a column ``key1``; its size is fixed, whatever the number of keys."""
    spot = F.shiftrightunsigned("key1", 64 - MAP_BITS)
    word, bit = F.shiftright(spot, 5).cast("int").alias("word"), F.call_function("shiftleft", F.lit(1).cast("bigint"), (spot % 32).cast("int"))
    found = keys.groupBy(word).agg(F.bit_or(bit).alias("bits")).toArrow()
    words = np.zeros(1 << (MAP_BITS - 5), np.uint32)
    words[found["word"].to_numpy()] = found["bits"].to_numpy().astype(np.uint32)
    return words


def _rows_in(bitmap) -> Task:
    """The rows whose key's bit is set."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = bitmap.value
        for batch in batches:
            spot = batch.column("key1").to_numpy().view(np.uint64) >> np.uint64(64 - MAP_BITS)
            inside = words[(spot >> np.uint64(5)).astype(np.int64)] >> (spot & np.uint64(31)).astype(np.uint32) & np.uint32(1)
            yield batch.take(pa.array(np.flatnonzero(inside)))

    return rows


def _clustered_texts(docs: DataFrame, signed: DataFrame, clusters: DataFrame) -> DataFrame:
    """One text (node, text) of each node of a cluster. A text is shuffled if the bitmap lets its row through."""
    chosen = signed.where("node is not null").join(clusters.select("node"), "node", "left_semi")
    chosen = chosen.groupBy("node").agg(F.min(F.struct("key1", "key2")).alias("key")).select("node", "key.key1", "key.key2")
    chosen = stored(chosen, "clustered-rows")
    bitmap = docs.sparkSession.sparkContext.broadcast(_key_bitmap(chosen))
    rows = docs.select(*_row_keys(), "text").mapInArrow(_rows_in(bitmap), "key1 bigint, key2 bigint, text string")
    texts = stored(rows.join(chosen, ["key1", "key2"]).dropDuplicates(["key1", "key2"]).select("node", "text"), "texts")
    drop(chosen)
    return texts


def _links(docs: DataFrame, signed: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Verified links between nodes (node, signature, size) that give their components."""
    bands = nodes.select("node", "signature").mapInArrow(_bands, "key bigint, node binary")
    shared = bands.groupBy("key").agg(F.min("node").alias("center"), F.count("*").alias("n")).where("n > 1")
    buckets = stored(shared, "buckets")
    members = stored(bands.join(buckets, "key"), "members")
    drop(buckets)
    candidates = members.select("node").distinct()
    signatures = stored(nodes.join(candidates, "node", "left_semi").select("node", "signature", "size"), "candidate-signatures")
    whole = signatures.select("node", "signature")

    star = members.where("node != center").select(F.col("center").alias("a"), F.col("node").alias("b")).distinct()
    x = signatures.select(F.col("node").alias("a"), F.col("signature").alias("x"))
    y = signatures.select(F.col("node").alias("b"), F.col("signature").alias("y"))
    likely = stored(star.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(_compare(percent), "a binary, b binary, matches bigint"), "likely")
    keys = ["key", "first", "second"]
    rows = [*keys, "tile", "node", "root", "signature"]
    near_roots = stored(components(likely), "near")
    near = _with_roots(members.where("n > 2").select("key", "node", F.lit(0).alias("size")), near_roots)
    crossing = _tiled(near).join(whole, "node").repartition(*keys).sortWithinPartitions(*keys)
    more = crossing.select(*rows).mapInArrow(_spanning_likely(percent), "a binary, b binary")
    spanning = stored(likely.select("a", "b").unionByName(more), "spanning")
    drop(members, near_roots)
    clusters = stored(components(spanning), "clusters")
    drop(spanning)

    texts = _clustered_texts(docs, signed, clusters)
    best = likely.groupBy("b").agg(F.max_by("a", F.struct("matches", "a")).alias("a")).select("a", "b")
    links = _verified(best, texts, percent)
    first_roots = stored(components(links), "first-roots")
    sized = clusters.select("node", F.col("root").alias("key")).join(signatures.select("node", "size"), "node")
    tiled = _tiled(_with_roots(sized, first_roots)).join(whole, "node").repartition(*keys).sortWithinPartitions(*keys)
    kinds = "key binary, first int, second int, tile int, node binary, root binary, signature binary"
    wanted = stored(tiled.select(*rows).mapInArrow(_in_likely_pairs(percent), kinds), "likely-nodes")
    inside = wanted.join(texts, "node").repartition(*keys).sortWithinPartitions(*keys)
    rest = stored(inside.select(*rows, "text").mapInArrow(_spanning_links(percent), "a binary, b binary"), "rest")
    drop(wanted, texts, likely, signatures, clusters, first_roots)
    return links.unionByName(rest)


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Rows (doc_id, key1, key2, n_shingles, node, root, component_id, kept), one for each of the documents (doc_id, text).

    Words are runs of other than white space with A-Z lower-cased. A text with fewer than five
    words is one shingle; without words, or null, it has none and is linked with nothing.
    Documents are linked from a similarity of ``percent`` hundredths up. ``component_id`` is the
    smallest id reachable by links, itself included, and the document with that id is kept. Documents with
    equal sets, so also repeated rows, are one component; of rows that share the smallest id all
    are marked as kept. A null id counts as larger than others; a component of null ids only
    has a null ``component_id`` and is kept. ``root`` tells components apart, also those with
    equal ids; it is null without words. The keys are hashes of id and text. Other columns
    are ignored, an empty table gives none.
    """
    keyed = docs.select("doc_id", *_row_keys(), "text")
    kind = dict(docs.dtypes)["doc_id"]
    signed = stored(keyed.mapInArrow(_sign, f"doc_id {kind}, key1 bigint, key2 bigint, n_shingles bigint, node binary, signature binary, size bigint"), "signed")
    nodes = signed.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("least_id"), F.first("signature").alias("signature"), F.max("size").alias("size"))
    nodes = stored(nodes, "nodes")
    roots = components(_links(docs, signed, nodes, percent))
    rooted = _with_roots(nodes.select("node", "least_id"), roots)
    ids = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = rooted.join(ids, "root").select(F.col("node").alias("_node"), "root", "component_id")
    whole = signed.select("doc_id", "key1", "key2", "n_shingles", "node").join(named, F.col("node") == F.col("_node"), "left").drop("_node")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return whole.withColumn("component_id", component).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _row_keys() -> list[Column]:
    """128 bits that tell rows apart by id and text."""
    return [F.xxhash64(F.lit(k), "doc_id", "text").alias(f"key{k}") for k in (1, 2)]


def without_near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One document of each component, with the documents' columns; documents without words all stay.

    Of several texts with the kept id, or of null ids only, one stays; so does one of several
    rows without words that agree in id and text. The documents are shuffled once, and repeated
    rows go before.
    """
    empty = [F.when(F.col("root").isNull(), F.col(k)).alias(f"empty_{k}") for k in ("key1", "key2")]
    chosen = near_duplicates(docs, percent).where("kept").groupBy("root", *empty)
    chosen = chosen.agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key1", "key2")).alias("key"))
    names = unused(docs, "_key1", "_key2")
    kept = stored(chosen.select(*[F.col(f"key.key{k}").alias(n) for k, n in zip((1, 2), names, strict=True)]), "kept")
    single = docs.select("*", *[c.alias(n) for c, n in zip(_row_keys(), names, strict=True)]).dropDuplicates(names)
    return single.join(kept, names, "left_semi").select(*docs.columns)
