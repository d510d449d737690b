"""Whitening, token alignment and token files: brute force, exact round trips and defined edge cases."""

import random
import tracemalloc
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cardwarden.llm import alignment, segments, token_files, whitening
from cardwarden.llm.queries import QUERIES

tokenizers = pytest.importorskip("tokenizers")
pytest.importorskip("sentencepiece")
P = pytest.importorskip("public_tokenizers")

NAMES = [f"w{i}" for i in range(300)] + ["Straße", "naïve", "don't", "日本語", "Ａ", "é", "H̱", "x.y", "1,234.50", "dogs'", "'s", "it's!", "ὈΔΥΣΣΕΎΣ", "İstanbul"]
#: What tokenizers may treat in a special way, also beside each other.
ODD = ["", " ", "  ", "\n", "\t ", " ", "  ", "　", "\x1c", "\x85", "​", "﻿", "<|endoftext|>", "<|startoftext|>x", "x<|endoftext|>", "</w>", "<s>", "</s>", "<0x41>", "▁", "\x00", "😀", "👩‍💻", "́", "'RE", "'ll", "!!'s", "don't.", "A" * 90, "é" * 70]


def mixed_text(seed):
    draw = random.Random(seed)
    parts = draw.choices(NAMES, k=draw.randrange(60)) + draw.choices(ODD, k=draw.randrange(12))
    draw.shuffle(parts)
    return "".join(p + draw.choice([" ", " ", " ", "  ", "\n", "", ", ", "\n "]) for p in parts)


TEXTS = [None, "", " ", "x ", " x", "one", "one", " ".join(NAMES) * 3, "日" * 5000, "a" * 3000] + [mixed_text(i) for i in range(120)] + ODD


@pytest.fixture(scope="module")
def docs(spark):
    """Odd and mixed texts, repeated rows, null and repeated ids; with columns whose names clash."""
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(7, TEXTS[7]), (7, "another"), (None, "no id"), (None, None)]
    clash = ("a", "b", "times", "row", "file", "value", "mark", "content", "ids", "whitening")
    return spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3).withColumns({c: F.lit(7) for c in clash})


# Token files -----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def words_json():
    with open(P.path("word_bpe_49k.json")) as file:
        return file.read()


def test_by_word_gives_the_ids_of_whole_texts(words_json):
    texts = [t for t in TEXTS if t] + [mixed_text(1000 + i) for i in range(400)]
    expected = tokenizers.Tokenizer.from_str(words_json).encode_batch(texts, add_special_tokens=False)
    for by_word in (True, False):
        ids, counts = token_files.Encoder(words_json, by_word)(pa.array(texts, pa.large_string()))
        found = np.split(ids, np.cumsum(counts)[:-1])
        assert [f.tolist() for f in found] == [e.ids for e in expected]


def test_task_holds_little_beside_its_texts(words_json, monkeypatch):
    """A task's memory doesn't grow with the texts that it has encoded, nor with the size of a batch."""
    draw = random.Random(4)
    names = ["".join(draw.choices("abcdefghij", k=6)) for _ in range(5000)]
    batch = pa.record_batch([pa.array(range(600)), pa.array([" ".join(draw.choices(names, k=1500)) for _ in range(600)])], ["doc_id", "text"])
    shipped = type("Shipped", (), {"value": (b"", None)})()
    tokenizer = type("Shipped", (), {"value": words_json})()
    monkeypatch.setattr(token_files, "TaskContext", type("Context", (), {"get": lambda: type("Task", (), {"partitionId": lambda self: 0})()}))
    parts = token_files._file_parts(tokenizer, True, 2, 2, shipped)
    next(parts(iter([batch.slice(0, 1)])))
    tracemalloc.start()
    try:
        assert sum(b.num_rows for b in parts(iter([batch]))) > 600
        assert tracemalloc.get_traced_memory()[1] < 60 << 20
    finally:
        tracemalloc.stop()


def test_segments_are_forgotten_and_learnt_again(words_json, monkeypatch):
    monkeypatch.setattr(segments, "MOST_SEGMENTS", 5)
    encode, plain = token_files.Encoder(words_json, True), tokenizers.Tokenizer.from_str(words_json)
    for text in (t for t in TEXTS if t):
        ids, _ = encode(pa.array([text, text], pa.large_string()))
        assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids * 2


def test_known_words_change_nothing(words_json):
    some, texts = pa.array([t for t in TEXTS[:60] if t], pa.large_string()), pa.array([t for t in TEXTS if t], pa.large_string())
    first = token_files.Encoder(words_json, True)
    first(some)
    expected, found = token_files.Encoder(words_json, True)(texts), token_files.Encoder(words_json, True, first.known.state())(texts)
    assert all((x == y).all() for x, y in zip(expected, found))


def test_token_files(spark, docs, words_json, tmp_path):
    tokenizer, folder = tokenizers.Tokenizer.from_str(words_json), str(tmp_path / "tokens")
    token_files.write_token_files(docs, folder, words_json, end_id=2, by_word=True, width=2)
    rows = token_files.read_token_digests(spark, folder).collect()
    assert len(rows) == docs.count()
    rows.sort(key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted((r.doc_id for r in rows if r.doc_id is not None)) + [None, None]
    total, texts = 0, defaultdict(list)
    for r in docs.select("doc_id", "text").collect():
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [2]
        texts[r.doc_id].append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    found = defaultdict(list)
    for r in rows:
        assert r.start == total
        total += r.n_tokens
        found[r.doc_id].append((r.n_tokens, r.ids_crc32))
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in texts.items()}
    few = token_files.read_documents(spark, folder, [5, 9, 10_000]).collect()
    assert {r.doc_id: r.ids for r in few} == {i: tokenizer.encode(TEXTS[i], add_special_tokens=False).ids + [2] for i in (5, 9)}


def test_token_file_checks_its_dictionary(spark, words_json, tmp_path):
    folder = str(tmp_path / "tokens")
    some = spark.createDataFrame([(i, mixed_text(i)) for i in range(40)], "doc_id int, text string")
    token_files.write_token_files(some, folder, words_json)
    dictionary = token_files.read_dictionary(spark, folder)
    content = next(bytes(r.content) for r in token_files._files(spark, folder).collect() if len(r.content))
    assert len(token_files.TokenFile(content, dictionary).count)
    with pytest.raises(ValueError, match="dictionary"):
        token_files.TokenFile(content, dictionary + b"x")


def test_token_files_of_nothing(docs, words_json):
    assert token_files.token_digests(docs.where("false"), words_json).count() == 0
    only = token_files.token_digests(docs.where("text is null and doc_id is not null"), words_json, end_id=2).collect()
    assert [(r.start, r.n_tokens) for r in only] == [(0, 1)]


def test_dictionary_of_few_documents_is_their_bytes():
    assert token_files._dictionary([]) == b""
    assert token_files._dictionary([b"12345678"]) == b"12345678"


# Alignment -------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def files():
    with open(P.path("byte_bpe_50k.json")) as one, open(P.path("piece_bpe_32k.model"), "rb") as other:
        return alignment.Tokenizers(one.read(), other.read())


def aligned_plainly(files, texts):
    """Figures of each text by whole encodings, a set intersection and nested loops."""
    pair, rows, count = alignment.Pair(files), [], Counter()
    for text in texts:
        raw = f" {text or ''}".encode()
        a = pair.first.encode(raw.decode(), add_special_tokens=False).ids if text else []
        b = pair.second.encode(text) if text else []
        bytes_a, bytes_b = [pair.first_bytes[i] for i in a], [pair.second_bytes[i] for i in b]
        if not text or b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
            rows.append(None)
            continue
        ends_a, ends_b = (np.cumsum([len(x) for x in side]).tolist() for side in (bytes_a, bytes_b))
        groups, i, j = [], 0, 0
        for cut in sorted(set(ends_a) & set(ends_b)):
            m, n = ends_a.index(cut) + 1, ends_b.index(cut) + 1
            groups.append((a[i:m], b[j:n]))
            i, j = m, n
        links = Counter((x, y) for g, h in groups for x in g for y in h)
        count.update(links.keys())
        rows.append((a, b, groups, links))
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    for row in rows:
        if row is None:
            yield (0, 0, 0, 0, "", 0, 0)
            continue
        a, b, groups, links = row
        text = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        sums = (sum(m for p, m in links.items() if count[p] == best[p[0]]), sum(m * count[p] for p, m in links.items()))
        yield (len(a), len(b), len(groups), sum(links.values()), sha256(text.encode()).hexdigest(), *sums)


FIGURES = ("n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum")


@pytest.mark.parametrize("common", [alignment.COMMON_PAIRS, 40, 0])
def test_aligned(docs, files, common):
    given = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    expected = Counter((i, *figures) for (i, _), figures in zip(given, aligned_plainly(files, [t for _, t in given])))
    rows = alignment.aligned(docs, files, common).collect()
    assert Counter((r.doc_id, *(r[c] for c in FIGURES)) for r in rows) == expected


def test_aligned_with_large_groups(spark, files, monkeypatch):
    monkeypatch.setattr(alignment, "LARGE_GROUP", 1)
    texts = TEXTS[-60:]
    given = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = {r.doc_id: tuple(r[c] for c in FIGURES) for r in alignment.aligned(given, files).collect()}
    assert rows == dict(enumerate(aligned_plainly(files, texts)))


def test_aligned_of_nothing(docs, files):
    assert alignment.aligned(docs.where("false"), files).count() == 0
    assert [tuple(r)[1:] for r in alignment.aligned(docs.where("text = '▁'"), files).collect()] == [(0, 0, 0, 0, "", 0, 0)]


def test_shared_ends():
    draw = np.random.default_rng(4)
    for density in (0.05, 0.3, 0.9):
        for _ in range(60):
            ends, others, last, at = [], [], [], 0
            for _ in range(draw.integers(1, 5)):
                span = int(draw.integers(1, 80))
                for side in (ends, others):
                    inside = np.flatnonzero(draw.random(span - 1) < density) + 1
                    side += [*(at + inside).tolist(), at + span]
                last.append(len(ends) - 1)
                at += span
            found = alignment.shared_ends(*map(np.array, (ends, others, last)))
            assert [ends[i] for i in found] == sorted(set(ends) & set(others))


# Whitening -------------------------------------------------------------------------------


def test_bit_sliced_scatter():
    draw = np.random.default_rng(1)
    for bits in (1, 7, 20, 40, 62):
        for n in (1, 63, 64, 200):
            rows = draw.integers(0, 1 << bits, (n, 5)).astype(np.uint64)
            plain = [[sum(int(r[i]) * int(r[j]) for r in rows) for j in range(5)] for i in range(5)]
            assert whitening.bit_sliced_scatter(rows).tolist() == plain


def plain_whitening(x):
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = (fit * n - sums) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][: whitening.COMPONENTS], vectors[:, ::-1][:, : whitening.COMPONENTS]
    return n, sums, values, (x * n - sums) / n @ vectors / np.sqrt(values)


def vectors_frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)


def test_whitened(spark):
    draw = np.random.default_rng(2)
    base = draw.normal(size=(300, 20)) @ draw.normal(size=(20, 20))
    base[200:] = base[:100]
    rows = [(i, r.tolist()) for i, r in enumerate(base)]
    bad = [(900, None), (901, [None] * 20), (902, [float("nan")] * 20), (903, [float("inf"), *[0.0] * 19]), (None, rows[5][1])]
    found = whitening.whitened(vectors_frame(spark, rows + bad).withColumns({"dim": F.lit(1), "_whitening": F.lit(2), "whitening": F.lit(3)}))
    assert found.columns == ["vec_id", "embedding", "dim", "_whitening", "whitening"]
    got = {r.vec_id: r.whitening for r in found.collect()}
    assert set(got) == {*range(300), None}
    x = np.floor(64 * base).astype(np.int64) + 1_000_000
    n, sums, values, expected = plain_whitening(x)
    w = np.array([got[i].whitened for i in range(300)])
    signs = np.sign((w * expected).sum(axis=0))
    assert np.allclose(w * signs, expected, atol=1e-8) and got[None].whitened == got[5].whitened
    for i in range(300):
        assert got[i].n == n == 200 and int(got[i].deviation) == int(((n * x[i] - sums) ** 2).sum())
        assert np.allclose(got[i].explained, values / values_total(x), rtol=1e-9) and got[i].identity_error < 1e-9


def values_total(x):
    fit = np.unique(x, axis=0)
    return fit.var(axis=0).sum()


def test_whitened_edges(spark):
    rows = [(1, [1e300, 1.0]), (2, [-1e300, 2.0]), (3, [0.0, 2.0]), (4, [0.0, 2.0]), (5, [7.0]), (6, []), (7, [1.0, 0.0, 5.0]), (8, [2.0, 0.0, 5.0])]
    got = {r.vec_id: r.whitening for r in whitening.whitened(vectors_frame(spark, rows)).collect()}
    assert [got[i].n for i in range(1, 9)] == [3, 3, 3, 3, 1, 0, 2, 2]
    assert got[3] == got[4] and all(np.isfinite(v) for v in got[1].whitened if v is not None)
    ends = [int(c * 64) + 1_000_000 for c in (2.0**55, -(2.0**55), 0.0)]
    second = [64 + 1_000_000, 128 + 1_000_000, 128 + 1_000_000]
    assert int(got[1].deviation) == (3 * ends[0] - sum(ends)) ** 2 + (3 * second[0] - sum(second)) ** 2
    assert got[5].whitened == [None] and got[5].explained == [None] and got[6].whitened == []
    assert [abs(v) if v is not None else None for v in got[7].whitened] == [pytest.approx(1.0), None, None]
    assert got[7].explained[0] == pytest.approx(1.0)
    assert whitening.whitened(vectors_frame(spark, rows).where("false")).count() == 0


def test_limbs():
    for value in (0, 1, -1, 3 << 130, -(5 << 131) - 7, (1 << 40) - 1):
        parts = [int(p[0]) for p in whitening._limbs([value])]
        assert sum(p << (whitening.LIMB * k) for k, p in enumerate(parts)) == value


def test_queries(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert QUERIES["op13_token_files"](spark, sf_dir).count() == docs
    rows = QUERIES["op12_token_alignment"](spark, sf_dir).where("n_a > 0 and n_b > 0 and n_links >= n_groups and n_best <= n_links").count()
    assert rows == docs
    found = QUERIES["op11_whitening"](spark, sf_dir)
    assert found.count() == 16 * spark.read.parquet(f"{sf_dir}/embeddings.parquet").count()
    assert found.where("identity_error > 0.0001 or deviation is null or whitened is null").count() == 0
