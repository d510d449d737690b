"""The training-data operators on small tables: defined edge cases, brute force and twins."""

import random
import re
import zlib
from collections import Counter
from hashlib import sha256
from pathlib import Path

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from oracle_check import connect, difference
from pyspark.sql import functions as F

from cardwarden.llm import decontamination, graph, language, learning, mixing, near_duplicates, quality, sharding, toxicity, vectors
from cardwarden.llm.chat import assemble, conversation_digests, escape, format_conversations, read_turns, unescape
from cardwarden.llm.graph import components
from cardwarden.llm.oracle import SQL
from cardwarden.llm.pages import Page, host_paths, with_main_text
from cardwarden.llm.queries import QUERIES
from cardwarden.llm.storage import work_folder

KIND = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = [f"w{i}" for i in range(400)]
ODD = [None, "", "  \n ", "one", "ÄÖ été 漢字", "x " * 3000, "one"]


def prose(seed, n=60):
    return " ".join(random.Random(seed).choices(WORDS, k=n))


@pytest.fixture(scope="module")
def docs(spark):
    """Odd texts, repeated rows, null ids and sources, copies, and prose; with columns whose names clash."""
    rows = [(i, t, "en", "a" if i % 2 else None, 0) for i, t in enumerate(ODD)]
    rows += [(100 + i, prose(i // 2), "en" if i % 3 else None, "bc"[i % 2], 1) for i in range(30)]
    rows += [(100, prose(0), "en", "b", 1), (None, None, None, None, None), (None, prose(3), None, "c", None)]
    frame = spark.createDataFrame(rows, KIND).repartition(3)
    clash = ("size", "_size", "_mark", "_key", "_part", "_name", "node", "rep", "key1", "score", "found", "_found")
    return frame.withColumns({c: F.lit(7) for c in clash})


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


@pytest.mark.parametrize("name", sorted(SQL))
def test_twins(spark, sf_dir, name):
    assert difference(QUERIES[name](spark, sf_dir), connect(sf_dir), SQL[name]) is None


def test_components(spark):
    draw = random.Random(1)
    links = [(draw.randrange(300), draw.randrange(300)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5, 5)]
    parent = {}
    find = lambda x: x if parent.setdefault(x, x) == x else find(parent[x])
    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    linked = {x for p in links for x in p if p[0] != p[1]}
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert found == {x: find(x) for x in linked}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_components_in_few_steps(spark, monkeypatch):
    """A long chain, stars and copies need two tables; graphs beyond a task's bound give the same by steps."""
    chain = [(i * 7919 % 3001, (i + 1) * 7919 % 3001) for i in range(3000)]
    links = chain + [(9000, 5000 + i) for i in range(400)] + [(8001, 8000)] * 50
    frame = spark.createDataFrame(links, "a bigint, b bigint").repartition(5)
    frame = frame.select(*[F.encode(F.format_string("%05d", k), "utf-8").alias(k) for k in "ab"])
    made, store = [], graph.stored
    monkeypatch.setattr(graph, "stored", lambda rows, label: made.append(label) or store(rows, label))
    found = {(bytes(r.node), bytes(r.root)) for r in components(frame).collect()}
    assert len(made) <= 2
    expected = {(i, 0) for i in range(3001)} | {(5000 + i, 5000) for i in range(400)} | {(9000, 5000), (8000, 8000), (8001, 8000)}
    assert found == {(b"%05d" % n, b"%05d" % r) for n, r in expected}
    monkeypatch.setattr(graph, "LINKS", 100)
    assert {(bytes(r.node), bytes(r.root)) for r in components(frame).collect()} == found
    assert len(made) > 4


def test_memory_of_a_fit_goes_back(monkeypatch):
    released = []
    pool = type("Pool", (), {"release_unused": lambda self: released.append(True)})()
    monkeypatch.setattr(learning.pa, "default_memory_pool", lambda: pool)
    assert learning.fitted(lambda texts, labels: (len(texts), labels), (pa.array(["a", "b"]), [0, 1])) == (2, [0, 1])
    assert released == [True]


def test_knapsack_is_exact():
    draw = np.random.default_rng(3)
    for _ in range(40):
        lengths = np.unique(draw.integers(1, 60, 6))
        counts = draw.integers(0, 4, len(lengths))
        sums = {0}
        for n, c in zip(lengths.tolist(), counts.tolist()):
            sums = {s + k * n for s in sums for k in range(c + 1)}
        budget = int(draw.integers(0, 1 + (lengths * counts).sum()))
        taken = mixing.fitted_counts(lengths, counts, budget, 1)
        assert (taken <= counts).all() and (taken >= 0).all()
        assert abs(int((taken * lengths).sum()) - budget) == min(abs(s - budget) for s in sums)


def test_mix(docs, none):
    rows = mixing.mix(docs).select("doc_id", "source", "text", "mix.*").collect()
    assert len(rows) == docs.count() and sorted(map(repr, rows)) == sorted(map(repr, mixing.mix(docs).select("doc_id", "source", "text", "mix.*").collect()))
    sizes = Counter()
    for r in rows:
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) and 0 <= r.copies <= 2
        sizes[r.source] += r.size
    names = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, budget, open_names = {}, 1.5 * sum(sizes.values()), set(names)
    while True:
        rate = (budget - sum(target.values())) / sum(weight[s] for s in open_names)
        over = {s for s in open_names if rate * weight[s] > 2 * sizes[s]}
        if not over:
            break
        target |= {s: 2.0 * sizes[s] for s in over}
        open_names -= over
    target |= {s: rate * weight[s] for s in open_names}
    for s in names:
        own = [r for r in rows if r.source == s]
        assert own[0].target == pytest.approx(target[s]) and own[0].source_size == sizes[s]
        assert abs(sum(r.size * r.copies for r in own) - target[s]) <= max((r.size for r in own), default=0)
    assert sorted(mixing.mixed_documents(docs).columns) == sorted(docs.columns)
    assert mixing.mixed_documents(docs).count() == sum(r.copies for r in rows)
    assert mixing.mix(none).count() == 0


def test_smallest_capacity():
    draw = random.Random(2)
    for _ in range(200):
        sizes = [draw.randrange(1, 30) for _ in range(draw.randrange(0, 25))]
        shards = draw.randrange(1, 6)
        best = [0] + [10**9] * len(sizes)  # smallest maximum for the first i sizes
        for _ in range(shards):
            best = [min((max(best[j], sum(sizes[j:i])) for j in range(i + 1)), default=0) for i in range(len(sizes) + 1)]
        assert sharding.smallest_capacity(sizes, shards) == best[-1]
        cuts = [0, *sharding.contiguous_cuts(sizes, shards), len(sizes)]
        assert cuts == sorted(cuts) and max(sum(sizes[a:b]) for a, b in zip(cuts, cuts[1:])) == best[-1]


def test_cuts_of_ranges_are_best(spark, monkeypatch):
    monkeypatch.setattr(sharding, "FIRST_BITS", 3)
    monkeypatch.setattr(sharding, "MORE_BITS", 2)
    draw = random.Random(4)
    groups = sorted({draw.randrange(-(1 << 63), 1 << 63): draw.choice([1, 5, 90]) for _ in range(120)}.items())
    frame = spark.createDataFrame(groups, "key bigint, size bigint")
    cuts = sharding.cut_keys(frame, 4)
    sums = Counter()
    for key, size in groups:
        sums[sum(c is not None and key >= c for c in cuts)] += size
    assert max(sums.values()) == sharding.smallest_capacity([s for _, s in groups], 4)


def test_shard(docs, none):
    rows = sharding.shard(docs).select("doc_id", "text", "sharding.*").collect()
    assert len(rows) == docs.count()
    assert all(r.size == len((r.text or "").encode()) + 1 and r.law == "bytes" and r.grown_shard is None for r in rows)
    where = {}
    for r in rows:
        assert where.setdefault(r.text, r.shard) == r.shard and 0 <= r.shard < 8
    for s in range(8):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    assert sharding.shard(none).count() == 0


def test_escape_round_trip():
    draw = random.Random(6)
    bits = ["\\", "<|im_start|>", "<|im_sep|>", "<|im_end|>", "<s>", "</s>", "[INST]", "[/INST]", "<", "|", "[", "\n", "é", "漢"]
    texts = ["".join(draw.choices(bits, k=draw.randrange(8))) for _ in range(400)]
    safe = escape(pa.array(texts, pa.large_string())).to_pylist()
    assert [unescape(t) for t in safe] == texts
    made, _, _ = assemble(pa.array(texts, pa.large_string()), pa.array(texts[::-1], pa.large_string()), np.array([150, 150, 400]))
    assert [t for part in made.to_pylist() for t in read_turns(part)] == list(zip(texts, texts[::-1]))
    assert made.to_pylist()[1] == ""


def test_chat(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", None), (1, 1, "assistant", "b"), (2, None, None, "x"), (None, 0, "assistant", "é"), (3, 5, "user\n", "<s>\\")]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("part", F.lit(1))
    found = {r.conv_id: r for r in conversation_digests(format_conversations(frame)).collect()}
    assert set(found) == {1, 2, 3, None} and found[1].n_turns == 3
    assert found[1].turns_sha256 == sha256(b"user\n\nassistant\nb\nassistant\nb\n").hexdigest()
    assert (found[1].loss_chars, found[1].loss_sha256) == (2, sha256(b"bb").hexdigest())
    assert found[3].turns_sha256 == sha256(b"user\n\n<s>\\\n").hexdigest() and found[None].loss_chars == 1
    assert conversation_digests(format_conversations(frame.where("false"))).count() == 0


def test_page_parts():
    text = Page(
        '<body class="has-sidebar"><header><h1>Site</h1></header><div class="cookie-notice">We use cookies, lots.</div><nav><a href=x>Home</a></nav>'
        '<div class="post-12"><header><h1>A &lt;b&gt; &amp; c</h1><span>by me</span></header><p>One, <b>two</b>&nbsp; three.<p>Four<br>five &#8212; six.'
        "<script>if (a < b) '</p>'</script><ul><li>x<li>y</ul><div class=ad>Buy, now.</div><form><p>Mail</p></form>"
        '<div id="comments"><p>No, never, no.</p></div></div><aside>Side, side.</aside><footer>(c)</footer>'
    ).text(None)
    assert text.split("\n\n") == ["A <b> & c", "One, two three.", "Four five — six.", "x", "y"]
    assert Page("").text(None) == "" and Page("a < b <p x='").text("p") is not None


def test_page_attributes_are_read_whole():
    parts = [
        '<p title="the hidden cost">One, two.</p>',
        '<div data-hidden="false"><p>Three, four.</p></div>',
        '<p>Five, <a href="/hidden-gems">six</a> and <a href="?id=comments">seven</a>, <a href=/hidden>eight</a> of all that we have seen.</p>',
        '<p data-class="ad" xml:id="comments" data-style="display:none">Nine, ten.</p>',
        '<section id="discussion"><h2 id="related-work">Related work</h2><p>Eleven, twelve.</p></section>',
        '<h2 id="search-methods">Search methods</h2><p id="hero-story">Thirteen.</p>',
    ]
    hidden = [
        "<p HIDDEN>No, no.</p>",
        "<div aria-hidden='true'><p>No, no.</p></div>",
        "<p style = 'display: none'>No, no.</p>",
        "<div class=related id=x><p>No, no.</p></div>",
        "<div id=comments><p>No, no.</p></div>",
        "<div id='disqus_thread'><p>No, no.</p></div>",
    ]
    wanted = ["One, two.", "Three, four.", "Five, six and seven, eight of all that we have seen.", "Nine, ten.", "Related work", "Eleven, twelve.", "Search methods", "Thirteen."]
    for tag in ("article", "main"):
        text = Page(f"<body><{tag}>{''.join(parts + hidden)}</{tag}></body>").text(None)
        assert text.split("\n\n") == wanted
    content = '<body><div class="content"><p>One, two, three.</p><section id="discussion"><h2 id="related">Related</h2><p>Four, five.</p></section><div id="related"><p>No, no.</p></div></div></body>'
    assert Page(content).text(None).split("\n\n") == ["One, two, three.", "Related", "Four, five."]


def page_of_parts(i, outer):
    """An article in containers two deep with classes of their own, the second part longer."""
    a, b = "Alpha, of page {}. ".format(i) * 5, "Beta, the longer one. " * 9
    part = "<div class='part {}'><div class=col><p>{}</p></div></div>"
    return f"<body><nav><a href=x>Home</a></nav>{outer.format(part.format('intro', a) + part.format('methods', b))}<footer>(c)</footer></body>", f"{a.strip()}\n\n{b.strip()}"


@pytest.mark.parametrize("outer", ["<main>{}</main>", "<div class=wrap>{}</div>", "<article><section><div>{}</div></section></article>", "{}"])
def test_articles_in_parts_are_whole(outer):
    page, text = page_of_parts(1, outer)
    assert Page(page).text(None) == text


def test_titles_beside_the_content_stay():
    content = "<div class='entry-content'><p>Long, long text.</p><p>More of it, and more.</p></div>"
    for outer in ("<article>{}</article>", "<main><article>{}</article></main>", "<main><h2>Before</h2><article>{}</article></main>", "<div class=post>{}</div>"):
        text = Page("<body><div class=ad>Buy.</div>" + outer.format(f"<h1>Title</h1><p>Lead, short.</p>{content}") + "</body>").text(None)
        assert text.removeprefix("Before\n\n").split("\n\n") == ["Title", "Lead, short.", "Long, long text.", "More of it, and more."]
    teasers = "".join(f"<article class=card><p>Other story, number {i}.</p></article>" for i in range(3))
    story = "<article class=post><h1>Title</h1><p>" + "Long, long text. " * 12 + "</p></article>"
    assert Page(f"<main>{story}{teasers}</main>").text(None).startswith("Title\n\nLong") and "Other" not in Page(f"<main>{story}{teasers}</main>").text(None)


def test_hosts_vote_for_whole_articles(spark):
    pages = [page_of_parts(i, "<main>{}</main>") for i in range(4)]
    frame = spark.createDataFrame([(i, "http://parts.example/", html) for i, (html, _) in enumerate(pages)], "page_id bigint, url string, html string")
    assert {r.page_id: r.text for r in with_main_text(frame).select("page_id", "main.text").collect()} == {i: text for i, (_, text) in enumerate(pages)}


ARTICLE = "".join(f"<p>Paragraph {i} of the article, which goes on for a while, and then ends.</p>" for i in range(6))
ARTICLE_TEXT = "\n\n".join(f"Paragraph {i} of the article, which goes on for a while, and then ends." for i in range(6))


@pytest.mark.parametrize("html", [
    f"<div class='content has-sidebar'>{ARTICLE}</div>",
    f"<div id=content class=no-sidebar>{ARTICLE}</div><div class=x><p>foo, bar.</p></div>",
    f"<div id=page class='has-header'><main>{ARTICLE}</main></div>",
    f"<div class='wrapper with-menu'><main>{ARTICLE}</main></div>",
    f"<div class='social-science'><article>{ARTICLE}</article></div>",
    f"<div class='search-engines-guide'>{ARTICLE}</div>",
    f"<form id=aspnetForm><nav><p>A, b, c.</p></nav><div id=main>{ARTICLE}</div></form>",
    f"<body>{ARTICLE}",
    ARTICLE,
    f"<article>{ARTICLE}<div class='newsletter-box'><p>Join us, now.</p></div><form><p>Mail, please.</p></form></article>",
    f"<div class='left-sidebar'><p>Side, a, b, c.</p></div><div class=content>{ARTICLE}</div><section id=comments><p>I like it, a lot.</p></section>",
])
def test_no_article_is_lost_to_a_name(html):
    assert Page(html).text(None) == ARTICLE_TEXT


@pytest.mark.parametrize("part", ["<section class=discussion>{}</section>", "<div class=code-widget>{}</div>", "<p class=share-price>{}</p>", "<p class=dialog>{}</p>"])
def test_parts_of_an_article_stay(part):
    assert "It says, so." in Page(f"<article>{ARTICLE}{part.format('It says, so.')}</article>").text(None)


def test_pages_without_containers():
    assert Page("<h1>T</h1><p>Text, one, two, three.</p>").text(None) == "T\n\nText, one, two, three."
    assert Page("plain text").text(None) == "plain text"
    assert Page("<nav><a>x</a></nav><article><p><a>All linked text</a></p></article>").text(None) == "All linked text"
    assert Page("<nav>only a menu</nav>").text(None) == "" and Page("").text("body") == ""


def test_equal_votes_take_more_text_then_the_first_name(spark):
    def page(name, n):
        return f"<html><body><div class={name}>" + "<p>Some words, and more of them.</p>" * n + "</div></body></html>"

    rows = [(1, "http://h/", page("b", 3)), (2, "http://h/", page("a", 3)), (3, "http://k/", page("a", 3)), (4, "http://k/", page("b", 4))]
    for parts in (1, 4):
        frame = spark.createDataFrame(rows, "page_id int, url string, html string").repartition(parts)
        found = {r.host: r.path for r in host_paths(frame.withColumn("host", F.substring("url", 8, 1))).collect()}
        assert found == {"h": "html>body>div.a", "k": "html>body>div.b"}


def test_pages_agree_on_a_path(spark):
    body = "<html><body><div class='story{0}'><p>{1}</p></div><div class='box{0}'><p>{2}</p></div></body></html>"
    rows = [(i, f"http://H.example/{i}", body.format(i, "Long, long text. " * 9, "Short, text.")) for i in range(5)]
    rows += [(9, "http://h.example/x", body.format(9, "Short, text.", "Long, long text. " * 9)), (10, None, body.format(1, "Own.", "")), (11, "http://h.example/", None)]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("host", F.lit(1))
    found = {r.page_id: r.text for r in with_main_text(frame).select("page_id", "main.text").collect()}
    assert found[9] == "Short, text." and found[0].startswith("Long") and found[10] == "Own." and found[11] == ""
    assert with_main_text(frame.where("false")).count() == 0


def test_posteriors_match_plain_passes():
    draw = np.random.default_rng(0)
    emission, transition, at = draw.normal(size=(300, 3)), draw.normal(size=(3, 3)), np.array([0, 5, 5, 150, 300])
    found = language.posteriors(emission, transition, at)
    for a, b in zip(at[:-1], at[1:]):
        forward, backward, v, w = [], [], np.ones(3), np.ones(3)
        for t in range(a, b):
            v = (v @ np.exp(transition)) * np.exp(emission[t])
            v /= v.sum()
            forward.append(v)
        for t in range(b - 1, a - 1, -1):
            backward.append(w)
            w = np.exp(transition) @ (np.exp(emission[t]) * w)
            w /= w.sum()
        both = np.array(forward).reshape(-1, 3) * np.array(backward[::-1]).reshape(-1, 3)
        assert np.allclose(found[a:b], both / both.sum(axis=1, keepdims=True))


def test_language(spark, sf_dir, docs, none):
    rows = QUERIES["op5_language"](spark, sf_dir).collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.9
    labels = docs.select("doc_id", "lang")
    found = language.with_language(docs, labels).select("doc_id", "text", "language.*").collect()
    assert len(found) == docs.count()
    assert all((r.predicted == "und") == (not any(c.isalpha() for c in r.text or "")) for r in found)
    assert language.with_language(none, labels).count() == 0
    assert {r[0] for r in language.with_language(docs, labels.where("false")).select("language.predicted").collect()} == {"und"}


def test_mixed_text_has_two_languages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = [(r.text, r.lang) for r in docs.orderBy("doc_id").collect()]
    model = language.fit(pa.array([t for t, _ in texts], pa.large_string()), [x for _, x in texts])
    pieces = {x: [w for t, y in texts if y == x for w in re.findall(r"[^\W\d_]+", t)][:40] for x in ("en", "de")}
    _, found = language.word_languages(pa.array([" ".join(pieces["en"] + pieces["de"])], pa.large_string()), model)
    best = [model[0][k] for k in found.argmax(axis=1)]
    assert Counter(best[:35])["en"] > 30 and Counter(best[-35:])["de"] > 30


def brute_overlap(texts, items, window=10):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    out = []
    for text in texts:
        w, names = words(text), set()
        hit = [False] * len(w)
        for name, item in items:
            v = words(item)
            n = min(window, len(v))
            for k in range(len(v) - n + 1) if v else ():
                for p in range(len(w) - n + 1):
                    if w[p : p + n] == v[k : k + n]:
                        hit[p : p + n] = [True] * n
                        names |= {str(name)} if name is not None else set()
        out.append((len(w), sum(hit), len(names), sha256(",".join(sorted(names)).encode()).hexdigest(), any(hit)))
    return out


@pytest.mark.parametrize("block", [1 << 20, 30])
def test_contamination(spark, docs, none, monkeypatch, block):
    monkeypatch.setattr(decontamination, "BLOCK_WORDS", block)
    items = [(1, prose(4, 25)), (2, prose(5)[:80].upper()), (2, "one"), (30, None), (None, "w1 w2"), (4, "x x"), (5, "ÄÖ été"), (6, " ".join(prose(6).split()[20:45]))]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    rows = decontamination.contamination(docs, bench).select("text", "overlap.*").collect()
    assert [tuple(r)[1:] for r in rows] == brute_overlap([r.text for r in rows], items)
    assert decontamination.decontaminated(docs, bench).count() == sum(not r.contaminated for r in rows)
    assert decontamination.contamination(none, bench).count() == 0
    assert decontamination.decontaminated(docs, bench.where("false")).count() == docs.count()
    found = decontamination.longest_matches(docs, bench).where("item_id = '6' and doc_id = 112").collect()
    assert [(r.word, r.item_word, r.n_words) for r in found] == [(20, 0, 25)]


def brute_components(pairs):
    sets = {}
    for key, text in pairs:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[key] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    root = {k: k for k in sets}
    for a in sets:
        for b in sets:
            common = len(sets[a] & sets[b])
            if a < b and common and 100 * common >= 85 * (len(sets[a]) + len(sets[b]) - common) and root[a] != root[b]:
                low, high = sorted((root[a], root[b]))
                root = {k: low if r == high else r for k, r in root.items()}
    return root, {k: len(s) for k, s in sets.items()}


def near_copies(seed, n):
    """Texts that differ from one text in some words, and so from each other in more."""
    draw, base, out = random.Random(seed), prose(seed, 200).split(), []
    for _ in range(n):
        words = list(base)
        for i in draw.sample(range(200), draw.randrange(0, 8)):
            words[i] = draw.choice(WORDS)
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("tile, tile_bytes, block", [(4096, 8 << 20, 128), (8, 8 << 20, 3), (4096, 3000, 128)])
def test_near_duplicates_of_a_large_group(spark, monkeypatch, tile, tile_bytes, block):
    monkeypatch.setattr(near_duplicates, "TILE", tile)
    monkeypatch.setattr(near_duplicates, "TILE_BYTES", tile_bytes)
    monkeypatch.setattr(near_duplicates, "BLOCK", block)
    monkeypatch.setattr(near_duplicates, "MAP_BITS", 6)  # lets many rows through wrongly
    monkeypatch.setattr(near_duplicates, "FAN", 5)
    rows = list(enumerate([*near_copies(900, 70), *near_copies(901, 6), *(prose(i, 200) for i in range(30)), *ODD]))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    root, sizes = brute_components(rows)
    found = near_duplicates.near_duplicates(frame).collect()
    assert {r.doc_id: (r.component_id, r.n_shingles, r.kept) for r in found} == {k: (root[k], sizes[k], root[k] == k) for k in root}


def test_chained_copies_below_the_threshold_stay_apart(spark, monkeypatch):
    """One cluster of likely pairs of which few are links: all the others have to be refuted."""
    monkeypatch.setattr(near_duplicates, "TILE", 16)
    draw, base, texts = random.Random(5), prose(920, 300).split(), []
    for i in range(60):
        words = list(base)
        for k in draw.sample(range(300), 4 if i % 8 else 2):
            words[k] = f"x{i}-{k}"
        texts.append(" ".join(words))
    rows = list(enumerate(texts))
    root, sizes = brute_components(rows)
    assert 5 < len(set(root.values())) < 60
    found = near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()
    assert {r.doc_id: r.component_id for r in found} == root


def test_near_duplicates_leave_few_tables(spark):
    folder = Path(work_folder(spark, "x").removeprefix("file:")).parent
    before = set(folder.iterdir()) if folder.exists() else set()
    frame = spark.createDataFrame(list(enumerate(near_copies(930, 12))), "doc_id bigint, text string")
    assert near_duplicates.near_duplicates(frame).count() == 12
    left = {p.name.rsplit("-", 1)[0] for p in set(folder.iterdir()) - before}
    assert "nodes" in left
    assert not left & {"buckets", "members", "candidate-signatures", "likely", "texts", "likely-nodes", "clustered-rows", "spanning", "large-stars", "links"}


def test_near_duplicates_edges(docs, none):
    found = near_duplicates.near_duplicates(docs).collect()
    assert len(found) == docs.count()
    assert all(r.component_id == r.doc_id and r.kept for r in found if r.n_shingles == 0)
    kept = near_duplicates.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids[100] == 1 and ids[101] == 0 and ids[3] == 1 and ids[6] == 0 and ids[0] == 1 and ids[1] == 1 and ids[None] == 1
    assert near_duplicates.near_duplicates(none).count() == 0 and near_duplicates.without_near_duplicates(none).count() == 0


def test_one_of_each_component_stays(spark):
    copies = [" ".join([f"{end}-{i}", *prose(seed, 200).split(), f"{i}-{end}"]) for seed, end in ((910, "a"), (911, "b")) for i in range(3)]
    rows = [(None, copies[0]), (None, copies[1] + " tail"), (7, copies[3]), (7, copies[4] + " tail"), (7, prose(912, 200)), (None, prose(913, 200)), (8, copies[5]), (None, "  "), (None, "  "), (None, None)]
    kept = near_duplicates.without_near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    texts = Counter((r.doc_id, r.text) for r in kept)
    assert sum(n for (_, t), n in texts.items() if t in (rows[0][1], rows[1][1])) == 1
    assert [n for (i, t), n in texts.items() if t in (rows[2][1], rows[3][1], rows[6][1])] == [1] and texts[8, copies[5]] == 0
    assert texts[7, rows[4][1]] == texts[None, rows[5][1]] == texts[None, "  "] == texts[None, None] == 1 and len(kept) == 6


def test_pipeline_drops_near_copies_from_80_percent(spark):
    rows, at = [], 0
    for seed in range(12):
        words = prose(700 + seed, 200).split()
        for k in (0, 2, 3, 4, 4, 5):
            copy = list(words)
            for j in range(k):
                copy[10 + 40 * j + len(rows) % 6] = f"n{at}-{j}"
            rows.append((at, " ".join(copy), "en", "a", 0))
            at += 1
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for i, t, *_ in rows}
    root, between = {i: i for i in sets}, 0
    for a in sets:
        for b in range(a + 1, at):
            common = len(sets[a] & sets[b])
            union = len(sets[a]) + len(sets[b]) - common
            between += 80 * union <= 100 * common < 85 * union
            if 100 * common >= 80 * union:
                low, high = sorted((root[a], root[b]))
                root = {i: low if r == high else r for i, r in root.items()}
    kept = corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(rows, KIND), "").collect()
    assert between >= 12 and sorted(r.doc_id for r in kept) == sorted(set(root.values()))
    strict = near_duplicates.without_near_duplicates(spark.createDataFrame(rows, KIND)).count()
    assert strict > len(kept)


def test_least_matches_rise_with_the_batches():
    needed = near_duplicates.least_matches()
    assert needed == sorted(needed) and needed[-1] < 0.85 * near_duplicates.HASHES


def test_quality(spark, sf_dir, docs, none):
    """Held-out rows alone: all three grades are predicted."""
    folder = sf_dir.replace("sf0.001", "sf0.1")
    rows = QUERIES["op8_quality"](spark, folder).collect()
    label = {r.doc_id: r.quality * (2 - (r.toxic or 0)) for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    assert all(0 <= r.tail_probability <= r.expected_grade <= 2 for r in rows)
    confusion = np.zeros((3, 3), int)
    for r in rows:
        if r.held_out and r.doc_id in label:
            confusion[label[r.doc_id], round(r.expected_grade)] += 1
    recall = confusion.diagonal() / confusion.sum(axis=1)
    assert recall[0] > 0.9 and recall[1] > 0.5 and recall[2] > 0.95, confusion
    ratings = docs.select("doc_id", (F.col("doc_id") % 4).cast("int").alias("rating"))
    assert quality.with_grade(docs, ratings, tail=2).count() == docs.count()
    assert quality.with_grade(docs, ratings.where("false")).count() == docs.count()
    assert quality.with_grade(none, ratings).count() == 0


def plain_ordinal_loss(weights, thresholds, buckets, grades):
    """Weighted loss of documents given as rows of buckets, straight from the definition."""
    counts, total = Counter(grades), 0.0
    for rows, g in zip(buckets, grades):
        place = sum(weights[b] for row in rows for b in row) / max(1, len(rows)) ** quality.DAMPING
        above = [1.0, *(1 / (1 + np.exp(t - place)) for t in thresholds), 0.0]
        total -= np.log(above[g] - above[g + 1]) * (len(grades) / 3 / counts[g]) ** quality.BALANCE
    return total


def test_quality_lowers_the_plain_loss():
    draw = random.Random(12)
    grades = [draw.choices([0, 1, 2], [1, 1, 4])[0] for _ in range(240)]
    texts = [" ".join(draw.choices(WORDS, k=40) + draw.choices(["vile", "rude"], k=2 if g == 1 else 0) + ["!!!"] * (9 if g == 0 else 0)) for g in grades]
    column = pa.array(texts, pa.large_string())
    weights, thresholds = quality.fit(column, grades)
    buckets, at = quality.token_buckets(column)
    rows = [buckets[a:b] for a, b in zip(at[:-1], at[1:])]
    share = [np.mean([g >= k for g in grades]) for k in (1, 2)]
    untrained = plain_ordinal_loss(np.zeros(len(weights)), [-np.log(s / (1 - s)) for s in share], rows, grades)
    assert plain_ordinal_loss(weights, thresholds, rows, grades) < 0.3 * untrained
    places = quality._places(weights, buckets, at)
    assert places[7] == pytest.approx(sum(weights[b] for row in rows[7] for b in row) / len(rows[7]) ** quality.DAMPING, abs=1e-4)


def test_scores_are_a_plain_noisy_or():
    """The score of a text from its sentences alone: the probability that one of them offends."""
    draw = random.Random(13)
    words = [f"{a}{b}" for a in "bcdfg" for b in ("ala", "ela", "ilo", "umo")]
    sentences = lambda bad: ". ".join([" ".join(draw.choices(words, k=8)) for _ in range(5)] + (["you vile creature"] if bad else [])) + "."
    labels = [i % 3 == 0 for i in range(200)]
    texts = pa.array([sentences(bad) for bad in labels] + [""], pa.large_string())
    model = toxicity.fit(texts.slice(0, 200), [int(x) for x in labels])
    whole, each = toxicity.score(toxicity.Sentences(texts), *model)
    parts = toxicity.Sentences(texts)
    at = np.searchsorted(parts.start, parts.words.offsets)
    for i in range(200):
        assert whole[i] == pytest.approx(1 - np.prod(1 - each[at[i] : at[i + 1]]), abs=1e-6)
    assert np.mean([(whole[i] >= toxicity.THRESHOLD) == labels[i] for i in range(200)]) > 0.95


def test_long_documents_are_learnt_from_and_judged(spark):
    """Texts of more than 20 000 characters: clean ones stay, toxic ones are found, and the sample takes them."""
    draw = random.Random(14)
    words = [f"{a}{b}{c}" for a in "bcdfgklm" for b in "aeiou" for c in ("ra", "ne", "stil", "om")]

    def text(n, bad):
        parts = [" ".join(draw.choices(words, k=10)).capitalize() + "." for _ in range(n)]
        for _ in range(max(1, n // 40) if bad else 0):
            parts[draw.randrange(n)] = "You are vile scum and I despise you."
        return " ".join(parts)

    rows = [(i, text(draw.randrange(3, 30) if i % 10 else 500, i % 4 == 0), int(i % 4 == 0)) for i in range(400)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int").repartition(3)
    assert sum(len(t) > 20_000 for _, t, _ in rows) == 40
    texts, labels = learning.labelled_sample(frame, frame.select("doc_id", F.col("toxic").alias("label")), 400, 10**8)
    assert len(texts) == 400 and sorted(zip(texts.to_pylist(), labels)) == sorted((t, y) for _, t, y in rows)
    few, _ = learning.labelled_sample(frame, frame.select("doc_id", F.col("toxic").alias("label")), 400, 60_000)
    assert sum(map(len, few.to_pylist())) <= 60_000 and set(few.to_pylist()) <= {t for _, t, _ in rows}
    fresh = [(1000 + i, text(600, i % 2 == 0), i % 2 == 0) for i in range(20)]
    both = frame.select("doc_id", "text").unionByName(spark.createDataFrame([r[:2] for r in fresh], "doc_id bigint, text string"))
    found = {r.doc_id: r.predicted for r in toxicity.with_toxicity(both, frame.select("doc_id", "toxic")).select("doc_id", "toxicity.predicted").collect()}
    assert all(found[i] == int(bad) for i, _, bad in fresh)


def test_rare_labels_are_sampled(spark):
    rows = [(i, f"text {i}", "rare" if i % 200 == 0 else "common") for i in range(2000)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, label string")
    _, labels = learning.labelled_sample(frame, frame.select("doc_id", "label"), 100, 10**6, per_label=True)
    assert Counter(labels)["rare"] == 10 and len(labels) == 100
    again = [learning.labelled_sample(frame.repartition(n), frame.select("doc_id", "label"), 30, 10**6)[0].to_pylist() for n in (2, 5)]
    assert again[0] == again[1] and len(again[0]) == 30
    doubled = frame.unionByName(frame).unionByName(frame.withColumn("text", F.lit(None).cast("string")))
    assert learning.labelled_sample(doubled, frame.select("doc_id", "label"), 30, 10**6)[0].to_pylist() == again[0]
    assert learning.labelled_sample(frame.where("false"), frame.select("doc_id", "label"), 30, 10**6)[1] == []


def test_ordered_thresholds():
    draw = random.Random(8)
    texts, grades = [], []
    for _ in range(300):
        g = draw.randrange(4)
        texts.append(" ".join(draw.choices(["good"] * g + ["bad"] * (3 - g), k=30)))
        grades.append(g)
    weights, thresholds = quality.fit(pa.array(texts, pa.large_string()), grades)
    assert list(thresholds) == sorted(thresholds)
    place = quality._places(weights, *quality.token_buckets(pa.array(texts, pa.large_string())))
    means = [np.mean(place[np.array(grades) == g]) for g in range(4)]
    assert means == sorted(means)


def test_toxicity_is_located(spark, docs, none):
    draw, rows = random.Random(5), []
    for i in range(240):
        bad = i % 4 == 0
        sentences = [" ".join(draw.choices(WORDS, k=8)) for _ in range(6)]
        if bad:
            sentences[draw.randrange(6)] += f" {draw.choice(['vile', 'rotten'])} thing"
        rows.append((i, ". ".join(sentences) + ".", int(bad)))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    found = toxicity.with_toxicity(frame, frame.where("doc_id < 160")).select("doc_id", "text", "toxic", "toxicity.*").where("doc_id >= 160").collect()
    assert np.mean([r.predicted == r.toxic for r in found]) > 0.9
    assert all(re.search("vile|rotten", s.text) for r in found if r.toxic for s in r.sentences)
    assert all(r.text.encode()[s.start :].startswith(s.text.encode()) for r in found for s in r.sentences)
    labels = frame.select("doc_id", "toxic")
    scored = toxicity.with_toxicity(docs, labels).select("text", "toxicity.*").collect()
    assert len(scored) == docs.count() and all(0 <= r.score <= 1 for r in scored)
    assert all(r.score == 0 for r in scored if not re.search(r"[^\W\d_]", r.text or ""))
    assert toxicity.with_toxicity(docs, labels.where("false")).where("toxicity.predicted = 1").count() == 0
    assert toxicity.with_toxicity(none, labels).count() == 0


def test_sentence_gradient_of_a_document_without_sentences():
    weights, _ = toxicity.fit(pa.array(["", "bad word", "fine word", ""], pa.large_string()), [1, 1, 0, 0])
    assert np.isfinite(weights).all()


@pytest.mark.parametrize("tile", [1024, 3])
def test_vectors(spark, monkeypatch, tile):
    monkeypatch.setattr(vectors, "TILE", tile)
    monkeypatch.setattr(vectors, "STEPS", (2, 4))
    draw = np.random.default_rng(2)
    base = draw.normal(size=(6, 8))
    rows = [(i, (base[i % 6] * draw.uniform(0.5, 2) + draw.normal(scale=0.06, size=8)).tolist(), i % 2) for i in range(60)]
    rows += [(100, base[0].tolist(), 0), (101, base[0].tolist(), 0), (102, (2 * base[0]).tolist(), 0), (103, base[0].tolist(), None), (104, None, 0)]
    rows += [(105, [0.0] * 8, 0), (106, [float("nan")] * 8, 0), (107, [1.0, None], 0), (108, [], 0), (109, [1.0, 2.0], 0), (110, [1.0, 2.0], 0), (111, [float("inf")] * 8, 0)]
    good = {i: (np.array(v, np.float32).astype(float), k) for i, v, k in rows if i < 103 or i in (109, 110)}
    links, root = Counter(), {i: i for i, _, _ in rows}
    for a, (x, k) in good.items():
        for b, (y, m) in good.items():
            if a < b and k == m and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.98:
                links.update([a, b])
                low, high = sorted((root[a], root[b]))
                root = {i: low if r == high else r for i, r in root.items()}
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").withColumn("tile", F.lit(1))
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.near_duplicate_vectors(frame).collect()}
    assert found == {i: (links[i], root[i], root[i] == i) for i, _, _ in rows}
    assert vectors.near_duplicate_vectors(frame.where("false")).count() == 0


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, sf_dir)
        assert after.columns == docs.columns and stage(spark, docs.where("false"), sf_dir).count() == 0, name
    final = corpus_pipeline.run(spark, sf_dir).collect()
    assert final and {r.shard for r in final} <= set(range(8)) and {r.doc_id for r in final} <= {r.doc_id for r in docs.collect()}


def test_planted_copies_of_vectors(spark, sf_dir, monkeypatch):
    """All vectors of a larger table with copies of every 20th one planted, some of them just below the threshold."""
    monkeypatch.setattr(vectors, "TILE", 300)
    monkeypatch.setattr(vectors, "BLOCK", 64)
    given = spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.1')}/embeddings.parquet").collect()
    draw, rows = np.random.default_rng(7), [(r.vec_id, [float(x) for x in r.embedding], r.label) for r in given]
    for k, (i, v, label) in enumerate(rows[::20]):
        noise = draw.normal(size=len(v))
        noise *= np.linalg.norm(v) / np.linalg.norm(noise) * draw.uniform(0.1, 0.3)
        rows.append((100_000 + k, (3 * (np.array(v) + noise)).tolist(), label))
    ids, labels = np.array([r[0] for r in rows]), np.array([r[2] for r in rows])
    x = np.array([r[1] for r in rows], np.float32).astype(float)
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    linked = (x @ x.T >= 0.98) & (labels[:, None] == labels[None, :]) & ~np.eye(len(x), dtype=bool)
    assert 50 < linked.sum() // 2 < 400
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").repartition(4)
    found = {r.vec_id: r.n_links for r in vectors.near_duplicate_vectors(frame).collect()}
    assert found == dict(zip(ids.tolist(), linked.sum(axis=1).tolist()))
