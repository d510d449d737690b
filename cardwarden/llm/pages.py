"""Main text of web pages, from the container that the pages of a host agree on.

Every page's containers are scored by the running text that they hold. The best one is only a
part of the article where that lies in several containers, so from it one goes up to the
article or main element, else to the smallest container with nearly all running text. That
one votes for its path, the tags and classes from the root with digits made equal. Spark counts the votes
per host. Then each page is read again, and its text is what lies at its host's winning path;
a page without that path gives what its own container holds.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.llm.naming import unused
from cardwarden.llm.storage import stored
from cardwarden.llm.words import slices

SLICE_BYTES = 16 << 20

#: Elements of HTML by their part in the layout.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("script style textarea title xmp iframe noembed noframes noscript template head svg math canvas audio video object select datalist".split())
CONTAINERS = frozenset("article body center dd details div fieldset figure html li main ol section table tbody td th tr ul dl blockquote".split())
LEAVES = frozenset("address caption dt figcaption h1 h2 h3 h4 h5 h6 hr legend p pre summary".split())
OUTSIDE = frozenset("aside button dialog footer form header menu nav search".split())
BLOCKS = CONTAINERS | LEAVES | OUTSIDE
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Share of the running text that is nearly all of it.
NEARLY = 0.9
#: What an open element doesn't survive: the start of one of these tags.
ENDED_BY = {
    "p": BLOCKS,
    "li": frozenset({"li"}),
    "dt": frozenset({"dt", "dd"}),
    "dd": frozenset({"dt", "dd"}),
    "tr": frozenset({"tr", "tbody", "thead", "tfoot"}),
    "td": frozenset({"td", "th", "tr", "tbody", "tfoot"}),
    "th": frozenset({"td", "th", "tr", "tbody", "tfoot"}),
    "option": frozenset({"option", "optgroup"}),
    **{h: HEADINGS for h in HEADINGS},
}
#: Elements that keep the ends of the elements around them from reaching inside.
SCOPES = frozenset("table td th ul ol dl article section div main body".split())

#: Words of class names, ids and roles that mark what isn't the article. A name counts if all its words do or are neutral.
FOREIGN_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adslot adsense sponsor sponsored sponsors promo promos promotion promoted outbrain taboola "
    "sidebar sidebars sidenav rail aside menu menus nav navbar navigation breadcrumb breadcrumbs pagination pager toolbar topbar "
    "footer footers footnav copyright colophon cookie cookies consent gdpr notice notices notification alert alerts popup modal overlay "
    "announcement disclaimer newsletter subscribe subscription signup login share sharing social related recommended recommendations "
    "comment comments commentlist respond replies reply disqus discussion widget widgets contentinfo complementary search dialog".split()
)
#: Words that may stand beside those, as in left-sidebar or related-posts; with others, as in social-science, a name says nothing.
NEUTRAL_WORDS = frozenset(
    "left right top bottom upper lower first second third primary secondary tertiary main site page global local sub mini sticky fixed floating inline "
    "container wrapper wrap box block blocks unit units slot zone area areas section sections bar panel pane col column row grid inner outer body content "
    "contents list lists item items link links button buttons btn icon icons post posts article articles story stories entry entries reader readers user "
    "text title form field input thread card cards group footer header js wp ui the and of for by in on to us your you also more read like".split()
)
#: Names that begin with one of these describe the layout of an element that is something else.
MODIFIERS = frozenset("has no with without is not hide show enable disable".split())
#: Words that an article's own parts go by too.
ARTICLE_WORDS = frozenset("discussion dialog notice notices disclaimer alert alerts".split())
#: The same for what stands above an article; a heading inside the article stays.
HEAD_WORDS = frozenset("header headers masthead banner hero topper".split())
#: Ids that aren't made from a heading, so that they mark what isn't the article inside of one too.
FOREIGN_IDS = frozenset("comments commentlist respond disqus disqus_thread taboola outbrain sidebar".split())
#: Words of class names and ids that mark the article.
OWN_WORDS = frozenset("article body content entry main post story text".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?/](?![a-zA-Z])[^>]*(?:>|\Z)"
    r"|<!?(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)"
    r"|<!?(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)(?:>|\Z)",
    re.DOTALL,
)
#: One attribute after the other, so that a name is never looked for inside another name or a value.
_ATTRIBUTE = re.compile(r"([^\s/>=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]*))?")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_SPACE = re.compile(r"\s+")
_DIGITS = re.compile(r"\d+")


def _marks(name: str) -> set[str]:
    """The words by which a class, role or id says that something isn't the article."""
    words = [w.lower() for w in _WORD.findall(name)]
    telling = {w for w in words if w in FOREIGN_WORDS or w in HEAD_WORDS}
    if not telling or words[0] in MODIFIERS or any(w not in telling and w not in NEUTRAL_WORDS and len(w) > 1 for w in words):
        return set()
    return telling


class _Node:
    """An open or closed element: its parent, path, and what it counts as."""

    __slots__ = ("tag", "parent", "path", "foreign", "head", "inside", "within", "own", "up", "weight", "credit")

    def __init__(self, tag: str, parent: _Node | None, rest: str, forms: bool = False):
        self.tag, self.parent, self.weight, self.credit = tag, parent, 0.0, 0.0
        #: The nearest container around it, or the page.
        self.up = parent if parent is None or parent.tag in CONTAINERS or parent.parent is None else parent.up
        classes: list[str] = []
        words: set[str] = set()
        id_words: set[str] = set()
        own_words: set[str] = set()
        whole_id = ""
        hidden = False
        read: set[str] = set()
        for name, value in _ATTRIBUTE.findall(rest):
            name, value = name.lower(), value.strip("\"'")
            if name in read:
                continue
            read.add(name)
            if name in ("class", "role"):
                own_words.update(w.lower() for w in _WORD.findall(value))
                for c in value.split():
                    words |= _marks(c)
                if name == "class":
                    classes += [_DIGITS.sub("0", c) for c in value.split()]
            elif name == "id":
                own_words.update(w.lower() for w in _WORD.findall(value))
                id_words, whole_id = _marks(value), value.lower()
            elif name == "hidden" or name == "aria-hidden" and value.lower() == "true":
                hidden = True
            elif name == "style" and "display:none" in value.replace(" ", "").lower():
                hidden = True
        main = tag in ("html", "body", "main", "article")
        up = parent
        self.own = not main and tag in CONTAINERS and bool(own_words & OWN_WORDS)
        self.inside = main and tag in ("main", "article") or up is not None and up.inside or tag in CONTAINERS and bool(own_words & OWN_WORDS)
        self.within = tag in ("main", "article") or up is not None and up.within
        # The ids of headings, and of parts of an article, come from the article's own words.
        if tag not in HEADINGS and not (self.within or tag == "section" and up is not None and up.inside) or tag in CONTAINERS and whole_id in FOREIGN_IDS:
            words |= id_words | ({whole_id} & FOREIGN_IDS)
        if self.within:
            words -= ARTICLE_WORDS
        self.head = up is not None and up.head or tag == "header" or not main and bool(words & HEAD_WORDS)
        outside = tag in OUTSIDE and tag not in ("header", "form" if forms else "") or tag in UNSEEN
        self.foreign = up is not None and up.foreign or outside or hidden or not main and bool(words & FOREIGN_WORDS or {whole_id} & FOREIGN_IDS & words)
        own = ".".join([tag, *sorted(set(classes))])
        self.path = own if up is None or not up.path else f"{up.path}>{own}"


class Page:
    """Blocks of text of a page, each with its element, and the page's containers.

    A form that holds more text than the page has outside of forms is the page itself, as some
    frameworks write it; then the page is read again and forms count as any other element.
    """

    def __init__(self, source: str, forms: bool = False):
        self._forms, self._in_forms = forms, 0
        self.blocks: list[tuple[_Node, str, int]] = []
        self.nodes: list[_Node] = []
        self._stack = [_Node("", None, "")]
        self._page = self._stack[0]
        self._pieces: list[str] = []
        self._linked = 0
        self._read(source)
        self._flush()
        if not forms and self._in_forms > sum(len(text) for _, text, _ in self.blocks):
            self.__init__(source, True)

    def _read(self, source: str) -> None:
        at, end = 0, len(source)
        while at < end:
            m = _TAG.search(source, at)
            self._text(source[at : m.start() if m else end])
            if m is None:
                return
            at = m.end()
            name = m["name"] or m["name2"]
            if name is None or source[m.start() + 1] == "!":
                continue
            name = name.lower()
            if m["end"] or m["end2"]:
                self._close(name)
                continue
            rest = m["rest"] or m["rest2"] or ""
            self._open(name, rest)
            if name in RAW:
                close = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(source, at)
                at = close.end() if close else end
                self._close(name)

    def _text(self, raw: str) -> None:
        top = self._stack[-1]
        if raw and top.foreign and not self._forms and self._only_by_form():
            self._in_forms += len(raw.strip())
        if raw and not top.foreign:
            text = html.unescape(raw)
            self._pieces.append(text)
            if any(n.tag == "a" for n in self._stack):
                self._linked += len(text.strip())

    def _only_by_form(self) -> bool:
        """Whether the open elements are foreign because of a form and nothing else."""
        first = next(n for n in self._stack if n.foreign)
        return first.tag == "form" and not any(n.tag in OUTSIDE - {"form", "header"} or n.tag in UNSEEN for n in self._stack)

    def _open(self, name: str, rest: str) -> None:
        for i in range(len(self._stack) - 1, 0, -1):
            tag = self._stack[i].tag
            if name in ENDED_BY.get(tag, ()):
                self._pop(i)
                break
            if tag in SCOPES:
                break
        if name in BLOCKS:
            self._flush()
        elif name == "br":
            self._pieces.append(" ")
        if name not in VOID:
            node = _Node(name, self._stack[-1], rest, self._forms)
            if name not in BLOCKS and (node.foreign or node.head) and not (self._stack[-1].foreign or self._stack[-1].head):
                self._pieces.append(" ")
            self._stack.append(node)
            if name in CONTAINERS:
                self.nodes.append(node)

    def _close(self, name: str) -> None:
        for i in range(len(self._stack) - 1, 0, -1):
            tag = self._stack[i].tag
            if tag == name:
                self._pop(i)
                return
            if tag in BLOCKS and name not in BLOCKS:
                return

    def _pop(self, i: int) -> None:
        if any(n.tag in BLOCKS for n in self._stack[i:]):
            self._flush()
        del self._stack[i:]

    def _flush(self) -> None:
        """Ends the block of text that is being read."""
        text = _SPACE.sub(" ", "".join(self._pieces)).strip()
        if text:
            owner = next((n for n in reversed(self._stack) if n.tag in BLOCKS or n.parent is None), self._stack[0])
            if not owner.foreign and (not owner.head or owner.inside and owner.tag in HEADINGS):
                self.blocks.append((owner, text, self._linked))
        self._pieces, self._linked = [], 0

    def best(self) -> _Node | None:
        """The container of the article, around the one with the most running text of its own.

        For that, the parent of a container gets half of its text too.
        """
        for node in (self._page, *self.nodes):
            node.weight = node.credit = 0.0
        for owner, text, linked in self.blocks:
            gain = len(text) - 2.0 * min(linked, len(text))
            gain += 20.0 * sum(text.count(c) for c in ",.;:!?") if gain > 0 else 0.0
            node = owner if owner.tag in CONTAINERS or owner.up is None else owner.up
            node.weight += max(gain, 0.0)
            if node.tag in ("li", "dd", "td", "th"):
                gain *= 0.5
            node.credit += gain
            if node.up is not None:
                node.up.credit += 0.5 * gain
        for node in reversed(self.nodes):
            node.up.weight += node.weight
        found, most = None, 0.0
        for node in self.nodes:
            score = node.credit * (1.25 if node.inside else 1.0) * (1.25 if node.tag in ("article", "main") else 1.0)
            if score > most:
                found, most = node, score
        return found and self._whole(found)

    def _whole(self, found: _Node) -> _Node:
        """What holds the whole article of which a container holds a part.

        That is the outermost article or main element around it; an article in a main element
        that has as much running text elsewhere is one of several parts, and one with nearly all
        of it has its title beside it. Without such an element it is the smallest container with
        nearly all running text of the page, or one around that whose class or id says so.
        """
        around = [found]
        while around[-1].up is not None:
            around.append(around[-1].up)
        tops = [n for n in around if n.tag in ("article", "main")]
        if tops:
            articles = [n for n in tops if n.tag == "article"]
            one = articles and 0.5 * tops[-1].weight <= articles[-1].weight < NEARLY * tops[-1].weight
            return articles[-1] if one else tops[-1]
        at = next(i for i, n in enumerate(around) if n.weight >= NEARLY * self._page.weight)
        return next((n for n in reversed(around[at + 1 :]) if n.own), around[at])

    def text(self, path: str | None) -> str:
        """Blocks below the elements at the path, joined by empty lines; below the page's own container of the article without such an element.

        A page without such a container, as one without any or with linked text only, gives its
        article or main elements, and without those all that isn't foreign.
        """
        wanted = {id(n) for n in self.nodes if n.path == path} if path else set()
        if not any(self._below(owner, wanted) for owner, _, _ in self.blocks):
            node = self.best()
            wanted = {id(node)} if node else {id(n) for n in self.nodes if n.tag in ("article", "main") and not n.foreign}
        if not any(self._below(owner, wanted) for owner, _, _ in self.blocks):
            wanted = {id(self._page)}
        return "\n\n".join(text for owner, text, _ in self.blocks if self._below(owner, wanted))

    @staticmethod
    def _below(node: _Node | None, wanted: set[int]) -> bool:
        while node is not None and id(node) not in wanted:
            node = node.parent
        return node is not None


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "html", SLICE_BYTES):
        hosts, paths, credits = [], [], []
        for host, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
            node = Page(source or "").best()
            if node is not None:
                hosts.append(host)
                paths.append(node.path)
                credits.append(round(node.weight))
        yield pa.record_batch([pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(credits, pa.int64())], names=["host", "path", "credit"])


def host_paths(pages: DataFrame) -> DataFrame:
    """One row (host, path, votes) per host for pages (host, html): the path that most pages vote for.

    Of paths with equally many votes, the one with more text wins, then the first by name.
    """
    votes = pages.where("host is not null").select("host", "html").mapInArrow(_votes, "host string, path string, credit bigint")
    counts = votes.groupBy("host", "path").agg(F.count("*").alias("votes"), F.sum("credit").alias("credit"))
    best = F.min_by(F.struct("path", "votes"), F.struct(-F.col("votes"), -F.col("credit"), "path"))
    return counts.groupBy("host").agg(best.alias("best")).select("host", "best.path", "best.votes")


def with_main_text(pages: DataFrame) -> DataFrame:
    """The pages' columns and ``main``, a struct of text and path.

    ``pages`` has url and html; an extra column ``main`` is replaced, others are kept. A null or
    empty html, and one without text that isn't foreign, gives an empty text. Hosts are compared in lower
    case; a page whose url is null or names no host counts for itself. Repeated pages vote each.
    Inside a block white space becomes one space; blocks are joined by empty lines.

    The pages are read twice and never shuffled, unless there are so many hosts that Spark
    doesn't broadcast their paths.
    """
    columns = [c for c in pages.columns if c != "main"]
    host, path, key = unused(pages, "_host", "_path", "_key")
    named = F.lower(F.regexp_extract(F.col("url"), r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    hosted = pages.withColumn(host, F.when(named != "", named))
    paths = stored(host_paths(hosted.select(F.col(host).alias("host"), "html")), "host-paths")
    found = hosted.join(paths.select(F.col("host").alias(key), F.col("path").alias(path)), F.col(host) == F.col(key), "left")

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html", SLICE_BYTES):
            chosen = batch.column(path).to_pylist()
            texts = [Page(source or "").text(p) for source, p in zip(batch.column("html").to_pylist(), chosen, strict=True)]
            made = pa.StructArray.from_arrays([pa.array(texts, pa.string()), pa.array(chosen, pa.string())], ["text", "path"])
            yield pa.record_batch([*[batch.column(c) for c in columns], made], names=[*columns, "main"])

    rows = found.select(*columns, path)
    return rows.mapInArrow(extracted, pages.select(*columns).withColumn("main", F.lit(None).cast("struct<text: string, path: string>")).schema)
