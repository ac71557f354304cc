"""HTML extraction: the article of a page, without what the pages of its host share.

1. *Trees.* Each page is parsed into elements; end tags that HTML lets a page leave out are
   supplied. The digest of an element covers its tag, class, text and the digests below it.
2. *Site templates.* Digests are counted per host in Spark, each different page once. Those
   on at least ``min_pages`` pages and ``min_share`` of a host's pages are its template.
   Only elements outside the article can go so, and those in it that hold a few words and
   no paragraph or heading, as repeated paragraphs of articles are articles' text.
3. *Text.* From the article (or the main part, or the body) of each page, elements of the
   template go, and those that say by tag, role, class or id that they are navigation,
   headers, footers, asides, forms, notices, adverts, comments or code.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roomgrid.llm.common import stored, table

MIN_PAGES = 5
MIN_SHARE = 0.1
FEW_WORDS = 40
#: A template of at most so many digests goes to every task (a few megabytes); a larger one is joined.
BROADCAST_ROWS = 100_000

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?>[^>"']|"[^"]*"|'[^']*')*+)>""", re.S
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_WORD = re.compile(r"[a-z]+|[0-9]+")

_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
_PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre".split())
#: A start tag ends open elements of these kinds, up to the nearest of the bounds.
_CLOSES = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
    "body": (frozenset(["head"]), frozenset(["html"])),
}
_P_BOUNDS = frozenset("button table td th caption object li article main body html".split())
_DROP_TAGS = frozenset(
    "head script style noscript template nav footer aside form button select option textarea input iframe svg math canvas object applet dialog menu title audio video noembed noframes".split()
)
_DROP_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
_DROP_WORDS = frozenset(
    """ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner
    nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager toolbar
    sidebar aside footer foot copyright legal masthead topbar
    cookie cookies consent gdpr notice notices notification notifications popup modal overlay alert
    newsletter subscribe subscription signup login form search
    comment comments commentlist disqus reply replies respond discussion
    share sharing social related recommended recommendations teaser widget hidden""".split()
)


@dataclass(slots=True)
class Element:
    tag: str
    parent: int
    names: frozenset[str]
    hidden: bool
    main: bool
    words: int = 0
    prose: bool = False
    digest: int = 0
    parts: list[str] = field(default_factory=list)


def _attributes(raw: str) -> dict[str, str]:
    return {k.lower(): (v[1:-1] if v[:1] in "\"'" else v) for k, v in _ATTRIBUTE.findall(raw)} if raw.strip() else {}


class Page:
    """The elements of a page in order, and its text pieces with the element each is in."""

    def __init__(self, source: str | None) -> None:
        self.elements = [Element("", -1, frozenset(), False, False)]
        self.pieces: list[tuple[int, str | None]] = []  # a None parts two blocks
        self._stack = [0]
        self._paragraphs = 0  # open ones
        self._read(source or "")
        while self._stack:
            self._close()

    def _close(self) -> None:
        number = self._stack.pop()
        e = self.elements[number]
        self._paragraphs -= e.tag == "p"
        e.digest = xxhash.xxh3_64_intdigest("\x1f".join([e.tag, " ".join(sorted(e.names)), *e.parts])) >> 1
        e.parts = []
        if e.parent >= 0:
            up = self.elements[e.parent]
            up.words += e.words
            up.prose |= e.prose or e.tag in _PROSE
            if e.words:
                up.parts.append(f"\x1e{e.digest}")
        if e.tag not in _INLINE:
            self.pieces.append((number, None))

    def _close_to(self, tags: frozenset[str], bounds: frozenset[str]) -> None:
        for depth in range(len(self._stack) - 1, 0, -1):
            tag = self.elements[self._stack[depth]].tag
            if tag in tags:
                while len(self._stack) > depth:
                    self._close()
                return
            if tag in bounds:
                return

    def _text(self, text: str) -> None:
        if text:
            here = self._stack[-1]
            text = entities.unescape(text)
            self.pieces.append((here, text))
            words = text.split()
            if words:
                self.elements[here].words += len(words)
                self.elements[here].parts.append(" ".join(words))

    def _open(self, tag: str, raw: str) -> None:
        if tag in _CLOSES:
            self._close_to(*_CLOSES[tag])
        if tag not in _INLINE:
            if self._paragraphs and (tag not in _VOID or tag == "hr"):
                self._close_to(frozenset(["p"]), _P_BOUNDS)
            self.pieces.append((self._stack[-1], None))
        if tag in _VOID:
            return
        a = _attributes(raw)
        names = frozenset(_WORD.findall(f"{a.get('class', '')} {a.get('id', '')}".lower()))
        role = a.get("role", "").lower()
        style = a.get("style", "").replace(" ", "").lower()
        hidden = "hidden" in a or a.get("aria-hidden") == "true" or "display:none" in style or role in _DROP_ROLES
        self.elements.append(Element(tag, self._stack[-1], names, hidden, tag == "main" or role == "main"))
        self._stack.append(len(self.elements) - 1)
        self._paragraphs += tag == "p"

    def _end(self, tag: str) -> None:
        for depth in range(len(self._stack) - 1, 0, -1):
            open_tag = self.elements[self._stack[depth]].tag
            if open_tag == tag:
                while len(self._stack) > depth:
                    self._close()
                return
            if tag in _INLINE and open_tag not in _INLINE:
                return
        if tag == "p" or tag == "br":
            self.pieces.append((self._stack[-1], None))

    def _read(self, source: str) -> None:
        at = 0
        while True:
            m = _TOKEN.search(source, at)
            if m is None:
                self._text(source[at:])
                return
            self._text(source[at : m.start()])
            at = m.end()
            tag = (m[2] or "").lower()
            if not tag:
                continue
            if m[1]:
                self._end(tag)
                continue
            self._open(tag, m[3])
            if tag in _RAW and not m[3].rstrip().endswith("/"):
                end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(source, at)
                at = end.start() if end else len(source)

    def root(self) -> int:
        """The article with the most words; else the main part; else what is named like one; else all."""
        gone = self._gone(frozenset(), 0)
        kinds = (
            lambda e: e.tag == "article",
            lambda e: e.main,
            lambda e: e.tag in ("div", "section", "td") and bool(e.names & {"article", "content", "post", "entry", "story", "main"}),
        )
        for kind in kinds:
            found = [k for k, e in enumerate(self.elements) if k and kind(e) and e.words and not gone[k]]
            if found:
                return max(found, key=lambda k: (self.elements[k].words, -k))
        return 0

    def _gone(self, template: frozenset[int], root: int) -> list[bool]:
        """Which elements go, if ``root`` is the article: they, or what they are in."""
        gone = [False] * len(self.elements)
        inside = self.inside(root)
        for k, e in enumerate(self.elements[1:], 1):
            if k == root:
                continue
            named = e.tag not in _INLINE and bool(e.names & _DROP_WORDS) and not (e.tag in ("body", "html", "article", "main") or e.main)
            header = e.tag == "header" and not (inside[k] and root)
            gone[k] = gone[e.parent] or e.hidden or e.tag in _DROP_TAGS or named or header or (e.digest in template and self.removable(k, root, inside))
        return gone

    def inside(self, root: int) -> list[bool]:
        out = [False] * len(self.elements)
        out[root] = True
        for k, e in enumerate(self.elements[1:], 1):
            out[k] = out[k] or out[e.parent]
        return out

    def removable(self, k: int, root: int, inside: list[bool]) -> bool:
        """Whether the element may be part of a template at all."""
        e = self.elements[k]
        if k == root or not e.words or e.tag in _INLINE or e.tag in ("html", "body", "article", "main"):
            return False
        if not root or not inside[k]:
            return True
        return e.tag not in _PROSE and not e.prose and e.words <= FEW_WORDS and e.tag not in ("br", "li", "td", "th", "dd", "dt")

    def digests(self) -> list[int]:
        root = self.root()
        inside = self.inside(root)
        return sorted({e.digest for k, e in enumerate(self.elements) if k and self.removable(k, root, inside)})

    def text(self, template: frozenset[int] = frozenset()) -> str:
        root = self.root()
        gone, inside = self._gone(template, root), self.inside(root)
        if root:  # the article itself stays, whatever it is in
            for k, e in enumerate(self.elements[root + 1 :], root + 1):
                if inside[k] and e.parent == root and gone[root]:
                    gone[k] = gone[k] and e.tag in _DROP_TAGS
        kept = [(" " if text is None else text) for k, text in self.pieces if inside[k] and (text is None or not gone[k])]
        return " ".join("".join(kept).split())


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def extract(
    df: DataFrame, page: str = "page_id", url: str = "url", html: str = "html", min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Per row of ``df``: its id, url, ``text`` and ``n_chars`` in code points.

    Blocks are joined by one blank in page order; white space in a block is one blank. A null
    or empty page, or one without an article's text, gives an empty text. Rows without a url
    or host count as one host; ids may be null; repeated rows and copies count once towards a
    template and get the same text each. Other columns are ignored; an empty table gives no
    rows.
    """
    pages = df.select(F.col(page).alias("page"), F.col(url).alias("url"), F.col(html).alias("html"))
    keyed = pages.withColumn("host", host_of(F.col("url"))).withColumn("key", F.xxhash64("html"))

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [Page(x).digests() for x in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column("key"), pa.array(found, pa.list_(pa.int64()))], ["host", "key", "digests"])

    parsed = keyed.where("html is not null").select("host", "key", "html").mapInArrow(digests, "host string, key long, digests array<long>")
    elements = stored(parsed.select("host", "key", F.explode("digests").alias("digest")), "elements").distinct()
    sizes = keyed.where("html is not null").select("host", "key").distinct().groupBy("host").agg(F.count("*").alias("pages"))
    counts = elements.groupBy("host", "digest").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages)
    template = stored(counts.join(sizes, "host").where(F.col("n") >= min_share * F.col("pages")).select("host", "digest"), "template")
    if template.limit(broadcast_rows + 1).count() <= broadcast_rows:  # pages stay where they are
        by, own = ["host"], F.broadcast(template.groupBy("host").agg(F.collect_set("digest").alias("template")))
    else:  # each page meets only those of the template that are its own
        by, own = ["host", "key"], elements.join(template, ["host", "digest"]).groupBy("host", "key").agg(F.collect_set("digest").alias("template"))

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # one row's template at a time is turned into numbers
            found = [Page(x.as_py()).text(frozenset(t.as_py() or ())) for x, t in zip(batch.column("html"), batch.column("template"))]
            columns = [batch.column("page"), batch.column("url"), pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page", "url", "text", "n_chars"])

    kinds = dict(pages.dtypes)
    joined = keyed.join(own, by, "left").select("page", "url", "html", "template")
    made = joined.mapInArrow(texts, f"page {kinds['page']}, url {kinds['url']}, text string, n_chars long")
    return stored(made, "texts").withColumnsRenamed({"page": page, "url": url})


def op4_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return extract(table(spark, folder, "pages"))
