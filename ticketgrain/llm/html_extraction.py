"""Main text of web pages by site template removal.

Each page is parsed once into blocks of text.  The subtrees of its block elements are hashed (tag,
text and children; no attributes), and Spark counts for each host in how many different surroundings
a subtree stands: the surroundings are the digest of the page's other text, so that copies of one
article count once and are not taken for a template.  Subtrees that stand in at least ``MIN_PAGES``
different surroundings, and in ``MIN_SHARE`` of the host's different pages, are the site's template
and are deleted from every page of that host.

Hosts of few pages show no repetition, and some boilerplate differs from page to page.  So elements
whose tag, role or class names say what they are (menus, footers, adverts, comments, forms, hidden
parts) are left out while parsing, and a page that marks its article gives only that.  Paragraphs
and headings inside a marked article are never deleted as template: passages that many articles of
a site quote are text.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketgrain.llm.common import map_texts, order_id, quoted
from ticketgrain.session import scratch_path

MIN_PAGES = 5
MIN_SHARE = 0.4
# The counts of a host's hot subtrees are joined back in so many parts.
SALTS = 16
# A list or box whose text is links to this share is a menu, where no article is marked.
LINK_SHARE = 0.8
# The plainest mark of an article holds unless a less plain one has more than this many times its text.
OUTWEIGHED = 3

# --- fixed values of the HTML standard and of common naming ------------------------------------
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PROSE = HEADINGS | frozenset("p li dt dd blockquote pre td th tr tbody table caption figcaption".split())
CELLS = frozenset(("td", "th"))
# The elements that a start tag ends, and those that it does not reach beyond.
ENDS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th"), "tr": ("tr",),
    "tbody": ("thead", "tbody"), "tfoot": ("thead", "tbody"),
}
WALLS = {"li": ("ul", "ol", "menu", "dir"), "dt": ("dl",), "dd": ("dl",), "td": ("tr", "table"), "th": ("tr", "table")}
UNSEEN = frozenset(
    "head script style title noscript noembed noframes xmp template iframe object applet svg math canvas audio video select datalist "
    "textarea button form fieldset dialog nav aside footer menu".split()
)
ROLES = frozenset(
    "navigation contentinfo complementary search form dialog alertdialog alert status menu menubar toolbar tablist".split()
)
NAMES = frozenset(
    "nav navbar navigation menu menus submenu topnav breadcrumb breadcrumbs footer sidebar aside toolbar "
    "ad ads adbox adslot adsense adunit adwrap banner promo promos promotion promoted "
    "cookie cookies consent gdpr notice notices notification notifications alert alerts popup modal overlay disclaimer paywall "
    "newsletter subscribe subscription signup login signin share sharing sharebar social "
    "related recommended recommendation recommendations pagination pager widget widgets search searchbox form "
    "comment comments commentlist disqus replies reply respond responses discussion hidden".split()
)
HEADER_NAMES = frozenset("header masthead".split())
CONTENT_NAMES = frozenset("content article post entry story main articlebody maincontent postbody postcontent entrycontent".split())
_ADVERT = re.compile(r"advert|adsby|googlead|taboola|outbrain|sponsor")
_HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
_NOT = ("has", "no", "with", "without", "is", "not")

# Comments, declarations and tags; anything else that begins with < is text.
_MARKUP = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<[!?][^>]*+(?:>|\Z)|</[^a-zA-Z][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|=?[^\s/>=]++(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+)?)?|=)*+)(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s/>=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]*))?")
_TELLING = re.compile(r"class|id|role|style|hidden|itemprop", re.IGNORECASE)
_WORDS = re.compile(r"[A-Z]?[a-z0-9]+|[A-Z0-9]+")

KEEP, SKIP, HEADER = 0, 1, 2


def attributes(written: str) -> dict[str, str]:
    if not written or not _TELLING.search(written):
        return {}
    return {name.lower(): unescape(value.strip("\"'")) for name, value in _ATTRIBUTE.findall(written)}


def names_of(attrs: dict[str, str]) -> list[list[str]]:
    """The words of each class and id: ``post-Header sideBar`` gives [post, header], [side, bar]."""
    return [[w.lower() for w in _WORDS.findall(n)] for n in f"{attrs.get('class', '')} {attrs.get('id', '')}".split()]


def verdict(tag: str, attrs: dict[str, str]) -> int:
    """What tag, role and names say: part of the text, boilerplate, or a header (whose headings may be text)."""
    if tag in UNSEEN:
        return SKIP
    if tag == "header":
        return HEADER
    if not attrs:
        return KEEP
    role = attrs.get("role", "").lower()
    if role in ROLES or "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true" or _HIDING.search(attrs.get("style", "")):
        return SKIP
    names = [words for words in names_of(attrs) if words and words[0] not in _NOT]
    if tag in ("html", "body", "main") or tag in HEADINGS:
        return KEEP
    if tag == "article":
        return SKIP if any({"comment", "comments", "reply"} & set(words) for words in names) else KEEP
    for words in names:
        joined = "".join(words)
        if joined in NAMES or not NAMES.isdisjoint(words) or _ADVERT.search(joined):
            return SKIP
    if role == "banner" or any(not HEADER_NAMES.isdisjoint(words) for words in names):
        return HEADER
    return KEEP


def content_rank(tag: str, attrs: dict[str, str]) -> int:
    """How plainly an element says that it holds the article: 3 article, 2 main, 1 by its names, 0 not."""
    if tag == "article" or "articlebody" in attrs.get("itemprop", "").lower():
        return 3
    if tag == "main" or attrs.get("role", "").lower() in ("main", "article"):
        return 2
    return int(tag in ("div", "section", "td") and any("".join(words) in CONTENT_NAMES for words in names_of(attrs)))


class Element:
    __slots__ = ("tag", "verdict", "rank", "start", "end", "depth", "hasher", "digest")

    def __init__(self, tag: str, says: int, rank: int, start: int, depth: int) -> None:
        self.tag, self.verdict, self.rank, self.start, self.depth = tag, says, rank, start, depth
        self.hasher = xxhash.xxh64(tag)


class Page:
    """The blocks of a page in its order, and its block elements as ranges of them.

    Tag soup is read as browsers read it where it matters here: a new block ends an open paragraph,
    items, cells and rows end their predecessors, end tags without a start are ignored, and what is
    open at the end of the page ends there.  The cells of a row are one block.
    """

    def __init__(self, html: str) -> None:
        self.stack = [Element("html", KEEP, 0, 0, 0)]
        self.open: Counter[str] = Counter()
        self.skipped = self.headers = self.headings = self.links = self.articles = 0
        self.parts: list[str] = []
        self.link_chars = 0
        self.blocks: list[str] = []
        # sums over the blocks before each: characters, characters in links, hashes
        self.chars, self.linked, self.sums = [0], [0], [0]
        self.elements: list[Element] = []
        self.read(html)

    def read(self, html: str) -> None:
        at = 0
        while (m := _MARKUP.search(html, at)) is not None:
            if m.start() > at:
                self.data(html[at : m.start()])
            at = m.end()
            if m[2] is None:
                continue
            tag = m[2].lower()
            if m[1]:
                self.end_tag(tag)
                continue
            self.start_tag(tag, m[3])
            if tag in RAW:  # up to its end tag there is no markup
                close = re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE).search(html, at)
                at = close.start() if close else len(html)
        self.data(html[at:])
        self.pop_to(1)
        self.flush()

    def data(self, text: str) -> None:
        if self.skipped or (self.headers and not self.headings):
            return
        self.parts.append(unescape(text) if "&" in text else text)
        if self.links:
            self.link_chars += len(text.strip())

    def flush(self) -> None:
        """End the current block."""
        if not self.parts:
            return
        text, linked = " ".join("".join(self.parts).split()), self.link_chars
        self.parts, self.link_chars = [], 0
        if text:
            hashed = xxhash.xxh64(text)
            self.stack[-1].hasher.update(hashed.digest())
            self.blocks.append(text)
            self.chars.append(self.chars[-1] + len(text))
            self.linked.append(self.linked[-1] + min(linked, len(text)))
            self.sums.append((self.sums[-1] + hashed.intdigest()) % 2**64)

    def start_tag(self, tag: str, written: str) -> None:
        if tag in VOID:
            self.parts.append(" ")
            if tag == "hr":
                self.close_paragraph()
                self.flush()
            return
        if tag in ("html", "body"):
            return
        if tag in BLOCK:
            self.close_paragraph()
            self.close_implied(tag)
            if tag in CELLS:
                self.parts.append(" ")
            else:
                self.flush()
        attrs = attributes(written)
        says = verdict(tag, attrs)
        if says == HEADER and not self.articles:
            says = SKIP
        rank = content_rank(tag, attrs) if tag in BLOCK and not self.skipped else 0
        self.stack.append(Element(tag, says, rank, len(self.blocks), len(self.stack)))
        self.count(self.stack[-1], 1)

    def count(self, element: Element, by: int) -> None:
        self.open[element.tag] += by
        self.skipped += by * (element.verdict == SKIP)
        self.headers += by * (element.verdict == HEADER)
        self.headings += by * (element.tag in HEADINGS)
        self.links += by * (element.tag == "a")
        self.articles += by * (element.rank == 3)

    def end_tag(self, tag: str) -> None:
        if tag in VOID:
            self.parts.append(" ")
            return
        if not self.open[tag]:
            return
        for depth in range(len(self.stack) - 1, 0, -1):
            if self.stack[depth].tag == tag:
                self.pop_to(depth)
                return
            if tag not in BLOCK and self.stack[depth].tag in BLOCK:
                return  # a misnested inline element does not end a block

    def close_paragraph(self) -> None:
        if not self.open["p"]:
            return
        for depth in range(len(self.stack) - 1, 0, -1):
            if self.stack[depth].tag == "p":
                self.pop_to(depth)
                return
            if self.stack[depth].tag in BLOCK:
                return

    def close_implied(self, tag: str) -> None:
        ends = ENDS.get(tag, ())
        if not any(self.open[t] for t in ends):
            return
        for depth in range(len(self.stack) - 1, 0, -1):
            if self.stack[depth].tag in ends:
                self.pop_to(depth)
                return
            if self.stack[depth].tag in WALLS.get(tag, ("table",)):
                return

    def pop_to(self, depth: int) -> None:
        while len(self.stack) > depth:
            element = self.stack[-1]
            if element.tag in CELLS:
                self.parts.append(" ")
            elif element.tag in BLOCK:
                self.flush()
            self.stack.pop()
            self.count(element, -1)
            element.end = len(self.blocks)
            element.digest = element.hasher.intdigest()
            if element.verdict != SKIP:
                self.stack[-1].hasher.update(element.digest.to_bytes(8, "little"))
                if element.tag in BLOCK and element.end > element.start:
                    self.elements.append(element)

    def size(self, e: Element) -> int:
        return self.chars[e.end] - self.chars[e.start]

    def article(self) -> Element | None:
        """The element that holds the article, if one says so."""
        best = None
        for rank in (1, 2, 3):
            marked = [e for e in self.elements if e.rank == rank]
            if not marked:
                continue
            largest = max(map(self.size, marked))
            # of elements one in another, the innermost that has nearly all of the text
            chosen = max((e for e in marked if self.size(e) >= 0.9 * largest), key=lambda e: (e.depth, self.size(e), -e.start))
            if best is None or OUTWEIGHED * self.size(chosen) >= self.size(best):
                best = chosen
        return best

    def extract(self) -> tuple[list[str], int, list[tuple[int, int, int, int]]]:
        """Blocks, their digest, and (hash, digest of the other blocks, start, end) of the subtrees that may be template."""
        whole = self.article()
        start, end = (whole.start, whole.end) if whole else (0, len(self.blocks))
        total = self.sums[end] - self.sums[start]
        dropped, subtrees = [], []
        for e in self.elements:
            if e is whole or e.start < start or e.end > end or (whole and e.tag in PROSE):
                continue
            if not whole and e.tag not in PROSE - {"li", "table"} and self.linked[e.end] - self.linked[e.start] >= LINK_SHARE * self.size(e):
                dropped.append((e.start, e.end))
            if e.end - e.start < end - start:
                others = (total - self.sums[e.end] + self.sums[e.start]) % 2**64
                subtrees.append((e.digest - 2**63, others - 2**63, e.start - start, e.end - start))
        blocks = self.blocks[start:end]
        for a, b in dropped:  # their places stay, so that the ranges do
            blocks[a - start : b - start] = [""] * (b - a)
        return blocks, total % 2**64 - 2**63, subtrees


def host_of(url: Column) -> Column:
    """Lower-case host of a URL; null where there is none."""
    host = F.regexp_extract(url, r"^\s*[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.when(host != "", F.lower(host))


_PARSED = (
    "page_id long, url string, key long, tie long, host string, blocks array<string>, digest long, "
    "subtrees array<struct<hash: long, others: long, first: int, last: int>>"
)


def parsed_pages(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """Each page's blocks and subtrees, written once."""
    spark = pages.sparkSession
    kind = pa.list_(pa.struct([("hash", pa.int64()), ("others", pa.int64()), ("first", pa.int32()), ("last", pa.int32())]))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        blocks, digests, subtrees = [], [], []
        for html in batch.column("html").to_pylist():
            found, digest, within = Page(html).extract()
            blocks.append(found)
            digests.append(digest)
            subtrees.append([dict(zip(("hash", "others", "first", "last"), s, strict=True)) for s in within])
        columns = [batch.column(c) for c in ("page_id", "url", "key", "tie", "host")]
        columns += [pa.array(blocks, pa.list_(pa.string())), pa.array(digests, pa.int64()), pa.array(subtrees, kind)]
        return pa.record_batch(columns, ["page_id", "url", "key", "tie", "host", "blocks", "digest", "subtrees"])

    rows = pages.select(
        quoted(id_col).cast("long").alias("page_id"), quoted(url_col).cast("string").alias("url"),
        F.coalesce(quoted(html_col).cast("string"), F.lit("")).alias("html"),
    )
    rows = rows.select(
        "page_id", "url", order_id("page_id").alias("key"), F.xxhash64("url", "html").alias("tie"), host_of(F.col("url")).alias("host"), "html"
    )
    path = scratch_path(spark, "pages")
    parsed = map_texts(rows, run, _PARSED, "html")
    parsed.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(parsed.schema).parquet(path)


def templates(parsed: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """host, hash: the subtrees that recur in so many different surroundings on a host."""
    places = parsed.filter("host IS NOT NULL").select("host", F.explode("subtrees").alias("s"))
    counted = places.select("host", "s.hash", "s.others").distinct().groupBy("host", "hash").agg(F.count(F.lit(1)).alias("n"))
    sizes = parsed.filter("host IS NOT NULL").select("host", "digest").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    often = counted.filter(F.col("n") >= min_pages).join(sizes.filter(F.col("pages") >= min_pages), "host")
    return often.filter(F.col("n") >= min_share * F.col("pages")).select("host", "hash")


def extract_text(
    pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE,
    id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
) -> DataFrame:
    """page_id, url, text, n_chars: one row for each row of ``pages``.

    ``text`` has one line for each block: character references decoded, white space (line breaks
    too) turned into single spaces, ends trimmed.  Null and empty pages, and pages without text, have
    an empty one.  Pages whose URL has no host have no template.  Equal rows have equal results.
    """
    spark = pages.sparkSession
    parsed = parsed_pages(pages, id_col, url_col, html_col)
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    wanted = templates(parsed, min_pages, min_share).select("host", "hash", salts)
    places = parsed.filter("host IS NOT NULL").select(
        "key", "tie", "host", F.pmod(F.xxhash64("key", "tie"), F.lit(SALTS)).cast("int").alias("salt"), F.explode("subtrees").alias("s")
    )
    hits = places.select("*", "s.hash").join(wanted, ["host", "hash", "salt"])
    hits = hits.groupBy("key", "tie").agg(F.collect_set(F.struct("s.first", "s.last")).alias("gone"))
    # a table of its own, so that the planner knows its size before any text moves
    path = scratch_path(spark, "page-templates")
    hits.write.parquet(path)
    both = parsed.join(spark.read.schema(hits.schema).parquet(path), ["key", "tie"], "left")
    kept = F.filter(
        "blocks",
        lambda text, i: (text != "") & ~F.coalesce(F.exists("gone", lambda g: (g["first"] <= i) & (i < g["last"])), F.lit(False)),
    )
    both = both.select("page_id", "url", F.array_join(kept, "\n").alias("text"))
    return both.withColumn("n_chars", F.char_length("text").cast("long"))
