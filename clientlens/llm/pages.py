"""Main text of web pages with the help of a style tree for each site.

*Style tree.* The documents of all pages of a host are merged: a node is a path of elements, each
with its tag and its presentation (class and id without digits). A node that stands on ``m`` pages
has a presentation importance, the entropy of the child sequences it has on them, and a content
importance, 1 less the mean entropy of its blocks of text over the pages; both are scaled by the log
of ``m``. A node is as important as the larger of the two, times the weight of its role.

*Doubt.* Few pages say little, so a node's importance is drawn towards 1 as if ``DOUBT`` more pages
had spoken for it. A branch is as important as the most important node in it, so removing the
blocks of unimportant nodes removes just the unimportant branches.

*Roles.* Elements for navigation, headers, footers, asides, forms, dialogs and the like, by tag or
role attribute, and hidden ones have the weight 0; so has everything in them. So have elements with
a name (a class or id) that says such a thing and nothing else: ``cookie-notice`` and
``left-sidebar``, but not ``social-history``. Within the main element only the names of adverts and
reader comments say so, as their text may differ from page to page; all else is up to the tree. In
an article's own header the headings stay. All others have the weight 1.

*Extraction.* The main text is what is inside ``article`` elements, or ``main``, or an element whose
class or id says content; on a page without any of these it is the body. In the body, nodes with an
importance of ``LEAST_IN_BODY`` or less are removed. Inside the main element they must have ``LEAST``
or less, and stand below an element with a class or id: an article's plain paragraphs stay even if
all pages of a site have the same ones. A page of which nothing would be left keeps its nodes: on a
site of copies of one page the tree can't tell text from frame.

Text is decoded, white space inside a block becomes one blank, blocks are joined by a line break in
page order. ``br`` is white space. Defined results: NULL or empty html has an empty text; NULL or
odd urls are one host; repeated rows are extracted each for itself; an empty table gives no rows;
further columns are left out.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_slices, materialise, strings

LEAST = 0.1
LEAST_IN_BODY = 0.4
DOUBT = 0.5

# Tags and words by their meaning.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset(("script", "style", "textarea", "title", "xmp", "noembed", "noframes"))
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
NOISE_TAGS = frozenset(
    "nav footer aside form head menu button select option datalist noscript template svg math iframe object audio video "
    "canvas dialog".split()
)
NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promotion banner nav navbar "
    "navigation menu menubar breadcrumb breadcrumbs sidebar sidebars aside footer cookie cookies consent gdpr notice "
    "notices popup modal overlay comment comments commentlist disqus respond form login signup subscribe subscription "
    "newsletter share sharing social related recommended recommendations widget pagination pager toolbar search "
    "contentinfo complementary alert".split()
)
OWN_NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored sponsors comment comments commentlist disqus "
    "respond".split()
)
#: Words beside those above that change nothing about what an element is.
PLAIN_WORDS = frozenset(
    "area bar block bottom box button buttons center col column container content div footer form global group header icons "
    "inner item items left line link links list main outer page panel post primary right row secondary section site slot "
    "small text thread top unit wrap wrapper".split()
)
HEADER_WORDS = frozenset(("header", "masthead", "pageheader"))
MAIN_WORDS = frozenset(("content", "maincontent", "article", "articlebody", "post", "entry", "story", "main"))
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",), "tbody": ("tr", "td", "th", "thead", "tbody"), "tfoot": ("tr", "td", "th", "tbody"),
}
#: Elements that an implied end doesn't reach beyond.
SCOPES = frozenset("article aside body div footer form header html main nav ol section table td th ul dl".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>|</([a-zA-Z][^\s/>]*+)[^>]*+>"
    r"|<([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"""(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?(?=[\s/]|\Z)""", re.IGNORECASE)
HOST = re.compile(r"\s*[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)")

#: What a branch is: free, below the header of an article, noise.
FREE, HEADER, NOISE = 0, 1, 2


def number_of(*parts: object) -> int:
    """A signed 64-bit number that is the same in every process."""
    value = xxhash.xxh3_64_intdigest("\x00".join(map(str, parts)))
    return value - (1 << 64) if value >> 63 else value


def host_of(url: str | None) -> str:
    found = HOST.match(url or "")
    return found[1].lower() if found else ""


@dataclass(slots=True)
class Element:
    tag: str
    path: int
    role: int
    main: int
    marked: bool
    children: list[int] = field(default_factory=list)


@dataclass(slots=True)
class Block:
    text: str
    path: int
    role: int
    main: int
    marked: bool


@dataclass
class Page:
    blocks: list[Block]
    #: For each path the sequences of its elements' children.
    sequences: dict[int, list[tuple[int, ...]]]


def _words(text: str) -> set[str]:
    found = set(re.split(r"[^a-z]+", text.lower()))
    return found | {re.sub(r"[^a-z]", "", part) for part in text.lower().split()}


def _says(value: str, words: frozenset[str]) -> bool:
    """Whether one of the names in ``value`` is made of ``words`` and plain words alone."""
    for name in value.split():
        parts = set(re.findall(r"[A-Z]?[a-z]+|[A-Z]+", name))
        parts = {part.lower() for part in parts}
        if re.sub(r"[^a-z]", "", name.lower()) in words or (parts & words and parts <= words | PLAIN_WORDS):
            return True
    return False


def _child(parent: Element, tag: str, attributes: str) -> Element:
    presentation, words, noise = "", set(), False
    noise_words = OWN_NOISE_WORDS if parent.main else NOISE_WORDS
    if attributes:
        for name, value in ATTRIBUTE.findall(attributes):
            name, value = name.lower(), value.strip("\"'")
            if name in ("class", "id", "role"):
                words |= _words(value)
                noise = noise or _says(value, NOISE_WORDS if name == "role" else noise_words)
                presentation += f" {name}={re.sub(r'[0-9]+', '', value.lower())}"
            elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
                noise = True
            elif name == "style" and "display:none" in value.replace(" ", "").lower():
                noise = True
    main = parent.main
    if not main and tag not in ("html", "body"):
        main = 3 if tag == "article" else 2 if tag == "main" or "main" in words else 1 if words & MAIN_WORDS else 0
    elif tag == "article":
        main = 3
    role = parent.role
    if tag in ("html", "body"):
        pass
    elif tag in NOISE_TAGS or noise:
        role = NOISE
    elif role != NOISE and (tag == "header" or words & HEADER_WORDS):
        role = HEADER if parent.main else NOISE
    elif role == HEADER and tag in HEADINGS:
        role = FREE
    path = number_of(parent.path, tag, presentation)
    return Element(tag, path, role, main, parent.marked or bool(parent.main and presentation))


def parse(text: str) -> Page:
    """Blocks of a page in their order; unclosed and stray tags do no harm."""
    stack = [Element("", 0, FREE, 0, False)]
    open_tags: dict[str, int] = {}
    blocks: list[Block] = []
    sequences: dict[int, list[tuple[int, ...]]] = {}
    waiting: list[str] = []
    holder = stack[0]

    def flush() -> None:
        if waiting:
            words = " ".join("".join(waiting).split())
            waiting.clear()
            if words:
                blocks.append(Block(words, holder.path, holder.role, holder.main, holder.marked))

    def say(raw: str) -> None:
        nonlocal holder
        top = stack[-1]
        if waiting and (top.role == NOISE) != (holder.role == NOISE):
            # An inline branch of another role inside a block: left out of it, or a block of its own.
            if top.role == NOISE:
                return
            flush()
        if not waiting or not holder.path:
            holder = next((e for e in reversed(stack) if e.tag not in INLINE), top) if top.role != NOISE else top
        waiting.append(html.unescape(raw) if "&" in raw else raw)

    def close() -> None:
        element = stack.pop()
        open_tags[element.tag] -= 1
        runs = [c for i, c in enumerate(element.children) if not i or c != element.children[i - 1]]
        sequences.setdefault(element.path, []).append(tuple(runs))

    at = 0
    while True:
        token = TOKEN.search(text, at)
        if token is None:
            if at < len(text):
                say(text[at:])
            break
        if token.start() > at:
            say(text[at : token.start()])
        at = token.end()
        end, start = token[1], token[2]
        if start:
            tag = start.lower()
            if tag not in INLINE:
                flush()
                closing = CLOSES.get(tag, ()) if open_tags else ()
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag in closing or (stack[k].tag == "p" and tag not in INLINE):
                        while len(stack) > k:
                            close()
                        if not closing:
                            break
                    elif stack[k].tag in SCOPES and stack[k].tag not in closing:
                        break
            element = _child(stack[-1], tag, token[3])
            stack[-1].children.append(element.path)
            if tag in RAW:
                found = re.compile(f"</{tag}[^>]*>?", re.IGNORECASE).search(text, at)
                at = found.end() if found else len(text)
            elif tag in VOID:
                if tag == "br":
                    say(" ")
            elif not token[3].endswith("/") or tag not in ("svg", "math", "path"):
                stack.append(element)
                open_tags[tag] = open_tags.get(tag, 0) + 1
        elif end:
            tag = end.lower()
            if tag not in INLINE:
                flush()
            if open_tags.get(tag):
                while stack[-1].tag != tag:
                    close()
                close()
    flush()
    while len(stack) > 1:
        close()
    return Page(blocks, sequences)


def extract(page: Page, importance: Mapping[int, float]) -> str:
    """The main text of a page; ``importance`` has that of its host's less important nodes by path."""
    free = [b for b in page.blocks if b.role == FREE]
    main = max((b.main for b in free), default=0)
    inside = [b for b in free if b.main >= main]
    least = LEAST if main else LEAST_IN_BODY
    kept = [b for b in inside if importance.get(b.path, 1.0) > least or (main and not b.marked)]
    return "\n".join(b.text for b in kept or inside)


def style_trees(pages: DataFrame) -> DataFrame:
    """Nodes of all hosts: ``host``, ``path``, ``pages``, ``presentation``, ``content`` and
    ``importance``, before doubt and the weight of the role."""

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts = [host_of(u) for u in batch.column("url").to_pylist()]
            texts = strings(batch, "html")
            for low, high in in_slices(texts, 1 << 20):
                rows = []
                for host, text in zip(hosts[low:high], texts.slice(low, high - low).to_pylist()):
                    page = parse(text)
                    rows += [(host, p, True, number_of(*s)) for p, s in page.sequences.items()]
                    rows += [(host, p, False, t) for p, t in {(b.path, number_of(b.text)) for b in page.blocks}]
                if rows:
                    yield pa.record_batch([pa.array(c) for c in zip(*rows)], names=["host", "path", "layout", "feature"])

    rows = pages.select(F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    found = rows.mapInArrow(features, "host string, path long, layout boolean, feature long")
    counted = found.groupBy("host", "path", "layout", "feature").agg(F.count(F.lit(1)).alias("n"))
    m = F.sum(F.when(F.col("layout"), F.col("n")).otherwise(0))
    layouts = F.sum(F.when(F.col("layout"), -F.col("n") * F.log("n")).otherwise(0.0))
    contents = F.avg(F.when(~F.col("layout"), F.log("n")))
    nodes = counted.groupBy("host", "path").agg(m.alias("pages"), layouts.alias("l"), contents.alias("c"))
    of_m = F.log("pages")
    single = F.col("pages") < 2
    return nodes.select(
        "host",
        "path",
        "pages",
        # The entropy -sum(n/m log(n/m)) is log m + sum(-n log n) / m.
        F.when(single, 1.0).otherwise((of_m + F.col("l") / F.col("pages")) / of_m).alias("presentation"),
        F.when(single, 1.0).otherwise(1 - F.coalesce("c", of_m) / of_m).alias("content"),
    ).withColumn("importance", F.greatest("presentation", "content"))


def main_texts(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every page."""
    doubted = (F.col("pages") * F.col("importance") + DOUBT) / (F.col("pages") + DOUBT)
    weak = style_trees(pages).select("host", F.struct("path", doubted.alias("importance")).alias("node"))
    weak = weak.filter(F.col("node.importance") <= max(LEAST, LEAST_IN_BODY))
    weak = materialise(weak.groupBy("host").agg(F.collect_list("node").alias("weak")), "style-trees")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        site, nodes = None, {}
        for batch in batches:
            hosts, weak_nodes = batch.column("host").to_pylist(), batch.column("weak")
            texts = strings(batch, "html")
            for low, high in in_slices(texts, 1 << 20):
                found = []
                for i, text in enumerate(texts.slice(low, high - low).to_pylist(), low):
                    if hosts[i] != site:
                        site = hosts[i]
                        nodes = {n["path"]: n["importance"] for n in weak_nodes[i].as_py() or ()}
                    found.append(extract(parse(text), nodes))
                own = [batch.column(c).slice(low, high - low) for c in ("page_id", "url")]
                yield pa.record_batch([*own, pa.array(found, pa.string())], names=["page_id", "url", "text"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    host = F.lower(F.coalesce(F.regexp_extract("url", r"^\s*[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1), F.lit("")))
    joined = rows.withColumn("host", host).join(weak, "host", "left")
    texts = joined.mapInArrow(run, "page_id long, url string, text string")
    return texts.withColumn("n_chars", F.length("text").cast("long"))
