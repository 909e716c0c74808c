"""Main text of web pages by consensus paths of their host.

Each page is read once to score its containers: the smallest container that holds nearly all clean
text (outside links and outside parts that are never content) gives the page's vote, a path of tags
with generalised classes. Votes are counted per host in Spark. Each page is then read again with the
winning path of its host; a page without such a container falls back to its own choice.

Defined results: null, empty or textless html gives an empty text; a null or malformed url belongs
to the host of the empty name; a tie of votes goes to more clean text, then to the smaller path;
repeated rows vote each and are extracted alike; a very long page is read whole; an empty table
gives an empty result. Only the
named columns are read. ``br`` ends a line as a block does; a character reference without meaning
stays as written; markup that never closes runs to the end of the page.
"""

from __future__ import annotations

import hashlib
import html as references
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera_spark.llm import common

MARKUP = re.compile(
    r"""<!--(?:.*?-->|.*\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>"']|"[^"]*"|'[^']*')*|[^>]*)>""", re.DOTALL
)
ATTRIBUTE = re.compile(r"""([a-zA-Z][\w:-]*)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)|(\bhidden\b)""")
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Elements that can be the main container.
CONTAINERS = {"body", "article", "main", "section", "div", "td", "form", "center"}
BLOCKS = CONTAINERS | {
    "p", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "li", "dl", "dt", "dd", "table", "thead", "tbody", "tfoot", "tr", "th", "caption",
    "blockquote", "pre", "figure", "figcaption", "address", "header", "footer", "nav", "aside", "hr", "br", "html", "head", "details",
    "summary", "fieldset",
}
#: What a start tag closes if it is open, up to the nearest container or list.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
STOPS = {"ul", "ol", "dl", "table", "body", "article", "main", "section", "div", "center", "form"}
#: Never content.
DROPPED = {"head", "nav", "footer", "aside", "button", "select", "svg", "dialog", "menu", "object", "canvas", "audio", "video"} | RAW
HINTS = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion sidebar nav navbar navigation menu menus breadcrumb "
    "breadcrumbs cookie cookies consent notice notices notification banner newsletter subscribe popup modal comment comments disqus respond "
    "reply replies share sharing social related footer masthead widget toolbar pagination pager login signup".split()
)
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu", "menubar"}
#: A page's own choice holds at least this share of its clean text, and what looks like furniture by
#: its names, or is a form, is none if it holds as much.
NEARLY_ALL = 0.9
#: A host's path counts on a page unless the page's own choice holds more than twice as much and is
#: no stray remark but an article of its own.
HOST_SHARE, ARTICLE_CHARS = 0.5, 250


@dataclass
class Page:
    """Elements in page order and texts with the element and block they stand in."""

    parent: list[int]
    tag: list[str]
    path: list[str]
    barred: list[int]  # nearest element at or above that is never content, -1 if none
    hinted: set[int]  # elements that are only taken for furniture by their names, or forms
    texts: list[tuple[int, int, bool, str]]


def _never_content(tag: str, attributes: dict[str, str], in_article: bool) -> bool:
    if tag in DROPPED or (tag == "header" and not in_article):
        return True
    if attributes.get("role", "") in ROLES or attributes.get("aria-hidden") == "true" or "hidden" in attributes:
        return True
    return "display:none" in attributes.get("style", "").replace(" ", "")


def _looks_like_furniture(tag: str, attributes: dict[str, str], in_article: bool) -> bool:
    """By the parts of class and id names; an article or main part by whole names only."""
    if tag == "body":
        return False
    names = f"{attributes.get('class', '')} {attributes.get('id', '')}"
    words = set(names.split() if tag in ("article", "main") else re.split(r"[\s_-]+", names))
    return tag == "form" or bool(words & HINTS) or ("header" in words and not in_article)


def _below(path: str, part: str) -> str:
    """A path one element longer; beyond 2,000 characters a digest stands for what is above."""
    if len(path) > 2000:
        path = hashlib.sha256(path.encode("utf-8", "surrogatepass")).hexdigest()
    return f"{path}/{part}"


def parse(text: str) -> Page:
    page = Page([-1], ["html"], ["html"], [-1], set(), [])
    stack = [0]
    articles = links = block = 0
    at, end = 0, len(text)

    def close(to: int) -> None:
        nonlocal articles, links
        while len(stack) > to:
            closed = page.tag[stack.pop()]
            articles -= closed in ("article", "main")
            links -= closed == "a"

    def words(a: int, b: int) -> None:
        if b > a and (piece := references.unescape(text[a:b])):
            page.texts.append((stack[-1], block, links > 0, piece))

    while at < end:
        found = MARKUP.search(text, at)
        if not found:
            words(at, end)
            break
        words(at, found.start())
        at = found.end()
        tag = (found[2] or "").lower()
        if not tag:
            continue
        block += tag in BLOCKS
        if found[1]:
            for k in range(len(stack) - 1, 0, -1):
                if page.tag[stack[k]] == tag:
                    close(k)
                    break
                if page.tag[stack[k]] in CONTAINERS and tag not in BLOCKS:
                    break  # an inline end tag closes nothing outside its container
            continue
        if tag in ("html", "br", "wbr") or tag in VOID:
            continue
        if tag in BLOCKS:  # a block ends an open paragraph and what is open in it
            for k in range(len(stack) - 1, 0, -1):
                if page.tag[stack[k]] == "p":
                    close(k)
                    break
                if page.tag[stack[k]] in STOPS:
                    break
        for k in range(len(stack) - 1, 0, -1) if tag in CLOSES else ():
            if page.tag[stack[k]] in CLOSES[tag]:
                close(k)
            elif page.tag[stack[k]] in STOPS:
                break
        attributes = {m[1].lower() if m[1] else "hidden": (m[2] or "").strip("\"'").lower() for m in ATTRIBUTE.finditer(found[3] or "")}
        if tag in RAW:
            stop = re.compile(rf"</{tag}\b[^>]*>", re.IGNORECASE).search(text, at)
            at = stop.end() if stop else end
            continue
        parent = stack[-1]
        number = len(page.tag)
        kinds = sorted(re.sub(r"\d+", "#", c) for c in attributes.get("class", "").split())
        page.parent.append(parent)
        page.tag.append(tag)
        page.path.append(_below(page.path[parent], ".".join([tag, *kinds])))
        page.barred.append(number if _never_content(tag, attributes, articles > 0) else page.barred[parent])
        if page.barred[number] < 0 and _looks_like_furniture(tag, attributes, articles > 0):
            page.hinted.add(number)
        stack.append(number)
        articles += tag in ("article", "main")
        links += tag == "a"
    _bar_furniture(page)
    return page


def _bar_furniture(page: Page) -> None:
    """Bar what looks like furniture, unless it holds nearly all text: a page in one form, a body or
    a wrapper with an unlucky name."""
    sizes = clean_sizes(page)
    for k in range(1, len(page.tag)):
        if page.barred[k] < 0:
            furniture = k in page.hinted and sizes[k] < NEARLY_ALL * max(sizes[0], 1)
            page.barred[k] = k if furniture else page.barred[page.parent[k]]


def clean_sizes(page: Page) -> list[int]:
    """Clean characters below each element: not in links, not in what is never content."""
    sizes = [0] * len(page.tag)
    for element, _, linked, piece in page.texts:
        if not linked and page.barred[element] < 0:
            sizes[element] += len(piece.strip())
    for k in range(len(sizes) - 1, 0, -1):
        sizes[page.parent[k]] += sizes[k]
    return sizes


def _with_headline(page: Page, k: int) -> int:
    """Container k, or one above it in which headline or lead stand before it on their own. Of the
    body, only if there is a first headline among them."""
    while k > 0:
        up = page.parent[k]
        while up > 0 and page.tag[up] not in CONTAINERS:
            up = page.parent[up]
        if up <= 0 or page.barred[up] >= 0:
            return k
        before, headline = False, False
        for element, _, linked, piece in page.texts:
            if element >= k:
                break
            inside, first = element, False
            while inside > up and page.tag[inside] not in CONTAINERS:
                first |= page.tag[inside] == "h1"
                inside = page.parent[inside]
            if inside == up and not linked and page.barred[element] < 0 and piece.strip():
                before, headline = True, headline or first
        if not before or (page.tag[up] == "body" and not headline):
            return k
        k = up
    return k


def choice(page: Page) -> int | None:
    """The page's own choice: an article or main part that holds most text, else the smallest
    container with nearly all clean text, and headline and lead right before it."""
    sizes = clean_sizes(page)
    whole = sizes[0]
    best: tuple[tuple[bool, int], int] | None = None
    for k, tag in enumerate(page.tag):
        if sizes[k] and (k == 0 or tag in CONTAINERS) and page.barred[k] < 0:
            named = tag in ("article", "main") and 2 * sizes[k] >= whole
            if named or sizes[k] >= NEARLY_ALL * whole:
                # Of the named ones and of the others the last is the innermost.
                best = max(best or ((named, k), k), ((named, k), k))
    return best and (best[1] if best[0][0] else _with_headline(page, best[1]))


def vote(page: Page) -> tuple[str, int] | None:
    """Path and clean size of the page's own choice."""
    k = choice(page)
    return None if k is None else (page.path[k], clean_sizes(page)[k])


def extract(page: Page, path: str | None) -> str:
    """Text of all containers with this path, block by block; of the page's own choice if they hold
    nothing, or much less than an article that stands elsewhere."""
    sizes, own = clean_sizes(page), choice(page)
    if own is None:
        return ""
    chosen = [k for k, p in enumerate(page.path) if p == path and sizes[k]]
    held = sum(sizes[k] for k in chosen)
    if not held or (held < HOST_SHARE * sizes[own] and sizes[own] >= ARTICLE_CHARS):
        chosen = [k for k, p in enumerate(page.path) if p == page.path[own]]
    above = [-1] * len(page.tag)  # the outermost chosen element at or above
    inside = set(chosen)
    for k in range(len(page.tag)):
        up = above[page.parent[k]] if k else -1
        above[k] = up if up >= 0 else (k if k in inside else -1)
    blocks: list[list[str]] = []
    last = None
    for element, block, _, piece in page.texts:
        top = above[element]
        if top < 0 or page.barred[element] > top:
            continue
        if block != last:
            blocks.append([])
            last = block
        blocks[-1].append(piece)
    lines = (" ".join("".join(b).split()) for b in blocks)
    return "\n".join(line for line in lines if line)


def extract_pages(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text, n_chars, one row per input row."""
    common.prepared(pages.sparkSession)
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"),
        F.col(url).cast("string").alias("url"),
        F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)).alias("host"),
        F.coalesce(F.col(html), F.lit("")).alias("html"),
    )

    def votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(h, v) for h, text in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True) if (v := vote(parse(text)))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([h for h, _ in found], pa.string()), pa.array([v[0] for _, v in found], pa.string()), pa.array([v[1] for _, v in found], pa.int64())],
                ["host", "path", "size"],
            )

    counted = rows.select("host", "html").mapInArrow(votes, "host string, path string, size long").groupBy("host", "path")
    counted = counted.agg(F.count("*").alias("votes"), F.sum("size").alias("size"))
    first = F.min(F.struct((-F.col("votes")).alias("votes"), (-F.col("size")).alias("size"), "path"))
    winners = common.stored(counted.groupBy("host").agg(first.alias("first")).select("host", F.col("first.path").alias("path")), "host-paths")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(parse(text), path) for text, path in zip(batch.column("html").to_pylist(), batch.column("path").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    told = rows.join(common.small_or_plain(winners), "host", "left").select("page_id", "url", "html", "path")
    return told.mapInArrow(read, "page_id long, url string, text string, n_chars long")
