"""HTML main text by site template removal.

Method: each page is read into its element tree; every block-level subtree gets a
hash of its tags and text.  Spark counts, per host, the distinct pages that each hash
occurs on; subtrees that recur on many pages of their host are template and are
deleted.  Elements that are never article text by their tag or role (menus, headers,
footers, asides, forms, scripts, adverts, notices, comments) go too.  What is left,
block by block, is the text.

Shape of the plan: pages are parsed where they are; (host, hash) pairs are counted
with partial sums per (host, hash, page) and so spread even if one host holds a third
of all pages.  Only recurring hashes (on at least ``MIN_PAGES`` pages) go back, to the
pages that have them, by a join on (host, hash); hashes of a third of all pages are
met by broadcast, as at most ``1 / HOT_SHARE`` can be that frequent.
"""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.llm.common import query, table
from tallyward.session import settle

#: A subtree is template from so many pages and this share of its host's pages.
MIN_PAGES, MIN_SHARE = 5, 0.3
#: The same inside an element that the page marks as its article or main part: there
#: only what nearly every page of the host has is taken for template, so passages that
#: many articles quote stay.
MARKED_PAGES, MARKED_SHARE = 10, 0.9
#: A (host, hash) with more than this share of all counted pairs is broadcast.
HOT_SHARE = 5e-5

#: Elements by what they do in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
NEVER = frozenset(
    "head script style noscript template iframe svg canvas object audio video map nav header footer aside form button select "
    "textarea dialog menu xmp noembed noframes math input title".split()
)
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td "
    "tfoot th thead tr ul".split()
)
CLOSES_P = BLOCK - frozenset(["body", "html", "head"])
#: Open elements of the key's kind end where an element of its kind begins, up to the named containers.
SIBLINGS = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}
ROLES = frozenset("navigation banner contentinfo complementary search menu menubar dialog alert alertdialog toolbar form".split())
#: Words of a class or id that say what an element is, when it is not inside an article's own text block.
BOILER = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|advertising|adsense|banner|sponsor(?:ed)?|promo(?:tion)?|nav|navbar|navigation|menu|menus|"
    r"breadcrumbs?|sidebar|side-bar|header|masthead|footer|comments?|commentlist|disqus|respond|replies|cookie|cookies|consent|gdpr|notice|"
    r"notices|popup|modal|newsletter|subscribe|signup|login|share|sharing|social|related|recommended|widget|toolbar|pagination|pager|"
    r"skip-link|copyright)(?:$|[\s_-])",
    re.I,
)
TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>?", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
SPACE = re.compile(r"\s+")


@dataclass
class Node:
    """An element; ``parts`` holds texts and child nodes in order."""

    tag: str
    boiler: bool = False
    hidden: bool = False
    parts: list = field(default_factory=list)
    hash: int = 0


def _attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, value in ATTRIBUTE.findall(text):
        out.setdefault(name.lower(), html_lib.unescape(value.strip("\"'")) if value else "")
    return out


def _judge(tag: str, attributes: str) -> tuple[bool, bool]:
    """(never article text, hidden) by tag and attributes."""
    if tag in NEVER:
        return True, False
    if not attributes.strip():
        return False, False
    a = _attributes(attributes)
    hidden = "hidden" in a or a.get("aria-hidden") == "true" or bool(re.search(r"display\s*:\s*none", a.get("style", ""), re.I))
    if tag in ("html", "body", "main", "article"):
        return False, hidden
    named = a.get("role", "").lower() in ROLES or bool(BOILER.search(f"{a.get('class', '')} {a.get('id', '')}"))
    return named, hidden


def parse(page: str | None) -> Node:
    """The element tree; unclosed and stray tags are mended, nothing is cut off."""
    root = Node("#root")
    stack = [root]
    text = page or ""
    at, end = 0, len(text)
    while at < end:
        m = TOKEN.search(text, at)
        if not m:
            stack[-1].parts.append(text[at:])
            break
        if m.start() > at:
            stack[-1].parts.append(text[at : m.start()])
        at = m.end()
        tag = m.group(2)
        if tag is None:
            continue
        tag = tag.lower()
        if m.group(1):
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
                # A closing inline tag does not end blocks.
                if stack[i].tag in BLOCK and tag not in BLOCK:
                    break
            continue
        if tag in CLOSES_P:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    del stack[i:]
                    break
                if stack[i].tag in BLOCK:
                    break
        if tag in SIBLINGS:
            ends, inside = SIBLINGS[tag]
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in ends:
                    del stack[i:]
                    break
                if stack[i].tag in inside:
                    break
        node = Node(tag, *_judge(tag, m.group(3)))
        stack[-1].parts.append(node)
        if tag in VOID or m.group(3).endswith("/"):
            continue
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(text, at)
            node.parts.append(text[at : close.start() if close else end])
            at = close.end() if close else end
            continue
        stack.append(node)
    return root


def _clean(raw: str) -> str:
    return SPACE.sub(" ", html_lib.unescape(raw)).strip()


def article(root: Node) -> Node:
    """The element to read: the first outermost article, else main, else the whole page."""
    for wanted in ("article", "main"):
        todo = [root]
        while todo:
            node = todo.pop()
            if node.tag == wanted:
                return node
            todo.extend(p for p in reversed(node.parts) if isinstance(p, Node) and not p.boiler)
    return root


def hash_blocks(root: Node) -> dict[int, Node]:
    """Hash of every block-level subtree that has text, and its first node; sets ``node.hash``."""
    out: dict[int, Node] = {}
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo.extend(p for p in node.parts if isinstance(p, Node))
    for node in reversed(order):  # children first
        h, some = xxhash.xxh64(node.tag), False
        for p in node.parts:
            if isinstance(p, Node):
                h.update(p.hash.to_bytes(8, "little"))
                some |= bool(p.hash)
            elif s := _clean(p):
                h.update(s.encode("utf-8", "surrogatepass"))
                some = True
        node.hash = (h.intdigest() or 1) if some else 0
        if some and node.tag in BLOCK:
            out.setdefault(node.hash, node)
    return out


def render(node: Node, gone: set[int]) -> str:
    """Blocks of text in page order, joined by one line end, without deleted subtrees."""
    blocks: list[str] = []
    run: list[str] = []

    def flush() -> None:
        s = SPACE.sub(" ", html_lib.unescape("".join(run))).strip()
        if s:
            blocks.append(s)
        run.clear()

    todo: list = [node]
    while todo:
        p = todo.pop()
        if p is None:
            flush()
        elif isinstance(p, str):
            run.append(p)
        elif p is node or not (p.boiler or p.hidden or (p.tag in BLOCK and p.hash in gone)):
            if p.tag == "br":
                run.append(" ")
            elif p.tag in BLOCK:
                flush()
                todo.append(None)
                todo.extend(reversed(p.parts))
            else:
                todo.extend(reversed(p.parts))
        elif p.tag in BLOCK:
            flush()
        else:
            run.append(" ")
    flush()
    return "\n".join(blocks)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), "^(?s).*?://([^/?#]*)", 1))


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def subtree_hashes(pages: DataFrame) -> DataFrame:
    """(host, page, marked, h): each distinct hash of a block subtree inside a page's article part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found, marked = [], []
                for page in part.column(2):
                    root = parse(page.as_py())
                    hash_blocks(root)
                    read = article(root)
                    found.append([_signed(h) for h in sorted(_candidates(read))])
                    marked.append(read is not root)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(marked, pa.bool_()), pa.array(found, pa.list_(pa.int64()))],
                    ["host", "page", "marked", "hs"],
                )

    rows = pages.select("__host", "__page", "__html").mapInArrow(run, "host string, page long, marked boolean, hs array<long>")
    return rows.select("host", "page", "marked", F.explode("hs").alias("h"))


def _candidates(node: Node) -> set[int]:
    """Hashes of the block subtrees below ``node`` that rules by tag and role have left."""
    out, todo = set(), [p for p in node.parts if isinstance(p, Node)]
    while todo:
        n = todo.pop()
        if n.boiler or n.hidden or not n.hash:
            continue
        if n.tag in BLOCK:
            out.add(n.hash)
        todo.extend(p for p in n.parts if isinstance(p, Node))
    return out


def extract(
    pages: DataFrame, url_col: str = "url", html_col: str = "html", min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE
) -> DataFrame:
    """``pages`` with ``text`` and ``n_chars``.

    A block subtree is template when at least ``min_pages`` distinct pages, and at
    least ``min_share`` of the pages of its host, have it (``MARKED_PAGES`` and
    ``MARKED_SHARE`` inside a marked article).  Pages with the same
    html on one host count once: a copied page is no template of its site.  Null
    html is empty and gives empty text; a null url is the empty host.  Columns
    named ``text`` or ``n_chars`` are replaced, others stay.
    """
    work = pages.withColumns(
        {
            "__host": host_of(F.col(url_col)),
            "__html": F.coalesce(F.col(html_col).cast("string"), F.lit("")),
            "__page": F.xxhash64(F.coalesce(F.col(html_col).cast("string"), F.lit(""))),
        }
    )
    pairs = settle(subtree_hashes(work).distinct())
    per_host = work.groupBy("__host", "__page").agg(F.lit(1).alias("x")).groupBy(F.col("__host").alias("host")).agg(F.count(F.lit(1)).alias("pages"))
    counts = pairs.groupBy("host", "h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_pages)
    recurring = counts.join(per_host, "host").where(F.col("n") >= min_share * F.col("pages"))
    everywhere = (F.col("n") >= MARKED_PAGES) & (F.col("n") >= MARKED_SHARE * F.col("pages"))
    recurring = settle(recurring.select("host", "h", "n", everywhere.alias("everywhere")))
    bar = F.greatest(recurring.agg(F.sum("n").alias("n")).scalar() * F.lit(HOT_SHARE), F.lit(10_000.0))
    hot = recurring.where(F.col("n") > bar).select("host", "h", "everywhere")
    usual = recurring.where(F.col("n") <= bar).select("host", "h", "everywhere")
    gone = pairs.join(F.broadcast(hot), ["host", "h"]).unionByName(pairs.join(usual, ["host", "h"]))
    gone = gone.where(~F.col("marked") | F.col("everywhere"))
    lists = gone.groupBy(F.col("host").alias("__h2"), F.col("page").alias("__p2")).agg(F.collect_set("h").alias("__gone"))
    joined = work.join(lists, (F.col("__host") == F.col("__h2")) & (F.col("__page") == F.col("__p2")), "left")

    def run(pages_: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for htmls, gones in pages_:
            out = []
            for page, gone_here in zip(htmls, gones, strict=True):
                root = parse(page.as_py())
                drop: set[int] = set()
                if gone_here.is_valid:
                    hash_blocks(root)
                    drop = {h & 0xFFFFFFFFFFFFFFFF for h in gone_here.as_py()}
                out.append(render(article(root), drop))
            yield pa.array(out, pa.string())

    text = F.arrow_udf(run, "string")(F.col("__html"), F.col("__gone"))
    names = [c for c in pages.columns if c.lower() not in ("text", "n_chars")]
    out = joined.select(*names, text.alias("text"))
    return out.withColumn("n_chars", F.char_length("text").cast("long"))


@query("op7_html_text")
def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages).select("page_id", "url", "text", "n_chars")
