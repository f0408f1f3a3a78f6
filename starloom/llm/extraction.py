"""Main text of web pages: flat text blocks judged by a decision tree.

A page is cut into blocks at block-level tags. Each block has its word count, its link density
(share of its words inside links), both of the blocks before and after it, whether it is a
heading, and the region it lies in: 1 in an article, -1 in a part that tags or names call a menu,
header, footer, sidebar, notice, advert, form or comments, 0 if nothing says so; the innermost
such element decides. A tree fitted on the small labelled table below keeps or drops each block.

A name marks a part only as a whole: every word of one class, id, role or itemprop must be a
boilerplate name or an addition to one ("cookie-notice", "site-footer", but not "ad-free" or
"copyright-law"). Names of headings mark nothing, nor do ids of sections within an article;
paragraphs, items and cells within an article go by the names of adverts and comments only,
elements within a line by those of adverts only.
"""

from __future__ import annotations

import functools
import html
import re
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import in_tasks, pieces_of

# Elements and names that say what a part of a page is.
RAW = "script style textarea title iframe noscript template svg object select button canvas audio video"
BOILER_TAGS = frozenset("nav footer aside form header menu dialog".split())
CONTENT_TAGS = frozenset("article main".split())
BLOCK_TAGS = frozenset((
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "section summary table tbody td tfoot th thead tr ul").split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BOILER_NAMES = frozenset((
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar "
    "navigation menu menubar submenu breadcrumb breadcrumbs header masthead topbar toolbar footer sidebar aside widget "
    "related recommended recommendations teaser comment comments commentlist remarks disqus reply replies respond discussion feedback guestbook "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe signup "
    "login search searchform share sharing social pagination pager copyright legal disclaimer skip hidden form "
    "complementary contentinfo").split())
ADVERTS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored".split())
REMARKS = frozenset("comment comments commentlist reply replies respond disqus".split())
TEASERS = frozenset("teaser related recommended promo".split())
ADDITIONS = frozenset((
    "site page global top bottom left right main primary secondary user users reader readers visitor visitors "
    "container wrapper wrap box bar block inner outer area section list links buttons button items item slot unit "
    "panel row column thread title bottombar policy message").split())
CARDS = ADDITIONS | frozenset("post posts card cards".split())
TEXT_TAGS = frozenset("p li dd dt td th tr tbody blockquote pre figure figcaption address".split())
CONTENT_NAMES = frozenset("article articlebody articletext posttext maincontent main".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*+(?:>|\Z))", re.S)
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for t in RAW.split()}
_NAMES = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?=[\s=/>]|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_PARTS = re.compile(r"[a-z]+|[A-Z][a-z]*")


class Block(NamedTuple):
    text: str
    region: int
    heading: int
    words: int
    links: float


# Labelled blocks: region, heading, words, link density, words and link density of the block
# before, the same of the block after; then 1 for main text.
LABELLED = (
    (1, 0, 120, 0.0, 80, 0.0, 90, 0.0, 1), (1, 0, 1, 0.0, 60, 0.0, 45, 0.0, 1), (1, 0, 1, 0.0, 0, 0.0, 0, 0.0, 1),
    (1, 1, 8, 0.0, 6, 1.0, 70, 0.0, 1), (1, 1, 1, 0.0, 9, 0.0, 2, 0.0, 1), (1, 0, 35, 0.4, 60, 0.0, 50, 0.1, 1),
    (1, 0, 6, 1.0, 60, 0.0, 50, 0.0, 1), (1, 0, 3, 0.0, 2, 1.0, 12, 0.0, 1), (1, 0, 2, 0.0, 1, 0.0, 8, 0.1, 1),
    (1, 0, 14, 0.9, 40, 0.0, 35, 0.0, 1), (1, 0, 400, 0.0, 1, 0.0, 9, 0.2, 1), (1, 0, 5, 0.0, 0, 0.0, 7, 0.0, 1),
    (1, 0, 2, 1.0, 3, 1.0, 30, 0.0, 1), (1, 1, 4, 1.0, 0, 0.0, 80, 0.0, 1), (1, 0, 20, 0.1, 9, 0.0, 6, 0.0, 1),
    (-1, 0, 1, 1.0, 1, 1.0, 1, 1.0, 0), (-1, 0, 9, 0.0, 1, 1.0, 12, 0.0, 0), (-1, 0, 60, 0.0, 50, 0.0, 40, 0.0, 0),
    (-1, 1, 3, 0.0, 70, 0.0, 40, 0.0, 0), (-1, 0, 200, 0.0, 120, 0.0, 90, 0.0, 0), (-1, 0, 12, 0.0, 60, 0.0, 0, 0.0, 0),
    (-1, 0, 25, 0.3, 5, 1.0, 5, 1.0, 0), (-1, 0, 5, 0.0, 5, 0.0, 5, 0.0, 0), (-1, 0, 2, 0.0, 90, 0.0, 100, 0.0, 0),
    (-1, 1, 6, 0.0, 4, 1.0, 90, 0.0, 0), (-1, 0, 35, 0.0, 4, 0.0, 120, 0.0, 0), (-1, 0, 14, 0.1, 400, 0.0, 0, 0.0, 0),
    (0, 0, 80, 0.0, 60, 0.0, 70, 0.0, 1), (0, 0, 45, 0.1, 8, 0.0, 50, 0.0, 1), (0, 0, 30, 0.0, 3, 1.0, 40, 0.0, 1),
    (0, 0, 22, 0.2, 40, 0.0, 35, 0.0, 1), (0, 0, 25, 0.0, 45, 0.0, 4, 1.0, 1), (0, 0, 16, 0.0, 28, 0.1, 0, 0.0, 1),
    (0, 0, 4, 0.0, 50, 0.0, 45, 0.0, 1), (0, 0, 2, 0.0, 40, 0.0, 30, 0.0, 1), (0, 0, 7, 0.1, 35, 0.0, 28, 0.0, 1),
    (0, 1, 6, 0.0, 2, 1.0, 60, 0.0, 1), (0, 1, 9, 0.0, 0, 0.0, 45, 0.0, 1), (0, 1, 3, 0.0, 50, 0.0, 60, 0.0, 1),
    (0, 0, 18, 0.0, 2, 0.0, 22, 0.0, 1), (0, 0, 12, 0.0, 4, 0.0, 60, 0.0, 1), (0, 0, 150, 0.0, 0, 0.0, 0, 0.0, 1),
    (0, 0, 1, 1.0, 1, 1.0, 1, 1.0, 0), (0, 0, 3, 1.0, 2, 1.0, 4, 1.0, 0), (0, 0, 2, 1.0, 0, 0.0, 2, 1.0, 0),
    (0, 0, 12, 0.8, 10, 0.9, 9, 1.0, 0), (0, 0, 30, 0.7, 3, 1.0, 4, 1.0, 0), (0, 0, 50, 0.9, 4, 1.0, 20, 0.8, 0),
    (0, 0, 5, 0.0, 3, 1.0, 2, 1.0, 0), (0, 0, 4, 0.0, 2, 0.0, 3, 0.0, 0), (0, 0, 8, 0.4, 4, 1.0, 0, 0.0, 0),
    (0, 0, 6, 0.2, 5, 0.0, 0, 0.0, 0), (0, 0, 3, 0.0, 0, 0.0, 3, 1.0, 0), (0, 0, 7, 0.5, 30, 0.9, 8, 0.8, 0),
    (0, 1, 2, 0.0, 4, 1.0, 3, 1.0, 0), (0, 1, 3, 1.0, 3, 1.0, 3, 1.0, 0), (0, 0, 9, 1.0, 70, 0.0, 8, 1.0, 0),
    (-1, 0, 18, 0.0, 2, 0.7, 2, 0.0, 0), (-1, 0, 40, 0.0, 3, 0.0, 3, 0.0, 0), (-1, 0, 90, 0.0, 30, 0.0, 5, 0.0, 0),
    (-1, 0, 22, 0.1, 1, 0.0, 9, 0.0, 0), (-1, 0, 16, 0.0, 0, 0.0, 0, 0.0, 0), (-1, 0, 70, 0.1, 9, 0.0, 60, 0.0, 0),
    (-1, 0, 30, 0.0, 60, 0.0, 8, 0.0, 0), (-1, 1, 12, 0.0, 25, 0.0, 30, 0.0, 0), (-1, 0, 300, 0.0, 2, 0.0, 1, 1.0, 0),
    (-1, 0, 8, 0.0, 150, 0.0, 150, 0.0, 0), (-1, 0, 3, 0.0, 22, 0.0, 26, 0.0, 0), (-1, 0, 55, 0.0, 0, 0.0, 11, 0.2, 0),
    (0, 0, 3, 0.7, 0, 0.0, 40, 0.0, 0), (0, 0, 2, 1.0, 0, 0.0, 60, 0.0, 0), (0, 0, 5, 0.8, 2, 1.0, 30, 0.0, 0),
    (0, 0, 4, 0.6, 50, 0.0, 2, 0.0, 0), (0, 0, 2, 1.0, 40, 0.0, 45, 0.0, 0), (0, 0, 6, 0.7, 25, 0.0, 90, 0.0, 0),
    (0, 0, 1, 0.0, 24, 0.0, 20, 0.0, 1), (0, 0, 3, 0.0, 26, 0.0, 24, 0.0, 1), (0, 0, 5, 0.0, 90, 0.0, 28, 0.0, 1),
    (0, 0, 24, 0.0, 1, 0.0, 20, 0.0, 1), (0, 0, 20, 0.0, 1, 0.0, 3, 0.8, 1), (0, 0, 28, 0.0, 3, 0.7, 1, 0.0, 1),
    (1, 0, 2, 0.0, 0, 0.0, 0, 0.0, 1), (1, 0, 4, 0.0, 3, 1.0, 0, 0.0, 1), (1, 0, 3, 1.0, 5, 1.0, 6, 1.0, 1),
    (1, 1, 2, 0.0, 4, 1.0, 3, 1.0, 1), (1, 0, 9, 0.0, 3, 0.9, 2, 0.0, 1), (1, 0, 6, 0.5, 0, 0.0, 0, 0.0, 1),
    (1, 0, 12, 0.0, 10, 1.0, 9, 0.9, 1), (1, 0, 3, 0.0, 2, 0.0, 2, 0.0, 1), (1, 0, 1, 1.0, 1, 1.0, 1, 1.0, 1),
    (1, 0, 5, 1.0, 0, 0.0, 0, 0.0, 1), (1, 0, 8, 0.8, 7, 0.8, 2, 1.0, 1), (1, 1, 3, 0.0, 0, 0.0, 0, 0.0, 1),
    (0, 1, 1, 0.0, 0, 0.0, 22, 0.0, 1), (0, 1, 3, 0.0, 0, 0.0, 30, 0.0, 1), (0, 1, 2, 0.0, 3, 0.0, 26, 0.0, 1),
    (0, 0, 8, 0.0, 12, 0.9, 15, 0.8, 0), (0, 0, 6, 0.0, 20, 0.8, 18, 0.9, 0), (0, 0, 4, 0.0, 9, 1.0, 14, 1.0, 0),
    (0, 0, 12, 0.0, 16, 0.9, 22, 0.9, 0), (0, 1, 4, 0.0, 10, 0.9, 14, 0.9, 0), (0, 0, 9, 0.0, 24, 1.0, 30, 0.9, 0),
    (0, 0, 5, 0.0, 30, 0.0, 0, 0.0, 1), (0, 0, 2, 0.0, 45, 0.0, 0, 0.0, 1), (0, 0, 7, 0.0, 60, 0.0, 2, 1.0, 1),
    (0, 0, 8, 0.0, 12, 0.0, 15, 0.0, 1), (0, 0, 6, 0.0, 20, 0.0, 18, 0.9, 1), (0, 0, 9, 0.0, 35, 0.0, 3, 1.0, 1),
    (0, 0, 2, 0.0, 3, 0.8, 0, 0.0, 0), (0, 0, 3, 0.0, 6, 0.2, 0, 0.0, 0), (0, 0, 2, 0.0, 4, 0.7, 2, 0.0, 0),
)
FEATURES = 8


def grow(rows: list[tuple], depth: int = 8):
    """A tree by Gini impurity: a share of main text, or (feature, limit, at most, above)."""
    share = sum(r[-1] for r in rows) / len(rows)
    if depth == 0 or share in (0, 1):
        return share

    def impurity(part):
        p = sum(r[-1] for r in part) / len(part)
        return len(part) * p * (1 - p)

    best = None
    for f in range(FEATURES):
        values = sorted({r[f] for r in rows})
        for a, b in zip(values, values[1:]):
            low = [r for r in rows if r[f] <= a]
            high = [r for r in rows if r[f] > a]
            cost = impurity(low) + impurity(high)
            if best is None or cost < best[0] - 1e-12:
                best = (cost, f, (a + b) / 2, low, high)
    if best is None:
        return share
    return best[1], best[2], grow(best[3], depth - 1), grow(best[4], depth - 1)


@functools.cache
def trained_tree():
    return grow(list(LABELLED))


def is_main(tree, features: tuple) -> bool:
    while isinstance(tree, tuple):
        tree = tree[2] if features[tree[0]] <= tree[1] else tree[3]
    return tree >= 0.5


@functools.lru_cache(1 << 16)
def _parts(name: str) -> frozenset[str]:
    """The words of one name, such as cookie and notice in cookieNotice."""
    words = re.split(r"[^A-Za-z]+", name)
    parts = [p.lower() for w in words for p in ([w] if w.isupper() else _PARTS.findall(w))]
    return frozenset(p for p in parts if len(p) > 1)


def _named(names: list[str], known: frozenset[str], additions: frozenset[str] = ADDITIONS) -> bool:
    """Is one of the names made of known words and additions only?"""
    return any(not known.isdisjoint(p) and p <= known | additions for p in map(_parts, names))


def _region_of(tag: str, attrs: str, in_article: bool) -> int:
    """1, -1, or 0 where the element says nothing."""
    if tag in ("html", "body"):
        return 0
    names: list[str] = []
    if len(attrs) > 4:
        if _HIDDEN.search(attrs):
            return -1
        for kind, value in _NAMES.findall(attrs):
            found = value.strip("\"'>").split()
            if not (in_article and tag == "section" and kind.lower() == "id") or found == ["comments"]:
                names += found
    if tag in CONTENT_TAGS:
        return -1 if _named(names, ADVERTS | REMARKS | TEASERS, CARDS) else 1
    if tag == "header" and in_article:
        return 0
    if tag in BOILER_TAGS:
        return -1
    if not names or tag in HEADINGS:
        return 0
    if tag not in BLOCK_TAGS:
        return -_named(names, ADVERTS)
    if in_article and tag in TEXT_TAGS:
        return -_named(names, ADVERTS | REMARKS)
    if _named(names, BOILER_NAMES):
        return -1
    return int(not in_article and tag in ("div", "section", "td") and not CONTENT_NAMES.isdisjoint(n.lower() for n in names))


def blocks_of(page: str) -> list[Block]:
    """The text blocks of a page in order; broken and cut-off markup is read as far as it goes."""
    out: list[Block] = []
    runs: list[str] = []
    linked = heading = anchors = 0
    stack: list[tuple[str, int]] = []
    regions: list[int] = [0]

    def flush():
        nonlocal linked
        if runs:
            text = " ".join("".join(runs).split())
            if text:
                n = text.count(" ") + 1
                out.append(Block(text, regions[-1], int(heading > 0), n, min(1.0, linked / n)))
            runs.clear()
        linked = 0

    at, size = 0, len(page)
    while at < size:
        m = _TAG.search(page, at)
        stop = m.start() if m else size
        if stop > at:
            run = html.unescape(page[at:stop])
            runs.append(run)
            if anchors:
                linked += len(run.split())
        if not m:
            break
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if m["close"]:
            if tag == "a":
                anchors = 0
                continue
            if tag in BLOCK_TAGS:
                flush()
                if tag in HEADINGS:
                    heading = 0
            if any(t == tag for t, _ in stack):
                flush()
                while stack.pop()[0] != tag:
                    regions.pop()
                regions.pop()
            continue
        attrs = m["attrs"]
        if tag in _RAW_END:
            if not attrs.endswith("/>"):
                end = _RAW_END[tag].search(page, at)
                at = end.end() if end else size
            runs.append(" ")
            continue
        if tag == "br":
            runs.append(" ")
            continue
        if tag == "a":
            anchors = 1
            if len(attrs) < 4 or not _NAMES.search(attrs):
                continue
        block = tag in BLOCK_TAGS
        if block:
            flush()
            anchors = 0
            heading = int(tag in HEADINGS)
            if stack and stack[-1][0] == "p":
                stack.pop()
                regions.pop()
            if tag == "li" and any(t == "li" for t, _ in stack):
                last = max(i for i, (t, _) in enumerate(stack) if t == "li")
                if all(t not in ("ul", "ol", "menu") for t, _ in stack[last:]):
                    del stack[last:], regions[last + 1:]
        if tag in VOID or attrs.endswith("/>"):
            continue
        region = _region_of(tag, attrs, any(t in CONTENT_TAGS for t, _ in stack))
        if block and tag not in HEADINGS or region:
            if region:
                flush()
            stack.append((tag, region))
            regions.append(region or regions[-1])
    flush()
    return out


def main_text(page: str, tree=None) -> str:
    """The kept blocks of a page, one to a line."""
    tree = trained_tree() if tree is None else tree
    blocks = blocks_of(page)
    kept = []
    for i, b in enumerate(blocks):
        before = blocks[i - 1] if i else None
        after = blocks[i + 1] if i + 1 < len(blocks) else None
        features = (b.region, b.heading, b.words, b.links,
                    before.words if before else 0, before.links if before else 0.0,
                    after.words if after else 0, after.links if after else 0.0)
        if is_main(tree, features):
            kept.append(b.text)
    return "\n".join(kept)


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                  html_col: str = "html") -> DataFrame:
    """One row per page: its id and url unchanged, ``text`` and ``n_chars``.

    The whole page is read. A null or empty page, or one without main text, has an empty text.
    Repeated rows give repeated results; no rows give none; other columns are ignored.
    """
    rows = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"),
                        F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")).alias("html"))
    kinds = dict(rows.dtypes)
    tree = trained_tree()
    schema = f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long"

    def work(batches):
        for batch in batches:
            for part in pieces_of(batch, "html", 8 << 20):
                texts = [main_text(h, tree) for h in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return in_tasks(rows, work, schema)
