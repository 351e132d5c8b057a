"""Main text of web pages by wrapper induction: the trees of a host's pages are aligned with one of them.

Elements whose text is the same on distinct aligned pages belong to the template, text that varies to the content.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeferry.llm.common import landed
from lakeferry.llm.dom import INLINE, RAW, Tree, align, parse, text_of

#: An element is template if this share of the pages that have it agree on its text.
CONSTANT_SHARE = 0.8
#: Distinct pages besides the model page that must have an element before it can be template.
LEAST_PAGES = 2
#: Model pages are sent to all tasks up to this size together; beyond it they are joined by host.
BROADCAST_BYTES = 8 << 20
#: The hosts with the ids of their model pages are sent to all tasks up to this number; beyond it they are joined.
BROADCAST_HOSTS = 50_000

#: On a page without marks, an element beside which less than this share of the text is left is no aside by its name.
NAMED_SHARE = 0.1

# Elements, and whole words of class, id and role, that never are main text.
ASIDE_TAGS = RAW | frozenset("nav aside footer form noscript template button select datalist dialog svg canvas object head".split())
ASIDE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar aside footer cookie cookies consent gdpr notice notices alert popup modal overlay "
    "newsletter subscribe signup share sharing social related recommended comment comments disqus respond replies "
    "pagination pager toolbar login search skip contentinfo complementary banner".split()
)
PAGE_HEADS = frozenset(("header", "hgroup"))
#: Elements that no name makes an aside, and names of the main text.
FRAMES = frozenset(("#root", "html", "body", "main"))
MAIN_NAMES = frozenset(("main", "main-content", "main_content", "maincontent"))


def host(url):
    """Host of a url in lower case; urls without one have none and share the empty host."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


@lru_cache(maxsize=128)
def _model(html: str) -> Tree:
    return parse(html)


@lru_cache(maxsize=128)
def _model_roots(html: str) -> list[int]:
    return _marks(_model(html))[0]


def content_hash(page: Tree) -> bytes:
    """Equal for pages with the same text: copies, whatever their attributes."""
    return hashlib.blake2b(text_of(page, [0], lambda n: False).encode("utf-8", "replace"), digest_size=16).digest()


@lru_cache(maxsize=128)
def _model_hash(html: str) -> bytes:
    return content_hash(_model(html))


def _marks(tree: Tree) -> tuple[list[int], frozenset[int], frozenset[int]]:
    """The outermost elements that say they are the main text, the asides, and those asides that are so by name alone.

    Articles outside of all asides come first, then main, then articles in elements with the name of an aside. What
    holds main, or holds the articles where there are no others, is a wrapper whatever its classes say. An article in
    another one (a comment) may be an aside, an outermost one is none.
    """
    count = len(tree.tags)
    hard, soft, inside, nested = [False] * count, [False] * count, [False] * count, [False] * count
    articles, mains = [], []
    for n, tag in enumerate(tree.tags):
        up = tree.parents[n]
        nested[n] = up >= 0 and (nested[up] or tree.tags[up] == "article")
        hard[n] = tag in ASIDE_TAGS and tag != "form" or up >= 0 and hard[up]
        soft[n] = tag == "form" or tag not in FRAMES and bool(tree.names[n] & ASIDE_NAMES) and (tag != "article" or nested[n])
        inside[n] = soft[n] or up >= 0 and inside[up]
        if hard[n]:
            continue
        if tag == "article" and not nested[n]:
            articles.append(n)
        elif tag == "main" or tree.names[n] & MAIN_NAMES and tag not in FRAMES and not soft[n]:
            mains.append(n)
    free = [n for n in articles if not inside[n]]
    wrappers = set()
    for n in [*mains, *([] if free else articles)]:
        while n >= 0 and n not in wrappers:
            wrappers.add(n)
            n = tree.parents[n]
    roots = free or _outermost(tree, mains) or articles
    named = frozenset(n for n in range(count) if soft[n] and n not in wrappers and not hard[n])
    return roots, named | {n for n, tag in enumerate(tree.tags) if tag in ASIDE_TAGS and n not in wrappers}, named


def _outermost(tree: Tree, found: list[int]) -> list[int]:
    own, below, kept = set(found), set(), []
    for n, up in enumerate(tree.parents):
        if up in own or up in below:
            below.add(n)
        elif n in own:
            kept.append(n)
    return kept


def votes(model: Tree, page: Tree) -> dict[int, bool]:
    """For each element of the model page that another page has: whether its own text is the same there."""
    found = {}
    for x, y in align(model, page):
        mine, theirs = model.own_text(x), page.own_text(y)
        if mine or theirs:
            found[x] = mine == theirs
    return found


def content_slot(page: Tree, template: set[int], asides: frozenset[int]) -> int:
    """The smallest element of a page without marks that holds all its varying text, which no template element or
    aside has."""
    weights = [0 if n in template else len(page.own_text(n)) for n in range(len(page.tags))]
    for n in range(len(weights) - 1, 0, -1):
        if n in asides or page.tags[n] in PAGE_HEADS:
            weights[n] = 0
        weights[page.parents[n]] += weights[n]
    node = 0
    while weights[node]:
        whole = [c for c in page.children[node] if weights[c] == weights[node]]
        if not whole or page.tags[whole[0]] in ("p", "li", "td", "pre") or page.tags[whole[0]] in INLINE:
            break
        node = whole[0]
    return node


def main_text(html: str, model_html: str | None, constant: frozenset[int]) -> str:
    """Main text of a page; ``constant`` are the template elements of the host's model page.

    A page without marks is aligned with the model page, and its content is all text that is not template there. A
    marked page is read where the model has its marked article; a page that has another one is read by its own marks.
    Inside a marked article nothing is template, since the pages of a small host may well be copies. Menus, adverts,
    forms, comments and the like are left out by element or by whole words of class, id and role; a name that would
    leave nothing, or next to nothing of an unmarked page, does not count.
    """
    page = parse(html)
    named, asides, by_name = _marks(page)
    marked = bool(named)
    template: set[int] = set()
    roots: list[int] = []
    if model_html:
        pairs = dict(align(_model(model_html), page))
        template = {pairs[n] for n in constant if n in pairs}
        roots = sorted(pairs[n] for n in _model_roots(model_html) if n in pairs)
    if not marked:
        roots = roots or [content_slot(page, template, asides)]
    elif not set(named) <= set(roots):
        roots = named

    def read(roots: list[int], asides: frozenset[int]) -> str:
        def dropped(n: int) -> bool:
            if n in asides or not marked and page.tags[n] in PAGE_HEADS:
                return True
            return not marked and n in template and not page.children[n]

        return text_of(page, roots, dropped)

    text = read(roots, asides)
    while by_name and (not text or not marked):
        # the largest outermost one is a wrapper if the page has next to nothing beside it
        sizes = {n: len(read([n], asides - {n})) or len(read([n], asides - by_name)) for n in _outermost(page, by_name)}
        largest = max(sizes, key=lambda n: sizes[n])
        if not sizes[largest] or len(text) > NAMED_SHARE * (len(text) + sizes[largest]):
            break
        asides, by_name = asides - {largest}, by_name - {largest}
        text = read(roots, asides)
    return text


def _models(pages: DataFrame) -> DataFrame:
    """One page of each host, of the host's most usual length: (host, model_id).

    Pages are counted by the power of two of their length before they meet, so a large host is a few rows.
    """
    rows = pages.where("html is not null").select(
        host(F.col("url")).alias("host"), "page_id", F.floor(F.log2(F.octet_length("html") + 1)).alias("length")
    )
    lengths = rows.groupBy("host", "length").agg(F.count("*").alias("pages"), F.min("page_id").alias("page_id"))
    usual = F.max(F.struct("pages", "length", "page_id"))
    return lengths.groupBy("host").agg(usual["page_id"].alias("model_id"))


def wrappers(pages: DataFrame) -> tuple[DataFrame, bool]:
    """(host, model_html, constant) of every host, written to the shared folder, and whether they may be broadcast.

    All pages of a host are aligned with its model page. Copies have one vote together and those of the model page none:
    a page leaves its task as two bits for each element of the model page, copies are folded, then votes are summed.
    """
    pages = pages.select("page_id", "url", "html")
    chosen = landed(_models(pages), "chosen")
    chosen = F.broadcast(chosen) if chosen.count() <= BROADCAST_HOSTS else chosen
    texts = pages.join(chosen, (pages["page_id"] == chosen["model_id"]) & (host(pages["url"]) == chosen["host"]))
    models = landed(texts.groupBy("host").agg(F.min("html").alias("model_html")), "models")
    small = (models.agg(F.sum(F.octet_length("model_html"))).first()[0] or 0) <= BROADCAST_BYTES

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own: dict[tuple[str, bytes], bytes] = {}
            columns = (batch.column(c).to_pylist() for c in ("host", "model_html", "html"))
            for name, model_html, html in zip(*columns, strict=True):
                if html is None or model_html is None:
                    continue
                page = parse(html)
                key = (name, content_hash(page))
                if key[1] == _model_hash(model_html):
                    continue
                bits = bytearray(len(_model(model_html).tags))
                for node, same in votes(_model(model_html), page).items():
                    bits[node] = 1 + same
                packed = zlib.compress(bytes(bits), 1)
                own[key] = min(own.get(key, packed), packed)
            yield pa.RecordBatch.from_pydict(
                {
                    "host": pa.array([k[0] for k in own], pa.string()),
                    "copy": pa.array([k[1] for k in own], pa.binary()),
                    "bits": pa.array([*own.values()], pa.binary()),
                }
            )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums: dict[tuple[str, int], list[int]] = defaultdict(lambda: [0, 0])
            for name, bits in zip(batch.column("host").to_pylist(), batch.column("bits").to_pylist(), strict=True):
                for node, bit in enumerate(zlib.decompress(bits)):
                    if bit:
                        own = sums[name, node]
                        own[0] += 1
                        own[1] += bit - 1
            keys = [*sums]
            yield pa.RecordBatch.from_pydict(
                {
                    "host": pa.array([k[0] for k in keys], pa.string()),
                    "node": pa.array([k[1] for k in keys], pa.int32()),
                    "seen": pa.array([sums[k][0] for k in keys], pa.int64()),
                    "same": pa.array([sums[k][1] for k in keys], pa.int64()),
                }
            )

    rows = pages.select(host(F.col("url")).alias("host"), "html").join(F.broadcast(models) if small else models, "host")
    voted = rows.select("host", "model_html", "html").mapInArrow(vote, "host string, copy binary, bits binary")
    voted = voted.groupBy("host", "copy").agg(F.min("bits").alias("bits")).select("host", "bits")
    counts = voted.mapInArrow(count, "host string, node int, seen bigint, same bigint")
    counts = counts.groupBy("host", "node").agg(F.sum("seen").alias("seen"), F.sum("same").alias("same"))
    constant = counts.where((F.col("seen") >= LEAST_PAGES) & (F.col("same") >= CONSTANT_SHARE * F.col("seen")))
    constant = constant.groupBy("host").agg(F.collect_list("node").alias("constant"))
    return landed(models.join(constant, "host", "left"), "wrappers"), small


@F.arrow_udf(T.StringType())
def _extracted(columns: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for htmls, models, constants in columns:
        rows = zip(htmls.to_pylist(), models.to_pylist(), constants.to_pylist(), strict=True)
        yield pa.array([main_text(h or "", m, frozenset(c or ())) for h, m, c in rows], pa.string())


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page.

    Null and empty pages have the empty text; pages without a host share one wrapper; repeated rows count each. Other
    columns are not read. Broken pages are read as far as they go. No pages give no rows.
    """
    known, small = wrappers(pages)
    known = known.select(F.col("host").alias("known_host"), "model_html", "constant")
    rows = pages.select("page_id", "url", "html")
    rows = rows.join(F.broadcast(known) if small else known, host(rows["url"]) == known["known_host"], "left")
    found = rows.select("page_id", "url", _extracted("html", "model_html", "constant").alias("text"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))
