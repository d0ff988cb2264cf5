"""Main text of web pages: parts of the site's template are found by counting and cut away.

Elements are hashed with all that they contain. Spark counts beside how many different texts of a host each
hash occurs (partial counts per task, so one large host stays spread); hashes with many are template. The text
beside an element is what is left of the page without it, or of the article for an element in an article, so copies
of a page or of an article are one text, and their own body is no template however many there are.

- Outside articles, elements that their name or a word of their class, id or role marks as menu, footer, advert
  and so on are dropped without asking, and every other element is dropped where its hash is template.
- Inside an article or main, elements are dropped without asking by their name or a few whole class names only.
  Boxes (div, section, list and so on) and elements with a marking word are dropped where their hash is template;
  single unmarked paragraphs, headings and inline elements there are text of the article, also where they recur.
- What is left stays, inside articles and beside them.

Defined results: null or empty html gives an empty text; unclosed, crossed and cut-off tags are read as browsers
do in the main (a paragraph ends where a block begins, end tags close what is open inside); a page without a
host belongs to the host ''; equal pages (same id, url and html) share one decision and each keep their row.
"""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from erpspark.llm.scratch import aside, stored
from erpspark.llm.words import text_bytes

#: A subtree is template when it occurs beside so many different texts of its host.
MIN_PAGES = 8

# Element names, fixed values of the HTML standard.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
DROPPED = frozenset(
    "head title script style noscript template iframe object svg math canvas audio video nav footer aside form button select textarea input menu dialog noembed noframes".split()
)
MAIN = frozenset(["article", "main"])
#: An opening tag of these ends an open element of the same group.
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Inside an article these hold its text; other elements there are boxes.
_TEXT = INLINE | frozenset("p h1 h2 h3 h4 h5 h6 hgroup li dt dd tr td th thead tbody tfoot caption col colgroup pre blockquote figcaption address article main".split())
_STOPS = frozenset("ul ol dl table select body article main div section td th".split())

#: Words of a class, id or role that mark a part which is not main text.
MARKS = frozenset(
    """ad ads advert advertisement adverts adsense advertising sponsor sponsored promo promotion banner sidebar sidenav menu nav navbar navigation breadcrumb
    breadcrumbs footer masthead comment comments commentlist disqus respond reply cookie cookies consent gdpr notice notices notification popup modal newsletter
    subscribe signup login share sharing social related recommended pagination pager toolbar widget complementary contentinfo search dialog alert""".split()
)
#: Whole names that mark a box also inside an article.
SURE_MARKS = frozenset(
    """ad ads advert advertisement adverts adsense adsbygoogle banner breadcrumb breadcrumbs comment comments comment-body comment-list commentlist comments-area
    disqus disqus_thread complementary contentinfo cookie-notice masthead menu nav navbar navigation newsletter pager pagination popup sidebar sidenav""".split()
)
_HEADERS = frozenset(["header"])

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S)
_NAMES = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)


def _marked(attributes: str, cut: str = r"[^a-z0-9]+", marks: frozenset[str] = MARKS) -> bool:
    if not attributes or "=" not in attributes:
        return False
    words = (w for m in _NAMES.finditer(attributes) for w in re.split(cut, (m[2] or m[3] or m[4] or "").lower()))
    return not marks.isdisjoint(words)


class _Open:
    """An open element: its name, what it is, and what it has contained so far."""

    __slots__ = ("name", "dropped", "article", "number", "parts")

    def __init__(self, name: str, dropped: bool, article: int, number: int):
        self.name, self.dropped, self.article, self.number, self.parts = name, dropped, article, number, [name]


def parse(text: str) -> tuple[list[tuple[str, int, tuple[int, ...]]], list[int], list[bool], list[int]]:
    """Blocks (text, the outermost article around it or -1, numbers of the elements around it), and per number the hash, whether it is undecided, and its article.

    Numbered are the elements outside articles, and inside those that counting decides on; undecided are those that no name marks.
    """
    blocks: list[tuple[str, int, tuple[int, ...]]] = []
    hashes: list[int] = []
    undecided: list[bool] = []
    articles: list[int] = []
    n_articles = 0
    stack = [_Open("#page", False, -1, -1)]
    run: list[str] = []

    def flush() -> None:
        words = " ".join("".join(run).split())
        run.clear()
        if words and not stack[-1].dropped:
            blocks.append((words, stack[-1].article, tuple(e.number for e in stack if e.number >= 0)))

    def close() -> None:
        element = stack.pop()
        h = xxhash.xxh3_64_intdigest("\x00".join(element.parts))
        if element.number >= 0:
            hashes[element.number] = h
        stack[-1].parts.append(f"\x01{h}")

    def add(raw: str) -> None:
        said = html_lib.unescape(raw)
        run.append(said)
        stack[-1].parts.append(" ".join(said.split()))

    at, size = 0, len(text)
    while at < size:
        match = _TOKEN.search(text, at)
        if match is None:
            add(text[at:])
            break
        if match.start() > at:
            add(text[at : match.start()])
        at = match.end()
        if match[2] is None:
            continue
        name = match[2].lower()
        if name not in INLINE:
            if name == "br":
                run.append(" ")
                continue
            flush()
        if match[1]:
            if any(e.name == name for e in stack[1:]):
                while stack[-1].name != name:
                    close()
                close()
            continue
        if name in VOID:
            continue
        if name not in INLINE:
            for i in range(len(stack) - 1, 0, -1):  # a block ends an open paragraph
                if stack[i].name == "p":
                    while len(stack) > i:
                        close()
                    break
                if stack[i].name in _STOPS:
                    break
        for i in range(len(stack) - 1, 0, -1) if name in _ENDS else ():
            if stack[i].name in _ENDS[name]:
                while len(stack) > i:
                    close()
                break
            if stack[i].name in _STOPS:
                break
        above = stack[-1]
        article = above.article
        word = name not in ("html", "body") and _marked(match[3])
        if article >= 0:
            marked = name in DROPPED or (word and (name not in _TEXT or name in MAIN) and _marked(match[3], r"\s+", SURE_MARKS))
            numbered = word or name not in _TEXT
        else:
            marked = name in DROPPED or (name not in MAIN and (word or name in _HEADERS))
            numbered = name not in MAIN
        dropped = above.dropped or marked
        if name in MAIN and article < 0 and not dropped:
            article, n_articles = n_articles, n_articles + 1
        number = -1
        if numbered and name not in ("html", "body", "head"):
            number = len(hashes)
            hashes.append(0)
            undecided.append(not dropped)
            articles.append(article)
        stack.append(_Open(name, dropped, article, number))
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])", re.I).search(text, at)
            stop = end.start() if end else size
            stack[-1].parts.append(text[at:stop])
            at = stop
            if not end:
                break
    flush()
    while len(stack) > 1:
        close()
    return blocks, hashes, undecided, articles


def main_text(text: str, template: frozenset[int] | set[int] = frozenset()) -> str:
    """The blocks that stay, joined by a line break."""
    blocks, hashes, undecided, _ = parse(text)
    gone = {i for i, h in enumerate(hashes) if undecided[i] and h in template}
    return "\n".join(words for words, _, around in blocks if gone.isdisjoint(around))


def host(url: Column) -> Column:
    """Lower-case host of a URL, '' where there is none."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(found)


_SUBTREES = pa.schema([("page", pa.int64()), ("host", pa.string()), ("hash", pa.int64()), ("beside", pa.int64()), ("asked", pa.bool_())])


def subtrees(text: str) -> dict[int, tuple[int, bool]]:
    """Per subtree hash of a page the hash of the text beside it, and whether any of its elements is undecided."""
    blocks, hashes, undecided, articles = parse(text)
    inner, whole = [0] * len(hashes), {-1: 0}
    for words, article, around in blocks:
        h = xxhash.xxh3_64_intdigest(words)
        for n in around:
            inner[n] += h
        for scope in {-1, article}:
            whole[scope] = whole.get(scope, 0) + h
    held: dict[int, dict[int, int]] = {}  # hash -> article -> what its elements there hold
    asked: dict[int, bool] = {}
    for h, own, article, open_question in zip(hashes, inner, articles, undecided, strict=True):
        scopes = held.setdefault(h, {})
        scopes[article] = scopes.get(article, 0) + own
        asked[h] = asked.get(h, False) or open_question
    return {h: (sum(whole.get(a, 0) - own for a, own in scopes.items()) & 0xFFFFFFFFFFFFFFFF, asked[h]) for h, scopes in held.items()}


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pages, hosts, found, beside, asked = [], [], [], [], []
        for page, site, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), text_bytes(batch.column(2)), strict=True):
            by_hash = subtrees(raw.decode("utf-8", "replace"))
            pages += [page] * len(by_hash)
            hosts += [site] * len(by_hash)
            found += by_hash
            beside += (b for b, _ in by_hash.values())
            asked += (a for _, a in by_hash.values())
        hashes = (pa.array(np.array(h, np.uint64).view(np.int64)) for h in (found, beside))
        yield pa.record_batch([pa.array(pages, pa.int64()), pa.array(hosts, pa.string()), *hashes, pa.array(asked, pa.bool_())], schema=_SUBTREES)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for raw, cut in zip(text_bytes(batch.column("__text")), batch.column("__cut"), strict=True):
            template = {h & 0xFFFFFFFFFFFFFFFF for h in cut.as_py()} if cut.is_valid else frozenset()
            texts.append(main_text(raw.decode("utf-8", "replace"), template))
        keep = [n for n in batch.schema.names if n not in ("__text", "__cut")]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in keep), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*keep, "__text", "__n_chars"])


def template_parts(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """`page` (hash of the row) and `cut`: the template hashes among its undecided elements, for pages that have any. `pages` has page, host, html."""
    each = stored(pages.select("page", "host", "html").mapInArrow(_subtrees, "page long, host string, hash long, beside long, asked boolean"), "subtrees")
    # copies are one text: they go before anything is counted
    texts = each.groupBy("host", "hash", "beside").agg(F.bool_or("asked").alias("asked"))
    counts = texts.groupBy("host", "hash").agg(F.count(F.lit(1)).alias("n"), F.bool_or("asked").alias("asked"))
    template = stored(counts.where((F.col("n") >= min_pages) & F.col("asked")).select("host", "hash"), "template")
    hits = each.where("asked").join(template, ["host", "hash"])
    return stored(hits.groupBy("page").agg(F.collect_set("hash").alias("cut")), "template-hits")


def extract(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """The input's columns but `html`, and `__text` and `__n_chars` (input columns of these names give way)."""
    outputs = ["__text", "__n_chars"]
    page = F.xxhash64(*(F.col(c).cast("string") for c in ("page_id", "url", "html")))
    narrow = pages.select(page.alias("page"), host(F.col("url").cast("string")).alias("host"), F.col("html").cast("string").alias("html"))
    cut = template_parts(narrow, min_pages).select(F.col("page").alias("__page"), F.col("cut").alias("__cut"))
    named, inner = aside(pages, "html", outputs)
    row = F.xxhash64(*(named[c].cast("string") for c in (inner["page_id"], inner["url"], "__text")))
    joined = named.join(cut, row == cut["__page"], "left").drop("__page")
    schema = ", ".join([*(f"{n} {named.schema[n].dataType.simpleString()}" for n in inner.values()), "__text string, __n_chars long"])
    return joined.mapInArrow(_extract, schema).toDF(*inner, *outputs)
