"""Main text of web pages by template deduction.

Tokens are a page's elements, told apart by their path from the root (tag, class and id of each
step, digits in names aside), and the texts in them: an element's text as a whole is a token at the
element's path.  Over the pages of a host each token has an occurrence vector, its count on every
page; tokens with equal vectors form an equivalence class.  A class of frequent elements is valid;
nested by their paths the classes make the host's template.  Where a text token is in the
class of its element, the element's text is the template's own; the other elements with text are
slots.

The article is the element that holds all slots, the innermost one; where an outermost ``article`` or
``main`` holds most of the text, it is that.  It is extracted whole but for template text in boxes
(``div``, lists, tables and such) and for menus, headers, footers, sidebars, notices, adverts,
forms, scripts, styles and comments, which are known by their tags and names.  A paragraph
that repeats on other pages is no template text: its element has other texts too.

Vectors are compared by a hash that is summed over pages, so nothing of a host is ever
gathered: a host with very many pages is combined before it is shuffled.  A template needs
``MIN_PAGES`` different texts, however many copies there are; hosts with fewer share one that is
deduced over all their pages.

Defined cases: a null or empty page has no text; a page that lacks its host's article
element gives what its own ``article`` or ``main`` holds, or all its text outside named elements; a
null address has an empty host; equal
pages are each returned; an empty table gives no rows.  Only id, address and page are
read, so other columns cannot clash.
"""

from __future__ import annotations

import functools
import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_side, stored

MIN_PAGES = 3            # different texts of a host with a template of its own
MIN_SUPPORT = 60         # per cent of the pages that have a frequent token
SHARED = ""              # the host of the shared template

# What the contract leaves out, by tag and by names of classes and ids.
LEFT_OUT = frozenset("head nav header footer aside form script style noscript template button select textarea "
                     "option input iframe svg canvas object menu dialog".split())
# A name is a whole class or id; words that only place or shape an element may stand beside it.
_PLACED = (r"(?:site|main|page|global|top|bottom|left|right|primary|secondary|widget|wrapper|container|box|bar|block|"
           r"area|section|inner|list|links?|menu|slot|unit|banner)")
LEFT_OUT_NAME = re.compile(
    rf"(?<!\S)(?:{_PLACED}[_-]+)*(?:ads?|adverts?|advertisement|advertising|sponsor(?:ed)?|promo|banner|menu|nav|navbar|"
    r"navigation|breadcrumbs?|header|masthead|footer|sidebar|cookies?|consent|notice|notification|popup|modal|newsletter|"
    rf"subscribe|share|sharing|social|related|comments?|replies|respond|disqus)(?:[_-]+{_PLACED})*(?:[_-]*\d+)?(?!\S)", re.I)
NEVER_BY_NAME = frozenset("html body main article".split())
MAIN = frozenset("article main".split())
BOXES = frozenset("div section ul ol dl table figure details fieldset".split())
PARTS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd tr td th blockquote pre figcaption caption".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp".split())
INLINE = frozenset("a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small "
                   "span strike strong sub sup time tt u var wbr".split())
# An element that a new one of the set ends, if it lies open in the same parent.
ENDS = {"p": None, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
        "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}
_TAG = re.compile(r"""<(?:!--.*?(?:-->|\Z)|[!?][^>]*(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)(?:>|\Z))""",
                  re.S)
_DIGITS = re.compile(r"\d+")
_NAME = re.compile(r"""(?:^|\s)(class|id)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)


def _step(tag: str, attributes: str) -> tuple[str, bool, bool]:
    """How an element appears in a path, and whether it is left out by its tag and by a name."""
    names = " ".join(v.strip("\"'") for _, v in _NAME.findall(attributes)) if "=" in attributes else ""
    return (f"{tag}.{_DIGITS.sub('#', ' '.join(names.split())).replace('/', '|')}" if names else tag,
            tag in LEFT_OUT, bool(names and tag not in NEVER_BY_NAME and LEFT_OUT_NAME.search(names)))


def walk(page: str) -> Iterator[tuple[str, str, bool, bool]]:
    """``(path, text, left_out, new_block)`` for every element that opens (with text "") and
    every piece of text, in page order.  A name leaves out no element that holds more than
    half of the text that tags leave."""
    kept: set[str] = set()
    while True:
        found = list(_walk(page, kept))
        texts = [(len(t), by_name) for _, t, out, by_name, _ in found if not out and not t.isspace()]
        half = sum(n for n, _ in texts) / 2
        named: dict[str, int] = {}
        for n, by_name in texts:
            if by_name:
                named[by_name] = named.get(by_name, 0) + n
        more = {path for path, n in named.items() if n > half}
        if not more:
            return ((path, t, out or bool(by_name), fresh) for path, t, out, by_name, fresh in found)
        kept |= more


def _walk(page: str, kept: set[str]) -> Iterator[tuple[str, str, bool, str, bool]]:
    """``(path, text, left_out_by_tag, named, new_block)``; ``named`` is the path of the
    outermost element that a name leaves out, those in ``kept`` aside."""
    stack: list[tuple[str, str, bool, str]] = [("", "", False, "")]     # tag, path, left out, named
    at, fresh = 0, True

    def close(k: int) -> None:
        del stack[k:]

    while True:
        m = _TAG.search(page, at)
        text = page[at:m.start() if m else len(page)]
        if text and not text.isspace():
            yield stack[-1][1], text, *stack[-1][2:], fresh
            fresh = False
        elif text and not fresh:
            yield stack[-1][1], " ", *stack[-1][2:], fresh
        if not m:
            return
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        block = tag not in INLINE
        if m[1]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    close(k)
                    break
            fresh |= block
            continue
        if block:
            fresh = True
            ended = ENDS.get(tag)
            for k in range(len(stack) - 1, 0, -1):
                open_ = stack[k][0]
                if open_ == "p" or ended and open_ in ended:
                    close(k)
                    if not ended or open_ == tag:
                        break
                elif open_ not in INLINE:
                    break
        name, out, by_name = _step(tag, m[3])
        path, out = f"{stack[-1][1]}/{name}", out or stack[-1][2]
        named = stack[-1][3] or (path if by_name and path not in kept else "")
        yield path, "", out, named, fresh
        if tag == "br" and not fresh:
            yield stack[-1][1], " ", *stack[-1][2:], False
        if tag in VOID:
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\b", re.I).search(page, at)
            at = end.start() if end else len(page)
        stack.append((tag, path, out, named))


def tag_of(path: str) -> str:
    return path.rpartition("/")[2].partition(".")[0]


@functools.lru_cache(1 << 14)
def outermost_main(path: str) -> str:
    """The path down to its first ``article`` or ``main``; empty if it has none."""
    steps = path.split("/")
    return next(("/".join(steps[:k + 1]) for k, s in enumerate(steps) if s.partition(".")[0] in MAIN), "")


def tokens(page: str) -> dict[str, tuple[int, int, int, int]]:
    """For every element path outside left-out ones, and for the page (path ""): its count, the
    length of the text that stands in it directly, of all text in it, and the digest of the latter."""
    counts: dict[str, int] = {"": 1}
    direct: dict[str, int] = {}
    inner: dict[str, list[str]] = {}
    for path, text, out, _ in walk(page):
        if out:
            continue
        if not text:
            counts[path] = counts.get(path, 0) + 1
            continue
        text = " ".join(text.split())
        if not text:
            continue
        direct[path] = direct.get(path, 0) + len(text)
        while True:
            inner.setdefault(path, []).append(text)
            if not path:
                break
            path = path.rpartition("/")[0]
    return {p: (counts.get(p, 1), direct.get(p, 0), sum(map(len, inner.get(p, ()))),
                xxhash.xxh3_64_intdigest("\0".join(inner.get(p, ()))) >> 1) for p in {*counts, *inner}}


def extract(page: str, article: str | None, template: frozenset[str] = frozenset()) -> str:
    """The blocks of the article element, or else of the page's own, or of the whole page;
    without the elements of ``template``."""
    found = False
    chosen: list[tuple[str, str, bool]] = []
    lengths: dict[str, int] = {}
    for path, text, out, fresh in walk(page):
        found |= bool(article) and (path == article or path.startswith(f"{article}/"))
        if text and not out:
            chosen.append((path, text, fresh))
            main = outermost_main(path)
            lengths[main] = lengths.get(main, 0) + len(text)
        elif not text and fresh:
            chosen.append((path, "", True))
    if not found:
        most = max(lengths, key=lengths.get, default="")
        article = most if 2 * lengths.get(most, 0) > sum(lengths.values()) else ""
    blocks: list[list[str]] = []
    start = True
    for path, text, fresh in chosen:
        start |= fresh
        if not text or article and path != article and not path.startswith(f"{article}/"):
            continue
        if template and any(path == t or path.startswith(f"{t}/") for t in template):
            start = True
            continue
        if start or not blocks:
            blocks.append([])
            start = False
        blocks[-1].append(html.unescape(text))
    lines = (" ".join("".join(b).split()) for b in blocks)
    return "\n".join(x for x in lines if x)


def host_of(address: str | None) -> str:
    return re.sub(r"^[a-zA-Z][a-zA-Z0-9+.-]*://", "", address or "").split("/")[0].lower()


def _occurrences(pages: DataFrame) -> DataFrame:
    """``host, path, content, total, mark, direct, text`` for every token of every page:
    elements have no ``content``, texts their digest.  ``mark`` stands for the count on this page
    in the sum that stands for the vector; an element's text occurs as often as the element."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for key, url, page in zip(*(c.to_pylist() for c in batch.columns)):
                host = host_of(url)
                salt = xxhash.xxh3_64_intdigest(f"{key}\0{url}")
                for p, (c, direct, n, digest) in tokens(page or "").items():
                    mark = (salt * (2 * c + 1) >> 24) & 0xFFFFFFFFFF
                    rows += [(host, p, None, c, mark, direct, n), (host, p, digest, c, mark, direct, n)]
            cols = list(zip(*rows)) if rows else [()] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.string(), *[pa.int64()] * 5))],
                ["host", "path", "content", "total", "mark", "direct", "text"])

    return pages.mapInArrow(read, "host string, path string, content long, total long, mark long, direct long, text long")


def _marks(value):
    return F.sum(value.cast("decimal(38,0)"))


def _summed(each: DataFrame, host) -> DataFrame:
    return each.groupBy(host.alias("host"), "path", "content").agg(
        F.sum("support").alias("support"), F.sum("total").alias("total"), _marks(F.col("vector")).alias("vector"),
        F.sum("direct").alias("direct"), F.sum("text").alias("text"))


def vectors(pages: DataFrame) -> DataFrame:
    """``host, path, content, support, total, vector, direct, text`` of every token; hosts with too few
    different texts are one."""
    each = stored(_occurrences(pages).groupBy("host", "path", "content").agg(
        F.count("*").alias("support"), F.sum("total").alias("total"), _marks(F.col("mark")).alias("vector"),
        F.sum("direct").alias("direct"), F.sum("text").alias("text")), "tokens")
    differ = each.where("path = '' AND content IS NOT NULL").groupBy("host").agg(F.count("*").alias("n"))
    own = differ.where((F.col("n") >= MIN_PAGES) & (F.col("host") != "")).select("host")
    return each.join(own, "host", "left_semi").unionByName(_summed(each.join(own, "host", "left_anti"), F.lit(SHARED)))


def classes(tokens_: DataFrame) -> DataFrame:
    """``host, path, total, support, direct, text, own``: the frequent elements of the valid classes;
    ``own`` if a text of the element is in its class, so that it is the template's."""
    pages = tokens_.where("path = '' AND content IS NULL").select("host", F.col("support").alias("pages"))
    elements = tokens_.where("content IS NULL").join(pages, "host").where(
        F.col("support") * 100 >= F.col("pages") * MIN_SUPPORT)
    # a class is known by its host and vector; of its texts only those of its own elements matter
    texts = tokens_.where("content IS NOT NULL").join(pages, "host").where(
        F.col("support") * 100 >= F.col("pages") * MIN_SUPPORT).select("host", "path", "vector", F.lit(True).alias("own"))
    return elements.join(texts, ["host", "path", "vector"], "left").select(
        "host", "path", "total", "support", "direct", "text", F.coalesce("own", F.lit(False)).alias("own"))


def templates(pages: DataFrame) -> DataFrame:
    """``host, article, template``: the path of the article element, and those of the boxes with
    template text, for every host with a template and for the shared one."""
    # as large as the hosts' templates, whatever the number of pages
    nested = stored(classes(vectors(pages)), "classes")
    steps = F.split("path", "/")
    # the innermost element that holds all slots
    slots = nested.where("direct > 0 AND NOT own").select("host", steps.alias("steps"))
    above = slots.select("host", F.explode(F.transform(
        F.sequence(F.lit(1), F.size("steps")), lambda k: F.array_join(F.slice("steps", 1, k), "/"))).alias("path"))
    held = above.groupBy("host", "path").agg(F.count("*").alias("slots"))
    whole = ~F.substring_index(F.element_at(steps, -1), ".", 1).isin(*sorted(PARTS | INLINE))
    once = held.join(nested.where(F.col("total") == F.col("support")).where(whole).select("host", "path"), ["host", "path"])
    every = slots.groupBy("host").agg(F.count("*").alias("every"))
    around = once.join(every, "host").where("slots = every").groupBy("host").agg(
        F.max(F.struct(F.size(steps).alias("depth"), "path"))["path"].alias("around"))
    # an outermost article or main element with most of the text
    root = nested.where("path = ''").select("host", F.col("text").alias("all_text"))
    tags = F.transform(steps, lambda s: F.substring_index(s, ".", 1).isin(*sorted(MAIN)))
    outer = nested.where(F.element_at(tags, -1) & (F.size(F.filter(tags, lambda t: t)) == 1)).join(root, "host")
    main = outer.where("text * 2 > all_text").groupBy("host").agg(F.max(F.struct("text", "path"))["path"].alias("main"))
    boxes = nested.where(F.col("own") & (F.col("text") > 0)
                         & F.substring_index(F.element_at(steps, -1), ".", 1).isin(*sorted(BOXES)))
    boxes = boxes.groupBy("host").agg(F.sort_array(F.collect_set("path")).alias("template"))
    return root.join(around, "host", "left").join(main, "host", "left").join(boxes, "host", "left").select(
        "host", F.coalesce("main", "around", F.lit("")).alias("article"), F.coalesce("template", F.array().cast("array<string>")).alias("template"))


def main_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` for every page."""
    pages = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    found = stored(templates(pages), "templates")
    shared = found.where(F.col("host") == SHARED).first() or {"article": "", "template": []}
    shared_article, shared_boxes = shared["article"], frozenset(shared["template"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(p or "", *((a, frozenset(t)) if a is not None else (shared_article, shared_boxes)))
                     for p, a, t in zip(*(c.to_pylist() for c in batch.columns[2:]))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array(np.array([len(t) for t in texts], np.int64))], ["page_id", "url", "text", "n_chars"])

    host = F.lower(F.regexp_extract(F.regexp_replace(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://", ""),
                                    "^[^/]*", 0))
    own = small_side(found.where(F.col("host") != SHARED).select(F.col("host").alias("_host"), "article", "template"))
    joined = pages.join(own, host == F.col("_host"), "left").select("page_id", "url", "html", "article", "template")
    kind = dict(pages.dtypes)["page_id"]
    return joined.mapInArrow(read, f"page_id {kind}, url string, text string, n_chars long")
