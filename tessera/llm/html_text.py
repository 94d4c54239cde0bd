"""HTML extraction by differencing each page with its nearest page of the host.

A page becomes a list of text lines, one for each block of text, with where it
stands: in boilerplate (menus, headers, footers, sidebars, notices, adverts,
forms, comments, by element, role or class name), in an ``article`` (running
text or not), or elsewhere. The pages of a host are sorted by URL path, so
neighbours share the longest path prefix; each page is aligned with its
nearest neighbour by the longest common subsequence of all their lines, and
the shared lines are deleted: they belong to the template. The markup is a
later check: running text of an ``article`` stays, however often it occurs
elsewhere (two pages may carry the same article), and boilerplate that is the
page's own (a menu or an advert that its neighbour has not) goes. A neighbour
that shares nearly every line is a copy, which says nothing about the
template: the nearest page beyond it that is no copy is used. A page with no
page to compare with is read by its markup alone: its articles, or all lines outside boilerplate.

Pages are compared by hashes of their lines. Equal pages of a host (repeated
rows, variants of one path) count once and get one verdict. The distinct pages
are range-partitioned by host, path and URL in parts of about ``part_pages``;
each part is also handed the rows of the parts on either side (of more parts,
where copies fill those), so every page meets its true neighbours at any host
size. Texts travel only to meet their verdict.

Edge cases: null or empty html gives empty text; a null url, or one without
a host, has no neighbour and only the markup decides; very long pages are
aligned in linear memory; equal rows give equal results; an empty table gives
an empty result; only the three columns are read.
"""

from __future__ import annotations

import hashlib
import html as _html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.scratch import ship, written

#: Elements that run on within a line.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small "
                   "span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is not text of the page.
RAW = frozenset("script style noscript template textarea title svg math iframe object canvas audio video select "
                "button datalist".split())
BOILERPLATE = frozenset("nav footer aside form menu dialog fieldset".split())
RUNNING = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre td th dd dt figcaption caption".split())
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu "
                              "menubar toolbar".split())
#: Parts of class names and ids that name boilerplate.
BOILERPLATE_NAMES = frozenset(
    "nav navbar navigation menu menus breadcrumb breadcrumbs header masthead topbar footer sidebar aside rail ad ads "
    "advert adverts advertisement advertising sponsor sponsored promo promotion banner notice notices cookie cookies "
    "consent gdpr popup modal overlay newsletter subscribe subscription signup login share sharing social related "
    "recommended teaser teasers comment comments discussion disqus replies respond pagination pager widget widgets "
    "toolbar alert paywall copyright".split())
#: A neighbour that leaves less than this part of a page's characters is a copy of it.
COPY_REST = 0.05

#: Distinct pages of a part, and the most parts (larger ones if need be).
PART_PAGES, MOST_PARTS = 512, 20_000

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)"
                    r"(?:((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|[^>]*(?:>|\Z))", re.S)
_NAMED = re.compile(r"\b(class|id|role|hidden|aria-hidden)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_PART = re.compile(r"[a-z]+")
DROP, ARTICLE, OTHER = 0, 1, 2


def _is_boilerplate(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in BOILERPLATE or (tag == "header" and not in_article):
        return True
    if not attributes or tag in ("html", "body", "main"):
        return False
    for name, a, b, c in _NAMED.findall(attributes):
        name, value = name.lower(), (a or b or c).lower()
        if name == "role":
            if value in BOILERPLATE_ROLES:
                return True
        elif name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        elif name in ("class", "id"):
            for word in value.split():
                parts = _PART.findall(word)
                if any(p in BOILERPLATE_NAMES for p in parts) and not (tag in ("article",) and parts[:1] == ["post"]):
                    if not (tag == "header" and in_article) and not (parts[-1:] == ["content"] or parts[-1:] == ["body"]):
                        return True
    return False


@dataclass
class Page:
    """Lines of a page: text, and place (DROP, ARTICLE or OTHER; 10 more in running text of an article)."""

    lines: list[tuple[str, int]] = field(default_factory=list)


def read_page(source: str) -> Page:
    """Blocks of text in page order; ends of input close what is open."""
    page = Page()
    stack: list[tuple[str, bool, bool, bool]] = []     # tag, boilerplate, article, running text
    text: list[str] = []

    def flush() -> None:
        if text:
            whole = " ".join(_html.unescape("".join(text)).split())
            text.clear()
            if whole:
                _, bad, art, run = stack[-1] if stack else ("", False, False, False)
                place = DROP if bad else (ARTICLE + 10 * run if art else OTHER)
                page.lines.append((whole, place))

    at, end = 0, len(source)
    while at < end:
        m = _TOKEN.search(source, at)
        if m is None:
            text.append(source[at:])
            break
        if m.start() > at:
            text.append(source[at:m.start()])
        at = m.end()
        tag = m.group(2)
        if tag is None:
            continue
        tag = tag.lower()
        if tag in RAW and not m.group(1):
            if not (m.group(3) or "").rstrip().endswith("/") or tag in ("script", "style", "title", "textarea"):
                close = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(source, at)
                at = close.end() if close else end
            if tag not in INLINE:
                text.append(" ")
            continue
        if tag in RAW:
            continue
        if tag in INLINE:
            if not m.group(1) and tag not in VOID and _is_boilerplate(tag, m.group(3) or "", _within(stack)):
                flush()
                stack.append((tag, True, _within(stack), False))
            elif m.group(1) and stack and stack[-1][0] == tag:
                flush()
                stack.pop()
            continue
        if tag == "br":
            text.append(" ")
            continue
        flush()
        if m.group(1):
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    break
                if stack[i][0] in ("article", "main", "body", "nav", "aside", "footer") and tag in RUNNING | {"div"}:
                    break                              # a stray end tag does not close a region
        elif tag not in VOID:
            if tag in ("p", "li", "dd", "dt", "td", "th", "tr", "option") or tag in RUNNING:
                _close_implied(stack, tag)
            _, bad, art, run = stack[-1] if stack else ("", False, False, False)
            bad = bad or _is_boilerplate(tag, m.group(3) or "", art)
            art = art or tag == "article"
            stack.append((tag, bad, art, tag in RUNNING or (run and tag not in ("div", "section", "article", "aside"))))
    flush()
    return page


def _within(stack) -> bool:
    return bool(stack) and stack[-1][2]


def _close_implied(stack, tag: str) -> None:
    """An open paragraph or item ends where the next one starts."""
    ends = {"li": ("li", "p"), "dd": ("dd", "dt", "p"), "dt": ("dd", "dt", "p"), "td": ("td", "th", "p"),
            "th": ("td", "th", "p"), "tr": ("tr", "td", "th", "p")}.get(tag, ("p",))
    while stack and stack[-1][0] in ends and not stack[-1][1]:
        stack.pop()


# -- alignment --------------------------------------------------------------

def _rows(a: list, b: list):
    """Bit rows of the LCS table: a zero at bit j where the length grows at b[j]."""
    masks: dict = {}
    for j, x in enumerate(b):
        masks[x] = masks.get(x, 0) | (1 << j)
    full = (1 << len(b)) - 1
    v = full
    for x in a:
        u = v & masks.get(x, 0)
        v = ((v + u) | (v - u)) & full
        yield v


def lcs(a: list, b: list, cells: int = 1 << 22) -> list[int]:
    """Indices of ``a`` in one longest common subsequence with ``b``; linear memory beyond ``cells``."""
    common = set(a) & set(b)
    ia, b = [i for i, x in enumerate(a) if x in common], [x for x in b if x in common]
    return [ia[i] for i in _lcs([a[i] for i in ia], b, cells)]


def _lcs(a: list, b: list, cells: int) -> list[int]:
    if not a or not b:
        return []
    if len(a) == 1:
        return [0] if a[0] in b else []
    if len(a) * len(b) <= cells:
        rows = [(1 << len(b)) - 1, *_rows(a, b)]
        out, i, j = [], len(a), len(b)
        while i and j:
            if not rows[i] >> (j - 1) & 1:                # the length grows at b[j-1] in row i
                if not rows[i - 1] >> (j - 1) & 1:
                    i -= 1
                    continue
                out.append(i - 1)
                i -= 1
            j -= 1
        return out[::-1]
    half = len(a) // 2
    lengths = []
    for x, y in ((a[:half], b), (a[half:][::-1], b[::-1])):
        *_, last = _rows(x, y)
        bits = bin(last | (1 << len(b)))[3:][::-1]
        sums = [0]
        for c in bits:
            sums.append(sums[-1] + (c == "0"))
        lengths.append(sums)
    cut = max(range(len(b) + 1), key=lambda j: lengths[0][j] + lengths[1][len(b) - j])
    return _lcs(a[:half], b[:cut], cells) + [half + i for i in _lcs(a[half:], b[cut:], cells)]


def by_markup(page: Page) -> list[int]:
    """Lines that the markup alone keeps: those of articles, or without one all outside boilerplate."""
    article = [i for i, (_, place) in enumerate(page.lines) if place % 10 == ARTICLE]
    return article or [i for i, (_, place) in enumerate(page.lines) if place != DROP]


def shared_lines(page: Page, other: Page, markup: bool = True) -> set[int] | None:
    """Lines of ``page`` in the longest common subsequence with ``other``, or None if ``other`` is a copy of it.

    All lines take part. Boilerplate by markup does not count for what makes a copy.
    """
    return _shared(*([t for t, _ in x.lines] for x in (page, other)), [len(t) for t, _ in page.lines],
                   [place for _, place in page.lines], markup)


def _shared(lines: list, others: list, sizes: list[int], places: list[int], markup: bool) -> set[int] | None:
    shared = set(lcs(lines, others))
    counted = [i for i, place in enumerate(places) if place != DROP or not markup]
    own = sum(sizes[i] for i in counted if i not in shared)
    return None if own < COPY_REST * sum(sizes[i] for i in counted) else shared


def _kept(places: list[int], shared: set[int], markup: bool) -> list[int]:
    return [i for i, place in enumerate(places)
            if (place >= 10 or i not in shared and place != DROP if markup else i not in shared)]


def difference(page: Page, neighbours: list[Page], markup: bool = True) -> list[str]:
    """Texts of the page's lines that its nearest page, not a copy, does not share.

    The differencing judges every line; then the markup is checked: running
    text of an article stays, and of the page's own lines boilerplate goes.
    Without a page to compare with, the markup alone decides.
    """
    kept = by_markup(page) if markup else range(len(page.lines))
    for other in neighbours:
        shared = shared_lines(page, other, markup)
        if shared is not None:
            kept = _kept([place for _, place in page.lines], shared, markup)
            break
    return [page.lines[i][0] for i in kept]


def _common(a: str, b: str) -> int:
    n = min(len(a), len(b))
    for i in range(n):
        if a[i] != b[i]:
            return i
    return n


def _digest(page: Page) -> bytes:
    whole = "\0".join([f"{place} {t}" for t, place in page.lines])
    return hashlib.blake2b(whole.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def _line_id(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _parsed(rows: DataFrame, markup: bool, texts: bool) -> DataFrame:
    """Pages read: digest ``g`` and the lines as texts and what markup alone keeps, or as ids, sizes and places."""
    from pyspark.sql.types import ArrayType, BinaryType, ByteType, IntegerType, LongType, StringType, StructType

    carried = ["k", "u", "host"] if texts else ["host", "path", "u"]
    out = StructType([rows.schema[c] for c in carried]).add("g", BinaryType())
    arrow = [pa.binary()]
    if texts:
        out = out.add("lines", ArrayType(StringType())).add("alone", ArrayType(IntegerType()))
        arrow += [pa.list_(pa.string()), pa.list_(pa.int32())]
    else:
        out = out.add("ids", ArrayType(LongType())).add("sizes", ArrayType(IntegerType())).add("places", ArrayType(ByteType()))
        arrow += [pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int8())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                made = []
                for source in part.column(len(carried)):
                    page = read_page(source.as_py() or "")
                    if texts:
                        kept = by_markup(page) if markup else list(range(len(page.lines)))
                        made.append((_digest(page), [t if place != DROP or not markup else "" for t, place in page.lines], kept))
                    else:
                        made.append((_digest(page), [_line_id(t) for t, _ in page.lines], [len(t) for t, _ in page.lines],
                                     [place for _, place in page.lines]))
                yield pa.RecordBatch.from_arrays([*part.columns[:len(carried)], *(pa.array(c, t) for c, t in zip(zip(*made), arrow))],
                                                 names=out.names)

    return rows.select(*carried, "x").mapInArrow(run, out)


def _judge(pages: list[tuple], first: bool, last: bool, markup: bool) -> Iterator[tuple]:
    """(host, digest, lines kept or None, done) of a part's own pages; ``pages`` are in URL order.

    A page is (own, host, path, g, ids, sizes, places). On either side the
    nearest page that is no copy counts; the search passes over a copy to the
    page that the copy itself was led to. It is not done if it runs out of
    ``pages`` and these are not the ``first`` or ``last`` of the table.
    """
    own = [i for i, x in enumerate(pages) if x[0]]
    near: dict[int, list] = {i: [] for i in own}
    done = dict.fromkeys(own, True)
    for step, order, whole in ((-1, own, first), (1, own[::-1], last)):
        led: dict[int, int | None] = {}                     # None: no such page in the host
        for i in order:
            _, host, path, _, ids, sizes, places = pages[i]
            j = i + step
            while j is not None and 0 <= j < len(pages):
                if pages[j][1] != host:
                    j = None
                    break
                shared = _shared(ids, pages[j][4], sizes, places, markup)
                if shared is not None:
                    near[i].append((_common(pages[j][2], path), shared))
                    break
                j = led.get(j, j + step)
            led[i] = j
            if j is not None and not 0 <= j < len(pages) and not whole:
                done[i] = False
    for i in own:
        best = max(near[i], key=lambda x: x[0], default=None)           # ties: the page before
        yield pages[i][1], pages[i][3], None if best is None else _kept(pages[i][6], best[1], markup), done[i]


def _verdicts(rows: DataFrame, part_pages: int, markup: bool) -> DataFrame:
    """(host, g, kept): lines kept of each distinct page that has a page to compare with."""
    lines = _parsed(rows.where("host != ''"), markup, False)
    distinct = written(lines.groupBy("host", "g").agg(F.min(F.struct("path", "u", "ids", "sizes", "places")).alias("p"))
                       .select("host", "g", "p.*"), "pages")
    n = distinct.count()
    parts = max(1, min(MOST_PARTS, -(-n // part_pages)))
    ranged = written(distinct.repartitionByRange(parts, "host", "path", "u", "g")
                     .withColumn("part", F.spark_partition_id()), "pages-ranged")
    used = [r["part"] for r in ranged.select("part").distinct().orderBy("part").collect()]      # empty parts left out
    parts = len(used)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pages():
            for batch in batches:
                columns = [c.to_pylist() for c in batch.columns]
                yield from zip(*columns)

        for _, group in groupby(pages(), key=lambda r: r[0]):
            group = list(group)
            target, first, last = group[0][:3]
            made = list(_judge([r[3:] for r in group], first, last, markup))
            host, g, kept, done = zip(*made)
            yield pa.RecordBatch.from_arrays([pa.array(host, pa.string()), pa.array(g, pa.binary()), pa.array(kept, pa.list_(pa.int32())),
                                              pa.array(done), pa.array([target] * len(made), pa.int32())],
                                             names=["host", "g", "kept", "done", "target"])

    out, targets, width = None, list(range(parts)), 1
    while out is None or targets:                       # parts whose copies fill all the parts beside them look further
        pairs = [(used[p], t, t <= width, t + width >= parts - 1, p == t)
                 for t in targets for p in range(max(0, t - width), min(parts, t + width + 1))]
        pairs = rows.sparkSession.createDataFrame(pairs, "part int, target int, first boolean, last boolean, own boolean")
        around = (ranged.join(F.broadcast(pairs), "part").repartition(max(1, len(targets)), "target")
                  .sortWithinPartitions("target", "host", "path", "u", "g"))
        found = written(around.select("target", "first", "last", "own", "host", "path", "g", "ids", "sizes", "places").mapInArrow(
            run, "host string, g binary, kept array<int>, done boolean, target int"), "verdicts")
        targets = [r["target"] for r in found.where("not done").select("target").distinct().collect()]
        settled = found.where(~F.col("target").isin(targets)) if targets else found
        settled = settled.where("kept is not null").select("host", "g", "kept")
        out = settled if out is None else out.unionByName(settled)
        width *= 4
    return out


def extract_main_text(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html",
                      part_pages: int = PART_PAGES, markup: bool = True) -> DataFrame:
    """One row per row of ``pages``: key, url, text, n_chars; without ``markup`` the differencing alone decides."""
    ship(pages.sparkSession)
    rest = F.regexp_extract(F.coalesce(F.col(url).cast("string"), F.lit("")), r"(?s)^.*?://(.*)$", 1)
    rows = pages.select(F.col(key).alias("k"), F.col(url).alias("u"), F.col(html).cast("string").alias("x"),
                        F.lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)).alias("host"),
                        F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1).alias("path"))
    out = _parsed(rows, markup, True).join(_verdicts(rows, part_pages, markup), ["host", "g"], "left")
    text = F.array_join(F.transform(F.coalesce("kept", "alone"), lambda i: F.get("lines", i)), " ")
    out = out.select(F.col("k").alias(key), F.col("u").alias(url), text.alias("text"))
    return out.withColumn("n_chars", F.char_length("text").cast("long"))
