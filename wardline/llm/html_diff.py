"""Main text of web pages by nearest-URL page differencing.

Pages of one host are put in the order of their URL paths; each is paired with
the neighbour whose path shares the longer prefix.  The text blocks (lines) of
the two are aligned by longest common subsequence, and shared lines are deleted
as template text.  Copies and near copies tell nothing about templates: pages
that follow each other and are such form a run, and the neighbours of a page are
the nearest pages of other runs.

Menus, adverts and footers whose wording changes from page to page are not
shared lines, and an article that was published twice is; differencing alone
gets both wrong.  So elements that declare themselves as boilerplate (by tag,
role, class or id) are left out before, and lines inside an ``article`` or
``main`` element are kept even if they are shared, with the unshared lines beside
them where these hold far more text.

Pages are compared as lists of line hashes, in ranges of the order; the pages at
the edges of each range are handed to the others, so that results do not depend
on where ranges end.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import materialise

NEAR = 0.1  # share of a page's characters; with less than that of its own, it is a near copy of the other page
MORE = 2  # lines beside the surest element are kept if they hold more than so many times its text
LCS_CELLS = 1 << 21  # cells of a table of lengths; longer line lists are halved first
RUNS = 3  # runs of near copies that are tried on each side of a page

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(?:![^>]*|\?[^>]*)>|<(script|style|template|textarea|noscript|iframe|svg|math)\b[^>]*>.*?(?:</\1\s*>|\Z)"
                    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)/?>", re.S | re.I)
_ATTRIBUTE = re.compile(r"([a-zA-Z_:-]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
# Elements of HTML by how they take part in a page.
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small "
                    "span strike strong sub sup time tt u var wbr img".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_OUT = frozenset("head title nav header footer aside form button select option menu dialog object canvas audio video map".split())
_MAIN = {"main": 1, "article": 2}  # how surely an element holds the main text
_OUT_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
# Words of class and id that name boilerplate, and those that name reader comments.
_OUT_WORDS = frozenset("ad ads adv advert adverts advertisement advertising adsense alert banner breadcrumb breadcrumbs consent cookie "
                       "cookies copyright disclaimer footer form gdpr header login masthead menu modal nav navbar navigation newsletter "
                       "notice notices notification overlay pagination pager popup promo promotion related search share sharing sidebar "
                       "sidenav signup social sponsor sponsored subscribe subscription toolbar topbar widget widgets".split())
_COMMENT_WORDS = frozenset("comment comments commentlist discussion disqus replies reply respond".split())
_SOFT, _HARD = 1, 2
# Open elements that a start tag of the same family closes.
_CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}


def _attributes(text: str) -> dict[str, str]:
    return {k.lower(): html.unescape(a or b or c) for k, a, b, c in _ATTRIBUTE.findall(text)}


def _out(tag: str, attributes: str, inside: int) -> int:
    """Whether an element is left out: surely, or (by its class or id) unless it wraps the main element."""
    if tag in _OUT:
        return _HARD
    if not attributes.strip(" /") or tag in ("body", "html"):
        return 0
    a = _attributes(attributes)
    if "hidden" in a or a.get("aria-hidden") == "true" or "display:none" in a.get("style", "").replace(" ", "").lower():
        return _HARD
    if a.get("role", "").lower() in _OUT_ROLES:
        return _HARD
    words = {w.lower() for w in re.findall(r"[A-Z]?[a-z]+|[A-Z]+", f"{a.get('class', '')} {a.get('id', '')}")}
    if not words.isdisjoint(_COMMENT_WORDS) and (tag not in _MAIN or inside):
        return _HARD
    return _SOFT if tag not in _MAIN and not words.isdisjoint(_OUT_WORDS) else 0


def text_blocks(page: str | None) -> list[tuple[str, int]]:
    """The text blocks of a page in page order, each with 2 if it is inside an article, 1 inside a main element, else 0.

    Comments, scripts, styles and elements that declare themselves as
    boilerplate are left out; character references are decoded, white space
    inside a block becomes one space.
    """
    page = page or ""
    blocks: list[tuple[str, int]] = []
    parts: list[str] = []
    stack: list[tuple[str, int, int]] = []  # tag, left out, inside main
    out = main = at = 0

    def flush() -> None:
        text = " ".join("".join(parts).split())
        parts.clear()
        if text:
            blocks.append((text, main))

    for m in _TOKEN.finditer(page):
        if m.start() > at and not out:
            parts.append(html.unescape(page[at:m.start()]))
        at = m.end()
        tag = m[3]
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "br":
            parts.append(" ")
            continue
        if tag not in _INLINE:
            flush()
        if m[2]:  # an end tag closes what was opened after its start tag; a stray one closes nothing
            if any(t == tag for t, _, _ in stack):
                while stack.pop()[0] != tag:
                    pass
        elif tag not in _VOID:
            closes = _CLOSES.get(tag, ())
            if closes:
                while stack and (stack[-1][0] in closes or stack[-1][0] in _INLINE and any(t in closes for t, _, _ in _block(stack))):
                    stack.pop()
                _, out, main = stack[-1] if stack else ("", 0, 0)
            kind = _MAIN.get(tag, 1 if 'role="main"' in m[4] else 0)
            if kind and out == _SOFT and not main:
                out = 0  # the element around it names boilerplate, but wraps the main element
            stack.append((tag, max(out, _out(tag, m[4], main)), max(main, kind)))
        _, out, main = stack[-1] if stack else ("", 0, 0)
    if not out:
        parts.append(html.unescape(page[at:]))
    flush()
    return blocks


def _block(stack: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """The innermost open element that is not inline."""
    for entry in reversed(stack):
        if entry[0] not in _INLINE:
            return [entry]
    return []


def shared_lines(a: list[str], b: list[str]) -> set[int]:
    """Places in ``a`` of a longest common subsequence with ``b`` (quadratic time, only between the first and last
    difference and for lines of both; memory grows with their number, not with its square)."""
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    end = 0
    while end < min(len(a), len(b)) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    found = {*range(start), *range(len(a) - end, len(a))}
    both = set(a[start:len(a) - end]) & set(b[start:len(b) - end])  # only lines of both pages can be shared
    names = {x: i for i, x in enumerate(both)}
    places = np.array([i for i, x in enumerate(a[start:len(a) - end], start) if x in both], np.int64)
    left = np.array([names[a[i]] for i in places], np.int32)
    right = np.array([names[x] for x in b[start:len(b) - end] if x in both], np.int32)
    parts = [(0, len(left), 0, len(right))]
    while parts:
        i, i_end, j, j_end = parts.pop()
        if (i_end - i) * (j_end - j) <= LCS_CELLS or i_end - i == 1:
            found.update(places[i:i_end][_table_lcs(left[i:i_end], right[j:j_end])].tolist())
            continue
        # The half of the lines that best goes with each start of the other side, and the rest with its end.
        half = (i + i_end) // 2
        ahead = _lengths(left[half:i_end][::-1], right[j:j_end][::-1])[::-1]
        cut = j + int(np.argmax(_lengths(left[i:half], right[j:j_end]) + ahead))
        parts += [(i, half, j, cut), (half, i_end, cut, j_end)]
    return found


def _lengths(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Length of a longest common subsequence of ``left`` with each start of ``right``, the empty one first."""
    row = np.zeros(len(right) + 1, np.int32)
    for x in left:
        row[1:] = np.maximum.accumulate(np.where(right == x, row[:-1] + 1, row[1:]))
    return row


def _table_lcs(left: np.ndarray, right: np.ndarray) -> list[int]:
    """Places in ``left`` of a longest common subsequence, by the whole table of lengths."""
    table = np.zeros((len(left) + 1, len(right) + 1), np.int32)
    for i in range(len(left) - 1, -1, -1):
        hit = np.where(right == left[i], table[i + 1, 1:] + 1, table[i + 1, :-1])
        table[i, :-1] = np.maximum.accumulate(hit[::-1])[::-1]
    places = []
    i = j = 0
    while i < len(left) and j < len(right):
        if left[i] == right[j] and table[i, j] == table[i + 1, j + 1] + 1:
            places.append(i)
            i, j = i + 1, j + 1
        elif table[i + 1, j] >= table[i, j + 1]:
            i += 1
        else:
            j += 1
    return places


def _gone(lines: list, sizes: list[int], partner: list) -> set[int] | None:
    """Places of the lines that ``partner`` shares; None if it is a near copy, beside which too little is left."""
    gone = shared_lines(lines, partner)
    total = sum(sizes)
    return gone if total - sum(sizes[i] for i in gone) >= max(1, NEAR * total) else None


def _near(a: dict, b: dict) -> bool:
    """Whether two pages are copies or near copies of each other."""
    if a["lines"] == b["lines"]:
        return True
    small, large = sorted((sum(a["sizes"]), sum(b["sizes"])))
    if large - small >= NEAR * large:
        return False
    same = sum(a["sizes"][i] for i in shared_lines(a["lines"], b["lines"]))
    return large - same < NEAR * large and small - same < NEAR * small


def _may_matter(inside: list[int], sizes: list[int]) -> bool:
    """Whether a partner can change which blocks of a page are kept."""
    surest = max(inside)
    held = sum(n for n, k in zip(sizes, inside) if k == surest)
    return not surest or sum(sizes) - held > MORE * held


def kept_blocks(inside: list[int], sizes: list[int], gone: set[int] | None) -> list[int]:
    """Places of the blocks of the main text: those of the surest element, and unshared ones of less sure places
    that hold more than ``MORE`` times its text (outside article and main only if there is a partner)."""
    surest = max(inside, default=0)
    shared = gone or set()
    kept = [i for i, k in enumerate(inside) if k == surest and (surest or i not in shared)]
    held = sum(sizes[i] for i in kept)
    for level in range(surest - 1, -1, -1):
        rest = [i for i, k in enumerate(inside) if k == level and i not in shared]
        n = sum(sizes[i] for i in rest)
        if n > MORE * held and (level or gone is not None):
            kept, held = kept + rest, held + n
    return sorted(kept)


def main_text(blocks: list[tuple[str, int]], partner: list[tuple[str, int]] | None) -> str:
    """The blocks of the main text of a page, see ``kept_blocks``; a near copy is no partner."""
    lines, inside = [text for text, _ in blocks], [k for _, k in blocks]
    sizes = [len(x) for x in lines]
    gone = _gone(lines, sizes, [text for text, _ in partner]) if partner else None
    return " ".join(lines[i] for i in kept_blocks(inside, sizes, gone))


def _common(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 500) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*held), schema)], schema=schema)


_BLOCKS = ("page_id long, url string, host string, path string, text string, texts array<string>, "
           "inside array<int>, lines array<long>, sizes array<int>")
_BLOCKS_ARROW = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("host", pa.string()), ("path", pa.string()),
                           ("text", pa.string()), ("texts", pa.list_(pa.string())), ("inside", pa.list_(pa.int32())), ("lines", pa.list_(pa.int64())),
                           ("sizes", pa.list_(pa.int32()))])


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages as line hashes, with the main text where no partner can change it, else with all texts."""
    def rows():
        for batch in batches:
            for row in batch.to_pylist():
                blocks = text_blocks(row["html"])
                texts = [x for x, _ in blocks]
                lines = np.array([xxhash.xxh3_64_intdigest(x.encode("utf-8", "surrogatepass")) for x in texts], np.uint64).view(np.int64)
                inside, sizes, text = [k for _, k in blocks], [len(x) for x in texts], None
                if not texts or not _may_matter(inside, sizes):
                    text, texts = " ".join(texts[i] for i in kept_blocks(inside, sizes, None)), None
                yield row["page_id"], row["url"], row["host"], row["path"], text, texts, inside, lines, sizes

    return _batches(rows(), _BLOCKS_ARROW)


_RANGES = ("uid long, host string, path string, inside array<int>, lines array<long>, sizes array<int>, r int, at long, follows boolean, "
           "head int, tail int")
_RANGES_ARROW = pa.schema([("uid", pa.int64()), ("host", pa.string()), ("path", pa.string()), ("inside", pa.list_(pa.int32())),
                           ("lines", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())), ("r", pa.int32()), ("at", pa.int64()),
                           ("follows", pa.bool_()), ("head", pa.int32()), ("tail", pa.int32())])


def _runs(pages: list[dict]) -> list[list[int]]:
    """Places of the pages of each run of near copies."""
    runs: list[list[int]] = []
    for i, p in enumerate(pages):
        if p["follows"]:
            runs[-1].append(i)
        else:
            runs.append([i])
    return runs


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sorted pages of a range: whether each continues a run, and which are the nearest pages to the edges of the
    first and last ``RUNS + 1`` runs of the host there."""
    r = TaskContext.get().partitionId()
    pages = [row for batch in batches for row in batch.to_pylist()]
    for i, p in enumerate(pages):
        p["follows"] = i > 0 and pages[i - 1]["host"] == p["host"] and _near(pages[i - 1], p)
    runs = _runs(pages)
    head = {run[0]: k for k, run in enumerate(runs[:RUNS + 1]) if pages[run[0]]["host"] == pages[0]["host"]}
    tail = {run[-1]: k for k, run in enumerate(runs[:-RUNS - 2:-1]) if pages[run[-1]]["host"] == pages[-1]["host"]}
    return _batches(((p["uid"], p["host"], p["path"], p["inside"], p["lines"], p["sizes"], r, i, p["follows"], head.get(i), tail.get(i))
                     for i, p in enumerate(pages)), _RANGES_ARROW)


def _beyond(edges: list[dict]) -> dict[int, tuple[list[dict], list[dict]]]:
    """Of each range: the nearest page of each of the ``RUNS`` runs before it and after it on the host at its edge."""
    ends: dict[int, tuple[list, list]] = {}
    for e in edges:
        for side, k in enumerate((e["head"], e["tail"])):
            if k is not None:
                ends.setdefault(e["r"], ([], []))[side].append((k, e))
    order = sorted(ends)
    heads, tails = ([[e for _, e in sorted(ends[r][side], key=lambda x: x[0])] for r in order] for side in (0, 1))
    joined = [a[0]["host"] == b[0]["host"] and _near(a[0], b[0]) for a, b in zip(tails, heads[1:])]  # a run goes on over the edge

    def walk(k: int, step: int) -> list[dict]:
        near, far = (tails, heads) if step < 0 else (heads, tails)
        host, found, j = far[k][0]["host"], [], k + step
        while 0 <= j < len(order) and len(found) < RUNS and near[j][0]["host"] == host:
            found += near[j][joined[min(j, j - step)]:]
            if far[j][0]["host"] != host:
                break
            j += step
        return found[:RUNS]

    return {r: (walk(k, -1), walk(k, 1)) for k, r in enumerate(order)}


_KEPT = pa.schema([("uid", pa.int64()), ("keep", pa.list_(pa.int32()))])


def _keep(beyond: dict[int, tuple[list[dict], list[dict]]]):
    """The places of the kept blocks of every page of a range whose partner can matter."""
    def decided(r: int, pages: list[dict]) -> Iterator[tuple]:
        runs = _runs(pages)
        before, after = beyond[r]
        for k, run in enumerate(runs):
            host = pages[run[0]]["host"]
            sides = ([pages[x[-1]] for x in reversed(runs[max(0, k - RUNS):k])] + (before if k < RUNS else []),
                     [pages[x[0]] for x in runs[k + 1:k + 1 + RUNS]] + (after if k + RUNS >= len(runs) else []))
            sides = [[p for p in side if p["host"] == host][:RUNS] for side in sides]
            for page in (pages[i] for i in run):
                if not _may_matter(page["inside"], page["sizes"]):
                    continue
                gone, best = None, -1
                for side in sides:  # the nearest page of each side that is no near copy; of both, the one of longer common path
                    for p in side:
                        if (g := _gone(page["lines"], page["sizes"], p["lines"])) is not None:
                            if (n := _common(page["path"], p["path"])) > best:
                                gone, best = g, n
                            break
                yield page["uid"], kept_blocks(page["inside"], page["sizes"], gone)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            now, pages = None, []
            for batch in batches:
                for row in batch.to_pylist():
                    if row["r"] != now:
                        if pages:
                            yield from decided(now, pages)
                        now, pages = row["r"], []
                    pages.append(row)
            if pages:
                yield from decided(now, pages)

        return _batches(rows(), _KEPT)

    return run


def extract_main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages(page_id, url, html)``.

    Pages are dealt by ranges of (host, path, page_id), so a host with a third
    of all pages is spread over tasks; of each range, at most ``2 * RUNS + 2``
    pages (as line hashes) go to the others, and results do not depend on the
    ranges.  Null and empty html give an empty text and such pages are nobody's
    partner; pages of null or unreadable URL count as one host.  A page without
    a partner loses no lines: alone on its host, or where the nearest ``RUNS``
    runs on both sides would leave less than a tenth of its characters.
    Repeated rows and copies are pages of their own and get equal treatment; an
    empty table gives no rows.  The whole html is read.
    """
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    host = F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))
    path = F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)?([^?#]*)", 1)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"), host.alias("host"), path.alias("path"))
    blocks = materialise(rows.mapInArrow(_parse, _BLOCKS).withColumn("uid", F.monotonically_increasing_id()), "html-blocks")
    order = ["host", "path", "page_id", "url", "digest"]
    narrow = blocks.where(F.size("lines") > 0).select("uid", "host", "path", "page_id", "url", F.xxhash64("lines", "inside").alias("digest"),
                                                      "inside", "lines", "sizes")
    ranges = materialise(narrow.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_cut, _RANGES), "html-ranges")
    edges = ranges.where("head is not null or tail is not null").select("r", "head", "tail", "host", "path", "lines", "sizes").collect()
    edges = [e.asDict() for e in edges]
    count = max((e["r"] for e in edges), default=0) + 1
    kept = (ranges.drop("head", "tail").repartitionById(count, F.col("r")).sortWithinPartitions("r", "at")
            .mapInArrow(_keep(_beyond(edges)), "uid long, keep array<int>"))
    text = F.concat_ws(" ", F.transform(F.col("keep"), lambda i: F.get("texts", i)))
    dealt = blocks.where("text is null").select("uid", "page_id", "url", "texts").join(kept, "uid")
    done = blocks.where("text is not null").select("page_id", "url", "text")
    return done.unionByName(dealt.select("page_id", "url", text.alias("text"))).withColumn("n_chars", F.length("text").cast("long"))
