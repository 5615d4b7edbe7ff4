"""Main text of web pages: nearest-URL page differencing, checked by article marks.

A page is read into text lines, a line per block element. Lines inside menus,
headers, footers, sidebars, notices, adverts, forms, comments, scripts and styles
(told by element, role, class or id) are never text. Every page is then differenced:
pages are put in order of URL path within their host, a page's lines are aligned
with those of the page before and the page after by longest common subsequence,
and lines shared with either are the site's frame. The marks of the page are the
check that follows:

* A line in a marked ``article`` is text, shared or not. Beside it, lines of
  ``main`` and headings ``h1`` outside the article are text where they are not shared.
* On a page with ``main`` alone, lines of ``main`` are text, and ``h1`` headings that
  are not shared.
* On a page with neither, all lines that are not shared are text.

An article whose letters stand mostly in links is a teaser where another article
is not. A class or id names a frame if all its words do, or say only where or how
large (``cookie-notice``, ``site-footer``; not ``social-science``).

Pages of one host with the same lines count as one page, at the first of their
paths. A neighbour that holds all lines of a page tells nothing about it (it may be
a longer version of the same page) and is passed over. A neighbour that repeats most
of a page's text is not told from one that shares a frame; on pages without marks
what they share goes.

Plan: the html is read once and its lines are written to the shared folder. Hashes
of lines are put in range partitions by (host, path), so a host with a third of all
pages is spread; each partition's first and last row go to the partitions beside it.
Only pages with lines that differencing may delete are joined to its result, on
their lines' digest: copies are one row on the small side.

Rows: null or empty html gives an empty text. A page with a null or unusable URL
has no neighbours. Repeated rows are pages with the same lines, treated alike.
Markup is scanned once, however broken; a tag or comment that never ends takes the
rest of the page, as in browsers. An empty table gives an empty result; other
columns are left out.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadcast.llm.store import cut, land, shuffle_partitions

# Elements that end a line, elements whose content is no markup, and
# the names that pages give to their frames.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol "
    "p pre section summary table tbody tfoot thead title tr ul".split())
RAW = frozenset("script style noscript noembed noframes textarea title iframe xmp".split())
FRAMES = frozenset("nav aside footer form menu dialog button header template svg math select object".split())
FRAME_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
FRAME_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments "
    "consent cookie cookies disclaimer disqus footer gdpr header login masthead menu modal nav navbar "
    "navigation newsletter notice notices pager pagination popup promo promoted promotion related replies "
    "respond search share sharing sidebar signup skip social sponsor sponsored subscribe teaser teasers toolbar widget".split())
PLACE_NAMES = frozenset(
    "area article articles bar block body bottom box button buttons col column container content footer form "
    "global group header icon icons inner item items large left link links list main media mobile outer page "
    "panel post posts primary right row secondary section side site slot small sticky text thread title to top "
    "unit wrap wrapper".split())
#: Frames that an article never breaks out of.
CLOSED_FRAMES = frozenset("form dialog aside footer template svg math select object".split())
CLOSED_NAMES = frozenset("comment comments disqus related replies respond teaser teasers promo promoted sponsored ad ads advert adverts".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var".split())
ALONE = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Open elements that a start tag ends.
IMPLIED = {
    "li": frozenset(["li"]), "dd": frozenset(["dd", "dt"]), "dt": frozenset(["dd", "dt"]),
    "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]), "tr": frozenset(["td", "th", "tr"]),
}

_NAME = re.compile(r"[a-zA-Z][^ \t\n\f\r/>]*")
_ATTRIBUTE = re.compile(
    r"[ \t\n\f\r/]*+(?:(>)|([^ \t\n\f\r/>][^ \t\n\f\r/>=]*+)"
    r"(?:[ \t\n\f\r]*+=[ \t\n\f\r]*+(?:\"([^\"]*+)\"|'([^']*+)'|([^ \t\n\f\r>]*+)))?+)")
_RAW_END = {name: re.compile(rf"</{name}(?=[ \t\n\f\r/>])", re.I) for name in RAW}
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
_NO_ATTRIBUTES: dict[str, str] = {}

# What a line stands in.
ELSEWHERE, HEADING, MAIN, ARTICLE = range(4)


def scan(html: str) -> Iterator[tuple[str, str, bool, dict[str, str]]]:
    """(text before the tag, tag, whether it closes, attributes) in order; the last
    tag is ''. Each character is looked at a bounded number of times."""
    at, size = 0, len(html)
    text: list[str] = []
    while at < size:
        tag = html.find("<", at)
        if tag < 0:
            break
        text.append(html[at:tag])
        closing = html.startswith("/", tag + 1)
        name = _NAME.match(html, tag + 2 if closing else tag + 1)
        if name is None:
            if html.startswith("<!--", tag):
                end = html.find("-->", tag + 2)
                at = size if end < 0 else end + 3
            elif closing or html.startswith(("!", "?"), tag + 1):
                end = html.find(">", tag)
                at = size if end < 0 else end + 1
            else:  # a sign, no markup
                text.append("<")
                at = tag + 1
            continue
        end = html.find(">", name.end())
        if end < 0:
            at = size
            break
        inside = html[name.end():end]
        attributes = _NO_ATTRIBUTES
        if not closing and inside.strip("/ ") or '"' in inside or "'" in inside:
            attributes, place = {}, name.end()
            while (m := _ATTRIBUTE.match(html, place)) and m[1] is None:
                attributes.setdefault(m[2].lower(), m[3] or m[4] or m[5] or "")
                place = m.end()
            if m is None:
                at = size
                break
            end = m.end() - 1
        at = end + 1
        tag_name = name[0].lower()
        if tag_name in ("svg", "math") and html.endswith("/", 0, end):
            continue
        yield "".join(text), tag_name, closing, attributes
        text = []
        if not closing and tag_name in RAW:
            over = _RAW_END[tag_name].search(html, at)
            at = over.start() if over else size
    yield "".join(text) + html[at:], "", False, _NO_ATTRIBUTES


def frame_kind(name: str, attributes: dict[str, str], in_article: bool) -> int:
    """0: no frame, 1: a frame, 2: a frame whose articles are none."""
    if name in ("html", "body", "main"):
        return 0
    kind = 0
    if name in FRAMES and not (name == "header" and in_article):
        kind = 2 if name in CLOSED_FRAMES else 1
    if not attributes:
        return kind
    if ("hidden" in attributes or attributes.get("aria-hidden", "").strip().lower() == "true"
            or "style" in attributes and _UNSEEN.search(attributes["style"].lower())):
        return 2
    if attributes.get("role", "").strip().lower() in FRAME_ROLES:
        kind = max(kind, 1)
    for value in (attributes.get("class"), attributes.get("id")):
        for word in value.lower().split() if value else ():
            parts = [p.rstrip("0123456789") for p in re.split(r"[-_]+", word)]
            naming = [p for p in parts if p in FRAME_NAMES and not (in_article and p == "header")]
            if naming and all(not p or p in FRAME_NAMES or p in PLACE_NAMES for p in parts):
                kind = max(kind, 1 if CLOSED_NAMES.isdisjoint(naming) else 2)
    return kind


def read_lines(html: str) -> list[tuple[str, int]]:
    """The text lines of a page in order, each with what it stands in (``ARTICLE``,
    ``MAIN``, ``HEADING``, ``ELSEWHERE``); frames are left out."""
    lines: list[list] = []  # text, mark, number of the article
    parts: list[str] = []
    # Open block elements; an article or main begins a scope, which end tags inside
    # it do not leave.
    scopes: list[tuple[str, list[str], dict[str, int]]] = [("", [], {})]
    frame: tuple | None = None  # (kind, scopes, open blocks in the last, inline name) where the frame began
    inline_depth = 0
    met = in_link = heading = False
    number = 0
    linked: dict[int, int] = {}
    lettered: dict[int, int] = {}
    in_articles = in_mains = 0

    def end_line() -> None:
        if parts:
            text = " ".join("".join(parts).split())
            parts.clear()
            if text:
                mark = ARTICLE if in_articles else MAIN if in_mains else HEADING if heading else ELSEWHERE
                lines.append([text, mark, number if in_articles else 0])

    def drop(names: list[str], counts: dict[str, int]) -> str:
        gone = names.pop()
        counts[gone] -= 1
        return gone

    for text, name, closing, attributes in scan(html):
        if frame is None and text:
            text = entities.unescape(text) if "&" in text else text
            parts.append(text)
            if in_articles:
                lettered[number] = lettered.get(number, 0) + len(text)
                if in_link:
                    linked[number] = linked.get(number, 0) + len(text)
        if not name or name in RAW:
            continue
        kind = 0
        if not closing and name not in ALONE and (frame is None or name in ("article", "main")):
            kind = frame_kind(name, attributes, bool(in_articles))
        if frame is not None and name in ("article", "main") and not closing and not met and frame[0] == 1 and not kind:
            # The first article may stand in a header or behind a menu left open.
            frame = None
        if frame is None:
            if name in BLOCKS:
                end_line()
            elif name in ("br", "td", "th"):
                parts.append(" ")
            if name == "a":
                in_link = not closing
            elif name == "h1":
                heading = not closing
        if name in INLINE:
            if frame is None:
                if kind:
                    frame, inline_depth = (kind, len(scopes), len(scopes[-1][1]), name), 1
            elif frame[3] == name:
                inline_depth += -1 if closing else 1
                if not inline_depth:
                    frame = None
            continue
        if name in ALONE:
            continue
        _, names, counts = scopes[-1]
        if not closing:
            if name in BLOCKS and names and names[-1] == "p":
                drop(names, counts)
            ends = IMPLIED.get(name, ())
            while names and names[-1] in ends:
                drop(names, counts)
            if frame is not None and len(scopes) == frame[1] and (
                    len(names) < frame[2] if frame[3] else len(names) <= frame[2]):
                frame = None
                if name in BLOCKS:
                    end_line()
                kind = frame_kind(name, attributes, bool(in_articles))
            if frame is None and not kind and name in ("article", "main"):
                scopes.append((name, [], {}))
                met = True
                if name == "article":
                    in_articles += 1
                    number += in_articles == 1
                else:
                    in_mains += 1
                continue
            if frame is None and kind:
                frame = (kind, len(scopes), len(names), "")
            names.append(name)
            counts[name] = counts.get(name, 0) + 1
            continue
        if counts.get(name):
            while drop(names, counts) != name:
                pass
        elif name == "article" and in_articles or name == "main" and in_mains:
            while True:
                left = scopes.pop()[0]
                in_articles -= left == "article"
                in_mains -= left == "main"
                if left == name:
                    break
            in_link = heading = False
        if frame is not None:
            here = len(scopes[-1][1])
            if len(scopes) < frame[1] or len(scopes) == frame[1] and (here < frame[2] if frame[3] else here <= frame[2]):
                frame = None
                if name in BLOCKS:
                    end_line()
    end_line()
    teasers = {a for a, n in lettered.items() if 2 * linked.get(a, 0) > n}
    if not teasers or teasers >= {a for _, m, a in lines if m == ARTICLE}:
        teasers = set()
    return [(t, ELSEWHERE if a in teasers else m) for t, m, a in lines]


def _rows_of(a: list[int], b: list[int]) -> Iterator[int]:
    """Bit rows of the table of common subsequences: bit j of row i is 0 where b[j]
    lengthens the longest one of a[:i + 1] and b[:j]."""
    where: dict[int, int] = {}
    for j, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    row = full
    for x in a:
        hit = row & where.get(x, 0)
        row = (row + hit | row - hit) & full
        yield row


def _lengths(a: list[int], b: list[int]) -> list[int]:
    """Length of the longest common subsequence of a with b[:0], b[:1], ..."""
    row = (1 << len(b)) - 1
    for row in _rows_of(a, b):
        pass
    out = [0]
    for bit in reversed(format(row, f"0{len(b)}b") if b else ""):
        out.append(out[-1] + (bit == "0"))
    return out


#: Bits of table kept for one alignment; longer pages are halved first.
TABLE_BITS = 1 << 26


def common(a: list[int], b: list[int]) -> set[int]:
    """Positions in ``a`` of a longest common subsequence with ``b``."""
    out: set[int] = set()
    open_parts = [(0, a, b)]
    while open_parts:
        start, x, y = open_parts.pop()
        head = 0
        while head < len(x) and head < len(y) and x[head] == y[head]:
            out.add(start + head)
            head += 1
        tail = 0
        while tail < min(len(x), len(y)) - head and x[-1 - tail] == y[-1 - tail]:
            out.add(start + len(x) - 1 - tail)
            tail += 1
        x, y, start = x[head:len(x) - tail], y[head:len(y) - tail], start + head
        if not x or not y or set(x).isdisjoint(y):
            continue
        if len(x) * len(y) > TABLE_BITS and len(x) > 1:
            half = len(x) // 2
            front, back = _lengths(x[:half], y), _lengths(x[half:][::-1], y[::-1])[::-1]
            best = max(range(len(y) + 1), key=lambda j: front[j] + back[j])
            open_parts += [(start, x[:half], y[:best]), (start + half, x[half:], y[best:])]
            continue
        rows = list(_rows_of(x, y))
        i, j = len(x), len(y)
        while i and j:
            if rows[i - 1] >> (j - 1) & 1:
                j -= 1
            else:
                i -= 1
                if not i or rows[i - 1] >> (j - 1) & 1:
                    j -= 1
                    out.add(start + i)
    return out


def shared_lines(own: list[int], others: list[list[int] | None]) -> list[int]:
    """Positions of the lines shared with a neighbour that does not hold all of them."""
    gone: set[int] = set()
    for other in others:
        if other:
            same = common(own, other)
            if len(same) < len(own):
                gone |= same
    return sorted(gone)


def in_doubt(marks: list[int]) -> list[bool]:
    """Per line: whether differencing decides it. The others are text if they have
    the page's best mark, else none."""
    best = max(marks, default=ELSEWHERE)
    if best == HEADING:
        best = ELSEWHERE
    if best == ELSEWHERE:
        return [True] * len(marks)
    return [m != best and m != ELSEWHERE for m in marks]


def main_text(lines: list[tuple[str, int]], gone=()) -> str:
    marks = [m for _, m in lines]
    best, deleted = max(marks, default=ELSEWHERE), set(gone)
    return "\n".join(t for k, ((t, m), d) in enumerate(zip(lines, in_doubt(marks))) if (k not in deleted if d else m == best))


# --- tasks --------------------------------------------------------------------

#: A line's state: no text, text, or decided by differencing.
NO_TEXT, TEXT, DOUBT = range(3)


def line_states(marks: list[int]) -> list[int]:
    best = max(marks, default=ELSEWHERE)
    return [DOUBT if d else TEXT if m == best else NO_TEXT for m, d in zip(marks, in_doubt(marks))]


_READ = ("host string, path string, rest string, d1 long, d2 long, hashes array<long>, states array<byte>, "
         "lines array<string>")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import numpy as np
    import xxhash

    for batch in batches:
        first, second, hashes, states, kept = [], [], [], [], []
        for html in batch.column("html"):
            lines = read_lines(html.as_py() or "")
            own = np.array([xxhash.xxh3_64_intdigest(t.encode()) for t, _ in lines], np.uint64).view(np.int64)
            state = np.array(line_states([m for _, m in lines]), np.int8)
            d = np.frombuffer(xxhash.xxh3_128_digest(own.tobytes() + state.tobytes()), "<i8")
            first.append(int(d[0]))
            second.append(int(d[1]))
            hashes.append(own)
            states.append(state)
            kept.append([t for (t, _), s in zip(lines, state) if s != NO_TEXT])
        names = ["page_id", "url", "host", "path", "rest"]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in names], pa.array(first, pa.int64()), pa.array(second, pa.int64()),
             pa.array(hashes, pa.list_(pa.int64())), pa.array(states, pa.list_(pa.int8())), pa.array(kept, pa.list_(pa.string()))],
            [*names, "d1", "d2", "hashes", "states", "lines"])


_DIFFERENCE = "host string, d1 long, d2 long, kept array<boolean>"


def _difference(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per page with a line to delete: which of its lines stay."""
    for batch in batches:
        rows = ([], [], [], [])
        for host, d1, d2, own, states, before, after in zip(
                *(batch.column(c).to_pylist() for c in ("host", "d1", "d2", "hashes", "states", "before", "after"))):
            gone = {k for k in shared_lines(own, [before, after]) if states[k] == DOUBT}
            if gone:
                for out, x in zip(rows, (host, d1, d2, [k not in gone for k, s in enumerate(states) if s != NO_TEXT])):
                    out.append(x)
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows[0], pa.string()), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.int64()),
             pa.array(rows[3], pa.list_(pa.bool_()))], ["host", "d1", "d2", "kept"])


# --- the operator ---------------------------------------------------------------

def _read_pages(pages: DataFrame) -> DataFrame:
    """A row per page with its address, its lines and their hashes."""
    url = F.col("url").cast("string")
    address = r"^\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]+)([^?#]*)(.*)"
    # Views of one page differ in what these endings say, not in the path.
    path = F.regexp_replace(F.regexp_extract(url, address, 2), r"(?:/|\.html?)+$", "")
    rows = pages.select("page_id", url.alias("url"), F.lower(F.regexp_extract(url, address, 1)).alias("host"),
                        path.alias("path"), F.regexp_extract(url, address, 3).alias("rest"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(_read, f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, {_READ}")


def deleted_lines(read: DataFrame) -> DataFrame:
    """(host, d1, d2, kept) of the pages that lose a line to differencing."""
    order = ["host", "path", "rest", "d1", "d2"]
    named = read.where((F.col("host") != "") & (F.size("hashes") > 0))
    # Pages of a host with the same lines stand as one.
    one = (named.groupBy("host", "d1", "d2").agg(F.min(F.struct("path", "rest", "hashes", "states")).alias("x"))
           .select("host", "d1", "d2", "x.*"))
    placed = cut(one.repartitionByRange(shuffle_partitions(read.sparkSession), *order).sortWithinPartitions(*order)
                 .withColumn("pid", F.spark_partition_id()))
    row = F.struct(*order, "hashes")
    ends = cut(placed.groupBy("pid").agg(F.min(row).alias("first"), F.max(row).alias("last")))
    across = Window.orderBy("pid")  # a number per partition, without its lines
    beside = ends.select("pid").select("pid", F.lag("pid").over(across).alias("p"), F.lead("pid").over(across).alias("n"))
    beside = (beside.join(ends.select(F.col("pid").alias("p"), F.col("last").alias("prior")), "p", "left")
              .join(ends.select(F.col("pid").alias("n"), F.col("first").alias("next")), "n", "left")
              .select("pid", "prior", "next"))
    inside = Window.partitionBy("pid").orderBy(*order)
    near = placed.join(beside, "pid").select(
        "host", "d1", "d2", "hashes", "states", F.coalesce(F.lag(row).over(inside), "prior").alias("p"),
        F.coalesce(F.lead(row).over(inside), "next").alias("n"))
    near = near.select("host", "d1", "d2", "hashes", "states",
                       F.when(F.col("p.host") == F.col("host"), F.col("p.hashes")).alias("before"),
                       F.when(F.col("n.host") == F.col("host"), F.col("n.hashes")).alias("after"))
    return near.mapInArrow(_difference, _DIFFERENCE)


def extract_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages``."""
    read = land(_read_pages(pages))
    lost = land(deleted_lines(read)).withColumnsRenamed({"host": "h", "d1": "e1", "d2": "e2"})
    met = read.join(lost, (F.col("host") == F.col("h")) & (F.col("d1") == F.col("e1")) & (F.col("d2") == F.col("e2")), "left")
    text = F.array_join(F.when(F.col("kept").isNull(), F.col("lines")).otherwise(
        F.filter("lines", lambda x, i: F.get("kept", i))), "\n")
    return met.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
