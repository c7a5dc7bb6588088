"""HTML extraction by nearest-URL page differencing."""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape
from itertools import accumulate

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, LongType, StringType, StructField, StructType

from strataflow.llm.arrow import by_bytes, in_arrow
from strataflow.llm.scratch import stored

# HTML's elements without an end tag, those whose content is no text, those that
# start a block, and the names by which pages mark what is not the main text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea iframe svg math object canvas select title".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody tfoot thead tr ul".split())
JUNK_TAGS = frozenset("aside button dialog footer form head menu nav".split())
JUNK_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
JUNK_NAMES = frozenset("ad ads adv advert adverts advertisement advertising alert banner breadcrumb breadcrumbs captcha comment comments commentlist consent cookie cookies disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promoted promotion related replies reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe toolbar topbar widget widgets".split())
MAIN_NAMES = frozenset("articlebody article-body article-content entry-content post-body post-content main-content story-body".split())
CLOSED_BY = {"p": BLOCK - {"body", "html"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}, "head": {"body", "article", "div", "main", "p", "nav", "header"}}

_NAME = re.compile(r"</?([A-Za-z][^\s/>]*)")
_RAW_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW}
_STOP = re.compile("[>\"']")
_ATTR = re.compile(r"""(?<![a-z-])([a-z-]++)\s*+=\s*+(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|\b(hidden)\b""", re.I)
_NAME_SPLIT = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[A-Z])")

#: Pairs of equal lines up to which a longest common subsequence is traced pair by pair.
MOST_MATCHES = 1 << 16

#: Where a line stands: in what is marked as no main text, in nothing marked, in the article.
JUNK, PLAIN, ARTICLE = 0, 1, 2


def _marked(name: str, more: str, in_article: bool) -> int | None:
    """The zone that an element opens, None if it goes on with its parent's."""
    attrs = {(m[1] or m[5]).lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(more)} if more.strip() else {}
    if name in JUNK_TAGS or name == "header" and not in_article:
        return JUNK
    if "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attrs.get("style", ""), re.I):
        return JUNK
    if name in ("html", "body"):
        return None
    named = f"{attrs.get('class', '')} {attrs.get('id', '')}"
    words = {w.lower() for w in _NAME_SPLIT.split(named) if w}
    if attrs.get("role", "").lower() in JUNK_ROLES or words & (JUNK_NAMES - {"header"} if in_article else JUNK_NAMES):
        return JUNK
    if name in ("article", "main") or attrs.get("role", "").lower() == "main" or attrs.get("itemprop", "").lower() == "articlebody" or {w.lower() for w in named.split()} & MAIN_NAMES:
        return ARTICLE
    return None


def pieces(html: str) -> Iterator[tuple[str, str, str]]:
    """A page as ("", text, ""), ("<", name, attributes) and ("</", name, ""), without comments, declarations and elements that hold no text.

    A ``>`` in quotes does not end a tag. From the first quote on that nothing closes, or behind which no tag ends,
    quotes count for nothing, so that a page is gone through once whatever is in it. A page cut off in a tag ends before it.
    """
    at, last, quotes = 0, html.rfind(">"), True
    while (lt := html.find("<", at)) >= 0:
        if lt > at:
            yield "", html[at:lt], ""
        head = html[lt + 1 : lt + 3]
        if html.startswith("<!--", lt):
            end = html.find("-->", lt + 4)
            at = len(html) if end < 0 else end + 3
            continue
        m = _NAME.match(html, lt)
        if lt > last:
            if m and head[0] != "/" and html.find("<", lt + 1) < 0:
                return
        elif m:
            name = m[1].lower()
            end = -1
            if quotes:
                i = m.end()
                while stop := _STOP.search(html, i):
                    if stop[0] == ">":
                        end = stop.start()
                        break
                    close = html.find(stop[0], stop.end())
                    if close < 0:
                        break
                    i = close + 1
                quotes = end >= 0
            if end < 0:
                end = html.find(">", m.end())
            at = end + 1
            more = html[m.end() : end]
            if head[0] == "/":
                yield "</", name, ""
            elif name not in RAW:
                yield "<", name, more
            elif not (name in ("svg", "math") and more.endswith("/")):
                closed = _RAW_END[name].search(html, at)
                at = closed.end() if closed else len(html)
            continue
        elif head[:1] in ("!", "?", "/"):
            at = html.find(">", lt) + 1
            continue
        yield "", "<", ""
        at = lt + 1
    if at < len(html):
        yield "", html[at:], ""


def page_lines(html: str) -> list[tuple[str, int]]:
    """Text and zone of each block of a page, white space as one space, empty blocks left out.

    End tags that fit nothing are ignored, elements left open end with their parent.
    """
    out: list[tuple[str, int]] = []
    stack: list[tuple[str, int]] = []  # open elements and their zones
    within: Counter = Counter()  # how many of each name are open
    text: list[str] = []
    zone = PLAIN

    def close() -> None:
        line = " ".join(unescape("".join(text)).split())
        if line:
            out.append((line, zone))
        text.clear()

    def leave() -> str:
        name = stack.pop()[0]
        within[name] -= 1
        return name

    for kind, name, more in pieces(html):
        if not kind:
            text.append(name)
            continue
        if name in ("br", "td", "th", "wbr", "img"):
            text.append(" " if name != "wbr" else "")
        if name in VOID:
            if name == "hr":
                close()
            continue
        if kind == "</":
            if not within[name]:
                continue
            if name in BLOCK:
                close()
            while leave() != name:
                pass
        else:
            if name in BLOCK:
                close()
            while stack and name in CLOSED_BY.get(stack[-1][0], ()):
                leave()
            if name in BLOCK:  # inline elements left open in a paragraph that ends here
                while stack and stack[-1][0] in ("b", "i", "em", "strong", "a", "span", "u", "font", "small") and within["p"]:
                    leave()
                while stack and name in CLOSED_BY.get(stack[-1][0], ()):
                    leave()
            now = stack[-1][1] if stack else PLAIN
            if now != JUNK:
                marked = _marked(name, more, within["article"] > 0)
                now = now if marked is None else marked
            if not more.endswith("/"):
                stack.append((name, now))
                within[name] += 1
        zone = stack[-1][1] if stack else PLAIN
    close()
    return out


def common_lines(a: list[int], b: list[int]) -> set[int]:
    """Places in ``a`` of a longest common subsequence with ``b``.

    Few pairs of equal lines are traced one by one. With many, as of pages that repeat a line thousands of
    times, ``a`` is halved where the halves' subsequences are longest together.
    """
    out: set[int] = set()
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, j, k, m = todo.pop()
        while i < j and k < m and a[i] == b[k]:
            out.add(i)
            i, k = i + 1, k + 1
        while i < j and k < m and a[j - 1] == b[m - 1]:
            out.add(j - 1)
            j, m = j - 1, m - 1
        if i == j or k == m:
            continue
        times = Counter(b[k:m])
        if j - i == 1:
            out |= {i} if times[a[i]] else set()
        elif sum(times[x] for x in a[i:j]) <= MOST_MATCHES:
            out |= _traced(a, i, j, b, k, m)
        else:
            half = (i + j) // 2
            ahead, behind = _lengths(a[i:half], b[k:m]), _lengths(a[half:j][::-1], b[k:m][::-1])[::-1]
            cut = k + max(range(m - k + 1), key=lambda x: ahead[x] + behind[x])
            todo += [(i, half, k, cut), (half, j, cut, m)]
    return out


def _lengths(a: list[int], b: list[int]) -> list[int]:
    """Length of a longest common subsequence of ``a`` with each beginning of ``b``, all of them at once in the bits of a number."""
    where: dict[int, int] = {}
    for j, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    row = full
    for x in a:
        hit = row & where.get(x, 0)
        row = (row + hit | row - hit) & full
    return [0, *accumulate(int(x == "0") for x in reversed(f"{row:0{len(b)}b}"))] if b else [0]


def _traced(a: list[int], i: int, j: int, b: list[int], k: int, m: int) -> set[int]:
    """Places from ``i`` to ``j`` of a longest common subsequence with ``b[k:m]``, by increasing places in ``b``."""
    places: dict[int, list[int]] = {}
    for y in range(m - 1, k - 1, -1):
        places.setdefault(b[y], []).append(y)
    ends: list[int] = []  # smallest last place in b of a common subsequence of each length
    links: list[tuple[int, tuple | None]] = []
    for x in range(i, j):
        for y in places.get(a[x], ()):
            n = bisect_left(ends, y)
            link = (x, links[n - 1] if n else None)
            if n == len(ends):
                ends.append(y)
                links.append(link)
            else:
                ends[n], links[n] = y, link
    out, node = set(), links[-1] if links else None
    while node:
        out.add(node[0])
        node = node[1]
    return out


def _hash(line: str) -> int:
    return xxhash.xxh3_64_intdigest(line) - (1 << 63)


def _likeness(a: str, b: str) -> int:
    """Leading characters that two paths share."""
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


@dataclass
class _Page:
    page_id: object
    url: str | None
    host: str
    path: str
    lines: list[str]
    zones: list[int]
    hashes: list[int]

    def partner(self, *others: _Page | None) -> _Page | None:
        """Of the nearest pages before and behind it on its host that are no copy of it, the one with the nearest path; of equal ones the first."""
        fit = [o for o in others if o and o.host == self.host and o.hashes != self.hashes]
        return max(fit, key=lambda o: _likeness(self.path, o.path), default=None)

    def text(self, partner: _Page | None) -> str:
        return main_text(self.lines, self.zones, self.hashes, partner.hashes if partner else [])


def main_text(lines: list[str], zones: list[int], hashes: list[int], partner: list[int]) -> str:
    """Lines left after those shared with the partner page are deleted, and those marked as no main text.

    Lines of an article element are not deleted for being shared: else two copies of an article at
    neighbouring URLs would erase each other. A page with such lines consists of them; of a page
    without any, the unmarked lines that its neighbour has not are its text.
    """
    shared = common_lines(hashes, partner) if partner else set()
    left = [i for i in range(len(lines)) if zones[i] == ARTICLE or zones[i] == PLAIN and i not in shared]
    if any(zones[i] == ARTICLE for i in left):
        left = [i for i in left if zones[i] == ARTICLE]
    return "\n".join(lines[i] for i in left)


def pack_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches with their third column, texts, compressed one by one; null is empty."""
    for batch in batches:
        for part in by_bytes(batch):
            packed = pa.array([zlib.compress((x or "").encode(), 6) for x in part.column(2).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([packed if i == 2 else c for i, c in enumerate(part.columns)], names=["packed" if i == 2 else n for i, n in enumerate(part.schema.names)])


def _digest(hashes: list[int]) -> int:
    return xxhash.xxh3_64_intdigest(repr(hashes)) - (1 << 63)


def _beside(faces: list[tuple[int, int, int, str, int, bool]]) -> list[tuple[int, int, int, int, bool]]:
    """For the first and last row of equal pages of each range, where the page before and behind it is found.

    ``faces`` are (range, face, at, host, digest of lines, whether the range has a page of its host next to it)
    of each range's first and last page, ascending. What is found is the last or first page (face 2 or 1) of another
    range or, with ``inner``, the page next to the row that this one belongs to, past any number of ranges of
    equal pages.
    """
    ranges: dict[int, dict[int, tuple]] = {}
    for r, face, *rest in faces:
        for f in (1, 2) if face == 3 else (face,):
            ranges.setdefault(r, {})[f] = tuple(rest)
    out = [(r, f[k][0], r, k, True) for r, f in ranges.items() for k in (1, 2) if f[k][0] == k - 1 and f[k][3]]
    for here, there, order in ((1, 2, sorted(ranges)), (2, 1, sorted(ranges, reverse=True))):
        last: tuple | None = None  # range, host, digest of the range next to this one on that side, and what lies beyond its outer row
        for r in order:
            at, host, digest, _ = ranges[r][here]
            target = None
            if last and last[1] == host:
                target = last[3] if last[2] == digest else (last[0], there, False)
            if target:
                out.append((r, at, *target))
            outer_at, outer_host, outer_digest, known = ranges[r][there]
            last = (r, outer_host, outer_digest, target if outer_at == 2 else (r, there, True) if known else None)
    return out


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id_col``, ``url_col``, ``text`` and ``n_chars`` of the main text of each page.

    Pages are dealt by ranges of (host, path, id, html, place), so that a host with many pages, or a page
    that comes many times, takes many tasks; each is compared with the nearest page before and behind it that has other lines, so that
    equal pages in a row have the same two. The first and last such row of a range are compared with
    the ranges beside it in a second step over those pages alone. Pages
    without a host share an empty one; null html is empty text; null ids, repeated rows and equal
    URLs (ordered by id, then html) are pages like any other; an empty table gives an empty result.
    """
    u = F.coalesce(F.col(url_col), F.lit(""))
    rows = df.select(
        F.col(id_col), F.col(url_col), F.col(html_col),
        F.lower(F.regexp_extract(u, "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)).alias("host"),
        F.regexp_extract(u, "^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^#]*)", 1).alias("path"),
        F.xxhash64(html_col).alias("tie"), F.monotonically_increasing_id().alias("place"),
    )
    kind = df.schema[id_col].dataType
    arrow_kind = to_arrow_type(kind)
    hashes = ArrayType(LongType())
    schema = StructType([StructField(id_col, kind), StructField(url_col, StringType()), StructField("text", StringType()), StructField("edge", BooleanType()), StructField("at", LongType()), StructField("host", StringType()), StructField("path", StringType()), StructField("lines", ArrayType(StringType())), StructField("zones", hashes), StructField("hashes", hashes), StructField("near_path", StringType()), StructField("near", hashes), StructField("face", LongType()), StructField("digest", LongType())])
    kinds = [arrow_kind, pa.string(), pa.string(), pa.bool_(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.string(), pa.list_(pa.int64()), pa.int64(), pa.int64()]

    def rows_of(pages: list[tuple]) -> pa.RecordBatch:
        """``at`` is null for a page that is done; else 0 for the first row of equal pages of a range and 1 for the last, 2 for one that is both.

        ``face`` is 1 for the first page of a range, 2 for the last, 3 for one that is both, else 0; only those list hashes.
        """
        out = []
        for p, near, edge, face in pages:
            if edge is None:
                out.append((p.page_id, p.url, p.text(near), False, *[None] * 10))
            else:
                known = (p.hashes, near.path if near else None, near.hashes if near else None, face, _digest(p.hashes)) if face else (None, None, None, 0, None)
                out.append((p.page_id, p.url, None, True, edge, p.host, p.path, p.lines, p.zones, *known))
        columns = list(zip(*out, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        equal: list[_Page] = []
        done: list = []
        size = 0

        def close(behind: _Page | None) -> Iterator[pa.RecordBatch]:
            nonlocal size
            edge = (2 if before is None else 1) if behind is None else 0 if before is None else None
            for i, p in enumerate(equal):
                face = (before is None and i == 0) + 2 * (behind is None and i == len(equal) - 1)
                done.append((p, p.partner(before, behind), edge, face))
                size += sum(map(len, p.lines)) + 64 * len(p.lines)
                if size > 4 << 20 or len(done) >= 1000:
                    yield rows_of(done)
                    done.clear()
                    size = 0

        for batch in batches:
            for part in by_bytes(batch):
                for doc, url, raw, host, path in zip(*[part.column(i).to_pylist() for i in range(5)], strict=True):
                    got = page_lines(zlib.decompress(raw).decode())
                    page = _Page(doc, url, host or "", path or "", [x for x, _ in got], [z for _, z in got], [_hash(x) for x, _ in got])
                    if equal and page.host == equal[0].host and page.hashes == equal[0].hashes:
                        first = equal[0]  # one copy of the lines, however many pages have them
                        page.lines, page.hashes, page.zones = first.lines, first.hashes, first.zones if page.zones == first.zones else page.zones
                    elif equal:
                        yield from close(page)
                        before, equal = equal[-1], []
                    equal.append(page)
        if equal:
            yield from close(None)
            if done:
                yield rows_of(done)

    # A page is compressed by itself before it is dealt: half of what the shuffle's own codec leaves.
    fields = [StructField(id_col, kind), StructField(url_col, StringType()), StructField("packed", BinaryType()), StructField("host", StringType()), StructField("path", StringType()), StructField("tie", LongType()), StructField("place", LongType())]
    rows = rows.transform(in_arrow, pack_pages, StructType(fields))
    ranged = rows.repartitionByRange(F.col("host"), F.col("path"), F.col(id_col), F.col("tie"), F.col("place")).sortWithinPartitions("host", "path", id_col, "tie")
    table = stored(ranged.transform(in_arrow, run, schema).withColumn("range", F.spark_partition_id()), "pages", level=12)
    faces = sorted((r["range"], r["face"], r["at"], r["host"], r["digest"], r["known"]) for r in table.filter("face > 0").select("range", "face", "at", "host", "digest", F.col("near").isNotNull().alias("known")).collect())
    edges = table.filter("edge")
    links = df.sparkSession.createDataFrame(_beside(faces), "range int, at long, other_range int, face long, inner boolean")
    sides = table.filter("face > 0").withColumn("face", F.explode(F.when(F.col("face") == 3, F.array(F.lit(1).cast("long"), F.lit(2).cast("long"))).otherwise(F.array("face"))))
    others = sides.select(F.col("range").alias("other_range"), "face", "path", "hashes", "near_path", "near")
    beside = F.broadcast(links).join(others, ["other_range", "face"]).select("range", "at", F.when(F.col("inner"), F.struct(F.col("near_path").alias("path"), F.col("near").alias("hashes"))).otherwise(F.struct("path", "hashes")).alias("o")).groupBy("range", "at").agg(F.collect_list("o").alias("beside"))
    open_ = edges.join(F.broadcast(beside), ["range", "at"], "left").select(id_col, url_col, "host", "path", "lines", "zones", "beside")
    final = StructType([StructField(id_col, kind), StructField(url_col, StringType()), StructField("text", StringType())])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch, 1 << 20):
                out = []
                for r in part.to_pylist():
                    page = _Page(r[id_col], r[url_col], r["host"], r["path"], r["lines"], r["zones"], [_hash(x) for x in r["lines"]])
                    other = [_Page(None, None, page.host, o["path"], [], [], o["hashes"]) for o in r["beside"] or []]
                    out.append((page.page_id, page.url, page.text(page.partner(*sorted(other, key=lambda o: (o.path, o.hashes))))))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=False)], names=final.names)

    text = table.filter("not edge").select(id_col, url_col, "text").union(open_.transform(in_arrow, finish, final))
    return text.select(id_col, url_col, "text", F.length("text").cast("long").alias("n_chars"))
