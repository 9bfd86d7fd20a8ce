"""Main text of web pages: nearest-URL page differencing, then a check by the page's structure.

Pages are dealt by ranges of (host, path) and sorted, so that each meets the pages of its host whose paths are nearest: the
one before it and the one after it (at the ends of a host, one of them). Each range also gets the last page of the range
before it and the first of the one after, so results don't depend on the ranges. The pages' text lines (blocks)
are aligned by a longest common subsequence, and shared lines are deleted, inside <article> and <main> too. What differencing
can't know the structure check mends: lines of the article come back where the neighbour is a copy (it repeats at least half
of the article's characters) or where the line is the page's <title> and not the neighbour's, and lines go that no neighbour
shares but that are not the article (menus, headers, footers, sidebars, notices, adverts, forms, reader comments, articles
inside such parts). Lines outside both are kept as far as differencing leaves them; without a neighbour only if there is no
article. All lines of the article come back if differencing would leave none of them, and of a page without one, all lines
outside such parts.

Edge cases: null html gives an empty text; a null url is a host of its own; pages without a neighbour are not differenced;
broken or unclosed markup is read as far as it goes; repeated rows and null ids are kept, one output row per input row; an
empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .fingerprints import _bucket

#: Elements without an end tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is not markup.
RAW = frozenset("script style textarea title noscript iframe template xmp".split())
#: Elements that are never part of an article's text.
OUT = frozenset("nav header footer aside form menu dialog button select head object svg canvas audio video map math datalist".split())
#: Elements that end a line before and after them.
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that end tags of inner ones don't reach through.
SCOPE = frozenset("html body article main section div nav header footer aside form table td th ul ol dl blockquote figure".split())
#: Words of class, id and role that mark what is not the article.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert popup "
    "modal overlay newsletter subscribe subscription signup login sidebar widget widgets menu nav navbar navigation breadcrumb breadcrumbs pagination pager "
    "header masthead topbar toolbar footer comment comments disqus respond replies share sharing social related recommended complementary contentinfo search".split()
)
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_NAME = re.compile(r"(/?)([a-zA-Z][^\s/><]*)")
_STOP, _END = re.compile(r"[\"'<>]"), re.compile(r"[<>]")
_ATTR = re.compile(r"""(?:^|[\s"'/])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)|(?=[\s/]|$))""", re.I)
_WORD = re.compile(r"[^a-z0-9]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


def _marked(attrs: str) -> bool:
    for m in _ATTR.finditer(attrs):
        name, value = m[1].lower(), (m[2] or "").strip("\"'").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and _HIDDEN.search(value):
            return True
        if name in ("class", "id", "role") and not MARKS.isdisjoint(_WORD.split(value)):
            return True
    return False


def _closed(html: str, i: int, last: dict[str, int], dead: set[int]) -> int:
    """Where the first > outside of quotes is, read from i on; -1 where a < or a quote that isn't closed comes before. dead: quotes
    from which this is so, which are not read again."""
    read = []
    while (s := _STOP.search(html, i)) and s.start() not in dead:
        if s[0] == ">":
            return s.start()
        if s[0] == "<" or s.start() >= last[s[0]]:
            break
        read.append(s.start())
        i = html.find(s[0], s.end()) + 1
    dead.update(read)
    return -1


def next_tag(html: str, at: int, last: dict[str, int], dead: set[int] | None = None) -> tuple[int, int, str, str, str] | None:
    """(start, end, "/" or "", name, attributes) of the next tag, comment or declaration (these without a name).

    A tag ends at the first > outside of quotes, however long what is in quotes is. Where a quote is not closed (`last`: the last place of
    each kind of quote) or another tag begins before, its name ends before the last quote in it from which on there is such a >; without
    one, it ends at the first >, if no < comes before; else its < is text. dead: see _closed, kept from tag to tag."""
    dead = set() if dead is None else dead
    while (p := html.find("<", at)) >= 0:
        if html.startswith("<!--", p):
            end = html.find("-->", p + 4)
            return p, end + 3 if end >= 0 else len(html), "", "", ""
        if html[p + 1 : p + 2] in ("!", "?"):
            end = html.find(">", p)
            return p, end + 1 if end >= 0 else len(html), "", "", ""
        if m := _NAME.match(html, p + 1):
            i = m.end()
            end = _closed(html, i, last, dead)
            if end < 0:
                for q in [m.start(2) + j for j, c in enumerate(m[2]) if c in last][::-1]:
                    if q not in dead and (end := _closed(html, q, last, dead)) >= 0:
                        i = q
                        break
            if end < 0 and (s := _END.search(html, i)) and s[0] == ">":
                end = s.start()
            if end >= 0:
                return p, end + 1, m[1], html[m.start(2) : i], html[i:end]
        at = p + 1
    return None


#: What a line is: the article's, of no known part, of a part that is not the article, of an article inside such a part (only
#: while a page is read), or the article's and the page's title.
ARTICLE, LOOSE, OTHER, NESTED, TITLE = range(5)


def page_lines(html: str) -> list[tuple[str, int]]:
    """The page's lines in order, each with what it is; white space within a line is one space."""
    lines: list[tuple[str, int]] = []
    text: list[str] = []
    stack: list[tuple[str, int]] = []  # element and the kind of what stands in it
    places: dict[str, list[int]] = {}  # where in the stack the elements of a name are
    scopes: list[int] = []
    n_out = 0
    kind = LOOSE
    title = ""

    def end_line() -> None:
        if text:
            line = " ".join(unescape("".join(text)).split())
            text.clear()
            if line:
                lines.append((line, kind))

    def cut(to: int, line: bool = True) -> None:
        """Close the elements from this place of the stack on."""
        nonlocal n_out
        if line and any(x[1] != stack[to][1] for x in stack[to:]):
            end_line()
        for x, _ in stack[to:]:
            places[x].pop()
            n_out -= x in OUT
        del stack[to:]
        while scopes and scopes[-1] >= to:
            scopes.pop()

    at, n = 0, len(html)
    last, dead = {q: html.rfind(q) for q in "\"'"}, set()
    while at < n:
        tag = next_tag(html, at, last, dead)
        if not tag:
            text.append(html[at:])
            break
        start, end, closing, name, attrs = tag
        if start > at:
            text.append(html[at:start])
        at, name = end, name.lower()
        if not name:
            continue
        if name in BLOCK:
            end_line()
        if closing:
            # The innermost open element of the name, if no scope that it doesn't reach through lies inside of it.
            if (own := places.get(name)) and (name in SCOPE or not scopes or scopes[-1] <= own[-1]):
                cut(own[-1])
            kind = stack[-1][1] if stack else LOOSE
            continue
        if name in RAW:
            if attrs.rstrip().endswith("/") and name not in ("script", "style"):
                continue
            end = re.compile(rf"</{name}\s*>", re.I).search(html, at)
            if name == "title" and not title:
                title = " ".join(unescape(html[at : end.start() if end else n]).split())
            at = end.end() if end else n
            continue
        if name in VOID or attrs.endswith("/") and name not in BLOCK:
            continue
        closes = _CLOSES.get(name) or ({"p"} if name in BLOCK and name != "br" else None)
        if closes:
            base = scopes[-1] if scopes else -1
            ends = [own[i] for c in closes if (own := places.get(c)) and (i := bisect_right(own, base)) < len(own)]
            if ends:
                cut(min(ends), False)
        outer = stack[-1][1] if stack else LOOSE
        if name in ("article", "main"):
            if outer == OTHER and n_out or outer != LOOSE and _marked(attrs):
                inner = OTHER
            else:
                inner = NESTED if outer in (OTHER, NESTED) else ARTICLE
        elif name in OUT or name not in ("html", "body") and _marked(attrs):
            inner = OTHER
        else:
            inner = outer
        if inner != kind:
            end_line()
        places.setdefault(name, []).append(len(stack))
        if name in SCOPE:
            scopes.append(len(stack))
        n_out += name in OUT
        stack.append((name, inner))
        kind = inner
    end_line()
    # An article in a marked part is a teaser, unless the page has no other article and most of its text there (the mark is of the layout).
    size = lambda what: sum(len(x) for x, k in lines if k == what)
    nested = ARTICLE if not size(ARTICLE) and size(NESTED) > size(LOOSE) else OTHER
    lines = [(x, nested if k == NESTED else k) for x, k in lines]
    return [(x, TITLE if k == ARTICLE and x == title else k) for x, k in lines]


def _rows(a: list[int], b: list[int], keep: bool) -> list[int]:
    """Rows of the table of longest common subsequences of a's prefixes and b, as bits: 0 where a prefix of b has one line more in
    common than the next shorter one. All rows, or the last."""
    where: dict[int, int] = {}
    for j, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    v, out = full, []
    for x in a:
        u = v & where.get(x, 0)
        v = (v + u | v - u) & full
        if keep:
            out.append(v)
    return out if keep else [v]


def _lengths(row: int, n: int) -> np.ndarray:
    """Of each prefix of n lines how many it has in common, from a row."""
    bits = np.unpackbits(np.frombuffer(row.to_bytes(n // 8 + 1, "little"), np.uint8), bitorder="little")[:n]
    return np.concatenate([[0], np.cumsum(bits == 0)])


#: Bits of a table of rows that is kept; larger ones are halved (Hirschberg), so memory is linear.
TABLE = 1 << 28


def _aligned(a: list[int], b: list[int]) -> list[int]:
    """Indices in a of a longest common subsequence of a and b."""
    if not a or not b:
        return []
    if len(a) * len(b) > TABLE and len(a) > 1:
        mid = len(a) // 2
        upper = _lengths(_rows(a[:mid], b, False)[0], len(b))
        lower = _lengths(_rows(a[mid:][::-1], b[::-1], False)[0], len(b))[::-1]
        j = int((upper + lower).argmax())
        return _aligned(a[:mid], b[:j]) + [mid + i for i in _aligned(a[mid:], b[j:])]
    rows, out, i, j = _rows(a, b, True), [], len(a), len(b)
    while i and j:
        if rows[i - 1] >> j - 1 & 1:
            j -= 1
            continue
        i -= 1
        if not (i and not rows[i - 1] >> j - 1 & 1):
            j -= 1
            out.append(i)
    return out[::-1]


def common_lines(a: list[str], b: list[str]) -> set[int]:
    """Indices in a of a longest common subsequence of a and b: equal ends, then bit-parallel rows for what is between."""
    lo, most = 0, min(len(a), len(b))
    while lo < most and a[lo] == b[lo]:
        lo += 1
    hi = 0
    while hi < most - lo and a[-1 - hi] == b[-1 - hi]:
        hi += 1
    number: dict[str, int] = {}
    x, y = ([number.setdefault(t, len(number)) for t in part[lo : len(part) - hi]] for part in (a, b))
    # Lines that the other page doesn't have can't be aligned.
    both = set(x) & set(y)
    at = [i for i, t in enumerate(x) if t in both]
    inner = _aligned([x[i] for i in at], [t for t in y if t in both])
    return {*range(lo), *(lo + at[i] for i in inner), *range(len(a) - hi, len(a))}


def main_text(lines: list[tuple[str, int]], *neighbours: list[tuple[str, int]]) -> str:
    """The page's text after differencing from each neighbour and the structure check."""
    texts = [x for x, _ in lines]
    article = [i for i, (_, kind) in enumerate(lines) if kind in (ARTICLE, TITLE)]
    loose = [i for i, (_, kind) in enumerate(lines) if kind == LOOSE]
    size = sum(len(texts[i]) for i in article)
    gone: set[int] = set()
    for other in neighbours:
        shared = common_lines(texts, [x for x, _ in other])
        again = shared.intersection(article)
        # The check: what a copy repeats and the page's own title stay in the article.
        copied = 2 * sum(len(texts[i]) for i in again) >= size
        gone |= shared - {i for i in again if copied or lines[i][1] == TITLE and lines[i] not in other}
    own = [i for i in article if i not in gone] or article
    rest = [i for i in loose if i not in gone] if neighbours or not article else []
    return " ".join(texts[i] for i in sorted(own + rest) or loose)


#: Pages' keys drawn for each range's bounds.
DRAWN = 50


def _ranges(rows: DataFrame) -> DataFrame:
    """rows (with key) dealt by ranges of key and sorted, with bucket, side (1: own; 0 and 2: the page before the range and the one after it) and h."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets, n = 2 * parts, rows.count()
    drawn = sorted({r[0] for r in rows.select("key").sample(min(1.0, DRAWN * buckets / max(n, 1)), 1).limit(2 * DRAWN * buckets).collect()})
    bounds = sorted({drawn[len(drawn) * i // buckets] for i in range(1, buckets)}) if drawn else []
    own = rows.withColumns({"bucket": _bucket(F.col("key"), bounds), "side": F.lit(1), "h": F.xxhash64("html")})
    # One row for each bucket: the number of buckets is set above.
    ends = own.groupBy("bucket").agg(F.min("key"), F.max("key")).orderBy("bucket").collect()
    both = own
    for side, at, of, pick in ((0, 1, 2, F.max), (2, -1, 1, F.min)):
        to = {ends[i][of]: ends[i + at][0] for i in range(len(ends)) if 0 <= i + at < len(ends)}
        if to:
            place = F.create_map(*[F.lit(v) for kv in to.items() for v in kv])[F.col("key")]
            halo = own.where(F.col("key").isin(list(to))).groupBy("key").agg(pick(F.struct("h", *rows.drop("key").columns)).alias("m"))
            both = both.unionByName(halo.select(place.alias("bucket"), F.lit(side).alias("side"), "key", "m.*"))
    return both.repartitionById(buckets, "bucket").sortWithinPartitions("bucket", "side", "key", "h")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row of pages: page_id, url, text, n_chars."""
    url = F.coalesce(F.col("url"), F.lit(""))
    rows = common.pick(pages, page_id=id_col, url=url_col, html=html_col).select(
        "page_id", "url", "html", F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)).alias("host"), F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1).alias("path")
    )
    number = F.lpad(F.coalesce(F.col("page_id").cast("string"), F.lit("")), 20, "0")
    ordered = _ranges(rows.withColumn("key", F.concat_ws("\0", "host", "path", number)))

    def run(batches):
        place = None  # the bucket
        before: tuple | None = None  # the page before the waiting one: host, lines
        waiting: tuple | None = None  # the last page so far: id, url, host, lines

        def finish(after: tuple | None) -> tuple:
            page, u, host, lines = waiting
            return page, u, main_text(lines, *(x[1] for x in (before, after) if x is not None and x[0] == host))

        def out(kind, rows):
            texts = [x[2] for x in rows]
            return pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in rows], kind), pa.array([x[1] for x in rows], pa.string()), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

        kind = None
        for batch in batches:
            kind = batch.schema.field(0).type
            for part in common.slices(batch, "html"):
                done = []
                for page, u, html, host, bucket, side in zip(*(part.column(i).to_pylist() for i in range(6)), strict=True):
                    lines = page_lines(html or "")
                    if waiting:
                        done.append(finish((host, lines) if bucket == place else None))
                        before = waiting[2], waiting[3]
                    if bucket != place:
                        place, before = bucket, None
                    if side == 0:
                        before = host, lines
                    waiting = (page, u, host, lines) if side == 1 else None
                if done:
                    yield out(kind, done)
        if waiting:
            yield out(kind, [finish(None)])

    return ordered.select("page_id", "url", "html", "host", "bucket", "side").mapInArrow(run, f"page_id {rows.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6 over the whole of pages."""
    return extract(common.table(spark, sf_dir, "pages"))
