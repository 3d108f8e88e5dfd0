"""Operator 4, HTML extraction by nearest-URL page differencing.

Every page is cut into text blocks in page order, each marked sure (inside article or main content),
never (navigation, header and footer, aside, form, script, style, advert, notice, comment section) or
open. Pages are range-sorted by host and URL path; each page is paired with that neighbour of its host
whose path shares the longer prefix, all blocks of both but the never ones are aligned by longest common
subsequence, and shared blocks are deleted, inside marked content too. The marks confirm: with sure blocks,
open ones are left out. The sort spreads a hot host over many tasks, and a task holds two pages at a time. A
page whose open blocks are all shared, or more than half of whose sure text is, is a copy of its neighbour and
keeps them.

Defined results: null html is empty and gives an empty text; a page alone on its host keeps its open
blocks; a page at the edge of a sorted part is lent to the next one, so no result depends on the parts; null or odd URLs form a host of
their own; repeated rows give repeated results; ties in path are ordered by page_id; extra columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# HTML element names.
BLOCKS = frozenset("address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section select summary table tbody td tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NEVER = frozenset("nav footer aside form script style head title noscript template button select option textarea svg iframe object dialog menu header".split())
SURE = frozenset("article main".split())
#: A tag that opens one of these ends an open element of the same set (unclosed li, p, td and so on).
IMPLIED = {"li": {"li"}, "p": {"p"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_HINT = re.compile(r"(?:^|[-_\s])(?:ad|ads|advert\w*|banner|sponsor\w*|promo\w*|cookie\w*|consent|notice|popup|modal|newsletter|subscribe|sidebar|side|menu|nav\w*|breadcrumb\w*|footer|masthead|site-header|comment\w*|disqus\w*|respond|reply|replies|share|sharing|social|related|widget|toolbar|skip\w*|pagination|copyright)(?:$|[-_\s])", re.I)
_ROLE = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
_SPACE = re.compile(r"\s+")
NEVER_MARK, OPEN_MARK, SURE_MARK = 0, 1, 2
#: Keys sampled for the bounds of the sorted parts: for each part, and in all (as Spark's range sort does).
PER_PART, MOST = 20, 1_000_000


class _Blocks(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, int]] = []
        self.mark, self.parts, self.out = OPEN_MARK, [], []

    def _flush(self) -> None:
        if self.parts:
            text = _SPACE.sub(" ", "".join(self.parts)).strip()
            self.parts = []
            if text and self.mark != NEVER_MARK:
                self.out.append((self.mark, text))

    def _set(self) -> None:
        self.mark = self.stack[-1][1] if self.stack else OPEN_MARK

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in IMPLIED:
            while self.stack and self.stack[-1][0] in IMPLIED[tag]:
                self._flush()
                self.stack.pop()
                self._set()
        inner = self.stack[-1][1] if self.stack else OPEN_MARK
        mark = inner
        if inner != NEVER_MARK:
            a = dict(attrs)
            named = f"{a.get('class') or ''} {a.get('id') or ''}"
            header = tag == "header" and any(t in SURE for t, _ in self.stack)  # an article's own heading stays
            if (tag in NEVER and not header) or "hidden" in a or a.get("aria-hidden") == "true" or (a.get("role") or "").lower() in _ROLE:
                mark = NEVER_MARK
            elif tag not in ("body", "html") and tag not in SURE and named != " " and _HINT.search(named):
                mark = NEVER_MARK
            elif tag in SURE or (a.get("role") or "").lower() == "main":
                mark = SURE_MARK
        if tag in BLOCKS or mark != inner:
            self._flush()
        if tag not in VOID:
            self.stack.append((tag, mark))
            self.mark = mark

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        if tag in BLOCKS:
            self._flush()

    def handle_endtag(self, tag: str) -> None:
        at = next((i for i in range(len(self.stack) - 1, -1, -1) if self.stack[i][0] == tag), None)
        if tag in BLOCKS or (at is not None and any(t in BLOCKS or m != self.mark for t, m in self.stack[at:])):
            self._flush()
        if at is not None:
            del self.stack[at:]
            self._set()

    def handle_data(self, data: str) -> None:
        if self.mark != NEVER_MARK:
            self.parts.append(data)


def blocks(html: str | None) -> list[tuple[int, str]]:
    """(mark, text) of every block that may belong to the main text, in page order."""
    if not html:
        return []
    p = _Blocks()
    p.feed(html)
    p.close()
    p._flush()
    return p.out


def _lengths(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of a longest common subsequence of a and every prefix of b, one row of the table at a time."""
    row = np.zeros(len(b) + 1, np.int32)
    for x in a:
        row[1:] = np.maximum.accumulate(np.maximum(row[1:], row[:-1] + (b == x)))
    return row


def shared(a: list[str], b: list[str]) -> set[int]:
    """Places in ``a`` on a longest common subsequence of the two lists: Hirschberg's halving, exact at every
    length in memory proportional to it."""
    both = set(a) & set(b)
    number = {x: i for i, x in enumerate(both)}
    ia = [i for i, x in enumerate(a) if x in both]
    na, nb = (np.fromiter((number[x] for x in y if x in both), np.int64) for y in (a, b))
    out: set[int] = set()
    todo = [(0, len(na), 0, len(nb))]
    while todo:
        i, j, k, m = todo.pop()
        while i < j and k < m and na[i] == nb[k]:  # equal ends belong to some longest one
            out.add(ia[i])
            i, k = i + 1, k + 1
        while i < j and k < m and na[j - 1] == nb[m - 1]:
            j, m = j - 1, m - 1
            out.add(ia[j])
        if i == j or k == m:
            continue
        if j - i == 1:
            if (nb[k:m] == na[i]).any():
                out.add(ia[i])
            continue
        half = (i + j) // 2
        cut = k + int((_lengths(na[i:half], nb[k:m]) + _lengths(na[half:j][::-1], nb[k:m][::-1])[::-1]).argmax())
        todo += [(i, half, k, cut), (half, j, cut, m)]
    return out


def main_text(own: list[tuple[int, str]], other: list[tuple[int, str]] | None) -> str:
    """The page's lines joined by a space, without those that the paired page shares. All lines of both pages are
    aligned; marks only confirm: with marked content, what lies outside is not the article. A page that shares all
    its open lines, or more than half of its marked text, is a copy of its neighbour and keeps them."""
    marked = any(m == SURE_MARK for m, _ in own)
    mine = [i for i, (m, _) in enumerate(own) if not marked or m == SURE_MARK]
    gone = shared([t for _, t in own], [t for _, t in other]).intersection(mine) if other else set()
    if marked:
        copy = 2 * sum(len(own[i][1]) for i in gone) > sum(len(own[i][1]) for i in mine)
    else:
        copy = len(gone) == len(mine)
    return " ".join(own[i][1] for i in mine if copy or i not in gone)


def _prefix(a: str, b: str) -> int:
    n = min(len(a), len(b))
    return next((i for i in range(n) if a[i] != b[i]), n)


def _null(v):
    return None if v is None or v != v else v


def _key(host: str, path: str, page_id) -> tuple:
    """The sort key of a page; a null id comes first, as in Spark."""
    page_id = _null(page_id)
    return host, path, page_id is not None, 0 if page_id is None else int(page_id)


def _keys(pdf: pd.DataFrame) -> list[tuple]:
    return [_key(*x) for x in zip(pdf["host"], pdf["path"], pdf["page_id"], strict=True)]


def _ends(bounds: list[tuple]):
    """First and last key of each part that a batch meets."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ends: dict[int, tuple[tuple, tuple]] = {}
        for pdf in batches:
            for k in _keys(pdf):
                part = bisect_right(bounds, k)
                low, high = ends.get(part, (k, k))
                ends[part] = min(low, k), max(high, k)
        yield pd.DataFrame([(part, *k) for part, both in ends.items() for k in both], columns=["part", "host", "path", "some", "page_id"])

    return run


def _cut(bounds: list[tuple], lent: dict[tuple, set[int]]):
    """Pages to their parts, as lines of mark and text; a page at the edge of a part is lent to the next part too."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for k, i, url, html in zip(_keys(pdf), pdf["page_id"], pdf["url"], pdf["html"], strict=True):
                lines = "\n".join(f"{m}{t}" for m, t in blocks(_null(html)))
                part = bisect_right(bounds, k)
                rows += [(p, k[0], k[1], _null(i), _null(url), lines, p != part) for p in (part, *lent.get(k, ()))]
            yield pd.DataFrame(rows, columns=["part", "host", "path", "page_id", "url", "lines", "lent"]).astype({"page_id": "Int64"})

    return run


def _pair(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by part, host and path; each is answered once its successor is known."""
    before = now = None  # ((part, host), path, page_id, url, blocks, lent)

    def answer(prev, row, after):
        near = [p for p in (prev, after) if p is not None and p[0] == row[0]]
        other = max(near, key=lambda p: _prefix(p[1], row[1]), default=None)
        text = main_text(row[4], other[4] if other else None)
        return row[2], row[3], text, len(text)

    def frame(out):
        return pd.DataFrame(out, columns=["page_id", "url", "text", "n_chars"]).astype({"page_id": "Int64"})

    for pdf in batches:
        out = []
        for part, host, path, i, url, lines, lent in zip(*(pdf[c] for c in ("part", "host", "path", "page_id", "url", "lines", "lent")), strict=True):
            row = ((part, host), path, _null(i), _null(url), [(int(x[0]), x[1:]) for x in lines.split("\n")] if lines else [], lent)
            if now is not None and not now[5]:
                out.append(answer(before, now, row))
            before, now = now, row
        yield frame(out)
    if now is not None and not now[5]:
        yield frame([answer(before, now, None)])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every page."""
    url = F.coalesce("url", F.lit(""))
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    path = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?[^/?#]*([^?#]*)", 1)
    rows = pages.select(host.alias("host"), path.alias("path"), "page_id", "url", "html")
    keys = rows.select("host", "path", "page_id")
    n = max(int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    # the parts' bounds come from a sample of keys, which decides how even the parts are and no result
    want = min(n * PER_PART, MOST)
    share = min(1.0, want / max(keys.count(), 1))
    some = sorted(_key(*r) for r in keys.sample(share, 7).limit(2 * want).collect())
    bounds = sorted({some[len(some) * i // n] for i in range(1, n)}) if some else []
    ends: dict[int, list[tuple]] = {}
    found = keys.mapInPandas(_ends(bounds), "part int, host string, path string, some boolean, page_id long")
    key = F.struct("host", "path", "some", "page_id")
    for r in found.groupBy("part").agg(F.min(key).alias("low"), F.max(key).alias("high")).collect():  # a row for each part
        ends[r["part"]] = [tuple(r["low"]), tuple(r["high"])]
    lent: dict[tuple, set[int]] = {}
    parts = sorted(ends)
    for p, q in zip(parts, parts[1:], strict=False):
        last, first = ends[p][1], ends[q][0]
        if last[0] == first[0]:
            lent.setdefault(last, set()).add(q)
            lent.setdefault(first, set()).add(p)
    rows = rows.mapInPandas(_cut(bounds, lent), "part int, host string, path string, page_id long, url string, lines string, lent boolean")
    rows = rows.repartitionById(n, F.col("part")).sortWithinPartitions("part", "host", "path", "page_id")
    return rows.mapInPandas(_pair, "page_id long, url string, text string, n_chars long")
