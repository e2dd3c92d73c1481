"""Main text of pages, by differencing each page against its nearest-URL neighbour.

The pages of a host are put in the order of their URL paths; the neighbour of a
page is the one before or after it whose path shares the longer beginning;
copies, which are pages with the same lines, are passed over, as they would
delete each other's whole text. The text lines (blocks) of the two pages are aligned by a longest common
subsequence, and the lines that they share are deleted: menus, notices and
footers repeat from page to page, the article does not.

What differencing leaves decides about everything that a page does not say itself:

* Elements whose tag or role, or whose class and id alone, say that they are never the
  article (menus, headers, footers, sidebars, forms, comments, adverts, notices,
  scripts, styles) are no text at all.
* Elements with such a word among others in class or id (as `notice-board related`)
  are only suspects: their lines go if the neighbour has them too, else they stay.
* On a page without a marked article (article, main, or such a role), and outside
  of one, every line that the neighbour shares goes.
* A marked article is the text, unless more text than it has is left outside: then the
  mark was a teaser's and what is left outside is the text. Of several marked
  articles, those that the neighbour has whole go if another is left.

Lines of a marked article that are no suspects stay, shared or not: pages quote each
other, and a page must not lose its sentences to one that copied them.

The parser reads a page once from start to end, whatever its faults.

The order over all pages is computed by a range sort of keys and a global
number, so that a host of any size is spread over tasks; the neighbours' lines
are sent as hashes.

Defined results: a null or empty html gives an empty text; a page without a
neighbour in its host, or with copies only, is not differenced; rows that are equal in page_id, url
and html have one neighbour set and give a row each. Other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import in_chunks, materialize, small_batches, strings
from .url_filter import host_of, path_of

# Elements by their role in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea iframe svg math object canvas title select".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
NEVER = frozenset("nav footer aside form button dialog menu head fieldset".split())
ARTICLE = frozenset("article main".split())
NEVER_ROLES = frozenset("navigation banner contentinfo complementary dialog alertdialog alert search form menu menubar".split())
NEVER_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices notification popup modal overlay"
    " newsletter subscribe signup paywall social share sharing comment comments commentlist disqus reply replies respond discussion sidebar aside menu nav navbar navigation breadcrumb"
    " breadcrumbs pager pagination related recommended recommendations widget footer masthead toolbar skip".split()
)
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME = re.compile(r"[a-z]+")
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_MAIN = re.compile(r"role\s*=\s*[\"']?(?:main|article)\b", re.I)
_SPACE = re.compile(r"\s+")
# Parts of a name that only say how an element is laid out.
LAYOUT = frozenset("area bar block box button buttons container content inner item items link links list main outer panel posts section top wrap wrapper bottom left right".split())
#: Elements that the next of their kind ends, and elements that this does not reach through.
SELF_ENDING = frozenset("p li dt dd tr td th option".split())
BARRIERS = frozenset("ul ol dl table div article section td th".split())
#: Cells of an alignment kept at once; larger ones are halved first.
MOST_CELLS = 200_000_000


def _judged(tag: str, attributes: str, inside: bool) -> tuple[bool, bool]:
    """Whether an element is never the article's, and whether it is a suspect; inside: it stands in a marked article."""
    if tag in NEVER or tag == "header" and not inside:
        return True, False
    if not attributes:
        return False, False
    found = {m[1].lower(): next((x for x in m.groups()[1:] if x is not None), "").lower() for m in _ATTRIBUTE.finditer(attributes)}
    if "hidden" in found or found.get("aria-hidden") == "true" or found.get("role") in NEVER_ROLES:
        return True, False
    if tag in ARTICLE or tag in ("body", "html"):
        return False, False
    names = [set(_NAME.findall(x)) for x in f"{found.get('class', '')} {found.get('id', '')}".split()]
    listed = [x <= NEVER_NAMES | LAYOUT and not x.isdisjoint(NEVER_NAMES) for x in names]
    if any(listed) and (all(listed) or not inside):
        return True, False
    return False, any(not x.isdisjoint(NEVER_NAMES) for x in names)


class _Scanner:
    """Tags of a page, found from start to end: no stretch is scanned for a tag's end more than twice."""

    def __init__(self, page: str):
        self.page, self.quoted, self.last = page, True, page.rfind(">")

    def end_of_tag(self, at: int) -> int:
        """Index of the > that ends the tag whose name ends at `at`, or -1. Quoted values can hold a >, until the page turns out not to close one."""
        if at > self.last:
            return -1
        page, begin = self.page, at
        end = page.find(">", at)
        while self.quoted and end >= 0:
            equal = page.find("=", at, end)
            if equal < 0:
                return end
            at = equal + 1
            while page[at] in " \t\r\n\f":
                at += 1
            if page[at] in "\"'":
                close = page.find(page[at], at + 1)
                if close < 0:
                    break
                at = close + 1
                if at > end:
                    end = page.find(">", at)
        self.quoted = False
        return page.find(">", begin)


class _Open:
    """The open elements: tag and what holds inside of it."""

    def __init__(self):
        self.stack: list[tuple[str, tuple]] = []
        self.where: dict[str, list[int]] = {}
        self.barriers: list[int] = []

    def push(self, tag: str, state: tuple) -> None:
        self.where.setdefault(tag, []).append(len(self.stack))
        if tag in BARRIERS:
            self.barriers.append(len(self.stack))
        self.stack.append((tag, state))

    def has(self, tag: str) -> bool:
        return bool(self.where.get(tag))

    def close(self, tag: str) -> None:
        """Close the innermost element of this tag and all inside of it."""
        at = self.where[tag][-1]
        while len(self.stack) > at:
            name, _ = self.stack.pop()
            self.where[name].pop()
            if name in BARRIERS:
                self.barriers.pop()

    def ends_next(self, tag: str) -> bool:
        """Whether an element of this tag is open that the next of its kind ends."""
        found = self.where.get(tag)
        return bool(found) and (not self.barriers or found[-1] >= self.barriers[-1])

    @property
    def state(self) -> tuple:
        return self.stack[-1][1] if self.stack else (-1, False, False)


def blocks_of(page: str | None) -> list[tuple[str, int, bool, bool]]:
    """Text blocks in page order: text, number of the outermost marked article around it (or -1), whether inside an element that is never the article, and whether inside a suspect."""
    out: list[tuple[str, int, bool, bool]] = []
    words: list[str] = []
    page, at, marked = page or "", 0, 0
    scanner, open_ = _Scanner(page), _Open()
    state = open_.state

    def flush():
        if words:
            if text := _SPACE.sub(" ", entities.unescape("".join(words))).strip():
                out.append((text, *state))
            words.clear()

    while at < len(page):
        start = page.find("<", at)
        if start < 0:
            words.append(page[at:])
            break
        if start > at:
            words.append(page[at:start])
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            at = end + 3 if end >= 0 else len(page)
            continue
        m = _TAG.match(page, start)
        if m is None:
            end = page.find(">", start) if page[start + 1 : start + 2] in ("!", "?") and start < scanner.last else -1
            if end < 0:
                words.append("<")
            at = max(start, end) + 1
            continue
        end = scanner.end_of_tag(m.end())
        if end < 0:
            words.append("<")
            at = start + 1
            continue
        closing, tag, attributes, at = bool(m[1]), m[2].lower(), page[m.end() : end], end + 1
        if tag in INLINE and not attributes and not open_.has(tag):
            if tag == "br":
                words.append(" ")
            continue
        if closing:
            if open_.has(tag):
                open_.close(tag)
                if tag not in INLINE or open_.state != state:
                    flush()
                state = open_.state
            elif tag not in INLINE:
                flush()
            continue
        alone = attributes.rstrip().endswith("/")
        if tag in RAW and not alone:
            found = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = found.end() if found else len(page)
            continue
        if tag in VOID or alone:
            if tag not in INLINE:
                flush()
            elif tag == "br":
                words.append(" ")
            continue
        if tag in INLINE:
            never, suspect = _judged(tag, attributes, state[0] >= 0)
            # Those that say nothing of their own are not kept open; inside of what says something, the same tag has to be counted.
            if not open_.has(tag) and (state[1] or not never and not suspect):
                continue
        else:
            flush()
        if tag in SELF_ENDING and open_.ends_next(tag):
            open_.close(tag)
            state = open_.state
        region, never, suspect = state
        if not never:
            never, doubt = _judged(tag, attributes, region >= 0)
            suspect = suspect or doubt
            if region < 0 and not never and (tag in ARTICLE or "role" in attributes and _MAIN.search(attributes)):
                region, marked = marked, marked + 1
        if (region, never, suspect) != state:
            flush()
        state = (region, never, suspect)
        open_.push(tag, state)
    flush()
    return out


def undecided(found: list[tuple[str, int, bool, bool]]) -> bool:
    """Whether the text of these blocks depends on what a neighbour shares."""
    kept = [x for x in found if not x[2]]
    return any(region < 0 or suspect for _, region, _, suspect in kept) or len({x[1] for x in kept}) > 1


def _lengths(a: list[int], b: list[int]) -> list[int]:
    """LCS lengths of a with every beginning of b, by bit vectors."""
    where: dict[int, int] = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    full, row, out = (1 << len(a)) - 1, (1 << len(a)) - 1, [0]
    for x in b:
        u = row & where.get(x, 0)
        row = (row + u | row - u) & full
        out.append(len(a) - row.bit_count())
    return out


def shared_lines(a: list[int], b: list[int]) -> list[int]:
    """Positions of a in a longest common subsequence with b."""
    low = 0
    while low < min(len(a), len(b)) and a[low] == b[low]:
        low += 1
    high = 0
    while high < min(len(a), len(b)) - low and a[-1 - high] == b[-1 - high]:
        high += 1
    ends = [*range(low), *range(len(a) - high, len(a))]
    a, b = a[low : len(a) - high], b[low : len(b) - high]
    if not a or not b:
        return ends
    if len(a) * len(b) > MOST_CELLS and len(a) > 1:
        half = len(a) // 2
        first, last = _lengths(a[:half], b), _lengths(a[half:][::-1], b[::-1])
        cut = max(range(len(b) + 1), key=lambda j: first[j] + last[len(b) - j])
        middle = shared_lines(a[:half], b[:cut]) + [half + i for i in shared_lines(a[half:], b[cut:])]
        return sorted(ends + [low + i for i in middle])
    where: dict[int, int] = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    rows = [full]
    for x in b:
        u = rows[-1] & where.get(x, 0)
        rows.append((rows[-1] + u | rows[-1] - u) & full)
    middle, i = [], len(a)
    for j in range(len(b), 0, -1):
        # Length of a[:i] with b[:j] is the number of zero bits below i.
        while i and rows[j] >> (i - 1) & 1:
            i -= 1
        if not i:
            break
        if rows[j - 1] >> (i - 1) & 1 and a[i - 1] == b[j - 1]:
            middle.append(i - 1)
            i -= 1
    return sorted(ends + [low + i for i in middle])


def row_key() -> Column:
    return F.xxhash64("page_id", "url", "html")


def _pages(pages: DataFrame) -> DataFrame:
    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))


def _same_beginning(a: str, b: str) -> Column:
    """Characters that two columns share from the start, by halving; exact to the character."""
    return F.expr(
        f"aggregate(sequence(30, 0, -1), 0, (n, k) -> CASE WHEN n + shiftleft(1, k) <= least(length({a}), length({b}))"
        f" AND substring({a}, 1, n + shiftleft(1, k)) = substring({b}, 1, n + shiftleft(1, k)) THEN n + shiftleft(1, k) ELSE n END)"
    )


def neighbours(pages: DataFrame, lines: DataFrame) -> DataFrame:
    """key, copy, other: each distinct page, one page of its run of copies, and the page of its host with the nearest URL path whose lines differ.

    Pages of a host that follow each other in the order of paths with equal lines are a run. The nearest page with other
    lines is the one before the run or the one after it, as the shared beginning only falls with the distance.
    """
    keys = _pages(pages).select(row_key().alias("key"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "page_id").distinct()
    keys = keys.join(lines.select("key", F.xxhash64("lines").alias("same_lines")), "key")
    order = ["host", "path", "page_id", "key"]
    sorted_keys = materialize(keys.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), "page-order")
    part = F.shiftright("at", 33)
    sizes = sorted_keys.groupBy(part.alias("part")).count()
    # One row for each partition, so its sums fit one task.
    before = sizes.select("part", F.coalesce(F.sum("count").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    numbered = sorted_keys.withColumn("part", part).join(F.broadcast(before), "part").select("part", "key", "host", "path", "same_lines", (F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1)).alias("number"))
    numbered = materialize(numbered, "page-numbers")
    last = numbered.select((F.col("number") + 1).alias("number"), F.struct("key", "host", "path").alias("page"), F.col("same_lines").alias("lines_before"))
    rows = numbered.join(last, "number", "left").withColumn("starts", F.expr("NOT (page.host <=> host AND lines_before <=> same_lines)"))
    # At the first row of each run: itself, and the last page of the run before.
    rows = rows.select("part", "number", "key", "host", "path", F.when(F.col("starts"), F.struct("number", F.col("page").alias("before"), F.struct("key", "host", "path").alias("first"))).alias("run"))
    rows = materialize(rows, "page-runs")
    edges = rows.groupBy("part").agg(F.max("run").alias("last_run"), F.min("run").alias("first_run"))
    edges = edges.select(
        "part", F.max("last_run").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)).alias("run_before"),
        F.min("first_run").over(Window.orderBy("part").rowsBetween(1, Window.unboundedFollowing)).alias("run_after"),
    )
    within = Window.partitionBy("part").orderBy("number")
    rows = rows.withColumns({
        "own_run": F.last("run", ignorenulls=True).over(within.rowsBetween(Window.unboundedPreceding, 0)),
        "next_run": F.last("run", ignorenulls=True).over(Window.partitionBy("part").orderBy(F.desc("number")).rowsBetween(Window.unboundedPreceding, -1)),
    }).join(F.broadcast(edges), "part")
    rows = rows.select("key", "host", "path", F.coalesce("own_run", "run_before").alias("own_run"), F.coalesce("next_run", "run_after").alias("next_run"))
    rows = rows.select("key", "path", F.col("own_run.first.key").alias("copy"), *[F.when(F.col(f"{c}.host") == F.col("host"), F.col(c)).alias(name) for c, name in (("own_run.before", "before"), ("next_run.first", "after"))])
    rows = rows.withColumns({"path_before": F.col("before.path"), "path_after": F.col("after.path")})
    first = F.col("after").isNull() | F.coalesce(_same_beginning("path_before", "path") >= _same_beginning("path_after", "path"), F.lit(False))
    return rows.select("key", "copy", F.when(first, F.col("before.key")).otherwise(F.col("after.key")).alias("other")).where("other IS NOT NULL")


def _lines(pages: DataFrame) -> DataFrame:
    """key, lines (hashes), open: whether the text depends on what a neighbour shares."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in in_chunks(batches, "html"):
            found = [blocks_of(x) for x in batch["html"]]
            yield pd.DataFrame({
                "key": batch["key"].to_numpy(),
                "lines": [np.array([xxhash.xxh64_intdigest(t.encode("utf-8", "surrogatepass")) for t, *_ in x], np.uint64).view(np.int64) for x in found],
                "open": [undecided(x) for x in found],
            })

    return _pages(pages).select(row_key().alias("key"), "html").mapInPandas(run, "key long, lines array<long>, open boolean").dropDuplicates(["key"])


def shared_with_neighbour(pages: DataFrame) -> DataFrame:
    """key, shared: positions of the lines that the neighbour shares, of pages whose text depends on them."""
    lines = materialize(_lines(pages), "page-lines")
    near = materialize(neighbours(pages, lines), "page-neighbours")

    @F.pandas_udf("array<int>")
    def aligned(own: pd.Series, others: pd.Series) -> pd.Series:
        return pd.Series([sorted(shared_lines(a.tolist(), b.tolist())) for a, b in zip(own, others, strict=True)])

    # Copies of a run have one alignment with a neighbour.
    asked = near.join(lines.where("open").select("key"), "key")
    pairs = asked.select("copy", "other").distinct().join(lines.select(F.col("key").alias("copy"), "lines"), "copy")
    pairs = pairs.join(lines.select(F.col("key").alias("other"), F.col("lines").alias("other_lines")), "other")
    found = pairs.select("copy", "other", aligned("lines", "other_lines").alias("shared")).where("size(shared) > 0")
    return asked.join(found, ["copy", "other"]).select("key", "shared")


def text_of(page: str | None, shared=()) -> str:
    """The blocks of the article, one to a line, given the positions of blocks that the neighbour shares."""
    found, gone = blocks_of(page), set(shared)
    kept = [(i, text, region, suspect) for i, (text, region, never, suspect) in enumerate(found) if not never]
    outside = [text for i, text, region, _ in kept if region < 0 and i not in gone]
    marked = [x for x in kept if x[2] >= 0]
    if sum(map(len, outside)) > sum(len(text) for _, text, *_ in marked):
        return "\n".join(outside)
    left = {region for i, _, region, _ in marked if i not in gone}
    return "\n".join(text for i, text, region, suspect in marked if (not left or region in left) and not (suspect and i in gone))


def extract_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    small_batches(pages.sparkSession)
    shared = materialize(shared_with_neighbour(pages), "page-shared").withColumnRenamed("key", "own")
    rows = _pages(pages).withColumn("key", row_key()).join(shared, F.col("key") == F.col("own"), "left").select("page_id", "url", "html", "shared")

    @F.pandas_udf("string")
    def text(pages: pd.Series, shared: pd.Series) -> pd.Series:
        return strings(text_of(p, () if s is None else s.tolist()) for p, s in zip(pages, shared, strict=True))

    rows = rows.select("page_id", "url", text("html", "shared").alias("text"))
    return rows.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
