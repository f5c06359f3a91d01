"""HTML extraction (operator 3): the article of a page as plain text.

Method: a host suffix array.  A page is cut into blocks at block-level tags.  The blocks that no
``article`` or ``main`` element holds make the page's token stream; the streams of a host's pages
are concatenated, suffixes sorted (induced sorting, see suffix_sort), and token runs of at least
``RUN`` tokens that occur on ``PAGES`` or more distinct pages are the host's boilerplate.  A block
keeps the runs that are unique.

What the markup settles is not judged by repetition: menus, headers, footers, sidebars, forms,
adverts, notices, comments, scripts and styles go (by element, role, class or id), and what an
``article`` or ``main`` element holds stays whole, however many pages quote it.  Where a page has
such an element with text, its other blocks only serve as evidence for the host; pages without
one are what the suffix array decides.

A host of more than ``SHARD_PAGES`` distinct streams is too large for one sort, so its suffixes are
sorted in shards, each by the same suffix array.  A window of ``RUN`` tokens belongs to the shard of its
anchor, its token of the smallest hash; neighbouring windows of one anchor are one segment.  Equal
windows have equal anchors, so they meet in a shard, and a run is found there if it is one in the host.
Of equal segments ``PAGES`` pages are enough.  An anchor of more than ``SHARD_SEGMENTS`` segments is
cut again by anchors of 3 and then of ``RUN`` tokens, so no shard is too large for a task.

Inside a block, white space becomes one space; ``br`` is white space; character references are
decoded; blocks come in page order, one a line.  Defined results: null or empty html, or a page of
boilerplate alone, gives the empty string; a null url is a host of its own; of equal streams each url
whose text the markup settles counts as a page, the pages that the runs decide together as one (copies of a page
don't make it boilerplate); rows repeat as they come; other columns are not looked at; an empty table gives no rows.
"""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.sizing import join_small, stored
from .common import concat_ranges, small_batches
from .suffix_sort import suffix_array

RUN = 6                   # tokens of a repeated run, at least
PAGES = 3                 # distinct pages it occurs on, at least
SHARD_PAGES = 5_000       # streams of a host that are sorted together, at most
SHARD_SEGMENTS = 4_096    # segments of an anchor that are sorted together, at most
ANCHORS = (1, 3, RUN)     # tokens of an anchor; longer ones for those that too many segments share
SORT_TOKENS = 1 << 20     # tokens of the shards that a task sorts at a time, about

#: Elements by their part in a page (HTML standard).
RAW = frozenset("script style template noscript iframe svg math head textarea select option object canvas "
                "audio video title".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
APART = frozenset("nav header footer aside form button dialog menu fieldset".split())
MAIN = frozenset("article main".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i ins kbd label mark nobr q rp rt "
                   "ruby s samp small span strike strong sub sup time tt u var wbr img".split())
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert".split())
#: Words of a class or id that mark what isn't the article.
MARKS = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored promo banner nav navbar navigation "
                  "menu breadcrumb breadcrumbs sidebar footer masthead cookie cookies consent notice popup modal newsletter "
                  "subscribe subscription share sharing social related recommended comment comments disqus respond "
                  "login signup pagination pager toolbar widget".split())

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*>", re.S)
_ATTR = re.compile(r"(class|id|role|hidden|aria-hidden)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
_NAME = re.compile(r"[A-Za-z]+")
_ABOUT = re.compile(r"(?:has|no|with|without|is|not|hide|hides)[-_]", re.I)
_HOST = re.compile(r"[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)")

ARTICLE, OPEN, SIDE = 2, 1, 0


HARD, SOFT = 2, 1


def _apart(name: str, attrs: str) -> int:
    """Whether an element's name or attributes mark what isn't the article: HARD by its element, role or
    being hidden, SOFT by a word of its class or id (or a form), which page-wide wrappers carry, too.
    Classes that tell *about* another part (``has-sidebar``, ``no-menu``) mark nothing."""
    found = SOFT if name == "form" else HARD if name in APART else 0
    if found == HARD or not attrs or name in ("html", "body"):
        return found
    for m in _ATTR.finditer(attrs):
        key, value = m[1].lower(), (m[2] or "").strip("\"'").lower()
        if key == "hidden" or key == "aria-hidden" and value == "true":
            return HARD
        if key == "role" and value in ROLES:
            return HARD
        if key in ("class", "id") and name not in MAIN and any(
                not _ABOUT.match(word) and not MARKS.isdisjoint(_NAME.findall(word)) for word in value.split()):
            found = SOFT
    return found


def blocks(page: str | None) -> list[tuple[int, str]]:
    """``(zone, text)`` of the page's blocks in order.

    A marked inline element is cut out of its block, which goes on after it.  A SOFT mark doesn't hold
    for a page's first ``article`` or ``main``: what contains that is a wrapper of the page."""
    page = page or ""
    out: list[tuple[int, str]] = []
    parts: list[str] = []
    # open elements that aren't inline (or are set apart): name, zone, whether a HARD mark holds, and the
    # text of the block that a marked inline element stands in
    stack: list[tuple[str, int, bool, list[str] | None]] = []
    zone, hard, seen_main, at, n = OPEN, False, False, 0, len(page)

    def close():
        if parts:
            text = " ".join(html_lib.unescape("".join(parts)).split())
            if text:
                out.append((zone, text))
            parts.clear()

    def pop(i: int):
        """End the open elements from the i-th on."""
        nonlocal zone, hard
        for j in range(i, len(stack)):
            if stack[j][3] is not None:      # the text around a marked inline element goes on
                close()
                parts[:] = stack[j][3]
                zone = stack[j - 1][1] if j else OPEN
                break
        if stack[i][3] is None:
            close()
        del stack[i:]
        zone, hard = stack[-1][1:3] if stack else (OPEN, False)
    while at < n:
        m = _TAG.search(page, at)
        if m is None:
            parts.append(page[at:])
            break
        if m.start() > at:
            parts.append(page[at:m.start()])
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if m[1]:
            i = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), -1)
            if i >= 0:
                pop(i)
            elif name not in INLINE:
                close()
            continue
        if name in RAW and not m[3].endswith("/"):
            end = re.compile(rf"</{name}\s*>", re.I).search(page, at)
            close()
            # an element that never ends takes its tag alone, but for code
            at = end.end() if end else (n if name in ("script", "style") else at)
            continue
        if name == "br":
            parts.append(" ")
            continue
        mark = _apart(name, m[3])
        if name in INLINE:
            if name not in VOID and not m[3].endswith("/") and (mark or zone == SIDE):
                # inside a marked one all are followed, so that the right end tag ends it
                stack.append((name, SIDE, hard or mark == HARD, None if zone == SIDE else parts[:]))
                if zone != SIDE:
                    parts.clear()
                    zone, hard = SIDE, stack[-1][2]
            continue
        close()
        if name in VOID or m[3].endswith("/"):
            continue
        if name == "p" and stack and stack[-1][0] == "p":  # a paragraph ends where the next begins
            pop(len(stack) - 1)
        first = name in MAIN and not seen_main and not hard
        if mark == HARD and not (name == "header" and zone == ARTICLE):
            zone, hard = SIDE, True
        elif first:
            zone, seen_main = ARTICLE, True
        elif zone == SIDE or mark == SOFT:
            zone = SIDE
        elif name in MAIN:
            zone = ARTICLE
        stack.append((name, zone, hard, None))
    close()
    return out


def host_of(url: str | None) -> str | None:
    m = _HOST.match(url or "")
    return m[1].lower().rpartition("@")[2] if m else None


# -- runs that a host repeats ------------------------------------------------


def repeated_runs(streams: list[np.ndarray], run: int, pages: int, owner: np.ndarray | None = None,
                  stands_for: np.ndarray | None = None) -> list[np.ndarray]:
    """Per stream of tokens (integers): the starts of its windows of ``run`` tokens that
    occur in ``pages`` or more of the streams (of their owners, numbers below that of the streams).  A stream
    counts as the number of pages that it stands for."""
    size = np.array([len(s) for s in streams], np.int64)
    begin = np.cumsum(size + 1) - (size + 1)
    total = int((size + 1).sum()) + 1
    text = np.zeros(total, np.int64)
    at = concat_ranges(begin, size)
    page = np.repeat(np.arange(len(streams)) if owner is None else owner, size + 1)
    page = np.append(page, -1)
    weight = np.append(np.repeat(np.ones(len(streams), np.int64) if stands_for is None else stands_for, size + 1), 1)
    if len(at):
        text[at] = np.unique(np.concatenate(streams), return_inverse=True)[1] + 1 + len(streams)
    text[begin + size] = np.arange(1, len(streams) + 1)  # separators differ, so no run passes one
    order = suffix_array(text)
    alike = np.ones(total - 1, bool)                     # of neighbours in the order: first run tokens
    for k in range(run):
        a, b = order[:-1] + k, order[1:] + k
        inside = (a < total) & (b < total)
        alike &= inside
        alike[inside] &= text[a[inside]] == text[b[inside]]
    group = np.append(0, np.cumsum(~alike))
    known, at = np.unique(group * (len(streams) + 1) + page[order] + 1, return_index=True)
    n = np.bincount(known // (len(streams) + 1), weight[order[at]], minlength=group[-1] + 1)
    # a window that holds a separator is alike to none, so its group is one suffix (and no long one)
    hit = np.zeros(total, bool)
    hit[order[n[group] >= pages]] = True
    long = np.zeros(total, bool)
    windows = np.maximum(size - run + 1, 0)
    long[concat_ranges(begin, windows)] = True
    where = np.nonzero(hit & long)[0]
    cuts = np.searchsorted(where, np.append(begin, total))
    return [where[cuts[i]:cuts[i + 1]] - begin[i] for i in range(len(streams))]


def hash_token(token: str) -> int:
    import xxhash
    return xxhash.xxh3_64_intdigest(token) >> 1 | 1


def grams(tokens: np.ndarray, length: int) -> np.ndarray:
    """A hash of the ``length`` tokens from each place on."""
    n = max(0, len(tokens) - length + 1)
    h = np.zeros(n, np.uint64)
    for j in range(length):
        h = (h ^ tokens[j:j + n].view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


def segments(tokens: np.ndarray, run: int, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(anchor, start, end)`` of the segments that hold all windows of ``run`` tokens, each once: the
    neighbouring windows whose smallest hash of ``length`` tokens is the same one."""
    h = grams(tokens, length)
    if len(tokens) < run:
        return h[:0], np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.lib.stride_tricks.sliding_window_view(h, run - length + 1).argmin(axis=1)
    at += np.arange(len(at))
    first = np.nonzero(np.diff(at, prepend=-1))[0]
    return h[at[first]], first, np.append(first[1:], len(at)) - 1 + run


def _token_lists(column: pa.Array) -> list[np.ndarray]:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    size = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return np.split(flat, np.cumsum(size)[:-1]) if len(size) else []


def cut_segments(streams: DataFrame, length: int) -> DataFrame:
    """``streams(stream, pages, tokens)`` -> ``(anchor, content, stream, pages, tokens)``, a row for each different
    segment and stream of it, ``PAGES`` streams at most."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def some(found):
            anchor, size, tokens, owner, pages = (np.concatenate(c) for c in zip(*found))
            upto = pa.array(np.append(0, np.cumsum(size)).astype(np.int32))
            return pa.RecordBatch.from_arrays(
                [pa.array(anchor.view(np.int64)), pa.array(owner), pa.array(pages),
                 pa.ListArray.from_arrays(upto, pa.array(tokens))], ["anchor", "stream", "pages", "tokens"])
        for batch in batches:
            found, held = [], 0
            for stream, pages, tokens in zip(*(c.to_pylist() for c in batch.columns[:2]), _token_lists(batch.column(2))):
                anchor, start, end = segments(tokens, RUN, length)
                found.append((anchor, end - start, tokens[concat_ranges(start, end - start)],
                              np.full(len(anchor), stream, np.int64), np.full(len(anchor), pages, np.int64)))
                held += len(found[-1][2])
                if held >= SORT_TOKENS:
                    yield some(found)
                    found, held = [], 0
            if found:
                yield some(found)
    cut = streams.select("stream", "pages", "tokens") \
        .mapInArrow(run, "anchor bigint, stream bigint, pages bigint, tokens array<bigint>") \
        .withColumn("content", F.xxhash64("tokens")).dropDuplicates(["anchor", "content", "stream"])
    nth = F.row_number().over(Window.partitionBy("anchor", "content").orderBy("stream"))
    return cut.withColumn("nth", nth).where(F.col("nth") <= PAGES).select("anchor", "content", "stream", "pages", "tokens")


def sharded_runs(streams: DataFrame) -> DataFrame:
    """``host_runs`` of hosts that are too large for one sort."""
    # tokens of different hosts differ, so hosts need not be told apart from here on
    own = F.xxhash64(F.coalesce("host", F.lit("")), F.col("host").isNull())
    streams = stored(streams.select("host", "stream", "pages",
                                    F.transform("tokens", lambda t: t.bitwiseXOR(own)).alias("tokens")), "large-hosts")
    rest, shards = streams, None
    for length in ANCHORS:
        cut = stored(cut_segments(rest, length), "segments")
        if length < RUN:
            hot = stored(cut.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > SHARD_SEGMENTS), "hot-anchors")
            marked = join_small(cut, hot, "anchor", "left")
            cut, rest = marked.where("n is null").drop("n"), marked.where("n is not null").drop("n")
        shards = cut if shards is None else shards.unionByName(cut)

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, rows, owner, count, held = None, [], [], [], 0

        def solve():
            nonlocal rows, owner, count, held
            who = np.unique(np.array(owner, np.int64), return_inverse=True)[1]
            found = repeated_runs(rows, RUN, PAGES, who, np.array(count, np.int64)) if rows else []
            w = [grams(t, RUN)[s] for t, s in zip(rows, found)]
            rows, owner, count, held = [], [], [], 0
            w = np.unique(np.concatenate([np.zeros(0, np.uint64), *w])).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(w)], ["w"])
        for batch in batches:
            for anchor, stream, pages, tokens in zip(*(c.to_pylist() for c in batch.columns[:3]),
                                                     _token_lists(batch.column(3))):
                if anchor != last and held >= SORT_TOKENS:
                    yield solve()
                last = anchor
                rows.append(tokens)
                owner.append(stream)
                count.append(pages)
                held += len(tokens)
        yield solve()

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, tokens in enumerate(_token_lists(batch.column(2))):
                w = grams(tokens, RUN).view(np.int64)
                same = pa.array(np.full(len(w), i))
                yield pa.RecordBatch.from_arrays([*(batch.column(c).take(same) for c in (0, 1)),
                                                  pa.array(np.arange(len(w), dtype=np.int32)), pa.array(w)],
                                                 ["host", "stream", "at", "w"])
    parts = int(streams.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hits = shards.select("anchor", "stream", "pages", "tokens").repartition(parts, "anchor").sortWithinPartitions("anchor") \
        .mapInArrow(sort, "w bigint").distinct()
    every = streams.select("host", "stream", "tokens").mapInArrow(windows, "host string, stream bigint, at int, w bigint")
    return join_small(every, stored(hits, "runs"), "w").groupBy("host", "stream") \
        .agg(F.sort_array(F.collect_list("at")).alias("starts"))


def host_runs(streams: DataFrame) -> DataFrame:
    """``streams(host, stream, tokens)``, distinct, with the ``pages`` that each stands for (else 1)
    -> ``(host, stream, starts)``."""
    if "pages" not in streams.columns:
        streams = streams.withColumn("pages", F.lit(1).cast("bigint"))
    sizes = streams.groupBy(F.col("host").alias("_host")).agg(F.count("*").alias("n"))
    sized = stored(streams.join(sizes, F.col("host").eqNullSafe(F.col("_host")))
                   .select("host", "stream", "pages", "tokens", "n"), "streams")

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, rows = None, []

        def solve():
            found = repeated_runs([np.array(r[2], np.int64) for r in rows], RUN, PAGES, None,
                                  np.array([r[1] for r in rows], np.int64)) if rows else []
            got = [(last[0], r[0], s.tolist()) for r, s in zip(rows, found) if len(s)]
            rows.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.int64()),
                 pa.array([g[2] for g in got], pa.list_(pa.int32()))], ["host", "stream", "starts"])
        for batch in batches:
            for host, stream, pages, tokens in zip(*(c.to_pylist() for c in batch.columns)):
                if last != (host,):
                    yield solve()
                    last = (host,)
                rows.append((stream, pages, tokens))
        yield solve()
    parts = int(streams.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    small = sized.where(F.col("n") <= SHARD_PAGES).select("host", "stream", "pages", "tokens") \
        .repartition(parts, "host").sortWithinPartitions("host").mapInArrow(
            sort, "host string, stream bigint, starts array<int>")
    large = sized.where(F.col("n") > SHARD_PAGES).select("host", "stream", "pages", "tokens")
    return small if large.isEmpty() else small.unionByName(sharded_runs(large))


def unique_text(parts: list[str], starts: list[int]) -> str:
    """The blocks without the tokens that the windows at ``starts`` cover.  A window may pass from
    block to block; of a block it takes all, or ``RUN`` tokens and more, never a shorter scrap."""
    tokens = [b.split() for b in parts]
    covered = np.zeros(sum(map(len, tokens)), bool)
    for s in starts or []:
        covered[s:s + RUN] = True
    out, at = [], 0
    for block in tokens:
        mine = covered[at:at + len(block)]
        at += len(block)
        edges = np.nonzero(np.diff(np.concatenate([[False], mine, [False]]).astype(np.int8)))[0]
        left, end = [], 0
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if b - a >= min(RUN, len(block)):
                left += block[end:a]
                end = b
        left += block[end:]
        if left:
            out.append(" ".join(left))
    return "\n".join(out)


def extract(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``(page_id, url, text, n_chars)`` of every row."""
    kind = pages.select(page_id).schema[0].dataType.simpleString()

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for u, page in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                found = blocks(page)
                article = "\n".join(t for z, t in found if z == ARTICLE)
                open_ = [t for z, t in found if z == OPEN]
                # the side blocks come after the open ones, as evidence
                stream = [hash_token(t) for b in [*open_, *(t for z, t in found if z == SIDE)] for t in b.split()]
                rows.append((host_of(u), article if article or not open_ else None,
                             None if article or not open_ else open_, stream))
            cols = list(zip(*rows)) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()),
                 pa.array(cols[2], pa.list_(pa.string())), pa.array(cols[3], pa.list_(pa.int64()))],
                ["page_id", "url", "host", "text", "open", "tokens"])
    p = pages.select(F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("url"),
                     F.col(html).cast("string").alias("html"))
    parsed = stored(small_batches(p).mapInArrow(
        parse, f"page_id {kind}, url string, host string, text string, open array<string>, tokens array<bigint>")
        .withColumn("stream", F.xxhash64("tokens")), "pages")
    evidence = parsed.where(F.size("tokens") > 0)
    seen = evidence.select("host", "stream", F.col("open").isNull().alias("settled"), F.when(
        F.col("open").isNull(), F.coalesce(F.concat(F.lit("u"), "url"), F.concat(F.lit("p"), F.col("page_id").cast("string"))))
        .alias("page")).distinct()
    # beyond PAGES the number makes no difference
    pages_of = seen.groupBy(F.col("host").alias("_host"), F.col("stream").alias("_stream")).agg(
        F.least(F.count("*"), F.lit(PAGES)).alias("pages"))
    distinct = evidence.select("host", "stream", "tokens").dropDuplicates(["host", "stream"])
    runs = host_runs(distinct.join(pages_of, F.col("host").eqNullSafe(F.col("_host")) & (F.col("stream") == F.col("_stream")))
                     .select("host", "stream", "pages", "tokens"))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = [unique_text(o, s) for o, s in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(text, pa.string())],
                                             ["page_id", "url", "text"])
    settled = parsed.where("open is null").select("page_id", "url", "text")
    undecided = parsed.where("open is not null").alias("p").join(
        runs.alias("r"), F.col("p.host").eqNullSafe(F.col("r.host")) & (F.col("p.stream") == F.col("r.stream")), "left") \
        .select("page_id", "url", "open", "starts").mapInArrow(keep, f"page_id {kind}, url string, text string")
    return settled.unionByName(undecided).select("page_id", "url", "text",
                                                 F.char_length("text").cast("bigint").alias("n_chars"))
