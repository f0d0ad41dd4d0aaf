"""Main text of web pages: a host's suffix array finds the boilerplate, landmarks confirm it.

A page is cut into blocks in page order. Blocks in menus, headers, footers, sidebars, notices,
adverts, forms and comments (by element, role or class) are furniture; those inside an article (or
main) element are its text; all others are open. Repeats judge the blocks of all pages, articles
too; what an element says confirms or stands in where nothing repeats.

Each page has two token streams, of its articles and of all that stands outside them. They are
concatenated per host, and the suffix array of a host is needed only as far as neighbours that share
``RUN`` tokens and stand on distinct pages. So suffixes are sorted into buckets by their first
``RUN`` tokens, over all hosts at once; a longer repeat is the union of those inside it.
A bucket is boilerplate if at least ``PAGES`` pages and a share of ``SHARE`` of the host's pages have
it; on a host of fewer than ``PAGES`` pages, if all have it. So an article copied to a few pages of a
host stays, however long it is. Outside articles whole blocks are buckets, too, so that a short menu
or notice counts, while short runs of words that other text has as well do not.
Buckets are aggregated before the shuffle, so neither a host with a third of all pages nor a menu on
all of them is a hot key, and no host is ever in one task.

Articles are long and seldom repeat, so their suffix array is sparse first: it has the suffixes that
begin at a stem, the ``STEM`` tokens of least hash among those of some ``RUN`` tokens. Equal runs
have their stem in the same place, so where no stem is on enough pages no run is. An article
more than half of whose stems are on enough pages is a copy of others, or they of it: it stays whole
and is no evidence against others. In the other articles all suffixes around such stems are sorted and
counted, with those outside articles, and a block that boilerplate covers by more than half is
dropped, as a notice inside the article element of every page; short lines that repeat stay.

A page with a landmark (an article or main element that is no furniture) keeps the other blocks inside
it. An element that is furniture by its class or id only, but holds the only article of the page, is a
wrapper. A page without a landmark loses its furniture and those open blocks that boilerplate outside
articles covers by more than half, and keeps the others; if there are none, its text is empty.

Rows: a null html is empty; a null url is a host of its own name; repeated rows (equal page_id) are
one page for each other and are reported once each; an empty table gives no rows; other columns are
ignored. Broken markup (unclosed elements, comments, quotes) ends at the latest with the page.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickbars.llm import wordhash
from tickbars.llm.tables import removed, settled, staged, table

RUN = 20
STEM = 10
COVERED = 0.5
PAGES, SHARE = 3, 0.02
# A host's number of pages is written so many times over, so that its pages can be joined in parts.
SALTS = 64

FURNITURE, ARTICLE, OPEN = 0, 1, 2
# Furniture by a name only, and an article inside it: settled when the whole page is known.
NAMED, INNER = 3, 4
HOST = 0x5BF03635D1F4A3C7  # tells the bucket of a host from those of its text

# Elements whose content is no text of the page.
_DARK = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(script|style|noscript|template|svg|iframe|object|canvas|title|textarea|select|math|audio|video)\b[^>]*>.*?(?:</\1\s*>|\Z)|<[!?][^>]*>",
    re.S | re.I,
)
_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>")
_LOOSE = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)(?:>|\Z)")
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SPACE = frozenset(["br", "wbr", "img", "input"])
_HOME = frozenset(["article", "main"])
_ASIDE = frozenset("nav header footer aside form dialog menu button".split())
_ROLE = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert toolbar".split())
# Words of class and id names that name furniture; of an article only those of readers' replies.
_FURNITURE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies"
    " disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices pager pagination paywall popup"
    " promo promotion recommended related replies reply respond share sharing sidebar signup skip social sponsor sponsored subscribe"
    " subscription tags toolbar widget".split()
)
_REPLIES = frozenset("comment comments replies reply respond".split())
# A name that begins with one of these says something about an element, not what it is.
_ABOUT = frozenset("has no not with without is category cat tag type format status single page template theme layout supports hide show".split())
_NAME = re.compile(r"(?:^|\s)(?:class|id)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_ROLES = re.compile(r"(?:^|\s)role\s*=\s*[\"']?([a-zA-Z]+)", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_PART = re.compile(r"[a-zA-Z][a-z]*|[A-Z]+")


def _kind(tag: str, rest: str) -> int:
    """What an element's start tag says of its content."""
    if not rest:
        return FURNITURE if tag in _ASIDE else ARTICLE if tag in _HOME else OPEN
    role = _ROLES.search(rest)
    role = role[1].lower() if role else ""
    if tag in _ASIDE or role in _ROLE or _HIDDEN.search(rest):
        return FURNITURE
    home = tag in _HOME or role == "main"
    words = _REPLIES if home else _FURNITURE_WORDS
    for found in _NAME.finditer(rest):
        for name in (found[1] or found[2] or found[3] or "").split():
            parts = [part.lower() for part in _PART.findall(name)]
            if parts and (parts[0] not in _ABOUT or len(parts) == 1) and any(part in words for part in parts):
                return NAMED
    return ARTICLE if home else OPEN


def blocks(page: str) -> tuple[list[tuple[str, int]], bool]:
    """The blocks of a page, in order (text with single spaces, and kind), and whether it has a
    landmark."""
    page = _DARK.sub(lambda m: "" if m[0].startswith("<!--") else " ", page)
    out: list[tuple[str, int]] = []
    text: list[str] = []
    stack: list[tuple[str, int, int]] = []  # open elements that set the kind: name, how many of it are open, kind
    kind, at, landmark, inner = OPEN, 0, False, False

    def flush() -> None:
        if text:
            line = " ".join(entities.unescape("".join(text)).split())
            if line:
                out.append((line, kind))
            text.clear()

    while True:
        low = page.find("<", at)
        if low < 0:
            text.append(page[at:])
            break
        tag = _TAG.match(page, low) or _LOOSE.match(page, low)
        if not tag:
            text.append(page[at : low + 1])
            at = low + 1
            continue
        if low > at:
            text.append(page[at:low])
        at = tag.end()
        closing, name, rest = tag[1], tag[2].lower(), tag[3]
        if name in _BLOCK:
            flush()
            if stack and stack[-1][0] == "p":  # a paragraph ends where another block begins or ends
                stack.pop()
                kind = stack[-1][2] if stack else OPEN
        elif name in _SPACE:
            text.append(" ")
        if name in _VOID or rest.endswith("/") and name not in _BLOCK:
            continue
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    if stack[k][1] == 1:
                        if name not in _BLOCK:
                            flush()
                        del stack[k:]
                        kind = stack[-1][2] if stack else OPEN
                    else:
                        stack[k] = (name, stack[k][1] - 1, stack[k][2])
                    break
            continue
        new = _kind(name, rest)
        if kind in (NAMED, INNER):  # only an article, or what is furniture for sure, can be in here
            new = {ARTICLE: INNER, FURNITURE: FURNITURE, NAMED: NAMED if kind == INNER else OPEN}.get(new, OPEN)
        if kind != FURNITURE and new != OPEN and name not in ("html", "body"):
            if name not in _BLOCK:
                flush()
            kind = new
            landmark |= kind == ARTICLE
            inner |= kind == INNER
            stack.append((name, 1, kind))
        elif stack and any(x[0] == name for x in stack):
            k = max(k for k in range(len(stack)) if stack[k][0] == name)
            stack[k] = (name, stack[k][1] + 1, stack[k][2])
    flush()
    # What is named like furniture but holds the page's only article is a wrapper: the article counts.
    settled = {NAMED: FURNITURE, INNER: FURNITURE if landmark else ARTICLE}
    return [(line, settled.get(kind, kind)) for line, kind in out], landmark or inner


def host_of(url: str | None) -> str:
    """Host of a url, in small letters, without user and port; one word, even if it has white space."""
    found = re.match(r"(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", url or "")
    return re.sub(r"\s", "_", found[1].rpartition("@")[2].partition(":")[0] if found else url or "").lower()


def parsed(pages: DataFrame) -> DataFrame:
    """One row for each row of ``pages``, each parsed once: its text if it has a landmark, the bucket of
    its host, the buckets and stems of all that stands outside articles, and, without a landmark, its
    open blocks with the places of their buckets."""

    def parse(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        urls = batch.column("url").to_pylist()
        texts, outside, lines = [], [], []
        for url, x in zip(urls, batch.column("html"), strict=True):
            found, landmark = blocks(x.as_py() or "")
            texts.append("\n\n".join(b[0] for b in found if b[1] == ARTICLE) if landmark else None)
            outside.append([b for b in found if b[1] != ARTICLE])
            lines.append(f"{host_of(url)} " + "\n".join(b[0] for b in outside[-1]))
        hosts, buckets, stems, opened = [0] * len(urls), [None] * len(urls), [None] * len(urls), [None] * len(urls)
        for row, data, starts, _, hashes in wordhash.text_words(pa.array(lines, pa.string()), wordhash.NOT_SPACE):
            first = 1 if host_of(urls[row]) else 0
            host = hashes[0] if first else np.uint64(0)
            leads = wordhash.mix(wordhash.shingles(hashes[first:], RUN) + host)
            ends = np.append(np.flatnonzero(data == 0x0A), len(data))
            sizes = np.diff(np.concatenate([[0], np.searchsorted(starts[first:], ends)])) if outside[row] else np.zeros(0, np.int64)
            # Shingles of one size hold it in their hash; those of blocks hold another number.
            wholes = [hashlib.blake2b(x.tobytes(), digest_size=8).digest() for x in np.split(hashes[first:], np.cumsum(sizes)[:-1])] if len(sizes) else []
            wholes = wordhash.mix(wordhash.mix(np.frombuffer(b"".join(wholes), np.uint64)) + host).view(np.int64)
            leads = leads.view(np.int64)
            hosts[row] = int(wordhash.mix(np.array([host]) ^ np.uint64(HOST)).view(np.int64)[0])
            buckets[row] = np.unique(np.concatenate([leads, wholes, [hosts[row]]]))
            stems[row] = np.unique(_stems(hashes[first:], host)[1])
            if texts[row] is None:
                high = np.cumsum(sizes).tolist()
                opened[row] = [
                    {"number": k, "text": text, "spans": _places(leads, int(wholes[k]), high[k] - int(sizes[k]), high[k])}
                    for k, (text, kind) in enumerate(outside[row])
                    if kind == OPEN
                ]
        found = [batch.column("page"), batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(hosts, pa.int64()), pa.array(buckets, pa.list_(pa.int64())), pa.array(stems, pa.list_(pa.int64())), pa.array(opened, _OPENED)]
        yield pa.RecordBatch.from_arrays(found, ["page", "page_id", "url", "text", "host", "buckets", "stems", "open"])

    rows = pages.select(F.monotonically_increasing_id().alias("page"), "page_id", "url", "html")
    return wordhash.mapped(rows, parse, PARSED)


_OPENED = pa.list_(pa.struct([("number", pa.int32()), ("text", pa.string()), ("spans", pa.list_(pa.struct([("lead", pa.int64()), ("low", pa.int32()), ("high", pa.int32()), ("size", pa.int32())])))]))
PARSED = "page long, page_id long, url string, text string, host long, buckets array<long>, stems array<long>, open array<struct<number:int,text:string,spans:array<struct<lead:long,low:int,high:int,size:int>>>>"


def _places(leads: np.ndarray, whole: int, low: int, high: int) -> list[dict]:
    """The buckets that cover words of the block from ``low`` to ``high``, and which words of it."""
    first = max(0, low - RUN + 1)
    found = [{"lead": x, "low": max(low, p) - low, "high": min(high, p + RUN) - low, "size": high - low} for p, x in enumerate(leads[first:high].tolist(), first)]
    return [*found, {"lead": whole, "low": 0, "high": high - low, "size": high - low}]


def _stems(hashes: np.ndarray, host: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """Where the stems of a stream are, and their names: in each run of ``RUN`` tokens the first of
    those ``STEM`` tokens that have the least hash."""
    if len(hashes) < RUN:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    names = wordhash.shingles(hashes, STEM)
    least = np.lib.stride_tricks.sliding_window_view(names, RUN - STEM + 1).argmin(axis=1)
    at = np.unique(least + np.arange(len(least)))
    return at, wordhash.mix(names[at] + host).view(np.int64)


def _articles(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.uint64, np.ndarray]]:
    """For each page with a landmark: its row, the tokens of its article, its host, and the number of
    tokens up to the end of each block."""
    hosts = [host_of(url) for url in batch.column("url").to_pylist()]
    lines = [f"{host} {text}" for host, text in zip(hosts, batch.column("text").to_pylist(), strict=True)]
    for row, data, starts, _, hashes in wordhash.text_words(pa.array(lines, pa.string()), wordhash.NOT_SPACE):
        first = 1 if hosts[row] else 0
        # Blocks are one line each, with an empty line between them.
        breaks = np.flatnonzero(data == 0x0A)[::2]
        high = np.append(np.searchsorted(starts[first:], breaks), len(hashes) - first)
        yield row, hashes[first:], hashes[0] if first else np.uint64(0), high


def sparse_suffixes(known: DataFrame) -> DataFrame:
    """(page, page_id, host, name, at, of): the stems of parsed pages; ``at`` is the place in the article
    and ``of`` how many it has, both null outside articles."""

    def stems(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found, sizes = [], np.zeros(batch.num_rows, np.int64)
        for row, hashes, host, _ in _articles(batch):
            found.append(_stems(hashes, host))
            sizes[row] = len(found[-1][0])
        at, name = (np.concatenate(x) for x in zip(*found, strict=True))
        rows = batch.select(["page", "page_id", "host"]).take(pa.array(np.repeat(np.arange(len(sizes)), sizes)))
        more = [pa.array(name), pa.array(at, pa.int32()), pa.array(np.repeat(sizes, sizes), pa.int32())]
        yield pa.RecordBatch.from_arrays([*rows.columns, *more], ["page", "page_id", "host", "name", "at", "of"])

    inside = known.where("text is not null").select("page", "page_id", "host", "url", "text")
    inside = wordhash.mapped(inside, stems, "page long, page_id long, host long, name long, at int, of int")
    outside = known.select("page", "page_id", "host", F.explode("stems").alias("name"), F.lit(None).cast("int").alias("at"), F.lit(None).cast("int").alias("of"))
    return inside.unionByName(outside)


def places_around(pages: DataFrame) -> DataFrame:
    """(page, page_id, host, number, lead, low, high, size) of parsed pages with a column ``stems``: the
    suffixes of their articles that begin with as many tokens as hold one of these stems, and which
    words of which block they cover."""

    def places(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows, found = [], []
        for row, hashes, host, high in _articles(batch):
            leads = wordhash.mix(wordhash.shingles(hashes, RUN) + host).view(np.int64)
            some = np.zeros(len(leads), bool)
            for at in batch.column("stems")[row].as_py():
                some[max(0, at - RUN + STEM) : at + 1] = True
            for p in np.flatnonzero(some).tolist():
                for k in range(int(np.searchsorted(high, p, "right")), len(high)):
                    low = int(high[k - 1]) if k else 0
                    if low >= p + RUN:
                        break
                    rows.append(row)
                    found.append((k, int(leads[p]), max(low, p) - low, min(int(high[k]), p + RUN) - low, int(high[k]) - low))
        columns = zip(*found, strict=True) if found else [[]] * 5
        kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
        given = batch.select(["page", "page_id", "host"]).take(pa.array(rows, pa.int64()))
        more = [pa.array(list(x), kind) for x, kind in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays([*given.columns, *more], ["page", "page_id", "host", "number", "lead", "low", "high", "size"])

    rows = pages.select("page", "page_id", "host", "url", "text", "stems")
    return wordhash.mapped(rows, places, "page long, page_id long, host long, number int, lead long, low int, high int, size int")


def counted(rows: DataFrame) -> DataFrame:
    """(lead, pages) of rows (page_id, lead): on how many pages a bucket is, if on two or more; the bucket
    of a host itself is on all its pages."""
    return rows.groupBy("lead").agg(F.countDistinct("page_id").alias("pages")).where("pages > 1")


def often(rows: DataFrame, sizes: DataFrame, *parts: str) -> DataFrame:
    """Those rows (host, pages, ...) that are on enough pages of their host, dealt by ``parts``. A host of
    one page has no bucket, and nothing on it repeats."""
    rows = rows.withColumn("salt", F.pmod(F.hash(*parts), F.lit(SALTS)))
    enough = (F.col("pages") >= F.least(F.lit(PAGES), "all")) & (F.col("pages") >= SHARE * F.col("all"))
    return rows.join(sizes, ["host", "salt"]).where(enough)


def boilerplate(places: DataFrame, buckets: DataFrame, sizes: DataFrame) -> DataFrame:
    """(page, number) of the blocks that boilerplate covers by more than half."""
    found = often(places.join(buckets, "lead"), sizes, "page", "number", "low")
    hit = found.groupBy("page", "number").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list(F.sequence("low", F.col("high") - 1))))).alias("hit"), F.max("size").alias("size")
    )
    return hit.where(F.col("hit") > COVERED * F.col("size")).select("page", "number")


def repeated_in_articles(known: DataFrame, outside: DataFrame, sizes: DataFrame) -> DataFrame:
    """(page, gone) of parsed pages: the numbers of the article's blocks that are boilerplate."""
    suffixes = sparse_suffixes(known)
    # Rows are counted first, which are no fewer than pages: one shuffle of all stems, of few bytes each.
    rows = suffixes.groupBy("name").agg(F.first("host").alias("host"), F.count("*").alias("pages")).where("pages > 1")
    some = staged(often(rows, sizes, "name").select("name"), "stems")
    settled(known.sparkSession)
    again = staged(suffixes.join(some, "name"), "suffixes")
    pages = often(again.groupBy("host", "name").agg(F.countDistinct("page_id").alias("pages")).where("pages > 1"), sizes, "name")
    stems = again.where("at is not null").join(pages.select("name"), "name").groupBy("page").agg(F.collect_list("at").alias("stems"), F.max("of").alias("of"))
    # An article of which more than that repeats is a copy, and stays.
    stems = staged(stems.where(F.size("stems") <= COVERED * F.col("of")).select("page", "stems"), "stems")
    places = staged(places_around(known.drop("stems").join(stems, "page")), "places")
    elsewhere = outside.join(places.select("lead").distinct(), "lead", "left_semi")
    gone = boilerplate(places.drop("page_id"), counted(places.select("page_id", "lead").unionByName(elsewhere)), sizes)
    gone = staged(gone.groupBy("page").agg(F.collect_set("number").alias("gone")), "gone")
    removed(some, again, stems, places)
    return gone


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages``."""
    known = staged(parsed(pages), "pages", compression="zstd")
    outside = known.select("page_id", F.explode("buckets").alias("lead"))
    buckets = staged(counted(outside), "buckets")
    sizes = known.select(F.col("host").alias("lead")).distinct().join(buckets, "lead")
    sizes = sizes.select(F.col("lead").alias("host"), F.col("pages").alias("all"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    sizes = staged(sizes, "sizes")

    inside = known.where("text is not null").join(repeated_in_articles(known, outside, sizes), "page", "left")
    left = F.filter(F.split("text", "\n\n"), lambda _, k: ~F.array_contains("gone", k))
    framed = inside.select("page_id", "url", F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(left, "\n\n")).alias("text"))

    rows = known.where("text is null").select("page", "page_id", "url", "host", F.explode_outer("open").alias("b"))
    rows = rows.select("page", "page_id", "url", "host", "b.*")
    places = rows.select("page", "host", "number", F.explode("spans").alias("s")).select("page", "host", "number", "s.*")
    gone = boilerplate(places, buckets, sizes).withColumn("gone", F.lit(True))
    left = rows.drop("spans", "host").join(gone, ["page", "number"], "left")
    every_block = F.sort_array(F.collect_list(F.struct("number", F.coalesce("gone", F.lit(False)).alias("gone"), "text")))
    kept = F.filter(every_block, lambda b: b["number"].isNotNull() & ~b["gone"])
    bare = left.groupBy("page").agg(F.first("page_id").alias("page_id"), F.first("url").alias("url"), F.array_join(F.transform(kept, lambda b: b["text"]), "\n\n").alias("text"))
    every = framed.unionByName(bare.drop("page"))
    return every.withColumn("n_chars", F.length("text").cast("long"))


def op8_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages; see the module."""
    return extracted(table(spark, sf_dir, "pages"))
