"""Removing repeated bytes with a logarithmic family of suffix arrays.

A suffix matters here by its first ``MATCH`` bytes: a byte goes if a string of that length over it also
starts earlier, in a document of smaller doc_id or at an earlier place of the same one.

**Suffix arrays.** Documents come in batches of ascending doc_id. The suffix array of a batch is a table
of its suffixes in buckets, sorted by the names of their first bytes, with the first place of each name.
Names are two hashes of 64 bits; they stand in for the bytes in the order, since equal strings must only
stand side by side, and a table of the bytes themselves would be a hundred times the text.

**Family.** A new batch is sorted into the same buckets and merge-scanned against each level: both sides
are sorted by name in the same buckets, so only the batch is shuffled. What is new becomes a level of
size 1; two levels of one size are merged, bucket by bucket, into one of twice the size. So b batches
have at most log2(b) + 1 levels, and a suffix is written again at most log2(b) times.

**Neighbours in one entry.** A suffix array with an entry for each byte would be many times the text. So
an entry stands for a run of neighbouring suffixes. The least hash of ``GRAM`` bytes within a string
anchors it, and so depends on the string alone; strings side by side mostly share the anchor. A run of
up to ``size`` strings with one anchor, in the same block of distances from it, has a *hull*, all bytes of
its strings, and a *core*, the bytes that every string of that block has around that anchor. If a hull
occurs earlier, so do all its strings. If its core occurs in no other hull, none of them occurs anywhere
else. Only hulls that share a core with others, and come first, are cut into runs of the next size
(``TIERS``), at last into single strings, where core and hull are the same. So nothing is missed, and
nothing but what is equal is taken for equal.

Joins hash the side of repeated names or places, of which a task has its share of a few in a hundred
entries, so that neither the entries nor the texts are sorted for them.

Hot groups: an entry is aggregated before it is shuffled, and repeated names are joined back from written
tables, so that Spark can split a frequent one. No task ever holds the documents of a name together.

Rows: a null text is empty; a row without doc_id counts as of the smallest id; rows of one doc_id are
ordered by a checksum of their text, and equal rows are one document; texts shorter than ``MATCH`` bytes
lose nothing; an empty table gives no rows; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickbars.llm import wordhash
from tickbars.llm.tables import deleted, removed, settled, staged, table
from tickbars.session import fresh_folder

MATCH = 100
GRAM = 32
# Strings that can share an anchor, and the most of them in a run of each tier.
SPAN = MATCH - GRAM + 1
TIERS = (SPAN, 8, 1)
BATCHES = 4

# A place in one long: checksum of the text, start in it, start in the piece it was cut from, strings.
CHECK_BITS, START_BITS, PART_BITS, COUNT_BITS = 18, 31, 7, 7
START_AT = PART_BITS + COUNT_BITS
CHECK_AT = START_AT + START_BITS

BLOCK = 1 << 16
PLACE_BITS = 17
NAME = ["core", "hull"]
PLACE = ["doc_id", "at"]
ENTRIES = "core long, hull long, doc_id long, at long"
PIECES = "doc_id long, origin long, bytes binary"
RESULT = "doc_id long, n_bytes long, n_removed long, spans array<struct<start: long, end: long>>, kept binary"


def _low(bits: int) -> int:
    return (1 << bits) - 1


# --- names of runs, in numpy --------------------------------------------------------------------


def _anchors(data: np.ndarray) -> np.ndarray:
    """The place of the anchor of each string of MATCH bytes, by its first byte."""
    hashes = wordhash.run_hashes(data, GRAM, wordhash.EXACT[0])
    bits = np.uint64(PLACE_BITS)  # the same for all, so that every text breaks ties alike
    least = (hashes >> bits << bits) | np.arange(len(hashes), dtype=np.uint64)
    width = 1
    while width < SPAN:
        step = min(width, SPAN - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    return (least & np.uint64(_low(PLACE_BITS))).astype(np.int64)


def runs(data: np.ndarray, rows: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Row, start in the row, number of strings, core and hull of each run; ``rows`` as ``wordhash.slices``
    gives it: the start of each row, with a byte that is not part of it behind each."""
    for low in range(0, len(data) - MATCH, BLOCK):
        part = data[low : low + BLOCK + MATCH - 1]
        anchors = _anchors(part)
        # Strings that reach over the end of their row are none.
        whole = np.ones(len(anchors), bool)
        for end in (rows[np.searchsorted(rows, low, "right") : np.searchsorted(rows, low + len(part), "right")] - 1 - low).tolist():
            whole[max(0, end - MATCH + 1) : end + 1] = False
        new = (anchors[1:] != anchors[:-1]) | (whole[1:] != whole[:-1])
        if size < SPAN:
            block = (anchors - np.arange(len(anchors))) // size
            new |= block[1:] != block[:-1]
        cuts = np.flatnonzero(new) + 1
        first, last = np.concatenate([[0], cuts]), np.concatenate([cuts - 1, [len(anchors) - 1]])
        kept = whole[first]
        first, last = first[kept], last[kept]
        if not len(first):
            continue
        row = np.searchsorted(rows, first + low, "right") - 1
        core = first + (anchors[first] - first) % size
        yield (
            row,
            first + low - rows[row],
            last - first + 1,
            wordhash.span_hashes(part, core, core + MATCH - size + 1, wordhash.EXACT[0]),
            wordhash.span_hashes(part, first, last + MATCH, wordhash.EXACT[1]),
        )


def entries(pieces: DataFrame, size: int) -> DataFrame:
    """The entries of ``pieces``: names of the runs of up to ``size`` strings, and their places."""

    def named(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids, origins = batch.column("doc_id"), batch.column("origin").to_numpy()
        for low, _, data, rows in wordhash.slices(batch.column("bytes")):
            for row, start, count, core, hull in runs(data, rows, size):
                within = start if size < SPAN else 0
                at = (origins[row + low] + start << START_AT) | within << COUNT_BITS | count
                yield pa.RecordBatch.from_arrays(
                    [pa.array(core.view(np.int64)), pa.array(hull.view(np.int64)), ids.take(pa.array(row + low)), pa.array(at)], [*NAME, *PLACE]
                )

    return wordhash.mapped(pieces.select("doc_id", "origin", "bytes"), named, ENTRIES)


# --- the index ----------------------------------------------------------------------------------


class Family:
    """Suffix arrays of batches, in levels whose sizes are powers of two, each name in one level."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[tuple[int, str]] = []
        self.folders: dict[str, str] = {}

    def _saved(self, rows: DataFrame) -> str:
        name = f"suffixes_{uuid.uuid4().hex}"
        self.folders[name] = fresh_folder(self.spark, "suffixes")
        writer = rows.write.format("parquet").bucketBy(self.buckets, *NAME).sortBy(*NAME)
        writer.option("path", self.folders[name]).saveAsTable(name)
        return name

    def _dropped(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        deleted(self.spark, self.folders.pop(name))

    def _level(self, name: str) -> DataFrame:
        return self.spark.table(name).where("earlier is null").select(*NAME, "first")

    def merged(self) -> None:
        """Merge levels of one size, smallest first."""
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (size, later), (_, sooner) = self.levels.pop(), self.levels.pop()
            other = self._level(later).withColumnRenamed("first", "other")
            both = self._level(sooner).join(other, NAME, "full_outer")
            both = both.select(*NAME, F.coalesce("first", "other").alias("first"), F.lit(None).cast("long").alias("n"), F.lit(None).cast("struct<doc_id: long, at: long>").alias("earlier"))
            self.levels.append((2 * size, self._saved(both)))
            self._dropped(sooner)
            self._dropped(later)

    def added(self, batch: DataFrame) -> DataFrame:
        """Add the entries of a batch, all behind those of the batches before; gives the places in it
        whose names occur earlier, as a written table."""
        self.merged()
        scan = batch.groupBy(*NAME).agg(F.min(F.struct(*PLACE)).alias("first"), F.count(F.lit(1)).alias("n"))
        found = []
        for k, (_, name) in enumerate(self.levels):
            found.append(f"_level_{k}")
            scan = scan.join(self._level(name).withColumnRenamed("first", found[-1]), NAME, "left")
        none = F.lit(None).cast("struct<doc_id: long, at: long>")
        array = self._saved(scan.select(*NAME, "first", "n", F.coalesce(*found, none).alias("earlier")))
        self.levels.append((1, array))
        # Written, so that the join deals both sides anew and Spark can split a frequent name.
        known = staged(
            self.spark.table(array).where("n > 1 or earlier is not null").select(*NAME, F.coalesce("earlier", "first").alias("known")), "known"
        )
        later = (F.col("doc_id") > F.col("known.doc_id")) | ((F.col("doc_id") == F.col("known.doc_id")) & (F.col("at") > F.col("known.at")))
        places = staged(batch.join(known.hint("shuffle_hash"), NAME).where(later).select(*PLACE), "places")
        removed(known)
        return places

    def shared(self) -> DataFrame:
        """The first places of the hulls that share their core with another hull, as a written table."""
        names = [self._level(name).select("core", "first.doc_id", "first.at") for _, name in self.levels]
        every = names[0]
        for more in names[1:]:
            every = every.unionByName(more)
        cores = staged(every.groupBy("core").agg(F.count(F.lit(1)).alias("_hulls")).where("_hulls > 1").select("core"), "cores")
        places = staged(every.join(cores.hint("shuffle_hash"), "core").select(*PLACE), "shared")
        removed(cores)
        return places

    def close(self) -> None:
        for name in list(self.folders):
            self._dropped(name)


# --- from documents to repeats and back ---------------------------------------------------------


def _identified(documents: DataFrame) -> DataFrame:
    """(doc_id, origin, bytes) with an id in each row; origin is the checksum, and start 0."""
    text = F.coalesce(F.col("text").cast("binary"), F.lit(bytearray()))
    check = F.shiftleft(F.crc32(text).bitwiseAND(F.lit(_low(CHECK_BITS))), START_BITS)
    return documents.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("doc_id"), check.alias("origin"), text.alias("bytes"))


def _origin(at: Column, size: int) -> Column:
    """The origin of the piece that a place of a tier was found in."""
    place = F.shiftright(at, START_AT)
    if size == SPAN:
        return F.shiftleft(F.shiftright(place, START_BITS), START_BITS)
    return place - F.shiftright(at, COUNT_BITS).bitwiseAND(F.lit(_low(PART_BITS)))


def _gathered(places: DataFrame, size: int) -> DataFrame:
    """The places of each piece, together; as many as its length allows."""
    grouped = places.groupBy(F.col("doc_id").alias("_doc_id"), _origin(F.col("at"), size).alias("_origin"))
    return grouped.agg(F.collect_list("at").alias("places"))


def _joined(pieces: DataFrame, gathered: DataFrame, how: str) -> DataFrame:
    same = (F.col("doc_id") == F.col("_doc_id")) & (F.col("origin") == F.col("_origin"))
    return pieces.join(gathered.hint("shuffle_hash"), same, how).select("doc_id", "origin", "bytes", "places")


def _starts_ends(places: np.ndarray, origin: int) -> tuple[np.ndarray, np.ndarray]:
    """Spans in a piece that the places of its strings cover."""
    starts = (places >> START_AT) - origin
    return starts, starts + (places & _low(COUNT_BITS)) + MATCH - 1


def _rows(batch: pa.RecordBatch) -> tuple[Iterator[bytes], Iterator[np.ndarray | None]]:
    """The bytes and the places of the rows of a batch, made one by one."""
    data, places = batch.column("bytes"), batch.column("places")
    numbers, bounds = places.values.to_numpy(), places.offsets.to_numpy().tolist()
    known = places.is_valid().to_pylist()
    return (
        (x.as_py() for x in data),
        (numbers[bounds[k] : bounds[k + 1]] if known[k] else None for k in range(len(known))),
    )


def cut_out(pieces: DataFrame, places: DataFrame, size: int) -> DataFrame:
    """The bytes around the given places of ``pieces``, as pieces."""

    def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        origins, counts, found, out = batch.column("origin").to_numpy(), [], [], []
        for origin, data, places in zip(origins.tolist(), *_rows(batch), strict=True):
            starts, ends = _starts_ends(np.unique(places), origin)
            counts.append(len(starts))
            found.append(starts + origin)
            out += [data[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        ids = batch.column("doc_id").take(pa.array(np.repeat(np.arange(len(counts)), counts)))
        yield pa.RecordBatch.from_arrays([ids, pa.array(np.concatenate(found)), pa.array(out, pa.binary())], ["doc_id", "origin", "bytes"])

    return wordhash.mapped(_joined(pieces, _gathered(places, size), "inner"), cut, PIECES)


def _bounds(documents: DataFrame, batches: int) -> list[int]:
    """The last ids of all batches but the last one."""
    shares = [k / batches for k in range(1, batches)]
    if not shares:
        return []
    found = documents.agg(F.percentile_approx("doc_id", shares)).first()[0]
    return sorted(set(found or []))


def repeats(documents: DataFrame, batches: int = BATCHES) -> DataFrame:
    """The places (doc_id, at) of ``documents`` as :func:`_identified` gives them, whose strings start
    earlier too, as a written table; a place may stand for several strings side by side.

    The entries of the first tier, nearly all there are, come in ``batches``; those cut from them in one."""
    spark = documents.sparkSession
    pieces, found = documents, []
    for size in TIERS:
        bounds = _bounds(documents, batches if size == SPAN else 1)
        number = sum(((F.col("doc_id") > b).cast("int") for b in bounds), F.lit(0)).alias("batch")
        folder = fresh_folder(spark, "entries")
        entries(pieces, size).select("*", number).write.partitionBy("batch").parquet(folder)
        every = spark.read.schema(f"{ENTRIES}, batch int").parquet(folder)
        family = Family(spark)
        for batch in range(len(bounds) + 1):
            found.append(family.added(every.where(F.col("batch") == batch).drop("batch")))
            deleted(spark, f"{folder}/batch={batch}")
            settled(spark)
        deleted(spark, folder)
        if size != TIERS[-1]:
            shared = family.shared()
            family.close()
            before, pieces = pieces, staged(cut_out(pieces, shared, size), "pieces")
            removed(shared, before)
        else:
            family.close()
            removed(pieces)
        settled(spark)
    places = found[0]
    for more in found[1:]:
        places = places.unionByName(more)
    kept = staged(places, "repeats")
    removed(*found)
    return kept


def without_repeats(documents: DataFrame, batches: int = BATCHES) -> DataFrame:
    """doc_id, n_bytes, n_removed, spans (of removed bytes, maximal) and kept (the other bytes) of each
    document; a null doc_id stays null."""
    rows = _identified(documents)
    # All places of a document, whichever tier found them.
    gathered = _gathered(repeats(rows, batches), SPAN)

    def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        out = []
        for doc_id, origin, data, places in zip(batch.column("doc_id").to_pylist(), batch.column("origin").to_pylist(), *_rows(batch), strict=True):
            spans, left, last = [], [], 0
            if places is not None:
                starts, ends = _starts_ends(np.unique(places), origin)
                ends = np.maximum.accumulate(ends)
                new = np.flatnonzero(starts[1:] > ends[:-1]) + 1
                spans = list(zip(starts[np.concatenate([[0], new])].tolist(), ends[np.concatenate([new - 1, [-1]])].tolist(), strict=True))
            for a, b in spans:
                left.append(data[last:a])
                last = b
            out.append((None if doc_id == -(1 << 63) else doc_id, len(data), sum(b - a for a, b in spans), [{"start": a, "end": b} for a, b in spans], b"".join([*left, data[last:]]) if spans else data))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary())
        columns = [pa.array(x, kind) for x, kind in zip(zip(*out, strict=True), kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_removed", "spans", "kept"])

    return wordhash.mapped(_joined(rows, gathered, "left"), cut, RESULT)


def op12_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the bytes of strings of 100 bytes that start earlier too."""
    rows = without_repeats(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
