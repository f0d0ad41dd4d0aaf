"""Jaccard join over word n-grams with vertical partitioning.

A global order of all shingles is cut into fragments. A document's set falls into one part per
fragment; for a pair the overlaps of the parts are counted fragment by fragment and summed.

* **Order.** Rare shingles first: by the binary logarithm of a count from a sketch of fixed size
  over all documents, then by hash. The order decides the cost, never the result.
* **Candidates.** A pair of the wanted similarity shares a shingle among the first
  ``n - ceil(0.85 n) + 1`` of both. Equal sets are one class, so copies meet only once.
* **No pairs within a group.** In the list of one shingle, every class is first paired with one
  pivot only (the class with the least before this shingle). The links found so make components.
  Then classes of different components that share a shingle, and lie in the same or the next
  bucket of sizes, are paired, so no link between components is lost, while links within one, which
  change nothing, are not looked for. Of the component with most classes in a list, no two are paired.
* **Filters** by size and by the places of the first common shingle drop only pairs that cannot
  reach the similarity.

Shingles and classes are known by 64-bit hashes. Rows: a null or empty text has an empty set and
no links; a text shorter than a shingle is one shingle; rows that repeat a doc_id are reported
once each; rows without doc_id have no links and no component; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickbars.llm import wordhash
from tickbars.llm.components import components
from tickbars.llm.tables import bit_field, free, may_have, removed, settled, staged, table

SIZE = 4
PERCENT = 85
FRAGMENTS = 8
CELL_BITS = 22
CHUNK_BITS = 16

SETS = "doc_id long, v long, n int, prefix array<long>"
PARTS = "v long, f int, n int, part array<long>"


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """The distinct shingles of a document, by hash."""
    return np.unique(wordhash.shingles(words, min(size, len(words)))) if len(words) else words


def sketch(documents: DataFrame, size: int) -> np.ndarray:
    """Counts of shingle hashes, by their top CELL_BITS bits; a table of fixed size."""
    chunks = 1 << (CELL_BITS - CHUNK_BITS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(1 << CELL_BITS, np.uint32)
        for batch in batches:
            for _, _, _, _, words in wordhash.text_words(batch.column("text"), wordhash.NOT_SPACE):
                if len(words):
                    grams = wordhash.shingles(words, min(size, len(words)))
                    np.add.at(cells, (grams >> np.uint64(64 - CELL_BITS)).astype(np.int64), np.uint32(1))
        rows = [zlib.compress(x.tobytes(), 1) for x in cells.reshape(chunks, -1)]
        yield pa.RecordBatch.from_arrays([pa.array(range(chunks), pa.int32()), pa.array(rows, pa.binary())], ["chunk", "cells"])

    def total(frame: pd.DataFrame) -> pd.DataFrame:
        cells = np.zeros(1 << CHUNK_BITS, np.uint64)
        for x in frame["cells"]:
            cells += np.frombuffer(zlib.decompress(x), np.uint32)
        logs = np.log2(np.maximum(cells, 1)).astype(np.uint8)
        return pd.DataFrame({"chunk": [int(frame["chunk"].iloc[0])], "cells": [zlib.compress(logs.tobytes(), 1)]})

    kind = "chunk int, cells binary"
    rows = documents.select("text").mapInArrow(count, kind).groupBy("chunk").applyInPandas(total, kind).collect()
    logs = np.zeros((chunks, 1 << CHUNK_BITS), np.uint8)
    for chunk, cells in rows:
        logs[chunk] = np.frombuffer(zlib.decompress(cells), np.uint8)
    return logs.ravel()


def ordered(grams: np.ndarray, logs: np.ndarray) -> np.ndarray:
    """Sorted places of shingles in the global order: the logarithm of the count, then the hash."""
    rank = logs[(grams >> np.uint64(64 - CELL_BITS)).astype(np.int64)].astype(np.uint64)
    return np.sort((rank << np.uint64(57)) | (grams >> np.uint64(7))).astype(np.int64)


def fragment_cuts(logs: np.ndarray, fragments: int) -> np.ndarray:
    """Cuts of the global order into fragments of about equal weight, by the counts in the sketch."""
    weight = np.zeros(64)
    np.add.at(weight, logs, np.exp2(logs.astype(float)))
    upto = np.cumsum(weight)
    cuts = []
    for k in range(1, fragments):
        goal = upto[-1] * k / fragments
        rank = int(np.searchsorted(upto, goal))
        share = (goal - (upto[rank] - weight[rank])) / weight[rank]
        cuts.append((rank << 57) + int(share * (1 << 57)))
    return np.array(cuts, np.int64)


def _named(grams: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(grams.tobytes(), digest_size=8).digest(), "little", signed=True)


def similar(documents: DataFrame, size: int = SIZE, percent: int = PERCENT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The sets (doc_id, v, n; ``v`` names the class of equal sets), the classes (v, least doc_id)
    that are not empty, and the links (a, b) between classes, enough of them to connect all that are
    connected."""
    spark = documents.sparkSession
    documents = documents.where("doc_id is not null").select("doc_id", "text")
    logs = sketch(documents, size)
    shared = spark.sparkContext.broadcast(logs)

    def prefixes(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        names, counts, parts = [], [], []
        for _, _, _, _, words in wordhash.text_words(batch.column("text"), wordhash.NOT_SPACE):
            grams = shingle_set(words, size)
            n = len(grams)
            names.append(_named(grams))
            counts.append(n)
            parts.append(ordered(grams, shared.value)[: n - -(-percent * n // 100) + 1 if n else 0])
        offsets = np.cumsum([0, *map(len, parts)])
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(parts)))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names, pa.int64()), pa.array(counts, pa.int32()), lists], ["doc_id", "v", "n", "prefix"])

    sets = staged(wordhash.mapped(documents, prefixes, SETS), "sets")
    classes = staged(sets.where("n > 0").groupBy("v").agg(F.min("doc_id").alias("least")), "classes")
    # One row for each class and shingle of its prefix, before any list is put together; size and place
    # share a column.
    rows = sets.select("v", "n", F.posexplode("prefix").alias("at", "token"))
    rows = rows.select("token", "v", F.shiftleft(F.col("n").cast("long"), 32).bitwiseOR(F.col("at").cast("long")).alias("size_at"))
    rows = staged(rows.distinct(), "tokens")
    names = staged(sets.drop("prefix"), "names")
    removed(sets)
    at_size = F.shiftleft("size_at", 32).bitwiseOR(F.shiftright("size_at", 32))
    pivots = rows.groupBy("token").agg(F.min_by("v", at_size).alias("pv"), F.count(F.lit(1)).alias("classes"))
    # Lists of one class only are of no use. Both sides are written tables, so a long list can be split.
    pivots = staged(pivots.where("classes > 1").drop("classes"), "pivots")
    listed = staged(rows.join(pivots.hint("shuffle_hash"), "token"), "lists")
    removed(rows, pivots)
    settled(spark)
    own = listed.where("v = pv").select(F.col("token").alias("_token"), F.col("size_at").alias("ps"))
    # The pivot's own row is added again below.
    lists = listed.where("v <> pv").join(own.hint("shuffle_hash"), F.col("token") == F.col("_token"))
    lists = staged(lists.select("token", "v", "size_at", "pv", "ps"), "lists")
    removed(listed)

    def may(one, other):
        """Whether the filters leave the pair, given sizes and places in the list."""
        n, m = F.shiftright(one, 32), F.shiftright(other, 32)
        i, j = one.bitwiseAND(F.lit(0xFFFFFFFF)), other.bitwiseAND(F.lit(0xFFFFFFFF))
        return (100 * n >= percent * m) & (100 * m >= percent * n) & ((100 + percent) * F.least(n - i, m - j) >= percent * (n + m))

    def pair(a, b):
        return F.least(a, b).alias("a"), F.greatest(a, b).alias("b")

    starred = lists.where(may(F.col("size_at"), F.col("ps"))).select(*pair(F.col("v"), F.col("pv"))).distinct()
    starred = staged(starred, "pairs")
    first = verified(documents, classes, starred, shared, size, percent)
    settled(spark)
    roots = components(first)
    settled(spark)
    # Every class of a list with its component.
    member = lists.select("token", "v", "size_at").unionByName(lists.select("token", F.col("pv").alias("v"), F.col("ps").alias("size_at"))).distinct()
    member = member.join(roots, member.v == roots.node, "left").select("token", "v", "size_at", F.coalesce("root", "v").alias("root"))
    member = staged(member, "members")
    counts = member.groupBy("token", "root").agg(F.count("*").alias("c"))
    most = counts.groupBy("token").agg(F.max(F.struct("c", "root"))["root"].alias("most"), F.count("*").alias("kinds")).where("kinds > 1").select("token", "most")
    other = member.join(most, "token")
    # Classes of a list meet only if their sizes may be alike: those of one bucket of sizes and the next.
    bucket = F.floor(F.log(F.shiftright("size_at", 32).cast("double")) / math.log(100 / percent)).cast("int")
    other = staged(other.withColumn("bucket", bucket), "others")
    left = other.where("root <> most").select(
        "token", F.explode(F.sequence(F.col("bucket") - 1, F.col("bucket") + 1)).alias("bucket"),
        F.col("v").alias("lv"), F.col("size_at").alias("ls"), F.col("root").alias("lr"),
    )
    crossed = left.join(other, ["token", "bucket"]).where((F.col("lr") != F.col("root")) & ((F.col("root") == F.col("most")) | (F.col("lv") < F.col("v"))))
    crossed = crossed.where(may(F.col("ls"), F.col("size_at"))).select(*pair(F.col("lv"), F.col("v"))).distinct()
    crossed = crossed.join(starred, ["a", "b"], "left_anti")
    crossed = staged(crossed, "pairs")
    removed(lists, member, starred, other)
    settled(spark)
    second = verified(documents, classes, crossed, shared, size, percent)
    removed(crossed)
    settled(spark)
    return names, classes, first.unionByName(second)


def _parts(documents: DataFrame, classes: DataFrame, wanted: DataFrame, logs, size: int, first: bool) -> DataFrame:
    """(v, f, n, part): the first fragment of the classes ``wanted`` (v), or all behind it.

    Only one document of a class is read for it, and which are comes as a bit field of fixed size
    that may also hit others; those are joined away.
    """
    cuts = fragment_cuts(logs.value, FRAGMENTS)
    named = wanted.join(classes.select("v", "least"), "v")
    field = documents.sparkSession.sparkContext.broadcast(bit_field(named, "least"))

    def parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        names, numbers, counts, lists = [], [], [], []
        batch = batch.filter(pa.array(may_have(field.value, batch.column("doc_id").to_numpy())))
        for _, _, _, _, words in wordhash.text_words(batch.column("text"), wordhash.NOT_SPACE):
            grams = shingle_set(words, size)
            keys = ordered(grams, logs.value)
            ends = [0, *np.searchsorted(keys, cuts).tolist(), len(keys)]
            for f in range(1) if first else range(1, FRAGMENTS):
                if first or ends[f] < ends[f + 1]:
                    names.append(_named(grams))
                    numbers.append(f)
                    counts.append(len(grams))
                    lists.append(keys[ends[f] : ends[f + 1]])
        if names:
            offsets = np.cumsum([0, *map(len, lists)])
            column = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(lists)))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(numbers, pa.int32()), pa.array(counts, pa.int32()), column], ["v", "f", "n", "part"])

    taken = wordhash.mapped(documents, parts, PARTS).join(wanted, "v", "left_semi")
    return staged(taken.groupBy("v", "f").agg(F.first("n").alias("n"), F.first("part").alias("part")), "parts")


def verified(documents: DataFrame, classes: DataFrame, pairs: DataFrame, logs, size: int, percent: int) -> DataFrame:
    """Those of the written pairs (a, b) of classes that reach the similarity: overlaps by fragment,
    summed.

    The overlap of the first fragment comes first, with the sizes of the rest as a bound; so only
    pairs that can still reach the similarity have their other fragments counted.
    """

    def sides(cut: DataFrame) -> tuple[DataFrame, DataFrame]:
        return tuple(
            cut.select(F.col("v").alias(x), "f", F.col("n").cast("long").alias(f"n{x}"), F.col("part").alias(f"part_{x}"))
            for x in ("a", "b")
        )

    def wanted(rows: DataFrame) -> DataFrame:
        return rows.select(F.explode(F.array("a", "b")).alias("v")).distinct()

    cut = _parts(documents, classes, wanted(pairs), logs, size, True)
    one, two = sides(cut)
    both = pairs.join(one.drop("f"), "a").join(two.drop("f"), "b")
    both = both.withColumn("common", F.size(F.array_intersect("part_a", "part_b")).cast("long"))
    rest = F.least(F.col("na") - F.size("part_a"), F.col("nb") - F.size("part_b"))
    able = both.where((100 + percent) * (F.col("common") + rest) >= percent * (F.col("na") + F.col("nb")))
    able = staged(able.select("a", "b", "na", "nb", "common"), "pairs")
    others = _parts(documents, classes, wanted(able), logs, size, False)
    # Every pair in every fragment, so that a class with many partners is spread over them.
    spread = able.select("a", "b", F.explode(F.array([F.lit(f) for f in range(1, FRAGMENTS)])).alias("f"))
    one, two = (x.drop("na", "nb") for x in sides(others))
    partial = spread.join(one, ["a", "f"]).join(two, ["b", "f"])
    partial = partial.select("a", "b", F.size(F.array_intersect("part_a", "part_b")).cast("long").alias("common"))
    summed = partial.unionByName(able.select("a", "b", "common")).groupBy("a", "b").agg(F.sum("common").alias("common"))
    known = summed.join(able.select("a", "b", "na", "nb"), ["a", "b"])
    links = staged(known.where(f"100 * common >= {percent} * (na + nb - common)").select("a", "b"), "similar")
    removed(cut, able, others)
    return links


def groups(documents: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document."""
    sets, classes, links = similar(documents, size, percent)
    roots = components(links)
    # The smallest doc_id of each component of classes.
    classes = classes.join(roots, classes.v == roots.node, "left").select("v", "least", F.coalesce("root", "v").alias("root"))
    classes = staged(classes, "classes")
    lowest = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    named = classes.join(lowest, "root").select("v", "component_id")
    found = sets.join(named, "v", "left")
    found = found.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))

    def count(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        n = [len(shingle_set(words, size)) for _, _, _, _, words in wordhash.text_words(batch.column("text"), wordhash.NOT_SPACE)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), batch.column("doc_id")], ["doc_id", "n_shingles", "component_id"])

    lost = documents.where("doc_id is null").select("doc_id", "text")
    return found.unionByName(wordhash.mapped(lost, count, "doc_id long, n_shingles long, component_id long"))


def one_of_each_group(documents: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """The rows of ``documents``, whole, of which each group keeps the one with the smallest doc_id (one
    without comes last; of rows of one doc_id the one read first). Rows are told apart by a number
    they get when they are written, so rows that share a doc_id, or have none, are judged each."""
    row, place = free("row", documents.columns), F.monotonically_increasing_id()
    kept = staged(documents.withColumn(row, place), "numbered")
    found = groups(kept.select(F.col(row).alias("doc_id"), "text"), size, percent)
    found = found.select(F.col("doc_id").alias("_row"), "component_id")
    named = kept.select(F.col(row).alias("_of"), F.col("doc_id").alias("_id")).join(found, F.col("_of") == F.col("_row"))
    order = F.struct(F.col("_id").isNull().alias("missing"), F.col("_id").alias("id"), F.col("_row").alias("row"))
    first = named.groupBy("component_id").agg(F.min(order)["row"].alias("_first")).select("_first")
    # Written, so that nothing of the search is held while the texts are dealt.
    first = staged(first, "leaders").hint("shuffle_hash")
    settled(documents.sparkSession)
    return kept.join(first, F.col(row) == F.col("_first"), "left_semi").select(*[F.col(f"`{c}`") for c in documents.columns])


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents of Jaccard similarity 0.85 over 4-word shingles; see the module."""
    return groups(table(spark, sf_dir, "documents"))
