"""A Merkle manifest of a dataset: a digest for each row, a tree per source, a tree over the sources.

Sibling-shift self-joins: the nodes of a level know their place in their tree, so they can compute the
places of their siblings (XOR for a binary tree, offsets of the slot otherwise). Each level is joined
with itself once for each sibling, on tree and computed place; the rows of slot 0 then emit the parents.
Every key of these joins is one node, so no tree is too large for it and no key is hot, whatever share
of the rows one source holds.

Places come from one range shuffle of the digests, not of the texts: rows are sorted by (source, doc_id,
digest) in partitions, and the rows of a source in a partition come behind those in the partitions
before it, which a table of one row per partition and source tells.

Proofs are handed down: each node takes the path of its parent and puts its own siblings before it. So
paths are shipped once a level, from parents to children, and the levels shrink by the arity. Levels are
tables in the shared folder; a lost executor costs a read.

Rows: a null value is marked as such, unlike an empty one, in any column; a null source is the first
source, a null doc_id the first of its source; rows of equal doc_id stand in the order of their digests,
so repeated rows are leaves side by side; other columns are ignored, whatever their names; an empty table
gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickbars.llm.tables import removed, staged, table

ARITY = 3
# Fixed value: the columns of a leaf, in their order.
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")

# Bits of monotonically_increasing_id that count the rows of a partition.
ROW_BITS = 33
NO_DIGEST = bytearray()
NO_PATH = "cast(array() as array<struct<left: binary, right: binary>>)"


def hexed(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def digest(text: Column) -> Column:
    """sha256 as 32 bytes: half of what its hex text would ship."""
    return F.unhex(F.sha2(text.cast("binary"), 256))


def field(value: Column) -> Column:
    """A value with its length in bytes, so that no two rows run together to the same text."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    )


def leaf(**replaced: Column) -> Column:
    """The digest of a row, or of what it would be with other values."""
    return digest(F.concat(*[field(replaced.get(name, F.col(name))) for name in COLUMNS]))


def ranked(rows: DataFrame, group: list[str], order: list[str]) -> tuple[DataFrame, DataFrame]:
    """``rows`` with ``_place``, and (_part, *group, first, before, n): the first place of each group in
    each partition, the rows of the group in the partitions before, and all its rows."""
    placed = staged(
        rows.repartitionByRange(*[F.col(c).asc_nulls_first() for c in order])
        .sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in order])
        .withColumn("_place", F.monotonically_increasing_id()),
        "places",
    )
    runs = placed.groupBy(F.shiftright("_place", ROW_BITS).alias("_part"), *group).agg(
        F.min("_place").alias("first"), F.count(F.lit(1)).alias("_rows")
    )
    # One row per partition and group.
    whole = Window.partitionBy(*group)
    earlier = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return placed, runs.select(
        "_part", *group, "first",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("before"),
        F.sum("_rows").over(whole).alias("n"),
    )


def _position(placed: DataFrame, runs: DataFrame, group: list[str]) -> DataFrame:
    """``placed`` with ``idx`` and the other columns of its run."""
    given = runs.select(
        F.col("_part").alias("_run"), *[F.col(c).alias(f"_of_{c}") for c in group], *[c for c in runs.columns if c not in ("_part", *group)]
    )
    same = F.shiftright("_place", ROW_BITS) == F.col("_run")
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    joined = placed.join(given, same)
    return joined.withColumn("idx", F.col("before") + F.col("_place") - F.col("first")).drop("_run", "_place", "first", "before", *[f"_of_{c}" for c in group])


def nodes_of(leaves: DataFrame) -> tuple[DataFrame, int]:
    """``leaves`` (source, doc_id, digest, ...) with tree (the rank of the source), idx and n (leaves of
    the tree), and the number of leaves of the largest tree."""
    placed, runs = ranked(leaves, ["source"], ["source", "doc_id", "digest"])
    runs = staged(runs, "runs")
    sources = runs.groupBy("source").agg(F.max("n").alias("leaves"))
    trees = _position(*ranked(sources, [], ["source"]), [])
    trees = trees.select(F.col("source").alias("_source"), F.col("idx").alias("tree"))
    named = runs.join(trees, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    largest = runs.agg(F.max("n")).first()[0] or 0
    return _position(placed, named, ["source"]).drop("source"), largest


def with_siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """``nodes`` with the digests of their siblings: those before (left) and behind (right)."""
    slot = F.col("idx") % arity
    rows = nodes
    for shift in range(1, arity):
        there = F.col("idx").bitwiseXOR(F.lit(1).cast("long")) if arity == 2 else F.col("idx") - slot + (slot + shift) % arity
        other = nodes.select(F.col("tree").alias("_tree"), F.col("idx").alias("_idx"), F.col("digest").alias(f"_shift_{shift}"))
        rows = rows.withColumn("_there", there).join(other, (F.col("tree") == F.col("_tree")) & (F.col("_there") == F.col("_idx")), "left").drop("_tree", "_idx", "_there")
    shifts = [(shift, F.coalesce(F.col(f"_shift_{shift}"), F.lit(NO_DIGEST))) for shift in range(1, arity)]
    left = F.concat(*[F.when(slot + shift >= arity, d).otherwise(F.lit(NO_DIGEST)) for shift, d in shifts])
    right = F.concat(*[F.when(slot + shift < arity, d).otherwise(F.lit(NO_DIGEST)) for shift, d in shifts])
    return rows.withColumns({"left": left, "right": right}).drop(*[f"_shift_{shift}" for shift, _ in shifts])


def levels(nodes: DataFrame, largest: int, arity: int = ARITY) -> list[DataFrame]:
    """The levels of all trees, leaves first; a tree of n = 1 nodes ends with that level."""
    found = []
    while True:
        level = staged(with_siblings(nodes, arity), "level")
        found.append(level)
        if largest <= 1:
            return found
        largest = -(-largest // arity)
        nodes = level.where((F.col("idx") % arity == 0) & (F.col("n") > 1)).select(
            "tree",
            F.expr(f"idx div {arity}").alias("idx"),
            F.ceil(F.col("n") / arity).alias("n"),
            digest(F.concat(hexed(F.col("digest")), hexed(F.col("right")))).alias("digest"),
        )


def subroots(tree_levels: list[DataFrame]) -> DataFrame:
    """(tree, digest) of each tree."""
    tops = [level.where("n = 1").select("tree", "digest") for level in tree_levels]
    return tops[0] if len(tops) == 1 else tops[0].unionByName(_union(tops[1:]))


def _union(frames: list[DataFrame]) -> DataFrame:
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame)
    return first


def paths(tree_levels: list[DataFrame], above: DataFrame | None = None, arity: int = ARITY) -> DataFrame:
    """The leaves with subroot, root and path: for each level from the leaf on, the siblings before and
    behind. ``above`` has (tree, root, path) of the trees' own roots; without it they are the root."""
    handed, step = None, F.array(F.struct("left", "right"))
    for number, level in reversed(list(enumerate(tree_levels))):
        kept = [c for c in level.columns if c not in ("left", "right")]
        top = level.where("n = 1")
        if above is None:
            rows = top.select(*kept, F.col("digest").alias("subroot"), F.col("digest").alias("root"), F.expr(NO_PATH).alias("path"))
        else:
            given = above.select(F.col("tree").alias("_tree"), "root", "path")
            rows = top.join(given, F.col("tree") == F.col("_tree")).select(*kept, F.col("digest").alias("subroot"), "root", "path")
        if handed is not None:
            given = handed.select(F.col("tree").alias("_tree"), F.col("idx").alias("_parent"), "subroot", "root", F.col("path").alias("_path"))
            below = level.where("n > 1").join(given, (F.col("tree") == F.col("_tree")) & (F.expr(f"idx div {arity}") == F.col("_parent")))
            rows = rows.unionByName(below.select(*kept, "subroot", "root", F.concat(step, F.col("_path")).alias("path")))
        if number == 0:
            return rows
        before, handed = handed, staged(rows.select("tree", "idx", "subroot", "root", "path"), "paths")
        if before is not None:
            removed(before)
    return rows


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, start, lambda acc, s: digest(F.concat(hexed(s["left"]), hexed(acc), hexed(s["right"]))))


def siblings(path: Column) -> Column:
    """All siblings of a path as hex text, from the leaf to the root, left to right."""
    return F.concat_ws("", F.transform(path, lambda s: F.concat(hexed(s["left"]), hexed(s["right"]))))


def manifest(leaves: DataFrame, arity: int = ARITY) -> DataFrame:
    """``leaves`` (source, doc_id, digest and any other columns but tree, idx, n, left, right, root,
    subroot, path) with tree, idx, n, subroot, root and path; source is left out."""
    nodes, largest = nodes_of(staged(leaves, "leaves"))
    trees = levels(nodes, largest, arity)
    tops = staged(subroots(trees), "subroots")
    count = tops.count()
    over = levels(tops.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("idx"), F.lit(count).cast("long").alias("n"), "digest"), count, arity)
    above = staged(paths(over, arity=arity).select(F.col("idx").alias("tree"), "root", "path"), "above")
    return paths(trees, above, arity)


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all documents, and what verification says where every second one, by crc32 of its
    doc_id, has lost its line feeds."""
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    without = F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    documents = table(spark, sf_dir, "documents").select(*COLUMNS)
    leaves = documents.select("source", "doc_id", leaf().alias("digest"), leaf(text=without).alias("found"))
    rows = manifest(leaves).withColumn("_folded", folded(F.col("found"), F.col("path")))
    return rows.select(
        "doc_id",
        hexed(F.col("digest")).alias("leaf"),
        hexed(F.col("subroot")).alias("subroot"),
        hexed(F.col("root")).alias("root"),
        F.sha2(siblings(F.col("path")).cast("binary"), 256).alias("proof_sha256"),
        hexed(F.col("_folded")).alias("folded_root"),
        (F.col("_folded") == F.col("root")).alias("verified"),
    )
