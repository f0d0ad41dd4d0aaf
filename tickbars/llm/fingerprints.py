"""Homomorphic document fingerprints: sums of wide vectors hashed from paragraphs, modulo powers of 2.

The vector of a paragraph (a line with something in it) has two parts:

* ``IDENTITY`` lanes of 32 bits hashed from the paragraph as a whole. Their sums are equal for
  equal multisets of paragraphs, in whatever order, and practically for no others.
* ``3 * SHIFTS * SEEDS`` lanes of LANE bits that sketch what the paragraph holds: each run of up to
  ``RUN`` words, counted from its start, adds a hashed bit to every lane. With the number of runs,
  a lane gives a sum of random signs, so the squared distance of two sketches estimates in how many
  runs the texts differ.

Lanes only add up, so the fingerprint of a text after paragraphs were put in or taken out is the old
one plus or minus theirs (:func:`added`); nothing else has to be read again. Lanes are packed three to
a long and added without carry from one to the next, each modulo 2^LANE.

Only built-in expressions are used. Rows: a null text is empty (its lanes are 0 and two empty texts
are alike: 1.0); rows of equal doc_id are ordered by text; a null doc_id has no next document and is
edited with an empty one; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickbars.llm.tables import table

IDENTITY = 8
SEEDS = 2
RUN = 8
WORD = 32
BUCKETS, MOST_BUCKETS, FAN = 8, 4096, 64

# Lanes of 21 bits, three to a long; of the bits of a hash, the first SHIFTS of each lane count.
LANE, SHIFTS = 21, 16
STEP = 1 << 20
_LANES = 1 | 1 << LANE | 1 << 2 * LANE
_HIGH = _LANES << LANE - 1
_LOW = _LANES * ((1 << LANE - 1) - 1)
_EMPTY = "named_struct('identity', array_repeat(0L, {i}), 'lanes', array_repeat(0L, {n}), 'runs', 0L)"


def lit(n: int) -> Column:
    return F.lit(n).cast("long")


def _summed(values: Column, value) -> Column:
    return F.aggregate(values, lit(0), lambda total, x: total + value(x))


def _plus(x: Column, y: Column) -> Column:
    """Three sums at once, without carry: the upper bits of the lanes apart from the rest."""
    low, high = lit(_LOW), lit(_HIGH)
    return (x.bitwiseAND(low) + y.bitwiseAND(low)).bitwiseXOR(x.bitwiseXOR(y).bitwiseAND(high))


def _laned(hashes: Column, k: int) -> Column:
    """Sum of the bits k, k + LANE and k + 2 LANE of the hashes, in lanes.

    Up to STEP hashes no lane can overflow and plain sums do; their results are added without carry.
    """

    def step(values: Column) -> Column:
        return _summed(values, lambda h: F.shiftright(h, k).bitwiseAND(lit(_LANES)))

    steps = F.sequence(F.lit(0), F.floor((F.size(hashes) - 1) / STEP).cast("int"))
    many = F.aggregate(steps, lit(0), lambda total, n: _plus(total, step(F.slice(hashes, n * STEP + 1, F.lit(STEP)))))
    return F.when(F.size(hashes) <= STEP, step(hashes)).otherwise(many)


def with_fingerprint(rows: DataFrame, text: str, name: str) -> DataFrame:
    """``rows`` with the fingerprint of the column ``text`` as the struct ``name``."""
    paragraphs = F.filter(F.split(F.col(text), "\n"), lambda p: p != "")
    runs = F.expr(f"regexp_extract_all({text}, r'(?:\\S{{1,{WORD}}}[^\\S\\n]*){{1,{RUN}}}', 0)")
    rows = rows.withColumn("_paragraphs", paragraphs).withColumn("_runs", runs)
    for seed in range(SEEDS):
        # (A second parameter of the function would be the place in the array.)
        rows = rows.withColumn(f"_h{seed}", F.expr(f"transform(_runs, x -> xxhash64({seed}, x))"))
    identity = [
        _summed(F.col("_paragraphs"), lambda p, k=k: F.shiftrightunsigned(F.xxhash64(F.lit(100 + k), p), 32))
        for k in range(IDENTITY)
    ]
    lanes = [
        _laned(F.col(f"_h{seed}"), k)
        for seed in range(SEEDS)
        for k in range(SHIFTS)
    ]
    mark = F.struct(
        F.transform(F.array(*identity), lambda x: x.bitwiseAND(lit(0xFFFFFFFF))).alias("identity"),
        F.array(*lanes).alias("lanes"),
        F.size("_runs").cast("long").alias("runs"),
    )
    return rows.withColumn(name, mark).drop("_paragraphs", "_runs", *[f"_h{seed}" for seed in range(SEEDS)])


def added(one: Column, other: Column, sign: int = 1) -> Column:
    """The fingerprint of two texts' paragraphs together (``sign`` 1), or of what is left of ``one``
    when the paragraphs of ``other`` are taken out (-1)."""

    def lanes(x: Column, y: Column) -> Column:
        if sign < 0:
            low, high = lit(_LOW), lit(_HIGH)
            return (x.bitwiseOR(high) - y.bitwiseAND(low)).bitwiseXOR(x.bitwiseXOR(F.bitwise_not(y)).bitwiseAND(high))
        return _plus(x, y)

    return F.struct(
        F.zip_with(one["identity"], other["identity"], lambda x, y: (x + sign * y).bitwiseAND(lit(0xFFFFFFFF))).alias("identity"),
        F.zip_with(one["lanes"], other["lanes"], lanes).alias("lanes"),
        (one["runs"] + sign * other["runs"]).alias("runs"),
    )


def _square(lanes: Column, runs: Column) -> Column:
    """Sum of the squares of the signed lanes: of a pair (x, y) of packed lanes, x minus y."""

    def of(pair: Column) -> Column:
        total = None
        for s in (0, LANE, 2 * LANE):
            x, y = (F.shiftright(pair[side], s).bitwiseAND(lit((1 << LANE) - 1)) for side in ("x", "y"))
            d = (F.pmod(2 * (x - y) - runs + (1 << LANE), lit(2 << LANE)) - (1 << LANE)).cast("double")
            total = d * d if total is None else total + d * d
        return total

    return F.aggregate(lanes, F.lit(0.0), lambda total, pair: total + of(pair))


def likeness(one: Column, other: Column) -> Column:
    """From 0 to 1: one minus the estimated squared distance over the sum of the squared sizes."""

    def pairs(a: Column, b: Column | None) -> Column:
        if b is None:
            return F.transform(a, lambda x: F.struct(x.alias("x"), lit(0).alias("y")))
        return F.zip_with(a, b, lambda x, y: F.struct(x.alias("x"), y.alias("y")))

    apart = _square(pairs(one["lanes"], other["lanes"]), one["runs"] - other["runs"])
    sizes = _square(pairs(one["lanes"], None), one["runs"]) + _square(pairs(other["lanes"], None), other["runs"])
    return F.when(sizes == 0, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), 1 - apart / sizes))


def written(mark: Column) -> Column:
    """The fingerprint as text: identity lanes, runs and sketch lanes in hexadecimal."""
    short = F.array_join(F.transform(mark["identity"], lambda x: F.lpad(F.hex(x), 8, "0")), "")
    lanes = F.array_join(F.transform(mark["lanes"], lambda x: F.lpad(F.hex(x), 16, "0")), "")
    return F.concat_ws("-", short, F.hex(mark["runs"]), lanes)


def _bucket(documents: DataFrame) -> Column:
    """The bucket of a doc_id: ranges of ids with about as many rows each, however the ids lie. There are
    BUCKETS for each shuffle partition, at most MOST_BUCKETS; found among so many bounds in two steps."""
    spark = documents.sparkSession
    n = min(MOST_BUCKETS, BUCKETS * int(spark.conf.get("spark.sql.shuffle.partitions")))
    bounds = documents.agg(F.percentile_approx("doc_id", [k / n for k in range(1, n)], 20 * n)).first()[0]
    bounds = sorted(set(bounds or []))
    parts = [bounds[k : k + FAN] for k in range(0, len(bounds), FAN)] or [[]]

    def behind(bounds: Column) -> Column:
        return F.size(F.filter(bounds, lambda b: b < F.col("doc_id")))

    longs = "array<long>"
    upper = behind(F.array(*[lit(part[-1]) for part in parts[:-1]]).cast(longs))
    fine = F.array(*[F.array(*[lit(b) for b in part]).cast(longs) for part in parts])
    return upper * (FAN + 1) + behind(F.element_at(fine, upper + 1))


def _next_firsts(documents: DataFrame) -> DataFrame:
    """For each bucket (one row, MOST_BUCKETS at most), the first doc_id behind it (behind the last: the
    first of all)."""
    rows = documents.groupBy("block").agg(F.min("doc_id").alias("first")).collect()
    firsts = sorted((r["block"], r["first"]) for r in rows)
    links = [(block, firsts[(k + 1) % len(firsts)][1]) for k, (block, _) in enumerate(firsts)]
    return documents.sparkSession.createDataFrame(links, "block int, first long")


def with_next(documents: DataFrame, columns: list[str], more: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``more(documents)`` with ``columns`` of the document that follows by doc_id, as ``next_*``.

    Buckets of ids are the windows; the one document behind a bucket comes from a table with a row
    for each bucket. ``more`` adds columns row by row.
    """
    rows = documents.withColumn("block", _bucket(documents.select("doc_id")))
    links = F.broadcast(_next_firsts(rows.where("doc_id is not null").select("doc_id", "block")))
    behind = more(rows.drop("block").join(links.select(F.col("first").alias("doc_id"), F.col("block").alias("before")), "doc_id"))
    behind = behind.groupBy("before").agg(F.min(F.struct(*columns)).alias("behind")).withColumnRenamed("before", "block")
    order = Window.partitionBy("block").orderBy("doc_id", "text")
    known = more(rows.where("doc_id is not null")).withColumn("lead", F.lead(F.struct(*columns)).over(order))
    known = known.join(behind, "block", "left").withColumn("next", F.coalesce("lead", "behind")).drop("block", "lead", "behind")
    known = known.select(*[c for c in known.columns if c != "next"], *[F.col(f"next.{c}").alias(f"next_{c}") for c in columns])
    lost = more(documents.where("doc_id is null"))
    lost = lost.select("*", *[F.lit(None).cast(known.schema[c].dataType).alias(f"next_{c}") for c in columns])
    return known.unionByName(lost)


def fingerprints(documents: DataFrame) -> DataFrame:
    """Fingerprints of all texts and of their edited forms, and how alike they are."""
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(rows, ["text", "mark"], lambda x: with_fingerprint(x, "text", "mark"))
    empty = F.expr(_EMPTY.format(i=IDENTITY, n=SHIFTS * SEEDS))
    rows = rows.withColumn("n_chars", F.length("text").cast("long")).withColumn("next_mark", F.coalesce("next_mark", empty))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half),
        F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), half),
    )
    rows = rows.withColumn("edited", edited).drop("text", "next_text")
    rows = with_fingerprint(rows, "edited", "edited_mark")
    mark, new = F.col("mark"), F.col("edited_mark")
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        written(mark).alias("fingerprint"),
        written(new).alias("edited_fingerprint"),
        likeness(mark, new).alias("near_edited"),
        likeness(mark, F.col("next_mark")).alias("near_next"),
    )


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents; see the module."""
    return fingerprints(table(spark, sf_dir, "documents"))
