"""Chat formatting with Spark expressions only.

The turns of a conversation are collected as structs and sorted; adjacent turns of one role are
merged; every merged turn becomes

    <|role|>text<|more|>text<|end|>

and the marks are unambiguous, since ``\\``, ``<`` and ``|`` inside roles and texts are written as
``\\b``, ``\\l`` and ``\\p``. ``<|more|>`` keeps the turns apart that were merged, so the format can
be read back whole. The loss mask is a list of spans (start, length in code points), one for each
assistant text; marks are outside.

A conversation becomes one row, so it is as large as its text: that is what is asked for. Rows: a
null text is empty, a null role is written as an empty one; turns of equal number are sorted by role
and text, null numbers first; repeated rows stay; rows without conv_id are one conversation; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickbars.llm.tables import table

# The format's marks.
OPEN, SHUT, MORE, END = "<|", "|>", "<|more|>", "<|end|>"
LEARNED = "assistant"
# Fixed value: the conversation that is added to the table.
EXTRA_ID, EXTRA_TEXT = -7, "</s>[INST] ok [/INST]"
STEP = 256


def escaped(text: Column) -> Column:
    """Text without a mark in it."""
    for plain, code in (("\\", "\\b"), ("<", "\\l"), ("|", "\\p")):
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescaped(text: Column) -> Column:
    for plain, code in (("|", "\\p"), ("<", "\\l"), ("\\", "\\b")):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def _starts(sizes: Column) -> Column:
    """Sum of the elements before each one: within steps of STEP, then over the steps."""

    def run(values: Column) -> Column:
        nothing = F.struct(F.lit(0).cast("long").alias("sum"), F.array().cast("array<long>").alias("before"))
        return F.aggregate(
            values,
            nothing,
            lambda a, x: F.struct((a["sum"] + x).alias("sum"), F.concat(a["before"], F.array(a["sum"])).alias("before")),
        )

    count = F.ceil(F.size(sizes) / F.lit(STEP)).cast("int")
    steps = F.transform(F.sequence(F.lit(1), count), lambda k: run(F.slice(sizes, (k - 1) * STEP + 1, F.lit(STEP))))
    bases = run(F.transform(steps, lambda s: s["sum"]))["before"]
    return F.flatten(F.zip_with(steps, bases, lambda s, base: F.transform(s["before"], lambda x: x + base)))


def formatted(conversations: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_spans) of each conversation."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    rows = rows.withColumn(
        "turns", F.transform("turns", lambda t: F.struct(escaped(t["role"]).alias("role"), escaped(t["text"]).alias("text")))
    )
    turns = F.col("turns")
    # Where a merged turn begins, and, as the end of the last one, the number behind all turns.
    begins = F.filter(
        F.sequence(F.lit(1), F.size(turns)),
        lambda k: (k == 1) | (F.get(turns, k - 1)["role"] != F.get(turns, F.greatest(k - 2, F.lit(0)))["role"]),
    )
    rows = rows.withColumn("begins", begins)
    ends = F.concat(F.slice("begins", F.lit(2), F.size("begins")), F.array(F.size(turns) + 1))
    rows = rows.withColumn("ends", ends)
    merged = F.zip_with(
        "begins",
        "ends",
        lambda a, b: F.struct(
            F.get(turns, a - 1)["role"].alias("role"),
            F.transform(F.slice(turns, a, b - a), lambda t: t["text"]).alias("texts"),
        ),
    )
    rows = rows.withColumn("merged", merged)
    text = F.array_join(
        F.transform(
            "merged",
            lambda m: F.concat(F.lit(OPEN), m["role"], F.lit(SHUT), F.array_join(m["texts"], MORE), F.lit(END)),
        ),
        "",
    )
    # The pieces in order: each text with the length of the mark before it and behind it.
    pieces = F.flatten(
        F.transform(
            "merged",
            lambda m: F.transform(
                m["texts"],
                lambda t, k: F.struct(
                    (m["role"] == LEARNED).alias("learned"),
                    F.when(k == 0, F.length(m["role"]) + len(OPEN + SHUT)).otherwise(len(MORE)).cast("long").alias("mark"),
                    F.length(t).cast("long").alias("length"),
                    F.when(k == F.size(m["texts"]) - 1, len(END)).otherwise(0).cast("long").alias("end"),
                ),
            ),
        )
    )
    rows = rows.select("conv_id", text.alias("formatted"), pieces.alias("pieces"))
    rows = rows.withColumn("starts", _starts(F.transform("pieces", lambda p: p["mark"] + p["length"] + p["end"])))
    spans = F.zip_with(
        "pieces",
        "starts",
        lambda p, s: F.struct((s + p["mark"]).alias("start"), p["length"].alias("length"), p["learned"].alias("learned")),
    )
    spans = F.transform(F.filter(spans, lambda s: s["learned"]), lambda s: F.struct(s["start"], s["length"]))
    return rows.select("conv_id", "formatted", spans.alias("loss_spans"))


def turns_of(text: Column) -> Column:
    """The turns (role, text) read back from the format."""
    merged = F.filter(F.split(text, r"<\|end\|>"), lambda m: m != "")
    return F.flatten(
        F.transform(
            merged,
            lambda m: F.transform(
                F.split(F.substring(m, F.instr(m, SHUT) + len(SHUT), F.length(m)), r"<\|more\|>"),
                lambda t: F.struct(
                    unescaped(F.substring(m, F.lit(len(OPEN) + 1), F.instr(m, SHUT) - len(OPEN) - 1)).alias("role"),
                    unescaped(t).alias("text"),
                ),
            ),
        )
    )


def learned(text: Column, spans: Column) -> Column:
    """The text under the loss mask, unescaped."""
    return F.array_join(
        F.transform(
            spans, lambda s: unescaped(F.substring(text, s["start"].cast("int") + 1, s["length"].cast("int")))
        ),
        "",
    )


def read_back(rows: DataFrame) -> DataFrame:
    """Counts and digests of what the formatted rows hold."""
    rows = rows.withColumn("turns", turns_of(F.col("formatted"))).withColumn("loss", learned(F.col("formatted"), F.col("loss_spans")))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return rows.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and the extra one, formatted and read back; see the module."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(EXTRA_ID).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise(LEARNED).alias("role"),
        F.lit(EXTRA_TEXT).alias("text"),
    )
    return read_back(formatted(rows.unionByName(extra)))
