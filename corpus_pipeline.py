"""A training-data pipeline over ``documents``: each stage works on all that the one before kept.

Stages: documents that are toxic go; of each group of near copies the smallest doc_id stays; text
that repeats an earlier document's is cut out; documents contaminated by the benchmark go; the rest
is packed into sequences. SQL cannot express the first stage (a trained model) or the last one, so
there is no SQL for the whole; tests hold the near copies, the repeats and the packing against brute
force, and the contamination against its SQL.

Rows: each row is judged by its own text or, among near copies, as a row of its own; a null or a
repeated doc_id lets no other row go. Of rows that are copies in everything one stays. Null and empty
texts are clean, have no near copies and nothing to cut; they stay, and are packed as their end
token. Very long texts are read whole. Ties of doc_id among near copies go to the row read first. All
stages but the last return the columns of ``documents``, whatever further columns these have; empty
tables give empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickbars.llm import decontamination, tables, toxicity as toxic
from tickbars.llm.ngram_join import one_of_each_group
from tickbars.llm.packing import TOKENIZER, pack
from tickbars.llm.substrings import deduplicated

ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score of 0.5 or more go."""
    return toxic.clean_rows(docs, toxic.fit(docs, tables.table(spark, sf_dir, "labels")))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, the one with the smallest doc_id."""
    tables.shipped(spark)
    return one_of_each_group(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has are cut out; a document of nothing else goes."""
    tables.shipped(spark)
    left = deduplicated(docs).where("n_passages = 0 or trim(text) <> ''")
    return left.select(*docs.columns)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go."""
    return decontamination.clean_rows(docs, tables.table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What stays, packed into sequences."""
    import public_tokenizers

    tables.shipped(spark)
    return pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("toxicity", toxicity),
    ("ngram_join", near_copies),
    ("substrings", repeats),
    ("decontamination", benchmark),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; each one's output is written and read again by the next."""
    docs = tables.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = tables.staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
