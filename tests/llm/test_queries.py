"""The registered queries and the pipeline over the smallest tables."""

import os
import re

import corpus_pipeline
import duckdb
import pytest
from compare import both
from llm.cases import lower
from llm.test_operators import without_passages
from pyspark.sql import functions as F
from tickbars.llm import queries

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    our_columns, ours, their_columns, theirs = both(spark, name, FOLDER)
    assert our_columns == their_columns and ours == theirs and ours


def test_one_query_for_each_operator():
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in queries.QUERIES) == list(range(1, 14))


def test_stages_equal_brute_force(spark):
    """Near copies and repeated passages of the smallest table."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    split = {i: re.findall(r"[^\x20\x09-\x0D]+", lower(t)) for i, t in rows}
    sets = {i: {tuple(w[k : k + 4]) for k in range(max(1, len(w) - 3))} if w else set() for i, w in split.items()}
    least = {i: i for i in sets}
    for a in sets:
        for b in sets:
            if a < b and sets[a] and min(len(sets[a]), len(sets[b])) * 100 >= 85 * max(len(sets[a]), len(sets[b])):
                both = len(sets[a] & sets[b])
                if 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((least[a], least[b]))
                    least = {k: x if v == y else v for k, v in least.items()}
    kept = corpus_pipeline.near_copies(spark, docs, FOLDER).collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(least.values()))
    want = {i: w for i, w, n in without_passages(rows) if w or not n}
    got = {r.doc_id: tuple(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in corpus_pipeline.repeats(spark, docs, FOLDER).collect()}
    assert got == want


def test_pipeline(spark, tmp_path):
    given = spark.read.parquet(f"{FOLDER}/documents.parquet")
    docs, kept = given, []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, FOLDER)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept.append(docs)
    assert all(x.columns == given.columns for x in kept[:-1])
    ids = [{r.doc_id for r in x.select("doc_id").collect()} for x in kept]
    assert all(b <= a for a, b in zip(ids, ids[1:])) and ids[-1] == ids[-2]
    # Toxic rows that were labelled go, clean ones stay.
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    assert all(i in ids[0] for i, toxic in labels.items() if not toxic)
    # No two documents of the same words are left after the second stage.
    words = [tuple(lower(r.text).split()) for r in kept[1].collect()]
    assert len(words) == len(set(words))
    # No clean document left in the fourth.
    con = duckdb.connect()
    con.register("documents", kept[3].toPandas())
    con.execute(f"create view benchmark as select * from '{FOLDER}/benchmark.parquet'")
    assert con.execute(f"select count(*) from ({queries.CONTAMINATION_SQL}) where contaminated").fetchall() == [(0,)]
    assert kept[4].agg(F.countDistinct("doc_id")).first()[0] == kept[3].select("doc_id").distinct().count()
    assert corpus_pipeline.run(spark, FOLDER).count() == kept[4].count()
