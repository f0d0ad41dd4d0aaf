"""Whole rows, judged each by itself: stages of the pipeline, names that clash, neighbours, labels."""

import hashlib
import math
import os
import random

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from llm import cases
from llm.test_operators import labelled
from pyspark.sql import functions as F
from tickbars.llm import decontamination, extraction, fingerprints, language, ngram_join, substrings, tables, toxicity
from tickbars.llm.tables import held_out

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
LARGER = "/root/testdata/sf0.1"
CLASHING = "doc_id long, text string, lang string, source string, n_chars long, _id long, _windows array<long>, windows string, of_id int, hit string, row long, _row long, score double, places int"


def clashing(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 7, 1, [1], "w", 2, "h", 3, 4, 0.5, 6) for i, t in rows], CLASHING)


def as_rows(frame):
    return sorted(((r.doc_id, r.text) for r in frame.collect()), key=str)


def test_a_toxic_row_takes_no_other_with_it(spark):
    """Rows without doc_id, and two rows of one doc_id, one toxic and one clean each."""
    rows, _, known = labelled(spark)
    model = toxicity.fit(cases.frame(spark, rows), known)
    toxic, clean = "vilest scornful Rotten scorning vilest", "the cat sat down"
    given = [(None, toxic), (None, clean), (77, toxic), (77, clean), (78, None), (79, "")]
    kept = toxicity.clean_rows(clashing(spark, given), model)
    assert as_rows(kept) == sorted([(None, clean), (77, clean), (78, None), (79, "")], key=str)
    assert kept.columns == clashing(spark, given).columns and kept.first()["_windows"] == [1]
    assert toxicity.clean_rows(clashing(spark, given), None).count() == 6


@pytest.mark.parametrize("limit", (1 << 20, 300))
def test_a_contaminated_row_takes_no_other_with_it(spark, limit, monkeypatch):
    """Read in one block or in many, of which each holds a part of what a row has of the benchmark."""
    rng = random.Random(2)
    items = [(k, cases.prose(rng, 16)) for k in range(12)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    if limit < 1 << 20:
        kept = decontamination.blocks
        monkeypatch.setattr(decontamination, "blocks", lambda b: kept(b, limit))
    clean = cases.prose(rng, 40)
    # One item is under a twentieth of the words here, two are enough.
    long = cases.prose(rng, 400)
    some, enough = f"{long} {items[1][1]}", f"{items[2][1]} {long} {items[3][1]}"
    given = [(None, items[0][1]), (None, clean), (77, items[0][1]), (77, clean), (78, None), (79, some), (80, enough)]
    found = decontamination.clean_rows(clashing(spark, given), benchmark)
    assert as_rows(found) == sorted([(None, clean), (77, clean), (78, None), (79, some)], key=str)
    assert found.columns == clashing(spark, given).columns
    assert decontamination.clean_rows(clashing(spark, given), benchmark.limit(0)).count() == 7


def test_near_copies_are_rows_of_their_own(spark):
    rng = random.Random(6)
    text, other, third = (cases.prose(rng, 50) for _ in range(3))
    given = [(9, text), (9, text), (9, other), (3, other + " end"), (None, text), (None, third), (8, None), (8, ""), (8, third)]
    found = ngram_join.one_of_each_group(clashing(spark, given))
    assert as_rows(found) == sorted([(9, text), (3, other + " end"), (8, None), (8, ""), (8, third)], key=str)
    assert found.columns == clashing(spark, given).columns


def test_substrings_keep_clashing_columns(spark):
    rng = random.Random(7)
    passage = cases.prose(rng, 70)
    given = [(1, passage), (2, "a b " + passage), (None, passage)]
    found = substrings.deduplicated(clashing(spark, given))
    assert sorted(((r.doc_id, r.text.strip()) for r in found.collect()), key=str) == sorted([(1, passage), (2, "a b"), (None, passage)], key=str)
    assert {r["_windows"][0] for r in found.collect()} == {1} and {r["_id"] for r in found.collect()} == {1}


def test_stages_with_odd_tables(spark):
    """Nulls, empty and long texts, repeats, clashing names; and no rows at all."""
    docs = clashing(spark, cases.texts())
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, FOLDER).columns == docs.columns, name
        assert stage(spark, docs.where("false"), FOLDER).count() == 0, name
    clean = corpus_pipeline.benchmark(spark, corpus_pipeline.toxicity(spark, docs, FOLDER), FOLDER)
    assert as_rows(clean) == as_rows(docs)
    packed = corpus_pipeline.packing(spark, docs, FOLDER)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {i for i, _ in cases.texts()}
    assert corpus_pipeline.packing(spark, docs.where("false"), FOLDER).count() == 0


WRAPPED = {
    '<div class="layout has-sidebar"><article><p>Text.</p></article></div>': "Text.",
    '<div id="page" class="hfeed no-comments"><main><p>Text.</p></main></div>': "Text.",
    '<article class="post category-social"><p>Text.</p></article>': "Text.",
    '<div class="social"><main><h1>Head</h1><p>Text.</p><nav>Menu</nav></main></div>': "Head\n\nText.",
    '<div class="widget-area"><div class="sidebar"><article><p>Text.</p></article></div></div>': "Text.",
    '<article><p>Text.</p><div class="share">Share</div></article><div class="related"><article>Teaser</article></div>': "Text.",
    '<main><article><p>Text.</p></article><section id="comments"><article class="comment">Reply</article></section></main>': "Text.",
    '<article><p>Text.</p></article><ol><li><article class="comment even">Reply</article></li></ol>': "Text.",
    '<div class="sidebar">Menu</div><article class="tags"><p>Text.</p></article>': "Text.",
    '<footer class="x"><article>Imprint</article></footer><article><p>Text.</p></article>': "Text.",
    '<div class="cookie-banner">Cookies</div><div class="no-sidebar"><p>Text.</p></div>': "Text.",
    '<div class="has-ads with-sidebar is-page"><p>Text.</p></div>': "Text.",
    '<nav>Menu</nav><div class="menu">Menu</div>': "",
}


@pytest.mark.parametrize("page", WRAPPED)
def test_names_of_wrappers(spark, page):
    rows = spark.createDataFrame([(1, "http://a.example/", f"<html><body>{page}</body></html>")], "page_id long, url string, html string")
    assert extraction.extracted(rows).first().text == WRAPPED[page]


def test_a_page_of_nothing_but_boilerplate_is_empty(spark):
    rng = random.Random(3)
    notice = cases.prose(rng, 40)
    pages = [(k, "http://a.example/", f"<div>{notice}</div><div>{cases.prose(rng, 30)}</div>") for k in range(4)]
    pages.append((9, "http://a.example/9", f"<div>{notice}</div>"))
    rows = spark.createDataFrame(pages, "page_id long, url string, html string")
    found = {r.page_id: r.text for r in extraction.extracted(rows).collect()}
    assert found[9] == "" and all(len(found[k].split()) == 30 for k in range(4))


def test_profiles_do_not_depend_on_neighbours():
    rng = random.Random(1)
    texts = ["ein", "", "x", None, "Ünïcode", "ab", *[cases.prose(rng, rng.randint(1, 30)) for _ in range(30)]]
    alone = {t: next(language.profiles(pa.array([t], pa.string())))[1:] for t in texts}
    for _ in range(10):
        rng.shuffle(texts)
        for row, profile, some in language.profiles(pa.array(texts, pa.string())):
            assert np.array_equal(profile, alone[texts[row]][0]) and some == alone[texts[row]][1]


def test_label_model_equals_plain_expectation_maximization():
    """Voters that do not depend on each other, against loops over rows and voters."""
    rng = np.random.default_rng(5)
    hidden = rng.random(400) < 0.3
    votes = np.zeros((400, 4), np.int8)
    for voter, (hit, miss) in enumerate(((0.8, 0.02), (0.6, 0.05), (0.7, 0.01))):
        votes[rng.random(400) < np.where(hidden, hit, miss), voter] = 1
    votes[(votes[:, :3] == 0).all(axis=1), 3] = -1
    start = np.where(votes[:, 3] < 0, 0.02, 0.9)
    posterior = [float(x) for x in start]
    for _ in range(toxicity.ROUNDS):
        prior = min(max(sum(posterior) / 400, 1e-4), 1 - 1e-4)
        ones, zeros = sum(posterior) + 1, 400 - sum(posterior) + 1
        new = []
        rates = {}
        for v in range(4):
            for value in (1, -1):
                yes = sum(p for p, x in zip(posterior, votes[:, v], strict=True) if x == value) + 0.1
                no = sum(1 - p for p, x in zip(posterior, votes[:, v], strict=True) if x == value) + 0.1
                rates[v, value] = math.log(yes / ones * zeros / no)
        for row in votes:
            logit = math.log(prior / (1 - prior)) + sum(rates[v, int(x)] for v, x in enumerate(row) if x)
            new.append(1 / (1 + math.exp(-min(max(logit, -30), 30))))
        moved, posterior = max(abs(a - b) for a, b in zip(new, posterior, strict=True)), new
        if moved < 1e-4:
            break
    correlated, toxicity.CORRELATED = toxicity.CORRELATED, 2.0
    try:
        found, parameters = toxicity.label_model(votes, start)
    finally:
        toxicity.CORRELATED = correlated
    assert np.allclose(found, posterior, atol=1e-6)
    assert ((found > 0.5) == hidden).mean() > 0.93 and parameters["accuracy"].min() > 0.8


def test_a_voter_that_repeats_another_does_not_count_twice():
    votes = np.zeros((200, 3), np.int8)
    votes[:40, 0] = votes[20:60, 1] = 1
    votes[60:, 2] = -1
    once, _ = toxicity.label_model(votes, np.where(votes[:, 2] < 0, 0.02, 0.9))
    many, _ = toxicity.label_model(votes[:, [0, 0, 0, 0, 1, 2]], np.where(votes[:, 2] < 0, 0.02, 0.9))
    assert ((once > 0.5) == (many > 0.5)).all()


@pytest.mark.skipif(not os.path.exists(f"{LARGER}/labels.parquet"), reason="needs the larger tables")
def test_held_out_recall_of_toxicity(spark):
    """Nine in ten toxic documents of all languages are found, and hardly a clean one."""
    documents, labels = (spark.read.parquet(f"{LARGER}/{x}.parquet") for x in ("documents", "labels"))
    found = toxicity.scored(documents, toxicity.fit(documents, labels)).join(labels, "doc_id").where(held_out(F.col("doc_id")))
    found = found.join(documents.select("doc_id", "lang"), "doc_id").select("lang", "toxic", (F.col("score") >= toxicity.TOXIC).alias("marked")).collect()
    toxic, clean = ([r for r in found if r.toxic == x] for x in (1, 0))
    assert sum(r.marked for r in toxic) >= 0.9 * len(toxic)
    assert sum(r.marked for r in clean) <= 0.01 * len(clean)
    for lang in {r.lang for r in toxic}:
        assert sum(r.marked for r in toxic if r.lang == lang) >= 0.8 * sum(r.lang == lang for r in toxic), lang


def likeness(one, other):
    """Of two written fingerprints, lane by lane."""
    (_, runs, lanes), (_, more, others) = (x.split("-") for x in (one, other))
    runs, more = int(runs, 16), int(more, 16)

    def split(text):
        return [int(text[k : k + 16], 16) >> s & (1 << 21) - 1 for k in range(0, len(text), 16) for s in (0, 21, 42)]

    def square(x, y, n):
        return sum((((2 * (a - b) - n + (1 << 21)) % (1 << 22)) - (1 << 21)) ** 2 for a, b in zip(x, y, strict=True))

    a, b = split(lanes), split(others)
    sizes = square(a, [0] * len(a), runs) + square(b, [0] * len(b), more)
    return 1.0 if sizes == 0 else max(0.0, 1 - square(a, b, runs - more) / sizes)


@pytest.mark.parametrize("ids", ("dense", "sparse", "hashed", "one"))
def test_neighbours_of_fingerprints(spark, ids, monkeypatch):
    """The next document by id, over all buckets, however the ids lie; likeness against its lanes."""
    rng = random.Random(9)
    made = {"dense": range(90), "sparse": [k << 40 for k in range(-45, 45)], "hashed": [rng.getrandbits(63) for _ in range(90)], "one": [5]}[ids]
    base = [cases.prose(rng, rng.randint(0, 120)) for _ in range(20)]
    rows = [(i, rng.choice(base) + rng.choice(["", "\n" + rng.choice(base)])) for i in made]
    monkeypatch.setattr(fingerprints, "FAN", 3)
    rng.shuffle(rows)
    got = {r.doc_id: r for r in fingerprints.fingerprints(cases.frame(spark, rows).repartition(5)).collect()}
    order = sorted(rows)
    assert len(got) == len(rows)
    for k, (i, text) in enumerate(order):
        follows, after = order[(k + 1) % len(order)]
        edited = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert math.isclose(got[i].near_next, likeness(got[i].fingerprint, got[follows].fingerprint), abs_tol=1e-9)
        assert math.isclose(got[i].near_edited, likeness(got[i].fingerprint, got[i].edited_fingerprint), abs_tol=1e-9)


def test_likeness_follows_how_much_is_shared(spark):
    rng = random.Random(10)
    words = cases.prose(rng, 2000).split()
    rows = [(0, " ".join(words))]
    for k, share in enumerate((1.0, 0.9, 0.5, 0.0)):
        changed = [w if rng.random() < share ** (1 / 8) else cases.prose(rng, 1) + "x" for w in words]
        rows.append((k + 1, " ".join(changed)))
    got = {r.doc_id: r.fingerprint for r in fingerprints.fingerprints(cases.frame(spark, rows)).collect()}
    found = [likeness(got[0], got[k]) for k in (1, 2, 3, 4)]
    assert found[0] == 1.0 and all(abs(a - b) < 0.15 for a, b in zip(found[1:], (0.9, 0.5, 0.0), strict=True))


def test_classes_of_one_list_that_are_not_alike(spark):
    """Many documents of one rare line and other words of their own: no pairs, whatever their sizes."""
    rng = random.Random(12)
    line = "this one line stands in all of them"
    rows = [(k, line + " " + cases.prose(rng, rng.randint(5, 60))) for k in range(300)]
    rows += [(1000 + k, rows[7 * k][1] + " end") for k in range(20) if len(rows[7 * k][1].split()) > 30]
    got = {r.doc_id: r.component_id for r in ngram_join.groups(cases.frame(spark, rows)).collect()}
    split = {i: t.split() for i, t in rows}
    sets = {i: {tuple(w[k : k + 4]) for k in range(len(w) - 3)} for i, w in split.items()}
    want = {i: i for i in sets}
    for i in sorted(sets):
        for j in sorted(sets):
            if i < j and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                want = {k: want[i] if v == want[j] else v for k, v in want.items()}
    assert got == want


def test_only_tables_written_here_are_deleted(spark, tmp_path):
    path = str(tmp_path / "own")
    spark.range(3).write.parquet(path)
    own, written = spark.read.parquet(path), tables.staged(spark.range(4), "some")
    tables.removed(own, written, spark.range(2))
    assert spark.read.parquet(path).count() == 3
    assert not os.path.exists(written._tickbars_folder)
