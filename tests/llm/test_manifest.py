"""The manifest against trees built in Python."""

import hashlib
from collections import defaultdict

import pytest
from llm import cases
from pyspark.sql import functions as F
from tickbars.llm import manifest as m


def H(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(nodes, arity):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([H(last[k : k + arity]) for k in range(0, len(last), arity)])
    return levels


def brute(rows, arity):
    """Sorted (doc_id, leaf, subroot, root, [(left, right)]) of rows (doc_id, source, lang, n_chars, text)."""
    by = defaultdict(list)
    for row in rows:
        by[row[1]].append((row[0] is not None, row[0] or 0, H(map(field, row)), row[0]))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([leaf for _, _, leaf, _ in sorted(by[s], key=lambda x: x[:3])], arity) for s in sources}
    top = tree([trees[s][-1][0] for s in sources], arity)
    out = []
    for at, s in enumerate(sources):
        for place, (_, _, leaf, doc_id) in enumerate(sorted(by[s], key=lambda x: x[:3])):
            path = []
            for levels, k in ((trees[s], place), (top, at)):
                for level in levels[:-1]:
                    low = k // arity * arity
                    path.append(("".join(level[low:k]), "".join(level[k + 1 : low + arity])))
                    k //= arity
            out.append((doc_id, leaf, trees[s][-1][0], top[-1][0], path))
    return sorted(out, key=str)


def ours(frame, arity):
    leaves = frame.select("source", "doc_id", m.leaf().alias("digest"))
    rows = m.manifest(leaves, arity).withColumn("_folded", m.folded(F.col("digest"), F.col("path"))).collect()
    assert all(r._folded == r.root for r in rows)
    found = [(r.doc_id, r.digest.hex(), r.subroot.hex(), r.root.hex(), [(s.left.hex(), s.right.hex()) for s in r.path]) for r in rows]
    return sorted(found, key=str)


@pytest.mark.parametrize("arity", (2, 3, 5))
def test_trees_equal_brute_force(spark, arity):
    """Sources of 1, 2, 3, 4, 9, 10 and 100 rows, one of them null, one empty; nulls, repeats, clashing names."""
    rows, number = [], 0
    for source, size in (("a", 1), ("b", 2), ("é", 3), (None, 4), ("", 9), ("z", 10), ("hot", 100)):
        for k in range(size):
            number += 7
            rows.append((None if k == 2 else number, source, None if k % 3 == 0 else "en", None if k % 4 == 0 else k, [None, "", "x\ny", "日本" * k][k % 4]))
    rows += [rows[-1], rows[-1]]
    frame = spark.createDataFrame([(*r, 1, "t", "i") for r in rows], "doc_id long, source string, lang string, n_chars long, text string, tree int, digest string, idx string")
    assert ours(frame.repartition(7), arity) == brute(rows, arity)


def test_cases(spark):
    rows = [(i, "s", "en", 7, t) for i, t in cases.texts()]
    assert ours(cases.frame(spark, cases.texts()), 3) == brute(rows, 3)


def test_one_row_and_none(spark):
    frame = cases.frame(spark, [(1, "x")])
    ((doc_id, leaf, subroot, root, path),) = ours(frame, 3)
    assert leaf == subroot == root and path == []
    assert ours(frame.where("false"), 3) == []


def test_verification_finds_any_change(spark):
    frame = cases.frame(spark, [(k, f"text {k}\n") for k in range(20)])
    leaves = frame.select("source", "doc_id", m.leaf().alias("digest"), m.leaf(text=F.replace("text", F.lit("7"), F.lit("8"))).alias("found"))
    rows = m.manifest(leaves).select("doc_id", (m.folded(F.col("found"), F.col("path")) == F.col("root")).alias("same")).collect()
    assert {r.doc_id for r in rows if not r.same} == {7, 17}
