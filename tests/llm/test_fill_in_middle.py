"""Fill-in-middle against slicing, and outputs back to texts."""

import hashlib
import random

import pytest
from hypothesis import given
from hypothesis import strategies as st
from llm import cases
from tickbars.llm import fill_in_middle as f


def brute(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}"
    return n, "psm", a, b - a, f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"


def test_rows_equal_brute_force(spark):
    rows = cases.texts() + [(k, "añ日\n😀" * (k % 7)) for k in range(100, 400)] + [(500, "a <P> b"), (501, "<S>"), (502, "<M"), (503, "x<M>")]
    got = f.fill_in_middle(cases.frame(spark, rows)).collect()
    assert sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got), key=str) == sorted(((i, *brute(i, t)) for i, t in rows), key=str)
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    texts = sorted((r.doc_id if r.doc_id is not None else -1, f.restored(r.output, r.form)) for r in got)
    assert texts == sorted((i if i is not None else -1, t or "") for i, t in rows)


def test_empty_table(spark):
    assert f.fill_in_middle(cases.frame(spark, cases.texts()).where("false")).collect() == []


@given(st.integers(), st.text(alphabet="<>PSM \né", max_size=30))
def test_any_text_comes_back(doc_id, text):
    cut = f.Cutter().cut(doc_id, text)
    assert f.restored(cut.output, cut.form) == text
    assert (cut.n, cut.form, cut.prefix_chars, cut.middle_chars, cut.output) == brute(doc_id, text)


@pytest.mark.parametrize("extra", (-1, 0, 1, f.PIECE + 3))
def test_texts_beyond_one_match(extra):
    text = "ab\n日" * ((f.PIECE + extra) // 4) + "x"
    assert f.Cutter().ends(text) == list(range(1, len(text) + 1))
    cut = f.Cutter().cut(3, text)
    assert f.restored(cut.output, cut.form) == text


def test_other_units():
    """Words and what stands between them are never cut; a text of other things stays plain."""
    rng, words = random.Random(5), f.Cutter(r"\w+|\W")
    for k in range(200):
        text = cases.prose(rng, k % 20)
        cut = words.cut(k, text)
        assert f.restored(cut.output, cut.form) == text
        if cut.form != f.PLAIN:
            ends = [0, *words.ends(text)]
            assert cut.n == len(ends) - 1 and cut.prefix_chars in ends and cut.prefix_chars + cut.middle_chars in ends
    assert f.Cutter(r"\w+").cut(1, "two words") == f.Cut(0, f.PLAIN, "two words")
