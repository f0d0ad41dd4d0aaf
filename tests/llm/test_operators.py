"""Each operator against brute force, on documents with nulls, empties, long texts, ties, repeated
rows and columns of clashing names, and on empty tables."""

import collections
import hashlib
import random
import re
import zlib

import public_tokenizers
import pytest
from llm.cases import SCHEMA, frame, lower, prose, texts
from pyspark.sql import functions as F
from tickbars.llm import chat, decontamination, extraction, fingerprints, language, ngram_join, packing, substrings, tables, token_counts, toxicity


@pytest.fixture(scope="module")
def documents(spark):
    tables.shipped(spark)
    return frame(spark, texts()).repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def test_fingerprints(spark, documents, nothing):
    rows = sorted(((i, t or "") for i, t in texts() if i is not None))
    got = collections.defaultdict(list)
    for r in fingerprints.fingerprints(documents).collect():
        got[r.doc_id].append(r)
    for k, (doc_id, text) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert hashlib.sha256(edited.encode()).hexdigest() in {r.edited_sha256 for r in got[doc_id]}
        assert {r.n_chars for r in got[doc_id]} == {len(text)}
    every = [r for x in got.values() for r in x]
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in every)
    assert got[0][0].fingerprint == got[20][0].fingerprint != got[21][0].fingerprint
    long = [r for r in every if r.n_chars > 400 and r.doc_id is not None and r.doc_id not in (41,)]
    assert sum(r.near_edited for r in long) / len(long) > 0.3
    assert fingerprints.fingerprints(nothing).count() == 0


def test_fingerprints_add_up(spark):
    one, two = "first line\nsecond line", "third line of text\nfirst line"
    rows = spark.createDataFrame([(one, two, two + "\n" + one)], "one string, two string, both string")
    for c in rows.columns:
        rows = fingerprints.with_fingerprint(rows, c, f"f_{c}")
    total = fingerprints.added(F.col("f_one"), F.col("f_two"))
    left = fingerprints.added(F.col("f_both"), F.col("f_two"), -1)
    w = fingerprints.written
    r = rows.select(w(total) == w(F.col("f_both")), w(left) == w(F.col("f_one"))).first()
    assert tuple(r) == (True, True)


def test_substrings(spark, documents, nothing):
    out = substrings.deduplicated(documents)
    assert set(out.columns) == {*documents.columns, "n_removed", "n_passages"}
    got = collections.defaultdict(list)
    for r in out.collect():
        got[r.doc_id].append(r)
    assert len(got[50]) == 2 and [r.text for r in got[30]] == [None]
    given = dict(x for x in texts() if x[0] is not None)
    for same in (0, 2, 3, 4, 5, 6, 25, 31, 32, 33, 34, 35, 36, 40, 41, -3):
        assert got[same][0].text == given[same] and got[same][0].n_passages == 0, same
    assert got[20][0].text.strip() == "" and got[20][0].n_removed == len(given[20])
    assert got[21][0].text.strip() == "end"
    # The shared passage of 70 words stays in document 25 and leaves the later one.
    assert abs(len(got[26][0].text.split()) - 90) <= 4
    assert all(r.n_chars == len(r.text) for x in got.values() for r in x if r.text is not None)
    assert substrings.deduplicated(nothing).count() == 0


def test_substrings_find_every_long_passage(spark):
    rng = random.Random(5)
    shared = [prose(rng, 60) for _ in range(60)]
    rows = [(k, prose(rng, 40) + " " + x + " " + prose(rng, 40)) for k, x in enumerate(shared)]
    rows += [(1000 + k, prose(rng, rng.randint(1, 60)) + " " + x + " " + prose(rng, 25)) for k, x in enumerate(shared)]
    got = {r.doc_id: r for r in substrings.deduplicated(frame(spark, rows)).collect()}
    assert all(got[k].n_passages == 0 for k in range(60))
    found = [got[1000 + k].n_passages == 1 for k in range(60)]
    assert all(found)


def without_passages(rows):
    """What brute force leaves: (doc_id, words left, passages cut out) of each row."""
    first = {}
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    for i, w in split:
        for k in range(len(w) - 49 if i is not None else 0):
            first[tuple(w[k : k + 50])] = min(i, first.get(tuple(w[k : k + 50]), i))
    for i, w in split:
        gone = set()
        for k in range(len(w) - 49 if i is not None else 0):
            if first[tuple(w[k : k + 50])] < i:
                gone.update(range(k, k + 50))
        yield i, tuple(x for k, x in enumerate(w) if k not in gone), sum(k - 1 not in gone for k in gone)


def substrings_left(spark, rows):
    return collections.Counter((r.doc_id, tuple(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")), r.n_passages) for r in substrings.deduplicated(frame(spark, rows)).collect())


def test_substrings_whose_pieces_occur_earlier_elsewhere(spark):
    """Pieces of a shared passage, of 3 to 30 words, stand in many documents before it."""
    rng = random.Random(11)
    rows = []
    for k in range(40):
        passage = prose(rng, rng.randint(60, 100))
        words = passage.split()
        for j in range(30):
            at, n = rng.randrange(len(words) - 3), rng.randint(3, 30)
            rows.append((100 * k + j, f"{prose(rng, 20)} {' '.join(words[at : at + n])} {prose(rng, 20)}"))
        rows += [(100 * k + 50 + j, f"{prose(rng, rng.randint(0, 30))} {passage} {prose(rng, rng.randint(0, 30))}") for j in range(2)]
    got = substrings_left(spark, rows)
    assert got == collections.Counter(without_passages(rows))
    assert sum(n for *_, n in got) == 40


def test_substrings_find_passages_of_every_length_whole(spark):
    rng = random.Random(12)
    rows = []
    for k in range(550):
        passage = prose(rng, 50 + k % 11)
        rows += [(k + 1000 * j, f"{prose(rng, rng.randint(0, 60))} {passage} {prose(rng, rng.randint(0, 60))}") for j in range(2)]
    got = substrings_left(spark, rows)
    assert got == collections.Counter(without_passages(rows))
    assert sum(n for *_, n in got) == 550


def test_substrings_equal_brute_force(spark):
    """Copies, copies of other white space, several documents of one id, passages in three documents."""
    rng = random.Random(13)
    base = [prose(rng, rng.randint(40, 120)) for _ in range(20)]
    rows = texts() + [(100 + k, rng.choice(base)) for k in range(60)]
    rows += [(rng.randint(150, 200), f"{rng.choice(base)} {rng.choice(base)[:400]}") for _ in range(60)]
    rows += [(90, "\n".join(base[0].split())), (None, base[1]), (150, None), (100, base[2]), (100, base[3])]
    assert substrings_left(spark, rows) == collections.Counter(without_passages(rows))


def test_packing(spark, documents, nothing):
    from tokenizers import Tokenizer

    path = public_tokenizers.path(packing.TOKENIZER)
    known = Tokenizer.from_file(path)
    pieces = packing.pack(documents, path).collect()
    windows = collections.defaultdict(list)
    for p in pieces:
        windows[p.sequence_id].append(p)
    padding = 0
    for parts in windows.values():
        parts.sort(key=lambda p: p.offset)
        total = 0
        for p in parts:
            assert p.offset == total and p.length > 0
            total += p.length
        assert total <= packing.CAPACITY
        padding += packing.CAPACITY - total if total & (total - 1) else 0
    assert padding == 0
    by = collections.defaultdict(list)
    for p in pieces:
        by[p.doc_id].append(p)
    want = collections.Counter()
    for doc_id, text in texts():
        ids = known.encode(text or "", add_special_tokens=False).ids + [packing.END]
        want[doc_id] += len(ids)
        if doc_id not in (None, 50):
            parts = sorted(by[doc_id], key=lambda p: p.start)
            at = 0
            for p in parts:
                cut = ids[p.start : p.start + p.length]
                assert p.start == at and p.doc_tokens == len(ids)
                assert p.ids_crc32 == zlib.crc32(b"".join(x.to_bytes(4, "little") for x in cut))
                at += p.length
            assert at == len(ids)
    assert {k: sum(p.length for p in v) for k, v in by.items()} == dict(want)
    assert packing.pack(nothing, path).count() == 0


def test_tokens_by_units_are_those_of_the_whole_text():
    import pyarrow as pa
    from tokenizers import Tokenizer

    path = public_tokenizers.path(packing.TOKENIZER)
    known = Tokenizer.from_file(path)
    odd = ["a.'s b", "don't,'s", "x́.≮'T 's", "<|endoftext|>hi<|ENDOFTEXT|> ok", "K,' I'LL  x 3.5'd", "", "ÄÖ ﬁ é é.", "''ve.'ll'", "a\x1cb \x85 c"]
    for text, (_, ids) in zip(odd, packing.document_ids(pa.array(odd), path), strict=True):
        assert ids.tolist() == known.encode(text, add_special_tokens=False).ids + [packing.END], text


@pytest.mark.parametrize("capacity", [16, 100, 4096])
def test_windows_are_full(capacity):
    import numpy as np

    rng = np.random.default_rng(capacity)
    for n in (1, 2, 7, 60):
        sizes = rng.integers(1, capacity, n)
        windows = packing.packed(sizes, capacity)
        seen = collections.Counter()
        for w in windows:
            for item, start, used in w:
                assert start == seen[item]
                seen[item] += used
        assert [seen[k] for k in range(n)] == sizes.tolist()
        assert all((t := sum(p[2] for p in w)) == capacity or t & (t - 1) == 0 for w in windows)


def test_differencing_balances():
    import numpy as np

    sizes = np.random.default_rng(3).integers(1, 100, 500)
    bins = packing.differenced(sizes, 20)
    sums = [int(sizes[b].sum()) for b in bins]
    assert sorted(i for b in bins for i in b) == list(range(500)) and max(sums) - min(sums) <= 2


def test_token_counts(spark, documents, nothing):
    from tokenizers import Tokenizer, models, pre_tokenizers

    path = public_tokenizers.path(token_counts.MODEL)
    pieces = token_counts.vocabulary(path)
    least = min(s for _, s in pieces)
    known = Tokenizer(models.Unigram([("<unk>", least), *pieces, *[(f"<0x{i:02X}>", least) for i in range(256)]], unk_id=0, byte_fallback=True))
    known.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    rows = texts() + [(100 + k, x) for k, x in enumerate([" ", "  \n  ", "\n\n a", " a  b ", "▁x", "a▁▁b", "日本語テキスト  漢字 🎉", "a\tb\x00c"])]
    got = collections.defaultdict(set)
    for r in token_counts.token_counts(frame(spark, rows), path).collect():
        got[r.doc_id].add(r.n_tokens)
    for doc_id, text in rows:
        assert len(known.encode(text or "", add_special_tokens=False).ids) in got[doc_id], text and text[:40]
    assert token_counts.token_counts(nothing, path).count() == 0


WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def contaminated(rows, items):
    windows = collections.defaultdict(set)
    for item, text in items:
        w = WORDS.findall(lower(text))
        n = min(13, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[k : k + n])].add(item)
    for doc_id, text in rows:
        w, hit, found = WORDS.findall(lower(text)), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if items_ := windows.get(tuple(w[k : k + n])):
                    hit.update(range(k, k + n))
                    found |= items_
        name = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        yield (doc_id, len(w), len(hit), len(found), name, bool(hit) and 20 * len(hit) >= len(w))


@pytest.mark.parametrize("limit", [decontamination.BLOCK_BYTES, 1500])
def test_decontamination(spark, documents, nothing, monkeypatch, limit):
    monkeypatch.setattr(decontamination.blocks, "__defaults__", (limit,))
    given = dict(texts())
    items = [(1, given[0]), (2, " ".join(given[2].split()[40:55])), (3, "one, TWO!"), (4, given[6]), (5, None), (6, ".."), (7, given[0]), (8, " ".join(given[40].split()[700:712])), (9, given[2][:600] + " other " + given[3])]
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    got = collections.Counter(tuple(r) for r in decontamination.contamination(documents, bench).collect())
    assert got == collections.Counter(contaminated(texts(), items))
    assert decontamination.contamination(documents, bench.limit(0)).where("n_hit > 0").count() == 0
    assert decontamination.contamination(nothing, bench).count() == 0


def test_winnowing_keeps_one_of_each_window():
    import numpy as np

    rng = np.random.default_rng(0)
    for n in (1, 5, 8, 9, 40):
        grams = rng.integers(0, 6, n).astype(np.uint64)
        kept = set(decontamination.winnowed(grams, 8).tolist())
        for k in range(max(1, n - 7)):
            window = grams[k : k + 8]
            assert any(k + j in kept and window[j] == window.min() for j in range(len(window)))


def test_ngram_join(spark, documents, nothing):
    rows = texts()
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
        k = min(4, len(w))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set())
    root = list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 85 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    want = collections.Counter((i, len(sets[k]), None if i is None else least[find(k)]) for k, (i, _) in enumerate(rows))
    got = collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.groups(documents).collect())
    assert got == want
    assert ngram_join.groups(nothing).count() == 0


def test_ngram_join_connects_large_groups(spark):
    """Near copies of one text that are similar to some of the others only."""
    rng = random.Random(9)
    base = prose(rng, 150).split()
    rows = []
    for k in range(120):
        words = list(base)
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(len(words))] = f"edit{rng.random()}"
        rows.append((k, " ".join(words)))
    rng.shuffle(rows)
    sets = {i: {tuple(t.split()[j : j + 4]) for j in range(len(t.split()) - 3)} for i, t in rows}
    root = {i: i for i in sets}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    got = {r.doc_id: r.component_id for r in ngram_join.groups(frame(spark, rows)).collect()}
    assert got == {i: find(i) for i in sets}


def labelled(spark, n=3000):
    rng = random.Random(2)
    rows, labels = [], []
    for k in range(n):
        words = prose(rng, rng.randint(20, 80)).split()
        toxic = rng.random() < 0.15
        if toxic:
            for _ in range(rng.randint(1, 3)):
                words.insert(rng.randrange(len(words)), rng.choice(["vilest", "Rotten", "scorn" + rng.choice(["ful", "ing", "ed", "er"])]))
        rows.append((k, " ".join(words)))
        labels.append((k, 1 if toxic else 0, "x"))
    return rows, labels, spark.createDataFrame(labels, "doc_id long, toxic int, text string")


def test_toxicity(spark, nothing):
    rows, labels, known = labelled(spark)
    documents = frame(spark, rows + [(9000, None), (9001, ""), (9002, "x " * 50_000), (None, "vilest scornful"), (5, rows[5][1])])
    model = toxicity.fit(documents, known)
    assert model.labels["accuracy"].min() > 0.5
    got = {r.doc_id: r.score for r in toxicity.scored(documents, model).collect()}
    held = [k for k in range(len(rows)) if zlib.crc32(str(k).encode()) % 5 == 0]
    right = sum((got[k] >= 0.5) == (labels[k][1] == 1) for k in held)
    assert right / len(held) > 0.97
    assert got[None] > 0.5 and max(got[9000], got[9001], got[9002]) < 0.5
    assert toxicity.scored(nothing, model).count() == 0
    assert [r.score for r in toxicity.scored(documents.limit(3), toxicity.fit(documents, known.limit(0))).collect()] == [0.0] * 3


def test_toxicity_does_not_learn_from_held_out_rows(spark):
    rows, labels, known = labelled(spark, 600)
    documents = frame(spark, rows)
    turned = known.withColumn("toxic", F.when(tables.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity.fit(documents, known), toxicity.fit(documents, turned)
    assert a.known.tolist() == b.known.tolist() and a.weight.tolist() == b.weight.tolist()


def test_language(spark, nothing):
    rng = random.Random(4)
    kinds = {"aa": ["ka", "to", "mi"], "bb": ["sch", "ung", "ei"], "cc": ["tion", "ough", "ly"]}
    rows = []
    for k in range(900):
        lang = rng.choice(list(kinds))
        rows.append((k, " ".join("".join(rng.choice(kinds[lang]) for _ in range(3)) for _ in range(rng.randint(3, 60))), lang))
    extra = [(9000, None, "aa"), (9001, "", "bb"), (9002, "123 !? -", None), (9003, "katomi kato", None), (None, "schung", "bb"), (9004, "日", None)]
    documents = spark.createDataFrame([(i, t, l, 1.0) for i, t, l in rows + extra], "doc_id long, text string, lang string, score double")
    model = language.fit(documents)
    got = {r.doc_id: r for r in language.identified(documents, model).collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    assert sum(got[i].lang_pred == lang for i, _, lang in held) / len(held) > 0.98
    assert [got[k].lang_pred for k in (9000, 9001, 9002, 9003)] == ["und", "und", "und", "aa"]
    assert got[9004].lang_pred != "und" and all(0 <= r.score <= 1 for r in got.values())
    assert language.identified(nothing, model).count() == 0
    assert language.fit(documents.where("lang = 'zz'")) is None
    assert {r.lang_pred for r in language.identified(documents.limit(4), None).collect()} == {"und"}


@pytest.mark.parametrize("n", [1, 2, 4, 7, 8, 30])
def test_codewords_differ(n):
    code = language.codewords(n)
    assert len({tuple(x) for x in code}) == n


def test_extraction(spark):
    tables.shipped(spark)
    menu = "<div><a>Home</a> <a>About us</a> <a>Contact</a> <a>Jobs now</a></div>"
    bare = "<body>{m}<div><h2>Title {i}</h2><p>unique words number {i} are here {j} and there {k}</p></div><div>Copyright by the owners of this place</div><div class='cookie-bar'>Cookies!</div>"
    pages = [(i, f"http://h.example/{i}", bare.format(m=menu, i=i, j=7 * i, k=11 * i)) for i in range(4)]
    pages += [
        (10, "http://z/", "<main>a<br>b<p class=ad>buy</p>c</main><p>out"),
        (11, "http://z/", "<nav>n</nav><article class='comment'>no</article><article><header>h</header>yes <i>it</i>alic<!-- <p>x --> &amp; J&eacute;&#8364;&nbsp;&lt;b&gt;</article><footer>f"),
        (12, None, None),
        (13, "", ""),
        (14, "http://z/", "<article><h1>T</h1><p><b>one<br><p>two \n\t three</p><script>var t='</p>';</script><form>f</form><ul><li>x<li>y</ul></article>"),
        (14, "http://z/", "<article>again</article>"),
        (15, "http://z/", "<article><p>" + "long text " * 50_000 + "</article>"),
        (16, "http://z/", "plain < text & more <b"),
    ]
    rows = spark.createDataFrame([(*p, "x", 3) for p in pages], "page_id long, url string, html string, text string, lead int")
    got = collections.defaultdict(set)
    for r in extraction.extracted(rows).collect():
        got[r.page_id].add(r.text)
        assert r.n_chars == len(r.text)
    for i in range(4):
        assert got[i] == {f"Title {i}\n\nunique words number {i} are here {7 * i} and there {11 * i}"}
    assert got[10] == {"a b\n\nc"} and got[11] == {"yes italic & Jé€ <b>"}
    assert got[12] == got[13] == {""}
    assert got[14] == {"T\n\none\n\ntwo three\n\nx\n\ny", "again"}
    assert got[15] == {("long text " * 50_000).strip()} and len(got[16]) == 1
    assert extraction.extracted(rows.limit(0)).count() == 0


def test_extraction_without_landmarks_on_a_large_host(spark):
    """Menus and notices go; paragraphs of common short runs and articles copied to a second page stay."""
    rng = random.Random(14)
    common = [prose(rng, 7) for _ in range(15)]
    notice = prose(rng, 30)
    articles = [[" ".join(f"{rng.choice(common)} {prose(rng, 2)}" for _ in range(5)) for _ in range(3)] for _ in range(150)]
    own = articles + [articles[k] for k in range(0, 50)]
    page = "<div><a>Home</a> <a>About us</a></div>{}<div>{} <b>more</b></div>"
    rows = [(k, f"http://h.example/{k}", page.format("".join(f"<p>{x}</p>" for x in text), notice)) for k, text in enumerate(own)]
    got = {r.page_id: r.text for r in extraction.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {k: "\n\n".join(text) for k, text in enumerate(own)}


def pages_of(spark, articles):
    """One host's pages, each with an article of these paragraphs, a menu and a sidebar of its own."""
    page = "<nav>Home About</nav><article>{}</article><div class='sidebar'>own {} words</div>"
    rows = [(k, f"http://h.example/{k}", page.format("".join(f"<p>{x}</p>" for x in text), k)) for k, text in enumerate(articles)]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_repeats_judge_articles(spark):
    """A notice inside the article elements goes; short lines, copied articles and what quotes them stay."""
    rng = random.Random(15)
    notice, line = prose(rng, 40), prose(rng, 8)
    copied = [prose(rng, 60) for _ in range(3)]
    noticed = [[prose(rng, 90), line, prose(rng, 50), notice, prose(rng, 9)] for _ in range(12)]
    noticed += [[notice, prose(rng, 120)], [prose(rng, 60) + " " + notice, prose(rng, 60)]]
    articles = [*noticed, *[[*copied, prose(rng, 5)] for _ in range(5)], [prose(rng, 100), copied[1], prose(rng, 100)]]
    got = {r.page_id: r.text for r in extraction.extracted(pages_of(spark, articles)).collect()}
    assert got == {k: "\n\n".join(x for x in text if x != notice) for k, text in enumerate(articles)}


def test_repeats_in_articles_follow_brute_force(spark):
    rng = random.Random(16)
    articles = [[prose(rng, 150), *[prose(rng, rng.randint(1, 30)) for _ in range(3)]] for _ in range(120)]
    for _ in range(60):
        words = prose(rng, rng.randint(15, 45))
        for k in rng.sample(range(120), rng.randint(2, 5)):
            at = rng.randint(1, 3)
            articles[k][at] = rng.choice([f"{articles[k][at]} {words}", f"{words} {articles[k][at]}"]) if len(articles[k][at].split()) < 40 else articles[k][at]
    places = collections.defaultdict(set)
    for k, text in enumerate(articles):
        words = " ".join(text).split()
        for p in range(len(words) - 19):
            places[tuple(words[p : p + 20])].add(k)
    expected = {}
    for k, text in enumerate(articles):
        words = " ".join(text).split()
        covered = {q for p in range(len(words) - 19) if len(places[tuple(words[p : p + 20])]) >= 3 for q in range(p, p + 20)}
        kept, low = [], 0
        for block in text:
            high = low + len(block.split())
            if 2 * sum(q in covered for q in range(low, high)) <= high - low:
                kept.append(block)
            low = high
        expected[k] = "\n\n".join(kept)
    assert sum(expected[k] != "\n\n".join(text) for k, text in enumerate(articles)) > 20
    assert {r.page_id: r.text for r in extraction.extracted(pages_of(spark, articles)).collect()} == expected


def test_chat(spark):
    rows = [
        (1, 0, "user", "a <|end|> \\b \\l | < \n"), (1, 1, "user", None), (1, 2, "assistant", "x<|more|>y"), (1, 3, "assistant", ""), (1, 4, "assistant", "z"), (1, 5, "system", "s"),
        (2, 0, "assistant", "only"), (3, 0, None, None), (4, 1, "b|>r", "tie"), (4, 1, "assistant", "tie"), (4, None, "user", "first"), (4, 1, "assistant", "tie"),
        (None, 0, "user", "lost"), (5, 0, "assistant", "long " * 100_000),
    ]
    rows += [(6, k, random.Random(k).choice(["user", "assistant"]), f"turn {k} é") for k in range(700)]
    frame_ = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, turns string")
    turns = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = chat.formatted(frame_.repartition(3))
    got = {r.conv_id: r for r in chat.read_back(out).collect()}
    whole = {r.conv_id: r for r in out.collect()}
    assert set(got) == set(turns)
    for conv, own in turns.items():
        own.sort()
        text = "".join(f"{r}\n{t}\n" for _, _, r, t in own)
        learn = "".join(t for _, _, r, t in own if r == "assistant")
        r = got[conv]
        assert (r.n_turns, r.turns_sha256) == (len(own), hashlib.sha256(text.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(learn), hashlib.sha256(learn.encode()).hexdigest())
        assert r.formatted_chars == len(whole[conv].formatted)
        merged = 1 + sum(a[2] != b[2] for a, b in zip(own, own[1:]))
        assert whole[conv].formatted.count("<|end|>") == merged
    assert chat.read_back(chat.formatted(frame_.limit(0))).count() == 0
