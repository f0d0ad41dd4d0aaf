"""Removing repeated passages with content-defined chunks.

A gear hash rolls over the words of a text. The least hash inside ``PASSAGE`` words in a row is their
anchor. So an anchor depends on these words only, every passage has one, and the same passage has the
same anchor wherever it stands. The anchors of a text are its cuts: what lies between two of them is a
chunk, of variable length, and words put in or taken out change the chunks around them only.

**Chunks.** Passages with one anchor are neighbours. The chunks that they lie in are a run, known by the
digests of its chunks; runs are aggregated by digest to the first document that has them. If a
document's run is in an earlier one, so are all its passages. This settles whatever is copied
with some words around it.

**Ends.** Where a repeat begins or ends, chunks reach out of it and differ. There only, passages are
compared as such: the runs that share their anchor's ``ROLLED`` words with another run, and are the first of
their digest, are cut into their single passages, and these are aggregated by two digests of all their
words to the first document that has them. A passage whose run shares these words with none
repeats nowhere.

The words of all passages that an earlier document has are cut out; the first document keeps them,
and so stay all shorter repeats. Nothing is limited or left out. Words are equal if their bytes are,
whatever white space is between them.

Runs and passages are combined before they are shuffled, and repeated ones joined back from written
tables, so a passage in a third of all documents is no hot key.

Rows: a null text stays null; rows without doc_id and rows that repeat a doc_id are no other
document for each other and stay as they are; an empty table gives no rows; other columns are kept,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickbars.llm import wordhash
from tickbars.llm.tables import free, removed, settled, staged, table

PASSAGE = 50
# The gear hash of a word takes in the word and the 15 before it, 4 bits for each.
ROLLED, BITS = 16, 4
# Bits of a word's place beside its hash; the same for all texts, so that all break ties alike.
PLACE_BITS = 31

RUNS = "core long, run long, doc_id long"
PASSAGES = "digest long, second long, doc_id long"
RESULT = "n_chars long, n_removed long, n_passages int"


def gear(words: np.ndarray) -> np.ndarray:
    """The rolling hash at each word that has ROLLED - 1 words before it."""
    rolled, step = words.copy(), 1
    while step < ROLLED:
        rolled = rolled[step:] + (rolled[:-step] << np.uint64(BITS * step))
        step *= 2
    return wordhash.mix(rolled)


def anchors(words: np.ndarray) -> np.ndarray:
    """The place of the anchor (its first word) of each PASSAGE words, by their first word."""
    if len(words) < PASSAGE:
        return np.zeros(0, np.int64)
    hashes, width, wanted = gear(words), 1, PASSAGE - ROLLED + 1
    bits = np.uint64(PLACE_BITS)
    least = (hashes >> bits << bits) | np.arange(len(hashes), dtype=np.uint64)
    while width < wanted:
        step = min(width, wanted - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    return (least & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)


class Text:
    """The chunks of a text, by two hashes of each word."""

    def __init__(self, words: np.ndarray, others: np.ndarray):
        self.words, self.others = words, others
        places = anchors(words)
        new = np.flatnonzero(places[1:] != places[:-1]) + 1
        # Passages of one anchor: the first words of the first and the last of them.
        self.first = np.concatenate([[0], new])
        self.last = np.concatenate([new - 1, [len(places) - 1]])
        at = places[self.first]
        self.core = wordhash.sequence_hashes(words, at, at + ROLLED)
        cuts = np.unique(np.concatenate([[0], at, [len(words)]]))
        chunks = wordhash.sequence_hashes(others, cuts[:-1], cuts[1:])
        low = np.searchsorted(cuts, self.first, "right") - 1
        high = np.searchsorted(cuts, self.last + PASSAGE, "left")
        self.run = wordhash.sequence_hashes(chunks, low, high)

    def passages(self, runs: np.ndarray) -> np.ndarray:
        """The first words of the passages of these runs (flags)."""
        edges = np.zeros(self.last[-1] + 2, np.int32)
        edges[self.first[runs]] += 1
        edges[self.last[runs] + 1] -= 1
        return np.flatnonzero(np.cumsum(edges))

    def names(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The two digests of the passages that begin there."""
        return wordhash.sequence_hashes(self.words, at, at + PASSAGE), wordhash.sequence_hashes(self.others, at, at + PASSAGE)


def _texts(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, Text]]:
    """Row, bytes, starts and ends of words, and chunks of each text of at least one passage; capital
    letters are not small ones."""
    for row, data, starts, ends, words in wordhash.text_words(texts, wordhash.NOT_SPACE, wordhash.EXACT[0]):
        if len(words) >= PASSAGE:
            yield row, data, starts, ends, Text(words, _spans(data, starts, ends, wordhash.EXACT[1]))


def _spans(data: np.ndarray, first: np.ndarray, last: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Span hashes, some windows at a time; a span longer than a window makes a larger one."""
    if len(data) <= 2 * wordhash.WINDOW:
        return wordhash.span_hashes(data, first, last, value)
    out, k = [], 0
    while k < len(first):
        stop = max(k + 1, int(np.searchsorted(last, first[k] + wordhash.WINDOW, "right")))
        low = first[k]
        out.append(wordhash.span_hashes(data[low : last[stop - 1]], first[k:stop] - low, last[k:stop] - low, value))
        k = stop
    return np.concatenate(out)


def _columns(batch: pa.RecordBatch, names: str, rows: list[int], found: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    """Two columns of hashes, and the doc_ids of the rows that they were found in."""
    sizes = [len(x[0]) for x in found]
    columns = [pa.array(np.concatenate([np.zeros(0, np.uint64), *x]).view(np.int64)) for x in (zip(*found, strict=True) if found else ((), ()))]
    ids = batch.column("doc_id").take(pa.array(np.repeat(rows, sizes).astype(np.int64)))
    return pa.RecordBatch.from_arrays([*columns, ids], [x.split()[0] for x in names.split(", ")])


def repeats(documents: DataFrame) -> DataFrame:
    """(doc_id, runs, passages): the digests of the runs of chunks, and of the single passages, that an
    earlier document has, too."""

    def all_runs(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows, found = [], []
        for row, _, _, _, text in _texts(batch.column("text")):
            rows.append(row)
            found.append((text.core, text.run))
        yield _columns(batch, RUNS, rows, found)

    documents = documents.where("doc_id is not null").select("doc_id", "text")
    every = staged(wordhash.mapped(documents, all_runs, RUNS), "runs")
    runs = staged(every.groupBy("core", "run").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")), "firsts")
    # Joined from written tables, so that both sides are dealt anew and Spark can split a frequent run.
    known = runs.where("first < last").select("core", "run", "first").hint("shuffle_hash")
    later = staged(every.join(known, ["core", "run"]).where("doc_id > first").select("doc_id", "run"), "later")
    removed(every)
    several = runs.groupBy("core").agg(F.min("first").alias("low"), F.max("first").alias("high"))
    several = staged(several.where("low < high").select("core"), "cores")
    ends = runs.join(several.hint("shuffle_hash"), "core").groupBy(F.col("first").alias("of")).agg(F.collect_list("run").alias("ends"))
    settled(documents.sparkSession)

    def single(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows, found, wanted = [], [], batch.column("ends")
        for row, _, _, _, text in _texts(batch.column("text")):
            at = text.passages(np.isin(text.run.view(np.int64), wanted[row].values.to_numpy()))
            rows.append(row)
            found.append(text.names(at))
        yield _columns(batch, PASSAGES, rows, found)

    cut = documents.join(ends.hint("shuffle_hash"), F.col("doc_id") == F.col("of")).select("doc_id", "text", "ends")
    passages = staged(wordhash.mapped(cut, single, PASSAGES), "passages")
    removed(runs, several)
    first = passages.groupBy("digest", "second").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    first = staged(first.where("first < last").drop("last"), "firsts")
    found = passages.join(first.hint("shuffle_hash"), ["digest", "second"]).where("doc_id > first").select("doc_id", "second")
    found = staged(later.unionByName(found, allowMissingColumns=True), "found")
    removed(passages, first, later)
    settled(documents.sparkSession)
    return found.groupBy("doc_id").agg(F.collect_list("run").alias("runs"), F.collect_list("second").alias("passages"))


def spans_of(found: np.ndarray) -> list[tuple[int, int]]:
    """Word spans to cut out: what the passages that begin at the words ``found`` cover."""
    if not len(found):
        return []
    new = np.flatnonzero(np.diff(found) > PASSAGE) + 1
    lows, highs = found[np.concatenate([[0], new])], found[np.concatenate([new - 1, [-1]])] + PASSAGE
    return list(zip(lows.tolist(), highs.tolist(), strict=True))


def deduplicated(documents: DataFrame) -> DataFrame:
    """``documents`` without repeated passages, with n_chars (of the new text), n_removed (code
    points cut out) and n_passages; these replace columns of the same names."""
    kept = [c for c in documents.columns if c not in ("n_chars", "n_removed", "n_passages")]
    key, runs, passages = (free(name, kept) for name in ("of_id", "known_runs", "known_passages"))
    found = repeats(documents).toDF(key, runs, passages).hint("shuffle_hash")
    rows = documents.select(*[F.col(f"`{c}`") for c in kept]).join(found, F.col("doc_id") == F.col(key), "left").drop(key)

    def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts, whole, single = batch.column("text"), batch.column(runs), batch.column(passages)
        out = texts.to_pylist()
        lost, spans_cut = [0] * len(out), [0] * len(out)
        rows_ = np.flatnonzero(whole.is_valid().to_numpy(zero_copy_only=False))
        for k, data, starts, ends, text in _texts(texts.take(pa.array(rows_, pa.int64()))):
            at = int(rows_[k])
            gone = text.passages(np.isin(text.run.view(np.int64), whole[at].values.to_numpy()))
            if len(single[at]):
                every = np.arange(text.last[-1] + 1)
                again = np.isin(text.names(every)[1].view(np.int64), single[at].values.to_numpy())
                gone = np.union1d(gone, np.flatnonzero(again))
            spans = spans_of(gone)
            if not spans:
                continue
            raw, left, last = data.tobytes(), [], 0
            for a, b in spans:
                left.append(raw[last : starts[a]])
                last = int(starts[b]) if b < len(starts) else int(ends[b - 1])
            shorter = (b"".join(left) + raw[last:]).decode("utf-8", "replace")
            lost[at], spans_cut[at] = len(out[at]) - len(shorter), len(spans)
            out[at] = shorter
        columns = {c: batch.column(c) for c in kept} | {
            "text": pa.array(out, pa.string()),
            "n_chars": pa.array([None if x is None else len(x) for x in out], pa.int64()),
            "n_removed": pa.array(lost, pa.int64()),
            "n_passages": pa.array(spans_cut, pa.int32()),
        }
        yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    kinds = ", ".join(f"`{c}` {documents.schema[c].dataType.simpleString()}" for c in kept)
    return wordhash.mapped(rows, cut, f"{kinds}, {RESULT}")


def op2_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the passages that an earlier one has; see the module."""
    return deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))
