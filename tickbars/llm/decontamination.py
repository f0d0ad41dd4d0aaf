"""Benchmark decontamination by winnowing.

The k-gram hashes of a text are winnowed: of every ``WINNOW`` consecutive k-grams the one with
the smallest hash is kept. With ``K + WINNOW - 1 = SPAN`` words, two texts that share ``SPAN``
consecutive words keep at least one k-gram in common there, since the choice depends on the words
alone. So the kept k-grams of documents and items are joined, every hit is extended to the
``SPAN``-word windows around it, and these are compared word by word.

An item of fewer words is one window; it is found by the hash of its whole length, which needs a
pass over the document's words for each such length that occurs.

The benchmark is dealt into blocks of at most ``BLOCK_BYTES`` of text by cumulated size. A block is
what a task holds of it, whatever its size as a whole; documents are read once for each block and
never shuffled. Per document only hit positions and item ids leave a block, and are united over the
blocks.

Rows: null texts have no words; an item without words is none; repeated rows (equal doc_id and
text) are reported once each; an empty benchmark hits nothing; other columns are ignored
(``clean_rows`` keeps them).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickbars.llm import wordhash
from tickbars.llm.tables import free, table

SPAN = 13
K = 6
WINNOW = SPAN - K + 1
BLOCK_BYTES = 16 << 20

HITS = "doc_id long, copy long, n_words long, spans binary, items array<long>"
REPORT = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def winnowed(grams: np.ndarray, size: int) -> np.ndarray:
    """Places of the kept hashes: the (rightmost) smallest of each ``size`` consecutive ones."""
    if len(grams) <= size:
        return np.array([len(grams) - 1 - int(np.argmin(grams[::-1]))]) if len(grams) else np.zeros(0, np.int64)
    # Sliding minimum by doubling; then an element is kept if it is the minimum of a window and no
    # equal one stands to its right in that window.
    low, width = grams, 1
    while width * 2 <= size:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    n = len(grams) - size + 1
    low = np.minimum(low[:n], low[size - width : size - width + n])
    kept = np.zeros(len(grams), bool)
    open_ = np.ones(n, bool)
    for back in range(size - 1, -1, -1):
        here = open_ & (grams[back : back + n] == low)
        kept[back : back + n] |= here
        open_ &= ~here
    return np.flatnonzero(kept)


class Block:
    """Fingerprints and windows of some benchmark items."""

    def __init__(self, items: list[tuple[int, str | None]]):
        column = pa.array([text for _, text in items], pa.string())
        self.words, self.item, ids = [], [], []
        for row, data, starts, ends, hashes in wordhash.text_words(column, wordhash.ALPHANUMERIC):
            self.words.append(hashes)
            ids.append(items[row][0])
        self.ids = np.array(ids, object)
        gram, item, place = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        self.short: dict[int, dict[int, list[int]]] = {}
        for k, words in enumerate(self.words):
            if 0 < len(words) < SPAN:
                whole = int(wordhash.shingles(words, len(words))[0])
                self.short.setdefault(len(words), {}).setdefault(whole, []).append(k)
            elif len(words):
                grams = wordhash.shingles(words, K)
                at = winnowed(grams, WINNOW)
                gram.append(grams[at])
                place.append(at)
                item.append(np.full(len(at), k))
        gram = np.concatenate(gram)
        order = np.argsort(gram, kind="stable")
        self.gram, self.item, self.place = gram[order], np.concatenate(item)[order], np.concatenate(place)[order]
        # A cheap first test: the top bits of the fingerprints.
        self.seen = np.zeros(1 << 16, bool)
        self.seen[(self.gram >> np.uint64(48)).astype(np.int64)] = True

    def of(self, words: np.ndarray) -> tuple[np.ndarray, set]:
        """The hit words of a document as flags, and the items that occur."""
        hit, found = np.zeros(len(words), bool), set()
        for length, wholes in self.short.items():
            grams = wordhash.shingles(words, length)
            at = np.flatnonzero(np.isin(grams, np.fromiter(wholes, np.uint64, len(wholes))))
            for p in at.tolist():
                for k in wholes[int(grams[p])]:
                    if np.array_equal(self.words[k], words[p : p + length]):
                        hit[p : p + length] = True
                        found.add(k)
        if len(words) >= SPAN and len(self.gram):
            grams = wordhash.shingles(words, K)
            places = winnowed(grams, WINNOW)
            kept = grams[places]
            maybe = self.seen[(kept >> np.uint64(48)).astype(np.int64)]
            places, kept = places[maybe], kept[maybe]
            low, high = np.searchsorted(self.gram, kept, "left"), np.searchsorted(self.gram, kept, "right")
            lines = set()
            for p, a, b in zip(places.tolist(), low.tolist(), high.tolist(), strict=True):
                for x in range(a, b):
                    lines.add((int(self.item[x]), p - int(self.place[x])))
            for k, shift in lines:
                self._extend(words, k, shift, hit, found)
        return hit, found

    def _extend(self, words: np.ndarray, k: int, shift: int, hit: np.ndarray, found: set) -> None:
        """Compare item ``k``, laid at ``shift``, with the document; equal runs of SPAN words are hits."""
        item = self.words[k]
        low, high = max(0, shift), min(len(words), shift + len(item))
        same = np.zeros(high - low + 2, np.int8)
        same[1:-1] = words[low:high] == item[low - shift : high - shift]
        edges = np.flatnonzero(same[1:] != same[:-1])
        for a, b in zip(edges[0::2], edges[1::2], strict=True):
            if b - a >= SPAN:
                hit[low + a : low + b] = True
                found.add(k)


def blocks(benchmark: DataFrame, limit: int = BLOCK_BYTES) -> Iterator[list[tuple[int, str | None]]]:
    """The items in blocks of at most ``limit`` bytes (or one item), read block by block.

    Items are dealt by hash into so many blocks that the largest holds under ``limit``.
    """
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 64
    total = benchmark.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    parts = max(1, -(-2 * total // limit) if total > limit else 1)
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    for k in range(parts):
        yield [tuple(x) for x in benchmark.where(part == k).select("item_id", "text").collect()]


def hits(documents: DataFrame, items: list[tuple[int, str | None]]) -> DataFrame:
    """Of every document (doc_id, text): its words, hit words as packed flags, and items."""
    shared = documents.sparkSession.sparkContext.broadcast(items)
    made: dict[int, Block] = {}

    def look(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        block = made.get(0) or made.setdefault(0, Block(shared.value))
        keys = batch.column("doc_id").to_pylist()
        out = []
        for row, data, _, _, words in wordhash.text_words(batch.column("text"), wordhash.ALPHANUMERIC):
            hit, found = block.of(words)
            copy = int.from_bytes(hashlib.blake2b(data.tobytes(), digest_size=8).digest(), "little", signed=True)
            out.append((keys[row], copy, len(words), np.packbits(hit).tobytes() if found else b"", sorted({block.ids[k] for k in found if block.ids[k] is not None})))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)], ["doc_id", "copy", "n_words", "spans", "items"])

    return wordhash.mapped(documents.select("doc_id", "text"), look, HITS)


def is_contaminated(hit, words):
    """Fixed value: a twentieth of the words."""
    return (hit > 0) & (20 * hit >= words)


def contamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """REPORT: one row for each row of ``documents``."""
    found = [hits(documents, items) for items in blocks(benchmark)]
    every = found[0]
    if len(found) > 1:
        for more in found[1:]:
            every = every.unionByName(more)
        every = every.groupBy("doc_id", "copy").applyInPandas(_united(len(found)), HITS)

    def report(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        n = batch.column("n_words").to_numpy()
        hit = np.array([int(np.unpackbits(np.frombuffer(x, np.uint8)).sum()) if x else 0 for x in batch.column("spans").to_pylist()], np.int64)
        items = batch.column("items").to_pylist()
        names = [hashlib.sha256(",".join(sorted(map(str, x))).encode()).hexdigest() for x in items]
        columns = [batch.column("doc_id"), pa.array(n), pa.array(hit), pa.array([len(x) for x in items], pa.int64()), pa.array(names), pa.array(is_contaminated(hit, n))]
        yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in REPORT.split(", ")])

    return wordhash.mapped(every, report, REPORT)


def _united(blocks_read: int):
    def united(frame: pd.DataFrame) -> pd.DataFrame:
        """What the blocks found for one text; a text that occurs n times comes n times a block."""
        spans = [np.frombuffer(x, np.uint8) for x in frame["spans"] if len(x)]
        flags = np.bitwise_or.reduce(spans).tobytes() if spans else b""
        items = sorted({int(i) for x in frame["items"] for i in x})
        row = frame.iloc[0]
        rows = len(frame) // blocks_read
        return pd.DataFrame({"doc_id": [row["doc_id"]] * rows, "copy": row["copy"], "n_words": row["n_words"], "spans": [flags] * rows, "items": [items] * rows}).astype({"doc_id": "Int64"})

    return united


def clean_rows(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``documents`` that are not contaminated, whole; each is judged by its own text.

    One pass for each block of the benchmark marks hit words beside the row, the last one decides;
    nothing is shuffled."""
    context = documents.sparkSession.sparkContext
    parts = [context.broadcast(items) for items in blocks(benchmark)]
    flags = free("hit", documents.columns)
    marked = T.StructType([*documents.schema.fields, T.StructField(flags, T.BinaryType())])
    rows = documents
    for number, shared in enumerate(parts):
        last = number + 1 == len(parts)
        rows = wordhash.mapped(rows, _marking(shared, flags, last), documents.schema if last else marked)
    return rows


def _marking(shared, flags: str, last: bool):
    """A pass over rows that marks what one block hits, and at last keeps the clean rows."""
    made: dict[int, Block] = {}

    def mark(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        block = made.get(0) or made.setdefault(0, Block(shared.value))
        before = batch.column(flags).to_pylist() if flags in batch.schema.names else [None] * batch.num_rows
        found: list[np.ndarray] = []
        for row, _, _, _, words in wordhash.text_words(batch.column("text"), wordhash.ALPHANUMERIC):
            hit, _ = block.of(words)
            found.append(hit if before[row] is None else hit | np.frombuffer(before[row], bool))
        columns = {name: batch.column(name) for name in batch.schema.names if name != flags}
        if not last:
            columns[flags] = pa.array([x.tobytes() for x in found], pa.binary())
        out = pa.RecordBatch.from_arrays(list(columns.values()), list(columns))
        yield out.filter(pa.array([not is_contaminated(int(x.sum()), len(x)) for x in found])) if last else out

    return mark


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in all documents; see the module."""
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
