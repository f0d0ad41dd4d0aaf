"""Packing token sequences into windows of equal capacity by Karmarkar-Karp differencing.

A document's ids are its tokens and the end token. Whole windows of a long document leave at
once; what is left of each document (under one window) is dealt to groups of about
``GROUP_TOKENS`` tokens, by hash and row, so no key is hot. In a group, multiway differencing
merges partial partitions, the largest bins of one with the smallest of the other, into ``k``
near-equal windows; ``k`` rises until the largest fits. Since documents may be cut, the emptiest
windows are then dissolved to fill the gaps of the others, and what stays in the end is cut at
powers of two, which need no padding.

Rows: nulls count as empty texts (one end token); repeated rows are packed each by itself; an
empty table gives no pieces; other columns are ignored. Sequence ids are unique, not gapless.
"""

from __future__ import annotations

import heapq
import itertools
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickbars.llm import wordhash
from tickbars.llm.tables import staged, table

CAPACITY = 4096
GROUP_TOKENS = 1 << 20
SLOT_BITS = 20
END = 2
TOKENIZER = "word_bpe_49k.json"
SPECIAL = (b"<|startoftext|>", b"<|endoftext|>")

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, padded long"
REST = "doc_id long, start long, doc_tokens long, n int, ids binary, sequence_id long"

# Units of text that are tokenized by themselves: the tokenizer never joins a letter and an ASCII
# mark, except after an apostrophe, and never reaches across white space.
_UNIT = np.full(256, 2, np.uint8)
_UNIT[[*range(0x09, 0x0E), 0x20]] = 0
_UNIT[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 1
_UNIT[[0x27, *range(0x80, 0x100)]] = 4


# Units that are one pre-token and that the tokenizer only puts into lower case: letters of ASCII
# and of the Latin blocks without decompositions that change, or ASCII marks but the apostrophe.
_PLAIN = re.compile("[a-z\u00e0-\u00f6\u00f8-\u00ff]+|[!-&(-/:-@\\[-`{-~]+")
# Byte-level alphabet: printable bytes stand for themselves, the others for U+0100 and up, in order.
_SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_ALPHABET = {b: chr(b) if b in _SHOWN else chr(0x100 + sum(x not in _SHOWN for x in range(b))) for b in range(256)}


class UnitTokens:
    """Ids of text units, kept in a table of fixed size that new units overwrite."""

    SLOTS = 1 << SLOT_BITS
    POOL = 1 << 22
    LONGEST = 256

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.keys = np.zeros(self.SLOTS, np.uint64)
        self.at = np.zeros(self.SLOTS, np.int32)
        self.size = np.zeros(self.SLOTS, np.uint16)
        self.pool = np.zeros(self.POOL, np.uint16)
        self.used = 0

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode_units(self, units: list[str]) -> list[list[int]]:
        out, rest = [], []
        plain, tokenize = _PLAIN.fullmatch, self.model.tokenize
        for unit in units:
            low = unit.lower()
            if plain(low):
                if not low.isascii():
                    low = low.encode().decode("latin-1").translate(_ALPHABET)
                out.append([t.id for t in tokenize(low)])
            else:
                rest.append((len(out), unit))
                out.append([])
        if rest:
            for (k, _), ids in zip(rest, self.encode([x for _, x in rest]), strict=True):
                out[k] = ids
        return out

    def of(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts of the units of ``data``, how many ids each has, and all ids in order."""
        kind = _UNIT[data]
        start = np.ones(len(data), bool)
        start[1:] = (kind[1:] * kind[:-1] == 0) | (kind[1:] + kind[:-1] == 3)
        start &= kind != 0
        starts = np.flatnonzero(start)
        if not len(starts):
            return starts, np.zeros(0, np.int64), np.zeros(0, np.uint16)
        end = np.ones(len(data), bool)
        end[:-1] = start[1:] | (kind[1:] == 0)
        end &= kind != 0
        ends = np.flatnonzero(end) + 1
        hashes = wordhash.span_hashes(data, starts, ends) | np.uint64(1)
        slot = (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        at, size = self.at[slot], self.size[slot].astype(np.int64)
        new = np.flatnonzero(self.keys[slot] != hashes)
        pool = self.pool
        if len(new):
            _, first, which = np.unique(hashes[new], return_index=True, return_inverse=True)
            first = new[first]
            raw = data.tobytes()
            ids = self.encode_units([raw[a:b].decode("utf-8", "replace") for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)])
            sizes = np.array(list(map(len, ids)), np.int64)
            flat = np.array(list(itertools.chain.from_iterable(ids)), np.uint16)
            places = np.cumsum(sizes) - sizes
            if self.used + len(flat) > self.POOL:  # start anew; this window reads the old ids once more
                pool = np.concatenate([pool[: self.used], flat])
                at, places = at.astype(np.int64), places + self.used
                self.keys[:], self.used = 0, 0
            else:
                places += self.used
                pool[self.used : self.used + len(flat)] = flat
                self.used += len(flat)
                short = np.flatnonzero(ends[first] - starts[first] <= self.LONGEST)
                # Of units that share a slot, one stays: the first in the order of hashes.
                to, one = np.unique(slot[first[short]], return_index=True)
                short = short[one]
                self.at[to], self.size[to], self.keys[to] = places[short], sizes[short], hashes[first[short]]
            at[new], size[new] = places[which], sizes[which]
        ends_of = np.cumsum(size)
        index = np.repeat(at - (ends_of - size), size)
        index += np.arange(len(index))
        return starts, size, pool[index]


_loaded: dict[str, UnitTokens] = {}


def document_ids(texts: pa.Array, path: str) -> Iterator[tuple[int, np.ndarray]]:
    """The row and the ids of each text, exactly as the tokenizer gives them for the whole text."""
    tokens = _loaded.setdefault(path, None) or UnitTokens(path)
    _loaded[path] = tokens
    space = _UNIT != 0
    for low, high, data, rows in wordhash.slices(texts):
        starts, sizes, ids = [], [], []
        for a, b in wordhash.windows(data, space):
            s, n, i = tokens.of(data[a:b])
            starts.append(s + a)
            sizes.append(n)
            ids.append(i)
        starts, sizes, ids = np.concatenate(starts), np.concatenate(sizes), np.concatenate(ids)
        before = np.zeros(len(sizes) + 1, np.int64)
        np.cumsum(sizes, out=before[1:])
        cuts = before[np.searchsorted(starts, rows)]
        raw = data.tobytes()
        special = any(x in raw for x in SPECIAL)
        for k in range(high - low):
            found = ids[cuts[k] : cuts[k + 1]]
            if special and any(x in (text := raw[rows[k] : rows[k + 1] - 1]) for x in SPECIAL):
                found = np.array(tokens.encode([text.decode("utf-8", "replace")])[0], np.uint16)
            yield low + k, np.append(found, np.uint16(END))


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def differenced(sizes: np.ndarray, k: int) -> list[np.ndarray]:
    """``k`` near-equal bins of the items, by multiway differencing; each bin lists its items.

    A partial partition is ``k`` bins, largest first, and is ranked by the spread of its sums.
    The two with the largest spreads merge, largest bins with smallest ones, until one is left.
    """
    if k == 1 or not len(sizes):
        return [np.arange(len(sizes))] + [np.zeros(0, np.int64)] * (k - 1)
    left, right = [], []  # of each merged bin; items are the numbers below len(sizes)
    heap = []
    for item, size in enumerate(sizes.tolist()):
        # Bins that hold something, largest first; the other bins are empty.
        heap.append((-size, item, np.array([size]), np.array([item])))
    heapq.heapify(heap)
    number = len(heap)
    while len(heap) > 1:
        _, _, sums, bins = heapq.heappop(heap)
        _, _, sums2, bins2 = heapq.heappop(heap)
        over = len(sums) + len(sums2) - k
        if over > 0:  # the smallest bins of each meet the largest of the other
            a, b = slice(len(sums) - over, None), slice(len(sums2) - over, None)
            paired = sums[a] + sums2[b][::-1]
            made = np.arange(len(left), len(left) + over) + len(sizes)
            left.extend(bins[a].tolist())
            right.extend(bins2[b][::-1].tolist())
            sums = np.concatenate([sums[: len(sums) - over], paired, sums2[: len(sums2) - over]])
            bins = np.concatenate([bins[: len(bins) - over], made, bins2[: len(bins2) - over]])
        else:
            sums, bins = np.concatenate([sums, sums2]), np.concatenate([bins, bins2])
        order = np.argsort(-sums, kind="stable")
        sums, bins = sums[order], bins[order]
        smallest = int(sums[-1]) if len(sums) == k else 0
        heapq.heappush(heap, (smallest - int(sums[0]), number, sums, bins))
        number += 1
    out = []
    for top in heap[0][3].tolist():
        items, open_ = [], [top]
        while open_:
            x = open_.pop()
            if x < len(sizes):
                items.append(x)
            else:
                open_ += (left[x - len(sizes)], right[x - len(sizes)])
        out.append(np.array(sorted(items)))
    return out + [np.zeros(0, np.int64)] * (k - len(out))


def packed(sizes: np.ndarray, capacity: int = CAPACITY) -> list[list[tuple[int, int, int]]]:
    """Windows of (item, first token, tokens): each full, or a power of two long."""
    total = int(sizes.sum())
    k = max(1, -(-total // capacity))
    while True:
        bins = differenced(sizes, k)
        sums = np.array([int(sizes[b].sum()) for b in bins])
        if sums.max() <= capacity:
            break
        k = max(k + 1, -(-int(k * sums.max()) // capacity)) if sums.max() > 1.02 * capacity else k + 1
    order = np.argsort(-sums, kind="stable")
    gap = capacity - sums[order]
    whole, spare = len(bins), 0
    # Windows from the emptiest on give their tokens to the gaps of the fuller ones.
    while whole and int(gap[: whole - 1].sum()) >= spare + int(sums[order[whole - 1]]):
        whole -= 1
        spare += int(sums[order[whole]])
    if whole and int(gap[:whole].sum()) > spare:
        whole -= 1
        spare += int(sums[order[whole]])
    pieces = iter([(int(i), 0, int(sizes[i])) for b in order[whole:] for i in bins[b]])
    now = next(pieces, None)

    def take(n: int) -> list[tuple[int, int, int]]:
        nonlocal now
        got = []
        while n and now:
            item, start, length = now
            used = min(n, length)
            got.append((item, start, used))
            n -= used
            now = (item, start + used, length - used) if used < length else next(pieces, None)
        return got

    out = [[(int(i), 0, int(sizes[i])) for i in bins[b]] + take(capacity - int(sums[b])) for b in order[:whole]]
    spare -= int(gap[:whole].sum())
    while spare > 0:
        length = min(capacity, 1 << (spare.bit_length() - 1))
        out.append(take(length))
        spare -= length
    return out


def pack(documents: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of ``documents`` (doc_id, text), as PIECE; ``padded`` is its sequence's length with
    padding. ``path`` names the tokenizer's file on every executor."""

    def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        # Whole windows get ids by task and row, the groups' ids start behind those.
        task = TaskContext.get().partitionId()
        keys = batch.column("doc_id").to_pylist()
        out, size = [], 0
        for row, ids in document_ids(batch.column("text"), path):
            whole = len(ids) // capacity * capacity
            for start in range(0, whole, capacity):
                part = ids[start : start + capacity]
                out.append((keys[row], start, len(ids), capacity, part.tobytes(), (task << 36) + counter[0]))
                counter[0] += 1
            if whole < len(ids):
                out.append((keys[row], whole, len(ids), len(ids) - whole, ids[whole:].tobytes(), None))
            size += 2 * len(ids)
            if size > wordhash.SLICE_BYTES:
                yield rows(out)
                out, size = [], 0
        if out:
            yield rows(out)

    def rows(out: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64())
        columns = [pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "doc_tokens", "n", "ids", "sequence_id"])

    counter = [0]
    spark = documents.sparkSession
    cuts = staged(wordhash.mapped(documents.select("doc_id", "text"), cut, REST), "packing")
    whole = cuts.where("sequence_id is not null")
    rest = cuts.where("sequence_id is null")
    total = rest.agg(F.coalesce(F.sum(F.col("n").cast("long")), F.lit(0))).first()[0]
    groups = max(1, round(total / GROUP_TOKENS))

    def windows(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["doc_id", "start", "ids"], ignore_index=True)
        base = (1 << 62) + (int(frame["group"].iloc[0]) << 24)
        ids = [np.frombuffer(x, np.uint16) for x in frame["ids"]]
        out = []
        for number, window in enumerate(packed(frame["n"].to_numpy(np.int64), capacity)):
            at, length = 0, sum(x[2] for x in window)
            padded = length if length & (length - 1) == 0 else capacity
            for item, start, used in window:
                out.append((frame["doc_id"].iloc[item], frame["start"].iloc[item] + start, used, crc(ids[item][start : start + used]), frame["doc_tokens"].iloc[item], base + number, at, padded))
                at += used
        return pd.DataFrame(out, columns=[x.split()[0] for x in PIECE.split(", ")]).astype({"doc_id": "Int64"})

    def full(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        n, ids = batch.num_rows, batch.column("ids").to_pylist()
        crcs = [crc(np.frombuffer(x, np.uint16)) for x in ids]
        same = pa.array([capacity] * n, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("start"), same, pa.array(crcs, pa.int64()), batch.column("doc_tokens"), batch.column("sequence_id"), pa.array([0] * n, pa.int64()), same],
            [x.split()[0] for x in PIECE.split(", ")],
        )

    dealt = rest.withColumn("group", F.pmod(F.xxhash64("doc_id", "ids", F.monotonically_increasing_id()), F.lit(groups)).cast("long"))
    grouped = dealt.groupBy("group").applyInPandas(windows, PIECE)
    return wordhash.mapped(whole, full, PIECE).unionByName(grouped)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 4096 tokens; see the module."""
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
