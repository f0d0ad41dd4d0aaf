"""Words of Arrow string columns as 64-bit hashes, in numpy, without a Python loop over words.

A word is a maximal run of bytes of one class, which is the same as a run of characters as long
as the class holds all bytes from 0x80 on. A-Z count as a-z. The hash of a word is a polynomial
over a random table, read off prefix sums; that of a shingle is a polynomial over its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WINDOW = 1 << 18
SLICE_BYTES = 4 << 20

_random = np.random.default_rng(20240229)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_VALUE = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_VALUE[ord("A") : ord("Z") + 1] = _VALUE[ord("a") : ord("z") + 1]
# Tables that tell capital letters from small ones.
EXACT = [_random.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(2)]
_powers = [np.zeros(0, np.uint64), np.zeros(0, np.uint64)]


def byte_class(*spans: tuple[int, int]) -> np.ndarray:
    """A table of 256 flags, true for the bytes in the given closed spans."""
    table = np.zeros(256, bool)
    for low, high in spans:
        table[low : high + 1] = True
    return table


# The word definitions of the queries.
ALPHANUMERIC = byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
NOT_SPACE = byte_class((0x00, 0x08), (0x0E, 0x1F), (0x21, 0xFF))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            row = np.full(max(n, WINDOW + 4096), base, np.uint64)
            row[0] = 1
            _powers[k] = np.multiply.accumulate(row)
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread all bits over all bits, one to one."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, value: np.ndarray = _VALUE) -> np.ndarray:
    """Hash of each span of ``data``, with the given number for each byte."""
    return sequence_hashes(value[data], starts, ends)


def sequence_hashes(numbers: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each span of ``numbers``, such as hashes of words or chunks."""
    power, inverse = _power(len(numbers) + 1)
    sums = np.zeros(len(numbers) + 1, np.uint64)
    np.cumsum(numbers * power[: len(numbers)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def run_hashes(data: np.ndarray, size: int, value: np.ndarray = _VALUE) -> np.ndarray:
    """Hash of each run of ``size`` bytes, by its first byte, as :func:`span_hashes` gives it."""
    power, inverse = _power(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(value[data] * power[: len(data)], out=sums[1:])
    return mix((sums[size:] - sums[:-size]) * inverse[: len(data) - size + 1] + np.uint64(size))


def word_spans(data: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and byte behind the last one of each word."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = word[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[0::2], edges[1::2]


def windows(data: np.ndarray, joint: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cuts of ``data`` into about WINDOW bytes, never between two bytes of class ``joint``."""
    at = 0
    while at < len(data):
        end = at + WINDOW
        if end >= len(data):
            end = len(data)
        else:
            while end < len(data):
                free = np.flatnonzero(~joint[data[end : end + 4096]])
                if len(free):
                    end += int(free[0])
                    break
                end = min(end + 4096, len(data))
        yield at, end
        at = end


def words(data: np.ndarray, word: np.ndarray, value: np.ndarray = _VALUE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the words of ``data``, with the given number for each byte."""
    found = []
    for low, high in windows(data, word):
        part = data[low:high]
        starts, ends = word_spans(part, word)
        found.append((starts + low, ends + low, span_hashes(part, starts, ends, value)))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words, by its first word."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total *= np.uint64(_BASE)
        total += hashes[k : k + n]
    return mix(total ^ np.uint64(size))


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows of about ``limit`` bytes: first row, row behind the last, the bytes of the
    rows with a line feed behind each, and the start of each row in them (with the total at the
    end). A null text is empty."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    lengths = np.diff(np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1])
    at = 0
    while at < len(texts):
        end, total = at, 0
        while end < len(texts) and (end == at or total + lengths[end] <= limit):
            total += int(lengths[end])
            end += 1
        rows = texts.slice(at, end - at).to_pylist()
        data = np.frombuffer(b"\n".join([*rows, b""]), np.uint8)
        starts = np.zeros(end - at + 1, np.int64)
        np.cumsum(lengths[at:end] + 1, out=starts[1:])
        yield at, end, data, starts
        at = end


def text_words(texts: pa.Array, word: np.ndarray, value: np.ndarray = _VALUE) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each text: its row, its bytes, and the starts, ends and hashes of its words."""
    for low, high, data, rows in slices(texts):
        starts, ends, hashes = words(data, word, value)
        cuts = np.searchsorted(starts, rows)
        for k in range(high - low):
            part = slice(cuts[k], cuts[k + 1])
            yield low + k, data[rows[k] : rows[k + 1] - 1], starts[part] - rows[k], ends[part] - rows[k], hashes[part]


def mapped(frame, function, schema: str):
    """``mapInArrow`` with a function from a record batch to record batches (or columns)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from function(batch)
        pa.default_memory_pool().release_unused()  # workers live on, and hold what they ever needed

    return frame.mapInArrow(run, schema)
