"""Fill-in-middle: texts cut at two places and put together anew, so that a model learns to write a middle.

One match of the regex library cuts a text: ``fullmatch`` of ``(unit)*`` keeps every repetition of its
group, so ``match.ends(1)`` holds the end of each unit. Its length is the number of units, and both
cuts are looked up in it; no loop runs over units. The unit is a code point unless another pattern is
given. The library keeps some 180 bytes a unit while it matches and gives up beyond a few million, so a
text of more than ``PIECE`` units is matched by as many units at a time, each match from the end of the
one before.

Where a text is cut, in which form, and whether at all follows from a digest of seed and doc_id alone:
a run that is repeated, or another partitioning, gives the same rows. Each text is read once, by itself;
nothing is shuffled.

Forms: ``psm`` is <P>prefix<S>suffix<M>middle, ``spm`` is <S>suffix<P>prefix<M>middle, ``plain`` is the
text as it is. A text is plain if it is empty, holds one of the marks (so marks in an output are never
the text's own and :func:`restored` is exact), is not made up of units, or by lot.

Rows: a null text is empty; rows of equal doc_id are cut by the same numbers, each in its own text; a
null doc_id counts as no digits; an empty table gives no rows; other columns, whatever their names, are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from tickbars.llm import wordhash
from tickbars.llm.tables import table

# The marks and names of the forms, the lots (of 100) and the digits of a number.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
PLAIN_FROM, SPM_BELOW, LOTS = 90, 20, 100
DIGITS = 8
CODE_POINT = "(?s:.)"

PIECE = 1 << 18

SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
DIGESTS = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"


@dataclass(frozen=True)
class Cut:
    n: int
    form: str
    output: str
    prefix_chars: int | None = None
    middle_chars: int | None = None


class Cutter:
    """Cuts texts into units; ``unit`` is a pattern of the regex library that never matches nothing."""

    def __init__(self, unit: str = CODE_POINT, seed: int = 1):
        self.whole = regex.compile(f"((?>{unit}))*")
        self.some = regex.compile(f"((?>{unit})){{1,{PIECE}}}+")
        self.seed = seed

    def ends(self, text: str) -> list[int] | None:
        """Where each unit ends; None if units do not make up the whole text."""
        if len(text) <= PIECE:
            match = self.whole.fullmatch(text)
            return match and match.ends(1)
        found, at = [], 0
        while at < len(text):
            match = self.some.match(text, at)
            if match is None:
                return None
            found += match.ends(1)
            at = match.end()
        return found

    def numbers(self, doc_id: int | None) -> list[int]:
        digest = hashlib.sha256(f"{self.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
        return [int(digest[k : k + DIGITS], 16) for k in range(0, 4 * DIGITS, DIGITS)]

    def cut(self, doc_id: int | None, text: str) -> Cut:
        ends = self.ends(text)
        if ends is None:
            return Cut(0, PLAIN, text)
        n = len(ends)
        one, two, lot, order = self.numbers(doc_id)
        if not n or lot % LOTS >= PLAIN_FROM or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
            return Cut(n, PLAIN, text)
        first, last = (ends[k - 1] if k else 0 for k in sorted((one % (n + 1), two % (n + 1))))
        prefix, middle, suffix = PREFIX + text[:first], MIDDLE + text[first:last], SUFFIX + text[last:]
        if order % LOTS < SPM_BELOW:
            return Cut(n, SPM, suffix + prefix + middle, first, last - first)
        return Cut(n, PSM, prefix + suffix + middle, first, last - first)


def restored(output: str, form: str) -> str:
    """The text that an output of a form was made of."""
    if form == PLAIN:
        return output
    marks = (PREFIX, SUFFIX, MIDDLE) if form == PSM else (SUFFIX, PREFIX, MIDDLE)
    part, rest = {}, output
    for mark, following in zip(marks, (*marks[1:], None), strict=True):
        part[mark], _, rest = rest.removeprefix(mark).partition(following) if following else (rest.removeprefix(mark), "", "")
        rest = (following or "") + rest
    return part[PREFIX] + part[MIDDLE] + part[SUFFIX]


def _cuts(documents: DataFrame, schema: str, last: tuple, unit: str, seed: int) -> DataFrame:
    """One row per document: what a :class:`Cut` holds, and columns made of it by the functions ``last``."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        cutter = Cutter(unit, seed)
        ids, rows = batch.column("doc_id"), []
        for doc_id, text in zip(ids.to_pylist(), batch.column("text"), strict=True):
            cut = cutter.cut(doc_id, text.as_py() or "")
            rows.append((cut.n, cut.form, cut.prefix_chars, cut.middle_chars, *[f(cut) for f in last]))
        names = [field.split()[0] for field in schema.split(", ")]
        kinds = {"long": pa.int64(), "string": pa.string()}
        types = [kinds[field.split()[1]] for field in schema.split(", ")]
        columns = [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([ids.cast(pa.int64()), *columns], names)

    return wordhash.mapped(documents.select("doc_id", "text"), run, schema)


def fill_in_middle(documents: DataFrame, unit: str = CODE_POINT, seed: int = 1) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of each document."""
    return _cuts(documents, SCHEMA, (lambda cut: cut.output,), unit, seed)


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents cut by code points; digests of each output and of the text got back from it."""
    documents = table(spark, sf_dir, "documents")
    both = (lambda cut: _sha256(cut.output), lambda cut: _sha256(restored(cut.output, cut.form)))
    return _cuts(documents, DIGESTS, both, CODE_POINT, 1)
