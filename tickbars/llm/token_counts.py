"""Counting unigram tokens without making them: Aho-Corasick and a count-only Viterbi.

The vocabulary are the ordinary pieces of a SentencePiece model with their scores. An automaton
enumerates all pieces that end at each character; dynamic programming carries the best score and the
number of its pieces, no back pointers. The rules are those of the unigram tokenizer: a character that
is no piece may stand alone at the worst score minus 10 and counts as its UTF-8 bytes; of equal scores
the piece that starts first stays.

A text is cut before each space, and the space belongs to what follows (as ``▁``; one is put before a
text that does not start with one). So pieces of several spaces, of which the vocabulary has 14, are
never used. Pieces do not reach across these cuts, nor across a character
that no piece holds, such as a line feed, so a text's count is the sum over its units. Units repeat, so
each task keeps the counts of those it met in a table of fixed size.

Rows: null and empty texts have no tokens; very long words are one unit, in time proportional to their
length; repeated rows are counted each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from tickbars.llm import wordhash
from tickbars.llm.tables import table

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
PENALTY = 10.0
SLOT_BITS = 20
COUNTS = "doc_id long, n_tokens long, score double"


def vocabulary(path: str) -> list[tuple[str, float]]:
    """The ordinary pieces of a model and their scores."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [k for k in range(model.get_piece_size()) if not (model.is_unknown(k) or model.is_control(k) or model.is_byte(k) or model.is_unused(k))]
    return [(model.id_to_piece(k), model.get_score(k)) for k in plain]


class Viterbi:
    """Best score and number of pieces of strings."""

    SLOTS = 1 << SLOT_BITS
    LONGEST = 256

    def __init__(self, pieces: list[tuple[str, float]]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (score, len(piece)))
        self.automaton.make_automaton()
        self.single = {piece for piece, _ in pieces if len(piece) == 1}
        self.unknown = min(score for _, score in pieces) - PENALTY
        # A character in no piece parts a text wherever it stands.
        self.parts = "\n" if not any("\n" in piece for piece, _ in pieces) else ""
        self.keys = np.zeros(self.SLOTS, np.uint64)
        self.count = np.zeros(self.SLOTS, np.int32)
        self.score = np.zeros(self.SLOTS, np.float64)

    def best(self, text: str) -> tuple[int, float]:
        n = len(text)
        best, count = [float("-inf")] * (n + 1), [0] * (n + 1)
        best[0] = 0.0
        if self.single.issuperset(text):
            # Matches come by their end, the longest first: a later equal score changes nothing.
            for end, (score, length) in self.automaton.iter(text):
                at = end + 1 - length
                total = best[at] + score
                if total > best[end + 1]:
                    best[end + 1], count[end + 1] = total, count[at] + 1
            return count[n], best[n]
        ends: list[list[tuple[float, int]]] = [[] for _ in text]
        for end, match in self.automaton.iter(text):
            ends[end].append(match)
        for end, letter in enumerate(text):
            for score, length in ends[end]:
                at = end + 1 - length
                total = best[at] + score
                if total > best[end + 1]:
                    best[end + 1], count[end + 1] = total, count[at] + 1
            if letter not in self.single and best[end] + self.unknown > best[end + 1]:
                best[end + 1], count[end + 1] = best[end] + self.unknown, count[end] + len(letter.encode())
        return count[n], best[n]

    def units(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, spaced: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts and scores of spans of ``data``, each behind a space if ``spaced``."""
        hashes = wordhash.mix(wordhash.span_hashes(data, starts, ends, wordhash.EXACT[0]) + spaced.astype(np.uint64)) | np.uint64(1)
        slot = (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        count, score = self.count[slot].astype(np.int64), self.score[slot]
        new = np.flatnonzero(self.keys[slot] != hashes)
        if len(new):
            _, first, which = np.unique(hashes[new], return_index=True, return_inverse=True)
            first = new[first]
            raw = data.tobytes()
            found = [
                self.best((SPACE if s else "") + raw[a:b].decode("utf-8", "replace"))
                for a, b, s in zip(starts[first].tolist(), ends[first].tolist(), spaced[first].tolist(), strict=True)
            ]
            counts = np.array([x[0] for x in found], np.int64)
            scores = np.array([x[1] for x in found])
            count[new], score[new] = counts[which], scores[which]
            short = np.flatnonzero(ends[first] - starts[first] <= self.LONGEST)
            to, one = np.unique(slot[first[short]], return_index=True)
            short = short[one]
            self.keys[to], self.count[to], self.score[to] = hashes[first[short]], counts[short], scores[short]
        return count, score


_made: dict[str, Viterbi] = {}


def counted(texts: pa.Array, path: str) -> Iterator[tuple[int, int, float]]:
    """Row, number of tokens and best score of each text."""
    viterbi = _made.get(path) or _made.setdefault(path, Viterbi(vocabulary(path)))
    cut = wordhash.byte_class((0x20, 0x20), *([(0x0A, 0x0A)] if viterbi.parts else []))
    texts = pc.replace_substring(texts, SPACE, " ")  # the tokenizer takes them for the same
    alone = viterbi.best(SPACE)
    feed = viterbi.best("\n")
    for low, high, data, rows in wordhash.slices(texts):
        counts, scores, starts = [np.zeros(0, np.int64)], [np.zeros(0)], [np.zeros(0, np.int64)]
        for a, b in wordhash.windows(data, ~cut):
            part = data[a:b]
            s, e = wordhash.word_spans(part, ~cut)
            if not viterbi.parts:  # the line feed behind each row is not the text's
                s, e = _without_row_ends(s + a, e + a, rows)
                s, e = s - a, e - a
            before = np.where(s + a > 0, data[s + a - 1], 0x20) == 0x20
            spaced = before | np.isin(s + a, rows)
            n, x = viterbi.units(part, s, e, spaced)
            counts.append(n)
            scores.append(x)
            starts.append(s + a)
        start = np.concatenate(starts)
        at = np.searchsorted(start, rows)
        count = np.concatenate([[0], np.cumsum(np.concatenate(counts))])
        score = np.concatenate(scores)
        # Spaces that nothing follows, and line feeds, are units of their own.
        space = data == 0x20
        follows = np.append(~cut[data[1:]], False)
        lonely = np.concatenate([[0], np.cumsum(space & ~follows)])
        feeds = np.concatenate([[0], np.cumsum(data == 0x0A)])
        for k in range(high - low):
            x, y = rows[k], rows[k + 1] - 1
            n = int(count[at[k + 1]] - count[at[k]])
            total = float(score[at[k] : at[k + 1]].sum())
            if y > x:
                single = int(lonely[y] - lonely[x]) + (viterbi.parts != "" and data[x] == 0x0A)
                lines = int(feeds[y] - feeds[x]) if viterbi.parts else 0
                n += single * alone[0] + lines * feed[0]
                total += single * alone[1] + lines * feed[1]
            yield low + k, n, total


def _without_row_ends(starts: np.ndarray, ends: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans cut at the row ends that they hold."""
    starts = np.unique(np.concatenate([starts, rows[(rows > starts[:1].sum()) & (rows < ends[-1:].sum())]]))
    stops = np.unique(np.concatenate([ends, rows[1:] - 1]))
    ends = stops[np.searchsorted(stops, starts, "right")]
    full = ends > starts
    return starts[full], ends[full]


def token_counts(documents: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, score) of every row; ``path`` names the model on every executor."""

    def count(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = list(counted(batch.column("text"), path))
        columns = [batch.column("doc_id"), pa.array([x[1] for x in found], pa.int64()), pa.array([x[2] for x in found], pa.float64())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "score"])

    return wordhash.mapped(documents.select("doc_id", "text"), count, COUNTS)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram token counts of all documents; see the module."""
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(MODEL))
