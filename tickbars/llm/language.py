"""Language identification with error-correcting output codes.

Every language gets a codeword of bits, far from the others. For each bit a linear classifier over
hashed byte n-grams predicts whether the language of a text has it. A prediction is decoded to the
language with the smallest sum of logistic losses over its bits, each weighted by how well its
classifier did in training; when the second is nearly as near, the text is flagged as ambiguous.

A bounded sample is learned from, ``PER_LANGUAGE`` rows of each language by hash, so that rare
languages are seen, and ``MOST_ROWS`` in all, at least 8 of each of the ``MOST_ROWS // 8`` most frequent
languages; n-grams of whole texts are counted, in training and in prediction. A profile is that of
the text alone, whatever stands beside it.

Rows: null texts and texts without a letter are ``und`` with score 0; rows without a language are not
learned from; a null doc_id is not held out; repeated rows are predicted each; without anything to
learn from all texts are ``und``; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickbars.llm import wordhash
from tickbars.llm.tables import held_out, table

PER_LANGUAGE = 800
MOST_ROWS = 8_000
BINS = 2048
STEPS = 300
AMBIGUOUS = 0.6
NONE = "und"

FOUND = "doc_id long, lang_pred string, score double, ambiguous boolean"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_LETTER = wordhash.byte_class((0x41, 0x5A), (0x61, 0x7A))
# Anything that is no letter of ASCII and no byte of a longer character counts as a space.
_LOWER[~(_LETTER | wordhash.byte_class((0x80, 0xFF)))] = 0x20


def profiles(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, bool]]:
    """Row, n-gram profile (unit length) and whether there is a letter, for each text."""
    for low, high, data, rows in wordhash.slices(texts):
        plain = _LOWER[data].astype(np.uint32)
        # Every row begins behind two spaces, whatever row is before it.
        before, twice = np.roll(plain, 1), np.roll(plain, 2)
        before[rows[:-1]] = twice[rows[:-1]] = 0x20
        twice[np.minimum(rows[:-1] + 1, len(data) - 1)] = 0x20
        grams = plain * 961 + before * 31013 + twice * 1000003
        grams = ((grams * np.uint32(2654435761)) >> np.uint32(21)).astype(np.int64)
        letters = np.concatenate([[0], np.cumsum(_LETTER[data])])
        for k in range(high - low):
            a, b = rows[k], rows[k + 1]
            count = np.sqrt(np.bincount(grams[a:b], minlength=BINS)[:BINS])
            some = letters[b] > letters[a]
            if not some:
                part = data[a : b - 1].tobytes()
                some = not part.isascii() and any(c.isalpha() for c in part.decode("utf-8", "replace"))
            yield low + k, (count / np.sqrt((count**2).sum())).astype(np.float32), bool(some)


def codewords(n: int) -> np.ndarray:
    """A row of bits for each of ``n`` languages. Up to seven of them get all ways to part them in
    two; more get random bits, of several draws the one with the largest smallest distance."""
    if n <= 7:
        ways = np.arange(1, max(2, 1 << (n - 1)))
        return ((ways[None, :] >> np.arange(n)[:, None]) & 1).astype(bool)
    random, best = np.random.default_rng(7), (-1, None)
    width = int(10 * np.ceil(np.log2(n)))
    for _ in range(50):
        code = random.random((n, width)) < 0.5
        apart = (code[:, None, :] != code[None, :, :]).sum(axis=2) + width * np.eye(n, dtype=int)
        best = max(best, (int(apart.min()), code), key=lambda x: x[0])
    return best[1]


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray
    weight: np.ndarray
    bias: np.ndarray
    trust: np.ndarray

    def predict(self, profile: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best language (its number) and the share of each language, by row."""
        margin = profile @ self.weight + self.bias
        loss = np.logaddexp(0, -margin) @ (self.code * self.trust).T.astype(np.float32)
        loss += np.logaddexp(0, margin) @ (~self.code * self.trust).T.astype(np.float32)
        share = np.exp(-(loss - loss.min(axis=1, keepdims=True)))
        share /= share.sum(axis=1, keepdims=True)
        return share.argmax(axis=1), share


def fit(documents: DataFrame) -> Model | None:
    """Learn from the documents that have a language and are not held out."""
    known = documents.where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", "text", "lang")
    sizes = {r[0]: r[1] for r in known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_ROWS // 8).collect()}
    if not sizes:
        return None
    each = min(PER_LANGUAGE, MOST_ROWS // len(sizes))
    share = F.lit(0)
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 24))
    cells = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, int(min(1.0, each / n) * (1 << 24)))])
    share = F.coalesce(cells[F.col("lang")], F.lit(0))

    def look(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        langs = batch.column("lang").to_pylist()
        rows = [(langs[row], x.astype(np.float16).tobytes()) for row, x, some in profiles(batch.column("text")) if some]
        if rows:
            lang, profile = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(lang), pa.array(profile, pa.binary())], ["lang", "profile"])

    seen = wordhash.mapped(known.where(place < share).select("text", "lang"), look, "lang string, profile binary").collect()
    if not seen:
        return None
    languages = sorted({x["lang"] for x in seen})
    number = {lang: k for k, lang in enumerate(languages)}
    goal = np.array([number[x["lang"]] for x in seen])
    profile = np.stack([np.frombuffer(bytes(x["profile"]), np.float16) for x in seen]).astype(np.float32)
    code = codewords(len(languages))
    bits = code[goal].astype(np.float32)
    # Each language weighs the same, however many rows it has.
    weigh = (1 / np.bincount(goal)[goal] / len(languages)).astype(np.float32)[:, None]
    weight, bias = np.zeros((BINS, code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
    square, bias_square = np.full_like(weight, 1e-12), np.full_like(bias, 1e-12)
    for _ in range(STEPS):
        margin = profile @ weight + bias
        error = weigh * (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - bits)
        slope = profile.T @ error + 1e-6 * weight
        square += slope**2
        weight -= 0.5 * slope / np.sqrt(square)
        bias_slope = error.sum(axis=0)
        bias_square += bias_slope**2
        bias -= 0.1 * bias_slope / np.sqrt(bias_square)
    right = (weigh * ((profile @ weight + bias > 0) == (bits > 0.5))).sum(axis=0)
    trust = np.log(np.clip(right, 0.5, 0.999) / (1 - np.clip(right, 0.5, 0.999))) + 0.01
    return Model(languages, code, weight, bias, (trust / trust.mean()).astype(np.float32))


def identified(documents: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, lang_pred, score, ambiguous) of every row of ``documents``."""
    if model is None:
        return documents.select("doc_id", F.lit(NONE).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("ambiguous"))
    shared = documents.sparkSession.sparkContext.broadcast(model)  # BINS rows of one column a bit

    def look(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        known = shared.value
        names, scores, doubts, keys = [], [], [], batch.column("doc_id")
        profile, some = [], []

        def decode() -> None:
            if not profile:
                return
            best, share = known.predict(np.stack(profile))
            for k, (b, letter) in enumerate(zip(best, some, strict=True)):
                names.append(known.languages[b] if letter else NONE)
                scores.append(float(share[k, b]) if letter else 0.0)
                doubts.append(not letter or float(share[k, b]) < AMBIGUOUS)
            profile.clear()
            some.clear()

        for _, x, letter in profiles(batch.column("text")):
            profile.append(x)
            some.append(letter)
            if len(profile) == 512:
                decode()
        decode()
        yield pa.RecordBatch.from_arrays([keys, pa.array(names), pa.array(scores), pa.array(doubts)], ["doc_id", "lang_pred", "score", "ambiguous"])

    return wordhash.mapped(documents.select("doc_id", "text"), look, FOUND)


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents by a model learned from those that are not held out."""
    documents = table(spark, sf_dir, "documents")
    found = identified(documents, fit(documents))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", F.col("score").cast("double"), "ambiguous")
