"""Toxicity by weak supervision.

1. Features of a text are its words and their beginnings of 4, 5 and 6 bytes (a stem). Patterns are that
   a feature is there, that it is there ``AGAIN`` times, and that it is there once in ``DENSE`` bytes: a
   stem that long clean texts have by chance is dense in toxic ones. On labelled rows, a bounded
   sample of ``TRAIN_ROWS`` by hash, patterns are counted for both labels; the ``KEPT`` that are most
   clearly more frequent under the toxic one are the vocabulary of the model.
2. Voters are lexicons and patterns: of the kept patterns, greedily the one that marks most toxic
   rows with fewer than ``MARKS`` voters so far, up to ``VOTERS``, so that every kind of vocabulary
   (a language, say) gets its own; a voter votes if a text has its pattern. One more voter votes
   against toxicity where none of them votes. The given labels choose the voters but do not vote.
3. A generative label model has a hidden label and, for each voter, the rates of its votes under
   either label, and so its accuracy. Expectation maximization estimates them from the votes alone;
   correlations of voters under the model's own labels lower the weight of a vote by the like votes
   cast on the same row, so voters that repeat each other do not count twice, and one that stands
   alone counts in full.
4. A linear classifier over all kept patterns learns the posterior labels. It scores every text.

Labels, language, source and id are no features. Held-out rows are never read for 1 to 4.

Rows: null and empty texts get the score of no patterns; a null doc_id is not held out; repeated
rows are scored each; without labels of both kinds every score is 0; empty tables give no rows;
other columns are ignored (``clean_rows`` keeps them).
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

TRAIN_ROWS = 16_000
STEMS = (4, 5, 6)
# How often, and in how many bytes once, a feature has to be there for its stronger patterns.
AGAIN, DENSE = 2, 1000
KEPT = 1024
LEAST_ROWS = 5
VOTERS, MARKS = 64, 2
ROUNDS = 30
CORRELATED = 0.1
STEPS = 1000
TOXIC = 0.5

SCORES = "doc_id long, score double"


def features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Hashes of words and of their beginnings."""
    found = [hashes]
    for n in STEMS:
        long = ends - starts > n
        first = starts[long]
        window = np.zeros(len(first), np.uint64)
        for k in range(n):
            window *= np.uint64(0x100000001B3)
            window += wordhash._VALUE[data[first + k]]
        found.append(wordhash.mix(window + np.uint64(n)))
    return np.concatenate(found)


def text_features(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, int]]:
    """Row, features as often as they occur, and bytes of each text."""
    for row, data, starts, ends, hashes in wordhash.text_words(texts, wordhash.ALPHANUMERIC):
        yield row, features(data, starts, ends, hashes), len(data)


def patterns(found: np.ndarray, size: int) -> np.ndarray:
    """The patterns of a text of ``size`` bytes that has the features ``found``: that a feature is
    there at all, that it is there ``AGAIN`` times, and that it is there once in ``DENSE`` bytes."""
    names, n = np.unique(found & ~np.uint64(3), return_counts=True)
    return np.concatenate([names, names[n >= AGAIN] | np.uint64(1), names[n * DENSE >= size] | np.uint64(2)])


class Lookup:
    """Which of some known patterns a text has."""

    def __init__(self, known: np.ndarray):
        self.order = np.argsort(known)
        self.known = known[self.order]
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[(known >> np.uint64(48)).astype(np.int64)] = True

    def of(self, found: np.ndarray, size: int) -> np.ndarray:
        found = found[self.maybe[(found >> np.uint64(48)).astype(np.int64)]]
        if not len(found) or not len(self.known):
            return np.zeros(0, np.int64)
        found = patterns(found, size)
        at = np.minimum(np.searchsorted(self.known, found), len(self.known) - 1)
        return np.unique(self.order[at[self.known[at] == found]])


def label_model(votes: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, dict]:
    """Posterior of label 1 for each row of ``votes``, and the estimated parameters.

    A vote is 1 or -1 for either label, or 0 if the voter abstains, which says nothing. A voter's
    accuracy is the share of its votes that meet the hidden label. ``start`` are first guesses of the posterior.
    """
    posterior = start.astype(float)
    n = len(votes)
    for_, against, cast = (votes > 0).astype(float), (votes < 0).astype(float), (votes != 0).astype(float)
    for _ in range(ROUNDS):
        prior = np.clip(posterior.mean(), 1e-4, 1 - 1e-4)
        # How often each voter votes for either label under either label.
        ones, zeros = posterior.sum() + 1, (1 - posterior).sum() + 1
        yes = ((posterior @ for_ + 0.1) / ones, ((1 - posterior) @ for_ + 0.1) / zeros)
        no = ((posterior @ against + 0.1) / ones, ((1 - posterior) @ against + 0.1) / zeros)
        hit, miss = (posterior @ cast) / ones, ((1 - posterior) @ cast) / zeros
        # Correlations given the label: of the votes that the label does not explain.
        rest = cast - np.outer(posterior, hit) - np.outer(1 - posterior, miss)
        scale = np.sqrt((rest**2).mean(axis=0)) + 1e-9
        correlation = (rest.T @ rest) / n / np.outer(scale, scale)
        np.fill_diagonal(correlation, 0)
        # A vote weighs less the more voters like this one have voted on the same row.
        weight = 1 / (1 + cast @ np.where(correlation > CORRELATED, correlation, 0))
        logit = np.log(prior / (1 - prior)) + (weight * (for_ * np.log(yes[0] / yes[1]) + against * np.log(no[0] / no[1]))).sum(axis=1)
        new = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        moved, posterior = np.abs(new - posterior).max(), new
        if moved < 1e-4:
            break
    right = posterior @ (votes > 0) + (1 - posterior) @ (votes < 0)
    accuracy = (right + 0.5) / (cast.sum(axis=0) + 1)
    return posterior, {"prior": prior, "accuracy": accuracy, "correlation": correlation}


def linear(rows: list[np.ndarray], goal: np.ndarray, width: int) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression on sets of features, by full gradient steps."""
    sizes = np.fromiter(map(len, rows), np.int64, len(rows))
    column = np.concatenate(rows) if len(rows) else np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(rows)), sizes)
    weight, bias = np.zeros(width), float(np.log((goal.mean() + 1e-3) / (1 - goal.mean() + 1e-3)))
    square, bias_square = np.zeros(width), 0.0
    for _ in range(STEPS):
        z = bias + np.bincount(row, weight[column], len(rows))
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - goal) / len(rows)
        slope = np.bincount(column, error[row], width) + 1e-6 * weight
        square += slope**2
        weight -= 0.5 * slope / (np.sqrt(square) + 1e-9)
        bias_square += error.sum() ** 2
        bias -= 0.2 * error.sum() / (np.sqrt(bias_square) + 1e-9)
    return weight, bias


@dataclass
class Model:
    known: np.ndarray
    weight: np.ndarray
    bias: float
    labels: dict


def _kept(counts: list[tuple[int, int, int]], ones: int, zeros: int) -> np.ndarray:
    """Of (feature, rows of label 1, rows of label 0), those of clearly different rates."""
    if not counts:
        return np.zeros(0, np.uint64)
    table_ = np.array(counts, np.int64)
    name, one, zero = table_[:, 0].view(np.uint64), table_[:, 1], table_[:, 2]
    rate, base = (one + 0.5) / (ones + 1), (zero + 0.5) / (zeros + 1)
    mean = (one + zero + 1) / (ones + zeros + 2)
    gap = (rate - base) / np.sqrt(mean * (1 - mean) * (1 / ones + 1 / zeros))
    clear = (gap > 5) & (rate > 3 * base)
    order = np.argsort(-gap[clear], kind="stable")[:KEPT]
    return name[clear][order]


def fit(documents: DataFrame, labels: DataFrame) -> Model | None:
    """Learn from the labelled documents that are not held out."""
    known = labels.where(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    total = known.count()
    share = min(1.0, TRAIN_ROWS / max(total, 1))
    sample = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    sizes = {r[0]: r[1] for r in sample.groupBy("toxic").count().collect()}
    ones, zeros = sizes.get(1, 0), sizes.get(0, 0)
    if not ones or not zeros:
        return None
    rows = documents.select("doc_id", "text").join(F.broadcast(sample), "doc_id")  # at most about TRAIN_ROWS pairs of numbers

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Each task sums its own rows first.
        for batch in batches:
            label = batch.column("toxic").to_numpy(zero_copy_only=False)
            sums = {}
            for value in (0, 1):
                sets = [patterns(x, size) for _, x, size in text_features(batch.column("text").filter(pa.array(label == value)))]
                sums[value] = np.unique(np.concatenate(sets) if sets else np.zeros(0, np.uint64), return_counts=True)
            for value, (name, n) in sums.items():
                zero = np.zeros(len(n), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(name.view(np.int64)), pa.array(n if value else zero), pa.array(zero if value else n)], ["feature", "one", "zero"])

    counts = rows.select("text", "toxic").mapInArrow(count, "feature long, one long, zero long").groupBy("feature").agg(F.sum("one").alias("one"), F.sum("zero").alias("zero"))
    # Only features that can pass the test; the best KEPT of a bounded sample.
    gain = F.col("one") / ones - F.col("zero") / zeros
    counts = counts.where((F.col("one") >= LEAST_ROWS) & (gain > 0)).orderBy(F.desc(gain / F.sqrt((F.col("one") + F.col("zero")))), "feature").limit(4 * KEPT)
    names = _kept([tuple(x) for x in counts.collect()], ones, zeros)
    if not len(names):
        return Model(names, np.zeros(0), float(np.log(ones / zeros)), {})

    def look(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(names)
        found = [lookup.of(x, size).astype(np.int32).tobytes() for _, x, size in text_features(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([batch.column("toxic").cast(pa.int32()), pa.array(found, pa.binary())], ["toxic", "found"])

    seen = wordhash.mapped(rows.select("text", "toxic"), look, "toxic int, found binary").collect()
    sets = [np.frombuffer(bytes(x["found"]), np.int32).astype(np.int64) for x in seen]
    given = np.array([x["toxic"] for x in seen])
    votes = np.zeros((len(sets), len(names)), bool)
    for k, x in enumerate(sets):
        votes[k, x] = True
    voters, marks = [], np.zeros(len(sets), np.int64)
    clean = 3 * votes[given == 0].sum(axis=0)
    while len(voters) < VOTERS:
        # Each toxic row is to have MARKS voters, so that votes can be told from agreement.
        gains = votes[(given == 1) & (marks < MARKS)].sum(axis=0) - clean
        gains[voters] = 0
        best = int(np.argmax(gains))
        if gains[best] < LEAST_ROWS:
            break
        voters.append(best)
        marks += votes[:, best]
    cast = votes[:, voters].astype(np.int8)
    silent = -(cast.sum(axis=1) == 0).astype(np.int8)
    posterior, labels_ = label_model(np.column_stack([cast, silent]), np.where(silent < 0, 0.02, 0.9))
    weight, bias = linear(sets, posterior, len(names))
    return Model(names, weight, bias, labels_)


def _scores(texts: pa.Array, model: Model) -> np.ndarray:
    lookup = Lookup(model.known)
    z = np.array([model.bias + model.weight[lookup.of(x, size)].sum() for _, x, size in text_features(texts)])
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def scored(documents: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, score) of every row of ``documents``."""
    if model is None:
        return documents.select("doc_id", F.lit(0.0).alias("score"))

    def score(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(_scores(batch.column("text"), model))], ["doc_id", "score"])

    return wordhash.mapped(documents.select("doc_id", "text"), score, SCORES)


def clean_rows(documents: DataFrame, model: Model | None) -> DataFrame:
    """The rows of ``documents`` that score below ``TOXIC``, whole; each is judged by its own text."""
    if model is None:
        return documents

    def keep(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield batch.filter(pa.array(_scores(batch.column("text"), model) < TOXIC))

    return wordhash.mapped(documents, keep, documents.schema)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a model learned from labels that are not held out."""
    documents = table(spark, sf_dir, "documents")
    found = scored(documents, fit(documents, table(spark, sf_dir, "labels")))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= TOXIC).cast("int").alias("predicted"))
