"""Outputs of a query that hands its micro-batches over with their number.

An output writes the rows of a batch under the batch's number. If the query fails before all outputs
are written, the same batch comes again with the same rows, and writing it again replaces what it
left the first time. So each output holds every batch once, whatever failed, and outputs of one query
agree.

A table of batches is a folder of Parquet files ``batch=<number>/day=<date>``. Nothing in it is ever
changed but by its own batch; what it *says* is computed when it is read: the newest row of each key,
or windows put together from their parts. Give ``days`` when reading, so that only these are read.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickbars.operators.sma import merge_partial_windows
from tickbars.sinks import Sink

Output = Callable[[DataFrame, int], None]
BATCH, DAY = "batch", "day"


def to_all(outputs: Sequence[Output]) -> Output:
    """One output that computes a batch once and writes it to all others."""

    def write(rows: DataFrame, batch: int) -> None:
        kept = rows.persist() if len(outputs) > 1 else rows
        try:
            for output in outputs:
                output(kept, batch)
        finally:
            if len(outputs) > 1:
                kept.unpersist()

    return write


def to_messages(sink: Sink) -> Output:
    """Messages with the batch's number in them, by which a consumer of a topic knows what it got
    twice; a folder of messages gets a folder per batch and so holds each once."""

    def write(rows: DataFrame, batch: int) -> None:
        made = sink.prepare(rows.withColumn(BATCH, F.lit(batch).cast("long")))
        options = dict(sink.options)
        if "path" in options:
            options["path"] = f"{options['path']}/{BATCH}={batch}"
            made.write.format(sink.format).options(**options).mode("overwrite").save()
        else:
            made.write.format(sink.format).options(**options).save()

    return write


@dataclass(frozen=True)
class BatchTable:
    """A table of batches, cut by the day of ``time``."""

    path: str
    time: str = "start"

    def __call__(self, rows: DataFrame, batch: int) -> None:
        """Write a batch, or write it again."""
        days = rows.withColumn(DAY, F.to_date(self.time))
        days.write.partitionBy(DAY).mode("overwrite").parquet(f"{self.path}/{BATCH}={batch}")

    def rows(self, spark: SparkSession, schema: T.StructType, days: Sequence[str] | None = None) -> DataFrame:
        """All rows of all batches, with their ``batch``; ``schema`` is that of the rows written."""
        full = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType()), T.StructField(DAY, T.DateType())])
        found = spark.read.schema(full).option("basePath", self.path).parquet(self.path)
        if days is not None:
            found = found.where(F.col(DAY).isin([F.lit(d).cast("date") for d in days]))
        return found.drop(DAY)


@dataclass(frozen=True)
class Newest(BatchTable):
    """A served table: of each key the row of the greatest ``version``; of rows of one version that of
    the latest batch, and in one batch that of the greatest content."""

    keys: tuple[str, ...] = ("symbol",)
    version: str = "start"

    def read(self, spark: SparkSession, schema: T.StructType, days: Sequence[str] | None = None) -> DataFrame:
        rows = self.rows(spark, schema, days)
        values = [f.name for f in schema if f.name not in self.keys]
        order = [self.version, BATCH, *[v for v in values if v != self.version]]
        newest = rows.groupBy(*self.keys).agg(F.max(F.struct(*order)).alias("row"))
        return newest.select(*[f.name if f.name in self.keys else F.col(f"row.{f.name}") for f in schema])


@dataclass(frozen=True)
class Windows(BatchTable):
    """Averages that may be corrected: a batch brings whole windows or, for late bars, parts of them;
    a window is read as the sum of its parts in all batches. A batch written again changes nothing."""

    def read(
        self, spark: SparkSession, schema: T.StructType, days: Sequence[str] | None = None, round_to: int | None = 2
    ) -> DataFrame:
        return merge_partial_windows(self.rows(spark, schema, days), round_to)
