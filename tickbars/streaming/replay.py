"""Run a stream over stored data to its end and give back what it wrote."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import nullcontext

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickbars.session import fresh_folder
from tickbars.sinks import row_files
from tickbars.streaming.jobs import rocksdb, start

# How far behind the newest event an end marker lies: beyond any watermark and window.
BEYOND = "1 day"


def run_to_end(rows: DataFrame, out: str, checkpoint: str, name: str = "replay") -> StreamingQuery:
    """Process everything the source holds now, continuing from ``checkpoint``."""
    query = start(rows, row_files(out), name, checkpoint, {"availableNow": True})
    query.awaitTermination()
    return query


def newest_event(query: StreamingQuery) -> str | None:
    """The newest event time that the query has seen in this run, as text."""
    times = [p["eventTime"].get("max") for p in map(dict, query.recentProgress) if p.get("eventTime")]
    return max((t for t in times if t), default=None)


class Ending:
    """A stream with an end: after ``close``, its next run writes the windows still open.

    The end is one row without a symbol, a day behind the newest event. It moves the
    watermark over all windows but its own, which therefore is never written. It is a
    table of its own beside the stream, so the source needs no change, and it serves
    the close of a session as well as the end of a replay.
    """

    def __init__(self, rows: DataFrame, time: str, folder: str):
        self.time, self.folder, self.schema = time, folder, rows.schema
        self.spark = rows.sparkSession
        self.spark.createDataFrame([], rows.schema).write.mode("ignore").parquet(folder)
        self.rows = rows.unionByName(self.spark.readStream.schema(rows.schema).parquet(folder))

    def close(self, newest: str) -> None:
        end = F.lit(newest).cast("timestamp") + F.expr(f"INTERVAL {BEYOND}")
        marker = self.spark.range(1).select(
            *[
                (end if f.name == self.time else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in self.schema
            ]
        )
        marker.write.mode("append").parquet(self.folder)


def newest_in(rows: DataFrame, time: str) -> str | None:
    """The newest event time of a table, as text."""
    return rows.agg(F.max(time).cast("string")).first()[0]


def replay(
    source: DataFrame,
    time: str,
    build: Callable[[DataFrame], DataFrame],
    name: str,
    newest: str | None = None,
    keyed: bool = False,
) -> DataFrame:
    """The rows that ``build`` makes of the stream ``source`` (with event time ``time``) from
    its first stored row to its last, the last windows included.

    With ``newest``, the newest event time of ``source``, one run does it: the end marker comes with
    the rows, and is no danger to them in the first micro-batch, whose watermark is not set yet. So
    the source must give all its rows in that one; without ``newest`` they may come in many, and a
    second run brings the marker. ``keyed`` says that ``build`` keeps keyed state (``follow``). The
    result goes through a written table in the shared folder, not through the driver.
    """
    spark = source.sparkSession
    folder = fresh_folder(spark, name)
    stream = Ending(source, time, f"{folder}/end")
    if newest is not None:
        stream.close(newest)
    rows = build(stream.rows)
    out, state = f"{folder}/out", f"{folder}/state"
    with rocksdb(spark) if keyed else nullcontext():
        query = run_to_end(rows, out, state, name)
        if newest is None and (newest := newest_event(query)) is not None:
            stream.close(newest)
            run_to_end(rows, out, state, name)
    return spark.read.schema(rows.schema).parquet(out)
