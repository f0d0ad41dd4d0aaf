"""Where results go.

A sink is a format with options. Message sinks get (key, value) rows with the
processing time added; row sinks get the columns as they are. A failing write
fails the query: on restart it continues from its checkpoint, so nothing is lost.
Delivery to a topic is at least once; (symbol, MA_type, start) identifies a row.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from tickbars.functions.codec import encode, stamp


@dataclass(frozen=True)
class Sink:
    format: str
    options: dict[str, str] = field(default_factory=dict)
    messages: bool = False
    keyed: bool = True

    def prepare(self, rows: DataFrame) -> DataFrame:
        return encode(stamp(rows), self.keyed) if self.messages else rows


def kafka_sink(servers: str, topic: str, keyed: bool = True, **extra: str) -> Sink:
    """A topic; with ``keyed`` all rows of a symbol go to one partition, in order."""
    options = {"kafka.bootstrap.servers": servers, "topic": topic, **extra}
    return Sink("kafka", options, messages=True, keyed=keyed)


def message_files(path: str, file_format: str = "parquet", keyed: bool = True) -> Sink:
    """Files that hold what a topic would get."""
    return Sink(file_format, {"path": path}, messages=True, keyed=keyed)


def row_files(path: str, file_format: str = "parquet") -> Sink:
    """Files of result rows; each row is written exactly once."""
    return Sink(file_format, {"path": path})


def console() -> Sink:
    """A few rows of every micro-batch on the driver's console, for watching a stream."""
    return Sink("console", {"truncate": "false"})


def write(rows: DataFrame, sink: Sink) -> None:
    """Write a batch."""
    sink.prepare(rows).write.format(sink.format).options(**sink.options).mode("append").save()
