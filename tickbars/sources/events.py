"""The `events` table seen as ticks.

Fixed values of the mapping: the base instant 2024-01-01T00:00:00Z, time squeezed
by 3600 (an hour of events becomes a second of ticks), five symbols, seven source
partitions, and a yesterday price of 40 plus the symbol's number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickbars.functions.columns import ntz_to_micros
from tickbars.schemas import HEARTBEAT, TICK

BASE_MICROS = 1704067200000000
SQUEEZE = 3600
SYMBOLS = 5
PARTITIONS = 7
YESTERDAY = 40


def read_events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/events.parquet")


def stream_events(spark: SparkSession, folder: str, **options: str) -> DataFrame:
    """The same table as a stream of files; one file or a folder of files."""
    path = f"{folder}/events.parquet"
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.format("parquet").schema(schema)
    # A glob, because a stream takes a single file only through one.
    return reader.options(**options).load(f"{path}*")


def _fields(symbols: int, squeeze: int) -> dict[str, Column]:
    since = ntz_to_micros(F.col("ts")) - BASE_MICROS
    micros = BASE_MICROS + F.floor(since / squeeze).cast("bigint")
    number = F.col("user_id") % symbols
    kind = F.when(F.col("event_type") == "error", HEARTBEAT).otherwise("trade")
    return {
        "symbol": F.concat(F.lit("S"), number.cast("string")),
        "type": kind,
        "price": F.col("value"),
        "size": F.get_json_object("props", "$.k").cast("bigint"),
        "volume": F.col("event_id"),
        "isContinuous": F.col("event_type") != "signup",
        "time": micros,
        "serial": F.col("event_id").cast("string"),
        "yesterday_price": (YESTERDAY + number).cast("double"),
    }


def ticks_from_events(
    events: DataFrame, symbols: int = SYMBOLS, squeeze: int = SQUEEZE
) -> DataFrame:
    """Ticks with event time as a timestamp, as `bars` takes them."""
    fields = _fields(symbols, squeeze)
    fields["time"] = F.timestamp_micros(fields["time"])
    return events.select(*[value.alias(name) for name, value in fields.items()])


def messages_from_events(events: DataFrame) -> DataFrame:
    """Ticks as JSON messages, as a topic of seven partitions would deliver them."""
    fields = _fields(SYMBOLS, SQUEEZE)
    fields["time"] = fields["time"].cast("string")
    names = [f.name for f in TICK if f.name in fields]
    value = F.to_json(F.struct(*[fields[name].alias(name) for name in names]))
    partition = (F.col("user_id") % PARTITIONS).cast("int")
    return events.select(
        fields["symbol"].alias("key"), value.alias("value"), partition.alias("partition")
    )
