"""JSON messages to columns and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickbars.functions.columns import in_calendar, micros_to_time, to_long
from tickbars.schemas import BAR, TICK

TICK_FIELDS = (
    "symbol", "type", "price", "size", "volume", "isContinuous", "time", "serial",
    "yesterday_price",
)
BAR_FIELDS = ("symbol", "start", "real_or_filled", "vwap_price_per_sec", "size_per_sec")


def decode(messages: DataFrame, schema: T.StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """Flatten the JSON ``value`` of each message into the columns of ``schema``.

    Text that is not JSON gives a row of nulls, and a field of the wrong type
    gives a null field: one bad message never stops a stream. ``keep`` names
    message columns (partition, offset, timestamp ...) to carry along.
    """
    data = F.from_json(F.col("value").cast("string"), schema)
    return messages.select(*keep, data.alias("data")).select(*keep, "data.*")


def decode_ticks(
    messages: DataFrame, keep: tuple[str, ...] = (), fields: tuple[str, ...] = ()
) -> DataFrame:
    """Ticks from messages; ``fields`` (all by default) are the ones worth parsing."""
    schema = T.StructType([f for f in TICK if not fields or f.name in fields])
    return decode(messages, schema, keep)


def decode_bars(
    messages: DataFrame,
    lenient: bool = False,
    keep: tuple[str, ...] = (),
    fields: tuple[str, ...] = (),
) -> DataFrame:
    """Bars from messages. ``lenient`` also takes numbers that were sent as text."""
    wanted = T.StructType([f for f in BAR if not fields or f.name in fields])
    if not lenient:
        return decode(messages, wanted, keep)
    numbers = {
        f.name: f.dataType for f in wanted if isinstance(f.dataType, (T.DoubleType, T.LongType))
    }
    as_text = T.StructType(
        [
            T.StructField(f.name, T.StringType() if f.name in numbers else f.dataType)
            for f in wanted
        ]
    )

    def number(name: str) -> Column:
        text = F.col(name)
        whole = isinstance(numbers[name], T.LongType)
        return (to_long(text) if whole else text.try_cast("double")).alias(name)

    decoded = decode(messages, as_text, keep)
    return decoded.select(
        *keep, *[number(f.name) if f.name in numbers else F.col(f.name) for f in wanted]
    )


def with_event_time(ticks: DataFrame) -> DataFrame:
    """Turn the text ``time`` of decoded ticks into a timestamp."""
    return ticks.withColumn("time", micros_to_time(F.col("time")))


def observed(rows: DataFrame, time: str, name: str) -> DataFrame:
    """Count the rows that no window can take, as metrics of the running query.

    Observing also keeps the optimizer from moving a null check below the parsing,
    where it would parse each message again.
    """
    return rows.observe(
        name,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(time).isNull()).alias("without_event_time"),
        F.count_if(F.col("symbol").isNull()).alias("without_symbol"),
    )


def _ahead(time: str, limit: str) -> Column:
    """Whether an event lies further than ``limit`` ahead of its message's own timestamp."""
    return F.coalesce(F.col(time) > F.col("timestamp") + F.expr(f"INTERVAL {limit}"), F.lit(False))


def ticks_of(
    messages: DataFrame, ahead: str | None = None, name: str = "tick_quality"
) -> DataFrame:
    """The fields of tick messages that ``bars`` uses, each message parsed once.

    One event time far in the future moves the watermark there and makes all that
    follows late. With ``ahead`` ("1 hour"), a tick further ahead of the timestamp
    of its message loses its event time and is counted with those without one;
    ``ahead_of_time`` gives these messages for an output of their own. ``name`` is
    that of the metrics, which must differ where a query reads two topics.
    """
    keep = ("timestamp",) if ahead else ()
    ticks = with_event_time(decode_ticks(messages, keep, TICK_FIELDS))
    if ahead:
        ticks = ticks.withColumn("time", F.when(~_ahead("time", ahead), F.col("time"))).drop("timestamp")
    return observed(ticks, "time", name)


def ahead_of_time(messages: DataFrame, ahead: str, name: str = "rejected_ticks") -> DataFrame:
    """The tick messages (value, timestamp) that ``ticks_of`` refuses for lying too far ahead."""
    time = F.get_json_object(F.col("value").cast("string"), "$.time")
    rows = messages.withColumn("_time", micros_to_time(time)).where(_ahead("_time", ahead))
    return rows.select("value", "timestamp").observe(name, F.count(F.lit(1)).alias("rows"))


def bars_of(
    messages: DataFrame,
    lenient: bool = False,
    name: str = "bar_quality",
    fields: tuple[str, ...] = BAR_FIELDS,
) -> DataFrame:
    """The fields of bar messages that the averages use (or others; none for all), each message
    parsed once.

    A start outside the years 0001 to 9999 is no time and is counted as missing.
    """
    rows = decode_bars(messages, lenient, fields=fields)
    return observed(rows.withColumn("start", in_calendar(F.col("start"))), "start", name)


def rejected_ticks(messages: DataFrame, ahead: str | None = None, name: str = "dead_letters") -> DataFrame:
    """The tick messages that make no bar or not a whole one, as they came, with the ``reason``:

    ``not json``             the text is no JSON object
    ``wrong type: a, b``     fields that hold something, but not what they should
    ``no symbol``, ``no time``
    ``no such time``         a time that is no number, or outside the years 0001 to 9999
    ``ahead of time``        further than ``ahead`` ahead of the message's own timestamp

    The first that applies counts. All columns of ``messages`` are kept, so what came from a topic
    can be found there again by partition and offset. A message is parsed twice here, once as text;
    run it as a query of its own, or on the batch of a ``foreachBatch``.
    """
    used = T.StructType([f for f in TICK if f.name in TICK_FIELDS])
    as_text = T.StructType([*[T.StructField(f.name, T.StringType()) for f in used], T.StructField("_bad", T.StringType())])
    text = F.col("value").cast("string")
    rows = messages.withColumns(
        {
            "_text": F.from_json(text, as_text, {"columnNameOfCorruptRecord": "_bad"}),
            "_typed": F.from_json(text, used),
        }
    )
    time = micros_to_time(F.col("_text.time"))
    wrong = F.concat_ws(
        ", ",
        *[
            F.when(F.col(f"_text.{f.name}").isNotNull() & F.col(f"_typed.{f.name}").isNull(), F.lit(f.name))
            for f in used
            if f.name != "time"
        ],
    )
    too_far = F.lit(False)
    if ahead:
        rows, too_far = rows.withColumn("_time", time), _ahead("_time", ahead)
    reason = (
        F.when(text.isNull() | F.col("_text._bad").isNotNull() | ~F.ltrim(text).startswith("{"), "not json")
        .when(wrong != "", F.concat(F.lit("wrong type: "), wrong))
        .when(F.col("_text.symbol").isNull(), "no symbol")
        .when(F.col("_text.time").isNull(), "no time")
        .when(time.isNull(), "no such time")
        .when(too_far, "ahead of time")
    )
    found = rows.select(*messages.columns, reason.alias("reason")).where("reason is not null")
    return found.observe(name, F.count(F.lit(1)).alias("rows"))


def encode(rows: DataFrame, keyed: bool = True) -> DataFrame:
    """Messages with ``symbol`` as key (optional) and the row as JSON value.

    Null fields are left out of the JSON; timestamps carry milliseconds and the
    offset of the session zone.
    """
    value = F.to_json(F.struct("*")).alias("value")
    if not keyed:
        return rows.select(value)
    return rows.select(F.col("symbol").cast("string").alias("key"), value)


def stamp(rows: DataFrame) -> DataFrame:
    """Add the processing time; used at the sink only, as it differs per run."""
    return rows.withColumn("current_time", F.current_timestamp())
