"""The streaming jobs: ticks to bars, bars to averages, and both in one query.

All of them group on event time behind a watermark, so a window is complete
when it is written, however the ticks were cut into micro-batches, and state is
bounded by the watermark plus the window length.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tickbars.functions.codec import BAR_FIELDS, bars_of, decode_bars, rejected_ticks, ticks_of
from tickbars.functions.columns import in_calendar
from tickbars.operators.bars import bars
from tickbars.operators.history import latest_bar
from tickbars.operators.sma import fill_bar_defaults, sma, sma_all
from tickbars.plans.lines import sma_lines
from tickbars.schemas import DURATIONS
from tickbars.session import STREAMING
from tickbars.sinks import Sink
from tickbars.sinks.tables import Output, to_all
from tickbars.streaming import follow

WATERMARK = "30 seconds"
#: The fields of a bar that are its key.
BAR_KEY = ("symbol", "start")


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Queries started here keep their state in RocksDB, which keyed state with timers needs. A query
    takes the settings of its session when it starts, so others are not touched."""
    before = {key: spark.conf.get(key, None) for key in STREAMING}
    for key, value in STREAMING.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def start(
    rows: DataFrame,
    sink: Sink,
    name: str,
    checkpoint: str,
    trigger: dict[str, object] | None = None,
    output_mode: str = "append",
) -> StreamingQuery:
    """Start one query. ``trigger`` holds the arguments of ``DataStreamWriter.trigger``;
    without it the next micro-batch starts as soon as the last one ends.

    ``checkpoint`` is a folder of this query alone that outlives the application.
    """
    writer = sink.prepare(rows).writeStream.format(sink.format).options(**sink.options)
    return _started(writer, name, checkpoint, trigger, output_mode)


def _started(
    writer: DataStreamWriter, name: str, checkpoint: str, trigger: dict[str, object] | None, output_mode: str
) -> StreamingQuery:
    writer = writer.outputMode(output_mode).queryName(name).option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def start_to_all(
    rows: DataFrame,
    outputs: Sequence[Output],
    name: str,
    checkpoint: str,
    trigger: dict[str, object] | None = None,
    output_mode: str = "append",
) -> StreamingQuery:
    """One computation to several outputs: each micro-batch is computed once and handed to each of
    them with its number. A batch whose outputs were not all written when the query failed comes
    again with the same number and the same rows, which replaces what it wrote before (see
    ``sinks.tables``)."""
    return _started(rows.writeStream.foreachBatch(to_all(outputs)), name, checkpoint, trigger, output_mode)


def once(rows: DataFrame, watermark: str = WATERMARK, time_column: str = "start") -> DataFrame:
    """Each bar of a stream once, however often it is delivered: topics are at least once, and an
    average must not count a second twice.

    The state is a key per bar, kept until the watermark has passed it; what is delivered again after
    that is late and dropped. The first of different bars of a second counts."""
    return rows.withWatermark(time_column, watermark).dropDuplicatesWithinWatermark(list(BAR_KEY))


def bar_rows(ticks: DataFrame, watermark: str = WATERMARK, **options: bool) -> DataFrame:
    return bars(ticks, watermark=watermark, **options)


def average_rows(
    rows: DataFrame,
    durations: Sequence[int] = DURATIONS,
    time_column: str = "start",
    watermark: str | None = WATERMARK,
    round_to: int | None = 2,
    each_bar_once: bool = False,
) -> DataFrame:
    """Averages of a stream of bars. Pass one duration to get its windows as early
    as possible; several share one state store and wait for the longest."""
    if each_bar_once:
        rows, watermark = once(rows, watermark, time_column), None
    shared = {"time_column": time_column, "watermark": watermark, "round_to": round_to}
    if len(durations) == 1:
        return sma(rows, durations[0], **shared)
    return sma_all(rows, durations, **shared)


def chained_rows(
    ticks: DataFrame,
    durations: Sequence[int] = DURATIONS,
    watermark: str = WATERMARK,
    round_to: int | None = 2,
) -> DataFrame:
    """Ticks to averages in one query, with no topic between the two stages."""
    return average_rows(
        bars(ticks, watermark=watermark, chain=True),
        durations,
        time_column="bar_time",
        watermark=None,
        round_to=round_to,
    )


def start_bars(
    messages: DataFrame,
    sink: Sink,
    name: str = "bars",
    watermark: str = WATERMARK,
    ahead: str | None = None,
    **run: object,
) -> StreamingQuery:
    """Tick messages to bars; ``ahead`` as in ``ticks_of``. With ``output_mode="update"`` a bar is written as soon
    as it changes, and again on every later change."""
    return start(bar_rows(ticks_of(messages, ahead), watermark), sink, name, **run)


def start_averages(
    messages: DataFrame,
    sink: Sink,
    name: str = "averages",
    durations: Sequence[int] = DURATIONS,
    watermark: str = WATERMARK,
    round_to: int | None = 2,
    lenient: bool = False,
    each_bar_once: bool = False,
    **run: object,
) -> StreamingQuery:
    """Bar messages to averages. ``lenient`` takes numbers sent as text and puts
    defaults where fields are missing, so an unlabelled bar counts as filled.
    ``each_bar_once`` drops what a topic delivers again."""
    rows = bars_of(messages, lenient)
    if lenient:
        rows = fill_bar_defaults(rows)
    averages = average_rows(rows, durations, watermark=watermark, round_to=round_to, each_bar_once=each_bar_once)
    return start(averages, sink, name, **run)


def start_lines(
    messages: DataFrame,
    sink: Sink,
    name: str = "lines",
    durations: Sequence[int] = DURATIONS,
    watermark: str = WATERMARK,
    round_to: int | None = 2,
    lenient: bool = False,
    each_bar_once: bool = True,
    **run: object,
) -> StreamingQuery:
    """Bar messages to averages of all durations, each window as soon as it is complete, from one
    state of a row per symbol and second."""
    rows = bars_of(messages, lenient)
    if lenient:
        rows = fill_bar_defaults(rows)
    with rocksdb(messages.sparkSession):
        return start(follow.lines(rows, durations, watermark, round_to, each_bar_once), sink, name, **run)


def start_filled(
    messages: DataFrame,
    sink: Sink,
    name: str = "filled",
    watermark: str = WATERMARK,
    quiet: int = follow.DAY,
    until: int | None = None,
    with_carried: bool = False,
    **run: object,
) -> StreamingQuery:
    """Bar messages to bars without gaps: a silent second is a bar as a heartbeat would have made it,
    as soon as the watermark passes it, also while the symbol goes on being silent.

    ``quiet``         seconds of silence after which a symbol is forgotten
    ``until``         the second (since 1970) of the close, behind which nothing is filled
    ``with_carried``  also give ``carried_vwap``, the price that a silent second takes over
    """
    rows = bars_of(messages, fields=())
    make = follow.followed(rows, watermark, True, quiet, until) if with_carried else follow.filled(rows, watermark, quiet=quiet, until=until)
    with rocksdb(messages.sparkSession):
        return start(make, sink, name, **run)


def start_carried(
    messages: DataFrame,
    sink: Sink,
    name: str = "carried",
    watermark: str = WATERMARK,
    quiet: int = follow.DAY,
    **run: object,
) -> StreamingQuery:
    """Bar messages to bars with ``carried_vwap``, in the order of time; a price is carried over a
    silence of at most ``quiet`` seconds."""
    rows = follow.carried(bars_of(messages, fields=()), watermark, quiet=quiet)
    with rocksdb(messages.sparkSession):
        return start(rows, sink, name, **run)


def start_latest(
    messages: DataFrame, outputs: Sequence[Output], name: str = "latest", **run: object
) -> StreamingQuery:
    """Bar messages to the newest bar of each symbol, written whenever it changes. State is one row
    per symbol; bars delivered again or out of order change nothing. ``sinks.tables.Newest`` with
    the key ``symbol`` and the version ``start`` serves it as a table."""
    rows = latest_bar(bars_of(messages, fields=()).where("start is not null"))
    return start_to_all(rows, outputs, name, output_mode="update", **run)


def start_rejected(
    messages: DataFrame, sink: Sink, name: str = "rejected", ahead: str | None = None, **run: object
) -> StreamingQuery:
    """The tick messages that ``start_bars`` cannot use, as they came, with the reason."""
    return start(rejected_ticks(messages, ahead), sink, name, **run)


def start_per_batch(
    rows: DataFrame,
    function: Callable[[DataFrame], DataFrame],
    outputs: Sequence[Output],
    name: str,
    **run: object,
) -> StreamingQuery:
    """``function`` applied to each micro-batch as a table. So what it reads beside the batch, such as
    the map of partitions to symbols, is read anew for each, and may change while the query runs."""
    return start_to_all(rows, [_applied(function, output) for output in outputs], name, **run)


def start_parts(
    messages: DataFrame,
    outputs: Sequence[Output],
    name: str = "parts",
    durations: Sequence[int] = DURATIONS,
    lenient: bool = False,
    **run: object,
) -> StreamingQuery:
    """Bar messages to the windows of each micro-batch alone, without state or watermark: values at
    once, and however late a bar comes, it is not lost. A window that lies in several batches is
    written in parts; ``sinks.tables.Windows`` puts them together when it is read. A batch that comes
    again changes nothing, but a bar that its topic delivers again in another batch counts again."""

    def parts(messages: DataFrame) -> DataFrame:
        rows = decode_bars(messages, lenient, fields=BAR_FIELDS)
        rows = rows.withColumn("start", in_calendar(F.col("start"))).where("start is not null")
        return sma_lines(fill_bar_defaults(rows) if lenient else rows, durations, round_to=None)

    return start_per_batch(messages, parts, outputs, name, **run)


def _applied(function: Callable[[DataFrame], DataFrame], output: Output) -> Output:
    return lambda rows, batch: output(function(rows), batch)


def start_chained(
    messages: DataFrame,
    sink: Sink,
    name: str = "chained",
    durations: Sequence[int] = DURATIONS,
    watermark: str = WATERMARK,
    round_to: int | None = 2,
    ahead: str | None = None,
    **run: object,
) -> StreamingQuery:
    rows = chained_rows(ticks_of(messages, ahead), durations, watermark, round_to)
    return start(rows, sink, name, **run)


def start_each(
    messages: Callable[[], DataFrame],
    sink: Callable[[int], Sink],
    checkpoint: str,
    durations: Sequence[int] = DURATIONS,
    name: str = "averages",
    **run: object,
) -> list[StreamingQuery]:
    """One query per duration, each with a source of its own from ``messages()``, so that a
    short window does not wait for a longer one. ``sink`` takes the duration."""
    return [
        start_averages(
            messages(), sink(d), f"{name}_{d}", (d,), checkpoint=f"{checkpoint}/{name}_{d}", **run
        )
        for d in durations
    ]
