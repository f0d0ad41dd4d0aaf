"""Every operator as a query over the driver's tables.

Times leave as epoch numbers and averages with six decimals, so that the results
compare equal with another engine in any session time zone.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickbars.functions.codec import (
    BAR_FIELDS,
    bars_of,
    decode_bars,
    decode_ticks,
    encode,
    rejected_ticks,
    ticks_of,
    with_event_time,
)
from tickbars.functions.columns import iso_to_millis, millis_to_iso, ntz_to_micros
from tickbars.operators import history
from tickbars.operators.bars import bars, in_time_order
from tickbars.operators.sma import (
    COUNTS,
    fill_bar_defaults,
    merge_partial_windows,
    sma,
    sma_all,
)
from tickbars.plans.lines import sma_lines
from tickbars.session import fresh_folder, stored
from tickbars.sinks import message_files
from tickbars.sinks.tables import BatchTable, Newest, Windows, to_messages
from tickbars.sources.events import (
    PARTITIONS,
    SYMBOLS,
    messages_from_events,
    read_events,
    stream_events,
    ticks_from_events,
)
from tickbars.sources.files import read_messages, stream_messages
from tickbars.streaming import follow
from tickbars.streaming.jobs import (
    WATERMARK,
    average_rows,
    bar_rows,
    chained_rows,
    start_latest,
    start_parts,
    start_per_batch,
    start_to_all,
)
from tickbars.streaming.replay import Ending, newest_event, newest_in, replay, run_to_end

Query = Callable[[SparkSession, str], DataFrame]

PLACES = 6
AT_ONCE = {"availableNow": True}
ALL_USERS = 10**12


def _six(name: str) -> Column:
    return F.round(name, PLACES).alias(name)


def _seconds(name: str) -> Column:
    return F.unix_seconds(name).alias(f"{name}_s")


def _micros(name: str) -> Column:
    return F.unix_micros(name).alias(f"{name}_us")


def _ticks(spark: SparkSession, folder: str, **mapping: int) -> DataFrame:
    return ticks_from_events(read_events(spark, folder), **mapping)


def _bars(spark: SparkSession, folder: str, **options: bool) -> DataFrame:
    return bars(_ticks(spark, folder), **options)


def _bar_view(rows: DataFrame, *columns: str | Column) -> DataFrame:
    return rows.select("symbol", _seconds("start"), *columns)


def _line_view(rows: DataFrame) -> DataFrame:
    return rows.select(
        "symbol", "type", "MA_type", _seconds("start"), _seconds("end"),
        _six("sma_value"), _six("sum_of_vwap"), *COUNTS,
    )


def _lines(durations: tuple[int, ...]) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        lines = sma_lines(
            _bars(spark, folder), durations, round_to=None, one_bar_per_second=True
        )
        return _line_view(lines)

    return query


# --- messages and scalar expressions ---------------------------------------------------


def query_decode_ticks(spark: SparkSession, folder: str) -> DataFrame:
    ticks = decode_ticks(messages_from_events(read_events(spark, folder)))
    return ticks.select(
        "symbol", "type", "price", "size", "volume", "isContinuous", "time", "serial",
        "yesterday_price",
    )


def query_event_time(spark: SparkSession, folder: str) -> DataFrame:
    ticks = decode_ticks(messages_from_events(read_events(spark, folder)))
    return with_event_time(ticks).select("serial", _micros("time"))


def query_event_time_iso(spark: SparkSession, folder: str) -> DataFrame:
    millis = F.floor(ntz_to_micros(F.col("ts")) / 1000).cast("bigint")
    events = read_events(spark, folder)
    written = events.select("event_id", millis_to_iso(millis, "UTC").alias("iso"))
    with_offset = F.concat("iso", F.lit("+00:00"))
    return written.select("event_id", "iso", iso_to_millis(with_offset).alias("ms"))


def query_encode_kv(spark: SparkSession, folder: str) -> DataFrame:
    messages = encode(_bars(spark, folder))
    fields = F.from_json(
        "value",
        "symbol string, type string, start string, real_or_filled string,"
        " real_data_count bigint, filled_data_count bigint, size_per_sec bigint,"
        " vwap_price_per_sec double",
    )
    return messages.select("key", fields.alias("f")).select(
        "key", "f.symbol", "f.type",
        F.unix_seconds(F.to_timestamp("f.start")).alias("start_s"),
        "f.real_or_filled", "f.real_data_count", "f.filled_data_count", "f.size_per_sec",
        F.round("f.vwap_price_per_sec", PLACES).alias("vwap_price_per_sec"),
    )


def query_decode_bars(spark: SparkSession, folder: str) -> DataFrame:
    return _bar_view(
        decode_bars(encode(_bars(spark, folder))),
        "type", _seconds("end"), "real_data_count", "filled_data_count", "real_or_filled",
        _six("vwap_price_per_sec"), "size_per_sec", "volume_till_now", "yesterday_price",
        "price_change_percentage",
    )


# --- bars ------------------------------------------------------------------------------


def _whole_bar(rows: DataFrame) -> DataFrame:
    return _bar_view(
        rows,
        "type", _seconds("end"), _micros("last_data_time"), "size_per_sec",
        "volume_till_now", "yesterday_price", "real_data_count", "filled_data_count",
        "real_or_filled", _six("vwap_price_per_sec"),
    )


def query_bars_1s(spark: SparkSession, folder: str) -> DataFrame:
    return _whole_bar(_bars(spark, folder))


def query_bars_from_messages(spark: SparkSession, folder: str) -> DataFrame:
    """JSON ticks to bars."""
    return _whole_bar(bars(ticks_of(messages_from_events(read_events(spark, folder)))))


def query_bar_counts(spark: SparkSession, folder: str) -> DataFrame:
    return _bar_view(_bars(spark, folder), "real_data_count", "filled_data_count")


def query_vwap_1s(spark: SparkSession, folder: str) -> DataFrame:
    return _bar_view(_bars(spark, folder), _six("vwap_price_per_sec"), "size_per_sec")


def query_volume_till_now(spark: SparkSession, folder: str) -> DataFrame:
    return _bar_view(_bars(spark, folder), "volume_till_now", "yesterday_price")


def query_volume_of_last_trade(spark: SparkSession, folder: str) -> DataFrame:
    return _bar_view(_bars(spark, folder, ignore_heartbeats=True), "volume_till_now")


def query_price_change(spark: SparkSession, folder: str) -> DataFrame:
    return _bar_view(_bars(spark, folder), "price_change_percentage")


def query_real_or_filled(spark: SparkSession, folder: str) -> DataFrame:
    return _bar_view(_bars(spark, folder), "real_or_filled")


def query_last_flag(spark: SparkSession, folder: str) -> DataFrame:
    flagged = _bars(spark, folder, with_flag=True)
    return _bar_view(flagged, F.col("isContinuous").alias("is_continuous"))


def query_bars_sorted(spark: SparkSession, folder: str) -> DataFrame:
    return _bar_view(in_time_order(_bars(spark, folder)), "size_per_sec")


# --- averages --------------------------------------------------------------------------


def query_sma_all_windowed(spark: SparkSession, folder: str) -> DataFrame:
    return _line_view(sma_all(_bars(spark, folder), round_to=None))


def query_sma_5_windowed(spark: SparkSession, folder: str) -> DataFrame:
    return _line_view(sma(_bars(spark, folder), 5, round_to=None))


def query_sma_all_by_user(spark: SparkSession, folder: str) -> DataFrame:
    """Every user a symbol of their own: many symbols, with gaps between their bars."""
    per_user = bars(_ticks(spark, folder, symbols=ALL_USERS))
    return _line_view(sma_lines(per_user, round_to=None, one_bar_per_second=True))


def query_sma_5_rounded(spark: SparkSession, folder: str) -> DataFrame:
    lines = sma_lines(_bars(spark, folder), (5,), round_to=2, one_bar_per_second=True)
    return _bar_view(lines, "sma_value")


def _messages_without_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Bar messages in which a second without trades has neither price nor label."""
    traded = F.col("real_data_count") > 0
    return encode(
        _bars(spark, folder).withColumns(
            {n: F.when(traded, F.col(n)) for n in ("vwap_price_per_sec", "real_or_filled")}
        )
    )


def query_sma_5_counts(spark: SparkSession, folder: str) -> DataFrame:
    rows = bars_of(_messages_without_labels(spark, folder))
    return _line_view(sma_lines(rows, (5,), round_to=None))


def query_sma_5_defaults(spark: SparkSession, folder: str) -> DataFrame:
    rows = bars_of(_messages_without_labels(spark, folder), lenient=True)
    return _line_view(sma_lines(fill_bar_defaults(rows), (5,), round_to=None))


def query_sma_merge(spark: SparkSession, folder: str) -> DataFrame:
    """Windows cut every ten seconds, as micro-batches would cut them, put together."""
    rows = stored(_bars(spark, folder), "bars")
    even = F.floor(F.unix_seconds("start") / 10) % 2 == 0
    partials = sma(rows.where(even), 5).unionByName(sma(rows.where(~even), 5))
    return _line_view(merge_partial_windows(partials, round_to=None))


# --- along the history of a symbol -----------------------------------------------------


def query_window_rank(spark: SparkSession, folder: str) -> DataFrame:
    lines = sma_lines(_bars(spark, folder), (5,), one_bar_per_second=True)
    ranked = history.window_rank(stored(lines, "lines"))
    return _bar_view(ranked, F.col("rank").cast("bigint").alias("rank"))


def query_prev_vwap(spark: SparkSession, folder: str) -> DataFrame:
    rows = stored(_bars(spark, folder), "bars")
    both = history.previous(rows, "vwap_price_per_sec", (1, 2), ("prev_1", "prev_2"))
    return _bar_view(both, _six("prev_1"), _six("prev_2"))


def query_carry_forward(spark: SparkSession, folder: str) -> DataFrame:
    carried = history.carry_forward(stored(_bars(spark, folder), "bars"))
    return _bar_view(carried, _six("carried_vwap"))


def query_gap_fill(spark: SparkSession, folder: str) -> DataFrame:
    per_user = bars(_ticks(spark, folder, symbols=ALL_USERS))
    filled = history.gap_fill(stored(per_user, "bars"))
    return _bar_view(
        filled, _seconds("end"), "real_data_count", "filled_data_count", "real_or_filled",
        _six("vwap_price_per_sec"), "size_per_sec", "volume_till_now", "yesterday_price",
    )


def query_latest_bar(spark: SparkSession, folder: str) -> DataFrame:
    newest = history.latest_bar(_bars(spark, folder))
    return _bar_view(
        newest, _micros("last_data_time"), "real_or_filled", "real_data_count",
        "filled_data_count", _six("vwap_price_per_sec"), "size_per_sec", "volume_till_now",
        "yesterday_price",
    )


def query_latest_vwap(spark: SparkSession, folder: str) -> DataFrame:
    return _bar_view(history.latest_price(_bars(spark, folder)), _six("vwap_price_per_sec"))


def query_window_bounds(spark: SparkSession, folder: str) -> DataFrame:
    bounds = history.window_bounds(_bars(spark, folder), 5)
    return _bar_view(bounds, _seconds("first_data_time"), _seconds("last_data_time"))


def query_partition_symbol(spark: SparkSession, folder: str) -> DataFrame:
    ticks = decode_ticks(messages_from_events(read_events(spark, folder)), keep=("partition",))
    symbols = {number: f"S{number}" for number in range(SYMBOLS)}
    named = history.with_partition_symbol(ticks, symbols, "none")
    return named.groupBy("partition", "partition_symbol").agg(F.count("*").alias("ticks"))


def query_source_partitions(spark: SparkSession, folder: str) -> DataFrame:
    return history.source_partitions(messages_from_events(read_events(spark, folder)))


# --- streams ---------------------------------------------------------------------------


def _newest_tick(spark: SparkSession, folder: str) -> str:
    return newest_in(_ticks(spark, folder), "time")


def query_stream_bars(spark: SparkSession, folder: str) -> DataFrame:
    ticks = ticks_from_events(stream_events(spark, folder))
    written = replay(ticks, "time", bar_rows, "stream_bars", _newest_tick(spark, folder))
    return _bar_view(
        written, "size_per_sec", "volume_till_now", "real_data_count", "filled_data_count",
        _six("vwap_price_per_sec"),
    )


def _topic(spark: SparkSession, rows: DataFrame) -> str:
    topic = fresh_folder(spark, "messages")
    encode(rows).write.parquet(topic)
    return topic


def _replayed(
    spark: SparkSession,
    topic: str,
    name: str,
    build: Callable[[DataFrame], DataFrame],
    fields: tuple[str, ...] = BAR_FIELDS,
    keyed: bool = False,
) -> DataFrame:
    """What ``build`` makes of the bar messages in a folder."""
    newest = newest_in(bars_of(read_messages(spark, topic)), "start")
    rows = bars_of(stream_messages(spark, topic), fields=fields)
    return replay(rows, "start", build, name, newest, keyed)


def query_stream_sma(spark: SparkSession, folder: str) -> DataFrame:
    """Bar messages to five-second averages."""
    topic = _topic(spark, _bars(spark, folder))
    return _line_view(_replayed(spark, topic, "stream_sma", lambda r: average_rows(r, (5,), round_to=None)))


def query_stream_chained(spark: SparkSession, folder: str) -> DataFrame:
    """Ticks to averages of all durations in one query."""
    ticks = ticks_from_events(stream_events(spark, folder))
    newest = _newest_tick(spark, folder)
    return _line_view(
        replay(ticks, "time", lambda r: chained_rows(r, round_to=None), "stream_chained", newest)
    )


def query_stream_sma_each(spark: SparkSession, folder: str) -> DataFrame:
    """A query per duration, each with a source of its own."""
    topic = _topic(spark, _bars(spark, folder))
    lines = [
        _replayed(spark, topic, f"stream_sma_{d}", lambda r, d=d: average_rows(r, (d,), round_to=None))
        for d in (5, 10, 15)
    ]
    return _line_view(lines[0].unionByName(lines[1]).unionByName(lines[2]))


def query_stream_lines(spark: SparkSession, folder: str) -> DataFrame:
    """All durations from one source and one state of a row per second."""
    topic = _topic(spark, _bars(spark, folder))
    build = partial(follow.lines, watermark=WATERMARK, round_to=None)
    return _line_view(_replayed(spark, topic, "stream_lines", build, keyed=True))


def query_stream_sma_redelivered(spark: SparkSession, folder: str) -> DataFrame:
    """Every bar message twice or more: in one micro-batch, in two, and after a restart. The first
    half of the time is sent twice; after the restart everything is sent, the second half twice."""
    rows = stored(_bars(spark, folder), "bars")
    first, last = rows.agg(F.min("start"), F.max("start")).first()
    half = rows.where(F.col("start") < first + (last - first) / 2)
    run, topic = fresh_folder(spark, "redelivered"), fresh_folder(spark, "messages")
    for sent, is_last in ((half.unionByName(half), False), (rows.unionByName(rows), True)):
        encode(sent).write.mode("append").parquet(topic)
        stream = Ending(bars_of(stream_messages(spark, topic)), "start", f"{run}/end")
        if is_last:
            stream.close(newest_in(rows, "start"))
        lines = average_rows(stream.rows, (5,), round_to=None, each_bar_once=True)
        run_to_end(lines, f"{run}/out", f"{run}/state", "redelivered")
    return _line_view(spark.read.schema(lines.schema).parquet(f"{run}/out"))


def query_stream_sma_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Windows of each micro-batch alone, put together from the parts when they are read. The
    second batch is late by all of the time of the first."""
    rows = stored(_bars(spark, folder), "bars")
    topic, run = fresh_folder(spark, "messages"), fresh_folder(spark, "parts")
    table = Windows(f"{run}/windows")
    odd = F.unix_seconds("start") % 7 < 3
    for sent in (rows.where(odd), rows.where(~odd)):
        encode(sent).write.mode("append").parquet(topic)
        messages = stream_messages(spark, topic)
        start_parts(messages, [table], checkpoint=f"{run}/state", trigger=AT_ONCE).awaitTermination()
    schema = sma_lines(rows, round_to=None).schema
    return _line_view(table.read(spark, schema, round_to=None))


def query_stream_carry_forward(spark: SparkSession, folder: str) -> DataFrame:
    topic = _topic(spark, _bars(spark, folder))
    build = partial(follow.carried, watermark=WATERMARK)
    return _bar_view(_replayed(spark, topic, "stream_carry", build, (), keyed=True), _six("carried_vwap"))


def query_stream_gap_fill(spark: SparkSession, folder: str) -> DataFrame:
    """Every second from the first bar of a symbol to the newest bar of any, the close, also behind
    the last bar of the symbol."""
    rows = stored(_bars(spark, folder), "bars")
    close = rows.agg(F.max(F.unix_seconds("start"))).first()[0]
    build = partial(follow.filled, watermark=WATERMARK, until=close)
    filled = _replayed(spark, _topic(spark, rows), "stream_fill", build, (), keyed=True)
    return _bar_view(
        filled, _seconds("end"), "real_data_count", "filled_data_count", "real_or_filled",
        _six("vwap_price_per_sec"), "size_per_sec", "volume_till_now", "yesterday_price",
    )


def query_stream_latest_bar(spark: SparkSession, folder: str) -> DataFrame:
    """The newest bar of each symbol as a served table, every bar sent twice: the newer half first,
    then all of them."""
    rows = stored(_bars(spark, folder), "bars")
    first, last = rows.agg(F.min("start"), F.max("start")).first()
    newer = rows.where(F.col("start") >= first + (last - first) / 2)
    topic, run = fresh_folder(spark, "messages"), fresh_folder(spark, "latest")
    table = Newest(f"{run}/bars")
    for sent in (newer, rows):
        encode(sent).write.mode("append").parquet(topic)
        messages = stream_messages(spark, topic)
        start_latest(messages, [table], checkpoint=f"{run}/state", trigger=AT_ONCE).awaitTermination()
    newest = table.read(spark, history.latest_bar(decode_bars(encode(rows))).schema)
    return _bar_view(
        newest, F.unix_millis("last_data_time").alias("last_data_time_ms"), "real_or_filled", "real_data_count",
        "filled_data_count", _six("vwap_price_per_sec"), "size_per_sec", "volume_till_now",
        "yesterday_price",
    )


def query_stream_to_both(spark: SparkSession, folder: str) -> DataFrame:
    """One computation of the bars, to messages and to a table."""
    run = fresh_folder(spark, "both")
    ticks = ticks_from_events(stream_events(spark, folder))
    stream = Ending(ticks, "time", f"{run}/end")
    stream.close(_newest_tick(spark, folder))
    rows, table = bar_rows(stream.rows), BatchTable(f"{run}/table")
    outputs = [table, to_messages(message_files(f"{run}/messages"))]
    start_to_all(rows, outputs, "both", f"{run}/state", AT_ONCE).awaitTermination()
    sent = decode_bars(read_messages(spark, f"{run}/messages"))
    columns = ("size_per_sec", "real_data_count", "filled_data_count", _six("vwap_price_per_sec"))
    return _bar_view(table.rows(spark, rows.schema), F.lit("table").alias("output"), *columns).unionByName(
        _bar_view(sent, F.lit("messages").alias("output"), *columns)
    )


def query_stream_partition_symbol(spark: SparkSession, folder: str) -> DataFrame:
    """Source partitions named by a table that every micro-batch reads anew."""
    run = fresh_folder(spark, "partitions")
    events = read_events(spark, folder).select(F.col("user_id").cast("string").alias("key"), F.lit("{}").alias("value"))
    events.withColumn("timestamp", F.current_timestamp()).write.parquet(f"{run}/in")
    symbols = [(number, f"S{number}") for number in range(SYMBOLS)]
    spark.createDataFrame(symbols, "partition int, symbol string").write.parquet(f"{run}/symbols")

    def named(rows: DataFrame) -> DataFrame:
        numbered = rows.withColumn("partition", (F.col("key").cast("bigint") % PARTITIONS).cast("int"))
        table = rows.sparkSession.read.parquet(f"{run}/symbols")
        found = history.with_partition_symbol(numbered, table, "none")
        return found.select("partition", "partition_symbol", "timestamp")

    table = BatchTable(f"{run}/out", "timestamp")
    messages = stream_messages(spark, f"{run}/in")
    start_per_batch(messages, named, [table], "partitions", checkpoint=f"{run}/state", trigger=AT_ONCE).awaitTermination()
    schema = spark.createDataFrame([], "partition int, partition_symbol string, timestamp timestamp").schema
    written = table.rows(spark, schema)
    return written.groupBy("partition", "partition_symbol").agg(F.count("*").alias("ticks"))


def query_rejected_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Tick messages of which six of fifty are bad, each in its own way, as dead letters."""
    good = messages_from_events(read_events(spark, folder))
    number = F.get_json_object("value", "$.serial").cast("bigint")
    sent = F.timestamp_micros(F.get_json_object("value", "$.time").cast("bigint"))
    kind, value = number % 50, F.col("value")
    later = F.lit('"time":"2019686400000000"')
    spoiled = (
        F.when(kind == 0, F.substr(value, F.lit(1), (F.length(value) / 2).cast("int")))
        .when(kind == 1, F.regexp_replace(value, r'"size":\d+', '"size":"many"'))
        .when(kind == 2, F.regexp_replace(value, r'"time":"\d+",', ""))
        .when(kind == 3, F.regexp_replace(value, r'"time":"\d+"', '"time":"never"'))
        .when(kind == 4, F.regexp_replace(value, r'"symbol":"\w+",', ""))
        .when(kind == 5, F.regexp_replace(value, F.lit(r'"time":"\d+"'), later))
        .otherwise(value)
    )
    run = fresh_folder(spark, "rejected")
    messages = good.select(number.cast("string").alias("key"), spoiled.alias("value"), sent.alias("timestamp"))
    messages.write.parquet(f"{run}/in")
    rows = rejected_ticks(stream_messages(spark, f"{run}/in"), ahead="1 hour")
    run_to_end(rows, f"{run}/out", f"{run}/state", "rejected")
    written = spark.read.schema(rows.schema).parquet(f"{run}/out")
    return written.select(F.col("key").cast("bigint").alias("event_id"), "reason")


def query_bars_with_bad_messages(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of messages between which bad ones stand: no JSON, wrong types, sizes beyond
    bigint in a second of their own, absurd times, and one far ahead of its message."""
    good = messages_from_events(read_events(spark, folder)).select("key", "value")
    sent = F.timestamp_seconds(F.lit(1893456000))
    bad = [
        "not json", "[1]", '{"symbol":"S0","time":"never"}', '{"symbol":"S0","type":"trade","size":1}',
        '{"symbol":"S0","type":"trade","price":1,"size":"x","time":"9999999999999999999"}',
        '{"symbol":"S0","type":"trade","price":1,"size":1,"time":"253402300799999999"}',
        *['{"symbol":"BAD","type":"trade","price":1,"size":9223372036854775807,"time":"1704067200000000"}'] * 2,
    ]
    topic = fresh_folder(spark, "tick_messages")
    rows = good.unionByName(
        spark.createDataFrame([(None, b) for b in bad], "key string, value string")
    ).withColumn("timestamp", sent)
    rows.write.parquet(topic)
    ticks = ticks_of(stream_messages(spark, topic), ahead="1 hour")
    written = replay(ticks, "time", bar_rows, "bad_messages", _newest_tick(spark, folder))
    zero = F.lit(0).cast("bigint")
    return _bar_view(
        written, F.col("size_per_sec").isNull().alias("size_overflow"),
        *[F.coalesce(n, zero).alias(n) for n in ("size_per_sec", "volume_till_now")],
        "real_data_count", "filled_data_count", _six("vwap_price_per_sec"),
    )


def query_stream_late(spark: SparkSession, folder: str) -> DataFrame:
    """Page views arrive after everything else: the query is stopped, started again from
    its checkpoint, and drops the views that are behind the watermark by then."""
    events = read_events(spark, folder)
    run = fresh_folder(spark, "stream_late")
    views = F.col("event_type") == "view"
    for part in (events.where(~views), events.where(views)):
        part.write.mode("append").parquet(f"{run}/events.parquet")
        stream = Ending(ticks_from_events(stream_events(spark, run)), "time", f"{run}/end")
        rows = bar_rows(stream.rows)
        query = run_to_end(rows, f"{run}/out", f"{run}/state", "stream_late")
    stream.close(newest_event(query))
    run_to_end(rows, f"{run}/out", f"{run}/state", "stream_late")
    written = spark.read.schema(rows.schema).parquet(f"{run}/out")
    return _bar_view(written, "size_per_sec", "real_data_count", "filled_data_count")


QUERIES: dict[str, Query] = {
    "sma_5": _lines((5,)),
    "sma_10": _lines((10,)),
    "sma_15": _lines((15,)),
    "sma_all": _lines((5, 10, 15)),
    **{
        name.removeprefix("query_"): query
        for name, query in list(globals().items())
        if name.startswith("query_")
    },
}
