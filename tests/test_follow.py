"""Streams that follow a symbol second by second, and bars that come more than once."""

import random

import pytest
from pyspark.sql import functions as F
from ticks import BASE, messages, tick

from tickbars.functions.codec import bars_of, decode_ticks, encode, with_event_time
from tickbars.operators import history
from tickbars.operators.bars import BAR_COLUMNS, bars
from tickbars.operators.sma import sma_all
from tickbars.sinks import row_files
from tickbars.sources.files import stream_messages
from tickbars.streaming import follow
from tickbars.streaming.jobs import once, average_rows, rocksdb, start, start_filled, start_lines
from tickbars.streaming.replay import Ending, newest_in, run_to_end

NOW = {"availableNow": True}
TEN = "10 seconds"


def bar_table(spark, ticks):
    return bars(with_event_time(decode_ticks(messages(spark, ticks))))


def uneven(spark, symbols=("A", "B", None), seconds=400, count=40):
    random.seed(11)
    ticks = [
        tick(
            at, symbol=symbol, micro=7, price=round(random.random() * 9, 2), serial=str(at), volume=2**60 + at,
            kind=random.choice(("trade", "heartbeat")), yesterday_price=float(at // 100),
        )
        for symbol in symbols
        for at in sorted(random.sample(range(seconds), count))
    ]
    return bar_table(spark, ticks)


class Topic:
    """A folder of bars that is sent to part by part, and a query that is started anew for each part."""

    def __init__(self, spark, folder, schema):
        self.spark, self.folder, self.schema = spark, folder, schema

    def send(self, rows):
        rows.coalesce(1).write.mode("append").parquet(str(self.folder / "in"))

    def run(self, build, close=None):
        rows = self.spark.readStream.schema(self.schema).parquet(str(self.folder / "in"))
        stream = Ending(rows, "start", str(self.folder / "end"))
        if close is not None:
            stream.close(close)
        with rocksdb(self.spark):
            self.query = run_to_end(build(stream.rows), str(self.folder / "out"), str(self.folder / "state"))
        return self

    def out(self):
        return self.spark.read.parquet(str(self.folder / "out"))


def seconds_of(rows, column="start"):
    return sorted(r[0] - BASE for r in rows.select(F.unix_seconds(column)).collect())


def as_set(rows):
    return sorted(map(str, rows.collect()))


def test_gaps_are_filled_while_a_symbol_is_silent(spark, tmp_path):
    """No bar of A comes after second 5; the clock of B fills it."""
    rows = bar_table(spark, [tick(s) for s in (0, 1, 5)] + [tick(s, "B") for s in range(0, 101, 10)])
    sent = encode(rows).withColumn("timestamp", F.current_timestamp())
    sent.coalesce(1).write.parquet(str(tmp_path / "in"))
    query = start_filled(
        stream_messages(spark, str(tmp_path / "in")), row_files(str(tmp_path / "out")), checkpoint=str(tmp_path / "state"), trigger=NOW
    )
    query.awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert seconds_of(out.where("symbol = 'A'")) == list(range(71))
    assert seconds_of(out.where("symbol = 'A' and real_or_filled = 'real'")) == [0, 1, 5]
    assert seconds_of(out.where("symbol = 'B'")) == list(range(71))


@pytest.mark.parametrize("shuffled", (False, True))
def test_filled_and_carried_equal_batch(spark, tmp_path, shuffled):
    """In four parts with a restart before each, whatever the order within what the watermark allows."""
    rows = uneven(spark).cache()
    second = F.unix_seconds("start") - BASE
    topic = Topic(spark, tmp_path, rows.schema)
    close = newest_in(rows, "start")
    build = lambda r: follow.followed(r, "60 seconds", True)
    for low, high, last in ((0, 100, False), (100, 110, False), (110, 300, False), (300, 400, True)):
        part = rows.where((second >= low) & (second < high))
        if shuffled:
            kept, rest = part.where("volume_till_now % 2 = 0"), part.where("volume_till_now % 2 = 1")
            topic.send(kept.unionByName(kept))
            topic.send(rest)
        else:
            topic.send(part)
        topic.run(build, close if last else None)
    newest = rows.groupBy(F.col("symbol").alias("s")).agg(F.max("start").alias("last"))
    up_to_last = topic.out().join(newest, F.col("symbol").eqNullSafe(F.col("s"))).where("start <= last")
    assert as_set(up_to_last.select(*BAR_COLUMNS)) == as_set(history.gap_fill(rows).select(*BAR_COLUMNS))
    real = up_to_last.where("last_data_time is not null").select(*BAR_COLUMNS, "carried_vwap")
    assert as_set(real) == as_set(history.carry_forward(rows).select(*real.columns))


def test_a_filler_carries_the_price_before(spark, tmp_path):
    rows = bar_table(spark, [tick(0, price=7.0), tick(3, kind="heartbeat"), tick(4, price=9.0)])
    topic = Topic(spark, tmp_path, rows.schema)
    topic.send(rows)
    topic.run(lambda r: follow.followed(r, TEN, True), newest_in(rows, "start"))
    got = {s: p for s, p in topic.out().select(F.unix_seconds("start") - BASE, "carried_vwap").collect() if s < 5}
    assert got == {0: 7.0, 1: 7.0, 2: 7.0, 3: 7.0, 4: 9.0}


def test_the_order_of_bars_of_one_second_does_not_matter(spark, tmp_path):
    rows = bar_table(spark, [tick(0, price=7.0)])
    other = bar_table(spark, [tick(0, price=8.0)])
    found = set()
    for k, parts in enumerate(([rows, other, rows], [other, rows, other])):
        topic = Topic(spark, tmp_path / str(k), rows.schema)
        for part in parts[:2]:
            topic.send(part)
        topic.run(lambda r: follow.carried(r, TEN))
        topic.send(parts[2])
        topic.run(lambda r: follow.carried(r, TEN), newest_in(rows, "start"))
        found.add(tuple(as_set(topic.out())))
    assert len(found) == 1 and len(found.pop()) == 1


def test_quiet_symbols_are_forgotten_and_a_close_ends_the_filling(spark, tmp_path):
    rows = bar_table(spark, [tick(0), tick(50)] + [tick(s, "B") for s in (0, 100)])
    topic = Topic(spark, tmp_path, rows.schema)
    topic.send(rows)
    topic.run(lambda r: follow.filled(r, TEN, quiet=20, until=BASE + 60), newest_in(rows, "start"))
    assert seconds_of(topic.out().where("symbol = 'A'")) == [*range(21), *range(50, 61)]
    assert seconds_of(topic.out().where("symbol = 'B'")) == [*range(21), 100]
    # Nothing is left but the end marker.
    assert topic.query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 4


def test_a_price_is_carried_over_a_short_silence_only(spark, tmp_path):
    rows = bar_table(spark, [tick(0, price=7.0), tick(10, kind="heartbeat"), tick(40, kind="heartbeat")])
    topic = Topic(spark, tmp_path, rows.schema)
    topic.send(rows)
    topic.run(lambda r: follow.carried(r, TEN, quiet=20), newest_in(rows, "start"))
    assert [r.carried_vwap for r in topic.out().orderBy("start").collect()] == [7.0, 7.0, 100.0]


def lines_of(rows):
    names = ("symbol", "MA_type", "start", "end", "sma_value", "sum_of_vwap", "count_of_vwap", "window_data_count", "real_data_count", "filled_data_count")
    return as_set(rows.select(*[F.round(n, 9).alias(n) if n in ("sma_value", "sum_of_vwap") else n for n in names]))


@pytest.mark.parametrize("durations", ((5, 10, 15), (3,)))
def test_lines_equal_batch(spark, tmp_path, durations):
    rows = uneven(spark, seconds=150).cache()
    second = F.unix_seconds("start") - BASE
    topic = Topic(spark, tmp_path, rows.schema)
    build = lambda r: follow.lines(r, durations, TEN, round_to=None)
    for low, high, last in ((0, 60, False), (60, 61, False), (61, 150, True)):
        topic.send(rows.where((second >= low) & (second < high)))
        topic.run(build, newest_in(rows, "start") if last else None)
    assert lines_of(topic.out()) == lines_of(sma_all(rows, durations, round_to=None))


def test_bars_of_one_second_are_added_or_counted_once(spark, tmp_path):
    rows = uneven(spark, seconds=60).cache()
    for each_once, given in ((True, rows), (False, rows.unionByName(rows))):
        topic = Topic(spark, tmp_path / str(each_once), rows.schema)
        topic.send(rows.unionByName(rows))
        topic.run(lambda r, o=each_once: follow.lines(r, watermark=TEN, round_to=None, once=o), newest_in(rows, "start"))
        assert lines_of(topic.out()) == lines_of(sma_all(given, round_to=None))


def test_short_windows_leave_first_and_state_is_a_row_per_second(spark, tmp_path):
    rows = bar_table(spark, [tick(s, symbol) for s in range(200) for symbol in "AB"])
    sent = encode(rows).withColumn("timestamp", F.current_timestamp())
    sent.coalesce(1).write.parquet(str(tmp_path / "in"))
    query = start_lines(
        stream_messages(spark, str(tmp_path / "in")), row_files(str(tmp_path / "out")), checkpoint=str(tmp_path / "state"), trigger=NOW
    )
    query.awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    newest = {r[0]: r[1] for r in out.groupBy("MA_type").agg(F.max(F.unix_seconds("start") - BASE)).collect()}
    # The watermark stands at 169: windows whose last second it is have left.
    assert newest == {"5_MA_data": 165, "10_MA_data": 160, "15_MA_data": 155}
    # Of each symbol: 30 open seconds, 14 in windows, what is remembered, and a timer.
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 2 * (30 + 14 + 3)


def test_each_bar_once_across_batches_and_restarts(spark, tmp_path):
    rows = uneven(spark, seconds=90).cache()
    second = F.unix_seconds("start") - BASE
    topic = Topic(spark, tmp_path, rows.schema)
    build = lambda r: average_rows(r, (5,), watermark="30 seconds", round_to=None, each_bar_once=True)
    parts = [rows.where(second < 40), rows.where(second < 60), rows, rows]
    for k, part in enumerate(parts):
        topic.send(part.unionByName(part))
        topic.run(build, newest_in(rows, "start") if k == 3 else None)
    assert lines_of(topic.out()) == lines_of(sma_all(rows, (5,), round_to=None))


def test_once_keeps_other_columns_and_symbols_without_name(spark, tmp_path):
    rows = uneven(spark, seconds=60).cache()
    topic = Topic(spark, tmp_path, rows.schema)
    topic.send(rows.unionByName(rows))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    start(once(stream), row_files(str(tmp_path / "out")), "once", str(tmp_path / "state"), NOW).awaitTermination()
    assert as_set(topic.out()) == as_set(rows)


def test_bars_without_start_fall_out(spark, tmp_path):
    rows = bar_table(spark, [tick(0), tick(1)])
    empty = rows.limit(1).withColumn("start", F.lit(None).cast("timestamp"))
    topic = Topic(spark, tmp_path, rows.schema)
    topic.send(rows.unionByName(empty))
    topic.run(lambda r: follow.carried(r, TEN), newest_in(rows, "start"))
    assert seconds_of(topic.out()) == [0, 1]
    assert bars_of(encode(empty)).where("start is not null").count() == 0
