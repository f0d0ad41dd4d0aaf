"""Several outputs of one query, tables that are written batch by batch, and dead letters."""

import json

import pytest
from pyspark.sql import functions as F
from ticks import BASE, messages, tick, write_messages

from tickbars.functions.codec import decode_bars, decode_ticks, encode, rejected_ticks, ticks_of, with_event_time
from tickbars.operators.bars import bars
from tickbars.operators.history import latest_bar, with_partition_symbol
from tickbars.operators.sma import sma_all
from tickbars.sinks import message_files
from tickbars.sinks.tables import BatchTable, Newest, Windows, to_all, to_messages
from tickbars.sources.files import read_messages, stream_messages
from tickbars.streaming.jobs import bar_rows, start_latest, start_parts, start_per_batch, start_to_all

NOW = {"availableNow": True}


def bar_table(spark, ticks):
    return bars(with_event_time(decode_ticks(messages(spark, ticks))))


def send(rows, folder):
    encode(rows).withColumn("timestamp", F.current_timestamp()).coalesce(1).write.mode("append").parquet(str(folder))


def as_set(rows):
    return sorted(map(str, rows.collect()))


def test_outputs_agree_after_a_failure_between_them(spark, tmp_path):
    """The first output is written, the second fails; the batch comes again after the restart."""
    write_messages(spark, [tick(s, price=float(s)) for s in range(10)], tmp_path / "in")
    write_messages(spark, [tick(3600, symbol="Z")], tmp_path / "in")
    table, sent, failures = BatchTable(str(tmp_path / "table")), to_messages(message_files(str(tmp_path / "sent"))), []

    def failing(rows, batch):
        if rows.count() and not failures:
            failures.append(batch)
            raise RuntimeError("output is down")
        sent(rows, batch)

    rows = bar_rows(ticks_of(stream_messages(spark, str(tmp_path / "in"), max_files_per_trigger=1)))
    with pytest.raises(Exception, match="output is down"):
        start_to_all(rows, [table, failing], "down", str(tmp_path / "state"), NOW).awaitTermination()
    written = table.rows(spark, rows.schema)
    assert written.count() == 10
    start_to_all(rows, [table, failing], "down", str(tmp_path / "state"), NOW).awaitTermination()
    columns = ("symbol", F.unix_seconds("start"), "vwap_price_per_sec", "size_per_sec")
    one = as_set(table.rows(spark, rows.schema).select(*columns))
    two = as_set(decode_bars(read_messages(spark, str(tmp_path / "sent"))).select(*columns))
    assert failures and one == two and len(one) == 10


def test_a_batch_is_computed_once_for_all_outputs(spark):
    runs = spark.sparkContext.accumulator(0)
    rows = spark.range(4).rdd.map(lambda r: (runs.add(1), r.id)[1:]).toDF("id long")
    found = []
    to_all([lambda r, b: found.append(r.count()), lambda r, b: found.append(r.agg(F.sum("id")).first()[0])])(rows, 7)
    assert found == [4, 6] and runs.value == 4


def test_writing_a_batch_again_changes_nothing(spark, tmp_path):
    table = BatchTable(str(tmp_path / "t"))
    rows = bar_table(spark, [tick(s) for s in (0, 1, 90_000)])
    for batch in (0, 1, 1, 0):
        table(rows, batch)
    assert table.rows(spark, rows.schema).count() == 6
    assert table.rows(spark, rows.schema, ["2024-01-02"]).count() == 2
    table(rows.where("false"), 1)
    assert table.rows(spark, rows.schema).count() == 3


def lines_of(rows):
    names = ("symbol", "MA_type", "start", "end", "sma_value", "count_of_vwap", "window_data_count", "real_data_count", "filled_data_count")
    return as_set(rows.select(*names))


def test_late_parts_merge_into_their_windows(spark, tmp_path):
    """Three micro-batches cut through windows, the last is an hour late; one is written, but not
    committed, when the query fails, and written again."""
    ticks = [tick(s, price=float(s)) for s in range(20)] + [tick(3600 + s) for s in range(3)]
    rows = bar_table(spark, ticks).cache()
    second, table, failed = F.unix_seconds("start") - BASE, Windows(str(tmp_path / "windows")), []

    def written_but_failing(parts, batch):
        table(parts, batch)
        if batch == 1 and not failed:
            failed.append(batch)
            raise RuntimeError("down after the write")

    for part in (rows.where(second > 100), rows.where(second < 8), rows.where((second >= 8) & (second < 100))):
        send(part, tmp_path / "in")
    job = {"name": "parts", "checkpoint": str(tmp_path / "state"), "trigger": NOW}
    messages_ = stream_messages(spark, str(tmp_path / "in"), max_files_per_trigger=1)
    with pytest.raises(Exception, match="down after the write"):
        start_parts(messages_, [written_but_failing], **job).awaitTermination()
    start_parts(messages_, [written_but_failing], **job).awaitTermination()
    expected = sma_all(rows)
    assert failed and lines_of(table.read(spark, expected.schema)) == lines_of(expected)


def test_newest_row_of_each_key(spark, tmp_path):
    schema = "symbol string, start timestamp, price double"
    rows = lambda *given: spark.createDataFrame([(s, t, p) for s, t, p in given], "symbol string, t long, price double").select("symbol", F.timestamp_seconds("t").alias("start"), "price")
    table = Newest(str(tmp_path / "t"))
    table(rows(("A", 5, 1.0), ("B", 5, 2.0), (None, 1, 3.0)), 0)
    table(rows(("A", 9, 4.0), ("B", 4, 9.0)), 1)
    table(rows(("B", 5, 0.5), ("A", 9, 4.0)), 2)
    table(rows(("A", 9, 4.0), ("B", 4, 9.0)), 1)
    kinds = spark.createDataFrame([], schema).schema
    got = {r.symbol: r.price for r in table.read(spark, kinds).collect()}
    assert got == {"A": 4.0, "B": 0.5, None: 3.0}


def test_latest_bar_does_not_depend_on_order_or_repeats(spark, tmp_path):
    parts = [bar_table(spark, [tick(s, price=p)]) for s, p in ((1, 5.0), (9, 6.0), (9, 7.0))]
    found = set()
    for k, order in enumerate(((0, 1, 2), (2, 0, 1), (1, 2, 0))):
        for at in (*order, order[0]):
            send(parts[at], tmp_path / f"in{k}")
        table = Newest(str(tmp_path / f"t{k}"))
        stream = stream_messages(spark, str(tmp_path / f"in{k}"), max_files_per_trigger=2)
        start_latest(stream, [table], checkpoint=str(tmp_path / f"state{k}"), trigger=NOW).awaitTermination()
        rows = table.read(spark, latest_bar(decode_bars(encode(parts[0]))).schema).collect()
        assert len(rows) == 1 and rows[0].start.timestamp() == BASE + 9
        found.add(rows[0].vwap_price_per_sec)
    assert len(found) == 1


def test_partition_names_may_change_between_batches(spark, tmp_path):
    def named(rows):
        table = rows.sparkSession.read.parquet(str(tmp_path / "names"))
        return with_partition_symbol(rows.withColumn("partition", F.lit(1)), table, "none").select("timestamp", "partition_symbol")

    table, found = BatchTable(str(tmp_path / "out"), "timestamp"), []
    schema = spark.createDataFrame([], "timestamp timestamp, partition_symbol string").schema
    for name in ("old", "new"):
        spark.createDataFrame([(1, name), (2, "x")], "partition int, symbol string").write.mode("overwrite").parquet(str(tmp_path / "names"))
        write_messages(spark, [tick(0)], tmp_path / "in")
        stream = stream_messages(spark, str(tmp_path / "in"))
        start_per_batch(stream, named, [table], "named", checkpoint=str(tmp_path / "state"), trigger=NOW).awaitTermination()
        found.append(sorted(r.partition_symbol for r in table.rows(spark, schema).collect()))
    assert found == [["old"], ["new", "old"]]


def test_dead_letters(spark):
    good = tick(0)
    cases = {
        "not json": ["not json", "[1]", '{"symbol":', "", "  ", "7", "null", json.dumps(good)[:-3]],
        "wrong type: size": [tick(0, size="many"), tick(0, size=1.5), tick(0, size=2**63)],
        "wrong type: price, volume": [tick(0, price="x", volume=[1])],
        "no symbol": [tick(0, symbol=None)],
        "no time": [tick(0, time=None)],
        "no such time": [tick(0, time="never"), tick(0, time=""), tick(0, time="9" * 18)],
        "ahead of time": [tick(3601)],
        None: [good, tick(3600), tick(0, price=None), tick(0, id=7), tick(-10**6)],
    }
    rows = [(json.dumps(v) if isinstance(v, dict) else v, reason) for reason, values in cases.items() for v in values]
    frame = spark.createDataFrame([(v, r, k) for k, (v, r) in enumerate([*rows, (None, "not json")])], "value string, expected string, offset int")
    frame = frame.withColumn("timestamp", F.timestamp_seconds(F.lit(BASE)))
    found = {r.offset: (r.value, r.reason) for r in rejected_ticks(frame, "1 hour").collect()}
    expected = {r.offset: (r.value, r.expected) for r in frame.collect() if r.expected}
    assert found == expected
    assert {r.offset for r in rejected_ticks(frame).collect()} == {k for k, (_, reason) in expected.items() if reason != "ahead of time"}
