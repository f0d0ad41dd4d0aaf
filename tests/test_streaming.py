import json
import random
import uuid

import pytest
from pyspark.sql import functions as F
from ticks import BASE, messages, tick, write_messages

from tickbars.functions.codec import (
    decode_bars,
    decode_ticks,
    encode,
    ticks_of,
    with_event_time,
)
from tickbars.operators.bars import bars
from tickbars.operators.history import latest_bar
from tickbars.operators.sma import sma, sma_all
from tickbars.session import shared_folder, stored
from tickbars.sinks import Sink, console, kafka_sink, message_files, row_files, write
from tickbars.sources import files, kafka
from tickbars.streaming.jobs import (
    bar_rows,
    chained_rows,
    start,
    start_averages,
    start_bars,
    start_chained,
)
from tickbars.streaming.replay import run_to_end

NOW = {"availableNow": True}
SENTINEL = tick(3600, symbol="Z")


def twenty():
    return [tick(s, price=float(s), serial=str(s)) for s in range(20)]


def source(spark, folder, per_batch=1):
    return files.stream_messages(spark, str(folder), max_files_per_trigger=per_batch)


def finish(query):
    query.awaitTermination()
    assert query.exception() is None
    return query


def lines(frame):
    return sorted(
        tuple(r) for r in frame.select(
            "symbol", "MA_type", F.unix_seconds("start"), F.unix_seconds("end"), "sma_value",
            "count_of_vwap", "window_data_count", "real_data_count", "filled_data_count",
        ).collect()
    )


def batch_bars(spark, ticks):
    return bars(with_event_time(decode_ticks(messages(spark, ticks))))


@pytest.mark.parametrize("parts", [1, 2, 5])
def test_chained_result_does_not_depend_on_batches(spark, tmp_path, parts):
    ticks = twenty()
    size = len(ticks) // parts
    for at in range(0, len(ticks), size):
        write_messages(spark, ticks[at : at + size], tmp_path / "in")
    write_messages(spark, [SENTINEL], tmp_path / "in")
    finish(
        start_chained(
            source(spark, tmp_path / "in"), row_files(str(tmp_path / "out")),
            name=f"chained{parts}", checkpoint=str(tmp_path / "state"), trigger=NOW,
        )
    )
    found = spark.read.parquet(str(tmp_path / "out"))
    assert found.count() == 24 + 29 + 34
    assert lines(found) == lines(sma_all(batch_bars(spark, ticks)))


def test_bars_split_over_batches_are_whole(spark, tmp_path):
    random.seed(5)
    ticks = [
        tick(random.randrange(30), micro=i, symbol=random.choice("AB"), price=float(i), serial=str(i))
        for i in range(200)
    ]
    for at in range(0, 200, 50):
        write_messages(spark, ticks[at : at + 50], tmp_path / "in")
    write_messages(spark, [SENTINEL], tmp_path / "in")
    query = finish(
        start_bars(
            source(spark, tmp_path / "in"), message_files(str(tmp_path / "out")),
            name="whole_bars", checkpoint=str(tmp_path / "state"), trigger=NOW,
        )
    )
    sent = spark.read.parquet(str(tmp_path / "out"))
    assert sent.columns == ["key", "value"]
    found = decode_bars(sent).drop("current_time")
    expected = decode_bars(encode(batch_bars(spark, ticks))).drop("current_time")
    assert sorted(found.collect()) == sorted(expected.collect())
    observed = [p["observedMetrics"]["tick_quality"] for p in query.recentProgress if p["observedMetrics"]]
    assert sum(o["rows"] for o in observed) == 201


@pytest.mark.parametrize("durations", [(5,), (5, 10, 15)])
def test_averages_from_bar_messages(spark, tmp_path, durations):
    bar_rows_ = batch_bars(spark, [*twenty(), SENTINEL])
    sent = encode(bar_rows_).withColumn("timestamp", F.current_timestamp())
    sent.coalesce(1).write.parquet(str(tmp_path / "in"))
    finish(
        start_averages(
            source(spark, tmp_path / "in"), row_files(str(tmp_path / "out")), durations=durations,
            name=f"averages{len(durations)}", checkpoint=str(tmp_path / "state"), trigger=NOW,
        )
    )
    found = spark.read.parquet(str(tmp_path / "out")).where("symbol = 'A'")
    expected = sma_all(batch_bars(spark, twenty()), durations)
    assert lines(found) == lines(expected)


def test_lenient_averages(spark, tmp_path):
    def bar(second, **fields):
        start = f"2024-01-01T00:00:{second:02d}.000Z"
        return {"symbol": "A", "start": start, **fields}

    late = {"symbol": "Z", "start": "2024-01-01T01:00:00.000Z", "size_per_sec": 1}
    sent = [bar(0, size_per_sec="2", vwap_price_per_sec="3.5", real_or_filled="real"), bar(1), late]
    write_messages(spark, [json.dumps(m) for m in sent], tmp_path / "in")
    finish(
        start_averages(
            source(spark, tmp_path / "in"), row_files(str(tmp_path / "out")), durations=(5,),
            lenient=True, round_to=None, name="lenient", checkpoint=str(tmp_path / "state"),
            trigger=NOW,
        )
    )
    row = spark.read.parquet(str(tmp_path / "out")).where("window_data_count = 2").first()
    assert (row.sma_value, row.real_data_count, row.filled_data_count) == (3.5, 1, 1)


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    folder = tmp_path / "in"
    write_messages(spark, [tick(0), tick(100)], folder)  # the watermark goes to 70
    write_messages(spark, [tick(100, micro=1)], folder)  # this batch works with it
    write_messages(spark, [tick(69, serial="2"), tick(70, serial="3"), tick(71)], folder)
    write_messages(spark, [SENTINEL], folder)
    query = finish(
        start_bars(
            source(spark, folder), row_files(str(tmp_path / "out")), name="late",
            checkpoint=str(tmp_path / "state"), trigger=NOW,
        )
    )
    out = spark.read.parquet(str(tmp_path / "out"))
    starts = sorted(r[0] - BASE for r in out.select(F.unix_seconds("start")).collect())
    assert starts == [0, 70, 71, 100]  # [69, 70) ends at the watermark: late
    dropped = sum(
        op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"]
    )
    assert dropped == 1


def test_restart_loses_and_repeats_nothing(spark, tmp_path):
    ticks = twenty()
    chunks = [ticks[:7], ticks[7:8], ticks[8:], [SENTINEL]]
    for chunk in chunks:
        write_messages(spark, chunk, tmp_path / "in")
        rows = chained_rows(ticks_of(source(spark, tmp_path / "in")))
        run_to_end(rows, str(tmp_path / "out"), str(tmp_path / "state"))
    found = spark.read.parquet(str(tmp_path / "out"))
    assert lines(found) == lines(sma_all(batch_bars(spark, ticks)))


def test_state_is_dropped_behind_the_watermark(spark, tmp_path):
    for at in range(0, 200, 40):
        write_messages(spark, [tick(s) for s in range(at, at + 40)], tmp_path / "in")
    query = finish(
        start_bars(
            source(spark, tmp_path / "in"), row_files(str(tmp_path / "out")), name="bounded",
            checkpoint=str(tmp_path / "state"), trigger=NOW,
        )
    )
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 31


def test_failing_sink_fails_the_query_and_keeps_the_data(spark, tmp_path):
    write_messages(spark, [tick(0), SENTINEL], tmp_path / "in")
    rows = bar_rows(ticks_of(source(spark, tmp_path / "in")))
    broken = rows.withColumn("start", F.expr("raise_error('sink is down')").cast("timestamp"))
    query = start(broken, row_files(str(tmp_path / "out")), "broken", str(tmp_path / "state"), NOW)
    with pytest.raises(Exception, match="sink is down"):
        query.awaitTermination()
    run_to_end(rows, str(tmp_path / "out"), str(tmp_path / "state"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_early_bars_in_update_mode(spark, tmp_path):
    write_messages(spark, [tick(0, size=1)], tmp_path / "in")
    write_messages(spark, [tick(0, size=2, serial="2")], tmp_path / "in")
    name = f"early_{uuid.uuid4().hex}"
    finish(
        start_bars(
            source(spark, tmp_path / "in"), Sink("memory"), name=name, output_mode="update",
            checkpoint=str(tmp_path / "state"), trigger=NOW,
        )
    )
    assert sorted(r.size_per_sec for r in spark.table(name).collect()) == [1, 3]


def test_latest_bar_of_a_stream(spark, tmp_path):
    sent = encode(batch_bars(spark, twenty())).withColumn("timestamp", F.current_timestamp())
    sent.coalesce(1).write.parquet(str(tmp_path / "in"))
    name = f"newest_{uuid.uuid4().hex}"
    rows = latest_bar(decode_bars(source(spark, tmp_path / "in")))
    finish(start(rows, Sink("memory"), name, str(tmp_path / "state"), NOW, output_mode="update"))
    assert [r.vwap_price_per_sec for r in spark.table(name).collect()] == [19.0]


def test_text_source_and_console_sink(spark, tmp_path, capfd):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("\n".join(json.dumps(t) for t in [tick(0), SENTINEL]))
    raw = files.stream_messages(spark, str(tmp_path / "in"), "text")
    finish(start(raw, console(), "shown", str(tmp_path / "state"), NOW))
    batch = files.read_messages(spark, str(tmp_path / "in"), "text")
    assert decode_ticks(batch).where("symbol = 'Z'").count() == 1
    assert decode_ticks(raw).isStreaming


def test_json_files_of_messages(spark, tmp_path):
    write(batch_bars(spark, twenty()), message_files(str(tmp_path / "out"), "json"))
    back = decode_bars(files.read_messages(spark, str(tmp_path / "out"), "json"))
    assert back.where("current_time is not null").count() == 20
    assert sma(back, 5).count() == 24


def test_kafka_source_options():
    options = kafka.source_options(
        "a:1,b:2", "kafka_raw_data", starting="earliest", max_per_trigger=2000,
        fail_on_data_loss=False, group_id="g", extra={"kafka.security.protocol": "SSL"},
    )
    assert options == {
        "kafka.bootstrap.servers": "a:1,b:2", "subscribe": "kafka_raw_data",
        "startingOffsets": "earliest", "maxOffsetsPerTrigger": "2000",
        "failOnDataLoss": "false", "kafka.group.id": "g", "kafka.security.protocol": "SSL",
    }
    assert kafka.source_options("a:1", "t") == {
        "kafka.bootstrap.servers": "a:1", "subscribe": "t", "startingOffsets": "latest",
        "failOnDataLoss": "true",
    }


def test_kafka_sink(spark):
    sink = kafka_sink("a:1", "kafka_MA_data")
    assert sink.options == {"kafka.bootstrap.servers": "a:1", "topic": "kafka_MA_data"}
    rows = sma(batch_bars(spark, twenty()), 5)
    assert sink.prepare(rows).columns == ["key", "value"]
    value = json.loads(sink.prepare(rows).first().value)
    assert {"current_time", "MA_type", "sma_value"} <= value.keys()
    assert kafka_sink("a:1", "t", keyed=False).prepare(rows).columns == ["value"]


def test_kafka_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        kafka.stream_messages(spark, servers="localhost:1", topic="t")


def test_shared_folder_and_stored_table(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    rows = batch_bars(spark, twenty())
    table = stored(rows, "bars")
    assert table.schema.names == rows.schema.names
    assert sorted(table.collect()) == sorted(rows.collect())
    assert all(shared_folder(spark) in path for path in table.inputFiles())
