"""Bad and extreme input, complete results, ties, and the jobs as a program."""

import itertools
import json

from pyspark.sql import functions as F
from tickbars.functions.codec import ahead_of_time, bars_of, ticks_of, with_event_time
from tickbars.main import main
from tickbars.operators.bars import bars
from tickbars.schemas import ENVELOPE
from tickbars.sinks import row_files
from tickbars.sources.files import stream_messages
from tickbars.streaming.jobs import average_rows, bar_rows, start, start_each
from tickbars.streaming.replay import replay, run_to_end

BASE = 1_704_067_200
NOW = {"availableNow": True}


def tick(second, symbol="A", price=10.0, size=1, serial="1", **more):
    return json.dumps({"symbol": symbol, "type": "trade", "price": price, "size": size, "serial": serial, "time": str((BASE + second) * 1_000_000), **more})


def send(spark, folder, values, stamp=BASE):
    rows = [(None, v) for v in values]
    frame = spark.createDataFrame(rows, "key string, value string").withColumn("timestamp", F.timestamp_seconds(F.lit(stamp)))
    frame.select(*ENVELOPE.names).coalesce(1).write.mode("append").parquet(folder)


def test_overflow_does_not_stop_a_stream(spark, tmp_path):
    topic, out, state = (str(tmp_path / x) for x in ("topic", "out", "state"))
    most = 2**63 - 1
    send(spark, topic, [tick(0, size=most), tick(0, size=most, serial="2"), tick(1)])
    rows = bar_rows(ticks_of(stream_messages(spark, topic), name="overflow"))
    run_to_end(rows, out, state, "overflow")
    send(spark, topic, [tick(60), tick(200)])
    run_to_end(rows, out, state, "overflow")  # and it starts again
    got = {r[0]: r[1] for r in spark.read.parquet(out).select(F.unix_seconds("start") - BASE, "size_per_sec").collect()}
    assert got == {0: None, 1: 1, 60: 1}


def test_absurd_bar_times_do_not_stop_a_stream(spark, tmp_path):
    topic = str(tmp_path / "topic")
    bad = ["+294247-01-10T04:00:54.775Z", "-290308-12-21T19:59:06Z", "soon"]
    good = [{"symbol": "A", "start": f"2024-01-01T00:00:{s:02d}Z", "real_or_filled": "real", "vwap_price_per_sec": 1.0, "size_per_sec": 1} for s in range(3)]
    send(spark, topic, [json.dumps({**good[0], "start": b}) for b in bad] + [json.dumps(g) for g in good])
    for durations in ((5,), (5, 10)):
        rows = bars_of(stream_messages(spark, topic), name=f"bars{len(durations)}")
        got = replay(rows, "start", lambda r, d=durations: average_rows(r, d), f"absurd{len(durations)}")
        assert got.where("MA_type = '5_MA_data'").agg(F.sum("window_data_count")).first()[0] == 15


def test_a_far_future_tick_is_refused_and_given_apart(spark, tmp_path):
    topic, out, state = (str(tmp_path / x) for x in ("topic", "out", "state"))
    send(spark, topic, [tick(0), tick(7 * 86400, symbol="FAR")])
    rows = bar_rows(ticks_of(stream_messages(spark, topic), ahead="1 hour", name="future"))
    run_to_end(rows, out, state, "future")
    for second in (1, 2, 300):
        send(spark, topic, [tick(second)], BASE + second)
        run_to_end(rows, out, state, "future")
    assert sorted(r[0] for r in spark.read.parquet(out).select(F.unix_seconds("start") - BASE).collect()) == [0, 1, 2]
    refused = ahead_of_time(spark.read.schema(ENVELOPE).parquet(topic), "1 hour").collect()
    assert [json.loads(r.value)["symbol"] for r in refused] == ["FAR"]


def test_two_topics_in_one_query(spark, tmp_path):
    for name in ("one", "two"):
        send(spark, str(tmp_path / name), [tick(0, symbol=name)])
    both = [ticks_of(stream_messages(spark, str(tmp_path / name)), name=f"quality_{name}") for name in ("one", "two")]
    got = replay(both[0].unionByName(both[1]), "time", bar_rows, "both")
    assert sorted(r.symbol for r in got.collect()) == ["one", "two"]


def test_last_does_not_depend_on_order(spark):
    rows = [("A", "trade", 10.0 + v, 1, v, v % 2 == 0, str(BASE * 1_000_000), "7", 5.0 + v) for v in range(3)]
    kinds = "symbol string, type string, price double, size long, volume long, isContinuous boolean, time string, serial string, yesterday_price double"
    found = set()
    for order in itertools.permutations(rows):
        frame = with_event_time(spark.createDataFrame(list(order), kinds).coalesce(1))
        r = bars(frame, with_flag=True).first()
        found.add((r.volume_till_now, r.isContinuous, r.yesterday_price))
    assert len(found) == 1
    assert next(iter(found)) in {(v, v % 2 == 0, 5.0 + v) for v in range(3)}  # of one and the same tick


def test_serials_of_either_sign_and_large_windows_keep_their_order(spark):
    rows = [("A", "trade", 1.0, 1, v, True, str((BASE + s) * 1_000_000), serial, 1.0) for v, (s, serial) in enumerate([(0, str(2**63 - 1)), (1, str(-(2**63))), (1, "-5"), (1, "3"), (86_000, "-9")])]
    kinds = "symbol string, type string, price double, size long, volume long, isContinuous boolean, time string, serial string, yesterday_price double"
    frame = with_event_time(spark.createDataFrame(rows, kinds))
    assert {r.volume_till_now for r in bars(frame).collect()} == {0, 3, 4}
    assert [r.volume_till_now for r in bars(frame, size="1 day").collect()] == [4]


def test_each_duration_on_its_own_is_early(spark, tmp_path):
    topic = str(tmp_path / "topic")
    bar = {"symbol": "A", "real_or_filled": "real", "vwap_price_per_sec": 1.0, "size_per_sec": 1}
    send(spark, topic, [json.dumps({**bar, "start": f"2024-01-01T00:00:{s:02d}Z"}) for s in (0, 38)])
    counter = itertools.count()
    queries = start_each(
        lambda: stream_messages(spark, topic), lambda d: row_files(str(tmp_path / f"out{d}")), str(tmp_path / "state"), name=f"each{next(counter)}", trigger=NOW
    )
    for q in queries:
        q.awaitTermination()
    ends = {d: spark.read.parquet(str(tmp_path / f"out{d}")).count() if (tmp_path / f"out{d}").exists() and list((tmp_path / f"out{d}").glob("*.parquet")) else 0 for d in (5, 10, 15)}
    assert ends[5] > 0 and ends[15] < 15  # the watermark has passed every 5-second window only


def test_processing_time_trigger(spark, tmp_path):
    topic = str(tmp_path / "topic")
    send(spark, topic, [tick(0), tick(100)])
    rows = bar_rows(ticks_of(stream_messages(spark, topic), name="timed"))
    query = start(rows, row_files(str(tmp_path / "out")), "timed", str(tmp_path / "state"), {"processingTime": "1 second"})
    query.processAllAvailable()
    query.stop()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_the_program_runs_over_files(spark, tmp_path):
    topic = str(tmp_path / "topic")
    send(spark, topic, [tick(s) for s in range(20)] + [tick(500)])
    main(["bars", "--source", "parquet", "--from", topic, "--sink", "parquet", "--to", str(tmp_path / "bars"), "--checkpoint", str(tmp_path / "s1"), "--once"], spark)
    assert spark.read.parquet(str(tmp_path / "bars")).count() == 20
    main(["averages-each", "--source", "parquet", "--from", str(tmp_path / "bars"), "--sink", "parquet", "--to", str(tmp_path / "lines"), "--checkpoint", str(tmp_path / "s2"), "--once", "--durations", "5"], spark)
    main(["chained", "--source", "parquet", "--from", topic, "--sink", "parquet", "--to", str(tmp_path / "chained"), "--checkpoint", str(tmp_path / "s3"), "--once"], spark)
    assert spark.read.parquet(str(tmp_path / "chained")).count() == 24 + 29 + 34
    filled = ["--source", "parquet", "--from", str(tmp_path / "bars"), "--sink", "parquet", "--once", "--watermark", "5 seconds"]
    main(["filled", *filled, "--to", str(tmp_path / "filled"), "--checkpoint", str(tmp_path / "s4")], spark)
    assert spark.read.parquet(str(tmp_path / "filled")).count() == 15
    main(["lines", *filled, "--to", str(tmp_path / "each"), "--checkpoint", str(tmp_path / "s5"), "--each-bar-once"], spark)
    assert spark.read.parquet(str(tmp_path / "each")).count() == 3 * 15
    main(["latest", *filled, "--to", str(tmp_path / "latest"), "--checkpoint", str(tmp_path / "s6")], spark)
    assert spark.read.parquet(str(tmp_path / "latest")).count() == 1
    main(["rejected", "--source", "parquet", "--from", topic, "--sink", "parquet", "--to", str(tmp_path / "bad"), "--checkpoint", str(tmp_path / "s7"), "--once"], spark)
    assert not [f for f in (tmp_path / "bad").glob("*.parquet") if spark.read.parquet(str(f)).count()]
