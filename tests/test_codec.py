import json

import pytest
from pyspark.sql import functions as F
from ticks import BASE, messages, tick

from tickbars.functions.codec import decode_bars, decode_ticks, encode, stamp, with_event_time
from tickbars.functions.columns import (
    iso_to_millis,
    millis_to_iso,
    rounded,
    safe_ratio,
    to_long,
)
from tickbars.operators.bars import bars
from tickbars.schemas import BAR, TICK


def value_of(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_bad_json_is_a_row_of_nulls(spark):
    row = decode_ticks(messages(spark, ["not json"])).first()
    assert row.asDict() == {f.name: None for f in TICK}


@pytest.mark.parametrize("size", [1.5, "7", True])
def test_wrong_type_nulls_the_field_only(spark, size):
    row = decode_ticks(messages(spark, [tick(0, size=size)])).first()
    assert (row.size, row.price, row.symbol) == (None, 10.0, "A")


def test_binary_value(spark):
    raw = messages(spark, [tick(0)]).withColumn("value", F.col("value").cast("binary"))
    assert decode_ticks(raw).first().symbol == "A"


def test_kept_columns(spark):
    raw = messages(spark, [tick(0)]).withColumn("partition", F.lit(3))
    assert decode_ticks(raw, keep=("partition",)).first().partition == 3


def test_event_time(spark):
    frame = with_event_time(decode_ticks(messages(spark, [tick(1, micro=179575)])))
    assert frame.select(F.unix_micros("time")).first()[0] == (BASE + 1) * 1_000_000 + 179575


@pytest.mark.parametrize(
    ("text", "number"),
    [("12", 12), ("-3", -3), ("1.9", 1), ("1e3", 1000), ("x", None), ("", None), ("nan", None)],
)
def test_to_long(spark, text, number):
    assert value_of(spark, to_long(F.lit(text))) == number


def test_round_half_up(spark):
    assert value_of(spark, rounded(F.lit(1.005), 2)) == 1.01
    assert value_of(spark, rounded(F.lit(-1.005), 2)) == -1.01
    assert value_of(spark, rounded(F.lit(1.2345), None)) == 1.2345


@pytest.mark.parametrize(("n", "d", "q"), [(6.0, 3.0, 2.0), (6.0, 0.0, 0.0), (6.0, None, 0.0), (None, 3.0, None)])
def test_safe_ratio(spark, n, d, q):
    assert value_of(spark, safe_ratio(F.lit(n).cast("double"), F.lit(d).cast("double"))) == q


def test_iso(spark):
    moment = 1704067207179
    assert value_of(spark, iso_to_millis(F.lit("2024-01-01T08:00:07.179+08:00"))) == moment
    assert value_of(spark, iso_to_millis(F.lit("2024-01-01T00:00:07.179"))) == moment
    assert value_of(spark, iso_to_millis(F.lit("not a time"))) is None
    assert value_of(spark, millis_to_iso(F.lit(moment))) == "2024-01-01T00:00:07.179000"
    assert value_of(spark, millis_to_iso(F.lit(moment), "Asia/Taipei")) == "2024-01-01T08:00:07.179000"
    assert value_of(spark, millis_to_iso(F.lit(1704067207000))) == "2024-01-01T00:00:07"


def some_bars(spark):
    ticks = [tick(0, price=None, size=2), tick(1, price=0.1, size=3), tick(1, symbol="B")]
    return bars(with_event_time(decode_ticks(messages(spark, ticks))))


def test_encode_leaves_nulls_out_and_writes_millis(spark):
    rows = {json.loads(r.value)["start"]: (r.key, json.loads(r.value)) for r in encode(some_bars(spark)).collect()}
    key, value = rows["2024-01-01T00:00:00.000Z"]
    assert key == "A"
    assert "vwap_price_per_sec" not in value
    assert value["size_per_sec"] == 2


def test_encode_without_key(spark):
    assert encode(some_bars(spark), keyed=False).columns == ["value"]


def test_round_trip(spark):
    original = some_bars(spark)
    back = decode_bars(encode(stamp(original)))
    assert back.columns == BAR.names
    assert back.where("current_time is null").count() == 0
    assert sorted(back.select(*original.columns).collect()) == sorted(original.collect())


def test_round_trip_in_another_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Taipei")
    try:
        frame = encode(some_bars(spark))
        assert all(
            json.loads(r.value)["start"].startswith("2024-01-01T08:00:0") for r in frame.collect()
        )
        starts = decode_bars(frame).select(F.unix_seconds("start")).distinct().collect()
        assert {r[0] for r in starts} == {BASE, BASE + 1}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_lenient_numbers(spark):
    text = json.dumps({"symbol": "A", "size_per_sec": "7", "vwap_price_per_sec": "1.5",
                       "volume_till_now": 3.0, "real_data_count": "many"})
    raw = messages(spark, [text])
    strict, lenient = decode_bars(raw).first(), decode_bars(raw, lenient=True).first()
    assert (strict.size_per_sec, strict.vwap_price_per_sec) == (None, None)
    assert (lenient.size_per_sec, lenient.vwap_price_per_sec) == (7, 1.5)
    assert (lenient.volume_till_now, lenient.real_data_count) == (3, None)
    assert decode_bars(raw, lenient=True).schema == decode_bars(raw).schema
