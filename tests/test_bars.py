from datetime import datetime

import pytest
from pyspark.sql import functions as F
from ticks import BASE, messages, tick

from tickbars.functions.codec import decode_ticks, ticks_of, with_event_time
from tickbars.operators.bars import BAR_COLUMNS, bars, in_time_order


@pytest.fixture
def make(spark):
    def run(*ticks, **options):
        return bars(with_event_time(decode_ticks(messages(spark, ticks))), **options)

    return run


def one(frame):
    (row,) = frame.collect()
    return row


def test_vwap_size_and_label(make):
    row = one(make(tick(0, price=10.0, size=1), tick(0, micro=5, price=20.0, size=3)))
    assert (row.vwap_price_per_sec, row.size_per_sec, row.real_or_filled) == (17.5, 4, "real")
    assert (row.real_data_count, row.filled_data_count) == (2, 0)
    assert row.type == "per_sec_data"
    assert row.price_change_percentage == -82.5


def test_bar_columns(make):
    assert make(tick(0)).columns == list(BAR_COLUMNS)


def test_window_bounds_and_last_time(make):
    frame = make(tick(7, micro=179575), tick(7, micro=20)).select(
        F.unix_seconds("start").alias("a"),
        F.unix_seconds("end").alias("b"),
        F.unix_micros("last_data_time").alias("last"),
    )
    assert tuple(one(frame)) == (BASE + 7, BASE + 8, (BASE + 7) * 1_000_000 + 179575)


def test_only_heartbeats(make):
    row = one(make(tick(0, kind="heartbeat", yesterday_price=100.0)))
    assert (row.vwap_price_per_sec, row.size_per_sec, row.real_or_filled) == (0, 0, "filled")
    assert row.price_change_percentage == -100.0
    assert (row.real_data_count, row.filled_data_count) == (0, 1)


def test_heartbeat_last_hides_the_volume(make):
    ticks = (
        tick(0, volume=700),
        tick(0, micro=9, kind="heartbeat", volume=900),
    )
    row = one(make(*ticks))
    assert row.volume_till_now == 0
    assert (row.real_data_count, row.filled_data_count) == (1, 1)
    assert one(make(*ticks, ignore_heartbeats=True)).volume_till_now == 700


def test_last_volume_null_is_kept(make):
    row = one(make(tick(0, volume=5), tick(0, micro=9, volume=None)))
    assert row.volume_till_now is None


@pytest.mark.parametrize("base", [0.0, None])
def test_no_change_without_base(make, base):
    assert one(make(tick(0, yesterday_price=base))).price_change_percentage == 0


def test_last_known_yesterday_price(make):
    row = one(
        make(
            tick(0, yesterday_price=1.0),
            tick(0, micro=5, yesterday_price=2.0),
            tick(0, micro=9, yesterday_price=None),
        )
    )
    assert row.yesterday_price == 2.0


def test_untyped_tick_adds_nothing(make):
    row = one(make(tick(0, kind=None, price=5.0, size=7, volume=9)))
    assert (row.size_per_sec, row.vwap_price_per_sec, row.volume_till_now) == (0, 0, 0)
    assert (row.real_data_count, row.filled_data_count, row.real_or_filled) == (0, 0, "filled")


def test_all_prices_null(make):
    row = one(make(tick(0, price=None, size=2)))
    assert row.vwap_price_per_sec is None
    assert row.size_per_sec == 2


def test_large_volume(make):
    assert one(make(tick(0, volume=3_000_000_000))).volume_till_now == 3_000_000_000


def test_equal_times_are_told_apart_by_number_not_text(make):
    row = one(make(tick(0, serial="9", volume=1), tick(0, serial="10", volume=2)))
    assert row.volume_till_now == 2


def test_extreme_serials_keep_the_time_order(make):
    biggest, smallest = str(2**63 - 1), str(-(2**63))
    row = one(make(tick(0, serial=biggest, volume=1), tick(0, micro=1, serial=smallest, volume=2)))
    assert row.volume_till_now == 2
    row = one(make(tick(0, serial=biggest, volume=1), tick(0, serial=smallest, volume=2)))
    assert row.volume_till_now == 1


def test_result_does_not_depend_on_row_order(spark, make):
    ticks = [tick(0, serial=s, volume=v) for s, v in (("x", 1), (None, 2), ("y", 3), ("z", 4))]
    results = {one(make(*order)).volume_till_now for order in (ticks, ticks[::-1], ticks[2:] + ticks[:2])}
    assert len(results) == 1


def test_bad_messages_make_no_bar(make):
    assert make("not json", tick(0, time="abc"), tick(0, time=None)).count() == 0


def test_absurd_times_make_no_bar(make):
    assert make(tick(0, time=str(2**63 - 1)), tick(0, time="inf"), tick(0, time="1e300")).count() == 0


def test_symbols_and_seconds_are_apart(make):
    frame = make(tick(0), tick(1), tick(1, symbol="B"), tick(1, micro=999999))
    found = {(r.symbol, r.start.second, r.size_per_sec) for r in frame.collect()}
    assert len(found) == 3


def test_null_symbol_is_a_group_without_counts(make):
    row = one(make(tick(0, symbol=None)))
    assert (row.real_data_count, row.real_or_filled, row.size_per_sec) == (0, "filled", 1)


def test_flag(make):
    row = one(
        make(
            tick(0, isContinuous=False),
            tick(0, micro=1, isContinuous=True),
            tick(0, micro=2),
            with_flag=True,
        )
    )
    assert row.isContinuous is True


def test_other_bar_size(make):
    assert make(tick(0), tick(3), tick(5), size="5 seconds").count() == 2


def test_sorted(make):
    frame = in_time_order(make(tick(5), tick(1), tick(3), tick(1, symbol="B"), tick(2)))
    order = [(r.start, r.symbol) for r in frame.collect()]
    assert order == sorted(order)
    assert all(isinstance(start, datetime) for start, _ in order)


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_bars_use_one_shuffle_and_hash_aggregation(make):
    plan = plan_of(make(tick(0)))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "SortAggregate" not in plan
    assert "partial_sum" in plan


def test_each_message_is_parsed_once(spark):
    frame = bars(ticks_of(messages(spark, [tick(0), tick(1, channel="c", bid=1.0)])))
    assert plan_of(frame).count("from_json(") == 1
    assert "channel" not in plan_of(frame)
    assert frame.count() == 2
