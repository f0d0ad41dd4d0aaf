import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from ticks import BASE, messages, tick

from tickbars.functions.codec import decode_ticks, with_event_time
from tickbars.operators import history
from tickbars.operators.bars import BAR_COLUMNS, bars

def plain():
    return Window.partitionBy("symbol").orderBy("start")


@pytest.fixture(scope="module")
def rows(spark):
    random.seed(7)
    ticks = []
    for symbol, span in (("A", 60), ("B", 5000), ("C", 300), (None, 200)):
        for serial in range(120):
            ticks.append(
                tick(
                    random.randrange(span), symbol=symbol, serial=str(serial), volume=serial,
                    price=round(random.random() * 50, 2),
                    kind=random.choice(("trade", "trade", "heartbeat")),
                    yesterday_price=20.0,
                )
            )
    return bars(with_event_time(decode_ticks(messages(spark, ticks)))).cache()


def same(found, expected):
    key = lambda r: tuple((v is not None, v) for v in r)
    assert sorted(found.collect(), key=key) == sorted(expected.collect(), key=key)


@pytest.mark.parametrize("seconds", [3, 50, 600])
def test_rank(rows, seconds):
    found = history.window_rank(rows, slice_seconds=seconds).select("symbol", "start", "rank")
    same(found, rows.select("symbol", "start", F.row_number().over(plain()).alias("rank")))


@pytest.mark.parametrize("seconds", [3, 600])
@pytest.mark.parametrize("steps", [1, 2, 4])
def test_previous(rows, seconds, steps):
    found = history.previous(rows, "volume_till_now", steps, "p", slice_seconds=seconds)
    expected = rows.select("symbol", "start", F.lag("volume_till_now", steps).over(plain()).alias("p"))
    same(found.select("symbol", "start", "p"), expected)


@pytest.mark.parametrize("seconds", [3, 600])
def test_carry_forward(rows, seconds):
    last = F.last(F.nullif("vwap_price_per_sec", F.lit(0.0)), ignorenulls=True).over(plain())
    expected = rows.select("symbol", "start", F.coalesce(last, "yesterday_price"))
    same(history.carry_forward(rows, seconds).select("symbol", "start", "carried_vwap"), expected)


@pytest.mark.parametrize("seconds", [3, 600])
def test_gap_fill(rows, seconds):
    filled = history.gap_fill(rows, seconds).cache()
    assert filled.columns == list(BAR_COLUMNS)
    spans = rows.groupBy("symbol").agg(
        (F.max(F.unix_seconds("start")) - F.min(F.unix_seconds("start")) + 1).alias("n")
    )
    assert filled.count() == spans.agg(F.sum("n")).first()[0]
    assert filled.select("symbol", "start").distinct().count() == filled.count()
    columns = list(BAR_COLUMNS)
    assert rows.select(columns).exceptAll(filled.select(columns)).count() == 0
    made = filled.exceptAll(rows.select(columns))
    expected = ("filled", 0, 1, 0.0, 0, 0, 20.0, -100.0, None)
    shape = made.select(
        "real_or_filled", "real_data_count", "filled_data_count", "vwap_price_per_sec",
        "size_per_sec", "volume_till_now", "yesterday_price", "price_change_percentage",
        "last_data_time",
    ).distinct()
    assert [tuple(r) for r in shape.collect()] == [expected]


def test_gap_fill_makes_what_a_heartbeat_makes(spark):
    def of(*ticks):
        return bars(with_event_time(decode_ticks(messages(spark, ticks)))).drop("last_data_time")

    with_heartbeat = of(tick(0), tick(1, kind="heartbeat"), tick(2))
    silent = bars(with_event_time(decode_ticks(messages(spark, [tick(0), tick(2)]))))
    same(history.gap_fill(silent).drop("last_data_time"), with_heartbeat)


def test_latest(rows):
    newest = rows.withColumn("n", F.row_number().over(Window.partitionBy("symbol").orderBy(F.desc("start"))))
    columns = ["symbol", "start", "vwap_price_per_sec", "volume_till_now", "real_or_filled"]
    same(history.latest_bar(rows).select(columns), newest.where("n = 1").select(columns))
    priced = rows.where("vwap_price_per_sec != 0").withColumn(
        "n", F.row_number().over(Window.partitionBy("symbol").orderBy(F.desc("start")))
    )
    columns = columns[:3]
    same(history.latest_price(rows).select(columns), priced.where("n = 1").select(columns))


def test_window_bounds(spark):
    rows = bars(with_event_time(decode_ticks(messages(spark, [tick(0), tick(3)]))))
    found = {
        r.s - BASE: (r.a - BASE, r.b - BASE)
        for r in history.window_bounds(rows, 5)
        .select(
            F.unix_seconds("start").alias("s"), F.unix_seconds("first_data_time").alias("a"),
            F.unix_seconds("last_data_time").alias("b"),
        )
        .collect()
    }
    assert found == {
        -4: (0, 0), -3: (0, 0), -2: (0, 0), -1: (0, 3), 0: (0, 3), 1: (3, 3), 2: (3, 3), 3: (3, 3),
    }


def test_partition_symbols(spark):
    frame = spark.createDataFrame([(0,), (1,), (1,), (9,)], "partition int")
    named = history.with_partition_symbol(frame, {0: "A", 1: "B"}, "none")
    assert sorted(tuple(r) for r in named.collect()) == [
        (0, "A"), (1, "B"), (1, "B"), (9, "none"),
    ]
    assert history.source_partitions(frame).count() == 3


def test_no_window_over_a_whole_symbol(rows):
    plan = history.carry_forward(rows)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "windowspecdefinition(" in line]
    assert windows and all("_group" in line or "_closing" in line for line in windows)


@pytest.mark.parametrize(
    "operator",
    [
        history.window_rank,
        history.carry_forward,
        lambda r: history.previous(r, "volume_till_now", (1, 2), ("p", "q")),
    ],
)
def test_whole_rows_are_shuffled_and_sorted_once(spark, rows, operator):
    """Without broadcast joins, as on large tables: what else is shuffled is a row per slice."""
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = operator(rows)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    lines = plan.splitlines()
    at = next(k for k, line in enumerate(lines) if "SortMergeJoin" in line)
    depth = lines[at + 1].index(":- ")
    end = next(k for k in range(at + 1, len(lines)) if lines[k][depth : depth + 3] == "+- ")
    left = lines[at + 1 : end]  # the side of the whole rows
    assert sum("Exchange hashpartitioning(_group" in line for line in left) == 1
    assert sum(" Sort [" in line for line in left) == 1
