"""Ticks to bars: one row per symbol and second."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickbars.functions.columns import (
    arrival_order,
    change_percent,
    from_trade,
    is_trade,
    trade_label,
    vwap,
)
from tickbars.schemas import BAR_TYPE

BAR_COLUMNS = (
    "symbol", "type", "start", "end", "last_data_time",
    "real_data_count", "filled_data_count", "real_or_filled",
    "vwap_price_per_sec", "size_per_sec", "volume_till_now",
    "yesterday_price", "price_change_percentage",
)


def _last(value: Column, order: Column, among: Column | None = None) -> Column:
    """``value`` of the latest row, or of the latest row of those ``among``.

    Rows with a null ordering are skipped by ``max_by``; null values are not.
    """
    return F.max_by(value, order if among is None else F.when(among, order))


def bars(
    ticks: DataFrame,
    size: str = "1 second",
    watermark: str | None = None,
    ignore_heartbeats: bool = False,
    with_flag: bool = False,
    chain: bool = False,
) -> DataFrame:
    """Volume-weighted price, size, volume and row counts per symbol and window.

    ``ticks`` has the TICK columns with ``time`` as a timestamp; rows without
    event time fall out. The grouping key is (window, symbol), so even a symbol
    that holds a third of all ticks is spread over its seconds, and each task
    first reduces its own ticks to one partial row per key.

    ``watermark``          how late a tick may be (streaming only)
    ``ignore_heartbeats``  take ``volume_till_now`` from the last trade instead
                           of giving 0 when the last row is a heartbeat
    ``with_flag``          also give the last ``isContinuous`` flag
    ``chain``              also give ``bar_time``, the event time a following
                           streaming aggregation has to group on
    """
    if watermark is not None:
        ticks = ticks.withWatermark("time", watermark)
    named = F.col("symbol").isNotNull()
    order = arrival_order(size)
    volume = (
        _last(F.col("volume"), order, is_trade())
        if ignore_heartbeats
        else _last(from_trade(F.col("volume")), order)
    )
    aggregates = [
        F.sum(from_trade(F.col("price") * F.col("size"))).alias("notional"),
        # A sum beyond bigint is null: it must not stop a stream.
        F.try_sum(from_trade(F.col("size"))).alias("size_per_sec"),
        volume.alias("volume_till_now"),
        F.max("time").alias("last_data_time"),
        F.count_if(is_trade() & named).alias("real_data_count"),
        F.count_if(~is_trade() & named).alias("filled_data_count"),
        _last(
            F.col("yesterday_price"), order, F.col("yesterday_price").isNotNull()
        ).alias("yesterday_price"),
    ]
    if with_flag:
        flag = F.col("isContinuous")
        aggregates.append(_last(flag, order, flag.isNotNull()).alias("isContinuous"))

    grouped = ticks.groupBy(F.window("time", size).alias("window"), "symbol").agg(*aggregates)
    price = vwap(F.col("notional"), F.col("size_per_sec"))
    out = grouped.select(
        "*",
        F.lit(BAR_TYPE).alias("type"),
        F.col("window.start").alias("start"),
        F.col("window.end").alias("end"),
        trade_label(F.col("real_data_count")).alias("real_or_filled"),
        price.alias("vwap_price_per_sec"),
        change_percent(price, F.col("yesterday_price")).alias("price_change_percentage"),
    )
    extra = ["isContinuous"] if with_flag else []
    if chain:
        extra.append(F.window_time("window").alias("bar_time"))
    return out.select(*BAR_COLUMNS, *extra)


def in_time_order(rows: DataFrame) -> DataFrame:
    """Bars or windows sorted by time over the whole table (batch results only; a
    stream keeps the order of a symbol by its message key)."""
    return rows.orderBy("start", "symbol")
