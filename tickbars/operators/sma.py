"""Bars to sliding moving averages.

``sma`` and ``sma_all`` use event-time windows and run on batch and streaming
DataFrames alike. ``tickbars.plans.lines`` holds the plan for large tables.

The average of a window is the mean of the per-second prices over the seconds
that traded; it is not weighted by volume.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickbars.schemas import DURATIONS, MA_TYPE, REAL, ma_label

MA_COLUMNS = (
    "symbol", "type", "MA_type", "start", "end", "sma_value", "sum_of_vwap",
    "count_of_vwap", "window_data_count", "real_data_count", "filled_data_count",
)
COUNTS = ("count_of_vwap", "window_data_count", "real_data_count", "filled_data_count")


# What one bar adds to the sums of every window it lies in.
MEASURES = {
    "sum_of_vwap": "if(size_per_sec != 0, vwap_price_per_sec, 0D)",
    "count_of_vwap": "if(size_per_sec != 0 AND vwap_price_per_sec IS NOT NULL, 1L, 0L)",
    "window_data_count": "1L",
    "real_data_count": f"if(real_or_filled = '{REAL}' AND symbol IS NOT NULL, 1L, 0L)",
    "filled_data_count": f"if(real_or_filled != '{REAL}' AND symbol IS NOT NULL, 1L, 0L)",
}


def average(total: str, count: str, round_to: int | None) -> str:
    value = f"{total} / {count}"
    if round_to is not None:
        value = f"round({value}, {round_to})"
    return f"if({count} != 0, {value}, 0D)"


def sma(
    bars: DataFrame,
    seconds: int,
    slide: str = "1 second",
    round_to: int | None = 2,
    time_column: str = "start",
    watermark: str | None = None,
) -> DataFrame:
    """Moving average over ``seconds``, one row per symbol and window start.

    Windows with fewer than ``seconds`` bars, at the edges and beside gaps, are
    given too; ``window_data_count`` tells how full a window is.
    """
    if watermark is not None:
        bars = bars.withWatermark(time_column, watermark)
    window = F.window(time_column, f"{seconds} seconds", slide).alias("window")
    sums = [F.expr(f"sum({value}) AS {name}") for name, value in MEASURES.items()]
    windows = bars.groupBy(window, "symbol").agg(*sums)
    return windows.selectExpr(
        "symbol",
        f"'{MA_TYPE}' AS type",
        f"'{ma_label(seconds)}' AS MA_type",
        "window.start",
        "window.end",
        f"{average('sum_of_vwap', 'count_of_vwap', round_to)} AS sma_value",
        *MEASURES,
    )


def sma_all(
    bars: DataFrame,
    durations: Sequence[int] = DURATIONS,
    slide: str = "1 second",
    round_to: int | None = 2,
    time_column: str = "start",
    watermark: str | None = None,
) -> DataFrame:
    """Moving averages for several durations in one aggregation.

    A shorter window is the first part of the longest one that starts at the
    same time, so one sliding window of the longest duration carries them all:
    one source, one shuffle and one state store, and each bar is expanded
    ``max(durations)`` times, not ``sum(durations)`` times. On a stream the
    short windows therefore come out together with the longest; start one
    ``sma`` query per duration where that delay matters.
    """
    if watermark is not None:
        bars = bars.withWatermark(time_column, watermark)
    durations = sorted(durations)
    measures = [f"{value} AS {name}" for name, value in MEASURES.items()]
    rows = bars.selectExpr("symbol", time_column, *measures)
    rows = rows.withColumn("window", F.window(time_column, f"{durations[-1]} seconds", slide))
    sums = [
        F.expr(
            f"sum(if({time_column} < window.start + INTERVAL {seconds} SECONDS, {name}, NULL))"
            f" AS {name}_{seconds}"
        )
        for seconds in durations
        for name in MEASURES
    ]
    windows = rows.groupBy("window", "symbol").agg(*sums)
    return unfold(windows, durations, "window.start", round_to)


def unfold(
    windows: DataFrame, durations: Sequence[int], start: str, round_to: int | None
) -> DataFrame:
    """One row per duration from rows that hold ``<measure>_<seconds>`` columns.

    ``start`` is the SQL of the window start. Windows without a bar are left out.
    """

    def line(seconds: int) -> str:
        value = average(f"sum_of_vwap_{seconds}", f"count_of_vwap_{seconds}", round_to)
        measures = ", ".join(f"{name}_{seconds} AS {name}" for name in MEASURES)
        return (
            f"struct('{MA_TYPE}' AS type, '{ma_label(seconds)}' AS MA_type, {start} AS start,"
            f" {start} + INTERVAL {seconds} SECONDS AS end, {value} AS sma_value, {measures})"
        )

    lines = ", ".join(line(seconds) for seconds in durations)
    return windows.selectExpr("symbol", f"inline(array({lines}))").where("window_data_count > 0")


def fill_bar_defaults(bars: DataFrame) -> DataFrame:
    """Defaults for absent fields: price 0, size 0, label empty (counts as filled)."""
    defaults = {"vwap_price_per_sec": 0.0, "size_per_sec": 0, "real_or_filled": ""}
    return bars.fillna(defaults)


def merge_partial_windows(partials: DataFrame, round_to: int | None = 2) -> DataFrame:
    """Complete windows from rows that each cover a part of the same window."""
    key = ["symbol", "type", "MA_type", "start", "end"]
    merged = partials.groupBy(*key).agg(
        *[F.sum(name).alias(name) for name in ("sum_of_vwap", *COUNTS)]
    )
    value = average("sum_of_vwap", "count_of_vwap", round_to)
    return merged.withColumn("sma_value", F.expr(value)).select(*MA_COLUMNS)
