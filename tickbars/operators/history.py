"""Looking along the bars or windows of a symbol: rank, previous value, last price,
gaps, and the latest row.

These are batch operators over one row per key and ``start``; the ones that need
order work slice by slice (see ``slices``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickbars.functions.columns import change_percent, trade_label
from tickbars.operators.bars import BAR_COLUMNS
from tickbars.operators.slices import (
    GROUP,
    SLICE_SECONDS,
    across,
    dealt,
    join_slices,
    sliced,
    window_starts,
    within,
)
from tickbars.schemas import BAR_TYPE

SYMBOL = ("symbol",)


def window_rank(
    rows: DataFrame, keys: Sequence[str] = SYMBOL, slice_seconds: int = SLICE_SECONDS
) -> DataFrame:
    """Add ``rank``: the number of the row in the time order of its key, from 1."""
    parts = sliced(rows, keys, slice_seconds)
    earlier = across(keys).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        parts.groupBy(GROUP)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(GROUP, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    )
    ranked = parts.withColumn("_rank", F.row_number().over(within()))
    joined = join_slices(ranked, offsets)
    return joined.withColumn("rank", F.col("_rank") + F.col("_before")).drop(
        "_rank", "_before", GROUP
    )


def previous(
    rows: DataFrame,
    column: str,
    steps: int | Sequence[int] = 1,
    name: str | Sequence[str] | None = None,
    keys: Sequence[str] = SYMBOL,
    slice_seconds: int = SLICE_SECONDS,
) -> DataFrame:
    """Add the value ``column`` had ``steps`` rows ago; null where there is no such row.

    Several steps, with a name each, cost one pass."""
    every = [steps] if isinstance(steps, int) else list(steps)
    names = [name or f"prev_{column}"] if isinstance(steps, int) else list(name)
    most = max(every)
    order = within()
    group = Window.partitionBy(GROUP)
    parts = sliced(rows, keys, slice_seconds).withColumns(
        {
            "_row": F.row_number().over(order),
            **{f"_back_{k}": F.lag(column, k).over(order) for k in every},
            "_rows": F.count(F.lit(1)).over(group),
        }
    )
    # The first rows of a slice look into the last rows of the slices before it.
    # Every slice in the table has a row, so `most` slices back always suffice.
    tails = (
        parts.where(F.col("_rows") - F.col("_row") < most)
        .groupBy(GROUP)
        .agg(
            F.sort_array(
                F.collect_list(F.struct(F.col("_row"), F.col(column).alias("value")))
            ).alias("_tail")
        )
    )
    nothing = F.expr("array()").cast(tails.schema["_tail"].dataType)
    behind = [
        F.coalesce(F.lag("_tail", slices_back).over(across(keys)), nothing)
        for slices_back in range(most, 0, -1)
    ]
    carried = tails.select(GROUP, F.concat(*behind).alias("_earlier"))
    joined = join_slices(parts, carried)

    def value(k: int) -> Column:
        looked_up = F.try_element_at("_earlier", (F.col("_row") - k - 1).cast("int"))
        return F.when(F.col("_row") > k, F.col(f"_back_{k}")).otherwise(looked_up["value"])

    found = joined.withColumns({n: value(k) for n, k in zip(names, every, strict=True)})
    return found.drop("_row", "_rows", "_earlier", GROUP, *[f"_back_{k}" for k in every])


def carry_forward(bars: DataFrame, slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """Add ``carried_vwap``: the price of the bar, or the last price before it that was
    not 0, or yesterday's price when there was none."""
    price = F.nullif(F.col("vwap_price_per_sec"), F.lit(0.0))
    parts = sliced(bars, SYMBOL, slice_seconds)
    so_far = within().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = across(SYMBOL).rowsBetween(Window.unboundedPreceding, -1)
    closing = (
        parts.groupBy(GROUP)
        .agg(F.max_by(price, F.when(price.isNotNull(), F.col("start"))).alias("_closing"))
        .select(
            GROUP, F.last("_closing", ignorenulls=True).over(earlier).alias("_earlier")
        )
    )
    seen = parts.withColumn("_seen", F.last(price, ignorenulls=True).over(so_far))
    joined = join_slices(seen, closing)
    return joined.withColumn(
        "carried_vwap", F.coalesce("_seen", "_earlier", "yesterday_price")
    ).drop("_seen", "_earlier", GROUP)


def gap_fill(bars: DataFrame, slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """Add the bar a heartbeat would have made for every silent second between the
    first and the last bar of a symbol."""
    parts = sliced(bars, SYMBOL, slice_seconds).withColumn("_second", F.unix_seconds("start"))
    openings = (
        parts.groupBy(GROUP)
        .agg(F.min("_second").alias("_opening"))
        .select(GROUP, F.lead("_opening").over(across(SYMBOL)).alias("_later"))
    )
    following = parts.withColumn("_following", F.lead("_second").over(within()))
    joined = join_slices(following, openings)

    # From each bar up to the second before the next one.
    last = F.coalesce(F.col("_following") - 1, F.col("_later") - 1, F.col("_second"))
    return fill_seconds(joined, F.col("_second"), last, F.col("yesterday_price"), slice_seconds)


def fill_seconds(
    rows: DataFrame,
    first: Column,
    last: Column,
    yesterday: Column,
    slice_seconds: int = SLICE_SECONDS,
) -> DataFrame:
    """A row for each second from ``first`` to ``last``: the bar itself at its own
    ``_second``, and the bar of a heartbeat, with ``yesterday`` as price to compare
    with, at the others.

    The seconds are made slice by slice, and the slices of a silence are dealt out before, so a
    long silence is neither one long array nor the work of one task.
    """
    spans = rows.withColumns({"_first": first, "_last": last}).withColumn(
        "_span",
        F.explode(
            F.sequence(
                F.floor(F.col("_first") / slice_seconds), F.floor(F.col("_last") / slice_seconds)
            )
        ),
    ).repartition("symbol", "_span")
    begin = F.greatest(F.col("_first"), F.col("_span") * slice_seconds)
    end = F.least(F.col("_last"), F.col("_span") * slice_seconds + slice_seconds - 1)
    seconds = spans.withColumn("_at", F.explode(F.sequence(begin, end)))

    has_bar = F.col("_at") == F.col("_second")
    start = F.timestamp_seconds("_at")
    zero = F.lit(0)
    filler = {
        "last_data_time": F.lit(None),
        "real_data_count": zero,
        "filled_data_count": F.lit(1),
        "real_or_filled": trade_label(zero),
        "vwap_price_per_sec": zero,
        "size_per_sec": zero,
        "volume_till_now": zero,
        "yesterday_price": yesterday,
        "price_change_percentage": change_percent(F.lit(0.0), yesterday),
    }
    columns = {
        name: F.when(has_bar, F.col(name)).otherwise(value) for name, value in filler.items()
    }
    columns["type"] = F.lit(BAR_TYPE)
    columns["start"] = start
    columns["end"] = start + F.expr("interval 1 second")
    return seconds.select(*[columns.get(name, F.col(name)).alias(name) for name in BAR_COLUMNS])


def latest_bar(bars: DataFrame) -> DataFrame:
    """The newest bar of each symbol, from one hash aggregation; of bars of one start, such as one
    sent again with other values, the one with the greatest hash of its content.

    On a stream, use output mode ``update``; state is one row per symbol.
    """
    numbers = (
        "last_data_time", "real_data_count", "filled_data_count", "vwap_price_per_sec",
        "size_per_sec", "volume_till_now", "yesterday_price", "price_change_percentage",
    )
    # Start and hash in one number of fixed width keep Spark on hash aggregation.
    width = F.lit("20000000000000000000").cast("decimal(20,0)")
    start = F.unix_micros("start").cast("decimal(18,0)")
    order = (start * width).cast("decimal(38,0)") + F.xxhash64(*numbers).cast("decimal(19,0)")
    newest = bars.groupBy("symbol").agg(
        F.max("start").alias("start"), *[F.max_by(n, order.cast("decimal(38,0)")).alias(n) for n in numbers]
    )
    return newest.withColumn("real_or_filled", trade_label(F.col("real_data_count")))


def latest_price(bars: DataFrame) -> DataFrame:
    """The last price of each symbol that was not 0, with the time of its bar."""
    priced = bars.where("vwap_price_per_sec != 0")
    return priced.groupBy("symbol").agg(
        F.max("start").alias("start"),
        F.max_by("vwap_price_per_sec", "start").alias("vwap_price_per_sec"),
    )


def window_bounds(bars: DataFrame, seconds: int, slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """First and last bar of each window of ``seconds`` that slides by a second.

    Bars are shipped once, to their slice of time, and windows are made only there."""
    rows = bars.where("start is not null").selectExpr("symbol", "unix_seconds(start) AS second", "start AS _bar")
    per_second = dealt(rows, seconds - 1, slice_seconds).groupBy("symbol", "slice", "second").agg(
        F.min("_bar").alias("first"), F.max("_bar").alias("last")
    )
    own = {"first": (F.min("first"), 0), "last": (F.max("last"), seconds - 1)}
    starts = window_starts(per_second, seconds - 1, ["last"], slice_seconds, own)
    last = f"if(at = second, last, element_at(filter(ahead, b -> b.second < at + {seconds}), -1).last)"
    grouped = starts.select(
        "symbol", "at", F.col("first").alias("first_data_time"), F.expr(last).alias("last_data_time")
    )
    start = F.timestamp_seconds("at")
    end = F.timestamp_seconds(F.col("at") + seconds)
    return grouped.select("symbol", start.alias("start"), end.alias("end"), "first_data_time", "last_data_time")


def source_partitions(messages: DataFrame) -> DataFrame:
    return messages.select("partition").distinct()


def with_partition_symbol(
    messages: DataFrame, symbols: Mapping[int, str] | DataFrame, unknown: str
) -> DataFrame:
    """Add ``partition_symbol``, the symbol a source partition stands for.

    ``symbols`` is a map or a table (partition, symbol) with one row per partition. Its size is known
    to the planner, which broadcasts it if it is small and shuffles if it is not. On a stream a table
    is read as it was when the query started; ``streaming.jobs.start_per_batch`` reads it for each
    micro-batch.
    """
    spark: SparkSession = messages.sparkSession
    if isinstance(symbols, DataFrame):
        table = symbols.select(F.col("partition").alias("_partition"), F.col("symbol").alias("_symbol"))
    else:
        table = spark.createDataFrame(list(symbols.items()), "_partition int, _symbol string")
    joined = messages.join(table, F.col("partition") == F.col("_partition"), "left")
    return joined.withColumn("partition_symbol", F.coalesce("_symbol", F.lit(unknown))).drop(
        "_partition", "_symbol"
    )
