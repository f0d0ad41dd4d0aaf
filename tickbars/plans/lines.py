"""Moving-average lines of large tables, with one shuffle for all durations.

A sliding window over bars that lie scattered over the partitions copies every
bar once per window it is in, and ships nearly all of these copies. Here each
bar is shipped once (plus a narrow overlap): time is cut into slices, whole
(symbol, slice) groups meet in one task, sorted by time, and each window is made
there from its first bar and those that follow, without another shuffle and without
a table of windows in memory. A slice holds at most
``slice_seconds`` bars of one symbol, so the group size does not grow with the
table, and a symbol that holds a third of all bars is spread over its slices.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickbars.operators.slices import SLICE_SECONDS, dealt, window_starts
from tickbars.operators.sma import MEASURES, unfold
from tickbars.schemas import DURATIONS


def _sums(seconds: int) -> str:
    """Sums of the bars in the window of ``seconds`` from ``at``, in time order: those of the frame if it
    starts at a bar, otherwise of the bars ``ahead``."""
    types = {name: "DOUBLE" if name == "sum_of_vwap" else "BIGINT" for name in MEASURES}
    zero = ", ".join(f"CAST(NULL AS {of}) AS {name}" for name, of in types.items())
    more = ", ".join(
        f"if(b.{name} IS NULL, a.{name}, coalesce(a.{name}, CAST(0 AS {of})) + b.{name}) AS {name}"
        for name, of in types.items()
    )
    within = f"filter(ahead, b -> b.second < at + {seconds})"
    frame = ", ".join(f"{name}_{seconds} AS {name}" for name in MEASURES)
    return f"if(at = second, struct({frame}), aggregate({within}, struct({zero}), (a, b) -> struct({more})))"


def sma_lines(
    bars: DataFrame,
    durations: Sequence[int] = DURATIONS,
    round_to: int | None = 2,
    one_bar_per_second: bool = False,
    slice_seconds: int = SLICE_SECONDS,
) -> DataFrame:
    """The rows of ``sma`` for each duration, for a batch of bars.

    ``one_bar_per_second`` says that (symbol, second) is unique, which holds for
    the result of ``bars``; otherwise rows of the same second are added up within their slice.
    """
    durations = sorted(durations)
    reach = durations[-1] - 1
    values = [f"{value} AS {name}" for name, value in MEASURES.items()]
    per_second = bars.selectExpr("symbol", "unix_seconds(start) AS second", *values)

    sliced = dealt(per_second, reach, slice_seconds)
    if not one_bar_per_second:
        # Rows of one second meet in their slice; adding them up needs no further shuffle.
        sums = [F.sum(name).alias(name) for name in MEASURES]
        sliced = sliced.groupBy("symbol", "slice", "second").agg(*sums)
    # Windows that start at a bar, as nearly all do where bars are dense, are summed by frames.
    own = {
        f"{name}_{seconds}": (F.sum(name), seconds - 1) for seconds in durations for name in MEASURES
    }
    starts = window_starts(sliced, reach, list(MEASURES), slice_seconds, own)
    windows = starts.select(
        "symbol", "at", *[F.expr(_sums(seconds)).alias(f"_{seconds}") for seconds in durations]
    ).select(
        "symbol", "at",
        *[F.col(f"_{seconds}")[name].alias(f"{name}_{seconds}") for seconds in durations for name in MEASURES],
    )
    return unfold(windows, durations, "timestamp_seconds(at)", round_to)
