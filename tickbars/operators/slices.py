"""Ordered computations per symbol, cut into slices of time.

A window over all bars of a symbol puts them into one task, however many there
are. These helpers order rows inside (symbol, slice) groups only, whose size is
bounded by the slice length, and carry what the earlier slices leave behind in a
table with one row per slice.

The group is one struct column, used to partition windows, to aggregate and to join. A struct equals
itself where a key in it is null, so the join keeps null keys and still finds the rows partitioned
and sorted as the window before it left them: the whole table is shuffled and sorted once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

SLICE_SECONDS = 600
SLICE = "_slice"
GROUP = "_group"


def sliced(
    rows: DataFrame, keys: Sequence[str], slice_seconds: int = SLICE_SECONDS
) -> DataFrame:
    """Add the group of each row: its keys and the number of the slice of time that ``start`` is in."""
    number = F.floor(F.unix_seconds("start") / slice_seconds).alias(SLICE)
    return rows.withColumn(GROUP, F.struct(*keys, number))


def within() -> WindowSpec:
    return Window.partitionBy(GROUP).orderBy("start")


def across(keys: Sequence[str]) -> WindowSpec:
    """Over the slice table: one row per slice, so it may be ordered per key."""
    key = F.struct(*[F.col(GROUP)[name].alias(name) for name in keys])
    return Window.partitionBy(key).orderBy(F.col(GROUP)[SLICE])


def join_slices(rows: DataFrame, slices: DataFrame) -> DataFrame:
    """Give each row the columns of its slice."""
    return rows.join(slices, GROUP, "left")


def dealt(rows: DataFrame, reach: int, slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """Rows (symbol, second, ...) dealt out by (symbol, ``slice``), each shipped once: a window belongs
    to the slice its start is in, so a row goes to its own slice and, in the first ``reach`` seconds
    of it, to the one before as well."""
    return rows.selectExpr(
        "*",
        f"explode(sequence(floor((second - {reach}) / {slice_seconds}),"
        f" floor(second / {slice_seconds}))) AS slice",
    ).repartition("symbol", "slice")


def window_starts(
    rows: DataFrame,
    reach: int,
    values: Sequence[str],
    slice_seconds: int = SLICE_SECONDS,
    own: Mapping[str, tuple[Column, int]] | None = None,
) -> DataFrame:
    """A row (symbol, second, at, ahead) for each start ``at``, within its slice, of a window that a row
    of ``dealt`` is in; ``ahead`` has the second and the ``values`` of all rows of the window, in time
    order. ``own`` adds aggregates of the rows up to so many seconds after the ``second`` of the row that
    gives the start, for the window that starts there.

    Rows are sorted once and each start is given by the first row at or after it, so a task keeps the
    rows of one window only, not a table of all its windows."""
    group = Window.partitionBy("symbol", "slice").orderBy("second")
    ahead = F.collect_list(F.struct("second", *values)).over(group.rangeBetween(0, reach))
    own = {name: value.over(group.rangeBetween(0, upto)) for name, (value, upto) in (own or {}).items()}
    rows = rows.select(
        "symbol", "slice", "second", F.lag("second").over(group).alias("before"), ahead.alias("ahead"),
        *[value.alias(name) for name, value in own.items()],
    )
    # The comparison skips a null: the first row of a group has no row before it.
    first = f"greatest(second - {reach}, slice * {slice_seconds}, before + 1)"
    last = f"least(second, slice * {slice_seconds} + {slice_seconds - 1})"
    return rows.where(f"{first} <= {last}").selectExpr(
        "symbol", "second", f"explode(sequence({first}, {last})) AS at", "ahead", *own
    )
