"""Column expressions shared by the batch and the streaming operators.

Everything here is a built-in Spark expression, so it stays inside
whole-stage code generation and works on a streaming DataFrame.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickbars.schemas import FILLED, HEARTBEAT, REAL

# First and last microsecond of the years 0001 to 9999, the range
# in which Spark's timestamp arithmetic is defined.
_MIN_MICROS = -62135596800000000
_MAX_MICROS = 253402300799999999


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator``, and 0 where the denominator is 0 or null."""
    return F.when(denominator != 0, numerator / denominator).otherwise(F.lit(0.0))


def rounded(value: Column, places: int | None) -> Column:
    """Round half up to ``places``; ``None`` leaves the value alone."""
    return value if places is None else F.round(value, places)


def is_trade() -> Column:
    """True for a trade, false for a heartbeat, null where ``type`` is null."""
    return F.col("type") != HEARTBEAT


def from_trade(value: Column) -> Column:
    """``value`` on a trade row and 0 on any other (an untyped row included)."""
    return F.when(is_trade(), value).otherwise(F.lit(0))


def vwap(notional: Column, size: Column) -> Column:
    return safe_ratio(notional, size)


def change_percent(price: Column, base: Column, places: int | None = 2) -> Column:
    """Change of ``price`` against ``base`` in percent; 0 without a base."""
    change = rounded((price - base) / base * 100, places)
    return F.when(base != 0, change).otherwise(F.lit(0.0))


def trade_label(real_count: Column) -> Column:
    return F.when(real_count > 0, REAL).otherwise(FILLED)


def to_long(text: Column) -> Column:
    """Whole number from text or a number; null when it is neither.

    Text with a fraction is cut, not refused, and text beyond bigint is null.
    """
    return F.coalesce(text.try_cast("bigint"), text.try_cast("double").try_cast("bigint"))


def micros_to_time(micros_text: Column) -> Column:
    """Timestamp from the text of epoch microseconds, without a trip through double.

    Malformed text, and numbers outside the years 0001 to 9999, give null.
    """
    micros = to_long(micros_text)
    return F.when(micros.between(_MIN_MICROS, _MAX_MICROS), F.timestamp_micros(micros))


def iso_to_millis(text: Column) -> Column:
    """Epoch milliseconds from ISO-8601 text; text without an offset is read in
    the session time zone, malformed text gives null."""
    return F.unix_millis(F.try_to_timestamp(text))


def millis_to_iso(millis: Column, zone: str | None = None) -> Column:
    """ISO-8601 local time of ``zone`` (session zone by default).

    A fraction is written, with six digits, only when there is one.
    """
    time = F.timestamp_millis(millis)
    if zone is not None:
        time = F.convert_timezone(F.current_timezone(), F.lit(zone), time)
    whole = F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss")
    return F.when(F.pmod(millis, F.lit(1000)) == 0, whole).otherwise(
        F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    )


def ntz_to_micros(ntz: Column) -> Column:
    """Epoch microseconds of a zone-less timestamp read as UTC, whatever the
    session time zone is."""
    local = F.convert_timezone(F.lit("UTC"), F.current_timezone(), ntz)
    return F.unix_micros(local.cast("timestamp"))


def in_calendar(time: Column) -> Column:
    """``time``, and null where it lies outside the years 0001 to 9999."""
    return F.when(F.unix_micros(time).between(_MIN_MICROS, _MAX_MICROS), time)


def arrival_order(size: str) -> Column:
    """One sortable number per tick of a window of ``size``: time, serial, content.

    All three are packed into a decimal because aggregation buffers of fixed width
    keep Spark on hash aggregation; a struct would make it sort every tick before
    the map-side aggregation. Of 38 digits the microsecond within the window has
    12, which is eleven days, the serial (any bigint, moved up to be positive) 20,
    and a hash of the content 6, so ticks of equal time and serial are told apart
    whatever order they arrive in. A serial that is no number counts as the
    hash of the content.
    """
    content = F.xxhash64("serial", "type", "price", "size", "volume", "yesterday_price", "isContinuous")
    length = F.unix_micros(F.expr(f"timestamp_seconds(0) + INTERVAL {size}"))
    within = F.pmod(F.unix_micros("time"), length).cast("decimal(12,0)")
    lowest = F.lit("9223372036854775808").cast("decimal(19,0)")
    serial = F.coalesce(F.col("serial").try_cast("bigint"), content).cast("decimal(19,0)") + lowest
    tie = F.pmod(content, F.lit(1_000_000)).cast("decimal(6,0)")
    high = within * F.lit("100000000000000000000").cast("decimal(21,0)") + serial
    return (high.cast("decimal(32,0)") * F.lit(1_000_000).cast("decimal(7,0)") + tie).cast("decimal(38,0)")
