"""Streams that follow each symbol second by second: filled gaps, carried prices, averages.

A processor keeps the bars of a symbol until the watermark has passed their second and then takes
them one by one in the order of time, whatever order they came in. A timer per symbol, armed for the
next second that has something to give, does this also while the symbol is silent: the seconds of a
silence are filled, and windows closed, as the clock of the whole stream goes on, with no further
bar of that symbol.

State of a symbol is typed: a list with one row per second still open (or still in a window), and
one row of what is remembered of the seconds before. It holds the time that the watermark lags
behind and what a micro-batch spans, at most one row per second of it; nothing is kept as text and
nothing as a table. A symbol that is silent for ``quiet`` seconds is forgotten.

Bars of one second: of the same bar delivered again, or corrected, the one with the greater content
counts, so the result does not depend on the order; averages add up different bars of a second
unless ``once`` is set. A bar at or behind the watermark is dropped, as everywhere. A bar without
start falls out; bars without symbol are a symbol of their own.

These streams need the RocksDB state store (``session.STREAMING``).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tickbars.functions.columns import change_percent, trade_label
from tickbars.operators.bars import BAR_COLUMNS
from tickbars.operators.sma import MA_COLUMNS, MEASURES, average
from tickbars.schemas import BAR_TYPE, DURATIONS, MA_TYPE, ma_label

MILLIS = 1000
DAY = 86400


def _content(fields: tuple) -> tuple:
    """An order of rows in which a missing value comes first."""
    return tuple((value is not None, 0 if value is None else value) for value in fields)


class SecondBySecond(StatefulProcessor):
    """Hands the rows of a symbol to :meth:`passed` when the watermark has passed their second.

    Rows have ``symbol``, ``second`` and the columns of ``fields`` (as DDL).
    """

    fields = ""
    remembered = ""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.names = [field.split()[0] for field in self.fields.split(", ")]
        self.open = handle.getListState("open", f"second bigint, {self.fields}")
        self.memory = handle.getValueState("memory", f"passed bigint, timer bigint, {self.remembered}")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        passed, timer, *rest = self._memory()
        known = self._open()
        before = len(known)
        for row in rows:
            if row.second is not None and (passed is None or row.second > passed):
                fields = tuple(row[name] for name in self.names)
                known[row.second] = self.merged(known[row.second], fields) if row.second in known else fields
        if known:
            self._keep(known)
            first = min(s for s in known if passed is None or s > passed) if len(known) > before else None
            if first is not None and (timer is None or first < timer):
                self.handle.registerTimer(first * MILLIS)
                self.memory.update((passed, first, *rest))
        yield from ()

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        passed, timer, *rest = self._memory()
        now = timerValues.getCurrentWatermarkInMs() // MILLIS
        if passed is not None and passed >= now:
            return
        known = self._open()
        rest, known, timer = yield from self.passed(key[0], passed, now, rest, known)
        if known:
            self._keep(known)
        else:
            self.open.clear()
        if timer is None:
            self.memory.clear()
            return
        self.handle.registerTimer(timer * MILLIS)
        self.memory.update((now, timer, *rest))

    def _memory(self) -> tuple:
        return self.memory.get() or (None,) * (2 + len(self.remembered.split(", ")))

    def _open(self) -> dict[int, tuple]:
        return {row[0]: tuple(row[1:]) for row in self.open.get()}

    def _keep(self, known: dict[int, tuple]) -> None:
        self.open.put([(second, *known[second]) for second in sorted(known)])

    def merged(self, one: tuple, other: tuple) -> tuple:
        """What two rows of one second make."""
        return max(one, other, key=_content)

    def passed(self, symbol, passed, now, memory, known):
        """Give the rows of the seconds behind ``passed`` up to ``now``; return what to remember,
        the rows to keep, and the next second to be called for (none forgets the symbol)."""
        raise NotImplementedError

    def close(self) -> None:
        pass


# --- filled gaps and carried prices -------------------------------------------------------------

_FOLLOWED = (
    "start_us bigint, last_us bigint, real_data_count bigint, filled_data_count bigint, vwap double,"
    " size_per_sec bigint, volume_till_now bigint, base double, label string, change double"
)


class Follow(SecondBySecond):
    """Each bar with the price carried to it; with ``fill``, silent seconds as rows of their own, up
    to the second ``until``."""

    fields = _FOLLOWED
    remembered = "given bigint, bar bigint, base double, price double"
    output = f"symbol string, second bigint, is_bar boolean, {_FOLLOWED}, carried double"

    def __init__(self, fill: bool, quiet: int, until: int | None):
        self.fill, self.quiet, self.until = fill, quiet, until

    def _silence(self, symbol, first: int, last: int, base, price) -> Iterator[Row]:
        for second in range(first, last + 1):
            values = dict.fromkeys(self.names) | {"base": base}
            yield Row(symbol=symbol, second=second, is_bar=False, **values, carried=base if price is None else price)

    def passed(self, symbol, passed, now, memory, known):
        given, bar, base, price = memory
        for second in sorted(s for s in known if s <= now):
            fields = known.pop(second)
            if self.fill and given is not None:
                end = min(second - 1, bar + self.quiet)
                yield from self._silence(symbol, given + 1, end if self.until is None else min(end, self.until), base, price)
            if bar is not None and second - bar > self.quiet:
                price = None
            values = dict(zip(self.names, fields, strict=True))
            given = bar = second
            base = values["base"]
            price = values["vwap"] or price
            yield Row(symbol=symbol, second=second, is_bar=True, **values, carried=base if price is None else price)
        following = min(known, default=None)
        if bar is None or now >= bar + self.quiet:
            forgotten = bar is not None
            if self.fill and forgotten:
                end = bar + self.quiet
                yield from self._silence(symbol, given + 1, end if self.until is None else min(end, self.until), base, price)
            return (None, None, None, None), known, following
        timer = bar + self.quiet
        if self.fill:
            last = now if self.until is None else min(now, self.until)
            yield from self._silence(symbol, given + 1, last, base, price)
            given = max(given, last)
            if self.until is None or given < self.until:
                timer = now + 1
        return (given, bar, base, price), known, timer if following is None else min(timer, following)


def followed(
    bars: DataFrame, watermark: str | None, fill: bool, quiet: int = DAY, until: int | None = None
) -> DataFrame:
    """The bars of a stream in the order of time, with ``carried_vwap``: the price of the bar, else the
    last one before it that was not 0, else yesterday's. With ``fill`` the silent seconds between
    them, too, as heartbeats would have made them, each as soon as the watermark passes it."""
    if watermark is not None:
        bars = bars.withWatermark("start", watermark)
    slim = bars.select(
        "symbol", "start",
        F.unix_seconds("start").alias("second"),
        F.unix_micros("start").alias("start_us"),
        F.unix_micros("last_data_time").alias("last_us"),
        "real_data_count", "filled_data_count",
        F.col("vwap_price_per_sec").alias("vwap"),
        "size_per_sec", "volume_till_now",
        F.col("yesterday_price").alias("base"),
        F.col("real_or_filled").alias("label"),
        F.col("price_change_percentage").alias("change"),
    )
    processor = Follow(fill, quiet, until)
    rows = slim.groupBy("symbol").transformWithState(processor, processor.output, "append", "eventTime")
    zero = F.lit(0).cast("bigint")
    start = F.when(F.col("is_bar"), F.timestamp_micros("start_us")).otherwise(F.timestamp_seconds("second"))

    def or_filler(bar: str, filler: Column) -> Column:
        return F.when(F.col("is_bar"), F.col(bar)).otherwise(filler)

    columns = {
        "symbol": F.col("symbol"),
        "type": F.lit(BAR_TYPE),
        "start": start,
        "end": start + F.expr("interval 1 second"),
        "last_data_time": F.timestamp_micros("last_us"),
        "real_data_count": or_filler("real_data_count", zero),
        "filled_data_count": or_filler("filled_data_count", F.lit(1).cast("bigint")),
        "real_or_filled": or_filler("label", trade_label(zero)),
        "vwap_price_per_sec": or_filler("vwap", F.lit(0.0)),
        "size_per_sec": or_filler("size_per_sec", zero),
        "volume_till_now": or_filler("volume_till_now", zero),
        "yesterday_price": F.col("base"),
        "price_change_percentage": or_filler("change", change_percent(F.lit(0.0), F.col("base"))),
        "carried_vwap": F.col("carried"),
    }
    return rows.select(*[columns[name].alias(name) for name in (*BAR_COLUMNS, "carried_vwap")])


def filled(bars: DataFrame, watermark: str | None = None, **options) -> DataFrame:
    return followed(bars, watermark, True, **options).select(*BAR_COLUMNS)


def carried(bars: DataFrame, watermark: str | None = None, **options) -> DataFrame:
    return followed(bars, watermark, False, **options)


# --- averages -----------------------------------------------------------------------------------

_SUMS = "sum_of_vwap double, count_of_vwap bigint, window_data_count bigint, real_data_count bigint, filled_data_count bigint"


def _added(one: tuple, other: tuple) -> tuple:
    return tuple(b if a is None else a if b is None else a + b for a, b in zip(one, other, strict=True))


class Lines(SecondBySecond):
    """The sums of each window when the watermark passes its last second, from one row per second."""

    fields = _SUMS
    remembered = "nothing boolean"
    output = f"symbol string, seconds int, at bigint, {_SUMS}"

    def __init__(self, durations: Sequence[int], once: bool):
        self.durations, self.once = sorted(durations), once

    def merged(self, one: tuple, other: tuple) -> tuple:
        return super().merged(one, other) if self.once else _added(one, other)

    def passed(self, symbol, passed, now, memory, known):
        reach = self.durations[-1] - 1
        seconds = sorted(known)
        for place, second in enumerate(seconds):
            if second > now:
                break
            last = min(now, second + reach, seconds[place + 1] - 1 if place + 1 < len(seconds) else now)
            first = second if passed is None else max(second, passed + 1)
            for end in range(first, last + 1):
                for duration in self.durations:
                    if second > end - duration:
                        low = place
                        while low and seconds[low - 1] > end - duration:
                            low -= 1
                        sums = known[seconds[low]]
                        for between in seconds[low + 1 : place + 1]:
                            sums = _added(sums, known[between])
                        yield Row(symbol=symbol, seconds=duration, at=end - duration + 1, **dict(zip(self.names, sums, strict=True)))
        kept = {s: known[s] for s in seconds if s > now - reach}
        first = min(kept, default=None)
        return (None,), kept, None if first is None else max(first, now + 1)


def lines(
    bars: DataFrame,
    durations: Sequence[int] = DURATIONS,
    watermark: str | None = None,
    round_to: int | None = 2,
    once: bool = False,
) -> DataFrame:
    """The rows of ``sma`` for each duration, from one source and one state of a row per second: a
    window leaves when the watermark passes its last second, the short ones before the long ones."""
    if watermark is not None:
        bars = bars.withWatermark("start", watermark)
    slim = bars.selectExpr("symbol", "start", "unix_seconds(start) AS second", *[f"{value} AS {name}" for name, value in MEASURES.items()])
    processor = Lines(durations, once)
    rows = slim.groupBy("symbol").transformWithState(processor, processor.output, "append", "eventTime")
    label = F.lit(None).cast("string")
    for seconds in durations:
        label = F.when(F.col("seconds") == seconds, ma_label(seconds)).otherwise(label)
    start = F.timestamp_seconds("at")
    columns = {
        "type": F.lit(MA_TYPE),
        "MA_type": label,
        "start": start,
        "end": F.timestamp_seconds(F.col("at") + F.col("seconds")),
        "sma_value": F.expr(average("sum_of_vwap", "count_of_vwap", round_to)),
    }
    return rows.select(*[columns.get(name, F.col(name)).alias(name) for name in MA_COLUMNS])
