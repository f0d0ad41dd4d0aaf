"""The registered queries as SQL over the same tables, for comparison."""

from __future__ import annotations

B = 1704067200000000


def _ticks(symbols: int | None = 5) -> str:
    number = "user_id" if symbols is None else f"(user_id % {symbols})"
    return f"""
    ticks AS (
      SELECT event_id, event_type, 'S' || {number} AS symbol,
             CASE WHEN event_type = 'error' THEN 'heartbeat' ELSE 'trade' END AS type,
             value AS price, CAST(json_extract_string(props, '$.k') AS BIGINT) AS size,
             event_id AS volume, event_type <> 'signup' AS flag,
             {B} + ((epoch_us(ts) - {B}) // 3600) AS time_us,
             CAST(40 + {number} AS DOUBLE) AS yesterday_price
      FROM events)"""


def _bars(source: str = "ticks") -> str:
    return f"""
    sums AS (
      SELECT symbol, time_us // 1000000 AS sec,
             SUM(CASE WHEN type <> 'heartbeat' THEN price * size ELSE 0 END ORDER BY event_id)
               AS notional,
             CAST(SUM(CASE WHEN type <> 'heartbeat' THEN size ELSE 0 END) AS BIGINT)
               AS size_per_sec,
             arg_max_null(CASE WHEN type <> 'heartbeat' THEN volume ELSE 0 END,
                          (time_us, event_id)) AS volume_till_now,
             arg_max(volume, (time_us, event_id)) FILTER (WHERE type <> 'heartbeat')
               AS volume_of_last_trade,
             arg_max(yesterday_price, (time_us, event_id)) AS yesterday_price,
             arg_max(flag, (time_us, event_id)) AS flag,
             MAX(time_us) AS last_us,
             COUNT(*) FILTER (WHERE type <> 'heartbeat') AS real_data_count,
             COUNT(*) FILTER (WHERE type = 'heartbeat') AS filled_data_count
      FROM {source} GROUP BY ALL),
    bars AS (
      SELECT *, CASE WHEN size_per_sec <> 0 THEN notional / size_per_sec ELSE 0 END AS vwap,
             CASE WHEN real_data_count > 0 THEN 'real' ELSE 'filled' END AS label
      FROM sums)"""


def _windows(durations: tuple[int, ...]) -> str:
    parts = " UNION ALL ".join(
        f"SELECT bars.*, {d} AS d, sec - k AS st FROM bars, range({d}) r(k)" for d in durations
    )
    return f"""
    expanded AS ({parts}),
    windows AS (
      SELECT symbol, d, st,
             SUM(CASE WHEN size_per_sec <> 0 THEN vwap ELSE 0 END ORDER BY sec) AS s,
             COUNT(*) FILTER (WHERE size_per_sec <> 0) AS c,
             COUNT(*) AS n,
             COUNT(*) FILTER (WHERE label = 'real') AS r,
             COUNT(*) FILTER (WHERE label = 'filled') AS f,
             MIN(sec) AS first_sec, MAX(sec) AS last_sec
      FROM expanded GROUP BY symbol, d, st)"""


_LINE = """
    SELECT symbol, 'MA_data' AS type, d || '_MA_data' AS "MA_type", st AS start_s,
           st + d AS end_s, ROUND(CASE WHEN c <> 0 THEN s / c ELSE 0 END, 6) AS sma_value,
           ROUND(s, 6) AS sum_of_vwap, c AS count_of_vwap, n AS window_data_count,
           r AS real_data_count, f AS filled_data_count
    FROM windows"""


def _with(*parts: str) -> str:
    return "WITH" + ",".join(parts)


def _line(durations: tuple[int, ...], symbols: int | None = 5, where: str = "") -> str:
    return _with(_ticks(symbols), _bars(), _windows(durations)) + _LINE + where


def _bar(select: str, symbols: int | None = 5) -> str:
    return _with(_ticks(symbols), _bars()) + f" SELECT {select} FROM bars"


def _watermark(source: str) -> str:
    """Microseconds below which a stream that has seen ``source`` is complete."""
    return f"((SELECT MAX(time_us) FROM {source}) // 1000 - 30000) * 1000"


_BAR_FIELDS = """symbol, 'per_sec_data' AS type, sec AS start_s, real_data_count,
    filled_data_count, label AS real_or_filled, ROUND(vwap, 6) AS vwap_price_per_sec,
    size_per_sec"""


def _two_places(value: str) -> str:
    """Two places, halves up on the decimal digits of the number."""
    digits = f"CAST(CAST({value} AS VARCHAR) AS DECIMAL(38, 20))"
    return f"CAST(ROUND({digits}, 2) AS DOUBLE)"


_CHANGE = _two_places("(vwap - yesterday_price) / yesterday_price * 100")


def _all() -> dict[str, str]:
    sql = {
        "decode_ticks": _with(_ticks())
        + """ SELECT symbol, type, price, size, volume, flag AS "isContinuous",
              CAST(time_us AS VARCHAR) AS time, CAST(event_id AS VARCHAR) AS serial,
              yesterday_price FROM ticks""",
        "event_time": _with(_ticks())
        + " SELECT CAST(event_id AS VARCHAR) AS serial, time_us FROM ticks",
        "event_time_iso": """
          SELECT event_id, epoch_us(ts) // 1000 AS ms,
                 CASE WHEN epoch_us(ts) // 1000 % 1000 = 0
                      THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
                      ELSE strftime(date_trunc('millisecond', ts), '%Y-%m-%dT%H:%M:%S.%f')
                 END AS iso
          FROM events""",
        "encode_kv": _bar(f"symbol AS key, {_BAR_FIELDS}"),
        "decode_bars": _bar(
            f"""{_BAR_FIELDS}, sec + 1 AS end_s, volume_till_now, yesterday_price,
            {_CHANGE} AS price_change_percentage"""
        ),
        "bars_1s": _bar(
            f"""{_BAR_FIELDS}, sec + 1 AS end_s, last_us AS last_data_time_us,
            volume_till_now, yesterday_price"""
        ),
        "bar_counts": _bar("symbol, sec AS start_s, real_data_count, filled_data_count"),
        "vwap_1s": _bar(
            "symbol, sec AS start_s, ROUND(vwap, 6) AS vwap_price_per_sec, size_per_sec"
        ),
        "volume_till_now": _bar("symbol, sec AS start_s, volume_till_now, yesterday_price"),
        "volume_of_last_trade": _bar(
            "symbol, sec AS start_s, volume_of_last_trade AS volume_till_now"
        ),
        "price_change": _bar(
            f"symbol, sec AS start_s, {_CHANGE} AS price_change_percentage"
        ),
        "real_or_filled": _bar("symbol, sec AS start_s, label AS real_or_filled"),
        "last_flag": _bar("symbol, sec AS start_s, flag AS is_continuous"),
        "bars_sorted": _bar("symbol, sec AS start_s, size_per_sec") + " ORDER BY 2, 1",
        "sma_5": _line((5,)),
        "sma_10": _line((10,)),
        "sma_15": _line((15,)),
        "sma_all": _line((5, 10, 15)),
        "sma_5_windowed": _line((5,)),
        "sma_all_windowed": _line((5, 10, 15)),
        "sma_all_by_user": _line((5, 10, 15), symbols=None),
        "sma_5_defaults": _line((5,)),
        "sma_merge": _line((5,)),
    }
    sql["bars_from_messages"] = sql["bars_1s"]
    sql["sma_5_rounded"] = (
        _with(_ticks(), _bars(), _windows((5,)))
        + f"""
        SELECT symbol, st AS start_s,
               CASE WHEN c <> 0 THEN {_two_places("s / c")} ELSE 0 END AS sma_value
        FROM windows"""
    )
    # Bars without a label are in neither count.
    sql["sma_5_counts"] = f"""
        SELECT * REPLACE (CAST(0 AS BIGINT) AS filled_data_count) FROM ({_line((5,))})"""
    sql["window_rank"] = (
        _with(_ticks(), _bars(), _windows((5,)))
        + """
        SELECT symbol, st AS start_s,
               ROW_NUMBER() OVER (PARTITION BY symbol ORDER BY st) AS rank
        FROM windows"""
    )
    sql["window_bounds"] = (
        _with(_ticks(), _bars(), _windows((5,)))
        + """
        SELECT symbol, st AS start_s, first_sec AS first_data_time_s,
               last_sec AS last_data_time_s
        FROM windows"""
    )
    sql["prev_vwap"] = _bar(
        """symbol, sec AS start_s, ROUND(LAG(vwap, 1) OVER w, 6) AS prev_1,
        ROUND(LAG(vwap, 2) OVER w, 6) AS prev_2"""
    ) + " WINDOW w AS (PARTITION BY symbol ORDER BY sec)"
    sql["carry_forward"] = _bar(
        """symbol, sec AS start_s, ROUND(COALESCE(
             LAST_VALUE(NULLIF(vwap, 0) IGNORE NULLS) OVER (
               PARTITION BY symbol ORDER BY sec ROWS UNBOUNDED PRECEDING),
             yesterday_price), 6) AS carried_vwap"""
    )
    sql["gap_fill"] = (
        _with(_ticks(None), _bars())
        + """,
        spans AS (SELECT symbol, MIN(sec) AS a, MAX(sec) AS b, MIN(yesterday_price) AS y
                  FROM bars GROUP BY symbol),
        seconds AS (SELECT symbol, y, UNNEST(range(a, b + 1)) AS sec FROM spans)
        SELECT s.symbol, s.sec AS start_s, s.sec + 1 AS end_s,
               COALESCE(real_data_count, 0) AS real_data_count,
               COALESCE(filled_data_count, 1) AS filled_data_count,
               COALESCE(label, 'filled') AS real_or_filled,
               ROUND(COALESCE(vwap, 0), 6) AS vwap_price_per_sec,
               COALESCE(size_per_sec, 0) AS size_per_sec,
               COALESCE(volume_till_now, 0) AS volume_till_now,
               y AS yesterday_price
        FROM seconds s LEFT JOIN bars b ON s.symbol = b.symbol AND s.sec = b.sec"""
    )
    newest = "QUALIFY ROW_NUMBER() OVER (PARTITION BY symbol ORDER BY sec DESC) = 1"
    sql["latest_bar"] = _bar(
        """symbol, sec AS start_s, last_us AS last_data_time_us, label AS real_or_filled,
        real_data_count, filled_data_count, ROUND(vwap, 6) AS vwap_price_per_sec,
        size_per_sec, volume_till_now, yesterday_price"""
    ) + f" {newest}"
    sql["latest_vwap"] = _bar(
        "symbol, sec AS start_s, ROUND(vwap, 6) AS vwap_price_per_sec"
    ) + f" WHERE vwap <> 0 {newest}"
    sql["partition_symbol"] = """
        SELECT CAST(user_id % 7 AS INTEGER) AS partition,
               CASE WHEN user_id % 7 < 5 THEN 'S' || (user_id % 7) ELSE 'none' END
                 AS partition_symbol,
               COUNT(*) AS ticks
        FROM events GROUP BY 1, 2"""
    sql["source_partitions"] = """
        SELECT DISTINCT CAST(user_id % 7 AS INTEGER) AS partition FROM events"""

    # A stream that was run to its end has written every window.
    sql["stream_bars"] = _bar(
        """symbol, sec AS start_s, size_per_sec, volume_till_now, real_data_count,
        filled_data_count, ROUND(vwap, 6) AS vwap_price_per_sec"""
    )
    sql["stream_sma"] = _line((5,))
    sql["stream_chained"] = sql["stream_sma_each"] = _line((5, 10, 15))
    on_time = _watermark("ticks WHERE event_type <> 'view'")
    sql["stream_late"] = (
        _with(
            _ticks(),
            f"""
    kept AS (
      SELECT * FROM ticks
      WHERE event_type <> 'view' OR (time_us // 1000000 + 1) * 1000000 > {on_time})""",
            _bars("kept"),
        )
        + """
        SELECT symbol, sec AS start_s, size_per_sec, real_data_count, filled_data_count
        FROM bars"""
    )
    # Two sizes of 2^63 - 1 in a second of their own: their sum is no bigint.
    sql["bars_with_bad_messages"] = f"""
        SELECT *, FALSE AS size_overflow FROM ({sql["stream_bars"]})
        UNION ALL SELECT 'BAD', {B // 1000000}, 0, 0, 2, 0, 0.0, TRUE"""
    sql["stream_lines"] = sql["stream_sma_parts"] = sql["sma_all"]
    sql["stream_sma_redelivered"] = sql["sma_5"]
    sql["stream_carry_forward"] = sql["carry_forward"]
    # Every symbol up to the newest second of all of them.
    sql["stream_gap_fill"] = (
        sql["gap_fill"]
        .replace(_ticks(None), _ticks())
        .replace("MAX(sec) AS b,", "(SELECT MAX(sec) FROM bars) AS b,")
    )
    sql["stream_latest_bar"] = sql["latest_bar"].replace(
        "last_us AS last_data_time_us", "last_us // 1000 AS last_data_time_ms"
    )
    sql["stream_to_both"] = (
        _with(_ticks(), _bars())
        + """
        SELECT output, symbol, sec AS start_s, size_per_sec, real_data_count, filled_data_count,
               ROUND(vwap, 6) AS vwap_price_per_sec
        FROM bars, (VALUES ('table'), ('messages')) outputs(output)"""
    )
    sql["stream_partition_symbol"] = sql["partition_symbol"]
    sql["rejected_messages"] = """
        SELECT event_id, CASE event_id % 50 WHEN 0 THEN 'not json' WHEN 1 THEN 'wrong type: size'
               WHEN 2 THEN 'no time' WHEN 3 THEN 'no such time' WHEN 4 THEN 'no symbol'
               ELSE 'ahead of time' END AS reason
        FROM events WHERE event_id % 50 < 6"""
    return sql


ORACLE_SQL: dict[str, str] = _all()
