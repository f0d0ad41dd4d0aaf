"""Hand-made ticks."""

import json

BASE = 1704067200  # 2024-01-01T00:00:00Z


def tick(second, symbol="A", micro=0, kind="trade", **fields):
    base = {
        "symbol": symbol, "type": kind, "price": 10.0, "size": 1, "volume": 100,
        "time": str((BASE + second) * 1_000_000 + micro), "serial": "1",
        "yesterday_price": 100.0,
    }
    return {k: v for k, v in {**base, **fields}.items() if v is not None}


def messages(spark, ticks):
    rows = [(t.get("symbol"), json.dumps(t)) if isinstance(t, dict) else (None, t) for t in ticks]
    return spark.createDataFrame(rows, "key string, value string")


def write_messages(spark, ticks, folder):
    """One more file of messages in a folder, as a topic would get one more batch."""
    from pyspark.sql import functions as F

    stamped = messages(spark, ticks).withColumn("timestamp", F.timestamp_seconds(F.lit(BASE)))
    stamped.coalesce(1).write.mode("append").parquet(str(folder))
