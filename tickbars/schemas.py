"""Message schemas and the fixed names that appear in the messages.

All fields are nullable. Counts, sizes and volumes are ``bigint`` so that a
day's volume above 2**31 survives the trip through JSON.
"""

from pyspark.sql import types as T

# They are part of the message formats.
HEARTBEAT = "heartbeat"
BAR_TYPE = "per_sec_data"
MA_TYPE = "MA_data"
REAL = "real"
FILLED = "filled"
DURATIONS = (5, 10, 15)


def ma_label(seconds: int) -> str:
    return f"{seconds}_MA_data"


# The fields of the messages on the wire.
TICK = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("exchange", T.StringType()),
        T.StructField("market", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("size", T.LongType()),
        T.StructField("bid", T.DoubleType()),
        T.StructField("ask", T.DoubleType()),
        T.StructField("volume", T.LongType()),
        T.StructField("isContinuous", T.BooleanType()),
        T.StructField("time", T.StringType()),
        T.StructField("serial", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("channel", T.StringType()),
        T.StructField("yesterday_price", T.DoubleType()),
    ]
)

BAR = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("start", T.TimestampType()),
        T.StructField("end", T.TimestampType()),
        T.StructField("current_time", T.TimestampType()),
        T.StructField("last_data_time", T.TimestampType()),
        T.StructField("real_data_count", T.LongType()),
        T.StructField("filled_data_count", T.LongType()),
        T.StructField("real_or_filled", T.StringType()),
        T.StructField("vwap_price_per_sec", T.DoubleType()),
        T.StructField("size_per_sec", T.LongType()),
        T.StructField("volume_till_now", T.LongType()),
        T.StructField("yesterday_price", T.DoubleType()),
        T.StructField("price_change_percentage", T.DoubleType()),
    ]
)

MA = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("MA_type", T.StringType()),
        T.StructField("start", T.TimestampType()),
        T.StructField("end", T.TimestampType()),
        T.StructField("current_time", T.TimestampType()),
        T.StructField("sma_value", T.DoubleType()),
        T.StructField("sum_of_vwap", T.DoubleType()),
        T.StructField("count_of_vwap", T.LongType()),
        T.StructField("window_data_count", T.LongType()),
        T.StructField("real_data_count", T.LongType()),
        T.StructField("filled_data_count", T.LongType()),
    ]
)

# What a message source delivers; Kafka adds topic, offset and timestampType.
ENVELOPE = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)
LINES = T.StructType([T.StructField("value", T.StringType())])
