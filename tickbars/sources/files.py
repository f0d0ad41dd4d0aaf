"""Files as a source of messages: the envelope of a topic without the broker."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tickbars.schemas import ENVELOPE, LINES


def _schema(file_format: str) -> T.StructType:
    return LINES if file_format == "text" else ENVELOPE


def stream_messages(
    spark: SparkSession,
    path: str,
    file_format: str = "parquet",
    max_files_per_trigger: int | None = None,
    extra: dict[str, str] | None = None,
) -> DataFrame:
    """Messages from files as they arrive: ``parquet``, ``orc`` or ``json`` files with
    key, value and timestamp, or ``text`` with one message per line."""
    reader = spark.readStream.format(file_format).schema(_schema(file_format))
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.options(**(extra or {})).load(path)


def read_messages(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    return spark.read.format(file_format).schema(_schema(file_format)).load(path)
