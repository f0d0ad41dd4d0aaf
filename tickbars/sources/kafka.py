"""Kafka as a source of messages.

The connector is a separate package of Spark
(``org.apache.spark:spark-sql-kafka-0-10``) and has to be on the class path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def source_options(
    servers: str,
    topic: str,
    starting: str = "latest",
    max_per_trigger: int | None = None,
    fail_on_data_loss: bool = True,
    group_id: str | None = None,
    extra: dict[str, str] | None = None,
) -> dict[str, str]:
    """``starting`` is where a query without a checkpoint begins: ``latest``,
    ``earliest`` or offsets as JSON. ``max_per_trigger`` bounds one micro-batch."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    if group_id is not None:
        options["kafka.group.id"] = group_id
    return {**options, **(extra or {})}


def stream_messages(spark: SparkSession, **source: object) -> DataFrame:
    return spark.readStream.format("kafka").options(**source_options(**source)).load()


def read_messages(spark: SparkSession, **source: object) -> DataFrame:
    """The messages in a topic right now, as a batch."""
    options = source_options(**{"starting": "earliest", **source})
    return spark.read.format("kafka").options(**options).load()
