"""Session settings and the shared folder for checkpoints and staged tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings of a streaming deployment: state on local disk with an incremental
# change log, so that state larger than the heap is no problem and a checkpoint
# costs only what changed.
STREAMING = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(
    app: str, zone: str = "UTC", streaming: bool = True, settings: dict[str, str] | None = None
) -> SparkSession:
    """A session for one of the jobs.

    Master, executors and ``spark.sql.shuffle.partitions`` come from the submit
    command. A streaming query keeps the partition count of its first start, so
    set it there to a small multiple of the cores the job will ever get.
    """
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", zone)
    for key, value in {**(STREAMING if streaming else {}), **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, reachable from every executor.

    Only a local session may go without that setting; it gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="tickbars-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new folder for one run inside the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` as a table in the shared folder, so that a plan which reads them more
    than once computes them once, and a lost executor costs a read only."""
    path = fresh_folder(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
