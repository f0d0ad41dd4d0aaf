"""What the operators of this package share: tables in, stages out to the shared folder."""

from __future__ import annotations

import contextlib
import gc
import tempfile
import zipfile
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickbars.session import fresh_folder

# Fixed value: every fifth document is held out of all learning.
FOLDS = 5


#: Rows of an Arrow batch, where the session has Spark's own 10000: texts are long, and a task holds
#: a batch several times over.
BATCH_ROWS = 1000


def shipped(spark: SparkSession) -> None:
    """Make a session ready for this package's tasks: batches of a size fit for texts, and, once for
    each application, the package on the executors, as ``--py-files`` does it."""
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(batch) == "10000":
        spark.conf.set(batch, str(BATCH_ROWS))
    context = spark.sparkContext
    if getattr(context, "_tickbars_shipped", False):
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="tickbars-")) / "tickbars_package.zip"
    with zipfile.ZipFile(archive, "w") as files:
        for source in sorted(package.rglob("*.py")):
            files.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._tickbars_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    shipped(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(rows: DataFrame, name: str, **options: str) -> DataFrame:
    """``rows`` written once into the shared folder, with options of the writer: later readings cost a
    scan, their size is known to the planner, and a lost executor loses nothing."""
    path = fresh_folder(rows.sparkSession, name)
    rows.write.options(**options).parquet(path)
    read = rows.sparkSession.read.schema(rows.schema).parquet(path)
    read._tickbars_folder = path
    return read


def free(name: str, columns: list[str]) -> str:
    """``name``, or with as many underscores before it as it takes to be none of ``columns``."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def held_out(doc_id: Column) -> Column:
    """The documents that nothing may be learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def deleted(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # what stays is only space
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def removed(*tables: DataFrame) -> None:
    """Delete tables that :func:`staged` wrote and nothing will read again; never any other."""
    for rows in tables:
        path = getattr(rows, "_tickbars_folder", None)
        if path:
            deleted(rows.sparkSession, path)


def settled(spark: SparkSession) -> None:
    """Let go of the shuffle files of plans that are done: Spark deletes them when the driver collects
    its garbage, which a driver with memory to spare puts off for up to half an hour."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


BIT_FIELD = 24


def bit_field(rows: DataFrame, name: str) -> np.ndarray:
    """2^BIT_FIELD bits, set for the remainders of the long column ``name``: a first test of fixed
    size for whether a number may be among the rows; others pass it too."""
    cell = F.col(name).bitwiseAND(F.lit((1 << BIT_FIELD) - 1))
    bit = F.expr(f"shiftleft(1L, cast({name} & 63 as int))")
    words = rows.groupBy(F.shiftright(cell, 6).cast("int").alias("word")).agg(F.bit_or(bit).alias("bits"))
    field = np.zeros(1 << (BIT_FIELD - 6), np.int64)
    for word, bits in words.toLocalIterator():
        field[word] = bits
    return field


def may_have(field: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    cell = numbers.astype(np.int64) & ((1 << BIT_FIELD) - 1)
    return (field[cell >> 6] >> (cell & 63)) & 1 == 1
