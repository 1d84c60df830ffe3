"""Helpers shared by the training-data operators: table reads, the shared folder, shipping
this package to executors and slicing Arrow batches by bytes."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: White space of the contracts: space and U+0009..U+000D; everything else belongs to a word.
SPACES = "[\\x20\\x09-\\x0D]"

_SHIPPED: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in ``spark.checkpoint.dir``.

    Only where the session names none and runs on one machine (tests) a private folder is made;
    executors elsewhere would not see it, so on a cluster that is an error."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not path:
        path = context.getCheckpointDir()
    if not path:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="fleetscope-shared-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(path)
    return path


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder of its own below the shared one."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Run ``df`` once and cut its lineage with a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: its size is then known to
    the planner, which broadcasts it only below the session's threshold."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers (once for each application)."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="fleetscope-zip-"), "fleetscope.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    context.addPyFile(target)
    _SHIPPED.add(context.applicationId)


def byte_slices(batch: pa.RecordBatch, column: str, most: int = 8 << 20):
    """Row slices of ``batch`` holding about ``most`` bytes of ``column`` each (a longer single
    value makes a slice of its own)."""
    values = batch.column(batch.schema.get_field_index(column))
    lengths = pc.fill_null(pc.binary_length(values), 0).to_pylist()
    start = held = 0
    for i, n in enumerate(lengths):
        if held and held + n > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < batch.num_rows:
        yield batch.slice(start)


def ascii_lower(text: Column) -> Column:
    """``text`` with only A-Z in lower case; ``translate`` only where a code point is not ASCII."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, letters, letters.lower()))


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` with a column ``name``: its rows' places (from 0) in the order ``order``.

    Rows are range-partitioned and sorted, so no task holds more than one range; the ranges' row
    counts (one row a partition, hence broadcast) give each range its first place."""
    at = f"_at_{name}"
    placed = stored(df.repartitionByRange(*order).sortWithinPartitions(*order)
                    .withColumn(at, F.monotonically_increasing_id()), f"numbered-{name}")
    sizes = placed.groupBy(F.shiftright(at, 33).alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    first = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_first"))
    rows = placed.join(F.broadcast(first), F.shiftright(at, 33) == F.col("_part"))
    return rows.withColumn(name, F.col("_first") + F.col(at).bitwiseAND(F.lit((1 << 33) - 1))).drop(at, "_part", "_first")
