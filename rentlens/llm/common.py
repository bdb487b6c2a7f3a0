"""Helpers shared by the operators: ranks over range partitions and joins that survive a hot key."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import zipfile
from collections.abc import Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rentlens.session import materialise, scratch_path

__all__ = ["ASCII_LOWER", "SPACE", "attach", "empty_if_null", "give_back", "global_rank", "materialise", "scratch_path", "prepare", "shuffle_partitions", "table"]

BATCH_ROWS = 1000
SPACE = r"[\x20\x09-\x0D]"


def prepare(spark: SparkSession) -> None:
    """Set a session up for operators with Python workers.

    Arrow batches are held to ``BATCH_ROWS`` rows, as whole texts travel in them. The package becomes importable in the
    workers, wherever the driver found it: a zip of it goes out with ``addPyFile``, once per context.
    """
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    context = spark.sparkContext
    if getattr(context, "_ships_rentlens", None):
        return
    root = Path(__file__).resolve().parents[2]
    path = f"{tempfile.mkdtemp(prefix='spark-')}/rentlens.zip"  # the driver's own; Spark serves it to the executors
    with zipfile.ZipFile(path, "w") as package:
        for source in sorted((root / "rentlens").rglob("*.py")):
            package.write(source, source.relative_to(root))
    context.addPyFile(path)
    context._ships_rentlens = True


def give_back() -> None:
    """At the end of a task's batches: return what Python, Arrow and the C library have freed to the system.

    Python workers are kept for later tasks and stages, and with them the memory they once needed.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def empty_if_null(text: str | Column) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def ASCII_LOWER(text: Column) -> Column:  # noqa: N802
    """A-Z lower-cased, every other code point as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def global_rank(df: DataFrame, by: Sequence[str], order: Sequence[Column], out: str = "rank") -> DataFrame:
    """Adds the 1-based rank of each row inside its ``by`` group in ``order``; null keys form a group, last.

    Rows are range-partitioned on (by, order) and sorted there, so a hot group spreads over many tasks. A row's
    place in its partition is fixed by writing it once; the rank is that place plus the group's rows in earlier
    partitions. The join key holds the partition number, so no key has more rows than one range partition.
    """
    keys = [F.col(c).asc_nulls_last() for c in by] + list(order)
    n = shuffle_partitions(df.sparkSession)
    placed = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id())
    placed = materialise(placed, "rank").withColumn("_part", F.shiftright("_at", 33))
    heads = placed.groupBy("_part", *by).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    heads = heads.select(F.col("_part").alias("_in"), *[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)], (F.col("_first") - F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - 1).alias("_zero"))
    match = F.col("_part") == F.col("_in")
    for i, c in enumerate(by):
        match &= F.col(c).eqNullSafe(F.col(f"_by{i}"))
    joined = placed.join(heads, match).withColumn(out, F.col("_at") - F.col("_zero"))
    return joined.select(*df.columns, out)


def attach(rows: DataFrame, groups: DataFrame, key: str, size: str, share: int = 1000) -> DataFrame:
    """``rows ⋈ groups`` on ``key`` where ``size`` counts a group's rows and every row has its group.

    Groups with more than one in ``share`` of all rows, of which there are fewer than ``share``, are broadcast; only
    the others are shuffled, so no key of the shuffle holds more than that part of the rows. Both inputs are read
    more than once and should be written tables.
    """
    total = rows.count()
    hot = groups.filter(F.col(size) * share > total)
    cold = groups.filter(F.col(size) * share <= total)
    return rows.join(F.broadcast(hot), key).unionByName(rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key))
