"""Session construction and the shared scratch folder used by writing jobs."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, app: str = "rentlens") -> SparkSession:
    """A local session for tests and benchmarks. A cluster brings its own session and settings."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; where that is unset, a temporary one if the master is local, else an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not folder:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path in the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/rentlens-{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def parallelism(spark: SparkSession) -> int:
    """Task count for a step whose work is far larger than its input bytes, so size-based splitting would give one task."""
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


#: Rows of a task, at most about this many, where rows are dealt evenly before work that is far larger than their bytes.
DEALT_ROWS = 1 << 18


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """The ``rows`` of ``df`` evenly over the tasks, by ``keys`` or in turn: a narrow table may come from one file block, as one task's rows."""
    return df.repartition(max(parallelism(df.sparkSession), -(-rows // DEALT_ROWS)), *keys)


def ship_package(spark: SparkSession) -> None:
    """Make the package importable in Python workers, wherever the driver found it: a zip goes out with ``addPyFile``, once per context."""
    context = spark.sparkContext
    if getattr(context, "_ships_rentlens", None):
        return
    root = Path(__file__).resolve().parents[1]
    path = f"{tempfile.mkdtemp(prefix='spark-')}/rentlens.zip"  # the driver's own; Spark serves it to the executors
    with zipfile.ZipFile(path, "w") as package:
        for source in sorted((root / "rentlens").rglob("*.py")):
            package.write(source, source.relative_to(root))
    context.addPyFile(path)
    context._ships_rentlens = True
