"""Reading and writing the engine's tables: CSV and Parquet data sets, maps, reports, keyed tables, versions."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rentlens.operators import writes
from rentlens.operators.filters import population_predicate, require_columns
from rentlens.operators.polygons import polygon_edges


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """Any Spark source (parquet, csv, json, orc, jdbc…); filters and column selection reach it."""
    return spark.read.format(fmt).options(**options).load(path)


def read_jdbc(spark: SparkSession, url: str, table: str, key: str, low: int, high: int, parts: int, **options) -> DataFrame:
    """A database table read in ``parts`` parallel key ranges."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn=key, lowerBound=low, upperBound=high, numPartitions=parts, **options)
        .load()
    )


def read_population(listings: DataFrame, details: DataFrame, key: str, **population) -> DataFrame:
    """Listings of the training population with their details; the filter is pushed to both scans where it can be."""
    return listings.join(details, key).filter(population_predicate(**population))


def read_dataset(spark: SparkSession, path: str, schema: T.StructType | str | None = None, columns: Sequence[str] = ()) -> DataFrame:
    """CSV data set without index leftovers ('Unnamed: n'), projected to the wanted columns that exist."""
    reader = spark.read.option("header", True).option("nanValue", "NaN")
    df = reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)
    df = df.select(*[F.col(f"`{c}`") for c in df.columns if not re.fullmatch(r"Unnamed: \d+|_c\d+", c)])
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    # missing numbers are nulls throughout the engine, never NaN
    df = df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in doubles}) if doubles else df
    return df.select(*[c for c in columns if c in df.columns]) if columns else df


def write_dataset(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)


def write_level_map(levels: DataFrame, extras: DataFrame, key: str, path: str) -> None:
    """Group→level map, default level and cuts as one JSON document. The map is a small lookup by construction."""
    packed = levels.filter(F.col(key).isNotNull()).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col(key).cast("string"), "nivel"))).alias("mapa")
    )
    row = extras.first()
    packed.select("mapa", F.lit(row["nivel_default"]).alias("nivel_default"), F.array(*[F.lit(c) for c in row["cuts"]]).alias("cortes")).write.mode(
        "overwrite"
    ).json(path)


def read_level_map(spark: SparkSession, path: str, key: str) -> tuple[DataFrame, int]:
    """(key, nivel; default level)."""
    doc = spark.read.schema("mapa map<string,int>, nivel_default int, cortes array<double>").json(path)
    return doc.select(F.explode("mapa").alias(key, "nivel")), doc.first()["nivel_default"]


def write_feature_list(spark: SparkSession, features: Sequence[str], path: str) -> None:
    rows = [(i, f) for i, f in enumerate(features)]
    spark.createDataFrame(rows, "orden int, feature string").coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def read_feature_list(spark: SparkSession, path: str) -> list[str]:
    df = spark.read.option("header", True).schema("orden int, feature string").csv(path)
    return [r["feature"] for r in df.orderBy("orden").collect()]


def table_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.schema("_ int").parquet(path)  # looks at the path only
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def append_rows(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def insert_new_only(spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str], order: Sequence[str]) -> int:
    """Append the batch's unseen keys to a Parquet table; returns how many rows were added, counted as they are written.

    One writer at a time: two at once may both add a key.
    """
    existing = spark.read.schema(batch.schema).parquet(path)
    unseen = writes.unseen_rows(existing, batch, keys, order)
    added = Observation()
    append_rows(unseen.observe(added, F.count(F.lit(1)).alias("n")), path)
    return added.get["n"]


def replace_table(df: DataFrame, path: str, key: Sequence[str]) -> None:
    """Drop-and-write of a reference table whose key must be unique."""
    twice = df.groupBy(*key).count().filter("count > 1")
    if not twice.isEmpty():
        raise ValueError(f"duplicate key in {list(key)}")
    df.write.mode("overwrite").parquet(path)


def write_snapshot(df: DataFrame, path: str) -> None:
    """Daily snapshot partitioned by date: only the dates present in ``df`` are replaced."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("fecha").parquet(path)


def read_snapshot_history(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).orderBy("fecha", "id")


def read_polygons(zones: DataFrame, zone: str, wkt: str) -> DataFrame:
    """Edges of the zone polygons; an empty zone table is an error."""
    return polygon_edges(zones, zone, wkt)


def write_report(df: DataFrame, path: str) -> None:
    """Nested rows (structs, arrays, maps) as JSON lines."""
    df.write.mode("overwrite").json(path)


def archive_version(artifacts: dict[str, DataFrame], root: str, version: str) -> None:
    """Copies of a version's tables under ``version=<id>/``, so that old predictions can be reproduced."""
    for name, df in artifacts.items():
        df.write.mode("overwrite").parquet(f"{root}/version={version}/{name}")


def register_version(spark: SparkSession, root: str, version: str, algorithm: str, counter: int) -> None:
    row = [(counter, version, algorithm)]
    spark.createDataFrame(row, "contador int, version string, algoritmo string").write.mode("append").parquet(f"{root}/registry")


def next_counter(spark: SparkSession, root: str) -> int:
    """One more than the registry's highest number. Only a registry that is not there counts as empty; other errors come out."""
    if not table_exists(spark, f"{root}/registry"):
        return 1
    return (spark.read.parquet(f"{root}/registry").agg(F.max("contador")).first()[0] or 0) + 1


def read_current_model(spark: SparkSession, root: str) -> dict:
    """The current version's id, algorithm, models and calibration; the two records must agree on the algorithm."""
    from rentlens.models.boosting import Ensemble

    registry = require_columns(spark.read.parquet(f"{root}/registry"), ["contador", "version", "algoritmo"])
    row = registry.orderBy(F.desc("contador")).first()
    base = f"{root}/version={row['version']}"
    meta = spark.read.parquet(f"{base}/meta").first()
    if meta["algoritmo"] != row["algoritmo"]:
        raise ValueError(f"registry says {row['algoritmo']}, version {row['version']} was trained with {meta['algoritmo']}")
    models = Ensemble.load(spark, f"{base}/models")
    return {
        "version": row["version"], "algoritmo": row["algoritmo"], "models": models, "features": list(meta["features"]),
        "calibration": spark.read.parquet(f"{base}/calibration"),
    }
