"""Profiles, counts and facets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentlens.functions.numeric import room_bucket


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """columna, nulos, pct for the columns that have nulls, with the table's row count. One pass."""
    columns = list(columns or df.columns)
    one = df.agg(F.count(F.lit(1)).alias("filas"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    long = one.unpivot(["filas"], columns, "columna", "nulos").filter("nulos > 0")
    return long.withColumn("pct", F.col("nulos") / F.col("filas") * 100)


def crosstab(df: DataFrame, row: str, column: str, values: Sequence[str]) -> DataFrame:
    """Counts of row × column with zeros filled, one output column per given value."""
    return df.groupBy(row).agg(*[F.count_if(F.col(column) == v).alias(v) for v in values])


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Count and percentage (1 decimal, half to even) of each non-null value."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("pct", F.bround(F.col("n") / counts.agg(F.sum("n")).scalar() * 100, 1))


def facet_counts(df: DataFrame, bucketed: Sequence[str], bounded: Sequence[str], place: str) -> DataFrame:
    """faceta, valor, n, minimo, maximo: bucket counts, place counts and numeric bounds of the search form."""
    parts = [
        df.groupBy(room_bucket(c).alias("valor")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(c).alias("faceta"), "valor", "n")
        for c in bucketed
    ]
    parts.append(df.filter(F.col(place).isNotNull()).groupBy(F.col(place).alias("valor")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(place).alias("faceta"), "valor", "n"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out = out.withColumns({"minimo": F.lit(None).cast("double"), "maximo": F.lit(None).cast("double")})
    one = df.agg(*[F.struct(F.min(c).cast("double").alias("minimo"), F.max(c).cast("double").alias("maximo"), F.count(c).alias("n")).alias(c) for c in bounded])
    bounds = one.unpivot([], list(bounded), "faceta", "s").select(
        "faceta", F.lit(None).cast("string").alias("valor"), F.col("s.n").alias("n"), "s.minimo", "s.maximo"
    )
    return out.unionByName(bounds)


def geo_centre(df: DataFrame, lat: str, lon: str) -> DataFrame:
    """Mean point and the zoom: close when the points lie within a tenth of a degree of latitude (sample std)."""
    one = df.agg(F.avg(lat).alias("lat"), F.avg(lon).alias("lon"), F.stddev_samp(lat).alias("_s"))
    return one.select("lat", "lon", F.when(F.col("_s") < 0.1, 12).otherwise(10).alias("zoom"))


def poi_counts(items: DataFrame, id_col: str, category: str, distance: str, categories: Sequence[str], radius_m: float = 500.0) -> DataFrame:
    """Per id and known category: items within the radius and the nearest of them.

    A category that is listed with nothing near gives 0 and null; a category not listed gives nulls.
    """
    near = F.col(distance) <= radius_m
    return items.groupBy(id_col).agg(
        *[
            c
            for k in categories
            for c in (
                F.when(F.count_if(F.col(category) == k) > 0, F.count_if((F.col(category) == k) & near)).alias(f"cantidad_{k}"),
                F.min(F.when((F.col(category) == k) & near, F.col(distance))).alias(f"distancia_min_m_{k}"),
            )
        ]
    )
