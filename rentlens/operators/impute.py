"""Imputation: group means and modes, cascades on original values, outlier replacement.

Group statistics are aggregated (combining before the shuffle) and joined back; no window runs over
a whole group, so a hot group never sits in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentlens.operators.keys import lookup
from rentlens.operators.quantiles import exact_median


def group_transform(df: DataFrame, by: Sequence[str], **stats: Column) -> DataFrame:
    """Aggregates broadcast back to the rows of their group; rows with a null key get null."""
    by = list(by)
    table = df.groupBy(*by).agg(*[c.alias(n) for n, c in stats.items()])
    for k in by:
        table = table.filter(F.col(k).isNotNull())
    return lookup(df, table, by)


def group_mean_impute(df: DataFrame, columns: Sequence[str], by: str) -> DataFrame:
    """Null to the group mean, then to the mean of the column as filled so far. Absent columns are skipped."""
    present = [c for c in columns if c in df.columns]
    filled = group_transform(df, [by], **{f"_m_{c}": F.avg(c) for c in present})
    filled = filled.select(
        *[
            F.coalesce(F.col(c).cast("double"), F.col(f"_m_{c}")).alias(c) if c in present else F.col(c)
            for c in df.columns
        ]
    )
    means = {c: filled.agg(F.avg(c)).scalar() for c in present}
    return filled.withColumns({c: F.coalesce(F.col(c), means[c]) for c in present})


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def group_mode(df: DataFrame, keys: Sequence[str], value: str, out: str = "mode") -> DataFrame:
    """Most frequent value per group, the smallest among ties. Two combining aggregations, no per-group buffer."""
    keys = list(keys)
    seen = df.filter(F.col(value).isNotNull())
    for k in keys:
        seen = seen.filter(F.col(k).isNotNull())
    counts = seen.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    return counts.groupBy(*keys).agg(F.min_by(value, F.struct(-F.col("_n"), F.col(value))).alias(out))


def group_mode_impute(df: DataFrame, columns: Sequence[str], keys: Sequence[str], null_key: str = "keep") -> DataFrame:
    """Null to the mode of rows with exactly equal keys.

    ``null_key='keep'`` leaves rows without a key as they are; ``'erase'`` sets them to null, which is
    what a group-wise transform that drops null keys does.
    """
    keys = list(keys)
    missing_key = F.lit(False)
    for k in keys:
        missing_key = missing_key | F.col(k).isNull()
    out = df
    for c in columns:
        out = lookup(out, group_mode(df, keys, c, f"_mode_{c}"), keys)
    filled = []
    for c in df.columns:
        if c not in columns:
            filled.append(F.col(c))
            continue
        value = F.coalesce(F.col(c), F.col(f"_mode_{c}"))
        if null_key == "erase":
            value = F.when(~missing_key, value)
        filled.append(value.alias(c))
    return out.select(*filled)


def median_cascade(
    df: DataFrame, column: str, nearby: str | None, groups: Sequence[str], out: str | None = None, as_int: bool = True
) -> DataFrame:
    """Own value, then the ``nearby`` estimate, then group medians in order, then the global median.

    All medians come from the original values. The result is rounded half to even when ``as_int``.
    """
    out = out or column
    chain = [F.col(column).cast("double")]
    if nearby:
        chain.append(F.col(nearby).cast("double"))
    joined = df
    for i, g in enumerate(groups):
        joined = lookup(joined, exact_median(df, column, [g], f"_g{i}").select(g, f"_g{i}"), [g])
        chain.append(F.col(f"_g{i}"))
    chain.append(exact_median(df, column).select("median").scalar())
    value = F.coalesce(*chain)
    if as_int:
        value = F.bround(value, 0).cast("int")
    return joined.withColumn("_filled", value).select(
        *[F.col(c) for c in df.columns if c != out], F.col("_filled").alias(out)
    )


def replace_outlier_with_mean(df: DataFrame, column: str, limit: float) -> DataFrame:
    """Values above ``limit`` become the mean of the values up to it."""
    mean = df.agg(F.avg(F.when(F.col(column) <= limit, F.col(column)))).scalar()
    return df.withColumn(column, F.when(F.col(column) > limit, mean).otherwise(F.col(column).cast("double")))
