"""Price levels of groups: smoothed means cut at row-weighted quantiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentlens.functions.numeric import LEVEL_NAMES
from rentlens.operators.keys import lookup
from rentlens.operators.quantiles import run, running_total
from rentlens.session import materialise


def smoothed_group_mean(df: DataFrame, value: str, by: str, k: float = 20.0) -> DataFrame:
    """Per group: mean, count of non-null values, and the mean pulled to the global one by ``k`` virtual rows."""
    overall = df.agg(F.avg(value)).scalar()
    g = df.filter(F.col(by).isNotNull()).groupBy(by).agg(F.avg(value).alias("mean"), F.count(value).alias("n"))
    # a group without any value keeps a null smoothed mean
    return g.withColumn("smoothed", (F.col("n") * F.col("mean") + k * overall) / (F.col("n") + k))


def cumulative_share(groups: DataFrame, order: str, weight: str, tie: str) -> DataFrame:
    return running_total(groups, order, weight, tie)


def interpolate_at(groups: DataFrame, value: str, share: str, positions: list[float]) -> DataFrame:
    """Linear interpolation of ``value`` over ``share`` at the positions, clamped at both ends: one row, array ``cuts``.

    Only the two neighbours of each position are kept, by aggregation, so no sort of the table is needed.
    """
    aggs = []
    for i, p in enumerate(positions):
        aggs += [
            f"max_by(struct({share} AS x, {value} AS v), struct({share}, {value})) FILTER (WHERE {share} < {p!r}D) AS lo{i}",
            f"min_by(struct({share} AS x, {value} AS v), struct({share}, {value})) FILTER (WHERE {share} >= {p!r}D) AS hi{i}",
        ]
    cuts = [
        f"CASE WHEN lo{i} IS NULL THEN hi{i}.v WHEN hi{i} IS NULL THEN lo{i}.v "
        f"ELSE lo{i}.v + (hi{i}.v - lo{i}.v) * ({p!r}D - lo{i}.x) / (hi{i}.x - lo{i}.x) END"
        for i, p in enumerate(positions)
    ]
    return run(
        f"SELECT array({', '.join(cuts)}) AS cuts FROM (SELECT {', '.join(aggs)} FROM {{g}} WHERE {value} IS NOT NULL)", g=groups
    )


def weighted_quantile_levels(df: DataFrame, value: str, by: str, levels: int = 5, k: float = 20.0) -> tuple[DataFrame, DataFrame]:
    """(group, n, mean, smoothed, nivel, for five levels nivel_nombre; one row of cuts and nivel_default).

    Cuts are the 1/levels … quantiles of the cumulative row count over groups ordered by smoothed
    mean. A group's level is the number of cuts strictly below its smoothed mean.
    """
    g = materialise(smoothed_group_mean(df, value, by, k), "group-means")  # one row per group, read by each step below
    positions = [i / levels for i in range(1, levels)]
    shares = running_total(g.filter(F.col("smoothed").isNotNull()), "smoothed", "n", f"`{by}`")
    cuts = materialise(interpolate_at(shares, "smoothed", "cum_share", positions), "cuts")
    level = "cast(coalesce(size(filter(cuts, c -> c < {v})), 0) AS int)"
    table = g.withColumn("cuts", cuts.scalar()).withColumn("nivel", F.expr(f"CASE WHEN smoothed IS NULL THEN 0 ELSE {level.format(v='smoothed')} END"))
    default = cuts.withColumn("_m", df.agg(F.avg(value)).scalar()).withColumn("nivel_default", F.expr(level.format(v="_m"))).drop("_m")
    if levels == len(LEVEL_NAMES):
        table = table.withColumn("nivel_nombre", F.element_at(F.array(*[F.lit(n) for n in LEVEL_NAMES]), F.col("nivel") + 1))
    return table.drop("cuts"), default


def map_with_default(df: DataFrame, mapping: DataFrame, key: str, value: str, default, out: str) -> DataFrame:
    """Lookup in a two-column mapping table, ``default`` (a column or scalar subquery) for unseen or null keys."""
    m = mapping.select(F.col(key), F.col(value).alias("_v"))
    return lookup(df, m, [key]).withColumn(out, F.coalesce(F.col("_v"), default)).drop("_v")


def add_price_level(df: DataFrame, value: str, by: str, out: str = "nivel", levels: int = 5, k: float = 20.0) -> DataFrame:
    table, default = weighted_quantile_levels(df, value, by, levels, k)
    return map_with_default(df, table, by, "nivel", default.select("nivel_default").scalar(), out)
