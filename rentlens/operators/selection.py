"""Feature selection statistics: variance, stability, the one-standard-error rule, correlation and attribution."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentlens.operators.quantiles import exact_median, run


def variances(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """feature, varianza (sample variance, nulls skipped)."""
    one = df.agg(*[F.var_samp(F.col(c).cast("double")).alias(c) for c in columns])
    return one.unpivot([], list(columns), "feature", "varianza")


def low_variance_columns(df: DataFrame, columns: Sequence[str], threshold: float = 1e-6) -> DataFrame:
    return variances(df, columns).filter(F.col("varianza").isNull() | (F.col("varianza") <= threshold))


def stability_score(importances: DataFrame, feature: str, importance: str, threshold: float = 0.6) -> DataFrame:
    """Per feature over the models: mean, population std, median, CV, presence share, score, pass flag."""
    mean, std = F.col("mean_imp"), F.col("std_imp")
    stats = importances.groupBy(feature).agg(
        F.avg(importance).alias("mean_imp"), F.stddev_pop(importance).alias("std_imp"),
        F.avg((F.col(importance) > 0).cast("double")).alias("presence"),
    )
    stats = stats.join(exact_median(importances, importance, [feature], "median_imp").drop("n"), feature)
    cv = F.when(mean > 0, std / mean)
    return stats.withColumn("cv", cv).withColumns(
        {"score": F.coalesce(F.col("presence") / (1 + F.col("cv")), F.lit(0.0)), "passes": F.col("presence") >= threshold}
    )


def one_se_rule(curve: DataFrame, n_seeds: int, k: str = "k", mae: str = "mae", std: str = "std") -> DataFrame:
    """One row: the k of the lowest error, its standard error, the threshold and the smallest k within it."""
    best = curve.agg(F.min_by(F.struct(F.col(k).alias("k"), F.col(mae).alias("mae"), F.col(std).alias("std")), F.struct(mae, k)).alias("b"))
    marked = curve.withColumn("b", best.scalar()).withColumn("threshold", F.col("b.mae") + F.col("b.std") / (float(n_seeds) ** 0.5))
    return marked.filter(F.col(mae) <= F.col("threshold")).agg(
        F.min(k).alias("best_k"), F.max("b.k").alias("argmin_k"), F.max("b.mae").alias("min_mae"), F.max("threshold").alias("threshold")
    )


def correlation_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """a, b, r: Pearson correlation of every pair of the (few) columns, nulls as 0, in one aggregation."""
    filled = df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in columns])
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    one = filled.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    long = one.unpivot([], [f"{a}|{b}" for a, b in pairs], "pair", "r")
    return long.select(F.split_part("pair", F.lit("|"), F.lit(1)).alias("a"), F.split_part("pair", F.lit("|"), F.lit(2)).alias("b"), "r")


def correlation_prune(df: DataFrame, scores: dict[str, float], threshold: float = 0.95) -> tuple[list[str], list[str]]:
    """(kept, removed): walking down the scores, drop every later feature too correlated with a kept one.

    Only the feature-by-feature matrix reaches the driver; its size depends on the number of columns.
    """
    ordered = sorted(scores, key=lambda c: -scores[c])
    filled = df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in ordered])
    vectors = VectorAssembler(inputCols=ordered, outputCol="v").transform(filled).select("v")
    matrix = Correlation.corr(vectors, "v").first()[0].toArray()
    kept: list[int] = []
    for i in range(len(ordered)):
        if all(not abs(matrix[i][j]) > threshold for j in kept):
            kept.append(i)
    return [ordered[i] for i in kept], [c for i, c in enumerate(ordered) if i not in kept]


def attribution_summary(long: DataFrame, feature: str, value: str, contribution: str, limit: float = 0.15) -> DataFrame:
    """Per feature: mean absolute contribution, share of the total, correlation of value with contribution, direction."""
    stats = long.groupBy(feature).agg(
        F.avg(F.abs(contribution)).alias("importancia"), F.when(F.stddev_pop(value) > 0, F.corr(value, contribution)).alias("direccion_corr")
    )
    total = stats.agg(F.sum("importancia")).scalar()
    return stats.withColumns(
        {
            "share_pct": F.col("importancia") / total * 100,
            "direccion": F.when(F.col("direccion_corr") > limit, "sube").when(F.col("direccion_corr") < -limit, "baja").otherwise("mixta"),
        }
    )


def rank_by_score(df: DataFrame, score: str, tie: str, n: int | None = None) -> DataFrame:
    ordered = df.orderBy(F.desc(score), F.asc(tie))
    return ordered.limit(n) if n else ordered
