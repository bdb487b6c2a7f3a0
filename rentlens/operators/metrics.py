"""Regression metrics, residual moments, baselines and model comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentlens.functions.numeric import ape
from rentlens.operators.binning import quantile_bin
from rentlens.operators.quantiles import exact_median, exact_quantiles, run


def _global_metrics() -> list[Column]:
    """n, mae, rmse, r2, mape of the columns ``y`` and ``p``."""
    # total sum of squares about the mean, from the population variance
    return [
        F.count("y").alias("n"), F.avg(F.abs(F.col("y") - F.col("p"))).alias("mae"),
        F.sqrt(F.avg((F.col("y") - F.col("p")) * (F.col("y") - F.col("p")))).alias("rmse"),
        (1 - F.avg((F.col("y") - F.col("p")) * (F.col("y") - F.col("p"))) / F.nullif(F.var_pop("y"), F.lit(0.0))).alias("r2"),
        (F.avg(ape("y", "p")) * 100).alias("mape"),
    ]


def regression_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """One row: n, mae, rmse, r2, mape, mdape (percent). Predictions are clipped at 0."""
    e = df.select(F.col(actual).alias("y"), F.greatest(F.col(predicted), F.lit(0.0)).alias("p"))
    median = exact_median(e, "abs(y - p) / nullif(y, 0D)").select("median").scalar()
    return e.agg(*_global_metrics()).withColumn("mdape", median * 100)


def metrics_by_group(df: DataFrame, actual: str, predicted: str, by: Sequence[str], bins: int = 5) -> DataFrame:
    """by…, the columns of ``regression_metrics`` and ``mae_q{bins}``, the mae of the highest quantile bin, for each of a few groups."""
    by = list(by)
    e = df.select(*by, F.col(actual).alias("y"), F.greatest(F.col(predicted), F.lit(0.0)).alias("p"))
    median = exact_median(e, "abs(y - p) / nullif(y, 0D)", by, "mdape", few_groups=True).select(*by, (F.col("mdape") * 100).alias("mdape"))
    edges = exact_quantiles(e, "y", [i / bins for i in range(bins + 1)], by, out="_q", few_groups=True)
    # rows above the last distinct edge but one, or all
    last = edges.selectExpr(*[f"`{c}`" for c in by], "try_element_at(array_distinct(_q), -2) AS _last", "size(array_distinct(_q)) AS _edges")
    top = F.avg(F.when((F.col("_edges") <= 2) | (F.col("y") > F.col("_last")), F.abs(F.col("y") - F.col("p")))).alias(f"mae_q{bins}")
    return e.join(F.broadcast(last), by, "left").groupBy(*by).agg(*_global_metrics(), top).join(F.broadcast(median), by, "left")


def metrics_by_quantile(df: DataFrame, actual: str, predicted: str, bins: int = 5) -> DataFrame:
    """Per quantile bin of the actual value: n, range, mae, mape, mdape."""
    b = quantile_bin(df, actual, bins).withColumns(
        {"_e": F.abs(F.col(actual) - F.col(predicted)), "_ape": ape(actual, predicted) * 100}
    )
    one = b.groupBy("bin").agg(
        F.count(F.lit(1)).alias("n"), F.min(actual).alias("y_min"), F.max(actual).alias("y_max"),
        F.avg("_e").alias("mae"), F.avg("_ape").alias("mape"),
    )
    return one.join(F.broadcast(exact_median(b, "_ape", ["bin"], "mdape", few_groups=True).drop("n")), "bin")


def residual_moments(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Mean, population std, skewness and excess kurtosis of actual - predicted."""
    r = df.select((F.col(actual) - F.col(predicted)).alias("r"))
    return r.agg(
        F.avg("r").alias("media"), F.stddev_pop("r").alias("std"), F.skewness("r").alias("skewness"), F.kurtosis("r").alias("kurtosis")
    )


def baseline_mae(train: DataFrame, test: DataFrame, actual: str, predicted: str, sector: str, area: str) -> DataFrame:
    """MAE of the train-mean predictor and of sector price × area, and what the model gains over each."""
    mean = train.agg(F.avg(actual)).scalar()
    return (
        test.withColumn("_mean", mean)
        .agg(
            F.avg(F.abs(F.col(actual) - F.col(predicted))).alias("mae_modelo"),
            F.avg(F.abs(F.col(actual) - F.col("_mean"))).alias("mae_media"),
            F.avg(F.abs(F.col(actual) - F.col(sector) * F.col(area))).alias("mae_sector"),
        )
        .withColumns(
            {"ganancia_media": F.col("mae_media") - F.col("mae_modelo"), "ganancia_sector": F.col("mae_sector") - F.col("mae_modelo")}
        )
    )


def evaluate(train: DataFrame, test: DataFrame, actual: str, predicted: str, sector: str, area: str) -> DataFrame:
    """All global metrics of one split as a single row (quantile metrics as an array of structs)."""
    by_bin = metrics_by_quantile(test, actual, predicted)
    bins = by_bin.agg(F.sort_array(F.collect_list(F.struct("bin", "n", "y_min", "y_max", "mae", "mape", "mdape"))).alias("b"))
    out = regression_metrics(test, actual, predicted)
    for part in (residual_moments(test, actual, predicted), baseline_mae(train, test, actual, predicted, sector, area)):
        packed = part.select(F.struct(*part.columns).alias("s"))
        out = out.withColumn("_s", packed.scalar()).select("*", "_s.*").drop("_s")
    return out.withColumn("por_quintil", bins.scalar())


def seed_dispersion(df: DataFrame, metrics: Sequence[str], limit: float = 0.15, r2: str = "r2") -> DataFrame:
    """Mean, sample std, min, max and CV of each metric over the seeds, and the stability verdict from R²'s CV."""
    long = df.unpivot([], list(metrics), "metrica", "valor")
    stats = long.groupBy("metrica").agg(
        F.avg("valor").alias("media"), F.stddev_samp("valor").alias("std"), F.min("valor").alias("minimo"), F.max("valor").alias("maximo")
    )
    stats = stats.withColumn("cv", F.col("std") / F.nullif(F.abs(F.col("media")), F.lit(0.0)))
    return stats.withColumn("estable", F.when(F.col("metrica") == r2, F.col("cv") < limit))


def weighted_model_score(df: DataFrame, model: str, w_mae: float = 0.5, w_rmse: float = 0.5, mae: str = "mae", rmse: str = "rmse", top: str = "mae_q5") -> DataFrame:
    """Score per candidate relative to the mean of all, winner, margin to the runner-up and the top-quantile warning."""
    if abs(w_mae + w_rmse - 1.0) > 1e-9:
        raise ValueError(f"weights must sum to 1, got {w_mae} + {w_rmse}")
    means = df.agg(F.avg(mae).alias("m"), F.avg(rmse).alias("r")).select(F.struct("m", "r").alias("s"))
    scored = df.withColumn("_s", means.scalar()).withColumn(
        "score", w_mae * F.col(mae) / F.col("_s.m") + w_rmse * F.col(rmse) / F.col("_s.r")
    ).drop("_s")
    # the two best candidates only: a bounded top-k
    best = run(
        f"SELECT min(score) AS first, max(score) AS second, min_by(`{model}`, score) AS winner FROM (SELECT * FROM {{s}} ORDER BY score, `{model}` LIMIT 2)",
        s=scored,
    ).select(F.struct("first", "second", "winner").alias("s"))
    q5 = scored.agg(F.min_by(model, F.struct(F.col(top), F.col(model)))).scalar()
    return (
        scored.withColumn("_b", best.scalar())
        .withColumn("_q5", q5)
        .select(
            *df.columns, "score", (F.col(model) == F.col("_b.winner")).alias("ganador"),
            (F.col("_b.second") - F.col("_b.first")).alias("margen_absoluto"),
            ((F.col("_b.second") - F.col("_b.first")) / F.nullif(F.col("_b.second"), F.lit(0.0)) * 100).alias("margen_relativo_pct"),
            (F.col("_q5") != F.col("_b.winner")).alias("advertencia_q5"),
        )
    )
