"""Quantile bins, robust scores within bins, calibration tables and labels.

Bin edges (at most ``bins + 1`` numbers) come to the driver and go back into the plan as literals, so
assigning a bin is a handful of comparisons inside generated code.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentlens.functions.numeric import (
    CONFIDENCE_TIERS, MAD_SCALE, TINY_DIVISOR, combined_label, label_by_threshold,
)
from rentlens.operators.quantiles import edge_values, median_mad
from rentlens.session import materialise


def bin_expr(value: str, edges: Sequence[float]) -> Column:
    """0-based right-closed bin of ``value``: the number of inner edges strictly below it; null for null."""
    inner = list(edges)[1:-1]
    count = " + ".join([f"cast({value} > {float(e)!r}D AS int)" for e in inner] or ["0"])
    return F.expr(f"CASE WHEN {value} IS NOT NULL THEN {count} END")


def quantile_bin(df: DataFrame, value: str, bins: int, out: str = "bin") -> DataFrame:
    """Adds the 0-based equal-count bin: right-closed, duplicate edges dropped."""
    return df.withColumn(out, bin_expr(value, edge_values(df, value, bins)))


def tier_expr(value: str, edges: Sequence[float], tiers: Sequence[str] = CONFIDENCE_TIERS) -> Column:
    """Name of the confidence bin; with fewer bins than tiers only the extreme names are used."""
    bins = max(len(edges) - 1, 1)
    used = list(tiers) if bins >= len(tiers) else [tiers[0], tiers[-1]]
    out = F.when(bin_expr(value, edges) == 0, used[0])
    for i, t in enumerate(used[1:], start=1):
        out = out.when(bin_expr(value, edges) == i, t)
    return out


def bin_statistics(df: DataFrame, error: str, bin_: str) -> DataFrame:
    """n, median and MAD of the error per bin, written once. The bins are few by construction."""
    return materialise(median_mad(df.select(bin_, error), error, [bin_], few_groups=True), "binstats")


def _z(median: str, mad: str, error: str, scale: float) -> Column:
    spread = F.col(mad) * scale
    return (F.col(error) - F.col(median)) / F.when(spread == 0, F.lit(TINY_DIVISOR)).otherwise(spread)


def robust_z_by_bin(
    df: DataFrame, actual: str, predicted: str, bins: int = 10, scale: float = MAD_SCALE
) -> tuple[DataFrame, DataFrame]:
    """(rows with error, bin, median, mad, z; statistics per bin)."""
    binned = quantile_bin(df, actual, bins).withColumn("error", F.col(actual) - F.col(predicted))
    stats = bin_statistics(binned, "error", "bin")
    rows = binned.join(F.broadcast(stats.select("bin", "median", "mad")), "bin", "left")
    return rows.withColumn("z", _z("median", "mad", "error", scale)), stats


def with_ensemble(df: DataFrame, predictions: Sequence[str]) -> DataFrame:
    """Adds ``pred`` (mean), ``pred_std`` (population) and ``cv`` over the per-model prediction columns.

    Plain arithmetic over the columns, which stays in generated code; a zero mean divides by a tiny number.
    """
    n = len(predictions)
    total = " + ".join(f"`{p}`" for p in predictions)
    squares = " + ".join(f"(`{p}` - pred) * (`{p}` - pred)" for p in predictions)
    out = df.withColumn("pred", F.expr(f"({total}) / {n}")).withColumn("pred_std", F.expr(f"sqrt(({squares}) / {n})"))
    return out.withColumn("cv", F.expr(f"pred_std / CASE WHEN pred = 0 THEN {TINY_DIVISOR!r}D ELSE pred END"))


def narrow_scores(df: DataFrame, actual: str, predictions: Sequence[str], *keep: str) -> DataFrame:
    """keep…, y, pred, cv written once: the passes that follow read four narrow columns, not the prediction matrix."""
    scored = with_ensemble(df, predictions).select(*keep, F.col(actual).cast("double").alias("y"), "pred", "cv")
    return materialise(scored, "scores")


def confidence_tier(df: DataFrame, cv: str = "cv", tiers: Sequence[str] = CONFIDENCE_TIERS, out: str = "confianza") -> DataFrame:
    """Equal-count tiers of the ensemble's variation."""
    return df.withColumn(out, tier_expr(cv, edge_values(df, cv, len(tiers)), tiers))


def label_opportunities(
    df: DataFrame, id_col: str, actual: str, predictions: Sequence[str], bins: int = 10, low: float = 1.0, high: float = 1.0
) -> DataFrame:
    """The full labelling table: cost, prediction, error, bin statistics, robust z, dispersion, tier and label."""
    scored = narrow_scores(df, actual, predictions, id_col).select(
        id_col, F.col("y").alias("costo_total_real"), F.col("pred").alias("costo_total_predicho"), "cv"
    )
    rows, _ = robust_z_by_bin(scored, "costo_total_real", "costo_total_predicho", bins)
    rows = rows.withColumn("etiqueta", label_by_threshold("z", low, high)).withColumn(
        "nivel_confianza", tier_expr("cv", edge_values(scored, "cv", len(CONFIDENCE_TIERS)))
    )
    return rows.select(
        id_col, "costo_total_real", "costo_total_predicho", "error", F.col("bin").alias("decil_precio"),
        F.col("median").alias("mediana_error_decil"), F.col("mad").alias("mad_error_decil"), F.col("z").alias("z_robusto"),
        F.col("cv").alias("cv_ensamble"), "nivel_confianza", "etiqueta", combined_label("etiqueta", "nivel_confianza").alias("etiqueta_final"),
    )


def _numbers(values: Sequence[float]) -> Column:
    """Array of doubles whose end values are replaced by -inf / +inf, so unseen extreme values still get a bin."""
    inner = [F.lit(float(v)) for v in list(values)[1:-1]]
    return F.array(F.lit(float("-inf")), *inner, F.lit(float("inf")))


def calibrate(
    df: DataFrame, actual: str, predictions: Sequence[str], bins: int = 10, low: float = 1.0, high: float = 1.0
) -> DataFrame:
    """One row holding everything needed to label unseen rows: open-ended edges, per-bin statistics, tier edges, constants."""
    scored = narrow_scores(df, actual, predictions)
    edges = edge_values(scored, "y", bins)
    binned = scored.select(bin_expr("y", edges).alias("bin"), (F.col("y") - F.col("pred")).alias("error"))
    stat = F.struct(F.col("bin").alias("decil"), "n", F.col("median").alias("mediana_error"), F.col("mad").alias("mad_error"))
    return bin_statistics(binned, "error", "bin").agg(F.sort_array(F.collect_list(stat)).alias("stats_por_decil")).select(
        _numbers(edges).alias("bordes_deciles_precio"),
        "stats_por_decil",
        _numbers(edge_values(scored, "cv", len(CONFIDENCE_TIERS))).alias("bordes_cv_confianza"),
        F.array(*[F.lit(t) for t in CONFIDENCE_TIERS]).alias("etiquetas_confianza"),
        F.lit(MAD_SCALE).alias("mad_scale_const"), F.lit(float(low)).alias("umbral_oportunidad"), F.lit(float(high)).alias("umbral_caro"),
    )


def bin_lookup(df: DataFrame, calibration: DataFrame, value: str) -> DataFrame:
    """Adds the stored bin of ``value`` and that bin's n, median and MAD. The calibration is one row of a few dozen numbers."""
    cal = calibration.first()
    stats = calibration.select(F.explode("stats_por_decil").alias("s")).select("s.*")
    return df.withColumn("decil", bin_expr(value, cal["bordes_deciles_precio"])).join(F.broadcast(stats), "decil", "left")


def market_band(df: DataFrame, calibration: DataFrame, predicted: str, charges: str) -> DataFrame:
    """Adds the range regarded as market price around a prediction, and the rent it implies net of charges."""
    cal = calibration.first()
    spread = F.col("mad_error") * cal["mad_scale_const"]
    middle = F.col(predicted) + F.col("mediana_error")
    return bin_lookup(df, calibration, predicted).withColumns(
        {
            "limite_inferior": middle - cal["umbral_oportunidad"] * spread,
            "limite_superior": middle + cal["umbral_caro"] * spread,
            "arriendo_implicito": F.col(predicted) - F.col(charges),
        }
    )


def score_rows(df: DataFrame, calibration: DataFrame, actual: str, predictions: Sequence[str]) -> DataFrame:
    """Label unseen rows with a stored calibration; rows without an actual cost are left out."""
    cal = calibration.first()
    scored = with_ensemble(df.filter(F.col(actual).isNotNull()), predictions).withColumn("error", F.col(actual) - F.col("pred"))
    b = bin_lookup(scored, calibration, actual).withColumn("z_robusto", _z("mediana_error", "mad_error", "error", cal["mad_scale_const"]))
    return b.withColumns(
        {
            "etiqueta": label_by_threshold("z_robusto", cal["umbral_oportunidad"], cal["umbral_caro"]),
            "nivel_confianza": tier_expr("cv", cal["bordes_cv_confianza"], cal["etiquetas_confianza"]),
        }
    ).drop("n")


def stored_calibration(calibration: DataFrame) -> DataFrame:
    """The calibration written once, so scoring does not recompute it."""
    return materialise(calibration, "calibration")
