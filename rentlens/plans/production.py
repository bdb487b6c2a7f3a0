"""Training a production version and scoring new rows with it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentlens.functions.text import canonical_hash8, version_id
from rentlens.models.regression import fit_ensemble, predict_matrix
from rentlens.operators.binning import calibrate, score_rows
from rentlens.operators.filters import max_value_filter
from rentlens.operators.joins import fx_convert
from rentlens.operators.metrics import regression_metrics
from rentlens.operators.sampling import holdout_split_production
from rentlens.session import materialise
from rentlens.sources.tables import next_counter, read_current_model, register_version


def train_production(
    features_table: DataFrame, features: Sequence[str], target: str, root: str, stamp: str, algorithm: str = "gbt",
    n_models: int = 10, params: dict | None = None, seed: int = 42,
) -> DataFrame:
    """Split, fit with early stopping, evaluate and calibrate on the hold-out, then store the version.

    Returns the one-row evaluation with the version id. The registry row is written last, so a failed
    run never becomes the current version.
    """
    spark = features_table.sparkSession
    split = materialise(holdout_split_production(features_table.select("id", target, *features), "id", target, seed=seed), "split")
    train = split.filter("split <> 'test'").withColumn("_val", F.col("split") == "earlystop")
    models = fit_ensemble(train, features, target, n_models, seed, params, validation="_val")
    test = materialise(predict_matrix(models, split.filter("split = 'test'"), features), "test")
    names = [f"p{i}" for i in range(1, n_models + 1)]
    calibration = calibrate(test.select(target, *names), target, names)
    metrics = regression_metrics(test.withColumn("pred", F.expr(f"({' + '.join(names)}) / {n_models}")), target, "pred")

    counter = next_counter(spark, root)
    settings = {k: str(v) for k, v in sorted((params or {}).items())} | {"algoritmo": algorithm, "semilla": str(seed)}
    one = spark.range(1).select(*[F.lit(v).alias(k) for k, v in settings.items()])
    version = one.select(
        version_id(F.lit(counter), F.lit(stamp), F.lit(algorithm), canonical_hash8(*settings)).alias("v")
    ).first()["v"]
    base = f"{root}/version={version}"
    models.save(spark, f"{base}/models")
    calibration.write.mode("overwrite").parquet(f"{base}/calibration")
    meta = spark.createDataFrame([(algorithm, n_models, list(features))], "algoritmo string, n_models int, features array<string>")
    meta.write.mode("overwrite").parquet(f"{base}/meta")
    metrics.withColumn("version", F.lit(version)).write.mode("overwrite").parquet(f"{base}/metrics")
    register_version(spark, root, version, algorithm, counter)
    return spark.read.parquet(f"{base}/metrics")


def score_new_rows(
    spark: SparkSession, root: str, features_df: DataFrame, listings: DataFrame, rates: DataFrame, max_price: float = 8_000_000.0
) -> DataFrame:
    """Predictions of the current version for rows with a usable price, ready for ``upsert_by_key`` on (id, version)."""
    model = read_current_model(spark, root)
    price = max_value_filter(fx_convert(listings, rates, "precio", "moneda", "fecha"), "precio_clp", max_price).select("id", "precio_clp")
    scored = predict_matrix(model["models"], features_df, model["features"])
    real = scored.join(price, "id", "left").withColumn("costo_total_real", F.col("precio_clp") + F.col("gastos"))
    names = [f"p{i}" for i in range(1, len(model["models"]) + 1)]
    out = score_rows(real, model["calibration"], "costo_total_real", names)
    return out.select(
        "id", F.lit(model["version"]).alias("version"), F.col("pred").alias("costo_total_predicho"), "z_robusto",
        F.col("decil").alias("decil_precio"), "etiqueta", "nivel_confianza", F.col("cv").alias("cv_ensamble"),
    )
