"""Ensemble regression by shared boosting passes, surface imputation with Spark ML, searches and importances."""

from __future__ import annotations

import math
import random
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentlens.models.boosting import Ensemble, Matrix, Spec, errors_of, feature_array, fit_many, quantised
from rentlens.operators.metrics import metrics_by_group, regression_metrics
from rentlens.operators.quantiles import run
from rentlens.operators.sampling import stratified_split, with_hash_rank
from rentlens.session import dealt, materialise

DEFAULT_PARAMS = {"maxIter": 20, "maxDepth": 5, "stepSize": 0.1, "subsamplingRate": 0.8}
#: What a search draws from.
SPACE = {"maxDepth": [3, 4, 5, 6], "maxIter": [10, 20, 30], "stepSize": [0.05, 0.1, 0.3], "subsamplingRate": [0.6, 0.8, 1.0]}


def spec(features: Sequence[str], seed: int, params: dict | None = None, **masks) -> Spec:
    """A model with ``DEFAULT_PARAMS`` where ``params`` says nothing else. Names outside of them are an error."""
    p = {**DEFAULT_PARAMS, **(params or {})}
    if unknown := set(p) - set(DEFAULT_PARAMS):
        raise ValueError(f"unknown parameters: {sorted(unknown)}")
    return Spec(tuple(features), seed, p["maxIter"], p["maxDepth"], p["stepSize"], p["subsamplingRate"], **masks)


def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    """Adds the feature vector for Spark ML's estimators; missing values count as 0. A missing column is an error, never a made-up 0."""
    return df.withColumn(out, array_to_vector(feature_array(df, features)))


def fit_ensemble(
    train: DataFrame, features: Sequence[str], target: str, n_models: int = 10, seed: int = 42,
    params: dict | None = None, validation: str | None = None, id_col: str = "id",
) -> Ensemble:
    """``n_models`` boosted regressors that differ in seed only, fitted together; ``validation`` names a boolean column for early stopping.

    Row subsets come from a hash of ``id_col``.
    """
    matrix = quantised(train, id_col, features, target, [validation] if validation else [])
    return fit_many(matrix, [spec(features, seed + i, params, validation=validation) for i in range(n_models)])


def predict_matrix(models: Ensemble, df: DataFrame, features: Sequence[str], prefix: str = "p") -> DataFrame:
    """Adds one clipped prediction column per model (p1…pN). Map-only: all models score in one pass."""
    if tuple(features) != models.features:
        raise ValueError(f"the models were fitted on {models.features}")
    scored = models.predictions(df, feature_array(df, features), "_p")
    return scored.withColumns({f"{prefix}{i + 1}": F.greatest(F.col("_p")[i], F.lit(0.0)) for i in range(len(models))}).drop("_p")


def predict_mean(models: Ensemble, df: DataFrame, features: Sequence[str], out: str = "pred") -> DataFrame:
    scored = predict_matrix(models, df, features, "_p")
    names = [f"_p{i}" for i in range(1, len(models) + 1)]
    return scored.withColumn(out, F.expr(f"({' + '.join(names)}) / {len(names)}")).drop(*names)


# ---- surface imputation ------------------------------------------------------------------------
def fit_surface_imputer(
    df: DataFrame, target: str, numeric: Sequence[str], categorical: Sequence[str], minimum: float = 30.0,
    min_rows: int = 20, trees: int = 50, seed: int = 42,
) -> PipelineModel | None:
    """A forest trained on the trusted rows (target ≥ ``minimum``); None when there are too few of them."""
    trusted = df.filter(F.col(target) >= minimum).fillna(0.0, subset=list(numeric)).select(target, *numeric, *categorical)
    rows = trusted.count()
    if rows < min_rows:
        return None
    indexed, encoded = [f"_i_{c}" for c in categorical], [f"_e_{c}" for c in categorical]
    stages = [
        StringIndexer(inputCols=list(categorical), outputCols=indexed, handleInvalid="keep", stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCols=indexed, outputCols=encoded),
        VectorAssembler(inputCols=[*numeric, *encoded], outputCol="features"),
        RandomForestRegressor(labelCol=target, featuresCol="features", predictionCol="_estimate", numTrees=trees, seed=seed, maxBins=64),
    ]
    # a level of the forest reads all rows of a partition, with their places in all trees
    return Pipeline(stages=stages).fit(dealt(trusted, rows))


def apply_surface_imputer(model: PipelineModel, df: DataFrame, target: str, numeric: Sequence[str], minimum: float = 30.0) -> DataFrame:
    """Estimates (1 decimal, half to even) replace missing and implausibly small values only."""
    filled = df.withColumns({f"_keep_{c}": F.col(c) for c in numeric}).fillna(0.0, subset=list(numeric))
    scored = model.transform(filled)
    value = F.when(F.col(target) >= minimum, F.col(target).cast("double")).otherwise(F.bround("_estimate", 1))
    keep = [F.col(f"_keep_{c}").alias(c) if c in numeric else value.alias(c) if c == target else F.col(c) for c in df.columns]
    return scored.select(*keep)


def surface_regression_impute(
    df: DataFrame, target: str, numeric: Sequence[str], categorical: Sequence[str], group: str, groups: Sequence[str],
    minimum: float = 30.0, min_rows: int = 20, trees: int = 50,
) -> tuple[DataFrame, dict[str, PipelineModel]]:
    """(rows with the target corrected, model per group). Groups with too few trusted rows, or not listed, are left as they are."""
    models, parts = {}, []
    for g in groups:
        rows = df.filter(F.col(group) == g)
        model = fit_surface_imputer(rows, target, numeric, categorical, minimum, min_rows, trees)
        if model is not None:
            models[g] = model
            parts.append(apply_surface_imputer(model, rows, target, numeric, minimum))
    rest = df.filter(F.col(group).isNull() | ~F.col(group).isin(list(models)))
    out = rest.withColumn(target, F.col(target).cast("double"))
    for p in parts:
        out = out.unionByName(p)
    return out, models


def validate_surface_imputer(df: DataFrame, id_col: str, target: str, numeric: Sequence[str], categorical: Sequence[str], minimum: float = 30.0, trees: int = 50) -> DataFrame:
    """Error of the imputer on a fifth of the trusted rows held out by hash order."""
    trusted = df.filter(F.col(target) >= minimum)
    ranked = with_hash_rank(trusted, [], id_col, 42).withColumn("_val", F.col("rank") <= F.ceil(F.col("group_size") * 0.2))
    model = fit_surface_imputer(ranked.filter(~F.col("_val")), target, numeric, categorical, minimum, 1, trees)
    held = ranked.filter("_val").fillna(0.0, subset=list(numeric))
    return regression_metrics(model.transform(held), target, "_estimate")


# ---- searches ----------------------------------------------------------------------------------
def drawn_params(space: dict[str, Sequence], trials: int, seed: int) -> list[dict]:
    rng = random.Random(seed)
    return [{k: rng.choice(list(v)) for k, v in sorted(space.items())} for _ in range(trials)]


def cross_validated(matrix: Matrix, trials: Sequence[tuple[int, dict, str | None]], folds: int, metric: str) -> DataFrame:
    """trial, error: ``metric`` as the mean over the folds, for each (seed, parameters, mask of the rows used). All trials and folds are fitted together."""
    models = fit_many(matrix, [spec(matrix.layout.features, s, d, fold=(s, folds, k), train=train) for s, d, train in trials for k in range(folds)])
    return errors_of(matrix, models).groupBy((F.col("model") / folds).cast("int").alias("trial")).agg(F.avg(metric).alias("error"))


def param_search(
    train: DataFrame, id_col: str, features: Sequence[str], target: str, space: dict[str, Sequence], trials: int = 10,
    folds: int = 5, seed: int = 42, metric: str = "mae",
) -> DataFrame:
    """Cross-validated ``error`` (``metric``: mae or rmse, mean over the folds) of ``trials`` random draws from the space: one row per draw, best first.

    All trials and folds are fitted together.
    """
    draws = drawn_params(space, trials, seed)
    matrix = quantised(train, id_col, features, target)
    errors = cross_validated(matrix, [(seed, d, None) for d in draws], folds, metric)
    rows = [(i, {k: str(v) for k, v in d.items()}) for i, d in enumerate(draws)]
    return train.sparkSession.createDataFrame(rows, "trial int, params map<string,string>").join(F.broadcast(errors), "trial").orderBy("error", "trial")


def stability_selection(
    df: DataFrame, id_col: str, features: Sequence[str], target: str, n_models: int = 30, folds: int = 5, seed: int = 42, params: dict | None = None
) -> DataFrame:
    """model, feature, importance: mean over the folds of each seed's model importances. All seeds and folds are fitted together."""
    matrix = quantised(df, id_col, features, target)
    specs = [spec(features, seed + i, params, fold=(seed + i, folds, k)) for i in range(n_models) for k in range(folds)]
    mean = fit_many(matrix, specs).importances().reshape(n_models, folds, len(features)).mean(axis=1)
    rows = [(i, f, float(v)) for i, row in enumerate(mean) for f, v in zip(features, row)]
    return df.sparkSession.createDataFrame(rows, "model int, feature string, importance double")


def k_curve(
    train: DataFrame, val: DataFrame, id_col: str, ranked: Sequence[str], target: str, k_min: int = 1, k_max: int | None = None, n_seeds: int = 5,
    seed: int = 42, params: dict | None = None,
) -> DataFrame:
    """k, mae, std (population, over seeds), rmse, r2 on ``val`` of models using the first k features, all fitted together."""
    both = [d.select(id_col, target, *ranked, F.lit(v).alias("_val"), F.lit(not v).alias("_train")) for d, v in ((train, False), (val, True))]
    matrix = quantised(both[0].unionByName(both[1]), id_col, ranked, target, ["_train", "_val"])
    ks = range(k_min, (k_max or len(ranked)) + 1)
    models = fit_many(matrix, [spec(ranked[:k], seed + i, params, train="_train") for k in ks for i in range(n_seeds)])
    long = errors_of(matrix, models, "_val").withColumn("k", (F.col("model") / n_seeds + k_min).cast("int"))
    return long.groupBy("k").agg(F.avg("mae").alias("mae"), F.stddev_pop("mae").alias("std"), F.avg("rmse").alias("rmse"), F.avg("r2").alias("r2"))


def permutation_importance(models: Ensemble, df: DataFrame, id_col: str, features: Sequence[str], target: str, seed: int = 42) -> DataFrame:
    """feature, importance: how much the mean absolute error grows when the feature comes from another row.

    Each row is paired with another by two hash orders (an exact permutation, made by a join on rank);
    all features are then tried in one pass over the pairs.
    """
    narrow = df.select(id_col, target, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features])
    narrow = materialise(narrow, "narrow")
    first = with_hash_rank(narrow, [], id_col, seed, "_r").drop("group_size")
    ranked = materialise(with_hash_rank(first, [], id_col, seed + 1, "_s").drop("group_size"), "ranks")
    other = ranked.select(F.col("_s").alias("_r"), *[F.col(c).alias(f"_o_{c}") for c in features])
    scored = materialise(ranked.drop("_s").join(other, "_r"), "pairs")
    for j, v in enumerate(["_none", *features]):
        scored = models.predictions(scored, F.array(*[F.col(f"_o_{c}" if c == v else c) for c in features]), f"_p{j}")
        mean = F.aggregate(f"_p{j}", F.lit(0.0), lambda total, p: total + F.greatest(p, F.lit(0.0))) / len(models)
        scored = scored.withColumn(f"_e{j}", F.abs(F.col(target) - mean))
    one = scored.agg(*[F.avg(f"_e{j}").alias(f"e{j}") for j in range(len(features) + 1)])
    long = ", ".join(f"struct('{f}' AS feature, e{j} - e0 AS importance)" for j, f in enumerate(features, start=1))
    return run(f"SELECT inline(array({long})) FROM {{d}}", d=one)


def repeat_over_seeds(
    df: DataFrame, id_col: str, features: Sequence[str], target: str, seeds: Sequence[int], n_models: int = 10, params: dict | None = None,
    space: dict[str, Sequence] | None = None, trials: int = 10, folds: int = 5, metric: str = "mae",
) -> DataFrame:
    """The whole training per seed, one row each: a fresh stratified split, the search of ``param_search`` on its train part, ``n_models``
    with the best draw, early-stopped on the validation part, and their mean's errors: seed, mae, rmse, r2, mape, mdape, mae_q5 (highest
    fifth of the targets) on the test part and val_mae, val_rmse, val_r2 on the validation part, which the search does not see.

    ``params`` are fixed, the search draws the rest of ``space`` (``SPACE``). The searches of all seeds are fitted together, then all their models.
    """
    rows = materialise(df.select(id_col, target, *features), "rows")
    for i, s in enumerate(seeds):
        rows = stratified_split(rows, id_col, target, seed=s).withColumnRenamed("split", f"_split_{i}").drop("estrato")
    rows = materialise(rows, "splits")
    part, masks = {i: F.col(f"_split_{i}") for i in range(len(seeds))}, {}
    for i in part:
        masks |= {f"_train_{i}": part[i] == "train", f"_val_{i}": part[i] == "val", f"_fit_{i}": part[i] != "test"}
    matrix = quantised(rows.withColumns(masks), id_col, features, target, list(masks))

    choices = (SPACE if space is None else space) | {k: [v] for k, v in (params or {}).items()}
    draws = [(s, d, f"_train_{i}") for i, s in enumerate(seeds) for d in drawn_params(choices, trials, s)]
    # less than nine digits apart is rounding: of equal draws the first is taken
    errors = {r["trial"]: float(f"{r['error']:.9g}") for r in cross_validated(matrix, draws, folds, metric).collect() if r["error"] is not None}
    best = [draws[min(range(i * trials, (i + 1) * trials), key=lambda t: errors.get(t, math.inf))][1] for i in part]

    # seeds of their own for the models of each split
    models = fit_many(matrix, [spec(features, s * 1000 + j, best[i], train=f"_fit_{i}", validation=f"_val_{i}") for i, s in enumerate(seeds) for j in range(n_models)])
    scored = None
    for i in part:
        held = rows.filter(part[i] != "train").select(F.lit(i).alias("_i"), part[i].alias("_part"), F.col(target).cast("double").alias("_y"), *features)
        one = predict_mean(models.part(range(i * n_models, (i + 1) * n_models)), held, features, "_pred").select("_i", "_part", "_y", "_pred")
        scored = one if scored is None else scored.unionByName(one)
    found = materialise(metrics_by_group(materialise(scored, "scored"), "_y", "_pred", ["_i", "_part"]), "metrics")
    test = found.filter("_part = 'test'").select("_i", "mae", "rmse", "r2", "mape", "mdape", "mae_q5")
    val = found.filter("_part = 'val'").select("_i", *[F.col(c).alias(f"val_{c}") for c in ("mae", "rmse", "r2")])
    places = df.sparkSession.range(len(seeds)).select(F.col("id").cast("int").alias("_i"), F.array(*map(F.lit, seeds))[F.col("id").cast("int")].alias("seed"))
    return places.join(F.broadcast(test), "_i", "left").join(F.broadcast(val), "_i", "left").orderBy("_i").drop("_i")
