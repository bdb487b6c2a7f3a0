"""Models, feature tables and streams over whole tables. SQL checks what is exact of a model: rows, bounds, order, untouched values."""

from __future__ import annotations

from pyspark.sql import functions as F

from rentlens.models import regression as R
from rentlens.operators import selection
from rentlens.operators.sampling import stratified_split
from rentlens.plans import features as P
from rentlens.plans.production import score_new_rows, train_production
from rentlens.queries.registry import query
from rentlens.session import materialise, scratch_path
from rentlens.sources.tables import read_current_model
from rentlens.streaming import jobs

FEATS = ["l_quantity", "l_discount", "l_tax", "sector"]


def base(t):
    """Scored rows with one noisy prediction standing for the sector price."""
    return t.scored.select("id", "y", "l_quantity", "l_discount", "l_tax", F.col("p1").alias("sector"))


def split_scored(t):
    return materialise(stratified_split(base(t), "id", "y").withColumn("es_val", F.col("split") == "val"), "split")


def fitted(t):
    """Ten models, early-stopped on the validation part, and the split rows."""
    s = split_scored(t)
    return R.fit_ensemble(s.filter("split <> 'test'"), FEATS, "y", validation="es_val"), s


@query("seed_ensemble")
def _(t):
    """Error of each of the ten models and of their mean (model 0) on the test part, with the rounds that early stopping kept."""
    models, s = fitted(t)
    scored = materialise(R.predict_mean(models, R.predict_matrix(models, s.filter("split = 'test'"), FEATS), FEATS), "scored")
    rounds = {i + 1: len(trees) for i, trees in enumerate(models.trees)}
    errors = F.inline(F.array(*[F.struct(F.lit(i).alias("model"), F.lit(rounds.get(i)).cast("int").alias("rounds"), F.abs(F.col("y") - F.col(f"p{i}" if i else "pred")).alias("e")) for i in range(len(models) + 1)]))
    return scored.select(errors).groupBy("model", "rounds").agg(F.count(F.lit(1)).alias("n"), F.avg("e").alias("mae"), F.sqrt(F.avg(F.col("e") * F.col("e"))).alias("rmse"))


@query("predict_matrix")
def _(t):
    models, s = fitted(t)
    return R.predict_matrix(models, s.filter("split = 'test'"), FEATS).select("id", "y", *[f"p{i}" for i in range(1, len(models) + 1)])


@query("predict_mean")
def _(t):
    models, s = fitted(t)
    return R.predict_mean(models, s.filter("split = 'test'"), FEATS).select("id", "y", "pred")


@query("param_search")
def _(t):
    return R.param_search(base(t), "id", FEATS, "y", R.SPACE)


@query("stability_selection")
def _(t):
    """Importance statistics of each feature over 30 seeds of 5 folds."""
    return selection.stability_score(R.stability_selection(base(t), "id", FEATS, "y"), "feature", "importance")


@query("k_curve")
def _(t):
    s = split_scored(t)
    return R.k_curve(s.filter("split = 'train'"), s.filter("split = 'val'"), "id", ["sector", "l_quantity", "l_discount", "l_tax"], "y")


@query("permutation_importance")
def _(t):
    models, s = fitted(t)
    return R.permutation_importance(models, s.filter("split = 'test'"), "id", FEATS, "y")


@query("row_attributions")
def _(t):
    """What each feature adds to a test row's prediction along the paths of the trees; ``base`` and the four add up to ``pred``."""
    models, s = fitted(t)
    out = models.contributions(R.predict_mean(models, s.filter("split = 'test'"), FEATS))
    return out.select("id", "pred", "base", *[F.col("contributions")[f].alias(f"by_{f}") for f in FEATS])


@query("model_attribution_summary")
def _(t):
    """Per feature the mean absolute contribution to the test rows' predictions and the direction it pushes them in."""
    models, s = fitted(t)
    rows = models.contributions(s.filter("split = 'test'"))
    long = rows.select(F.inline(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("v"), F.col("contributions")[f].alias("c")) for f in FEATS])))
    return selection.attribution_summary(materialise(long, "contributions"), "feature", "v", "c")


@query("repeat_over_seeds")
def _(t):
    """Split, search, early-stopped ensemble and its errors, once more for each seed."""
    return R.repeat_over_seeds(base(t), "id", FEATS, "y", [1, 2, 3, 4, 5])


SURFACE = "SELECT id, CASE WHEN superficie_util >= 30 THEN superficie_util END AS kept, superficie_util IS NULL OR superficie_util < 30 AS estimated FROM listings"


def surfaces(t):
    return t.listings.select("id", "tipo", "comuna", "dormitorios", "banos", "superficie_util")


def against_source(out, src):
    """Trusted values as they were; which rows have an estimate instead."""
    doubt = F.col("_was").isNull() | (F.col("_was") < 30)
    both = out.join(src.select("id", F.col("superficie_util").alias("_was")), "id")
    return both.select("id", F.when(~doubt, F.col("superficie_util")).alias("kept"), (doubt & F.col("superficie_util").isNotNull()).alias("estimated"))


@query("surface_regression_impute", SURFACE, ["listings"])
def _(t):
    src = surfaces(t)
    out, _ = R.surface_regression_impute(src, "superficie_util", ["dormitorios", "banos"], ["comuna"], "tipo", ["departamento", "casa"])
    return against_source(out, src)


@query("validate_surface_imputer")
def _(t):
    """Error of the imputer on the held-out fifth of the trusted rows."""
    return R.validate_surface_imputer(surfaces(t), "id", "superficie_util", ["dormitorios", "banos"], ["comuna"])


@query("apply_saved_imputer", SURFACE, ["listings"])
def _(t):
    """Fit, store, load and apply the imputer to the rows of the other kind."""
    from pyspark.ml import PipelineModel

    src = surfaces(t)
    model = R.fit_surface_imputer(src.filter("tipo = 'departamento'"), "superficie_util", ["dormitorios", "banos"], ["comuna"])
    path = scratch_path(t.spark, "imputer")
    model.write().save(path)
    return against_source(R.apply_surface_imputer(PipelineModel.load(path), src, "superficie_util", ["dormitorios", "banos"]), src)


def training_table(t):
    return P.feature_table_training(t.listings, t.rates, ["departamento", "casa"], zones=t.zones, zone_attrs=["attr"])


@query("feature_table_training")
def _(t):
    out, _ = training_table(t)
    return out.drop("comuna", "lat", "lon")


@query("feature_table_serving")
def _(t):
    table, artifacts = training_table(t)
    out, _ = P.feature_table_serving(t.listings, t.predictions, materialise(table, "reference"), artifacts)
    return out


@query("train_production")
def _(t):
    """Test metrics of a new version."""
    return train_production(base(t), FEATS, "y", scratch_path(t.spark, "versions"), "20250101000000")


@query("read_current_model", """SELECT 'gbt' AS algoritmo, 10 AS n_models, feature, true AS newest, n FROM (VALUES ('l_quantity'), ('sector')) v(feature),
 (SELECT count(*) AS n FROM scored) c""", ["scored"])
def _(t):
    """Two versions are stored; the second is current, with its models and features. ``n``: rows that its models score."""
    root = scratch_path(t.spark, "versions")
    rows = materialise(base(t), "rows")
    for stamp, feats in (("20250101000000", FEATS), ("20250102000000", ["l_quantity", "sector"])):
        train_production(rows, feats, "y", root, stamp)
    m = read_current_model(t.spark, root)
    scored = R.predict_mean(m["models"], rows, m["features"]).filter("pred >= 0").agg(F.count(F.lit(1)).alias("n"))
    found = [(m["algoritmo"], len(m["models"]), f, m["version"].startswith("v0002_20250102")) for f in m["features"]]
    return t.spark.createDataFrame(found, "algoritmo string, n_models int, feature string, newest boolean").withColumn("n", scored.scalar())


@query("score_pending_rows")
def _(t):
    """Train a version on the feature table, then label every listing without a prediction."""
    table, artifacts = training_table(t)
    table = materialise(table, "reference")
    root = scratch_path(t.spark, "versions")
    train_production(table, P.FEATURES, "costo_total", root, "20250101000000")
    pending, _ = P.feature_table_serving(t.listings, t.predictions, table, artifacts)
    return score_new_rows(t.spark, root, pending, t.listings, t.rates)


@query("stream_new_listings", "SELECT user_id AS id, min(event_id) AS event_id FROM events GROUP BY 1")
def _(t):
    """First event of each user, appended by a stream over files that hold the events out of order."""
    folder = scratch_path(t.spark, "event-files")
    t.events.select("user_id", "event_id", "ts").repartition(5, "event_id").write.parquet(folder)
    source = jobs.file_stream(t.spark, folder, t.events.select("user_id", "event_id", "ts").schema).selectExpr("user_id AS id", "event_id")
    table = scratch_path(t.spark, "new-listings")
    jobs.run_to_end(jobs.stream_new_listings(source, "id", "event_id", table, scratch_path(t.spark, "ck")))
    return t.spark.read.parquet(table).select("id", "event_id")


def visit_stream(t):
    kinds = "CASE event_type WHEN 'signup' THEN 'pausado' WHEN 'purchase' THEN 'finalizado' WHEN 'error' THEN 'no_disponible' ELSE 'activo' END AS estado"
    return jobs.file_stream(t.spark, t.sf_dir, t.events.schema, "events.parquet").selectExpr("user_id AS id", "event_id AS seq", "ts", "event_type = 'error' AS fallo", kinds)


@query("stream_status_changes", """, z AS (SELECT id, seq, fallo, estado, sum((NOT fallo)::INT) OVER (PARTITION BY id ORDER BY seq) AS g FROM visits), f AS (SELECT *, sum(fallo::INT) OVER (PARTITION BY id, g ORDER BY seq)::BIGINT AS n FROM z),
 s AS (SELECT *, CASE WHEN NOT fallo THEN estado WHEN n>2 THEN 'no_disponible' END AS nuevo FROM f), k AS (SELECT *, lag(nuevo) OVER (PARTITION BY id ORDER BY seq) AS antes FROM s WHERE nuevo IS NOT NULL)
 SELECT id, seq, nuevo AS estado, n AS intentos_fallidos, n>2 AS terminal FROM k WHERE antes IS NULL OR antes<>nuevo""", ["visits"])
def _(t):
    table = scratch_path(t.spark, "changes")
    jobs.run_to_end(jobs.stream_status_changes(visit_stream(t), table, scratch_path(t.spark, "ck"), limit=2))
    return t.spark.read.parquet(table)


@query("stream_daily_snapshot", "SELECT fecha, id, estado FROM snapshots", ["snapshots"])
def _(t):
    table = scratch_path(t.spark, "snapshots")
    jobs.run_to_end(jobs.stream_daily_snapshot(visit_stream(t), table, scratch_path(t.spark, "ck")))
    return t.spark.read.parquet(table).select("fecha", "id", "estado")
