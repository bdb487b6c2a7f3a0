import pytest
from pyspark.sql import functions as F

from rentlens.models import regression as R
from rentlens.plans.production import train_production
from rentlens.sources.tables import read_current_model

SMALL = {"maxIter": 3, "maxDepth": 2}


@pytest.fixture(scope="module")
def table(spark):
    rows = [(i, float(i % 20), float(i % 3), 100.0 + 10 * (i % 20)) for i in range(400)]
    return spark.createDataFrame(rows, "id long, a double, b double, y double")


def test_permutation_importance_finds_the_driver(spark, table):
    models = R.fit_ensemble(table, ["a", "b"], "y", 2, params=SMALL)
    imp = {r["feature"]: r["importance"] for r in R.permutation_importance(models, table, "id", ["a", "b"], "y").collect()}
    assert imp["a"] > 10 * max(imp["b"], 0.1)
    scored = R.predict_matrix(models, table, ["a", "b"], "m").agg(F.min("m1"), F.count("m2")).first()
    assert scored[0] >= 0 and scored[1] == 400


def test_missing_feature_is_an_error(spark, table):
    with pytest.raises(ValueError):
        R.assemble(table, ["a", "nope"])


def test_surface_imputer_touches_only_bad_rows(spark):
    rows = [(i, "d", ["x", "y"][i % 2], 2.0, None if i == 0 else 5.0 if i == 1 else 40.0 + i) for i in range(40)] + [(100, "c", "x", 1.0, 3.0)]
    df = spark.createDataFrame(rows, "id int, tipo string, comuna string, rooms double, s double")
    out, models = R.surface_regression_impute(df, "s", ["rooms"], ["comuna"], "tipo", ["d", "c"], trees=5)
    got = {r["id"]: r["s"] for r in out.collect()}
    assert set(models) == {"d"} and got[100] == 3.0 and got[0] >= 30 and got[1] >= 30
    assert all(got[i] == 40.0 + i for i in range(2, 40))


def test_version_round_trip(spark, table, tmp_path):
    root = str(tmp_path)
    for _ in range(2):
        train_production(table, ["a", "b"], "y", root, "20250101000000", n_models=2, params=SMALL)
    cur = read_current_model(spark, root)
    assert cur["version"].startswith("v0002_20250101000000_gbt_") and len(cur["models"]) == 2
    assert len(cur["calibration"].first()["stats_por_decil"]) >= 1


def test_the_imputers_rows_are_dealt_over_tasks(spark, monkeypatch):
    """Rows of one task are all read by it at every level of the forest, so a task has a bounded number of them."""
    from rentlens import session

    rows = spark.range(0, 900, 1, 1).selectExpr("cast(30 + id % 50 AS double) AS s", "id % 4 AS d", "concat('c', id % 3) AS c")
    seen = []
    monkeypatch.setattr(R.Pipeline, "fit", lambda self, df: seen.append(df))
    R.fit_surface_imputer(rows, "s", ["d"], ["c"])
    monkeypatch.setattr(session, "DEALT_ROWS", 100)
    R.fit_surface_imputer(rows, "s", ["d"], ["c"])
    assert seen[0].rdd.getNumPartitions() >= session.parallelism(spark) and seen[1].rdd.getNumPartitions() >= 9
    for df in seen:
        assert max(df.rdd.glom().map(len).collect()) <= 900 // df.rdd.getNumPartitions() + 5 and df.count() == 900
