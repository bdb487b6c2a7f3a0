"""Shared boosting passes against a plain boosting of one model, and what is built on them."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rentlens.models import boosting as B
from rentlens.models import regression as R
from rentlens.operators.binning import quantile_bin
from rentlens.operators.metrics import metrics_by_group, metrics_by_quantile, regression_metrics
from rentlens.operators.sampling import stratified_split

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def frame():
    r = np.random.default_rng(1)
    n = 1500
    a, b, c = r.normal(size=n), r.integers(0, 5, n).astype(float), r.random(n)
    c[::50] = np.nan
    y = 100 + 30 * np.sign(a) + 5 * b * (np.nan_to_num(c) > 0.5) + r.normal(size=n)
    return pd.DataFrame({"id": range(n), "a": a, "b": b, "c": c, "y": y, "val": np.arange(n) % 5 == 0})


@pytest.fixture(scope="module")
def table(spark, frame):
    df = spark.createDataFrame(frame).withColumn("c", F.when(~F.isnan("c"), F.col("c")))
    return df.unionByName(df.limit(1).withColumn("y", F.lit(None).cast("double")))


def plain_boost(x, y, train, rounds, depth, step, mean, unit, drawn, use):
    """One model by the definition: exhaustive search over the bins of each node, all in memory."""
    pred, trees = np.full(len(y), mean), []
    for r in range(rounds):
        rows = train & drawn(r)
        whole = np.rint((y - pred) / unit)
        node, out, tree = np.zeros(len(y), int), np.zeros(len(y)), {}
        scale = unit * (step if r else 1.0)
        for level in range(depth + 1):
            for i in range(2**level - 1, 2 ** (level + 1) - 1):
                mine = rows & (node == i)
                if not mine.any():
                    continue
                s, n = whole[mine].sum(), mine.sum()
                out[node == i] = scale * s / n
                best = None
                for f in use if level < depth else []:
                    for b in range(B.BINS):
                        left = mine & (x[f] <= b)
                        nl = left.sum()
                        if 0 < nl < n:
                            sl = whole[left].sum()
                            gain = sl**2 / nl + (s - sl) ** 2 / (n - nl) - s**2 / n
                            if gain > 1e-9 * max(1.0, s**2 / n) and (best is None or gain > best[0]):
                                best = gain, f, b
                if best:
                    tree[i] = best[1:]
                    here = node == i
                    node[here] = 2 * i + 1 + (x[best[1]][here] > best[2])
                    for kid in (2 * i + 1, 2 * i + 2):
                        some = rows & (node == kid)
                        out[node == kid] = scale * whole[some].sum() / some.sum()
        pred = pred + out
        trees.append(tree)
    return pred, trees


def all_rows(matrix, count=0):
    rows = matrix.table.collect()
    blocks = [B.Block(r.asDict(), matrix.layout, count) for r in rows]
    whole = B.Block.__new__(B.Block)
    whole.bins, whole.target = np.concatenate([b.bins for b in blocks], axis=1), np.concatenate([b.target for b in blocks])
    whole.hash, whole.masks = np.concatenate([b.hash for b in blocks]), np.concatenate([b.masks for b in blocks], axis=1)
    whole.n = len(whole.target)
    return whole


@pytest.mark.parametrize("bytes_", [16 << 20, 0])
def test_models_fitted_together_equal_one_fitted_plainly(spark, table, monkeypatch, bytes_):
    """Different seeds, folds, masks, features and parameters in the same passes; sums by the driver or by tasks; states and groups in use."""
    monkeypatch.setattr(B, "DRIVER_BYTES", bytes_)
    monkeypatch.setattr(B, "STATE_ROUNDS", 2)
    monkeypatch.setattr(B, "SUM_BYTES", 4 * 3 * B.BINS_USED * 16 * 2)
    monkeypatch.setattr(B, "BLOCK_ROWS", 300)
    specs = [
        B.Spec(("a", "b", "c"), 1, 5, 3, 0.3, 0.7), B.Spec(("a", "b", "c"), 2, 3, 2, 0.1, 1.0, fold=(9, 4, 1)), B.Spec(("b", "c"), 3, 4, 3, 0.5, 0.5, train="val"),
    ]
    matrix = B.quantised(table, "id", FEATURES, "y", ["val"])
    models = B.fit_many(matrix, specs)
    whole, layout = all_rows(matrix), matrix.layout
    assert whole.n == 1500 and abs(layout.mean - whole.target.mean()) < 1e-9
    for spec, trees in zip(specs, models.trees):
        def drawn(r, spec=spec):
            some = whole.drawn(spec, r)
            return np.ones(whole.n, bool) if some is None else some

        want, by_hand = plain_boost(whole.bins, whole.target, whole.training(layout, spec), spec.rounds, spec.depth, spec.step, layout.mean, layout.unit, drawn, [FEATURES.index(f) for f in spec.features])
        for t, h in zip(trees, by_hand):
            assert {i: (int(t.feature[i]), int(t.bin[i])) for i in np.flatnonzero(t.feature >= 0)} == h
        got = layout.mean + sum(t.value[t.leaves(whole.bins)] for t in trees)
        np.testing.assert_allclose(got, want, rtol=1e-12)
    alone = B.fit_many(B.quantised(table.repartition(7), "id", FEATURES, "y", ["val"]), [specs[0]])
    for t, u in zip(alone.trees[0], models.trees[0]):
        assert (t.feature == u.feature).all() and (t.bin == u.bin).all() and (t.value == u.value).all()
    folds = B.errors_of(matrix, models.part([1])).first()
    held = whole.folds(specs[1]) == 1
    e = whole.target - (layout.mean + sum(t.value[t.leaves(whole.bins)] for t in models.trees[1]))
    assert folds["n"] == held.sum() and folds["mae"] == pytest.approx(np.abs(e[held]).mean()) and folds["rmse"] == pytest.approx(np.sqrt((e[held] ** 2).mean()))
    assert folds["r2"] == pytest.approx(1 - (e[held] ** 2).sum() / ((whole.target[held] - whole.target[held].mean()) ** 2).sum())


def test_early_stopping_keeps_the_best_rounds(spark, table):
    matrix = B.quantised(table, "id", FEATURES, "y", ["val"])
    free = B.Spec(("c",), 1, 8, 4, 1.0, 1.0, train="val")
    models = B.fit_many(matrix, [B.Spec(("a", "b", "c"), 1, 12, 5, 0.9, 0.6, validation="val"), free])
    whole, spec = all_rows(matrix), models.specs[0]
    full = B.fit_many(matrix, [B.Spec(("a", "b", "c"), 1, 12, 5, 0.9, 0.6, fold=None, train=None, validation="val")])
    assert [len(t) for t in full.trees] == [len(models.trees[0])] and len(models.trees[1]) == 8
    held = whole.mask(matrix.layout, spec.validation)
    errors, p = [], np.full(whole.n, matrix.layout.mean)
    for t in models.trees[0]:
        errors.append(((whole.target - p)[held] ** 2).mean())
        p = p + t.value[t.leaves(whole.bins)]
    assert ((whole.target - p)[held] ** 2).mean() < min(errors)


def test_stored_models_predict_and_explain_alike(spark, table, tmp_path):
    models = R.fit_ensemble(table, FEATURES, "y", 3, params={"maxIter": 4, "maxDepth": 3})
    models.save(spark, str(tmp_path))
    again = B.Ensemble.load(spark, str(tmp_path))
    scored = again.contributions(R.predict_mean(again, R.predict_matrix(models, table, FEATURES), FEATURES))
    rows = scored.collect()
    assert len(rows) == 1501
    for r in rows:
        assert r["pred"] == pytest.approx((r["p1"] + r["p2"] + r["p3"]) / 3)
        assert r["base"] + sum(r["contributions"].values()) == pytest.approx(r["pred"], abs=1e-9)
    nodes = models.nodes(spark)
    assert nodes.filter("feature IS NOT NULL AND threshold IS NULL").count() == 0 and nodes.select("model").distinct().count() == 3
    imp = models.importances()
    assert imp.shape == (3, 3) and np.allclose(imp.sum(axis=1), 1) and (imp.argmax(axis=1) == 0).all()


def test_thresholds_of_the_node_table_are_the_rule(spark, table):
    """Following the node table by value gives the prediction."""
    models = R.fit_ensemble(table, FEATURES, "y", 1, params={"maxIter": 3, "maxDepth": 3})
    nodes = {(r["tree"], r["node"]): r for r in models.nodes(spark).collect()}
    for r in R.predict_matrix(models, table, FEATURES).limit(200).collect():
        total = models.start
        for k in range(3):
            i = 0
            while (n := nodes[k, i])["feature"] is not None:
                i = 2 * i + 1 + ((r[n["feature"]] or 0.0) > n["threshold"])
            total += n["value"]
        assert r["p1"] == pytest.approx(max(total, 0.0))


def test_searches_return_their_errors(spark, table):
    found = R.param_search(table, "id", FEATURES, "y", {"maxDepth": [1, 4], "maxIter": [2, 6]}, trials=4, folds=3).collect()
    assert len(found) == 4 and [r["error"] for r in found] == sorted(r["error"] for r in found)
    best, worst = found[0]["params"], found[-1]["params"]
    assert (int(best["maxDepth"]), int(best["maxIter"])) > (int(worst["maxDepth"]), int(worst["maxIter"]))
    curve = {r["k"]: r for r in R.k_curve(table.filter("NOT val"), table.filter("val"), "id", ["a", "b", "c"], "y", n_seeds=2, params={"maxIter": 4}).collect()}
    assert set(curve) == {1, 2, 3} and curve[3]["mae"] < curve[1]["mae"] and curve[1]["rmse"] >= curve[1]["mae"]
    imp = R.stability_selection(table, "id", FEATURES, "y", 2, 3, params={"maxIter": 3})
    assert imp.count() == 6 and imp.groupBy("model").agg(F.max_by("feature", "importance").alias("f")).select("f").distinct().collect()[0][0] == "a"
    seeds = R.repeat_over_seeds(table, "id", FEATURES, "y", [1, 2], 2, {"maxIter": 3}).collect()
    assert [r["seed"] for r in seeds] == [1, 2] and all(r["r2"] > 0.9 for r in seeds)
    with pytest.raises(ValueError):
        R.fit_ensemble(table, FEATURES, "y", 1, params={"max_depth": 3})


def test_a_repetition_is_split_search_ensemble_and_errors_of_each_seed(spark):
    """As if each seed's steps were taken one by one: the search on the train part only, early stopping on the validation part, both parts' errors."""
    y = "100 + 20 * (id % 5) * (id * 7 % 3) - 3 * pow(id * 13 % 8, 2) + xxhash64(id) % 40"
    table = spark.range(1500).selectExpr("id", "double(id % 5) AS a", "double(id * 7 % 3) AS b", "double(id * 13 % 8) AS c", f"double({y}) AS y")
    space = {"maxDepth": [1, 4], "maxIter": [2, 12], "subsamplingRate": [0.5, 1.0]}
    got = R.repeat_over_seeds(table, "id", FEATURES, "y", [4, 3], 2, {"stepSize": 0.6}, space, trials=4, folds=3).collect()
    assert [r["seed"] for r in got] == [4, 3]
    for r in got:
        s, split = r["seed"], stratified_split(table, "id", "y", seed=r["seed"])
        train = split.filter("split = 'train'")
        found = R.param_search(train, "id", FEATURES, "y", {**space, "stepSize": [0.6]}, trials=4, folds=3, seed=s).collect()
        best = {k: type(R.DEFAULT_PARAMS[k])(v) for k, v in found[0]["params"].items()}
        assert (best["maxDepth"], best["maxIter"]) != (R.DEFAULT_PARAMS["maxDepth"], R.DEFAULT_PARAMS["maxIter"]) and found[0]["error"] < found[-1]["error"]
        models = R.fit_ensemble(split.filter("split <> 'test'").withColumn("held", F.col("split") == "val"), FEATURES, "y", 2, s * 1000, best, "held")
        assert len(models) == 2
        for part, names in (("test", ["mae", "rmse", "r2", "mape", "mdape"]), ("val", ["val_mae", "val_rmse", "val_r2"])):
            scored = R.predict_mean(models, split.filter(F.col("split") == part), FEATURES)
            want = regression_metrics(scored, "y", "pred").first()
            for name in names:
                assert r[name] == pytest.approx(want[name.removeprefix("val_")], rel=1e-6), (s, name)
            if part == "test":
                top = metrics_by_quantile(scored, "y", "pred").orderBy(F.desc("bin")).first()
                assert r["mae_q5"] == pytest.approx(top["mae"], rel=1e-6)


def test_held_out_folds_are_those_of_the_rows_a_model_may_train_on(spark, table):
    """Rows outside of the mask of a search, even in the held-out fold, do not count for its errors."""
    marked = table.withColumn("some", F.col("id") % 3 != 0)
    matrix = B.quantised(marked, "id", FEATURES, "y", ["some"])
    models = B.fit_many(matrix, [B.Spec(tuple(FEATURES), 1, 3, 3, fold=(9, 4, k), train="some") for k in (1, 2)])
    whole = all_rows(matrix)
    for k, r in zip((1, 2), sorted(B.errors_of(matrix, models).collect())):
        held = (whole.folds(models.specs[0]) == k) & whole.mask(matrix.layout, "some")
        e = whole.target - (matrix.layout.mean + sum(t.value[t.leaves(whole.bins)] for t in models.trees[k - 1]))
        assert r["n"] == held.sum() and r["mae"] == pytest.approx(np.abs(e[held]).mean())


def test_errors_of_groups_equal_those_of_each_group(spark):
    """Ordinary values, targets tied at the top, one value only, zeros, and predictions below 0."""
    rows = [("plain", float(i), i * 0.9 - 4) for i in range(41)] + [("tied", min(float(i), 9.0), i + 1.0) for i in range(30)]
    rows += [("one", 7.0, i + 5.0) for i in range(4)] + [("zero", 0.0, 1.0)]
    df = spark.createDataFrame(rows, "g string, y double, p double")
    got = {r["g"]: r for r in metrics_by_group(df, "y", "p", ["g"]).collect()}
    assert set(got) == {"plain", "tied", "one", "zero"}
    for g, r in got.items():
        own = df.filter(F.col("g") == g)
        want = regression_metrics(own, "y", "p").first().asDict()
        assert {c: r[c] for c in want} == {c: pytest.approx(v) for c, v in want.items()}
        top = quantile_bin(own, "y", 5).groupBy("bin").agg(F.avg(F.abs(F.col("y") - F.greatest("p", F.lit(0.0)))).alias("mae")).orderBy(F.desc("bin")).first()
        assert r["mae_q5"] == pytest.approx(top["mae"])


def test_empty_and_constant_tables(spark, table):
    none = R.fit_ensemble(table.filter("false"), FEATURES, "y", 2, params={"maxIter": 2})
    assert R.predict_mean(none, table.limit(2), FEATURES).select("pred").distinct().collect()[0][0] == 0.0
    flat = R.fit_ensemble(table.withColumn("y", F.lit(7.0)), FEATURES, "y", 1, params={"maxIter": 2})
    assert R.predict_mean(flat, table.limit(2), FEATURES).select("pred").distinct().collect()[0][0] == 7.0
    few = R.repeat_over_seeds(table.limit(2), "id", FEATURES, "y", [5, 6], 1, {"maxIter": 2}, trials=2, folds=2).collect()
    assert [r["seed"] for r in few] == [5, 6] and all(r["mae"] is None and r["val_mae"] is None for r in few)


def test_passes_read_cells_not_rows(spark, monkeypatch):
    """Ten times the rows of the same bins give the same cells and passes of the same size; adding up rows instead gives the same trees."""
    def matrix(n):
        rows = spark.range(n).selectExpr("id", "double(id % 5) AS a", "double(id * 7 % 3) AS b", "double(id % 5 * 3 + id % 11) AS y", "id % 4 = 0 AS val")
        return B.quantised(rows, "id", ["a", "b"], "y", ["val"])

    specs = [B.Spec(("a", "b"), i, 6, 3, 0.3, 0.7, fold=(i, 3, 1), validation="val") for i in range(3)]
    few, many = matrix(2_000), matrix(20_000)
    assert few.cells <= 15 + 4 and many.cells <= 15 + 4
    draws = B.Draws(specs, range(3))
    table = B.prepared(many.layout, many.table, specs, [[] for _ in specs], draws, False)
    got = table.selectExpr("sum(rows)", "sum(length(sums)) + sum(length(counts))", "sum(length(hash)) + sum(length(target))").first()
    assert got[0] == 0 and got[1] == many.cells * 3 * 3 * 12 and got[2] == 0
    want = B.fit_many(many, specs).trees
    monkeypatch.setattr(B, "ROUND_BYTES", 0)
    monkeypatch.setattr(B, "ROW_MODELS", 2)
    again = B.fit_many(many, specs).trees
    assert [len(t) for t in want] == [len(t) for t in again]
    for t, u in zip([t for m in want for t in m], [t for m in again for t in m]):
        assert (t.feature == u.feature).all() and (t.bin == u.bin).all() and (t.value == u.value).all()


def test_remembered_cells_give_the_computed_values(monkeypatch):
    monkeypatch.setattr(B, "KNOWN_CELLS", 40)
    seen, r = [], np.random.default_rng(0)

    def compute(bins):
        seen.append(bins.shape[1])
        return np.stack([bins[0] * 7.0 + bins[-1], bins[-1] - 3.0]).T

    for width in (1, 3, 8, 9):
        known = B.Remembered(compute)
        for n in (30, 0, 200, 25):
            bins = r.integers(0, 4, (width, n)).astype(np.uint8)
            np.testing.assert_array_equal(known(bins), compute(bins))
    known, bins = B.Remembered(compute), np.array([[1, 2, 1, 2]], np.uint8)
    seen.clear()
    known(bins), known(bins[:, :1])
    assert seen == [2]


def same_trees(one, other):
    assert [len(t) for t in one.trees] == [len(t) for t in other.trees]
    for a, b in zip((t for trees in one.trees for t in trees), (t for trees in other.trees for t in trees)):
        for part in ("feature", "bin", "value", "gain"):
            np.testing.assert_array_equal(getattr(a, part), getattr(b, part))


@pytest.mark.parametrize("round_bytes", [512 << 20, 1])
def test_trees_grown_in_tasks_equal_those_grown_level_by_level(spark, table, monkeypatch, round_bytes):
    """Seeds, shares, folds, masks, features, rounds and depths of many kinds, in one and in many passes over the rows."""
    marked = table.withColumn("some", F.col("id") % 3 != 0)
    matrix = B.quantised(marked, "id", FEATURES, "y", ["val", "some"])
    specs = [
        B.Spec(("a", "b", "c"), rounds=7, validation="val"), B.Spec(("a", "b"), seed=43, rounds=4, depth=2, subsample=1.0, validation="val"),
        B.Spec(("b", "c"), rounds=6, depth=3, step=0.5, fold=(7, 3, 1)), B.Spec(("a",), rounds=3, fold=(7, 3, 1), train="some"),
        B.Spec(("c",), rounds=2, depth=0), B.Spec(("a", "b", "c"), rounds=3, subsample=0.0, validation="val"),
    ]
    monkeypatch.setattr(B, "TASK_CELLS", 0)
    by_level = B.fit_many(matrix, specs)
    monkeypatch.setattr(B, "TASK_CELLS", matrix.cells)
    if round_bytes > 1:
        in_tasks = B.fit_many(matrix, specs)
    else:  # one round a pass, as with sums that fill a pass
        monkeypatch.setattr(B, "ROUND_BYTES", 12 * matrix.cells * len(B.Draws(specs, range(1)).kinds))
        in_tasks = B.fit_many(matrix, specs)
    same_trees(by_level, in_tasks)


def test_a_fit_over_few_cells_needs_few_jobs(spark, table):
    """Jobs by the round, not by the level, would cost a cluster's start of a job a hundred times."""
    matrix = B.quantised(table, "id", FEATURES, "y")
    spark.sparkContext.setJobGroup("few-cells", "fit")
    try:
        B.fit_many(matrix, [B.Spec(tuple(FEATURES), seed=s) for s in range(3)])
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("few-cells")) <= 5
