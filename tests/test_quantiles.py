import numpy as np
import pandas as pd
import pytest

from rentlens.operators import binning, levels, quantiles
from rentlens.operators.quantiles import bucketed_rank, exact_median, exact_quantiles, median_mad, ranked_values, running_total

PROBS = [0.0, 0.1, 0.25, 0.5, 0.77, 1.0]


def cases():
    rng = np.random.default_rng(1)
    return {
        "normal": rng.normal(0, 1, 501), "ties": rng.integers(0, 4, 300).astype(float), "negative": -rng.exponential(5, 200),
        "constant": np.full(50, 7.0), "single": np.array([3.0]), "pair": np.array([1.0, 2.0]), "wide": 10.0 ** rng.uniform(-9, 12, 400),
        "zeros": np.array([0.0, -0.0, 0.0, 1.0, -1.0]), "hot": np.concatenate([np.full(1000, 5e5), rng.uniform(4.9e5, 5.1e5, 500)]),
    }


@pytest.mark.parametrize("few", [True, False])
def test_grouped_quantiles_equal_numpy(spark, few):
    data = cases()
    pdf = pd.concat([pd.DataFrame({"g": k, "v": v}) for k, v in data.items()])
    df = spark.createDataFrame(pdf).union(spark.sql("SELECT 'normal', cast(NULL AS double) UNION ALL SELECT NULL, 1D"))
    got = {r["g"]: (r["n"], r["q"]) for r in exact_quantiles(df, "v", PROBS, ["g"], few_groups=few).collect()}
    assert set(got) == set(data)
    for k, v in data.items():
        assert got[k][0] == len(v)
        np.testing.assert_allclose(got[k][1], np.quantile(v, PROBS), rtol=1e-12, atol=1e-12)


def test_weights_and_ranks(spark):
    df = spark.createDataFrame([(1.0, 3), (2.0, 1), (9.0, 2)], "v double, w int")
    row = ranked_values(df, "v", ["0", "2", "3", "5", "6"], weight="w").first()
    assert (row["n"], row["s0"], row["s1"], row["s2"], row["s3"], row["s4"]) == (6, 1.0, 1.0, 2.0, 9.0, None)


def test_empty_input(spark):
    assert exact_median(spark.createDataFrame([], "v double"), "v").first()["median"] is None


def test_median_mad(spark):
    v = np.random.default_rng(2).normal(10, 3, 101)
    row = median_mad(spark.createDataFrame(pd.DataFrame({"v": v})), "v").first()
    assert row["median"] == pytest.approx(np.median(v)) and row["mad"] == pytest.approx(np.median(np.abs(v - np.median(v))))


def test_bins_match_pandas_qcut(spark):
    rng = np.random.default_rng(3)
    for v in (rng.normal(0, 1, 200), rng.integers(0, 3, 90).astype(float), np.arange(11.0)):
        df = spark.createDataFrame(pd.DataFrame({"i": range(len(v)), "v": v}))
        got = [r["bin"] for r in binning.quantile_bin(df, "v", 5).orderBy("i").collect()]
        assert got == list(pd.qcut(v, 5, labels=False, duplicates="drop"))


def test_constant_column_is_one_bin(spark):
    df = spark.createDataFrame([(2.0,)] * 5, "v double")
    assert {r["bin"] for r in binning.quantile_bin(df, "v", 10).collect()} == {0}
    assert {r["confianza"] for r in binning.confidence_tier(df, "v").collect()} == {"alta confianza"}


def test_zero_mad_uses_tiny_divisor(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 1.0), (1.0, 0.0)], "y double, p double")
    rows, stats = binning.robust_z_by_bin(df, "y", "p", 1)
    assert stats.first()["mad"] == 0.0
    assert max(r["z"] for r in rows.collect()) == pytest.approx(1e6)


def test_calibration_labels_like_the_batch(spark):
    rng = np.random.default_rng(4)
    y = rng.uniform(100, 1000, 300)
    pdf = pd.DataFrame({"id": range(300), "y": y, **{f"p{i}": y * rng.normal(1, 0.1, 300) for i in range(3)}})
    df = spark.createDataFrame(pdf)
    preds = ["p0", "p1", "p2"]
    batch = {r["id"]: (r["decil_precio"], r["etiqueta"], r["nivel_confianza"]) for r in binning.label_opportunities(df, "id", "y", preds).collect()}
    cal = binning.stored_calibration(binning.calibrate(df, "y", preds))
    served = {r["id"]: (r["decil"], r["etiqueta"], r["nivel_confianza"]) for r in binning.score_rows(df, cal, "y", preds).collect()}
    assert batch == served
    far = spark.createDataFrame([(1, 1e9, 1.0, 1.0, 1.0), (2, None, 1.0, 1.0, 1.0)], "id int, y double, p0 double, p1 double, p2 double")
    assert [(r["id"], r["decil"]) for r in binning.score_rows(far, cal, "y", preds).collect()] == [(1, 9)]


def test_running_total_and_rank(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"k": range(100), "o": rng.integers(-3, 4, 100).astype(float), "w": rng.integers(1, 9, 100)})
    got = {r["k"]: r["cum"] for r in running_total(spark.createDataFrame(pdf), "o", "w", "k").collect()}
    s = pdf.sort_values(["o", "k"])
    assert got == dict(zip(s["k"], s["w"].cumsum()))
    ranked = bucketed_rank(spark.createDataFrame(pdf), ["w"], "o", "k", "cast(floor(o) AS bigint)").collect()
    want = pdf.sort_values(["w", "o", "k"]).groupby("w").cumcount() + 1
    assert {r["k"]: r["rank"] for r in ranked} == want.to_dict()


def test_levels_equal_numpy(spark):
    rng = np.random.default_rng(6)
    pdf = pd.DataFrame({"g": rng.integers(0, 12, 400).astype(str), "v": rng.gamma(3, 2, 400)})
    pdf.loc[pdf.index[:9], "g"] = None
    table, default = levels.weighted_quantile_levels(spark.createDataFrame(pdf), "v", "g")
    overall = pdf["v"].mean()
    s = pdf.groupby("g")["v"].agg(["mean", "count"])
    s["a"] = (s["count"] * s["mean"] + 20 * overall) / (s["count"] + 20)
    o = s.sort_values("a")
    cuts = np.interp([0.2, 0.4, 0.6, 0.8], (o["count"].cumsum() / o["count"].sum()).values, o["a"].values)
    row = default.first()
    np.testing.assert_allclose(row["cuts"], cuts)
    assert row["nivel_default"] == sum(overall > c for c in cuts)
    assert {r["g"]: r["nivel"] for r in table.collect()} == {g: sum(a > c for c in cuts) for g, a in s["a"].items()}


@pytest.mark.parametrize("by", [[], ["g"]])
def test_crowded_values_are_refined(spark, monkeypatch, by):
    """Values that share one bucket: epoch seconds, a narrow range, copies of one value, and a cluster far smaller than its range."""
    monkeypatch.setattr(quantiles, "SORT_ROWS", 50)
    sizes = []
    real = quantiles._found

    def spied(rows, wanted, keys, few):
        sizes.append(wanted.filter("hi > lo").agg({"size": "max"}).first()[0] or 0)
        return real(rows, wanted, keys, few)

    monkeypatch.setattr(quantiles, "_found", spied)
    rng = np.random.default_rng(7)
    data = {
        "epoch": 1.7e9 + rng.integers(0, 10**6, 4000), "narrow": 1e5 + 300 * rng.random(4000), "copies": np.append(np.full(3000, 1.5), 1.5000001),
        "cluster": np.concatenate([1000 + 1e-9 * rng.random(3000), [1000.9, 1001.5]]), "negative": -(1e5 + 300 * rng.random(2000)), "few": rng.random(10),
    }
    pdf = pd.concat([pd.DataFrame({"g": k, "v": v}) for k, v in data.items()])
    df = spark.createDataFrame(pdf)
    if by:
        got = {r["g"]: (r["n"], r["q"]) for r in exact_quantiles(df, "v", PROBS, by).collect()}
    else:
        got = {}
        for k in data:
            row = exact_quantiles(df.filter(df["g"] == k), "v", PROBS).first()
            got[k] = (row["n"], row["q"])
    for k, v in data.items():
        assert got[k][0] == len(v)
        np.testing.assert_allclose(got[k][1], np.quantile(v, PROBS), rtol=1e-13)
    assert max(sizes) <= 50


def test_a_million_values_in_one_bucket(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "SORT_ROWS", 2000)
    df = spark.range(0, 10**6, 1, 8).selectExpr("1e5D + pmod(id * 7919, 1000003) / 1000003D * 300 AS v")
    v = 1e5 + (np.arange(10**6) * 7919 % 1000003) / 1000003 * 300
    row = exact_median(df, "v").first()
    assert row["n"] == 10**6 and row["median"] == pytest.approx(np.median(v), rel=1e-14)


def test_running_total_of_one_hot_value(spark):
    df = spark.range(1000).selectExpr("id AS k", "CASE WHEN id % 10 = 0 THEN NULL WHEN id % 3 = 0 THEN 2D ELSE 5D END AS o", "1 AS w")
    got = {r["k"]: r["cum"] for r in running_total(df, "o", "w", "k").collect()}
    want = sorted(range(1000), key=lambda i: (i % 10 != 0, 0 if i % 10 == 0 else 2 if i % 3 == 0 else 5, i))
    assert got == {k: i + 1 for i, k in enumerate(want)}
