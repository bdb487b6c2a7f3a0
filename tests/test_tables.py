import datetime as dt

import pytest
from pyspark.sql import functions as F

from rentlens.operators import filters, impute, joins, ordering, quality, sampling, selection, timeline, writes
from rentlens.sources import tables

D = dt.date


def test_mode_ties_and_null_groups(spark):
    rows = [("a", 1), ("a", 1), ("a", 3), ("a", 3), ("a", None), ("b", None), (None, 5), (None, None)]
    df = spark.createDataFrame(rows, "k string, v int")
    kept = sorted(impute.group_mode_impute(df, ["v"], ["k"]).collect(), key=str)
    assert sum(r["v"] == 1 for r in kept) == 3 and [r["v"] for r in kept if r["k"] == "b"] == [None]
    assert sorted(str(r["v"]) for r in kept if r["k"] is None) == ["5", "None"]
    erased = impute.group_mode_impute(df, ["v"], ["k"], null_key="erase").filter("k IS NULL").collect()
    assert [r["v"] for r in erased] == [None, None]


def test_group_mean_then_global(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", None), ("a", 4.0)], "k string, v double")
    assert sorted(r["v"] for r in impute.group_mean_impute(df, ["v", "nope"], "k").collect()) == [1.0, 2.5, 2.5, 4.0]


def test_cascade_rounds_half_to_even(spark):
    df = spark.createDataFrame([("a", 2), ("a", 3), ("a", None), ("b", None), ("b", 9)], "k string, v int")
    assert sorted(r["v"] for r in impute.median_cascade(df, "v", None, ["k"]).collect()) == [2, 2, 3, 9, 9]


def test_null_rules_of_filters(spark):
    df = spark.createDataFrame([(1, 2, None), (2, 2, 1), (3, 9, 1)], "id int, a int, b int")
    assert [r["id"] for r in filters.max_bound_filter(df, {"a": 6, "b": 15}).collect()] == [2]
    assert [r["id"] for r in filters.max_bound_filter(df, {"a": 6, "b": 15}, null_ok=["b"]).collect()] == [1, 2]
    pts = spark.createDataFrame([(1, "40.4953", "-3.8785"), (2, None, "1"), (3, "-36.8", "-73.0"), (4, "x", "y")], "id int, la string, lo string")
    kept, out = filters.bbox_filter(pts, "la", "lo", (-37.5, -36.0), (-73.7, -72.5))
    assert [r["id"] for r in kept.collect()] == [2, 3, 4] and [r["id"] for r in out.collect()] == [1]
    pop = spark.createDataFrame([("t", "finalizado", None), ("t", "activo", None), ("t", "finalizado", D(2024, 12, 31))], "tipo string, estado string, fecha date")
    assert filters.population_filter(pop, "t", ["activo", "finalizado"], "2025-01-01", 3).count() == 2
    assert filters.population_filter(pop, "t", ["activo", "finalizado"], "2025-01-01", 0).count() == 3


def test_guards(spark):
    df = spark.range(1)
    with pytest.raises(ValueError):
        filters.require_columns(df, ["id", "x"])
    assert filters.align_columns(df, ["x", "id"]).first().asDict() == {"x": 0.0, "id": 0}


def test_fx(spark):
    df = spark.createDataFrame(
        [(1, 10.0, "$", D(2024, 1, 1)), (2, 10.0, "UF", D(2024, 1, 1)), (3, 10.0, "UF", None), (4, 10.0, "US$", D(2024, 1, 5)), (5, 10.0, "UF", D(2024, 1, 5))],
        "id int, precio double, moneda string, fecha date")
    rates = spark.createDataFrame([(D(2024, 1, 1), 2.0), (D(2024, 1, 3), 3.0)], "fecha date, valor double")
    got = {r["id"]: r["precio_clp"] for r in joins.fx_convert(df, rates, "precio", "moneda", "fecha").collect()}
    assert got == {1: 10.0, 2: 20.0, 3: 30.0, 4: 9300.0, 5: 30.0}


def test_keyed_writes(spark):
    old = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "id int, s string, v double")
    batch = spark.createDataFrame([(2, "x", 9.0, 1), (3, "y", 3.0, 1), (3, "z", 4.0, 2), (None, "n", 0.0, 3)], "id int, s string, v double, o int")
    ins = {r["id"]: r["s"] for r in writes.insert_new_only(old, batch, ["id"], ["o"]).collect()}
    assert ins == {1: "a", 2: "b", 3: "y"}
    up = writes.upsert_by_key(old, batch, ["id"], ["o"])
    assert {r["id"]: r["s"] for r in up.collect()} == {1: "a", 2: "x", 3: "z"}
    again = writes.upsert_by_key(up, batch, ["id"], ["o"])
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, up.collect()))
    part = writes.upsert_columns(old, writes.last_per_key(batch, ["id"], ["o"]), "id", ["v"])
    assert {r["id"]: (r["s"], r["v"]) for r in part.collect()} == {1: ("a", 1.0), 2: ("b", 9.0), 3: (None, 4.0)}
    assert writes.bulk_update_from(old, writes.last_per_key(batch, ["id"], ["o"]), "id", ["v"]).count() == 2


def test_history(spark):
    rows = [(D(2024, 1, 1), 1, "activo"), (D(2024, 1, 1), 2, "activo"), (D(2024, 1, 3), 2, "activo"), (D(2024, 1, 3), 3, "activo"), (D(2024, 1, 4), 2, "pausado")]
    h = spark.createDataFrame(rows, "fecha date, id int, estado string")
    got = [tuple(r) for r in timeline.entries_exits(h).orderBy("fecha").collect()]
    assert got == [(D(2024, 1, 1), None, None), (D(2024, 1, 3), 1, 1), (D(2024, 1, 4), 0, 2)]
    totals = [r["total"] for r in timeline.daily_totals(h, False).orderBy("fecha").collect()]
    assert totals == [2, 2, 0]
    assert [e - s for _, e, s in got[1:]] == [b - a for a, b in zip(totals, totals[1:])]


def test_trailing_failures(spark):
    rows = [(1, i, f) for i, f in enumerate([True, False, True, True])] + [(2, 0, True), (3, 0, False)]
    v = spark.createDataFrame(rows, "id int, seq int, fallo boolean")
    got = {r["id"]: (r["intentos_fallidos"], r["terminal"]) for r in timeline.trailing_failures(v, "id", "seq", "fallo", 1).collect()}
    assert got == {1: (2, True), 2: (1, False), 3: (0, False)}


def test_stale_runs(spark):
    runs = spark.createDataFrame([(i, 0, "ok") for i in range(4)], "c int, n int, r string")
    assert timeline.stale_run_alert(runs, "c", "n", "r", 5).first()["alerta"] is False
    assert timeline.stale_run_alert(runs, "c", "n", "r", 4).first()["alerta"] is True


def test_sort_and_page(spark):
    df = spark.createDataFrame([(1, "caro", "alta confianza"), (2, "oportunidad", "baja confianza"), (3, "raro", None), (4, "oportunidad", "alta confianza")], "id int, etiqueta string, nivel_confianza string")
    assert [r["id"] for r in ordering.sort_listings(df, "relevant").collect()] == [4, 2, 1, 3]
    pages = spark.range(50)
    assert [r["id"] for r in ordering.paginate(pages, 3, [F.col("id")]).collect()] == [48, 49]
    assert [r["id"] for r in ordering.paginate(pages, 9, [F.col("id")]).collect()][:2] == [0, 1]
    assert ordering.total_pages(spark.range(0)) == 1


def test_splits_are_exact_and_stable(spark):
    df = spark.range(1000).selectExpr("id", "cast(id AS double) AS y")
    s = sampling.stratified_split(df, "id", "y")
    n = {r["split"]: r["count"] for r in s.groupBy("split").count().collect()}
    assert n == {"test": 150, "val": 150, "train": 700}
    assert sorted(map(tuple, s.collect())) == sorted(map(tuple, sampling.stratified_split(df.repartition(7), "id", "y").collect()))
    assert sampling.stratified_quota_sample(df.withColumn("g", F.col("id") % 3), ["g"], "id", 30).count() == 30


def test_one_se_rule_and_pruning(spark):
    curve = spark.createDataFrame([(1, 10.0, 1.0), (2, 8.2, 1.0), (3, 8.0, 1.0), (4, 8.1, 1.0)], "k int, mae double, std double")
    row = selection.one_se_rule(curve, 4)
    assert (row.first()["best_k"], row.first()["argmin_k"]) == (2, 3)
    df = spark.range(100).selectExpr("cast(id AS double) AS a", "cast(id * 2 AS double) AS b", "cast(id % 7 AS double) AS c")
    assert selection.correlation_prune(df, {"b": 0.9, "a": 0.8, "c": 0.1}) == (["b", "c"], ["a"])


def test_poi_counts(spark):
    items = spark.createDataFrame([(1, "plazas", 100.0), (1, "plazas", 600.0), (1, "colegios", 900.0), (2, "colegios", None)], "id int, c string, d double")
    got = {r["id"]: tuple(r)[1:] for r in quality.poi_counts(items, "id", "c", "d", ["plazas", "colegios"]).collect()}
    assert got == {1: (1, 100.0, 0, None), 2: (None, None, 0, None)}


def test_stored_tables(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.5, None), (2, float("nan"), "x")], "id int, v double, s string")
    p = str(tmp_path / "csv")
    tables.write_dataset(df.withColumn("Unnamed: 0", F.lit(0)), p, "csv")
    back = tables.read_dataset(spark, p, columns=["v", "id", "gone"])
    assert back.columns == ["v", "id"] and back.filter("v IS NULL").count() == 1
    tables.write_feature_list(spark, ["b", "a"], str(tmp_path / "f"))
    assert tables.read_feature_list(spark, str(tmp_path / "f")) == ["b", "a"]
    levels = spark.createDataFrame([("x", 1), ("y", 4)], "barrio string, nivel int")
    extras = spark.createDataFrame([([1.0, 2.0], 2)], "cuts array<double>, nivel_default int")
    tables.write_level_map(levels, extras, "barrio", str(tmp_path / "m"))
    m, default = tables.read_level_map(spark, str(tmp_path / "m"), "barrio")
    assert {r["barrio"]: r["nivel"] for r in m.collect()} == {"x": 1, "y": 4} and default == 2
    with pytest.raises(ValueError):
        tables.replace_table(df.union(df), str(tmp_path / "r"), ["id"])
    tables.replace_table(df, str(tmp_path / "r"), ["id"])
    assert tables.insert_new_only(spark, str(tmp_path / "r"), spark.createDataFrame([(2, 1.0, "q"), (7, 1.0, "n"), (7, 2.0, "m")], df.schema), ["id"], ["v"]) == 1


def test_snapshot_overwrites_only_its_day(spark, tmp_path):
    p = str(tmp_path / "snap")
    mk = lambda rows: spark.createDataFrame(rows, "fecha date, id int, estado string")
    tables.write_snapshot(mk([(D(2024, 1, 1), 1, "activo"), (D(2024, 1, 2), 1, "activo")]), p)
    tables.write_snapshot(mk([(D(2024, 1, 2), 1, "pausado")]), p)
    assert [(r["fecha"], r["estado"]) for r in tables.read_snapshot_history(spark, p).collect()] == [(D(2024, 1, 1), "activo"), (D(2024, 1, 2), "pausado")]


def test_splits_need_no_ranks_of_rows(spark):
    """Rows are told apart by the hash at which a part ends; repeated ids, which share a hash, are ranked."""
    df = spark.range(2000).selectExpr("id", "cast(id * 37 % 997 AS double) AS y")
    for out in (sampling.stratified_split(df, "id", "y"), sampling.holdout_split_production(df, "id", "y")):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan and "Exchange" not in plan
    ranked = sampling.with_hash_rank(sampling.stratified_split(df, "id", "y"), ["estrato"], "id", 42)
    sizes = {r["estrato"]: r["n"] for r in ranked.groupBy("estrato").agg(F.count("*").alias("n")).collect()}
    for r in ranked.collect():
        n_test = round(sizes[r["estrato"]] * 0.15)
        n_val = round((sizes[r["estrato"]] - n_test) * (0.15 / 0.85))
        assert r["split"] == ("test" if r["rank"] <= n_test else "val" if r["rank"] <= n_test + n_val else "train")
    twins = spark.range(1000).selectExpr("id % 7 AS id", "cast(id AS double) AS y")
    assert dict(sampling.stratified_split(twins, "id", "y").groupBy("split").count().collect()) == {"test": 150, "val": 150, "train": 700}
