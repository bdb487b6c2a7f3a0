"""Serving features: zone attributes by polygon and surfaces written back."""

import pytest
from pyspark.sql import functions as F

from rentlens.plans import features as P
from rentlens.queries.registry import Tables
from rentlens.session import materialise


@pytest.fixture(scope="module")
def served(spark):
    t = Tables(spark, "/root/testdata/sf0.001")
    table, artifacts = P.feature_table_training(t.listings, t.rates, ["departamento", "casa"], trees=3, zones=t.zones, zone_attrs=["attr"])
    reference = materialise(table, "reference")
    out, _ = P.feature_table_serving(t.listings, t.predictions, reference, artifacts)
    return t, reference, materialise(out, "served")


def test_pending_rows_get_their_polygons_attributes(served):
    t, reference, out = served
    boxes = t.zones.select("zona", F.col("attr").cast("double").alias("attr"), "x0", "y0", "w").collect()
    got = {r["id"]: r["attr"] for r in out.select("id", "attr").collect()}
    inside = 0
    means = {r["comuna"]: r["m"] for r in reference.groupBy("comuna").agg(F.avg("attr").alias("m")).collect()} if "comuna" in reference.columns else {}
    for r in t.listings.select("id", "lat", "lon", "comuna").collect():
        if r["id"] not in got or r["lat"] is None or r["lon"] is None:
            continue
        own = [b for b in boxes if b["x0"] < r["lon"] < b["x0"] + b["w"] and b["y0"] < r["lat"] < b["y0"] + b["w"]]
        if own:
            inside += 1
            assert got[r["id"]] == min(own, key=lambda b: b["zona"])["attr"]
        elif r["comuna"] in means:
            assert got[r["id"]] == pytest.approx(means[r["comuna"]])
    assert inside > 0


def test_surfaces_are_written_back(served):
    t, _, out = served
    before = {r["id"]: (r["superficie_util"], r["superficie_total"], r["precio"]) for r in t.listings.collect()}
    fixed = {r["id"]: (r["superficie_util"], r["superficie_total"]) for r in out.collect()}
    after = P.write_back_surfaces(t.listings, out)
    assert after.columns == t.listings.columns
    rows = after.collect()
    assert len(rows) == len(before) and fixed
    for r in rows:
        want = fixed.get(r["id"], before[r["id"]][:2])
        assert (r["superficie_util"], r["superficie_total"], r["precio"]) == (*want, before[r["id"]][2])
        if r["id"] in fixed and before[r["id"]][0] is not None and before[r["id"]][0] >= 30:
            assert r["superficie_util"] == before[r["id"]][0]


def test_listings_of_one_file_block_are_dealt_over_tasks_first(spark, monkeypatch):
    """All later passes read as many parts as there are tasks, though the file came as one."""
    from rentlens.session import parallelism
    from rentlens.sources.views import load

    class Enough(Exception):
        pass

    def seen(df, label):
        assert df.rdd.getNumPartitions() >= parallelism(spark) and df.count() == load(spark, "/root/testdata/sf0.001", "listings").count()
        raise Enough

    monkeypatch.setattr(P, "materialise", seen)
    with pytest.raises(Enough):
        P.feature_table_training(load(spark, "/root/testdata/sf0.001", "listings"), load(spark, "/root/testdata/sf0.001", "rates"), ["casa"])
