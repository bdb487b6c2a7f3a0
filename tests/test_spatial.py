import numpy as np
import pandas as pd
import pytest

import rentlens.operators.spatial as S
from rentlens.functions.geo import EARTH_RADIUS_M, haversine_m
from rentlens.operators import polygons

R = EARTH_RADIUS_M


def dist(a, b):
    la1, lo1, la2, lo2 = map(np.radians, (a[0], a[1], b[0], b[1]))
    x = np.sin((la2 - la1) / 2) ** 2 + np.cos(la1) * np.cos(la2) * np.sin((lo2 - lo1) / 2) ** 2
    return 2 * R * np.arctan2(np.sqrt(x), np.sqrt(1 - x))


def points(n=160, seed=0, centre=(-36.8, -73.05), spread=0.006):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({"id": range(n), "g": rng.choice(["a", "b"], n, p=[0.9, 0.1])})
    pdf["lat"] = centre[0] + rng.uniform(-spread, spread, n)
    pdf["lon"] = (centre[1] + rng.uniform(-spread, spread, n) + 180) % 360 - 180
    # a third of all rows on one point, as a geocoder default would put them
    hot = rng.choice(n, n // 3, replace=False)
    pdf.loc[hot, ["lat", "lon"]] = [centre[0], centre[1]]
    pdf["v"] = rng.choice([1.0, 2.0, 3.5, 4.0, 50.0], n) + rng.integers(0, 2, n)
    pdf.loc[rng.choice(n, 8, replace=False), "v"] = np.nan
    pdf.loc[rng.choice(n, 8, replace=False), ["lat", "lon"]] = np.nan
    return pdf


def frame(spark, pdf):
    rows = [tuple(None if isinstance(x, float) and np.isnan(x) else x for x in r) for r in pdf.itertuples(index=False)]
    return spark.createDataFrame(rows, "id long, g string, lat double, lon double, v double")


def brute_median(pdf, radius):
    out = {}
    for g, d in pdf.groupby("g"):
        known = d["v"].dropna()
        q1, q3 = known.quantile([0.25, 0.75])
        ok = d[d["v"].between(q1 - 3 * (q3 - q1), q3 + 3 * (q3 - q1)) & d["lat"].notna()]
        fallback = ok["v"].median()
        for r in d.itertuples():
            near = [o.v for o in ok.itertuples() if o.id != r.id and dist((r.lat, r.lon), (o.lat, o.lon)) <= radius] if r.id in set(ok["id"]) else []
            out[r.id] = (float(np.median(near)), True) if near else (fallback, False)
    return out


@pytest.mark.parametrize("limit", [20_000, 5])
@pytest.mark.parametrize("centre", [(-36.8, -73.05), (10.0, 179.9999), (89.5, 20.0)])
def test_radius_median_equals_brute_force(spark, monkeypatch, limit, centre):
    monkeypatch.setattr(S, "ARRAY_LIMIT", limit)
    monkeypatch.setattr(S, "SALT_ROWS", 7)
    pdf = points(centre=centre)
    got = {r["id"]: (r["sector"], r["tiene_comparables"]) for r in S.radius_median(frame(spark, pdf), "id", "lat", "lon", "v", "g", 300.0).collect()}
    want = brute_median(pdf, 300.0)
    assert set(got) == set(want)
    for k, (v, flag) in want.items():
        assert got[k][1] == flag, k
        assert got[k][0] == pytest.approx(v), k


def test_radius_impute_keeps_known_values(spark):
    pdf = points(seed=3)
    got = {r["id"]: r["v"] for r in S.radius_impute(frame(spark, pdf), "lat", "lon", "v", "g", 200.0).collect()}
    for r in pdf.itertuples():
        if not np.isnan(r.v):
            assert got[r.id] == r.v
            continue
        near = [o.v for o in pdf.itertuples() if o.g == r.g and not np.isnan(o.v) and not np.isnan(o.lat) and not np.isnan(r.lat) and dist((r.lat, r.lon), (o.lat, o.lon)) <= 200]
        assert got[r.id] == (pytest.approx(np.median(near)) if near else None)


@pytest.mark.parametrize("spread", [0.01, 5.0, 60.0])
def test_nearest_fill_equals_brute_force(spark, spread):
    rng = np.random.default_rng(9)
    n = 80
    pts = [(i, float(rng.uniform(-spread, spread)), float((179 + rng.uniform(-spread, spread) + 180) % 360 - 180), None if i % 4 == 0 else f"n{i % 7}") for i in range(n)]
    pts.append((n, None, None, None))
    df = spark.createDataFrame(pts, "id int, lat double, lon double, barrio string")
    got = {r["id"]: r["barrio"] for r in S.nearest_fill(df, "id", "lat", "lon", "barrio").collect()}
    for i, la, lo, b in pts:
        if la is None:
            assert got[i] is None
        elif b is None:
            best = min((dist((la, lo), (p[1], p[2])), p[0], p[3]) for p in pts if p[3] and p[1] is not None)
            assert got[i] == best[2]
        else:
            assert got[i] == b


def test_no_pairwise_join_in_plans(spark, no_pair_join):
    df = frame(spark, points())
    no_pair_join(S.radius_median(df, "id", "lat", "lon", "v", "g", 300.0))
    no_pair_join(S.nearest_fill(df.selectExpr("id", "lat", "lon", "string(v) AS b"), "id", "lat", "lon", "b"))
    zones = spark.createDataFrame([("z", "POLYGON ((0 0, 1 0, 1 1, 0 1, 0 0))")], "z string, w string")
    no_pair_join(polygons.point_in_polygon(df, zones, "lat", "lon", "z", "w", "zone"))


def test_polygon_with_hole_and_multipolygon(spark):
    zones = spark.createDataFrame(
        [("a", "POLYGON ((0 0, 10 0, 10 10, 0 10, 0 0), (4 4, 6 4, 6 6, 4 6, 4 4))"),
         ("b", "MULTIPOLYGON (((20 20, 21 20, 21 21, 20 21, 20 20)), ((-5 -5, -4 -5, -4.5 -4, -5 -5)))"),
         ("c", "POLYGON ((1 1, 3 1, 3 3, 1 3, 1 1))")], "z string, w string")
    pts = [(1, 5.0, 5.0, None), (2, 2.0, 2.0, "a"), (3, 20.5, 20.5, "b"), (4, -4.8, -4.5, "b"), (5, 50.0, 50.0, None), (6, None, 1.0, None), (7, 9.99, 0.01, "a")]
    df = spark.createDataFrame([p[:3] for p in pts], "id int, lat double, lon double")
    for cell in (0.5, 3.0):
        got = {r["id"]: r["zone"] for r in polygons.point_in_polygon(df, zones, "lat", "lon", "z", "w", "zone", cell).collect()}
        assert got == {p[0]: p[3] for p in pts}


def test_empty_polygons_fail(spark):
    with pytest.raises(ValueError):
        polygons.polygon_edges(spark.createDataFrame([], "z string, w string"), "z", "w")


def test_haversine_known_distance(spark):
    row = spark.range(1).select(haversine_m("0D", "0D", "0D", "180D")).first()
    assert row[0] == pytest.approx(np.pi * R)


@pytest.mark.parametrize("spread", [0.0005, 0.3, 60.0])
def test_nearest_donors_by_branch_and_bound(spark, spread):
    """Donors in towns, at the poles, on both sides of 180 degrees and on a circle around a point; ties go to the smallest id."""
    r = np.random.default_rng(int(spread * 10) + 1)
    at = [(-36.8, -73.05), (-36.81, -73.0), (89.9, 10.0), (-89.99, -170.0), (0.0, 179.99), (0.0, -179.99)]
    rows = []
    for i in range(300):
        la, lo = at[r.integers(len(at))]
        lo = (lo + r.normal() * spread + 180) % 360 - 180
        rows.append((i, float(np.clip(la + r.normal() * spread, -89.995 + 0.004 * r.random(), 89.995 - 0.004 * r.random())), float(lo), f"b{i}" if r.random() < 0.6 else None))
    centre = (10.0, 10.0)
    rows += [(1000 + i, centre[0] + 0.1 * float(np.sin(a)), centre[1] + 0.1 * float(np.cos(a)), f"c{i}") for i, a in enumerate(np.linspace(0, 6.28, 40))]
    rows += [(2000, *centre, None), (2001, None, 1.0, None), (3001, 50.0, 0.001, "later"), (3000, 50.0, -0.001, "first"), (3002, 50.0, 0.0, None), (5000, 50.0, 0.001, "twin")]
    df = spark.createDataFrame(rows, "id long, lat double, lon double, b string")
    got = {x["id"]: x["b"] for x in S.nearest_fill(df, "id", "lat", "lon", "b").collect()}
    assert len(got) == len(rows)
    donors = [x for x in rows if x[3] is not None and x[1] is not None]
    for i, la, lo, b in rows:
        want = b if b is not None or la is None else min(donors, key=lambda d: (round(dist((la, lo), (d[1], d[2])), 6), d[0]))[3]
        assert got[i] == want, (i, la, lo, got[i], want, [(d, dist((la, lo), d[1:3])) for d in donors if d[3] in (got[i], want)])


def test_nearest_joins_cells_not_donors(spark):
    """A thousand donors in one town: the keys of all joins together hold few more rows than there are points."""
    r = np.random.default_rng(1)
    rows = [(i, -36.8 + 0.02 * r.random(), -73.0 + 0.02 * r.random(), "b" if i % 2 else None) for i in range(4000)]
    df = spark.createDataFrame([(i, float(a), float(o), b) for i, a, o, b in rows], "id long, lat double, lon double, b string")
    donors = df.filter("b IS NOT NULL").selectExpr("lat", "lon", "id", "b AS attr", f"cast(floor((lat + 90) / {S.DONOR_LEVELS[0]!r}D) AS bigint) AS cy", f"cast(floor((lon + 180) / {S.DONOR_LEVELS[0]!r}D) AS bigint) AS cx")
    levels = S.donor_tree(donors)
    assert max(c.groupBy("py", "px").count().agg({"count": "max"}).first()[0] for c in levels) <= 64
    assert donors.groupBy("cy", "cx").count().agg({"count": "max"}).first()[0] <= 20
    assert S.nearest_fill(df, "id", "lat", "lon", "b").filter("b IS NULL").count() == 0
