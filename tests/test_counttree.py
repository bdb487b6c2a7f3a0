import numpy as np
import pytest

import rentlens.operators.counttree as C
import rentlens.operators.spatial as S
from rentlens.functions.geo import EARTH_RADIUS_M

RADIUS = 300.0


def dist(a, b):
    la1, lo1, la2, lo2 = map(np.radians, (a[0], a[1], b[0], b[1]))
    x = np.sin((la2 - la1) / 2) ** 2 + np.cos(la1) * np.cos(la2) * np.sin((lo2 - lo1) / 2) ** 2
    return 2 * EARTH_RADIUS_M * np.arctan2(np.sqrt(x), np.sqrt(1 - x))


def town(n, seed=0):
    """n distinct points of a square of two radii, few groups of values."""
    r = np.random.default_rng(seed)
    side = RADIUS / 111_195
    return [(i, "a", float(-36.8 + side * r.uniform(-1, 1)), float(-73.0 + side * r.uniform(-1, 1) / 0.8), float(r.integers(0, 5000)) / 4) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, g string, lat double, lon double, v double")


def cover_rows(spark, n, probes=20):
    spots = S.collapse(frame(spark, town(n)))
    cells = spots.selectExpr("g", f"{C.cell_row('lat', RADIUS)} AS cy", "lat", "lon").selectExpr("g", "cy", f"{S.cell_column('lon', 'cy', RADIUS)} AS cx").distinct()
    near = spots.limit(probes).selectExpr("g", "lat AS plat", "lon AS plon", f"inline({S.cells_around('lat', 'lon', RADIUS)})").selectExpr("g", "plat", "plon", "cy", "cx")
    points = C.place_points(spots, cells, RADIUS)
    cover = C.covering(near, C.count_tree(points, RADIUS), RADIUS)
    return cover.count(), cover.agg({"w": "sum"}).first()[0]


def test_nodes_of_a_place_grow_less_than_its_points(spark):
    few, inside_few = cover_rows(spark, 4_000)
    many, inside_many = cover_rows(spark, 16_000)
    assert inside_many > 3 * inside_few  # what pairs of points would be
    assert many < 2.2 * few
    assert many < inside_many / 8


def test_ranks_equal_brute_force_with_many_values_on_one_point(spark, monkeypatch):
    monkeypatch.setattr(S, "ARRAY_LIMIT", 0)
    rows = town(150, 3)
    lat, lon = rows[0][2:4]
    rows += [(1000 + i, "a", lat, lon, float(v)) for i, v in enumerate(np.random.default_rng(4).permutation(2500) * 1.0 - 700)]
    rows += [(9000, "a", lat + 1, lon, 5.0), (9001, "b", lat, lon, 7.0), (9002, "b", lat, lon, 8.0), (9003, None, lat, lon, 1.0), (9004, "a", None, lon, 1.0), (9005, "a", lat, lon, None)]
    df = frame(spark, rows)
    probes = df.select("g", "lat", "lon")
    got = {(x["g"], x["lat"], x["lon"]): (x["n"], x["s0"], x["s1"], x["s2"]) for x in S.neighbour_middle(probes, S.collapse(df), RADIUS).collect()}
    known = [r for r in rows if None not in r]
    assert set(got) == {r[1:4] for r in known}
    for (g, la, lo), found in got.items():
        near = sorted(r[4] for r in known if r[1] == g and dist((la, lo), r[2:4]) <= RADIUS)
        at = [(len(near) - 2) // 2 + k for k in range(3)]
        assert found == (len(near), *[near[k] if 0 <= k < len(near) else None for k in at])


@pytest.mark.parametrize("rows", [[], [(1, "a", None, None, 1.0)]])
def test_no_places(spark, monkeypatch, rows):
    monkeypatch.setattr(S, "ARRAY_LIMIT", 0)
    df = frame(spark, rows)
    assert S.neighbour_middle(df.select("g", "lat", "lon"), S.collapse(df), RADIUS).count() == 0


def test_no_pairwise_join(spark, monkeypatch, no_pair_join):
    monkeypatch.setattr(S, "ARRAY_LIMIT", 0)
    no_pair_join(S.radius_median(frame(spark, town(50)), "id", "lat", "lon", "v", "g", RADIUS))
