import numpy as np
import pytest

import rentlens.operators.spatial as S
import rentlens.operators.tiles as T

RADIUS = 300.0


def brute(places, spots, weights):
    out = []
    for p in places:
        near = np.flatnonzero(T.haversine(p[0], p[1], spots[:, 0], spots[:, 1]) <= RADIUS)
        each = np.repeat(near, weights[near])
        out.append((len(each), *[each[k] if 0 <= k < len(each) else -1 for k in S.middle_ranks(np.array([len(each)]))[:, 0]]))
    return out


@pytest.mark.parametrize("centre", [(-36.8, -73.05), (10.0, 179.9999), (89.9995, 20.0)])
@pytest.mark.parametrize("spread", [0.0005, 0.006])
def test_ranks_in_tiles_equal_brute_force(monkeypatch, centre, spread):
    monkeypatch.setattr(T, "PAIRS", 500)
    r = np.random.default_rng(int(spread * 1e4))
    at = np.stack([centre[0] + r.uniform(-spread, spread, 700), (centre[1] + r.uniform(-spread, spread, 700) + 180) % 360 - 180], axis=1)
    at[:, 0] = np.minimum(at[:, 0], 90)
    weights = r.integers(1, 4, 500)
    weights[::50] = 900
    at[450:500] = at[3]
    n, found = T.ranked(at, at[:500], weights, RADIUS, S.middle_ranks)
    assert [tuple(x) for x in np.vstack([n, found]).T.tolist()] == brute(at, at[:500], weights)


@pytest.mark.parametrize(("tile_limit", "part_places"), [(10**6, 30), (0, 250_000)])
def test_crowded_places_by_tiles_and_by_counts(spark, monkeypatch, tile_limit, part_places):
    """Both exact ways for crowded places give the same; cells of many places are dealt to several tasks."""
    monkeypatch.setattr(S, "ARRAY_LIMIT", 10)
    monkeypatch.setattr(S, "TILE_LIMIT", tile_limit)
    monkeypatch.setattr(T, "PART_PLACES", part_places)
    r = np.random.default_rng(5)
    rows = [(i, "a" if i % 9 else "b", float(-36.8 + r.uniform(-0.004, 0.004)), float(-73 + r.uniform(-0.004, 0.004)), float(r.integers(0, 60))) for i in range(300)]
    rows += [(900 + i, "a", rows[1][2], rows[1][3], float(i)) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, g string, lat double, lon double, v double")
    got = {(x["g"], x["lat"], x["lon"]): (x["n"], x["s0"], x["s1"], x["s2"]) for x in S.neighbour_middle(df.select("g", "lat", "lon"), S.collapse(df), RADIUS).collect()}
    assert set(got) == {x[1:4] for x in rows}
    for (g, la, lo), found in got.items():
        near = sorted(x[4] for x in rows if x[1] == g and T.haversine(la, lo, x[2], x[3]) <= RADIUS)
        assert found == (len(near), *[near[k] if 0 <= k < len(near) else None for k in S.middle_ranks(np.array([len(near)]))[:, 0]])


def test_work_of_crowded_places_grows_with_the_rim(spark, monkeypatch):
    """Four times the spots and places of a town: the pairs that are compared one by one grow far less than sixteen times."""
    pairs = []
    cumsum = np.cumsum
    monkeypatch.setattr(T.np, "cumsum", lambda x, *a, **k: (pairs.append(x.size if x.ndim == 2 else 0), cumsum(x, *a, **k))[1])
    r, done = np.random.default_rng(2), []
    for n in (4_000, 16_000):
        at = np.stack([-36.8 + r.uniform(-0.004, 0.004, n), -73 + r.uniform(-0.004, 0.004, n)], axis=1)
        pairs.clear()
        T.ranked(at, at, np.ones(n, np.int64), RADIUS, S.middle_ranks)
        done.append(sum(pairs))
    assert done[1] < 12 * done[0] and done[1] < 16_000 * 16_000 / 4
