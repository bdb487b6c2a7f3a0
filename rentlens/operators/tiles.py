"""Order statistics of the values around crowded places, by tiles of places that share most of what is around them.

The places of a grid cell and the spots in the cells around it come to one task. There the places are cut into tiles of
a few metres, the denser the spots the smaller. Spots that lie within the radius of every place of a tile, by the
circle around the tile, are counted for all of them at once, spots that lie outside of all are left out, and only those on
the rim are compared place by place. Values are in order throughout, so a wanted rank is found by the counts of the shared
spots before each spot on the rim. The answer is exact; the distance is that of ``geo.within``.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from rentlens.functions.geo import EARTH_RADIUS_M, cell_column, cell_row
from rentlens.operators.quantiles import run
from rentlens.session import materialise, ship_package

#: Places of a cell that one task takes; more are dealt to several.
PART_PLACES = 250_000
#: Pairs of a place and a spot on the rim that a task holds at once.
PAIRS = 1 << 21


def haversine(lat1, lon1, lat2, lon2):
    """``geo.haversine`` for arrays."""
    s_lat, s_lon = np.sin(np.radians(lat2 - lat1) / 2), np.sin(np.radians(lon2 - lon1) / 2)
    a = s_lat * s_lat + np.cos(np.radians(lat1)) * np.cos(np.radians(lat2)) * s_lon * s_lon
    return 2 * EARTH_RADIUS_M * np.arctan2(np.sqrt(a), np.sqrt(np.maximum(1 - a, 0)))


def unit_vectors(lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
    la, lo = np.radians(lat), np.radians(lon)
    return np.stack([np.cos(la) * np.cos(lo), np.cos(la) * np.sin(lo), np.sin(la)], axis=1)


def tiles_of(units: np.ndarray, side: float) -> list[np.ndarray]:
    """Numbers of the places of each occupied cube of ``side`` (on the unit sphere)."""
    at = np.floor((units + 2) / side).astype(np.int64)
    order = np.lexsort(at.T)
    at = at[order]
    return np.split(order, np.flatnonzero((at[1:] != at[:-1]).any(axis=1)) + 1)


def ranked(places: np.ndarray, spots: np.ndarray, weights: np.ndarray, radius_m: float, ranks_of: Callable) -> tuple[np.ndarray, np.ndarray]:
    """(weight around each place, number of the spot at each wanted rank or -1). ``places`` and ``spots`` are (rows, 2): lat, lon; spots in order of their values.

    ``ranks_of`` gives the wanted ranks, one row each, from the weights around the places.
    """
    pu, su = unit_vectors(*places.T), unit_vectors(*spots.T)
    n = np.zeros(len(places), np.int64)
    out = np.full((len(ranks_of(n)), len(places)), -1)
    edge = 2 * np.sin(min(radius_m / EARTH_RADIUS_M, np.pi) / 2)
    limit = edge**2
    # a tile's work is all spots, a place's is a ring as wide as the tile: at this side they are about alike
    density = len(spots) / max(np.ptp(su, axis=0).max() * EARTH_RADIUS_M, radius_m) ** 2
    side = min((2 * radius_m / density) ** (1 / 3), radius_m / 4)
    for tile in tiles_of(pu, side / EARTH_RADIUS_M):
        centre = (pu[tile].min(axis=0) + pu[tile].max(axis=0)) / 2
        pc, sc = pu[tile] - centre, su - centre
        # a place's chord differs from the centre's by no more than the tile's circle
        reach = np.sqrt((pc**2).sum(axis=1).max()) + 1e-14
        apart = np.sqrt(np.einsum("ij,ij->i", sc, sc))
        inner = apart < edge * (1 - 1e-7) - reach
        rim = np.flatnonzero(~inner & (apart <= edge * (1 + 1e-7) + reach))
        shared = np.flatnonzero(inner)
        upto = np.cumsum(weights[shared])
        total = int(upto[-1]) if len(upto) else 0
        # weight of the shared spots before each spot on the rim
        before = np.r_[0, upto][np.searchsorted(shared, rim)]
        step = max(1, PAIRS // max(len(rim), 1))
        for start in range(0, len(tile), step):
            part, p = tile[start : start + step], pc[start : start + step]
            d = (p**2).sum(axis=1)[:, None] + (apart[rim] ** 2)[None] - 2 * (p @ sc[rim].T)
            inside = d < limit * (1 - 1e-7)
            hair = ~inside & (d < limit * (1 + 1e-7))
            if hair.any():
                i, j = np.nonzero(hair)
                a, b = places[part[i]], spots[rim[j]]
                inside[i, j] = haversine(a[:, 0], a[:, 1], b[:, 0], b[:, 1]) <= radius_m
            own = np.cumsum(np.where(inside, weights[rim], 0), axis=1)
            own = np.concatenate([np.zeros((len(part), 1), np.int64), own], axis=1)
            n[part] = total + own[:, -1]
            passed = own[:, 1:] + before
            for k, rank in enumerate(ranks_of(n[part])):
                # the first spot on the rim by which the rank is passed, and the weight of those before it
                j = (passed <= rank[:, None]).sum(axis=1)
                in_shared = rank - own[np.arange(len(part)), j]
                found = np.where(
                    in_shared < np.r_[before, total][j],
                    np.r_[shared, -1][np.searchsorted(upto, in_shared, "right")], np.r_[rim, -1][j],
                )
                out[k, part] = np.where((rank >= 0) & (rank < n[part]), found, -1)
    return n, out


def ranked_in_tiles(around: DataFrame, placed: DataFrame, radius_m: float, ranks_of: Callable, count: int) -> DataFrame:
    """Values at ``count`` 0-based ranks around each place: ``g, lat, lon, n, s0, s1, …``; a rank outside gives null.

    ``around`` holds the places with the cells that can be in reach: ``g, plat, plon, cells`` (array of structs of cy, cx);
    ``placed`` the weighted values ``g, lat, lon, v, w`` with their cell. Places without a value in reach have no row.
    """
    spark = around.sparkSession
    ship_package(spark)
    homes = run(
        f"SELECT *, {cell_column('plon', 'hy', radius_m)} AS hx FROM (SELECT g, plat, plon, cells, {cell_row('plat', radius_m)} AS hy FROM {{a}})", a=around
    )
    sizes = run(f"SELECT g, hy, hx, count(*) DIV {PART_PLACES} + 1 AS parts FROM {{h}} GROUP BY g, hy, hx", h=homes)
    dealt = run("SELECT h.*, pmod(xxhash64(plat, plon), parts) AS part FROM {h} h JOIN {s} USING (g, hy, hx)", h=homes, s=sizes)
    dealt = materialise(dealt, "tile-places")
    met = run("SELECT DISTINCT g, hy, hx, part, c.cy AS cy, c.cx AS cx FROM (SELECT g, hy, hx, part, explode(cells) AS c FROM {d})", d=dealt)
    spots = run("SELECT m.g AS of_g, m.hy AS of_hy, m.hx AS of_hx, m.part AS of_part, s.lat, s.lon, cast(s.v AS double) AS v, s.w FROM {m} m JOIN {s} s ON m.g = s.g AND m.cy = s.cy AND m.cx = s.cx", m=met, s=placed)
    names = ["g", "lat", "lon", "n", *[f"s{i}" for i in range(count)]]
    schema = ", ".join(f"{n} {around.schema[c].dataType.simpleString()}" for n, c in (("g", "g"), ("lat", "plat"), ("lon", "plon"))) + ", n bigint" + "".join(f", s{i} double" for i in range(count))

    def solve(places: pa.Table, found: pa.Table) -> pa.Table:
        at = [np.stack([t.column(c).to_numpy().astype(float) for c in cs], axis=1) for t, cs in ((places, ("plat", "plon")), (found, ("lat", "lon")))]
        values, weights = found.column("v").to_numpy(), found.column("w").to_numpy()
        order = np.argsort(values, kind="stable")
        n, number = ranked(at[0], at[1][order], weights[order], radius_m, ranks_of) if len(order) and len(at[0]) else (np.zeros(len(at[0]), np.int64), np.full((count, len(at[0])), -1))
        values = np.r_[values[order], np.nan]
        columns = [places.column(c) for c in ("g", "plat", "plon")] + [pa.array(n)] + [pa.array(values[x], mask=x < 0) for x in number]
        return pa.table(columns, names=names).filter(pa.array(n > 0))

    keys = ["g", "hy", "hx", "part"]
    return dealt.select(*keys, "plat", "plon").groupBy(*keys).cogroup(spots.groupBy(*[f"of_{k}" for k in keys])).applyInArrow(solve, schema)
