"""Radius comparables, radius imputation and nearest-neighbour fill on a grid.

Rows are first collapsed to distinct coordinates (a geocoder default can put a third of all listings
on one point), so a hot point is one probe and a list of weighted values, never all pairs of its
rows. Points meet through an equi-join on grid cells; there is no cross join.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentlens.functions.geo import cell_column, cell_row, cells_around, haversine, unit_vector, within
from rentlens.operators.counttree import ranked_around
from rentlens.operators.tiles import ranked_in_tiles
from rentlens.operators.quantiles import exact_quantiles, iqr_bounds, run
from rentlens.session import materialise, parallelism

# a location whose surrounding cells hold at most this many donor rows is solved from one array
ARRAY_LIMIT = 256
# a place with more spots in the cells around it is solved over a tree of counts, not in one task's tiles
TILE_LIMIT = 1_000_000
SPOTS_AROUND = "aggregate(cells, 0L, (n, c) -> n + c.spots)"
# a cell with more spots than this is split into several salted parts, each joined by its own task
SALT_ROWS = 2_000
# ranks around the middle: enough for the plain median and for the median without one own value
_MIDDLE = ["floor((n - 2) / 2)", "floor((n - 2) / 2) + 1", "floor((n - 2) / 2) + 2"]


def middle_ranks(n: np.ndarray) -> np.ndarray:
    """``_MIDDLE`` for arrays."""
    return (n - 2) // 2 + np.arange(len(_MIDDLE))[:, None]


def collapse(points: DataFrame) -> DataFrame:
    """Distinct (g, lat, lon, v) with their row count w, written once: every later step reads this small table."""
    counted = run(
        """SELECT g, lat, lon, v, count(*) AS w FROM {d}
        WHERE g IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL AND v IS NOT NULL GROUP BY g, lat, lon, v""",
        d=points,
    )
    return materialise(counted, "spots")


def neighbour_middle(probes: DataFrame, spots: DataFrame, radius_m: float) -> DataFrame:
    """Middle order statistics of the values within ``radius_m`` of each probe location.

    ``probes`` has columns g, lat, lon; ``spots`` comes from ``collapse``. Returns one row per distinct
    probe location that has a spot in reach: ``g, lat, lon, n, s0, s1, s2`` (see ``_MIDDLE``).

    How many rows can lie around a location is known from cell counts before any pair is made.
    Locations below ``ARRAY_LIMIT`` are solved from a bounded array; crowded ones, when there are any, tile
    by tile, where each cell's task holds the spots around the cell (up to ``TILE_LIMIT``); denser places
    over a tree of counts. Either way the work of a place grows with the rim of the circle, not with its points.
    """
    placed = run(
        f"""SELECT *, {cell_column('lon', 'cy', radius_m)} AS cx FROM
        (SELECT *, {cell_row('lat', radius_m)} AS cy FROM {{s}})""",
        s=spots,
    )
    cells = materialise(
        run(
            f"SELECT g, cy, cx, sum(w) AS cw, count(*) AS spots, count(*) DIV {SALT_ROWS} + 1 AS parts FROM {{s}} GROUP BY g, cy, cx", s=placed
        ),
        "cells",
    )
    around = materialise(
        run(
            f"""SELECT g, plat, plon, sum(cw) AS bound, collect_list(struct(cy, cx, parts, spots)) AS cells FROM
            (SELECT g, plat, plon, c.cy AS cy, c.cx AS cx FROM
              (SELECT g, lat AS plat, lon AS plon, explode({cells_around('lat', 'lon', radius_m)}) AS c FROM
                (SELECT DISTINCT g, lat, lon FROM {{p}} WHERE g IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL)))
            JOIN {{c}} USING (g, cy, cx) GROUP BY g, plat, plon""",
            p=probes,
            c=cells,
        ),
        "around",
    )
    salted = run(
        f"""SELECT g, lat, lon, v, w, cy, cx, pmod(xxhash64(lat, lon, v), parts) AS part, {unit_vector('lat', 'lon')}
        FROM {{s}} JOIN {{c}} USING (g, cy, cx)""",
        s=placed,
        c=cells,
    ).repartition(parallelism(spots.sparkSession), "g", "cy", "cx", "part")

    def pairs(condition: str, donors: DataFrame) -> DataFrame:
        return run(
            f"""SELECT a.g, a.plat, a.plon, s.v, s.w FROM
            (SELECT *, explode(sequence(0, c.parts - 1)) AS part FROM
              (SELECT g, plat, plon, explode(cells) AS c, {unit_vector('plat', 'plon')} FROM {{b}} WHERE {condition})) a
            JOIN {{s}} s ON a.g = s.g AND a.c.cy = s.cy AND a.c.cx = s.cx AND a.part = s.part
            WHERE {within('a', 'plat', 'plon', 's', 'lat', 'lon', radius_m)}""",
            b=around,
            s=donors,
        )

    # (value, weight) in value order, folded once: each wanted rank's value is the one whose weights reach it
    take = ", ".join(f"CASE WHEN r{i} >= a.c AND r{i} < a.c + x.w THEN x.v ELSE a.s{i} END AS s{i}" for i in range(3))
    ranks = ", ".join(f"cast({r} AS bigint) AS r{i}" for i, r in enumerate(_MIDDLE))
    none = ", ".join(f"cast(NULL AS double) AS s{i}" for i in range(3))
    middle = run(
        f"""SELECT g, lat, lon, n, m.s0, m.s1, m.s2 FROM
        (SELECT g, plat AS lat, plon AS lon, n, aggregate(vs, struct(0L AS c, {none}), (a, x) -> struct(a.c + x.w AS c, {take})) AS m FROM
          (SELECT *, {ranks} FROM
            (SELECT g, plat, plon, sum(w) AS n, sort_array(collect_list(struct(cast(v AS double) AS v, w))) AS vs FROM {{few}} GROUP BY g, plat, plon)))""",
        few=pairs(f"bound <= {ARRAY_LIMIT}", salted),
    )
    crowded = around.filter(F.col("bound") > ARRAY_LIMIT)
    if crowded.isEmpty():
        return middle
    numbers = spots.withColumn("v", F.col("v").cast("double"))
    tiled = crowded.filter(SPOTS_AROUND + f" <= {TILE_LIMIT}").select("g", "plat", "plon", "cells")
    middle = middle.unionByName(ranked_in_tiles(tiled, placed, radius_m, middle_ranks, len(_MIDDLE)))
    denser = crowded.filter(SPOTS_AROUND + f" > {TILE_LIMIT}")
    if denser.isEmpty():
        return middle
    return middle.unionByName(ranked_around(denser, numbers, radius_m, _MIDDLE))


def spot_median(spots: DataFrame, out: str = "fallback") -> DataFrame:
    """Median of all collapsed values per group: ``g, out``."""
    q = exact_quantiles(spots, "v", [0.5], ["g"], "w")
    return q.selectExpr("g", f"q[0] AS `{out}`")


PLAIN_MEDIAN = "CASE WHEN n % 2 = 1 THEN s1 ELSE (s0 + s1) / 2 END"


def median_without(x: str) -> str:
    """SQL: median of the located values after taking one occurrence of ``x`` out (null when none is left)."""
    first = f"(CASE WHEN s0 < {x} THEN s0 ELSE s1 END)"
    second = f"(CASE WHEN s1 < {x} THEN s1 ELSE s2 END)"
    return f"CASE WHEN n < 2 THEN NULL WHEN n % 2 = 0 THEN {first} ELSE ({first} + {second}) / 2 END"


def radius_median(
    df: DataFrame, id_col: str, lat: str, lon: str, value: str, group: str, radius_m: float = 300.0,
    iqr: float = 3.0, out: str = "sector", flag: str = "tiene_comparables",
) -> DataFrame:
    """Median ``value`` of the other rows of the group within the radius, for rows that are themselves comparable.

    Comparable rows have coordinates and a value inside the group's IQR fence. Rows that are not, and
    rows without a neighbour, get the median of the group's comparable rows and a false ``flag``.
    Self-exclusion is by row, so twins at the same point still see each other.
    """
    bounds = materialise(iqr_bounds(df, value, [group], iqr).select(group, "low", "high"), "fence")
    marked = df.join(bounds, group, "left").withColumn(
        "_ok", F.expr(f"coalesce({lat} IS NOT NULL AND {lon} IS NOT NULL AND {value} BETWEEN low AND high, false)")
    )
    valid = marked.filter("_ok").selectExpr(f"`{group}` AS g", f"{lat} AS lat", f"{lon} AS lon", f"{value} AS v")
    spots = collapse(valid)
    middle = neighbour_middle(spots, spots, radius_m)
    fallback = spot_median(spots)
    keep = ", ".join(f"m.`{c}`" for c in df.columns)
    return run(
        f"""SELECT {keep}, coalesce(near, fallback) AS `{out}`, near IS NOT NULL AS `{flag}` FROM
        (SELECT m.*, f.fallback, CASE WHEN m._ok THEN {median_without(f'm.{value}')} END AS near
         FROM {{m}} m LEFT JOIN {{f}} f ON m.`{group}` = f.g
         LEFT JOIN {{q}} q ON m.`{group}` = q.g AND m.{lat} = q.lat AND m.{lon} = q.lon) m""",
        m=marked,
        f=fallback,
        q=middle,
    )


def radius_impute(
    df: DataFrame, lat: str, lon: str, value: str, group: str, radius_m: float = 200.0, out: str | None = None
) -> DataFrame:
    """Null values with coordinates become the median of the group's known values within the radius."""
    out = out or value
    located = df.filter(f"{lat} IS NOT NULL AND {lon} IS NOT NULL").selectExpr(
        f"`{group}` AS g", f"{lat} AS lat", f"{lon} AS lon", f"cast({value} AS double) AS v"
    )
    middle = neighbour_middle(located.filter("v IS NULL"), collapse(located), radius_m)
    keep = ", ".join(f"m.`{c}`" for c in df.columns if c != out)
    return run(
        f"""SELECT {keep}, coalesce(cast(m.{value} AS double), {PLAIN_MEDIAN}) AS `{out}` FROM {{m}} m
        LEFT JOIN {{q}} q ON m.{value} IS NULL AND m.`{group}` = q.g AND m.{lat} = q.lat AND m.{lon} = q.lon""",
        m=df,
        q=middle,
    )


def lookup_median(points: DataFrame, reference: DataFrame, lat: str, lon: str, value: str, radius_m: float, out: str) -> DataFrame:
    """Adds ``out``: the median reference value within the radius of each point (null when none).

    Two separate tables, so nothing is excluded: a point also listed in the reference sees itself.
    """
    probes = points.selectExpr("1 AS g", f"{lat} AS lat", f"{lon} AS lon")
    donors = reference.selectExpr("1 AS g", f"{lat} AS lat", f"{lon} AS lon", f"cast({value} AS double) AS v")
    middle = neighbour_middle(probes, collapse(donors), radius_m)
    return run(
        f"""SELECT p.*, {PLAIN_MEDIAN} AS `{out}` FROM {{p}} p
        LEFT JOIN {{q}} q ON p.{lat} = q.lat AND p.{lon} = q.lon""",
        p=points,
        q=middle,
    )


# degrees of the cells of the donor tree, finest (about 11 m) first; each level's cells hold 8 x 8 of the one before,
# and the globe has two of the last
DONOR_LEVELS = [0.0001 * 8**k for k in range(8)]
#: Metres by which rounding may put a bound wrong.
BOUND_SLACK = 1e-3


def donor_tree(donors: DataFrame) -> list[DataFrame]:
    """Per level the occupied cells: cy, cx, their cell py, px of the next level, and a circle around their donors (clat, clon, r).

    Donors are read once, for the finest level; a circle of a coarser level is made from the circles inside, so it may
    be wider than need be.
    """
    levels, below = [], None
    for k, size in enumerate(DONOR_LEVELS):
        up = DONOR_LEVELS[k + 1] if k + 1 < len(DONOR_LEVELS) else None
        parent = f"cast(floor((clat + 90) / {up!r}D) AS bigint) AS py, cast(floor((clon + 180) / {up!r}D) AS bigint) AS px" if up else "0L AS py, 0L AS px"
        if below is None:
            rows = run(f"SELECT cy, cx, lat, lon, 0D AS r FROM {{d}}", d=donors)
        else:
            rows = run("SELECT py AS cy, px AS cx, clat AS lat, clon AS lon, r FROM {b}", b=below)
        centred = f"""SELECT *, (cy + 0.5D) * {size!r}D - 90 AS clat, (cx + 0.5D) * {size!r}D - 180 AS clon FROM {{r}}"""
        below = materialise(
            run(
                f"""SELECT *, {parent} FROM (SELECT cy, cx, any_value(clat) AS clat, any_value(clon) AS clon,
 max(r + {haversine('lat', 'lon', 'clat', 'clon')}) AS r FROM ({centred}) GROUP BY cy, cx)""",
                r=rows,
            ),
            "donor-cells",
        )
        levels.append(below)
    return levels


def nearest_fill(df: DataFrame, id_col: str, lat: str, lon: str, attr: str) -> DataFrame:
    """Null ``attr`` of rows with coordinates becomes that of the nearest row having it (smallest id among ties).

    A branch-and-bound search down a tree of occupied cells, for all points together. A cell's donors lie in a circle, so
    their distance from a point is between (distance to the centre - radius) and (distance + radius). At every level a
    point keeps the cells whose least distance does not exceed its best greatest distance; only cells are joined, and
    donors at the finest level alone, where a cell is about 11 m wide. Rows to fill without any donor are an error.
    """
    located = df.filter(f"{lat} IS NOT NULL AND {lon} IS NOT NULL").selectExpr(
        f"`{id_col}` AS id", f"{lat} AS lat", f"{lon} AS lon", f"`{attr}` AS attr"
    )
    fine = DONOR_LEVELS[0]
    # one donor per point: the smallest id stands for its twins
    donors = materialise(
        run(
            f"""SELECT lat, lon, min(id) AS id, min_by(attr, id) AS attr, cast(floor((lat + 90) / {fine!r}D) AS bigint) AS cy,
 cast(floor((lon + 180) / {fine!r}D) AS bigint) AS cx FROM {{d}} WHERE attr IS NOT NULL GROUP BY lat, lon""",
            d=located,
        ),
        "donors",
    )
    probes = located.filter("attr IS NULL").select("lat", "lon").distinct()
    if donors.isEmpty():
        if not probes.isEmpty():
            raise ValueError(f"no row with coordinates has {attr}")
        return df
    tree = donor_tree(donors)
    top = ", ".join(f"struct({r['cy']}L AS py, {r['cx']}L AS px)" for r in tree.pop().collect())
    near = run(f"SELECT lat, lon, inline(array({top})) FROM {{p}}", p=probes)
    for cells in reversed(tree):
        far = haversine("p.lat", "p.lon", "c.clat", "c.clon")
        near = run(
            f"""SELECT lat, lon, cy AS py, cx AS px FROM
 (SELECT *, min(d + r) OVER (PARTITION BY lat, lon) AS best FROM
   (SELECT p.lat, p.lon, c.cy, c.cx, c.r, {far} AS d FROM {{p}} p JOIN {{c}} c ON p.py = c.py AND p.px = c.px))
 WHERE d - r <= best + {BOUND_SLACK!r}D""",
            p=near,
            c=cells,
        )
    best = run(
        f"""SELECT p.lat, p.lon, min_by(d.attr, struct({haversine('p.lat', 'p.lon', 'd.lat', 'd.lon')}, d.id)) AS near
 FROM {{p}} p JOIN {{d}} d ON p.py = d.cy AND p.px = d.cx GROUP BY p.lat, p.lon""",
        p=near,
        d=donors,
    )
    keep = ", ".join(f"coalesce(m.`{c}`, b.near) AS `{c}`" if c == attr else f"m.`{c}`" for c in df.columns)
    return run(
        f"SELECT {keep} FROM {{m}} m LEFT JOIN {{b}} b ON m.`{attr}` IS NULL AND m.{lat} = b.lat AND m.{lon} = b.lon",
        m=df,
        b=best,
    )


def centroid_distance(df: DataFrame, centroids: DataFrame, place: str, lat: str, lon: str, centre: tuple[float, float]) -> DataFrame:
    """Adds ``dist_place_m`` (to the row's own centroid) and ``dist_centre_m``, rounded half to even to 0.1 m.

    ``centroids`` (place, clat, clon) is a lookup table; unknown places and unusable coordinates give null.
    """
    here = df.withColumns({"_la": F.expr(f"try_cast({lat} AS double)"), "_lo": F.expr(f"try_cast({lon} AS double)")})
    joined = here.join(centroids.select(place, "clat", "clon"), place, "left")
    return joined.select(
        *[F.col(c) for c in df.columns],
        F.expr(f"bround({haversine('_la', '_lo', 'clat', 'clon')}, 1)").alias("dist_place_m"),
        F.expr(f"bround({haversine('_la', '_lo', f'({centre[0]}D)', f'({centre[1]}D)')}, 1)").alias("dist_centre_m"),
    )
