"""Point-in-polygon assignment from WKT text.

Polygons become horizontal bands of edges cut by the same grid rows as the points' cells, so a point
meets only the polygons whose box covers its cell, and of each only the edges at its height. Even-odd
crossing handles holes and multipolygons. A point exactly on a boundary is not guaranteed a side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentlens.operators.keys import lookup
from rentlens.operators.quantiles import run

NUMBER = r"-?[0-9.]+(?:[eE][-+]?[0-9]+)?"


def wkt_rings(wkt: str) -> str:
    """SQL: array of rings, each an array of struct(x, y), from POLYGON or MULTIPOLYGON text."""
    ring = r"'\\(([^()]+)\\)'"
    point = "transform(split(trim(p), '\\\\s+'), s -> try_cast(s AS double))"
    return (
        f"transform(regexp_extract_all({wkt}, {ring}, 1), r -> "
        f"transform(transform(split(r, ','), p -> {point}), q -> struct(q[0] AS x, q[1] AS y)))"
    )


def polygon_edges(zones: DataFrame, zone: str, wkt: str) -> DataFrame:
    """One row per edge: zone, x1, y1, x2, y2. Fails on an empty zone table."""
    if zones.isEmpty():
        raise ValueError("no polygons to load")
    return run(
        f"""SELECT zone, e.a.x AS x1, e.a.y AS y1, e.b.x AS x2, e.b.y AS y2 FROM
        (SELECT zone, explode(transform(sequence(1, size(ring) - 1), i -> struct(ring[i - 1] AS a, ring[i] AS b))) AS e FROM
          (SELECT `{zone}` AS zone, explode({wkt_rings(wkt)}) AS ring FROM {{z}}) WHERE size(ring) > 1)""",
        z=zones,
    )


def polygon_cells(edges: DataFrame, cell_deg: float) -> DataFrame:
    """cy, cx, zone, edges: for each grid cell a polygon's box covers, the polygon's edges crossing the cell's band."""
    d = f"{float(cell_deg)!r}D"
    return run(
        f"""SELECT b.cy, explode(sequence(x.c0, x.c1)) AS cx, zone, b.edges FROM
        (SELECT zone, cy, collect_list(struct(x1, y1, x2, y2)) AS edges FROM
          (SELECT *, explode(sequence(cast(floor(least(y1, y2) / {d}) AS bigint), cast(floor(greatest(y1, y2) / {d}) AS bigint))) AS cy
           FROM {{e}} WHERE y1 <> y2) GROUP BY zone, cy) b
        JOIN (SELECT zone, cast(floor(min(least(x1, x2)) / {d}) AS bigint) AS c0, cast(floor(max(greatest(x1, x2)) / {d}) AS bigint) AS c1
          FROM {{e}} GROUP BY zone) x USING (zone)""",
        e=edges,
    )


def point_in_polygon(
    df: DataFrame, zones: DataFrame, lat: str, lon: str, zone: str, wkt: str, out: str, cell_deg: float = 0.02
) -> DataFrame:
    """Adds ``out``: the smallest zone id whose polygon contains the point, null when none does.

    Points are collapsed to distinct coordinates first, so a third of the rows on one point costs one lookup.
    """
    cells = polygon_cells(polygon_edges(zones, zone, wkt), cell_deg)
    d = f"{float(cell_deg)!r}D"
    crossing = "(e.y1 > lat) <> (e.y2 > lat) AND lon < (e.x2 - e.x1) * (lat - e.y1) / (e.y2 - e.y1) + e.x1"
    found = run(
        f"""SELECT lat, lon, min(zone) AS zone FROM
        (SELECT DISTINCT {lat} AS lat, {lon} AS lon, cast(floor({lat} / {d}) AS bigint) AS cy, cast(floor({lon} / {d}) AS bigint) AS cx
         FROM {{p}} WHERE {lat} IS NOT NULL AND {lon} IS NOT NULL) p
        JOIN {{c}} c USING (cy, cx) WHERE size(filter(c.edges, e -> {crossing})) % 2 = 1 GROUP BY lat, lon""",
        p=df,
        c=cells,
    )
    return lookup(df, found.selectExpr(f"lat AS `{lat}`", f"lon AS `{lon}`", f"zone AS `{out}`"), [lat, lon])


def enrich_from_zones(df: DataFrame, zones: DataFrame, lat: str, lon: str, zone: str, wkt: str, attrs: list[str]) -> DataFrame:
    """Resolve rows that have coordinates but no zone yet, and copy the zone's attributes; other rows stay as they are."""
    pending = df.filter(F.col(zone).isNull() & F.col(lat).isNotNull() & F.col(lon).isNotNull()).drop(zone, *attrs)
    rest = df.filter(F.col(zone).isNotNull() | F.col(lat).isNull() | F.col(lon).isNull())
    solved = point_in_polygon(pending, zones, lat, lon, zone, wkt, zone)
    return rest.unionByName(solved.join(zones.select(zone, *attrs), zone, "left").select(*df.columns))
