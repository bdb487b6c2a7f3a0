"""Distances and a latitude-row grid, as SQL expression text over column names.

The grid has rows of equal height in latitude. Each row is cut into a whole number of equal
columns, chosen so that a column is at least as wide as the row is high anywhere in the row.
Longitudes wrap, so points on both sides of 180° meet in neighbouring columns.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6_371_000.0
METRES_PER_DEGREE = EARTH_RADIUS_M * math.pi / 180.0
# a little slack so that rounding never separates two points that are exactly the radius apart
SLACK = 1.0001


def haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    """Great-circle distance in metres (atan2 form, stable near zero)."""
    s_lat = f"sin(radians({lat2} - {lat1}) / 2)"
    s_lon = f"sin(radians({lon2} - {lon1}) / 2)"
    a = f"({s_lat} * {s_lat} + cos(radians({lat1})) * cos(radians({lat2})) * {s_lon} * {s_lon})"
    return f"(2 * {EARTH_RADIUS_M!r}D * atan2(sqrt({a}), sqrt(greatest(1 - {a}, 0D))))"


def haversine_m(lat1: str, lon1: str, lat2: str, lon2: str) -> Column:
    return F.expr(haversine(lat1, lon1, lat2, lon2))


def cell_degrees(size_m: float | str) -> str:
    if isinstance(size_m, str):
        return f"({size_m} * {SLACK / METRES_PER_DEGREE!r}D)"
    return f"{float(size_m) * SLACK / METRES_PER_DEGREE!r}D"


def cell_row(lat: str, size_m: float | str) -> str:
    return f"cast(floor(({lat} + 90) / {cell_degrees(size_m)}) AS bigint)"


def columns_in_row(row: str, size_m: float | str) -> str:
    """How many columns the row has: 360° over the cell width at the row's most polar degree."""
    d = cell_degrees(size_m)
    pole = f"least(greatest(abs({row} * {d} - 90), abs(({row} + 1) * {d} - 90)), 90D)"
    return f"greatest(cast(floor(360 * cos(radians({pole})) / {d}) AS bigint), 1L)"


def cell_column(lon: str, row: str, size_m: float | str) -> str:
    n = columns_in_row(row, size_m)
    return f"pmod(cast(floor(({lon} + 180) / 360 * {n}) AS bigint), {n})"


def cells_around(lat: str, lon: str, size_m: float | str) -> str:
    """Array of distinct struct(cy, cx): the cells that can hold a point within ``size_m`` of this one."""
    d = cell_degrees(size_m)
    row = cell_row(lat, size_m)
    # widest longitude difference a point in reach can have, taken at the most polar latitude in reach
    pole = f"least(abs({lat}) + {d}, 90D)"
    reach = f"CASE WHEN {pole} >= 89.9D THEN 180D ELSE least({d} / cos(radians({pole})), 180D) END"
    first = f"cast(floor(({lon} + 180 - {reach}) / 360 * n) AS bigint)"
    last = f"cast(floor(({lon} + 180 + {reach}) / 360 * n) AS bigint)"
    whole = f"{last} - {first} + 1 >= n"
    cols = f"sequence(CASE WHEN {whole} THEN 0L ELSE {first} END, CASE WHEN {whole} THEN n - 1 ELSE {last} END)"
    rows = (
        f"transform(sequence({row} - 1, {row} + 1), r -> struct(r AS r, {columns_in_row('r', size_m)} AS n))"
    )
    cells = cols.replace(" n)", " q.n)").replace(">= n", ">= q.n").replace("THEN n - 1", "THEN q.n - 1")
    return f"flatten(transform({rows}, q -> transform({cells}, c -> struct(q.r AS cy, pmod(c, q.n) AS cx))))"


def unit_vector(lat: str, lon: str) -> str:
    """Columns ux, uy, uz of the point on the unit sphere."""
    la, lo = f"radians({lat})", f"radians({lon})"
    return f"cos({la}) * cos({lo}) AS ux, cos({la}) * sin({lo}) AS uy, sin({la}) AS uz"


def within(a: str, alat: str, alon: str, b: str, blat: str, blon: str, radius_m: float) -> str:
    """SQL: point of alias ``a`` within the radius of that of ``b``; both carry ``unit_vector`` columns.

    The squared chord decides all but a hair around the radius; only there is the haversine needed.
    """
    chord = " + ".join(f"({a}.u{i} - {b}.u{i}) * ({a}.u{i} - {b}.u{i})" for i in "xyz")
    limit = (2 * math.sin(min(radius_m / EARTH_RADIUS_M, math.pi) / 2)) ** 2
    exact = haversine(f"{a}.{alat}", f"{a}.{alon}", f"{b}.{blat}", f"{b}.{blon}")
    return f"(({chord}) < {limit * (1 - 1e-7)!r}D OR (({chord}) < {limit * (1 + 1e-7)!r}D AND {exact} <= {float(radius_m)!r}D))"
