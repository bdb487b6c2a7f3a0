"""Order statistics of the values around crowded places, by counts of whole cells instead of pairs of points.

Space: the cells around a place are halved ``DEPTH`` times, down to 1/32 of the radius; below them come the distinct
coordinates. A cell has a circle around its centre that holds its points, so it lies inside a place's radius, outside,
or across the rim. A place takes a cell that is inside as one node, however many points it has, and goes on in the four
parts of a cell on the rim; coordinates on the rim are tested one by one. A place's nodes so grow with its rim, not
with the points in reach, and a coordinate with many values is one node.

Values: the distinct values of a group are numbered in order. A number has a few digits to base ``BASE``; for each node
and each beginning of a number the counts of the next digit are one row. The wanted ranks of a place are narrowed by
one digit a pass, from the sums of its nodes' counts. The answer is exact, and no task gathers the values of a place.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentlens.functions.geo import cell_degrees, cell_row, columns_in_row, haversine, unit_vector, within
from rentlens.operators.quantiles import bucketed_rank, run, value_bucket
from rentlens.session import materialise

DEPTH = 5
BASE = 32
#: Metres by which rounding may put a circle wrong: nearer to the rim than this, a cell counts as on it.
RIM_SLACK = 1e-3
NODE = "g, lvl, a, b"


def place_points(spots: DataFrame, cells: DataFrame, radius_m: float) -> DataFrame:
    """``g, lat, lon, v, w`` of the cells (g, cy, cx) with their finest cell (fy, fx) and the columns ``n`` of their row."""
    fine = 2**DEPTH
    return run(
        f"""SELECT g, lat, lon, v, w, n, fy, fx FROM
 (SELECT *, cast(floor((lat + 90) / {cell_degrees(radius_m)} * {fine}) AS bigint) AS fy, pmod(cast(floor((lon + 180) / 360 * n * {fine}) AS bigint), n * {fine}) AS fx
  FROM (SELECT *, {columns_in_row('cy', radius_m)} AS n FROM (SELECT g, lat, lon, v, w, {cell_row('lat', radius_m)} AS cy FROM {{s}}))) p
 LEFT SEMI JOIN {{c}} c ON p.g = c.g AND shiftright(p.fy, {DEPTH}) = c.cy AND shiftright(p.fx, {DEPTH}) = c.cx""",
        s=spots,
        c=cells,
    )


def count_tree(points: DataFrame, radius_m: float) -> list[DataFrame]:
    """Cells of each level, coarsest first, as ``g, ky, kx, n, w, clat, clon, r``, and the coordinates ``g, lat, lon, ky, kx, n, w``."""
    spots = materialise(points.groupBy("g", "lat", "lon").agg(F.first("fy").alias("ky"), F.first("fx").alias("kx"), F.first("n").alias("n"), F.sum("w").alias("w")), "tree-spots")
    levels, below = [spots], spots.selectExpr("g", "ky", "kx", "n", "w", "lat AS blat", "lon AS blon", "0D AS r")
    for k in range(DEPTH, -1, -1):
        cells = run(
            f"""SELECT g, ky, kx, n, sum(w) AS w, any_value(clat) AS clat, any_value(clon) AS clon, max(r + {haversine('blat', 'blon', 'clat', 'clon')}) AS r FROM
 (SELECT *, least((ky + 0.5D) * {cell_degrees(radius_m)} / {2**k} - 90, 90D) AS clat, (kx + 0.5D) / (n * {2**k}) * 360 - 180 AS clon FROM {{b}}) GROUP BY g, ky, kx, n""",
            b=below,
        )
        levels.append(materialise(cells, "tree-cells"))
        below = levels[-1].selectExpr("g", "shiftright(ky, 1) AS ky", "shiftright(kx, 1) AS kx", "n", "w", "clat AS blat", "clon AS blon", "r")
    return levels[::-1]


def covering(probes: DataFrame, tree: list[DataFrame], radius_m: float) -> DataFrame:
    """The nodes that make up each place's circle: ``g, plat, plon, lvl, a, b, w``.

    ``probes`` has the base cells around each place: ``g, plat, plon, cy, cx``.
    """
    near, parts = probes.selectExpr("g", "plat", "plon", "cy AS py", "cx AS px"), []
    for k, cells in enumerate(tree[:-1]):
        up = 0 if k == 0 else 1
        met = run(
            f"""SELECT g, plat, plon, ky, kx, w, d + r <= {radius_m - RIM_SLACK!r}D AS inside FROM
 (SELECT p.g, p.plat, p.plon, c.ky, c.kx, c.w, c.r, {haversine('p.plat', 'p.plon', 'c.clat', 'c.clon')} AS d
  FROM {{p}} p JOIN {{c}} c ON p.g = c.g AND p.py = shiftright(c.ky, {up}) AND p.px = shiftright(c.kx, {up}))
 WHERE d - r <= {radius_m + RIM_SLACK!r}D""",
            p=near,
            c=cells,
        )
        met = materialise(met, "tree-level")
        parts.append(met.filter("inside").selectExpr("g", "plat", "plon", f"{k} AS lvl", "cast(ky AS double) AS a", "cast(kx AS double) AS b", "w"))
        near = met.filter("NOT inside").selectExpr("g", "plat", "plon", "ky AS py", "kx AS px")
    rim = run(
        f"""SELECT p.g, p.plat, p.plon, {DEPTH + 1} AS lvl, s.lat AS a, s.lon AS b, s.w
 FROM (SELECT *, {unit_vector('plat', 'plon')} FROM {{p}}) p JOIN (SELECT *, {unit_vector('lat', 'lon')} FROM {{s}}) s ON p.g = s.g AND p.py = s.ky AND p.px = s.kx
 WHERE {within('p', 'plat', 'plon', 's', 'lat', 'lon', radius_m)}""",
        p=near,
        s=tree[-1],
    )
    return materialise(reduce(DataFrame.unionByName, [*parts, rim]), "covering")


def node_codes(points: DataFrame, codes: DataFrame) -> DataFrame:
    """Weight of each value number in each node: ``g, lvl, a, b, code, w``."""
    at = ", ".join(f"struct({k} AS lvl, cast(shiftright(fy, {DEPTH - k}) AS double) AS a, cast(shiftright(fx, {DEPTH - k}) AS double) AS b)" for k in range(DEPTH + 1))
    return run(
        f"""SELECT {NODE}, code, sum(w) AS w FROM
 (SELECT p.g, c.code, p.w, inline(array({at}, struct({DEPTH + 1} AS lvl, lat AS a, lon AS b))) FROM {{p}} p JOIN {{c}} c ON p.g = c.g AND p.v = c.v)
 GROUP BY {NODE}, code""",
        p=points,
        c=codes,
    )


def ranked_around(around: DataFrame, spots: DataFrame, radius_m: float, ranks: list[str]) -> DataFrame:
    """Values at 0-based ranks (SQL over ``n``) around each place: ``g, lat, lon, n, s0, s1, …``; a rank outside gives null.

    ``around`` holds the places with the cells that can be in reach: ``g, plat, plon, cells`` (array of cy, cx);
    ``spots`` the weighted values ``g, lat, lon, v, w``. Places without a value in reach have no row.
    """
    probes = materialise(run("SELECT g, plat, plon, c.cy AS cy, c.cx AS cx FROM (SELECT g, plat, plon, explode(cells) AS c FROM {a})", a=around), "tree-probes")
    points = materialise(place_points(spots, probes.select("g", "cy", "cx").distinct(), radius_m), "tree-points")
    cover = covering(probes, count_tree(points, radius_m), radius_m)
    values = points.select("g", "v").distinct()
    codes = materialise(bucketed_rank(values, ["g"], "v", "v", value_bucket("v"), "code").withColumn("code", F.col("code") - 1), "value-numbers")
    members = materialise(node_codes(points, codes), "node-codes")
    distinct = codes.agg(F.max("group_size")).first()[0] or 1
    digits = 1
    while BASE**digits < distinct:
        digits += 1
    wanted = "array(" + ", ".join(f"struct({i} AS tag, cast({r} AS bigint) AS rank)" for i, r in enumerate(ranks)) + ")"
    totals = materialise(cover.groupBy("g", "plat", "plon").agg(F.sum("w").alias("n")), "tree-totals")
    state = totals.selectExpr("g", "plat", "plon", "0L AS head", f"filter({wanted}, t -> t.rank >= 0 AND t.rank < n) AS targets")
    counts = ", ".join(f"sum(CASE WHEN digit = {i} THEN w ELSE 0 END) AS c{i}" for i in range(BASE))
    sums = ", ".join(f"sum(h.c{i})" for i in range(BASE))
    for step in range(digits - 1, -1, -1):
        # (digit, weight of smaller digits in this beginning): the last one whose smaller weight does not pass the rank
        state = run(
            f"""WITH h AS (SELECT {NODE}, head, {counts} FROM (SELECT *, code DIV {BASE ** (step + 1)} AS head, code DIV {BASE**step} % {BASE} AS digit FROM {{m}}) GROUP BY {NODE}, head),
 s AS (SELECT c.g, c.plat, c.plon, q.head, any_value(q.targets) AS targets, array({sums}) AS cs
  FROM {{c}} c JOIN {{q}} q ON c.g = q.g AND c.plat = q.plat AND c.plon = q.plon
  JOIN h ON c.g = h.g AND c.lvl = h.lvl AND c.a = h.a AND c.b = h.b AND q.head = h.head GROUP BY c.g, c.plat, c.plon, q.head),
 t AS (SELECT g, plat, plon, head, t.tag AS tag, t.rank AS rank,
   aggregate(cs, struct(0L AS upto, 0L AS i, 0L AS digit, 0L AS before), (x, k) -> struct(x.upto + k AS upto, x.i + 1 AS i,
    CASE WHEN t.rank >= x.upto AND t.rank < x.upto + k THEN x.i ELSE x.digit END AS digit,
    CASE WHEN t.rank >= x.upto AND t.rank < x.upto + k THEN x.upto ELSE x.before END AS before)) AS f FROM (SELECT *, explode(targets) AS t FROM s))
 SELECT g, plat, plon, head * {BASE} + f.digit AS head, collect_list(struct(tag, rank - f.before AS rank)) AS targets FROM t GROUP BY g, plat, plon, head * {BASE} + f.digit""",
            m=members,
            c=cover,
            q=state,
        )
        state = materialise(state, "tree-ranks")
    picks = ", ".join(f"max(CASE WHEN tag = {i} THEN v END) AS s{i}" for i in range(len(ranks)))
    found = run(
        f"""SELECT g, plat, plon, {picks} FROM
 (SELECT s.g, s.plat, s.plon, t.tag AS tag, c.v FROM (SELECT *, explode(targets) AS t FROM {{s}}) s JOIN {{c}} c ON s.g = c.g AND s.head = c.code) GROUP BY g, plat, plon""",
        s=state,
        c=codes,
    )
    kept = ", ".join(f"f.s{i}" for i in range(len(ranks)))
    return run(f"SELECT t.g, t.plat AS lat, t.plon AS lon, t.n, {kept} FROM {{t}} t JOIN {{f}} f ON t.g = f.g AND t.plat = f.plat AND t.plon = f.plon", t=totals, f=found)
