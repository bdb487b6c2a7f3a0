"""Spatial queries: radius comparables, radius imputation, nearest fill, zones and centroids."""

from __future__ import annotations

from pyspark.sql import functions as F

from rentlens.functions.geo import haversine_m
from rentlens.operators import joins, polygons, quality, spatial
from rentlens.queries.registry import query, rounded

L = ["listings"]
V = "precio/nullif(superficie_util,0)"
_X = "(pow(sin(radians(b.lat-a.lat)/2),2)+cos(radians(a.lat))*cos(radians(b.lat))*pow(sin(radians(b.lon-a.lon)/2),2))"
DIST = f"2*6371000.0::DOUBLE*atan2(sqrt({_X}),sqrt(1-{_X}))"
# a box a little larger than any radius used, to keep the brute-force check quick; the haversine decides
NEAR = "abs(a.lat-b.lat) < 0.004"
CENTRE = (-36.8265, -73.0524)

RADIUS = f""", l AS (SELECT id, tipo, lat, lon, {V} AS v FROM listings), q AS (SELECT tipo, quantile_cont(v,0.25) AS q1, quantile_cont(v,0.75) AS q3 FROM l GROUP BY 1),
 m AS (SELECT l.*, coalesce(lat IS NOT NULL AND lon IS NOT NULL AND v BETWEEN q1-3*(q3-q1) AND q3+3*(q3-q1), false) AS ok FROM l JOIN q USING (tipo)),
 f AS (SELECT tipo, median(v) AS fb FROM m WHERE ok GROUP BY 1),
 n AS (SELECT a.id, median(b.v) AS med FROM m a JOIN m b ON a.ok AND b.ok AND a.tipo=b.tipo AND a.id<>b.id AND {NEAR} AND {DIST}<=300 GROUP BY 1)
 SELECT m.id, round(coalesce(med,fb),6) AS sector, med IS NOT NULL AS tiene_comparables FROM m JOIN f USING (tipo) LEFT JOIN n USING (id)"""


@query("radius_median", RADIUS, L)
def _(t):
    src = t.listings.selectExpr("id", "tipo", "lat", "lon", "precio / nullif(superficie_util, 0D) AS v")
    out = spatial.radius_median(src, "id", "lat", "lon", "v", "tipo", 300.0)
    return rounded(out.select("id", "sector", "tiene_comparables"), "sector")


IMPUTE = f""", n AS (SELECT a.id, median(b.antiguedad) AS med FROM listings a JOIN listings b ON a.antiguedad IS NULL AND b.antiguedad IS NOT NULL AND a.tipo=b.tipo AND {NEAR} AND {DIST}<=200 GROUP BY 1)"""


@query("radius_impute", IMPUTE + " SELECT id, coalesce(antiguedad, med)::DOUBLE AS antiguedad FROM listings LEFT JOIN n USING (id)", L)
def _(t):
    return spatial.radius_impute(t.listings.select("id", "tipo", "lat", "lon", "antiguedad"), "lat", "lon", "antiguedad", "tipo", 200.0).select("id", "antiguedad")


@query("nearest_fill", f""", n AS (SELECT a.id, arg_min(b.barrio, struct_pack(d := {DIST}, i := b.id)) AS cerca FROM listings a JOIN listings b
 ON a.barrio IS NULL AND b.barrio IS NOT NULL AND a.lat IS NOT NULL AND b.lat IS NOT NULL GROUP BY 1) SELECT id, coalesce(barrio, cerca) AS barrio FROM listings LEFT JOIN n USING (id)""", L)
def _(t):
    return spatial.nearest_fill(t.listings.select("id", "lat", "lon", "barrio"), "id", "lat", "lon", "barrio").select("id", "barrio")


LOOKUP = f""", ref AS (SELECT id, comuna, lat, lon, antiguedad, piso, cantidad_plazas, {V} AS v FROM listings WHERE estado IN ('finalizado','no_disponible') AND lat IS NOT NULL AND lon IS NOT NULL),
 pts AS (SELECT id, comuna, lat, lon, antiguedad, piso, cantidad_plazas FROM listings WHERE estado IN ('activo','pausado')),
 q AS (SELECT quantile_cont(v,0.25) AS q1, quantile_cont(v,0.75) AS q3 FROM ref), fair AS (SELECT ref.* FROM ref, q WHERE v BETWEEN q1-3*(q3-q1) AND q3+3*(q3-q1)),
 s AS (SELECT a.id, median(b.v) AS sector FROM pts a JOIN fair b ON {NEAR} AND {DIST}<=300 GROUP BY 1),
 g AS (SELECT a.id, median(b.antiguedad) AS age FROM pts a JOIN ref b ON b.antiguedad IS NOT NULL AND {NEAR} AND {DIST}<=200 GROUP BY 1),
 c AS (SELECT comuna, median(antiguedad) AS cage, avg(cantidad_plazas) AS cp FROM ref GROUP BY 1)
 SELECT id, round(coalesce(antiguedad, age, cage, (SELECT median(antiguedad) FROM ref)),6) AS antiguedad, round(CASE WHEN piso>30 THEN (SELECT avg(piso) FROM ref) ELSE coalesce(piso,1) END,6) AS piso,
 round(coalesce(cantidad_plazas, cp, (SELECT avg(cantidad_plazas) FROM ref)),6) AS cantidad_plazas, round(coalesce(sector,(SELECT median(v) FROM fair)),6) AS precio_m2_sector, sector IS NOT NULL AS tiene_comparables
 FROM pts LEFT JOIN s USING (id) LEFT JOIN g USING (id) LEFT JOIN c USING (comuna)"""


@query("reference_lookup", LOOKUP, L)
def _(t):
    """Closed listings are the reference population, open ones the new points."""
    ref = t.listings.filter("estado IN ('finalizado', 'no_disponible') AND lat IS NOT NULL AND lon IS NOT NULL").withColumn("precio_m2", F.expr("precio / nullif(superficie_util, 0D)"))
    pts = t.listings.filter("estado IN ('activo', 'pausado')").select("id", "comuna", "lat", "lon", "antiguedad", "piso", "cantidad_plazas")
    out = joins.reference_lookup(pts, ref, "comuna", "lat", "lon", "antiguedad", "piso", ["cantidad_plazas"])
    return rounded(out.drop("comuna", "lat", "lon"), "antiguedad", "piso", "cantidad_plazas", "precio_m2_sector")


@query("reference_population", f"SELECT id, lat, lon, round({V},6) AS precio_m2 FROM listings WHERE lat IS NOT NULL AND lon IS NOT NULL AND superficie IS NOT NULL", L)
def _(t):
    clean = t.listings.filter("superficie IS NOT NULL").select("id", "precio", "superficie_util")
    out = joins.reference_population(clean, t.listings.select("id", "lat", "lon"), "id", "lat", "lon", "precio", "superficie_util")
    return rounded(out.select("id", "lat", "lon", "precio_m2"), "precio_m2")


@query("point_in_polygon", "SELECT l.id, min(z.zona) AS zona FROM listings l LEFT JOIN zones z ON l.lon > z.x0 AND l.lon < z.x0+z.w AND l.lat > z.y0 AND l.lat < z.y0+z.w GROUP BY 1", ["listings", "zones"])
def _(t):
    return polygons.point_in_polygon(t.listings.select("id", "lat", "lon"), t.zones, "lat", "lon", "zona", "geometria_wkt", "zona").select("id", "zona")


@query("enrich_from_zones", "SELECT l.id, CASE WHEN l.id % 4 = 0 THEN 'previa' ELSE z.zona END AS zona, CASE WHEN l.id % 4 = 0 THEN -1 ELSE z.attr END AS attr FROM listings l LEFT JOIN zones z ON l.lon > z.x0 AND l.lon < z.x0+z.w AND l.lat > z.y0 AND l.lat < z.y0+z.w", ["listings", "zones"])
def _(t):
    src = t.listings.selectExpr("id", "lat", "lon", "CASE WHEN id % 4 = 0 THEN 'previa' END AS zona", "CASE WHEN id % 4 = 0 THEN -1 END AS attr")
    return polygons.enrich_from_zones(src, t.zones, "lat", "lon", "zona", "geometria_wkt", ["attr"]).select("id", "zona", "attr")


@query("wkt_parse", "SELECT zona, x0+w AS x, y0 AS y FROM zones UNION ALL SELECT zona, x0, y0 FROM zones UNION ALL SELECT zona, x0+w, y0+w FROM zones UNION ALL SELECT zona, x0, y0+w FROM zones", ["zones"])
def _(t):
    return polygons.polygon_edges(t.zones, "zona", "geometria_wkt").select(F.col("zone").alias("zona"), F.col("x1").alias("x"), F.col("y1").alias("y"))


@query("haversine_m", f"SELECT a.id, round({DIST},3) AS m FROM listings a, (SELECT {CENTRE[0]}::DOUBLE AS lat, {CENTRE[1]}::DOUBLE AS lon) b", L)
def _(t):
    return rounded(t.listings.select("id", haversine_m("lat", "lon", f"({CENTRE[0]}D)", f"({CENTRE[1]}D)").alias("m")), "m", digits=3)


@query("centroid_distance", f""", c AS (SELECT comuna, avg(lat) AS lat, avg(lon) AS lon FROM listings WHERE comuna <> 'Brand#9' GROUP BY 1)
 SELECT a.id, round_even({DIST},1) AS dist_place_m, (SELECT round_even({DIST},1) FROM (SELECT {CENTRE[0]}::DOUBLE AS lat, {CENTRE[1]}::DOUBLE AS lon) b) AS dist_centre_m FROM listings a LEFT JOIN c b USING (comuna)""", L)
def _(t):
    centroids = t.listings.filter("comuna <> 'Brand#9'").groupBy("comuna").agg(F.avg("lat").alias("clat"), F.avg("lon").alias("clon"))
    return spatial.centroid_distance(t.listings.select("id", "comuna", "lat", "lon"), centroids, "comuna", "lat", "lon", CENTRE).select("id", "dist_place_m", "dist_centre_m")


@query("geo_centre", "SELECT round(avg(lat),8) AS lat, round(avg(lon),8) AS lon, CASE WHEN stddev_samp(lat)<0.1 THEN 12 ELSE 10 END AS zoom FROM listings", L)
def _(t):
    return rounded(quality.geo_centre(t.listings, "lat", "lon"), "lat", "lon", digits=8)


@query("poi_counts", """SELECT o_custkey AS id, count(*) FILTER (WHERE o_orderstatus='O' AND o_totalprice<=200000) + CASE WHEN count(*) FILTER (WHERE o_orderstatus='O')=0 THEN NULL ELSE 0 END AS cantidad_O, min(o_totalprice) FILTER (WHERE o_orderstatus='O' AND o_totalprice<=200000) AS distancia_min_m_O,
 CASE WHEN count(*) FILTER (WHERE o_orderstatus='F')>0 THEN count(*) FILTER (WHERE o_orderstatus='F' AND o_totalprice<=200000) END AS cantidad_F, min(o_totalprice) FILTER (WHERE o_orderstatus='F' AND o_totalprice<=200000) AS distancia_min_m_F,
 CASE WHEN count(*) FILTER (WHERE o_orderstatus='P')>0 THEN count(*) FILTER (WHERE o_orderstatus='P' AND o_totalprice<=200000) END AS cantidad_P, min(o_totalprice) FILTER (WHERE o_orderstatus='P' AND o_totalprice<=200000) AS distancia_min_m_P FROM orders GROUP BY 1""")
def _(t):
    """Orders stand for items around a customer: status is the category, total price the distance."""
    items = t.orders.select(F.col("o_custkey").alias("id"), F.col("o_orderstatus").alias("categoria"), F.col("o_totalprice").alias("d"))
    return quality.poi_counts(items, "id", "categoria", "d", ["O", "F", "P"], 200000.0)
