"""Filters, scalar expressions, imputation, price levels and currency conversion."""

from __future__ import annotations

from pyspark.sql import functions as F

from rentlens.functions import numeric as N
from rentlens.functions import text as T
from rentlens.operators import filters, impute, joins, levels, quality
from rentlens.operators.quantiles import iqr_bounds
from rentlens.queries.registry import AS_OF, query, rounded
from rentlens.session import scratch_path
from rentlens.sources import tables

L = ["listings"]
FX = "CASE WHEN moneda='UF' THEN precio*coalesce(r.valor,(SELECT valor FROM rates WHERE fecha=(SELECT DATE '1970-01-01' + CAST(floor(avg(datediff('day', DATE '1970-01-01', fecha))) AS INT) FROM listings))) WHEN moneda='US$' THEN precio*930.0::DOUBLE ELSE precio END"


# ---- filters and projections -------------------------------------------------------------------
@query("population_filter", f"""SELECT id, estado, fecha FROM listings WHERE tipo='departamento' AND estado IN ('activo','pausado','finalizado')
 AND (estado NOT IN ('finalizado') OR fecha >= DATE '{AS_OF}' - 90)""", L)
def _(t):
    kept = filters.population_filter(t.listings, "departamento", ["activo", "pausado", "finalizado"], AS_OF, 3)
    return kept.select("id", "estado", "fecha")


@query("max_bound_filter", "SELECT id, dormitorios, banos, estacionamientos FROM listings WHERE dormitorios<=6 AND banos<=5 AND estacionamientos<=15", L)
def _(t):
    return filters.max_bound_filter(t.listings, {"dormitorios": 6, "banos": 5, "estacionamientos": 15}).select("id", "dormitorios", "banos", "estacionamientos")


@query("drop_incomplete", "SELECT id, superficie FROM listings WHERE superficie IS NOT NULL AND dormitorios IS NOT NULL AND banos IS NOT NULL", L)
def _(t):
    return filters.drop_incomplete(t.listings, ["dormitorios", "banos", "superficie"]).select("id", "superficie")


@query("bbox_filter", """SELECT id, coalesce(lat BETWEEN -37.5 AND -36.0 AND lon BETWEEN -73.7 AND -72.5, true) AS dentro FROM listings""", L)
def _(t):
    kept, out = filters.bbox_filter(t.listings, "lat", "lon", (-37.5, -36.0), (-73.7, -72.5))
    return kept.select("id", F.lit(True).alias("dentro")).union(out.select("id", F.lit(False).alias("dentro")))


@query("max_value_filter", "SELECT id, precio FROM listings WHERE precio <= 950", L)
def _(t):
    return filters.max_value_filter(t.listings, "precio", 950).select("id", "precio")


@query("sanity_split", """SELECT id, CASE WHEN dormitorios IS NULL OR banos IS NULL THEN 'sin dormitorios/baños'
 WHEN dormitorios>6 THEN 'dormitorios extremos ('||dormitorios||')' WHEN banos>5 THEN 'baños extremos ('||banos||')'
 WHEN estacionamientos>15 THEN 'estacionamientos extremos ('||estacionamientos||')'
 WHEN superficie IS NULL AND superficie_util IS NULL AND superficie_total IS NULL THEN 'sin ningún dato de superficie' END AS motivo FROM listings""", L)
def _(t):
    reason = filters.sanity_reason("dormitorios", "banos", "estacionamientos", ["superficie_util", "superficie_total", "superficie"])
    ok, bad = filters.sanity_split(t.listings, "id", reason)
    return ok.select("id", F.lit(None).cast("string").alias("motivo")).unionByName(bad)


@query("facet_filter", """SELECT id FROM listings WHERE precio BETWEEN 920 AND 1000 AND superficie_util BETWEEN 25 AND 60 AND comuna IN ('Brand#1','Brand#2','Brand#3','Brand#4')
 AND CASE WHEN dormitorios>=4 THEN '4+' ELSE dormitorios::VARCHAR END IN ('1','2','4+') AND CASE WHEN banos>=4 THEN '4+' ELSE banos::VARCHAR END IN ('1','2','3','4+') AND piscina=1""", L)
def _(t):
    return filters.facet_filter(
        t.listings, {"precio": (920, 1000), "superficie_util": (25, 60)}, {"comuna": ["Brand#1", "Brand#2", "Brand#3", "Brand#4"], "estado": []},
        {"dormitorios": ["1", "2", "4+"], "banos": ["1", "2", "3", "4+"]}, ["piscina"], optional_members=["comuna", "estado"],
    ).select("id")


@query("status_filter", "SELECT id, estado FROM listings WHERE estado IN ('activo','pausado')", L)
def _(t):
    return filters.status_filter(t.listings, include_paused=True).select("id", "estado")


@query("select_present", "SELECT id, comuna, piso FROM listings", L)
def _(t):
    return filters.select_present(t.listings, ["id", "comuna"], ["piso", "uv_rsh", "rank_nac"])


@query("drop_columns", "SELECT id, comuna, precio FROM listings", L)
def _(t):
    return filters.drop_columns(t.listings.select("id", "comuna", "precio", "lat", "lon"), ["lat", "lon", "fecha_publicacion"])


@query("align_columns", "SELECT id, banos, 0.0::DOUBLE AS cantidad_metro, dormitorios FROM listings", L)
def _(t):
    return filters.align_columns(t.listings, ["banos", "cantidad_metro", "dormitorios"], keep=["id"])


@query("price_on_total_cost", "SELECT id, round(precio+gastos,4) AS costo_total FROM listings", L)
def _(t):
    return rounded(filters.total_cost(t.listings, "precio", "gastos").select("id", "costo_total"), "costo_total", digits=4)


@query("exclude_leaky", "SELECT sum(y)::DOUBLE > 0 AS hay_objetivo, round(sum(l_quantity),2) AS l_quantity, round(sum(l_discount),2) AS l_discount, round(sum(l_tax),2) AS l_tax FROM scored", ["scored"])
def _(t):
    s = t.scored.select("id", "y", "p1", "l_quantity", "l_discount", "l_tax")
    kept = filters.exclude_leaky(s, "id", "y", ["p1"])
    return rounded(s.agg((F.sum("y") > 0).alias("hay_objetivo"), *[F.sum(c).alias(c) for c in kept]), *kept, digits=2)


@query("require_columns", "SELECT id, superficie, banos FROM listings WHERE superficie IS NOT NULL", L)
def _(t):
    return filters.require_columns(t.listings, ["superficie", "banos"]).filter("superficie IS NOT NULL").select("id", "superficie", "banos")


@query("check_constraints", """SELECT 'estado' AS columna, count(*) FILTER (WHERE estado NOT IN ('activo','pausado','finalizado')) AS violaciones FROM listings
 UNION ALL SELECT 'moneda', count(*) FILTER (WHERE moneda NOT IN ('$','UF','US$')) FROM listings""", L)
def _(t):
    return filters.check_constraints(t.listings, {"estado": ["activo", "pausado", "finalizado"], "moneda": ["$", "UF", "US$"]})


@query("drop_unfetchable", "SELECT id, url FROM listings WHERE url IS NOT NULL ORDER BY id LIMIT 500", L)
def _(t):
    return filters.drop_unfetchable(t.listings.select("id", "url"), "url", 500, ["id"])


@query("missing_detail_backfill_queue", "SELECT l.id, l.url FROM listings l JOIN orders o ON l.id = o.o_orderkey WHERE l.estado='activo' AND l.fecha IS NULL", L)
def _(t):
    details = t.orders.select(F.col("o_orderkey").alias("id"))
    return filters.status_filter(t.listings, False).filter("fecha IS NULL").join(details, "id").select("id", "url")


# ---- scalar expressions ------------------------------------------------------------------------
@query("to_numeric_or_null", "SELECT id, try_cast(trim(numero_txt) AS DOUBLE) AS v, trunc(try_cast(trim(numero_txt) AS DOUBLE))::INT AS i FROM raw_listings", ["raw_listings"])
def _(t):
    return t.raw_listings.select("id", T.to_number("numero_txt").alias("v"), T.to_integer("numero_txt").alias("i"))


@query("decimal_comma_to_double", "SELECT id, try_cast(replace(trim(lat_txt),',','.') AS DOUBLE) AS v FROM raw_listings", ["raw_listings"])
def _(t):
    return t.raw_listings.select("id", T.decimal_comma("lat_txt").alias("v"))


@query("digits_only_price", "SELECT id, try_cast(nullif(regexp_replace(precio_txt,'[^0-9]','','g'),'') AS DOUBLE) AS v FROM raw_listings", ["raw_listings"])
def _(t):
    return t.raw_listings.select("id", T.digits_only("precio_txt").alias("v"))


@query("parse_local_amount", """, n AS (SELECT id, trim(gastos_txt) AS s, try_cast(replace(CASE WHEN contains(trim(gastos_txt),'.') THEN replace(trim(gastos_txt),'.','') ELSE trim(gastos_txt) END, ',','.') AS DOUBLE) AS v FROM raw_listings)
 SELECT id, CASE WHEN v<1000 AND NOT contains(s,'.') THEN 0.0 WHEN v>500000 THEN NULL ELSE v END AS v FROM n""", ["raw_listings"])
def _(t):
    return t.raw_listings.select("id", T.local_amount("gastos_txt").alias("v"))


@query("parse_distance_m", r"""SELECT id, CASE WHEN id % 5 = 0 THEN regexp_extract(distancia_txt,'^(\d+)',1)::DOUBLE WHEN id % 5 = 1 THEN round(regexp_extract(distancia_txt,'^1\.(\d)',1)::DOUBLE*100 + 1000, 6)
 WHEN id % 5 = 3 THEN replace(regexp_extract(distancia_txt,'- (\d+,5)',1),',','.')::DOUBLE WHEN id % 5 = 4 THEN 1250.0 END AS v FROM raw_listings""", ["raw_listings"])
def _(t):
    return rounded(t.raw_listings.select("id", T.distance_metres("distancia_txt").alias("v")), "v")


@query("parse_relative_date", f"""SELECT id, CASE id % 7 WHEN 0 THEN DATE '{AS_OF}' WHEN 1 THEN DATE '{AS_OF}' - 3 WHEN 2 THEN NULL
 ELSE DATE '{AS_OF}' - (regexp_extract(publicado,'(\\d+)',1)::INT * CASE id % 7 WHEN 3 THEN 1 WHEN 4 THEN 7 WHEN 5 THEN 30 ELSE 365 END) END AS fecha,
 CASE WHEN id % 7 = 1 THEN 'aproximada_categoria' WHEN publicado IS NOT NULL THEN 'exacta' END AS precision_fecha FROM raw_listings""", ["raw_listings"])
def _(t):
    return t.raw_listings.select("id", T.relative_date("publicado", AS_OF).alias("fecha"), T.date_precision("publicado").alias("precision_fecha"))


@query("date_precision", "SELECT CASE WHEN lower(trim(publicado))='esta semana' THEN 'aproximada_categoria' WHEN length(publicado)>0 THEN 'exacta' END AS precision_fecha, count(*) AS n FROM raw_listings GROUP BY 1", ["raw_listings"])
def _(t):
    return t.raw_listings.groupBy(T.date_precision("publicado").alias("precision_fecha")).agg(F.count(F.lit(1)).alias("n"))


@query("strip_accents_lower", "SELECT id, translate(lower(trim(nombre)),'áéíóúñ','aeioun') AS minusculas, upper(strip_accents(trim(nombre))) AS mayusculas FROM raw_listings", ["raw_listings"])
def _(t):
    return t.raw_listings.select("id", T.strip_accents_lower("nombre").alias("minusculas"), T.upper_ascii("nombre").alias("mayusculas"))


@query("text_flag", "SELECT id, coalesce(regexp_matches(titulo,'amoblad[oa]|amueblad[oa]','i'),false)::INT AS amoblado FROM listings", L)
def _(t):
    return t.listings.select("id", T.text_flag("titulo").alias("amoblado"))


@query("extract_listing_id", "SELECT id, nullif(regexp_extract(url,'(MLC-[0-9]+)',1),'') AS aviso FROM raw_listings", ["raw_listings"])
def _(t):
    return t.raw_listings.select("id", T.listing_id("url").alias("aviso"))


@query("yes_no_to_bool", """SELECT id, CASE WHEN lower(trim(condominio_txt)) IN ('sí','si','true','1','1.0') THEN true WHEN lower(trim(condominio_txt)) IN ('no','false','0','0.0') THEN false END AS v,
 coalesce(lower(trim(condominio_txt)) IN ('sí','si','true','1','1.0'), false) AS v_falso FROM raw_listings""", ["raw_listings"])
def _(t):
    return t.raw_listings.select("id", T.yes_no("condominio_txt").alias("v"), T.yes_no("condominio_txt", False).alias("v_falso"))


@query("status_classify", """SELECT id, CASE WHEN mensaje IS NULL THEN 'activo' WHEN lower(mensaje) LIKE '%pausad%' THEN 'pausado' WHEN lower(mensaje) LIKE '%finaliz%' THEN 'finalizado' ELSE 'pausado' END AS estado FROM raw_listings""", ["raw_listings"])
def _(t):
    return t.raw_listings.select("id", T.status_word("mensaje").alias("estado"))


@query("safe_ratio", "SELECT id, round(superficie_total/nullif(superficie_util,0),6) AS ratio, round(coalesce(banos::DOUBLE/nullif(dormitorios,0),banos),6) AS banos_por_dormitorio FROM listings", L)
def _(t):
    return rounded(t.listings.select("id", N.safe_ratio("superficie_total", "superficie_util").alias("ratio"),
                                     N.safe_ratio("banos", "dormitorios", F.col("banos").cast("double")).alias("banos_por_dormitorio")), "ratio", "banos_por_dormitorio")


@query("fill_zero_numeric", "SELECT id, coalesce(cantidad_plazas,0)::DOUBLE AS plazas, coalesce(piscina,0)::DOUBLE AS piscina, coalesce(piso,1)::DOUBLE AS piso FROM listings", L)
def _(t):
    return t.listings.select("id", N.fill_zero("cantidad_plazas").alias("plazas"), N.fill_zero("piscina").alias("piscina"), N.fill_zero("piso", 1).alias("piso"))


@query("derived_features", """SELECT id, round(coalesce(superficie_util/nullif(dormitorios,0),superficie_util),6) AS area_per_room, round(coalesce(banos::DOUBLE/nullif(dormitorios,0),banos),6) AS baths_per_room,
 round(coalesce(estacionamientos::DOUBLE/nullif(dormitorios,0),0),6) AS parking_per_room, round(coalesce(gastos/nullif(superficie_util,0),0),6) AS charges_per_m2,
 (coalesce(piscina,0)+coalesce(ascensor,0))::DOUBLE AS amenity_index, piso*(1-ascensor) AS high_floor_no_lift, (coalesce(cantidad_plazas,0)+coalesce(cantidad_colegios,0))::DOUBLE AS poi_density,
 round(coalesce((lon+80)/nullif(lat+90,0), lon+80),6) AS distance_ratio, round(precio*superficie_util,4) AS implied_market_value, round(banos*superficie_util,4) AS level_x_area,
 round(coalesce(nullif(superficie_util,0)/nullif(superficie_total,0),1.0),6) AS space_efficiency FROM listings""", L)
def _(t):
    src = t.listings.withColumns({"d_c": F.col("lon") + 80, "d_l": F.col("lat") + 90})
    roles = {"usable_area": "superficie_util", "total_area": "superficie_total", "rooms": "dormitorios", "baths": "banos", "parking": "estacionamientos", "charges": "gastos",
             "floor": "piso", "lift": "ascensor", "dist_centre": "d_c", "dist_local": "d_l", "sector_price": "precio", "level": "banos"}
    feats = N.derived_features(roles, ["piscina", "ascensor"], ["cantidad_plazas", "cantidad_colegios"])
    out = src.select("id", *[c.alias(n) for n, c in feats.items()])
    return rounded(rounded(out, "area_per_room", "baths_per_room", "parking_per_room", "charges_per_m2", "distance_ratio", "space_efficiency"), "implied_market_value", "level_x_area", digits=4)


@query("group_rare_categories", "SELECT CASE WHEN comuna IN ('Brand#1','Brand#2','Brand#3') THEN 'otras comunas' ELSE comuna END AS comuna, count(*) AS n FROM listings GROUP BY 1", L)
def _(t):
    return t.listings.groupBy(N.group_rare("comuna", ["Brand#1", "Brand#2", "Brand#3"]).alias("comuna")).agg(F.count(F.lit(1)).alias("n"))


@query("one_hot", "SELECT id, (estado='finalizado')::INT AS estado_finalizado, (estado='no_disponible')::INT AS estado_no_disponible, (estado='pausado')::INT AS estado_pausado FROM listings", L)
def _(t):
    return t.listings.select("id", *N.one_hot("estado", ["activo", "pausado", "finalizado", "no_disponible"]))


@query("coalesce_surface", "SELECT id, coalesce(superficie_util,superficie) AS superficie_util, coalesce(superficie_total,superficie) AS superficie_total FROM listings WHERE coalesce(superficie_util,superficie) IS NOT NULL AND coalesce(superficie_total,superficie) IS NOT NULL", L)
def _(t):
    return filters.coalesce_surface(t.listings.select("id", "superficie", "superficie_util", "superficie_total"), ["superficie_util", "superficie_total"], "superficie")


@query("room_bucket", "SELECT CASE WHEN dormitorios>=4 THEN '4+' ELSE dormitorios::VARCHAR END AS tramo, count(*) AS n FROM listings GROUP BY 1", L)
def _(t):
    return t.listings.groupBy(N.room_bucket("dormitorios").alias("tramo")).agg(F.count(F.lit(1)).alias("n"))


@query("parking_flag", "SELECT id, coalesce(estacionamientos,0)>0 AS tiene FROM listings", L)
def _(t):
    return t.listings.select("id", N.parking_flag("estacionamientos").alias("tiene"))


@query("age_label", """, d AS (SELECT id, datediff('day', fecha, DATE '2024-12-30') AS n FROM listings) SELECT id, CASE WHEN n IS NULL THEN 'Publicado: fecha no disponible' WHEN n<=0 THEN 'Publicado: hoy' WHEN n=1 THEN 'Publicado: hace 1 día'
 WHEN n<30 THEN 'Publicado: hace '||n||' días' WHEN n<365 THEN 'Publicado: hace '||(n//30)||CASE WHEN n//30=1 THEN ' mes' ELSE ' meses' END ELSE 'Publicado: hace '||(n//365)||CASE WHEN n//365=1 THEN ' año' ELSE ' años' END END AS edad FROM d""", L)
def _(t):
    return t.listings.select("id", T.age_label("fecha", "2024-12-30").alias("edad"))


@query("format_thousands", r"""SELECT o_orderkey AS id, replace(format('{:,}', CAST(round_even(o_totalprice,0) AS BIGINT)), ',', '.') AS monto FROM orders""")
def _(t):
    return t.orders.select(F.col("o_orderkey").alias("id"), T.thousands("o_totalprice").alias("monto"))


@query("canonical_hash8", """SELECT id, substr(sha256('{"banos":'||banos||',"comuna":"'||comuna||'","dormitorios":'||dormitorios||'}'),1,8) AS h FROM listings""", L)
def _(t):
    return t.listings.select("id", T.canonical_hash8("dormitorios", "comuna", "banos").alias("h"))


# ---- imputation, levels, currency --------------------------------------------------------------
@query("group_mean_impute", """, m AS (SELECT comuna, avg(superficie_util) AS mu, avg(antiguedad) AS ma FROM listings WHERE comuna IS NOT NULL GROUP BY 1),
 f AS (SELECT id, coalesce(superficie_util,mu) AS su, coalesce(antiguedad,ma) AS an FROM listings LEFT JOIN m USING (comuna))
 SELECT id, round(coalesce(su,(SELECT avg(su) FROM f)),6) AS superficie_util, round(coalesce(an,(SELECT avg(an) FROM f)),6) AS antiguedad FROM f""", L)
def _(t):
    out = impute.group_mean_impute(t.listings.select("id", "comuna", "superficie_util", "antiguedad"), ["superficie_util", "antiguedad", "ausente"], "comuna")
    return rounded(out.select("id", "superficie_util", "antiguedad"), "superficie_util", "antiguedad")


@query("group_mode_impute", """, c AS (SELECT comuna, moneda, antiguedad, count(*) AS n FROM listings WHERE antiguedad IS NOT NULL GROUP BY ALL),
 m AS (SELECT comuna, moneda, antiguedad AS moda FROM (SELECT *, row_number() OVER (PARTITION BY comuna, moneda ORDER BY n DESC, antiguedad) AS k FROM c) WHERE k=1)
 SELECT id, coalesce(antiguedad, moda) AS antiguedad FROM listings LEFT JOIN m USING (comuna, moneda)""", L)
def _(t):
    return impute.group_mode_impute(t.listings.select("id", "comuna", "moneda", "antiguedad"), ["antiguedad"], ["comuna", "moneda"]).select("id", "antiguedad")


@query("median_cascade", """, x AS (SELECT *, CASE WHEN id % 3 = 0 THEN NULL ELSE barrio END AS g1 FROM listings), a AS (SELECT g1, median(antiguedad) AS m1 FROM x WHERE g1 IS NOT NULL GROUP BY 1),
 b AS (SELECT comuna, median(antiguedad) AS m2 FROM x GROUP BY 1)
 SELECT id, CAST(round_even(coalesce(antiguedad, m1, m2, (SELECT median(antiguedad) FROM x)), 0) AS INT) AS antiguedad FROM x LEFT JOIN a USING (g1) LEFT JOIN b USING (comuna)""", L)
def _(t):
    x = t.listings.select("id", "comuna", "antiguedad", F.expr("CASE WHEN id % 3 = 0 THEN NULL ELSE barrio END").alias("g1"))
    return impute.median_cascade(x, "antiguedad", None, ["g1", "comuna"]).select("id", "antiguedad")


@query("replace_outlier_with_mean", "SELECT id, round(CASE WHEN piso>30 THEN (SELECT avg(piso) FROM listings WHERE piso<=30) ELSE piso END,6) AS piso FROM listings", L)
def _(t):
    return rounded(impute.replace_outlier_with_mean(t.listings.select("id", "piso"), "piso", 30), "piso")


@query("group_transform", "SELECT id, round(avg(precio) OVER (PARTITION BY comuna),6) AS media, max(superficie) OVER (PARTITION BY comuna) AS maxima FROM listings", L)
def _(t):
    out = impute.group_transform(t.listings.select("id", "comuna", "precio", "superficie"), ["comuna"], media=F.avg("precio"), maxima=F.max("superficie"))
    return rounded(out.select("id", "media", "maxima"), "media")


#: Every column of the listings view.
LISTING_COLUMNS = (
    "id comuna tipo barrio0 barrio titulo moneda precio dormitorios banos estacionamientos superficie superficie_util superficie_total gastos antiguedad piso "
    "ascensor piscina cantidad_plazas cantidad_colegios lat lon estado fecha fecha_chequeo url"
).split()
PROFILE = " UNION ALL ".join(f"SELECT '{c}' AS columna, count(*) AS filas, count(*)-count({c}) AS nulos FROM listings" for c in LISTING_COLUMNS)


@query("null_profile", f", u AS ({PROFILE}) SELECT columna, filas, nulos, round(nulos*100.0::DOUBLE/filas,6) AS pct FROM u WHERE nulos>0", L)
def _(t):
    return rounded(quality.null_profile(t.listings), "pct")


def level_sql(tail: str) -> str:
    return f""", x AS (SELECT *, precio/nullif(superficie_util,0) AS v FROM listings), g AS (SELECT barrio, avg(v) AS m, count(v) AS n FROM x WHERE barrio IS NOT NULL GROUP BY 1),
 s AS (SELECT barrio, n, (n*m + 20.0::DOUBLE*(SELECT avg(v) FROM x))/(n+20) AS a FROM g),
 c AS (SELECT *, sum(n) OVER (ORDER BY a, barrio)::DOUBLE/(SELECT sum(n) FROM s) AS w FROM s WHERE a IS NOT NULL),
 i AS (SELECT *, lag(w) OVER (ORDER BY w) AS pw, lag(a) OVER (ORDER BY w) AS pa FROM c),
 p AS (SELECT unnest([0.2::DOUBLE,0.4::DOUBLE,0.6::DOUBLE,0.8::DOUBLE]) AS p),
 k AS (SELECT p, CASE WHEN pw IS NULL THEN a ELSE pa + (a-pa)*(p-pw)/(w-pw) END AS cut FROM (SELECT p, i.*, row_number() OVER (PARTITION BY p ORDER BY w) AS r FROM p JOIN i ON w>=p) WHERE r=1),
 lv AS (SELECT barrio, n, a, (SELECT count(*) FROM k WHERE cut < s.a)::INT AS nivel FROM s) {tail}"""


@query("smoothed_group_mean", level_sql("SELECT barrio, n, round(a,6) AS smoothed FROM s"), L)
def _(t):
    x = t.listings.withColumn("v", N.safe_ratio("precio", "superficie_util"))
    return rounded(levels.smoothed_group_mean(x, "v", "barrio").select("barrio", "n", "smoothed"), "smoothed")


@query("cumulative_share", level_sql("SELECT barrio, round(w,9) AS cum_share FROM c"), L)
def _(t):
    x = t.listings.withColumn("v", N.safe_ratio("precio", "superficie_util"))
    g = levels.smoothed_group_mean(x, "v", "barrio").filter("smoothed IS NOT NULL")
    return rounded(levels.cumulative_share(g, "smoothed", "n", "barrio").select("barrio", "cum_share"), "cum_share", digits=9)


@query("interpolate_at", level_sql("SELECT round(p,1) AS p, round(cut,6) AS cut FROM k"), L)
def _(t):
    x = t.listings.withColumn("v", N.safe_ratio("precio", "superficie_util"))
    _, cuts = levels.weighted_quantile_levels(x, "v", "barrio")
    out = cuts.select(F.posexplode("cuts").alias("i", "cut")).select(((F.col("i") + 1) * 0.2).alias("p"), "cut")
    return rounded(rounded(out, "cut"), "p", digits=1)


@query("weighted_quantile_levels", level_sql("SELECT barrio, n, round(a,6) AS smoothed, nivel, ['muy_barato','barato','medio','alto','muy_alto'][nivel+1] AS nivel_nombre FROM lv"), L)
def _(t):
    x = t.listings.withColumn("v", N.safe_ratio("precio", "superficie_util"))
    table, _ = levels.weighted_quantile_levels(x, "v", "barrio")
    return rounded(table.select("barrio", "n", "smoothed", "nivel", "nivel_nombre"), "smoothed")


@query("map_with_default", level_sql("SELECT id, coalesce(nivel, (SELECT count(*) FROM k WHERE cut < (SELECT avg(v) FROM x)))::INT AS nivel FROM listings LEFT JOIN lv USING (barrio)"), L)
def price_level(t):
    """Price level of every listing: cleaning, smoothed group means, weighted cuts, lookup with default."""
    x = t.listings.withColumn("v", N.safe_ratio("precio", "superficie_util"))
    return levels.add_price_level(x, "v", "barrio").select("id", "nivel")


@query("read_level_map", level_sql("SELECT barrio AS clave, nivel AS valor FROM lv"), L)
def _(t):
    x = t.listings.withColumn("v", N.safe_ratio("precio", "superficie_util"))
    table, extras = levels.weighted_quantile_levels(x, "v", "barrio")
    path = scratch_path(t.spark, "level-map")
    tables.write_level_map(table, extras, "barrio", path)
    stored, _ = tables.read_level_map(t.spark, path, "clave")
    return stored.select("clave", F.col("nivel").alias("valor"))


@query("iqr_bounds", """, q AS (SELECT tipo, quantile_cont(precio/nullif(superficie_util,0),0.25) AS a, quantile_cont(precio/nullif(superficie_util,0),0.75) AS b FROM listings GROUP BY 1)
 SELECT tipo, round(a-3*(b-a),6) AS low, round(b+3*(b-a),6) AS high FROM q""", L)
def _(t):
    return rounded(iqr_bounds(t.listings, "precio / nullif(superficie_util, 0D)", ["tipo"]).select("tipo", "low", "high"), "low", "high")


@query("fx_convert", f"SELECT id, round({FX},6) AS precio_clp FROM listings l LEFT JOIN rates r USING (fecha)", ["listings", "rates"])
def _(t):
    return rounded(joins.fx_convert(t.listings, t.rates, "precio", "moneda", "fecha").select("id", "precio_clp"), "precio_clp")


@query("union_distinct_dates", """, m AS (SELECT DATE '1970-01-01' + CAST(floor(avg(datediff('day', DATE '1970-01-01', fecha))) AS INT) AS fecha FROM listings),
 n AS (SELECT fecha FROM listings WHERE moneda='UF' AND fecha IS NOT NULL UNION SELECT fecha FROM m) SELECT fecha FROM n WHERE fecha NOT IN (SELECT fecha FROM rates)""", ["listings", "rates"])
def _(t):
    return joins.missing_rate_dates(t.listings, t.rates, "moneda", "fecha")
