"""Joins, work queues, keyed writes and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from rentlens.operators import joins, writes
from rentlens.queries.registry import AS_OF, ORACLES, query
from rentlens.session import scratch_path
from rentlens.sources import tables as store
from rentlens.sources.keyed_store import KeyedStore

L = ["listings"]


def details(t):
    """One detail row per listing that has an order of the same number."""
    return t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("cliente"), F.col("o_orderpriority").alias("prioridad"))


@query("left_enrich", "SELECT l.id, o.o_orderpriority AS prioridad, c.c_nationkey AS zona, n.n_name AS nombre_zona FROM listings l LEFT JOIN orders o ON o.o_orderkey=l.id LEFT JOIN customer c ON c.c_custkey=l.id LEFT JOIN nation n ON n.n_nationkey=c.c_nationkey", L)
def _(t):
    bridge = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("zona"))
    zones = t.nation.select(F.col("n_nationkey").alias("zona"), F.col("n_name").alias("nombre_zona"))
    out = joins.left_enrich(t.listings.select("id"), details(t), "id", bridge, zones, "zona", drop=["cliente"])
    return out.select("id", "prioridad", "zona", "nombre_zona")


@query("inner_equi", "SELECT l.id, l.comuna, o.o_custkey AS cliente FROM listings l JOIN orders o ON o.o_orderkey=l.id", L)
def _(t):
    return t.listings.join(details(t), "id").select("id", "comuna", "cliente")


@query("pending_anti_join", "SELECT id FROM listings WHERE estado<>'no_disponible' AND id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus='F')", L)
def _(t):
    done = t.orders.filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("id"))
    return joins.pending_anti_join(t.listings, done, "id", "estado").select("id")


@query("unscored_anti_join", "SELECT id, 'pendiente' AS modo FROM listings WHERE id NOT IN (SELECT user_id FROM events) UNION ALL SELECT id, 'todos' FROM listings WHERE estado IN ('activo','pausado')", L)
def _(t):
    a = joins.unscored_anti_join(t.listings, t.predictions, "id").select("id", F.lit("pendiente").alias("modo"))
    return a.unionByName(joins.unscored_anti_join(t.listings, t.predictions, "id", ["activo", "pausado"]).select("id", F.lit("todos").alias("modo")))


@query("recheck_queue", f"SELECT l.id, l.fecha_chequeo FROM listings l JOIN orders o ON o.o_orderkey=l.id WHERE l.estado IN ('activo','pausado') AND (fecha_chequeo IS NULL OR fecha_chequeo <= DATE '{AS_OF}' - 10) ORDER BY fecha_chequeo ASC NULLS FIRST, l.id LIMIT 200", L)
def _(t):
    return joins.recheck_queue(t.listings, details(t), "id", AS_OF, 10, 200).select("id", "fecha_chequeo")


LATEST = ", u AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY fecha DESC, seq DESC) AS k FROM predictions) WHERE k=1)"


@query("latest_per_key", LATEST + " SELECT id, version, seq, value FROM u", ["predictions"])
def _(t):
    return joins.latest_per_key(t.predictions, ["id"], ["fecha", "seq"]).select("id", "version", "seq", "value")


@query("latest_version_join", LATEST + " SELECT l.id, l.comuna, o.o_orderpriority AS prioridad, u.version, u.value FROM listings l JOIN orders o ON o.o_orderkey=l.id JOIN u ON u.id=l.id", ["predictions", "listings"])
def _(t):
    out = joins.latest_version_join(t.listings, details(t), t.predictions.withColumnRenamed("fecha", "fecha_prediccion"), "id", ["fecha_prediccion", "seq"])
    return out.select("id", "comuna", "prioridad", "version", "value")


# ---- keyed writes: the table after the write ---------------------------------------------------
OLD = "old AS (SELECT id, estado, fecha_chequeo, precio FROM listings WHERE estado IN ('activo','pausado','finalizado'))"
BATCH = "bat AS (SELECT o_custkey AS id, 'activo' AS estado, CAST(o_orderdate AS DATE) AS fecha_chequeo, o_totalprice AS precio, o_orderkey AS seq FROM orders)"


def stored(t):
    return t.listings.filter("estado IN ('activo','pausado','finalizado')").select("id", "estado", "fecha_chequeo", "precio")


def batch(t):
    return t.orders.selectExpr("o_custkey AS id", "'activo' AS estado", "cast(o_orderdate AS date) AS fecha_chequeo", "o_totalprice AS precio", "o_orderkey AS seq")


@query("insert_new_only", f", {OLD}, {BATCH}, f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq) AS k FROM bat) WHERE k=1 AND id IS NOT NULL) SELECT * FROM old UNION ALL SELECT id, estado, fecha_chequeo, precio FROM f WHERE id NOT IN (SELECT id FROM old)", L)
def _(t):
    return writes.insert_new_only(stored(t), batch(t), ["id"], ["seq"])


@query("upsert_by_key", f", {OLD}, {BATCH}, f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS k FROM bat) WHERE k=1) SELECT * FROM old WHERE id NOT IN (SELECT id FROM f) UNION ALL SELECT id, estado, fecha_chequeo, precio FROM f", L)
def _(t):
    return writes.upsert_by_key(stored(t), batch(t), ["id"], ["seq"])


ONE = f", {OLD}, {BATCH}, f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS k FROM bat) WHERE k=1)"


@query("upsert_columns", ONE + " SELECT coalesce(o.id,f.id) AS id, o.estado, CASE WHEN f.id IS NOT NULL THEN f.fecha_chequeo ELSE o.fecha_chequeo END AS fecha_chequeo, CASE WHEN f.id IS NOT NULL THEN f.precio ELSE o.precio END AS precio FROM old o FULL JOIN f ON o.id=f.id", L)
def _(t):
    return writes.upsert_columns(stored(t), writes.last_per_key(batch(t), ["id"], ["seq"]), "id", ["fecha_chequeo", "precio"])


@query("bulk_update_from", ONE + " SELECT o.id, o.estado, o.fecha_chequeo, CASE WHEN f.id IS NOT NULL THEN f.precio ELSE o.precio END AS precio FROM old o LEFT JOIN f ON o.id=f.id", L)
def _(t):
    return writes.bulk_update_from(stored(t), writes.last_per_key(batch(t), ["id"], ["seq"]), "id", ["precio"])


@query("update_status", f", {OLD}, {BATCH} SELECT id, CASE WHEN id IN (SELECT id FROM bat) THEN 'no_disponible' ELSE estado END AS estado, CASE WHEN id IN (SELECT id FROM bat) THEN DATE '{AS_OF}' ELSE fecha_chequeo END AS fecha_chequeo, precio FROM old", L)
def _(t):
    return writes.update_status(stored(t), batch(t), "id", "no_disponible", AS_OF, "estado", "fecha_chequeo")


@query("daily_snapshot", ", m AS (SELECT max(fecha) AS f FROM snapshots), n AS (SELECT DATE '2024-01-30' AS fecha, id, estado FROM listings WHERE estado IN ('activo','pausado')) SELECT fecha, id, estado FROM snapshots s WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.fecha=s.fecha AND n.id=s.id) UNION ALL SELECT * FROM n", ["listings", "snapshots"])
def _(t):
    return writes.daily_snapshot(t.snapshots, t.listings, "2024-01-30", ["activo", "pausado"])


# ---- the same writes through the keyed store: the same checks ------------------------------------
def kept(t, rows, keys=("id",)):
    """A new keyed store that holds ``rows``."""
    table = KeyedStore.create(t.spark, scratch_path(t.spark, "store"), rows.schema, keys, 16)
    table.upsert(rows, keys, "start")
    return table


@query("store_insert_new_only")
def _(t):
    """Applied twice under one batch id: the second time changes nothing."""
    table = kept(t, stored(t))
    for _ in range(2):
        table.insert_new(batch(t), ["seq"], "b1")
    return table.read()


@query("store_upsert_by_key")
def _(t):
    """Applied twice under one batch id: the second time changes nothing."""
    table = kept(t, stored(t))
    for _ in range(2):
        table.upsert(batch(t), ["seq"], "b1")
    return table.read()


@query("store_upsert_columns")
def _(t):
    """Applied twice under one batch id: the second time changes nothing."""
    table = kept(t, stored(t))
    for _ in range(2):
        table.update_columns(batch(t), ["fecha_chequeo", "precio"], "b1", ["seq"])
    return table.read()


@query("store_bulk_update_from")
def _(t):
    """Applied twice under one batch id: the second time changes nothing."""
    table = kept(t, stored(t))
    for _ in range(2):
        table.update_columns(batch(t), ["precio"], "b1", ["seq"], insert=False)
    return table.read()


@query("store_daily_snapshot")
def _(t):
    table = kept(t, t.snapshots.select("fecha", "id", "estado"), ("fecha", "id"))
    table.replace_day(t.listings, "2024-01-30", ["activo", "pausado"], "2024-01-30")
    return table.read()


for _name in ("insert_new_only", "upsert_by_key", "upsert_columns", "bulk_update_from", "daily_snapshot"):
    ORACLES[f"store_{_name}"] = ORACLES[_name]


@query("version_registry", ", v AS (SELECT version, min(fecha) AS f, min(seq) AS s FROM predictions GROUP BY 1), n AS (SELECT *, row_number() OVER (ORDER BY s, version) AS contador FROM v) SELECT version, contador, contador=(SELECT max(contador) FROM n) AS vigente FROM n", ["predictions"])
def _(t):
    runs = t.predictions.groupBy("version").agg(F.min("seq").alias("s"))
    every, current = writes.version_registry(runs, "s", "version")
    return every.select("version", "contador", (F.col("contador") == current.select("contador").scalar()).alias("vigente"))


# ---- sets and comparisons ----------------------------------------------------------------------
@query("except_ids", "SELECT id, 'solo_a' AS lado FROM listings WHERE id NOT IN (SELECT c_custkey FROM customer) UNION ALL SELECT c_custkey, 'solo_b' FROM customer WHERE c_custkey NOT IN (SELECT id FROM listings)", L)
def _(t):
    return joins.except_ids(t.listings, t.customer.select(F.col("c_custkey").alias("id")), "id")


@query("dedupe_known_ids", "SELECT DISTINCT user_id AS id FROM events WHERE user_id NOT IN (SELECT id FROM listings WHERE estado='activo')", L)
def _(t):
    return joins.dedupe_known_ids(t.events.select(F.col("user_id").alias("id")), t.listings.filter("estado = 'activo'"), "id")


@query("missing_names", "SELECT DISTINCT barrio0 AS barrio FROM listings WHERE barrio0 NOT IN (SELECT barrio FROM listings WHERE barrio IS NOT NULL AND precio < 1000 AND dormitorios = 7)", L)
def _(t):
    found = t.listings.filter("barrio IS NOT NULL AND precio < 1000 AND dormitorios = 7").select("barrio")
    return joins.missing_names(t.listings.select(F.col("barrio0").alias("barrio")), found, "barrio")


@query("comparability_check", "SELECT DISTINCT p_type AS ajuste, 'solo_a' AS lado FROM part WHERE p_type NOT IN (SELECT p_type FROM part WHERE p_size > 49) UNION ALL SELECT 'x', 'solo_b' FROM part HAVING count(*) < 0")
def _(t):
    a = t.part.select(F.col("p_type").alias("ajuste")).distinct()
    return joins.comparability_check(a, t.part.filter("p_size > 49").select(F.col("p_type").alias("ajuste")).distinct(), ["ajuste"])


@query("source_reconciliation", """, a AS (SELECT id, comuna, precio, superficie FROM listings WHERE estado<>'finalizado'), b AS (SELECT id, comuna, CASE WHEN dormitorios=3 THEN precio+1 ELSE precio END AS precio, CASE WHEN banos=2 THEN NULL ELSE superficie END AS superficie FROM listings WHERE estado<>'pausado')
 SELECT coalesce(a.id,b.id) AS id, a.id IS NOT NULL AS en_a, b.id IS NOT NULL AS en_b, CASE WHEN a.id IS NULL OR b.id IS NULL THEN '' ELSE concat_ws(',', CASE WHEN a.comuna IS DISTINCT FROM b.comuna THEN 'comuna' END, CASE WHEN a.precio IS DISTINCT FROM b.precio THEN 'precio' END, CASE WHEN a.superficie IS DISTINCT FROM b.superficie THEN 'superficie' END) END AS difieren,
 a.id IS NOT NULL AND b.id IS NOT NULL AND a.comuna IS NOT DISTINCT FROM b.comuna AND a.precio IS NOT DISTINCT FROM b.precio AND a.superficie IS NOT DISTINCT FROM b.superficie AS coincide FROM a FULL JOIN b ON a.id=b.id""", L)
def _(t):
    a = t.listings.filter("estado <> 'finalizado'").select("id", "comuna", "precio", "superficie")
    b = t.listings.filter("estado <> 'pausado'").selectExpr("id", "comuna", "CASE WHEN dormitorios = 3 THEN precio + 1 ELSE precio END AS precio", "CASE WHEN banos = 2 THEN NULL ELSE superficie END AS superficie")
    return joins.source_reconciliation(a, b, "id", ["comuna", "precio", "superficie"])


@query("feature_list", "SELECT comuna AS feature, row_number() OVER (ORDER BY avg(precio) DESC, comuna) AS orden FROM listings GROUP BY 1", L)
def _(t):
    """Names ordered by score, numbered as the feature list file keeps them."""
    g = t.listings.groupBy(F.col("comuna").alias("feature")).agg(F.avg("precio").alias("s")).orderBy(F.desc("s"), "feature")
    path = scratch_path(t.spark, "features")
    store.write_feature_list(t.spark, [r["feature"] for r in g.collect()], path)  # one name per feature
    rows = [(f, i + 1) for i, f in enumerate(store.read_feature_list(t.spark, path))]
    return t.spark.createDataFrame(rows, "feature string, orden bigint")


@query("nested_report", "SELECT comuna, '{\"n\":'||count(*)||',\"activos\":'||count(*) FILTER (WHERE estado='activo')||'}' AS informe FROM listings GROUP BY 1", L)
def _(t):
    g = t.listings.groupBy("comuna").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("estado") == "activo").alias("activos"))
    path = scratch_path(t.spark, "report")
    store.write_report(g.select("comuna", F.struct("n", "activos").alias("informe")), path)
    return t.spark.read.schema("comuna string, informe struct<n: bigint, activos: bigint>").json(path).select("comuna", F.to_json("informe").alias("informe"))


# ---- sources and sinks: written to the shared folder and read back ------------------------------
@query("read_population", f"SELECT l.id, l.estado, o.o_custkey AS cliente FROM listings l JOIN orders o ON o.o_orderkey=l.id WHERE l.tipo='departamento' AND l.estado IN ('activo','finalizado') AND (l.estado<>'finalizado' OR l.fecha >= DATE '{AS_OF}' - 180)", L)
def _(t):
    out = store.read_population(t.listings, details(t), "id", kind="departamento", states=["activo", "finalizado"], as_of=AS_OF, max_months=6)
    return out.select("id", "estado", "cliente")


@query("read_dataset", "SELECT id, comuna, dormitorios, precio FROM listings", L)
def _(t):
    path = scratch_path(t.spark, "dataset")
    store.write_dataset(t.listings.select("id", "comuna", "dormitorios", "precio", F.col("banos").alias("Unnamed: 0")), path, "csv")
    schema = "id bigint, comuna string, dormitorios int, precio double, `Unnamed: 0` int"
    return store.read_dataset(t.spark, path, schema, ["id", "comuna", "dormitorios", "precio", "ausente"])


@query("write_dataset", "SELECT id, estado, precio FROM listings", L)
def _(t):
    path = scratch_path(t.spark, "dataset")
    store.write_dataset(t.listings.select("id", "precio", "estado"), path, partition_by=["estado"])
    return store.read_table(t.spark, path).select("id", "estado", "precio")


@query("replace_table", "SELECT zona, attr FROM zones", ["zones"])
def _(t):
    path = scratch_path(t.spark, "zones")
    store.replace_table(t.zones.select("zona", "attr"), path, ["zona"])
    return store.read_table(t.spark, path)


@query("read_polygons", "SELECT zona, 4 AS lados FROM zones", ["zones"])
def _(t):
    return store.read_polygons(t.zones, "zona", "geometria_wkt").groupBy(F.col("zone").alias("zona")).agg(F.count(F.lit(1)).cast("int").alias("lados"))


@query("archive_version", "SELECT id, version, value FROM predictions WHERE version='view'", ["predictions"])
def _(t):
    root = scratch_path(t.spark, "archive")
    for v in ("view", "click"):
        store.archive_version({"scores": t.predictions.filter(F.col("version") == v).select("id", "value")}, root, v)
    return t.spark.read.option("basePath", root).parquet(f"{root}/version=view/scores").select("id", "version", "value")


@query("read_snapshot_history", "SELECT fecha, id, estado FROM snapshots", ["snapshots"])
def _(t):
    path = scratch_path(t.spark, "history")
    store.write_snapshot(t.snapshots, path)
    return store.read_snapshot_history(t.spark, path).select("fecha", "id", "estado")
