"""Listing-domain views over the warehouse tables.

Each view is one SELECT in a dialect that Spark SQL and the checking engine both accept, with
``{table}`` placeholders. ``load`` binds the placeholders to Parquet files, so column pruning and
filters still reach the scan; ``cte`` gives the same text as ``WITH`` items for the SQL check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_D = "cast({} as double)".format

VIEWS: dict[str, str] = {
    "listings": """
SELECT p_partkey AS id,
  p_brand AS comuna,
  CASE WHEN p_partkey % 20 = 0 THEN 'casa' ELSE 'departamento' END AS tipo,
  concat(p_type, '-', cast(p_partkey % 7 AS string)) AS barrio0,
  CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE concat(p_type, '-', cast(p_partkey % 7 AS string)) END AS barrio,
  CASE WHEN p_partkey % 15 = 0 THEN concat(p_name, ' Amoblado') WHEN p_partkey % 29 = 0 THEN NULL
       WHEN p_partkey % 31 = 0 THEN concat('AMUEBLADA ', p_name) ELSE p_name END AS titulo,
  CASE WHEN p_partkey % 10 = 0 THEN 'UF' WHEN p_partkey % 10 = 1 THEN 'US$' ELSE '$' END AS moneda,
  p_retailprice AS precio,
  p_size % 8 AS dormitorios,
  1 + p_size % 6 AS banos,
  CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_size % 4 END AS estacionamientos,
  CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE cast(20 + p_size AS double) END AS superficie,
  CASE WHEN p_partkey % 37 = 0 THEN cast(0 AS double) WHEN p_partkey % 41 = 0 THEN NULL
       ELSE cast(18 + p_size AS double) END AS superficie_util,
  CASE WHEN p_partkey % 43 = 0 THEN NULL ELSE cast(24 + p_size AS double) END AS superficie_total,
  cast(p_partkey % 9 AS double) * cast(5.0 AS double) AS gastos,
  CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_size % 30 END AS antiguedad,
  CASE WHEN p_partkey % 14 = 0 THEN NULL ELSE p_size END AS piso,
  CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE cast(p_size % 2 AS int) END AS ascensor,
  CASE WHEN p_partkey % 16 = 0 THEN NULL ELSE cast(p_partkey % 2 AS int) END AS piscina,
  CASE WHEN p_partkey % 8 = 0 THEN NULL ELSE p_size % 5 END AS cantidad_plazas,
  CASE WHEN p_partkey % 12 = 0 THEN NULL ELSE p_size % 7 END AS cantidad_colegios,
  CASE WHEN p_partkey % 50 = 0 AND p_partkey % 23 <> 0 AND p_partkey % 97 <> 0
         THEN cast(-37.20 AS double) - cast(p_partkey % 2000 AS double) / cast(10000.0 AS double)
       WHEN p_partkey % 23 = 0 THEN NULL
       WHEN p_partkey % 97 = 0 THEN cast(40.4953 AS double)
       ELSE cast(-36.80 AS double) - cast((p_partkey * 7919) % 10007 AS double) / cast(200140.0 AS double) END AS lat,
  CASE WHEN p_partkey % 23 = 0 THEN NULL
       WHEN p_partkey % 97 = 0 THEN cast(-3.8785 AS double)
       ELSE cast(-73.00 AS double) - cast((p_partkey * 104729) % 10009 AS double) / cast(200180.0 AS double) END AS lon,
  CASE p_partkey % 4 WHEN 0 THEN 'activo' WHEN 1 THEN 'pausado' WHEN 2 THEN 'finalizado' ELSE 'no_disponible' END AS estado,
  CASE WHEN p_partkey % 33 = 0 THEN NULL ELSE DATE '2024-01-01' + cast(p_partkey % 365 AS int) END AS fecha,
  CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE DATE '2024-12-01' + cast(p_size % 31 AS int) END AS fecha_chequeo,
  CASE WHEN p_partkey % 19 = 0 THEN NULL
       ELSE concat('https://example.org/MLC-', cast(1000000 + p_partkey AS string), '-', replace(p_name, ' ', '-')) END AS url
FROM {part}""",
    # dirty text fields as a crawler would deliver them
    "raw_listings": """
SELECT p_partkey AS id,
  CASE p_partkey % 7 WHEN 0 THEN 'hoy' WHEN 1 THEN 'Esta semana' WHEN 2 THEN NULL
    WHEN 3 THEN concat(cast(p_size AS string), ' días') WHEN 4 THEN concat(cast(p_size % 9 + 1 AS string), ' semanas')
    WHEN 5 THEN concat(cast(p_size % 11 + 1 AS string), ' meses') ELSE concat(cast(p_size % 3 + 1 AS string), ' año') END AS publicado,
  CASE p_partkey % 6 WHEN 0 THEN concat(cast(p_size + 10 AS string), '.000') WHEN 1 THEN cast(p_size AS string)
    WHEN 2 THEN '1.111.111' WHEN 3 THEN ',' WHEN 4 THEN NULL ELSE concat(cast(p_size * 1000 AS string), ',5') END AS gastos_txt,
  CASE p_partkey % 5 WHEN 0 THEN concat(cast(p_size AS string), ' metros') WHEN 1 THEN concat('1.', cast(p_size % 9 + 1 AS string), ' km')
    WHEN 2 THEN 'sin dato' WHEN 3 THEN concat('2 mins - ', cast(p_size AS string), ',5 metros') ELSE '1.250 metros' END AS distancia_txt,
  CASE p_partkey % 8 WHEN 0 THEN 'Sí' WHEN 1 THEN ' no ' WHEN 2 THEN 'SI' WHEN 3 THEN '1.0' WHEN 4 THEN '0' WHEN 5 THEN 'true'
    WHEN 6 THEN 'quizás' ELSE NULL END AS condominio_txt,
  CASE p_partkey % 4 WHEN 0 THEN cast(p_size AS string) WHEN 1 THEN concat(' ', cast(p_size AS string), '.5 ') WHEN 2 THEN 'n/d' ELSE NULL END AS numero_txt,
  CASE p_partkey % 3 WHEN 0 THEN concat('-36,8', cast(p_size AS string)) WHEN 1 THEN concat(' -36.9', cast(p_size AS string)) ELSE 'x' END AS lat_txt,
  CASE WHEN p_partkey % 9 = 0 THEN 'Consultar' ELSE concat('$ ', cast(p_size AS string), '.', cast(100 + p_size AS string), '.000') END AS precio_txt,
  CASE p_partkey % 5 WHEN 0 THEN 'Ñuñoa Ánimas' WHEN 1 THEN ' Estación de Metro ' WHEN 2 THEN 'CLÍNICAS' WHEN 3 THEN 'Jardines Infantiles' ELSE p_type END AS nombre,
  CASE p_partkey % 5 WHEN 0 THEN 'Publicación pausada' WHEN 1 THEN 'Publicación FINALIZADA' WHEN 2 THEN 'Otro aviso' WHEN 3 THEN '' ELSE NULL END AS mensaje,
  concat(CASE WHEN p_partkey % 4 = 0 THEN 'HTTPS://example.org/mlc-' ELSE 'https://example.org/MLC-' END, cast(1000000 + p_partkey AS string), '-', p_type) AS url
FROM {part}""",
    "zones": """
SELECT zona, attr, x0, y0, concat('POLYGON ((', cast(x0 AS string), ' ', cast(y0 AS string), ', ', cast(x0 + w AS string), ' ', cast(y0 AS string),
   ', ', cast(x0 + w AS string), ' ', cast(y0 + w AS string), ', ', cast(x0 AS string), ' ', cast(y0 + w AS string), ', ',
   cast(x0 AS string), ' ', cast(y0 AS string), '))') AS geometria_wkt, w
FROM (SELECT concat('z', cast(n_nationkey AS string)) AS zona, n_regionkey AS attr, cast(0.01 AS double) AS w,
   cast(-73.05 AS double) + cast(n_nationkey % 5 AS double) * cast(0.01 AS double) + cast(0.0000037 AS double) AS x0,
   cast(-36.85 AS double) + floor(cast(n_nationkey AS double) / cast(5 AS double)) * cast(0.01 AS double) + cast(0.0000037 AS double) AS y0
  FROM {nation}) q""",
    "rates": """
SELECT fecha, cast(30.0 AS double) + cast(extract(DAY FROM fecha) AS double) / cast(10.0 AS double) AS valor
FROM (SELECT DISTINCT CASE WHEN p_partkey % 33 = 0 THEN NULL ELSE DATE '2024-01-01' + cast(p_partkey % 365 AS int) END AS fecha FROM {part}) q
WHERE extract(DAY FROM fecha) % 3 <> 0""",
    "scored": """
SELECT concat(cast(l_orderkey AS string), '-', cast(l_linenumber AS string), '-', cast(l_partkey AS string), '-', cast(l_suppkey AS string)) AS id,
  l_extendedprice AS y,
""" + ",\n".join(
        f"  l_extendedprice * (cast(0.8 AS double) + cast((l_partkey * 31 + l_suppkey * 7 + {k} * 13) % 41 AS double) / cast(100.0 AS double)) AS p{k}"
        for k in range(1, 11)
    ) + """,
  l_quantity, l_discount, l_tax, l_returnflag, l_partkey, l_suppkey
FROM {lineitem}""",
    "predictions": """
SELECT user_id AS id, event_type AS version, ts AS fecha, event_id AS seq, value FROM {events}""",
    "visits": """
SELECT event_id AS seq, user_id AS id, ts, event_type = 'error' AS fallo, value,
  CASE event_type WHEN 'signup' THEN 'pausado' WHEN 'purchase' THEN 'finalizado' WHEN 'error' THEN 'no_disponible' ELSE 'activo' END AS estado
FROM {events}""",
    "importances": """
SELECT user_id % 30 AS model, event_type AS feature, value AS importance FROM {events}""",
}

# latest event per (day, user)
VIEWS["snapshots"] = """
SELECT cast(ts AS date) AS fecha, user_id AS id,
  CASE max_by(event_type, event_id) WHEN 'signup' THEN 'pausado' WHEN 'purchase' THEN 'finalizado'
    WHEN 'error' THEN 'no_disponible' ELSE 'activo' END AS estado
FROM {events} GROUP BY cast(ts AS date), user_id"""

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The view ``name`` over the Parquet tables in ``sf_dir``."""
    if name not in VIEWS:
        return table(spark, sf_dir, name)
    bound = {t: f"parquet.`{sf_dir}/{t}.parquet`" for t in TABLES}
    return spark.sql(VIEWS[name].format(**bound))


def cte(*names: str) -> str:
    """``WITH`` clause items defining the named views for the SQL check."""
    return ",\n".join(f"{n} AS ({VIEWS[n].format(**{t: t for t in TABLES})})" for n in names)
