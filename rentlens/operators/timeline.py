"""Snapshot history: daily totals, entries and exits, daily value statistics, trailing failures, stale runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentlens.operators.quantiles import exact_median, run


def available_states(include_paused: bool) -> list[str]:
    return ["activo", "pausado"] if include_paused else ["activo"]


def daily_totals(history: DataFrame, include_paused: bool, date: str = "fecha", id_col: str = "id", state: str = "estado") -> DataFrame:
    states = available_states(include_paused)
    seen = history.select(date, F.when(F.col(state).isin(states), F.col(id_col)).alias("_id")).distinct()
    return seen.groupBy(date).agg(F.count("_id").alias("total"))


def entries_exits(history: DataFrame, date: str = "fecha", id_col: str = "id", state: str = "estado") -> DataFrame:
    """Per date of the history: ids active today but not on the previous date, and the reverse; the first date has nulls.

    Every active (id, day) is stacked twice, as "today" and as "yesterday" of the next day, and one
    aggregation on (id, day) tells which side is missing. No self-join and no window over an id.
    """
    days = run(
        f"SELECT `{date}` AS f, row_number() OVER (ORDER BY `{date}`) AS d FROM (SELECT DISTINCT `{date}` FROM {{h}})", h=history
    )
    return run(
        f"""
WITH days AS (SELECT * FROM {{days}}),
  act AS (SELECT h.`{id_col}` AS id, d FROM {{h}} h JOIN days ON h.`{date}` = days.f WHERE h.`{state}` = 'activo'),
  both AS (SELECT id, d, 1 AS today, 0 AS before FROM act UNION ALL SELECT id, d + 1, 0, 1 FROM act),
  merged AS (SELECT id, d, max(today) AS today, max(before) AS before FROM both GROUP BY id, d),
  moves AS (SELECT d, count_if(today > before) AS entran, count_if(before > today) AS salen FROM merged GROUP BY d)
SELECT f AS `{date}`, CASE WHEN d > 1 THEN coalesce(entran, 0) END AS entran, CASE WHEN d > 1 THEN coalesce(salen, 0) END AS salen
FROM days LEFT JOIN moves USING (d)""",
        h=history,
        days=days,
    )


def daily_series(history: DataFrame, ids: DataFrame, include_paused: bool) -> DataFrame:
    """fecha, total, entran, salen over the history of the ids that pass the filters."""
    kept = history.join(ids.select("id").distinct(), "id", "left_semi")
    return daily_totals(kept, include_paused).join(entries_exits(kept), "fecha")


def daily_value_stats(history: DataFrame, listings: DataFrame, value: str, include_paused: bool) -> DataFrame:
    """fecha, media, mediana, desviacion of the listings' current ``value`` over the ids available that day."""
    rows = history.filter(F.col("estado").isin(available_states(include_paused))).select("fecha", "id")
    v = listings.select("id", F.expr(value).cast("double").alias("v")).filter("v IS NOT NULL AND abs(v) <> double('infinity')")
    joined = rows.join(v, "id")
    stats = joined.groupBy("fecha").agg(F.avg("v").alias("media"), F.stddev_samp("v").alias("desviacion"))
    return stats.join(exact_median(joined, "v", ["fecha"], "mediana").drop("n"), "fecha")


def melt(df: DataFrame, ids: list[str], values: list[str], name: str = "metrica", value: str = "valor") -> DataFrame:
    return df.unpivot(ids, values, name, value)


def signed_union(moves: DataFrame) -> DataFrame:
    """Entries as positive and exits as negative long rows."""
    up = moves.select("fecha", F.lit("entran").alias("tipo"), F.col("entran").alias("n"))
    return up.unionByName(moves.select("fecha", F.lit("salen").alias("tipo"), (-F.col("salen")).alias("n")))


def trailing_failures(visits: DataFrame, id_col: str, seq: str, failed: str, limit: int = 5) -> DataFrame:
    """Per id: failures since its last success and whether that makes it terminal. Two combining aggregations."""
    last = visits.groupBy(id_col).agg(F.max(F.when(~F.col(failed), F.col(seq))).alias("_ok"))
    after = visits.filter(F.col(failed)).join(last, id_col).filter(F.col("_ok").isNull() | (F.col(seq) > F.col("_ok")))
    counts = after.groupBy(id_col).agg(F.count(F.lit(1)).alias("_n"))
    return last.join(counts, id_col, "left").select(
        id_col, F.coalesce("_n", F.lit(0)).alias("intentos_fallidos"), (F.coalesce("_n", F.lit(0)) > limit).alias("terminal")
    )


def stale_run_alert(runs: DataFrame, order: str, new_rows: str, result: str, n: int = 5) -> DataFrame:
    """One row: alert when each of the last ``n`` ok/partial runs brought nothing new (fewer runs: no alert)."""
    last = runs.filter(F.col(result).isin("ok", "parcial")).orderBy(F.desc(order)).limit(n)
    return last.agg(
        F.count(F.lit(1)).alias("corridas"), F.coalesce(F.max(new_rows), F.lit(0)).alias("max_nuevos")
    ).withColumn("alerta", (F.col("corridas") == n) & (F.col("max_nuevos") == 0))


def outcome_counters(visits: DataFrame, run_col: str, **conditions: str) -> DataFrame:
    """Per run: number of rows and of rows meeting each named condition."""
    return visits.groupBy(run_col).agg(
        F.count(F.lit(1)).alias("procesados"), *[F.count_if(F.expr(c)).alias(n) for n, c in conditions.items()]
    )


def size_anomaly(
    df: DataFrame, run_col: str, seq: str, size: str, error: str, status: str, redirect: str, block: str, first: int = 20, warmup: int = 5, ratio: float = 0.5
) -> DataFrame:
    """Flags per response: error, bad status, suspicious redirect, missing block, size far below the run's baseline.

    The baseline of a response is the median size of the good ones before it, among the first ``first``
    good ones of the run, once ``warmup`` responses exist. Only that bounded head of each run is
    gathered (a top-k per run), then joined back.
    """
    return run(
        f"""
WITH r AS (SELECT *, `{error}` IS NULL AND `{status}` = 200 AND `{block}` AND `{size}` > 0 AS _good FROM {{d}}),
  g AS (SELECT `{run_col}`, `{seq}`, `{size}` FROM
    (SELECT *, row_number() OVER (PARTITION BY `{run_col}` ORDER BY `{seq}`) AS k FROM r WHERE _good) WHERE k <= {first}),
  warm AS (SELECT `{run_col}`, max(`{seq}`) AS _warm, count(*) AS _nw FROM
    (SELECT `{run_col}`, `{seq}`, row_number() OVER (PARTITION BY `{run_col}` ORDER BY `{seq}`) AS k FROM r) WHERE k <= {warmup} GROUP BY 1),
  head AS (SELECT `{run_col}`, array_sort(collect_list(struct(cast(`{size}` AS double) AS size, `{seq}` AS seq))) AS head FROM g GROUP BY `{run_col}`),
  b AS (SELECT r.*, CASE WHEN _nw = {warmup} AND r.`{seq}` > _warm THEN filter(head, h -> h.seq < r.`{seq}`) END AS _h
    FROM r LEFT JOIN head USING (`{run_col}`) LEFT JOIN warm USING (`{run_col}`)),
  m AS (SELECT *, CASE WHEN size(_h) > 0 THEN
    (_h[cast(floor((size(_h) - 1) / 2) AS int)].size + _h[cast(floor(size(_h) / 2) AS int)].size) / 2 END AS baseline FROM b)
SELECT * EXCEPT (_good, _h), CASE WHEN `{error}` IS NOT NULL THEN array('error') ELSE array_compact(array(
    CASE WHEN `{status}` <> 200 THEN 'status' END, CASE WHEN `{redirect}` THEN 'redirect' END,
    CASE WHEN NOT `{block}` THEN 'block' END, CASE WHEN `{size}` / baseline < {ratio!r}D THEN 'small' END)) END AS indicios
FROM m""",
        d=df,
    )
