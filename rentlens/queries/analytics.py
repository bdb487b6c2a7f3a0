"""Bins, scores, metrics, selection statistics, snapshot series, facets, ordering and sampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from rentlens.functions import numeric as N
from rentlens.operators import binning, metrics, ordering, quality, sampling, selection, timeline
from rentlens.operators.quantiles import median_mad
from rentlens.queries.registry import query, rounded

S, L, H = ["scored"], ["listings"], ["snapshots"]
PREDS = [f"p{i}" for i in range(1, 11)]
MEAN = "((" + "+".join(PREDS) + ")/10)"
# equal-count right-closed bins by counting the inner edges below the value


def inner_bins(value: str, source: str, q: int, v: str) -> str:
    """SQL: number of inner q-quantile edges of ``value`` in ``source`` strictly below ``v``."""
    return " + ".join(f"({v} > (SELECT quantile_cont({value},{i / q!r}::DOUBLE) FROM {source}))::INT" for i in range(1, q))


BINNED = f""", z AS (SELECT id, y, p1, y-p1 AS e, {inner_bins('y', 'scored', 10, 'y')} AS bin FROM scored),
 m AS (SELECT bin, median(e) AS med, count(*) AS n FROM z GROUP BY 1), a AS (SELECT bin, median(abs(e-med)) AS mad FROM z JOIN m USING (bin) GROUP BY 1)"""
ENS = f""", e0 AS (SELECT *, {MEAN} AS pm FROM scored), e1 AS (SELECT *, sqrt(({'+'.join(f'pow({p}-pm,2)' for p in PREDS)})/10) AS ps FROM e0), e2 AS (SELECT *, ps/CASE WHEN pm=0 THEN 1e-6 ELSE pm END AS cv FROM e1)"""
LAB = ENS + f""", z AS (SELECT id, y, pm, cv, y-pm AS e, {inner_bins('y', 'scored', 10, 'y')} AS bin, {inner_bins('round(cv,12)', 'e2', 3, 'round(cv,12)')} AS tb FROM e2),
 m AS (SELECT bin, median(e) AS med, count(*) AS n FROM z GROUP BY 1), a AS (SELECT bin, median(abs(e-med)) AS mad FROM z JOIN m USING (bin) GROUP BY 1),
 w AS (SELECT *, (e-med)/CASE WHEN mad*1.4826=0 THEN 1e-6 ELSE mad*1.4826 END AS zr FROM z JOIN m USING (bin) JOIN a USING (bin)),
 lab AS (SELECT *, CASE WHEN zr<-1 THEN 'oportunidad' WHEN zr>1 THEN 'caro' ELSE 'precio_de_mercado' END AS etiqueta, ['alta confianza','confianza media','baja confianza'][tb+1] AS tier FROM w)"""


def tidy(t):
    """Prediction columns as given; the ensemble's variation is rounded before it is cut, as in the check."""
    return t.scored.select("id", "y", *PREDS)


@query("quantile_bin", f"SELECT bin, count(*) AS n, min(y) AS y_min, max(y) AS y_max FROM (SELECT y, {inner_bins('y', 'scored', 10, 'y')} AS bin FROM scored) GROUP BY 1", S)
def _(t):
    return binning.quantile_bin(t.scored.select("y"), "y", 10).groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.min("y").alias("y_min"), F.max("y").alias("y_max"))


@query("median_mad", """, m AS (SELECT l_returnflag AS g, median(y-p1) AS med, count(*) AS n FROM scored GROUP BY 1) SELECT g, n, round(any_value(med),6) AS median, round(median(abs(y-p1-med)),6) AS mad FROM scored JOIN m ON l_returnflag=g GROUP BY g, n""", S)
def _(t):
    src = t.scored.select(F.col("l_returnflag").alias("g"), (F.col("y") - F.col("p1")).alias("e"))
    return rounded(median_mad(src, "e", ["g"]).select("g", "n", "median", "mad"), "median", "mad")


@query("robust_z_by_bin", BINNED + " SELECT id, bin, round((e-med)/CASE WHEN mad*1.4826=0 THEN 1e-6 ELSE mad*1.4826 END,6) AS z FROM z JOIN m USING (bin) JOIN a USING (bin)", S)
def _(t):
    rows, _ = binning.robust_z_by_bin(t.scored.select("id", "y", "p1"), "y", "p1")
    return rounded(rows.select("id", "bin", "z"), "z")


@query("calibrate", LAB + f""" SELECT m.bin AS decil, m.n, round(med,5) AS mediana_error, round(mad,5) AS mad_error, round(CASE WHEN m.bin<9 THEN quantile_cont_edge END,5) AS borde_superior FROM m JOIN a USING (bin)
 JOIN (SELECT unnest(range(0,10)) AS bin, unnest((SELECT quantile_cont(y, [{','.join(f'{i / 10!r}::DOUBLE' for i in range(1, 11))}]) FROM scored)) AS quantile_cont_edge) q ON q.bin=m.bin""", S)
def _(t):
    cal = binning.calibrate(tidy(t), "y", PREDS)
    rows = cal.select(F.explode("stats_por_decil").alias("s"), "bordes_deciles_precio").select("s.*", F.expr("bordes_deciles_precio[s.decil + 1]").alias("b"))
    out = rows.select("decil", "n", "mediana_error", "mad_error", F.expr("CASE WHEN b < double('infinity') THEN b END").alias("borde_superior"))
    return rounded(out, "mediana_error", "mad_error", "borde_superior", digits=5)


@query("bin_lookup", LAB + f""", nb AS (SELECT id, {inner_bins('y', 'scored', 10, 'y * 1.1')} AS bin FROM scored) SELECT nb.id, nb.bin AS decil, m.n, round(m.med,5) AS mediana_error, round(a.mad,5) AS mad_error FROM nb JOIN m USING (bin) JOIN a USING (bin)""", S)
def _(t):
    cal = binning.stored_calibration(binning.calibrate(tidy(t), "y", PREDS))
    new = t.scored.select("id", (F.col("y") * 1.1).alias("v"))
    return rounded(binning.bin_lookup(new, cal, "v").select("id", "decil", "n", "mediana_error", "mad_error"), "mediana_error", "mad_error", digits=5)


@query("market_band", LAB + f""", nb AS (SELECT id, p2, l_tax, {inner_bins('y', 'scored', 10, 'p2')} AS bin FROM scored) SELECT nb.id, nb.bin AS decil, round(p2+med-mad*1.4826,4) AS limite_inferior, round(p2+med+mad*1.4826,4) AS limite_superior, round(p2-l_tax,4) AS arriendo_implicito FROM nb JOIN m USING (bin) JOIN a USING (bin)""", S)
def _(t):
    cal = binning.stored_calibration(binning.calibrate(tidy(t), "y", PREDS))
    out = binning.market_band(t.scored.select("id", "p2", "l_tax"), cal, "p2", "l_tax")
    return rounded(out.select("id", "decil", "limite_inferior", "limite_superior", "arriendo_implicito"), "limite_inferior", "limite_superior", "arriendo_implicito", digits=4)


@query("ensemble_dispersion", ENS + " SELECT id, round(pm,6) AS pred, round(ps,6) AS pred_std, round(cv,9) AS cv FROM e2", S)
def _(t):
    return rounded(rounded(binning.with_ensemble(tidy(t), PREDS).select("id", "pred", "pred_std", "cv"), "pred", "pred_std", digits=6), "cv", digits=9)


@query("confidence_tier", LAB + " SELECT tier AS confianza, count(*) AS n FROM lab GROUP BY 1", S)
def _(t):
    return binning.confidence_tier(binning.narrow_scores(tidy(t), "y", PREDS, "id").withColumn("cv", F.round("cv", 12))).groupBy("confianza").agg(F.count(F.lit(1)).alias("n"))


@query("label_opportunities", LAB + """ SELECT id, round(y,6) AS costo_total_real, round(pm,6) AS costo_total_predicho, bin AS decil_precio, round(zr,5) AS z_robusto, etiqueta FROM lab""", S)
def _(t):
    out = binning.label_opportunities(tidy(t), "id", "y", PREDS)
    return rounded(rounded(out.select("id", "costo_total_real", "costo_total_predicho", "decil_precio", "z_robusto", "etiqueta"), "costo_total_real", "costo_total_predicho"), "z_robusto", digits=5)


@query("score_new_rows", LAB + f""", nb AS (SELECT id, y*1.05 AS y2, pm, {inner_bins('y', 'scored', 10, 'y * 1.05')} AS bin FROM e2 WHERE l_quantity > 5), sc AS (SELECT nb.*, (y2-pm-med)/CASE WHEN mad*1.4826=0 THEN 1e-6 ELSE mad*1.4826 END AS zr FROM nb JOIN m USING (bin) JOIN a USING (bin))
 SELECT id, bin AS decil, round(zr,5) AS z_robusto, CASE WHEN zr<-1 THEN 'oportunidad' WHEN zr>1 THEN 'caro' ELSE 'precio_de_mercado' END AS etiqueta FROM sc""", S)
def _(t):
    """Rows with a small quantity stand for listings without a price and are skipped."""
    cal = binning.stored_calibration(binning.calibrate(tidy(t), "y", PREDS))
    new = t.scored.withColumn("y", F.when(F.col("l_quantity") > 5, F.col("y") * 1.05)).select("id", "y", *PREDS)
    return rounded(binning.score_rows(new, cal, "y", PREDS).select("id", "decil", "z_robusto", "etiqueta"), "z_robusto", digits=5)


@query("label_by_threshold", """, z AS (SELECT id, (y-p3)/10000 AS z FROM scored) SELECT id, CASE WHEN z<-1 THEN 'oportunidad' WHEN z>1 THEN 'caro' ELSE 'precio_de_mercado' END AS etiqueta, CASE WHEN z<-1 THEN 'oportunidad' WHEN z>1 THEN 'caro' ELSE 'precio_de_mercado' END||' (alta confianza)' AS etiqueta_final FROM z""", S)
def _(t):
    z = t.scored.select("id", ((F.col("y") - F.col("p3")) / 10000).alias("z")).withColumn("etiqueta", N.label_by_threshold("z"))
    return z.select("id", "etiqueta", N.combined_label("etiqueta", F.lit("alta confianza")).alias("etiqueta_final"))


@query("ape", "SELECT id, round(abs(y-p1)/nullif(y,0),8) AS ape, greatest(y-50000,0) AS recortado FROM scored", S)
def _(t):
    return rounded(t.scored.select("id", N.ape("y", "p1").alias("ape"), N.clip_at_zero(F.col("y") - 50000).alias("recortado")), "ape", digits=8)


@query("clip_at_zero", "SELECT round(sum(greatest(y-50000,0)),2) AS suma, count(*) FILTER (WHERE y<50000) AS recortados FROM scored", S)
def _(t):
    return rounded(t.scored.agg(F.sum(N.clip_at_zero(F.col("y") - 50000)).alias("suma"), F.count_if(F.col("y") < 50000).alias("recortados")), "suma", digits=2)


# ---- metrics -----------------------------------------------------------------------------------
@query("regression_metrics", "SELECT count(y) AS n, round(avg(abs(y-p1)),4) AS mae, round(sqrt(avg(pow(y-p1,2))),4) AS rmse, round(1-sum(pow(y-p1,2))/(var_pop(y)*count(*)),6) AS r2, round(avg(abs(y-p1)/y)*100,6) AS mape, round(median(abs(y-p1)/y)*100,6) AS mdape FROM scored", S)
def _(t):
    return rounded(rounded(metrics.regression_metrics(t.scored, "y", "p1"), "mae", "rmse", digits=4), "r2", "mape", "mdape")


@query("metrics_by_quantile", f", z AS (SELECT y, p1, {inner_bins('y', 'scored', 5, 'y')} AS bin FROM scored) SELECT bin, count(*) AS n, min(y) AS y_min, max(y) AS y_max, round(avg(abs(y-p1)),4) AS mae, round(avg(abs(y-p1)/y)*100,6) AS mape, round(median(abs(y-p1)/y)*100,6) AS mdape FROM z GROUP BY 1", S)
def _(t):
    return rounded(rounded(metrics.metrics_by_quantile(t.scored.select("y", "p1"), "y", "p1"), "mae", digits=4), "mape", "mdape")


@query("residual_moments", ", r AS (SELECT y-p1 AS r FROM scored), m AS (SELECT avg(r) AS mu, stddev_pop(r) AS sd FROM r) SELECT round(any_value(mu),4) AS media, round(any_value(sd),4) AS std, round(avg(pow((r-mu)/sd,3)),6) AS skewness, round(avg(pow((r-mu)/sd,4))-3,6) AS kurtosis FROM r, m", S)
def _(t):
    return rounded(rounded(metrics.residual_moments(t.scored, "y", "p1"), "media", "std", digits=4), "skewness", "kurtosis")


@query("baseline_mae", """, x AS (SELECT avg(abs(y-p1)) AS a, avg(abs(y-(SELECT avg(y) FROM scored WHERE l_returnflag<>'R'))) AS b, avg(abs(y-2000*l_quantity)) AS c FROM scored WHERE l_returnflag='R') SELECT round(a,4) AS mae_modelo, round(b,4) AS mae_media, round(c,4) AS mae_sector, round(b-a,4) AS ganancia_media, round(c-a,4) AS ganancia_sector FROM x""", S)
def _(t):
    s = t.scored.withColumn("sector", F.lit(2000.0))
    out = metrics.baseline_mae(s.filter("l_returnflag <> 'R'"), s.filter("l_returnflag = 'R'"), "y", "p1", "sector", "l_quantity")
    return rounded(out, *out.columns, digits=4)


@query("evaluate", "SELECT count(y) AS n, round(avg(abs(y-p1)),4) AS mae, round(sqrt(avg(pow(y-p1,2))),4) AS rmse, round(avg(y-p1),4) AS media, round(avg(abs(y-2000*l_quantity)),4) AS mae_sector, 5 AS quintiles FROM scored", S)
def _(t):
    s = t.scored.withColumn("sector", F.lit(2000.0))
    out = metrics.evaluate(s, s, "y", "p1", "sector", "l_quantity")
    return rounded(out.select("n", "mae", "rmse", "media", "mae_sector", F.size("por_quintil").alias("quintiles")), "mae", "rmse", "media", "mae_sector", digits=4)


PER_MODEL = ", m AS (" + " UNION ALL ".join(f"SELECT '{p}' AS modelo, avg(abs(y-{p})) AS mae, sqrt(avg(pow(y-{p},2))) AS rmse, 1-avg(pow(y-{p},2))/var_pop(y) AS r2, avg(abs(y-{p})) FILTER (WHERE y > (SELECT quantile_cont(y,0.8::DOUBLE) FROM scored)) AS mae_q5 FROM scored" for p in PREDS) + ")"


def model_table(t):
    """Metrics of each prediction column, from one pass over the unpivoted predictions."""
    from rentlens.operators.quantiles import exact_quantiles

    cut = exact_quantiles(t.scored, "y", [0.8]).select(F.col("q")[0]).scalar()
    long = t.scored.select("y", *PREDS).withColumn("corte", cut).unpivot(["y", "corte"], PREDS, "modelo", "p")
    e2 = (F.col("y") - F.col("p")) * (F.col("y") - F.col("p"))
    return long.groupBy("modelo").agg(
        F.avg(F.abs(F.col("y") - F.col("p"))).alias("mae"), F.sqrt(F.avg(e2)).alias("rmse"), (1 - F.avg(e2) / F.var_pop("y")).alias("r2"),
        F.avg(F.when(F.col("y") > F.col("corte"), F.abs(F.col("y") - F.col("p")))).alias("mae_q5"),
    )


@query("weighted_model_score", PER_MODEL + """, s AS (SELECT *, 0.5*mae/(SELECT avg(mae) FROM m)+0.5*rmse/(SELECT avg(rmse) FROM m) AS score FROM m), b AS (SELECT min(score) AS f, (SELECT score FROM s ORDER BY score, modelo LIMIT 1 OFFSET 1) AS g, arg_min(modelo, score) AS w FROM s)
 SELECT modelo, round(score,8) AS score, modelo=w AS ganador, round(g-f,8) AS margen_absoluto, round((g-f)/g*100,6) AS margen_relativo_pct, (SELECT arg_min(modelo, mae_q5) FROM m)<>w AS advertencia_q5 FROM s, b""", S)
def _(t):
    out = metrics.weighted_model_score(model_table(t), "modelo").drop("mae", "rmse", "r2", "mae_q5")
    return rounded(rounded(out, "score", "margen_absoluto", digits=8), "margen_relativo_pct")


@query("seed_dispersion", PER_MODEL + """, u AS (SELECT 'mae' AS metrica, mae AS v FROM m UNION ALL SELECT 'rmse', rmse FROM m UNION ALL SELECT 'r2', r2 FROM m) SELECT metrica, round(avg(v),6) AS media, round(stddev_samp(v),6) AS std, round(min(v),6) AS minimo, round(max(v),6) AS maximo, round(stddev_samp(v)/abs(avg(v)),6) AS cv, CASE WHEN metrica='r2' THEN stddev_samp(v)/abs(avg(v))<0.15 END AS estable FROM u GROUP BY 1""", S)
def _(t):
    return rounded(metrics.seed_dispersion(model_table(t), ["mae", "rmse", "r2"]), "media", "std", "minimo", "maximo", "cv")


# ---- feature selection -------------------------------------------------------------------------
@query("low_variance_columns", "SELECT 'constante' AS feature, 0.0::DOUBLE AS varianza FROM scored GROUP BY 1 HAVING var_samp(5.0::DOUBLE + 0*l_tax) <= 0.001 UNION ALL SELECT 'l_tax', round(var_samp(l_tax),8) FROM scored HAVING var_samp(l_tax)<=0.001 UNION ALL SELECT 'l_discount', round(var_samp(l_discount),8) FROM scored HAVING var_samp(l_discount)<=0.001", S)
def _(t):
    s = t.scored.withColumn("constante", F.lit(5.0))
    return rounded(selection.low_variance_columns(s, ["l_quantity", "l_discount", "l_tax", "constante"], 0.001), "varianza", digits=8)


@query("correlation_prune", "SELECT 'l_quantity' AS a, 'l_discount' AS b, round(corr(l_quantity,l_discount),6) AS r FROM scored UNION ALL SELECT 'l_quantity','y', round(corr(l_quantity,y),6) FROM scored UNION ALL SELECT 'l_quantity','p1', round(corr(l_quantity,p1),6) FROM scored UNION ALL SELECT 'l_discount','y', round(corr(l_discount,y),6) FROM scored UNION ALL SELECT 'l_discount','p1', round(corr(l_discount,p1),6) FROM scored UNION ALL SELECT 'y','p1', round(corr(y,p1),6) FROM scored", S)
def _(t):
    return rounded(selection.correlation_pairs(t.scored, ["l_quantity", "l_discount", "y", "p1"]), "r")


@query("correlation_prune_kept", "SELECT feature, kept FROM (VALUES ('y', true), ('l_quantity', true), ('l_discount', true)) v(feature, kept) UNION ALL SELECT 'doble', abs((SELECT corr(2*l_extendedprice+1, l_extendedprice) FROM lineitem)) <= 0.95 UNION ALL SELECT 'p1', abs((SELECT corr(y, p1) FROM scored)) <= 0.95", S)
def _(t):
    """Which features stay: one is twice another."""
    kept, removed = selection.correlation_prune(t.scored.withColumn("doble", F.col("y") * 2 + 1), {"y": 5.0, "p1": 4.0, "doble": 3.0, "l_quantity": 2.0, "l_discount": 1.0})
    return t.spark.createDataFrame([(f, True) for f in kept] + [(f, False) for f in removed], "feature string, kept boolean")


@query("stability_score", """, b AS (SELECT feature, avg(importance) AS m, stddev_pop(importance) AS s, median(importance) AS md, avg((importance>5)::INT) AS pr FROM (SELECT feature, importance, importance FROM importances) GROUP BY 1)
 SELECT feature, round(m,6) AS mean_imp, round(s,6) AS std_imp, round(md,6) AS median_imp, round(s/m,6) AS cv, round(1.0::DOUBLE/(1+s/m),6) AS score, true AS passes FROM b""", ["importances"])
def _(t):
    out = selection.stability_score(t.importances, "feature", "importance")
    return rounded(out.select("feature", "mean_imp", "std_imp", "median_imp", "cv", "score", "passes"), "mean_imp", "std_imp", "median_imp", "cv", "score")


@query("one_se_rule", """, c AS (SELECT (l_partkey % 20 + 1)::INT AS k, avg(abs(y-p1)) AS mae, stddev_pop(abs(y-p1))/10 AS std FROM scored GROUP BY 1), b AS (SELECT * FROM c ORDER BY mae, k LIMIT 1) SELECT min(c.k) AS best_k, any_value(b.k) AS argmin_k, round(any_value(b.mae),4) AS min_mae, round(any_value(b.mae+b.std/sqrt(5)),4) AS threshold FROM c, b WHERE c.mae <= b.mae+b.std/sqrt(5)""", S)
def _(t):
    e = F.abs(F.col("y") - F.col("p1"))
    curve = t.scored.groupBy((F.col("l_partkey") % 20 + 1).cast("int").alias("k")).agg(F.avg(e).alias("mae"), (F.stddev_pop(e) / 10).alias("std"))
    return rounded(selection.one_se_rule(curve, 5), "min_mae", "threshold", digits=4)


@query("attribution_summary", """, l AS (SELECT 'l_quantity' AS feature, l_quantity AS v, (l_quantity-25)*100 AS c FROM scored UNION ALL SELECT 'l_discount', l_discount, (0.05-l_discount)*y FROM scored UNION ALL SELECT 'l_tax', l_tax, p1-y FROM scored),
 g AS (SELECT feature, avg(abs(c)) AS i, corr(v,c) AS r FROM l GROUP BY 1) SELECT feature, round(i,4) AS importancia, round(r,6) AS direccion_corr, round(i/(SELECT sum(i) FROM g)*100,6) AS share_pct, CASE WHEN r>0.15 THEN 'sube' WHEN r<-0.15 THEN 'baja' ELSE 'mixta' END AS direccion FROM g""", S)
def _(t):
    one = t.scored.select(
        F.struct(F.col("l_quantity").alias("v"), ((F.col("l_quantity") - 25) * 100).alias("c")).alias("l_quantity"),
        F.struct(F.col("l_discount").alias("v"), ((0.05 - F.col("l_discount")) * F.col("y")).alias("c")).alias("l_discount"),
        F.struct(F.col("l_tax").alias("v"), (F.col("p1") - F.col("y")).alias("c")).alias("l_tax"),
    )
    long = one.unpivot([], ["l_quantity", "l_discount", "l_tax"], "feature", "s").select("feature", "s.v", "s.c")
    out = selection.attribution_summary(long, "feature", "v", "c")
    return rounded(rounded(out, "importancia", digits=4), "direccion_corr", "share_pct")


@query("rank_by_score", "SELECT feature, round(avg(importance),6) AS score FROM importances GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3", ["importances"])
def _(t):
    g = t.importances.groupBy("feature").agg(F.avg("importance").alias("score"))
    return rounded(selection.rank_by_score(g, "score", "feature", 3), "score")


# ---- snapshots and runs ------------------------------------------------------------------------
@query("daily_totals", "SELECT fecha, count(DISTINCT id) FILTER (WHERE estado IN ('activo','pausado')) AS total FROM snapshots GROUP BY 1", H)
def _(t):
    return timeline.daily_totals(t.snapshots, True)


MOVES = """, d AS (SELECT fecha, row_number() OVER (ORDER BY fecha) AS d FROM (SELECT DISTINCT fecha FROM snapshots)), a AS (SELECT DISTINCT id, d FROM snapshots JOIN d USING (fecha) WHERE estado='activo'),
 en AS (SELECT d, count(*) AS n FROM a WHERE NOT EXISTS (SELECT 1 FROM a b WHERE b.id=a.id AND b.d=a.d-1) GROUP BY 1), sa AS (SELECT d+1 AS d, count(*) AS n FROM a WHERE NOT EXISTS (SELECT 1 FROM a b WHERE b.id=a.id AND b.d=a.d+1) GROUP BY 1),
 mv AS (SELECT fecha, CASE WHEN d.d>1 THEN coalesce(en.n,0) END AS entran, CASE WHEN d.d>1 THEN coalesce(sa.n,0) END AS salen FROM d LEFT JOIN en ON en.d=d.d LEFT JOIN sa ON sa.d=d.d)"""


@query("entries_exits", MOVES + " SELECT * FROM mv", H)
def _(t):
    return timeline.entries_exits(t.snapshots)


@query("signed_union", MOVES + " SELECT fecha, 'entran' AS tipo, entran AS n FROM mv UNION ALL SELECT fecha, 'salen', -salen FROM mv", H)
def _(t):
    return timeline.signed_union(timeline.entries_exits(t.snapshots))


VALUE = """, v AS (SELECT id, precio/nullif(superficie_util,0) AS v FROM listings), j AS (SELECT fecha, v FROM snapshots JOIN v USING (id) WHERE estado IN ('activo','pausado') AND v IS NOT NULL), s AS (SELECT fecha, avg(v) AS media, median(v) AS mediana, stddev_samp(v) AS desviacion FROM j GROUP BY 1)"""


@query("daily_value_stats", VALUE + " SELECT fecha, round(media,6) AS media, round(mediana,6) AS mediana, round(desviacion,6) AS desviacion FROM s", ["snapshots", "listings"])
def _(t):
    out = timeline.daily_value_stats(t.snapshots, t.listings, "precio / nullif(superficie_util, 0D)", True)
    return rounded(out.select("fecha", "media", "mediana", "desviacion"), "media", "mediana", "desviacion")


@query("melt", VALUE + " SELECT fecha, 'media' AS metrica, round(media,6) AS valor FROM s UNION ALL SELECT fecha, 'mediana', round(mediana,6) FROM s UNION ALL SELECT fecha, 'desviacion', round(desviacion,6) FROM s", ["snapshots", "listings"])
def _(t):
    out = timeline.daily_value_stats(t.snapshots, t.listings, "precio / nullif(superficie_util, 0D)", True)
    return rounded(timeline.melt(out, ["fecha"], ["media", "mediana", "desviacion"]), "valor")


@query("semi_join_ids", "SELECT fecha, id, estado FROM snapshots WHERE id IN (SELECT id FROM listings WHERE comuna IN ('Brand#1','Brand#2','Brand#3'))", ["snapshots", "listings"])
def _(t):
    from rentlens.operators.joins import semi_join_ids

    return semi_join_ids(t.snapshots, t.listings.filter("comuna IN ('Brand#1','Brand#2','Brand#3')")).select("fecha", "id", "estado")


@query("daily_series", """, h AS (SELECT * FROM snapshots WHERE id IN (SELECT id FROM listings WHERE dormitorios>=2)), d AS (SELECT fecha, row_number() OVER (ORDER BY fecha) AS d FROM (SELECT DISTINCT fecha FROM h)), a AS (SELECT DISTINCT id, d FROM h JOIN d USING (fecha) WHERE estado='activo'),
 en AS (SELECT d, count(*) AS n FROM a WHERE NOT EXISTS (SELECT 1 FROM a b WHERE b.id=a.id AND b.d=a.d-1) GROUP BY 1), sa AS (SELECT d+1 AS d, count(*) AS n FROM a WHERE NOT EXISTS (SELECT 1 FROM a b WHERE b.id=a.id AND b.d=a.d+1) GROUP BY 1),
 tt AS (SELECT fecha, count(DISTINCT id) FILTER (WHERE estado='activo') AS total FROM h GROUP BY 1)
 SELECT fecha, total, CASE WHEN d.d>1 THEN coalesce(en.n,0) END AS entran, CASE WHEN d.d>1 THEN coalesce(sa.n,0) END AS salen FROM tt JOIN d USING (fecha) LEFT JOIN en ON en.d=d.d LEFT JOIN sa ON sa.d=d.d""", ["snapshots", "listings"])
def _(t):
    return timeline.daily_series(t.snapshots, t.listings.filter("dormitorios >= 2"), False)


TRAIL = """, o AS (SELECT id, max(seq) FILTER (WHERE NOT fallo) AS ok FROM visits GROUP BY 1), c AS (SELECT id, count(*) FILTER (WHERE fallo AND (ok IS NULL OR seq>ok)) AS n FROM visits JOIN o USING (id) GROUP BY 1)"""


@query("trailing_run", TRAIL + " SELECT id, n AS intentos_fallidos FROM c", ["visits"])
def _(t):
    return timeline.trailing_failures(t.visits, "id", "seq", "fallo").select("id", "intentos_fallidos")


@query("failure_counter", TRAIL + " SELECT id, n AS intentos_fallidos, n>1 AS terminal FROM c", ["visits"])
def _(t):
    return timeline.trailing_failures(t.visits, "id", "seq", "fallo", limit=1)


RUNS = ", r AS (SELECT CAST(ts AS DATE) AS corrida, count(*) FILTER (WHERE estado='activo' AND value>90) AS nuevos, CASE WHEN count(*) FILTER (WHERE fallo)*2 > count(*) THEN 'error' ELSE 'ok' END AS resultado FROM visits GROUP BY 1)"


def daily_runs(t):
    return t.visits.groupBy(F.to_date("ts").alias("corrida")).agg(
        F.expr("count_if(estado = 'activo' AND value > 90)").alias("nuevos"),
        F.expr("CASE WHEN count_if(fallo) * 2 > count(*) THEN 'error' ELSE 'ok' END").alias("resultado"),
    )


@query("stale_run_alert", RUNS + ", l AS (SELECT * FROM r WHERE resultado IN ('ok','parcial') ORDER BY corrida DESC LIMIT 5) SELECT count(*) AS corridas, coalesce(max(nuevos),0) AS max_nuevos, count(*)=5 AND max(nuevos)=0 AS alerta FROM l", ["visits"])
def _(t):
    return timeline.stale_run_alert(daily_runs(t), "corrida", "nuevos", "resultado")


@query("outcome_counters", "SELECT CAST(ts AS DATE) AS corrida, count(*) AS procesados, count(*) FILTER (WHERE estado<>'activo') AS cambios, count(*) FILTER (WHERE estado='no_disponible') AS no_disponibles FROM visits GROUP BY 1", ["visits"])
def _(t):
    return timeline.outcome_counters(t.visits.withColumn("corrida", F.to_date("ts")), "corrida", cambios="estado <> 'activo'", no_disponibles="estado = 'no_disponible'")


@query("run_record", "SELECT 'c1' AS corrida, min(seq) AS inicio, max(seq) AS fin, count(*) AS procesados, count(*) FILTER (WHERE value>90) AS nuevos, count(*) FILTER (WHERE fallo) AS errores, CASE WHEN count(*) FILTER (WHERE fallo)=0 THEN 'ok' WHEN count(*) FILTER (WHERE fallo)<count(*) THEN 'parcial' ELSE 'error' END AS resultado FROM visits", ["visits"])
def _(t):
    from rentlens.operators.writes import run_record

    return run_record(t.visits, "c1", "seq", "seq", "value > 90", "fallo")


SIZES = """WITH d AS (SELECT page_id % 3 AS corrida, page_id AS seq, length(html) AS tam, CASE WHEN page_id % 23 = 0 THEN 'timeout' END AS error, CASE WHEN page_id % 29 = 0 THEN 403 ELSE 200 END AS status, contains(url,'#') AS redir, contains(html,'<nav>') AND page_id % 31 <> 0 AS bloque FROM pages),
 r AS (SELECT *, error IS NULL AND status=200 AND bloque AND tam>0 AS good, row_number() OVER (PARTITION BY corrida ORDER BY seq) AS k FROM d),
 g AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY corrida ORDER BY seq) AS gk FROM r WHERE good) WHERE gk<=20),
 b AS (SELECT r.corrida, r.seq, median(g.tam) AS base FROM r JOIN g ON g.corrida=r.corrida AND g.seq<r.seq WHERE r.k>5 GROUP BY 1,2)"""


@query("size_anomaly", SIZES + """ SELECT seq, round(base,3) AS baseline, CASE WHEN error IS NOT NULL THEN 'error' ELSE concat_ws(',', CASE WHEN status<>200 THEN 'status' END, CASE WHEN redir THEN 'redirect' END, CASE WHEN NOT bloque THEN 'block' END, CASE WHEN tam/base<0.5 THEN 'small' END) END AS indicios FROM r LEFT JOIN b USING (corrida, seq)""")
def _(t):
    d = t.pages.selectExpr("page_id % 3 AS corrida", "page_id AS seq", "length(html) AS tam", "CASE WHEN page_id % 23 = 0 THEN 'timeout' END AS error", "CASE WHEN page_id % 29 = 0 THEN 403 ELSE 200 END AS status", "contains(url, '#') AS redir", "contains(html, '<nav>') AND page_id % 31 <> 0 AS bloque")
    out = timeline.size_anomaly(d, "corrida", "seq", "tam", "error", "status", "redir", "bloque")
    return rounded(out.select("seq", "baseline", F.array_join("indicios", ",").alias("indicios")), "baseline", digits=3)


# ---- counts, facets, order ---------------------------------------------------------------------
@query("crosstab", "SELECT comuna, count(*) FILTER (WHERE estado='activo') AS activo, count(*) FILTER (WHERE estado='pausado') AS pausado, count(*) FILTER (WHERE estado='finalizado') AS finalizado, count(*) FILTER (WHERE estado='no_disponible') AS no_disponible FROM listings GROUP BY 1", L)
def _(t):
    return quality.crosstab(t.listings, "comuna", "estado", ["activo", "pausado", "finalizado", "no_disponible"])


@query("value_counts", "SELECT event_type, count(*) AS n, round_even(count(*)*100.0::DOUBLE/(SELECT count(*) FROM events),1) AS pct FROM events GROUP BY 1")
def _(t):
    return quality.value_counts(t.events, "event_type")


@query("facet_counts", """SELECT 'dormitorios' AS faceta, CASE WHEN dormitorios>=4 THEN '4+' ELSE dormitorios::VARCHAR END AS valor, count(*) AS n, NULL::DOUBLE AS minimo, NULL::DOUBLE AS maximo FROM listings GROUP BY 2
 UNION ALL SELECT 'banos', CASE WHEN banos>=4 THEN '4+' ELSE banos::VARCHAR END, count(*), NULL, NULL FROM listings GROUP BY 2 UNION ALL SELECT 'comuna', comuna, count(*), NULL, NULL FROM listings GROUP BY 2
 UNION ALL SELECT 'precio', NULL, count(precio), min(precio), max(precio) FROM listings UNION ALL SELECT 'superficie_util', NULL, count(superficie_util), min(superficie_util), max(superficie_util) FROM listings""", L)
def _(t):
    return quality.facet_counts(t.listings, ["dormitorios", "banos"], ["precio", "superficie_util"], "comuna")


@query("sort_listings", "SELECT id, fecha FROM listings ORDER BY fecha DESC NULLS LAST, fecha_chequeo DESC NULLS LAST, id", L)
def _(t):
    return ordering.sort_listings(t.listings, "newest").select("id", "fecha")


@query("paginate", "SELECT id, precio FROM listings ORDER BY precio DESC, id LIMIT 24 OFFSET 48", L)
def _(t):
    return ordering.paginate(t.listings.select("id", "precio"), 3, ordering.order_columns("dearest"))


@query("top_n", "SELECT id, y FROM scored ORDER BY y DESC, id LIMIT 50", S)
def _(t):
    return ordering.top_n(t.scored.select("id", "y"), "y", 50, "id")


@query("priority_queue_limit", "SELECT id, fecha_chequeo FROM listings ORDER BY fecha_chequeo ASC NULLS FIRST, id LIMIT 200", L)
def _(t):
    return ordering.priority_queue(t.listings.select("id", "fecha_chequeo"), "fecha_chequeo", 200, "id")


@query("batch_cap", "SELECT id FROM listings WHERE estado='activo' ORDER BY id LIMIT 300", L)
def _(t):
    return ordering.batch_cap(t.listings.filter("estado = 'activo'").select("id"), 300, "id")


# ---- splits and samples ------------------------------------------------------------------------
def split_sql(seed: int) -> str:
    return f", z AS (SELECT id, y, {inner_bins('y', 'scored', 5, 'y')} AS estrato FROM scored), r AS (SELECT *, row_number() OVER (PARTITION BY estrato ORDER BY md5(id||':{seed}'), id) AS k, count(*) OVER (PARTITION BY estrato) AS n FROM z)"


@query("stratified_split", split_sql(42) + ", c AS (SELECT *, round_even(n*0.15,0) AS nt FROM r) SELECT id, estrato, CASE WHEN k<=nt THEN 'test' WHEN k<=nt+round_even((n-nt)*(0.15::DOUBLE/(1-0.15::DOUBLE)),0) THEN 'val' ELSE 'train' END AS split FROM c", S)
def _(t):
    return sampling.stratified_split(t.scored.select("id", "y"), "id", "y").select("id", "estrato", "split")


@query("holdout_split_production", split_sql(42) + f""", c AS (SELECT *, k<=round_even(n*0.15,0) AS test FROM r), rest AS (SELECT id, y FROM c WHERE NOT test), z2 AS (SELECT id, {inner_bins('y', 'rest', 5, 'y')} AS e2 FROM rest),
 r2 AS (SELECT *, row_number() OVER (PARTITION BY e2 ORDER BY md5(id||':42'), id) AS k, count(*) OVER (PARTITION BY e2) AS n FROM z2) SELECT id, CASE WHEN k<=round_even(n*0.1,0) THEN 'earlystop' ELSE 'fit' END AS split FROM r2 UNION ALL SELECT id, 'test' FROM c WHERE test""", S)
def _(t):
    return sampling.holdout_split_production(t.scored.select("id", "y"), "id", "y").select("id", "split")


@query("random_holdout", ", r AS (SELECT id, row_number() OVER (ORDER BY md5(id||':42'), id) AS k, count(*) OVER () AS n FROM scored) SELECT id, CASE WHEN k<=ceil(n*0.2) THEN 'val' ELSE 'train' END AS split FROM r", S)
def _(t):
    return sampling.random_holdout(t.scored.select("id", "y"), "id", "y").select("id", "split")


@query("kfold_assign", "SELECT id, (('0x'||substr(md5(id||':7'),1,8))::BIGINT % 5)::INT AS fold FROM scored", S)
def _(t):
    return sampling.kfold_assign(t.scored.select("id"), "id", 5, 7)


@query("stratified_quota_sample", """, g AS (SELECT id, comuna, tipo, row_number() OVER (PARTITION BY comuna, tipo ORDER BY md5(id||':42'), id) AS k, count(*) OVER (PARTITION BY comuna, tipo) AS n, count(*) OVER () AS total FROM listings) SELECT id, comuna, tipo FROM g WHERE k <= least(greatest(round_even(150*n::DOUBLE/total,0),1),n) ORDER BY md5(id||':42'), id LIMIT 150""", L)
def _(t):
    return sampling.stratified_quota_sample(t.listings.select("id", "comuna", "tipo"), ["comuna", "tipo"], "id", 150)
