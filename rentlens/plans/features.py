"""Feature tables: the full training build and the serving build for pending rows.

Column names follow the listing views (see ``sources.views``). The order of the steps matters: the
coordinate box comes before every spatial step, the price cap before the target, and price levels
before the surface correction.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentlens.functions import numeric as N
from rentlens.functions import text as T
from rentlens.models.regression import apply_surface_imputer, surface_regression_impute
from rentlens.operators import filters, impute, joins, levels, polygons, spatial, writes
from rentlens.session import dealt, materialise

LAT_RANGE, LON_RANGE = (-37.5, -36.0), (-73.7, -72.5)
MAX_PRICE = 8_000_000.0
COUNTS = ["cantidad_plazas", "cantidad_colegios"]
FEATURES = [
    "dormitorios", "banos", "estacionamientos", "superficie_util", "superficie_total", "antiguedad", "piso", "ascensor", "piscina",
    "cantidad_plazas", "cantidad_colegios", "precio_m2_sector", "tiene_comparables", "nivel", "amoblado", "ratio_total_util",
]


def clean_listings(df: DataFrame) -> DataFrame:
    """Row filters and simple fills, before any spatial step."""
    out = filters.max_bound_filter(df, {"dormitorios": 6, "banos": 5, "estacionamientos": 15})
    out = filters.drop_incomplete(out, ["dormitorios", "banos", "superficie"])
    out, _ = filters.bbox_filter(out, "lat", "lon", LAT_RANGE, LON_RANGE)
    out = out.withColumns(
        {**{c: N.fill_zero(c) for c in ["ascensor", "piscina", "gastos", *COUNTS]}, "piso": N.fill_zero("piso", 1.0)}
    )
    return impute.replace_outlier_with_mean(out, "piso", 30)


def priced(df: DataFrame, rates: DataFrame, max_price: float = MAX_PRICE) -> DataFrame:
    """Base-currency price, the price cap, then the total-cost target."""
    out = joins.fx_convert(df, rates, "precio", "moneda", "fecha")
    return filters.total_cost(filters.max_value_filter(out, "precio_clp", max_price), "precio_clp", "gastos")


DISTANCES = ["dist_place_m", "dist_centre_m"]
CENTRE = (-36.827, -73.05)
#: Places with fewer rows share one indicator.
MIN_PLACE_ROWS = 20
OTHER_PLACES = "otras comunas"


def zone_values(df: DataFrame, zones: DataFrame, attrs: Sequence[str]) -> DataFrame:
    """Attributes of the polygon that a row lies in, null outside of all."""
    empty = df.withColumns({"zona": F.lit(None).cast("string"), **{a: F.lit(None).cast("double") for a in attrs}})
    typed = zones.withColumns({a: F.col(a).cast("double") for a in attrs})
    return polygons.enrich_from_zones(empty, typed, "lat", "lon", "zona", "geometria_wkt", list(attrs)).drop("zona")


def zone_indicators(df: DataFrame, zones: DataFrame | None, attrs: Sequence[str]) -> DataFrame:
    """``zone_values``; rows outside get their place's mean, then the overall mean."""
    if zones is None:
        return df
    return impute.group_mean_impute(zone_values(df, zones, attrs), list(attrs), "comuna")


def place_columns(df: DataFrame, places: Sequence[str]) -> DataFrame:
    """One 0/1 column per listed place, and one for all others."""
    named = df.withColumn("_place", F.when(F.col("comuna").isin(list(places)), F.col("comuna")).otherwise(OTHER_PLACES))
    return named.select(*df.columns, *N.one_hot("_place", [*places, OTHER_PLACES], "comuna")).drop("_place")


def feature_table_training(
    listings: DataFrame, rates: DataFrame, groups: Sequence[str], trees: int = 50, population: dict | None = None,
    zones: DataFrame | None = None, zone_attrs: Sequence[str] = (), details: DataFrame | None = None,
) -> tuple[DataFrame, dict]:
    """(feature table with id, features and costo_total; artifacts: level map, default level, surface models, centroids, places, zones).

    ``details`` (by id) enriches the listings first; ``zones`` (zona, geometria_wkt, attributes) adds zone indicators.

    The rows are dealt over the tasks first; the table is written wherever several later passes read it again.
    """
    src = joins.left_enrich(listings, details, "id") if details is not None else listings
    src = filters.population_filter(src, **population) if population else src
    src = materialise(dealt(src, src.count(), "id"), "listings")  # narrow rows, which may come as one task's
    base = materialise(zone_indicators(clean_listings(src), zones, zone_attrs), "clean")
    places = base.groupBy("comuna").agg(F.avg("lat").alias("clat"), F.avg("lon").alias("clon"), F.count(F.lit(1)).alias("n")).filter("comuna IS NOT NULL")
    places = materialise(places, "places")  # one row per place
    names = sorted(r["comuna"] for r in places.filter(F.col("n") >= MIN_PLACE_ROWS).select("comuna").collect())
    base = spatial.nearest_fill(base, "id", "lat", "lon", "barrio")
    base = materialise(priced(base, rates), "priced")

    value = base.withColumn("_v", N.safe_ratio("costo_total", "superficie_util"))
    table, default = levels.weighted_quantile_levels(value, "_v", "barrio")
    table, default = materialise(table, "levels"), materialise(default, "level-default")
    default_level = default.first()["nivel_default"]
    base = levels.map_with_default(base, table.select("barrio", "nivel"), "barrio", "nivel", F.lit(default_level), "nivel")
    base = materialise(base, "levelled")

    numeric = ["dormitorios", "banos"]
    base, useful = surface_regression_impute(base, "superficie_util", numeric, ["comuna"], "tipo", groups, trees=trees)
    base = materialise(base, "useful-surfaces")
    base, total = surface_regression_impute(
        base, "superficie_total", [*numeric, "superficie_util"], ["comuna"], "tipo", groups, trees=trees
    )
    base = materialise(base, "surfaces")

    base = base.withColumn("_v", N.safe_ratio("costo_total", "superficie_util"))
    base = spatial.radius_median(base, "id", "lat", "lon", "_v", "tipo", 300.0, out="precio_m2_sector", flag="tiene_comparables").drop("_v")
    base = impute.group_mode_impute(base, ["antiguedad"], ["lat", "lon"])
    base = materialise(base, "comparables")
    base = spatial.radius_impute(base, "lat", "lon", "antiguedad", "tipo", 200.0, out="_cerca")
    base = impute.median_cascade(base, "antiguedad", "_cerca", ["tipo", "comuna"]).drop("_cerca")
    base = filters.coalesce_surface(base, ["superficie_util", "superficie_total"], "superficie")
    base = spatial.centroid_distance(base, places, "comuna", "lat", "lon", CENTRE)
    out = base.withColumns(
        {
            "amoblado": T.text_flag("titulo"),
            "ratio_total_util": N.safe_ratio("superficie_total", "superficie_util"),
            "tiene_comparables": F.col("tiene_comparables").cast("int"),
        }
    ).select("id", "comuna", "lat", "lon", *FEATURES, *zone_attrs, *DISTANCES, "gastos", "costo_total")
    out = place_columns(out, names)
    artifacts = {"places": names, "centroids": places, "zone_attrs": list(zone_attrs), "zones": zones, "levels": table, "default": default, "default_level": default_level, "superficie_util": useful, "superficie_total": total}
    return out, artifacts


def apply_surface_models(df: DataFrame, models: dict[str, PipelineModel], target: str, numeric: Sequence[str], group: str) -> DataFrame:
    """Stored imputers applied per group; groups without a model are left as they are."""
    rest = df.filter(F.col(group).isNull() | ~F.col(group).isin(list(models)))
    out = rest.withColumn(target, F.col(target).cast("double"))
    for g, m in models.items():
        out = out.unionByName(apply_surface_imputer(m, df.filter(F.col(group) == g), target, numeric))
    return out


def feature_table_serving(
    listings: DataFrame, predictions: DataFrame, reference: DataFrame, artifacts: dict, states: Sequence[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(features of the rows still to be scored, rejected ids with their reason).

    ``reference`` is a training feature table with coordinates. Zone attributes come from the polygons of training; rows
    outside of all get their place's mean in the reference. Unknown parking counts as none here, while training drops
    such rows.
    """
    pending = joins.unscored_anti_join(listings, predictions, "id", states)
    pending = materialise(dealt(pending, pending.count(), "id"), "unscored")
    reason = filters.sanity_reason("dormitorios", "banos", "estacionamientos", ["superficie_util", "superficie_total", "superficie"])
    ok, rejected = filters.sanity_split(pending, "id", reason)
    attrs = artifacts.get("zone_attrs", [])
    if artifacts.get("zones") is not None:
        ok = zone_values(ok, artifacts["zones"], attrs)
    ok = ok.withColumns({a: F.lit(None).cast("double") for a in attrs if a not in ok.columns})
    ok = materialise(ok, "sane")  # each imputer reads its rows again
    numeric = ["dormitorios", "banos"]
    ok = apply_surface_models(ok, artifacts["superficie_util"], "superficie_util", numeric, "tipo")
    ok = apply_surface_models(ok, artifacts["superficie_total"], "superficie_total", [*numeric, "superficie_util"], "tipo")
    ok = materialise(filters.coalesce_surface(ok, ["superficie_util", "superficie_total"], "superficie"), "pending")
    ref = reference.withColumn("precio_m2", N.safe_ratio("costo_total", "superficie_util")).filter("lat IS NOT NULL AND lon IS NOT NULL")
    out = joins.reference_lookup(ok, ref, "comuna", "lat", "lon", "antiguedad", "piso", attrs)
    out = levels.map_with_default(
        out, artifacts["levels"].select("barrio", "nivel"), "barrio", "nivel", F.lit(artifacts["default_level"]), "nivel"
    )
    out = out.withColumns(
        {
            **{c: N.fill_zero(c) for c in ["estacionamientos", "ascensor", "piscina", "gastos", *COUNTS]},
            "amoblado": T.text_flag("titulo"),
            "ratio_total_util": N.safe_ratio("superficie_total", "superficie_util"),
            "tiene_comparables": F.col("tiene_comparables").cast("int"),
        }
    )
    out = spatial.centroid_distance(out, artifacts["centroids"], "comuna", "lat", "lon", CENTRE)
    return place_columns(out.select("id", "comuna", *FEATURES, *attrs, *DISTANCES, "gastos"), artifacts["places"]).drop("comuna"), rejected


def write_back_surfaces(table: DataFrame, features: DataFrame) -> DataFrame:
    """``table`` with the corrected surfaces of the rows in ``features``; other rows stay as they are."""
    return writes.bulk_update_from(table, features.select("id", "superficie_util", "superficie_total"), "id", ["superficie_util", "superficie_total"])
