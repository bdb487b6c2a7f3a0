"""Enrichment joins, work queues, currency conversion and comparisons of two tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentlens.operators.keys import lookup
from rentlens.operators.quantiles import exact_median, exact_quantiles, iqr_bounds
from rentlens.operators.spatial import lookup_median

USD_RATE = 930.0


def left_enrich(
    listings: DataFrame, details: DataFrame, key: str, bridge: DataFrame | None = None, zones: DataFrame | None = None,
    zone: str = "zona", drop: Sequence[str] = (),
) -> DataFrame:
    """Details, then the id→zone bridge, then the zone's attributes; absent inputs are skipped."""
    out = listings.join(details, key, "left")
    if bridge is not None:
        out = out.join(bridge, key, "left")
    if zones is not None:
        out = out.join(zones, zone, "left")
    return out.drop(*drop)


def pending_anti_join(listings: DataFrame, details: DataFrame, key: str, state: str, terminal: str = "no_disponible") -> DataFrame:
    """Listings without a detail row that are still worth fetching."""
    return listings.filter(F.col(state) != terminal).join(details.select(key), key, "left_anti")


def unscored_anti_join(features: DataFrame, predictions: DataFrame, key: str, states: Sequence[str] | None = None, state: str = "estado") -> DataFrame:
    """Rows without a prediction of any version; with ``states``, all rows in those states instead.

    The second form does not touch the predictions, which hold one row per version and would multiply rows.
    """
    if states is not None:
        return features.filter(F.col(state).isin(list(states)))
    return features.join(predictions.select(key), key, "left_anti")


def recheck_queue(
    listings: DataFrame, details: DataFrame, key: str, as_of: str, min_days: int = 1, batch: int = 200,
    state: str = "estado", checked: str = "fecha_chequeo", states: Sequence[str] = ("activo", "pausado"),
) -> DataFrame:
    """The ``batch`` rows checked longest ago (never checked first, id breaks ties): a bounded work list."""
    due = F.col(checked).isNull() | (F.col(checked) <= F.date_sub(F.lit(as_of).cast("date"), min_days))
    return (
        listings.join(details, key)
        .filter(F.col(state).isin(list(states)) & due)
        .orderBy(F.col(checked).asc_nulls_first(), F.col(key))
        .limit(batch)
    )


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row per key by the ordering columns. An aggregation, so a key with very many rows is combined map-side."""
    rest = [c for c in df.columns if c not in keys]
    packed = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return packed.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest]).select(*df.columns)


def latest_version_join(listings: DataFrame, details: DataFrame, predictions: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    return listings.join(details, key).join(latest_per_key(predictions, [key], order), key)


def fx_convert(
    df: DataFrame, rates: DataFrame, price: str, currency: str, date: str, out: str = "precio_clp", rate: str = "valor",
    indexed: str = "UF", dollar: str = "US$", usd_rate: float = USD_RATE,
) -> DataFrame:
    """Price in base currency: indexed amounts by the rate of their date, dollars at a fixed rate, others as they are.

    A row without a date, or whose date has no rate, takes the rate of the mean date of the data set. Of several rates for one
    date the highest counts, so no row is doubled.
    """
    mean_date = df.agg(
        F.date_add(F.lit("1970-01-01").cast("date"), F.floor(F.avg(F.unix_date(date))).cast("int")).alias("d")
    )
    # at most one rate per date
    fallback = rates.groupBy("fecha").agg(F.max(rate).alias("_r")).join(F.broadcast(mean_date), F.col("fecha") == F.col("d")).agg(F.max("_r"))
    own = rates.filter("fecha IS NOT NULL").groupBy(F.col("fecha").alias(date)).agg(F.max(rate).alias("_rate"))
    joined = lookup(df, own, [date])
    value = (
        F.when(F.col(currency) == indexed, F.col(price) * F.coalesce(F.col("_rate"), fallback.scalar()))
        .when(F.col(currency) == dollar, F.col(price) * usd_rate)
        .otherwise(F.col(price).cast("double"))
    )
    return joined.withColumn(out, value).select(*df.columns, out)


def missing_rate_dates(df: DataFrame, rates: DataFrame, currency: str, date: str, indexed: str = "UF") -> DataFrame:
    """Dates whose rate is needed (those of indexed rows, and the mean date) but not stored."""
    mean_date = df.agg(F.date_add(F.lit("1970-01-01").cast("date"), F.floor(F.avg(F.unix_date(date))).cast("int")).alias("fecha"))
    needed = df.filter((F.col(currency) == indexed) & F.col(date).isNotNull()).select(F.col(date).alias("fecha"))
    return needed.union(mean_date).distinct().join(rates.select("fecha"), "fecha", "left_anti")


def reference_population(clean: DataFrame, coords: DataFrame, key: str, lat: str, lon: str, cost: str, area: str) -> DataFrame:
    """Cleaned rows with fresh coordinates and price per m²; rows without coordinates are dropped."""
    return (
        clean.join(coords.select(key, lat, lon), key)
        .dropna(subset=[lat, lon])
        .withColumn("precio_m2", F.col(cost) / F.nullif(F.col(area), F.lit(0.0)))
    )


def reference_lookup(
    points: DataFrame, reference: DataFrame, place: str, lat: str, lon: str, age: str, floor_: str, indicators: Sequence[str],
    price_radius: float = 300.0, age_radius: float = 200.0, floor_limit: float = 30.0,
) -> DataFrame:
    """Fill the features of new points from a fixed reference population.

    Sector price: median reference price within the radius, else the overall median, with a flag. Age:
    own, nearby median, place median, overall median. Indicators: own, place mean, overall mean.
    Floor: 1 when unknown, the reference mean when above the limit.
    """
    fence = iqr_bounds(reference, "precio_m2").select(F.struct("low", "high").alias("f")).scalar()
    fair = reference.withColumn("_f", fence).filter("precio_m2 BETWEEN _f.low AND _f.high").drop("_f")
    out = lookup_median(points, fair, lat, lon, "precio_m2", price_radius, "_sector")
    out = lookup_median(out, reference.filter(F.col(age).isNotNull()), lat, lon, age, age_radius, "_age")
    out = lookup(out, exact_median(reference, age, [place], "_place_age").select(place, "_place_age"), [place])
    if indicators:
        means = reference.groupBy(place).agg(*[F.avg(c).alias(f"_mean_{c}") for c in indicators])
        out = lookup(out, means, [place])
    overall = reference.agg(*[F.avg(c).alias(c) for c in indicators], F.avg(floor_).alias(floor_))
    overall = overall.select(F.struct(*overall.columns).alias("s"))
    medians = exact_quantiles(fair, "precio_m2", [0.5]).select(F.col("q")[0]).scalar()
    age_all = exact_median(reference, age).select("median").scalar()
    out = out.withColumn("_all", overall.scalar())
    replaced = {
        age: F.coalesce(F.col(age).cast("double"), "_age", "_place_age", age_all),
        floor_: F.when(F.col(floor_) > floor_limit, F.col(f"_all.{floor_}")).otherwise(F.coalesce(F.col(floor_).cast("double"), F.lit(1.0))),
        **{c: F.coalesce(F.col(c).cast("double"), F.col(f"_mean_{c}"), F.col(f"_all.{c}")) for c in indicators},
    }
    return out.select(
        *[replaced[c].alias(c) if c in replaced else F.col(c) for c in points.columns],
        F.coalesce(F.col("_sector"), medians).alias("precio_m2_sector"),
        F.col("_sector").isNotNull().alias("tiene_comparables"),
    )


def semi_join_ids(history: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    return history.join(ids.select(key).distinct(), key, "left_semi")


def except_ids(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """key, lado: keys found on one side only, both ways, in one aggregation."""
    tagged = a.select(key, F.lit(1).alias("l"), F.lit(0).alias("r")).unionAll(b.select(key, F.lit(0).alias("l"), F.lit(1).alias("r")))
    sides = tagged.groupBy(key).agg(F.max("l").alias("l"), F.max("r").alias("r")).filter("l <> r")
    return sides.select(key, F.when(F.col("l") == 1, "solo_a").otherwise("solo_b").alias("lado"))


def missing_names(expected: DataFrame, found: DataFrame, column: str) -> DataFrame:
    return expected.select(column).distinct().join(found.select(column), column, "left_anti")


def dedupe_known_ids(batch: DataFrame, known: DataFrame, key: str) -> DataFrame:
    return batch.dropna(subset=[key]).dropDuplicates([key]).join(known.select(key), key, "left_anti")


def source_reconciliation(a: DataFrame, b: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Field-by-field comparison of two extractions: presence on each side, differing fields, overall match."""
    left = a.select(key, F.lit(True).alias("_a"), *[F.col(c).alias(f"_a_{c}") for c in columns])
    right = b.select(key, F.lit(True).alias("_b"), *[F.col(c).alias(f"_b_{c}") for c in columns])
    both = F.col("_a").isNotNull() & F.col("_b").isNotNull()
    differing: list[Column] = [F.when(both & ~F.col(f"_a_{c}").eqNullSafe(F.col(f"_b_{c}")), F.lit(c)) for c in columns]
    joined = left.join(right, key, "full_outer").withColumn("campos", F.array_compact(F.array(*differing)))
    return joined.select(
        key, F.col("_a").isNotNull().alias("en_a"), F.col("_b").isNotNull().alias("en_b"), F.array_join("campos", ",").alias("difieren"),
        (both & (F.size("campos") == 0)).alias("coincide"),
    )


def comparability_check(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Settings rows found in one result set only; two sets are comparable when this is empty."""
    x, y = a.select(*columns), b.select(*columns)
    return x.exceptAll(y).withColumn("lado", F.lit("solo_a")).unionByName(y.exceptAll(x).withColumn("lado", F.lit("solo_b")))


def require_comparable(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> None:
    if not comparability_check(a, b, columns).isEmpty():
        raise ValueError("the two result sets were not produced under the same settings")
