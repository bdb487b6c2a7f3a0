"""Numeric column expressions: guarded ratios, bins, labels and derived measures."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: labels, tiers and display order of the valuation output
LABEL_CHEAP, LABEL_EXPENSIVE, LABEL_MARKET = "oportunidad", "caro", "precio_de_mercado"
CONFIDENCE_TIERS = ["alta confianza", "confianza media", "baja confianza"]
LABEL_RANK = {"oportunidad": 0, "precio_de_mercado": 1, "caro": 2}
CONFIDENCE_RANK = {"alta confianza": 0, "confianza media": 1, "baja confianza": 2}
LEVEL_NAMES = ["muy_barato", "barato", "medio", "alto", "muy_alto"]
MAD_SCALE = 1.4826
TINY_DIVISOR = 1e-6


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_ratio(a: Column | str, b: Column | str, fallback: Column | float | None = None) -> Column:
    """``a / b`` with a zero or null divisor giving ``fallback`` (null when omitted)."""
    ratio = as_col(a).cast("double") / F.nullif(as_col(b).cast("double"), F.lit(0.0))
    if fallback is None:
        return ratio
    return F.coalesce(ratio, fallback if isinstance(fallback, Column) else F.lit(float(fallback)))


def ape(actual: Column | str, predicted: Column | str) -> Column:
    """Absolute percentage error as a share; null where the actual value is 0."""
    return safe_ratio(F.abs(as_col(actual) - as_col(predicted)), actual)


def clip_at_zero(c: Column | str) -> Column:
    return F.greatest(as_col(c), F.lit(0.0))


def room_bucket(c: Column | str) -> Column:
    n = as_col(c)
    return F.when(n >= 4, F.lit("4+")).otherwise(n.cast("int").cast("string"))


def parking_flag(c: Column | str) -> Column:
    return F.coalesce(as_col(c), F.lit(0)) > 0


def fill_zero(c: Column | str, default: float = 0.0) -> Column:
    return F.coalesce(as_col(c).cast("string").try_cast("double"), F.lit(float(default)))


def label_by_threshold(z: Column | str, low: float = 1.0, high: float = 1.0) -> Column:
    z = as_col(z)
    return (
        F.when(z < -low, F.lit(LABEL_CHEAP)).when(z > high, F.lit(LABEL_EXPENSIVE)).when(z.isNotNull(), F.lit(LABEL_MARKET))
    )


def combined_label(label: Column | str, tier: Column | str) -> Column:
    return F.concat(as_col(label), F.lit(" ("), as_col(tier), F.lit(")"))


def one_hot(column: str, categories: Iterable[str], prefix: str | None = None) -> list[Column]:
    """0/1 columns for the sorted categories without the first one."""
    prefix = prefix or column
    return [
        F.coalesce(F.col(column) == F.lit(v), F.lit(False)).cast("int").alias(f"{prefix}_{v}")
        for v in sorted(categories)[1:]
    ]


def group_rare(column: Column | str, rare: Sequence[str], other: str = "otras comunas") -> Column:
    c = as_col(column)
    return F.when(c.isin(list(rare)), F.lit(other)).otherwise(c)


def derived_features(names: dict[str, str], amenities: Sequence[str], pois: Sequence[str]) -> dict[str, Column]:
    """Ratios and interactions; ``names`` maps each role to a column of the caller's table."""
    c = {role: F.col(col) for role, col in names.items()}
    usable, total = c["usable_area"], c["total_area"]

    def total_of(cols: Sequence[str]) -> Column:
        acc = F.lit(0.0)
        for col in cols:
            acc = acc + F.coalesce(F.col(col).cast("double"), F.lit(0.0))
        return acc

    return {
        "area_per_room": safe_ratio(usable, c["rooms"], usable),
        "baths_per_room": safe_ratio(c["baths"], c["rooms"], c["baths"].cast("double")),
        "parking_per_room": safe_ratio(c["parking"], c["rooms"], 0.0),
        "charges_per_m2": safe_ratio(c["charges"], usable, 0.0),
        "amenity_index": total_of(amenities),
        "high_floor_no_lift": c["floor"] * (1 - c["lift"]),
        "poi_density": total_of(pois),
        "distance_ratio": safe_ratio(c["dist_centre"], c["dist_local"], c["dist_centre"]),
        "implied_market_value": c["sector_price"] * usable,
        "level_x_area": c["level"] * usable,
        "space_efficiency": F.coalesce(F.nullif(usable, F.lit(0.0)) / F.nullif(total, F.lit(0.0)), F.lit(1.0)),
    }
