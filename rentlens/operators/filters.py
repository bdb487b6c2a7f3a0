"""Row filters, projections and schema guards."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentlens.functions.numeric import room_bucket

DAYS_PER_MONTH = 30


def population_predicate(
    kind: str, states: Sequence[str], as_of: str, max_months: int | None,
    terminal: Sequence[str] = ("finalizado",), kind_col: str = "tipo", state_col: str = "estado", date_col: str = "fecha",
) -> Column:
    """Rows of one kind in the wanted states; terminal states only when young enough. A null date fails."""
    keep = (F.col(kind_col) == kind) & F.col(state_col).isin(list(states))
    if max_months:
        oldest = F.date_sub(F.lit(as_of).cast("date"), DAYS_PER_MONTH * max_months)
        keep = keep & (~F.col(state_col).isin(list(terminal)) | (F.col(date_col) >= oldest))
    return keep


def population_filter(df: DataFrame, *args, **kwargs) -> DataFrame:
    return df.filter(population_predicate(*args, **kwargs))


def max_bound_filter(df: DataFrame, bounds: Mapping[str, float], null_ok: Sequence[str] = ()) -> DataFrame:
    """Keep rows with every bounded column at most its bound; a null drops the row unless listed in ``null_ok``."""
    out = df
    for c, bound in bounds.items():
        value = F.col(c).cast("string").try_cast("double")
        keep = value <= bound
        out = out.filter(value.isNull() | keep if c in null_ok else keep)
    return out


def drop_incomplete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def in_box(lat: str, lon: str, lat_range: tuple[float, float], lon_range: tuple[float, float]) -> Column:
    """True inside the box (ends included) and for rows without usable coordinates."""
    la, lo = F.col(lat).cast("string").try_cast("double"), F.col(lon).cast("string").try_cast("double")
    return la.isNull() | lo.isNull() | (la.between(*lat_range) & lo.between(*lon_range))


def bbox_filter(df: DataFrame, lat: str, lon: str, lat_range, lon_range) -> tuple[DataFrame, DataFrame]:
    """(kept, rejected)."""
    inside = in_box(lat, lon, lat_range, lon_range)
    return df.filter(inside), df.filter(~inside)


def max_value_filter(df: DataFrame, column: str, limit: float) -> DataFrame:
    return df.filter(F.col(column) <= limit)


def sanity_reason(
    rooms: str, baths: str, parking: str, areas: Sequence[str], max_rooms: int = 6, max_baths: int = 5, max_parking: int = 15
) -> Column:
    """Why a row cannot be valued (first failing rule), null when it can."""
    no_area = reduce(lambda a, b: a & b, [F.col(c).isNull() for c in areas])

    def extreme(label: str, c: str) -> Column:
        return F.concat(F.lit(f"{label} extremos ("), F.col(c).cast("string"), F.lit(")"))

    return (
        F.when(F.col(rooms).isNull() | F.col(baths).isNull(), F.lit("sin dormitorios/baños"))
        .when(F.col(rooms) > max_rooms, extreme("dormitorios", rooms))
        .when(F.col(baths) > max_baths, extreme("baños", baths))
        .when(F.col(parking) > max_parking, extreme("estacionamientos", parking))
        .when(no_area, F.lit("sin ningún dato de superficie"))
    )


def sanity_split(df: DataFrame, id_col: str, reason: Column) -> tuple[DataFrame, DataFrame]:
    """(valid rows, (id, reason) of the others)."""
    marked = df.withColumn("motivo", reason)
    return marked.filter(F.col("motivo").isNull()).drop("motivo"), marked.filter(F.col("motivo").isNotNull()).select(
        id_col, "motivo"
    )


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing {len(missing)} expected column(s): {missing}")
    return df


def check_constraints(df: DataFrame, domains: Mapping[str, Sequence[str]]) -> DataFrame:
    """One row per checked column: how many non-null values fall outside its domain."""
    counts = df.agg(*[F.count_if(~F.col(c).isin(list(v))).alias(c) for c, v in domains.items()])
    return counts.unpivot([], list(domains), "columna", "violaciones")


def facet_filter(
    df: DataFrame,
    ranges: Mapping[str, tuple[float, float]] | None = None,
    members: Mapping[str, Sequence] | None = None,
    buckets: Mapping[str, Sequence[str]] | None = None,
    flags: Sequence[str] = (),
    optional_members: Sequence[str] = (),
) -> DataFrame:
    """Conjunction of range, membership, room-bucket and ticked-flag predicates.

    An empty selection keeps nothing, except for the ``optional_members`` columns, where it means "any".
    """
    predicates = [F.col(c).between(lo, hi) for c, (lo, hi) in (ranges or {}).items()]
    for c, wanted in (members or {}).items():
        if wanted or c not in optional_members:
            predicates.append(F.col(c).isin(list(wanted)))
    predicates += [room_bucket(c).isin(list(wanted)) for c, wanted in (buckets or {}).items()]
    predicates += [F.coalesce(F.col(c).cast("boolean"), F.lit(False)) for c in flags]
    return df.filter(reduce(lambda a, b: a & b, predicates, F.lit(True)))


def status_filter(df: DataFrame, include_paused: bool, column: str = "estado") -> DataFrame:
    return df.filter(F.col(column).isin("activo", "pausado") if include_paused else F.col(column) == "activo")


def select_present(df: DataFrame, required: Sequence[str], optional: Sequence[str] = ()) -> DataFrame:
    require_columns(df, required)
    return df.select(*required, *[c for c in optional if c in df.columns])


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def align_columns(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = (), fill: float = 0.0) -> DataFrame:
    """Exactly ``keep`` then ``columns`` in order; absent ones are filled, unknown ones dropped."""
    return df.select(*keep, *[F.col(c) if c in df.columns else F.lit(fill).alias(c) for c in columns])


def total_cost(df: DataFrame, price: str, charges: str, out: str = "costo_total") -> DataFrame:
    return df.withColumn(out, F.col(price) + F.col(charges))


def exclude_leaky(df: DataFrame, id_col: str, target: str, leaky: Sequence[str]) -> list[str]:
    """Names of the candidate features: everything but the id, the target and the target's components."""
    return [c for c in df.columns if c not in {id_col, target, *leaky}]


def drop_unfetchable(df: DataFrame, url: str = "url", cap: int | None = None, order: Sequence[str] = ()) -> DataFrame:
    out = df.dropna(subset=[url])
    if order:
        out = out.orderBy(*order)
    return out.limit(cap) if cap else out


def coalesce_surface(df: DataFrame, targets: Sequence[str], fallback: str) -> DataFrame:
    """Fill the target areas from the general one; rows still without an area are dropped, and the general column too."""
    filled = df.withColumns({c: F.coalesce(F.col(c), F.col(fallback)) for c in targets})
    return filled.dropna(subset=list(targets)).drop(fallback)
