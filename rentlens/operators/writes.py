"""Result tables of keyed writes: first-seen inserts, upserts, partial updates, snapshots, run records.

Every function returns the table as it would be after the write; ``sources.tables`` stores it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row coming first in ``order`` for each key; rows with a null key are dropped. Combines before the shuffle."""
    picked = df.dropna(subset=list(keys)).groupBy(*keys).agg(
        F.min_by(F.struct(*df.columns), F.struct(*order)).alias("_r")
    )
    return picked.select("_r.*").select(*df.columns)


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    picked = df.dropna(subset=list(keys)).groupBy(*keys).agg(
        F.max_by(F.struct(*df.columns), F.struct(*order)).alias("_r")
    )
    return picked.select("_r.*").select(*df.columns)


def unseen_rows(existing: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows of the batch that an insert-if-absent would add."""
    return first_per_key(batch, keys, order).join(existing.select(*keys), list(keys), "left_anti").select(*batch.columns)


def insert_new_only(existing: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return existing.unionByName(unseen_rows(existing, batch, keys, order).select(*existing.columns))


def upsert_by_key(existing: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Whole-row replacement; the last row of the batch wins."""
    new = last_per_key(batch, keys, order).select(*existing.columns)
    return existing.join(new.select(*keys), list(keys), "left_anti").select(*existing.columns).unionByName(new)


def upsert_columns(existing: DataFrame, batch: DataFrame, key: str, columns: Sequence[str], insert: bool = True, order: Sequence[str] = ()) -> DataFrame:
    """Write only the listed columns of matching rows; unmatched batch rows are inserted when ``insert``.

    Of several batch rows with one key the last in ``order`` counts, by default the one with the largest values; batch
    rows without a key are left out.
    """
    new = last_per_key(batch.select(key, *columns, *[c for c in order if c not in (key, *columns)]), [key], order or columns)
    new = new.select(F.col(key), F.lit(True).alias("_hit"), *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = existing.join(new, key, "full_outer" if insert else "left")
    return joined.select(
        *[
            F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
            for c in existing.columns
        ]
    )


def bulk_update_from(existing: DataFrame, batch: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    return upsert_columns(existing, batch, key, columns, insert=False)


def update_status(existing: DataFrame, ids: DataFrame, key: str, state: str, as_of: str, state_col: str, date_col: str) -> DataFrame:
    change = ids.select(key).distinct().select(key, F.lit(state).alias(state_col), F.lit(as_of).cast("date").alias(date_col))
    return upsert_columns(existing, change, key, [state_col, date_col], insert=False)


def day_rows(listings: DataFrame, as_of: str, states: Sequence[str], id_col: str = "id", state: str = "estado") -> DataFrame:
    return listings.filter(F.col(state).isin(list(states))).select(
        F.lit(as_of).cast("date").alias("fecha"), F.col(id_col).alias("id"), F.col(state).alias("estado")
    )


def daily_snapshot(existing: DataFrame, listings: DataFrame, as_of: str, states: Sequence[str], id_col: str = "id", state: str = "estado") -> DataFrame:
    """The history with the day's (date, id, state) rows replaced: a rerun of the same day overwrites."""
    return upsert_by_key(existing, day_rows(listings, as_of, states, id_col, state), ["fecha", "id"], ["estado"])


def run_record(visits: DataFrame, run_id: str, started: str, ended: str, new_condition: str, error_condition: str) -> DataFrame:
    """One metadata row describing a finished run."""
    return visits.agg(
        F.lit(run_id).alias("corrida"), F.min(started).alias("inicio"), F.max(ended).alias("fin"),
        F.count(F.lit(1)).alias("procesados"), F.count_if(F.expr(new_condition)).alias("nuevos"),
        F.count_if(F.expr(error_condition)).alias("errores"),
    ).withColumn(
        "resultado", F.when(F.col("errores") == 0, "ok").when(F.col("errores") < F.col("procesados"), "parcial").otherwise("error")
    )


def version_registry(runs: DataFrame, order: str, version: str) -> tuple[DataFrame, DataFrame]:
    """(every version with its counter, the current one). The counter numbers the versions in registration order."""
    from pyspark.sql import Window

    # one row per trained version: a small metadata table
    numbered = runs.withColumn("contador", F.row_number().over(Window.orderBy(order, version)))
    current = numbered.agg(F.max_by(F.struct(*numbered.columns), F.col("contador")).alias("r")).select("r.*")
    return numbered, current
