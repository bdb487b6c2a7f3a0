"""Structured Streaming jobs: new listings, status changes and the daily snapshot."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from rentlens.operators.writes import last_per_key, unseen_rows
from rentlens.session import scratch_path
from rentlens.sources.tables import table_exists


def file_stream(spark: SparkSession, folder: str, schema, pattern: str = "*.parquet", max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder)


def stream_new_listings(source: DataFrame, key: str, order: str, table: str, checkpoint: str) -> StreamingQuery:
    """Append only the first sight of each id to a Parquet table.

    Of a batch's rows of one id the first by ``order`` counts; ids already stored are dropped by an anti-join,
    however late or out of order a row comes. A replayed batch finds its own rows stored and adds nothing.
    """

    def add(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        if table_exists(spark, table):
            batch = unseen_rows(spark.read.schema(batch.schema).parquet(table), batch, [key], [order])
        else:
            batch = unseen_rows(batch.limit(0), batch, [key], [order])
        batch.write.mode("append").parquet(table)

    return source.dropna(subset=[key]).writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


CHANGE_SCHEMA = "id bigint, seq bigint, estado string, intentos_fallidos bigint, terminal boolean"


def status_changes(visits: DataFrame, limit: int = 5) -> DataFrame:
    """Stream of status changes from visits (id, seq, fallo, estado).

    State per id: last status and failures since the last success, a few bytes. A success resets the
    counter and reports its status when it differs; a failure beyond ``limit`` makes the id terminal.
    """

    def advance(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, failures = state.get if state.exists else (None, 0)
        rows = pd.concat(list(frames)).sort_values("seq")
        out = []
        for seq, failed, status in zip(rows["seq"], rows["fallo"], rows["estado"]):
            failures = failures + 1 if failed else 0
            now = ("no_disponible" if failures > limit else last) if failed else status
            if now is not None and now != last:
                out.append((key[0], seq, now, failures, failures > limit))
                last = now
        state.update((last, failures))
        yield pd.DataFrame(out, columns=["id", "seq", "estado", "intentos_fallidos", "terminal"])

    return (
        visits.select("id", "seq", "fallo", "estado")
        .groupBy("id")
        .applyInPandasWithState(advance, CHANGE_SCHEMA, "estado string, fallos bigint", "append", GroupStateTimeout.NoTimeout)
    )


def stream_status_changes(visits: DataFrame, table: str, checkpoint: str, limit: int = 5) -> StreamingQuery:
    return (
        status_changes(visits, limit)
        .writeStream.format("parquet").option("path", table).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def stream_daily_snapshot(visits: DataFrame, table: str, checkpoint: str, event_time: str = "ts") -> StreamingQuery:
    """Keep the last status per (day, id) in a table partitioned by day; only the days of a batch are rewritten."""

    def merge(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        new = last_per_key(batch.select(F.to_date(event_time).alias("fecha"), "id", "seq", "estado"), ["fecha", "id"], ["seq"])
        if table_exists(spark, table):
            days = new.select("fecha").distinct()
            old = spark.read.schema("id bigint, seq bigint, estado string, fecha date").parquet(table).join(days, "fecha", "left_semi")
            new = last_per_key(old.select(*new.columns).unionByName(new), ["fecha", "id"], ["seq"])
        # the rows are written aside first, because the merged days are being read
        staged = scratch_path(spark, "snapshot")
        new.write.parquet(staged)
        spark.read.schema(new.schema).parquet(staged).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("fecha").parquet(table)

    return visits.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def run_to_end(query: StreamingQuery) -> None:
    query.awaitTermination()
    if query.exception():
        raise query.exception()
