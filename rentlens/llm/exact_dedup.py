"""Exact deduplication against a persistent index of text digests.

The index is a Parquet table in the shared folder, bucketed and sorted by digest. A batch is reduced to one row per
digest (combined before the shuffle), sort-merge anti-joined with the index, and what is new is appended. Appending a
batch again adds nothing, and the row that an earlier, broken run put into the index is known again by its id: a job
that broke off can be run again, against the index that it left, and keeps the same rows. Only digests and ids are
shuffled, never texts.

Defined cases: a null text counts as empty; a null id is larger than any other; of rows repeated with one id and one
text a single row stays; an empty batch changes nothing.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentlens.llm.common import SPACE, attach, empty_if_null, materialise, scratch_path, shuffle_partitions


def normalised_text(text: str) -> F.Column:
    """The text with every run of ASCII white space replaced by one space."""
    return F.regexp_replace(empty_if_null(text), f"{SPACE}+", " ")


@dataclass
class Batch:
    """What one batch leaves behind: ``rows`` (id, digest, row, batch) and ``groups`` (digest, keep_id, keep_row, n)."""

    name: str
    rows: DataFrame
    groups: DataFrame


class DigestIndex:
    """``open`` binds a (new or existing) folder to a bucketed table; ``ingest`` adds a batch; ``resolve`` looks batches up."""

    def __init__(self, spark: SparkSession, path: str, buckets: int):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.table = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {self.table} (digest BINARY, keep_id BIGINT, batch STRING, keep_row BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'"
        )

    @classmethod
    def new(cls, spark: SparkSession, buckets: int | None = None) -> DigestIndex:
        return cls(spark, scratch_path(spark, "digest-index"), buckets or shuffle_partitions(spark))

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def ingest(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Batch:
        name = uuid.uuid4().hex
        rows = docs.select(
            F.col(id_col).cast("bigint").alias("id"),
            F.unhex(F.sha2(normalised_text(text_col), 256)).alias("digest"),
            F.monotonically_increasing_id().alias("row"),
            F.lit(name).alias("batch"),
        )
        rows = materialise(rows, "digests")
        groups = rows.groupBy("digest").agg(
            F.min("id").alias("keep_id"),
            F.coalesce(F.min_by("row", "id"), F.min("row")).alias("keep_row"),
            F.count(F.lit(1)).alias("n"),
        )
        groups = materialise(groups, "digest-groups")
        fresh = groups.join(self.read().select("digest").hint("merge"), "digest", "left_anti")
        fresh = fresh.repartition(self.buckets, "digest").select("digest", "keep_id", F.lit(name).alias("batch"), "keep_row")
        fresh.write.insertInto(self.table)
        return Batch(name, rows, groups)

    def resolve(self, *batches: Batch) -> DataFrame:
        """Per row of the batches: ``id, digest, keep_id, group_size`` (rows in these batches) and ``kept``."""
        groups, rows = None, None
        for place, b in enumerate(batches):
            own = b.groups.select("digest", "n", F.struct(F.lit(place).alias("place"), F.lit(b.name).alias("batch"), F.col("keep_row").alias("row")).alias("here"), F.col("keep_id").alias("here_id"))
            groups = own if groups is None else groups.unionByName(own)
            rows = b.rows if rows is None else rows.unionByName(b.rows)
        found = groups.join(self.read().hint("merge"), "digest")
        # a row of these batches, or the row of an earlier run that one of them holds again
        again = F.min(F.when(F.col("here_id").eqNullSafe(F.col("keep_id")), F.col("here")))
        known = F.first(F.struct("keep_id", "batch", "keep_row"))
        found = found.groupBy("digest").agg(F.sum("n").alias("group_size"), known.alias("known"), again.alias("again"))
        ours = F.col("known.batch").isin([b.name for b in batches])
        keeper = F.when(ours, F.struct(F.col("known.batch").alias("batch"), F.col("known.keep_row").alias("row"))).otherwise(F.struct("again.batch", "again.row"))
        found = materialise(found.select("digest", "group_size", "known.keep_id", keeper.alias("keeper")), "digest-found")
        out = attach(rows, found, "digest", "group_size")
        kept = F.coalesce((F.col("batch") == F.col("keeper.batch")) & (F.col("row") == F.col("keeper.row")), F.lit(False))
        return out.select("id", "digest", "keep_id", "group_size", kept.alias("kept"))

    def close(self) -> None:
        """Takes the table out of the catalog; the folder stays and can be opened again."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")


def dedup_in_batches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batches: int = 2) -> DataFrame:
    """Ingests ``docs`` as ``batches`` ascending id ranges, so the smallest id of each text stays, and resolves all rows."""
    ends = docs.agg(F.min(id_col).alias("low"), F.max(id_col).alias("high")).first()
    low, high = (0, 0) if ends["low"] is None else (ends["low"], ends["high"])
    cuts = [low + (high - low) * (i + 1) // batches for i in range(batches - 1)]
    index, done, left = DigestIndex.new(docs.sparkSession), [], None
    for i in range(batches):
        right = cuts[i] if i < len(cuts) else None
        inside = F.lit(True) if left is None else F.col(id_col) > left
        inside = inside & (F.col(id_col) <= right) if right is not None else inside | F.col(id_col).isNull()
        done.append(index.ingest(docs.filter(inside), id_col, text_col))
        left = right
    out = index.resolve(*done)
    index.close()
    return out
