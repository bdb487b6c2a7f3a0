"""Left joins to a lookup table that is unique by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(df: DataFrame, table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` left-joined to ``table`` on ``keys``; rows without a key get nulls.

    Rows without a key can be a large part. A second join key, a hash of the row for them and the only slot for all
    others, deals them over all tasks instead of one.
    """
    keys = list(keys)
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    plain = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    left = df.withColumn("_slot", F.when(missing, F.xxhash64(*plain)).otherwise(F.lit(0).cast("bigint")))
    right = table.withColumn("_slot", F.pmod(F.xxhash64(*keys), F.lit(1).cast("bigint")))
    return left.join(right, [*keys, "_slot"], "left").drop("_slot")
