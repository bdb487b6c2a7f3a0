import pytest
from pyspark.sql import types as T

DOCS = T.StructType().add("doc_id", T.LongType()).add("text", T.StringType()).add("lang", T.StringType()).add("source", T.StringType()).add("n_chars", T.LongType())


@pytest.fixture
def docs(spark):
    """``docs([(doc_id, text), …])`` or rows with lang and source: a documents table with an extra column of a clashing name."""

    def make(rows, partitions=3, extra=("_keep", "size")):
        full = [(*r, *("en", "s0")[len(r) - 2 :], None if r[1] is None else len(r[1])) if len(r) < 5 else r for r in rows]
        df = spark.createDataFrame(full, DOCS).repartition(partitions)
        for name in extra:
            df = df.selectExpr("*", f"'extra' AS `{name}`")
        return df

    return make
