"""Values off the fixtures: nothing stops a job, nothing is lost or doubled."""

import datetime

import pytest
from pyspark.sql import functions as F

from rentlens.functions import text as T
from rentlens.operators import extract, joins
from rentlens.session import scratch_path
from rentlens.sources import tables
from rentlens.streaming import jobs


def test_numbers(spark):
    df = spark.createDataFrame([("99999999999",), ("NaN",), ("Infinity",), ("-1e400",), (" 7.9 ",), ("x",), (None,)], "t string")
    got = [tuple(r) for r in df.select(T.to_integer("t"), T.to_number("t")).collect()]
    assert got == [(None, 99999999999.0), (None, None), (None, None), (None, None), (7, 7.9), (None, None), (None, None)]
    assert extract.convert_typed(df.withColumnRenamed("t", "banos"), integers=["banos"]).filter("banos IS NOT NULL").count() == 1


def test_relative_dates(spark):
    df = spark.createDataFrame([("9999999 años",), ("99999999999999 días",), ("5000 años",), ("2 semanas",)], "t string")
    got = [r[0] for r in df.select(T.relative_date("t", "2025-01-15")).collect()]
    assert got == [None, None, None, datetime.date(2025, 1, 1)]


def test_two_rates_for_one_date(spark):
    rows = spark.createDataFrame([(1, "UF", 2.0, "2024-01-01"), (2, "UF", 1.0, None)], "id int, m string, p double, f string").withColumn("f", F.col("f").cast("date"))
    rates = spark.createDataFrame([("2024-01-01", 10.0), ("2024-01-01", 11.0), (None, 5.0)], "fecha string, valor double").withColumn("fecha", F.col("fecha").cast("date"))
    assert sorted((r["id"], r["precio_clp"]) for r in joins.fx_convert(rows, rates, "p", "m", "f").collect()) == [(1, 22.0), (2, 11.0)]


def test_stream_takes_late_and_unordered_rows(spark):
    folder, table, ck = (scratch_path(spark, n) for n in ("in", "out", "ck"))
    schema = "id bigint, n bigint, ts timestamp"

    def add(*rows):
        df = spark.createDataFrame([(i, n, datetime.datetime(2024, 1, 1) + datetime.timedelta(days=d)) for i, n, d in rows], schema)
        df.repartition(len(rows)).write.mode("append").parquet(folder)
        jobs.run_to_end(jobs.stream_new_listings(jobs.file_stream(spark, folder, df.schema), "id", "n", table, ck))

    add((1, 10, 60), (1, 5, 0), (3, 8, 60))
    add((2, 1, 1), (1, 2, 0), (None, 3, 1))
    assert sorted((r["id"], r["n"]) for r in spark.read.parquet(table).collect()) == [(1, 5), (2, 1), (3, 8)]


def test_next_counter_lets_errors_out(spark):
    root = scratch_path(spark, "registry")
    assert tables.next_counter(spark, root) == 1
    tables.register_version(spark, root, "v", "gbt", 4)
    assert tables.next_counter(spark, root) == 5
    spark.range(1).write.parquet(f"{root}x/registry")
    with pytest.raises(Exception, match="contador"):
        tables.next_counter(spark, f"{root}x")


def test_nearest_fill_without_a_donor(spark):
    from rentlens.operators.spatial import nearest_fill

    df = spark.createDataFrame([(1, 1.0, 2.0, None)], "id int, lat double, lon double, a string")
    with pytest.raises(ValueError, match="no row"):
        nearest_fill(df, "id", "lat", "lon", "a")
