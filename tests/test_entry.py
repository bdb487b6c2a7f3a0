import duckdb
import pytest

import __spark_entry__ as entry
from check_queries import rows_of
from rentlens.sources.views import TABLES

SF = "/root/testdata/sf0.001"
SAMPLE = [
    "map_with_default", "radius_median", "nearest_fill", "point_in_polygon", "label_opportunities", "entries_exits", "stratified_split", "fx_convert",
    "upsert_columns", "stream_status_changes", "stream_daily_snapshot", "stream_new_listings", "latest_version_join", "size_anomaly",
]


def test_registry():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 150


def test_flagship(spark):
    assert entry.entry(spark).columns == ["id", "nivel"]


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = entry.queries()[name](spark, SF)
    rel = con.execute(entry.oracle_sql()[name])
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of([d[0] for d in rel.description], rel.fetchall())
