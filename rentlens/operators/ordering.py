"""Listing orders, pages and top-n."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentlens.functions.numeric import CONFIDENCE_RANK, LABEL_RANK

PAGE_SIZE = 24
UNKNOWN_RANK = 99


def _rank(column: str, ranks: dict[str, int]) -> Column:
    pairs = [F.lit(x) for kv in ranks.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.col(column)), F.lit(UNKNOWN_RANK))


def order_columns(order: str, id_col: str = "id") -> list[Column]:
    """Sort keys of the five listing orders; the id makes each total."""
    keys = {
        "best": [F.col("z_robusto").asc_nulls_last()],
        "newest": [F.col("fecha").desc_nulls_last(), F.col("fecha_chequeo").desc_nulls_last()],
        "cheapest": [F.col("precio").asc_nulls_last()],
        "dearest": [F.col("precio").desc_nulls_last()],
    }.get(order, [_rank("etiqueta", LABEL_RANK), _rank("nivel_confianza", CONFIDENCE_RANK)])
    return [*keys, F.col(id_col)]


def sort_listings(df: DataFrame, order: str, id_col: str = "id") -> DataFrame:
    return df.orderBy(*order_columns(order, id_col))


def total_pages(df: DataFrame, size: int = PAGE_SIZE) -> int:
    return max(1, -(-df.count() // size))


def paginate(df: DataFrame, page: int, keys: list[Column], size: int = PAGE_SIZE) -> DataFrame:
    """The rows of one page; a page past the end shows the first one."""
    if page < 1 or page > total_pages(df, size):
        page = 1
    return df.orderBy(*keys).offset((page - 1) * size).limit(size)


def top_n(df: DataFrame, score: str, n: int, tie: str) -> DataFrame:
    return df.orderBy(F.desc_nulls_last(score), F.col(tie)).limit(n)


def priority_queue(df: DataFrame, column: str, n: int, tie: str) -> DataFrame:
    """Oldest first, never-seen before all."""
    return df.orderBy(F.col(column).asc_nulls_first(), F.col(tie)).limit(n)


def batch_cap(df: DataFrame, n: int, order: str) -> DataFrame:
    return df.orderBy(order).limit(n)
