"""Exact order statistics, medians and quantiles that never gather a group in one task.

Spark's ``percentile`` keeps every distinct value of a group in one aggregation buffer. Here the
values are first counted per coarse bucket (a monotone, data-independent function of the value, so
counting combines before the shuffle), the bucket holding each wanted rank is read off the bounded
bucket table, and only the rows of those buckets are looked at again. A bucket of more than
``SORT_ROWS`` rows is refined: the range from its least to its greatest value is cut into ``CELLS``
cells, these are counted, and the rank goes on in one cell, until what is left is small or one value.
So whatever the values, no task sorts more than ``SORT_ROWS`` of them. The answer is exact.

``value`` and ``weight`` arguments are SQL expressions over the input's columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentlens.session import materialise, parallelism

BUCKETS_PER_OCTAVE = 256
SORT_ROWS = 1 << 18
CELLS = 4096


def names(cols: Sequence[str], prefix: str = "", trailing: bool = True) -> str:
    """Quoted column list for SQL text, with a trailing comma when not empty."""
    text = ", ".join(f"{prefix}`{c}`" for c in cols)
    return text + ", " if text and trailing else text


def run(text: str, **frames: DataFrame) -> DataFrame:
    """Run SQL text in which ``{name}`` stands for one of the DataFrames."""
    return next(iter(frames.values())).sparkSession.sql(text, **frames)


def value_bucket(v: str) -> str:
    """Monotone bucket number of a double: equal steps of log2(|v|), mirrored for negatives, never null."""
    return f"coalesce(cast(signum({v}) * floor((log2(abs({v})) + 1100) * {BUCKETS_PER_OCTAVE}) AS bigint), 0L)"


def _over(keys: Sequence[str], order: str = "") -> str:
    part = "PARTITION BY " + (names(keys, trailing=False) or "1")
    return f"OVER ({part} ORDER BY {order} ROWS UNBOUNDED PRECEDING)" if order else f"OVER ({part})"


def _wanted(totals: DataFrame, keys: Sequence[str], at: str, ranks: str, few: bool) -> DataFrame:
    """The pieces ``at`` of each group that hold a wanted rank: ``keys…, at, n, lo, hi, size, targets``.

    ``totals`` has per piece its weight ``bw``, its least and greatest value and its number of rows; ``ranks`` is SQL for
    an array of (tag, rank) given the group's weight ``n``. Written, or for few groups held by the driver.
    """
    k, ka = names(keys), names([*keys, at], trailing=False)
    out = run(
        f"""
WITH offs AS (SELECT *, sum(bw) {_over(keys, at)} AS upto, sum(bw) {_over(keys)} AS total FROM {{t}})
SELECT {ka}, max(coalesce(n, total)) AS n, max(lo) AS lo, max(hi) AS hi, max(size) AS size, collect_list(struct(t.tag AS tag, t.rank - upto + bw AS rank)) AS targets
FROM (SELECT *, explode({ranks}) AS t FROM (SELECT * EXCEPT (n), coalesce(n, total) AS n FROM offs)) WHERE t.rank >= upto - bw AND t.rank < upto GROUP BY {ka}""",
        t=totals,
    )
    if few:
        spark = out.sparkSession
        return spark.createDataFrame(out.collect(), out.schema)
    return materialise(out, "wanted")


def _refined(rows: DataFrame, wanted: DataFrame, keys: Sequence[str], few: bool) -> tuple[DataFrame, DataFrame]:
    """(rows, wanted) one level deeper: each wanted piece ``b`` cut into cells, of which only those with a wanted rank stay."""
    k = names(keys)
    hint = "/*+ BROADCAST(wanted) */" if few else ""
    kb = names([*keys, "b"], trailing=False)
    cell = f"cast(CASE WHEN hi > lo THEN least({CELLS - 1}D, floor((v - lo) / (hi - lo) * {CELLS})) ELSE 0 END AS bigint)"
    split = run(f"WITH wanted AS (SELECT {kb}, lo, hi FROM {{w}}) SELECT {hint} {k} b, v, w, {cell} AS c FROM {{r}} JOIN wanted USING ({kb})", w=wanted, r=rows)
    split = materialise(split, "cells")
    totals = run(
        f"""SELECT {hint} {k} b, c, bw, lo, hi, size, n, targets FROM
 (SELECT {k} b, c, sum(w) AS bw, min(v) AS lo, max(v) AS hi, count(*) AS size FROM {{s}} GROUP BY {kb}, c) JOIN (SELECT {kb}, n, targets FROM {{w}}) wanted USING ({kb})""",
        s=split, w=wanted,
    )
    deeper = _wanted(totals, [*keys, "b"], "c", "targets", few)
    piece = "struct(b, c)"
    deeper = deeper.selectExpr(*[f"`{c}`" for c in keys], f"{piece} AS b", "n", "lo", "hi", "size", "targets")
    return split.selectExpr(*[f"`{c}`" for c in keys], f"{piece} AS b", "v", "w"), deeper


def _found(rows: DataFrame, wanted: DataFrame, keys: Sequence[str], few: bool) -> DataFrame:
    """``keys…, n, tag, v`` for every wanted rank; the rows of a piece are sorted by value in one task."""
    k, kb = names(keys), names([*keys, "b"], trailing=False)
    hint = "/*+ BROADCAST(wanted) */" if few else ""
    return run(
        f"""
WITH wanted AS (SELECT {kb}, n, targets FROM {{w}}),
  inside AS (SELECT {hint} {k} b, v, sum(w) AS w FROM {{r}} LEFT SEMI JOIN wanted USING ({kb}) GROUP BY {kb}, v),
  ranked AS (SELECT {hint} {k} b, v, w, n, targets, sum(w) {_over([*keys, 'b'], 'v')} AS upto FROM inside JOIN wanted USING ({kb}))
SELECT {k} n, t.tag AS tag, v FROM (SELECT *, explode(filter(targets, t -> t.rank < upto AND t.rank >= upto - w)) AS t FROM ranked)""",
        r=rows, w=wanted,
    )


def ranked_values(
    df: DataFrame, value: str, ranks: Sequence[str], by: Sequence[str] = (), weight: str = "1", few_groups: bool = False
) -> DataFrame:
    """Values at 0-based ranks of each group: ``by…, n, s0, s1, …``.

    Each rank is SQL over ``n`` (the group's weight); a rank outside ``0…n-1`` gives null. Null keys
    and values are left out. ``few_groups`` states that the number of groups is bounded by
    construction (bins, tiers), so the table of wanted buckets may be held by the driver and broadcast;
    without keys it always is, having at most one row per rank.
    """
    by, few = list(by), few_groups or not by
    array = "array(" + ", ".join(f"struct({i} AS tag, cast({r} AS bigint) AS rank)" for i, r in enumerate(ranks)) + ")"
    not_null = "".join(f" AND `{c}` IS NOT NULL" for c in by)
    k, kb = names(by), names([*by, "b"], trailing=False)
    rows = run(
        f"""SELECT {k} v, w, {value_bucket('v')} AS b FROM
 (SELECT {k} cast({value} AS double) AS v, cast({weight} AS bigint) AS w FROM {{df}}) WHERE v IS NOT NULL{not_null}""",
        df=df,
    )
    totals = run(f"SELECT {kb}, sum(w) AS bw, min(v) AS lo, max(v) AS hi, count(*) AS size, cast(NULL AS bigint) AS n FROM {{r}} GROUP BY {kb}", r=rows)
    wanted = _wanted(totals, by, "b", array, few)
    while True:
        # a piece of one value needs no sort, however many rows it has
        large = wanted.filter(f"size > {SORT_ROWS} AND hi > lo")
        if large.isEmpty():
            break
        rows, wanted = _refined(rows, wanted, by, few)
    picks = ", ".join(f"max(CASE WHEN tag = {i} THEN v END) AS s{i}" for i in range(len(ranks)))
    group = f"GROUP BY {names(by, trailing=False)}" if by else ""
    return run(f"SELECT {names(by)} max(n) AS n, {picks} FROM {{f}} {group}", f=_found(rows, wanted, by, few))


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs: Sequence[float],
    by: Sequence[str] = (),
    weight: str = "1",
    out: str = "q",
    few_groups: bool = False,
) -> DataFrame:
    """Linear-interpolated quantiles: one row per group with ``by…, n, out`` (array aligned with ``probs``)."""
    ranks, values = [], []
    for i, p in enumerate(probs):
        at = f"(n - 1) * {float(p)!r}D"
        ranks += [f"floor({at})", f"least(floor({at}) + 1, n - 1)"]
        values.append(f"s{2 * i} + (s{2 * i + 1} - s{2 * i}) * ({at} - floor({at}))")
    found = ranked_values(df, value, ranks, by, weight, few_groups)
    return found.selectExpr(*[f"`{c}`" for c in by], "n", f"array({', '.join(values)}) AS `{out}`")


def exact_median(
    df: DataFrame, value: str, by: Sequence[str] = (), out: str = "median", few_groups: bool = False
) -> DataFrame:
    """Median per group: ``by…, n, out``."""
    found = ranked_values(df, value, ["floor((n - 1) / 2)", "floor(n / 2)"], by, few_groups=few_groups)
    return found.selectExpr(*[f"`{c}`" for c in by], "n", f"(s0 + s1) / 2 AS `{out}`")


def quantile_edges(df: DataFrame, value: str, bins: int, by: Sequence[str] = (), out: str = "edges") -> DataFrame:
    """Edges of ``bins`` equal-count bins, with duplicates removed: ``by…, n, out``."""
    q = exact_quantiles(df, value, [i / bins for i in range(bins + 1)], by, out="_q")
    return q.selectExpr(*[f"`{c}`" for c in by], "n", f"array_distinct(_q) AS `{out}`")


def iqr_bounds(df: DataFrame, value: str, by: Sequence[str] = (), multiplier: float = 3.0) -> DataFrame:
    """``[Q1 - m·IQR, Q3 + m·IQR]`` per group: ``by…, n, low, high``."""
    q = exact_quantiles(df, value, [0.25, 0.75], by, out="_q")
    m = f"{float(multiplier)!r}D"
    return q.selectExpr(
        *[f"`{c}`" for c in by],
        "n",
        f"_q[0] - {m} * (_q[1] - _q[0]) AS low",
        f"_q[1] + {m} * (_q[1] - _q[0]) AS high",
    )


def edge_values(df: DataFrame, value: str, bins: int) -> list[float]:
    """Distinct edges of ``bins`` equal-count bins, as at most ``bins + 1`` numbers on the driver."""
    row = quantile_edges(df, value, bins).first()
    return list(row["edges"]) if row and row["n"] else []


def median_mad(df: DataFrame, value: str, by: Sequence[str] = (), few_groups: bool = False) -> DataFrame:
    """Median and unscaled median absolute deviation per group: ``by…, n, median, mad``.

    The medians, one row per group, are written once and read by the second pass.
    """
    by = list(by)
    med = materialise(exact_median(df, value, by, few_groups=few_groups), "medians")
    if not by:
        middle = med.first()["median"]
        if middle is None:
            return med.selectExpr("n", "median", "cast(NULL AS double) AS mad")
        mad = exact_median(df, f"abs({value} - {middle!r}D)", out="mad")
        return med.withColumn("mad", mad.select("mad").scalar())
    medians = med.withColumnRenamed("median", "_median").drop("n")
    dev = df.join(medians.hint("broadcast") if few_groups else medians, by)
    mad = exact_median(dev, f"abs({value} - _median)", by, "mad", few_groups)
    return med.join(mad.drop("n"), by)


def running_total(df: DataFrame, order: str, value: str, tie: str) -> DataFrame:
    """Adds ``cum`` and ``cum_share``: the running sum of ``value`` in (order, tie) order, nulls first.

    Rows are dealt by ranges of (order, tie), so rows of one value spread too; the window runs inside one
    range, and the totals of the ranges, one row each, give every range its offset.
    """
    n = parallelism(df.sparkSession)
    placed = df.repartitionByRange(n, F.expr(order).asc_nulls_first(), F.expr(tie).asc_nulls_first()).withColumn("_p", F.spark_partition_id())
    return run(
        f"""
WITH t AS (SELECT _p, sum({value}) AS _bw FROM {{d}} GROUP BY _p),
  o AS (SELECT _p, sum(_bw) {_over([], '_p')} - _bw AS _before, sum(_bw) {_over([])} AS _total FROM t)
SELECT /*+ BROADCAST(o) */ * EXCEPT (_p, _before, _total), cum / _total AS cum_share FROM
  (SELECT *, sum({value}) OVER (PARTITION BY _p ORDER BY {order}, {tie} ROWS UNBOUNDED PRECEDING) + _before AS cum
   FROM {{d}} JOIN o USING (_p))""",
        d=materialise(placed, "ranges"),
    )


def bucketed_rank(df: DataFrame, by: Sequence[str], order: str, tie: str, bucket: str, out: str = "rank") -> DataFrame:
    """Adds the 1-based rank of each row in its group by (order, tie), and ``group_size``.

    ``bucket`` (SQL) must be monotone in ``order``; rows are ranked inside (group, bucket) and shifted
    by the counts of the lower buckets, so a hot group spreads over as many tasks as it has buckets.
    """
    by = list(by)
    kb = names([*by, "_b"], trailing=False)
    return run(
        f"""
WITH b AS (SELECT *, {bucket} AS _b FROM {{df}}),
  t AS (SELECT {kb}, count(*) AS _bn FROM b GROUP BY {kb}),
  o AS (SELECT {kb}, sum(_bn) {_over(by, '_b')} - _bn AS _before, sum(_bn) {_over(by)} AS group_size FROM t)
SELECT * EXCEPT (_b, _before), row_number() OVER (PARTITION BY {kb} ORDER BY {order}, {tie}) + _before AS `{out}`
FROM b JOIN o USING ({kb})""",
        df=df,
    )
