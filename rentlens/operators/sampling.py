"""Deterministic splits, folds and quota samples by hash order.

Rows are ordered by the md5 of (id, seed). A split needs only the hash at which each part of a stratum ends: these few
numbers are exact order statistics, and the rows are then told apart without a shuffle. Where ranks are wanted they are
taken inside (stratum, first hash digits) and shifted by bucket counts, so strata of any size spread over many tasks.
Sizes are exact either way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentlens.operators.binning import bin_expr, quantile_bin
from rentlens.operators.quantiles import bucketed_rank, edge_values, ranked_values
from rentlens.session import materialise

#: Hash digits of a range: 65,536 ranges of about equal size, whatever the table's; the ranks do not depend on it.
HASH_DIGITS = 4


def with_hash_rank(df: DataFrame, by: Sequence[str], id_col: str, seed: int, out: str = "rank") -> DataFrame:
    """Adds ``rank`` (1-based, in hash order within the group) and ``group_size``."""
    hashed = df.withColumn("_h", F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}"))))
    return bucketed_rank(hashed, by, "_h", id_col, f"substr(_h, 1, {HASH_DIGITS})", out).drop("_h")


#: Hash digits that are exact as a double.
NUMBER_DIGITS = 13
Cuts = dict[int, list[str]]


def hash_head(id_col: str, seed: int) -> str:
    """SQL: the first digits of the hash that orders the rows."""
    return f"substr(md5(concat(cast(`{id_col}` AS string), ':{seed}')), 1, {NUMBER_DIGITS})"


def hash_cuts(numbers: DataFrame, by: str, parts: Sequence[str]) -> Cuts | None:
    """Per group (few, by construction) the hash head at which each part ends; None where rows on both sides of an end have the same.

    ``numbers`` has the group and the hash heads as numbers ``x``. A part is SQL over the group's size ``n``: the rows in it and in those before it.
    """
    ranks = [r for upto in parts for r in (f"{upto} - 1", upto)]
    cuts = {}
    for r in ranked_values(numbers, "x", ranks, [by], few_groups=True).collect():
        ends = [(r[f"s{2 * i}"], r[f"s{2 * i + 1}"]) for i in range(len(parts))]
        if any(last is not None and last == after for last, after in ends):
            return None
        cuts[r[by]] = ["" if last is None else f"{int(last):0{NUMBER_DIGITS}x}" for last, _ in ends]
    return cuts


def part_number(head: str, by: str, cuts: Cuts, parts: int) -> str:
    """SQL: 1 for the first part of the row's group up to ``parts`` + 1 for the rest. ``head`` stands once in it for each part, always evaluated."""
    ends = [" ".join(f"WHEN {g} THEN '{c[i]}'" for g, c in cuts.items()) or "WHEN 0 THEN ''" for i in range(parts)]
    return "1 + " + " + ".join(f"cast({head} > CASE {by} {e} END AS int)" for e in ends)


def numbered(df: DataFrame, keep: Sequence[str], id_col: str, seed: int) -> DataFrame:
    """``keep`` and the hash head as the number ``x``, written once: narrow, for the passes that look for the ends."""
    known = df.filter(F.col(id_col).isNotNull())
    return materialise(known.select(*keep, F.conv(F.expr(hash_head(id_col, seed)), 16, 10).cast("double").alias("x")), "hashes")


def stratified_split(
    df: DataFrame, id_col: str, target: str, test: float = 0.15, val: float = 0.15, strata: int = 5, seed: int = 42
) -> DataFrame:
    """Adds ``split``: the first ``test`` share of each target stratum, then ``val/(1-test)`` of the rest, then train."""
    binned = quantile_bin(df, target, strata, "estrato").filter(F.col(target).isNotNull() & F.col(id_col).isNotNull())
    n_test = f"bround(n * {float(test)!r}D, 0)"
    parts = [n_test, f"{n_test} + bround((n - {n_test}) * {float(val / (1 - test))!r}D, 0)"]
    cuts = hash_cuts(numbered(binned, ["estrato"], id_col, seed), "estrato", parts)
    if cuts is None:
        ranked = with_hash_rank(binned, ["estrato"], id_col, seed).withColumnRenamed("group_size", "n")
        number = f"CASE WHEN rank <= {parts[0]} THEN 1 WHEN rank <= {parts[1]} THEN 2 ELSE 3 END"
    else:
        ranked, number = binned, part_number(hash_head(id_col, seed), "estrato", cuts, 2)
    split = ranked.withColumn("split", F.expr(f"element_at(array('test', 'val', 'train'), {number})"))
    return split.select("estrato", *df.columns, "split")


def holdout_split_production(
    df: DataFrame, id_col: str, target: str, test: float = 0.15, early: float = 0.10, strata: int = 5, seed: int = 42
) -> DataFrame:
    """Adds ``split``: test by target stratum; the remainder is re-stratified and a share of it set aside for early stopping."""
    first = edge_values(df, target, strata)
    known = df.filter(F.col(target).isNotNull() & F.col(id_col).isNotNull()).withColumn("_a", bin_expr(f"`{target}`", first))
    parts, early_part = [f"bround(n * {float(test)!r}D, 0)"], [f"bround(n * {float(early)!r}D, 0)"]
    numbers = numbered(known, [target, "_a"], id_col, seed)
    cuts, later = hash_cuts(numbers, "_a", parts), None
    if cuts is not None:
        head = f"lpad(lower(hex(cast(x AS bigint))), {NUMBER_DIGITS}, '0')"
        rest = numbers.filter(f"{part_number(head, '_a', cuts, 1)} = 2").drop("_a")
        second = edge_values(rest, target, strata)
        later = hash_cuts(rest.withColumn("_b", bin_expr(f"`{target}`", second)), "_b", early_part)
    if later is not None:
        head = hash_head(id_col, seed)
        number = f"{part_number(head, '_a', cuts, 1)} + 10 * ({part_number(head, '_b', later, 1)})"
        split = F.expr(f"element_at(map(11, 'test', 21, 'test', 12, 'earlystop', 22, 'fit'), {number})")
        return known.withColumn("_b", bin_expr(f"`{target}`", second)).withColumn("split", split).select(*df.columns, "split")
    split = stratified_split(df, id_col, target, test, 0.0, strata, seed).drop("estrato")
    rest = split.filter(F.col("split") == "train").drop("split")
    ranked = with_hash_rank(quantile_bin(rest, target, strata, "estrato"), ["estrato"], id_col, seed)
    named = F.when(F.col("rank") <= F.bround(F.col("group_size") * early, 0), "earlystop").otherwise("fit")
    done = ranked.withColumn("split", named).select(*df.columns, "split")
    return done.unionByName(split.filter(F.col("split") == "test"))


def random_holdout(df: DataFrame, id_col: str, target: str, val: float = 0.2, seed: int = 42) -> DataFrame:
    """Adds ``split`` train/val over the rows with a target, of exact sizes."""
    ranked = with_hash_rank(df.dropna(subset=[target]), [], id_col, seed)
    return ranked.withColumn("split", F.when(F.col("rank") <= F.ceil(F.col("group_size") * val), "val").otherwise("train")).drop("rank", "group_size")


def kfold_assign(df: DataFrame, id_col: str, k: int, seed: int) -> DataFrame:
    """Adds ``fold`` 0…k-1 from the hash of (id, seed): no shuffle at all."""
    digits = F.substring(F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}"))), 1, 8)
    return df.withColumn("fold", (F.conv(digits, 16, 10).cast("long") % k).cast("int"))


def stratified_quota_sample(df: DataFrame, by: Sequence[str], id_col: str, n: int, seed: int = 42) -> DataFrame:
    """About ``n`` rows spread over the groups by size (at least one each), then the first ``n`` in hash order."""
    total = df.agg(F.count(F.lit(1))).scalar()
    ranked = with_hash_rank(df, by, id_col, seed).withColumn("_total", total)
    quota = F.least(F.greatest(F.bround(n * F.col("group_size") / F.col("_total"), 0), F.lit(1)), F.col("group_size"))
    chosen = ranked.filter(F.col("rank") <= quota).drop("rank", "group_size", "_total")
    order = F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}")))
    return chosen.orderBy(order, id_col).limit(n)
