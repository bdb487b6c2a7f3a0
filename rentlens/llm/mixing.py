"""Mixing sources to target weights by systematic sampling.

Each source takes part with a weight. Its target is its share of all words, stopped at ``max_repeat`` times its own
size, the excess going to the others by weight. Inside a source every document is expected ``target / source size``
times; with the documents ordered by (size, id) the expected copies are summed up, one random offset per source is
added, and a document is emitted once for every integer boundary that its step crosses. Neighbours have nearly the
same size, so the words taken come within about one document of the target.

Defined cases: a null text has size 0; a null source is a source of its own, last; a source without words has target 0
and is not taken; equal rows are told apart only by their order, so reruns agree; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rentlens.llm.common import SPACE, empty_if_null, global_rank, materialise

MAX_REPEAT = 3


def word_count(text: str) -> Column:
    """Number of maximal runs of characters other than ASCII white space."""
    words = F.trim(F.regexp_replace(empty_if_null(text), f"{SPACE}+", " "))
    return F.when(words == "", F.lit(0)).otherwise(F.length(words) - F.length(F.replace(words, F.lit(" "), F.lit(""))) + 1).cast("bigint")


def capped_targets(sources: DataFrame, weights: Sequence[float], max_repeat: int = MAX_REPEAT) -> DataFrame:
    """``sources`` (source, source_size, …) with ``target``; only two sums per round reach the driver.

    Sharing the excess by weight again and again ends with ``target = least(max_repeat · size, level · weight)``: the
    level is raised until no source outside the stopped ones lies above its stop.
    """
    array = F.array(*[F.lit(float(w)) for w in weights])
    ranked = global_rank(sources, [], [F.col("source").asc_nulls_last()], "_place")
    ranked = materialise(ranked.withColumn("_w", F.element_at(array, ((F.col("_place") - 1) % len(weights) + 1).cast("int"))), "sources")
    level = 0.0
    while True:
        stopped = F.col("source_size") * max_repeat < F.col("_w") * F.lit(level)
        row = ranked.agg(
            F.coalesce(F.sum("source_size"), F.lit(0)).alias("all"),
            F.coalesce(F.sum(F.when(stopped, F.col("source_size") * max_repeat)), F.lit(0)).alias("held"),
            F.coalesce(F.sum(F.when(~stopped, F.col("_w"))), F.lit(0.0)).alias("open"),
        ).first()
        new = (row["all"] - row["held"]) / row["open"] if row["open"] else level
        if new == level:
            break
        level = new
    target = F.least((F.col("source_size") * max_repeat).cast("double"), F.col("_w") * F.lit(level))
    return ranked.withColumn("target", target).drop("_place", "_w")


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), seed: str = "mix", max_repeat: int = MAX_REPEAT, text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, copies, taken`` (= copies · size).

    ``docs`` needs ``doc_id``, ``source`` and the text; nothing but sizes and ids is shuffled.
    """
    sized = docs.select("doc_id", "source", word_count(text_col).alias("size"))
    ranked = materialise(global_rank(sized, ["source"], [F.col("size").asc(), F.col("doc_id").asc_nulls_last()], "_rank"), "sized")
    sources = materialise(ranked.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs")), "source-sizes")
    targets = capped_targets(sources, weights, max_repeat)
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce("source", F.lit("")))), 1, 8), 16, 10).cast("double") / float(1 << 32)
    step = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    targets = targets.select(F.col("source").alias("_source"), "source_size", "target", step.alias("_step"), offset.alias("_u"))
    both = ranked.join(targets, ranked["source"].eqNullSafe(targets["_source"]))
    crossed = F.floor(F.col("_rank") * F.col("_step") + F.col("_u")) - F.floor((F.col("_rank") - 1) * F.col("_step") + F.col("_u"))
    return both.withColumn("copies", F.least(crossed, F.lit(max_repeat))).select(
        "doc_id", "source", "size", "source_size", "target", F.col("copies").cast("bigint").alias("copies"), (F.col("copies") * F.col("size")).alias("taken")
    )


def repeat(docs: DataFrame, mixed: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with each row as often as ``mixed`` (the result of ``mix`` on them) says. The texts meet it in one join.

    Rows of one id, source and size are numbered on both sides, where there are any.
    """
    keys = ["__mix_doc", "__mix_source", "__mix_size"]
    taken = materialise(mixed.select(F.col("doc_id").alias("__mix_doc"), F.col("source").alias("__mix_source"), F.col("size").alias("__mix_size"), F.col("copies").alias("__mix_copies")), "copies")
    rows = docs.withColumns({"__mix_d": F.col("doc_id"), "__mix_s": F.col("source"), "__mix_n": word_count(text_col), "__mix_k": F.lit(1)})
    taken = taken.withColumn("__mix_no", F.lit(1))
    if not taken.groupBy(*keys).count().filter("count > 1").isEmpty():
        rows = rows.withColumn("__mix_k", F.row_number().over(Window.partitionBy("__mix_d", "__mix_s", "__mix_n").orderBy(F.xxhash64(text_col))))
        taken = taken.withColumn("__mix_no", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("__mix_copies"))))
    same = F.col("__mix_d").eqNullSafe(F.col("__mix_doc")) & F.col("__mix_s").eqNullSafe(F.col("__mix_source")) & (F.col("__mix_n") == F.col("__mix_size")) & (F.col("__mix_k") == F.col("__mix_no"))
    joined = rows.join(taken.filter("__mix_copies > 0").hint("shuffle_hash"), same)
    return joined.withColumn("__mix_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("__mix_copies")))).select(*docs.columns)
