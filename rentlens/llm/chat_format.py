"""Chat formatting by perspective rotation: each dialogue rendered once per participant, who then is the assistant.

A turn is ``<|assistant|>`` or ``<|user:NAME|>``, a line break, the text and ``<|end|>`` with a line break. The mask
marks the characters to learn from: text and end mark of the assistant's turns. Turns are ranked over range partitions,
so one very long dialogue does not meet in one task; a rendering is cut into parts of ``turns_per_part`` turns, each
with its own mask, which follow each other without loss. Only DataFrame functions are used.

Defined cases: a null text counts as empty; a null role is the participant ``unknown``; turns are ordered by turn (null
first), role and text, so repeated rows stay as they are; a null conversation id is a conversation of its own; one
participant alone is rendered as the assistant; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentlens.llm.common import empty_if_null, global_rank, materialise

ASSISTANT, USER, END = "<|assistant|>\n", "<|user:{}|>\n", "<|end|>\n"
TURNS_PER_PART = 256
UNKNOWN = "unknown"


def rotate_perspectives(turns: DataFrame, turns_per_part: int = TURNS_PER_PART) -> DataFrame:
    """``turns`` (conv_id, turn, role, text) -> ``conv_id, speaker, part, n_turns, text, mask, n_masked``.

    ``mask`` lists ``start-end`` (0-based characters of the part's text, end not included) separated by commas.
    """
    rows = turns.select("conv_id", F.col("turn"), F.coalesce("role", F.lit(UNKNOWN)).alias("role"), empty_if_null("text").alias("text"))
    order = [F.col(c).asc_nulls_first() for c in ("turn", "role", "text")]
    ranked = global_rank(rows, ["conv_id"], order, "_rank").withColumn("part", F.floor((F.col("_rank") - 1) / turns_per_part))
    ranked = materialise(ranked.select("conv_id", "part", "_rank", "role", "text"), "ranked-turns")
    # the turns of a part in order: at most turns_per_part structs
    parts = ranked.groupBy("conv_id", "part").agg(F.sort_array(F.collect_list(F.struct("_rank", "role", "text"))).alias("turns"))
    speakers = ranked.select("conv_id", F.col("role").alias("speaker")).distinct()
    pairs = parts.join(speakers.withColumnRenamed("conv_id", "_conv"), F.col("conv_id").eqNullSafe(F.col("_conv")))

    def own(t):
        return t["role"] == F.col("speaker")

    def head(t):
        return F.when(own(t), F.lit(ASSISTANT)).otherwise(F.concat(F.lit(USER.split("{}")[0]), t["role"], F.lit(USER.split("{}")[1])))

    def body(t):
        return F.concat(t["text"], F.lit(END))

    # running place: after each turn (where it starts, where it ends), by one fold over the part
    spans = F.aggregate(
        "turns",
        F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("spans"), F.lit(0).cast("bigint").alias("n")),
        lambda acc, t: F.struct(
            (acc["at"] + F.length(head(t)) + F.length(body(t))).cast("bigint").alias("at"),
            F.when(own(t), F.concat(acc["spans"], F.array(F.concat((acc["at"] + F.length(head(t))).cast("string"), F.lit("-"), (acc["at"] + F.length(head(t)) + F.length(body(t))).cast("string"))))).otherwise(acc["spans"]).alias("spans"),
            F.when(own(t), acc["n"] + F.length(body(t))).otherwise(acc["n"]).cast("bigint").alias("n"),
        ),
    )
    pairs = pairs.withColumns({"_spans": spans, "_text": F.concat_ws("", F.transform("turns", lambda t: F.concat(head(t), body(t))))})
    return pairs.select(
        "conv_id", "speaker", "part", F.size("turns").cast("bigint").alias("n_turns"), F.col("_text").alias("text"), F.concat_ws(",", "_spans.spans").alias("mask"), F.col("_spans.n").alias("n_masked")
    )
