"""I-Match fingerprints: hashes of the sorted distinct terms inside an inverse-document-frequency band, per lexicon subset.

Terms are lower-cased runs of letters and digits. The lexicon holds the terms found in a share of ``band`` of all
documents; as a document's distinct terms number A on average, it has at most A / band[0] terms whatever the number of
documents, so it is broadcast. Every subset draws its terms by a hash, at rates from all to one in 512: the dense
subsets change with the first edit, the sparse ones tell how much of a long text is the same. A fingerprint is the list
of the subsets' hashes, empty where a subset holds no term of the text; the likeness of two is the share of equal
fields among those filled in either. Only DataFrame functions are used.

Texts are shuffled once, by document; the head of the following document comes to a text in the same partitioning, and
terms are grouped there again without a shuffle.

Defined cases: a null text counts as empty; the next document follows by id (null first), then by a hash of the text,
the first follows the last, a single document follows itself; rows repeated with one id and one text are one document
here and come back as often as they were; a text without a term of the lexicon has one field, the hash of all its
terms; equal fingerprints have likeness 1; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentlens.llm.common import empty_if_null, global_rank, materialise

BAND = (0.005, 0.1)
#: The power of two by which each subset is thinned.
RATES = [0, 2] + [4] * 3 + [5] * 5 + [6] * 6 + [7] * 6 + [8] * 6 + [9] * 4
KEY = ["_id", "_h"]


def terms(text: Column) -> Column:
    """Hashes of the distinct terms."""
    words = F.array_distinct(F.split(F.lower(text), r"[^\p{L}\p{N}]+"))
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def lexicon(texts: DataFrame, band: tuple[float, float] = BAND) -> DataFrame:
    """``term, mask``: the terms whose share of all documents lies in ``band``; bit k of the mask tells of subset k."""
    total = texts.count()
    counts = texts.select(F.explode(terms(F.col("text"))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    kept = counts.filter((F.col("df") >= band[0] * total) & (F.col("df") <= band[1] * total))
    mask = F.lit(0).cast("bigint")
    for k, power in enumerate(RATES):
        drawn = F.xxhash64(F.lit(k), "term").bitwiseAND((1 << power) - 1) == 0
        mask = mask.bitwiseOR(F.when(drawn, F.lit(1 << k).cast("bigint")).otherwise(F.lit(0).cast("bigint")))
    return materialise(kept.select("term", mask.alias("mask")), "lexicon")


def fingerprint(found: Column, all_terms: Column) -> Column:
    """``found``: sorted array of (term, mask), null or empty where the text has none in the lexicon."""

    def field(k: int) -> Column:
        mine = F.transform(F.filter(found, lambda t: t["mask"].bitwiseAND(F.lit(1 << k).cast("bigint")) != 0), lambda t: t["term"])
        return F.when(F.size(mine) > 0, short(F.xxhash64(mine))).otherwise("")

    def short(value: Column) -> Column:
        return F.lower(F.lpad(F.hex(value.bitwiseAND(0xFFFFFFFF)), 8, "0"))

    fields = F.concat_ws(":", F.lit(""), *[field(k) for k in range(len(RATES))])
    return F.when(F.coalesce(F.size(found), F.lit(0)) > 0, fields).otherwise(F.concat(short(F.xxhash64(F.array_sort(all_terms))), F.lit(":" * len(RATES))))


def likeness(a: str, b: str) -> Column:
    pairs = F.arrays_zip(F.split(a, ":").alias("a"), F.split(b, ":").alias("b"))
    same = F.size(F.filter(pairs, lambda p: (p["a"] != "") & (p["a"] == p["b"])))
    any_ = F.size(F.filter(pairs, lambda p: (p["a"] != "") | (p["b"] != "")))
    return F.when(F.col(a) == F.col(b), 1.0).otherwise(same / any_)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", band: tuple[float, float] = BAND) -> DataFrame:
    """One row per document: ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    The edited text has its last quarter replaced by the head of the next document.
    """
    own = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), empty_if_null(text_col).alias("text"))
    own = own.withColumns({"_id": F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), "_h": F.xxhash64("text")})
    ids = own.groupBy("doc_id", *KEY).agg(F.max(F.length("text")).cast("bigint").alias("n_chars"), F.count(F.lit(1)).alias("copies"))
    ids = materialise(global_rank(ids, [], [F.col("doc_id").asc_nulls_first(), F.col("_h").asc()], "at"), "document-ranks")
    total, most = ids.agg(F.count(F.lit(1)), F.max("copies")).first()
    texts = own.select(*KEY, "text")
    if (most or 0) > 1:
        texts = texts.dropDuplicates(KEY)
    before = ids.select(F.col("at").alias("_at"), F.col("_id").alias("to_id"), F.col("_h").alias("to_h"), F.floor(F.col("n_chars") / 4).cast("int").alias("need"))
    wanted = ids.join(before, F.when(F.col("at") == 1, F.lit(total)).otherwise(F.col("at") - 1) == F.col("_at")).select(*KEY, "to_id", "to_h", "need")
    wanted = materialise(wanted, "wanted-heads")
    heads = texts.join(wanted.hint("shuffle_hash"), KEY).select(F.col("to_id").alias("_id"), F.col("to_h").alias("_h"), F.substring("text", F.lit(1), F.col("need")).alias("head"), "need")
    # the text before the last quarter, then as much of the next one's head as there is
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - F.col("need")), F.col("head"))
    both = texts.join(heads.hint("shuffle_hash"), KEY).select(*KEY, "text", edited.alias("edited"))
    words = lexicon(own.select("text"), band)
    sides = both.select(*KEY, F.posexplode(F.array(terms(F.col("text")), terms(F.col("edited")))).alias("side", "terms"))
    inside = sides.select(*KEY, "side", F.explode("terms").alias("term")).join(F.broadcast(words), "term")
    item = F.struct("term", "mask")
    found = inside.groupBy(*KEY).agg(
        F.array_sort(F.collect_list(F.when(F.col("side") == 0, item))).alias("found"), F.array_sort(F.collect_list(F.when(F.col("side") == 1, item))).alias("edited_found")
    )
    made = both.join(found.hint("shuffle_hash"), KEY, "left").select(
        *KEY,
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint(F.col("found"), terms(F.col("text"))).alias("fingerprint"),
        fingerprint(F.col("edited_found"), terms(F.col("edited"))).alias("edited_fingerprint"),
    )
    made = materialise(made, "fingerprints")
    following = made.select(*KEY, F.col("fingerprint").alias("next_fingerprint")).join(wanted, KEY).select(F.col("to_id").alias("_id"), F.col("to_h").alias("_h"), "next_fingerprint")
    rows = made.join(following, KEY).join(ids.select("doc_id", *KEY, "n_chars", "copies"), KEY)
    rows = rows.withColumns({"near_edited": likeness("fingerprint", "edited_fingerprint"), "near_next": likeness("fingerprint", "next_fingerprint")})
    if (most or 0) > 1:
        rows = rows.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
    return rows.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
