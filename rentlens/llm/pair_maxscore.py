"""Ranked lexical search by MaxScore whose bounds come from term pairs.

One pass over the texts turns runs of documents into blocks of postings (position in the block, term frequency) and
counts what the weights need. The blocks become an impact index: per term its highest impact in the block, and, for
terms that stand next to each other in an item's weight order, the intersection of their lists with its highest joint
impact. A search goes through the blocks with the scores of the best ``k`` so far as limit. For an item's terms in
ascending weight, the bound of the first i + 1 terms is the lower of (bound of i terms + the term's maximum) and (bound
of i - 1 terms + the joint maximum of the last two). Blocks whose bound is below the limit are skipped; elsewhere
documents come from the lists beyond the longest prefix below the limit only, and where even the first of those terms
needs its neighbour, from their intersection alone. A few blocks searched first give every task its first limit: it is
the score of ``k`` documents, so nothing that belongs to the result is lost.

Items go through in rounds of about ``ROUND_TERMS`` terms; tasks receive the terms, never documents. Each task returns
at most ``k`` rows an item, which two ranks (by a part of the item, then by item) reduce.

Defined cases: a null or empty text has no terms and is not counted; a term is a maximal run of ASCII letters, ASCII
digits and code points from U+0080, with A-Z lower-cased; rows of one ``item_id``, null too, are one item with all
their terms; rows repeated with one ``doc_id`` are documents of their own; a null id counts as the largest; items
without a scored document give no row; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rentlens.llm.common import empty_if_null, give_back, materialise

ROUND_TERMS = 1 << 16
BLOCK_DOCS = 1 << 12
BLOCK_POSTINGS = 1 << 19
SEED_BLOCKS = 32
PARTS = 64
#: Lower-cased letters, digits and bytes of code points from U+0080; all else as a space.
FOLD = bytes(b if b >= 0x80 or chr(b).isalnum() else 32 for b in bytes(range(256)).lower())
LAST_ID = np.iinfo(np.int64).max

POSTINGS = "docs array<bigint>, sizes binary, terms array<int>, df array<int>, pos binary, tf binary, n_docs bigint, n_terms bigint"
INDEX = "docs array<bigint>, terms binary, df binary, pos binary, share binary, top binary, pairs binary, pair_df binary, pair_pos binary, pair_top binary"


def terms_of(raw: bytes) -> list[bytes]:
    return raw.translate(FOLD).split()


@dataclass
class Round:
    """Items of one round: ``ids``; ``terms`` of each as numbers of ``vocabulary``."""

    ids: list
    terms: list[list[int]]
    vocabulary: dict[bytes, int]


def rounds(items: DataFrame, limit: int) -> Iterator[Round]:
    """The items (``item_id``, ``terms``) in runs of about ``limit`` terms; the driver holds one run at a time."""
    ids, terms, vocabulary, total = [], [], {}, 0
    for row in items.toLocalIterator():
        ids.append(row["item_id"])
        terms.append([vocabulary.setdefault(bytes(t), len(vocabulary)) for t in sorted(row["terms"])])
        total += len(row["terms"])
        if total >= limit:
            yield Round(ids, terms, vocabulary)
            ids, terms, vocabulary, total = [], [], {}, 0
    if ids:
        yield Round(ids, terms, vocabulary)


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``item_id, terms``: distinct terms of every item that has any."""
    id_type = items.schema[id_col].dataType

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = [sorted(set(terms_of(t.as_py()))) for t in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(terms, pa.list_(pa.binary()))], names=["item_id", "terms"])

    rows = items.select(F.col(id_col).alias("item_id"), empty_if_null(text_col).cast("binary").alias("text"))
    found = rows.mapInArrow(split, T.StructType().add("item_id", id_type).add("terms", T.ArrayType(T.BinaryType())))
    pairs = found.select("item_id", F.explode("terms").alias("term")).distinct()
    return pairs.groupBy("item_id").agg(F.collect_list("term").alias("terms"))


def posting_blocks(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """Blocks of postings over the terms of ``vocabulary``. A block's lists stand one after another in order of ``terms``."""
    width = len(vocabulary)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int | None] = []
        sizes: list[int] = []
        cells: list[np.ndarray] = []  # position in the block · width + term
        counts: list[np.ndarray] = []
        held = n_docs = n_terms = 0

        def flush() -> pa.RecordBatch:
            nonlocal ids, sizes, cells, counts, held, n_docs, n_terms
            cell = np.concatenate([np.zeros(0, np.int64), *cells])
            tf = np.concatenate([np.zeros(0, np.int64), *counts])
            term, pos = cell % width, cell // width
            order = np.lexsort((pos, term))
            terms, df = np.unique(term, return_counts=True)
            row = [pa.array([ids], pa.list_(pa.int64())), pa.array([np.array(sizes, "<i8").tobytes()], pa.binary()),
                   pa.array([terms.tolist()], pa.list_(pa.int32())), pa.array([df.tolist()], pa.list_(pa.int32())),
                   pa.array([pos[order].astype("<u2").tobytes()], pa.binary()), pa.array([tf[order].astype("<u4").tobytes()], pa.binary()),
                   pa.array([n_docs], pa.int64()), pa.array([n_terms], pa.int64())]
            ids, sizes, cells, counts, held, n_docs, n_terms = [], [], [], [], 0, 0, 0
            return pa.record_batch(row, names=["docs", "sizes", "terms", "df", "pos", "tf", "n_docs", "n_terms"])

        find = vocabulary.get
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = terms_of(text.as_py())
                n_docs += len(words) > 0
                n_terms += len(words)
                found = [t for t in map(find, words) if t is not None]
                if found:
                    term, tf = np.unique(np.array(found, np.int64), return_counts=True)
                    cells.append(len(ids) * width + term)
                    counts.append(tf)
                    ids.append(doc_id)
                    sizes.append(len(words))
                    held += len(term)
                if len(ids) >= BLOCK_DOCS or held >= BLOCK_POSTINGS:
                    yield flush()
        if n_docs:
            yield flush()
        give_back()

    return docs.select(F.col(id_col).cast("bigint").alias("id"), empty_if_null(text_col).cast("binary").alias("text")).mapInArrow(blocks, POSTINGS)


@dataclass
class Statistics:
    """``n`` documents with ``length`` terms in all, and the weight of each term of the round."""

    n: int
    length: int
    weights: np.ndarray


def statistics(blocks: DataFrame, width: int) -> Statistics:
    n, length = blocks.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    n, length = n or 0, length or 0
    df = np.zeros(width, np.int64)
    pairs = blocks.select(F.explode(F.arrays_zip("terms", "df")).alias("t")).groupBy("t.terms").agg(F.sum("t.df").alias("df"))
    for row in pairs.collect():  # at most one row a term of the round
        df[row["terms"]] = row["df"]
    return Statistics(n, length, np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * int(x) + 1))) for x in df], np.int64))


def impact_index(blocks: DataFrame, stats: Statistics, pairs: list[tuple[int, int]]) -> DataFrame:
    """Adds the impacts, each term's maximum and the intersection lists of ``pairs`` with their joint maxima."""
    by_second: dict[int, list[tuple[int, int]]] = {}
    for number, (a, b) in enumerate(pairs):
        by_second.setdefault(b, []).append((a, number))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block = batch.slice(i, 1)
                ids = block.column(0)
                sizes = np.frombuffer(block.column(1)[0].as_py(), "<i8")
                terms, df = np.array(block.column(2)[0].as_py(), np.int64), np.array(block.column(3)[0].as_py(), np.int64)
                pos, tf = np.frombuffer(block.column(4)[0].as_py(), "<u2"), np.frombuffer(block.column(5)[0].as_py(), "<u4").astype(np.int64)
                m = np.array([50 + 50 * n * stats.n // stats.length for n in sizes.tolist()], np.int64)
                share = 1_000_000_000 * tf // (1000 * tf + 20 * m[pos])
                impact = share * np.repeat(stats.weights[terms], df)
                ends = np.cumsum(df)
                top = np.maximum.reduceat(impact, ends - df) if len(df) else np.zeros(0, np.int64)
                at = dict(zip(terms.tolist(), zip((ends - df).tolist(), ends.tolist())))
                dense = np.empty(len(sizes), np.int64)
                numbers, lists, tops = [], [], []
                for b, firsts in by_second.items():
                    if b not in at:
                        continue
                    dense.fill(-1)
                    dense[pos[slice(*at[b])]] = impact[slice(*at[b])]
                    for a, number in firsts:
                        if a not in at:
                            continue
                        p = pos[slice(*at[a])]
                        other = dense[p]
                        both = other >= 0
                        if both.any():
                            numbers.append(number)
                            lists.append(p[both])
                            tops.append(int((impact[slice(*at[a])][both] + other[both]).max()))
                joined = np.concatenate([np.zeros(0, "<u2"), *lists])
                raw = [terms.astype("<i4"), df.astype("<i4"), pos, share.astype("<u4"), top.astype("<i8"), np.array(numbers, "<i4"), np.array([len(x) for x in lists], "<i4"), joined.astype("<u2"), np.array(tops, "<i8")]
                yield pa.record_batch([ids, *[pa.array([x.tobytes()], pa.binary()) for x in raw]], names=[c.split(" ")[0] for c in INDEX.split(", ")])
        give_back()

    return blocks.mapInArrow(build, INDEX)


class Block:
    """One row of the impact index."""

    def __init__(self, row: pa.RecordBatch, weights: np.ndarray):
        raw = [row.column(i)[0].as_py() for i in range(1, 10)]
        terms, df = np.frombuffer(raw[0], "<i4"), np.frombuffer(raw[1], "<i4").astype(np.int64)
        self.ids = np.array([LAST_ID if x is None else x for x in row.column(0)[0].as_py()], np.int64)
        self.pos = np.frombuffer(raw[2], "<u2")
        self.impact = np.frombuffer(raw[3], "<u4") * np.repeat(weights[terms], df)
        ends = np.cumsum(df)
        self.lists = dict(zip(terms.tolist(), zip((ends - df).tolist(), ends.tolist())))
        self.top = dict(zip(terms.tolist(), np.frombuffer(raw[4], "<i8").tolist()))
        numbers, pair_df = np.frombuffer(raw[5], "<i4").tolist(), np.frombuffer(raw[6], "<i4").astype(np.int64)
        self.pair_pos = np.frombuffer(raw[7], "<u2")
        ends = np.cumsum(pair_df)
        self.pair_lists = dict(zip(numbers, zip((ends - pair_df).tolist(), ends.tolist())))
        self.pair_top = dict(zip(numbers, np.frombuffer(raw[8], "<i8").tolist()))

    def bounds(self, terms: Sequence[int], pairs: Sequence[int]) -> list[int]:
        """Bound of the first 0, 1, … terms; ``pairs[i]`` is the number of the pair of terms i and i + 1."""
        bound, last = [0], 0
        for i, t in enumerate(terms):
            own = self.top.get(t, 0)
            alone = bound[i] + own
            if i and own:
                alone = min(alone, bound[i - 1] + max(own, last, self.pair_top.get(pairs[i - 1], 0)))
            bound.append(alone)
            last = own
        return bound

    def search(self, terms: Sequence[int], pairs: Sequence[int], limit: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and scores of the documents that score at least ``limit`` (1 or more)."""
        bound = self.bounds(terms, pairs)
        if bound[-1] < limit:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        first = max(i for i, b in enumerate(bound) if b < limit)  # terms before it cannot reach the limit together
        score = np.zeros(len(self.ids), np.int64)

        def add(t: int) -> None:
            if t in self.lists:
                a, b = self.lists[t]
                score[self.pos[a:b]] += self.impact[a:b]

        for t in terms[first + 1 :]:
            add(t)
        some = score > 0
        add(terms[first])
        if first and bound[first - 1] + self.top.get(terms[first], 0) < limit:
            # without the term before it, the first list's documents stay below the limit
            a, b = self.pair_lists.get(pairs[first - 1], (0, 0))
            some[self.pair_pos[a:b]] = True
        else:
            some |= score > 0
        found = np.flatnonzero(some)
        for i in range(first - 1, -1, -1):
            found = found[score[found] + bound[i + 1] >= limit]
            if not len(found):
                return found, found
            if terms[i] not in self.lists:
                continue
            a, b = self.lists[terms[i]]
            if len(found) * 8 < b - a:
                p = self.pos[a:b]
                at = np.minimum(np.searchsorted(p, found), len(p) - 1)
                hit = p[at] == found
                score[found[hit]] += self.impact[a:b][at[hit]]
            else:
                score[self.pos[a:b]] += self.impact[a:b]
        found = found[score[found] >= limit]
        return found, score[found]


def search_blocks(index: DataFrame, terms: list[list[int]], pairs: list[list[int]], weights: np.ndarray, limits: list[int], k: int) -> DataFrame:
    """``item`` (its number), ``doc_id``, ``score``: at most ``k`` an item and task, among them all of the result."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in terms]
        limit = list(limits)
        for batch in batches:
            for i in range(batch.num_rows):
                block = Block(batch.slice(i, 1), weights)
                for q, (t, p) in enumerate(zip(terms, pairs)):
                    at, score = block.search(t, p, limit[q])
                    if not len(at):
                        continue
                    ids, score = np.concatenate([best[q][0], block.ids[at]]), np.concatenate([best[q][1], score])
                    order = np.lexsort((ids, -score))[:k]
                    best[q] = ids[order], score[order]
                    if len(order) == k:
                        limit[q] = max(limit[q], int(score[order[-1]]))
        number = np.repeat(np.arange(len(best)), [len(ids) for ids, _ in best])
        ids = np.concatenate([np.zeros(0, np.int64), *[ids for ids, _ in best]])
        score = np.concatenate([np.zeros(0, np.int64), *[s for _, s in best]])
        give_back()
        yield pa.record_batch([pa.array(number, pa.int32()), pa.array(ids, pa.int64(), mask=ids == LAST_ID), pa.array(score, pa.int64())], names=["item", "doc_id", "score"])

    return index.mapInArrow(search, "item int, doc_id bigint, score bigint")


def best_of(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` highest scores of each ``item`` with ``rank``; first among the rows of one of ``PARTS`` parts of an item."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    part = F.pmod(F.xxhash64("doc_id", "score"), F.lit(PARTS))
    ranked = found.withColumn("_part", part).withColumn("_rank", F.row_number().over(Window.partitionBy("item", "_part").orderBy(*order))).filter(F.col("_rank") <= k)
    return ranked.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= k).drop("_part", "_rank")


def neighbours(terms: list[list[int]], weights: np.ndarray) -> tuple[list[list[int]], list[tuple[int, int]], list[list[int]]]:
    """Each item's terms in ascending weight, the distinct pairs of neighbours, and each item's pairs as their numbers."""
    ordered = [sorted(t, key=lambda x: (weights[x], x)) for t in terms]
    number: dict[tuple[int, int], int] = {}
    pairs = [[number.setdefault((a, b), len(number)) for a, b in zip(t, t[1:])] for t in ordered]
    return ordered, list(number), pairs


def search_documents(
    docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", round_terms: int = ROUND_TERMS,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of each item, equal scores by ascending id."""
    spark = docs.sparkSession
    schema = T.StructType().add("item_id", items.schema[item_col].dataType).add("rank", T.IntegerType()).add("doc_id", T.LongType()).add("score", T.LongType())
    results: list[DataFrame] = []
    for r in rounds(materialise(item_terms(items, item_col, item_text_col), "item-terms"), round_terms):
        blocks = materialise(posting_blocks(docs, r.vocabulary, id_col, text_col), "postings")
        stats = statistics(blocks, len(r.vocabulary))
        ordered, pairs, numbers = neighbours(r.terms, stats.weights)
        index = materialise(impact_index(blocks, stats, pairs), "impacts")
        limits = first_limits(index, ordered, numbers, stats.weights, k)
        found = materialise(search_blocks(index, ordered, numbers, stats.weights, limits, k), "ranked")
        names = spark.createDataFrame(list(enumerate(r.ids)), T.StructType().add("item", T.IntegerType()).add("item_id", schema["item_id"].dataType))
        results.append(best_of(found, k).join(F.broadcast(names), "item").select(*schema.names))
    return union(results) if results else spark.createDataFrame([], schema)


def union(parts: Iterable[DataFrame]) -> DataFrame:
    first, *rest = parts
    for p in rest:
        first = first.unionByName(p)
    return first


def first_limits(index: DataFrame, terms: list[list[int]], pairs: list[list[int]], weights: np.ndarray, k: int) -> list[int]:
    """Score that ``k`` documents of the ``SEED_BLOCKS`` first blocks reach, by item; 1 where there are fewer."""
    limits = [1] * len(terms)
    found = best_of(search_blocks(index.limit(SEED_BLOCKS), terms, pairs, weights, limits, k), k)
    for row in found.filter(F.col("rank") == k).collect():  # at most one row an item of the round
        limits[row["item"]] = row["score"]
    return limits
