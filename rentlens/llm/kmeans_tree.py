"""Approximate nearest neighbours by a hierarchical k-means tree, read best bin first.

The tree is fitted on a bounded sample of the distinct unit vectors (``SAMPLE_ROWS`` rows and ``SAMPLE_BYTES`` at most,
drawn by hash); every vector is then put into a leaf by descent. A query descends to its nearest leaf and keeps the
branches it passed in a priority queue by distance to their centres; the nearest waiting branch is opened next. How
many leaves are read is calibrated: for ``CALIBRATION`` queries the true neighbours are found by comparison with all
vectors, and the number of leaves is widened until ``recall`` of them lie in the leaves read. The leaves are read in
rounds, each ``WIDEN`` times as wide as the one before, and a round returns only what reaches the last score that a
query has kept so far: about ``k`` rows a query and round, however many leaves it reads. Leaves and queries meet
in a join on (leaf, part of the leaf, part of its queries) of about ``CHUNK`` rows on each side, so neither a large leaf
nor one that many queries read is one task's work. Scores are cosines in double precision on the original vectors.

Equal vectors are one row with their ``k`` + 1 smallest ids, which are all that any result can hold of them; equal
query vectors are searched once.

Defined cases: a vector that is null, empty, zero or holds a null or non-finite component takes no part, and of vectors
of several lengths only those of the most frequent one (of equals the longest) do; of rows with one id the vector that
is smallest as bytes counts; rows without an id are candidates, last among equals, and never queries; extra columns are
not read; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rentlens.llm.common import attach, give_back, materialise

BRANCHES = 8
LEAF_ROWS = 256
LEAF_SAMPLE = 32
SAMPLE_ROWS = 1 << 17
SAMPLE_BYTES = 64 << 20
CALIBRATION = 256
RECALL = 0.95
WIDEN = 8
CHUNK = 2048
#: Vectors within this of the last score kept are compared again with one fixed order of summation.
SLACK = 1e-9


def rows_of(column: pa.Array, kind: str) -> np.ndarray:
    """A binary column of equally long vectors as a matrix of doubles."""
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, kind).reshape(len(column), -1).astype(np.float64) if len(column) else np.zeros((0, 1))


def unit(x: np.ndarray) -> np.ndarray:
    top = np.abs(x).max(axis=1, keepdims=True)
    x = x / top  # so that no square overflows or vanishes
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, summed in an order that depends on the length only."""
    return np.einsum("ij,ij->i", unit(a), unit(b))


# ---- tree --------------------------------------------------------------------------------------
@dataclass
class Tree:
    """``centers`` of all nodes, root first; children of node i are ``first[i] … first[i] + count[i] - 1``; ``leaf`` its number or -1."""

    centers: np.ndarray
    first: np.ndarray
    count: np.ndarray
    leaf: np.ndarray

    def __post_init__(self) -> None:
        self.half = np.einsum("ij,ij->i", self.centers, self.centers) / 2

    @property
    def leaves(self) -> int:
        return int((self.leaf >= 0).sum())

    def assign(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each unit row: at every node the nearest child."""
        at = np.zeros(len(x), np.int64)
        while len(open_ := np.flatnonzero(self.count[at])):
            for node in np.unique(at[open_]).tolist():
                rows = open_[at[open_] == node]
                kids = slice(self.first[node], self.first[node] + self.count[node])
                at[rows] = self.first[node] + (x[rows] @ self.centers[kids].T - self.half[kids]).argmax(axis=1)
        return self.leaf[at]

    def order(self, q: np.ndarray, limit: int) -> list[int]:
        """The first ``limit`` leaves of a unit query, best bin first."""
        out, waiting = [], [(0.0, 0)]
        while waiting and len(out) < limit:
            node = heapq.heappop(waiting)[1]
            while self.count[node]:
                a = int(self.first[node])
                far = (self.half[a : a + self.count[node]] - self.centers[a : a + self.count[node]] @ q).tolist()
                best = min(range(len(far)), key=far.__getitem__)
                for i, f in enumerate(far):
                    if i != best:
                        heapq.heappush(waiting, (f, a + i))
                node = a + best
            out.append(int(self.leaf[node]))
        return out


def k_means(x: np.ndarray, k: int, rng: np.random.Generator, steps: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """(centers, owner of each row); no center is empty. The first centers are far from each other."""
    picks = [int(rng.integers(len(x)))]
    far = 2 - 2 * (x @ x[picks[0]])
    while len(picks) < k and far.max() > 1e-9:
        picks.append(int(rng.choice(len(x), p=np.maximum(far, 0) / np.maximum(far, 0).sum())))
        far = np.minimum(far, 2 - 2 * (x @ x[picks[-1]]))
    centers = x[picks]
    for _ in range(steps):
        own = (x @ centers.T - np.einsum("ij,ij->i", centers, centers) / 2).argmax(axis=1)
        used = np.unique(own)
        centers = np.stack([x[own == j].mean(axis=0) for j in used])
    return centers, (x @ centers.T - np.einsum("ij,ij->i", centers, centers) / 2).argmax(axis=1)


def fit_tree(x: np.ndarray, leaf_rows: int = LEAF_SAMPLE, branches: int = BRANCHES, seed: int = 1) -> Tree:
    """Unit rows split level by level until a node has at most ``leaf_rows`` of them or cannot be split."""
    rng = np.random.default_rng(seed)
    centers, first, count, leaf = [x.mean(axis=0)], [0], [0], [-1]
    level, leaves = [(0, np.arange(len(x)))], 0
    while level:
        below = []
        for node, rows in level:
            parts = []
            if len(rows) > leaf_rows:
                found, own = k_means(x[rows], min(branches, -(-len(rows) // leaf_rows) + 1), rng)
                parts = [(c, rows[own == j]) for j, c in enumerate(found) if (own == j).any()]
            if len(parts) < 2:
                leaf[node] = leaves
                leaves += 1
                continue
            first[node], count[node] = len(centers), len(parts)
            for c, r in parts:
                below.append((len(centers), r))
                centers.append(c)
                first.append(0)
                count.append(0)
                leaf.append(-1)
        level = below
    return Tree(np.array(centers), np.array(first), np.array(count), np.array(leaf))


# ---- tables ------------------------------------------------------------------------------------
def clean_vectors(df: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, str]:
    """``id, raw`` of the rows that take part, and the type of a component: the column's own, float or double."""
    kind = "<f4" if df.schema[vector_col].dataType.elementType.typeName() == "float" else "<f8"
    component = "float" if kind == "<f4" else "double"
    size = F.size(F.col("vector"))
    # a null compares as null, and NaN is larger than any number
    fine = F.forall("vector", lambda v: F.coalesce(F.abs(v) < F.lit(float("inf")).cast(component), F.lit(False)))
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast(f"array<{component}>").alias("vector"))
    rows = rows.filter(F.col("vector").isNotNull() & (size > 0)).filter(fine & F.exists("vector", lambda v: v != 0))
    top = rows.groupBy(size.alias("n")).count().agg(F.max_by("n", F.struct("count", "n"))).first()[0]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = np.ascontiguousarray(batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(kind)).tobytes()
            step = len(flat) // max(batch.num_rows, 1)
            yield pa.record_batch([batch.column(0), pa.array([flat[i * step : (i + 1) * step] for i in range(batch.num_rows)], pa.binary())], names=["id", "raw"])

    packed = rows.filter(size == (top or 0)).mapInArrow(pack, "id bigint, raw binary")
    own = packed.filter("id IS NOT NULL").groupBy("id").agg(F.min("raw").alias("raw"))
    return materialise(own.unionByName(packed.filter("id IS NULL")).withColumn("key", F.unhex(F.sha2("raw", 256))), "vectors"), kind


def distinct_vectors(rows: DataFrame, keep: int) -> DataFrame:
    """``key, raw, ids``: each vector once with its ``keep`` smallest ids; the limit is applied before the shuffle too."""
    place = F.row_number().over(Window.partitionBy("key").orderBy(F.col("id").asc_nulls_last()))
    few = rows.withColumn("_place", place).filter(F.col("_place") <= keep)
    return materialise(few.groupBy("key").agg(F.first("raw").alias("raw"), F.collect_list(F.struct("_place", "id")).alias("ids")).withColumn("ids", F.transform(F.array_sort("ids"), lambda s: s["id"])), "distinct-vectors")


def sampled_tree(vectors: DataFrame, total: int, kind: str) -> Tree | None:
    """Fitted in one task on the sample; the driver gets the centres."""
    width = vectors.agg(F.max(F.octet_length("raw"))).first()[0]
    if not width:
        return None
    leaves = max(1, -(-total // LEAF_ROWS))
    rows = min(total, leaves * LEAF_SAMPLE, SAMPLE_ROWS, SAMPLE_BYTES // width)
    drawn = vectors.filter(F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < int(-(-rows * (1 << 30) // total))).select("raw")

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [rows_of(b.column(0), kind) for b in batches if b.num_rows]
        if parts:
            x = unit(np.concatenate(parts))
            tree = fit_tree(x[np.lexsort(x.T[::-1])], leaf_rows=max(2, min(LEAF_SAMPLE, rows * LEAF_ROWS // total + 1)))
            yield pa.record_batch([pa.array([v.tobytes()], pa.binary()) for v in (tree.centers, tree.first, tree.count, tree.leaf)], names=["centers", "first", "count", "leaf"])

    found = drawn.coalesce(1).mapInArrow(fit, "centers binary, first binary, count binary, leaf binary").collect()
    if not found:  # nothing was drawn: one leaf holds all
        return Tree(np.zeros((1, width // int(kind[-1]))), np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1, np.int64))
    first, count, leaf = (np.frombuffer(found[0][c], np.int64) for c in ("first", "count", "leaf"))
    return Tree(np.frombuffer(found[0]["centers"], np.float64).reshape(len(first), -1), first, count, leaf)


def assigned(vectors: DataFrame, tree: Tree, kind: str) -> DataFrame:
    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            leaf = tree.assign(unit(rows_of(b.column(1), kind))) if b.num_rows else np.zeros(0, np.int64)
            yield pa.record_batch([*b.columns, pa.array(leaf, pa.int32())], names=["key", "raw", "ids", "leaf"])

    return materialise(vectors.select("key", "raw", "ids").mapInArrow(put, "key binary, raw binary, ids array<bigint>, leaf int"), "leaves")


# ---- search ------------------------------------------------------------------------------------
def nearest(queries: np.ndarray, rows: np.ndarray, k: int, least: np.ndarray | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per query the rows that can be among the ``k`` nearest, ties included, and their exact scores; only what reaches the query's score in ``least``."""
    out = []
    b = unit(rows)
    for start in range(0, len(queries), 256):
        a = unit(queries[start : start + 256])
        near = a @ b.T
        for i, (q, s) in enumerate(zip(a, near), start=start):
            last = np.partition(s, len(s) - k)[len(s) - k] if len(s) > k else -2.0
            last = last if least is None else max(last, least[i])
            at = np.flatnonzero(s >= last - SLACK)
            out.append((at, np.einsum("ij,ij->i", np.broadcast_to(q, (len(at), len(q))), b[at])))
    return out


def scored(keys: list, found: list[tuple[np.ndarray, np.ndarray]], ids: list[list], k: int) -> pa.RecordBatch:
    """``key, vec_id, score``: the ``k`` first of each query by score and id."""
    out_key, out_id, out_score = [], [], []
    for key, (at, score) in zip(keys, found):
        rows = [(-s, i is None, i or 0) for j, s in zip(at.tolist(), score.tolist()) for i in ids[j]]
        for s, none, i in heapq.nsmallest(k, rows):
            out_key.append(key)
            out_id.append(None if none else i)
            out_score.append(-s)
    return pa.record_batch([pa.array(out_key, pa.binary()), pa.array(out_id, pa.int64()), pa.array(out_score, pa.float64())], names=["key", "vec_id", "score"])


SCORED = "key binary, vec_id bigint, score double"


def first_of(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("key").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def brute_force(vectors: DataFrame, keys: list, queries: np.ndarray, kind: str, k: int) -> DataFrame:
    """``key, vec_id, score, place`` of the true neighbours of a bounded number of query vectors; every task compares its rows."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield scored(keys, nearest(queries, rows_of(b.column(0), kind), k), b.column(1).to_pylist(), k)

    return first_of(vectors.select("raw", "ids").mapInArrow(compare, SCORED), k)


def calibrate(leaves: DataFrame, wanted: DataFrame, tree: Tree, kind: str, k: int, recall: float, n: int = CALIBRATION) -> int:
    """The least number of leaves that hold ``recall`` of the true neighbours of ``n`` query vectors."""
    few = wanted.orderBy(F.xxhash64("key"), "key").limit(n).collect()
    if not few:
        return 1
    queries = np.stack([np.frombuffer(r["raw"], kind) for r in few]).astype(np.float64)
    true = brute_force(leaves, [bytes(r["key"]) for r in few], queries, kind, k)
    where = leaves.select("leaf", F.col("key").alias("_of"), F.explode("ids").alias("vec_id")).filter("vec_id IS NOT NULL")
    # a vector's own leaf is the first to be read, so equal vectors say nothing about the others
    found = true.join(where, "vec_id").filter("_of <> key").select("key", "leaf").collect()  # n · k rows
    place = {bytes(r["key"]): {leaf: i for i, leaf in enumerate(tree.order(q, tree.leaves))} for r, q in zip(few, unit(queries))}
    needed = sorted(place[bytes(r["key"])][r["leaf"]] + 1 for r in found)
    visits, caught = 1, 0
    while needed:
        while caught < len(needed) and needed[caught] <= visits:
            caught += 1
        if caught >= recall * len(needed):
            break
        visits += 1
    return visits


def routed(wanted: DataFrame, tree: Tree, kind: str, visits: int) -> DataFrame:
    """``key, raw, leaf, turn``: every query vector once for each leaf it reads, and the leaf's place in its order."""

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for start in range(0, b.num_rows, 100):
                part = b.slice(start, 100)
                orders = [tree.order(q, visits) for q in unit(rows_of(part.column(1), kind))]
                take = np.repeat(np.arange(len(orders)), [len(o) for o in orders])
                yield pa.record_batch([part.column(0).take(take), part.column(1).take(take), pa.array(np.concatenate(orders), pa.int32()), pa.array(np.concatenate([np.arange(len(o)) for o in orders]), pa.int32())], names=["key", "raw", "leaf", "turn"])

    return wanted.select("key", "raw").mapInArrow(route, "key binary, raw binary, leaf int, turn int")


def parts_of(df: DataFrame) -> dict[int, int]:
    """Number of parts of about ``CHUNK`` rows by leaf; at most one entry a leaf."""
    return {r["leaf"]: -(-r["count"] // CHUNK) for r in df.groupBy("leaf").count().collect()}


def looked_up(parts: dict[int, int]) -> Column:
    """The number of parts of the row's leaf; leaves with one part, the usual case, are not listed."""
    many = {k: v for k, v in parts.items() if v > 1}
    if not many:
        return F.lit(1)
    table = F.create_map(*[F.lit(x) for kv in sorted(many.items()) for x in kv])
    return F.coalesce(F.element_at(table, F.col("leaf")), F.lit(1))


def dealt(df: DataFrame, own: dict[int, int], other: dict[int, int], own_name: str, other_name: str) -> DataFrame:
    """Each row in one part of its own side, and once for every part of the other."""
    mine = F.pmod(F.xxhash64("key"), looked_up(own).cast("bigint")).cast("int")
    return df.withColumn(own_name, mine).withColumn(other_name, F.explode(F.sequence(F.lit(0), looked_up(other).cast("int") - 1)))


def search_leaves(leaves: DataFrame, asked: DataFrame, kind: str, k: int, visits: int) -> DataFrame:
    """``key, vec_id, score, place``: the ``k`` nearest of each query vector among the leaves it reads. ``asked`` is a written table."""
    found, start, width = None, 0, 1
    while start < visits:
        now = asked.filter(F.col("turn").between(start, min(start + width, visits) - 1)).drop("turn")
        if found is not None:
            kept = found.filter(F.col("place") == k).select("key", F.col("score").alias("least"))
            now = materialise(now.join(kept, "key", "left"), "asked")
        else:
            now = now.withColumn("least", F.lit(None).cast("double"))
        new = compared(leaves, now, kind, k)
        found = materialise(first_of(new if found is None else new.unionByName(found.drop("place")), k), "nearest")
        start, width = start + width, width * WIDEN
    return found


def compared(leaves: DataFrame, asked: DataFrame, kind: str, k: int) -> DataFrame:
    """``key, vec_id, score``: of each part of a leaf at most ``k`` rows for a query that reads it, none below the query's ``least`` score."""
    sizes, readers = parts_of(leaves), parts_of(asked)
    rows = dealt(leaves.select("leaf", "key", "raw", "ids"), sizes, readers, "part", "reader").groupBy("leaf", "part", "reader")
    ask = dealt(asked, readers, sizes, "reader", "part").groupBy("leaf", "part", "reader")

    def compare(data: pa.Table, queries: pa.Table) -> pa.Table:
        if not data.num_rows or not queries.num_rows:
            return pa.table({"key": pa.array([], pa.binary()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        least = np.array([-2.0 if x is None else x for x in queries["least"].to_pylist()])
        found = nearest(rows_of(queries["raw"].combine_chunks(), kind), rows_of(data["raw"].combine_chunks(), kind), k, least)
        return pa.Table.from_batches([scored(queries["key"].to_pylist(), found, data["ids"].to_pylist(), k)])

    return rows.cogroup(ask).applyInArrow(compare, SCORED)


def nearest_neighbours(df: DataFrame, k: int = 5, query_every: int = 50, id_col: str = "vec_id", vector_col: str = "embedding", recall: float = RECALL) -> DataFrame:
    """``query_id, rank, vec_id, score``: for every row whose id ``query_every`` divides the ``k`` nearest other rows found."""
    rows, kind = clean_vectors(df, id_col, vector_col)
    vectors = distinct_vectors(rows, k + 1)
    asking = materialise(rows.filter(F.col("id") % query_every == 0).select("id", "key"), "queries")
    total = vectors.count()
    tree = sampled_tree(vectors, total, kind) if total else None
    if tree is None:
        return df.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    leaves = assigned(vectors, tree, kind)
    sizes = asking.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    wanted = materialise(vectors.join(sizes, "key", "left_semi").select("key", "raw"), "query-vectors")
    visits = calibrate(leaves, wanted, tree, kind, k + 1, recall)
    asked = materialise(routed(wanted, tree, kind, visits), "routes")
    found = search_leaves(leaves, asked, kind, k + 1, visits).groupBy("key").agg(F.array_sort(F.collect_list(F.struct("place", "vec_id", "score"))).alias("near"))
    found = materialise(found.join(sizes, "key"), "found")
    near = F.slice(F.filter("near", lambda s: s["vec_id"].isNull() | (s["vec_id"] != F.col("id"))), 1, k)
    out = attach(asking, found, "key", "n").select(F.col("id").alias("query_id"), F.posexplode(near).alias("at", "hit"))
    return out.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), "hit.vec_id", "hit.score")


def recall_of(found: DataFrame, df: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", queries: int = 200) -> float:
    """Share of the true ``k`` nearest of the first ``queries`` query ids by hash that ``found`` holds, by comparison with all rows."""
    rows, kind = clean_vectors(df, id_col, vector_col)
    vectors = distinct_vectors(rows, k + 1)
    few = found.select(F.col("query_id").alias("id")).distinct().orderBy(F.xxhash64("id"), "id").limit(queries)
    few = rows.join(few, "id").collect()
    x = np.stack([np.frombuffer(r["raw"], kind) for r in few]).astype(np.float64)
    owners: dict[bytes, list[int]] = {}
    for r in few:
        owners.setdefault(bytes(r["key"]), []).append(r["id"])
    true: dict[int, list] = {}
    for r in sorted(brute_force(vectors, [bytes(r["key"]) for r in few], x, kind, k + 1).select("key", "place", "vec_id", "score").distinct().collect(), key=lambda r: r["place"]):
        for i in owners[bytes(r["key"])]:
            if r["vec_id"] != i and len(true.setdefault(i, [])) < k:
                true[i].append((r["vec_id"], r["score"]))
    got: dict[int, set] = {}
    for r in found.filter(F.col("query_id").isin(list(true))).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    return sum(v in got.get(i, set()) for i, t in true.items() for v, _ in t) / max(1, sum(map(len, true.values())))
