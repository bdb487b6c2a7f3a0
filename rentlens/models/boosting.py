"""Gradient boosting of many models in shared passes.

The matrix is quantised once (one byte a value, ``BINS`` bins a feature, edges from a bounded sample drawn by hash). Rows
are dealt by the sample and sorted by their bins and written in blocks, in which rows of equal bins, a cell, are neighbours. All rows of a
cell end in the same leaf of every tree, so a fit reads rows only to add up, per cell, the targets that a round draws: once
for several rounds, since what is drawn does not depend on the trees. Then the trees of all models, whatever their seeds,
folds, features or parameters, grow level by level together over these sums: every task adds up the residuals of its cells
per (model, node, feature, bin), these are shuffled by model, and each model's best splits come back. What travels depends
on the number of models, nodes, features and bins, and a level's work on the cells, never on the rows of a cell. Where cells
are about as many as rows, and their sums would be large, a level adds up the rows of its blocks instead. Where the whole
matrix has few cells (``TASK_CELLS``, however many rows), the sums are shuffled by what is drawn instead, and a task grows all
levels of its models' rounds: two stages for many rounds in place of a job a level. The trees are the same in all three ways.

Targets and predictions are rounded to a fixed unit, so that all sums are whole numbers: a fit depends neither on the partitioning
nor on which other models are fitted with it. Row subsets (subsample of a round, fold) come from a hash of the id.

Defined cases: a missing feature value counts as 0, NaN as larger than any number; rows without a target take no part;
the first tree has weight 1, the others ``step``; a node without a gain stays a leaf; a model without rows predicts the mean of all targets; an empty table predicts 0.
"""

from __future__ import annotations

from collections import namedtuple
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field, replace
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from rentlens.operators.filters import require_columns
from rentlens.session import materialise, parallelism, ship_package

BINS = 32
#: Rows from which bin edges are taken, drawn by hash.
EDGE_SAMPLE = 50_000
BLOCK_ROWS = 1 << 17
#: Rows of a partition of blocks, at most about this many.
PART_ROWS = 1 << 20
#: Rows that a task sorts at once.
SORT_ROWS = 1 << 21
#: Bytes of gradient sums that a task holds at once; more models than fit go in several passes.
SUM_BYTES = 64 << 20
#: Sums of all tasks up to this size go straight to the driver, larger ones are added up in tasks; the splits are the same.
DRIVER_BYTES = 16 << 20
#: Rounds after which the predictions so far are written with the cells instead of being computed from the trees.
STATE_ROUNDS = 5
#: Sums by cell of all the rounds that are written together; a round whose sums are larger is added up from the rows.
ROUND_BYTES = 512 << 20
#: Cells of a matrix, at most, whose sums of one draw a single task holds to grow the trees of the draw's models.
TASK_CELLS = 1 << 18
#: Cells that a task joins into one row, by the bytes of their sums.
ROW_BYTES = 16 << 20
#: Models that are fitted together where a round is added up from the rows, whose predictions are then written.
ROW_MODELS = 16
#: Cells whose predictions a task remembers.
KNOWN_CELLS = 1 << 17

BLOCKS = "rows int, cells binary, lengths binary, target binary, hash binary, masks binary, state binary, sums binary, counts binary, held binary"
BLOCK_NAMES = [c.split(" ")[0] for c in BLOCKS.split(", ")]


@dataclass(frozen=True)
class Spec:
    """One model. ``fold`` is (seed, folds, held-out fold) or None; ``train`` and ``validation`` name mask columns or are None."""

    features: tuple[str, ...]
    seed: int = 42
    rounds: int = 20
    depth: int = 5
    step: float = 0.1
    subsample: float = 0.8
    fold: tuple[int, int, int] | None = None
    train: str | None = None
    validation: str | None = None


@dataclass
class Tree:
    """A heap: the children of node i are 2i + 1 and 2i + 2. ``feature`` is -1 at a leaf; a row goes right if its bin is above ``bin``."""

    feature: np.ndarray
    bin: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        n = 2 ** (depth + 1) - 1
        return cls(np.full(n, -1, np.int32), np.zeros(n, np.int32), np.zeros(n), np.zeros(n))

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """Node at which each column of ``bins`` (features, rows) ends."""
        at = np.zeros(bins.shape[1], np.int64)
        every = np.arange(bins.shape[1])
        while True:
            f = self.feature[at]
            inner = f >= 0
            if not inner.any():
                return at
            right = bins[np.maximum(f, 0), every] > self.bin[at]
            at = np.where(inner, 2 * at + 1 + right, at)

    def contributions(self, bins: np.ndarray, out: np.ndarray) -> None:
        """Adds to ``out`` (features, rows) what every split on a row's path changes the value by."""
        at = np.zeros(bins.shape[1], np.int64)
        every = np.arange(bins.shape[1])
        while (inner := self.feature[at] >= 0).any():
            f = np.maximum(self.feature[at], 0)
            to = np.where(inner, 2 * at + 1 + (bins[f, every] > self.bin[at]), at)
            out[f, every] += self.value[to] - self.value[at]
            at = to


def mixed(hashes: np.ndarray, seed: int) -> np.ndarray:
    """Uniform 64-bit numbers from row hashes and a seed."""
    with np.errstate(over="ignore"):
        x = hashes.view(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Layout:
    """What is needed to read blocks."""

    features: tuple[str, ...]
    edges: list[np.ndarray]
    masks: tuple[str, ...]
    mean: float
    unit: float

    def whole(self, values: np.ndarray) -> np.ndarray:
        """Differences from the mean in units."""
        return np.rint(values / self.unit).astype(np.int64)


@dataclass
class Matrix:
    table: DataFrame
    layout: Layout
    cells: int


def number(column: str) -> F.Column:
    return F.coalesce(F.col(column).cast("double"), F.lit(0.0))


def feature_array(df: DataFrame, features: Sequence[str]) -> F.Column:
    require_columns(df, features)
    return F.array(*[number(c) for c in features])


def binned(columns: Sequence[np.ndarray], edges: list[np.ndarray]) -> np.ndarray:
    """(features, rows): the bin of every value."""
    return np.stack([np.searchsorted(e, x, "left").astype(np.uint8) for x, e in zip(columns, edges)])


def binned_rows(flat: np.ndarray, rows: int, edges: list[np.ndarray]) -> np.ndarray:
    return binned(list(flat.reshape(rows, len(edges)).T), edges)


def sort_keys(cells: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Byte strings that order rows by cell, then by hash."""
    raw = np.concatenate([cells.T, np.ascontiguousarray(hashes).astype(">i8").view(np.uint8).reshape(-1, 8)], axis=1)
    return np.ascontiguousarray(raw).view(f"S{raw.shape[1]}").ravel()


def bytes_column(values: np.ndarray) -> pa.Array:
    """One binary value per row of a matrix of bytes."""
    rows, width = values.shape
    return pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer(np.arange(0, rows * width + 1, width, np.int32) if width else np.zeros(rows + 1, np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def byte_rows(column: pa.Array, width: int) -> np.ndarray:
    """The matrix of bytes of a column made by ``bytes_column``."""
    if not len(column):
        return np.zeros((0, width), np.uint8)
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + 2]
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] :][: len(column) * width].reshape(len(column), width)


def quantised(df: DataFrame, id_col: str, features: Sequence[str], target: str, masks: Sequence[str] = (), bins: int = BINS) -> Matrix:
    """Writes the matrix in blocks. Boolean columns named in ``masks`` choose rows for models; null counts as false."""
    spark = df.sparkSession
    ship_package(spark)
    width, flag_count = len(features), max(len(masks), 1)
    require_columns(df, features)
    values, flags = [f"x{j}" for j in range(width)], [f"m{j}" for j in range(flag_count)]
    rows = df.filter(F.col(target).isNotNull()).select(
        *[number(c).alias(x) for c, x in zip(features, values)], F.col(target).cast("double").alias("y"), F.xxhash64(F.col(id_col).cast("string")).alias("hash"),
        *[F.coalesce(F.col(m), F.lit(False)).cast("byte").alias(f) for m, f in zip(masks, flags)], *([] if masks else [F.lit(0).cast("byte").alias("m0")]))
    rows = materialise(rows, "matrix")
    n, low, high, mean = rows.agg(F.count(F.lit(1)), F.min("y"), F.max("y"), F.avg("y")).first()
    drawn = rows.filter(F.pmod("hash", F.lit(1 << 30)) < int(min(1.0, EDGE_SAMPLE / max(n, 1)) * (1 << 30)) + 1).select(*values, "hash").collect()
    sample = np.array([r[:width] for r in drawn], float).reshape(-1, width)
    edges = [np.unique(np.quantile(c[~np.isnan(c)], np.arange(1, bins) / bins, method="lower")) if (~np.isnan(c)).any() else np.zeros(0) for c in sample.T]
    # the largest value as an edge would leave the bin above it empty
    edges = [e[e < np.nanmax(c)] if len(e) else e for e, c in zip(edges, sample.T)]
    # the sample also shows where parts of about equal size end, so that the rows are dealt without another pass over them
    parts = max(parallelism(spark), n // PART_ROWS)
    known = np.sort(sort_keys(binned(list(sample.T), edges), np.array([r["hash"] for r in drawn], np.int64)))
    ends = known[np.arange(1, parts) * len(known) // parts] if len(known) else known

    def to_bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [c.to_numpy() for c in batch.columns]
            cells, hashes = binned(columns[:width], edges), columns[width + 1]
            part = np.searchsorted(ends, sort_keys(cells, hashes), "right")
            yield pa.record_batch([pa.array(part, pa.int32()), bytes_column(cells.T), batch.column(width), batch.column(width + 1), bytes_column(np.stack(columns[width + 2 :], axis=1).astype(np.uint8))], names=["part", "cell", "y", "hash", "masks"])

    def block(cells: np.ndarray, y: np.ndarray, hashes: np.ndarray, flagged: np.ndarray) -> pa.RecordBatch:
        first = np.flatnonzero(np.r_[True, (cells[1:] != cells[:-1]).any(axis=1)])
        raw = [cells[first].T, np.diff(np.r_[first, len(y)]).astype(np.int32), y, hashes, flagged.T]
        return pa.record_batch([pa.array([len(y)], pa.int32()), *[pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in raw], *[pa.array([b""], pa.binary())] * 4], names=BLOCK_NAMES)

    def sorted_blocks(have: list[tuple]) -> Iterator[pa.RecordBatch]:
        columns = [np.concatenate(c) for c in zip(*have)]
        order = np.lexsort((columns[2], *columns[0].T[::-1]))
        for start in range(0, len(order), BLOCK_ROWS):
            yield block(*[c[order[start : start + BLOCK_ROWS]] for c in columns])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have, size = [], 0
        for batch in batches:
            have.append((byte_rows(batch.column(0), width).copy(), batch.column(1).to_numpy().copy(), batch.column(2).to_numpy().copy(), byte_rows(batch.column(3), flag_count).copy()))
            size += batch.num_rows
            if size >= SORT_ROWS:  # a part of more rows is sorted piece by piece
                yield from sorted_blocks(have)
                have, size = [], 0
        if have:
            yield from sorted_blocks(have)

    dealt = rows.mapInArrow(to_bins, "part int, cell binary, y double, hash bigint, masks binary").repartitionById(parts, "part").drop("part")
    table = materialise(dealt.mapInArrow(pack, BLOCKS), "blocks")
    cells = table.agg(F.sum(F.octet_length("lengths") / 4)).first()[0] or 0
    # sums of n residuals stay below 2^53, so that they are exact in doubles too
    steps = 2.0 ** max(20, 51 - int(n).bit_length())
    unit = float(high - low) / steps if n and high > low else 1.0
    # a whole number of units from the least target: the order of a sum does not show
    start = low + round((mean - low) / unit) * unit if n else 0.0
    return Matrix(table, Layout(tuple(features), edges, tuple(masks), float(start), unit), int(cells))


class Block:
    """Rows in order of their cells, ``lengths`` rows each, or only sums of the rows by cell; and each model's prediction for a cell, less the mean."""

    def __init__(self, row: dict, layout: Layout, models: int):
        self.n = row["rows"]
        self.cells = np.frombuffer(row["cells"], np.uint8).reshape(len(layout.features), -1)
        count = self.cells.shape[1]
        self.lengths = np.frombuffer(row["lengths"], np.int32)
        self.target, self.hash = np.frombuffer(row["target"]), np.frombuffer(row["hash"], np.int64)
        self.masks = np.frombuffer(row["masks"], np.uint8).reshape(-1, max(self.n, 1)).astype(bool)
        self.state = np.frombuffer(row["state"]).reshape(models, count) if row["state"] else np.zeros((models, count))
        self.sums, self.counts, self.held_sums = np.frombuffer(row["sums"], np.int64), np.frombuffer(row["counts"], np.int32), np.frombuffer(row["held"])

    @cached_property
    def bins(self) -> np.ndarray:
        return np.repeat(self.cells, self.lengths, axis=1)

    @cached_property
    def first(self) -> np.ndarray:
        return np.cumsum(self.lengths) - self.lengths

    def mask(self, layout: Layout, name: str | None) -> np.ndarray:
        return np.ones(self.n, bool) if name is None else self.masks[layout.masks.index(name)]

    def training(self, layout: Layout, spec: Spec) -> np.ndarray:
        chosen = self.mask(layout, spec.train)
        if spec.validation is not None:
            chosen = chosen & ~self.mask(layout, spec.validation)
        return chosen & (self.folds(spec) != spec.fold[2]) if spec.fold else chosen

    def folds(self, spec: Spec) -> np.ndarray:
        return mixed(self.hash, spec.fold[0]) % np.uint64(spec.fold[1])

    def drawn(self, spec: Spec, round_: int) -> np.ndarray | None:
        """Rows of a round's subsample; None for all."""
        if spec.subsample >= 1:
            return None
        return mixed(self.hash, (spec.seed << 20) + round_ + 1) < np.uint64(int(spec.subsample * 2.0**64) if spec.subsample > 0 else 0)

    def add_up(self, layout: Layout, draws: Sequence[Spec], rounds: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
        """(rounds, draws, cells): sums of the targets, and numbers, of the rows that each draw trains on."""
        shape = (len(rounds), len(draws), len(self.lengths))
        sums, counts = np.zeros(shape, np.int64), np.zeros(shape, np.int32)
        whole = layout.whole(self.target - layout.mean)
        subsets, folds = {}, {}
        for d, spec in enumerate(draws):
            chosen = self.mask(layout, spec.train)
            if spec.validation is not None:
                chosen = chosen & ~self.mask(layout, spec.validation)
            if spec.fold:
                if spec.fold[:2] not in folds:
                    folds = {spec.fold[:2]: self.folds(spec)}  # draws of a seed are neighbours
                chosen = chosen & (folds[spec.fold[:2]] != spec.fold[2])
            for r, round_ in enumerate(rounds):
                key = spec.seed, spec.subsample, round_
                if key not in subsets:
                    if any(k[0] != spec.seed for k in subsets):
                        subsets = {}
                    subsets[key] = self.drawn(spec, round_)
                rows = chosen if subsets[key] is None else chosen & subsets[key]
                sums[r, d] = np.add.reduceat(whole * rows, self.first)
                counts[r, d] = np.add.reduceat(rows, self.first, dtype=np.int32)
        return sums, counts

    def held(self, layout: Layout, spec: Spec) -> np.ndarray:
        """(3, cells): number, mean (less the overall one) and squared deviations of a cell's validation rows."""
        rows = self.mask(layout, spec.validation) & self.mask(layout, spec.train)
        y = (self.target - layout.mean) * rows
        n = np.add.reduceat(rows, self.first, dtype=np.int64)
        mean = np.add.reduceat(y, self.first) / np.maximum(n, 1)
        return np.stack([n, mean, np.add.reduceat(((y - np.repeat(mean, self.lengths)) * rows) ** 2, self.first)])


def prediction(cells: np.ndarray, trees: Sequence[Tree], start: np.ndarray | float = 0.0) -> np.ndarray:
    out = np.zeros(cells.shape[1]) + start
    for tree in trees:
        out += tree.value[tree.leaves(cells)]
    return out


def rows_in(batches: Iterator[pa.RecordBatch], layout: Layout, models: int) -> Iterator[Block]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield Block({c: batch.column(j)[i].as_py() for j, c in enumerate(BLOCK_NAMES)}, layout, models)


@dataclass
class Draws:
    """Which rows the models of some rounds train on. Models of the same seed, share, fold and masks have the same rows."""

    specs: list[Spec]
    rounds: range

    def __post_init__(self):
        keyed = {self.key(s): s for s in self.specs}
        self.kinds = [keyed[k] for k in sorted(keyed, key=repr)]
        self.place = {self.key(s): i for i, s in enumerate(self.kinds)}
        self.checks = sorted({(s.validation, s.train) for s in self.specs if s.validation is not None}, key=repr)

    @staticmethod
    def key(spec: Spec) -> tuple:
        return spec.seed, spec.subsample, spec.fold, spec.train, spec.validation


def prepared(layout: Layout, table: DataFrame, specs: list[Spec], trees: list[list[Tree]], draws: Draws, by_rows: bool) -> DataFrame:
    """The cells with the predictions of the ``trees`` and either the sums of the draws, many blocks in a row, or the rows as they were."""

    def joined(parts: list[tuple]) -> pa.RecordBatch:
        cells, sums, counts, held = (np.concatenate(p, axis=-1) for p in zip(*parts))
        state = np.stack([prediction(cells, t) for t in trees])
        raw = [cells, b"", b"", b"", b"", state, sums, counts, held]
        return pa.record_batch([pa.array([0], pa.int32()), *[pa.array([x if isinstance(x, bytes) else np.ascontiguousarray(x).tobytes()], pa.binary()) for x in raw]], names=BLOCK_NAMES)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have, size = [], 0
        for block in rows_in(batches, layout, 0):
            sums, counts = block.add_up(layout, draws.kinds, draws.rounds)
            held = np.stack([block.held(layout, Spec((), validation=v, train=t)) for v, t in draws.checks]) if draws.checks else np.zeros((0, 3, len(block.lengths)))
            have.append((block.cells, sums, counts, held))
            size += sums.nbytes + counts.nbytes + 8 * len(specs) * len(block.lengths)
            if size > ROW_BYTES:
                yield joined(have)
                have, size = [], 0
        if have:
            yield joined(have)

    def renew(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                cells = Block(row.to_pylist()[0], layout, 0).cells
                state = np.stack([prediction(cells, t) for t in trees])
                yield pa.record_batch([*row.columns[:6], pa.array([state.tobytes()], pa.binary()), *row.columns[7:]], names=BLOCK_NAMES)

    return materialise(table.mapInArrow(renew if by_rows else add, BLOCKS), "rounds")


def node_sums(cells: np.ndarray, node: np.ndarray, sums: np.ndarray, counts: np.ndarray, predicted: np.ndarray, nodes: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the residuals, and rows, by (node, feature, bin). ``node`` is the cell's place in its level, negative where it ended before; ``predicted`` is in units."""
    width = len(cells)
    size = nodes * width * BINS_USED
    at = np.flatnonzero((counts > 0) & (node >= 0))
    rows = counts[at].astype(np.int64)
    left = sums[at] - rows * predicted[at]
    place = (node[at] * (width * BINS_USED) + cells[:, at] + np.arange(width, dtype=np.int64)[:, None] * BINS_USED).ravel()
    return np.rint(np.bincount(place, np.tile(left, width), size)).astype(np.int64), np.bincount(place, np.tile(rows, width), size).astype(np.int64)


SUMS = "model int, sums binary, counts binary, error double, n bigint"
Split = namedtuple("Split", "model node feature bin gain total count left left_count error n")
SPLITS = "model int, node int, feature int, bin int, gain double, total bigint, count bigint, left bigint, left_count bigint, error double, n bigint"


def level_sums(layout: Layout, table: DataFrame, group: list[int], specs: list[Spec], draws: Draws, recent: list[list[Tree]], growing: list[Tree], level: int, round_: int) -> DataFrame:
    """Per task and model of the group the sums of residuals and the rows by (node, feature, bin) of one level, and the error on its validation rows."""
    nodes, base, width = 2**level, 2**level - 1, len(layout.features)
    kinds = sorted({draws.place[draws.key(specs[m])] for m in group})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = nodes * width * BINS_USED
        sums, counts = np.zeros((len(group), size), np.int64), np.zeros((len(group), size), np.int64)
        error, held = np.zeros(len(group)), np.zeros(len(group), np.int64)
        for block in rows_in(batches, layout, len(specs)):
            if block.n:
                some_sums, some_counts = (x[0] for x in block.add_up(layout, [draws.kinds[k] for k in kinds], [round_]))
            else:
                shape = len(draws.rounds), len(draws.kinds), -1
                at_round = draws.rounds.index(round_)
                some_sums, some_counts = (x.reshape(shape)[at_round, kinds] for x in (block.sums, block.counts))
            for g, m in enumerate(group):
                spec = specs[m]
                predicted = prediction(block.cells, recent[m], block.state[m])
                if level == 0 and spec.validation is not None:
                    if block.n:
                        n, mean, spread = block.held(layout, spec)
                    else:
                        n, mean, spread = block.held_sums.reshape(len(draws.checks), 3, -1)[draws.checks.index((spec.validation, spec.train))]
                    error[g] += float((spread + n * (mean - predicted) ** 2).sum())
                    held[g] += int(n.sum())
                k = kinds.index(draws.place[draws.key(spec)])
                more_sums, more_counts = node_sums(block.cells, growing[m].leaves(block.cells) - base, some_sums[k], some_counts[k], layout.whole(predicted), nodes)
                sums[g] += more_sums
                counts[g] += more_counts
        yield pa.record_batch([pa.array(group, pa.int32()), *[pa.array([x.tobytes() for x in v], pa.binary()) for v in (sums, counts)], pa.array(error), pa.array(held)], names=[c.split(" ")[0] for c in SUMS.split(", ")])

    return table.mapInArrow(add, SUMS)


#: Bins and one for values above the last edge.
BINS_USED = BINS + 1


def choose_splits(parts: Iterator[tuple], specs: list[Spec], features: tuple[str, ...], level: int) -> list[tuple]:
    """From the sums of all tasks (rows of ``SUMS``), one row of ``SPLITS`` per model and node: its best split, feature -1 without a gain."""
    width, nodes = len(features), 2**level
    total: dict[int, list] = {}
    for m, s, c, e, n in parts:
        s, c = np.frombuffer(s, np.int64), np.frombuffer(c, np.int64)
        have = total.get(m)
        total[m] = [s, c, e, n] if have is None else [have[0] + s, have[1] + c, have[2] + e, have[3] + n]
    out = []
    for m, (s, c, e, held) in sorted(total.items()):
        s, c = s.reshape(nodes, width, BINS_USED), c.reshape(nodes, width, BINS_USED)
        use = np.array([f in specs[m].features for f in features])
        if not c.any():
            out.append((m, 0, -1, 0, 0.0, 0, 0, 0, 0, e, held))
        for node in np.flatnonzero(c[:, 0].sum(axis=1)).tolist():
            ls, lc = np.cumsum(s[node], axis=1)[:, :-1], np.cumsum(c[node], axis=1)[:, :-1]
            all_s, all_c = int(s[node, 0].sum()), int(c[node, 0].sum())
            rs, rc = all_s - ls, all_c - lc
            whole = float(all_s) ** 2 / all_c
            gain = ls.astype(float) ** 2 / np.maximum(lc, 1) + rs.astype(float) ** 2 / np.maximum(rc, 1) - whole
            gain[(lc == 0) | (rc == 0) | ~use[:, None]] = -1.0
            f, b = divmod(int(gain.argmax()), BINS_USED - 1)
            if gain[f, b] > 1e-9 * max(1.0, whole):  # less is the rounding of the quotients
                out.append((m, node, f, b, float(gain[f, b]), all_s, all_c, int(ls[f, b]), int(lc[f, b]), e, held))
            else:
                out.append((m, node, -1, 0, 0.0, all_s, all_c, 0, 0, e, held))
    return out


def best_splits(sums: DataFrame, specs: list[Spec], features: tuple[str, ...], level: int) -> DataFrame:
    """``choose_splits`` of each model in one of several tasks, which adds up its rows as they come."""

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(batch.column(i).to_pylist() for i in range(5))))
        out = choose_splits(rows, specs, features, level)
        kinds = [pa.int32()] * 4 + [pa.float64()] + [pa.int64()] * 4 + [pa.float64(), pa.int64()]
        cols = list(zip(*out)) or [[]] * len(kinds)
        yield pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds)], names=[c.split(" ")[0] for c in SPLITS.split(", ")])

    return sums.repartition(min(len(specs), parallelism(sums.sparkSession)), "model").mapInArrow(choose, SPLITS)


class Remembered:
    """``compute`` (bins to one row of values per column) with the values of cells that came before; without memory for more than eight features."""

    def __init__(self, compute):
        self.compute, self.codes, self.values = compute, np.zeros(0, np.uint64), None

    def __call__(self, bins: np.ndarray) -> np.ndarray:
        width, n = bins.shape
        if not 0 < width <= 8:
            return self.compute(bins)
        padded = np.zeros((n, 8), np.uint8)
        padded[:, :width] = bins.T
        codes = padded.view(np.uint64).ravel()
        new = np.setdiff1d(codes, self.codes)
        if len(self.codes) + len(new) > KNOWN_CELLS:
            self.codes, self.values, new = self.codes[:0], None, np.unique(codes)
        if len(new):
            values = self.compute(new.view(np.uint8).reshape(-1, 8)[:, :width].T)
            order = np.argsort(both := np.concatenate([self.codes, new]))
            self.codes, self.values = both[order], (values if self.values is None else np.concatenate([self.values, values]))[order]
        return self.values[np.searchsorted(self.codes, codes)] if n else self.compute(bins)


@dataclass
class Ensemble:
    """Fitted models: their specs and trees, the features with bin edges, and the value that all start from."""

    features: tuple[str, ...]
    edges: list[np.ndarray]
    start: float
    specs: list[Spec]
    trees: list[list[Tree]] = field(default_factory=list)

    def __len__(self) -> int:
        return len(self.trees)

    def part(self, numbers: Sequence[int]) -> Ensemble:
        return replace(self, specs=[self.specs[i] for i in numbers], trees=[self.trees[i] for i in numbers])

    def importances(self) -> np.ndarray:
        """(models, features): share of the gain of all splits; 0 without any split."""
        out = np.zeros((len(self.trees), len(self.features)))
        for m, trees in enumerate(self.trees):
            for t in trees:
                inner = t.feature >= 0
                out[m] += np.bincount(t.feature[inner], t.gain[inner], len(self.features))
        return out / np.maximum(out.sum(axis=1, keepdims=True), 1e-300)

    def predictions(self, df: DataFrame, features: F.Column, out: str) -> DataFrame:
        """Adds ``out``, an array with each model's prediction, in one pass."""
        ship_package(df.sparkSession)

        @arrow_udf("array<double>")
        def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            known = Remembered(lambda bins: np.stack([self.start + prediction(bins, trees) for trees in self.trees]).T)
            for x in batches:
                got = known(binned_rows(x.flatten().to_numpy(), len(x), self.edges))
                yield pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * len(self.trees), got.ravel())

        return df.withColumn(out, score(features))

    def contributions(self, df: DataFrame, out: str = "contributions", base: str = "base") -> DataFrame:
        """Adds ``out`` (feature to what it adds to the mean prediction of the models, along the paths of their trees) and ``base``; together they are that prediction."""
        ship_package(df.sparkSession)
        n = len(self.trees)
        start = self.start + sum(t.value[0] for trees in self.trees for t in trees) / max(n, 1)

        def added(bins: np.ndarray) -> np.ndarray:
            got = np.zeros(bins.shape)
            for trees in self.trees:
                for t in trees:
                    t.contributions(bins, got)
            return (got / max(n, 1)).T

        @arrow_udf("array<double>")
        def explain(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            known = Remembered(added)
            for x in batches:
                got = known(binned_rows(x.flatten().to_numpy(), len(x), self.edges))
                yield pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * len(self.features), got.ravel())

        names = F.array(*[F.lit(f) for f in self.features])
        return df.withColumn(out, F.map_from_arrays(names, explain(feature_array(df, self.features)))).withColumn(base, F.lit(float(start)))

    def nodes(self, spark: SparkSession) -> DataFrame:
        """``model, tree, node, feature, threshold, bin, value, gain``: every node of every tree; a row goes left if its value is at most the threshold."""
        rows = []
        for m, trees in enumerate(self.trees):
            for k, t in enumerate(trees):
                used = [0]
                for i in used:
                    f = int(t.feature[i])
                    inner = f >= 0
                    rows.append((m, k, i, self.features[f] if inner else None, float(self.edges[f][t.bin[i]]) if inner else None, int(t.bin[i]), float(t.value[i]), float(t.gain[i])))
                    used += [2 * i + 1, 2 * i + 2] if inner else []
        return spark.createDataFrame(rows, "model int, tree int, node int, feature string, threshold double, bin int, value double, gain double")

    def save(self, spark: SparkSession, path: str) -> None:
        self.nodes(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        rows = [(i, f, self.edges[i].tolist()) for i, f in enumerate(self.features)]
        spark.createDataFrame(rows, "place int, feature string, edges array<double>").coalesce(1).write.mode("overwrite").parquet(f"{path}/features")
        specs = [(i, self.start, s.seed, s.rounds, s.depth, s.step, s.subsample, list(s.features)) for i, s in enumerate(self.specs)]
        schema = "model int, start double, seed bigint, rounds int, depth int, step double, subsample double, features array<string>"
        spark.createDataFrame(specs, schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/models")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Ensemble:
        found = spark.read.parquet(f"{path}/features").orderBy("place").collect()
        features, edges = tuple(r["feature"] for r in found), [np.array(r["edges"], float) for r in found]
        models = spark.read.parquet(f"{path}/models").orderBy("model").collect()
        specs = [Spec(tuple(r["features"]), r["seed"], r["rounds"], r["depth"], r["step"], r["subsample"]) for r in models]
        trees: list[list[Tree]] = [[] for _ in specs]
        for r in spark.read.parquet(f"{path}/nodes").orderBy("model", "tree", "node").collect():
            own = trees[r["model"]]
            if r["tree"] == len(own):
                own.append(Tree.empty(specs[r["model"]].depth))
            t, i = own[r["tree"]], r["node"]
            t.value[i], t.gain[i], t.bin[i] = r["value"], r["gain"], r["bin"]
            t.feature[i] = -1 if r["feature"] is None else features.index(r["feature"])
        return cls(features, edges, models[0]["start"] if models else 0.0, specs, trees)


def fit_many(matrix: Matrix, specs: Sequence[Spec]) -> Ensemble:
    """All models of ``specs`` in shared passes. With a validation mask a model keeps the rounds up to its least error there."""
    specs = list(specs)
    layout = matrix.layout
    last = max((s.rounds for s in specs), default=0)
    bytes_ = max(1, 12 * matrix.cells * len(Draws(specs, range(1)).kinds))
    by_rows = bytes_ > ROUND_BYTES
    if by_rows and len(specs) > ROW_MODELS:
        parts = [fit_many(matrix, specs[i : i + ROW_MODELS]) for i in range(0, len(specs), ROW_MODELS)]
        return replace(parts[0], specs=specs, trees=[t for p in parts for t in p.trees])
    done = Ensemble(layout.features, layout.edges, layout.mean, specs, [[] for _ in specs])
    errors: list[list[float]] = [[] for _ in specs]
    if matrix.cells <= TASK_CELLS and not by_rows:
        chunk = max(1, ROUND_BYTES // bytes_)
        for start in range(0, last, chunk):
            grow_in_tasks(layout, matrix.table, specs, done.trees, errors, Draws(specs, range(start, min(start + chunk, last))))
        return until_least(done, errors)
    chunk = max(1, min(STATE_ROUNDS, ROUND_BYTES // bytes_))
    for round_ in range(last):
        active = [m for m, s in enumerate(specs) if round_ < s.rounds]
        if round_ % chunk == 0:
            draws = Draws(specs, range(round_, min(round_ + chunk, last)))
            table = prepared(layout, matrix.table, specs, done.trees, draws, by_rows)
            recent, partitions = [[] for _ in specs], table.rdd.getNumPartitions()
        growing = [Tree.empty(s.depth) for s in specs]
        open_ = {m: {0} for m in active}
        for level in range(max(specs[m].depth for m in active)):
            here = [m for m in active if level < specs[m].depth and open_[m]]
            for found in level_splits(layout, table, partitions, here, specs, draws, recent, growing, level, round_):
                m = found.model
                grow(growing[m], (specs[m].step if round_ else 1.0) * layout.unit, layout.unit, found, level, open_[m])
                if level == 0 and found.n:
                    errors[m].append(found.error / found.n)
            for m in here:
                open_[m] = {i for i in open_[m] if i >= 2 ** (level + 1) - 1}
        for m in active:
            recent[m].append(growing[m])
            done.trees[m].append(growing[m])
    checked = [m for m, s in enumerate(specs) if s.validation is not None] if last else []
    if checked:  # the error before each round is known; the one after the last is not
        for found in level_splits(layout, table, partitions, checked, specs, draws, recent, [Tree.empty(0) for _ in specs], 0, last - 1):
            if found.n and found.node == 0:
                errors[found.model].append(found.error / found.n)
    return until_least(done, errors)


def until_least(models: Ensemble, errors: list[list[float]]) -> Ensemble:
    """Each model with the rounds before its least error; ``errors`` are before every round and after the last, or none."""
    return replace(models, trees=[trees[: int(np.argmin(e))] if e else trees for trees, e in zip(models.trees, errors)])


DRAWN = "kind int, cells binary, sums binary, counts binary, held binary"
GROWN = "model int, round int, feature binary, bin binary, value binary, gain binary, error double"


def drawn_sums(layout: Layout, table: DataFrame, draws: Draws) -> DataFrame:
    """One row per draw and some blocks: the cells, and by round and cell the sums and numbers of the drawn rows."""

    def joined(parts: list[tuple]) -> pa.RecordBatch:
        cells, sums, counts, held = (np.concatenate(p, axis=-1) for p in zip(*parts))
        raw = [[cells.tobytes()] * len(draws.kinds), *[[x.tobytes() for x in np.ascontiguousarray(v.swapaxes(0, 1))] for v in (sums, counts)]]
        of = [draws.checks.index((s.validation, s.train)) if s.validation is not None else None for s in draws.kinds]
        raw.append([b"" if i is None else np.ascontiguousarray(held[i]).tobytes() for i in of])
        return pa.record_batch([pa.array(range(len(draws.kinds)), pa.int32()), *[pa.array(x, pa.binary()) for x in raw]], names=[c.split(" ")[0] for c in DRAWN.split(", ")])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have, size = [], 0
        for block in rows_in(batches, layout, 0):
            sums, counts = block.add_up(layout, draws.kinds, draws.rounds)
            held = np.stack([block.held(layout, Spec((), validation=v, train=t)) for v, t in draws.checks]) if draws.checks else np.zeros((0, 3, len(block.lengths)))
            have.append((block.cells, sums, counts, held))
            size += sums.nbytes + counts.nbytes
            if size > ROW_BYTES:
                yield joined(have)
                have, size = [], 0
        if have:
            yield joined(have)

    return table.mapInArrow(add, DRAWN)


def grow_in_tasks(layout: Layout, table: DataFrame, specs: list[Spec], trees: list[list[Tree]], errors: list[list[float]], draws: Draws) -> None:
    """Appends the trees of the draws' rounds, and the errors before them, for all models; the models of one draw grow in one task."""
    members: dict[int, list[int]] = {}
    for m, spec in enumerate(specs):
        if draws.rounds.start < spec.rounds:
            members.setdefault(draws.place[draws.key(spec)], []).append(m)
    width = len(layout.features)

    def fit(group: pa.Table) -> pa.Table:
        # in an order of its own, so that the errors do not depend on which task came first
        parts = sorted(zip(*(group[c].to_pylist() for c in ("cells", "sums", "counts", "held"))))
        shapes = (np.uint8, width), (np.int64, len(draws.rounds)), (np.int32, len(draws.rounds)), (np.float64, 3)
        cells, sums, counts, held = (np.concatenate([np.frombuffer(x, kind).reshape(n, -1) for x in column], axis=1) for column, (kind, n) in zip(zip(*parts), shapes))
        out = []
        for m in members.get(group["kind"][0].as_py(), []):
            spec, predicted = specs[m], prediction(cells, trees[m])
            for at, round_ in enumerate(draws.rounds):
                if round_ >= spec.rounds:
                    break
                tree, error = Tree.empty(spec.depth), error_of(held, predicted)
                grow_tree(layout, tree, spec, round_, cells, sums[at], counts[at], layout.whole(predicted))
                predicted += tree.value[tree.leaves(cells)]
                out.append((m, round_, tree.feature.tobytes(), tree.bin.tobytes(), tree.value.tobytes(), tree.gain.tobytes(), error))
            if draws.rounds.start < spec.rounds <= draws.rounds.stop:
                out.append((m, spec.rounds, None, None, None, None, error_of(held, predicted)))
        kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 4, pa.float64()]
        return pa.table([pa.array(c, k) for c, k in zip(list(zip(*out)) or [[]] * len(kinds), kinds)], names=[c.split(" ")[0] for c in GROWN.split(", ")])

    found = {(r["model"], r["round"]): r for r in drawn_sums(layout, table, draws).groupBy("kind").applyInArrow(fit, GROWN).collect()}
    for m, spec in enumerate(specs):
        for round_ in range(draws.rounds.start, min(draws.rounds.stop, spec.rounds) + 1):
            r = found.get((m, round_))
            if r is not None and r["error"] is not None:
                errors[m].append(r["error"])
            if round_ < min(draws.rounds.stop, spec.rounds):
                # without any row there is no task, and the trees stay empty
                trees[m].append(Tree.empty(spec.depth) if r is None else Tree(*[np.frombuffer(r[c], kind).copy() for c, kind in (("feature", np.int32), ("bin", np.int32), ("value", float), ("gain", float))]))


def error_of(held: np.ndarray, predicted: np.ndarray) -> float | None:
    """Mean squared error on the validation rows of all cells; None without any."""
    n, mean, spread = held if held.size else np.zeros((3, 0))
    return float((spread + n * (mean - predicted) ** 2).sum() / n.sum()) if n.any() else None


def grow_tree(layout: Layout, tree: Tree, spec: Spec, round_: int, cells: np.ndarray, sums: np.ndarray, counts: np.ndarray, predicted: np.ndarray) -> None:
    """All levels of one tree over the sums of one draw by cell."""
    open_ = {0}
    for level in range(spec.depth):
        if not open_:
            break
        part = node_sums(cells, tree.leaves(cells) - (2**level - 1), sums, counts, predicted, 2**level)
        for row in choose_splits(iter([(0, *part, 0.0, 0)]), [spec], layout.features, level):
            grow(tree, (spec.step if round_ else 1.0) * layout.unit, layout.unit, Split(*row), level, open_)
        open_ = {i for i in open_ if i >= 2 ** (level + 1) - 1}


def level_splits(layout: Layout, table: DataFrame, partitions: int, models: list[int], specs: list[Spec], draws: Draws, recent: list[list[Tree]], growing: list[Tree], level: int, round_: int) -> Iterator:
    """Best splits of a level, one row a model and node; the models in groups whose sums fit into a task."""
    size = max(1, SUM_BYTES // (2**level * len(layout.features) * BINS_USED * 16))
    for a in range(0, len(models), size):
        group = models[a : a + size]
        sums = level_sums(layout, table, group, specs, draws, recent, growing, level, round_)
        if len(group) * 2**level * len(layout.features) * BINS_USED * 16 * partitions <= DRIVER_BYTES:
            yield from (Split(*row) for row in choose_splits((tuple(r) for r in sums.collect()), specs, layout.features, level))
        else:
            yield from (Split(*row) for row in best_splits(sums, specs, layout.features, level).collect())


def grow(tree: Tree, scale: float, unit: float, found: Split, level: int, open_: set[int]) -> None:
    """Puts one node's split, and the values of the node and its children, into the tree."""
    if not found.count:
        return
    i = 2**level - 1 + found.node
    tree.value[i] = scale * found.total / found.count
    if found.feature < 0:
        return
    tree.feature[i], tree.bin[i], tree.gain[i] = found.feature, found.bin, found.gain * unit * unit
    tree.value[2 * i + 1] = scale * found.left / found.left_count
    tree.value[2 * i + 2] = scale * (found.total - found.left) / (found.count - found.left_count)
    open_ |= {2 * i + 1, 2 * i + 2}


ERRORS = "model int, n bigint, abs_error double, sq_error double, target double, sq_target double"


def errors_of(matrix: Matrix, models: Ensemble, rows: str | None = None) -> DataFrame:
    """``model, n, mae, rmse, r2`` of each model's predictions, cut at 0, on its held-out fold (of the rows of its ``train`` mask), or on the rows of mask ``rows``."""
    layout = matrix.layout

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(models), 5))
        for block in rows_in(batches, layout, 0):
            cell, chosen_by = np.repeat(np.arange(len(block.lengths)), block.lengths), {}
            for m, (spec, trees) in enumerate(zip(models.specs, models.trees)):
                held_out = None if rows is not None or not spec.fold else (spec.fold, spec.train)
                if held_out not in chosen_by:
                    chosen = block.mask(layout, rows) if held_out is None else (block.folds(spec) == spec.fold[2]) & block.mask(layout, spec.train)
                    chosen_by[held_out] = block.target[chosen], cell[chosen]
                y, at = chosen_by[held_out]
                e = y - np.maximum(models.start + prediction(block.cells, trees), 0.0)[at]
                total[m] += [len(y), np.abs(e).sum(), (e**2).sum(), (y - models.start).sum(), ((y - models.start) ** 2).sum()]
        kinds = [pa.int64(), *[pa.float64()] * 4]
        yield pa.record_batch([pa.array(range(len(models)), pa.int32()), *[pa.array(total[:, i].astype(np.int64) if i == 0 else total[:, i], k) for i, k in enumerate(kinds)]], names=[c.split(" ")[0] for c in ERRORS.split(", ")])

    n = F.sum("n")
    spread = F.sum("sq_target") - F.sum("target") * F.sum("target") / n
    some = matrix.table.mapInArrow(add, ERRORS).groupBy("model")
    return some.agg(n.alias("n"), F.when(n > 0, F.sum("abs_error") / n).alias("mae"), F.when(n > 0, F.sqrt(F.sum("sq_error") / n)).alias("rmse"), F.when((n > 0) & (spread > 0), 1 - F.sum("sq_error") / spread).alias("r2"))
