"""Alignment of two tokenizers' tokens over the same bytes, by skipping along diagonals.

A text is encoded by a byte-level BPE (tokens A, of a space and the text) and by a piece model (tokens B, which adds the
space itself). Both give ascending arrays of byte ends. While the ends agree at the current index shift, every group
holds one token of each side: stretches of such groups are found by probing windows of doubling length and jumped in
one go. Where they differ, the smaller end advances until both meet, which closes one irregular group and sets the
shift anew.

A text is cut into units: the words that the byte-level BPE splits it into, put together again wherever the piece model
could make a piece over the cut, which is where some piece of its vocabulary holds the two characters around it one after
the other. Its merges cannot pass any other cut, so a unit has the same tokens in every text, and both sides end a token at
its end. A unit is therefore encoded, compared with its bytes and aligned when a task first meets it, all new units of a
batch along one diagonal walk, and then remembered in a bounded table until the task ends; a text is put together of its
units. A piece model that is no plain BPE over unchanged characters gives no such cuts: each whole text is then one unit.

How often a pair of ids is linked in the whole corpus is counted in blocks: a task adds up its documents' pairs in
blocks of about ``BLOCK_BYTES``; only these sums are shuffled by pair. Each block gets the counts of its
own pairs back, so a pair that every document holds costs one row a block, and nothing that grows with the vocabulary
or the corpus is broadcast.

Defined cases: a text that is null or empty, or whose joined A or B bytes differ from the space and the text, has no
tokens: counts 0 and an empty ``groups``; special tokens in a text are plain text; rows repeated with one id are rows of
their own; a null id stays null; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentencepiece import sentencepiece_model_pb2

from rentlens.llm.bpe import ByteBpe, Codes, slices, spread
from rentlens.llm.common import empty_if_null, give_back, materialise

BATCH_BYTES = 1 << 20
BLOCK_BYTES = 8 << 20
#: Groups of a stretch that are compared one by one before windows are.
SHORT = 8
#: Units that a task remembers before it starts anew, and the bytes of their texts.
CACHE_UNITS, CACHE_BYTES = 250_000, 8 << 20
#: Stands before a unit that does not begin with a space, so that the space which the piece model adds is no part of it.
MARK = "\0"
CHARACTERS = 0x110000

ALIGNED = "block string, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, codes binary"


class Aligner:
    """Both tokenizers' tables and the units met so far, once per Python worker."""

    def __init__(self, bpe_path: str, piece_path: str):
        self.a = ByteBpe(bpe_path)
        self.a.split = None  # special tokens are plain text
        self.a.special = {}
        self.a.clear()
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        self.a_bytes = [self.a.text[s : s + n].tobytes() for s, n in zip(self.a.text_start.tolist(), self.a.text_length.tolist())]
        self.b_bytes = [self.piece_bytes(self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())]
        self.a_length, self.b_length = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        self.width = len(self.b_bytes)
        self.code = code_type(len(self.a_bytes) * self.width)
        self.names = [b"%d%c" % (i, end) for i in range(len(self.a_bytes)) for end in b",|"] + [b"%d%c" % (i, end) for i in range(self.width) for end in b",;"]
        self.bonds = self.inner_pairs(self.b)
        self.clear()

    @staticmethod
    def piece_bytes(piece: str) -> bytes:
        byte = re.fullmatch("<0x([0-9A-Fa-f]{2})>", piece)
        return bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode()

    @staticmethod
    def inner_pairs(b: sentencepiece.SentencePieceProcessor) -> np.ndarray | None:
        """The pairs of characters that stand side by side inside some piece, as ascending codes; None if a text's tokens may depend on more."""
        model = sentencepiece_model_pb2.ModelProto.FromString(b.serialized_model_proto())
        train, norm, kind = model.trainer_spec, model.normalizer_spec, sentencepiece_model_pb2.ModelProto.SentencePiece
        plain = train.model_type == train.BPE and train.byte_fallback and not train.treat_whitespace_as_suffix
        plain &= norm.add_dummy_prefix and norm.escape_whitespaces and not norm.remove_extra_whitespaces and not norm.precompiled_charsmap
        plain &= all(p.type in (kind.NORMAL, kind.BYTE, kind.CONTROL, kind.UNKNOWN) for p in model.pieces)
        pieces = [p.piece for p in model.pieces if p.type == kind.NORMAL]
        if not plain or any(MARK in p for p in pieces) or b.encode(MARK) != [b.piece_to_id("▁"), b.piece_to_id("<0x00>")]:
            return None
        return np.array(sorted({ord(x) * CHARACTERS + ord(y) for p in pieces for x, y in zip(p, p[1:])}), np.int64)

    def clear(self) -> None:
        """Forgets all units."""
        self.units, self.kept = Codes(), 0
        self.groups: list[bytes] = []
        self.first, self.last, self.a_start, self.n_a, self.n_b, self.link_start, self.n_links, self.good, self.a_ids = (np.zeros(0, np.int64) for _ in range(9))
        self.links = np.zeros(0, self.code)

    def learn(self, units: list[str], a: np.ndarray, n_a: np.ndarray) -> None:
        """Encodes, checks and aligns new units, in the order of their numbers; ``a`` holds the ids of their words."""
        raw = [u.encode() for u in units]
        bare = [u[0] == " " and len(u) > 1 for u in units]
        found = self.b.encode([u[1:] if x else MARK + u for u, x in zip(units, bare)], num_threads=1)
        found = [ids if x else ids[2:] for ids, x in zip(found, bare)]
        n_b = np.array([len(ids) for ids in found], np.int64)
        b = np.fromiter(chain.from_iterable(found), np.int64, n_b.sum())
        good = same_bytes(self.a_bytes, self.a_length, a, n_a, raw) & same_bytes(self.b_bytes, self.b_length, b, n_b, raw)
        self.a_start, self.a_ids = np.append(self.a_start, len(self.a_ids) + np.cumsum(n_a) - n_a), np.append(self.a_ids, a)
        a, b, use_a, use_b = a[np.repeat(good, n_a)], b[np.repeat(good, n_b)], n_a * good, n_b * good
        at_a, at_b = common_ends(np.cumsum(self.a_length[a]), np.cumsum(self.b_length[b]))
        n_links = np.diff(np.searchsorted(at_a, np.cumsum(use_a)), prepend=0)
        names = list(map(self.names.__getitem__, group_order(len(self.a_bytes), a, b, at_a, at_b).tolist()))
        ends = np.cumsum(use_a + use_b).tolist()
        self.groups += [b"".join(names[s:e]) for s, e in zip([0, *ends], ends)]
        self.link_start = np.append(self.link_start, len(self.links) + np.cumsum(n_links) - n_links)
        self.links = np.append(self.links, (a[at_a] * self.width + b[at_b]).astype(self.code))
        self.n_a, self.n_b, self.n_links = np.append(self.n_a, n_a), np.append(self.n_b, n_b), np.append(self.n_links, n_links)
        self.good = np.append(self.good, good)
        self.first = np.append(self.first, [ord("▁" if u[0] == " " else u[0]) for u in units])
        self.last = np.append(self.last, [ord("▁" if u[-1] == " " else u[-1]) for u in units])
        self.kept += sum(map(len, raw))

    def cut(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the units of all texts, none of them empty, and how many each text has."""
        if len(self.units) > CACHE_UNITS or self.kept > CACHE_BYTES:
            self.clear()
        words: list[str] = []
        ends = []
        for text in texts:
            words += self.a.pieces(" " + text)
            ends.append(len(words))
        numbers = np.array(list(map(self.units.__getitem__, words)), np.int64)
        if fresh := self.units.fresh:
            self.learn(fresh, *self.a.encode_words(fresh))
            self.units.fresh = []
        starts = np.array([0, *ends[:-1]])
        joined = np.ones(len(words), bool)
        if self.bonds is not None:
            around = self.last[numbers[:-1]] * CHARACTERS + self.first[numbers[1:]]
            at = np.searchsorted(self.bonds, around)
            joined[1:] = self.bonds[np.minimum(at, len(self.bonds) - 1)] == around
        joined[starts] = False
        if joined.any():  # words that a piece may reach over are one unit, known by its words
            heads = np.flatnonzero(~joined)
            stops = np.append(heads[1:], len(words))
            whole = numbers[heads]
            long = np.flatnonzero(stops - heads > 1)
            whole[long] = [self.units[tuple(words[s:e])] for s, e in zip(heads[long].tolist(), stops[long].tolist())]
            if fresh := self.units.fresh:
                of = np.array([self.units[w] for unit in fresh for w in unit])
                n = np.array([len(unit) for unit in fresh])
                n_a = np.add.reduceat(self.n_a[of], np.cumsum(n) - n)
                self.learn(["".join(unit) for unit in fresh], self.a_ids[spread(self.a_start[of], self.n_a[of])], n_a)
                self.units.fresh = []
            return whole, np.add.reduceat((~joined).astype(np.int64), starts)
        return numbers, np.diff(ends, prepend=0)

    def align(self, texts: list[str]) -> list[tuple[int, int, int, str, bytes]]:
        """Of each text: tokens of both sides, groups, the digest of the groups, and the links' codes."""
        out = [(0, 0, 0, "", b"")] * len(texts)
        some = [i for i, t in enumerate(texts) if t]
        if not some:
            return out
        units, counts = self.cut([texts[i] for i in some])
        stops = np.cumsum(counts)
        n_a, n_b, n_links = (np.add.reduceat(n[units], stops - counts) for n in (self.n_a, self.n_b, self.n_links))
        good = np.minimum.reduceat(self.good[units], stops - counts)
        codes = self.links[spread(self.link_start[units], self.n_links[units])]
        ends, numbers = np.cumsum(n_links), units.tolist()
        for i, fine, s, e, na, nb, n, end in zip(some, *(x.tolist() for x in (good, stops - counts, stops, n_a, n_b, n_links, ends))):
            if fine:
                groups = b"".join(map(self.groups.__getitem__, numbers[s:e]))
                out[i] = na, nb, n, hashlib.sha256(memoryview(groups)[:-1]).hexdigest(), codes[end - n : end].tobytes()
        return out


def same_bytes(tokens: list[bytes], lengths: np.ndarray, ids: np.ndarray, counts: np.ndarray, raw: list[bytes]) -> np.ndarray:
    """Whether the joined bytes of each item's tokens are the item's."""
    stops = np.cumsum(counts)
    ends = np.concatenate([[0], np.cumsum(lengths[ids])])
    same = ends[stops] - ends[stops - counts] == np.array([len(r) for r in raw])
    joined = list(map(tokens.__getitem__, ids.tolist()))
    if same.all() and b"".join(joined) == b"".join(raw):
        return same
    return np.array([b"".join(joined[s:e]) == r for s, e, r in zip((stops - counts).tolist(), stops.tolist(), raw)])


def code_type(n: int) -> str:
    """The type of a pair's code, of ``n`` possible ones: four bytes where they suffice."""
    return "<u4" if n <= 1 << 32 else "<i8"


@functools.lru_cache(maxsize=1)
def aligner(bpe_path: str, piece_path: str) -> Aligner:
    return Aligner(bpe_path, piece_path)


def common_ends(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of the tokens of both sides that end together, for ascending ends with the same last one."""
    raw_a, raw_b = a.astype("<i8").tobytes(), b.astype("<i8").tobytes()
    list_a, list_b = a.tolist(), b.tolist()
    n, m = len(list_a), len(list_b)
    starts_a: list[int] = []
    starts_b: list[int] = []
    lengths: list[int] = []
    i = j = 0
    while i < n and j < m:
        # along the diagonal: most stretches are short, so the first ends are compared one by one; then windows of doubling
        # length, the first unlike one halved down to its first difference
        run, width, left = 0, SHORT, min(n - i, m - j)
        first = min(SHORT, left)
        while run < first and list_a[i + run] == list_b[j + run]:
            run += 1
        while SHORT <= run < left:
            w = min(width, left - run)
            p, q = (i + run) * 8, (j + run) * 8
            if raw_a[p : p + w * 8] == raw_b[q : q + w * 8]:
                run += w
                width *= 2
                continue
            while w > 1:
                half = w >> 1
                if raw_a[p : p + half * 8] == raw_b[q : q + half * 8]:
                    run, w = run + half, w - half
                    p, q = p + half * 8, q + half * 8
                else:
                    w = half
            break
        if run:
            starts_a.append(i)
            starts_b.append(j)
            lengths.append(run)
            i += run
            j += run
        # one irregular group: the smaller end advances until both meet
        while i < n and j < m:
            x, y = list_a[i], list_b[j]
            if x < y:
                i += 1
            elif y < x:
                j += 1
            else:  # where both meet the next run starts, with the shift of the new place
                break
    length = np.array(lengths, np.int64)
    return spread(np.array(starts_a, np.int64), length), spread(np.array(starts_b, np.int64), length)


def group_order(width: int, a: np.ndarray, b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray) -> np.ndarray:
    """The ids of all groups as ``a1,a2|b1;a3|b2,b3;`` has them: numbers of names, which are every A id (of ``width``) before a comma and a bar, then every B id before a comma and a semicolon."""
    last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    last_a[at_a] = last_b[at_b] = 1
    # a token stands behind all tokens of its side before it, and behind the other side's of its earlier groups (A) or of its group too (B)
    before_a = np.concatenate([[0], at_b + 1])[np.cumsum(last_a) - last_a]
    before_b = np.concatenate([at_a + 1, [len(a)]])[np.cumsum(last_b) - last_b]
    flat = np.empty(len(a) + len(b), np.int64)
    flat[np.arange(len(a)) + before_a] = 2 * a + last_a
    flat[np.arange(len(b)) + before_b] = 2 * (width + b) + last_b
    return flat


def align(docs: DataFrame, bpe_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document, with its links as codes: A id · number of B ids + B id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tools = aligner(bpe_path, piece_path)
        task, number, size = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for start, end in slices(pc.binary_length(batch.column(1)).to_pylist(), BATCH_BYTES):
                texts = batch.column(1).slice(start, end - start).to_pylist()
                rows = []
                for doc_id, (n_a, n_b, n, digest, codes) in zip(ids[start:end], tools.align(texts)):
                    if size >= BLOCK_BYTES:
                        number, size = number + 1, 0
                    rows.append((f"{task}-{number}", doc_id, n_a, n_b, n, n, digest, codes))
                    size += 64 + len(codes)
                kinds = [pa.string(), *[pa.int64()] * 5, pa.string(), pa.binary()]
                yield pa.record_batch([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names=[c.split(" ")[0] for c in ALIGNED.split(", ")])
        tools.clear()
        give_back()

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), empty_if_null(text_col).alias("text")).mapInArrow(run, ALIGNED)


def block_pairs(aligned: DataFrame, code_kind: str) -> DataFrame:
    """``block, code, links``: the sums of each block's pairs. A block's documents stand together in one file."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, codes, size = None, [], 0

        def flush() -> pa.RecordBatch:
            nonlocal codes, size
            code, links = np.unique(np.concatenate(codes), return_counts=True)
            codes, size = [], 0
            return pa.record_batch([pa.array([block] * len(code), pa.string()), pa.array(code.astype(np.int64)), pa.array(links, pa.int64())], names=["block", "code", "links"])

        for batch in batches:
            for name, c in zip(*(batch.column(i).to_pylist() for i in range(2))):
                if codes and (name != block or size >= BLOCK_BYTES):
                    yield flush()
                block = name
                if c:
                    codes.append(np.frombuffer(c, code_kind))
                    size += len(c)
        if codes:
            yield flush()

    found = aligned.select("block", "codes").mapInArrow(add, "block string, code bigint, links bigint")
    return materialise(found, "block-pairs")


def pair_counts(blocks: DataFrame, width: int) -> DataFrame:
    """``code, count, best``: links of every pair in the corpus, and whether no pair with its B id has more."""
    counts = materialise(blocks.groupBy("code").agg(F.sum("links").alias("count")).withColumn("b", F.col("code") % width), "pair-counts")
    highest = counts.groupBy("b").agg(F.max("count").alias("highest"))
    return materialise(counts.join(highest, "b").select("code", "count", (F.col("count") == F.col("highest")).alias("best")), "pairs")


def token_alignment(docs: DataFrame, bpe_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``."""
    aligned = materialise(align(docs, bpe_path, piece_path, id_col, text_col), "aligned")
    width = sentencepiece.SentencePieceProcessor(model_file=piece_path).get_piece_size()
    code_kind = code_type(ByteBpe(bpe_path).size * width)
    blocks = block_pairs(aligned, code_kind)
    known = pair_counts(blocks, width)
    wanted = blocks.select("block", "code").distinct().join(known, "code")
    tables = wanted.groupBy("block").agg(F.collect_list(F.struct("code", "count", "best")).alias("pairs"))
    whole = "doc_id", "n_a", "n_b", "n_groups", "n_links"

    def look_up(docs: pa.Table, tables: pa.Table) -> pa.Table:
        code = count = best = np.zeros(0, np.int64)
        if tables.num_rows:
            flat = tables["pairs"].combine_chunks().flatten()
            code, count, best = (flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3))
            order = np.argsort(code)
            code, count, best = code[order], count[order], best[order]
        n_best, sums = [], []
        for c in docs["codes"].to_pylist():
            at = np.searchsorted(code, np.frombuffer(c, code_kind))
            n_best.append(int(best[at].sum()) if len(at) else 0)
            sums.append(int(count[at].sum()) if len(at) else 0)
        return pa.table([*[docs[c] for c in whole], pa.array(n_best, pa.int64()), pa.array(sums, pa.int64()), docs["groups_sha256"]], names=[*whole, "n_best", "count_sum", "groups_sha256"])

    schema = ", ".join(f"{c} bigint" for c in (*whole, "n_best", "count_sum")) + ", groups_sha256 string"
    return aligned.groupBy("block").cogroup(tables.groupBy("block")).applyInArrow(look_up, schema)
