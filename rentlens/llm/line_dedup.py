"""Line deduplication over a corpus: frequent long lines stay only in the largest document id that holds them.

Each task splits its texts, keys every line by a 128-bit digest and folds the occurrences inside one document to one
row with all their positions. Rows are range-partitioned on (digest, document), so even a line found in a third of all
documents spreads over many tasks, and sorted by digest, document (descending) and position. One pass streams over each
partition: the first document of a digest is the one that keeps the line, the others lose it once enough documents are
seen. Only the first and the last digest of a partition can go on in another one; for these the pass leaves a summary
each, at most two rows a partition, whose sums decide the rows left open. What comes back is a compressed bitmap per
document of the lines to keep; the texts meet it in one join.

Defined cases: a null or empty text is one empty line; keys under ``min_chars`` code points are never dropped; rows with
one document id count as one document, a null id is a document smaller than any other; a text that loses all its lines
becomes empty; other columns of the input stay, except those named as an output, which are replaced.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from rentlens.llm.common import empty_if_null, give_back, materialise, shuffle_partitions

MIN_CHARS, MIN_DOCS = 40, 5
DROP, OPEN, SUMMARY = 0, 1, 2
LINES = "digest binary, doc bigint, text_key bigint, pos int, n_lines int, at binary"
DECIDED = "kind int, digest binary, doc bigint, text_key bigint, n_lines int, at binary, n bigint"
ROWS = 20_000


def line_key(line: bytes) -> bytes:
    """Without ASCII white space at both ends, A-Z lower-cased."""
    return line.strip(b" \t\n\x0b\x0c\r").lower()


def long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode("utf-8", "replace")) >= min_chars)


def line_rows(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """One row per (line key, document): the first position, the number of lines and all positions (little-endian int32)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("digest", pa.binary()), ("doc", pa.int64()), ("text_key", pa.int64()), ("pos", pa.int32()), ("n_lines", pa.int32()), ("at", pa.binary())])
        out: list[tuple] = []
        for batch in batches:
            for doc, key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                lines = text.as_py().split(b"\n")
                found: dict[bytes, list[int]] = {}
                for i, line in enumerate(lines):
                    if len(line) >= min_chars and long_enough(k := line_key(line), min_chars):
                        found.setdefault(hashlib.md5(k, usedforsecurity=False).digest(), []).append(i)
                out += [(d, doc, key, at[0], len(lines), np.array(at, "<i4").tobytes()) for d, at in found.items()]
                if len(out) >= ROWS:
                    yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                    out = []
        if out:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
        give_back()

    text = empty_if_null(text_col).cast("binary")
    return docs.select(F.col(id_col).cast("bigint"), F.xxhash64(empty_if_null(text_col)), text).mapInArrow(rows, LINES)


def decide(batches: Iterator[pa.RecordBatch], min_docs: int) -> Iterator[pa.RecordBatch]:
    """Streams over rows sorted by (digest, document descending): see the module's text.

    Held back are only rows of fewer than ``min_docs`` documents of the current digest.
    """
    schema = pa.schema([("kind", pa.int32()), ("digest", pa.binary()), ("doc", pa.int64()), ("text_key", pa.int64()), ("n_lines", pa.int32()), ("at", pa.binary()), ("n", pa.int64())])
    out: list[tuple] = []
    waiting: list[tuple] = []
    current = keeper = last = None
    n, runs = 0, 0
    for batch in batches:
        for digest, doc, key, _, lines, at in zip(*[c.to_pylist() for c in batch.columns]):
            if digest != current:
                if runs == 1:
                    out.append((SUMMARY, current, keeper, None, None, None, n))
                current, keeper, last, n, waiting = digest, doc, doc, 1, []
                runs += 1
            elif doc != last:
                last = doc
                n += 1
            if runs == 1:
                out.append((OPEN, digest, doc, key, lines, at, None))
            elif doc != keeper:
                waiting.append((DROP, digest, doc, key, lines, at, None))
                if n >= min_docs:
                    out += waiting
                    waiting = []
        while len(out) >= ROWS:
            part, out = out[:ROWS], out[ROWS:]
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*part), schema)], schema=schema)
    if current is not None:
        out.append((SUMMARY, current, keeper, None, None, None, n))
        if runs > 1:
            out += [(OPEN, *row[1:]) for row in waiting]
    if out:
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)


@arrow_udf(T.StructType().add("keep", T.BinaryType()).add("n_dropped", T.LongType()))
def keep_bitmap(n_lines: pa.Array, dropped: pa.Array) -> pa.Array:
    """zlib of the packed bits, 1 for a line to keep, and the number of zeros."""
    keep, count = [], []
    for n, parts in zip(n_lines.to_pylist(), dropped.to_pylist()):
        bits = np.ones(n, np.uint8)
        bits[np.frombuffer(b"".join(parts), "<i4")] = 0
        keep.append(zlib.compress(np.packbits(bits).tobytes(), 1))
        count.append(n - int(bits.sum()))
    return pa.StructArray.from_arrays([pa.array(keep, pa.binary()), pa.array(count, pa.int64())], ["keep", "n_dropped"])


def kept_lines(text: bytes, keep: bytes | None) -> bytes:
    if keep is None:
        return text
    lines = text.split(b"\n")
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), count=len(lines))
    return b"\n".join([line for line, bit in zip(lines, bits.tolist()) if bit])


@arrow_udf(T.StringType())
def apply_bitmap(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for text, keep in batches:
        done = [pa.array([], pa.string())]
        for a in range(0, len(text), 500):
            raw = [kept_lines(t.as_py(), k.as_py()) for t, k in zip(text[a : a + 500], keep[a : a + 500])]
            done.append(pa.array(raw, pa.binary()).cast(pa.string()))
        yield pa.concat_arrays(done)
    give_back()


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``doc, text_key, n_lines, n_dropped, keep`` for every document that loses a line; all others keep theirs."""
    order = [F.col("digest").asc(), F.col("doc").desc_nulls_last()]
    lines = materialise(line_rows(docs, id_col, text_col, min_chars), "lines")
    ranged = lines.repartitionByRange(shuffle_partitions(docs.sparkSession), *order).sortWithinPartitions(*order, "pos")
    decided = materialise(ranged.mapInArrow(lambda batches: decide(batches, min_docs), DECIDED), "line-decisions")
    at_ends = decided.filter(F.col("kind") == SUMMARY).groupBy("digest").agg(F.sum("n").alias("docs"), F.max("doc").alias("keeper")).filter(F.col("docs") >= min_docs)
    opened = decided.filter(F.col("kind") == OPEN).join(F.broadcast(at_ends), "digest").filter(~F.col("doc").eqNullSafe(F.col("keeper")))
    drops = decided.filter(F.col("kind") == DROP).select("doc", "text_key", "n_lines", "at").unionByName(opened.select("doc", "text_key", "n_lines", "at"))
    grouped = drops.groupBy("doc", "text_key").agg(F.max("n_lines").alias("n_lines"), F.collect_list("at").alias("_at"))
    return grouped.withColumn("_bits", keep_bitmap("n_lines", "_at")).select("doc", "text_key", "n_lines", "_bits.n_dropped", "_bits.keep")


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, prefix: str = "") -> DataFrame:
    """``docs`` with the kept text in place of the text, and ``n_lines`` (before) and ``n_dropped``, both with ``prefix`` before the name."""
    bitmaps = keep_bitmaps(docs, id_col, text_col, min_chars, min_docs)
    bitmaps = bitmaps.select(F.col("doc").alias("__line_doc"), F.col("text_key").alias("__line_key"), F.col("n_dropped").alias("__line_dropped"), F.col("keep").alias("__line_keep"))
    text = empty_if_null(text_col)
    found = docs.join(bitmaps.hint("shuffle_hash"), F.col(id_col).eqNullSafe(F.col("__line_doc")) & F.xxhash64(text).eqNullSafe(F.col("__line_key")), "left")
    n_lines = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    found = found.withColumns({f"{prefix}n_lines": n_lines.cast("bigint"), f"{prefix}n_dropped": F.coalesce("__line_dropped", F.lit(0)).cast("bigint"), "__line_text": apply_bitmap(text.cast("binary"), F.col("__line_keep"))})
    return found.withColumn(text_col, F.col("__line_text")).drop("__line_doc", "__line_key", "__line_keep", "__line_text", "__line_dropped")
