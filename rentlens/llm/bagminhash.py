"""Near-duplicate classes by weighted Jaccard similarity of the multisets of word shingles, found with BagMinHash.

A shingle with weight w owns the interval [0, w), cut into the dyadic pieces [0,1), [1,2), [2,4), ...; each piece has a
Poisson process of points (time, signature position, place in the piece) that depends on the shingle alone. A document
sees the points of its pieces, of a piece cut short those whose place lies below w. The earliest point of each
signature position is the signature. Two documents agree in a position with the probability of their weighted Jaccard
similarity. A document takes points up to a time that usually fills all positions, and goes on where one is empty, so
its cost is about its shingles plus m log m, not their product.

Bands of the signature propose candidates: texts that share a band value are joined to one hub, and the components of
that graph are verified on the real multisets. Components of at most ``BLOCK`` texts are compared whole in one task
(many small ones together). Of a larger one, first all texts go that cannot have a partner, because more than
1 - threshold of their weight is on shingles that no other text of the component has. The rest is compared in blocks,
each with the same few pivots; texts that are not joined to the largest class by then are compared with all blocks. So
no link between different texts is lost once a band proposed it, and no group is expanded into all its pairs. With 32
bands of 5 a pair at 0.8 is missed with probability 3e-6.

Words are separated by ASCII white space, letters lower-cased. Defined cases: a null text counts as empty; texts equal
after that form one node whatever their length; a text of fewer than five words has one shingle, all its words; empty
texts are copies of each other and near no other; a null id is larger than any other; the table may be empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentlens.llm.common import SPACE, attach, empty_if_null, give_back, materialise
from rentlens.llm.graph import components

WORDS, THRESHOLD = 5, 0.8
BANDS, ROWS = 32, 5
BLOCK, PIVOTS = 512, 16
BATCH_CHARS = 4 << 20
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that scatters them."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * GOLDEN)
PLACE = mixed(np.arange(1000, 1000 + 4096, dtype=np.uint64) * GOLDEN) | np.uint64(1)


def word_hashes(text: bytes) -> np.ndarray:
    """One 64-bit hash per word of a text whose words are separated by single spaces."""
    if not text:
        return np.zeros(0, np.uint64)
    raw = np.frombuffer(text + b" ", np.uint8)
    ends = np.flatnonzero(raw == 32) + 1
    starts = np.concatenate([[0], ends[:-1]])
    place = np.arange(len(raw)) - np.repeat(starts, ends - starts)
    values = BYTE[raw] * PLACE[place & 4095] + (place >> 12).astype(np.uint64)
    return mixed(np.add.reduceat(values, starts))


def shingle_bag(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles (sorted hashes) and how often each occurs."""
    words = word_hashes(text)
    if not len(words):
        return words, np.zeros(0, np.int64)
    n = min(WORDS, len(words))
    total = np.zeros(len(words) - n + 1, np.uint64)
    for i in range(n):
        total = total * np.uint64(0x100000001B3) + words[i : len(words) - n + 1 + i]
    return np.unique(mixed(total + np.uint64(n)), return_counts=True)


def signatures(bags: list[tuple[np.ndarray, np.ndarray]], m: int = BANDS * ROWS) -> np.ndarray:
    """BagMinHash signatures, one row of ``m`` 64-bit numbers per bag; of an empty bag all zeros."""
    sizes = np.array([len(b[0]) for b in bags])
    doc = np.repeat(np.arange(len(bags)), sizes)
    shingle = np.concatenate([b[0] for b in bags]) if len(bags) else np.zeros(0, np.uint64)
    weight = np.concatenate([b[1] for b in bags]) if len(bags) else np.zeros(0, np.int64)
    total = np.array([b[1].sum() for b in bags], np.float64)
    parts, level = [], 0
    some = np.arange(len(shingle))
    while len(some):  # piece 0 is [0, 1), piece j is [2^(j-1), 2^j)
        low, high = (0, 1) if level == 0 else (1 << (level - 1), 1 << level)
        some = some[weight[some] > low]
        parts.append((doc[some], mixed(shingle[some] + PLACE[level]), np.full(len(some), high - low), np.minimum(weight[some], high) - low))
        level += 1
    owner, seed, length, seen = (np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64) for i in range(4))
    best, value = np.full(len(bags) * m, np.inf), np.zeros(len(bags) * m, np.uint64)
    until = (np.log(m) + 3.0) / np.maximum(total, 1)
    step = np.zeros(len(seed), np.uint64)
    draw = mixed(seed.astype(np.uint64) + GOLDEN)
    time = -np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / (m * length)
    near = np.arange(len(seed))
    while True:
        active = near[time[near] <= until[owner[near]]]
        while len(active):
            mark = mixed(draw[active] ^ np.uint64(0xD6E8FEB86659FD93))
            place = ((mark & np.uint64(0xFFFFFFFF)) * length[active].astype(np.uint64)) >> np.uint64(32)
            inside = place.astype(np.int64) < seen[active]
            at, mine = active[inside], mark[inside]
            slot = owner[at] * m + ((mine >> np.uint64(32)) % np.uint64(m)).astype(np.int64)
            np.minimum.at(best, slot, time[at])
            first = best[slot] == time[at]
            value[slot[first]] = mixed(mine[first])
            step[active] += np.uint64(1)
            draw[active] = mixed(seed[active] + (step[active] + np.uint64(1)) * GOLDEN)
            time[active] -= np.log(((draw[active] >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / (m * length[active])
            active = active[time[active] <= until[owner[active]]]
        short = np.isinf(best.reshape(len(bags), m)).any(axis=1) & (total > 0)
        if not short.any():
            return value.reshape(len(bags), m)
        until[short] *= 1.5
        near = np.flatnonzero(short[owner])


def band_values(signature: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One 64-bit number per band; different bands never share one but by chance."""
    parts = signature.reshape(len(signature), bands, rows)
    out = np.tile(np.arange(1, bands + 1, dtype=np.uint64) * GOLDEN, (len(signature), 1))
    for i in range(rows):
        out = mixed(out ^ parts[:, :, i])
    return out.view(np.int64)


def normalised(text: str) -> Column:
    return F.trim(F.regexp_replace(F.lower(empty_if_null(text)), f"{SPACE}+", " "))


def sketches(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, row, digest, node, bands`` per document; the bands are null where the text is empty or stood before in the batch."""
    schema = pa.schema([("id", pa.int64()), ("row", pa.int64()), ("digest", pa.binary()), ("node", pa.int64()), ("bands", pa.list_(pa.int64()))])

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, texts = batch.column(2).to_pylist(), batch.column(4)
            met: set[bytes] = set()
            bands: list[list[int] | None] = [None] * len(digests)
            waiting: list[tuple[int, bytes]] = []
            size = 0

            def flush() -> None:
                got = band_values(signatures([shingle_bag(t) for _, t in waiting]))
                for (i, _), b in zip(waiting, got):
                    bands[i] = b.tolist()
                waiting.clear()

            for i, d in enumerate(digests):
                if d in met:
                    continue
                met.add(d)
                text = texts[i].as_py()
                if text:
                    waiting.append((i, text))
                    size += len(text)
                if size >= BATCH_CHARS:
                    flush()
                    size = 0
            if waiting:
                flush()
            yield pa.record_batch([*(batch.column(i) for i in range(4)), pa.array(bands, schema.field("bands").type)], schema=schema)
        give_back()

    plain = docs.select(F.col(id_col).cast("bigint").alias("id"), F.monotonically_increasing_id().alias("row"), normalised(text_col).alias("text"))
    keyed = plain.select("id", "row", F.unhex(F.md5("text")).alias("digest"), F.xxhash64("text").alias("node"), F.col("text").cast("binary").alias("text"))
    return keyed.mapInArrow(sketch, "id bigint, row bigint, digest binary, node bigint, bands array<bigint>")


def candidate_components(sketched: DataFrame) -> DataFrame:
    """``node, label``: texts joined by shared band values, each band value as a star around its smallest node."""
    rows = sketched.filter("bands IS NOT NULL").select("node", F.explode("bands").alias("band"))
    hubs = rows.groupBy("band").agg(F.min("node").alias("hub"), F.max("node").alias("other")).filter("hub < other").select("band", "hub")
    hubs = materialise(hubs, "hubs")
    return components(rows.join(hubs, "band").select(F.col("node").alias("u"), F.col("hub").alias("v")))


def similar_pairs(bags: list[tuple[np.ndarray, np.ndarray]], probe: np.ndarray, store: np.ndarray, threshold: float) -> Iterator[tuple[int, np.ndarray]]:
    """For each probing bag the storing bags with a weighted Jaccard similarity of at least ``threshold``."""
    sizes = np.array([len(b[0]) for b in bags])
    total = np.array([b[1].sum() for b in bags], np.int64)
    doc = np.repeat(np.arange(len(bags)), sizes)
    _, term = np.unique(np.concatenate([b[0] for b in bags]), return_inverse=True)
    weight = np.concatenate([b[1] for b in bags])
    starts = np.cumsum(sizes) - sizes
    order = np.argsort(term, kind="stable")
    order = order[store[doc[order]]]
    bounds = np.searchsorted(term[order], np.arange(term.max() + 2)) if len(term) else np.zeros(1, np.int64)
    for i in np.flatnonzero(probe):
        mine = np.arange(starts[i], starts[i] + sizes[i])
        a, n = bounds[term[mine]], bounds[term[mine] + 1] - bounds[term[mine]]
        ends = np.cumsum(n)
        at = order[np.repeat(a - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)]
        shared = np.bincount(doc[at], weights=np.minimum(weight[at], np.repeat(weight[mine], n)), minlength=len(bags))
        # exact in whole numbers: shared / (|A| + |B| - shared) >= threshold
        found = np.flatnonzero(shared * (1 + threshold) >= threshold * (total[i] + total) - 1e-9)
        yield i, found[(found != i) & (total[found] > 0)]


def links_in(group: pa.Table, threshold: float) -> pa.Table:
    """Links of one task's texts: a spanning forest of what is similar, texts of one ``label`` counting as joined."""
    bags = [shingle_bag(t) for t in group.column("text").to_pylist()]
    digests = group.column("digest").to_pylist()
    boss = list(range(len(bags)))

    def root(i: int) -> int:
        while boss[i] != i:
            boss[i] = boss[boss[i]]
            i = boss[i]
        return i

    first: dict[bytes, int] = {}
    for i, key in enumerate(group.column("label").to_pylist()):
        boss[root(i)] = root(first.setdefault(key, i))
    u, v = [], []
    flags = [np.array(group.column(c).to_pylist(), bool) for c in ("probe", "store")]
    for i, found in similar_pairs(bags, *flags, threshold):
        for j in found.tolist():
            if (a := root(i)) != (b := root(j)):
                boss[a] = b
                u.append(digests[i])
                v.append(digests[j])
    return pa.table({"u": pa.array(u, pa.binary()), "v": pa.array(v, pa.binary())})


def verified(tasks: DataFrame, threshold: float) -> DataFrame:
    """``tasks`` (task, digest, label, probe, store, text) -> links (u, v) of digests."""
    columns = tasks.select("task", "digest", "label", "probe", "store", F.col("text").cast("binary").alias("text"))
    return columns.groupBy("task").applyInArrow(lambda group: links_in(group, threshold), "u binary, v binary")


def without_partner(large: DataFrame, threshold: float) -> DataFrame:
    """Digests of ``large`` (comp, digest, text) whose weight is too much on shingles that no other text of the component has."""

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for comp, digest, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                shingle, weight = shingle_bag(text.as_py())
                n, total = len(shingle), int(weight.sum())
                yield pa.record_batch([pa.array([comp] * n, pa.int64()), pa.array(shingle.view(np.int64)), pa.array(weight, pa.int64()), pa.array([digest] * n, pa.binary()), pa.array([total] * n, pa.int64())], names=["comp", "term", "weight", "digest", "total"])

    rows = large.select("comp", "digest", F.col("text").cast("binary")).mapInArrow(terms, "comp bigint, term bigint, weight bigint, digest binary, total bigint")
    alone = rows.groupBy("comp", "term").agg(F.count(F.lit(1)).alias("n"), F.first("weight").alias("weight"), F.first("digest").alias("digest"), F.first("total").alias("total")).filter("n = 1")
    lost = alone.groupBy("digest").agg(F.sum("weight").alias("lost"), F.first("total").alias("total"))
    return lost.filter(F.col("lost") > (1 - threshold) * F.col("total") + 1e-9).select("digest")


def near_links(docs: DataFrame, nodes: DataFrame, comps: DataFrame, id_col: str, text_col: str, threshold: float) -> DataFrame:
    """Links (u, v) between digests whose similarity reaches the threshold, enough to join every class."""
    sizes = materialise(comps.groupBy("label").agg(F.count(F.lit(1)).alias("size")), "component-sizes")
    members = attach(comps, sizes, "label", "size").join(nodes, "node").select("node", F.col("label").alias("comp"), "size", "digest", "rep")
    members = materialise(members, "members")
    texts = docs.select(F.col(id_col).cast("bigint").alias("_id"), normalised(text_col).alias("text"))
    texts = texts.select("_id", "text", F.xxhash64("text").alias("_node"))
    found = members.hint("shuffle_hash").join(texts, (F.col("node") == F.col("_node")) & F.col("rep").eqNullSafe(F.col("_id"))).filter(F.unhex(F.md5("text")) == F.col("digest"))
    found = materialise(found.select("comp", "size", "digest", "text").dropDuplicates(["digest"]), "candidates")
    small, large = found.filter(F.col("size") <= BLOCK), found.filter(F.col("size") > BLOCK)
    rows = small.count()
    yes, no = F.lit(True), F.lit(False)
    whole = small.select(F.concat(F.lit("s"), F.pmod(F.xxhash64("comp"), F.lit(rows // BLOCK + 1))).alias("task"), "digest", F.col("digest").alias("label"), yes.alias("probe"), yes.alias("store"), "text")
    links = materialise(verified(whole, threshold), "links")
    if large.isEmpty():
        return links
    large = large.join(materialise(without_partner(large, threshold), "without-partner"), "digest", "left_anti")
    counts = large.groupBy("comp").agg(F.count(F.lit(1)).alias("left"))
    large = materialise(large.join(counts, "comp").withColumn("blocks", F.ceil(F.col("left") / BLOCK)), "large")
    block = F.pmod(F.xxhash64("digest"), F.col("blocks"))
    pivot = F.pmod(F.xxhash64("digest", F.lit("pivot")), F.col("left")) < PIVOTS
    own = large.select(F.concat_ws(":", "comp", block).alias("task"), "digest", F.col("digest").alias("label"), yes.alias("probe"), yes.alias("store"), "text")
    fixed = large.filter(pivot).select("comp", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("b"), "digest", "text", block.alias("mine"))
    fixed = fixed.filter("b <> mine").select(F.concat_ws(":", "comp", "b").alias("task"), "digest", F.col("digest").alias("label"), no.alias("probe"), yes.alias("store"), "text")
    inner = materialise(verified(own.unionByName(fixed), threshold), "links")
    # what is not in the largest class of its component yet meets every block
    labels = components(inner).withColumnRenamed("node", "digest")
    large = large.join(labels, "digest", "left").withColumn("label", F.coalesce("label", "digest"))
    large = materialise(large, "labelled")
    main = large.groupBy("comp", "label").count().groupBy("comp").agg(F.max_by("label", F.struct("count", "label")).alias("main"))
    rest = large.join(main, "comp").filter("label <> main AND blocks > 1")
    left_over = rest.groupBy("comp").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("parts"))
    rest = materialise(rest.drop("main").join(left_over, "comp"), "left-over")
    every = large.join(materialise(left_over, "left-over-counts"), "comp")
    part = F.pmod(F.xxhash64("digest", F.lit("part")), F.col("parts"))
    stores = every.select("comp", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("p"), block.alias("b"), "digest", "label", no.alias("probe"), yes.alias("store"), "text")
    probes = rest.select("comp", part.alias("p"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("b"), "digest", "label", yes.alias("probe"), no.alias("store"), "text")
    crossed = stores.unionByName(probes).withColumn("task", F.concat_ws(":", "comp", "p", "b"))
    return links.unionByName(inner).unionByName(materialise(verified(crossed, threshold), "links"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: ``id, digest, class_id`` (smallest id of its class), ``class_size``, ``kept`` (one row of each class)."""
    sketched = materialise(sketches(docs, id_col, text_col), "sketches")
    nodes = sketched.groupBy("digest", "node").agg(F.min("id").alias("rep"), F.coalesce(F.min_by("row", "id"), F.min("row")).alias("rep_row"), F.count(F.lit(1)).alias("n"))
    nodes = materialise(nodes, "nodes")
    comps = materialise(candidate_components(sketched), "candidate-components")
    labels = components(near_links(docs, nodes, comps, id_col, text_col, threshold)).withColumnRenamed("node", "digest")
    nodes = materialise(nodes.join(labels, "digest", "left").withColumn("label", F.coalesce("label", "digest")), "labelled-nodes")
    classes = nodes.groupBy("label").agg(
        F.min("rep").alias("class_id"), F.coalesce(F.min_by("rep_row", "rep"), F.min("rep_row")).alias("keep_row"), F.sum("n").alias("class_size"), F.count(F.lit(1)).alias("texts")
    )
    of_text = attach(nodes.select("digest", "label", "n"), materialise(classes, "classes"), "label", "texts").select("digest", "n", "class_id", "keep_row", "class_size")
    found = attach(sketched.select("id", "row", "digest"), materialise(of_text, "class-of-text"), "digest", "n")
    return found.select("id", "digest", "class_id", "class_size", (F.col("row") == F.col("keep_row")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one document of each class; of rows repeated with one id and text one stays. Texts meet in one join."""
    kept = near_duplicates(docs, id_col, text_col, threshold).filter("kept").select(F.col("id").alias("__near_id"), F.col("digest").alias("__near_digest"))
    keyed = docs.withColumn("__near_text", F.unhex(F.md5(normalised(text_col))))
    found = keyed.join(materialise(kept, "kept").hint("shuffle_hash"), F.col(id_col).cast("bigint").eqNullSafe(F.col("__near_id")) & (F.col("__near_text") == F.col("__near_digest")))
    return found.dropDuplicates(["__near_id", "__near_digest"]).select(*docs.columns)
