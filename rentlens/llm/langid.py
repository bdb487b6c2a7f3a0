"""Language identification by the nearest of several centroids per language.

Texts become normalised TF-IDF vectors of hashed character n-grams (letters only, lower-cased). Document frequencies
are counted over all training documents. The centroids of a language are fitted by spherical k-means on a bounded
sample: about ``sample_per_lang`` training documents per language, taken by a hash of id and text, equal rows once, each sent as a vector of
at most ``FEATURES`` entries. A text gets the language of the most similar centroid (cosine), and is rejected when that
similarity is far below what training texts of that language and length reach. Keys and encoded data among other words
are left out; a text that holds nothing else is taken as it is, so every text with a letter gets a language.

Defined cases: a null text or one without a letter is ``und`` with score 0 and is rejected; a text of training language
null or of blanks only is not trained on; without any training document everything is ``und``; other columns of the
input stay, except those named as an output, which are replaced.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from rentlens.llm.common import give_back, materialise

FEATURES = 1 << 13
ORDERS = (1, 2, 3)
CENTROIDS = 4
SAMPLE_PER_LANG = 1000
BATCH_CHARS = 1 << 20
UNKNOWN = "und"
#: A text is rejected below this share of the similarity that 99 % of the sampled texts of its language and length reach.
FLOOR_SHARE = 0.5
#: Keys and encoded data, which are no words: of ASCII letters and digits standing alone, those that mix both, and runs of
#: over 30 base64 characters that hold a digit or a capital after a small letter.
KEY = re.compile(r"(?<![^\W_])(?=[A-Za-z]*\d[A-Za-z0-9]*[A-Za-z]|[A-Za-z]+\d)[A-Za-z0-9]++(?![^\W_])|(?<![A-Za-z0-9+/=])(?=[A-Za-z0-9+/=]*?(?:\d|[a-z][A-Z]))[A-Za-z0-9+/=]{31,}+")
PRIMES = np.array([2654435761, 2246822519, 3266489917, 668265263], np.uint32)


@functools.lru_cache(maxsize=1)
def letter_table() -> np.ndarray:
    """Lower-cased code point of each letter below 65536, else a space."""
    low = np.full(0x10000, 32, np.uint32)
    for c in range(0x10000):
        if chr(c).isalpha():
            low[c] = ord(chr(c).lower()[0])
    return low


def letters(text: str) -> np.ndarray:
    """Letters lower-cased, each run of other characters as one space, framed by spaces."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    low = letter_table()[np.minimum(points, 0xFFFF)]
    high = np.flatnonzero(points > 0xFFFF)
    for c in np.unique(points[high]):
        low[points == c] = ord(chr(c).lower()[0]) if chr(c).isalpha() else 32
    low = np.concatenate([[32], low, [32]]).astype(np.uint32)
    return low[np.concatenate([[True], (low[1:] != 32) | (low[:-1] != 32)])]


def gram_counts(text: str) -> np.ndarray | None:
    """Counts of the hashed n-grams of the words, without keys if there are other words; None without a letter."""
    c = letters(KEY.sub(" ", text))
    if not (c != 32).any():
        c = letters(text)
    if not (c != 32).any():
        return None
    buckets = []
    with np.errstate(over="ignore"):
        for n in ORDERS:
            m = len(c) - n + 1
            if m > 0:
                h = np.full(m, n * 374761393, np.uint32)
                for i in range(n):
                    h = (h ^ (c[i : i + m] * PRIMES[i])) * np.uint32(2246822519)
                    h ^= h >> np.uint32(15)
                buckets.append(h >> np.uint32(32 - 13))
    return np.bincount(np.concatenate(buckets), minlength=FEATURES)


def tfidf(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows of counts as unit rows."""
    v = np.log1p(counts.astype(np.float32)) * idf
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)


def length_class(counts: np.ndarray) -> int:
    return int(counts.sum()).bit_length()


@dataclass
class Model:
    """``centroids``: (languages · k, FEATURES); ``floor``: least similarity by language and length class."""

    langs: list[str]
    owner: np.ndarray
    centroids: np.ndarray
    idf: np.ndarray
    floor: np.ndarray

    def predict(self, texts: list[str]) -> tuple[list[str], list[float], list[bool]]:
        lang, score, rejected = [UNKNOWN] * len(texts), [0.0] * len(texts), [True] * len(texts)
        counts = [gram_counts(t) for t in texts]
        some = [i for i, c in enumerate(counts) if c is not None]
        if not self.langs:
            return lang, score, [c is None for c in counts]
        for a in range(0, len(some), 256):
            part = some[a : a + 256]
            near = tfidf(np.stack([counts[i] for i in part]), self.idf) @ self.centroids.T
            best = near.argmax(axis=1)
            for i, b, s in zip(part, best.tolist(), near.max(axis=1).tolist()):
                lang[i], score[i] = self.langs[self.owner[b]], min(1.0, max(0.0, s))
                rejected[i] = score[i] < self.floor[self.owner[b], length_class(counts[i])]
        return lang, score, rejected


def spherical_kmeans(vectors: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Unit centroids; the first is the row nearest to the mean, each next one the row farthest from those before."""
    mean = vectors.mean(axis=0)
    picks = [int((vectors @ mean).argmax())]
    near = vectors @ vectors[picks[0]]
    while len(picks) < min(k, len(vectors)):
        picks.append(int(near.argmin()))
        near = np.maximum(near, vectors @ vectors[picks[-1]])
    centroids = vectors[picks].copy()
    for _ in range(rounds):
        own = (vectors @ centroids.T).argmax(axis=1)
        new = np.stack([vectors[own == j].mean(axis=0) if (own == j).any() else centroids[j] for j in range(len(centroids))])
        new /= np.maximum(np.linalg.norm(new, axis=1, keepdims=True), 1e-12)
        if np.allclose(new, centroids, atol=1e-5):
            break
        centroids = new.astype(np.float32)
    return centroids


def floors(low: dict[int, float]) -> np.ndarray:
    """Least similarity by length class. A class without enough samples takes the next shorter one's; below the shortest it falls with the root of the length."""
    floor = np.zeros(64, np.float32)
    for c in range(min(low, default=64), 64):
        floor[c] = FLOOR_SHARE * low[c] if c in low else floor[c - 1]
    for c in range(min(low, default=0) - 1, -1, -1):
        floor[c] = floor[c + 1] * 0.5**0.5
    return floor


def text_slices(batch: pa.Array) -> Iterator[list[str]]:
    """The texts in runs of about ``BATCH_CHARS``."""
    out, size = [], 0
    for value in batch:
        out.append(value.as_py())
        size += len(out[-1])
        if size >= BATCH_CHARS:
            yield out
            out, size = [], 0
    if out:
        yield out


def document_frequencies(train: DataFrame) -> tuple[int, np.ndarray]:
    """Number of training documents and, per feature, of those that hold it; each task sends one summed vector."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, found = 0, np.zeros(FEATURES, np.int64)
        for batch in batches:
            for texts in text_slices(batch.column(0)):
                for t in texts:
                    if (c := gram_counts(t)) is not None:
                        total += 1
                        found += c > 0
        give_back()
        yield pa.record_batch([pa.array([total], pa.int64()), pa.array([found.tolist()], pa.list_(pa.int64()))], names=["total", "found"])

    parts = train.select("text").mapInArrow(partial, "total bigint, found array<bigint>")
    parts = materialise(parts, "document-frequencies")
    total = parts.agg(F.sum("total")).first()[0] or 0
    rows = parts.select(F.posexplode("found").alias("at", "n")).groupBy("at").agg(F.sum("n").alias("n")).collect()
    df = np.zeros(FEATURES, np.int64)
    for r in rows:
        df[r["at"]] = r["n"]
    return total, df


def train_model(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", sample_per_lang: int = SAMPLE_PER_LANG, centroids: int = CENTROIDS) -> Model:
    """Fits on the rows with a text and a language. The driver gets counts per language and the centroids."""
    train = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"), F.xxhash64(id_col, text_col).alias("draw"))
    train = train.filter("text IS NOT NULL AND lang IS NOT NULL AND trim(lang) <> ''")
    total, df = document_frequencies(train)
    idf = (np.log((1 + total) / (1 + df)) + 1).astype(np.float32)
    sizes = train.select("lang", "draw").distinct().groupBy("lang").count()
    rate = F.pmod("draw", F.lit(1 << 30)).cast("double") / float(1 << 30)
    drawn = train.join(F.broadcast(sizes), "lang").filter(rate * F.col("count") < sample_per_lang)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, draw, at, n = [], [], [], []
            for name, d, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if (c := gram_counts(text.as_py())) is not None:
                    some = np.flatnonzero(c)
                    lang.append(name)
                    draw.append(d)
                    at.append(some.astype("<u2").tobytes())
                    n.append(c[some].astype("<u4").tobytes())
            yield pa.record_batch([pa.array(lang, pa.string()), pa.array(draw, pa.int64()), pa.array(at, pa.binary()), pa.array(n, pa.binary())], names=["lang", "draw", "at", "n"])

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["draw", "at", "n"])
        dense = np.zeros((len(rows), FEATURES), np.float32)
        for i, (at, n) in enumerate(zip(rows["at"], rows["n"])):
            dense[i, np.frombuffer(at, "<u2")] = np.frombuffer(n, "<u4")
        lengths = [length_class(d) for d in dense.astype(np.int64)]
        dense = tfidf(dense, idf)
        middle = spherical_kmeans(dense, centroids)
        near = (dense @ middle.T).max(axis=1)
        low = {c: float(np.quantile(near[np.array(lengths) == c], 0.01)) for c in set(lengths) if lengths.count(c) >= 20}
        if not low and len(rows) >= 20:
            low = {min(lengths): float(np.quantile(near, 0.01))}
        return pd.DataFrame({"lang": rows["lang"].iloc[0], "centroid": [m.tobytes() for m in middle], "low": [low] * len(middle)})

    fitted = drawn.select("lang", "draw", "text").mapInArrow(vectors, "lang string, draw bigint, at binary, n binary").dropDuplicates(["lang", "draw"])
    fitted = fitted.groupBy("lang").applyInPandas(fit, "lang string, centroid binary, low map<int,double>").collect()
    fitted.sort(key=lambda r: (r["lang"], r["centroid"]))
    langs = sorted({r["lang"] for r in fitted})
    own = {r["lang"]: floors(r["low"]) for r in fitted}
    # a language of too few documents takes the lowest limit of the others
    known = [f for f in own.values() if f.any()]
    lowest = np.min(known, axis=0) if known else np.zeros(64, np.float32)
    floor = np.array([own[name] if own[name].any() else lowest for name in langs], np.float32).reshape(-1, 64)
    matrix = np.stack([np.frombuffer(r["centroid"], np.float32) for r in fitted]) if fitted else np.zeros((0, FEATURES), np.float32)
    return Model(langs, np.array([langs.index(r["lang"]) for r in fitted], np.int64), matrix, idf, floor)


def predict(docs: DataFrame, model: Model, text_col: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (cosine, 0 to 1) and ``rejected``; reads nothing but the text. ``prefix`` stands before the names."""

    @arrow_udf("struct<lang_pred:string,score:double,rejected:boolean>")
    def nearest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            lang, score, rejected = [], [], []
            for texts in text_slices(batch):
                got = model.predict(texts)
                lang += got[0]
                score += got[1]
                rejected += got[2]
            yield pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())], ["lang_pred", "score", "rejected"])
        give_back()

    found = docs.withColumn("__lang_found", nearest(F.coalesce(F.col(text_col), F.lit(""))))
    return found.withColumns({prefix + c: F.col(f"__lang_found.{c}") for c in ("lang_pred", "score", "rejected")}).drop("__lang_found")


def held_out(id_col: str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves 2 on division by 4; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 4 == 2
