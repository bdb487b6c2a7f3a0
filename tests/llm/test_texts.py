"""Language ID, fingerprints and the pipeline."""

import base64
import hashlib
import math
import os
import random
import string
import tempfile
import zlib
from collections import Counter

import pytest
import regex
import xxhash

import corpus_pipeline
from rentlens.llm import imatch, langid
from rentlens.llm.stages import language_stage

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def table(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


def test_held_out_accuracy(table):
    model = langid.train_model(table.filter(~langid.held_out()))
    rows = langid.predict(table, model).withColumn("held", langid.held_out()).collect()
    for r in rows:
        assert r["held"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1
    held = [r for r in rows if r["held"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.95 * len(held)
    assert not any(r["rejected"] for r in rows)


ITALIAN = """Nel mezzo del cammin di nostra vita mi ritrovai per una selva oscura, che la diritta via era smarrita. Il governo ha annunciato ieri che le nuove regole per le imprese entreranno in vigore dal prossimo anno, mentre gli studenti delle scuole superiori
potranno scegliere tra diversi percorsi di studio. Secondo gli esperti, questa decisione avrebbe conseguenze molto importanti per tutti i cittadini, perché cambierebbe
il modo in cui vengono pagate le tasse e distribuiti i servizi. Nella città vecchia, vicino alla piazza, c'è ancora un piccolo mercato dove si vendono pane, formaggio,
olio e vino della campagna. Ogni mattina gli anziani si siedono davanti al bar e parlano della loro giovinezza, dei figli che lavorano lontano e delle stagioni che non
sono più quelle di una volta."""


def test_other_languages_and_codes_are_rejected(spark, docs):
    """And every labelled document stays, also with a long key in it."""
    r = random.Random(5)
    junk = [ITALIAN, ITALIAN * 4, base64.b64encode(r.randbytes(600)).decode(), "".join(r.choices(string.ascii_lowercase, k=844))]
    junk += [" ".join("".join(r.choices(string.ascii_lowercase, k=r.randint(2, 9))) for _ in range(150))]
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.train_model(table)
    assert [(row["doc_id"], row["score"]) for row in langid.predict(docs(list(enumerate(junk))), model).collect() if not row["rejected"]] == []
    keyed = table.filter("lang IS NOT NULL AND trim(text) <> ''").selectExpr("doc_id", "lang", "text").collect()
    rows = [(d, f"{t} {r.randbytes(120).hex()}", lang, "s", 1) for d, lang, t in keyed]
    assert [x["doc_id"] for x in langid.predict(docs(rows), model).collect() if x["rejected"] or x["lang_pred"] != x["lang"]] == []


def test_sample_is_bounded_for_repeated_ids(docs, table, monkeypatch):
    """Rows that share an id, are equal or have none: each language is learned from about as many rows as asked for."""
    texts = [(x["text"], x["lang"]) for x in table.filter("lang = 'en'").collect()]
    rows = [(None if i % 3 else 7, f"{texts[i % len(texts)][0]} {i}", "en", "s", 1) for i in range(2000)]
    rows += [(9, "un deux trois quatre cinq", "fr", "s", 1)] * 2000 + [(i, f"eins zwei drei {'abcdefghij'[i]}", "de", "s", 1) for i in range(10)]
    kmeans = langid.spherical_kmeans
    folder = tempfile.mkdtemp(prefix="spark-")

    def counted(vectors, k):
        with open(f"{folder}/{random.random()}", "w") as out:
            out.write(str(len(vectors)))
        return kmeans(vectors, k)

    monkeypatch.setattr(langid, "spherical_kmeans", counted)
    model = langid.train_model(docs(rows), sample_per_lang=100)
    taken = sorted(int(open(f"{folder}/{name}").read()) for name in os.listdir(folder))
    assert model.langs == ["de", "en", "fr"] and taken[:2] == [1, 10] and 50 < taken[2] < 200


def test_language_cases(docs, table):
    model = langid.train_model(table)
    df = docs([(1, None), (2, ""), (3, "123 !? \n"), (4, "a"), (5, "漢字かな交じり文" * 300), (None, "the and of the that with"), (7, "the and of " * 60_000), (8, "😀😀")]).selectExpr("*", "0 AS score")
    got = {r["doc_id"]: r for r in langid.predict(df, model).collect()}
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 and got[i]["rejected"] for i in (1, 2, 3, 8))
    assert got[5]["rejected"] and got[5]["lang_pred"] != "und"
    assert got[None]["lang_pred"] == got[7]["lang_pred"] == "en" and not got[7]["rejected"]
    assert langid.predict(df.limit(0), model).count() == 0


MIXED = ["mp3", "COVID19", "我在2024年去了北京参加会议", "2024年は日本に行きました", "rindfleischetikettierungsüberwachungsaufgabenübertragungsgesetz"[:63], "A4", "x1y2z3 " * 50, "été2", "QmFzZTY0" * 40, "①é", "٣ب"]


def test_every_letter_gives_a_language(docs, table):
    """Letters beside digits, scripts without spaces, long compounds and texts of nothing but keys: a learned language, never ``und``."""
    model = langid.train_model(table)
    got = langid.predict(docs(list(enumerate(MIXED))), model).collect()
    assert {r["doc_id"]: r["lang_pred"] for r in got if r["lang_pred"] not in model.langs} == {}
    assert all(langid.gram_counts(t) is not None for t in MIXED)
    prose = "the words of this text are plain and simple"
    assert (langid.gram_counts(f"{prose} a1b2c3d4 {'aB3' * 20}") == langid.gram_counts(prose)).all()
    assert (langid.gram_counts("我在A4纸") != langid.gram_counts("我在纸")).any()


def test_nearest_centroid_by_hand(docs, table):
    """The prediction is the language of the centroid with the highest cosine, all of it computed in plain Python."""
    model = langid.train_model(table)
    texts = [r["text"] for r in table.limit(15).collect() if r["text"]] + MIXED + ["Über den Wolken", "ÇA VA, ÊTES-VOUS LÀ ?"]

    def grams(text):
        chars = [ord(c.lower()[0]) if c.isalpha() else 32 for c in text]
        c = [x for i, x in enumerate([32, *chars, 32]) if x != 32 or i == 0 or [32, *chars, 32][i - 1] != 32]
        out = Counter()
        for n in langid.ORDERS:
            for at in range(len(c) - n + 1):
                h = n * 374761393 & 0xFFFFFFFF
                for i in range(n):
                    h = (h ^ (c[at + i] * int(langid.PRIMES[i]) & 0xFFFFFFFF)) * 2246822519 & 0xFFFFFFFF
                    h ^= h >> 15
                out[h >> 19] += 1
        return out

    got = {r["doc_id"]: r for r in langid.predict(docs(list(enumerate(texts))), model).collect()}
    for i, text in enumerate(texts):
        left = langid.KEY.sub(" ", text)
        counts = grams(left if any(c.isalpha() for c in left) else text)
        v = {g: math.log1p(n) * float(model.idf[g]) for g, n in counts.items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        near = [sum(x * float(c[g]) for g, x in v.items()) / norm for c in model.centroids]
        best = max(range(len(near)), key=near.__getitem__)
        assert got[i]["score"] == pytest.approx(min(1.0, max(0.0, near[best])), abs=1e-4), text[:50]
        assert near[[model.langs[o] for o in model.owner].index(got[i]["lang_pred"])] <= near[best]
        if sorted(near)[-1] - sorted(near)[-2] > 1e-4:
            assert got[i]["lang_pred"] == model.langs[model.owner[best]]


def test_nothing_to_learn_from(docs):
    df = docs([(1, "some text", None, "s", 9), (2, None)])
    model = langid.train_model(df)
    assert model.langs == [] and [(r["lang_pred"], r["rejected"]) for r in langid.predict(df, model).orderBy("doc_id").collect()] == [("und", False), ("und", True)]
    assert langid.train_model(df.limit(0)).langs == []


def test_language_stage_keeps_columns(table):
    df = table.selectExpr("*", "7 AS score")
    out = language_stage(df.sparkSession, df, SF)
    assert out.columns == df.columns and out.count() == table.count() and out.select("score").distinct().collect()[0][0] == 7


def chained(values):
    h = 42
    for v in values:
        h = xxhash.xxh64(v.to_bytes(8, "little", signed=True), seed=h % 2**64).intdigest()
    return h


def signed(u):
    return u - 2**64 if u >= 2**63 else u


def brute(rows, band):
    """Fingerprints and likenesses written out plainly. Spark's xxhash64 chains its arguments as seeds, from 42."""

    def terms(text):
        return {signed(xxhash.xxh64(w.encode(), seed=42).intdigest()) for w in regex.split(r"[^\p{L}\p{N}]+", text.lower()) if w}

    def fields(text):
        inside = sorted(t for t in terms(text) if lo <= df[t] <= hi)
        if not inside:
            return [f"{chained(sorted(terms(text))) & 0xFFFFFFFF:08x}"] + [""] * len(imatch.RATES)
        out = [""]
        for k, power in enumerate(imatch.RATES):
            seed = xxhash.xxh32  # noqa: F841
            mine = [t for t in inside if drawn(k, t, power)]
            out.append(f"{chained(mine) & 0xFFFFFFFF:08x}" if mine else "")
        return out

    def drawn(k, t, power):
        first = xxh_int(k, 42)
        return xxhash.xxh64(t.to_bytes(8, "little", signed=True), seed=first).intdigest() & ((1 << power) - 1) == 0

    def like(a, b):
        if a == b:
            return 1.0
        filled = [(x, y) for x, y in zip(a, b) if x or y]
        return sum(x == y for x, y in filled) / len(filled)

    df = {}
    for _, t in rows:
        for w in terms(t or ""):
            df[w] = df.get(w, 0) + 1
    lo, hi = band[0] * len(rows), band[1] * len(rows)
    for _, t in rows:
        pass
    ordered = sorted(rows)
    out = {}
    for i, (doc, text) in enumerate(ordered):
        text, nxt = text or "", ordered[(i + 1) % len(ordered)][1] or ""
        m = len(text) // 4
        edited = text[: len(text) - m] + nxt[:m]
        for w in terms(edited):
            df.setdefault(w, 0)
        a, b, c = fields(text), fields(edited), fields(nxt)
        out[doc] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), ":".join(a), ":".join(b), like(a, b), like(a, c))
    return out


def xxh_int(v, seed):
    """Spark hashes a 4-byte integer by the short tail of XXH64 as well."""
    return xxhash.xxh64(v.to_bytes(4, "little", signed=True), seed=seed).intdigest()


def fingerprint_rows(df, band):
    names = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return {r["doc_id"]: tuple(r[n] for n in names) for r in imatch.fingerprints(df, band=band).collect()}


def test_fingerprints_against_brute_force(docs):
    r = random.Random(2)
    vocabulary = [f"term{i}é" for i in range(300)]
    rows = [(i * 7, " ".join(r.choices(vocabulary, k=r.choice([0, 1, 3, 50, 200])))) for i in range(80)]
    rows += [(1000, None), (1001, "Other, WORDS!"), (1002, rows[5][1])]
    band = (0.05, 0.4)
    got, want = fingerprint_rows(docs(rows), band), brute(rows, band)
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k]) if False else got[k][:4] == want[k][:4] and got[k][4:] == pytest.approx(want[k][4:])


def test_fingerprint_cases(docs):
    one = fingerprint_rows(docs([(5, "abcdefgh")]), imatch.BAND)[5]
    assert one[0] == 8 and one[1] == hashlib.sha256(b"abcdefab").hexdigest() and one[5] == 1.0
    assert fingerprint_rows(docs([(5, "x")]).limit(0), imatch.BAND) == {}
    rows = imatch.fingerprints(docs([(1, "same"), (1, "same"), (None, "same"), (2, "long " * 40_000)])).collect()
    assert len(rows) == 4 and len({r["fingerprint"] for r in rows if r["n_chars"] == 4}) == 1


def test_pipeline(spark, table):
    from rentlens.session import materialise

    kept = table
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = materialise(stage(spark, kept, SF), name)
        assert kept.columns == table.columns
        if name != "mixing":
            assert kept.count() == kept.select("doc_id").distinct().count() > 100
    last = corpus_pipeline.STAGES[-1][1](spark, kept, SF).collect()
    assert len(last) == kept.count() and all(r["round_trip"] for r in last)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "mixing", "bpe"]
    got = sorted((r["doc_id"], r["ids_sha256"]) for r in corpus_pipeline.run(spark, SF).collect())
    assert got == sorted((r["doc_id"], r["ids_sha256"]) for r in last)
