import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from rentlens.llm import bagminhash as B
from rentlens.llm import graph
from rentlens.llm.graph import components
from rentlens.llm.stages import near_dedup_stage


def bag(text):
    w = (text or "").lower().split()
    n = min(5, len(w))
    return Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if w else Counter()


def brute(rows, threshold=0.8):
    """Classes by all pairs: id -> smallest id of its class."""
    bags = [bag(t) for _, t in rows]
    boss = list(range(len(rows)))

    def root(i):
        while boss[i] != i:
            i = boss[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            shared = sum((bags[i] & bags[j]).values())
            total = sum(bags[i].values()) + sum(bags[j].values()) - shared
            if (not total) or shared >= threshold * total - 1e-9:
                boss[root(i)] = root(j)
    classes = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        classes[root(i)].append(doc)
    return {rows[i][0]: (min(classes[root(i)]), len(classes[root(i)])) for i in range(len(rows))}


def words(r, n):
    return [f"w{r.randrange(5000)}" for _ in range(n)]


def corpus(seed, families=8, copies=12):
    r = random.Random(seed)
    rows = []
    for _ in range(families):
        base = words(r, r.choice([6, 30, 200]))
        for _ in range(copies):
            t = list(base)
            for _ in range(max(1, len(t) // 60) if r.random() < 0.7 else 0):
                t[r.randrange(len(t))] = f"x{r.randrange(9999)}"
            rows.append((len(rows), " ".join(t) if r.random() < 0.8 else "  ".join(t).upper()))
    rows += [(len(rows) + i, " ".join(words(r, 40))) for i in range(30)]
    return rows


def got(df):
    return {r["id"]: (r["class_id"], r["class_size"]) for r in B.near_duplicates(df).collect()}


def test_estimate_is_unbiased():
    r = np.random.default_rng(3)
    keys = np.sort(r.integers(0, 2**63, 300)).astype(np.uint64)
    a, b = r.integers(1, 9, 300), r.integers(1, 9, 300)
    s = B.signatures([(keys, a), (keys, b)], m=6000)
    want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((s[0] == s[1]).mean() - want) < 0.03


def test_words_hash_the_same_anywhere():
    assert len(set(B.word_hashes(b"ab cd ab x ab").tolist())) == 3


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(docs, seed):
    rows = corpus(seed)
    assert got(docs(rows)) == brute(rows)


def test_large_component_in_blocks(docs, monkeypatch):
    """A star: every copy is near the original, few copies near each other; texts that share a passage only stay apart."""
    monkeypatch.setattr(B, "BLOCK", 24)
    monkeypatch.setattr(B, "PIVOTS", 2)
    r = random.Random(5)
    base = words(r, 200)
    rows = []
    for _ in range(90):
        t = list(base)
        for at in r.sample(range(40), 4):
            t[5 * at] = f"x{r.randrange(10**6)}"
        rows.append((len(rows) + 1, " ".join(t)))
    rows.append((len(rows) + 1, " ".join(base)))
    passage = words(r, 60)
    rows += [(1000 + i, " ".join(passage + words(r, 30))) for i in range(60)]
    assert got(docs(rows)) == brute(rows)


def test_defined_cases(docs):
    rows = [(1, None), (2, ""), (3, " \t"), (4, "one two"), (5, "ONE  two"), (6, "one two three"), (7, "word " * 30_000), (8, "word " * 30_001)]
    found = got(docs(rows))
    assert found[1] == found[2] == found[3] == (1, 3)
    assert found[4] == found[5] == (4, 2) and found[6] == (6, 1) and found[7] == found[8] == (7, 2)
    assert got(docs(rows).limit(0)) == {}


def test_stage_keeps_one_row_of_each_class(docs):
    rows = corpus(4, families=3) + [(0, corpus(4, families=3)[0][1])] * 3 + [(None, "a text without an id of its own here"), (None, "a text without an id of its own here")]
    df = docs(rows)
    out = near_dedup_stage(df.sparkSession, df, "")
    assert out.columns == df.columns
    want = brute([x for x in dict.fromkeys(rows) if x[0] is not None])
    ids = sorted(r["doc_id"] for r in out.collect() if r["doc_id"] is not None)
    assert ids == sorted({c for c, _ in want.values()}) and out.filter("doc_id IS NULL").count() == 1


@pytest.mark.parametrize("per_task", [500_000, 10])
def test_components(spark, monkeypatch, per_task):
    monkeypatch.setattr(graph, "EDGES_PER_TASK", per_task)
    r = random.Random(1)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + r.randrange(50)) for _ in range(60)] + [(7, 7), (None, 3)]
    rows = components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()
    assert len(rows) == len({x["node"] for x in rows})
    assert all(x["label"] == (0 if x["node"] < 100 else 100) for x in rows) and len(rows) == 61 + len({b for a, b in edges if a == 100} | {100})
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0
