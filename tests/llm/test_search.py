"""Lexical search and nearest neighbours against comparison with everything."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import types as T

from rentlens.llm import kmeans_tree, pair_maxscore
from rentlens.llm.common import prepare

ITEMS = T.StructType().add("item_id", T.LongType()).add("text", T.StringType())


def by_hand(docs, items, k):
    def words(text):
        return pair_maxscore.terms_of((text or "").encode())

    tf = [(i, Counter(words(t))) for i, t in docs]
    sizes = [sum(c.values()) for _, c in tf]
    n, length = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in tf for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(words(t))
    out = []
    for item, terms in asked.items():
        found = []
        for (i, c), size in zip(tf, sizes):
            score = 0
            for t in terms & set(c):
                m = 100 - 50 + (50 * size * n) // length
                score += math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m))
            if score > 0:
                found.append((-score, i is None, i or 0))
        out += [(item, r, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(found)[:k], start=1)]
    return out


def plain(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is None, x or 0) for x in r))


def corpus(seed, n=300):
    r = np.random.default_rng(seed)
    names = [f"w{i}" for i in range(60)] + ["Été", "ÉTÉ", "naïve", "W1"]
    p = 1 / np.arange(1, len(names) + 1)
    text = [" ".join(r.choice(names, r.integers(0, 40), p=p / p.sum())) for _ in range(n)]
    rows = [(int(i), t) for i, t in enumerate(text)]
    rows += [(None, text[3]), (7, text[7]), (n, None), (n + 1, ""), (n + 2, "--- ..."), (n + 3, "w5 " * 5000), (n + 4, text[3])]
    items = [(i, " ".join(r.choice(names, 12))) for i in range(9)] + [(20, None), (21, ""), (22, "nowhere"), (None, "w7 w50"), (3, "w40 w41"), (23, "w1 w1, W1 été-w50")]
    return rows, items


@pytest.mark.parametrize("seed", [0, 1])
@pytest.mark.parametrize("k", [3, 50])
def test_search_equals_scoring_all(spark, docs, monkeypatch, seed, k):
    """Small blocks and rounds, so that limits, pair bounds and several rounds are all at work."""
    prepare(spark)
    monkeypatch.setattr(pair_maxscore, "SEED_BLOCKS", 2)
    rows, items = corpus(seed)
    asked = spark.createDataFrame(items, ITEMS).selectExpr("*", "'x' AS doc_id", "1 AS score")
    got = pair_maxscore.search_documents(docs(rows, 5, ("item_id", "score", "rank")), asked, k=k, round_terms=40)
    assert plain(got.collect()) == plain(by_hand(rows, items, k))


def test_blocks_skip_and_bound():
    """The bound of every prefix holds for all documents, with pairs tighter than the sum; search finds what scoring all does."""
    r = np.random.default_rng(5)
    n, terms = 400, list(range(6))
    impact = np.where(r.random((6, n)) < 0.4, r.integers(1, 100, (6, n)), 0)
    impact[0, impact[1] > 0] //= 4
    block = pair_maxscore.Block.__new__(pair_maxscore.Block)
    at = [np.flatnonzero(x) for x in impact]
    ends = np.cumsum([len(x) for x in at])
    block.ids, block.pos, block.impact = np.arange(n), np.concatenate(at), np.concatenate([x[p] for x, p in zip(impact, at)])
    block.lists = {t: (int(e - len(p)), int(e)) for t, (p, e) in enumerate(zip(at, ends))}
    block.top = {t: int(impact[t].max()) for t in terms}
    both = [np.flatnonzero((impact[i] > 0) & (impact[i + 1] > 0)) for i in range(5)]
    ends = np.cumsum([len(x) for x in both])
    block.pair_pos = np.concatenate(both)
    block.pair_lists = {i: (int(e - len(p)), int(e)) for i, (p, e) in enumerate(zip(both, ends))}
    block.pair_top = {i: int((impact[i] + impact[i + 1])[p].max()) for i, p in enumerate(both)}
    bound = block.bounds(terms, range(5))
    assert all(impact[:i].sum(axis=0).max() <= b for i, b in enumerate(bound)) and bound == sorted(bound)
    assert bound[-1] < sum(block.top.values())
    total = impact.sum(axis=0)
    for limit in range(1, int(total.max()) + 2, 7):
        found, score = block.search(terms, range(5), limit)
        assert found.tolist() == np.flatnonzero(total >= limit).tolist() and (score == total[found]).all()


def test_search_of_empty_tables(spark, docs):
    prepare(spark)
    rows, items = corpus(0, 20)
    none, nothing = docs([]), spark.createDataFrame([], ITEMS)
    assert pair_maxscore.search_documents(none, spark.createDataFrame(items, ITEMS)).collect() == []
    assert pair_maxscore.search_documents(docs(rows), nothing).columns == ["item_id", "rank", "doc_id", "score"]
    assert pair_maxscore.search_documents(docs([(1, None)]), spark.createDataFrame(items, ITEMS)).collect() == []


VECTORS = T.StructType().add("vec_id", T.LongType()).add("embedding", T.ArrayType(T.DoubleType())).add("score", T.StringType())


def true_neighbours(rows, k):
    fine = {i: np.array(v) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    out = {}
    for q, a in fine.items():
        if q % 50 == 0:
            near = [(-float(a @ b / math.sqrt(a @ a) / math.sqrt(b @ b)), i) for i, b in fine.items() if i != q]
            out[q] = [(i, -s) for s, i in sorted((round(s, 12), i) for s, i in near)[:k]]
    return out


def vectors(spark, rows, parts=4):
    return spark.createDataFrame([(i, v, "x") for i, v in rows], VECTORS).repartition(parts)


def test_neighbours_with_copies_and_bad_vectors(spark, monkeypatch):
    prepare(spark)
    monkeypatch.setattr(kmeans_tree, "CHUNK", 20)
    monkeypatch.setattr(kmeans_tree, "LEAF_ROWS", 30)
    r = np.random.default_rng(2)
    centers = r.normal(size=(8, 6)) * 4
    rows = [(i, (centers[i % 8] + r.normal(size=6)).tolist()) for i in range(400)]
    rows += [(i, rows[0][1]) for i in range(400, 520)]  # a large group of copies, three of them queries
    rows += [(600, None), (650, [0.0] * 6), (700, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (750, [float("nan")] * 6), (800, [1.0, float("inf")] + [0.0] * 4)]
    df = vectors(spark, [*rows, (850, [1.0, 2.0]), (851, []), (50, rows[50][1])])
    found = kmeans_tree.nearest_neighbours(df, recall=1.0).collect()
    got = {}
    for x in sorted(found, key=lambda x: (x.query_id, x["rank"])):
        assert x["rank"] == len(got.setdefault(x.query_id, [])) + 1
        got[x.query_id].append((x.vec_id, round(x.score, 12)))
    want = true_neighbours(rows, 5)
    assert set(got) == set(want)
    for q in want:
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in want[q]], abs=1e-11)
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]], q


def test_recall_and_leaves(spark):
    prepare(spark)
    r = np.random.default_rng(3)
    rows = [(i, r.normal(size=16).tolist()) for i in range(3000)]
    df = vectors(spark, rows)
    assert kmeans_tree.recall_of(kmeans_tree.nearest_neighbours(df), df) >= 0.9


def test_few_and_no_vectors(spark):
    prepare(spark)
    few = kmeans_tree.nearest_neighbours(vectors(spark, [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (None, [1.0, 1.0]), (2, [2.0, 0.0])]))
    assert [(x.query_id, x["rank"], x.vec_id) for x in few.orderBy("rank").collect()] == [(0, 1, 2), (0, 2, None), (0, 3, 1)]
    assert kmeans_tree.nearest_neighbours(vectors(spark, [])).collect() == []
    assert kmeans_tree.nearest_neighbours(vectors(spark, [(50, None)])).collect() == []


def test_tree_is_read_best_bin_first():
    r = np.random.default_rng(0)
    x = kmeans_tree.unit(r.normal(size=(500, 8)))
    tree = kmeans_tree.fit_tree(x, 20)
    leaf = tree.assign(x)
    assert set(leaf.tolist()) <= set(range(tree.leaves)) and np.bincount(leaf).max() <= 60
    for q in x[:20]:
        order = tree.order(q, tree.leaves)
        assert sorted(order) == list(range(tree.leaves)) and order[0] == tree.assign(q[None])[0]
        assert tree.order(q, 3) == order[:3]
