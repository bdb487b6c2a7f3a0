import random
from collections import defaultdict

import pytest

from rentlens.llm import line_dedup as L

LONG = "this line is well over forty characters long, number {}"


def brute(rows, min_chars=40, min_docs=5):
    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            holders[L.line_key(line.encode())].add(doc)
    low = lambda d: (d is not None, d)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            k = L.line_key(line.encode())
            if len(k.decode()) >= min_chars and len(holders[k]) >= min_docs and doc != max(holders[k], key=low):
                continue
            kept.append(line)
        out.append((doc, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def run(df):
    return sorted([(r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in L.drop_repeated_lines(df).collect()], key=str)


def rows_of(seed, n=120):
    r = random.Random(seed)
    pool = [LONG.format(i) for i in range(12)] + ["short", "", "É" * 40, "é" * 39 + " "]
    rows = []
    for i in range(n):
        lines = [r.choice(pool) for _ in range(r.randrange(0, 6))] + [f"  \t{LONG.format(0).upper()}\x0b "] * (r.random() < 0.7)
        rows.append((i, "\n".join(lines)))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_brute_force(docs, seed):
    rows = rows_of(seed) + [(None, LONG.format(1)), (500, None), (501, ""), (502, "\n\n")]
    assert run(docs(rows)) == brute(rows)


def test_hot_line_over_many_partitions(spark, docs):
    """One line in every document: the range partitions cut its group, the rows left open are decided by the summaries."""
    rows = [(i, "\n".join([LONG.format("hot"), LONG.format(i % 40), f"own {i}"])) for i in range(400)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    try:
        assert run(docs(rows)) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_four_documents_are_not_enough(docs):
    rows = [(i, LONG.format("x")) for i in range(4)]
    assert run(docs(rows)) == brute(rows) and all(r[3] == 0 for r in run(docs(rows)))


def test_repeated_rows_count_as_one_document(docs):
    rows = [(1, LONG.format("x"))] * 6 + [(2, LONG.format("x"))] * 3
    assert all(r[3] == 0 for r in run(docs(rows)))
    rows += [(i, LONG.format("x")) for i in (3, 4, 5)]
    assert run(docs(rows)) == brute(rows)


def test_very_long_text_and_empty_table(docs):
    rows = [(i, "\n".join(LONG.format(j) for j in range(3000))) for i in range(6)]
    assert run(docs(rows)) == brute(rows)
    assert run(docs(rows).limit(0)) == []


def test_other_columns_stay(docs):
    df = docs([(1, "a")]).selectExpr("*", "1 AS n_lines")
    row = L.drop_repeated_lines(df).first()
    assert row["_keep" if "_keep" in row else "size"] == "extra" and row["n_lines"] == 1
