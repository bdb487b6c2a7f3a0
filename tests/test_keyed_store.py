"""The keyed store: readers, replays, writers that die and writers that meet."""

import random

import pytest

from rentlens.sources import keyed_store
from rentlens.sources.keyed_store import Conflict, KeyedStore

SCHEMA = "id bigint, v string, n int"


@pytest.fixture
def store(spark, tmp_path):
    table = KeyedStore.create(spark, str(tmp_path / "t"), spark.createDataFrame([], SCHEMA).schema, ["id"], 8)
    table.upsert(spark.createDataFrame([(i, f"v{i}", i) for i in range(50)], SCHEMA), ["n"], "start")
    return table


def rows(store, version=None):
    return {r["id"]: (r["v"], r["n"]) for r in store.read(version).collect()}


def test_writes_equal_a_dictionary(spark, tmp_path):
    r = random.Random(1)
    table = KeyedStore.create(spark, f"file://{tmp_path}/t", spark.createDataFrame([], SCHEMA).schema, ["id"], 5)
    want = {}
    assert rows(table) == {}
    for step in range(6):
        batch = [(r.choice([*range(20), None]), f"s{step}-{i}", i) for i in range(r.randrange(0, 30))]
        df = spark.createDataFrame(batch, SCHEMA).selectExpr("*", "'x' AS other")
        kind = step % 3
        if kind == 0:
            table.upsert(df, ["n"], f"b{step}")
        elif kind == 1:
            table.insert_new(df, ["n"], f"b{step}")
        else:
            table.update_columns(df, ["v"], f"b{step}", ["n"])
        before = dict(want)
        for i, v, n in batch:
            if i is None:
                continue
            if kind == 0:
                want[i] = (v, n)
            elif kind == 1 and i not in before:
                want.setdefault(i, (v, n))
            elif kind == 2:
                want[i] = (v, before[i][1] if i in before else None)
        assert rows(table) == want
    assert table.manifest().version == 6
    assert KeyedStore(spark, f"file://{tmp_path}/t").keys == ["id"]


def test_only_touched_partitions_are_rewritten_and_old_versions_stay(spark, store):
    before = store.manifest()
    old = store.read()
    store.upsert(spark.createDataFrame([(7, "new", 1)], SCHEMA), ["n"], "one")
    after = store.manifest()
    assert sum(a != b for a, b in zip(before.folders, after.folders)) == 1
    assert rows(store)[7] == ("new", 1) and rows(store, before.version)[7] == ("v7", 7)
    assert {r["id"]: r["v"] for r in old.collect()}[7] == "v7"
    assert store.clean(1) > 0 and rows(store)[7] == ("new", 1) and len(rows(store)) == 50


def test_a_batch_counts_once(spark, store):
    batch = spark.createDataFrame([(7, "again", 1), (99, "z", 2)], SCHEMA)
    first = store.upsert(batch, ["n"], "b")
    store.upsert(spark.createDataFrame([(7, "later", 1)], SCHEMA), ["n"], "c")
    assert store.upsert(batch, ["n"], "b") >= first and rows(store)[7] == ("later", 1)
    assert store.upsert(spark.createDataFrame([], SCHEMA), ["n"], "none") and len(rows(store)) == 51


@pytest.mark.parametrize("point", ["data", "publish", "note"])
def test_a_write_that_dies_halfway(spark, store, monkeypatch, point):
    """Before the manifest the old state is read; after it the new one, also if the batch's note is missing; a rerun gives the new state once."""
    want_old = rows(store)
    batch = spark.createDataFrame([(7, "new", 1), (99, "z", 2)], SCHEMA)
    real = store._publish

    def dies(path, text):
        if point == "note" and "/batches/" in path or point == "publish" and "/manifests/" in path:
            raise RuntimeError("killed")
        real(path, text)

    def merge(old, new):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(store, "_publish", dies)
        with pytest.raises(RuntimeError):
            if point == "data":
                store.apply(batch, "b", merge)
            else:
                store.upsert(batch, ["n"], "b")
    again = KeyedStore(spark, store.path)
    assert rows(again) == (want_old | {7: ("new", 1), 99: ("z", 2)} if point == "note" else want_old)
    version = again.upsert(batch, ["n"], "b")
    assert rows(again) == want_old | {7: ("new", 1), 99: ("z", 2)}
    again.upsert(spark.createDataFrame([(7, "newer", 3)], SCHEMA), ["n"], "c")
    assert again.upsert(batch, ["n"], "b") >= version and rows(again)[7] == ("newer", 3)


def test_two_writers(spark, store):
    """The second writer finds the version taken: changes in other partitions stay, in the same one the merge runs again."""
    other = KeyedStore(spark, store.path)
    part = {r["id"]: r["p"] for r in store.read().select("id", store.part_of().alias("p")).collect()}
    far = next(i for i in part if part[i] != part[7])
    for near, name in ((7, "same"), (far, "far")):
        calls = []

        def merge(old, new, near=near, calls=calls, name=name):
            calls.append(1)
            if len(calls) == 1:  # another writer comes in between
                other.update_columns(spark.createDataFrame([(near, name, 0)], SCHEMA), ["v"], f"other-{name}")
            return old.selectExpr("id", "v", "n + 1 AS n")

        before = rows(store)
        store.apply(spark.createDataFrame([(7, "", 0)], SCHEMA), f"mine-{name}", merge)
        assert len(calls) == (2 if name == "same" else 1)
        now = rows(store)
        assert now[near][0] == name and now[7][1] == before[7][1] + 1


def test_endless_conflicts_and_wrong_use(spark, store, monkeypatch):
    monkeypatch.setattr(keyed_store, "ATTEMPTS", 2)
    count = iter(range(100))

    def merge(old, new):
        KeyedStore(spark, store.path).upsert(spark.createDataFrame([(7, "x", 0)], SCHEMA), ["n"], f"o{next(count)}")
        return old

    with pytest.raises(Conflict):
        store.apply(spark.createDataFrame([(7, "", 0)], SCHEMA), "mine", merge)
    with pytest.raises(ValueError):
        store.apply(spark.createDataFrame([(7, "", 0)], SCHEMA), "stray", lambda old, new: old.selectExpr("id + 1 AS id", "v", "n"))
    with pytest.raises(ValueError):
        store.upsert(spark.createDataFrame([(7, "", 0)], SCHEMA), ["n"], "a/b")
    with pytest.raises(Conflict):
        KeyedStore.create(spark, store.path, store.schema, ["id"])
    with pytest.raises(ValueError):
        KeyedStore.create(spark, store.path + "2", store.schema, ["nope"])
