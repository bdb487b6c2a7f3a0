"""A table by key: hash-partitioned Parquet under numbered manifests.

Rows of one key lie in one of a fixed number of partitions, chosen by a hash of the key. A write reads only the
partitions that its batch touches, writes their new contents into a new folder and then publishes a manifest, a list of
each partition's folder. The manifest of version n + 1 is put in place by a rename that fails if that version exists, so

- a reader sees the table before a write or after it, never between, also when a write dies halfway: what it had
  written is in no manifest;
- of two writers that started from one version the second finds its version taken: it publishes on top of the first
  where they touched different partitions, and repeats its merge where they touched the same;
- a batch that is applied twice under one batch id, as after a crash whose outcome is unknown, changes nothing the
  second time.

Defined cases: rows of a batch without a key are left out; an empty batch publishes a version with nothing changed; a
table without rows has the declared columns; a column that the table does not declare is not stored, and one that a
batch lacks is null in its rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rentlens.operators import writes

#: Attempts of a write that finds other writers' changes in its partitions.
ATTEMPTS = 10
PART = "_store_part"


class Conflict(Exception):
    """Another writer published the version first."""


@dataclass
class Manifest:
    """``folders``: per partition the folder with its rows, relative to the table, or null. ``batch``: the id of the write."""

    version: int
    batch: str | None
    folders: list[str | None]


class KeyedStore:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        meta = json.loads(self._read(f"{self.path}/table.json"))
        self.keys, self.partitions, self.schema = meta["keys"], meta["partitions"], T.StructType.fromJson(meta["schema"])

    @classmethod
    def create(cls, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], partitions: int = 64) -> KeyedStore:
        """A new, empty table. ``partitions`` stays as it is: choose it so that one partition of the full table fits a task."""
        missing = [k for k in keys if k not in schema.names]
        if missing:
            raise ValueError(f"keys that are no columns: {missing}")
        store = cls.__new__(cls)
        store.spark, store.path = spark, path.rstrip("/")
        meta = {"keys": list(keys), "partitions": partitions, "schema": schema.jsonValue()}
        store._publish(f"{store.path}/table.json", json.dumps(meta))
        store._publish(store._manifest_path(0), json.dumps({"batch": None, "folders": [None] * partitions}))
        return cls(spark, path)

    # ---- files -----------------------------------------------------------------------------------
    def _fs(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at, at.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        at, fs = self._fs(f"{self.path}/{folder}")
        return [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []

    def _read(self, path: str) -> str:
        at, fs = self._fs(path)
        stream = fs.open(at)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _exists(self, path: str) -> bool:
        at, fs = self._fs(path)
        return fs.exists(at)

    def _publish(self, path: str, text: str) -> None:
        """Puts a whole file in place in one step; ``Conflict`` if there is one."""
        draft, fs = self._fs(f"{path}.{uuid.uuid4().hex}.draft")
        out = fs.create(draft, False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        context = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark._jsc.hadoopConfiguration())
        fail_if_there = self.spark._sc._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(fs.makeQualified(draft), fs.makeQualified(at), fail_if_there)
        except Py4JJavaError as e:
            fs.delete(draft, False)
            if "FileAlreadyExistsException" in str(e.java_exception):
                raise Conflict(path) from None
            raise

    def _manifest_path(self, version: int) -> str:
        return f"{self.path}/manifests/{version:020d}"

    def _batch_path(self, batch: str) -> str:
        return f"{self.path}/batches/{batch}"

    # ---- reading ---------------------------------------------------------------------------------
    def manifest(self, version: int | None = None) -> Manifest:
        """The manifest of a version, by default the latest."""
        if version is None:
            version = max(int(n) for n in self._names("manifests") if n.isdigit())
        found = json.loads(self._read(self._manifest_path(version)))
        return Manifest(version, found["batch"], found["folders"])

    def read(self, version: int | None = None) -> DataFrame:
        """The table as of a version; the files are listed now, so a later write does not change what this reads."""
        return self._rows(self.manifest(version).folders)

    def _rows(self, folders: Sequence[str | None]) -> DataFrame:
        paths = [f"{self.path}/{f}" for f in folders if f]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def part_of(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(k).cast(self.schema[k].dataType) for k in self.keys]), F.lit(self.partitions)).cast("int")

    # ---- writing ---------------------------------------------------------------------------------
    def applied(self, batch_id: str) -> bool:
        """Whether a write of this batch id is in the table. Only the latest version's can lack its note, should its writer have died."""
        return self._exists(self._batch_path(batch_id)) or self.manifest().batch == batch_id

    def apply(self, batch: DataFrame, batch_id: str, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> int:
        """Publishes ``merge(existing rows of the touched partitions, batch)``; returns the version that holds it.

        ``merge`` must keep the keys of the rows it is given, and may be called again if other writers were faster.
        """
        if not batch_id or "/" in batch_id:
            raise ValueError("a batch id is a file name")
        batch = batch.dropna(subset=self.keys)
        touched = sorted(r["p"] for r in batch.select(self.part_of().alias("p")).distinct().collect())
        for _ in range(ATTEMPTS):
            base = self.manifest()
            self._note(base)
            if self.applied(batch_id):
                return base.version
            fresh = self._written(base, touched, batch, merge)
            latest = base
            while all(latest.folders[p] == base.folders[p] for p in touched):
                folders = list(latest.folders)
                for p in touched:
                    folders[p] = fresh.get(p)
                try:
                    self._publish(self._manifest_path(latest.version + 1), json.dumps({"batch": batch_id, "folders": folders}))
                except Conflict:
                    latest = self.manifest()
                    self._note(latest)
                    if self.applied(batch_id):
                        return latest.version
                    continue
                self._note(Manifest(latest.version + 1, batch_id, folders))
                return latest.version + 1
        raise Conflict(f"{ATTEMPTS} attempts met other writers in the same partitions")

    def _note(self, of: Manifest) -> None:
        """Notes the batch id of a published version before the next one is, so that it stays known."""
        if of.batch is not None and not self._exists(self._batch_path(of.batch)):
            try:
                self._publish(self._batch_path(of.batch), str(of.version))
            except Conflict:
                pass  # another writer has noted it

    def _written(self, base: Manifest, touched: list[int], batch: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> dict[int, str]:
        if not touched:
            return {}
        folder = f"data/{uuid.uuid4().hex}"
        out = merge(self._rows([base.folders[p] for p in touched]), batch)
        out = out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields]).withColumn(PART, self.part_of())
        out.repartition(len(touched), PART).write.partitionBy(PART).parquet(f"{self.path}/{folder}")
        found = {int(n.split("=")[1]): f"{folder}/{n}" for n in self._names(folder) if n.startswith(f"{PART}=")}
        if stray := set(found) - set(touched):
            raise ValueError(f"the merge made rows of partitions {sorted(stray)[:5]} that the batch does not touch")
        return found

    def _padded(self, batch: DataFrame) -> DataFrame:
        return batch.withColumns({f.name: F.lit(None).cast(f.dataType) for f in self.schema.fields if f.name not in batch.columns})

    def insert_new(self, batch: DataFrame, order: Sequence[str], batch_id: str) -> int:
        """Adds the keys that are not there yet, with their first row in ``order``."""
        return self.apply(self._padded(batch), batch_id, lambda old, new: writes.insert_new_only(old, new, self.keys, order))

    def upsert(self, batch: DataFrame, order: Sequence[str], batch_id: str) -> int:
        """Replaces or adds whole rows, with a key's last row in ``order``."""
        return self.apply(self._padded(batch), batch_id, lambda old, new: writes.upsert_by_key(old, new, self.keys, order))

    def update_columns(self, batch: DataFrame, columns: Sequence[str], batch_id: str, order: Sequence[str] = (), insert: bool = True) -> int:
        """Writes only ``columns`` of the rows with a batch row's key (one-column keys); other keys are added if ``insert``."""
        (key,) = self.keys
        return self.apply(batch, batch_id, lambda old, new: writes.upsert_columns(old, new, key, columns, insert, order))

    def replace_day(self, listings: DataFrame, as_of: str, states: Sequence[str], batch_id: str) -> int:
        """The snapshot rows (fecha, id, estado) of one day; a rerun of the day under another batch id overwrites."""
        day = writes.day_rows(listings, as_of, states)
        return self.apply(day, batch_id, lambda old, new: writes.upsert_by_key(old, new, self.keys, ["estado"]))

    def clean(self, keep: int = 2) -> int:
        """Deletes partition folders that none of the last ``keep`` versions names, and drafts. Run it while nobody writes; returns how many went."""
        latest = self.manifest().version
        named = {f for v in range(max(0, latest - keep + 1), latest + 1) for f in self.manifest(v).folders if f}
        old = [f"data/{d}/{n}" for d in self._names("data") for n in self._names(f"data/{d}") if n.startswith(f"{PART}=")]
        drafts = [f"{top}/{n}" for top in ("manifests", "batches") for n in self._names(top) if n.endswith(".draft")]
        gone = [f for f in old if f not in named] + drafts
        gone += [f"data/{d}" for d in self._names("data") if not any(f.startswith(f"data/{d}/") for f in named)]
        for f in gone:
            at, fs = self._fs(f"{self.path}/{f}")
            fs.delete(at, True)
        return len(gone)
