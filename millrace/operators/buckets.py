"""A keyed table in hash buckets: a batch rewrites only the buckets it touches, one rename publishes it."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import col
from millrace.plans.scratch import materialize
from millrace.sources.files import hadoop, read_document, write_document

BUCKET = "_bucket"
Fold = Callable[[DataFrame], DataFrame]


class BucketedTable:
    """Layout `<path>/data/<write id>/_bucket=<n>` and `<path>/versions/v<N>`, a manifest that names for every bucket the
    write that holds it.

    `fold` brings rows to one per key and must give the same when it is applied to its own results and new rows together
    (last version, sum, maximum). Choose `buckets` so that one bucket's rows fit a task; the manifest and what passes through
    the driver have one short entry per bucket, whatever the rows. A table keeps the number it was created with.

    Batches are merged by one writer in rising order. A batch whose id is not above the last merged one changes nothing, so a
    replay counts once. A crash before the rename leaves a folder that no manifest names; `vacuum` deletes it. Readers
    keep the version they pinned until `vacuum` drops it.

    Rows without a key are not stored; the key's type must not change. Columns may be added by later batches, older rows hold NULL there; an empty batch only
    moves the version on.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, fold: Fold, buckets: int = 64) -> None:
        self.spark, self.path, self.key, self.fold, self.buckets = spark, path.rstrip("/"), key, fold, buckets

    def versions(self) -> list[int]:
        fs, pattern = hadoop(self.spark, f"{self.path}/versions/v*/_SUCCESS")
        names = [s.getPath().getParent().getName() for s in fs.globStatus(pattern) or ()]
        return sorted(int(n[1:]) for n in names if n[1:].isdecimal())

    def manifest(self, version: int | None = None) -> dict:
        """The newest by default; version 0 is the empty table."""
        wanted = max(self.versions(), default=0) if version is None else version
        if wanted == 0:
            return {"version": 0, "last_batch": None, "buckets": self.buckets, "schema": None, "parts": {}, "write": None}
        return read_document(self.spark, f"{self.path}/versions/v{wanted}")

    def read(self, version: int | None = None, schema: T.StructType | None = None) -> DataFrame:
        """One version's rows, with files pinned now. An empty table needs a `schema` to be read."""
        return self._rows(self.manifest(version), schema=schema)

    def lookup(self, values: Sequence) -> DataFrame:
        """Rows of these keys, from their buckets only."""
        found = self.manifest()
        rows = self._rows(found, self._numbers(values, found["buckets"], found["schema"]) if found["schema"] else None)
        return rows.where(col(self.key).isin(list(values)))

    def _numbers(self, values: Sequence, buckets: int, schema: str) -> set[int]:
        kind = T.StructType.fromJson(json.loads(schema))[self.key].dataType
        keys = self.spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField(self.key, kind)]))
        return {r[0] for r in keys.select(self._bucket(buckets)).distinct().collect()}

    def _bucket(self, buckets: int):
        return F.pmod(F.hash(col(self.key)), F.lit(buckets))

    def _rows(self, manifest: dict, numbers: set[int] | None = None, schema: T.StructType | None = None) -> DataFrame:
        if manifest["schema"] is None and schema is None:
            raise FileNotFoundError(f"{self.path} holds no version")
        known = T.StructType.fromJson(json.loads(manifest["schema"])) if manifest["schema"] else schema
        parts = [f"{self.path}/data/{w}/{BUCKET}={b}" for b, w in manifest["parts"].items() if numbers is None or int(b) in numbers]
        return self.spark.read.schema(known).parquet(*parts) if parts else self.spark.createDataFrame([], known)

    def merge(self, batch: DataFrame, batch_id: int) -> int:
        """Bring a batch into the table; returns the version that holds it.

        The batch is folded before it meets the table, so a key with very many rows is combined in the tasks that read them.
        Old rows come from touched buckets only. Both are dealt by the hash that numbers the buckets, so one task writes one
        bucket as one file.
        """
        if BUCKET in batch.columns:
            raise ValueError(f"The name {BUCKET} is taken by the table")
        now = self.manifest()
        if now["last_batch"] is not None and batch_id <= now["last_batch"]:
            return now["version"]
        if now["schema"] and (known := T.StructType.fromJson(json.loads(now["schema"]))[self.key].dataType) != batch.schema[self.key].dataType:
            raise TypeError(f"Keys of {self.path} are {known.simpleString()}; another type would fall into other buckets")
        keyed = batch.where(col(self.key).isNotNull())
        fresh = materialize(self.fold(keyed), "merged-batch")
        touched = {r[0] for r in fresh.select(self._bucket(now["buckets"])).distinct().collect()}
        write = f"{int(batch_id)}-{uuid.uuid4().hex}"
        schema, parts = now["schema"], dict(now["parts"])
        if touched:
            rows = fresh
            if now["schema"]:
                rows = self._rows(now, touched).unionByName(fresh, allowMissingColumns=True)
            dealt = self.fold(rows.repartition(now["buckets"], col(self.key)))
            dealt.withColumn(BUCKET, self._bucket(now["buckets"])).write.partitionBy(BUCKET).parquet(f"{self.path}/data/{write}")
            schema = json.dumps(_nullable(dealt.schema).jsonValue())
            parts |= {str(b): write for b in touched}
        elif schema is None:
            schema = json.dumps(_nullable(fresh.schema).jsonValue())
        return self._commit({**now, "last_batch": int(batch_id), "schema": schema, "parts": parts, "write": write})

    def _commit(self, manifest: dict) -> int:
        """Show a manifest as the next version. A second writer that was faster is noticed and this one raises."""
        version = manifest["version"] + 1
        staged, final = f"{self.path}/staged/{manifest['write']}", f"{self.path}/versions/v{version}"
        write_document(self.spark, staged, {**manifest, "version": version})
        fs, place = hadoop(self.spark, final)
        fs.mkdirs(place.getParent())
        if fs.exists(place) or not fs.rename(hadoop(self.spark, staged)[1], place) or self.manifest(version)["write"] != manifest["write"]:
            raise RuntimeError(f"Version {version} of {self.path} was written by another writer")
        return version

    def vacuum(self, keep: int = 1) -> None:
        """Drop all but the newest `keep` versions, and data that none of these names. For the writer, between merges."""
        known = self.versions()
        kept = known[-max(1, keep):]
        named = {w for v in kept for w in self.manifest(v)["parts"].items()}
        for v in known[: len(known) - len(kept)]:
            self._delete(f"{self.path}/versions/v{v}")
        fs, pattern = hadoop(self.spark, f"{self.path}/data/*/{BUCKET}=*")
        for status in fs.globStatus(pattern) or ():
            where = status.getPath()
            if (where.getName().split("=")[1], where.getParent().getName()) not in named:
                fs.delete(where, True)
        writes = {w for _, w in named}
        for status in fs.globStatus(hadoop(self.spark, f"{self.path}/data/*")[1]) or ():
            if status.getPath().getName() not in writes:
                fs.delete(status.getPath(), True)
        self._delete(f"{self.path}/staged")

    def _delete(self, folder: str) -> None:
        fs, where = hadoop(self.spark, folder)
        fs.delete(where, True)


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in schema])
