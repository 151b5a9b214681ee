"""Parquet tables that are replaced or updated as a whole, or not at all.

A table is a folder with data folders and numbered manifests::

    path/data/<id>/...            written once, never changed
    path/versions/0000000007.json rows, schema, and the data folders of version 7

A writer fills a new data folder and creates the next manifest last. A write
that dies leaves data that no manifest names, so readers keep the version
before it. A manifest is created exclusively: of two writers that start from
the same version one fails with ``VersionConflict`` and changes nothing. Half
a manifest doesn't parse and doesn't count. Nothing is renamed, so object
stores work as well.

``upsert`` keeps a keyed table in buckets by a hash of the key. It reads and
writes only the buckets that hold keys of the update, and a version takes the
folders of the others from the versions before.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..context import _filesystem

_BUCKET, _CHANGED = "__bucket", "__changed"


class VersionConflict(RuntimeError):
    """Another writer has committed since the version this write started from."""


class VersionedTable:
    """A table at ``path``; see the module's text."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _numbers(self) -> list[int]:
        folder, fs = _filesystem(self.spark, f"{self.path}/versions")
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def _name(self, number: int) -> str:
        return f"{self.path}/versions/{number:010d}.json"

    def manifest(self, number: int) -> dict | None:
        """The manifest of a version; ``None`` if it was never completed."""
        file, fs = _filesystem(self.spark, self._name(number))
        stream = fs.open(file)
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            return json.loads(text)
        except ValueError:
            return None

    def versions(self) -> list[int]:
        """The numbers of complete versions, in order."""
        return [n for n in self._numbers() if self.manifest(n)]

    def current(self) -> dict | None:
        """The newest complete manifest; ``None`` before the first commit."""
        return next((m for n in reversed(self._numbers()) if (m := self.manifest(n))), None)

    def read(self, version: int | None = None) -> DataFrame:
        """The newest version, or the one asked for."""
        manifest = self.current() if version is None else self.manifest(version)
        if not manifest:
            raise FileNotFoundError(f"{self.path} has no committed version")
        return self._read(manifest, manifest["parts"])

    def _read(self, manifest: dict, parts: Sequence[str]) -> DataFrame:
        schema = T.StructType.fromJson(manifest["schema"])
        folders = [f"{self.path}/data/{manifest['parts'][p]['folder']}" for p in parts]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def _commit(self, base: dict | None, schema: T.StructType, parts: dict, **more) -> dict:
        base_number = base["version"] if base else 0
        newer = [n for n in self.versions() if n > base_number]
        if newer:
            raise VersionConflict(f"{self.path}: version {newer[-1]} was committed after version {base_number}")
        number = max([0, *self._numbers()]) + 1  # an incomplete manifest keeps its number
        manifest = {"version": number, "rows": sum(p["rows"] for p in parts.values()), "schema": schema.jsonValue(), "parts": parts, **more}
        file, fs = _filesystem(self.spark, self._name(number))
        try:
            out = fs.create(file, False)
        except Exception as e:
            if fs.exists(file):
                raise VersionConflict(f"{self.path}: version {number} is another writer's") from e
            raise
        try:
            out.write(bytearray(json.dumps(manifest).encode()))
            out.close()
        except BaseException:
            fs.delete(file, False)  # the caller deletes the data, so no manifest may name them
            raise
        return manifest

    def _delete(self, folder: str) -> None:
        path, fs = _filesystem(self.spark, f"{self.path}/data/{folder}")
        fs.delete(path, True)

    def replace(self, df: DataFrame) -> dict:
        """A new version that holds the rows of ``df`` alone. They are counted by the write itself."""
        base, folder, seen = self.current(), uuid.uuid4().hex, Observation()
        try:
            df.observe(seen, F.count(F.lit(1)).alias("rows")).write.option("compression", "snappy").parquet(f"{self.path}/data/{folder}")
            return self._commit(base, df.schema, {"all": {"folder": folder, "rows": seen.get["rows"]}})
        except BaseException:
            self._delete(folder)
            raise

    def upsert(self, rows: DataFrame, key: str, order: str, buckets: int = 64) -> dict | None:
        """A new version in which each key has the newer of its old and new row, by ``order``, then by the other columns.

        ``rows`` holds a key at most once. Null keys are one key. Keys of the
        first version decide nothing about ``buckets``: later calls keep its
        number. Without a newer row no version is made, and the result is the
        current manifest (``None`` if there is none).
        """
        base = self.current()
        if base and base.get("key") != key:
            raise ValueError(f"{self.path} is not kept by {key}")
        buckets = base["buckets"] if base else buckets
        schema = T.StructType.fromJson(base["schema"]) if base else rows.schema
        if [(f.name, f.dataType) for f in schema] != [(f.name, f.dataType) for f in rows.schema]:
            raise ValueError(f"{self.path} has other columns than the update")
        names = [order, *[c for c in rows.columns if c not in (key, order)]]
        number = F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(buckets)).cast("int")
        packed = lambda df, side: df.select(F.col(f"`{key}`").alias(f"{side}k"), F.struct(*[F.col(f"`{c}`") for c in names]).alias(side))
        folder, update = uuid.uuid4().hex, f"{uuid.uuid4().hex}-update"
        try:
            # the update is stored by bucket: it is read to find its buckets, then joined
            rows.withColumn(_BUCKET, number).write.parquet(f"{self.path}/data/{update}")
            new = self.spark.read.schema(T.StructType([*rows.schema.fields, T.StructField(_BUCKET, T.IntegerType())])).parquet(f"{self.path}/data/{update}")
            touched = {str(r[0]) for r in new.select(_BUCKET).distinct().collect()}  # at most ``buckets`` numbers
            old = self._read(base or {"schema": schema.jsonValue()}, [p for p in (base["parts"] if base else ()) if p in touched])
            both = packed(old, "o").join(packed(new, "n"), F.col("ok").eqNullSafe(F.col("nk")), "full_outer")
            changed = F.col("n").isNotNull() & (F.col("o").isNull() | (F.col("n") > F.col("o")))
            best = both.select(F.coalesce("ok", "nk").alias(key), F.greatest("o", "n").alias("best"), changed.alias(_CHANGED))
            out = best.select(*[F.col(f"`{key}`") if c == key else F.col(f"best.`{c}`").alias(c) for c in rows.columns], _CHANGED).withColumn(_BUCKET, number)
            out.repartition(_BUCKET).write.option("compression", "snappy").partitionBy(_BUCKET).parquet(f"{self.path}/data/{folder}")
            done = self.spark.read.schema(f"{_CHANGED} boolean, {_BUCKET} int").parquet(f"{self.path}/data/{folder}")
            counts = done.groupBy(_BUCKET).agg(F.count(F.lit(1)).alias("n"), F.max(_CHANGED).alias("changed")).collect() if touched else []
            fresh = {str(r[_BUCKET]): {"folder": f"{folder}/{_BUCKET}={r[_BUCKET]}", "rows": r["n"]} for r in counts if r["changed"]}
            if not fresh:
                self._delete(folder)
                return base
            for r in counts:
                if not r["changed"]:
                    self._delete(f"{folder}/{_BUCKET}={r[_BUCKET]}")
            return self._commit(base, schema, {**(base["parts"] if base else {}), **fresh}, key=key, buckets=buckets)
        except BaseException:
            self._delete(folder)
            raise
        finally:
            self._delete(update)

    def expire(self, keep: int = 2) -> int:
        """Forget all but the newest ``keep`` versions, and delete the data folders that only they name. Returns how many versions went.

        Run it while nobody writes: folders of an unfinished write are named by no version yet, and stay.
        """
        numbers = self.versions()
        manifests = {n: self.manifest(n) for n in numbers}
        folders = lambda some: {p["folder"] for n in some for p in manifests[n]["parts"].values()}
        old, kept = numbers[: max(len(numbers) - keep, 0)], numbers[max(len(numbers) - keep, 0) :]
        unused = folders(old) - folders(kept)
        for n in old:  # a version disappears before its data do
            file, fs = _filesystem(self.spark, self._name(n))
            fs.delete(file, False)
        for folder in unused:
            self._delete(folder)
        return len(old)
