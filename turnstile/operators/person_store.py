"""A table kept by buckets of its key, rewritten bucket by bucket (SNK3).

Rows lie in ``buckets`` folders by hash of the key.  A *version* is one small file in ``log/`` that names the folder of each
bucket; readers resolve the newest, so they see whole versions only.  An update finds the rows that would change, writes
anew just the buckets that hold one, and commits a version that names those and, for all others, the parent's folders.

Commits are optimistic: version ``n + 1`` comes into being by renaming a finished file to its name, which fails if that name
is there.  Of two publishers that started from one parent, one wins and the other gets :class:`Conflict`; nothing of its
data is ever referenced.  It may read again and retry.  The log goes through Hadoop's file interface, so it lies wherever
the data do.  Only bucket numbers and folder names reach the driver, never rows; there are at most ``buckets`` of each.

Defined results: keys are unique and not null (rows without one are refused).  An update sets columns of rows that are
there; keys the table doesn't have are left out; equal values, null ones included, are no change; an update that changes
nothing commits nothing and returns its parent.  A replay of a committed update changes nothing, too.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstile.sources import files


class Conflict(RuntimeError):
    """Another publisher committed first."""


class PersonStore:
    def __init__(self, spark: SparkSession, root: str, key: str = "idperson", buckets: int = 64) -> None:
        self.spark, self.root, self.key, self.buckets = spark, root.rstrip("/"), key, buckets

    # -- versions -------------------------------------------------------
    def versions(self) -> list[int]:
        """Committed versions, oldest first."""
        found = files.names(self.spark, f"{self.root}/log")
        return sorted(int(n[:-5]) for n in found if n.endswith(".json") and n[:-5].isdigit())

    def _entry(self, version: int | None) -> dict:
        if version is None:
            version = max(self.versions(), default=None)
        text = None if version is None else files.read_text(self.spark, f"{self.root}/log/{version:020d}.json")
        if text is None:
            raise FileNotFoundError(f"no committed version under {self.root}")
        return json.loads(text)

    def _commit(self, entry: dict) -> int:
        try:
            files.write_text(self.spark, f"{self.root}/log/{entry['version']:020d}.json", json.dumps(entry), replace=False)
        except files.AlreadyThere as error:
            raise Conflict(f"version {entry['version']} was committed by another publisher") from error
        return entry["version"]

    # -- rows -----------------------------------------------------------
    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame) -> dict[str, str]:
        """Writes rows by bucket; the folder of each bucket that has any."""
        path = f"{self.root}/data/commit={uuid.uuid4().hex}"
        (rows.withColumn("_bucket", self._bucket()).repartition(self.buckets, "_bucket").sortWithinPartitions("_bucket", self.key)
         .write.partitionBy("_bucket").parquet(path))
        found = files.names(self.spark, path)
        return {n.split("=")[1]: f"{path}/{n}" for n in found if n.startswith("_bucket=")}

    def create(self, rows: DataFrame) -> int:
        """Version 0, with every row."""
        checked = rows.withColumn(self.key, F.when(F.col(self.key).isNull(), F.raise_error(F.lit(f"{self.key} is null"))).otherwise(F.col(self.key)))
        return self._commit({"version": 0, "parent": None, "schema": rows.schema.jsonValue(), "paths": self._write(checked)})

    def read(self, version: int | None = None, buckets: list[str] | None = None) -> DataFrame:
        """A version's rows (the newest without a number), of all or some buckets."""
        entry = self._entry(version)
        schema = T.StructType.fromJson(entry["schema"])
        paths = [p for b, p in entry["paths"].items() if buckets is None or b in buckets]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def paths(self, version: int | None = None) -> dict[str, str]:
        return self._entry(version)["paths"]

    def update(self, changes: DataFrame, parent: int | None = None) -> int:
        """Sets the columns of ``changes(key, ...)``, one row for each key, on top of version ``parent`` (the newest
        without a number).  Returns the version that holds them."""
        entry = self._entry(parent)
        columns = [c for c in changes.columns if c != self.key]
        kinds = {f.name: f.dataType for f in T.StructType.fromJson(entry["schema"])}
        new = changes.select(F.col(self.key).alias("_k"), *[F.col(c).cast(kinds[c]).alias(f"_{i}") for i, c in enumerate(columns)])
        differs = F.lit(False)
        for i, c in enumerate(columns):
            differs = differs | ~F.col(c).eqNullSafe(F.col(f"_{i}"))
        now = self.read(entry["version"])
        # the key and the changed columns alone are read here
        moved = (now.select(self.key, *columns).join(new, F.col(self.key) == F.col("_k")).where(differs)
                 .select(self._bucket().alias("b")).distinct())
        changed = sorted(str(r.b) for r in moved.collect())          # at most one row per bucket
        if not changed:
            return entry["version"]
        old = self.read(entry["version"], changed)
        rows = old.join(new, F.col(self.key) == F.col("_k"), "left")
        there = F.col("_k").isNotNull()
        rows = rows.select(*[F.when(there, F.col(f"_{columns.index(c)}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in old.columns])
        return self._commit({"version": entry["version"] + 1, "parent": entry["version"], "schema": entry["schema"],
                             "paths": {**entry["paths"], **self._write(rows)}})
