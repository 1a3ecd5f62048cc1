"""A stored table with one row per key, changed by whole buckets.

Layout below ``path``::

    data/<version>-<writer>/bucket=<n>/part-...  rows of one bucket, never changed once written
    manifest/<version>.json                      for every bucket the folder that holds its rows

A key's bucket follows from its hash.  An upsert reads and rewrites only the
buckets its keys fall into, in a folder of its own; the other buckets stay the
files they are.  The manifest is written last, under a name that must not exist
yet: readers see the table before or after an upsert, never half of it, an
upsert that dies leaves files nobody refers to, and of two at once one fails.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from letterscope.operators.loading import conform, last_write


class ConcurrentChange(RuntimeError):
    """Another writer has made the version this one was about to make."""


@dataclass(frozen=True)
class Upserted:
    version: int
    inserted: int
    updated: int
    buckets: int


class KeyedTable:
    """Access to one stored table; :meth:`create` makes a new one."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    @classmethod
    def create(cls, spark: SparkSession, path: str, schema: str | StructType, key: str, buckets: int = 64) -> KeyedTable:
        """An empty table.  Choose ``buckets`` so that a bucket is about a file: it is the unit that is rewritten."""
        table = cls(spark, path)
        declared = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        table._publish({"version": 0, "key": key, "buckets": buckets, "schema": declared.json(), "held": {}})
        return table

    # --- files ------------------------------------------------------------
    def _fs(self):
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        root = hadoop.Path(self.path)
        return hadoop, root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _versions(self) -> list[int]:
        hadoop, fs = self._fs()
        folder = hadoop.Path(f"{self.path}/manifest")
        names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith((".", "_")))

    def manifest(self, version: int | None = None) -> dict:
        """The newest manifest, or that of a version."""
        hadoop, fs = self._fs()
        chosen = self._versions()[-1] if version is None else version
        stream = fs.open(hadoop.Path(f"{self.path}/manifest/{chosen}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode("utf-8"))
        finally:
            stream.close()

    def _publish(self, manifest: dict) -> None:
        """Write beside and rename: the name appears with its whole content, and only if nobody has taken it."""
        hadoop, fs = self._fs()
        target = hadoop.Path(f"{self.path}/manifest/{manifest['version']}.json")
        fs.mkdirs(target.getParent())
        beside = hadoop.Path(f"{self.path}/manifest/_{manifest['version']}-{uuid.uuid4().hex}.json")
        stream = fs.create(beside, True)
        stream.write(bytearray(json.dumps(manifest).encode("utf-8")))
        stream.close()
        if fs.exists(target) or not fs.rename(beside, target):
            fs.delete(beside, False)
            raise ConcurrentChange(f"version {manifest['version']} of {self.path} exists already")

    # --- reading ----------------------------------------------------------
    def _bucket(self, manifest: dict) -> Column:
        return F.pmod(F.xxhash64(manifest["key"]), F.lit(manifest["buckets"])).cast("int")

    def _rows(self, manifest: dict, buckets: set[int] | None = None) -> DataFrame:
        schema = StructType.fromJson(json.loads(manifest["schema"]))
        held = {int(b): v for b, v in manifest["held"].items() if buckets is None or int(b) in buckets}
        paths = [f"{self.path}/data/{v}/bucket={b}" for b, v in sorted(held.items())]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def read(self, version: int | None = None) -> DataFrame:
        """Rows of the newest version, or of an older one that has not been vacuumed."""
        return self._rows(self.manifest(version))

    def lookup(self, keys: list) -> DataFrame:
        """Rows of the given keys; only their buckets are read."""
        manifest = self.manifest()
        schema = StructType.fromJson(json.loads(manifest["schema"]))
        field = schema[manifest["key"]]
        asked = self.spark.createDataFrame([(k,) for k in keys], StructType([field]))
        buckets = {r[0] for r in asked.select(self._bucket(manifest)).distinct().collect()}
        return self._rows(manifest, buckets).filter(F.col(manifest["key"]).isin(list(keys)))

    # --- writing ----------------------------------------------------------
    def upsert(self, new: DataFrame, *sequence: str) -> Upserted:
        """Put the rows of ``new`` in place of those with the same key, or beside them.

        Of several new rows with one key the last by ``sequence`` counts (of
        equals any one); ``sequence`` columns need not be stored.  A null key is an
        error.  Old rows move once, by bucket; new ones are ranked once.
        """
        manifest = self.manifest()
        key, version = manifest["key"], manifest["version"] + 1
        schema = StructType.fromJson(json.loads(manifest["schema"]))
        null_key = F.raise_error(F.lit(f"null in key column {key}"))
        latest = conform(last_write(new, key, *(sequence or (key,))), schema)
        latest = latest.withColumn(key, F.when(F.col(key).isNull(), null_key).otherwise(F.col(key)))
        folder = f"{version}-{uuid.uuid4().hex[:12]}"
        # Written once: the rows of this upsert, by bucket.
        arrived = f"{self.path}/data/{folder}-arrived"
        bucketed = latest.withColumn("bucket", self._bucket(manifest))
        bucketed.repartition("bucket").write.partitionBy("bucket").parquet(arrived)
        stored = StructType([*schema.fields]).add("bucket", "integer")
        fresh = self.spark.read.schema(stored).parquet(arrived)
        touched = {r["bucket"] for r in fresh.select("bucket").distinct().collect()}  # at most the number of buckets
        old = self._rows(manifest, touched).withColumn("bucket", self._bucket(manifest))
        both = old.withColumn("__new", F.lit(0)).unionByName(fresh.withColumn("__new", F.lit(1)))
        same_key = Window.partitionBy("bucket", key)
        ranked = (
            both.repartition("bucket")
            .withColumn("__rank", F.row_number().over(same_key.orderBy(F.desc("__new"))))
            .withColumn("__rows", F.count("*").over(same_key))
            .filter("__rank = 1")
        )
        counted = Observation()
        is_new = F.col("__new") == 1
        result = ranked.observe(
            counted, F.count_if(is_new & (F.col("__rows") == 1)).alias("inserted"),
            F.count_if(is_new & (F.col("__rows") > 1)).alias("updated"),
        ).drop("__new", "__rank", "__rows")
        if touched:
            result.write.partitionBy("bucket").parquet(f"{self.path}/data/{folder}")
        held = {**manifest["held"], **{str(b): folder for b in sorted(touched)}}
        self._publish({**manifest, "version": version, "held": held})
        hadoop, fs = self._fs()
        fs.delete(hadoop.Path(arrived), True)
        numbers = counted.get if touched else {"inserted": 0, "updated": 0}
        return Upserted(version, numbers["inserted"], numbers["updated"], len(touched))

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete all manifests but the newest ``keep``, and the folders that only those refer to; returns the folders."""
        hadoop, fs = self._fs()
        versions = self._versions()
        old, kept = ([self.manifest(v)["held"].values() for v in some] for some in (versions[:-keep], versions[-keep:]))
        gone = sorted({f for held in old for f in held} - {f for held in kept for f in held})
        for v in versions[:-keep]:
            fs.delete(hadoop.Path(f"{self.path}/manifest/{v}.json"), False)
        for folder in gone:
            fs.delete(hadoop.Path(f"{self.path}/data/{folder}"), True)
        return gone
