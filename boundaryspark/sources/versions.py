"""A table of one row per key that is updated in part: every version names the files it consists of.

Rows lie in files by the hash of their key.  A batch writes new files for the key buckets that it touches only, and a manifest that
takes all other files over from the version before, so the cost of a batch follows the batch.  Versions are numbered by the caller (a stream's batch
number): a batch that is tried again writes the same files and manifest again, and older versions stay readable.

    <path>/files/version=<n>/bucket=<b>/    rows of a bucket as of version n
    <path>/manifest/version=<n>/            (bucket, holder): the version whose files hold the bucket
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boundaryspark.runtime import materialize

BUCKETS = 64


class VersionedTable:
    """The newest row per key, by `order`; all versions of a table have the same number of buckets."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], order: str, buckets: int = BUCKETS) -> None:
        self.spark, self.path, self.keys, self.order, self.buckets = spark, path.rstrip("/"), keys, order, buckets

    def manifest(self, version: int) -> DataFrame:
        return self.spark.read.schema("bucket int, holder long").parquet(f"{self.path}/manifest/version={version}")

    def versions(self) -> list[int]:
        """Numbers of the versions with a manifest, in order."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/manifest")
        files = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(folder):
            return []
        names = [s.getPath() for s in files.listStatus(folder) if s.isDirectory()]
        done = [p for p in names if files.exists(self.spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
        return sorted(int(p.getName().removeprefix("version=")) for p in done)

    def _rows(self, held: list[tuple[int, int]], schema) -> DataFrame:
        """Rows of (bucket, holder) files."""
        if not held:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/files/version={v}/bucket={b}" for b, v in held])

    def upsert(self, batch: DataFrame, version: int) -> None:
        """Write version `version` from the newest one below it and a batch."""
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        fresh = materialize(batch.withColumn("bucket", bucket), "upsert")
        touched = sorted(r["bucket"] for r in fresh.select("bucket").distinct().collect())  # at most `buckets`
        before = [v for v in self.versions() if v < version]
        old = [(r["bucket"], r["holder"]) for r in self.manifest(before[-1]).collect()] if before else []
        others = [c for c in batch.columns if c not in self.keys]
        kept = self._rows([(b, v) for b, v in old if b in set(touched)], batch.schema)
        rows = kept.withColumn("bucket", bucket).unionByName(fresh)
        newest = rows.groupBy("bucket", *self.keys).agg(F.max_by(F.struct(*others), F.col(self.order)).alias("_r")).select("bucket", *self.keys, "_r.*")
        # one file for each touched bucket; the expression keeps this shuffle apart from the aggregate's
        spread = newest.repartition(max(1, len(touched)), F.xxhash64("bucket"))
        spread.select("bucket", *batch.columns).write.partitionBy("bucket").mode("overwrite").parquet(f"{self.path}/files/version={version}")
        now = {**dict(old), **{b: version for b in touched}}
        listed = self.spark.createDataFrame(sorted(now.items()), "bucket int, holder long")
        listed.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/version={version}")

    def read(self, schema, version: int | None = None) -> DataFrame:
        """Rows of a version, the newest if None; without any, no rows of `schema`."""
        known = self.versions()
        if version is None and not known:
            return self.spark.createDataFrame([], schema)
        return self._rows([(r["bucket"], r["holder"]) for r in self.manifest(known[-1] if version is None else version).collect()], schema)
