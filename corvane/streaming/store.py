"""Keyed tables in hash buckets: a batch reads and writes only the buckets of its keys, and a lookup reads only its key's.

Files are plain Parquet, sorted by key and with Bloom filters on it, so that of a bucket only the row groups that may hold a key are read.
A batch is first staged as a whole and then published by overwriting its buckets; until it is published it can be published again, so a job that is lost
in between is run again without computing anything anew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Buckets of a new table; a table keeps the number that it began with.
BUCKETS = 256
#: Up to so many keys are told to the scan one by one, where Bloom filters can leave out row groups; more are told by their buckets. Both find the same rows.
LISTED = 500


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.delete(p, True)


class BucketedTable:
    """Rows of ``schema`` under ``path``, in buckets by ``key``."""

    def __init__(self, spark: SparkSession, path: str, schema: str, key: str, buckets: int = BUCKETS, group_bytes: int | None = None) -> None:
        self.spark, self.path, self.schema, self.key = spark, path.rstrip("/"), schema, key
        self.columns = spark.createDataFrame([], schema).columns
        self.buckets, self.group_bytes = self._known_buckets() or buckets, group_bytes

    def _known_buckets(self) -> int | None:
        p, fs = _path(self.spark, f"{self.path}/data")
        names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
        found = [int(n.split("=")[1]) for n in names if n.startswith("buckets=")]
        return found[0] if found else None

    @property
    def data(self) -> str:
        return f"{self.path}/data/buckets={self.buckets}"

    def bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key.cast("string")), F.lit(self.buckets)).cast("int")

    def _stored(self, path: str) -> DataFrame:
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], f"{self.schema}, bucket int")
        return self.spark.read.schema(f"{self.schema}, bucket int").parquet(path)

    def read(self, buckets: list[int] | None = None) -> DataFrame:
        """The table, or some buckets of it; other buckets' files aren't listed in the plan."""
        rows = self._stored(self.data)
        return (rows if buckets is None else rows.where(F.col("bucket").isin(buckets) if buckets else F.lit(False))).select(self.columns)

    def touched(self, keys: DataFrame) -> list[int]:
        """The buckets of some keys: at most as many numbers as there are buckets."""
        return sorted(r[0] for r in keys.select(self.bucket(F.col(self.key))).distinct().collect())

    def lookup(self, *keys: str) -> DataFrame:
        """Rows of a few keys; the scan is told buckets and keys."""
        places = [self.bucket(F.lit(k)) for k in keys]
        return self._stored(self.data).where(F.col("bucket").isin(places) & F.col(self.key).isin(list(keys))).select(self.columns)

    def matching(self, keys: DataFrame) -> DataFrame:
        """Rows of the keys of a table."""
        few = [r[0] for r in keys.select(self.key).distinct().limit(LISTED + 1).collect()]
        if len(few) <= LISTED:
            return self.lookup(*few) if few else self.spark.createDataFrame([], self.schema)
        return self.read(self.touched(keys)).join(keys.select(self.key).distinct(), self.key, "left_semi")

    def write(self, rows: DataFrame, path: str, mode: str) -> None:
        told = rows.select(*self.columns, self.bucket(F.col(self.key)).alias("bucket"))
        writer = told.repartition("bucket").sortWithinPartitions("bucket", self.key).write.mode(mode).partitionBy("bucket")
        writer = writer.option("partitionOverwriteMode", "dynamic").option(f"parquet.bloom.filter.enabled#{self.key}", "true")
        (writer.option("parquet.block.size", str(self.group_bytes)) if self.group_bytes else writer).parquet(path)

    def overwrite(self, rows: DataFrame) -> None:
        """Put ``rows`` in place of all that their buckets hold. Buckets without rows stay as they are."""
        self.write(rows, self.data, "overwrite")

    def append(self, rows: DataFrame) -> None:
        self.write(rows, self.data, "append")

    def files(self) -> dict[int, int]:
        """How many files each bucket has."""
        out = {}
        p, fs = _path(self.spark, self.data)
        for folder in fs.listStatus(p) if fs.exists(p) else []:
            name = folder.getPath().getName()
            if name.startswith("bucket="):
                out[int(name.split("=")[1])] = sum(1 for f in fs.listStatus(folder.getPath()) if f.getPath().getName().startswith("part-"))
        return out

    def tidy(self, most: int = 16) -> list[int]:
        """Rewrite buckets of more than ``most`` files as one file, each key once; returns them."""
        crowded = sorted(b for b, n in self.files().items() if n > most)
        if crowded:
            staged = f"{self.path}/tidied"
            self.write(self.read(crowded).dropDuplicates([self.key]), staged, "overwrite")
            self.overwrite(self._stored(staged).select(self.columns))
            remove(self.spark, staged)
        return crowded


class Staging:
    """One batch on its way into tables: staged as a whole, then published, which may be done again."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, f"{path.rstrip('/')}/staged"

    @property
    def _mark(self) -> str:
        return f"{self.path}/_READY"

    def ready(self) -> bool:
        return exists(self.spark, self._mark)

    def stage(self, **parts: DataFrame) -> None:
        remove(self.spark, self.path)
        for name, rows in parts.items():
            rows.write.parquet(f"{self.path}/{name}")
        p, fs = _path(self.spark, self._mark)
        fs.create(p, True).close()

    def part(self, name: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    def done(self) -> None:
        remove(self.spark, self._mark)
        remove(self.spark, self.path)
