"""Tables whose rows change in place at the cost of a batch, by Spark's own writer.

Rows lie in folders by the hash of a key. A batch opens only the folders of its keys and writes those anew, each under the
batch's number (``_bucket=12/_version=7``); nothing is deleted, so readers and a batch that has to be repeated find what was
there before. The latest version of a folder holds. A repeated batch starts from the version before its own and
overwrites what it wrote of itself (dynamic partition overwrite), so it changes nothing twice, even if only a part of its
folders had been written. One stream writes a table; versions are its batch numbers plus one.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET, VERSION = "_bucket", "_version"
_FOLDER = re.compile(f"/{BUCKET}=(\\d+)/{VERSION}=(\\d+)/")


class Buckets:
    """``by``: the column whose hash tells the folder, ``n``: the number of folders, which stays."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, by: str, n: int):
        self.spark, self.path, self.schema, self.by, self.n = spark, path.rstrip("/"), schema, by, n
        self._full = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType()), T.StructField(VERSION, T.LongType())])

    def bucket_of(self, column: str | Column | None = None) -> Column:
        return F.pmod(F.xxhash64(F.col(self.by) if column is None else column), F.lit(self.n)).cast("int")

    def create(self, rows: DataFrame) -> None:
        """The table's first content, version 0."""
        self.write(rows, 0)

    def write(self, rows: DataFrame, version: int) -> None:
        """Write the buckets of ``rows`` anew; a bucket's rows have to be all it holds."""
        typed = rows.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields])
        (
            typed.withColumns({BUCKET: self.bucket_of(), VERSION: F.lit(version)})
            .hint("rebalance", BUCKET)
            .write.partitionBy(BUCKET, VERSION)
            .mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .parquet(self.path)
        )

    def versions(self, before: int | None = None, buckets: Iterable[int] | None = None) -> dict[int, int]:
        """Bucket -> its latest version (under ``before``)."""
        wanted = None if buckets is None else {*buckets}
        found: dict[int, int] = {}
        for file in self.spark.read.schema(self._full).parquet(self.path).inputFiles():
            bucket, version = map(int, _FOLDER.search(file).groups())
            if (before is None or version < before) and (wanted is None or bucket in wanted):
                found[bucket] = max(version, found.get(bucket, -1))
        return found

    def rows(self, before: int | None = None, buckets: Iterable[int] | None = None) -> DataFrame:
        """The table, or some buckets of it, as it is or as it was before a version."""
        folders = [f"{self.path}/{BUCKET}={b}/{VERSION}={v}" for b, v in self.versions(before, buckets).items()]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self._full).option("basePath", self.path).parquet(*folders).select(*self.schema.names)

    def touched(self, keys: DataFrame) -> list[int]:
        """Buckets of the keys in a frame with the column ``by``."""
        return sorted(row[0] for row in keys.select(self.bucket_of()).distinct().collect())  # ``n`` at most

    def update(self, version: int, keys: DataFrame, change: Callable[[DataFrame], DataFrame]) -> list[int]:
        """Write the buckets of ``keys`` anew: ``change`` gets their rows before ``version`` and returns all they hold after it."""
        buckets = self.touched(keys)
        if buckets:
            self.write(change(self.rows(version, buckets)), version)
        return buckets


class Batches:
    """Rows added by numbered batches, a folder each; writing a batch again replaces it.

    ``apart``: columns whose values lie in folders of their own inside a batch, so that rows of one kind are read without the others.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, apart: Iterable[str] = ()):
        self.spark, self.path, self.schema, self.apart = spark, path.rstrip("/"), schema, [*apart]

    def put(self, number: int, rows: DataFrame) -> None:
        typed = rows.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields])
        typed.write.mode("overwrite").partitionBy(*self.apart).parquet(f"{self.path}/{VERSION}={number}")

    def _numbers(self) -> list[int]:
        files, path = _files(self.spark, self.path)
        if not files.exists(path):
            return []
        names = [status.getPath().getName() for status in files.listStatus(path)]
        return sorted(int(name.split("=")[1]) for name in names if name.startswith(f"{VERSION}="))

    def of(self, number: int) -> DataFrame:
        """One batch; none if it was never put."""
        if number not in self._numbers():
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/{VERSION}={number}")

    def last(self, before: int) -> DataFrame:
        """The latest batch under a number."""
        earlier = [n for n in self._numbers() if n < before]
        return self.of(earlier[-1] if earlier else -1)

    def rows(self) -> DataFrame:
        return self.rows_by_number().drop("number")

    def rows_by_number(self) -> DataFrame:
        """All rows with the number of their batch."""
        full = T.StructType([*self.schema.fields, T.StructField(VERSION, T.LongType())])
        rows = self.spark.read.schema(full).parquet(self.path) if self._numbers() else self.spark.createDataFrame([], full)
        return rows.withColumnRenamed(VERSION, "number")


class Kind:
    """The rows of numbered batches that fulfil a condition, with some of their columns."""

    def __init__(self, batches: Batches, condition: str, columns: Iterable[str]):
        self.batches, self.condition, self.columns = batches, condition, [*columns]

    def _chosen(self, rows: DataFrame) -> DataFrame:
        return rows.filter(self.condition).select(*self.columns)

    def of(self, number: int) -> DataFrame:
        return self._chosen(self.batches.of(number))

    def last(self, before: int) -> DataFrame:
        return self._chosen(self.batches.last(before))

    def rows(self) -> DataFrame:
        return self._chosen(self.batches.rows())


def _files(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), found
