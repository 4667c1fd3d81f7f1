"""A compute-once cache that notices changed input and shows no unfinished result.

A result has a key: a fingerprint of its inputs and of what the caller says about the computation. It is
written aside, in a folder that readers skip, and published by one rename to the folder of its key. So a
folder with that name is whole, a killed writer leaves only what nobody reads, and changed input
asks for another folder. Renames must be atomic, as on HDFS and local disks.
"""

from __future__ import annotations

import hashlib
import time
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F

ASIDE = ".writing-"


def rows_fingerprint(df: DataFrame) -> str:
    """Digest of a frame's rows in any order, of their number, and of its column names and types.

    One pass, from which each task sends a few numbers. The sum tells repeated rows apart, which a bare xor would cancel.
    """
    named = [F.col(f"`{c}`") for c in df.columns]
    low, high = F.xxhash64(*named), F.xxhash64(F.lit("again"), *named)
    found = df.agg(
        F.count(F.lit(1)), F.sum(low.cast("decimal(38,0)")), F.sum(high.cast("decimal(38,0)")), F.bit_xor(low), F.bit_xor(high)
    ).first()
    return hashlib.sha256(f"{df.schema.json()}|{tuple(map(str, found))}".encode()).hexdigest()


def files_fingerprint(spark: SparkSession, *paths: str) -> str:
    """Digest of the names, lengths and times of the files below some paths; no content is read."""
    listed = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
        .select("path", "length", "modificationTime")
    )
    return rows_fingerprint(listed)


class Published:
    """Results below ``root``, a folder for each key."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        hadoop = spark._jvm.org.apache.hadoop.fs
        self._path = hadoop.Path
        self._files = hadoop.Path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())
        self._context = hadoop.FileContext.getFileContext(self._files.getUri(), spark._jsc.hadoopConfiguration())

    def _folder(self, key: str):
        return self._files.makeQualified(self._path(f"{self.root}/{key}"))

    def key(self, *inputs: DataFrame | str, **about: object) -> str:
        """The key of a result computed from frames and paths; ``about`` names versions, parameters and the like."""
        parts = [
            files_fingerprint(self.spark, i) if isinstance(i, str) else rows_fingerprint(i) for i in inputs
        ]
        return hashlib.sha256(repr((parts, sorted(about.items()))).encode()).hexdigest()[:32]

    def exists(self, key: str) -> bool:
        return self._files.exists(self._folder(key))

    def read(self, key: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{key}")

    def publish(self, key: str, result: DataFrame) -> None:
        """Write aside, then rename. Of two writers of one key the first to rename wins, and the other's copy goes."""
        aside = f"{self.root}/{ASIDE}{key}-{uuid.uuid4().hex}"
        try:
            result.write.parquet(aside)
            options = self.spark.sparkContext._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
            self._context.rename(self._files.makeQualified(self._path(aside)), self._folder(key), options)
        except Py4JJavaError as failed:
            if "FileAlreadyExistsException" not in str(failed.java_exception.getClass().getName()):
                raise
        finally:
            self._files.delete(self._path(aside), True)

    def sweep(self, hours: float = 24.0) -> int:
        """Delete what killed writers left aside longer ago than ``hours``; returns how many folders."""
        gone, limit = 0, (time.time() - hours * 3600) * 1000
        if not self._files.exists(self._path(self.root)):
            return 0
        for status in self._files.listStatus(self._path(self.root)):
            if status.getPath().getName().startswith(ASIDE) and status.getModificationTime() < limit:
                gone += bool(self._files.delete(status.getPath(), True))
        return gone

    def get(self, compute: Callable[[], DataFrame], *inputs: DataFrame | str, **about: object) -> DataFrame:
        """The result for these inputs, computed and published first when there is none."""
        key = self.key(*inputs, **about)
        if not self.exists(key):
            self.publish(key, compute())
        return self.read(key)
