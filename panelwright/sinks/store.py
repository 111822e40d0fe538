"""Release folders on the file system that Spark writes to, whichever it is.

Driver and executors name one place: paths go through Hadoop's file system, never through the
driver's own disk.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Store:
    """A folder; ``path`` is its full name."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        given = spark._jvm.org.apache.hadoop.fs.Path(path)
        self._fs = given.getFileSystem(spark._jsc.hadoopConfiguration())
        self._path = self._fs.makeQualified(given)
        self.path = self._path.toString()

    def _at(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}") if name else self._path

    def exists(self, name: str = "") -> bool:
        return self._fs.exists(self._at(name))

    def make(self) -> None:
        self._fs.mkdirs(self._path)

    def delete(self) -> None:
        self._fs.delete(self._path, True)

    def write_text(self, name: str, text: str) -> None:
        out = self._fs.create(self._at(name), False)
        out.write(bytearray(text.encode("utf-8")))
        out.close()

    def rename(self, target: Store) -> None:
        if not self._fs.rename(self._path, target._path):
            raise OSError(f"{self.path} could not take the name {target.path}")


class Staged:
    """Writes into a folder beside the target and gives it its name in the end; a failure leaves no target."""

    def __init__(self, spark: SparkSession, target: str):
        self.target = Store(spark, target)
        if self.target.exists():
            raise FileExistsError(target)
        parent, _, name = self.target.path.rpartition("/")
        self.stage = Store(spark, f"{parent}/building-{name}-{uuid.uuid4().hex[:8]}")

    def __enter__(self) -> Store:
        self.stage.make()
        return self.stage

    def __exit__(self, kind, *_) -> None:
        if kind is not None:
            self.stage.delete()
        elif self.target.exists():
            self.stage.delete()
            raise FileExistsError(self.target.path)
        else:
            self.stage.rename(self.target)


def inventory(spark: SparkSession, folder: str) -> DataFrame:
    """(path, bytes, sha256) of every file that holds data; executors read and hash the files.

    Marker files (names that start with ``_`` or ``.``) are no part of a release.  A file is
    hashed in one piece, so it must be below two gigabytes, as files of a release are.
    """
    root = Store(spark, folder).path
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    bare = F.regexp_replace("path", r"\Afile:/+", "/")
    start = len("/" + root[5:].lstrip("/")) if root.startswith("file:") else len(root)
    return found.select(F.substring(bare, start + 2, 10_000).alias("path"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def verify(spark: SparkSession, folder: str, listed: DataFrame) -> None:
    """Raises unless the folder holds exactly the listed files, unchanged."""
    have = inventory(spark, folder).select("path", F.col("sha256").alias("is"))
    met = listed.select("path", F.col("sha256").alias("was")).join(have, "path", "full").where(~F.col("was").eqNullSafe(F.col("is")))
    try:
        bad = [r["path"] for r in met.select("path").limit(10).collect()]
    except (Py4JError, PySparkException) as e:  # a file that fails the file system's own checksum
        raise ValueError(f"a file of {folder} cannot be read as it was written") from e
    if bad:
        raise ValueError(f"missing, new or changed files: {sorted(bad)}")
