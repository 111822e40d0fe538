"""Session settings and lineage cutting shared by all operators."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructType

#: Bytes of rows up to which a written table may be broadcast whatever the threshold of its files.
BROADCAST_BYTES = 16 << 20

_FOLDER: str | None = None


def local_session(cpus: str = "*", partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("panelwright")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder of the session.

    The folder named in ``spark.checkpoint.dir`` is used where it is set: all
    executors share it, so a lost executor loses nothing.  Only a local session
    without that setting gets a temporary folder; elsewhere the setting is required.
    """
    sc = spark.sparkContext
    have = sc.getCheckpointDir()
    if have:
        return have
    wanted = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not wanted:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        wanted = tempfile.mkdtemp(prefix="panelwright-ckpt-")
    sc.setCheckpointDir(wanted)
    return sc.getCheckpointDir() or wanted


def _run_folder(spark: SparkSession) -> str:
    """The folder of this session's written tables, below the shared checkpoint folder.

    It goes when the driver's Python ends; tables of a loop go as soon as :func:`drop` is called.
    """
    global _FOLDER
    base = ensure_checkpoint_dir(spark)
    if _FOLDER is None or not _FOLDER.startswith(base):
        _FOLDER = f"{base.rstrip('/')}/tables-{uuid.uuid4().hex}"
        atexit.register(_remove, spark, _FOLDER)
    return _FOLDER


def _remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder through the file system that the path names; a session that has ended is no error."""
    try:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    except Exception:  # noqa: BLE001 - cleaning up must not hide the result
        pass


def _leaves(kind: DataType) -> int:
    """Atomic values in one value of a type, with one element of each array and map."""
    if isinstance(kind, StructType):
        return sum(_leaves(f.dataType) for f in kind.fields)
    return _leaves(kind.elementType) if isinstance(kind, ArrayType) else 1 + _leaves(kind.valueType) if isinstance(kind, MapType) else 1


def _row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row takes in memory; 32 for a value in an array, map or struct."""
    total = F.lit(16).cast("bigint")
    for f in df.schema.fields:
        c, kind = F.col("`" + f.name.replace("`", "``") + "`"), f.dataType
        many = F.greatest(F.lit(0), F.size(c)) if isinstance(kind, (ArrayType, MapType)) else F.lit(1)
        total += 8 + F.coalesce(F.octet_length(c), F.lit(0)) if isinstance(kind, StringType) else many * 32 * _leaves(kind) if isinstance(kind, (ArrayType, MapType, StructType)) else F.lit(8)
    return total


def _threshold(spark: SparkSession) -> int:
    """The size of files up to which the optimiser broadcasts a table."""
    return spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def cut(df: DataFrame) -> DataFrame:
    """Writes ``df`` below the shared checkpoint folder and reads it back: same rows, no lineage.

    A written table is compressed, is read column by column, and brings its true size, so the
    optimiser plans on facts; a checkpointed one would carry estimates that, over the rounds of
    an iteration, grow to numbers that take minutes to multiply.  All executors share the
    folder, so one that is lost takes nothing with it.

    Files of columns that repeat may be a hundredth of their rows, and the optimiser knows the
    files only: a table whose rows are too many to pass through the driver is joined by merging.
    """
    spark = df.sparkSession
    path = f"{_run_folder(spark)}/{uuid.uuid4().hex}"
    seen = Observation()
    df.observe(seen, F.sum(_row_bytes(df)).alias("bytes")).write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    if (seen.get["bytes"] or 0) > max(_threshold(spark), BROADCAST_BYTES):
        out = out.hint("merge")
    out._written = path
    return out


def drop(df: DataFrame) -> None:
    """Deletes the files of a table of :func:`cut` that no later step reads."""
    path = getattr(df, "_written", None)
    if path:
        _remove(df.sparkSession, path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One Parquet table of a data folder."""
    return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))
