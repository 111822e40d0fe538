"""Incremental use of the batch operators: late snapshots and event windows as streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.operators.keys import keep_last


#: Parts of a refreshed table; a batch rewrites the parts that its keys fall into.
PARTS = 64


def refresh(stream: DataFrame, target: str, keys: list[str], order: list[str], checkpoint: str, parts: int = PARTS) -> object:
    """Keeps the last row of each key in a versioned Parquet table; one new version per batch.

    The table is cut into parts by hash of the key.  A batch is merged with the newest version
    of the parts it touches and only these are written, beside the old ones, so a reader never
    sees a half-written part, and a batch that is replayed gives the same rows again.  Of each
    part the version before stays for readers that have begun; older ones are removed.
    """

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        part = F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int")
        touched = [r["part"] for r in batch.select(part.alias("part")).distinct().collect()]  # at most ``parts`` numbers
        held = versions(spark, target, number)
        old = [held[p][-1] for p in touched if p in held]
        both = spark.read.parquet(*[path for _, path in old]).unionByName(batch) if old else batch
        last = keep_last(both, keys, order).withColumn("__part", part)
        last.repartition("__part").write.partitionBy("__part").mode("overwrite").parquet(f"{target}/version={number}")
        for p in touched:
            for _, path in held.get(p, [])[:-1]:
                gone = spark._jvm.org.apache.hadoop.fs.Path(path)
                gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, True)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def versions(spark: SparkSession, target: str, below: int | None = None) -> dict[int, list[tuple[int, str]]]:
    """(version, path) of each part of a refreshed table, oldest first (older than ``below``)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    out: dict[int, list[tuple[int, str]]] = {}
    if not fs.exists(path):
        return out
    for v in fs.listStatus(path):
        name = v.getPath().getName()
        if not name.startswith("version=") or not fs.exists(spark._jvm.org.apache.hadoop.fs.Path(v.getPath(), "_SUCCESS")):
            continue  # a version that is being written
        number = int(name.split("=")[1])
        if below is not None and number >= below:
            continue
        for p in fs.listStatus(v.getPath()):
            if p.getPath().getName().startswith("__part="):
                out.setdefault(int(p.getPath().getName().split("=")[1]), []).append((number, p.getPath().toString()))
    return {k: sorted(found) for k, found in out.items()}


def latest(spark: SparkSession, target: str, below: int | None = None) -> DataFrame | None:
    """The newest rows of a refreshed table (older than ``below``), or nothing if it is not there."""
    held = versions(spark, target, below)
    return spark.read.parquet(*[found[-1][1] for found in held.values()]) if held else None


def windowed_counts(events: DataFrame, time: str, keys: list[str], window: str, late: str) -> DataFrame:
    """Counts per tumbling window; rows later than ``late`` are left out once their window has closed.

    Timestamps without zone are read as UTC, as a watermark needs an instant.
    """
    at = events.withColumn("__t", F.col(time).cast("timestamp")).withWatermark("__t", late)
    return at.groupBy(F.window("__t", window), *keys).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("window_start"), *keys, "n")


def run_once(df: DataFrame, name: str, checkpoint: str, mode: str = "append", each: Callable[[DataFrame, int], None] | None = None) -> object:
    """Works off what is there and stops; results go to ``each`` or to an in-memory table."""
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    query = (writer.foreachBatch(each) if each else writer.format("memory").queryName(name)).start()
    query.awaitTermination()
    return query
