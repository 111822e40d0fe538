"""Joins and orderings that stay balanced when one key holds a third of all rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A key is hot above this many rows, or above 1/MAX_HOT of all rows if that is more;
#: so there are never more than MAX_HOT hot keys, which bounds what is broadcast.
HOT_ROWS = 20_000
MAX_HOT = 2_000


def hot_limit(n_rows: int) -> int:
    """Rows from which a key counts as hot in a table of ``n_rows`` rows."""
    return max(HOT_ROWS, -(-n_rows // MAX_HOT))


def _on(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]) -> Column:
    return reduce(lambda a, b: a & b, (left[x] == right[y] for x, y in pairs))


def lookup(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]], take: dict[str, str], n_left: int, how: str = "left") -> DataFrame:
    """Left (or inner) join of ``left`` with a table whose key is unique.

    ``pairs`` are (left column, right column); ``take`` maps new column names to columns of
    ``right``.  Keys of ``left`` with more rows than :func:`hot_limit` are joined by
    broadcast (at most ``MAX_HOT`` rows of ``right``), the others by shuffle.  Rows with a
    null key match nothing: they take no part in any join and stay where they are.
    """
    keys = [x for x, _ in pairs]
    right = right.select(*[F.col(y).alias(f"__k{i}") for i, (_, y) in enumerate(pairs)], *[F.col(v).alias(k) for k, v in take.items()])
    renamed = [(x, f"__k{i}") for i, x in enumerate(keys)]
    drop = [f"__k{i}" for i in range(len(keys))]
    known = reduce(lambda a, b: a & b, (F.col(x).isNotNull() for x in keys))
    told = left.where(known)

    def whole(joined: DataFrame) -> DataFrame:
        if how == "inner":
            return joined
        return joined.unionByName(left.where(~known).withColumns({k: F.lit(None).cast(right.schema[k].dataType) for k in take}))

    if n_left <= hot_limit(n_left):
        return whole(told.join(right, _on(told, right, renamed), how).drop(*drop))
    counts = told.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > hot_limit(n_left))
    hot = [tuple(r[k] for k in keys) for r in counts.select(*keys).collect()]  # at most MAX_HOT keys
    if not hot:
        return whole(told.join(right, _on(told, right, renamed), how).drop(*drop))
    spark = left.sparkSession
    schema = left.select(*keys).schema
    hot_keys = spark.createDataFrame(hot, schema).toDF(*drop)
    mark = F.broadcast(hot_keys.withColumn("__hot", F.lit(True)))
    marked = told.join(mark, _on(told, mark, renamed), "left").drop(*drop)
    few = right.join(F.broadcast(hot_keys), drop, "left_semi")
    hot_left, cold_left = marked.where("__hot").drop("__hot"), marked.where("__hot IS NULL").drop("__hot")
    a = hot_left.join(F.broadcast(few), _on(hot_left, few, renamed), how).drop(*drop)
    b = cold_left.join(right, _on(cold_left, right, renamed), how).drop(*drop)
    return whole(a.unionByName(b))


def prefix_sum(df: DataFrame, group: list[str], order: str, value: str, out: str, spread: int = 5_000) -> DataFrame:
    """Exclusive running sum of ``value`` within ``group`` without one task per group.

    The order inside a group is any fixed order (by bucket, then ``order``, which is unique in a
    group).  A group of n rows is cut into n / ``spread`` buckets by hash: sums per bucket are
    partial aggregates, the window over a group sees its buckets only, and the window over rows
    sees one bucket only.
    """
    sizes = df.groupBy(*group).agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / spread)).cast("int").alias("__b"))
    n_big = sizes.where("__b > 1")
    big = F.broadcast(n_big) if n_big.count() <= MAX_HOT else n_big
    rows = df.join(big, group, "left").withColumn("__bucket", F.pmod(F.xxhash64(order), F.coalesce("__b", F.lit(1)))).drop("__b")
    by_group, by_bucket = Window.partitionBy(*group).orderBy("__bucket"), Window.partitionBy(*group, "__bucket").orderBy(order)
    sums = rows.groupBy(*group, "__bucket").agg(F.sum(value).alias("__s"))
    before = sums.withColumn("__before", F.sum("__s").over(by_group.rowsBetween(Window.unboundedPreceding, -1))).drop("__s")
    inside = rows.withColumn("__inside", F.sum(value).over(by_bucket.rowsBetween(Window.unboundedPreceding, -1)))
    return inside.join(before, [*group, "__bucket"]).withColumn(out, F.coalesce("__before", F.lit(0)) + F.coalesce("__inside", F.lit(0))).drop("__bucket", "__before", "__inside")
