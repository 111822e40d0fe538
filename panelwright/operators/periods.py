"""Joins on shifted periods, samples common to several shifts, summaries on dense grids, year ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.functions import stats
from panelwright.operators.keys import null_safe_left_join


def offset_join(left: DataFrame, right: DataFrame, unit: str, period: str, right_unit: str, right_period: str, offset: int, how: str = "left", prefix: str = "") -> DataFrame:
    """Rows of ``left`` with the row of ``right`` whose period is ``period + offset``.

    An equi-join on a derived key; the derived period stays as ``target_period``, and
    ``row_found`` tells whether there was a row.
    """
    other = right.select(F.col(right_unit).alias("__u"), F.col(right_period).alias("__p"), *[F.col(c).alias(f"{prefix}{c}") for c in right.columns if c not in (right_unit, right_period)], F.lit(True).alias("__r"))
    aimed = left.withColumn("target_period", F.col(period) + offset)
    joined = aimed.join(other, (F.col(unit) == F.col("__u")) & (F.col("target_period") == F.col("__p")), how)
    return joined.withColumn("row_found", F.coalesce("__r", F.lit(False))).drop("__u", "__p", "__r")


def offsets_join(left: DataFrame, right: DataFrame, unit: str, period: str, right_unit: str, right_period: str, offsets: list[int], prefix: str = "") -> DataFrame:
    """Rows of ``left`` once per offset, each with the shifted row of ``right``: one join for all.

    The few offsets are exploded from a literal array, so no second table is crossed.
    """
    spread = left.withColumn("offset", F.explode(F.array(*[F.lit(o) for o in offsets]))).withColumn("__t", F.col(period) + F.col("offset"))
    joined = offset_join(spread, right, unit, "__t", right_unit, right_period, 0, prefix=prefix)
    return joined.drop("__t")


def common_sample(df: DataFrame, keys: list[str], valid: str, out: str) -> DataFrame:
    """True on the rows of a key whose every row is valid (null counts as not valid).

    Keys with an invalid row are found by a distinct and joined back; no key is gathered.
    """
    bad = df.where(~F.coalesce(F.col(valid), F.lit(False))).select(*keys).distinct().withColumn("__bad", F.lit(True))
    return null_safe_left_join(df, bad, keys).withColumn(out, F.col("__bad").isNull()).drop("__bad")


def dense_summary(rows: DataFrame, base: str, other: str, samples: dict[str, Column], offset: str, year: str, population: str, offsets: list[int], years: list[int], cents: bool = False) -> DataFrame:
    """Summary per sample and offset over all rows, per year, and per population.

    Rolled-up dimensions read ``all``.  The all-row and every year are there even when no row
    qualifies (count 0, other figures null); populations only where present.  Samples are
    exploded from literal flags and grouped by grouping sets in one aggregate; the grid has
    samples x offsets x years rows.
    """
    spark = rows.sparkSession
    flags = F.filter(F.array(*[F.struct(F.lit(k).alias("name"), F.coalesce(c, F.lit(False)).alias("on")) for k, c in samples.items()]), lambda s: s["on"])
    long = rows.select(offset, year, population, base, other, F.explode(flags).alias("s")).select(F.col("s.name").alias("sample"), offset, year, population, base, other)
    sets = [["sample", offset], ["sample", offset, year], ["sample", offset, population]]
    cols = [F.col("sample"), F.col(offset), F.col(year), F.col(population)]
    grouped = long.groupingSets([[F.col(c) for c in s] for s in sets], *cols).agg(F.grouping(year).alias("gy"), F.grouping(population).alias("gp"), *stats.metric_summary(base, other, cents))
    told = grouped.withColumn("ipeds_year", F.when(F.col("gy") == 1, "all").otherwise(F.col(year).cast("string"))).withColumn("reporting_population", F.when(F.col("gp") == 1, "all").otherwise(F.col(population))).drop("gy", "gp", year, population)
    grid_rows = [(s, o, y, "all") for s in samples for o in offsets for y in ["all", *[str(y) for y in years]]]
    grid = spark.createDataFrame(grid_rows, f"sample string, {offset} int, ipeds_year string, reporting_population string")
    keys = ["sample", offset, "ipeds_year", "reporting_population"]
    full = grid.join(told.withColumn(offset, F.col(offset).cast("int")), keys, "full")
    counts = [c for c in full.columns if c.endswith("_rows")]
    return full.withColumns({c: F.coalesce(c, F.lit(0)) for c in counts})


def year_ranges(df: DataFrame, keys: list[str], year: str, out: str = "year_ranges") -> DataFrame:
    """Years of each key as text, runs joined: ``2004,2006-2007``.

    A run shares the difference of year and its rank; a key has at most one row per year
    after the distinct, so the window is bound by the calendar.
    """
    years = df.select(*keys, F.col(year).cast("int").alias("__y")).where("__y IS NOT NULL").distinct()
    island = F.col("__y") - F.row_number().over(Window.partitionBy(*keys).orderBy("__y"))
    runs = years.withColumn("__i", island).groupBy(*keys, "__i").agg(F.min("__y").alias("a"), F.max("__y").alias("b"))
    text = F.when(F.col("a") == F.col("b"), F.col("a").cast("string")).otherwise(F.concat_ws("-", F.col("a"), F.col("b")))
    parts = runs.select(*keys, F.struct(F.col("a"), text.alias("t")).alias("s"))
    return parts.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list("s")), lambda x: x["t"]), ",").alias(out))
