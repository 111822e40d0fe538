"""Proofs that rows and cells are conserved: exact comparisons and sums per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Columns of one type packed into one array.
COLUMNS_AT_ONCE = 64
#: Arrays compared in one join, so that the driver's memory for its plan doesn't grow with the columns.
ARRAYS_AT_ONCE = 8


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _unequal_at(x: Column, y: Column):
    return lambda _, k: ~F.get(x, k).eqNullSafe(F.get(y, k))


def cell_differences(a: DataFrame, b: DataFrame, keys: list[str], columns: list[str] | None = None) -> DataFrame:
    """(column, compared_rows, mismatched_cells) of two tables with equal keys.

    Cells are equal if both are null, both NaN, or the same value; nothing is rounded.  Rows
    on one side only count as mismatches of every column.  Types must be equal.  Columns of one
    type are packed into arrays, arrays that are equal are done, and only the others are taken
    apart.  ARRAYS_AT_ONCE of them are compared in one join, which runs at once and reads no other
    columns; so plans and the rows that are sorted are as wide for any number of columns.
    """
    columns = columns or [c for c in a.columns if c not in keys]
    ta, tb = dict(a.dtypes), dict(b.dtypes)
    other = [c for c in columns if ta[c] != tb.get(c)]
    if other:
        raise TypeError(f"columns of different types: {other}")
    groups = []
    for kind in dict.fromkeys(ta[c] for c in columns):
        own = [c for c in columns if ta[c] == kind]
        groups += [own[i : i + COLUMNS_AT_ONCE] for i in range(0, len(own), COLUMNS_AT_ONCE)]
    n_rows, counts = 0, {}
    for i in range(0, len(groups), ARRAYS_AT_ONCE):
        told = {r["column"]: r["n"] for r in _unequal(a, b, keys, groups[i : i + ARRAYS_AT_ONCE]).collect()}  # one row per column at most
        n_rows = told.pop(None, 0)
        counts |= told
    return a.sparkSession.createDataFrame([(c, n_rows, counts.get(c, 0)) for c in columns], "column string, compared_rows long, mismatched_cells long")


def _unequal(a: DataFrame, b: DataFrame, keys: list[str], groups: list[list[str]]) -> DataFrame:
    """(column, n): unequal cells of each column that has some, and all rows under null."""

    def packed(df: DataFrame, side: str) -> DataFrame:
        # transform() has no generated code, so none is made of its array: for hundreds of columns that takes the driver's memory, and methods too long to be compiled
        return df.select(*keys, *[F.expr(f"transform(array({', '.join(_quoted(c) for c in g)}), x -> x)").alias(f"{side}{i}") for i, g in enumerate(groups)])

    j = packed(a, "__a").join(packed(b, "__b"), keys, "full")
    names = []
    for i, g in enumerate(groups):
        x, y, known = F.col(f"__a{i}"), F.col(f"__b{i}"), F.split(F.lit("\0".join(g)), "\0")
        apart = F.filter(known, _unequal_at(x, y))
        names.append(F.when(x.isNull() | y.isNull(), known).when(x.eqNullSafe(y), F.array().cast("array<string>")).otherwise(apart))
    told = F.concat(F.array(F.lit(None).cast("string")), *names)
    return j.select(F.explode(told).alias("column")).groupBy("column").agg(F.count(F.lit(1)).alias("n"))


def sums_kept(a: DataFrame, b: DataFrame, group: str, measures: dict[str, float]) -> DataFrame:
    """(group, column, input_sum, output_sum, passed): known sums per group within a tolerance.

    ``measures`` maps column to tolerance (0 for counts, about a cent for money).  Sums add in
    decimals, so the order of rows cannot matter; a group without known values sums to null.
    """

    def sums(df: DataFrame, name: str) -> DataFrame:
        agg = df.groupBy(group).agg(*[F.sum(F.col(m).cast("decimal(24,2)")).alias(m) for m in measures])
        return agg.select(group, F.explode(F.array(*[F.struct(F.lit(m).alias("column"), F.col(m).alias("s")) for m in measures])).alias("e")).select(group, F.col("e.column").alias("column"), F.col("e.s").alias(name))

    both = sums(a, "input_sum").join(sums(b, "output_sum"), [group, "column"], "full")
    tolerance = F.lit(0.0)
    for m, t in measures.items():
        tolerance = F.when(F.col("column") == m, F.lit(float(t))).otherwise(tolerance)
    gap = F.abs(F.col("input_sum") - F.col("output_sum")).cast("double")
    ok = (F.col("input_sum").isNull() & F.col("output_sum").isNull()) | F.coalesce(gap <= tolerance, F.lit(False))
    return both.withColumn("passed", ok)


def row_bag_hash(df: DataFrame) -> int:
    """Order-independent fingerprint of a table: the sum of its rows' hashes."""
    row = df.select(F.xxhash64(*[F.col(c) for c in df.columns]).cast("decimal(38,0)").alias("h")).agg(F.sum("h").alias("s"), F.count(F.lit(1)).alias("n")).collect()[0]
    return int(row["s"] or 0) * 31 + row["n"]


def null_masks(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys and one boolean per text column that tells a null from an empty text."""
    texts = [c for c, t in df.dtypes if t == "string" and c not in keys]
    return df.select(*keys, *[F.col(c).isNull().alias(f"{c}__is_null") for c in texts])
