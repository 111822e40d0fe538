"""Keys and joins with a declared cardinality: violations raise before anything is written.

Checks are eager aggregates of their own; a check hidden in an unused column would be pruned.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class KeyViolation(ValueError):
    """A key is null, repeated or malformed, or a join is not of the declared kind."""


def violations(df: DataFrame, keys: list[str], positive: list[str] | None = None) -> DataFrame:
    """One row: rows, null keys, repeated keys, rows in repeats, non-positive or fractional keys.

    One pass and one shuffle: per-key counts are partial aggregates, then one row is left.
    """
    wrong = reduce(lambda a, b: a | b, (F.coalesce((F.col(c) <= 0) | (F.col(c) != F.floor(F.col(c))), F.lit(False)) for c in positive or []), F.lit(False))
    missing = reduce(lambda a, b: a | b, (F.col(k).isNull() for k in keys))
    per = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum(wrong.cast("bigint")).alias("bad"))
    return per.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.when(missing, F.col("n"))), F.lit(0)).alias("null_key_rows"),
        F.count_if(F.col("n") > 1).alias("repeated_keys"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("rows_in_repeats"),
        F.coalesce(F.sum("bad"), F.lit(0)).alias("invalid_key_rows"),
    )


def require_key(df: DataFrame, keys: list[str], what: str, positive: list[str] | None = None) -> DataFrame:
    """``df`` itself if ``keys`` are a valid key of it; else raises."""
    row = violations(df, keys, positive).collect()[0]
    found = {k: row[k] for k in ("null_key_rows", "repeated_keys", "invalid_key_rows") if row[k]}
    if found:
        raise KeyViolation(f"{what}: {', '.join(keys)} is no key: {found}")
    return df


def null_safe_left_join(df: DataFrame, marks: DataFrame, keys: list[str]) -> DataFrame:
    """Left join in which null keys match null keys; ``marks`` is unique by ``keys``.

    Two equal keys of ``df`` need not meet in one task: the optimiser may split a hot key.
    """
    renamed = marks.withColumnsRenamed({k: f"__k{i}" for i, k in enumerate(keys)})
    on = reduce(lambda x, y: x & y, (F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)))
    return df.join(renamed, on, "left").drop(*[f"__k{i}" for i in range(len(keys))])


def mark_duplicates(df: DataFrame, keys: list[str], out: str = "is_duplicate") -> DataFrame:
    """True on all rows of a repeated key; null keys are keys like others.

    Repeated keys are found by a partial aggregate and joined back, so a key of any size is
    never gathered in one task.
    """
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
    return null_safe_left_join(df, repeated, keys).withColumn(out, F.col("__n").isNotNull()).drop("__n")


def checked_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "left", validate: str = "one_to_one") -> DataFrame:
    """Equi-join that raises unless the sides are as unique as declared.

    ``validate`` is one_to_one, many_to_one or one_to_many.  Null keys count as keys for the
    check and match nothing.  Columns of both sides that are not keys must differ, whatever
    their case.
    """
    clash = {c.lower() for c in left.columns} & {c.lower() for c in right.columns} - {c.lower() for c in on}
    if clash:
        raise KeyViolation(f"columns on both sides: {sorted(clash)}")
    a, b = validate.split("_to_")
    if a == "one":
        require_key_unique(left, on, "left side")
    if b == "one":
        require_key_unique(right, on, "right side")
    return left.join(right, on, how)


def require_key_unique(df: DataFrame, keys: list[str], what: str) -> None:
    repeated = violations(df.select(*keys), keys).collect()[0]["repeated_keys"]
    if repeated:
        raise KeyViolation(f"{what}: {repeated} values of {', '.join(keys)} repeat")


def indicator_join(left: DataFrame, right: DataFrame, on: list[str], names: tuple[str, str, str] = ("left_only", "right_only", "both"), out: str = "merge_status") -> DataFrame:
    """Full outer join with a column that tells on which side a row was."""
    both = left.withColumn("__l", F.lit(True)).join(right.withColumn("__r", F.lit(True)), on, "full")
    status = F.when(F.col("__r").isNull(), names[0]).when(F.col("__l").isNull(), names[1]).otherwise(names[2])
    return both.withColumn(out, status).drop("__l", "__r")


def presence_join(left: DataFrame, right: DataFrame, on: list[str], out: str) -> DataFrame:
    """Left join with a true/false column that tells whether the right side had the key."""
    return left.join(right.withColumn("__r", F.lit(True)), on, "left").withColumn(out, F.coalesce("__r", F.lit(False))).drop("__r")


def keep_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key by ``order`` (then by the whole row, so ties are settled).

    An aggregate, not a window: repeats collapse before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max(F.struct(F.struct(*order).alias("o"), F.struct(*rest).alias("b")))["b"].alias("b"))
    return best.select(*keys, *[F.col("b")[c].alias(c) for c in rest])


def bags_equal(a: DataFrame, b: DataFrame, distinct: bool = True) -> bool:
    """Same rows whatever their order; ``distinct`` also ignores how often a row repeats."""
    a, b = (a.distinct(), b.distinct()) if distinct else (a, b)
    return not a.exceptAll(b).limit(1).count() and not b.exceptAll(a).limit(1).count()


def set_counts(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """One row: ids on both sides, only on the left, only on the right (nulls left out)."""
    x = a.select(key).where(F.col(key).isNotNull()).distinct().withColumn("__a", F.lit(1))
    y = b.select(key).where(F.col(key).isNotNull()).distinct().withColumn("__b", F.lit(1))
    m = x.join(y, key, "full")
    return m.agg(F.count_if(F.col("__a").isNotNull() & F.col("__b").isNotNull()).alias("in_both"), F.count_if(F.col("__b").isNull()).alias("left_only"), F.count_if(F.col("__a").isNull()).alias("right_only"))


def partner_counts(df: DataFrame, a: str, b: str) -> DataFrame:
    """(relation, n_distinct, n_keys): how many keys ever have so many partners, in both directions.

    Pairs are made distinct once; a null key or partner pairs with nothing.
    """
    pairs = df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(a, b).distinct()
    sides = [pairs.groupBy(x).agg(F.count(F.lit(1)).alias("n_distinct")).select(F.lit(f"{y}_per_{x}").alias("relation"), "n_distinct") for x, y in ((a, b), (b, a))]
    return sides[0].unionByName(sides[1]).groupBy("relation", "n_distinct").agg(F.count(F.lit(1)).alias("n_keys"))


def counted_once(left: DataFrame, right: DataFrame, on: list[str], columns: list[str]) -> DataFrame:
    """Left join to a unique right side that proves that no cell of ``left`` changed.

    Raises if the right key repeats, or if the number of rows or of known cells per column
    differs after the join: the check is an aggregate of its own over both sides.
    """
    joined = checked_join(left, right, on, "left", "many_to_one")

    def known(df: DataFrame) -> list[int]:
        return list(df.agg(F.count(F.lit(1)), *[F.count(F.col(c)) for c in columns]).collect()[0])

    if known(left) != known(joined):
        raise KeyViolation("the join changed rows or cells of its left side")
    return joined
