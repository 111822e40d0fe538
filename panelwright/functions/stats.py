"""Comparison of two reports of one measure: differences per row, summaries per sample."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(c: Column) -> Column:
    """The number, or null for null, NaN and infinities."""
    n = c.cast("double")
    return F.when(~F.isnan(n) & (F.abs(n) < float("inf")), n)


def differences(a: Column, b: Column, valid: Column) -> dict[str, Column]:
    """Columns of ``b`` against ``a`` where ``valid``; relative only for a positive base."""
    return {
        "difference": F.when(valid, b - a),
        "absolute_difference": F.when(valid, F.abs(b - a)),
        "relative_difference": F.when(valid & (a > 0), (b - a) / a),
        "exact_equal": F.when(valid, a == b),
    }


def metric_summary(a: str, b: str, cents: bool = False) -> list[Column]:
    """Aggregates of a comparable sample with columns ``a`` and ``b``.

    Sums are null for an empty sample, ratios null unless the base sum is positive.
    ``cents`` adds exactly in decimals, so that the order of rows cannot matter.
    """
    x, y = F.col(a), F.col(b)
    if cents:
        x, y = x.cast("decimal(24,2)"), y.cast("decimal(24,2)")
    d = y - x
    base, total, off = F.sum(x), F.sum(d), F.sum(F.abs(d))
    rel = F.when(F.col(a) > 0, F.abs((F.col(b) - F.col(a)) / F.col(a)))
    return [
        F.count(d).alias("comparable_rows"),
        F.count_if(x > 0).alias("positive_base_rows"),
        F.count_if(x == 0).alias("zero_base_rows"),
        F.count_if(d == 0).alias("exact_equal_rows"),
        F.count_if(rel <= 0.01).alias("within_1pct_rows"),
        base.cast("double").alias("base_total"),
        F.sum(y).cast("double").alias("other_total"),
        total.cast("double").alias("signed_difference_total"),
        off.cast("double").alias("absolute_difference_total"),
        F.when(base > 0, off.cast("double") / base.cast("double")).alias("weighted_absolute_relative_difference"),
        F.when(base > 0, total.cast("double") / base.cast("double")).alias("signed_relative_total_difference"),
        F.median(F.abs(d).cast("double")).alias("median_absolute_difference"),
        F.median(rel).alias("median_absolute_relative_difference"),
    ]
