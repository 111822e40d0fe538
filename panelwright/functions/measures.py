"""Reported measures: tokens to values with a status, and null-aware sums of components."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelwright.functions import clean

#: Tokens that stand for a symbol or an explicit suppression in a report cell.
SYMBOLS = ("-", "--", ".", "na", "n/a", "*")
SUPPRESSED = ("suppressed", "redacted", "privacy suppressed")


def parse(token: Column, count: bool) -> Column:
    """Struct value, status, raw_token, lower_bound, upper_bound of a report cell.

    Nothing is imputed: a blank, symbol or suppressed cell has a null value and says why.
    ``count`` also refuses fractions and negative numbers.
    """
    s = clean.strip(token)
    low = F.lower(s)
    plain = F.regexp_replace(s, r"[$,]", "")
    good = s.rlike(r"\A-?\$?-?(\d{1,3}(,\d{3})+|\d+)(\.\d*)?\z")
    n = F.when(good, plain.try_cast("double"))
    status = (
        F.when(s.isNull() | (s == ""), "source_blank")
        .when(low.rlike(r"\A<\s*10\z"), "suppressed_lt10")
        .when(low.isin(*SUPPRESSED), "suppressed")
        .when(low.isin(*SYMBOLS), "source_symbol")
        .when(n.isNull(), "invalid_numeric")
    )
    if count:
        status = status.when(n < 0, "invalid_negative_count").when(n != F.floor(n), "invalid_fractional_count")
    status = status.when(n == 0, "observed_zero").otherwise("observed")
    few = status == "suppressed_lt10"
    return F.struct(
        F.when(status.isin("observed", "observed_zero"), n).alias("value"),
        status.alias("status"),
        token.alias("raw_token"),
        F.when(few, F.lit(0.0)).alias("lower_bound"),
        F.when(few, F.lit(9.0)).alias("upper_bound"),
    )


def component_sum(parts: list[Column], required: list[Column] | None = None) -> Column:
    """Struct value, status, observed_partial_sum: complete only if every required part is known.

    ``required`` tells per part whether it is needed (all are by default).  A part that is
    not needed but known is still added.
    """
    need = required or [F.lit(True)] * len(parts)
    known = [p.isNotNull() for p in parts]
    n_known = reduce(lambda a, b: a + b, (k.cast("int") for k in known))
    complete = reduce(lambda a, b: a & b, (k | ~q for k, q in zip(known, need)))
    total = reduce(lambda a, b: a + b, (F.coalesce(p, F.lit(0.0)) for p in parts))
    n_need = reduce(lambda a, b: a + b, (q.cast("int") for q in need))
    status = F.when(n_known == 0, "no_observed_components").when(~complete, "incomplete_component_sum").when(n_need < len(parts), "complete_direct_only_scope").otherwise("complete_component_sum")
    return F.struct(F.when(complete & (n_known > 0), total).alias("value"), status.alias("status"), F.when(n_known > 0, total).alias("observed_partial_sum"))


def people_bounds(parts: list[Column]) -> Column:
    """Bounds of the number of different people behind overlapping counts: the largest, and the sum."""
    known = reduce(lambda a, b: a & b, (p.isNotNull() for p in parts))
    return F.struct(F.when(known, F.greatest(*parts)).alias("lower_bound"), F.when(known, reduce(lambda a, b: a + b, parts)).alias("upper_bound"))
