"""Masters: every unit and year of one panel, with the other panel's row at a year offset."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.operators.keys import KeyViolation, require_key
from panelwright.operators.periods import offset_join


def master(left: DataFrame, right: DataFrame, offset: int, unit: str = "UNITID", year: str = "year", check: bool = True) -> DataFrame:
    """Left universe with the right panel's row of ``year + offset`` and derived columns.

    Columns get the prefixes ``ipeds__`` and ``fsa__``.  What depends on a right row is null,
    not false, where there is none.  Column names that differ in case only raise.
    """
    if check:
        require_key(left, [unit, year], "left panel", [unit, year])
        require_key(right, ["unitid", "award_year_start"], "right panel", ["unitid", "award_year_start"])
    a = left.select(F.col(unit).alias("unitid"), F.col(year).cast("int").alias("year"), *[F.col(c).alias(f"ipeds__{c}") for c in left.columns])
    b = right.select(F.col("unitid").alias("__ru"), F.col("award_year_start").alias("__ry"), *[F.col(c).alias(f"fsa__{c}") for c in right.columns])
    names = [c.lower() for c in [*a.columns, *b.columns]]
    if len(names) != len(set(names)):
        raise KeyViolation("column names differ in case only")
    j = offset_join(a, b, "unitid", "year", "__ru", "__ry", offset)
    hit = F.col("row_found")

    def if_found(c):
        return F.when(hit, c)

    inc, blk = F.col("fsa__included_source_family_count"), F.col("fsa__blocked_source_family_count")
    return j.select(
        "unitid",
        "year",
        F.when(hit, "matched").otherwise("ipeds_only").alias("merge_status"),
        F.lit(True).alias("has_ipeds_record"),
        hit.alias("has_fsa_record"),
        if_found(inc > 0).alias("has_usable_fsa_record"),
        if_found(blk > 0).alias("has_blocked_fsa_family"),
        F.lit(offset).alias("fsa_year_offset"),
        (F.col("year") + offset).alias("expected_fsa_award_year_start"),
        (F.col("year") + offset + 1).alias("expected_fsa_award_year_end"),
        (F.col("year") - 1).alias("ipeds_sfa_reference_year_start"),
        F.col("year").alias("ipeds_sfa_reference_year_end"),
        if_found(F.lit(offset == -1)).alias("fsa_sfa_periods_aligned"),
        *[c for c in j.columns if c.startswith(("ipeds__", "fsa__"))],
    )
