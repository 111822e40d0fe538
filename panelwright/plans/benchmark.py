"""One measure reported by two sources, compared at several year offsets on common samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.functions import stats
from panelwright.operators import periods

OFFSETS = [-2, -1, 0, 1]


def pair_status(found: Column, included: Column, observed: Column, a: Column, b: Column, defined: Column, whole: bool) -> Column:
    """Why a pair can or cannot be compared; the first reason that holds."""
    ok = stats.finite(a).isNotNull() & stats.finite(b).isNotNull() & (a >= 0) & (b >= 0)
    if whole:
        ok = ok & (a % 1 == 0) & (b % 1 == 0)
    yes = F.lit(True)
    return (
        F.when(~F.coalesce(defined, ~yes), "all_undergraduate_measure_unavailable_in_dictionary_or_panel")
        .when(~F.coalesce(found, ~yes), "no_fsa_unitid_row")
        .when(~F.coalesce(included, ~yes), "fsa_grant_family_not_included")
        .when(~F.coalesce(observed, ~yes), "fsa_value_not_observed")
        .when(~F.coalesce(ok, ~yes), "missing_negative_nonfinite_or_invalid_numeric")
        .otherwise("comparable_numeric_pair_population_limits_apply")
    )


def pairs(left: DataFrame, right: DataFrame, measure: str, other: str, offsets: list[int] = OFFSETS, whole: bool = True, defined: str | None = None, screened: str | None = None) -> DataFrame:
    """Pairs of ``measure`` (left: unitid, year) and ``other`` (right: unitid, award_year_start,
    ``<other>__status``, record_status) per offset, with status, differences and common sample.

    ``defined`` names a true/false column of ``left`` that tells whether the dictionary has the
    measure that year; without it every year has.  ``screened`` names one that tells whether a
    row's scope is clear; pairs that pass it make samples of their own.
    """
    j = periods.offsets_join(left, right.withColumnRenamed("unitid", "__unit"), "unitid", "year", "__unit", "award_year_start", offsets, prefix="fsa__")
    a, b = F.col(measure).cast("double"), F.col(f"fsa__{other}").cast("double")
    status = pair_status(F.col("row_found"), F.col("fsa__record_status") == "included_unique_family_record", F.col(f"fsa__{other}__status").isin("observed", "observed_zero"), a, b, F.col(defined) if defined else F.lit(True), whole)
    j = j.withColumn("comparison_status", status).withColumn("valid_pair", F.col("comparison_status").startswith("comparable"))
    j = j.withColumns({"base_value": a, "other_value": b, **stats.differences(a, b, F.col("valid_pair"))})
    j = periods.common_sample(j, ["unitid", "year"], "valid_pair", "common_all_offsets")
    if screened:
        j = j.withColumn("screened_pair", F.col("valid_pair") & F.coalesce(F.col(screened), F.lit(False)))
        j = periods.common_sample(j, ["unitid", "year"], "screened_pair", "screened_common_all_offsets")
    zero = F.col("valid_pair") & (a == 0) & (b > 0)
    return j.withColumn("large_difference_review_flag", F.coalesce(F.abs(F.col("relative_difference")) > 0.2, F.lit(False)) | F.coalesce(zero, F.lit(False)))


def summary(rows: DataFrame, population: str, years: list[int], offsets: list[int] = OFFSETS, cents: bool = False) -> DataFrame:
    samples = {"available_pairs": F.col("valid_pair"), "common_all_offsets": F.col("common_all_offsets")}
    if "screened_pair" in rows.columns:
        samples |= {"scope_screened_available": F.col("screened_pair"), "scope_screened_common_all_offsets": F.col("screened_common_all_offsets")}
    return periods.dense_summary(rows, "base_value", "other_value", samples, "offset", "year", population, offsets, years, cents)


def comparability(catalog: DataFrame, dictionary: DataFrame) -> DataFrame:
    """A catalog of possible comparisons (comparison_id, variable, assessment) with the years each is defined in."""
    years = dictionary.groupBy("varname").agg(F.array_sort(F.collect_set("year")).alias("dictionary_years"))
    return catalog.join(years, F.col("variable") == F.col("varname"), "left").drop("varname").withColumn("dictionary_years", F.coalesce("dictionary_years", F.expr("cast(array() as array<int>)")))
