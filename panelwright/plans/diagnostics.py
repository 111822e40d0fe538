"""Coverage of two keyed panels at a year offset, with a reason for every unmatched row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.functions import clean, ids
from panelwright.operators.keys import indicator_join

#: What a resolution status says about a row that found no counterpart.
BY_RESOLUTION = {
    "multiple_official_site_unitids": "fsa_master_identity_ambiguous",
    "multiple_nonadministrative_directory_unitids": "fsa_master_identity_ambiguous",
    "directory_crosswalk_identity_conflict": "fsa_master_identity_evidence_conflict",
    "fsa_ipeds_geography_identity_conflict": "fsa_master_identity_evidence_conflict",
    "no_annual_site_match": "fsa_master_no_annual_site_match",
    "crosswalk_site_parse_incomplete": "fsa_master_identity_evidence_incomplete",
    "noninstitutional_source_placeholder": "fsa_master_noninstitutional_source_placeholder",
}
BY_FORMAT = {
    "source_missing": "missing_ipeds_opeid_no_exact_lookup",
    "not_applicable": "not_applicable_ipeds_opeid_no_exact_lookup",
    "ipeds_alpha_reporting_branch_not_exact_fsa_id": "ipeds_alphanumeric_branch_not_exact_fsa_id",
    "unrecognized_source_identifier": "unrecognized_ipeds_opeid_no_exact_lookup",
    "numeric8_format_only_not_verified_match": "no_exact_opeid_award_year_in_fsa_master_bridge",
}


def _mapped(c: Column, table: dict[str, str]) -> Column:
    return F.try_element_at(F.create_map(*[x for k, v in table.items() for x in (F.lit(k), F.lit(v))]), c)


def coverage(left: DataFrame, right: DataFrame, offset: int) -> DataFrame:
    """Full outer coverage of (unitid, year); right rows sit at ``award_year_start - offset``.

    ``left`` has unitid, year, opeid; ``right`` has unitid, award_year_start,
    included_source_family_count and blocked_source_family_count.
    """
    a = left.select("unitid", "year", F.col("opeid").alias("ipeds_opeid_raw"))
    b = right.select("unitid", (F.col("award_year_start") - offset).alias("year"), F.col("included_source_family_count").alias("included"), F.col("blocked_source_family_count").alias("blocked"))
    j = indicator_join(a, b, ["unitid", "year"], ("ipeds_only", "fsa_only", "matched"))
    years = F.broadcast(left.select("year").distinct().withColumn("__in", F.lit(True)))  # one row per calendar year
    j = j.join(years, "year", "left").withColumn("ipeds_year_in_supplied_panel", F.col("__in").isNotNull()).drop("__in")
    present = F.col("merge_status") != "ipeds_only"
    return j.withColumns(
        {
            "fsa_award_year_start": F.col("year") + offset,
            "ipeds_opeid_format_status": ids.opeid_format(F.col("ipeds_opeid_raw")),
            "fsa_has_usable_family": F.when(present, F.col("included") > 0),
            "fsa_blocked_only": F.when(present, (F.col("included") == 0) & (F.col("blocked") > 0)),
        }
    )


def year_counts(rows: DataFrame) -> DataFrame:
    matched = F.col("merge_status") == "matched"
    return rows.groupBy("year").agg(
        F.max("ipeds_year_in_supplied_panel").alias("ipeds_year_in_supplied_panel"),
        F.count_if(F.col("merge_status") != "fsa_only").alias("ipeds_rows"),
        F.count_if(F.col("merge_status") != "ipeds_only").alias("fsa_rows"),
        F.count_if(matched).alias("matched_rows"),
        F.count_if(matched & F.coalesce("fsa_has_usable_family", F.lit(False))).alias("matched_usable_family_rows"),
        F.count_if(matched & F.coalesce("fsa_blocked_only", F.lit(False))).alias("matched_blocked_only_rows"),
        F.count_if(F.col("merge_status") == "ipeds_only").alias("ipeds_only_rows"),
        F.count_if(F.col("merge_status") == "fsa_only").alias("fsa_only_rows"),
    )


def evidence(rows: DataFrame, bridge: DataFrame) -> DataFrame:
    """Rows only on the left with the reason, from the bridge of exact ids and award years."""
    b = bridge.select(ids.full_opeid(F.col("opeid8")).alias("__o"), ids.award_year_start(F.col("award_year")).alias("__y"), F.col("unitid").alias("bridge_unitid"), F.col("ipeds_resolution_status").alias("bridge_status"), F.coalesce(clean.truth(F.col("ipeds_annual_identity_eligible").cast("string")), F.lit(False)).alias("eligible"))
    only = rows.where("merge_status = 'ipeds_only'").withColumn("opeid8", ids.opeid_numeric8(F.col("ipeds_opeid_raw")))
    j = only.join(b, (F.col("opeid8") == F.col("__o")) & (F.col("fsa_award_year_start") == F.col("__y")), "left")
    found = F.col("__o").isNotNull()
    status = (
        F.when(found & (F.col("bridge_unitid") == F.col("unitid")) & F.col("eligible"), "fsa_master_same_unitid_without_unitid_panel_row")
        .when(found & (F.col("bridge_unitid") > 0) & (F.col("bridge_unitid") != F.col("unitid")), "fsa_master_assigned_another_unitid")
        .when(found, F.coalesce(_mapped(F.col("bridge_status"), BY_RESOLUTION), F.lit("fsa_master_identity_unresolved_or_ineligible")))
        .otherwise(_mapped(F.col("ipeds_opeid_format_status"), BY_FORMAT))
    )
    return j.select("unitid", "year", "ipeds_opeid_raw", "ipeds_opeid_format_status", found.alias("exact_bridge_row_present"), status.alias("evidence_status"))


def unmatched_right(rows: DataFrame) -> DataFrame:
    reason = F.when(F.col("ipeds_year_in_supplied_panel"), "unitid_year_not_in_supplied_ipeds_universe").otherwise("year_not_in_supplied_ipeds_panel")
    return rows.where("merge_status = 'fsa_only'").select("unitid", "year", reason.alias("unmatched_reason"))
