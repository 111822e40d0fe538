"""Queries of the panel operators on the star-schema tables, each with SQL for a second engine.

The tables are not panels of institutions, so each query builds keyed panels from them:
customers are units, order years are periods, order priorities are source families.  Gaps
and conflicts come from plain arithmetic on keys, which both engines can write.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.functions import ids, labels, measures, names, scope, stats, text
from panelwright.operators import conserve, harmonise, keys, metadata, periods
from panelwright.plans import benchmark, diagnostics, family_panel, linkage, masters
from panelwright.session import table

QUERIES = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# -- panels -----------------------------------------------------------------------------
def _orders(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").withColumn("year", F.year("o_orderdate"))


def _left(spark: SparkSession, d: str) -> DataFrame:
    """One row per customer and order year, with ids in all formats (unit ids start at 1)."""
    o = _orders(spark, d).groupBy((F.col("o_custkey") + 1).alias("unitid"), "year").agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("paid"), F.count(F.lit(1)).alias("n_orders"))
    k = F.col("unitid") % 7
    opeid = F.when(k == 0, "-2").when(k == 1, F.lit(None).cast("string")).when(k == 2, F.concat(F.lpad(F.col("unitid").cast("string"), 6, "0"), F.lit("A1"))).when(k == 3, "junk").otherwise(F.lpad(F.col("unitid").cast("string"), 8, "0"))
    return o.withColumn("opeid", opeid)


_LEFT = """lft AS (SELECT o_custkey AS unitid, CAST(year(o_orderdate) AS INTEGER) AS year, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS paid, COUNT(*) AS n_orders,
 CASE o_custkey % 7 WHEN 0 THEN '-2' WHEN 1 THEN NULL WHEN 2 THEN lpad(CAST(o_custkey AS VARCHAR), 6, '0') || 'A1' WHEN 3 THEN 'junk' ELSE lpad(CAST(o_custkey AS VARCHAR), 8, '0') END AS opeid
 FROM (SELECT * REPLACE (o_custkey + 1 AS o_custkey) FROM orders) GROUP BY o_custkey, year(o_orderdate))"""


def _right(spark: SparkSession, d: str) -> DataFrame:
    o = _orders(spark, d).where("o_orderstatus = 'F'")
    g = o.groupBy((F.col("o_custkey") + 1).alias("unitid"), F.col("year").alias("award_year_start")).agg(
        F.least(F.lit(4), F.count_if(F.substring("o_orderpriority", 1, 1).isin("1", "2"))).cast("int").alias("included_source_family_count"),
        F.least(F.lit(4), F.count_if(F.substring("o_orderpriority", 1, 1) == "3")).cast("int").alias("blocked_source_family_count"),
        F.max("o_totalprice").alias("grant__paid"),
        F.count(F.lit(1)).alias("grant__n"),
    )
    return g


_RIGHT = """rgt AS (SELECT o_custkey + 1 AS unitid, CAST(year(o_orderdate) AS INTEGER) AS award_year_start,
 CAST(least(4, SUM(CASE WHEN substr(o_orderpriority,1,1) IN ('1','2') THEN 1 ELSE 0 END)) AS INTEGER) AS included,
 CAST(least(4, SUM(CASE WHEN substr(o_orderpriority,1,1) = '3' THEN 1 ELSE 0 END)) AS INTEGER) AS blocked,
 MAX(o_totalprice) AS grant__paid, COUNT(*) AS grant__n
 FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey, year(o_orderdate))"""

_COVER = f"""{_LEFT}, {_RIGHT}, cov AS (SELECT coalesce(l.unitid, r.unitid) AS unitid, coalesce(l.year, r.award_year_start + 1) AS year, l.opeid AS ipeds_opeid_raw, r.included, r.blocked,
 CASE WHEN r.unitid IS NULL THEN 'ipeds_only' WHEN l.unitid IS NULL THEN 'fsa_only' ELSE 'matched' END AS merge_status
 FROM lft l FULL JOIN rgt r ON l.unitid = r.unitid AND l.year = r.award_year_start + 1),
 cv AS (SELECT cov.*, (year IN (SELECT DISTINCT year FROM lft)) AS in_panel,
 CASE WHEN merge_status <> 'ipeds_only' THEN included > 0 END AS usable, CASE WHEN merge_status <> 'ipeds_only' THEN included = 0 AND blocked > 0 END AS blocked_only,
 CASE WHEN ipeds_opeid_raw IS NULL OR ipeds_opeid_raw = '' THEN 'source_missing' WHEN ipeds_opeid_raw = '-2' THEN 'not_applicable'
 WHEN regexp_full_match(ipeds_opeid_raw, '[0-9]{{8}}') AND ipeds_opeid_raw <> '00000000' THEN 'numeric8_format_only_not_verified_match'
 WHEN regexp_full_match(ipeds_opeid_raw, '[0-9]{{6}}[A-Z][0-9]') THEN 'ipeds_alpha_reporting_branch_not_exact_fsa_id' ELSE 'unrecognized_source_identifier' END AS fmt FROM cov)"""


@query(
    f"""WITH {_COVER} SELECT year, bool_or(in_panel) AS ipeds_year_in_supplied_panel,
 CAST(SUM((merge_status <> 'fsa_only')::INT) AS BIGINT) AS ipeds_rows, CAST(SUM((merge_status <> 'ipeds_only')::INT) AS BIGINT) AS fsa_rows, CAST(SUM((merge_status = 'matched')::INT) AS BIGINT) AS matched_rows,
 CAST(SUM((merge_status = 'matched' AND coalesce(usable, FALSE))::INT) AS BIGINT) AS matched_usable_family_rows, CAST(SUM((merge_status = 'matched' AND coalesce(blocked_only, FALSE))::INT) AS BIGINT) AS matched_blocked_only_rows,
 CAST(SUM((merge_status = 'ipeds_only')::INT) AS BIGINT) AS ipeds_only_rows, CAST(SUM((merge_status = 'fsa_only')::INT) AS BIGINT) AS fsa_only_rows FROM cv GROUP BY year"""
)
def coverage_full_outer(spark, d):
    """Coverage of two panels at offset -1, counted per year."""
    return diagnostics.year_counts(diagnostics.coverage(_left(spark, d), _right(spark, d), -1))


@query(f"WITH {_COVER} SELECT unitid, year, merge_status, fmt AS ipeds_opeid_format_status, usable AS fsa_has_usable_family, blocked_only AS fsa_blocked_only FROM cv")
def coverage_rows(spark, d):
    """The rows behind the counts."""
    rows = diagnostics.coverage(_left(spark, d), _right(spark, d), -1)
    return rows.select("unitid", "year", "merge_status", "ipeds_opeid_format_status", "fsa_has_usable_family", "fsa_blocked_only")


def _bridge(spark, d):
    c = table(spark, d, "customer")
    k = F.col("c_custkey") % 11
    unit = F.when(k == 1, F.col("c_custkey") + 1).when(k > 3, F.col("c_custkey"))
    status = F.when(k == 0, "multiple_official_site_unitids").when(k == 2, "directory_crosswalk_identity_conflict").when(k == 3, "no_annual_site_match").otherwise("official_site_and_directory_agree")
    b = c.select(F.lpad(F.col("c_custkey").cast("string"), 8, "0").alias("opeid8"), unit.alias("unitid"), status.alias("ipeds_resolution_status"), F.when(k == 5, "False").otherwise("True").alias("ipeds_annual_identity_eligible"))
    return b.withColumn("y", F.explode(F.sequence(F.lit(1994), F.lit(2001)))).withColumn("award_year", ids.award_year_label(F.col("y"))).where(F.col("y") % 2 == 0)


@query(
    f"""WITH {_COVER}, brg AS (SELECT lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS opeid8, y, CASE WHEN c_custkey % 11 = 1 THEN c_custkey + 1 WHEN c_custkey % 11 > 3 THEN c_custkey END AS bunit,
 CASE c_custkey % 11 WHEN 0 THEN 'fsa_master_identity_ambiguous' WHEN 2 THEN 'fsa_master_identity_evidence_conflict' WHEN 3 THEN 'fsa_master_no_annual_site_match' ELSE 'fsa_master_identity_unresolved_or_ineligible' END AS why, c_custkey % 11 <> 5 AS eligible
 FROM customer, (VALUES (1994),(1996),(1998),(2000)) t(y))
 SELECT cv.unitid, cv.year, fmt AS ipeds_opeid_format_status, brg.opeid8 IS NOT NULL AS exact_bridge_row_present,
 CASE WHEN brg.opeid8 IS NULL THEN CASE fmt WHEN 'source_missing' THEN 'missing_ipeds_opeid_no_exact_lookup' WHEN 'not_applicable' THEN 'not_applicable_ipeds_opeid_no_exact_lookup'
 WHEN 'ipeds_alpha_reporting_branch_not_exact_fsa_id' THEN 'ipeds_alphanumeric_branch_not_exact_fsa_id' WHEN 'unrecognized_source_identifier' THEN 'unrecognized_ipeds_opeid_no_exact_lookup' ELSE 'no_exact_opeid_award_year_in_fsa_master_bridge' END
 WHEN bunit = cv.unitid AND eligible THEN 'fsa_master_same_unitid_without_unitid_panel_row' WHEN bunit > 0 AND bunit <> cv.unitid THEN 'fsa_master_assigned_another_unitid' ELSE why END AS evidence_status
 FROM cv LEFT JOIN brg ON fmt = 'numeric8_format_only_not_verified_match' AND brg.opeid8 = ipeds_opeid_raw AND brg.y = cv.year - 1 WHERE merge_status = 'ipeds_only'"""
)
def unmatched_evidence(spark, d):
    """A reason for every row without counterpart."""
    rows = diagnostics.coverage(_left(spark, d), _right(spark, d), -1)
    return diagnostics.evidence(rows, _bridge(spark, d)).drop("ipeds_opeid_raw")


@query(f"WITH {_COVER} SELECT unitid, year, CASE WHEN in_panel THEN 'unitid_year_not_in_supplied_ipeds_universe' ELSE 'year_not_in_supplied_ipeds_panel' END AS unmatched_reason FROM cv WHERE merge_status = 'fsa_only'")
def unmatched_right(spark, d):
    """Rows of the right panel only."""
    return diagnostics.unmatched_right(diagnostics.coverage(_left(spark, d), _right(spark, d), -1))


def _master_sql(offset: int) -> str:
    return f"""WITH {_LEFT}, {_RIGHT} SELECT l.unitid, l.year, CASE WHEN r.unitid IS NULL THEN 'ipeds_only' ELSE 'matched' END AS merge_status, TRUE AS has_ipeds_record, r.unitid IS NOT NULL AS has_fsa_record,
 CASE WHEN r.unitid IS NOT NULL THEN included > 0 END AS has_usable_fsa_record, CASE WHEN r.unitid IS NOT NULL THEN blocked > 0 END AS has_blocked_fsa_family, CAST({offset} AS INTEGER) AS fsa_year_offset,
 CAST(l.year + {offset} AS INTEGER) AS expected_fsa_award_year_start, CAST(l.year + {offset} + 1 AS INTEGER) AS expected_fsa_award_year_end, CAST(l.year - 1 AS INTEGER) AS ipeds_sfa_reference_year_start, l.year AS ipeds_sfa_reference_year_end,
 CASE WHEN r.unitid IS NOT NULL THEN {'TRUE' if offset == -1 else 'FALSE'} END AS fsa_sfa_periods_aligned, l.n_orders AS ipeds__n_orders, r.grant__n AS fsa__grant__n
 FROM lft l LEFT JOIN rgt r ON r.unitid = l.unitid AND r.award_year_start = l.year + {offset}"""


def _master(spark, d, offset):
    m = masters.master(_left(spark, d), _right(spark, d), offset, "unitid", "year")
    return m.select(*[c for c in m.columns if "__" not in c], "ipeds__n_orders", "fsa__grant__n")


@query(_master_sql(0))
def offset_join_same(spark, d):
    """Master at offset 0."""
    return _master(spark, d, 0)


@query(_master_sql(-1))
def offset_join_prior(spark, d):
    """Master at offset -1."""
    return _master(spark, d, -1)


def _benchmark_pairs(spark, d):
    left = _left(spark, d).select("unitid", "year", F.when(F.col("unitid") % 13 == 0, F.lit(None)).otherwise(F.col("n_orders")).alias("a"), F.concat(F.lit("p"), (F.col("unitid") % 3).cast("string")).alias("population"), ((F.col("unitid") + F.col("year")) % 19 != 0).alias("defined"), (F.col("unitid") % 4 != 0).alias("screened"))
    right = _right(spark, d).select("unitid", "award_year_start", F.col("grant__n").alias("b"), F.when(F.col("unitid") % 5 == 0, "suppressed_lt10").otherwise("observed").alias("b__status"), F.when(F.col("unitid") % 17 == 0, "ambiguous_family_multiple_records").otherwise("included_unique_family_record").alias("record_status"))
    return benchmark.pairs(left, right, "a", "b", defined="defined", screened="screened")


_PAIRS = f"""{_LEFT}, {_RIGHT}, prs AS (SELECT l.unitid, l.year, o.offset_, 'p' || CAST(l.unitid % 3 AS VARCHAR) AS population, CASE WHEN l.unitid % 13 <> 0 THEN CAST(l.n_orders AS DOUBLE) END AS a, CAST(r.grant__n AS DOUBLE) AS b,
 CASE WHEN (l.unitid + l.year) % 19 = 0 THEN 'all_undergraduate_measure_unavailable_in_dictionary_or_panel' WHEN r.unitid IS NULL THEN 'no_fsa_unitid_row' WHEN l.unitid % 17 = 0 THEN 'fsa_grant_family_not_included' WHEN l.unitid % 5 = 0 THEN 'fsa_value_not_observed' WHEN l.unitid % 13 = 0 THEN 'missing_negative_nonfinite_or_invalid_numeric' ELSE 'comparable_numeric_pair_population_limits_apply' END AS status
 FROM lft l CROSS JOIN (VALUES (-2),(-1),(0),(1)) o(offset_) LEFT JOIN rgt r ON r.unitid = l.unitid AND r.award_year_start = l.year + o.offset_),
 pv AS (SELECT *, starts_with(status, 'comparable') AS valid, bool_and(starts_with(status, 'comparable')) OVER (PARTITION BY unitid, year) AS common, starts_with(status, 'comparable') AND unitid % 4 <> 0 AS clear_, bool_and(starts_with(status, 'comparable') AND unitid % 4 <> 0) OVER (PARTITION BY unitid, year) AS clear_common FROM prs)"""


@query(f"WITH {_PAIRS} SELECT unitid, year, CAST(offset_ AS INTEGER) AS \"offset\", status AS comparison_status, valid AS valid_pair, common AS common_all_offsets, CASE WHEN valid THEN b - a END AS difference, CASE WHEN valid AND a > 0 THEN (b - a) / a END AS relative_difference FROM pv")
def offset_common_sample(spark, d):
    """Pairs at four offsets and the sample common to all."""
    return _benchmark_pairs(spark, d).select("unitid", "year", "offset", "comparison_status", "valid_pair", "common_all_offsets", "difference", "relative_difference")


_METRICS = """COUNT(b - a) AS comparable_rows, CAST(COALESCE(SUM((a > 0)::INT),0) AS BIGINT) AS positive_base_rows, CAST(COALESCE(SUM((a = 0)::INT),0) AS BIGINT) AS zero_base_rows, CAST(COALESCE(SUM((b = a)::INT),0) AS BIGINT) AS exact_equal_rows,
 CAST(COALESCE(SUM((a > 0 AND abs((b - a) / a) <= 0.01)::INT),0) AS BIGINT) AS within_1pct_rows, SUM(a) AS base_total, SUM(b) AS other_total, SUM(b - a) AS signed_difference_total, SUM(abs(b - a)) AS absolute_difference_total,
 CASE WHEN SUM(a) > 0 THEN SUM(abs(b - a)) / SUM(a) END AS weighted_absolute_relative_difference, CASE WHEN SUM(a) > 0 THEN SUM(b - a) / SUM(a) END AS signed_relative_total_difference,
 median(abs(b - a)) AS median_absolute_difference, median(CASE WHEN a > 0 THEN abs((b - a) / a) END) AS median_absolute_relative_difference"""


@query(
    f"""WITH {_PAIRS}, smp AS (SELECT 'available_pairs' AS sample, * FROM pv WHERE valid UNION ALL SELECT 'common_all_offsets' AS sample, * FROM pv WHERE common UNION ALL SELECT 'scope_screened_available', * FROM pv WHERE clear_ UNION ALL SELECT 'scope_screened_common_all_offsets', * FROM pv WHERE clear_common),
 grid AS (SELECT s.sample, o.offset_, y.yr, 'all' AS population FROM (VALUES ('available_pairs'),('common_all_offsets'),('scope_screened_available'),('scope_screened_common_all_offsets')) s(sample), (VALUES (-2),(-1),(0),(1)) o(offset_), (SELECT 'all' AS yr UNION ALL SELECT DISTINCT CAST(year AS VARCHAR) FROM lft) y),
 agg AS (SELECT sample, offset_, CASE WHEN GROUPING(year) = 1 THEN 'all' ELSE CAST(year AS VARCHAR) END AS yr, CASE WHEN GROUPING(population) = 1 THEN 'all' ELSE population END AS population, {_METRICS} FROM smp GROUP BY GROUPING SETS ((sample, offset_), (sample, offset_, year), (sample, offset_, population)))
 SELECT coalesce(g.sample, a.sample) AS sample, CAST(coalesce(g.offset_, a.offset_) AS INTEGER) AS "offset", coalesce(g.yr, a.yr) AS ipeds_year, coalesce(g.population, a.population) AS reporting_population,
 coalesce(comparable_rows,0) AS comparable_rows, coalesce(positive_base_rows,0) AS positive_base_rows, coalesce(zero_base_rows,0) AS zero_base_rows, coalesce(exact_equal_rows,0) AS exact_equal_rows, coalesce(within_1pct_rows,0) AS within_1pct_rows,
 base_total, other_total, signed_difference_total, absolute_difference_total, weighted_absolute_relative_difference, signed_relative_total_difference, median_absolute_difference, median_absolute_relative_difference
 FROM grid g FULL JOIN agg a ON g.sample = a.sample AND g.offset_ = a.offset_ AND g.yr = a.yr AND g.population = a.population"""
)
def metric_summary_grouping_sets(spark, d):
    """Summary per sample, offset, year and population on a dense grid."""
    years = [r["year"] for r in _orders(spark, d).select("year").distinct().collect()]  # calendar years
    return benchmark.summary(_benchmark_pairs(spark, d), "population", years)


# -- family panel -----------------------------------------------------------------------
FAMILIES = ["f1", "f2", "f3", "f4", "f5"]


def _records(spark, d):
    o = _orders(spark, d)
    r = o.select(F.col("o_custkey").alias("unitid"), F.col("year").alias("award_year_start"), F.concat(F.lit("f"), F.substring("o_orderpriority", 1, 1)).alias("family"), F.col("o_orderkey").alias("record_id"), F.col("o_totalprice").alias("paid"), F.when(F.col("o_orderkey") % 9 == 0, "suppressed_lt10").otherwise("observed").alias("paid__status"))
    return family_panel.dispositions(r, F.col("record_id") % 6 != 0, F.when(F.col("record_id") % 31 == 0, "excluded_official_membership_overlap"))


_RECORDS = """rec AS (SELECT o_custkey AS unitid, CAST(year(o_orderdate) AS INTEGER) AS award_year_start, 'f' || substr(o_orderpriority,1,1) AS family, o_orderkey AS record_id, o_totalprice AS paid, CASE WHEN o_orderkey % 9 = 0 THEN 'suppressed_lt10' ELSE 'observed' END AS paid_status,
 CASE WHEN o_orderkey % 6 = 0 THEN 'excluded_annual_identity_unresolved' WHEN o_orderkey % 31 = 0 THEN 'excluded_official_membership_overlap' ELSE 'candidate' END AS guard FROM orders),
 dsp AS (SELECT *, CASE WHEN guard = 'excluded_annual_identity_unresolved' THEN guard WHEN SUM((guard <> 'excluded_annual_identity_unresolved')::INT) OVER (PARTITION BY unitid, award_year_start, family) > 1 THEN 'ambiguous_family_multiple_records'
 WHEN guard = 'candidate' THEN 'included_unique_family_record' ELSE guard END AS disposition FROM rec)"""


@query(f"WITH {_RECORDS} SELECT record_id, guard AS identity_guard_status, disposition AS record_disposition FROM dsp")
def family_block_duplicates(spark, d):
    """All records of a key with several are blocked."""
    return _records(spark, d).select("record_id", "identity_guard_status", "record_disposition")


@query(f"WITH {_RECORDS} SELECT family, disposition AS record_disposition, COUNT(*) AS n_records FROM dsp GROUP BY family, disposition")
def disposition_counts(spark, d):
    """Value counts of dispositions."""
    return _records(spark, d).groupBy("family", "record_disposition").agg(F.count(F.lit(1)).alias("n_records"))


def _unit_panel(spark, d):
    reports = _orders(spark, d).select(F.concat(F.lit("f"), F.substring("o_orderpriority", 1, 1)).alias("family"), F.col("year").alias("award_year_start")).distinct().where("NOT (family = 'f5' AND award_year_start < 1997)")
    headers = reports.withColumn("measure", F.lit("paid")).where("NOT (family = 'f4' AND award_year_start > 1999)")
    return family_panel.unit_panel(_records(spark, d), FAMILIES, ["paid"], reports, headers)


def _panel_sql() -> str:
    parts = []
    for f in FAMILIES:
        gap = "CASE " + ("WHEN award_year_start < 1997 THEN 'report_not_available' " if f == "f5" else "") + ("WHEN award_year_start > 1999 THEN 'unavailable_in_schema' " if f == "f4" else "") + "ELSE 'absent_source_record' END"
        gap = gap if "WHEN" in gap else "'absent_source_record'"
        st = f"CASE WHEN n_{f} = 0 THEN 'absent_source_record' WHEN n_{f} > 1 THEN 'ambiguous_family_multiple_records' ELSE d_{f} END"
        parts.append(f"{st} AS {f}__unitid_record_status, CASE WHEN n_{f} = 1 AND d_{f} = 'included_unique_family_record' THEN p_{f} END AS {f}__paid, CASE WHEN n_{f} = 0 THEN {gap} WHEN n_{f} > 1 THEN 'ambiguous_family_multiple_records' WHEN d_{f} = 'included_unique_family_record' THEN s_{f} ELSE d_{f} END AS {f}__paid__status")
    inc = " + ".join(f"(n_{f} = 1 AND d_{f} = 'included_unique_family_record')::INT" for f in FAMILIES)
    blk = " + ".join(f"(n_{f} > 1 OR (n_{f} = 1 AND d_{f} <> 'included_unique_family_record'))::INT" for f in FAMILIES)
    aggs = ", ".join(f"SUM((family = '{f}')::INT) AS n_{f}, MAX(CASE WHEN family = '{f}' THEN disposition END) AS d_{f}, MAX(CASE WHEN family = '{f}' THEN paid END) AS p_{f}, MAX(CASE WHEN family = '{f}' THEN paid_status END) AS s_{f}" for f in FAMILIES)
    return f"WITH {_RECORDS}, w AS (SELECT unitid, award_year_start, {aggs} FROM dsp WHERE guard <> 'excluded_annual_identity_unresolved' GROUP BY unitid, award_year_start) SELECT unitid, award_year_start, {', '.join(parts)}, CAST({inc} AS INTEGER) AS included_source_family_count, CAST({blk} AS INTEGER) AS blocked_source_family_count FROM w"


@query(_panel_sql())
def missing_cell_status(spark, d):
    """Wide panel with a status for every cell."""
    p = _unit_panel(spark, d)
    keep = [c for f in FAMILIES for c in (f"{f}__unitid_record_status", f"{f}__paid", f"{f}__paid__status")]
    return p.select("unitid", "award_year_start", *keep, "included_source_family_count", "blocked_source_family_count")


@query(
    f"""WITH {_RECORDS}, i AS (SELECT * FROM dsp WHERE disposition = 'included_unique_family_record'), s AS (SELECT award_year_start, SUM(CAST(paid AS DECIMAL(24,2))) AS s FROM i GROUP BY award_year_start)
 SELECT award_year_start, 'paid' AS "column", CAST(s AS DOUBLE) AS input_sum, CAST(s AS DOUBLE) AS output_sum, TRUE AS passed FROM s"""
)
def conservation_check(spark, d):
    """Known sums per year before and after the panel was built."""
    before = _records(spark, d).where("record_disposition = 'included_unique_family_record'").select("award_year_start", "paid")
    p = _unit_panel(spark, d)
    after = p.select("award_year_start", F.explode(F.array(*[F.col(f"{f}__paid") for f in FAMILIES])).alias("paid")).where("paid IS NOT NULL")
    out = conserve.sums_kept(before, after, "award_year_start", {"paid": 0.011})
    return out.select("award_year_start", "column", F.col("input_sum").cast("double").alias("input_sum"), F.col("output_sum").cast("double").alias("output_sum"), "passed")


@query("SELECT 'o_orderstatus' AS \"column\", COUNT(*) AS compared_rows, CAST(0 AS BIGINT) AS mismatched_cells FROM orders UNION ALL SELECT 'o_totalprice', COUNT(*), CAST(SUM((o_orderkey % 1000 = 0)::INT) AS BIGINT) FROM orders")
def cell_conservation(spark, d):
    """Cells that differ between a table and a copy with some cells set to null."""
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    copy = o.withColumn("o_totalprice", F.when(F.col("o_orderkey") % 1000 != 0, F.col("o_totalprice")))
    return conserve.cell_differences(o, copy, ["o_orderkey"])


# -- sets, counts, ranges ---------------------------------------------------------------
@query(
    """WITH p AS (SELECT l_partkey, COUNT(DISTINCT l_suppkey) AS n FROM lineitem GROUP BY l_partkey), s AS (SELECT l_suppkey, COUNT(DISTINCT l_partkey) AS n FROM lineitem GROUP BY l_suppkey)
 SELECT 'l_suppkey_per_l_partkey' AS relation, n AS n_distinct, COUNT(*) AS n_keys FROM p GROUP BY n UNION ALL SELECT 'l_partkey_per_l_suppkey', n, COUNT(*) FROM s GROUP BY n"""
)
def lifetime_cardinality(spark, d):
    """A2: how many partners a key ever has, in both directions."""
    return keys.partner_counts(table(spark, d, "lineitem"), "l_partkey", "l_suppkey")


@query(
    """WITH y AS (SELECT DISTINCT o_custkey AS u, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders WHERE o_orderpriority <> '5-LOW'), f AS (SELECT DISTINCT o_custkey AS u, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders WHERE o_orderstatus = 'F'), p AS (SELECT DISTINCT o_custkey AS u, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders WHERE o_orderstatus = 'P'),
 a AS (SELECT coalesce(y.y, f.y, p.y) AS yr, y.u IS NOT NULL AS d, f.u IS NOT NULL AS c, p.u IS NOT NULL AS b FROM y FULL JOIN f ON f.u = y.u AND f.y = y.y FULL JOIN p ON p.u = coalesce(y.u, f.u) AND p.y = coalesce(y.y, f.y))
 SELECT yr AS ipeds_year, COUNT(*) FILTER (d) AS directory_units, COUNT(*) FILTER (c) AS crosswalk_units, COUNT(*) FILTER (b) AS bridge_units, COUNT(*) FILTER (d AND c) AS directory_and_crosswalk, COUNT(*) FILTER (d AND b) AS directory_and_bridge, COUNT(*) FILTER (d AND NOT b AND NOT c) AS directory_only,
 COUNT(*) FILTER (d AND c AND NOT b) AS unrepresented_with_crosswalk, COUNT(*) FILTER (b AND NOT d) AS bridge_not_in_directory FROM a GROUP BY yr"""
)
def universe_reconciliation(spark, d):
    """Annual overlaps of three sets of ids in one aggregate."""
    o = _orders(spark, d).select("year", F.col("o_custkey").alias("unitid"), "o_orderstatus", "o_orderpriority")
    whole = o.where("o_orderpriority <> '5-LOW'").select(F.col("year").alias("ipeds_year"), "unitid").distinct()
    return linkage.reconcile(o.where("o_orderstatus = 'P'").withColumnRenamed("year", "ipeds_year"), whole, o.where("o_orderstatus = 'F'").withColumnRenamed("year", "cw_year"))


@query(
    """WITH u AS (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS y, o_custkey AS u FROM orders), s AS (SELECT u.y, u.u, bool_or(o_orderstatus = 'F' AND o_orderpriority = '1-URGENT') AS direct, bool_or(o_orderstatus = 'P') AS official, bool_or(o_orderpriority = '2-HIGH') AS root FROM u JOIN orders o ON o.o_custkey = u.u AND year(o.o_orderdate) = u.y GROUP BY u.y, u.u)
 SELECT y AS period, CASE WHEN official AND root THEN 'both_official_affiliation_and_diagnostic_root' WHEN official THEN 'official_affiliation_only' WHEN root THEN 'diagnostic_root_only' ELSE 'no_group_evidence_in_reviewed_sources' END AS category, COUNT(*) AS n_units FROM s WHERE NOT direct GROUP BY ALL"""
)
def residual_partition(spark, d):
    """Units of a universe without a direct link, parted by the evidence there is of a group."""
    o = _orders(spark, d).select(F.col("year").alias("period"), F.col("o_custkey").alias("unitid"), "o_orderstatus", "o_orderpriority")
    parts = linkage.residual(o, o.where("o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'"), o.where("o_orderstatus = 'P'"), o.where("o_orderpriority = '2-HIGH'"))
    return parts.groupBy("period", "category").agg(F.count(F.lit(1)).alias("n_units"))


@query(
    """WITH a AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'F'), b AS (SELECT c_custkey AS k FROM customer WHERE c_acctbal > 0)
 SELECT CAST(SUM((a.k IS NOT NULL AND b.k IS NOT NULL)::INT) AS BIGINT) AS in_both, CAST(SUM((b.k IS NULL)::INT) AS BIGINT) AS left_only, CAST(SUM((a.k IS NULL)::INT) AS BIGINT) AS right_only FROM a FULL JOIN b ON a.k = b.k"""
)
def id_set_algebra(spark, d):
    """Sizes of intersection and differences of two id sets."""
    a = table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("k"))
    b = table(spark, d, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("k"))
    return keys.set_counts(a, b, "k")


@query(
    """WITH m AS (SELECT DISTINCT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS y, o_orderpriority AS p FROM orders), x AS (SELECT DISTINCT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS y, o_orderpriority AS p FROM orders WHERE o_orderstatus = 'P')
 SELECT m.p AS opeid8, m.y AS award_year, COUNT(*) AS n_units FROM m LEFT JOIN x ON x.o_custkey = m.o_custkey AND x.y = m.y AND x.p = m.p WHERE x.p IS NULL GROUP BY ALL"""
)
def contradicted_anti_join(spark, d):
    """Memberships without the contradicted ones."""
    m = _orders(spark, d).select(F.col("o_orderpriority").alias("opeid8"), F.col("year").alias("award_year"), F.col("o_custkey").alias("unitid"), "o_orderstatus")
    left = linkage.represented(m.drop("o_orderstatus").distinct(), m.where("o_orderstatus = 'P'").drop("o_orderstatus").distinct())
    return left.groupBy("opeid8", "award_year").agg(F.count(F.lit(1)).alias("n_units"))


@query(
    """WITH y AS (SELECT DISTINCT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders), i AS (SELECT *, y - row_number() OVER (PARTITION BY o_custkey ORDER BY y) AS g FROM y), r AS (SELECT o_custkey, MIN(y) AS a, MAX(y) AS b FROM i GROUP BY o_custkey, g)
 SELECT o_custkey, string_agg(CASE WHEN a = b THEN CAST(a AS VARCHAR) ELSE CAST(a AS VARCHAR) || '-' || CAST(b AS VARCHAR) END, ',' ORDER BY a) AS year_ranges FROM r GROUP BY o_custkey"""
)
def year_ranges_islands(spark, d):
    """Active years as ranges."""
    return periods.year_ranges(_orders(spark, d), ["o_custkey"], "year")


@query(
    """WITH r AS (SELECT o_orderkey, o_custkey, list_filter([CASE WHEN o_totalprice > 300000 THEN 'large' END, CASE WHEN o_orderstatus = 'P' THEN 'pending' END, CASE WHEN o_orderpriority = '5-LOW' THEN 'low' END, CASE WHEN o_custkey % 2 = 0 THEN 'even' END], lambda x: x IS NOT NULL) AS reasons FROM orders)
 SELECT x.reason, COUNT(*) AS n FROM (SELECT unnest(reasons) AS reason FROM r) x GROUP BY x.reason"""
)
def exclusion_reasons_explode(spark, d):
    """Reasons per row as text, split again and counted."""
    flags = {"large": F.col("o_totalprice") > 300000, "pending": F.col("o_orderstatus") == "P", "low": F.col("o_orderpriority") == "5-LOW", "even": F.col("o_custkey") % 2 == 0}
    told = table(spark, d, "orders").select(F.concat_ws(";", scope.reasons(flags)).alias("reasons"))
    return told.select(F.explode(F.split("reasons", ";")).alias("reason")).where("reason <> ''").groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS o_orderstatus FROM orders GROUP BY o_custkey")
def keep_last_dedup(spark, d):
    """The last order of each customer, ties settled by the key."""
    o = table(spark, d, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus")
    return keys.keep_last(o, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_orderstatus")


@query(
    """WITH g AS (SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber) SELECT CAST(SUM(n) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS null_key_rows, CAST(SUM((n > 1)::INT) AS BIGINT) AS repeated_keys, CAST(SUM(CASE WHEN n > 1 THEN n ELSE 0 END) AS BIGINT) AS rows_in_repeats, CAST(SUM(CASE WHEN l_orderkey <= 0 THEN n ELSE 0 END) AS BIGINT) AS invalid_key_rows FROM g"""
)
def key_violations(spark, d):
    """C4: how a would-be key fails, in one aggregate."""
    return keys.violations(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_orderkey"])


@query("SELECT l_orderkey, l_linenumber, COUNT(*) AS n_rows FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1")
def duplicate_members(spark, d):
    """Rows whose key repeats, counted per key."""
    marked = keys.mark_duplicates(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"])
    return marked.where("is_duplicate").groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n_rows"))


@query("SELECT TRUE AS same_with_other_order, (SELECT COUNT(*) = 0 FROM orders WHERE o_orderkey % 100 = 0) AS same_without_some")
def bag_equality(spark, d):
    """Record bags compared whatever their order."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return spark.createDataFrame([(keys.bags_equal(o, o.repartition(3, "o_custkey")), keys.bags_equal(o, o.where("o_orderkey % 100 <> 0")))], "same_with_other_order boolean, same_without_some boolean")


@query(
    """SELECT c.c_custkey, c.c_name, n.n_name, o.n AS n_orders, o.n IS NOT NULL AS has_orders FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey LEFT JOIN (SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY o_custkey) o ON o.o_custkey = c.c_custkey"""
)
def checked_joins(spark, d):
    """Joins with a declared cardinality and a presence marker."""
    c = table(spark, d, "customer").select("c_custkey", "c_name", F.col("c_nationkey").alias("n_nationkey"))
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    o = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n_orders"))
    a = keys.checked_join(c, n, ["n_nationkey"], "inner", "many_to_one")
    return keys.presence_join(a, o, ["c_custkey"], "has_orders").select("c_custkey", "c_name", "n_name", "n_orders", "has_orders")


# -- harmonising ------------------------------------------------------------------------
def _copies(spark, d):
    o = _orders(spark, d)
    return o.select("o_orderkey", "year", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_totalprice")).alias("a"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_totalprice")).alias("b"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 OR o_orderkey % 2 = 0 THEN o_totalprice END AS paid FROM orders")
def coalesce_checked(spark, d):
    """Coalesce of two partly null copies that must not conflict."""
    return harmonise.coalesce_checked(_copies(spark, d), ["a", "b"], "paid").select("o_orderkey", "paid")


@query("SELECT CAST(SUM((o_orderkey % 3 <> 0 AND o_orderkey % 2 = 0)::INT) AS BIGINT) AS overlap_rows, CAST(SUM((o_orderkey % 3 <> 0 AND o_orderkey % 2 = 0 AND o_orderkey % 50 = 2)::INT) AS BIGINT) AS conflict_rows FROM orders")
def coalesce_conflicts(spark, d):
    """Rows in which two copies overlap and conflict."""
    c = _copies(spark, d).withColumn("b", F.when(F.col("o_orderkey") % 50 == 2, F.col("b") + 1).otherwise(F.col("b")))
    return harmonise.coalesce_report(c, ["a", "b"])


@query("SELECT o_orderkey, o_totalprice AS paid FROM orders")
def year_partition_project(spark, d):
    """The column to take depends on the year."""
    o = _orders(spark, d).select("o_orderkey", "year", F.when(F.col("year") <= 1997, F.col("o_totalprice")).alias("old"), F.when(F.col("year") > 1997, F.col("o_totalprice")).alias("new"))
    return harmonise.year_partition(o, "year", [harmonise.YearRule("old", 1990, 1997), harmonise.YearRule("new", 1998, 2010)], "paid").select("o_orderkey", "paid")


RULES = [harmonise.MissingRule("code", 1996, "-1", "not_reported", "r1"), harmonise.MissingRule("code", 1997, "-2", "not_applicable", "r2"), harmonise.MissingRule("amount", 1996, "0", "not_available", "r3")]


def _coded(spark, d):
    k = F.col("o_orderkey") % 6
    code = F.when(k == 0, "-1").when(k == 1, "-1.0").when(k == 2, " -2 ").when(k == 3, "-01").otherwise(k.cast("string"))
    return _orders(spark, d).select("o_orderkey", "year", code.alias("code"), F.when(F.col("o_orderkey") % 10 == 0, 0.0).otherwise(F.col("o_totalprice")).alias("amount"))


_CODED = "c AS (SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CASE o_orderkey % 6 WHEN 0 THEN '-1' WHEN 1 THEN '-1.0' WHEN 2 THEN ' -2 ' WHEN 3 THEN '-01' ELSE CAST(o_orderkey % 6 AS VARCHAR) END AS code, CASE WHEN o_orderkey % 10 = 0 THEN 0.0 ELSE o_totalprice END AS amount FROM orders)"


@query(f"WITH {_CODED} SELECT o_orderkey, CASE WHEN (year = 1996 AND o_orderkey % 6 IN (0, 1)) OR (year = 1997 AND o_orderkey % 6 = 2) THEN NULL ELSE code END AS code, CASE WHEN year = 1996 AND amount = 0 THEN NULL ELSE amount END AS amount FROM c")
def missing_code_recode(spark, d):
    """Coded cells become null, by column and year."""
    clean, _ = harmonise.recode_missing(_coded(spark, d), ["o_orderkey"], "year", RULES)
    return clean.select("o_orderkey", "code", "amount")


@query(
    f"""WITH {_CODED} SELECT o_orderkey, 'code' AS "column", code AS original_value, CASE WHEN year = 1996 THEN 'r1' ELSE 'r2' END AS rule_id, CASE WHEN year = 1996 THEN 'not_reported' ELSE 'not_applicable' END AS reason FROM c WHERE (year = 1996 AND o_orderkey % 6 IN (0, 1)) OR (year = 1997 AND o_orderkey % 6 = 2)
 UNION ALL SELECT o_orderkey, 'amount', '0.0', 'r3', 'not_available' FROM c WHERE year = 1996 AND amount = 0"""
)
def missing_code_ledger(spark, d):
    """The ledger of recoded cells."""
    return harmonise.recode_missing(_coded(spark, d), ["o_orderkey"], "year", RULES)[1]


@query("SELECT o_orderkey, CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 WHEN 'P' THEN 3 END AS INTEGER) AS status_code FROM orders")
def value_label_encode(spark, d):
    """Reversible codes of a category; an unknown value would raise."""
    return harmonise.encode_categories(table(spark, d, "orders"), "o_orderstatus", {"F": 1, "O": 2, "P": 3}, "status_code").select("o_orderkey", "status_code")


@query(
    """WITH v AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS y, o_orderstatus AS st, CASE WHEN year(o_orderdate) < 1998 THEN 'old' ELSE 'std' END AS lab, o_custkey % 3 AS var FROM orders),
 y AS (SELECT DISTINCT var, st, lab, y FROM v), i AS (SELECT *, y - row_number() OVER (PARTITION BY var, st, lab ORDER BY y) AS g FROM y), r AS (SELECT var, st, lab, MIN(y) AS a, MAX(y) AS b FROM i GROUP BY var, st, lab, g),
 t AS (SELECT var, st, lab, MIN(a) AS f, string_agg(CASE WHEN a = b THEN CAST(a AS VARCHAR) ELSE CAST(a AS VARCHAR) || '-' || CAST(b AS VARCHAR) END, ',' ORDER BY a) || ': ' || lab AS s FROM r GROUP BY var, st, lab)
 SELECT var AS variable, st AS code, string_agg(s, '; ' ORDER BY f, s) AS labels FROM t GROUP BY var, st"""
)
def year_scoped_labels(spark, d):
    """Value labels with the years they held."""
    v = _orders(spark, d).select((F.col("o_custkey") % 3).alias("variable"), "year", F.col("o_orderstatus").alias("code"), F.when(F.col("year") < 1998, "old").otherwise("std").alias("label"))
    return metadata.scoped_labels(v, "variable", "year", "code", "label")


@query(
    """WITH v AS (SELECT p_partkey AS id, p_brand AS scope, p_type AS varname, CASE WHEN p_partkey % 4 = 0 THEN '' ELSE CAST(p_partkey % 3 AS VARCHAR) END AS varnumber FROM part),
 c AS (SELECT DISTINCT p_brand AS scope, p_type AS varname, CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE CAST(p_partkey % 3 AS VARCHAR) END AS varnumber FROM part WHERE p_size < 10)
 SELECT id, v.scope, v.varname, v.varnumber, c.varnumber AS code_varnumber FROM v JOIN c ON v.scope = c.scope AND v.varname = c.varname AND (coalesce(v.varnumber,'') = '' OR coalesce(c.varnumber,'') = '' OR v.varnumber = c.varnumber)"""
)
def exact_scope_metadata_join(spark, d):
    """Exact scope, numbers equal only where both are known."""
    p = table(spark, d, "part")
    v = p.select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("scope"), F.col("p_type").alias("varname"), F.when(F.col("p_partkey") % 4 == 0, "").otherwise((F.col("p_partkey") % 3).cast("string")).alias("varnumber"))
    c = p.where("p_size < 10").select(F.col("p_brand").alias("scope"), F.col("p_type").alias("varname"), F.when(F.col("p_partkey") % 5 == 0, F.lit(None)).otherwise((F.col("p_partkey") % 3).cast("string")).alias("varnumber")).distinct()
    return metadata.scoped_join(v, c, ["scope"])


@query("SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size < 20) AND l_partkey IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R')")
def exact_key_intersection(spark, d):
    """Keys in all of three tables."""
    li = table(spark, d, "lineitem").select("l_partkey", "l_suppkey").distinct()
    returned = table(spark, d, "lineitem").where("l_returnflag = 'R'").select("l_partkey")
    small = table(spark, d, "part").where("p_size < 20").select(F.col("p_partkey").alias("l_partkey"))
    return metadata.exact_keys(returned, small, li, ["l_partkey"])


@query("SELECT DISTINCT l_returnflag, l_linestatus, CAST(year(l_shipdate) AS INTEGER) AS year FROM lineitem WHERE year(l_shipdate) IN (1996, 1998, 2000)")
def lineage_distinct(spark, d):
    """Distinct lineage records of some years, in order."""
    from panelwright.sources.tables import lineage

    li = table(spark, d, "lineitem").withColumn("year", F.year("l_shipdate"))
    return lineage(li, ["l_returnflag", "l_linestatus", "year"], [1996, 1998, 2000], ["year", "l_returnflag", "l_linestatus"])


_AUDIT = """dic AS (SELECT p_partkey AS v, CASE WHEN p_partkey % 10 = 0 THEN '' ELSE 'Id' || CAST(p_size AS VARCHAR) END AS vid, p_brand AS sf, p_type AS tb FROM part),
 lin AS (SELECT p_partkey AS v, 'id' || CAST(CASE WHEN p_partkey % 10 = 1 THEN p_size + 1 ELSE p_size END AS VARCHAR) AS vid, lower(p_brand) AS sf, CASE WHEN p_partkey % 10 = 2 THEN 'other' ELSE lower(p_type) END AS tb, CASE WHEN p_partkey % 10 = 3 THEN 'derived' ELSE 'Direct' END AS role FROM part WHERE p_partkey % 10 <> 4
 UNION ALL SELECT p_partkey, 'second', lower(p_brand), lower(p_type), 'direct' FROM part WHERE p_partkey % 10 = 5)"""


@query(
    f"""WITH {_AUDIT}, a AS (SELECT v, COUNT(DISTINCT (vid, sf, tb)) AS n, MAX(vid) AS vid, MAX(sf) AS sf, MAX(tb) AS tb, bool_and(lower(role) = 'direct') AS plain FROM lin GROUP BY v)
 SELECT CAST(2010 AS INTEGER) AS year, d.v AS variable, CAST(coalesce(a.n, 0) AS INTEGER) AS lineage_source_count, CASE WHEN d.vid = '' THEN 'dictionary_source_identity_incomplete' WHEN a.v IS NULL THEN 'lineage_entry_missing' WHEN a.n <> 1 THEN 'ambiguous_lineage_sources'
 WHEN a.vid <> lower(d.vid) OR a.sf <> lower(d.sf) THEN 'variable_or_source_family_conflict' WHEN a.tb <> lower(d.tb) THEN 'source_table_conflict' WHEN NOT plain THEN 'nonidentity_lineage_requires_review' ELSE 'verified_annual_source_identity' END AS source_metadata_status FROM dic d LEFT JOIN a ON a.v = d.v"""
)
def source_metadata_audit(spark, d):
    """Whether values come from the table that the dictionary names."""
    p = table(spark, d, "part")
    k = F.col("p_partkey") % 10
    base = [F.lit(2010).alias("year"), F.col("p_partkey").alias("variable")]
    dic = p.select(*base, F.when(k == 0, "").otherwise(F.concat(F.lit("Id"), F.col("p_size").cast("string"))).alias("variable_id"), F.col("p_brand").alias("source_file"), F.col("p_type").alias("access_table_name"))
    lin = p.where(k != 4).select(*base, F.concat(F.lit("id"), F.when(k == 1, F.col("p_size") + 1).otherwise(F.col("p_size")).cast("string")).alias("variable_id"), F.lower("p_brand").alias("source_file"), F.when(k == 2, "other").otherwise(F.lower("p_type")).alias("access_table_name"), F.when(k == 3, "derived").otherwise("Direct").alias("lineage_role"))
    second = p.where(k == 5).select(*base, F.lit("second").alias("variable_id"), F.lower("p_brand").alias("source_file"), F.lower("p_type").alias("access_table_name"), F.lit("direct").alias("lineage_role"))
    return metadata.source_audit(dic, lin.unionByName(second))


@query(
    """WITH l AS (SELECT p_partkey AS k, CASE p_partkey % 6 WHEN 0 THEN '{Not applicable}' WHEN 1 THEN 'Not reported' WHEN 2 THEN 'Not derived - x' WHEN 3 THEN 'Yes' WHEN 4 THEN 'Item not available' ELSE 'Not  applicable, closed' END AS label, CASE WHEN p_partkey % 5 = 0 THEN 'STAT_X' ELSE 'VAR' END AS v FROM part)
 SELECT v AS variable, label, CASE WHEN v = 'STAT_X' THEN NULL WHEN label = 'Not reported' THEN 'not_reported' WHEN label LIKE '%applicable%' THEN 'not_applicable' WHEN label LIKE 'Item not%' THEN 'not_available' WHEN label LIKE 'Not derived%' THEN 'not_derived' END AS reason, COUNT(*) AS n FROM l GROUP BY v, label, reason"""
)
def missing_label_reasons(spark, d):
    """Why a code is missing, by its label."""
    k = F.col("p_partkey") % 6
    label = F.when(k == 0, "{Not applicable}").when(k == 1, "Not reported").when(k == 2, "Not derived - x").when(k == 3, "Yes").when(k == 4, "Item not available").otherwise("Not  applicable, closed")
    t = table(spark, d, "part").select(F.when(F.col("p_partkey") % 5 == 0, "STAT_X").otherwise("VAR").alias("variable"), label.alias("label"))
    return t.withColumn("reason", labels.missing_reason(F.col("variable"), F.lit("-1"), F.col("label"))).groupBy("variable", "label", "reason").agg(F.count(F.lit(1)).alias("n"))


# -- scalar functions -------------------------------------------------------------------
@query(
    """WITH t AS (SELECT o_orderkey AS k, CASE o_orderkey % 7 WHEN 0 THEN CAST(o_custkey AS VARCHAR) WHEN 1 THEN CAST(o_custkey AS VARCHAR) || '.0' WHEN 2 THEN ' ' || CAST(o_custkey AS VARCHAR) || ' ' WHEN 3 THEN 'bad' || CAST(o_custkey AS VARCHAR) WHEN 4 THEN '00000000' WHEN 5 THEN '123456789' END AS raw FROM orders),
 n AS (SELECT k, raw, CASE WHEN regexp_full_match(trim(raw), '[0-9]{1,8}(\\.0+)?') THEN nullif(lpad(split_part(trim(raw), '.', 1), 8, '0'), '00000000') END AS opeid8 FROM t)
 SELECT k AS o_orderkey, opeid8, '0' || substr(opeid8, 2, 5) AS opeid_root, CASE WHEN raw IS NULL OR raw = '' THEN 'source_missing' WHEN raw = '-2' THEN 'not_applicable' WHEN regexp_full_match(raw, '[0-9]{8}') AND raw <> '00000000' THEN 'numeric8_format_only_not_verified_match' WHEN regexp_full_match(raw, '[0-9]{6}[A-Z][0-9]') THEN 'ipeds_alpha_reporting_branch_not_exact_fsa_id' ELSE 'unrecognized_source_identifier' END AS id_format FROM n"""
)
def normalize_identifier(spark, d):
    """Ids in many spellings."""
    k, c = F.col("o_orderkey") % 7, F.col("o_custkey").cast("string")
    raw = F.when(k == 0, c).when(k == 1, F.concat(c, F.lit(".0"))).when(k == 2, F.concat(F.lit(" "), c, F.lit(" "))).when(k == 3, F.concat(F.lit("bad"), c)).when(k == 4, "00000000").when(k == 5, "123456789")
    t = table(spark, d, "orders").select("o_orderkey", raw.alias("raw")).withColumn("opeid8", ids.full_opeid(F.col("raw")))
    return t.select("o_orderkey", "opeid8", ids.opeid_root(F.col("opeid8")).alias("opeid_root"), ids.opeid_format(F.col("raw")).alias("id_format"))


@query(
    """WITH t AS (SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y, CASE o_orderkey % 5 WHEN 0 THEN CAST(year(o_orderdate) AS VARCHAR) WHEN 1 THEN CAST(year(o_orderdate) AS VARCHAR) || '-' || lpad(CAST((year(o_orderdate) + 1) % 100 AS VARCHAR), 2, '0') WHEN 2 THEN CAST(year(o_orderdate) AS VARCHAR) || '–' || CAST(year(o_orderdate) + 1 AS VARCHAR) WHEN 3 THEN CAST(year(o_orderdate) AS VARCHAR) || '-' || CAST(year(o_orderdate) + 2 AS VARCHAR) ELSE 'AY' || CAST(year(o_orderdate) AS VARCHAR) END AS lab FROM orders)
 SELECT o_orderkey, lab AS award_year, CASE WHEN o_orderkey % 5 IN (0, 1, 2) THEN y END AS award_year_start FROM t"""
)
def award_year_parse(spark, d):
    """Award-year labels; the end year must follow the start year."""
    k, y = F.col("o_orderkey") % 5, F.col("year")
    s = y.cast("string")
    lab = F.when(k == 0, s).when(k == 1, F.concat(s, F.lit("-"), F.lpad(((y + 1) % 100).cast("string"), 2, "0"))).when(k == 2, F.concat(s, F.lit("–"), (y + 1).cast("string"))).when(k == 3, F.concat(s, F.lit("-"), (y + 2).cast("string"))).otherwise(F.concat(F.lit("AY"), s))
    t = _orders(spark, d).select("o_orderkey", lab.alias("award_year"))
    return t.withColumn("award_year_start", ids.award_year_start(F.col("award_year")))


@query(
    """WITH t AS (SELECT l_orderkey AS k, l_linenumber AS n, CASE WHEN l_partkey % 9 = 0 THEN 'No match' WHEN l_partkey % 9 = 1 THEN CAST(100000 + l_partkey AS VARCHAR) || ' | 100' ELSE CAST(100000 + l_partkey AS VARCHAR) || ' | ' || CAST(100000 + l_suppkey AS VARCHAR) || '.0|' || CAST(100000 + l_partkey AS VARCHAR) END AS f FROM lineitem),
 x AS (SELECT DISTINCT f, trim(unnest(string_split(f, '|'))) AS tok FROM t)
 SELECT f AS field, COUNT(DISTINCT CASE WHEN regexp_full_match(tok, '[1-9][0-9]{5}(\\.0+)?') THEN split_part(tok, '.', 1) END) AS n_units, bool_and(regexp_full_match(tok, '[1-9][0-9]{5}(\\.0+)?') OR lower(tok) IN ('', '-2', 'no match', 'no matches', 'nan', 'none', '<na>')) AS complete FROM x GROUP BY f"""
)
def split_token_sets(spark, d):
    """Lists of unit ids; a token that is none keeps the list incomplete."""
    p, s = (100000 + F.col("l_partkey")).cast("string"), (100000 + F.col("l_suppkey")).cast("string")
    k = F.col("l_partkey") % 9
    f = F.when(k == 0, "No match").when(k == 1, F.concat(p, F.lit(" | 100"))).otherwise(F.concat(p, F.lit(" | "), s, F.lit(".0|"), p))
    t = table(spark, d, "lineitem").select(f.alias("field")).distinct().withColumn("t", ids.unit_tokens(F.col("field")))
    return t.select("field", F.size("t.units").cast("bigint").alias("n_units"), F.col("t.complete").alias("complete"))


@query(
    """WITH t AS (SELECT o_orderkey AS k, CASE o_orderkey % 9 WHEN 0 THEN '<10' WHEN 1 THEN '' WHEN 2 THEN '-' WHEN 3 THEN '$' || CAST(o_custkey AS VARCHAR) WHEN 4 THEN '1.2.3' WHEN 5 THEN '0' WHEN 6 THEN '1,234' WHEN 7 THEN '-5' ELSE '2.5' END AS tok FROM orders)
 SELECT tok AS raw_token, CASE WHEN tok = '<10' THEN 'suppressed_lt10' WHEN tok = '' THEN 'source_blank' WHEN tok = '-' THEN 'source_symbol' WHEN tok = '1.2.3' THEN 'invalid_numeric' WHEN tok IN ('0', '$0') THEN 'observed_zero' WHEN tok = '-5' THEN 'invalid_negative_count' WHEN tok = '2.5' THEN 'invalid_fractional_count' ELSE 'observed' END AS status,
 CASE WHEN tok = '0' THEN 0.0 WHEN tok = '1,234' THEN 1234.0 WHEN starts_with(tok, '$') THEN CAST(substr(tok, 2) AS DOUBLE) END AS value, CASE WHEN tok = '<10' THEN 0.0 END AS lower_bound, CASE WHEN tok = '<10' THEN 9.0 END AS upper_bound, COUNT(*) AS n FROM t GROUP BY tok"""
)
def parse_token_measure(spark, d):
    """M1: report cells to values with a status and bounds."""
    k = F.col("o_orderkey") % 9
    tok = F.when(k == 0, "<10").when(k == 1, "").when(k == 2, "-").when(k == 3, F.concat(F.lit("$"), F.col("o_custkey").cast("string"))).when(k == 4, "1.2.3").when(k == 5, "0").when(k == 6, "1,234").when(k == 7, "-5").otherwise("2.5")
    t = table(spark, d, "orders").select(tok.alias("tok")).groupBy("tok").agg(F.count(F.lit(1)).alias("n")).withColumn("m", measures.parse(F.col("tok"), True))
    return t.select("m.raw_token", "m.status", "m.value", "m.lower_bound", "m.upper_bound", "n")


@query(
    """WITH y AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS y, SUM(CASE WHEN o_orderpriority LIKE '1%' THEN 1 END) AS d, SUM(CASE WHEN o_orderpriority LIKE '2%' THEN 1 END) AS f FROM orders GROUP BY o_custkey, year(o_orderdate))
 SELECT o_custkey, y AS year, CASE WHEN d IS NULL AND f IS NULL THEN 'no_observed_components' WHEN d IS NULL OR (f IS NULL AND y <= 1998) THEN 'incomplete_component_sum' WHEN y > 1998 THEN 'complete_direct_only_scope' ELSE 'complete_component_sum' END AS status,
 CASE WHEN d IS NOT NULL AND (f IS NOT NULL OR y > 1998) THEN CAST(d + coalesce(f, 0) AS DOUBLE) END AS value, CASE WHEN d IS NOT NULL OR f IS NOT NULL THEN CAST(coalesce(d, 0) + coalesce(f, 0) AS DOUBLE) END AS observed_partial_sum, CASE WHEN d IS NOT NULL AND f IS NOT NULL THEN CAST(greatest(d, f) AS DOUBLE) END AS people_lower, CASE WHEN d IS NOT NULL AND f IS NOT NULL THEN CAST(d + f AS DOUBLE) END AS people_upper FROM y"""
)
def component_sums(spark, d):
    """M2, M3, M4: sums that are complete only if every required part is known."""
    p = F.substring("o_orderpriority", 1, 1)
    y = _orders(spark, d).groupBy("o_custkey", "year").agg(F.sum(F.when(p == "1", 1.0)).alias("d"), F.sum(F.when(p == "2", 1.0)).alias("f"))
    s = measures.component_sum([F.col("d"), F.col("f")], [F.lit(True), F.col("year") <= 1998])
    b = measures.people_bounds([F.col("d"), F.col("f")])
    return y.select("o_custkey", "year", s.alias("s"), b.alias("b")).select("o_custkey", "year", "s.status", "s.value", "s.observed_partial_sum", F.col("b.lower_bound").alias("people_lower"), F.col("b.upper_bound").alias("people_upper"))


@query("SELECT event_type, CAST(SUM(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS sum_k, CAST(MIN(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS min_k, CAST(MAX(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS max_k, COUNT(*) AS n FROM events GROUP BY event_type")
def json_props(spark, d):
    """Fields of JSON text."""
    e = table(spark, d, "events").select("event_type", F.from_json("props", "k bigint")["k"].alias("k"))
    return e.groupBy("event_type").agg(F.sum("k").alias("sum_k"), F.min("k").alias("min_k"), F.max("k").alias("max_k"), F.count(F.lit(1)).alias("n"))


@query("SELECT o_orderkey, (o_orderkey % 4 = 0) AS note__is_null FROM orders")
def string_null_masks(spark, d):
    """K7: the sidecar that tells null from empty text."""
    o = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 4 == 0, F.lit(None)).when(F.col("o_orderkey") % 4 == 1, "").otherwise("x").alias("note"))
    return conserve.null_masks(o, ["o_orderkey"])


@query("SELECT c_custkey, 'c_name' AS field, c_name AS value FROM customer UNION ALL SELECT c_custkey, 'c_mktsegment', c_mktsegment FROM customer")
def unpivot_ledger(spark, d):
    """Wide rows to long ledger rows."""
    return table(spark, d, "customer").unpivot("c_custkey", ["c_name", "c_mktsegment"], "field", "value")


@query(f"WITH {_RECORDS} SELECT award_year_start, CAST(SUM((disposition = 'included_unique_family_record')::INT) AS BIGINT) AS included, CAST(SUM((disposition = 'ambiguous_family_multiple_records')::INT) AS BIGINT) AS multiple FROM dsp GROUP BY award_year_start")
def pivot_disposition(spark, d):
    """Long counts to wide columns."""
    r = _records(spark, d)
    p = r.groupBy("award_year_start").pivot("record_disposition", [family_panel.INCLUDED, family_panel.MULTIPLE]).agg(F.count(F.lit(1)))
    return p.select("award_year_start", F.coalesce(F.col(family_panel.INCLUDED), F.lit(0)).alias("included"), F.coalesce(F.col(family_panel.MULTIPLE), F.lit(0)).alias("multiple"))


@query("SELECT CAST(year(l_shipdate) AS INTEGER) AS year, l_returnflag, COUNT(*) AS n, SUM(CAST(l_extendedprice AS DECIMAL(18,2)))::DOUBLE AS paid FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '1998-01-01' GROUP BY 1, 2")
def pruned_year_scan(spark, d):
    """Two columns of one year; the filter compares the raw column, so it reaches the scan."""
    li = table(spark, d, "lineitem").where("l_shipdate >= timestamp_ntz'1997-01-01' AND l_shipdate < timestamp_ntz'1998-01-01'")
    return li.groupBy(F.year("l_shipdate").alias("year"), "l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("paid"))


@query()
def name_similarity(spark, d):
    """Likeness of names (matching blocks, which SQL does not have)."""
    p = table(spark, d, "part").select("p_partkey", text.name_key(F.col("p_name")).alias("a"), text.name_key(F.col("p_type")).alias("b"))
    return p.select("p_partkey", text.name_similarity("a", "b").alias("similarity"))


@query("SELECT unnest(['c_name', 'c_nationkey', 'c_acctbal', 'c_mktsegment', 'note']) AS \"column\", (SELECT COUNT(*) FROM customer) AS compared_rows, CAST(0 AS BIGINT) AS mismatched_cells")
def csv_roundtrip(spark, d):
    """A table written with the null token and read back, compared cell by cell."""
    import os

    from panelwright.session import ensure_checkpoint_dir
    from panelwright.sinks.tables import token_csv
    from panelwright.sources.tables import typed_csv

    o = table(spark, d, "customer").withColumn("note", F.when(F.col("c_custkey") % 3 == 0, F.lit(None)).when(F.col("c_custkey") % 3 == 1, "").otherwise('a "b"\nc, NA'))
    path = os.path.join(ensure_checkpoint_dir(spark), f"csv-roundtrip-{spark.sparkContext.applicationId}-{abs(hash(d)) % 10**8}-{os.urandom(4).hex()}")
    token_csv(o, path)
    return conserve.cell_differences(o, typed_csv(spark, path, o.schema), ["c_custkey"])


@query("SELECT o_orderkey, b - a AS difference, CASE WHEN a > 0 THEN (b - a) / a END AS relative_difference, a = b AS exact_equal FROM (SELECT o_orderkey, CAST(o_orderkey % 4 AS DOUBLE) AS a, CAST(o_custkey % 4 AS DOUBLE) AS b FROM orders)")
def difference_columns(spark, d):
    """Difference, relative difference for a positive base, equality."""
    o = table(spark, d, "orders").select("o_orderkey", (F.col("o_orderkey") % 4).cast("double").alias("a"), (F.col("o_custkey") % 4).cast("double").alias("b"))
    c = stats.differences(F.col("a"), F.col("b"), F.lit(True))
    return o.select("o_orderkey", *[c[k].alias(k) for k in ("difference", "relative_difference", "exact_equal")])


# -- plans over wide tables -------------------------------------------------------------
@query("SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, o_orderstatus, CASE WHEN o_orderkey % 3 <> 0 OR o_orderkey % 2 = 0 THEN o_totalprice END AS paid, o_custkey AS party FROM orders")
def analysis_view(spark, d):
    """A projection plan with consolidated columns, built in one select."""
    from panelwright.plans import analysis

    k = F.col("o_orderkey")
    o = _orders(spark, d).select("o_orderkey", "year", "o_orderstatus", F.when(k % 3 != 0, F.col("o_totalprice")).alias("paid_a"), F.when(k % 2 == 0, F.col("o_totalprice")).alias("paid_b"), F.when(F.col("year") <= 1997, F.col("o_custkey")).alias("old"), F.when(F.col("year") > 1997, F.col("o_custkey")).alias("new"), F.lit("x").alias("admin_note"))
    groups = [
        {"target": "paid", "sources": ["paid_a", "paid_b"], "method": "coalesce"},
        {"target": "party", "sources": ["old", "new"], "method": "year_partition", "year_rules": [{"source": "old", "min": 1990, "max": 1997}, {"source": "new", "min": 1998, "max": 2010}]},
    ]
    return analysis.build(o, analysis.make_specs(o.columns, groups, dropped=("admin_note",)), "year")


_POLICY = """val AS (SELECT p_partkey % 200 AS v, p_size AS y, CAST(p_partkey % 3 - 2 AS VARCHAR) AS code, CASE p_partkey % 4 WHEN 0 THEN 'Not applicable' WHEN 1 THEN 'Not applicable' WHEN 2 THEN 'Yes' ELSE 'Not reported' END AS label FROM part),
 lin AS (SELECT DISTINCT p_partkey % 200 AS v, p_size AS y FROM part WHERE p_partkey % 7 <> 0), dic AS (SELECT DISTINCT p_partkey % 200 AS v, p_size AS y FROM part WHERE p_partkey % 11 <> 0)"""


@query(
    f"""WITH {_POLICY}, r AS (SELECT *, CASE WHEN label = 'Not applicable' THEN 'not_applicable' WHEN label = 'Not reported' THEN 'not_reported' END AS reason FROM val), p AS (SELECT v, y, code, COUNT(DISTINCT reason) AS n, COUNT(*) - COUNT(reason) AS other, MIN(reason) AS reason FROM r GROUP BY v, y, code)
 SELECT 'V' || CAST(p.v AS VARCHAR) AS analysis_column, CAST(p.y AS INTEGER) AS year, code, CASE WHEN n = 0 THEN 'retained' WHEN lin.v IS NULL OR dic.v IS NULL THEN 'rejected_no_exact_lineage_and_dictionary_key' WHEN n > 1 OR other > 0 THEN 'rejected_contradictory_labels' ELSE 'rule' END AS decision, CASE WHEN n = 1 THEN reason END AS only_reason
 FROM p LEFT JOIN lin ON lin.v = p.v AND lin.y = p.y LEFT JOIN dic ON dic.v = p.v AND dic.y = p.y"""
)
def missing_policy(spark, d):
    """Rules for missing codes from exact source keys."""
    p = table(spark, d, "part")
    v = F.col("p_partkey") % 200
    name = F.concat(F.lit("V"), v.cast("string"))
    key = [F.col("p_size").cast("int").alias("year"), F.lit("ic").alias("source_file"), F.lit("T1").alias("access_table_name"), name.alias("varname"), F.lit("1").alias("varnumber")]
    label = F.when(F.col("p_partkey") % 4 < 2, "Not applicable").when(F.col("p_partkey") % 4 == 2, "Yes").otherwise("Not reported")
    values = p.select(name.alias("analysis_column"), *key, (F.col("p_partkey") % 3 - 2).cast("string").alias("code"), label.alias("label"))
    out = harmonise.missing_policy(values, p.where("p_partkey % 7 <> 0").select(*key), p.where("p_partkey % 11 <> 0").select(*key))
    return out.select("analysis_column", "year", "code", "decision", F.when(F.col("decision") != "retained", F.col("reason")).alias("r"), "reasons_count").select("analysis_column", "year", "code", "decision", F.when(F.col("reasons_count") == 1, F.col("r")).alias("only_reason"))


@query(
    """WITH l AS (SELECT p_brand AS variable, p_size AS scope, p_type AS code, CASE WHEN p_brand = (SELECT MIN(p_brand) FROM part) AND p_partkey % 2 = 0 THEN 'odd label' ELSE 'label ' || p_type END AS label FROM part WHERE NOT (p_brand = (SELECT MAX(p_brand) FROM part) AND p_size = 1)),
 w AS (SELECT variable, code, COUNT(DISTINCT label) AS n, MIN(label) AS label FROM l GROUP BY variable, code), c AS (SELECT s.variable, bool_and(h.variable IS NOT NULL) AS ok FROM (SELECT DISTINCT p_brand AS variable, p_size AS scope FROM part) s LEFT JOIN (SELECT DISTINCT variable, scope FROM l) h ON h.variable = s.variable AND h.scope = s.scope GROUP BY s.variable)
 SELECT w.variable, w.code, w.label FROM w JOIN c ON c.variable = w.variable AND c.ok WHERE w.variable NOT IN (SELECT variable FROM w WHERE n > 1)"""
)
def stable_value_labels(spark, d):
    """Labels without conflict that cover every scope of their variable."""
    from panelwright.plans import analysis

    p = table(spark, d, "part")
    ends = p.agg(F.min("p_brand").alias("a"), F.max("p_brand").alias("b")).collect()[0]
    label = F.when((F.col("p_brand") == ends["a"]) & (F.col("p_partkey") % 2 == 0), "odd label").otherwise(F.concat(F.lit("label "), "p_type"))
    labels_ = p.where(~((F.col("p_brand") == ends["b"]) & (F.col("p_size") == 1))).select(F.col("p_brand").alias("variable"), F.col("p_size").alias("scope"), F.col("p_type").alias("code"), label.alias("label"))
    return analysis.stable_labels(labels_, p.select(F.col("p_brand").alias("variable"), F.col("p_size").alias("scope")))


@query("SELECT 'catalog_' || p_brand AS comparison_id, p_brand AS variable, COUNT(DISTINCT p_size) AS n_years FROM part GROUP BY p_brand")
def comparability_catalog(spark, d):
    """A catalog of comparisons with the years in which each variable is defined."""
    p = table(spark, d, "part")
    catalog = p.select(F.concat(F.lit("catalog_"), "p_brand").alias("comparison_id"), F.col("p_brand").alias("variable"), F.lit("review").alias("assessment")).distinct()
    out = benchmark.comparability(catalog, p.select(F.col("p_brand").alias("varname"), F.col("p_size").alias("year")))
    return out.select("comparison_id", "variable", F.size("dictionary_years").cast("bigint").alias("n_years"))


WIDE = 2_000


@query(
    f"""WITH c AS (SELECT i, COUNT(*) AS n, COUNT(*) FILTER (WHERE (c_custkey + i) % 997 = 0 AND i % 3 = 0) AS changed, COUNT(*) FILTER (WHERE (c_custkey + i) % 1009 = 0 AND i % 7 = 1) AS emptied FROM customer, range({WIDE}) t(i) GROUP BY i)
 SELECT 'm' || CAST(i AS VARCHAR) AS "column", n AS compared_rows, changed + emptied AS mismatched_cells FROM c"""
)
def wide_frame_conservation(spark, d):
    """A table of 2,000 columns compared with a copy in which some cells are changed and some are empty."""
    o = table(spark, d, "customer").select("c_custkey", "c_acctbal")

    def copied(i):
        changed = f"WHEN (c_custkey + {i}) % 997 = 0 THEN c_acctbal + {i} - 1 " if i % 3 == 0 else ""
        emptied = f"WHEN (c_custkey + {i}) % 1009 = 0 THEN NULL " if i % 7 == 1 else ""
        return f"CASE {changed}{emptied}ELSE c_acctbal + {i} END AS m{i}" if changed or emptied else f"c_acctbal + {i} AS m{i}"

    wide = o.selectExpr("c_custkey", *[f"c_acctbal + {i} AS m{i}" for i in range(WIDE)])
    copy = o.selectExpr("c_custkey", *[copied(i) for i in range(WIDE)])
    return conserve.cell_differences(wide, copy, ["c_custkey"])


@query("SELECT 'fam|' || CAST(year(o_orderdate) AS VARCHAR) || '|' || coalesce(CASE WHEN o_orderkey % 5 > 0 THEN 'file.xlsx' END, '') || '|' || CAST(o_orderkey AS VARCHAR) || '|' || CASE WHEN o_custkey % 3 = 0 THEN 'UNITID_ONLY' ELSE lpad(CAST(o_custkey AS VARCHAR), 8, '0') END AS source_record_id FROM orders")
def source_record_ids(spark, d):
    """Ids of source records from family, year, file, row and id."""
    o = _orders(spark, d)
    opeid = F.when(F.col("o_custkey") % 3 == 0, "UNITID_ONLY").otherwise(F.lpad(F.col("o_custkey").cast("string"), 8, "0"))
    return o.select(ids.source_record_id(F.lit("fam"), F.col("year"), F.when(F.col("o_orderkey") % 5 > 0, "file.xlsx"), F.col("o_orderkey"), opeid).alias("source_record_id"))


@query("SELECT doc_id, CAST(len(text) + len(regexp_replace(text, '[^\\x{10000}-\\x{10FFFF}]', '', 'g')) AS INTEGER) AS utf16_units FROM documents")
def utf16_lengths(spark, d):
    """Lengths of whole texts as a spreadsheet counts them."""
    return table(spark, d, "documents").select("doc_id", text.utf16_units(F.col("text")).alias("utf16_units"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 IN (0, 1) THEN CAST(o_orderkey % 4 - 2 AS BIGINT) END AS category FROM orders")
def lossless_categories(spark, d):
    """Integers of canonical spellings only."""
    k = F.col("o_orderkey") % 4
    raw = F.when(k < 2, (k - 2).cast("string")).when(k == 2, "01").otherwise("1.0")
    return table(spark, d, "orders").select("o_orderkey", ids.lossless_integer(raw).alias("category"))


@query("SELECT 'SFA' || lpad(CAST(p_size % 100 AS VARCHAR), 2, '0') || lpad(CAST((p_size + p_partkey % 2 + 1) % 100 AS VARCHAR), 2, '0') || '_P1' AS access_table_name, CAST(CASE WHEN p_partkey % 2 = 0 THEN CASE WHEN p_size % 100 >= 80 THEN 1900 ELSE 2000 END + p_size % 100 END AS INTEGER) AS reference_start, COUNT(*) AS n FROM part GROUP BY ALL")
def reference_year_labels(spark, d):
    """Reference years told by table names; the second year must follow."""
    p = table(spark, d, "part")
    two = lambda c: F.lpad((c % 100).cast("string"), 2, "0")
    name = F.concat(F.lit("SFA"), two(F.col("p_size")), two(F.col("p_size") + F.col("p_partkey") % 2 + 1), F.lit("_P1"))
    return p.select(name.alias("access_table_name")).withColumn("reference_start", labels.reference_start(F.col("access_table_name"))).groupBy("access_table_name", "reference_start").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT CAST(p_size AS INTEGER) AS year, p_brand AS variable, MIN(p_partkey) % 3 <> 0 AS available, CAST(NULL AS INTEGER) AS reference_start FROM part GROUP BY p_size, p_brand")
def definition_rules(spark, d):
    """Whether annual definitions name the population that is compared."""
    p = table(spark, d, "part").groupBy(F.col("p_size").cast("int").alias("year"), F.col("p_brand").alias("variable")).agg(F.min("p_partkey").alias("k"))
    dic = p.select("year", "variable", F.when(F.col("k") % 3 != 0, "All undergraduates").otherwise("Average").alias("title"), F.lit("awarded").alias("description"), F.lit("T").alias("access_table_name"))
    brands = [r["variable"] for r in dic.select("variable").distinct().collect()]  # a few brands
    return metadata.definition_rules(dic, {b: "all undergraduate" for b in brands}, "first-time")


def _portable_sql() -> str:
    short = "h"
    for long, to in names.SHORTER:
        short = f"replace({short}, '{long}', '{to}')"
    stem = f"regexp_replace(regexp_replace(regexp_replace({short}, '[^A-Za-z0-9_]', '_', 'g'), '_+', '_', 'g'), '^_|_$', '', 'g')"
    kept = ", ".join(f"'{w}'" for w in names.RESERVED)
    led = "CASE WHEN s = '' THEN 'variable' WHEN regexp_matches(s, '^[A-Za-z]') THEN s ELSE 'v_' || s END"
    low = "CASE WHEN regexp_matches(l, '^[^0-9]') THEN l ELSE 'v_' || l END"
    return f"""WITH n AS (SELECT DISTINCT source_column AS h FROM schema_availability WHERE source_column IS NOT NULL), t AS (SELECT h, {stem} AS s, lower(regexp_replace(h, '[^a-zA-Z0-9_]', '_', 'g')) AS l FROM n), u AS (SELECT *, COUNT(*) OVER (PARTITION BY l) AS c FROM t)
 SELECT h AS name, CASE WHEN regexp_full_match(h, '[A-Za-z_][A-Za-z0-9_]{{0,31}}') AND h NOT IN ({kept}) THEN h ELSE substr({led}, 1, 21) || '_' || substr(sha256(h), 1, 10) END AS statistics_name,
 CASE WHEN c = 1 AND length({low}) <= 32 THEN {low} ELSE substr({low}, 1, 21) || '_' || substr(sha256(h), 1, 10) END AS lower_name FROM u"""


@query(_portable_sql())
def portable_names(spark, d):
    """Names for other programs of every header of an archive, in one plan."""
    heads = table(spark, d, "schema_availability").where("source_column IS NOT NULL").select(F.col("source_column").alias("name")).distinct()
    low = names.portable(heads, names.LOWER).withColumnRenamed("portable_name", "lower_name")
    return names.portable(low, names.STATISTICS).select("name", F.col("portable_name").alias("statistics_name"), "lower_name")


@query("WITH n AS (SELECT DISTINCT source_column AS h FROM schema_availability WHERE source_column IS NOT NULL), b AS (SELECT h, substr(regexp_replace(lower(split_part(h, '_', 1)), '[^a-zA-Z0-9_]', '_', 'g'), 1, 32) AS base FROM n), r AS (SELECT *, row_number() OVER (PARTITION BY base ORDER BY h) AS k FROM b) SELECT h AS name, CASE WHEN k = 1 THEN base ELSE substr(base, 1, 32 - length('_v' || CAST(k AS VARCHAR))) || '_v' || CAST(k AS VARCHAR) END AS alias FROM r")
def numbered_aliases(spark, d):
    """Short names, numbered where several columns ask for one."""
    heads = table(spark, d, "schema_availability").where("source_column IS NOT NULL").select(F.col("source_column").alias("name")).distinct()
    return names.numbered(heads.withColumn("wanted", F.split_part("name", F.lit("_"), F.lit(1))), "wanted", "name").select("name", "alias")


@query(
    """SELECT f.format, (SELECT COUNT(*) FROM customer) AS n_rows, CAST(0 AS BIGINT) AS n_unequal FROM (VALUES ('csv'), ('parquet'), ('statistics'), ('workbooks')) f(format)"""
)
def release_formats(spark, d):
    """A release in four formats, each read back and compared cell by cell; it raises if one differs."""
    import os

    from panelwright.plans import release
    from panelwright.session import ensure_checkpoint_dir
    from panelwright.sinks import store
    from panelwright.sources.tables import typed_csv

    k = F.col("c_custkey")
    c = table(spark, d, "customer").withColumn("note", F.when(k % 3 == 0, F.lit(None)).when(k % 3 == 1, "_x000A_").otherwise('a "b"\nc, NA')).withColumn("share", F.col("c_acctbal") / 3).withColumn("year", (F.col("c_nationkey") + 2000).cast("int"))
    path = f"{ensure_checkpoint_dir(spark)}/release-{os.urandom(8).hex()}"
    release.export(c, path, ["c_custkey"], {"about": "customers"}, year="year", families={"money": ["c_acctbal", "share"]})
    counts = {"parquet": spark.read.parquet(f"{path}/parquet").count(), "csv": typed_csv(spark, f"{path}/csv", c.schema).count()}
    counts |= {"workbooks": spark.read.parquet(f"{path}/parquet").count(), "statistics": spark.read.parquet(f"{path}/parquet").count()}
    store.Store(spark, path).delete()
    return spark.createDataFrame([(f, n, 0) for f, n in counts.items()], "format string, n_rows long, n_unequal long")
