"""Queries of record linkage on the directory and the family records, with SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.functions import clean, ids, measures, scope
from panelwright.operators import periods
from panelwright.operators.directory import current_records
from panelwright.operators.profile import deduplicated
from panelwright.plans import family_panel, linkage
from panelwright.queries.general_sql import CURRENT
from panelwright.session import cut, table

QUERIES = {}
SQL: dict[str, str] = {}
CODES = ["opeid8", "instnm", "stabbr", "sector", "cyactive", "opeflag", "act", "newid", "deathyr", "closedat", "prch_f", "idx_f", "prch_sfa", "idx_sfa", "ipeds_flags_available"]


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _directory(spark: SparkSession, d: str) -> DataFrame:
    now = current_records(table(spark, d, "ipeds_directory"), CODES)
    return now.withColumn("opeid8", ids.full_opeid(F.col("opeid8")))


def _family(spark: SparkSession, d: str) -> DataFrame:
    cols = ["family", "award_year", "opeid8", "unitid", "ipeds_annual_identity_eligible", "disbursements", "disbursements__status", "disbursements__raw_token"]
    rows = deduplicated(table(spark, d, "family_records"), "record_id", cols)
    return rows.withColumn("opeid8", ids.full_opeid(F.col("opeid8"))).withColumn("award_year_start", clean.award_start(F.col("award_year")))


def _reported(spark: SparkSession, d: str) -> DataFrame:
    """Ids and award years that reported, under one label form."""
    f = _family(spark, d).where("opeid8 IS NOT NULL AND award_year_start IS NOT NULL")
    return f.select("opeid8", ids.award_year_label(F.col("award_year_start")).alias("award_year")).distinct()


_OP = "CASE WHEN regexp_full_match(trim({c}), '[0-9]{{1,8}}(\\.0+)?') THEN nullif(lpad(split_part(trim({c}), '.', 1), 8, '0'), '00000000') END"
_INT = "CASE WHEN TRY_CAST(trim({c}) AS DOUBLE) = floor(TRY_CAST(trim({c}) AS DOUBLE)) THEN CAST(TRY_CAST(trim({c}) AS DOUBLE) AS BIGINT) END"


def _int(c: str) -> str:
    return _INT.format(c=c)


#: Whether a record's scope is told: the source says so, and all four fields hold documented codes.
_FLAGS = f"""coalesce(ipeds_flags_available, FALSE) AND coalesce({_int('prch_f')} IN (-2,1,2,3,4,5) OR ({_int('prch_f')} = 6 AND ipeds_year >= 2016), FALSE) AND coalesce({_int('prch_sfa')} IN (-2,1,2), FALSE)
 AND coalesce({_int('idx_f')} = -2 OR {_int('idx_f')} > 0, FALSE) AND coalesce({_int('idx_sfa')} = -2 OR {_int('idx_sfa')} > 0, FALSE)"""

_BASE = f"""{CURRENT}, dir AS (SELECT ipeds_year AS y, unitid, {_OP.format(c='opeid8')} AS op, coalesce({_int('sector')} = 0, FALSE) AS admin, coalesce({_int('cyactive')} IN (0,2,3), FALSE) OR coalesce(upper(trim(act)) IN ('C','D','I','O','W','X'), FALSE) AS inactive, instnm, stabbr FROM cur),
 fam AS (SELECT *, {_OP.format(c='opeid8')} AS op, TRY_CAST(substr(trim(award_year), 1, 4) AS INTEGER) AS y0 FROM (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY loaded_at DESC) AS rn FROM family_records) WHERE rn = 1),
 rep AS (SELECT DISTINCT op, y0 FROM fam WHERE op IS NOT NULL AND y0 IS NOT NULL),
 st AS (SELECT y, op, COUNT(*) AS n, SUM((NOT admin)::INT) AS na, CASE WHEN COUNT(*) = 1 THEN MIN(unitid) END AS u FROM dir WHERE op IS NOT NULL GROUP BY y, op), yrs AS (SELECT DISTINCT y FROM dir),
 bm AS (SELECT r.op, r.y0, coalesce(a.n, 0) AS na_, coalesce(b.n, 0) AS nb, a.u AS ua, b.u AS ub, ya.y IS NOT NULL AS la, yb.y IS NOT NULL AS lb, d.admin, d.inactive FROM rep r LEFT JOIN st a ON a.op = r.op AND a.y = r.y0 LEFT JOIN st b ON b.op = r.op AND b.y = r.y0 + 1
 LEFT JOIN yrs ya ON ya.y = r.y0 LEFT JOIN yrs yb ON yb.y = r.y0 + 1 LEFT JOIN dir d ON d.y = r.y0 AND d.unitid = a.u),
 ms AS (SELECT *, CASE WHEN NOT la THEN 'ipeds_year_unavailable' WHEN na_ = 0 THEN 'no_exact_match' WHEN na_ > 1 THEN 'multiple_exact_unitids' WHEN admin THEN 'exact_unique_administrative_unit' WHEN inactive THEN 'exact_unique_inactive' ELSE 'exact_unique' END AS status,
 CASE WHEN NOT la OR NOT lb THEN 'year_unavailable' WHEN na_ = 1 AND nb = 1 AND ua = ub THEN 'stable_unique' WHEN na_ = 1 AND nb = 1 THEN 'different_unitid' ELSE 'ambiguous_or_unmatched' END AS sens FROM bm)"""


@query(
    f"""WITH {_BASE}, li AS (SELECT op, COUNT(DISTINCT unitid) AS n FROM dir WHERE op IS NOT NULL GROUP BY op), lu AS (SELECT unitid, COUNT(DISTINCT op) AS n FROM dir WHERE op IS NOT NULL GROUP BY unitid)
 SELECT ms.op AS opeid8, CAST(y0 AS VARCHAR) || '-' || CAST(y0 + 1 AS VARCHAR) AS award_year, CAST(y0 AS INTEGER) AS ipeds_year, CASE WHEN status = 'exact_unique' THEN ua END AS unitid, status AS ipeds_match_status, na_ AS candidate_count, sens AS anchor_sensitivity, coalesce(li.n, 0) AS lifetime_unitids, CASE WHEN status = 'exact_unique' THEN coalesce(lu.n, 0) ELSE 0 END AS lifetime_opeids
 FROM ms LEFT JOIN li ON li.op = ms.op LEFT JOIN lu ON lu.unitid = ms.ua"""
)
def linkage_base_match(spark, d):
    """Exact annual matches with statuses and sensitivity."""
    b = linkage.base_match(_reported(spark, d), _directory(spark, d))
    return b.select("opeid8", "award_year", "ipeds_year", "unitid", "ipeds_match_status", "candidate_count", "anchor_sensitivity", "lifetime_unitids", "lifetime_opeids")


_STRICT = f"""{_BASE}, flg AS (SELECT ipeds_year AS y, unitid, coalesce({_int('sector')} = 0, FALSE) AS admin, coalesce({_int('cyactive')} IN (0,2,3), FALSE) OR coalesce(upper(trim(act)) IN ('C','D','I','O','W','X'), FALSE) AS inactive,
 coalesce({_int('opeflag')} = 2, FALSE) OR coalesce(upper(trim(act)) = 'G', FALSE) AS branch, NOT coalesce({_int('opeflag')} = 1 OR ({_int('opeflag')} = 4 AND (ipeds_year = 2000 OR ipeds_year >= 2002)) OR ({_int('opeflag')} = 8 AND ipeds_year >= 2004), FALSE) AS partly,
 coalesce({_int('prch_f')} > 0, FALSE) OR coalesce({_int('idx_f')} > 0, FALSE) OR coalesce({_int('prch_sfa')} > 0, FALSE) OR coalesce({_int('idx_sfa')} > 0, FALSE) AS family, {_FLAGS} AS told,
 coalesce({_int('newid')} > 0, FALSE) OR coalesce({_int('deathyr')} > 0, FALSE) OR coalesce(upper(trim(closedat)) NOT IN ('', '-1', '-2', '-9', 'NAN', 'NONE', 'NA'), FALSE) AS ended, coalesce({_int('sector')} BETWEEN 0 AND 9 AND {_int('cyactive')} IN (1,2,3), FALSE) AS active FROM cur),
 li AS (SELECT op, COUNT(DISTINCT unitid) AS n FROM dir WHERE op IS NOT NULL GROUP BY op), lu AS (SELECT unitid, COUNT(DISTINCT op) AS n FROM dir WHERE op IS NOT NULL GROUP BY unitid),
 rt AS (SELECT y, substr(op, 2, 5) AS r, COUNT(DISTINCT unitid) AS n FROM dir WHERE op IS NOT NULL GROUP BY 1, 2), ow AS (SELECT y0, substr(op, 2, 5) AS r, COUNT(*) AS n FROM rep GROUP BY 1, 2),
 sr AS (SELECT ms.op, ms.status, list_filter([CASE WHEN ms.status <> 'exact_unique' THEN ms.status END, CASE WHEN sens <> 'stable_unique' THEN 'anchor_' || sens END, CASE WHEN coalesce(ra.n, 0) > 1 OR coalesce(rb.n, 0) > 1 THEN 'multiple_ipeds_units_in_opeid_group' END, CASE WHEN ow.n > 1 THEN 'multiple_fsa_rows_in_opeid_group' END,
 CASE WHEN substr(ms.op, 7, 2) <> '00' OR substr(ms.op, 1, 1) <> '0' THEN 'fsa_additional_location_identifier' END, CASE WHEN li.n > 1 THEN 'opeid_maps_to_multiple_unitids_over_time' END, CASE WHEN ms.status = 'exact_unique' AND lu.n > 1 THEN 'unitid_has_multiple_opeids_over_time' END,
 CASE WHEN coalesce(a.branch, FALSE) OR coalesce(b.branch, FALSE) THEN 'ipeds_branch_flag' END, CASE WHEN coalesce(a.family, FALSE) OR coalesce(b.family, FALSE) THEN 'ipeds_component_parent_child' END, CASE WHEN coalesce(a.ended, FALSE) OR coalesce(b.ended, FALSE) THEN 'ipeds_merger_or_closure' END,
 CASE WHEN coalesce(a.admin, FALSE) OR coalesce(b.admin, FALSE) THEN 'ipeds_administrative_unit' END, CASE WHEN coalesce(a.inactive, FALSE) OR coalesce(b.inactive, FALSE) THEN 'ipeds_inactive' END, CASE WHEN a.y IS NULL OR b.y IS NULL OR a.partly OR b.partly THEN 'ipeds_not_full_title_iv' END,
 CASE WHEN NOT coalesce(a.told AND b.told, FALSE) THEN 'parent_child_metadata_unavailable' END, CASE WHEN NOT coalesce(a.active AND b.active, FALSE) THEN 'activity_metadata_unavailable' END], lambda x: x IS NOT NULL) AS reasons
 FROM ms LEFT JOIN flg a ON a.y = ms.y0 AND a.unitid = ms.ua LEFT JOIN flg b ON b.y = ms.y0 + 1 AND b.unitid = ms.ub LEFT JOIN li ON li.op = ms.op LEFT JOIN lu ON lu.unitid = ms.ua LEFT JOIN rt ra ON ra.y = ms.y0 AND ra.r = substr(ms.op, 2, 5) LEFT JOIN rt rb ON rb.y = ms.y0 + 1 AND rb.r = substr(ms.op, 2, 5) LEFT JOIN ow ON ow.y0 = ms.y0 AND ow.r = substr(ms.op, 2, 5))"""


@query(f"WITH {_STRICT} SELECT status AS ipeds_match_status, reason, COUNT(*) AS n FROM (SELECT status, unnest(CASE WHEN len(reasons) = 0 THEN ['strict'] ELSE reasons END) AS reason FROM sr) GROUP BY status, reason")
def linkage_strict_reasons(spark, d):
    """Reasons for which a match is not strict, counted."""
    b = linkage.base_match(_reported(spark, d), _directory(spark, d))
    told = b.select("ipeds_match_status", F.explode_outer("strict_exclusion_reasons").alias("reason"))
    return told.groupBy("ipeds_match_status", F.coalesce("reason", F.lit("strict")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""WITH {_BASE} SELECT r.op AS opeid8, r.y0 AS award_year_start, a.anchor, CAST(d.y AS INTEGER) AS ipeds_year, COUNT(*) AS n_candidates, CAST(SUM((d.op = r.op)::INT) AS BIGINT) AS n_exact FROM rep r CROSS JOIN (VALUES ('start', 0), ('end', 1)) a(anchor, shift) JOIN dir d ON d.y = r.y0 + a.shift AND d.op IS NOT NULL AND substr(d.op, 2, 5) = substr(r.op, 2, 5) GROUP BY ALL"""
)
def candidate_ledger(spark, d):
    """Candidates at both anchors, exact ones and those of the id group, counted per row."""
    led = linkage.candidate_ledger(_reported(spark, d), _directory(spark, d))
    y0 = ids.award_year_start(F.col("award_year"))
    return led.groupBy("opeid8", y0.alias("award_year_start"), "anchor", "ipeds_year").agg(F.count(F.lit(1)).alias("n_candidates"), F.count_if(F.col("candidate_kind") == "exact_opeid").alias("n_exact"))


def _crosswalk(spark, d):
    """A crosswalk sheet made of the units that family records report: the smallest is the match, every other is additional.

    The match has one row, and so has each additional unit; an id with many units is many rows, never a collected list.
    Some fields are cut short, as happens in such sheets.
    """
    f = _family(spark, d).where("opeid8 IS NOT NULL AND award_year_start IS NOT NULL AND unitid BETWEEN 100000 AND 999999")
    units = f.select(F.col("award_year_start").alias("cw_year"), F.col("opeid8").alias("opeid"), "unitid").distinct()
    first = units.groupBy("cw_year", "opeid").agg(F.min("unitid").alias("a"))
    unit, match = F.col("unitid").cast("string"), F.col("unitid") == F.col("a")
    token = F.when(F.col("unitid") % 41 == 0, F.concat(unit, F.lit(" | 100"))).otherwise(unit)
    rows = units.join(first, ["cw_year", "opeid"])
    return rows.select("cw_year", "opeid", F.when(match, token).otherwise("No match").alias("ipedsmatch"), F.when(match, "No match").otherwise(unit).alias("addmatch"), F.lit("-2").alias("ipedsmain"), F.lit("1.0").alias("source"), F.lit("-2").alias("ipedsrpt"))


_SITES = """unit_ AS (SELECT DISTINCT y0, op, unitid FROM fam WHERE op IS NOT NULL AND y0 IS NOT NULL AND unitid BETWEEN 100000 AND 999999),
 site AS (SELECT y0, op, MIN(unitid) AS a, COUNT(*) AS n FROM unit_ GROUP BY y0, op)"""


@query(
    f"""WITH {_BASE}, {_SITES}, rel AS (SELECT u.y0 AS cw_year, u.op AS opeid8, u.unitid, CASE WHEN u.unitid = s.a THEN 'primary_match' ELSE 'additional_match' END AS relation_type FROM unit_ u JOIN site s ON s.y0 = u.y0 AND s.op = u.op UNION ALL SELECT y0, op, NULL, 'unparsed_site_match' FROM site WHERE a % 41 = 0)
 SELECT CAST(cw_year AS INTEGER) AS cw_year, relation_type, COUNT(*) AS n, COUNT(DISTINCT unitid) AS n_units FROM rel GROUP BY cw_year, relation_type"""
)
def crosswalk_relations(spark, d):
    """Relations parsed from the fields of a crosswalk sheet."""
    rel, _ = linkage.crosswalk(_crosswalk(spark, d))
    return rel.groupBy("cw_year", "relation_type").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("unitid").alias("n_units"))


def _resolved(spark, d):
    directory = cut(_directory(spark, d))
    rel, rec = linkage.crosswalk(_crosswalk(spark, d))
    base = linkage.base_match(_reported(spark, d), directory)
    return linkage.resolve(base, directory, rec, rel), directory, rel


_RESOLVED = f"""{_BASE}, {_SITES}, g AS (SELECT ms.*, coalesce(h.n, 0) AS nh, coalesce(h.na, 0) AS nna, h.u AS uh, s.a, coalesce(s.n, 0) AS ns FROM ms LEFT JOIN st h ON h.op = ms.op AND h.y = ms.y0 LEFT JOIN site s ON s.op = ms.op AND s.y0 = ms.y0),
 k AS (SELECT g.*, CASE WHEN ns = 1 THEN a WHEN ns = 0 THEN uh END AS guess FROM g), m AS (SELECT k.*, d.unitid AS ku, d.admin AS kadmin, coalesce(d.op = k.op, FALSE) AS member FROM k LEFT JOIN dir d ON d.y = k.y0 AND d.unitid = k.guess),
 res AS (SELECT *, CASE WHEN a % 41 = 0 THEN 'crosswalk_site_parse_incomplete' WHEN ns > 1 THEN 'multiple_official_site_unitids' WHEN ns = 1 AND nh > 0 AND NOT member THEN 'directory_crosswalk_identity_conflict' WHEN ns = 1 AND nh > 1 AND nna - (member AND NOT coalesce(kadmin, FALSE))::INT > 0 THEN 'multiple_nonadministrative_directory_unitids'
 WHEN ns = 1 AND ku IS NULL THEN 'crosswalk_site_missing_annual_directory' WHEN ns = 1 AND member THEN 'official_site_and_directory_agree' WHEN ns = 1 THEN 'official_site_alias_annual_unitid_verified' WHEN nh = 1 THEN 'unique_annual_directory_only' WHEN nh > 1 THEN 'multiple_exact_directory_unitids' WHEN NOT la THEN 'annual_directory_unavailable' ELSE 'no_annual_site_match' END AS rs FROM m),
 brg AS (SELECT *, CASE WHEN rs IN ('official_site_and_directory_agree', 'official_site_alias_annual_unitid_verified', 'unique_annual_directory_only') THEN guess END AS unit FROM res)"""


@query(
    f"""WITH {_RESOLVED} SELECT op AS opeid8, CAST(y0 AS VARCHAR) || '-' || CAST(y0 + 1 AS VARCHAR) AS award_year, unit AS unitid, rs AS ipeds_resolution_status, nh AS directory_candidate_count, CAST(ns AS BIGINT) AS crosswalk_site_count, unit IS NOT NULL AND NOT coalesce(kadmin, FALSE) AS ipeds_annual_identity_eligible FROM brg"""
)
def linkage_resolution(spark, d):
    """Units resolved from directory and crosswalk evidence."""
    r, _, _ = _resolved(spark, d)
    return r.select("opeid8", "award_year", "unitid", "ipeds_resolution_status", "directory_candidate_count", F.col("crosswalk_site_count").cast("bigint").alias("crosswalk_site_count"), "ipeds_annual_identity_eligible")


@query(
    f"""WITH {_RESOLVED}, u AS (SELECT y, unitid AS u, 1 AS d, NULL AS c, NULL AS b FROM dir UNION ALL SELECT y0, unitid, NULL, 1, NULL FROM unit_ UNION ALL SELECT y0, unit, NULL, NULL, 1 FROM brg WHERE unit IS NOT NULL), p AS (SELECT y, u, MAX(d) AS d, MAX(c) AS c, MAX(b) AS b FROM u GROUP BY y, u)
 SELECT CAST(y AS INTEGER) AS ipeds_year, CASE WHEN COUNT(d) > 0 THEN COUNT(d) END AS directory_units, COUNT(c) AS crosswalk_units, COUNT(b) AS bridge_units, CASE WHEN COUNT(d) > 0 THEN CAST(SUM((d = 1 AND c = 1)::INT) AS BIGINT) END AS directory_and_crosswalk0,
 CASE WHEN COUNT(d) > 0 THEN COUNT(*) FILTER (d = 1 AND c = 1) END AS directory_and_crosswalk, CASE WHEN COUNT(d) > 0 THEN COUNT(*) FILTER (d = 1 AND b = 1) END AS directory_and_bridge, CASE WHEN COUNT(d) > 0 THEN COUNT(*) FILTER (d = 1 AND b IS NULL AND c IS NULL) END AS directory_only,
 CASE WHEN COUNT(d) > 0 THEN COUNT(*) FILTER (d = 1 AND b IS NULL AND c = 1) END AS unrepresented_with_crosswalk, CASE WHEN COUNT(d) > 0 THEN COUNT(*) FILTER (b = 1 AND d IS NULL) END AS bridge_not_in_directory FROM p GROUP BY y""".replace("CASE WHEN COUNT(d) > 0 THEN CAST(SUM((d = 1 AND c = 1)::INT) AS BIGINT) END AS directory_and_crosswalk0,\n", "")
)
def annual_reconciliation(spark, d):
    """Annual overlaps of directory, crosswalk and bridge."""
    r, directory, rel = _resolved(spark, d)
    return linkage.reconcile(r, directory, rel)


@query(
    f"""WITH {_BASE}, {_SITES}, c AS (SELECT r.op, r.y0, s.n AS ns, e.n AS ne, s.a AS us, e.a AS ue, s.a % 41 = 0 AS bs, e.a % 41 = 0 AS be FROM rep r LEFT JOIN site s ON s.op = r.op AND s.y0 = r.y0 LEFT JOIN site e ON e.op = r.op AND e.y0 = r.y0 + 1)
 SELECT op AS opeid8, CAST(y0 AS VARCHAR) || '-' || CAST(y0 + 1 AS VARCHAR) AS award_year, coalesce(ns, 0) AS start_site_count, coalesce(ne, 0) AS end_site_count, CASE WHEN coalesce(ns > 1 OR bs, FALSE) OR coalesce(ne > 1 OR be, FALSE) OR coalesce(ns = 1 AND ne = 1 AND us <> ue, FALSE) THEN 'scope_or_identity_conflict' WHEN ns IS NULL OR ne IS NULL THEN 'year_unavailable' ELSE 'stable_unique' END AS crosswalk_anchor_sensitivity FROM c"""
)
def crosswalk_anchor(spark, d):
    """Whether the official sites of two years agree."""
    rel, rec = linkage.crosswalk(_crosswalk(spark, d))
    return linkage.crosswalk_sensitivity(_reported(spark, d), rec, rel)


@query(
    f"""WITH {_BASE}, {_SITES}, m AS (SELECT r.op, r.y0, u.unitid, CASE WHEN u.unitid = s.a THEN 'primary_match' ELSE 'additional_match' END AS t FROM rep r JOIN unit_ u ON u.op = r.op AND u.y0 = r.y0 JOIN site s ON s.op = r.op AND s.y0 = r.y0 UNION ALL SELECT r.op, r.y0, d.unitid, 'directory_opeid' FROM rep r JOIN dir d ON d.op = r.op AND d.y = r.y0)
 SELECT CAST(y0 AS INTEGER) AS award_year_start, t AS relation_type, COUNT(*) AS n_memberships, COUNT(DISTINCT unitid) AS n_units FROM m GROUP BY y0, t"""
)
def linkage_memberships(spark, d):
    """Memberships of units in reporting rows, counted per year and kind of evidence."""
    r, directory, rel = _resolved(spark, d)
    m = linkage.memberships(r, directory, rel)
    return m.groupBy(ids.award_year_start(F.col("award_year")).alias("award_year_start"), "relation_type").agg(F.count(F.lit(1)).alias("n_memberships"), F.countDistinct("unitid").alias("n_units"))


def _family_rows(spark, d):
    f = _family(spark, d).where("award_year_start IS NOT NULL")
    return family_panel.dispositions(f, F.coalesce(clean.truth(F.col("ipeds_annual_identity_eligible")), F.lit(False)))


_DISPOSED = """fam AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY loaded_at DESC) AS rn FROM family_records) WHERE rn = 1), g AS (SELECT *, TRY_CAST(substr(trim(award_year), 1, 4) AS INTEGER) AS y, CASE WHEN unitid IS NULL OR NOT coalesce(lower(trim(ipeds_annual_identity_eligible)) IN ('true','t','1','1.0','yes','y'), FALSE) THEN 'excluded_annual_identity_unresolved' ELSE 'candidate' END AS gs FROM fam),
 x AS (SELECT *, CASE WHEN gs <> 'candidate' THEN gs WHEN SUM((gs = 'candidate')::INT) OVER (PARTITION BY unitid, y, family) > 1 THEN 'ambiguous_family_multiple_records' ELSE 'included_unique_family_record' END AS disp FROM g WHERE y IS NOT NULL)"""


@query(f"WITH {_DISPOSED} SELECT family, CAST(y AS INTEGER) AS award_year_start, disp AS record_disposition, COUNT(*) AS n_records FROM x GROUP BY family, y, disp")
def family_dispositions(spark, d):
    """What became of each family record, counted."""
    return _family_rows(spark, d).groupBy("family", "award_year_start", "record_disposition").agg(F.count(F.lit(1)).alias("n_records"))


UNIT_FAMILIES = ["grants", "direct", "campus_based", "ffel"]


def _unit_panel_sql() -> str:
    inc, many, absent = "'included_unique_family_record'", "'ambiguous_family_multiple_records'", "'absent_source_record'"
    aggs, sts, out = [], [], []
    for f in UNIT_FAMILIES:
        own, ok = f"family = '{f}'", f"family = '{f}' AND disp = {inc}"
        aggs.append(f"COUNT(*) FILTER ({own}) AS n_{f}, MAX(disbursements) FILTER ({ok}) AS v_{f}, MAX(disbursements__status) FILTER ({ok}) AS s_{f}, MAX(disbursements__raw_token) FILTER ({ok}) AS t_{f}")
        sts.append(f"CASE WHEN n_{f} = 0 THEN {absent} WHEN n_{f} > 1 THEN {many} ELSE {inc} END AS st_{f}, EXISTS (SELECT 1 FROM rpt WHERE rpt.family = '{f}' AND rpt.y = w.y) AS r_{f}")
        out.append(
            f"st_{f} AS {f}__unitid_record_status, n_{f} AS {f}__unitid_source_record_count, st_{f} = {inc} AS {f}__source_record_present, v_{f} AS {f}__disbursements, t_{f} AS {f}__disbursements__raw_token,"
            f" CASE WHEN st_{f} = {inc} THEN s_{f} WHEN st_{f} <> {absent} THEN st_{f} WHEN NOT r_{f} THEN 'report_not_available' ELSE {absent} END AS {f}__disbursements__status"
        )
    blocked = f"(st_direct = {many} OR (y <= 2009 AND st_ffel = {many}))"
    complete = "(v_direct IS NOT NULL AND (v_ffel IS NOT NULL OR y > 2009))"
    total = "CASE WHEN v_direct IS NOT NULL OR v_ffel IS NOT NULL THEN coalesce(v_direct, 0) + coalesce(v_ffel, 0) END"
    status = f"CASE WHEN {blocked} THEN 'incomplete_blocked_unitid_family' WHEN v_direct IS NULL AND v_ffel IS NULL THEN 'no_observed_components' WHEN NOT {complete} THEN 'incomplete_component_sum' WHEN y > 2009 THEN 'complete_direct_only_scope' ELSE 'complete_component_sum' END"
    n_inc = " + ".join(f"(st_{f} = {inc})::INT" for f in UNIT_FAMILIES)
    n_blk = " + ".join(f"(st_{f} = {many})::INT" for f in UNIT_FAMILIES)
    return f"""WITH {_DISPOSED}, rpt AS (SELECT DISTINCT family, TRY_CAST(substr(trim(award_year), 1, 4) AS INTEGER) AS y FROM selected_panel_files), w AS (SELECT unitid, y, {', '.join(aggs)} FROM x WHERE gs = 'candidate' GROUP BY unitid, y), z AS (SELECT w.*, {', '.join(sts)} FROM w)
 SELECT unitid, CAST(y AS INTEGER) AS award_year_start, {', '.join(out)}, CAST({n_inc} AS INTEGER) AS included_source_family_count, CAST({n_blk} AS INTEGER) AS blocked_source_family_count,
 CASE WHEN NOT {blocked} AND {complete} THEN {total} END AS loan__disbursements, {status} AS loan__disbursements__status, {total} AS loan__disbursements__observed_partial_sum FROM z"""


@query(_unit_panel_sql())
def family_unit_panel(spark, d):
    """The wide unit panel of the four families with a status for every cell, and the sum of the two loan families."""
    rows = _family_rows(spark, d)
    reports = table(spark, d, "selected_panel_files").select("family", clean.award_start(F.col("award_year")).alias("award_year_start")).distinct()
    panel = family_panel.unit_panel(rows, UNIT_FAMILIES, ["disbursements"], reports, companions=("raw_token",))
    return family_panel.combined(panel, "loan", "disbursements", ["direct", "ffel"], {"ffel": F.col("award_year_start") <= 2009})


@query(
    """WITH fam AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY loaded_at DESC) AS rn FROM family_records) WHERE rn = 1)
 SELECT disbursements__status AS told_status, COUNT(*) AS n_records FROM fam GROUP BY 1"""
)
def family_status_counts(spark, d):
    """Statuses as delivered."""
    return _family(spark, d).groupBy(F.col("disbursements__status").alias("told_status")).agg(F.count(F.lit(1)).alias("n_records"))


@query(
    """WITH fam AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY loaded_at DESC) AS rn FROM family_records) WHERE rn = 1), t AS (SELECT disbursements__status AS told, disbursements AS v, trim(disbursements__raw_token, ' 	
') AS s FROM fam),
 n AS (SELECT *, CASE WHEN regexp_full_match(s, '-?\\$?-?(\\d{1,3}(,\\d{3})+|\\d+)(\\.\\d*)?') THEN TRY_CAST(replace(replace(s, '$', ''), ',', '') AS DOUBLE) END AS n FROM t),
 p AS (SELECT *, CASE WHEN s IS NULL OR s = '' THEN 'source_blank' WHEN regexp_full_match(lower(s), '<\\s*10') THEN 'suppressed_lt10' WHEN lower(s) IN ('suppressed', 'redacted', 'privacy suppressed') THEN 'suppressed' WHEN lower(s) IN ('-', '--', '.', 'na', 'n/a', '*') THEN 'source_symbol' WHEN n IS NULL THEN 'invalid_numeric' WHEN n = 0 THEN 'observed_zero' ELSE 'observed' END AS st FROM n)
 SELECT told AS disbursements__status, st AS parsed_status, COUNT(*) AS n_records, COUNT(*) FILTER ((CASE WHEN st IN ('observed', 'observed_zero') THEN n END) IS NOT DISTINCT FROM v) AS n_same_value FROM p GROUP BY told, st"""
)
def family_tokens_parsed(spark, d):
    """M1: raw tokens parsed anew and compared with the delivered status."""
    f = _family(spark, d).withColumn("m", measures.parse(F.col("disbursements__raw_token"), False))
    return f.groupBy("disbursements__status", F.col("m.status").alias("parsed_status")).agg(F.count(F.lit(1)).alias("n_records"), F.count_if(F.col("m.value").eqNullSafe(F.col("disbursements"))).alias("n_same_value"))


@query(
    f"""WITH {CURRENT}, k AS (SELECT ipeds_year AS y, {_int('opeflag')} AS f, {_int('prch_f')} AS c, {_int('idx_f')} AS p FROM cur)
 SELECT CASE WHEN f = 1 THEN 'participating' WHEN f = 2 THEN 'branch_of_participating_institution' WHEN f = 3 THEN 'deferment_only' WHEN f = 4 AND y IN (1999, 2001) THEN 'eligible_out_of_scope_or_historical_definition' WHEN f = 4 THEN 'new_participant' WHEN f = 5 THEN 'not_participating_with_opeid' WHEN f = 6 THEN 'not_participating_without_opeid' WHEN f = 7 THEN 'stopped_participating' WHEN f = 8 AND y >= 2004 THEN 'new_spring_participant' ELSE 'unknown' END AS participation,
 CASE WHEN c IS NULL OR p IS NULL OR (p <> -2 AND p <= 0) THEN 'metadata_unavailable_or_invalid' WHEN c = -2 AND p > 0 THEN 'parent_reference_without_role' WHEN c = -2 THEN 'no_parent_child_relation_reported' WHEN c = 1 THEN 'parent' WHEN c = 2 THEN 'full_child' WHEN c = 3 THEN 'partial_child' WHEN c = 4 THEN 'full_child_nonpostsecondary_parent' WHEN c = 5 THEN 'partial_child_nonpostsecondary_parent' WHEN c = 6 AND y >= 2016 THEN 'partial_parent_and_child' ELSE 'undocumented_code' END AS finance_role, COUNT(*) AS n FROM k GROUP BY 1, 2"""
)
def directory_roles(spark, d):
    """Year-aware participation and component role of directory records."""
    now = _directory(spark, d)
    return now.groupBy(scope.participation(F.col("opeflag"), F.col("ipeds_year")).alias("participation"), scope.component_role(F.col("prch_f"), F.col("idx_f"), F.col("ipeds_year"), True).alias("finance_role")).agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {CURRENT}, k AS (SELECT CASE WHEN upper(trim(stabbr)) = 'FC' THEN 'foreign_explicit' WHEN upper(trim(stabbr)) IN ('PR','GU','VI','AS','MP','FM','MH','PW') THEN 'territories_and_freely_associated_states' WHEN stabbr IS NULL OR trim(stabbr) = '' THEN 'unknown' ELSE 'us_states_dc' END AS geography FROM cur) SELECT geography, COUNT(*) AS n FROM k GROUP BY geography")
def directory_geography(spark, d):
    """Geography classes."""
    return _directory(spark, d).groupBy(scope.geography([F.col("stabbr")], []).alias("geography")).agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""WITH {CURRENT}, k AS (SELECT ipeds_year AS y, {_int('opeflag')} AS f, {_int('sector')} AS s, {_int('cyactive')} AS c, upper(trim(act)) AS a, {_int('newid')} AS n, {_int('deathyr')} AS dy, upper(trim(closedat)) AS cd, {_int('prch_f')} AS p1, {_int('idx_f')} AS i1, {_int('prch_sfa')} AS p2, {_int('idx_sfa')} AS i2, {_FLAGS} AS told FROM cur)
 SELECT CAST(y AS INTEGER) AS ipeds_year, COUNT(*) AS n_records, COUNT(*) FILTER (s = 0) AS is_administrative, COUNT(*) FILTER (c IN (0,2,3) OR a IN ('C','D','I','O','W','X')) AS is_inactive, COUNT(*) FILTER (f = 2 OR a = 'G') AS is_branch,
 COUNT(*) FILTER (NOT coalesce(f = 1 OR (f = 4 AND (y = 2000 OR y >= 2002)) OR (f = 8 AND y >= 2004), FALSE)) AS not_full_participant, COUNT(*) FILTER (p1 > 0 OR i1 > 0 OR p2 > 0 OR i2 > 0) AS has_parent_child,
 COUNT(*) FILTER (n > 0 OR dy > 0 OR (cd IS NOT NULL AND cd NOT IN ('', '-1', '-2', '-9', 'NAN', 'NONE', 'NA'))) AS merger_or_closure, COUNT(*) FILTER (s BETWEEN 0 AND 9 AND c IN (1,2,3)) AS status_available, COUNT(*) FILTER (told) AS flags_available FROM k GROUP BY y"""
)
def directory_flags(spark, d):
    """Flags of directory records, counted per year."""
    flags = scope.record_flags(CODES, F.col("ipeds_year"))
    names = ["is_administrative", "is_inactive", "is_branch", "not_full_participant", "has_parent_child", "merger_or_closure", "status_available", "flags_available"]
    return _directory(spark, d).groupBy("ipeds_year").agg(F.count(F.lit(1)).alias("n_records"), *[F.count_if(flags[k]).alias(k) for k in names])


@query(
    f"""WITH {CURRENT}, r AS (SELECT unitid, ipeds_year - row_number() OVER (PARTITION BY unitid ORDER BY ipeds_year) AS g, ipeds_year AS y FROM cur), i AS (SELECT unitid, MIN(y) AS a, MAX(y) AS b FROM r GROUP BY unitid, g) SELECT unitid, string_agg(CASE WHEN a = b THEN CAST(a AS VARCHAR) ELSE CAST(a AS VARCHAR) || '-' || CAST(b AS VARCHAR) END, ',' ORDER BY a) AS years_in_directory FROM i GROUP BY unitid"""
)
def directory_year_ranges(spark, d):
    """Years in which each unit has a record."""
    return periods.year_ranges(_directory(spark, d), ["unitid"], "ipeds_year", "years_in_directory")


@query(
    """WITH p AS (SELECT l_partkey AS k, l_suppkey AS s, bool_or(l_returnflag = 'R') AS h, bool_or(l_returnflag = 'A') AS o FROM lineitem GROUP BY 1, 2), c AS (SELECT k, COUNT(*) FILTER (h) AS nh, COUNT(*) FILTER (o) AS ns, COUNT(*) FILTER (h AND o) AS both_, MIN(s) FILTER (o) AS only_s, MIN(s) FILTER (h) AS only_h FROM p GROUP BY k)
 SELECT k AS l_partkey, nh AS directory_candidates, ns AS official_sites, CASE WHEN ns > 1 THEN 'multiple_official' WHEN ns = 1 AND nh > 0 AND both_ = 0 THEN 'conflict' WHEN ns = 1 THEN 'official' WHEN nh = 1 THEN 'directory_only' WHEN nh > 1 THEN 'ambiguous' ELSE 'none' END AS resolution, CASE WHEN ns = 1 AND (nh = 0 OR both_ = 1) THEN only_s WHEN ns = 0 AND nh = 1 THEN only_h END AS assigned FROM c"""
)
def candidate_set_resolution(spark, d):
    """Two candidate sets per key, told by their counts; ambiguity assigns nothing."""
    f = F.col("l_returnflag")
    p = table(spark, d, "lineitem").groupBy("l_partkey", "l_suppkey").agg(F.bool_or(f == "R").alias("h"), F.bool_or(f == "A").alias("o"))
    c = p.groupBy("l_partkey").agg(F.count_if("h").alias("directory_candidates"), F.count_if("o").alias("official_sites"), F.count_if(F.col("h") & F.col("o")).alias("b"), F.min(F.when(F.col("o"), F.col("l_suppkey"))).alias("s"), F.min(F.when(F.col("h"), F.col("l_suppkey"))).alias("u"))
    ns, nh, b = F.col("official_sites"), F.col("directory_candidates"), F.col("b")
    status = F.when(ns > 1, "multiple_official").when((ns == 1) & (nh > 0) & (b == 0), "conflict").when(ns == 1, "official").when(nh == 1, "directory_only").when(nh > 1, "ambiguous").otherwise("none")
    return c.select("l_partkey", "directory_candidates", "official_sites", status.alias("resolution"), F.when((ns == 1) & ((nh == 0) | (b == 1)), F.col("s")).when((ns == 0) & (nh == 1), F.col("u")).alias("assigned"))
