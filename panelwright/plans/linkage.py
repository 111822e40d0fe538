"""Resolves reporting ids to units per year from annual directories and crosswalk evidence.

Candidate sets are aggregated once per key and joined; what a row-by-row program decides by
branching is a ladder of conditions over these sets.  Several candidates block, none is picked.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.functions import ids, scope, text
from panelwright.operators import skew


def crosswalk(frame: DataFrame, year: str = "cw_year") -> tuple[DataFrame, DataFrame]:
    """(relations, records) of a crosswalk sheet read as text.

    Columns: year, opeid, ipedsmatch, addmatch, ipedsmain, source, ipedsrpt.  A relation is
    (cw_year, opeid8, unitid, relation_type); a field without a usable unit gives a row that
    says so.  Unparsed tokens stay in the records and make them incomplete.  An id may have
    several rows in a year; there is a record for each, telling of its own fields only.
    """
    fields = {"primary_match": "ipedsmatch", "additional_match": "addmatch", "parent_reference": "ipedsmain"}
    base = frame.select(F.col(year).cast("int").alias("cw_year"), ids.full_opeid(F.col("opeid")).alias("opeid8"), *[ids.unit_tokens(F.col(c)).alias(k) for k, c in fields.items()], ids.canonical_code(F.col("source")).alias("cw_source_code"), ids.canonical_code(F.col("ipedsrpt")).alias("cw_ipeds_reporting_code"))
    told = F.array(*[F.struct(F.lit(k).alias("relation_type"), F.col(f"{k}.units").alias("units"), F.col(f"{k}.unparsed").alias("bad")) for k in fields])
    long = base.select("cw_year", "opeid8", F.explode(told).alias("r"))
    found = long.select("cw_year", "opeid8", F.explode("r.units").alias("unitid"), "r.relation_type")
    unparsed = long.where(F.size("r.bad") > 0).select("cw_year", "opeid8", F.lit(None).cast("bigint").alias("unitid"), F.lit("unparsed_site_match").alias("relation_type"))
    sites = F.array_union(F.col("primary_match.units"), F.col("additional_match.units"))
    none = base.where((F.size(sites) == 0) & F.col("primary_match.complete") & F.col("additional_match.complete")).select("cw_year", "opeid8", F.lit(None).cast("bigint").alias("unitid"), F.lit("no_site_match").alias("relation_type"))
    records = base.select(
        "cw_year",
        "opeid8",
        "cw_source_code",
        "cw_ipeds_reporting_code",
        (F.col("primary_match.complete") & F.col("additional_match.complete")).alias("cw_site_parse_complete"),
        (F.size(sites) > 1).alias("cw_multiple_site_unitids"),
        (F.size("additional_match.units") > 0).alias("cw_has_additional_match"),
        F.to_json(F.array_union(F.col("primary_match.unparsed"), F.col("additional_match.unparsed"))).alias("cw_unparsed_json"),
    )
    return found.unionByName(unparsed).unionByName(none), records


#: Codes of the source of a match and of the reporting status.
SOURCE_CODES, REPORTING_CODES = ("1", "2", "3", "4", "5"), ("1", "2", "-2")


def require_codes(records: DataFrame) -> DataFrame:
    """``records`` of :func:`crosswalk` itself if all their codes are documented; else raises.  Null codes are allowed."""
    bad = ~F.col("cw_source_code").isin(*SOURCE_CODES) | ~F.col("cw_ipeds_reporting_code").isin(*REPORTING_CODES)
    odd = records.where(F.coalesce(bad, F.lit(False))).select("cw_source_code", "cw_ipeds_reporting_code").limit(3).collect()
    if odd:
        raise ValueError(f"undocumented codes in the crosswalk, such as {[tuple(r) for r in odd]}")
    return records


def candidates(directory: DataFrame) -> DataFrame:
    """Per (year, opeid8): number of candidate units, those that are no offices, and the only unit.

    A candidate set is told by its counts; membership of a unit is told by the unit's own
    record.  So an id that a tenth of all units carry is one row, never a collected list.
    """
    known = directory.where("opeid8 IS NOT NULL")
    admin = F.coalesce(ids.integral(F.col("sector")) == 0, F.lit(False))
    return known.groupBy(F.col("ipeds_year").alias("y"), "opeid8").agg(F.count(F.lit(1)).alias("n"), F.count_if(~admin).alias("n_not_admin"), F.when(F.count(F.lit(1)) == 1, F.min("unitid")).alias("only"))


def base_match(panel: DataFrame, directory: DataFrame, anchor: str = "start") -> DataFrame:
    """Exact matches of (opeid8, award_year) rows in the directory of the start or end year.

    ``directory`` has ipeds_year, unitid, a valid or null opeid8 and code columns.  Gives the
    match status, the unit (only for an exact unique active one), the sensitivity to the
    choice of year, lifetime counts, and the reasons for which a row is not strict.
    """
    start = ids.award_year_start(F.col("award_year"))
    rows = panel.select("opeid8", "award_year", start.alias("y0"), *[c for c in ("descriptor_review_required",) if c in panel.columns]).withColumn("y", F.col("y0") + (0 if anchor == "start" else 1))
    years = F.broadcast(directory.select(F.col("ipeds_year").alias("__y")).distinct())  # one row per calendar year
    flags = scope.record_flags(directory.columns, F.col("ipeds_year"))
    told = F.struct(*[c.alias(k) for k, c in flags.items()])
    known = directory.where("opeid8 IS NOT NULL").withColumn("__told", told)
    sets = known.groupBy("ipeds_year", "opeid8").agg(F.count(F.lit(1)).alias("n"), F.min("unitid").alias("u"), F.min("__told").alias("f"))
    one = F.col("n") == 1  # the flags of an id with one unit come with it
    side = F.struct("n", F.when(one, F.col("u")).alias("only"), F.when(one, F.col("f")).alias("flags"))
    sets = sets.select(F.col("ipeds_year").alias("__y"), F.col("opeid8").alias("__o"), side.alias("side"))
    for name, shift in (("s", 0), ("e", 1)):
        at = sets.select((F.col("__y") - shift).alias(f"{name}_y"), F.col("__o").alias(f"{name}_o"), F.col("side").alias(name))
        rows = rows.join(at, (F.col("y0") == F.col(f"{name}_y")) & (F.col("opeid8") == F.col(f"{name}_o")), "left").drop(f"{name}_y", f"{name}_o")
        rows = rows.join(years.withColumnRenamed("__y", f"{name}_year"), F.col("y0") + shift == F.col(f"{name}_year"), "left").withColumn(f"{name}_loaded", F.col(f"{name}_year").isNotNull()).drop(f"{name}_year")
        rows = rows.withColumns({f"{name}_n": F.coalesce(F.col(f"{name}.n"), F.lit(0)), f"{name}_only": F.col(f"{name}.only"), f"{name}_flags": F.col(f"{name}.flags")}).drop(name)
    pick = "s" if anchor == "start" else "e"
    lifetime = directory.where("opeid8 IS NOT NULL").select("ipeds_year", "unitid", "opeid8")
    pairs = lifetime.select("unitid", "opeid8").distinct()
    per_id = pairs.groupBy("opeid8").agg(F.count(F.lit(1)).alias("lifetime_unitids"))
    per_unit = pairs.groupBy(F.col("unitid").alias("lu")).agg(F.count(F.lit(1)).alias("lifetime_opeids"))
    grouped = lifetime.groupBy(F.col("ipeds_year").alias("ry"), ids.opeid_root(F.col("opeid8")).alias("rr")).agg(F.countDistinct("unitid").alias("k"))
    own = panel.groupBy(ids.award_year_start(F.col("award_year")).alias("ry"), "award_year", ids.opeid_root(F.col("opeid8")).alias("rr")).agg(F.count(F.lit(1)).alias("root_rows"))
    # counts of an id group at its year, the year after, and of its rows: one table, joined once
    root = grouped.select("ry", "rr", F.col("k").alias("s_root_units"), F.lit(0).cast("bigint").alias("e_root_units"))
    root = root.unionByName(grouped.select((F.col("ry") - 1).alias("ry"), "rr", F.lit(0).cast("bigint").alias("s_root_units"), F.col("k").alias("e_root_units")))
    root = root.groupBy("ry", "rr").agg(F.max("s_root_units").alias("s_root_units"), F.max("e_root_units").alias("e_root_units"))
    root = own.join(root, ["ry", "rr"], "left").select(F.col("award_year").alias("pa"), F.col("rr").alias("pr"), "s_root_units", "e_root_units", "root_rows")
    n, loaded_now, flag = F.col(f"{pick}_n"), F.col(f"{pick}_loaded"), F.col(f"{pick}_flags")
    status = (
        F.when(~loaded_now, "ipeds_year_unavailable")
        .when(n == 0, "no_exact_match")
        .when(n > 1, "multiple_exact_unitids")
        .when(F.coalesce(flag["is_administrative"], F.lit(False)), "exact_unique_administrative_unit")
        .when(F.coalesce(flag["is_inactive"], F.lit(False)), "exact_unique_inactive")
        .otherwise("exact_unique")
    )
    rows = rows.withColumn("ipeds_match_status", status).withColumn("unitid", F.when(F.col("ipeds_match_status") == "exact_unique", F.col(f"{pick}_only")))
    rows = rows.withColumn("anchor_sensitivity", scope.anchor_sensitivity(F.col("s_n"), F.col("e_n"), F.col("s_only"), F.col("e_only"), F.col("s_loaded"), F.col("e_loaded")))
    rows = rows.join(per_id, "opeid8", "left")
    matched = rows.where("unitid IS NOT NULL").join(per_unit, F.col("unitid") == F.col("lu"), "left").drop("lu")
    rows = matched.unionByName(rows.where("unitid IS NULL").withColumn("lifetime_opeids", F.lit(None).cast("bigint")))  # no unit, no join
    rows = rows.join(root, (F.col("award_year") == F.col("pa")) & (ids.opeid_root(F.col("opeid8")) == F.col("pr")), "left").drop("pa", "pr")
    counts = {c: F.coalesce(c, F.lit(0)) for c in ("lifetime_unitids", "lifetime_opeids", "s_root_units", "e_root_units", "root_rows")}
    rows = rows.withColumns(counts)

    def either(flag_name: str) -> Column:
        return F.coalesce(F.col(f"s_flags.{flag_name}"), F.lit(False)) | F.coalesce(F.col(f"e_flags.{flag_name}"), F.lit(False))

    no_record = F.col("s_flags").isNull() | F.col("e_flags").isNull()
    review = F.lower(F.coalesce(F.col("descriptor_review_required").cast("string"), F.lit("true"))) if "descriptor_review_required" in rows.columns else F.lit("false")
    ladder = {
        "fsa_descriptor_review_required": ~review.isin("false", "0", "0.0"),
        "match": F.col("ipeds_match_status") != "exact_unique",
        "anchor": F.col("anchor_sensitivity") != "stable_unique",
        "multiple_ipeds_units_in_opeid_group": (F.col("s_root_units") > 1) | (F.col("e_root_units") > 1),
        "multiple_fsa_rows_in_opeid_group": F.col("root_rows") > 1,
        "fsa_additional_location_identifier": (F.substring("opeid8", 7, 2) != "00") | (F.substring("opeid8", 1, 1) != "0"),
        "opeid_maps_to_multiple_unitids_over_time": F.col("lifetime_unitids") > 1,
        "unitid_has_multiple_opeids_over_time": F.col("lifetime_opeids") > 1,
        "ipeds_branch_flag": either("is_branch"),
        "ipeds_component_parent_child": either("has_parent_child"),
        "ipeds_merger_or_closure": either("merger_or_closure"),
        "ipeds_administrative_unit": either("is_administrative"),
        "ipeds_inactive": either("is_inactive"),
        "ipeds_not_full_title_iv": no_record | either("not_full_participant"),
        "parent_child_metadata_unavailable": no_record | ~F.coalesce(F.col("s_flags.flags_available") & F.col("e_flags.flags_available"), F.lit(False)),
        "activity_metadata_unavailable": no_record | ~F.coalesce(F.col("s_flags.status_available") & F.col("e_flags.status_available"), F.lit(False)),
    }
    named = F.transform(scope.reasons(ladder), lambda r: F.when(r == "match", F.col("ipeds_match_status")).when(r == "anchor", F.concat(F.lit("anchor_"), F.col("anchor_sensitivity"))).otherwise(r))
    rows = rows.withColumn("strict_exclusion_reasons", F.array_distinct(named))
    return rows.select(
        "opeid8", "award_year", F.col("y").alias("ipeds_year"), "unitid", "ipeds_match_status", F.col(f"{pick}_n").alias("candidate_count"), "anchor_sensitivity",
        "lifetime_unitids", "lifetime_opeids", "strict_exclusion_reasons", (F.size("strict_exclusion_reasons") == 0).alias("strict_eligible"),
    )


def candidate_ledger(panel: DataFrame, directory: DataFrame) -> DataFrame:
    """All candidates of each row at both years: exact ids, and units of the id group only as evidence.

    An id group with many records in a year (above :func:`skew.hot_limit`) is split by hash of
    the unit, and the rows that meet it are copied to its parts, so no group is gathered in
    one task.
    """
    rows = panel.select("opeid8", "award_year", ids.award_year_start(F.col("award_year")).alias("y0")).withColumn("__root", ids.opeid_root(F.col("opeid8")))
    spread = rows.withColumn("a", F.explode(F.array(F.struct(F.lit("start").alias("anchor"), F.col("y0").alias("y")), F.struct(F.lit("end").alias("anchor"), (F.col("y0") + 1).alias("y")))))
    d = directory.where("opeid8 IS NOT NULL").select(F.col("ipeds_year").alias("dy"), F.col("unitid").alias("candidate_unitid"), F.col("opeid8").alias("candidate_opeid8"), ids.opeid_root(F.col("opeid8")).alias("dr"))
    sizes = d.groupBy("dy", "dr").agg(F.count(F.lit(1)).alias("n"))
    limit = skew.hot_limit(int(sizes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).collect()[0]["n"]))
    hot = F.broadcast(sizes.where(F.col("n") > limit).select("dy", "dr", F.ceil(F.col("n") / limit).cast("int").alias("parts")))  # at most skew.MAX_HOT groups
    d = d.join(hot, ["dy", "dr"], "left").withColumn("part", F.pmod(F.xxhash64("candidate_unitid"), F.coalesce("parts", F.lit(1))).cast("int")).drop("parts")
    met = spread.select("opeid8", "award_year", "a.anchor", F.col("a.y").alias("dy"), F.col("__root").alias("dr")).where("dy IS NOT NULL AND dr IS NOT NULL")
    met = met.join(hot, ["dy", "dr"], "left").withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))).drop("parts")
    found = met.join(d, ["dy", "dr", "part"])
    kind = F.when(F.col("opeid8") == F.col("candidate_opeid8"), "exact_opeid").otherwise("scope_group_only_no_assignment")
    return found.select("opeid8", "award_year", "anchor", F.col("dy").alias("ipeds_year"), "candidate_unitid", "candidate_opeid8", kind.alias("candidate_kind"))


def resolve(base: DataFrame, directory: DataFrame, records: DataFrame, relations: DataFrame, descriptors: DataFrame | None = None) -> DataFrame:
    """Annual resolution from directory candidates (h) and official sites (s); the first status that holds.

    ``base`` is a table of :func:`base_match`; ``directory`` is unique by year and unit;
    ``descriptors`` may bring school, state and school_type per (opeid8, award_year) for the
    geography and placeholder overrides.  An id may have several records in a year; it is
    complete if all of them are.
    """
    h = candidates(directory).select(F.col("y").alias("hy"), F.col("opeid8").alias("ho"), F.col("n").alias("n_h"), "n_not_admin", F.col("only").alias("only_h"))
    own = relations.where(F.col("relation_type").isin("primary_match", "additional_match") & F.col("unitid").isNotNull())
    s = own.select("cw_year", "opeid8", "unitid").distinct().groupBy(F.col("cw_year").alias("sy"), F.col("opeid8").alias("so")).agg(F.count(F.lit(1)).alias("n_s"), F.when(F.count(F.lit(1)) == 1, F.min("unitid")).alias("only_s"))
    complete = F.coalesce(F.lower(F.col("cw_site_parse_complete").cast("string")).isin("true", "1"), F.lit(False))
    official = records.groupBy(F.col("cw_year").alias("oy"), F.col("opeid8").alias("oo")).agg(F.every(complete).alias("complete"))
    j = base.join(h, (F.col("ipeds_year") == F.col("hy")) & (F.col("opeid8") == F.col("ho")), "left")
    j = j.join(s, (F.col("ipeds_year") == F.col("sy")) & (F.col("opeid8") == F.col("so")), "left")
    j = j.join(official, (F.col("ipeds_year") == F.col("oy")) & (F.col("opeid8") == F.col("oo")), "left").drop("hy", "ho", "sy", "so", "oy", "oo")
    j = j.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("n_h", "n_s", "n_not_admin")})
    loaded = F.broadcast(directory.select(F.col("ipeds_year").alias("ly")).distinct())  # one row per calendar year
    j = j.join(loaded, F.col("ipeds_year") == F.col("ly"), "left")
    j = j.withColumn("guess", F.when(F.col("n_s") == 1, F.col("only_s")).when(F.col("n_s") == 0, F.col("only_h")))
    admin = F.coalesce(ids.integral(F.col("sector")) == 0, F.lit(False))
    known = directory.select(F.col("ipeds_year").alias("ky"), F.col("unitid").alias("ku"), F.col("opeid8").alias("k_id"), F.col("stabbr").alias("k_state"), F.col("instnm").alias("k_name"), admin.alias("k_admin"))
    j = j.join(known, (F.col("ipeds_year") == F.col("ky")) & (F.col("guess") == F.col("ku")), "left")
    one, member = F.col("n_s") == 1, F.coalesce(F.col("k_id") == F.col("opeid8"), F.lit(False))
    others = F.col("n_not_admin") - (member & ~F.coalesce("k_admin", F.lit(False))).cast("int")
    status = (
        F.when(F.col("complete").isNotNull() & ~F.col("complete"), "crosswalk_site_parse_incomplete")
        .when(F.col("n_s") > 1, "multiple_official_site_unitids")
        .when(one & (F.col("n_h") > 0) & ~member, "directory_crosswalk_identity_conflict")
        .when(one & (F.col("n_h") > 1) & (others > 0), "multiple_nonadministrative_directory_unitids")
        .when(one & F.col("ku").isNull(), "crosswalk_site_missing_annual_directory")
        .when(one & member, "official_site_and_directory_agree")
        .when(one, "official_site_alias_annual_unitid_verified")
        .when(F.col("n_h") == 1, "unique_annual_directory_only")
        .when(F.col("n_h") > 1, "multiple_exact_directory_unitids")
        .when(F.col("ly").isNull(), "annual_directory_unavailable")
        .otherwise("no_annual_site_match")
    )
    j = j.withColumn("status", status)
    assigned = F.col("status").isin("official_site_and_directory_agree", "official_site_alias_annual_unitid_verified", "unique_annual_directory_only")
    j = j.withColumn("assigned", F.when(assigned, F.col("guess")))
    conflict, placeholder, likeness = F.lit(False), F.lit(False), F.lit(None).cast("double")
    if descriptors is not None:
        j = j.join(descriptors.select("opeid8", "award_year", F.col("school").alias("d_school"), F.col("state").alias("d_state"), F.col("school_type").alias("d_type")), ["opeid8", "award_year"], "left")
        place = scope.geography([F.col("d_state")], [F.col("d_type")])
        at_home = F.upper(F.btrim("k_state")).isin(*scope.STATES, *scope.TERRITORIES)
        abroad = F.upper(F.btrim("k_state")) == "FC"
        clash = ((place == "foreign_explicit") & at_home) | (place.isin("us_states_dc", "territories_and_freely_associated_states") & abroad)
        conflict = F.col("assigned").isNotNull() & F.coalesce(clash, F.lit(False))
        placeholder = (F.col("opeid8") == "88888800") & (F.upper(F.btrim(F.coalesce("d_school", F.lit("")))) == "DEFAULT SCHOOL FOR CONSOLIDATED LOANS")
        likeness = text.name_similarity(text.name_key(F.col("d_school")), text.name_key(F.col("k_name")))
    final = F.when(placeholder, "noninstitutional_source_placeholder").when(conflict, "fsa_ipeds_geography_identity_conflict").otherwise(F.col("status"))
    unit = F.when(~placeholder & ~conflict, F.col("assigned"))
    eligible = unit.isNotNull() & ~F.coalesce("k_admin", F.lit(False))
    same = F.coalesce(unit == F.col("unitid"), F.lit(False))
    out = j.select(
        "opeid8",
        "award_year",
        "ipeds_year",
        F.col("unitid").alias("ipeds_directory_unitid"),
        unit.alias("__unit"),
        final.alias("ipeds_resolution_status"),
        F.col("n_h").alias("directory_candidate_count"),
        F.col("n_s").alias("crosswalk_site_count"),
        eligible.alias("ipeds_annual_identity_eligible"),
        likeness.alias("name_similarity"),
        "strict_exclusion_reasons",
        (F.col("strict_eligible") & eligible & same).alias("strict_eligible"),
    )
    return out.withColumn("name_review_required", F.col("name_similarity") < 0.5).withColumnRenamed("__unit", "unitid")


def reconcile(bridge: DataFrame, directory: DataFrame, relations: DataFrame) -> DataFrame:
    """Annual counts of units in the directory, in the crosswalk and in the bridge, and of their overlaps.

    A year whose directory is not loaded has null (not 0) for what depends on it.
    """
    d = directory.select(F.col("ipeds_year").alias("y"), F.col("unitid").alias("u"), F.lit(1).alias("in_directory"), F.lit(None).cast("int").alias("in_crosswalk"), F.lit(None).cast("int").alias("in_bridge"))
    c = relations.where("unitid IS NOT NULL").select(F.col("cw_year").alias("y"), F.col("unitid").alias("u"), F.lit(None).cast("int"), F.lit(1), F.lit(None).cast("int"))
    b = bridge.where("unitid IS NOT NULL").select(F.col("ipeds_year").alias("y"), F.col("unitid").alias("u"), F.lit(None).cast("int"), F.lit(None).cast("int"), F.lit(1))
    per = d.union(c).union(b).groupBy("y", "u").agg(*[F.max(x).alias(x) for x in ("in_directory", "in_crosswalk", "in_bridge")])
    has = F.count("in_directory") > 0

    def n(cond: str) -> Column:
        return F.count_if(F.expr(cond))

    return per.groupBy(F.col("y").alias("ipeds_year")).agg(
        F.when(has, F.count("in_directory")).alias("directory_units"),
        F.count("in_crosswalk").alias("crosswalk_units"),
        F.count("in_bridge").alias("bridge_units"),
        F.when(has, n("in_directory = 1 AND in_crosswalk = 1")).alias("directory_and_crosswalk"),
        F.when(has, n("in_directory = 1 AND in_bridge = 1")).alias("directory_and_bridge"),
        F.when(has, n("in_directory = 1 AND in_bridge IS NULL AND in_crosswalk IS NULL")).alias("directory_only"),
        F.when(has, n("in_directory = 1 AND in_bridge IS NULL AND in_crosswalk = 1")).alias("unrepresented_with_crosswalk"),
        F.when(has, n("in_bridge = 1 AND in_directory IS NULL")).alias("bridge_not_in_directory"),
    )


def crosswalk_sensitivity(panel: DataFrame, records: DataFrame, relations: DataFrame) -> DataFrame:
    """Whether the official sites of a row's start year and of the year after agree.

    Site sets are told by their counts and only unit, so an id with many sites is one row.  A
    conflict is an incomplete record or several sites at either year, or one site that differs.
    """
    own = relations.where(F.col("relation_type").isin("primary_match", "additional_match") & F.col("unitid").isNotNull()).select("cw_year", "opeid8", "unitid").distinct()
    sites = own.groupBy("cw_year", "opeid8").agg(F.count(F.lit(1)).alias("n"), F.min("unitid").alias("u"))
    whole = F.coalesce(F.lower(F.col("cw_site_parse_complete").cast("string")).isin("true", "1"), F.lit(False))
    told = records.groupBy("cw_year", "opeid8").agg(F.every(whole).alias("complete")).join(sites, ["cw_year", "opeid8"], "left")
    rows = panel.select("opeid8", "award_year", ids.award_year_start(F.col("award_year")).alias("y0"))
    for name, shift in (("s", 0), ("e", 1)):
        side = told.select((F.col("cw_year") - shift).alias("y0"), "opeid8", F.struct("complete", F.coalesce("n", F.lit(0)).alias("n"), "u").alias(name))
        rows = rows.join(side, ["y0", "opeid8"], "left")
    n = {k: F.coalesce(F.col(f"{k}.n"), F.lit(0)) for k in "se"}
    broken = reduce(lambda a, b: a | b, [(n[k] > 1) | F.coalesce(~F.col(f"{k}.complete"), F.lit(False)) for k in "se"])
    both = (n["s"] == 1) & (n["e"] == 1)
    status = (
        F.when(broken | (both & (F.col("s.u") != F.col("e.u"))), "scope_or_identity_conflict")
        .when(F.col("s").isNull() | F.col("e").isNull(), "year_unavailable")
        .when(both, "stable_unique")
        .otherwise("ambiguous_or_unmatched")
    )
    return rows.select("opeid8", "award_year", n["s"].alias("start_site_count"), n["e"].alias("end_site_count"), status.alias("crosswalk_anchor_sensitivity"))


def memberships(resolved: DataFrame, directory: DataFrame, relations: DataFrame) -> DataFrame:
    """(opeid8, award_year, unitid, relation_type): every unit that evidence ties to a row of :func:`resolve`, assigned or not.

    Official relations of the row's year, and directory units that carry its id.  A membership
    is possible coverage, never an assignment; see :func:`represented` for those disproved.
    """
    base = resolved.select("opeid8", "award_year", "ipeds_year")
    said = relations.where("unitid IS NOT NULL").select(F.col("cw_year").alias("ipeds_year"), "opeid8", "unitid", "relation_type")
    own = directory.where("opeid8 IS NOT NULL").select("ipeds_year", "opeid8", "unitid", F.lit("directory_opeid").alias("relation_type"))
    return base.join(said.unionByName(own).distinct(), ["ipeds_year", "opeid8"]).select("opeid8", "award_year", "unitid", "relation_type")


def represented(members: DataFrame, contradicted: DataFrame) -> DataFrame:
    """Memberships without those whose identity was disproved."""
    return members.join(contradicted, ["opeid8", "award_year", "unitid"], "left_anti")


#: What is known of the group of a unit without a direct link.
GROUPS = ("both_official_affiliation_and_diagnostic_root", "official_affiliation_only", "diagnostic_root_only", "no_group_evidence_in_reviewed_sources")


def residual(universe: DataFrame, direct: DataFrame, official: DataFrame, root: DataFrame) -> DataFrame:
    """(period, unitid, category): units of a universe without a direct link, in disjoint parts.

    All tables have period and unitid, and may repeat rows; a null unit is no unit.  The four
    sets meet in one aggregate per unit.  Group evidence is no assignment.
    """
    sets = {"u": universe, "d": direct, "o": official, "r": root}
    long = reduce(DataFrame.unionByName, (df.where("unitid IS NOT NULL").select("period", "unitid", F.lit(k).alias("s")) for k, df in sets.items()))
    has = {k: F.bool_or(F.col("s") == k).alias(k) for k in sets}
    per = long.groupBy("period", "unitid").agg(*has.values()).where("u AND NOT d")
    kind = F.when(F.col("o") & F.col("r"), GROUPS[0]).when(F.col("o"), GROUPS[1]).when(F.col("r"), GROUPS[2]).otherwise(GROUPS[3])
    return per.select("period", "unitid", kind.alias("category"))
