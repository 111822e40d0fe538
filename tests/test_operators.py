"""Panel operators on small fixtures with nulls, ties, repeats and empty tables."""

import pytest
from pyspark.sql import functions as F

from panelwright.functions import scope
from panelwright.operators import conserve, harmonise, keys, metadata, periods, skew
from panelwright.plans import analysis, benchmark, diagnostics, family_panel, linkage, masters
from tests.conftest import rows


def test_key_violations_and_joins(spark):
    a = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d")], "k int, x string")
    b = spark.createDataFrame([(1, "p"), (3, "q")], "k int, y string")
    v = keys.violations(a, ["k"]).collect()[0]
    assert (v.n_rows, v.null_key_rows, v.repeated_keys, v.rows_in_repeats) == (4, 1, 1, 2)
    with pytest.raises(keys.KeyViolation):
        keys.checked_join(a, b, ["k"], validate="one_to_one")
    assert len(rows(keys.checked_join(a, b, ["k"], validate="many_to_one"))) == 4
    with pytest.raises(keys.KeyViolation):
        keys.checked_join(a, a.withColumnRenamed("x", "X"), ["k"], validate="many_to_many")
    got = rows(keys.indicator_join(a.select("k").distinct(), b.select("k"), ["k"]))
    assert got == [(1, "both"), (2, "left_only"), (3, "right_only"), (None, "left_only")]
    empty = a.where("false")
    assert keys.violations(empty, ["k"]).collect()[0].n_rows == 0


def test_keep_last_and_bags(spark):
    a = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 2, "c"), (2, None, "z")], "k int, t int, x string")
    assert rows(keys.keep_last(a, ["k"], ["t"]), "k", "x") == [(1, "c"), (2, "z")]
    assert keys.bags_equal(a, a.union(a)) and not keys.bags_equal(a, a.union(a), distinct=False) and not keys.bags_equal(a, a.where("k = 1"))
    assert rows(keys.mark_duplicates(a.select("k"), ["k"])) == [(1, True)] * 3 + [(2, False)]


def test_offset_and_common_sample(spark):
    a = spark.createDataFrame([(1, 2005), (1, 2006), (2, 2005)], "unitid long, year int")
    b = spark.createDataFrame([(1, 2004, 5.0), (1, 2005, 6.0)], "unitid long, start int, x double")
    j = periods.offset_join(a, b.withColumnRenamed("unitid", "u"), "unitid", "year", "u", "start", -1)
    assert rows(j, "unitid", "year", "x", "row_found") == [(1, 2005, 5.0, True), (1, 2006, 6.0, True), (2, 2005, None, False)]
    k = periods.offsets_join(a, b.withColumnRenamed("unitid", "u"), "unitid", "year", "u", "start", [-1, 0])
    c = periods.common_sample(k, ["unitid", "year"], "row_found", "all_found")
    assert rows(c.where("all_found").select("unitid", "year").distinct()) == [(1, 2005)]


def test_year_ranges(spark):
    a = spark.createDataFrame([("x", y) for y in (2004, 2006, 2007, 2007)] + [("y", None)], "k string, y int")
    assert rows(periods.year_ranges(a, ["k"], "y")) == [("x", "2004,2006-2007")]


def test_dense_summary_has_empty_years(spark):
    left = spark.createDataFrame([(1, 2007, 100, "p"), (1, 2008, 80, "p")], "unitid long, year int, a int, population string")
    right = spark.createDataFrame([(1, y, v, "observed", "included_unique_family_record") for y, v in ((2005, 120), (2006, 100), (2007, 80), (2008, 60))], "unitid long, award_year_start int, b int, b__status string, record_status string")
    p = benchmark.pairs(left, right, "a", "b")
    assert rows(p.where("common_all_offsets").select("year").distinct()) == [(2007,)]
    s = benchmark.summary(p, "population", [2007, 2008, 2009])
    row = s.where("sample = 'common_all_offsets' AND offset = -1 AND ipeds_year = 'all' AND reporting_population = 'all'").collect()[0]
    assert row.comparable_rows == 1 and row.weighted_absolute_relative_difference == 0
    empty = s.where("ipeds_year = '2009' AND reporting_population = 'all'").collect()
    assert len(empty) == 8 and all(r.comparable_rows == 0 and r.base_total is None for r in empty)


def test_zero_base_and_statuses(spark):
    left = spark.createDataFrame([(1, 2007, 0.0), (2, 2007, -1.0), (3, 2007, 2.5), (4, 2007, 3.0), (5, 2007, 3.0), (6, 2007, float("nan"))], "unitid long, year int, a double")
    right = spark.createDataFrame([(u, 2007, 5.0, st, rs) for u, st, rs in ((1, "observed", "included_unique_family_record"), (2, "observed", "included_unique_family_record"), (3, "observed", "included_unique_family_record"), (4, "suppressed_lt10", "included_unique_family_record"), (6, "observed", "included_unique_family_record"))], "unitid long, award_year_start int, b double, b__status string, record_status string")
    p = benchmark.pairs(left, right, "a", "b", [0])
    got = dict(rows(p, "unitid", "comparison_status"))
    bad = "missing_negative_nonfinite_or_invalid_numeric"
    assert got == {1: "comparable_numeric_pair_population_limits_apply", 2: bad, 3: bad, 4: "fsa_value_not_observed", 5: "no_fsa_unitid_row", 6: bad}
    assert p.where("unitid = 1").collect()[0].relative_difference is None and p.where("unitid = 1").collect()[0].large_difference_review_flag


def test_coalesce_checked(spark):
    a = spark.createDataFrame([(1, 0, 0), (2, None, 1), (3, 5, None), (4, None, None)], "k int, a int, b int")
    assert rows(harmonise.coalesce_checked(a, ["a", "b"], "c"), "k", "c") == [(1, 0), (2, 1), (3, 5), (4, None)]
    for bad in ([(0, 1)], ):
        with pytest.raises(harmonise.ConflictError):
            harmonise.coalesce_checked(spark.createDataFrame(bad, "a int, b int"), ["a", "b"], "c")
    with pytest.raises(harmonise.ConflictError):
        harmonise.coalesce_checked(spark.createDataFrame([("", "school")], "a string, b string"), ["a", "b"], "c")
    n = spark.createDataFrame([(float("nan"), 1.0)], "a double, b double")
    assert rows(harmonise.coalesce_checked(n, ["a", "b"], "c"), "c") == [(1.0,)]


def test_year_partition(spark):
    R = harmonise.YearRule
    a = spark.createDataFrame([(2001, 1, None), (2005, None, 2), (None, None, None)], "y int, old int, new int")
    assert rows(harmonise.year_partition(a, "y", [R("old", 2000, 2003), R("new", 2004, 2010)], "v"), "y", "v") == [(2001, 1), (2005, 2), (None, None)]
    with pytest.raises(harmonise.ConflictError, match="overlap"):
        harmonise.year_partition(a, "y", [R("old", 2000, 2004), R("new", 2004, 2010)], "v")
    with pytest.raises(harmonise.ConflictError, match="covered"):
        harmonise.year_partition(a, "y", [R("old", 2000, 2003)], "v")
    b = spark.createDataFrame([(2005, 9, 2)], "y int, old int, new int")
    with pytest.raises(harmonise.ConflictError, match="outside"):
        harmonise.year_partition(b, "y", [R("old", 2000, 2003), R("new", 2004, 2010)], "v")


def test_recode_and_restore(spark):
    R = harmonise.MissingRule
    a = spark.createDataFrame([(1, 2005, "-1", 5.0), (2, 2005, "-1.0", -1.0), (3, 2005, "-01", 7.0), (4, 2006, "-1", None)], "k int, y int, c string, x double")
    rules = [R("c", 2005, "-1", "not_reported", "r1"), R("x", 2005, "-1", "not_applicable", "r2")]
    clean, ledger = harmonise.recode_missing(a, ["k"], "y", rules)
    assert rows(clean, "k", "c", "x") == [(1, None, 5.0), (2, None, None), (3, "-01", 7.0), (4, "-1", None)]
    assert rows(ledger, "k", "column", "original_value") == [(1, "c", "-1"), (2, "c", "-1.0"), (2, "x", "-1.0")]
    back = harmonise.restore_missing(clean, ledger, ["k"], ["c", "x"])
    assert rows(back, "k", "c", "x") == rows(a, "k", "c", "x")
    with pytest.raises(harmonise.ConflictError):
        harmonise.recode_missing(a, ["k"], "y", [*rules, R("c", 2005, "-1", "again", "r3")])


def test_categories(spark):
    a = spark.createDataFrame([("F",), (None,)], "s string")
    assert rows(harmonise.encode_categories(a, "s", {"F": 1}, "n"), "s", "n") == [("F", 1), (None, None)]
    with pytest.raises(harmonise.ConflictError):
        harmonise.encode_categories(spark.createDataFrame([("?",)], "s string"), "s", {"F": 1}, "n")
    assert rows(harmonise.numeric_category(spark.createDataFrame([("-2",), (None,)], "s string"), "s")) == [(-2,), (None,)]
    with pytest.raises(harmonise.ConflictError):
        harmonise.numeric_category(spark.createDataFrame([("01",)], "s string"), "s")


def test_cell_differences(spark):
    a = spark.createDataFrame([(1, 1.0, None), (2, float("nan"), "x"), (3, 1.0, "")], "k int, v double, s string")
    b = spark.createDataFrame([(1, 1.0000000000000002, None), (2, float("nan"), None), (3, 1.0, "")], "k int, v double, s string")
    assert rows(conserve.cell_differences(a, a, ["k"])) == [("s", 3, 0), ("v", 3, 0)]
    assert rows(conserve.cell_differences(a, b, ["k"])) == [("s", 3, 1), ("v", 3, 1)]
    assert rows(conserve.cell_differences(a, b.where("k < 3"), ["k"], ["s"])) == [("s", 3, 2)]
    with pytest.raises(TypeError):
        conserve.cell_differences(a, b.withColumn("v", F.col("v").cast("int")), ["k"])
    assert conserve.row_bag_hash(a) == conserve.row_bag_hash(a.orderBy(F.desc("k"))) != conserve.row_bag_hash(b)


def test_cell_differences_of_wide_tables_compile_no_code_per_column(spark, monkeypatch):
    """A join takes a bounded number of columns, and its code does not grow with them."""
    made = []
    unequal = conserve._unequal
    monkeypatch.setattr(conserve, "_unequal", lambda *a: made.append((len(a[3]), unequal(*a))) or made[-1][1])
    a = spark.range(20).selectExpr("id AS k", *[f"id + {i} AS m{i}" for i in range(600)], "id AS `*`")
    b = spark.range(20).selectExpr("id AS k", *[f"CASE WHEN id = 3 AND {i} % 100 = 0 THEN NULL ELSE id + {i} END AS m{i}" for i in range(600)], "id AS `*`")
    got = rows(conserve.cell_differences(a, b, ["k"]))
    assert got == sorted([("*", 20, 0), *[(f"m{i}", 20, int(i % 100 == 0)) for i in range(600)]], key=str)
    assert [n for n, _ in made] == [8, 2]
    for _, df in made:
        stages = spark._jvm.org.apache.spark.sql.execution.debug.__getattr__("package").codegenStringSeq(df._jdf.queryExecution().executedPlan())
        assert max([0, *(len(stages.apply(i)._2()) for i in range(stages.size()))]) < 100_000


def test_sums_kept(spark):
    a = spark.createDataFrame([("x", 1.0), ("x", 2.0), ("y", None)], "g string, m double")
    assert all(r.passed for r in conserve.sums_kept(a, a, "g", {"m": 0}).collect())
    assert not all(r.passed for r in conserve.sums_kept(a, a.where("m <> 2 OR m IS NULL"), "g", {"m": 0.011}).collect())


def test_scoped_labels_and_join(spark):
    lab = spark.createDataFrame([("v", 2004, "1", "Yes"), ("v", 2005, "1", "Included"), ("v", 2007, "1", "Yes")], "v string, y int, c string, l string")
    assert rows(metadata.scoped_labels(lab, "v", "y", "c", "l")) == [("v", "1", "2004,2007: Yes; 2005: Included")]
    with pytest.raises(ValueError):
        metadata.scoped_labels(lab.union(spark.createDataFrame([("v", 2004, "1", "No")], lab.schema)), "v", "y", "c", "l")
    a = spark.createDataFrame([("s", "n", "1"), ("s", "n", None)], "scope string, varname string, varnumber string")
    b = spark.createDataFrame([("s", "n", "2", "c1"), ("s", "n", "", "c2")], "scope string, varname string, varnumber string, code string")
    assert rows(metadata.scoped_join(a, b, ["scope"]), "varnumber", "code") == [("1", "c2"), (None, "c1"), (None, "c2")]


def test_codebook(spark):
    df = spark.createDataFrame([(1, 2.0, "observed")], "unitid long, grant__x double, grant__x__status string")
    book = metadata.codebook(df)
    assert [b["role"] for b in book] == ["attribute", "measure", "companion"]
    metadata.check_codebook(book, df.columns)
    with pytest.raises(ValueError):
        metadata.check_codebook(book[:2], df.columns)
    assert metadata.with_metadata(df, book).schema["grant__x"].metadata["role"] == "measure"


def test_dispositions_block_all(spark):
    r = spark.createDataFrame([(1, 2005, "a", 1, True), (1, 2005, "a", 2, True), (1, 2005, "b", 3, True), (2, 2005, "a", 4, False), (None, 2005, "a", 5, True), (3, 2005, "a", 6, True), (3, 2005, "a", 7, True)], "unitid long, award_year_start int, family string, id int, ok boolean")
    d = family_panel.dispositions(r, F.col("ok"), F.when(F.col("id") == 7, "excluded_official_membership_overlap"))
    got = dict(rows(d, "id", "record_disposition"))
    many = family_panel.MULTIPLE
    assert got == {1: many, 2: many, 3: family_panel.INCLUDED, 4: family_panel.UNRESOLVED, 5: family_panel.UNRESOLVED, 6: many, 7: many}


def test_unit_panel_statuses(spark):
    r = spark.createDataFrame([(1, 2005, "a", 10.0, "observed", True), (2, 2005, "b", None, "suppressed_lt10", True), (2, 2006, "b", 1.0, "observed", True), (2, 2006, "b", 2.0, "observed", True)], "unitid long, award_year_start int, family string, m double, m__status string, ok boolean")
    d = family_panel.dispositions(r, F.col("ok"))
    reports = spark.createDataFrame([("a", 2005), ("b", 2005), ("b", 2006)], "family string, award_year_start int")
    headers = spark.createDataFrame([("a", 2005, "m"), ("b", 2006, "m")], "family string, award_year_start int, measure string")
    p = family_panel.unit_panel(d, ["a", "b"], ["m"], reports, headers)
    got = {(x.unitid, x.award_year_start): (x["a__m"], x["a__m__status"], x["b__m"], x["b__m__status"], x.included_source_family_count, x.blocked_source_family_count) for x in p.collect()}
    assert got[(1, 2005)] == (10.0, "observed", None, "unavailable_in_schema", 1, 0)
    assert got[(2, 2005)] == (None, "absent_source_record", None, "suppressed_lt10", 1, 0)
    assert got[(2, 2006)] == (None, "report_not_available", None, family_panel.MULTIPLE, 0, 1)


def test_orphans_and_decisions(spark):
    o = spark.createDataFrame([(1, 2005), (2, 2005)], "unitid long, award_year_start int")
    m = spark.createDataFrame([(1, 2005, "primary_match"), (2, 2005, "parent_reference")], "unitid long, award_year_start int, relation_type string")
    assert rows(family_panel.guard_orphans(o, m), "unitid", "guard") == [(1, "excluded_official_membership_overlap"), (2, None)]
    q = spark.createDataFrame([("g", "2005", "f", "2", "tok")], "family string, award_year string, filename string, source_excel_row string, raw string")
    dec = spark.createDataFrame([("g", "2005", "f", "2", "tok", "r1")], "family string, award_year string, filename string, source_excel_row string, expected string, resolution_id string")
    assert family_panel.bind_decisions(q, dec, [("raw", "expected")]).count() == 1
    with pytest.raises(ValueError):
        family_panel.bind_decisions(q.withColumn("raw", F.lit("changed")), dec, [("raw", "expected")])


def _directory(spark, data):
    cols = "ipeds_year int, unitid long, opeid8 string, instnm string, stabbr string, sector string, cyactive string, opeflag string, act string, newid string, deathyr string, closedat string, prch_f string, idx_f string, prch_sfa string, idx_sfa string, ipeds_flags_available boolean"
    return spark.createDataFrame([(y, u, o, "Name", st, sec, cy, "1", "A", "-2", "-2", "-2", "-2", "-2", "-2", "-2", True) for y, u, o, st, sec, cy in data], cols)


def test_base_match_ladder(spark):
    d = _directory(spark, [(2005, 1, "00100200", "NY", "1", "1"), (2006, 1, "00100200", "NY", "1", "1"), (2005, 2, "00100300", "NY", "0", "1"), (2005, 3, "00100400", "NY", "1", "3"), (2005, 4, "00100500", "NY", "1", "1"), (2005, 5, "00100500", "NY", "1", "1")])
    p = spark.createDataFrame([("00100200", "2005-2006"), ("00100300", "2005-06"), ("00100400", "2005"), ("00100500", "2005-2006"), ("00999900", "2005-2006"), ("00100200", "2030-2031")], "opeid8 string, award_year string")
    b = linkage.base_match(p, d)
    got = {(r.opeid8, r.award_year[:4]): (r.ipeds_match_status, r.unitid, r.anchor_sensitivity) for r in b.collect()}
    assert got[("00100200", "2005")] == ("exact_unique", 1, "stable_unique")
    assert got[("00100300", "2005")][:2] == ("exact_unique_administrative_unit", None)
    assert got[("00100400", "2005")][:2] == ("exact_unique_inactive", None)
    assert got[("00100500", "2005")][:2] == ("multiple_exact_unitids", None)
    assert got[("00999900", "2005")][0] == "no_exact_match"
    assert got[("00100200", "2030")] == ("ipeds_year_unavailable", None, "year_unavailable")
    strict = b.where("opeid8 = '00100200' AND award_year = '2005-2006'").collect()[0]
    assert strict.strict_eligible, strict.strict_exclusion_reasons
    led = linkage.candidate_ledger(p.limit(1), d)
    assert led.where("candidate_kind = 'exact_opeid'").count() >= 1


def test_resolution_ladder(spark):
    d = _directory(spark, [(2005, u, o, st, sec, "1") for u, o, st, sec in ((101001, "00000100", "NY", "1"), (101002, "00000200", "NY", "1"), (101003, "00000300", "NY", "1"), (101004, "00000300", "NY", "1"), (101005, "00000500", "NY", "0"), (101006, "00000500", "NY", "1"), (101007, "00000700", "FC", "1"))])
    sheet = spark.createDataFrame(
        [(2005, "100", "101001", "", "-2", "1", "-2"), (2005, "200", "101009", "", "-2", "1", "-2"), (2005, "400", "101002", "", "-2", "1", "-2"), (2005, "500", "101006", "", "-2", "1", "-2"), (2005, "600", "101001 | 101002", "", "-2", "1", "-2"), (2005, "800", "101001 | 1", "", "-2", "1", "-2")],
        "cw_year int, opeid string, ipedsmatch string, addmatch string, ipedsmain string, source string, ipedsrpt string",
    )
    rel, rec = linkage.crosswalk(sheet)
    p = spark.createDataFrame([(f"00000{i}00", "2005-2006") for i in range(1, 10)], "opeid8 string, award_year string")
    desc = spark.createDataFrame([("00000700", "2005-2006", "Name", "NY", "Public"), ("00000100", "2005-2006", "Name", "NY", "Public")], "opeid8 string, award_year string, school string, state string, school_type string")
    r = linkage.resolve(linkage.base_match(p, d), d, rec, rel, desc)
    got = {x.opeid8[5]: (x.ipeds_resolution_status, x.unitid) for x in r.collect()}
    assert got == {
        "1": ("official_site_and_directory_agree", 101001), "2": ("directory_crosswalk_identity_conflict", None), "3": ("multiple_exact_directory_unitids", None),
        "4": ("official_site_alias_annual_unitid_verified", 101002), "5": ("official_site_and_directory_agree", 101006), "6": ("multiple_official_site_unitids", None),
        "7": ("fsa_ipeds_geography_identity_conflict", None), "8": ("crosswalk_site_parse_incomplete", None), "9": ("no_annual_site_match", None),
    }
    assert r.where("opeid8 = '00000100'").collect()[0].name_similarity == 1.0


def test_masters_and_diagnostics(spark):
    b = spark.createDataFrame([(1, 2005, "00000100", 5.0), (2, 2005, "-2", None), (3, 2005, None, None)], "UNITID long, year int, OPEID string, aid double")
    a = spark.createDataFrame([(1, 2005, 1, 0, "x"), (2, 2005, 0, 1, None), (9, 2005, 1, 0, None), (1, 2030, 1, 0, None)], "unitid long, award_year_start int, included_source_family_count int, blocked_source_family_count int, grant__opeid8 string")
    m = masters.master(b, a, 0)
    got = rows(m, "unitid", "merge_status", "has_usable_fsa_record", "has_blocked_fsa_family", "fsa_sfa_periods_aligned")
    assert got == [(1, "matched", True, False, False), (2, "matched", False, True, False), (3, "ipeds_only", None, None, None)]
    with pytest.raises(keys.KeyViolation):
        masters.master(b.union(b), a, 0)
    cov = diagnostics.coverage(b.select(F.col("UNITID").alias("unitid"), "year", F.col("OPEID").alias("opeid")), a, 0)
    y = cov.where("true")
    c = {r.year: r for r in diagnostics.year_counts(y).collect()}
    assert (c[2005].matched_rows, c[2005].matched_usable_family_rows, c[2005].matched_blocked_only_rows, c[2005].ipeds_only_rows, c[2005].fsa_only_rows) == (2, 1, 1, 1, 1)
    reasons = dict(rows(diagnostics.unmatched_right(cov), "year", "unmatched_reason"))
    assert reasons == {2005: "unitid_year_not_in_supplied_ipeds_universe", 2030: "year_not_in_supplied_ipeds_panel"}


def test_analysis_plan(spark):
    df = spark.createDataFrame([(1, 2001, 5, None, 7, None, "n"), (2, 2005, None, 6, None, 8, "n")], "k int, y int, a int, b int, old int, new int, note string")
    groups = [{"target": "ab", "sources": ["a", "b"], "method": "coalesce"}, {"target": "v", "sources": ["old", "new"], "method": "year_partition", "year_rules": [{"source": "old", "min": 2000, "max": 2003}, {"source": "new", "min": 2004, "max": 2009}]}]
    view = analysis.build(df, analysis.make_specs(df.columns, groups, dropped=("note",)), "y")
    assert view.columns == ["k", "y", "ab", "v"] and rows(view) == [(1, 2001, 5, 7), (2, 2005, 6, 8)]
    with pytest.raises(harmonise.ConflictError):
        analysis.make_specs(df.columns, [*groups, {"target": "z", "sources": ["a"], "method": "coalesce"}])
    bad = df.withColumn("b", F.lit(9))
    with pytest.raises(harmonise.ConflictError):
        analysis.build(bad, analysis.make_specs(df.columns, groups), "y")
    assert analysis.merged_labels([{1: "a"}, {1: "a", 2: "b"}]) == {1: "a", 2: "b"}
    assert analysis.merged_labels([{1: "a"}, {1: "b"}], strict=False) is None


def test_skew_lookup_equals_join(spark, monkeypatch):
    monkeypatch.setattr(skew, "HOT_ROWS", 50)
    left = spark.range(1000).select(F.col("id"), F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.col("id") % 40).alias("k"))
    right = spark.range(0, 45).select(F.col("id").alias("r"), (F.col("id") * 10).alias("v"))
    got = skew.lookup(left, right, [("k", "r")], {"v": "v"}, 1000)
    want = left.join(right, left.k == right.r, "left").select("id", "k", "v")
    assert rows(got, "id", "k", "v") == rows(want)


def test_skew_lookup_leaves_null_keys_where_they_are(spark):
    left = spark.range(0, 20_000, 1, 8).select("id", F.when(F.col("id") % 10 == 0, F.col("id")).alias("k"))  # nine tenths are null
    right = spark.range(0, 20_000, 10).select(F.col("id").alias("r"), F.lit(1).alias("v"))
    off = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in off}
    for k, v in off.items():
        spark.conf.set(k, v)
    try:
        for n in (20_000, 50_000):  # below and above the number from which hot keys are looked for
            got = skew.lookup(left, right, [("k", "r")], {"v": "v"}, n)
            sizes = [r[1] for r in got.groupBy(F.spark_partition_id()).count().collect()]
            assert sum(sizes) == 20_000 and max(sizes) < 3_000 and got.where("v IS NULL").count() == 18_000
        assert skew.lookup(left, right, [("k", "r")], {"v": "v"}, 50_000, "inner").count() == 2_000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_prefix_sum_over_buckets(spark):
    df = spark.range(500).select((F.col("id") % 2).alias("g"), F.col("id"), F.lit(2).alias("w"))
    got = skew.prefix_sum(df, ["g"], "id", "w", "before", spread=20)
    for g in (0, 1):
        assert sorted(r.before for r in got.where(F.col("g") == g).collect()) == list(range(0, 500, 2))


def test_scope_flags_need_all_four_columns(spark):
    d = _directory(spark, [(2005, 1, "00100200", "NY", "1", "1")])
    told = lambda df: df.select(scope.record_flags(df.columns, F.col("ipeds_year"))["flags_available"]).collect()[0][0]
    assert told(d) is True
    for c in ("prch_f", "idx_f", "prch_sfa", "idx_sfa", "ipeds_flags_available"):
        assert told(d.drop(c)) is False
    assert told(d.withColumn("prch_f", F.lit("9"))) is False and told(d.withColumn("idx_f", F.lit(None).cast("string"))) is False


def test_candidate_ledger_splits_hot_groups(spark, monkeypatch):
    d = _directory(spark, [(2005, u, "00100200" if u % 2 else "00100201", "NY", "1", "1") for u in range(1, 60)])
    p = spark.createDataFrame([("00100200", "2005-2006"), ("00100201", "2004-2005"), (None, "2005-2006")], "opeid8 string, award_year string")
    whole = rows(linkage.candidate_ledger(p, d))
    monkeypatch.setattr(skew, "HOT_ROWS", 7)
    assert rows(linkage.candidate_ledger(p, d)) == whole and len(whole) == 2 * 59


def test_residual_parts_are_disjoint(spark):
    def t(*pairs):
        return spark.createDataFrame(list(pairs), "period int, unitid long")

    got = linkage.residual(t((1, 1), (1, 2), (1, 3), (1, 4), (1, 5), (1, 5), (1, None)), t((1, 1)), t((1, 2), (1, 3), (2, 9)), t((1, 3), (1, 4), (1, 1)))
    assert dict((r.unitid, r.category) for r in got.collect()) == dict(zip((3, 2, 4, 5), linkage.GROUPS))
    assert linkage.residual(t((1, 1)).where("false"), t((1, 1)), t((1, 1)), t((1, 1))).count() == 0


def test_undocumented_codes_raise(spark):
    r = spark.createDataFrame([("1", "-2"), (None, None)], "cw_source_code string, cw_ipeds_reporting_code string")
    assert linkage.require_codes(r).count() == 2
    with pytest.raises(ValueError):
        linkage.require_codes(r.unionByName(spark.createDataFrame([("7", "1")], r.schema)))


def test_combined_families_are_blocked(spark):
    I, M, A = family_panel.INCLUDED, family_panel.MULTIPLE, family_panel.ABSENT
    p = spark.createDataFrame([(1, 2005, I, 1.0, I, 2.0), (2, 2005, I, 1.0, M, None), (3, 2012, I, 1.0, M, None), (4, 2005, I, 1.0, A, None), (5, 2005, A, None, A, None)], "unitid int, award_year_start int, d__unitid_record_status string, d__m double, f__unitid_record_status string, f__m double")
    out = family_panel.combined(p, "loan", "m", ["d", "f"], {"f": F.col("award_year_start") <= 2009})
    assert rows(out, "unitid", "loan__m", "loan__m__status") == [
        (1, 3.0, "complete_component_sum"), (2, None, family_panel.BLOCKED), (3, 1.0, "complete_direct_only_scope"), (4, None, "incomplete_component_sum"), (5, None, "no_observed_components"),
    ]


def test_joins_prove_that_cells_stay(spark):
    a = spark.createDataFrame([(1, "x"), (2, None)], "k int, v string")
    b = spark.createDataFrame([(1, 5)], "k int, w int")
    assert keys.counted_once(a, b, ["k"], ["v"]).count() == 2
    with pytest.raises(keys.KeyViolation):
        keys.counted_once(a, b.unionByName(b), ["k"], ["v"])


def test_audit_without_lineage(spark):
    d = spark.createDataFrame([(2005, "V", "1", "f", "t")], "year int, variable string, variable_id string, source_file string, access_table_name string")
    assert metadata.source_audit(d, None).collect()[0].source_metadata_status == "lineage_unavailable"


def test_crosswalk_sensitivity_and_memberships(spark):
    sheet = [(2005, "1", "100001", "", "", "", ""), (2006, "1", "100001", "", "", "", ""), (2005, "2", "100002", "100003", "", "", ""), (2006, "2", "100002", "", "", "", ""), (2005, "3", "100004", "", "", "", ""), (2005, "4", "100005", "", "", "", ""), (2006, "4", "100006", "", "", "", ""), (2005, "5", "No match", "", "", "", ""), (2006, "5", "No match", "", "", "", ""), (2005, "6", "100007 | 9", "", "", "", ""), (2006, "6", "100007", "", "", "", "")]
    rel, rec = linkage.crosswalk(spark.createDataFrame(sheet, "cw_year int, opeid string, ipedsmatch string, addmatch string, ipedsmain string, source string, ipedsrpt string"))
    p = spark.createDataFrame([(f"0000000{k}", "2005-2006") for k in range(1, 8)] + [(None, None)], "opeid8 string, award_year string")
    got = {r.opeid8: r.crosswalk_anchor_sensitivity for r in linkage.crosswalk_sensitivity(p, rec, rel).collect()}
    conflict = "scope_or_identity_conflict"
    assert got == {"00000001": "stable_unique", "00000002": conflict, "00000003": "year_unavailable", "00000004": conflict, "00000005": "ambiguous_or_unmatched", "00000006": conflict, "00000007": "year_unavailable", None: "year_unavailable"}
    d = _directory(spark, [(2005, 100001, "00000001", "NY", "1", "1"), (2005, 100009, "00000001", "NY", "1", "1")])
    resolved = spark.createDataFrame([("00000001", "2005-2006", 2005), ("00000002", "2005-2006", 2005)], "opeid8 string, award_year string, ipeds_year int")
    m = linkage.memberships(resolved, d, rel)
    assert rows(m, "opeid8", "unitid", "relation_type") == [
        ("00000001", 100001, "directory_opeid"), ("00000001", 100001, "primary_match"), ("00000001", 100009, "directory_opeid"), ("00000002", 100002, "primary_match"), ("00000002", 100003, "additional_match"),
    ]
    gone = spark.createDataFrame([("00000001", "2005-2006", 100009)], "opeid8 string, award_year string, unitid long")
    assert linkage.represented(m, gone).count() == 4


def test_screened_samples(spark):
    left = spark.createDataFrame([(1, 2008, 5.0, "p", True, True), (2, 2008, 5.0, "p", True, False), (3, 2008, 5.0, "p", False, True)], "unitid long, year int, a double, population string, ok boolean, clear boolean")
    right = spark.createDataFrame([(u, 2008, 5.0, "observed", "included_unique_family_record") for u in (1, 2, 3)], "unitid long, award_year_start int, b double, b__status string, record_status string")
    p = benchmark.pairs(left, right, "a", "b", [0], defined="ok", screened="clear")
    assert rows(p, "unitid", "valid_pair", "screened_pair") == [(1, True, True), (2, True, False), (3, False, False)]
    s = {(r["sample"], r.ipeds_year, r.reporting_population): r.comparable_rows for r in benchmark.summary(p, "population", [2008], [0]).collect()}
    assert s[("available_pairs", "all", "all")] == 2 and s[("scope_screened_available", "all", "all")] == 1 and s[("scope_screened_common_all_offsets", "2008", "all")] == 1
