"""Scalar expressions against values known by hand."""

import math
from difflib import SequenceMatcher

import hashlib

import pytest
from pyspark.sql import functions as F

from panelwright.functions import clean, ids, labels, measures, names, scope, stats, text


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def apply(spark, values, f, kind="string"):
    return [r[0] for r in column(spark, values, kind).orderBy("i").select(f(F.col("v")).alias("r")).collect()]


def test_full_opeid(spark):
    good = apply(spark, ["100200", "100200.0", "100200.00", "00100200", " 100200 "], ids.full_opeid)
    assert good == ["00100200"] * 5
    bad = apply(spark, ["bad100200", "1002x00", "-2", "00000000", "100200.1", "100200000", None, "", "1e5", "True", "123456\n7"], ids.full_opeid)
    assert bad == [None] * 11


def test_full_match_refuses_a_line_end(spark):
    assert apply(spark, ["12345678\n9", "00100200\nx"], ids.full_opeid) == [None, None]


def test_award_year(spark):
    v = ["2010", "2010-11", "2010-2011", "2010–2011", "1999-00", "2010-2012", "2010-12", "abc", None, "20101"]
    assert apply(spark, v, ids.award_year_start) == [2010, 2010, 2010, 2010, 1999, None, None, None, None, None]


def test_opeid_format(spark):
    v = ["00100200", "001002A1", "-2", None, "00000000", "junk", " 00100200"]
    got = apply(spark, v, ids.opeid_format)
    assert got == ["numeric8_format_only_not_verified_match", "ipeds_alpha_reporting_branch_not_exact_fsa_id", "not_applicable", "source_missing"] + ["unrecognized_source_identifier"] * 3


def test_lossless_integer(spark):
    assert apply(spark, ["-2", "0", "1", "2", None, "01", "1.0", " 1", "+1", "-0"], ids.lossless_integer) == [-2, 0, 1, 2] + [None] * 6


def test_unit_tokens(spark):
    v = ["100663 | 100690", "100663 | 100", "No match", "100654,100663", None, "100663|100663.0"]
    got = [(r["units"], r["unparsed"], r["complete"]) for r in apply(spark, v, ids.unit_tokens)]
    assert got == [([100663, 100690], [], True), ([100663], ["100"], False), ([], [], True), ([], ["100654,100663"], False), ([], [], True), ([100663], [], True)]


def test_codes_and_dates(spark):
    assert apply(spark, ["1", "01", "1.0", " 1 ", "-2", ".", "", None, "X", "0.50", "100"], clean.code) == ["1"] * 4 + [None] * 4 + ["x", "0.5", "100"]
    dates = ["2010-12-07", "12/07/2010", "7-Dec-2010", "20101207", "2010-12-07 00:00:00", "Dec 7, 2010", "-2.0", None, "."]
    assert apply(spark, dates, clean.date_code) == ["2010-12-07"] * 6 + [None] * 3
    assert apply(spark, ["100357.0", " 100357", "100357.5", "-1", None, "x"], clean.code_id) == [100357, 100357, None, None, None, None]


def test_truth_and_labels(spark):
    assert apply(spark, ["True", "1", "FALSE", "0", "False ", "maybe", None], clean.truth) == [True, True, False, False, False, None, None]
    assert apply(spark, ["  A \t b C ", None], clean.label) == ["a b c", None]


def test_parse_measure(spark):
    def parse(v, count):
        return [(r["value"], r["status"], r["lower_bound"], r["upper_bound"]) for r in apply(spark, v, lambda c: measures.parse(c, count))]

    assert parse(["100.25", "0", "", None, "-", "<10", "1,234", "12,5O0"], False) == [
        (100.25, "observed", None, None), (0.0, "observed_zero", None, None), (None, "source_blank", None, None), (None, "source_blank", None, None),
        (None, "source_symbol", None, None), (None, "suppressed_lt10", 0.0, 9.0), (1234.0, "observed", None, None), (None, "invalid_numeric", None, None),
    ]
    assert [r[1] for r in parse(["2.5", "-3", "7"], True)] == ["invalid_fractional_count", "invalid_negative_count", "observed"]


def test_component_sum(spark):
    df = spark.createDataFrame([(1.0, 2.0, 2005), (1.0, None, 2005), (None, None, 2005), (1.0, None, 2012)], "a double, b double, y int")
    s = measures.component_sum([F.col("a"), F.col("b")], [F.lit(True), F.col("y") <= 2009])
    got = [(r["s"]["value"], r["s"]["status"], r["s"]["observed_partial_sum"]) for r in df.select(s.alias("s")).collect()]
    assert got == [(3.0, "complete_component_sum", 3.0), (None, "incomplete_component_sum", 1.0), (None, "no_observed_components", None), (1.0, "complete_direct_only_scope", 1.0)]


def test_scope(spark):
    df = spark.createDataFrame([("3", "100", 2010), ("6", "100", 2015), ("6", "100", 2016), ("-2", "-2", 2010), ("-2", "5", 2010), (None, "5", 2010), ("1", "-5", 2010)], "c string, p string, y int")
    got = [r[0] for r in df.select(scope.component_role(F.col("c"), F.col("p"), F.col("y"), True)).collect()]
    assert got == ["partial_child", "undocumented_code", "partial_parent_and_child", "no_parent_child_relation_reported", "parent_reference_without_role", "metadata_unavailable_or_invalid", "metadata_unavailable_or_invalid"]
    df = spark.createDataFrame([("FC", "x"), ("NY", "Foreign"), ("NY", None), ("PR", None), (None, None)], "s string, t string")
    got = [r[0] for r in df.select(scope.geography([F.col("s")], [F.col("t")])).collect()]
    assert got == ["foreign_explicit", "conflicting_geography", "us_states_dc", "territories_and_freely_associated_states", "unknown"]


def test_missing_reason_and_codes(spark):
    got = apply(spark, ["{Not applicable}", "Not reported", "Yes", "Not derived due to x", "item not available", None], lambda c: labels.missing_reason(F.lit("VAR"), F.lit("-1"), c))
    assert got == ["not_applicable", "not_reported", None, "not_derived", "not_available", None]
    assert apply(spark, ["Not applicable"], lambda c: labels.missing_reason(F.lit("PRCH_F"), F.lit("-2"), c)) == [None]
    assert apply(spark, ["-1", "-1.0", " -1.00 ", "-01", "1", None], lambda c: labels.matches_code(c, False, "-1")) == [True, True, True, False, False, False]
    assert apply(spark, [-1.0, 1.0, None], lambda c: labels.matches_code(c, True, "-1"), "double") == [True, False, False]
    assert apply(spark, ["SFA0809_P1", "SFA9900", "SFA0810", "x"], labels.reference_start) == [2008, 1999, None, None]


def test_names(spark):
    long = "loan_direct__subsidized_undergraduate_recipients__observed_partial_sum"
    made = names.of(spark, ["unitid", long, "if", "1st place!", "***"], names.STATISTICS)
    assert made["unitid"] == "unitid" and all(len(v) <= 32 for v in made.values())
    tail = {n: hashlib.sha256(n.encode()).hexdigest()[:10] for n in made}
    assert made[long] == f"dl_sub_ug_recips_part_{tail[long]}" and made["if"] == f"if_{tail['if']}"
    assert made["1st place!"] == f"v_1st_place_{tail['1st place!']}" and made["***"] == f"variable_{tail['***']}"
    assert names.of(spark, [long], names.STATISTICS)[long] == made[long]
    low = names.of(spark, ["Aid", "aid", "x", "Total Paid", "9th", "y" * 40], names.LOWER)
    assert low["x"] == "x" and low["Total Paid"] == "total_paid" and low["9th"] == "v_9th" and len(set(low.values())) == 6
    assert low["Aid"].startswith("aid_") and low["aid"].startswith("aid_") and len(low["y" * 40]) == 32
    with pytest.raises(ValueError):
        names.of(spark, ["a", "a"], names.LOWER)
    clash = names.portable(spark.createDataFrame([("a",), ("a",), ("b",)], "name string").distinct(), names.LOWER)
    assert names.clashes(clash).count() == 0
    assert list(names.aliases(spark, ["p", "q"], {"p": "n", "q": "n"}).values()) == ["n", "n_v2"]
    assert list(names.aliases(spark, ["p", "q", "r"], {"p": "n", "q": "n_v2", "r": "n"}).values()) == ["n", "n_v2", "n_v3"]
    assert names.status_code("observed", {"observed": 1}) == 1 and names.status_code("new", {}) >= 10_000
    assert names.case_clashes(["UNITID", "unitid", "x"]) == [("UNITID", "unitid")]


def test_stored_ids_are_checked(spark):
    df = spark.createDataFrame([("00123400",), ("-2",), (None,), ("123456A1",)], "opeid string")
    got = {r.opeid: (r.opeid__numeric8, r.opeid__format) for r in ids.opeid_views(df, "opeid").collect()}
    assert got["00123400"] == ("00123400", "numeric8_format_only_not_verified_match") and got[None] == (None, "source_missing")
    with pytest.raises(TypeError):
        ids.opeid_views(df.withColumn("opeid", F.lit(1)), "opeid")
    with pytest.raises(ValueError):
        ids.opeid_views(spark.createDataFrame([(" 00123400",)], "opeid string"), "opeid")


def test_text(spark):
    pairs = [("abc university", "abd university"), ("", "x"), (None, "x"), ("same", "same")]
    df = spark.createDataFrame(pairs, "a string, b string")
    got = [r[0] for r in df.select(text.name_similarity("a", "b")).collect()]
    assert got[0] == SequenceMatcher(None, *pairs[0]).ratio() and got[1:] == [None, None, 1.0]
    assert apply(spark, ["a", "é", "😀", None], text.utf16_units) == [1, 1, 2, None]
    assert apply(spark, ["aéb", "ab", None], lambda c: text.byte_excerpt(c, 2)) == ["a", "ab", None]
    assert apply(spark, ["😀😀", "a😀", "", "é" * 50_000], lambda c: text.byte_excerpt(c, 5)) == ["😀", "a😀", "", "éé"]
    assert apply(spark, ["é"], lambda c: text.byte_excerpt(c, 0)) == [""]
    assert apply(spark, [3.78, 3.779999999999998, 0.1 + 0.2], lambda c: text.fits_15_digits(c), "double") == [True, False, False]
    df = spark.createDataFrame([(1.0, math.nextafter(1.0, 2)), (1.0, 1.1)], "a double, b double")
    assert [r[0] for r in df.select(text.within_one_ulp("a", "b")).collect()] == [True, False]


def test_differences(spark):
    df = spark.createDataFrame([(10.0, 12.0, True), (0.0, 1.0, True), (1.0, 2.0, False)], "a double, b double, ok boolean")
    d = stats.differences(F.col("a"), F.col("b"), F.col("ok"))
    got = [tuple(r) for r in df.select(*[c.alias(k) for k, c in d.items()]).collect()]
    assert got == [(2.0, 2.0, 0.2, False), (1.0, 1.0, None, False), (None, None, None, None)]
