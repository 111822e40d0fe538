"""Registered queries on small tables of their own, against results told by hand."""

from datetime import date, datetime

from panelwright.queries import general, linkage, panel
from tests.conftest import rows

T0 = datetime(2020, 1, 1)


# -- linkage ----------------------------------------------------------------------------
def linkage_tables(spark, folder):
    """Five units of one id and two of another, one unit alone and one whose field is cut short, in one year."""
    units = {"1": [100001, 100002, 100003, 100004, 100005], "2": [100006, 100007], "3": [100008], "4": [100040, 100041, 100042]}
    told = [(op, u) for op, us in units.items() for u in us] + [("1", 100003), ("3", 100008)]
    family = [(i, "grants", "2005-2006", op, u, "True", 1.0, "reported", "1", T0) for i, (op, u) in enumerate(told)]
    spark.createDataFrame(family, "record_id long, family string, award_year string, opeid8 string, unitid long, ipeds_annual_identity_eligible string, disbursements double, disbursements__status string, disbursements__raw_token string, loaded_at timestamp").write.parquet(f"{folder}/family_records.parquet")
    texts = [c for c in linkage.CODES if c not in ("opeid8", "ipeds_flags_available")]
    known = [(2005, u, op, True, "hd2005.csv", T0) for op, u in [("1", 100001), ("1", 100003), ("3", 100008), ("9", 100009)]]
    d = spark.createDataFrame(known, "ipeds_year int, unitid long, opeid8 string, ipeds_flags_available boolean, ipeds_source_member string, loaded_at timestamp")
    d.selectExpr("*", *[f"CAST(NULL AS STRING) AS {c}" for c in texts]).write.parquet(f"{folder}/ipeds_directory.parquet")
    return str(folder)


def test_crosswalk_keeps_every_unit(spark, tmp_path):
    d = linkage_tables(spark, tmp_path)
    got = rows(linkage.crosswalk_relations(spark, d), "cw_year", "relation_type", "n", "n_units")
    assert got == [(2005, "additional_match", 7, 7), (2005, "primary_match", 4, 4), (2005, "unparsed_site_match", 1, 0)]
    sites = rows(linkage.linkage_resolution(spark, d), "opeid8", "unitid", "ipeds_resolution_status", "crosswalk_site_count")
    assert sites == [
        ("00000001", None, "multiple_official_site_unitids", 5), ("00000002", None, "multiple_official_site_unitids", 2),
        ("00000003", 100008, "official_site_and_directory_agree", 1), ("00000004", None, "crosswalk_site_parse_incomplete", 3),
    ]
    told = rows(linkage.annual_reconciliation(spark, d), "ipeds_year", "directory_units", "crosswalk_units", "bridge_units", "directory_and_crosswalk", "directory_only", "unrepresented_with_crosswalk")
    assert told == [(2005, 4, 11, 1, 3, 1, 2)]


# -- panel ------------------------------------------------------------------------------
def test_year_scoped_labels_read_every_order(spark, tmp_path):
    told = [(7, 1995), (7, 1996), (10, 1996), (100, 1997), (1, 1998), (13, 1999), (13, 2001), (8, 1995), (8, 1998)]
    o = spark.createDataFrame([(k, date(y, 5, 1), "F") for k, y in told], "o_custkey long, o_orderdate date, o_orderstatus string")
    o.write.parquet(f"{tmp_path}/orders.parquet")
    got = rows(panel.year_scoped_labels(spark, str(tmp_path)))
    assert got == [(1, "F", "1995-1997: old; 1998-1999,2001: std"), (2, "F", "1995: old; 1998: std")]


# -- p2 ---------------------------------------------------------------------------------
def test_subtrees_below_loops_have_paths(spark, tmp_path):
    parent = {2: 1, 3: 2, 11: 12, 12: 11, 20: 11, 21: 20, 22: 20, 23: 22, 30: 12, 31: 30}  # 11 and 12 are a loop
    codes = [c for c in linkage.CODES if c not in ("opeid8", "ipeds_flags_available", "idx_sfa")]
    d = spark.createDataFrame([(2005, u, str(parent[u]) if u in parent else None, "hd2005.csv", T0) for u in sorted({1, *parent})], "ipeds_year int, unitid long, idx_sfa string, ipeds_source_member string, loaded_at timestamp")
    d.selectExpr("*", *[f"CAST(NULL AS STRING) AS {c}" for c in codes]).write.parquet(f"{tmp_path}/ipeds_directory.parquet")
    tree = {r.unitid: r for r in general.p2_tree(spark, str(tmp_path)).collect()}
    assert {u: (r.root_unitid, r.tree_depth, r.path, r.n_descendants) for u, r in tree.items()} == {
        1: (1, 0, "1", 2), 2: (1, 1, "1/2", 1), 3: (1, 2, "1/2/3", 0), 20: (11, -2, "20", 3), 21: (11, -2, "20/21", 0),
        22: (11, -2, "20/22", 1), 23: (11, -2, "20/22/23", 0), 30: (11, -2, "30", 1), 31: (11, -2, "30/31", 0),
    }
    pairs = {(1, 2), (1, 3), (2, 3), (20, 21), (20, 22), (20, 23), (22, 23), (30, 31)}
    inside = {(a, b) for a, x in tree.items() for b, y in tree.items() if x.root_unitid == y.root_unitid and x.first_position < y.first_position <= x.last_position}
    assert inside == pairs
    assert set(rows(general.p2_descendants(spark, str(tmp_path)), "unitid", "descendant")) == pairs


# -- p4 ---------------------------------------------------------------------------------
def test_profile_takes_every_column(spark, tmp_path):
    t = [datetime(2020, 1, k) for k in (1, 2, 3)]
    data = [(1, 1, 1, "L1", "matched", "True", 5.0, ["x"], t[0]), (1, 1, 1, "L1", "matched", "True", 5.0, ["x"], t[1]), (None, 1, 1, "L1", "matched", "True", 6.0, None, t[0]), (2, 1, 2, "L2", "matched", None, 5.0, ["y"], t[2])]
    schema = "panel_row_id long, feed_no long, load_seq int, load_id string, merge_status string, has_usable_fsa_record string, grant__pell_recipients double, extra array<string>, loaded_at timestamp"
    spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/master_panel.parquet")
    got = rows(general.p4_profile(spark, str(tmp_path)).where("field_name IN ('panel_row_id', 'extra', 'loaded_at')"), "load_id", "field_name", "n_rows", "n_null", "n_distinct", "min_value", "max_value")
    assert got == [
        ("L1", "extra", 2, 1, 1, '["x"]', '["x"]'), ("L1", "loaded_at", 2, 0, 2, "2020-01-01 00:00:00", "2020-01-02 00:00:00"), ("L1", "panel_row_id", 2, 1, 1, "1", "1"),
        ("L2", "extra", 1, 0, 1, '["y"]', '["y"]'), ("L2", "loaded_at", 1, 0, 1, "2020-01-03 00:00:00", "2020-01-03 00:00:00"), ("L2", "panel_row_id", 1, 0, 1, "2", "2"),
    ]
    shifts = {r.field_name: r.total_variation for r in general.p4_changes(spark, str(tmp_path)).where("load_id = 'L2'").collect()}
    assert set(shifts) == {"panel_row_id", "merge_status", "has_usable_fsa_record", "grant__pell_recipients", "extra", "loaded_at"}
    assert (shifts["loaded_at"], shifts["panel_row_id"], shifts["merge_status"]) == (1.0, 1.0, 0.0)
