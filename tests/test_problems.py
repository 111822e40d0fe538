"""Drifting schemas, hierarchies, history, profile and orphans against brute force on fixtures."""

import random
from collections import defaultdict
from datetime import datetime
from statistics import median

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelwright.operators import directory, drift, hierarchy, history, orphans, profile, skew
from tests.conftest import rows

T0 = datetime(2020, 1, 1)


# -- directory --------------------------------------------------------------------------
def test_current_records_prefer_revised(spark):
    d = spark.createDataFrame(
        [(2005, 1, "hd2005.csv", datetime(2021, 1, 1), "a"), (2005, 1, "hd2005_rv.csv", T0, "b"), (2005, 2, "hd2005.csv", T0, "c"), (2005, 2, "hd2005.csv", datetime(2020, 2, 1), "d"), (2005, 2, "hd2005.csv", T0, "c"), (None, 3, "x", T0, "e"), (2005, None, "x", T0, "f"), (2005, 4, None, None, None)],
        "ipeds_year int, unitid long, ipeds_source_member string, loaded_at timestamp, v string",
    )
    assert rows(directory.current_records(d, ["v"])) == [(2005, 1, "b"), (2005, 2, "d"), (2005, 4, None)]


# -- p3 ---------------------------------------------------------------------------------
def brute_versions(data):
    out, by = set(), defaultdict(dict)
    for u, y, *v in data:
        by[u][y] = tuple(v)
    for u, years in by.items():
        run = []
        for y in sorted(years):
            if run and run[-1] == y - 1 and years[y] == years[y - 1]:
                run.append(y)
            else:
                if run:
                    out.add((u, run[0], run[-1]))
                run = [y]
        if run:
            out.add((u, run[0], run[-1]))
    return out


def test_versions_brute_force(spark):
    r = random.Random(5)
    data = list({(u, y): (u, y, r.choice(["a", "b", None]), r.choice([None, "x"])) for u in range(40) for y in r.sample(range(2000, 2012), r.randint(1, 12))}.values())
    df = spark.createDataFrame(data, "u long, y int, p string, q string")
    got = history.versions(df, "u", "y", ["p", "q"])
    assert set(rows(got, "u", "valid_from", "valid_to")) == brute_versions(data)
    assert got.where("n_periods <> valid_to - valid_from + 1").count() == 0


def test_versions_nulls_and_empty(spark):
    df = spark.createDataFrame([(None, 2000, "a"), (1, None, "a"), (1, 2001, None), (1, 2002, None)], "u long, y int, p string")
    assert rows(history.versions(df, "u", "y", ["p"]), "u", "valid_from", "valid_to", "p") == [(1, 2001, 2002, None)]
    assert history.versions(df.where("false"), "u", "y", ["p"]).count() == 0
    twice = df.withColumn("extra", F.lit(1)).withColumn("valid_from", F.lit(0))
    assert history.versions(twice, "u", "y", ["p"]).count() == 1


# -- p2 ---------------------------------------------------------------------------------
def brute_tree(parent):
    out = {}
    nodes = set(parent) | set(parent.values())
    for n in nodes:
        path, x = [], n
        while x in parent and x not in path:
            path.append(x)
            x = parent[x]
        if x in path:
            ring = path[path.index(x) :]
            out[n] = (min(ring), -1 if n in ring else -2, None)
        else:
            out[n] = (x, len(path), [*path, x][::-1])
    return out


def solve(spark, parent):
    nodes = set(parent) | set(parent.values())
    df = spark.createDataFrame([("c", 2000, n, parent.get(n)) for n in nodes], "component string, ipeds_year int, unitid long, parent long")
    trees, rings, total = hierarchy.hierarchy(df, positions=True)
    got = {r.unitid: (r.root_unitid, r.tree_depth) for r in trees.collect()}
    got |= {r.unitid: (r.loop_root, -1 if r.on_loop else -2) for r in rings.collect()}
    paths = {r.unitid: r.path for r in hierarchy.paths(trees, total).collect()}
    spans = {r.unitid: (r.root_unitid, r.first_position, r.last_position) for r in trees.collect()}
    return got, paths, spans


def check(spark, parent):
    want = brute_tree(parent)
    got, paths, spans = solve(spark, parent)
    assert got == {n: v[:2] for n, v in want.items()}
    assert paths == {n: v[2] for n, v in want.items() if v[2]}
    below = defaultdict(set)
    for n, p in paths.items():
        for a in p[:-1]:
            below[a].add(n)
    for n, (root, a, b) in spans.items():
        inside = {m for m, (r, x, _) in spans.items() if r == root and a < x <= b}
        assert inside == below[n], n


@pytest.mark.parametrize("seed", range(3))
def test_hierarchy_brute_force(spark, seed):
    r = random.Random(seed)
    parent = {}
    for n in range(2, 60):
        if r.random() < 0.85:
            parent[n] = r.randrange(1, n)
    for a, b, c in ((101, 102, 103), (201, 202, 201)):
        parent |= {a: b, b: c, c: a} if c != a else {a: b, b: a}
    parent |= {301: 101, 302: 301, 303: 202}
    check(spark, parent)


def test_hierarchy_chain_star_and_long_loop(spark):
    check(spark, {n: n - 1 for n in range(2, 70)})
    check(spark, {n: 1 for n in range(2, 70)})
    ring = {n: n % 37 + 1 for n in range(1, 38)}
    check(spark, ring | {100: 5, 101: 100})


def test_links_rules(spark):
    d = spark.createDataFrame([(2000, 1, None, 1), (2000, 2, 1, 9), (2000, 3, 2, None), (2001, 2, 1, None)], "ipeds_year int, unitid long, a long, b long")
    got = rows(hierarchy.links(d, {"x": "a", "y": "b"}))
    assert got == [("x", 2000, 1, None), ("x", 2000, 2, 1), ("x", 2000, 3, 2)]
    assert hierarchy.links(d.where("false"), {"x": "a"}).count() == 0


def test_hierarchy_empty(spark):
    df = spark.createDataFrame([], "component string, ipeds_year int, unitid long, parent long")
    trees, rings, _ = hierarchy.hierarchy(df)
    assert trees.count() == 0 and rings.count() == 0


# -- p5 ---------------------------------------------------------------------------------
def test_orphans_brute_force(spark, monkeypatch):
    monkeypatch.setattr(skew, "HOT_ROWS", 20)
    r = random.Random(2)
    have = {(u, y) for u in range(30) for y in r.sample(range(2000, 2010), 5)}
    d = spark.createDataFrame(sorted(have), "unitid long, ipeds_year int")
    there = min(have)  # a third of the references name a key that is lost, a third one that exists
    data = [(i, 2001, 999) if i % 3 == 0 else (i, there[1], there[0]) if i % 3 == 1 else (i, r.randint(1999, 2011), r.choice([None, *range(35)])) for i in range(300)]
    refs = orphans.references(spark.createDataFrame(data, "id long, y int, ref long"), "t", "id", "y", ["ref"])
    counts = orphans.counted(refs)
    lost = orphans.orphan_keys(counts, d)

    def kind(u, y):
        ys = [b for a, b in have if a == u]
        return "never" if not ys else "not_yet" if min(ys) > y else "gone" if max(ys) < y else "gap"

    want = sorted((i, u, y, kind(u, y)) for i, y, u in data if u is not None and (u, y) not in have)
    got = orphans.orphan_rows(refs, counts, lost)
    assert sorted(map(tuple, got.select("record_key", "ref_unitid", "ref_year", "kind").collect())) == want
    assert sum(x.n_references for x in orphans.summary(counts, lost).collect()) == len(want)
    none = refs.where("false")
    nothing = orphans.counted(none)
    assert orphans.orphan_rows(none, nothing, orphans.orphan_keys(nothing, d)).count() == 0
    everything = orphans.orphan_keys(counts, d.where("false"))
    assert everything.where("kind <> 'never'").count() == 0


# -- p4 ---------------------------------------------------------------------------------
RULES = {"s": profile.Rule(allowed=("a", "b")), "n": profile.Rule(whole=True)}


def test_profile_and_findings(spark):
    nan = float("nan")
    data = []
    data += [(1, 1, "L1", "a", 10.0)] * 5 + [(1, 1, "L1", "b", 20.0)] * 5
    data += [(1, 2, "L2", "a", 10.0)] * 9 + [(1, 2, "L2", "a ", nan)]
    data += [(1, 3, "L3", None, 300.0)] * 5 + [(1, 3, "L3", "b", 9000.0)] * 5
    data += [(2, 1, "M1", None, None)]
    df = spark.createDataFrame([(i, *x, T0) for i, x in enumerate(data)], "id long, feed_no long, load_seq int, load_id string, s string, n double, loaded_at timestamp")
    f = profile.frequencies(profile.deduplicated(df.union(df), "id", [*profile.LOAD, "s", "n"]), ["s", "n"])
    p = {(r.load_id, r.field_name): r for r in profile.profile(f, RULES).collect()}
    assert p[("L2", "n")].n_nan == 1 and p[("L2", "n")].n_violations == 1 and p[("L2", "n")].n_null == 0 and p[("L1", "n")].n_rows == 10
    got = set(rows(profile.findings(profile.compared(f, RULES), RULES)))
    assert got == {("L2", "s", "pattern"), ("L2", "n", "pattern"), ("L2", "s", "distribution"), ("L3", "s", "constant"), ("L3", "s", "null_rate"), ("L3", "s", "distribution"), ("L3", "n", "distribution"), ("L3", "n", "value_range")}


def test_findings_of_one_value_and_empty(spark):
    df = spark.createDataFrame([(1, 1, 1, "L1", "a", 5.0, T0)], "id long, feed_no long, load_seq int, load_id string, s string, n double, loaded_at timestamp")
    f = profile.frequencies(df, ["s", "n"])
    assert set(rows(profile.findings(profile.compared(f, RULES), RULES))) == {("L1", "s", "constant"), ("L1", "n", "constant")}
    e = profile.frequencies(df.where("false"), ["s", "n"])
    assert profile.findings(profile.compared(e, RULES), RULES).count() == 0


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.floats(allow_nan=True, allow_infinity=False, width=32), st.integers(-5, 10**6).map(float)), min_size=1, max_size=60))
def test_median_is_exact(spark, values):
    df = spark.createDataFrame([(1, 1, "L", v) for v in values], "feed_no long, load_seq int, load_id string, n double")
    whole = [v for v in values if v is not None and v == v and v >= 0 and v == int(v)]
    got = [r.median_whole for r in profile.medians(profile.frequencies(df, ["n"])).collect()]
    assert got == ([median(whole)] if whole else [])


def test_deduplicated_keeps_rows_without_key(spark):
    df = spark.createDataFrame([(1, "a", T0), (1, "b", datetime(2021, 1, 1)), (None, "c", T0), (None, "c", T0), (None, "d", T0)], "id long, v string, loaded_at timestamp")
    assert rows(profile.deduplicated(df, "id", ["v"])) == [(1, "b"), (None, "c"), (None, "d")]


# -- p1 ---------------------------------------------------------------------------------
def _files(spark, files):
    """files: {(series, label): (sheets by header, payloads)}"""
    schema, raw = [], []
    for (s, y), (sheets, payloads) in files.items():
        schema += [(s, y, h, sh) for h, sh in sheets.items()]
        raw += [(len(raw) + i, s, "fam", y, f"{s}_{y}.csv", i, p, T0) for i, p in enumerate(payloads)]
    a = spark.createDataFrame(schema, "series_id string, award_year string, source_column string, sheet string")
    b = spark.createDataFrame(raw, "report_row_id long, series_id string, family string, award_year string, filename string, source_excel_row int, payload string, loaded_at timestamp")
    return a, b


def _solve(spark, files):
    a, b = _files(spark, files)
    reports = drift.read(b)
    columns = drift.listing(a, drift.column_facts(reports))
    named = drift.fields(columns, drift.renames(columns, reports))
    return reports, columns, named, drift.changes(columns, named)


def _payload(i, **more):
    import json

    return json.dumps({"OPEID": f"0{100100 + i * 100}0", **more})


def test_drift_finds_each_kind(spark):
    first = [_payload(i, School=f"n{i}", Pell_Recip=100 + i, Amount=1.5 + i, Flag=True, Gone="x") for i in range(6)]
    second = [_payload(i, school=f"n{i}", **{"recipients pell": 104 + i, "Amount": f"${2 + i}.00", "Flag": "Y" if i else "N", "Fresh": i}) for i in range(6)]
    files = {
        ("A", "2004-2005"): ({"OPEID": "S", "School ": "S", "Pell_Recip": "S", "Amount": "S", "Flag": "S", "Gone": "S"}, first),
        ("A", "2006–2007"): ({"OPEID": "s", " school": "S ", "recipients  Pell": "Other", "Amount": "S", "Flag": "Other", "Fresh": "S"}, second),
    }
    _, _, _, changes = _solve(spark, files)
    assert set(rows(changes)) == {
        ("A", 2006, "renamed", "recipients pell", "pell_recip"), ("A", 2006, "moved", "recipients pell", "pell_recip"), ("A", 2006, "retyped", "amount", "amount"),
        ("A", 2006, "retyped", "flag", "flag"), ("A", 2006, "moved", "flag", "flag"), ("A", 2006, "added", "fresh", ""), ("A", 2006, "removed", "", "gone"),
    }


def test_drift_similar_names_are_not_one_field(spark):
    a = [_payload(i, seog_amount=1000.0 * (i + 1)) for i in range(6)]
    b = [_payload(i, seog_amounts=7 - i) for i in range(6)]
    files = {("A", "2004"): ({"OPEID": "S", "seog_amount": "S"}, a), ("A", "2005"): ({"OPEID": "S", "seog_amounts": "S"}, b)}
    _, _, _, changes = _solve(spark, files)
    assert {r[2] for r in rows(changes)} == {"added", "removed"}


def test_drift_unified_keeps_every_row_and_cell(spark):
    a = [_payload(i, School=f"n{i}", Pell_Recip=100 + i) for i in range(4)]
    b = [_payload(i, Inst=f"n{i}", Pell_Recip=str(100 + i), Odd=[1, 2]) for i in range(4)]
    files = {("A", "2004"): ({"OPEID": "S", "School": "S", "Pell_Recip": "S"}, a), ("A", "2005"): ({"OPEID": "S", "Inst": "S", "Pell_Recip": "S", "Odd": "S"}, [*b, None, "no json", "{}"])}
    reports, columns, named, _ = _solve(spark, files)
    u = drift.unified(reports, named, drift.fuse(named))
    assert u.count() == 11 and u.columns[7:] == ["odd", "opeid", "pell_recip", "school", "other_fields"]
    names = [(r.school.canonical, r.pell_recip.tag, str(r.odd.integer_value)) for r in u.where("award_year_start = 2005 AND opeid IS NOT NULL").collect()]
    assert sorted(names) == [(f"n{i}", "string", "1") for i in range(4)]
    other = [(r.other_fields[0].header, r.other_fields[0].value.text if "text" in r.other_fields[0].value else r.other_fields[0].value.canonical) for r in u.where("size(other_fields) = 1").collect()]
    assert sorted(other) == [("$", "no json"), *[("odd[]", "2")] * 4]
    tags = {(r.field, r.tag): (r.n_cells, r.appeared) for r in drift.alternatives(columns, named).collect()}
    assert tags[("pell_recip", "integer")] == (4, False) and tags[("pell_recip", "string")] == (4, True)
    assert all(r.n_read == r.n_found for r in drift.cells_kept(reports, u).collect())


def test_drift_loses_no_cell(spark):
    """Headers that repeat in another spelling, rows without id, series or year, long integers, nested values, an id in two files."""
    import json

    text = json.dumps({"OPEID": "01001000", "Pell Recipients": 5, "pell  recipients": 7, "big": 99999999999999999999, "deep": {"a": {"b": 1.5}, "c": [True, {"d": "x"}], "e": {}}})
    raw = [
        (1, "A", "f", "2004", "a.csv", 1, text, T0), (1, "A", "f", "2004", "a.csv", 1, text, datetime(2021, 1, 1)), (None, "A", "f", "2004", "a.csv", 2, text, T0),
        (2, None, "f", "2004", "a.csv", 3, text, T0), (3, "A", "f", "unknown", "a.csv", 4, text, T0), (4, "A", "f", "2004", "a.csv", 5, "[1, 2]", T0),
        (5, "A", "f", "2004", "a.csv", 6, text, T0), (5, "A", "f", "2005", "b.csv", 6, text, datetime(2021, 1, 1)), (6, "A", "f", "2004", "a.csv", 7, None, T0),
    ]
    b = spark.createDataFrame(raw, "report_row_id long, series_id string, family string, award_year string, filename string, source_excel_row int, payload string, loaded_at timestamp")
    a = spark.createDataFrame([("A", "2004", "OPEID", "S")], "series_id string, award_year string, source_column string, sheet string")
    reports = drift.read(b)
    assert rows(reports, "report_row_id", "series_id", "year") == [(1, "A", 2004), (2, None, 2004), (3, "A", None), (4, "A", 2004), (5, "A", 2005), (6, "A", 2004), (None, "A", 2004)]
    columns = drift.listing(a, drift.column_facts(reports))
    named = drift.fields(columns, drift.renames(columns, reports))
    u = drift.unified(reports, named, drift.fuse(named))
    kept = {r.tag: (r.n_read, r.n_found) for r in drift.cells_kept(reports, u).collect()}
    assert kept == {"integer": (15, 15), "decimal": (5, 5), "boolean": (5, 5), "string": (16, 16)}
    got = u.where("report_row_id = 1").collect()[0]
    assert (str(got.big.integer_value), got.big.canonical, got.deep_a_b.decimal_value if "deep_a_b" in u.columns else got.a_b_deep.decimal_value) == ("99999999999999999999", "99999999999999999999", 1.5)
    assert got.pell_recipients.canonical == "5" and [(x.header, x.value.canonical) for x in got.other_fields] == [("pell recipients", "7")]
    assert len(u.where("report_row_id = 3").collect()[0].other_fields) == 8


def test_canonical_cells_are_exact(spark):
    cases = {"007": "7", "$1,200.50": "1200.5", "-0.0": "0", "1.": "1", "+3": "3", "-04.10": "-4.1", "1e3": "1000", "12345678901234567890123456789012345678901": "12345678901234567890123456789012345678901", "Yes": "1", "n/a": None, "New York, NY": "new york, ny", "0": "0"}
    df = spark.createDataFrame([(k,) for k in cases], "h string")
    assert {r[0]: r[1] for r in df.select("h", drift.canonical(F.col("h"))).collect()} == cases


def test_drift_splits_a_hot_file(spark, monkeypatch):
    monkeypatch.setattr(drift.skew, "hot_limit", lambda n: 10)
    a, b = _files(spark, {("A", "2004"): ({"OPEID": "S"}, [_payload(i) for i in range(200)]), ("B", "2004"): ({"OPEID": "S"}, [_payload(1)])})
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small partitions would be put together again
    try:
        read = drift.read(b.unionByName(b))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert read.count() == 201
    assert read.where("series_id = 'A'").groupBy(F.input_file_name()).count().agg(F.max("count")).collect()[0][0] < 150


def test_drift_empty(spark):
    a, b = _files(spark, {("A", "2004"): ({"OPEID": "S"}, [_payload(1)])})
    for x, y in ((a, b), (a.where("false"), b.where("false")), (a, b.where("false"))):
        reports = drift.read(y)
        columns = drift.listing(x, drift.column_facts(reports))
        named = drift.fields(columns, drift.renames(columns, reports))
        assert drift.changes(columns, named).count() == 0
        assert drift.unified(reports, named, drift.fuse(named)).count() == y.count()


def test_parallel_schemas_fuse_by_their_spellings(spark):
    data = [("A", "pell recip", 2004, "pell recip"), ("A", "pell recip", 2004, "campus__Pell_Students"), ("B", "x", 2004, "students pell_v2"), ("B", "y", 2004, "pellStudents (no.)"), ("C", "z", 2004, "other"), ("C", "q", 2004, "***")]
    df = spark.createDataFrame([(s, f, y, h.lower(), 2004) for s, f, y, h in data], "series_id string, field string, since int, header string, year int")
    got = {(r.series_id, r.field): r.column for r in drift.fuse(df).collect()}
    assert got[("A", "pell recip")] == got[("B", "x")] == got[("B", "y")] and got[("C", "z")] == "other" and got[("C", "q")] == "***"
