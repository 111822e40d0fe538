"""Sources and sinks: round trips, refusals, and files in odd encodings."""

import io
import json
import zipfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelwright.plans import release
from panelwright.sinks import bundle, store, tables, workbook
from panelwright.sources import datasource, files, remote, stata, tables as source_tables, xlsx
from panelwright.streaming import incremental
from tests.conftest import rows


def _zip(path, members):
    with zipfile.ZipFile(path, "w") as z:
        for name, text in members.items():
            z.writestr(name, text)


def test_decode_and_members():
    assert files.decode("é".encode("utf-8-sig"))[1] == "utf-8-sig" and files.decode(b"\xe9\x80")[1] == "cp1252" and files.decode(b"\x81")[1] == "latin1"
    assert files.preferred_member(["hd2010.csv", "HD2010_RV.csv"], "hd2010") == "HD2010_RV.csv"
    assert files.preferred_member(["x/hd2010.csv", "other.csv"], "hd2010") == "x/hd2010.csv"
    with pytest.raises(FileNotFoundError):
        files.preferred_member(["a.csv"], "hd2010")
    with pytest.raises(ValueError):
        files.preferred_member(["hd2010_rv.csv", "hd2010_r.csv"], "hd2010")
    assert files.final_releases(["a2010_prelim.xlsx", "a2010.xlsx", "b2011_prelim.xlsx"]) == {2010: "a2010.xlsx", 2011: "b2011_prelim.xlsx"}


def test_directory_loader(spark, tmp_path):
    _zip(tmp_path / "HD2010.zip", {"hd2010.csv": "UNITID,OPEID\n1,1\n", "hd2010_rv.csv": "UNITID, OPEID ,INSTNM\n101,100200,É\n102,-2,x\nbad,5,y\n103,junk,z\n"})
    _zip(tmp_path / "FLAGS2010.zip", {"flags2010.csv": "UNITID,PRCH_F,IDX_F,PRCH_SFA,IDX_SFA\n101,1,-2,-2,-2\n"})
    data, rejects, listed = source_tables.directory(spark, str(tmp_path), [2010, 2011])
    got = {r.unitid: (r.opeid8, r.prch_f, r.ipeds_flags_available, r.ipeds_source_member) for r in data.collect()}
    assert got == {101: ("00100200", "1", True, "hd2010_rv.csv"), 102: (None, None, False, "hd2010_rv.csv"), 103: (None, None, False, "hd2010_rv.csv")}
    assert sorted(r.unitid_text for r in rejects.collect()) == ["103", "bad"]
    assert [x["status"] for x in listed] == ["loaded", "missing_source"]
    _zip(tmp_path / "FLAGS2010.zip", {"flags2010.csv": "UNITID,PRCH_F\n101,1\n"})  # three of the four scope fields are not there
    assert not source_tables.directory(spark, str(tmp_path), [2010])[0].where("ipeds_flags_available").count()
    _zip(tmp_path / "HD2012.zip", {"hd2012.csv": "UNITID,OPEID,PRCH_F,IDX_F,PRCH_SFA,IDX_SFA\n104,100300,1,-2,-2,-2\n"})  # the directory holds them itself
    assert source_tables.directory(spark, str(tmp_path), [2012])[0].where("ipeds_flags_available").count() == 1


def test_workbook_round_trip(spark, tmp_path):
    path = str(tmp_path / "b.xlsx")
    data = [(1, "École\t東京", 0.1), (2, "=2+2", 123456789.12345679), (3, "", -0.125), (4, None, None), (5, "<a & b>\n", 3.779999999999998)]
    noted = workbook.write(path, ["k", "s", "x"], data, [{"canonical_name": "k"}], [], ["about"], ledger=True)
    assert {n["row"] for n in noted} == {3, 6} and xlsx.sheet_names(path) == ["Data", "Codebook", "ValueLabels", "README", "Exact"]
    back = workbook.restore(list(xlsx.records(path, "Data")), noted)
    assert [(int(r["k"]), r["s"], None if r["x"] is None else float(r["x"])) for r in back] == data
    datasource.register(spark)
    df = spark.read.format("xlsxsheet").option("sheet", "Data").load(path)
    assert df.count() == 5 and df.where("k = '3'").collect()[0].s == "" and df.where("k = '4'").collect()[0].s is None
    with pytest.raises(ValueError):
        workbook.write(path, ["x"], [(3.779999999999998,)], [], [], [])
    with pytest.raises(ValueError):
        list(xlsx.rows(path, "Nope"))
    bad = workbook.write(path, ["s"], [("a\x00b",), ("_x000A_",)], [], [], [], ledger=True)
    assert [n["kind"] for n in bad] == ["control_characters", "escape_sequence"] and json.loads(bad and '"a\\u0000b"') == bad[0]["exact"]


def test_workbooks_per_year(spark, tmp_path):
    df = spark.createDataFrame([(2005, 1.5, "a"), (2006, None, None)], "year int, x double, s string")
    got = workbook.per_year(df, "year", str(tmp_path), [], ["r"]).orderBy("year").collect()
    assert [(r.year, r.n_rows) for r in got] == [(2005, 1), (2006, 1)]
    assert next(iter(xlsx.records(got[0].path, "Data")))["s"] == "a"


def test_workbooks_keep_their_ledger(spark, tmp_path):
    odd = ["a\x00b", "_x000A_", "_x005F_x", "x" * 70_000, " =1+1 ", "tab\tline\n", "", None, "\ud800" if False else "é"]
    df = spark.createDataFrame([(2005, i, 0.1 + i / 3, 2**60 + i, s) for i, s in enumerate(odd)], "year int, k int, x double, n long, s string")
    got = workbook.per_year(df, "year", str(tmp_path), [], ["r"]).collect()[0]
    assert got.n_noted > len(odd) and got.n_unequal == 0
    exact = {(n["row"], n["column"]): n["exact"] for n in workbook.read_ledger(got.path)}
    assert exact[(5, "s")] == "x" * 70_000 and exact[(2, "n")] == str(2**60) and exact[(3, "s")] == "_x000A_"
    assert all("_x" not in str(r["exact"]) for r in xlsx.records(got.path, "Exact"))


def test_statistics_files_are_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "MODULE_CELLS", 3)
    with pytest.raises(ValueError):
        tables.stata(spark.range(5), str(tmp_path / "x.dta"), {})


def test_csv_tokens(spark, tmp_path):
    df = spark.createDataFrame([(1, None, "NA"), (2, "", ' "x"\n, '), (3, " b ", "é")], "k int, s string, t string")
    tables.token_csv(df, str(tmp_path / "c"))
    assert rows(source_tables.typed_csv(spark, str(tmp_path / "c"), df.schema)) == rows(df)
    with pytest.raises(ValueError):
        tables.token_csv(df.withColumn("s", F.lit(source_tables.NULL_TOKEN)), str(tmp_path / "d"))
    tables.report_csv(df.select("k"), str(tmp_path / "e"))
    assert source_tables.text_csv(spark, str(tmp_path / "e")).count() == 3


def test_stata(spark, tmp_path):
    path = str(tmp_path / "a.dta")
    df = spark.createDataFrame([(1, "x" * 200, 1.5, True), (2, None, None, False)], "k long, s string, x double, b boolean")
    assert tables.stata(df, path, {"s": "a label"}) == 2
    got = pd.concat(stata.chunks(path, 1, expect_rows=2))
    assert list(got.s) == ["x" * 200, ""] and stata.labels(path)[0]["s"] == "a label"
    with pytest.raises(ValueError):
        list(stata.chunks(path, 5, expect_rows=3))
    with pytest.raises(ValueError):
        tables.stata(df.withColumn("x", F.lit(float("inf"))), path, {})
    with pytest.raises(ValueError):
        tables.stata(df.withColumn("k", F.lit(2**60)), path, {})
    t = tables.topics([f"c{i}" for i in range(5000)], ["c0"], {"a": [f"c{i}" for i in range(1, 10)]})
    assert {c for v in t.values() for c in v} == {f"c{i}" for i in range(5000)} and all(len(v) <= 2048 for v in t.values())


def test_parquet_keeps_metadata(spark, tmp_path):
    df = spark.createDataFrame([(1, 2005)], "k int, year int")
    tables.labelled_parquet(df, str(tmp_path / "p"), [{"canonical_name": "k", "label": "key"}], "year", ["k"])
    back = source_tables.parquet(spark, str(tmp_path / "p"), ["k", "missing"], "year = 2005")
    assert back.schema["k"].metadata["label"] == "key" and back.columns == ["k"]


def test_release_and_bundle(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", None, 2005), (2, "", 1.5, 2006), (3, None, 0.1 + 0.2, 2005), (4, "_x000A_", 1e17, 2006)], "unitid long, s string, grant__x double, year int")
    listed = release.export(df, str(tmp_path / "r"), ["unitid"], {"about": "test"}, year="year", families={"grant": ["grant__x"]})
    have = {x.path for x in listed.collect()}
    assert {"manifest.json", "about.json", "workbooks/2005.xlsx", "workbooks/2006.xlsx", "statistics/grant.dta", "statistics/other.dta"} <= have
    told = spark.createDataFrame([r.asDict() for r in listed.collect()])
    store.verify(spark, str(tmp_path / "r"), told)
    (tmp_path / "r" / "load.py").write_text("changed")
    with pytest.raises(ValueError):
        store.verify(spark, str(tmp_path / "r"), told)
    with pytest.raises(FileExistsError):
        release.export(df, str(tmp_path / "r"), ["unitid"], {})
    with pytest.raises(ValueError):
        release.export(df.union(df), str(tmp_path / "q"), ["unitid"], {})
    with pytest.raises(ValueError):  # a text that is the null token fails after the folder was begun
        release.export(df.withColumn("s", F.lit(source_tables.NULL_TOKEN)), str(tmp_path / "q"), ["unitid"], {})
    assert not (tmp_path / "q").exists() and not list(tmp_path.glob("building*"))
    with pytest.raises(ValueError):
        bundle.require_separate(str(tmp_path / "r" / "x"), [str(tmp_path / "r")])
    for bad in ("/a", "../a", ""):
        with pytest.raises(ValueError):
            bundle.safe_relative(bad)
    f = tmp_path / "in.txt"
    f.write_text("1")
    ctx = bundle.context([str(f)], [], {"v": "1"})
    part = tmp_path / "part"
    part.mkdir()
    (part / "a").write_text("x")
    bundle.write_receipt(str(tmp_path / "receipt.json"), ctx, str(part))
    assert bundle.reusable(str(tmp_path / "receipt.json"), ctx, str(part))
    f.write_text("2")
    assert not bundle.reusable(str(tmp_path / "receipt.json"), bundle.context([str(f)], [], {"v": "1"}), str(part))
    bundle.write_json_gz({"b": 1, "a": "é"}, str(tmp_path / "m.gz"))
    first = (tmp_path / "m.gz").read_bytes()
    bundle.write_json_gz({"a": "é", "b": 1}, str(tmp_path / "m.gz"))
    assert (tmp_path / "m.gz").read_bytes() == first and files.read_json(str(tmp_path / "m.gz")) == {"a": "é", "b": 1}


def test_acquire(tmp_path):
    calls = []

    def fetch(url):
        calls.append(url)
        return (404, b"") if "new" in url else (200, b"data")

    got = remote.acquire_all({"a.zip": ["new", "old"]}, str(tmp_path), fetch)
    assert got[0]["status"] == "downloaded" and calls == ["new", "old"]
    assert remote.acquire("a.zip", ["new"], str(tmp_path))["status"] == "cached"
    (tmp_path / "a.zip").write_bytes(b"other")
    assert remote.acquire("a.zip", ["new"], str(tmp_path), fetch)["status"] == "failed"
    assert remote.acquire("b.zip", ["x"], str(tmp_path), lambda u: (500, b""))["status"] == "failed"


def test_zip_member_by_ranges():
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a.csv", "x" * 5000)
        z.writestr("b.csv", "hello")
    data, asked = buf.getvalue(), []

    def read(a, b):
        asked.append(b - a)
        return data[a:b]

    assert remote.zip_member(read, len(data), "b.csv") == b"hello"
    with pytest.raises(FileNotFoundError):
        remote.zip_member(read, len(data), "c.csv")


def test_streaming_refresh(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    schema = "k int, t int, v string"
    for i, data in enumerate([[(1, 1, "a"), (2, 1, "b")], [(1, 2, "c"), (1, 0, "late")]]):
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(src)
        incremental.refresh(spark.readStream.schema(schema).parquet(src), out, ["k"], ["t"], str(tmp_path / "ck")).awaitTermination()
    assert rows(incremental.latest(spark, out)) == [(1, 2, "c"), (2, 1, "b")]


def test_streaming_windows(spark, tmp_path):
    src = str(tmp_path / "src")
    spark.sql("SELECT * FROM VALUES (timestamp_ntz'2024-01-01 00:01:00','a'),(timestamp_ntz'2024-01-01 00:02:00','a'),(timestamp_ntz'2024-01-01 01:00:00','b') t(ts, e)").write.parquet(src)
    df = incremental.windowed_counts(spark.readStream.schema("ts timestamp_ntz, e string").parquet(src), "ts", ["e"], "10 minutes", "5 minutes")
    got = []
    incremental.run_once(df, "w", str(tmp_path / "ck"), "append", lambda b, n: got.extend((r.e, r.n) for r in b.collect()))
    assert ("a", 2) in got
