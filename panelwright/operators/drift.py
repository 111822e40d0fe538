"""Schemas that drift between files: tagged-union inference over report files.

A file is a series' report of one year.  Cells are variants, so each keeps its tag (integer,
decimal, boolean, string); nested objects and arrays are followed along their paths.

1. :func:`read` parses every payload once and writes the rows with their cells, clustered by
   file; everything else reads columns of that table.
2. :func:`column_facts` is the tagged union of each file's path: how often each tag occurs.
3. :func:`renames` fuses a path that goes with one that comes if the institutions of both
   files carry agreeing values under them.  Values meet values, never headers all headers.
4. :func:`fields` follows a path from file to file, through its renames; a field keeps every
   tag it ever had.  :func:`changes` and :func:`alternatives` are read from these fields.
5. :func:`fuse` fuses the fields of parallel series that share a spelling; the fused fields are
   the columns of :func:`unified`, each a union of typed branches with one canonical conversion.

Only header-level facts are joined with each other; cells are joined for headers that come or
go.  A file that holds a large share of all rows is split by hash of the row's id.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.functions import clean
from panelwright.operators import skew
from panelwright.operators.profile import deduplicated
from panelwright.session import cut, drop

FILE = ["series_id", "year"]
TAGS = ("integer", "decimal", "boolean", "string")
CELL = "array<struct<header:string,tag:string,text:string>>"
#: The path of a payload that is no JSON object; its text is kept as one cell.
WHOLE = "$"
#: Nested objects and arrays are followed this deep; what lies deeper stays whole as JSON text.
LEVELS = 3
#: Fused fields that become columns, most files first; cells of further ones are in ``other_fields``.
MAX_COLUMNS = 400

#: Marks that stand for a suppressed or missing cell.
SUPPRESSED = ("", "*", "-", ".", "n/a", "na", "<10", "< 10", "none", "null")

#: Share of institutions whose values must agree, how many must be comparable at least, and how far
#: two positive numbers of one institution may lie apart (as a logarithm) to agree.
AGREE, LEAST, NEAR = 0.6, 3, 0.35
#: Similarity of header words from which headers match where too few values can be compared.
ALIKE = 0.75


# -- cells ------------------------------------------------------------------------------
def canonical(text: Column) -> Column:
    """One spelling of a cell whatever its tag: numbers and truth values as exact plain decimals.

    Money signs and thousands separators go, as do zeros that say nothing; digits are never
    rounded.  True/yes/y are 1 and false/no/n are 0, suppression marks are null, other text
    is in lower case.
    """
    s = F.lower(clean.strip(text))
    bare = F.translate(s, "$,", "")
    number = r"\A(?:\+|-(?![\d.]*[1-9]))?(-?)0*(\d+)(?:\.0*|(\.\d*[1-9])0*)?\z"
    power = bare.rlike(r"\A[+-]?\d+(\.\d*)?e[+-]?\d+\z")
    return (
        F.when(s.isin(*SUPPRESSED), F.lit(None).cast("string"))
        .when(s.isin("true", "yes", "y"), "1")
        .when(s.isin("false", "no", "n"), "0")
        .when(bare.rlike(number), F.regexp_replace(bare, number, "$1$2$3"))
        .when(power, F.coalesce(F.regexp_replace(bare.try_cast("decimal(38,12)").cast("string"), number, "$1$2$3"), s))
        .otherwise(s)
    )


def tag_of(kind: Column) -> Column:
    """Tag of a variant's kind; null for a null cell.  A decimal without fraction of 19 digits or more is an integer."""
    return (
        F.when(kind == "BIGINT", "integer")
        .when(kind == "BOOLEAN", "boolean")
        .when(kind.startswith("DECIMAL("), F.when(kind.rlike(r"\ADECIMAL\((19|[23]\d),0\)"), "integer").otherwise("decimal"))
        .when(kind.isin("DOUBLE", "FLOAT"), "decimal")
        .when(kind == "VOID", F.lit(None).cast("string"))
        .otherwise("string")
    )


def _nested(kind: Column) -> Column:
    return kind.startswith("OBJECT<") & (kind != "OBJECT<>") | kind.startswith("ARRAY<") & (kind != "ARRAY<>") & (kind != "ARRAY<VOID>")


def _opened(entries: Column, levels: int) -> Column:
    """Path, kind and value of every cell of an array of (path, value), nested ones by their own paths."""
    shown = F.transform(entries, lambda e: F.struct(e["path"].alias("path"), F.schema_of_variant(e["value"]).alias("kind"), e["value"].alias("value")))
    if not levels:
        return shown

    def deeper(c: Column) -> Column:
        fields = F.map_entries(F.when(c["kind"].startswith("OBJECT<"), c["value"].cast("map<string,variant>")))
        under = F.transform(fields, lambda f: F.struct(F.concat(c["path"], F.lit("."), f["key"]).alias("path"), f["value"].alias("value")))
        items = F.transform(F.when(c["kind"].startswith("ARRAY<"), c["value"].cast("array<variant>")), lambda v: F.struct(F.concat(c["path"], F.lit("[]")).alias("path"), v.alias("value")))
        return _opened(F.coalesce(under, items), levels - 1)

    return F.flatten(F.transform(shown, lambda c: F.when(_nested(c["kind"]), deeper(c)).otherwise(F.array(c))))


def cells_of(payload: Column, levels: int = LEVELS) -> Column:
    """All cells of a payload as an array: header (a path), tag (null for a null cell) and text.

    A payload that is no JSON object is one cell under ``$`` with its text; null has no cells.
    """
    parsed = F.try_parse_json(payload)
    top = F.schema_of_variant(parsed).startswith("OBJECT<")
    entries = F.transform(F.map_entries(F.when(top, parsed.cast("map<string,variant>"))), lambda e: F.struct(e["key"].alias("path"), e["value"].alias("value")))
    told = F.transform(_opened(entries, levels), lambda c: F.struct(clean.label(c["path"]).alias("header"), tag_of(c["kind"]).alias("tag"), c["value"].cast("string").alias("text")))
    whole = F.array(F.struct(F.lit(WHOLE).alias("header"), F.lit("string").alias("tag"), payload.alias("text")))
    return F.when(payload.isNull(), F.array().cast(CELL)).otherwise(F.coalesce(told, whole)).cast(CELL)


def _once(rows: DataFrame) -> DataFrame:
    """Rows whose report_row_id lies in several files are settled first, so that the rest can be settled file by file."""
    known = rows.where("report_row_id IS NOT NULL").select("report_row_id", F.xxhash64(F.coalesce("series_id", F.lit("\0")), F.coalesce("year", F.lit(-1))).alias("f"))
    crossing = known.groupBy("report_row_id").agg(F.min("f").alias("a"), F.max("f").alias("b")).where("a <> b").select("report_row_id")
    if crossing.isEmpty():
        return rows
    crossing = cut(crossing)
    body = [c for c in rows.columns if c not in ("report_row_id", "loaded_at")]
    few = rows.join(crossing, "report_row_id", "left_semi")
    won = deduplicated(few, "report_row_id", [*body, "loaded_at"])
    return rows.join(crossing, "report_row_id", "left_anti").unionByName(won.select(*rows.columns))


def read(raw: DataFrame) -> DataFrame:
    """Report rows once per report_row_id with the start year and ``cells``, written clustered by file.

    Rows without report_row_id are kept, each distinct one; rows without series or readable
    year are kept with their cells, and belong to no file.  ``row_no`` tells rows apart.
    """
    columns = ["report_row_id", "series_id", "family", "award_year", "filename", "source_excel_row", "payload", "loaded_at"]
    rows = _once(raw.select(*columns).withColumn("year", clean.award_start(F.col("award_year"))))
    counts = rows.groupBy(*FILE).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).collect()[0]["n"]
    limit = skew.hot_limit(int(total))
    hot = counts.where((F.col("n") > limit) & F.col("series_id").isNotNull() & F.col("year").isNotNull()).select(*FILE, F.ceil(F.col("n") / limit).cast("int").alias("parts")).collect()  # at most MAX_HOT files
    spread = F.abs(F.xxhash64("report_row_id", F.when(F.col("report_row_id").isNull(), F.col("payload"))))
    alone = F.col("series_id").isNull() | F.col("year").isNull()
    if hot:
        wide = rows.sparkSession.createDataFrame(hot, "series_id string, year int, parts int")
        rows = rows.join(F.broadcast(wide), FILE, "left")
    else:
        rows = rows.withColumn("parts", F.lit(1))
    rows = rows.withColumn("part", F.when(alone, spread).otherwise(spread % F.coalesce("parts", F.lit(1)))).drop("parts")
    rows = rows.repartition(*FILE, "part")
    body = ["family", "award_year", "filename", "source_excel_row", "payload"]
    own = F.when(F.col("report_row_id").isNull(), F.xxhash64(*body, "loaded_at"))
    best = rows.groupBy(*FILE, "part", "report_row_id", own.alias("own")).agg(F.max(F.struct("loaded_at", F.struct(*body).alias("body")))["body"].alias("b"))
    told = best.select(*FILE, "report_row_id", "b.family", "b.award_year", "b.filename", "b.source_excel_row", cells_of(F.col("b.payload")).alias("cells"))
    return cut(told.withColumn("row_no", F.monotonically_increasing_id()))


def cells(rows: DataFrame) -> DataFrame:
    """One row per cell of rows that belong to a file."""
    known = rows.where("series_id IS NOT NULL AND year IS NOT NULL").select(*FILE, "row_no", F.explode("cells").alias("c"))
    return known.select(*FILE, "row_no", "c.header", "c.tag", "c.text").where(F.col("header") != WHOLE)


def _id_like(text: Column) -> Column:
    """Whether a cell looks like an eight-digit id of an institution, whose leading zeros may be lost."""
    n = F.when(text.rlike(r"\A\s*0{0,2}[1-9]\d{5,7}(\.0*)?\s*\z"), F.btrim(text).try_cast("double"))
    return F.coalesce((n < 100_000_000) & (n % 100 <= 20), F.lit(False))


def column_facts(rows: DataFrame) -> DataFrame:
    """The tagged union of each file's path: how many cells have each tag, and the tag of most (ties: the later by name).

    ``n_ids`` counts the cells that look like ids of institutions.
    """
    tags = {t: F.count(F.when(F.col("tag") == t, 1)) for t in TAGS}
    told = cells(rows).withColumn("id", _id_like(F.col("text")))
    facts = told.groupBy(*FILE, "header").agg(*[c.alias(f"n_{t}") for t, c in tags.items()], F.count_if("id").alias("n_ids"))
    ranked = F.array(*[F.struct(F.col(f"n_{t}").alias("n"), F.lit(t).alias("t")) for t in TAGS])
    return facts.withColumn("tag", F.when(F.array_max(ranked)["n"] > 0, F.array_max(ranked)["t"]))


def listing(schema: DataFrame, facts: DataFrame) -> DataFrame:
    """Columns of each file: header, sheets, tag counts, the files before and after it of the same series.

    A column listed or written is there; repeats in another spelling are one column.
    """
    listed = schema.select("series_id", clean.award_start(F.col("award_year")).alias("year"), clean.label(F.col("source_column")).alias("header"), clean.label(F.col("sheet")).alias("sheet"))
    counts = [*(f"n_{t}" for t in TAGS), "n_ids"]
    empty = {"sheet": F.lit(None).cast("string")}
    none = {c: F.lit(None).cast("bigint") for c in counts}
    both = listed.withColumns({**none, "tag": F.lit(None).cast("string")}).unionByName(facts.withColumns(empty).select(*FILE, "header", "sheet", *counts, "tag"))
    known = both.where("series_id IS NOT NULL AND year IS NOT NULL AND header IS NOT NULL AND header <> ''")
    columns = known.groupBy(*FILE, "header").agg(F.array_sort(F.collect_set("sheet")).alias("sheets"), F.max("tag").alias("tag"), *[F.coalesce(F.max(c), F.lit(0)).alias(c) for c in counts])
    w = Window.partitionBy("series_id").orderBy("year")
    files = columns.select(*FILE).distinct().withColumn("previous_year", F.lag("year").over(w)).withColumn("next_year", F.lead("year").over(w))
    return columns.join(files.hint("merge"), FILE)  # its size is unknown before it runs


# -- renames ----------------------------------------------------------------------------
def id_columns(files: DataFrame) -> DataFrame:
    """The header of each file that identifies institutions, of rows with ``cells`` and the headers ``ids`` that hold ids.

    One such header is the id.  Of several it is the one with the largest product of the
    shares of ids and of distinct values; ties go to the shorter, then the larger header.
    """
    one = files.where(F.size("ids") == 1).groupBy(*FILE).agg(F.max(F.col("ids")[0]).alias("id_header"))
    long = files.where(F.size("ids") > 1).select(*FILE, F.explode(F.filter("cells", lambda c: F.array_contains("ids", c["header"]))).alias("c"))
    known = long.select(*FILE, "c.header", _id_like(F.col("c.text")).alias("id"), canonical(F.col("c.text")).alias("canonical")).where("canonical IS NOT NULL")
    each = known.groupBy(*FILE, "header", "canonical").agg(F.count(F.lit(1)).alias("n"), F.count_if("id").alias("i"))
    facts = each.groupBy(*FILE, "header").agg(F.sum("n").alias("n"), F.sum("i").alias("i"), F.count(F.lit(1)).alias("d"))
    score = F.col("i") / F.col("n") * F.col("d") / F.col("n")
    best = facts.groupBy(*FILE).agg(F.max_by("header", F.struct(score.alias("s"), (-F.length("header")).alias("l"), F.col("header"))).alias("id_header"))
    return one.unionByName(best)


def words(h: Column) -> Column:
    """Words of a header in order of the alphabet, without a family prefix."""
    plain = F.regexp_replace(F.regexp_replace(h, r"\A[a-z]+(_[a-z]+)?__", ""), r"[^a-z0-9]+", " ")
    return F.array_join(F.array_sort(F.split(F.btrim(plain), " ")), "")


def _pairs(text: Column) -> Column:
    """Distinct pairs of neighbouring letters, or the whole text if it has fewer than four letters."""
    n = F.length(text)
    return F.when(n < 4, F.array(text)).otherwise(F.array_distinct(F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.substring(text, i, F.lit(2)))))


def _positive(v: Column) -> Column:
    """A canonical text as a number if it is one above zero; other text is never cast, as a failing cast is slow."""
    n = F.when(v.rlike(r"\A\d{1,300}(\.\d+)?\z"), v.try_cast("double"))
    return F.when(n > 0, n)


def _near() -> Column:
    """Whether ``v`` (``x`` as a positive number) and ``u`` (``y``) agree."""
    return F.when(F.col("x").isNotNull() & F.col("y").isNotNull(), F.abs(F.log(F.col("x") / F.col("y"))) < NEAR).otherwise(F.col("v") == F.col("u"))


def _agreeing(came: DataFrame, went: DataFrame) -> DataFrame:
    """(file, old, new): headers under which at least two institutions have agreeing values.

    Positive numbers meet in buckets of width NEAR of their logarithm or the bucket beside it;
    other values meet where they are equal.
    """
    at = F.floor(F.log("x") / NEAR)
    new = came.withColumns({"spot": F.coalesce(at, F.lit(0)), "same": F.when(F.col("x").isNull(), F.col("v")).otherwise("")})
    spot = F.floor(F.log("y") / NEAR)
    old = went.withColumns({"spot": F.explode(F.coalesce(F.array_compact(F.array(spot - 1, spot, spot + 1)), F.array())), "same": F.lit("")}).where("y IS NOT NULL")
    old = old.unionByName(went.where("y IS NULL").withColumns({"spot": F.lit(0).cast("bigint"), "same": F.col("u")}))
    met = new.join(old, ["series_id", "year", "previous_year", "unit", "spot", "same"]).where(_near())
    return met.groupBy("series_id", "year", "previous_year", "old", "new").agg(F.count(F.lit(1)).alias("n")).where("n >= 2").drop("n")


def renames(columns: DataFrame, rows: DataFrame) -> DataFrame:
    """(series_id, year, previous_year, previous_column, source_column): one field under two headers.

    Candidates are a header that went and one that came between two files whose institutions
    have agreeing values, or whose words are alike (they share a pair of letters, as words
    that are ALIKE must).  Evidence is the share of institutions in both files whose values
    agree; headers are matched one to one, best first on both sides.  Where fewer than LEAST
    institutions can be compared the likeness of the words decides.
    """
    cur = columns.where("previous_year IS NOT NULL").select("series_id", "year", "previous_year", "header")
    prev = columns.where("next_year IS NOT NULL").select("series_id", F.col("next_year").alias("year"), F.col("year").alias("previous_year"), "header")
    key = ["series_id", "year", "previous_year"]
    came = cur.join(prev, [*key, "header"], "left_anti")
    went = prev.join(cur, [*key, "header"], "left_anti")
    turned = cut(came.withColumn("new", F.lit(True)).unionByName(went.withColumn("new", F.lit(False))).withColumn("words", words(F.col("header"))))
    sides = turned.groupBy(*key).agg(F.bool_or("new").alias("a"), F.bool_or(~F.col("new")).alias("b")).where("a AND b").select(*key)
    turned = cut(turned.join(sides, key))
    came = turned.where("new").select(*key, F.col("header").alias("new"), F.col("words").alias("w"))
    went = turned.where("NOT new").select(*key, F.col("header").alias("old"), F.col("words").alias("z"))
    needed = turned.select("series_id", F.when(F.col("new"), F.col("year")).otherwise(F.col("previous_year")).alias("year"), "header").distinct()
    wanted = needed.groupBy(*FILE).agg(F.collect_set("header").alias("wanted"))
    per_file = cut(wanted.join(columns.where("n_ids > 0").groupBy(*FILE).agg(F.collect_set("header").alias("ids")), FILE))
    some = rows.select(*FILE, "cells").join(per_file, FILE)  # written, so that its true size decides whether it is broadcast
    named = some.join(cut(id_columns(some)), FILE)
    unit = F.get(F.filter("cells", lambda c: c["header"] == F.col("id_header")), F.lit(0))["text"]
    units = named.select(*FILE, canonical(unit).alias("unit"), F.explode(F.filter("cells", lambda c: c["tag"].isNotNull() & F.array_contains("wanted", c["header"]))).alias("c"))
    values = units.where("unit IS NOT NULL").select(*FILE, "unit", "c.header", canonical(F.col("c.text")).alias("canonical")).where("canonical IS NOT NULL")
    values = cut(values.groupBy(*FILE, "unit", "header").agg(F.max("canonical").alias("value")).withColumn("number", _positive(F.col("value"))))
    now = values.select("series_id", "year", F.col("header").alias("new"), "unit", F.col("value").alias("v"), F.col("number").alias("x"))
    then = values.select("series_id", F.col("year").alias("previous_year"), F.col("header").alias("old"), "unit", F.col("value").alias("u"), F.col("number").alias("y"))
    hits = _agreeing(came.join(now, ["series_id", "year", "new"]), went.join(then, ["series_id", "previous_year", "old"]))
    near = went.withColumn("pair", F.explode(_pairs(F.col("z")))).hint("merge")  # many rows for each that the optimiser knows of
    alike = came.withColumn("pair", F.explode(_pairs(F.col("w")))).join(near, [*key, "pair"])
    alike = alike.select(*key, "old", "new", "z", "w").distinct().where(_likeness() >= ALIKE)
    pairs = cut(hits.join(came, [*key, "new"]).join(went, [*key, "old"]).select(*key, "old", "new", "z", "w").unionByName(alike).distinct())
    measured = pairs.join(now, ["series_id", "year", "new"]).join(then, ["series_id", "previous_year", "old", "unit"])
    match = measured.groupBy(*key, "old", "new").agg(F.count(F.lit(1)).alias("n"), F.avg(_near().cast("int")).alias("share"))
    judged = pairs.join(match, [*key, "old", "new"], "left").withColumn("like", _likeness())
    enough = F.coalesce(F.col("n") >= LEAST, F.lit(False))
    kept = judged.where(F.when(enough, F.col("share") >= AGREE).otherwise(F.col("like") >= ALIKE))
    order = [F.coalesce("share", F.lit(0.0)).desc(), F.col("like").desc(), F.col("old"), F.col("new")]
    for side in ("old", "new"):
        kept = kept.withColumn(f"r_{side}", F.row_number().over(Window.partitionBy("series_id", "year", side).orderBy(*order)))
    best = kept.where("r_old = 1 AND r_new = 1")
    return best.select("series_id", "year", "previous_year", F.col("old").alias("previous_column"), F.col("new").alias("source_column"), "share", "n")


def _likeness() -> Column:
    """How alike the words ``z`` of the old and ``w`` of the new header are."""
    return 1 - F.levenshtein("z", "w") / F.greatest(F.length("z"), F.length("w"), F.lit(1))


# -- fields -----------------------------------------------------------------------------
def fields(columns: DataFrame, renamed: DataFrame) -> DataFrame:
    """The field of each file's column: ``field`` and ``since``, header and year where it began.

    A column that stays under one header from file to file is a run, found by one narrow
    window; only renames link runs.  Pointers from run to run double, so a field renamed R
    times takes log2(R) rounds over runs.
    """
    back = renamed.select("series_id", "year", F.col("source_column").alias("header"), F.col("previous_column").alias("was"))
    gone = renamed.select("series_id", "year", F.col("previous_column").alias("header"), F.lit(True).alias("taken"))
    nodes = columns.select(*FILE, "header", "previous_year").join(back, [*FILE, "header"], "left").join(gone, [*FILE, "header"], "left")
    w = Window.partitionBy("series_id", "header").orderBy("year")
    stays = (F.lag("year").over(w) == F.col("previous_year")) & F.col("was").isNull() & F.col("taken").isNull()
    runs = nodes.withColumn("start", F.when(~F.coalesce(stays, F.lit(False)), F.col("year")))
    runs = cut(runs.withColumn("start", F.max("start").over(w.rowsBetween(Window.unboundedPreceding, 0))).select(*FILE, "header", "previous_year", "was", "start"))
    ends = runs.select("series_id", F.col("year").alias("previous_year"), F.col("header").alias("was"), F.col("start").alias("js"))
    state = runs.where("year = start").join(ends, ["series_id", "previous_year", "was"], "left")
    state = state.select("series_id", "header", "start", F.when(F.col("js").isNotNull(), F.col("was")).alias("jh"), "js")
    state = cut(state.withColumns({"field": F.coalesce("jh", "header"), "since": F.coalesce("js", "start")}))
    while not state.where("jh IS NOT NULL").isEmpty():
        done, open_ = state.where("jh IS NULL"), state.where("jh IS NOT NULL")
        there = state.select("series_id", F.col("header").alias("jh"), F.col("start").alias("js"), F.col("jh").alias("jh2"), F.col("js").alias("js2"), F.col("field").alias("f2"), F.col("since").alias("s2"))
        moved = open_.join(there, ["series_id", "jh", "js"]).select("series_id", "header", "start", F.col("jh2").alias("jh"), F.col("js2").alias("js"), F.col("f2").alias("field"), F.col("s2").alias("since"))
        after = cut(done.unionByName(moved))
        drop(state)
        state = after
    return runs.select(*FILE, "header", "start").join(state.select("series_id", "header", "start", "field", "since"), ["series_id", "header", "start"]).select(*FILE, "header", "field", "since")


def changes(columns: DataFrame, named: DataFrame) -> DataFrame:
    """Every change of a field between a file and the one before it: added, removed, renamed, retyped, moved.

    A field's columns stand in order of their files; a field without a column in the file
    before is added, one without a column in the file after is removed there.
    """
    full = columns.join(named, [*FILE, "header"])
    w = Window.partitionBy("series_id", "field", "since").orderBy("year")
    was = {f"{c}0": F.lag(c).over(w) for c in ("year", "header", "tag", "sheets")}
    full = full.withColumns({**was, "later": F.lead("year").over(w)})
    there = F.coalesce(F.col("year0") == F.col("previous_year"), F.lit(False))
    moved = there & (F.size("sheets") > 0) & (F.size("sheets0") > 0) & (F.col("sheets") != F.col("sheets0"))
    kinds = {
        "added": F.col("previous_year").isNotNull() & ~there,
        "renamed": there & (F.col("header") != F.col("header0")),
        "retyped": there & (F.col("tag") != F.col("tag0")),
        "moved": moved,
    }
    told = [F.when(c, F.struct(F.col("year").alias("y"), F.lit(k).alias("k"), F.col("header").alias("c"), F.when(F.lit(k) == "added", "").otherwise(F.col("header0")).alias("p"))) for k, c in kinds.items()]
    lost = F.col("next_year").isNotNull() & ~F.coalesce(F.col("later") == F.col("next_year"), F.lit(False))
    told.append(F.when(lost, F.struct(F.col("next_year").alias("y"), F.lit("removed").alias("k"), F.lit("").alias("c"), F.col("header").alias("p"))))
    hits = full.select("series_id", F.explode(F.array_compact(F.array(*told))).alias("h"))
    return hits.select("series_id", F.col("h.y").alias("award_year_start"), F.col("h.k").alias("change_kind"), F.col("h.c").alias("source_column"), F.col("h.p").alias("previous_column"))


def alternatives(columns: DataFrame, named: DataFrame) -> DataFrame:
    """Alternative types of each field of a series: cells, first and last year and headers per tag.

    ``appeared`` tells the tags that came after the field began.
    """
    counts = F.explode(F.array(*[F.struct(F.lit(t).alias("tag"), F.col(f"n_{t}").alias("n")) for t in TAGS]))
    cell = columns.drop("tag").join(named, [*FILE, "header"]).select(*FILE, "header", "field", "since", counts.alias("t")).where("t.n > 0")
    per = cell.groupBy("series_id", "field", "since", F.col("t.tag").alias("tag")).agg(F.sum("t.n").alias("n_cells"), F.min("year").alias("first_year"), F.max("year").alias("last_year"), F.countDistinct("header").alias("n_headers"))
    return per.withColumn("appeared", F.col("first_year") > F.min("first_year").over(Window.partitionBy("series_id", "field", "since")))


# -- one set of columns -----------------------------------------------------------------
def spellings(h: Column) -> Column:
    """Forms of a header by which parallel schemas are told to name one thing.

    Family prefix, footnotes, units in brackets and version marks go; then the words in any
    order, and the letters in their order, as separators come and go.
    """
    bare = F.regexp_replace(F.regexp_replace(h, r"\A[a-z]+(_[a-z]+)?__", ""), r"([_ .-]?v\d+|[_ ]ay| ?\*| ?\[[^\]]*\]| ?\([^)]*\))+\z", "")
    letters = F.regexp_replace(bare, r"[^a-z0-9]+", "")
    spaced = F.btrim(F.regexp_replace(bare, r"[^a-z0-9]+", " "))
    sorted_words = F.array_join(F.array_sort(F.split(spaced, " ")), "_")
    return F.when(letters == "", F.array(F.concat(F.lit("h:"), h))).otherwise(F.array(F.concat(F.lit("w:"), sorted_words), F.concat(F.lit("l:"), letters)))


def fuse(named: DataFrame) -> DataFrame:
    """Fused field (``column``) of each series' field: fields that share a spelling, directly or by others.

    Labels run over (field, spelling) pairs: a spelling takes the smallest label of its
    fields, a field the smallest of its spellings, and labels are followed one step further
    each round.  The column is named after the spelling that most files use.
    """
    links = named.select("series_id", "field", "since", *FILE[1:], F.explode(spellings(F.col("header"))).alias("spelling"))
    links = cut(links.groupBy("series_id", "field", "since", "spelling").agg(F.count(F.lit(1)).alias("n_files")))
    node = ["series_id", "field", "since"]
    state = cut(links.groupBy("spelling").agg(F.min("spelling").alias("label")))
    while True:
        own = links.join(state, "spelling").groupBy(*node).agg(F.min("label").alias("low"))
        reach = links.join(own, node).groupBy("spelling").agg(F.min("low").alias("low"))
        far = state.select(F.col("spelling").alias("low"), F.col("label").alias("lower"))
        moved = state.select("spelling", "label").join(reach, "spelling").join(far, "low", "left")
        after = cut(moved.select("spelling", F.least("label", "low", "lower").alias("label"), (F.least("low", "lower") < F.col("label")).alias("changed")))
        again = not after.where("changed").isEmpty()
        drop(state)
        state = after
        if not again:
            break
    told = links.join(state, "spelling")
    per = told.groupBy("label", "spelling").agg(F.sum("n_files").alias("n")).where("spelling NOT LIKE 'l:%'")
    best = per.groupBy("label").agg(F.max_by("spelling", F.struct("n", "spelling")).alias("name"), F.sum("n").alias("n_files"))
    best = best.select("label", F.substring("name", 3, 1_000).alias("column"), "n_files")
    return told.select(*node, "label").distinct().join(best, "label").select(*node, "column", "n_files")


def columns_of(fused: DataFrame) -> list[str]:
    """Names of the columns: the MAX_COLUMNS fused fields of most files, in order of the alphabet."""
    most = fused.groupBy("column").agg(F.max("n_files").alias("n")).orderBy(F.desc("n"), "column").limit(MAX_COLUMNS)
    return sorted(r["column"] for r in most.select("column").collect())


def union_of(c: Column) -> Column:
    """A cell as tagged union: tag, typed branches, canonical conversion."""

    def branch(tag: str, kind: str) -> Column:
        return F.when(c["tag"] == tag, c["text"].try_cast(kind)).alias(f"{tag}_value")

    return F.struct(c["tag"].alias("tag"), branch("integer", "decimal(38,0)"), branch("decimal", "double"), branch("boolean", "boolean"), branch("string", "string"), canonical(c["text"]).alias("canonical"))


def unified(rows: DataFrame, named: DataFrame, fused: DataFrame) -> DataFrame:
    """All report rows with one set of columns, the fused fields.

    Every column is a tagged union.  A cell goes to ``other_fields`` with its header if its
    row belongs to no file, its field is beyond the columns, or another cell of the row
    stands in the column already (repeated headers, repeated elements of an array, two
    fields of a file fused into one: the first in order of the payload stays).  So every
    cell that is not null is there once, and no row is lost.  Headers join their columns as
    one map per file; rows keep their cells as an array, so no cell is shuffled.
    """
    names = columns_of(fused)
    node = ["series_id", "field", "since"]
    told = named.join(fused.where(F.col("column").isin(*names)) if names else fused.limit(0), node)
    per_file = cut(told.groupBy(*FILE).agg(F.map_from_entries(F.collect_list(F.struct("header", "column"))).alias("place")))
    base = rows.join(per_file, FILE, "left")
    full = F.filter("cells", lambda c: c["tag"].isNotNull())
    placed = F.transform(full, lambda c: F.struct(F.try_element_at("place", c["header"]).alias("column"), c["header"].alias("header"), union_of(c).alias("value")))
    base = base.withColumn("placed", placed)
    own = F.transform("placed", lambda c: c["column"])
    first = F.filter("placed", lambda c, i: c["column"].isNotNull() & (F.array_position(own, c["column"]) == i + 1))
    rest = F.filter("placed", lambda c, i: c["column"].isNull() | (F.array_position(own, c["column"]) != i + 1))
    base = base.withColumn("told", F.map_from_entries(F.transform(first, lambda c: F.struct(c["column"], c["value"]))))
    base = base.withColumn("other_fields", F.transform(rest, lambda c: F.struct(c["header"].alias("header"), c["value"].alias("value"))))
    picked = [F.try_element_at("told", F.lit(c)).alias(c) for c in names]
    lead = ["report_row_id", "series_id", "family", F.col("year").alias("award_year_start"), "award_year", "filename", "source_excel_row"]
    clash = {"report_row_id", "series_id", "family", "award_year_start", "award_year", "filename", "source_excel_row", "other_fields"}
    picked = [p.alias(f"{c}_field") if c in clash else p for p, c in zip(picked, names)]
    return base.select(*lead, *picked, "other_fields")


def cells_kept(rows: DataFrame, table: DataFrame) -> DataFrame:
    """Cells that are not null per tag, as read and as found in a table of :func:`unified`."""
    before = rows.select(F.explode("cells").alias("c")).where("c.tag IS NOT NULL").groupBy(F.col("c.tag").alias("tag")).agg(F.count(F.lit(1)).alias("n_read"))
    unions = [f.name for f in table.schema.fields if f.dataType.typeName() == "struct"]
    parts = [F.array(*[F.col("`" + c.replace("`", "``") + "`")["tag"] for c in unions])] if unions else []
    tags = reduce(lambda a, b: F.concat(a, b), [*parts, F.transform("other_fields", lambda x: x["value"]["tag"])])
    after = table.select(F.explode(tags).alias("tag")).where("tag IS NOT NULL").groupBy("tag").agg(F.count(F.lit(1)).alias("n_found"))
    met = before.join(after, "tag", "full")
    return met.select("tag", F.coalesce("n_read", F.lit(0)).alias("n_read"), F.coalesce("n_found", F.lit(0)).alias("n_found"))
