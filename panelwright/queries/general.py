"""Queries p1 to p5: drifting schemas, hierarchies, history, profile, orphans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.functions import clean
from panelwright.operators import drift, hierarchy, history, orphans, profile
from panelwright.operators.directory import current_codes
from panelwright.queries import drift_sql, general_sql
from panelwright.session import cut, table


# -- p1 ---------------------------------------------------------------------------------
def _drift(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(report rows with their cells, columns of files, the field of each column), all written."""
    rows = drift.read(table(spark, d, "raw_reports"))
    columns = cut(drift.listing(table(spark, d, "schema_availability"), cut(drift.column_facts(rows))))
    return rows, columns, cut(drift.fields(columns, cut(drift.renames(columns, rows))))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    _, columns, named = _drift(spark, d)
    return drift.changes(columns, named)


def p1_unified(spark: SparkSession, d: str) -> DataFrame:
    rows, _, named = _drift(spark, d)
    return drift.unified(rows, named, cut(drift.fuse(named)))


def p1_cells_kept(spark: SparkSession, d: str) -> DataFrame:
    """Cells per tag in the payloads and in the table of p1_unified: none is lost, none comes twice."""
    rows, _, named = _drift(spark, d)
    return drift.cells_kept(rows, drift.unified(rows, named, cut(drift.fuse(named))))


def p1_alternatives(spark: SparkSession, d: str) -> DataFrame:
    _, columns, named = _drift(spark, d)
    return drift.alternatives(columns, named)


# -- p2 ---------------------------------------------------------------------------------
def _links(spark: SparkSession, d: str) -> DataFrame:
    now = cut(current_codes(table(spark, d, "ipeds_directory"), {"idx_sfa": "id", "idx_f": "id"}))
    return hierarchy.links(now, {"sfa": "idx_sfa", "f": "idx_f"})


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    trees, rings, _ = hierarchy.hierarchy(_links(spark, d))
    a = trees.select(*hierarchy.NODE, "root_unitid", "tree_depth")
    b = rings.select(*hierarchy.NODE, F.col("loop_root").alias("root_unitid"), F.when(F.col("on_loop"), -1).otherwise(-2).alias("tree_depth"))
    return a.unionByName(b)


def p2_tree(spark: SparkSession, d: str) -> DataFrame:
    """Path, depth, root and descendants (as an interval of positions) of every node that is not on a loop."""
    trees, total = hierarchy.whole(_links(spark, d), positions=True)
    trees = cut(trees)
    full = hierarchy.paths(trees, total)
    rows = trees.join(full, hierarchy.NODE)
    return rows.select(*hierarchy.NODE, "root_unitid", "tree_depth", F.array_join(F.transform("path", lambda x: x.cast("string")), "/").alias("path"), (F.col("size") - 1).alias("n_descendants"), "head", "at", "first_position", "last_position")


def p2_descendants(spark: SparkSession, d: str) -> DataFrame:
    """One row per node and descendant, from the chains' intervals of positions; nodes on loops are left out."""
    trees, _ = hierarchy.whole(_links(spark, d), positions=True)
    return hierarchy.descendants(cut(trees))


def p2_loops(spark: SparkSession, d: str) -> DataFrame:
    _, rings, _ = hierarchy.hierarchy(_links(spark, d))
    return rings


# -- p3 ---------------------------------------------------------------------------------
HISTORY = {"opeflag": "code", "newid": "code", "deathyr": "code", "closedat": "date"}


def p3_history(spark: SparkSession, d: str) -> DataFrame:
    now = current_codes(table(spark, d, "ipeds_directory"), HISTORY)
    return history.versions(now, "unitid", "ipeds_year", list(HISTORY))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return p3_history(spark, d).select("unitid", "valid_from", "valid_to")


# -- p4 ---------------------------------------------------------------------------------
RULES = {
    "merge_status": profile.Rule(allowed=("matched", "ipeds_only")),
    "has_usable_fsa_record": profile.Rule(allowed=("True", "False")),
    "grant__pell_recipients": profile.Rule(whole=True),
}


def _frequencies(spark: SparkSession, d: str, columns: list[str] | None = None) -> DataFrame:
    """Value frequencies of ``columns``, by default of every column but the load's keys.

    Lists, structs and maps are profiled as JSON text, which has an order.
    """
    panel = table(spark, d, "master_panel")
    if columns is None:
        columns = [c for c in panel.columns if c not in profile.LOAD]
        panel = panel.withColumns({c: F.to_json(c) for c, kind in panel.dtypes if c in columns and kind.startswith(("array", "struct", "map"))})
    rows = profile.deduplicated(panel, "panel_row_id", [*profile.LOAD, *[c for c in columns if c != "panel_row_id"]])
    return cut(profile.frequencies(rows, columns))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    freq = _frequencies(spark, d, list(RULES))
    return profile.findings(profile.compared(freq, RULES), RULES)


def p4_profile(spark: SparkSession, d: str) -> DataFrame:
    """The profile of every column of every load but its keys; times have their range as text (min_value, max_value)."""
    return profile.profile(_frequencies(spark, d), RULES)


def p4_changes(spark: SparkSession, d: str) -> DataFrame:
    """Every column's change from the load before (its keys left out): null rate, total variation, stability index, chi-square."""
    both = profile.compared(_frequencies(spark, d), RULES)
    rate = F.col("n_null") / F.col("n_rows") - F.col("previous_n_null") / F.col("previous_n_rows")
    return both.select(*profile.LOAD, "field_name", F.round(rate, 9).alias("null_rate_change"), F.round("total_variation", 9).alias("total_variation"), F.round("stability_index", 9).alias("stability_index"), F.round("chi_square", 6).alias("chi_square"))


# -- p5 ---------------------------------------------------------------------------------
def _references(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    now = cut(current_codes(table(spark, d, "ipeds_directory"), {"idx_sfa": "id", "idx_f": "id"}))
    family = profile.deduplicated(table(spark, d, "family_records").select("record_id", "award_year", "unitid", "loaded_at"), "record_id", ["award_year", "unitid"])
    family = family.select("record_id", clean.award_start(F.col("award_year")).alias("year"), F.when(F.col("unitid") >= 0, F.col("unitid")).alias("unitid"))
    refs = orphans.union_references(
        [
            orphans.references(now, "ipeds_directory", "unitid", "ipeds_year", ["idx_sfa", "idx_f"]),
            orphans.references(family, "family_records", "record_id", "year", ["unitid"]),
        ]
    )
    return cut(refs), now.select("unitid", "ipeds_year")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    refs, directory = _references(spark, d)
    counts = orphans.counted(refs)
    return orphans.orphan_rows(refs, counts, cut(orphans.orphan_keys(counts, directory)))


def p5_report(spark: SparkSession, d: str) -> DataFrame:
    refs, directory = _references(spark, d)
    counts = orphans.counted(refs)
    return orphans.summary(counts, cut(orphans.orphan_keys(counts, directory)))


QUERIES = {f.__name__: f for f in (p1_found, p1_unified, p1_cells_kept, p1_alternatives, p2_found, p2_tree, p2_descendants, p2_loops, p3_found, p3_history, p4_found, p4_profile, p4_changes, p5_found, p5_report)}
SQL = {**general_sql.SQL, **drift_sql.SQL}
