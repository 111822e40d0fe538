"""One wide row per unit and period from several source families; ambiguous records are blocked.

A record is identified if its unit is known and eligible.  If a family has more than one
identified record for a unit and year, all of them are blocked: none is picked, added up or
filled with zero.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.functions.measures import component_sum

BLOCKED = "incomplete_blocked_unitid_family"
INCLUDED = "included_unique_family_record"
MULTIPLE = "ambiguous_family_multiple_records"
UNRESOLVED = "excluded_annual_identity_unresolved"
ABSENT = "absent_source_record"
KEYS = ["unitid", "award_year_start"]


def dispositions(records: DataFrame, eligible: Column, guard: Column | None = None) -> DataFrame:
    """Adds identity_guard_status and record_disposition to records (unitid, award_year_start, family).

    ``guard`` may name a further reason to exclude an identified record; such a record still
    competes, so no accepted record can hide a conflict with it.  Multiplicity is an aggregate
    joined back, so a key with many records is a few rows after the map side.  Records that
    are not identified take no part in the join.
    """
    first = F.when(~F.coalesce(eligible, F.lit(False)) | F.col("unitid").isNull(), UNRESOLVED)
    if guard is not None:
        first = first.when(guard.isNotNull(), guard)
    rows = records.withColumn("identity_guard_status", first.otherwise("candidate"))
    identified = rows.where(F.col("identity_guard_status") != UNRESOLVED)
    counts = identified.groupBy(*KEYS, "family").agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
    joined = identified.join(counts, [*KEYS, "family"], "left")
    status = F.when(F.col("__n") > 1, MULTIPLE).when(F.col("identity_guard_status") == "candidate", INCLUDED).otherwise(F.col("identity_guard_status"))
    rest = rows.where(F.col("identity_guard_status") == UNRESOLVED).withColumn("record_disposition", F.lit(UNRESOLVED))
    return joined.withColumn("record_disposition", status).drop("__n").select(*rest.columns).unionByName(rest)


def unit_panel(records: DataFrame, families: list[str], measures: list[str], reports: DataFrame, headers: DataFrame | None = None, companions: tuple[str, ...] = ()) -> DataFrame:
    """Wide panel: per family the record's status, count and measures with a status for every cell.

    ``records`` come from :func:`dispositions`, with ``<measure>`` and ``<measure>__status``.
    ``reports`` has (family, award_year_start) of the reports there are, ``headers`` has
    (family, award_year_start, measure) of the columns they hold.  A missing cell says why:
    the record is blocked, there is no report, the report lacks the column, or it has no such
    record.  ``companions`` are further ``<measure>__<companion>`` columns (the token as
    delivered, bounds) that an included record brings along.  One aggregate per key builds all
    families at once.
    """
    known = records.where(F.col("identity_guard_status") != UNRESOLVED)
    agg = []
    for f in families:
        own = F.col("family") == f
        inc = own & (F.col("record_disposition") == INCLUDED)
        agg += [F.count_if(own).alias(f"{f}__unitid_source_record_count"), F.max(F.when(own, F.col("record_disposition"))).alias(f"__{f}_one")]
        for m in measures:
            agg += [F.max(F.when(inc, F.col(m))).alias(f"{f}__{m}"), F.max(F.when(inc, F.col(f"{m}__status"))).alias(f"{f}__{m}__status")]
            agg += [F.max(F.when(inc, F.col(f"{m}__{k}"))).alias(f"{f}__{m}__{k}") for k in companions]
    wide = known.groupBy(*KEYS).agg(*agg)
    have = reports.groupBy("award_year_start").agg(F.collect_set("family").alias("__reports"))
    wide = wide.join(F.broadcast(have), "award_year_start", "left")  # one row per calendar year
    if headers is not None:
        cols = headers.groupBy("award_year_start").agg(F.collect_set(F.concat_ws("|", "family", "measure")).alias("__headers"))
        wide = wide.join(F.broadcast(cols), "award_year_start", "left")
    out = [F.col(k) for k in KEYS]
    included, blocked = F.lit(0), F.lit(0)
    for f in families:
        n = F.col(f"{f}__unitid_source_record_count")
        status = F.when(n == 0, ABSENT).when(n > 1, MULTIPLE).otherwise(F.col(f"__{f}_one"))
        included = included + (status == INCLUDED).cast("int")
        blocked = blocked + (~status.isin(INCLUDED, ABSENT)).cast("int")
        out += [status.alias(f"{f}__unitid_record_status"), n.alias(f"{f}__unitid_source_record_count"), (status == INCLUDED).alias(f"{f}__source_record_present")]
        report = F.coalesce(F.array_contains("__reports", f), F.lit(False))
        for m in measures:
            gap = F.when(~report, "report_not_available")
            if headers is not None:
                gap = gap.when(~F.coalesce(F.array_contains("__headers", f"{f}|{m}"), F.lit(False)), "unavailable_in_schema")
            cell = F.when(status == INCLUDED, F.col(f"{f}__{m}__status")).when(status != ABSENT, status).otherwise(gap.otherwise(ABSENT))
            out += [F.col(f"{f}__{m}"), cell.alias(f"{f}__{m}__status"), *[F.col(f"{f}__{m}__{k}") for k in companions]]
    return wide.select(*out, included.alias("included_source_family_count"), blocked.alias("blocked_source_family_count"))


def combined(panel: DataFrame, name: str, measure: str, families: list[str], needed: dict[str, Column]) -> DataFrame:
    """Adds ``<name>__<measure>``, its status and observed partial sum over several families of a panel.

    ``needed`` tells in which rows a family is needed (all are by default).  Where a needed
    family is blocked there is no sum, and the status says so.
    """
    need = [needed.get(f, F.lit(True)) for f in families]
    total = component_sum([F.col(f"{f}__{measure}") for f in families], need)
    stuck = [q & ~F.col(f"{f}__unitid_record_status").isin(INCLUDED, ABSENT) for f, q in zip(families, need)]
    blocked = reduce(lambda a, b: a | b, stuck)
    out = f"{name}__{measure}"
    return panel.withColumns({out: F.when(~blocked, total["value"]), f"{out}__status": F.when(blocked, BLOCKED).otherwise(total["status"]), f"{out}__observed_partial_sum": total["observed_partial_sum"]})


def guard_orphans(orphans: DataFrame, memberships: DataFrame | None) -> DataFrame:
    """Guard status of verified unit-only records: blocked where another membership overlaps.

    References to a parent say nothing about the unit itself and do not count.
    """
    if memberships is None:
        return orphans.withColumn("guard", F.lit("excluded_missing_official_membership_guard"))
    taken = memberships.where(~F.coalesce(F.col("relation_type").contains("parent_reference"), F.lit(False))).select("unitid", "award_year_start").distinct().withColumn("__t", F.lit(True))
    return orphans.join(taken, KEYS, "left").withColumn("guard", F.when(F.col("__t"), "excluded_official_membership_overlap")).drop("__t")


def bind_decisions(quarantine: DataFrame, decisions: DataFrame, evidence: list[tuple[str, str]]) -> DataFrame:
    """Quarantined rows with the decision on each; raises if the row is no longer what was decided on.

    ``evidence`` pairs a column of the row with the column of the decision that must equal it
    (null and empty are the same).
    """
    key = ["family", "award_year", "filename", "source_excel_row"]
    joined = quarantine.join(decisions, key, "left")
    changed = F.lit(False)
    for a, b in evidence:
        changed = changed | (F.coalesce(F.btrim(F.col(a).cast("string")), F.lit("")) != F.coalesce(F.btrim(F.col(b).cast("string")), F.lit("")))
    if joined.where(F.col("resolution_id").isNotNull() & changed).limit(1).count():
        raise ValueError("a quarantined row differs from the evidence of its decision")
    return joined


def blocked_rows(records: DataFrame) -> DataFrame:
    """Everything that did not enter the panel, with the reason."""
    return records.where(F.col("record_disposition") != INCLUDED)

