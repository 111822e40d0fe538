"""Year-aware readings of directory codes: roles, status, flags, reasons."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelwright.functions import clean, ids

#: Postal codes of states and of territories and associated states.
STATES = tuple("AL AK AZ AR CA CO CT DE DC FL GA HI ID IL IN IA KS KY LA ME MD MA MI MN MS MO MT NE NV NH NJ NM NY NC ND OH OK OR PA RI SC SD TN TX UT VT VA WA WV WI WY".split())
TERRITORIES = tuple("AS FM GU MH MP PW PR VI".split())


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, (F.coalesce(c, F.lit(False)) for c in conditions), F.lit(False))


def component_role(code: Column, parent: Column, year: Column, finance: bool) -> Column:
    """Role of a unit in a survey component from its role code, parent id and year."""
    c, p = ids.integral(code), ids.integral(parent)
    role = F.when(c == -2, "no_parent_child_relation_reported").when(c == 1, "parent").when(c == 2, "full_child")
    if finance:
        role = role.when(c == 3, "partial_child").when(c == 4, "full_child_nonpostsecondary_parent").when(c == 5, "partial_child_nonpostsecondary_parent").when((c == 6) & (year >= 2016), "partial_parent_and_child")
    return (
        F.when(c.isNull() | p.isNull() | ((p != -2) & (p <= 0)), "metadata_unavailable_or_invalid")
        .when(role.isNull(), "undocumented_code")
        .when((c == -2) & (p > 0), "parent_reference_without_role")
        .otherwise(role)
    )


def scope_code_valid(value: Column, kind: str, year: Column, finance: bool = False) -> Column:
    """True for a documented role code (``kind`` prch) or parent id (``kind`` idx)."""
    v = ids.integral(value)
    if kind == "idx":
        return F.coalesce((v == -2) | (v > 0), F.lit(False))
    ok = v.isin(-2, 1, 2)
    if finance:
        ok = ok | v.isin(3, 4, 5) | ((v == 6) & (year >= 2016))
    return F.coalesce(ok, F.lit(False))


def participation(opeflag: Column, year: Column) -> Column:
    """Programme participation from the annual flag; unknown for codes without a meaning that year."""
    c = ids.integral(opeflag)
    return (
        F.when(c == 1, "participating")
        .when(c == 2, "branch_of_participating_institution")
        .when(c == 3, "deferment_only")
        .when((c == 4) & year.isin(1999, 2001), "eligible_out_of_scope_or_historical_definition")
        .when(c == 4, "new_participant")
        .when(c == 5, "not_participating_with_opeid")
        .when(c == 6, "not_participating_without_opeid")
        .when(c == 7, "stopped_participating")
        .when((c == 8) & (year >= 2004), "new_spring_participant")
        .otherwise("unknown")
    )


def geography(states: list[Column], types: list[Column]) -> Column:
    """Class of the states and school types that several sources report for one row."""
    s = F.transform(F.array(*states), lambda x: F.upper(F.btrim(F.coalesce(x, F.lit("")))))
    t = F.transform(F.array(*types), lambda x: F.lower(F.coalesce(x, F.lit("")))) if types else F.array(F.lit(""))
    foreign = F.array_contains(s, "FC") | F.exists(t, lambda x: x.contains("foreign"))
    in_states = F.arrays_overlap(s, F.array(*[F.lit(x) for x in STATES]))
    in_territories = F.arrays_overlap(s, F.array(*[F.lit(x) for x in TERRITORIES]))
    return (
        F.when(foreign & (in_states | in_territories), "conflicting_geography")
        .when(foreign, "foreign_explicit")
        .when(in_states, "us_states_dc")
        .when(in_territories, "territories_and_freely_associated_states")
        .otherwise("unknown")
    )


def record_flags(columns: list[str], year: Column) -> dict[str, Column]:
    """Flags of a directory record, false where evidence is missing.

    ``columns`` are the record's columns; role and parent columns are found by prefix.  The four
    scope columns must all be there and hold documented codes for ``flags_available``.
    """
    have = {c.lower() for c in columns}

    def num(c: str) -> Column:
        return ids.integral(F.col(c)) if c in have else F.lit(None).cast("bigint")

    def text(c: str) -> Column:
        return F.upper(clean.strip(F.col(c))) if c in have else F.lit(None).cast("string")

    relations = [c for c in sorted(have) if c.startswith(("prch_", "idx_", "prchtp_"))]
    flag = num("opeflag")
    full = (flag == 1) | ((flag == 4) & ((year == 2000) | (year >= 2002))) | ((flag == 8) & (year >= 2004))
    scope = ("prch_f", "idx_f", "prch_sfa", "idx_sfa")
    needed = [scope_code_valid(F.col(c), c.split("_")[0], year, c.endswith("_f")) if c in have else F.lit(False) for c in scope]
    flags_told = F.col("ipeds_flags_available") if "ipeds_flags_available" in have else F.lit(False)
    no_date = text("closedat").isNull() | text("closedat").isin("", "-1", "-2", "-9", "NAN", "NONE", "NA")
    return {
        "is_administrative": F.coalesce(num("sector") == 0, F.lit(False)),
        "is_inactive": _any([num("cyactive").isin(0, 2, 3), text("act").isin("C", "D", "I", "O", "W", "X")]),
        "is_branch": _any([flag == 2, text("act") == "G"]),
        "not_full_participant": ~F.coalesce(full, F.lit(False)),
        "has_parent_child": _any([num(c) > 0 for c in relations]),
        "flags_available": reduce(lambda a, b: a & b, needed, F.coalesce(flags_told, F.lit(False))),
        "merger_or_closure": _any([num("newid") > 0, num("deathyr") > 0, ~no_date]),
        "status_available": F.coalesce(num("sector").between(0, 9) & num("cyactive").isin(1, 2, 3), F.lit(False)),
    }


def anchor_sensitivity(n_start: Column, n_end: Column, unit_start: Column, unit_end: Column, start_loaded: Column, end_loaded: Column) -> Column:
    """Whether the match of the start year and that of the end year agree."""
    return (
        F.when(~start_loaded | ~end_loaded, "year_unavailable")
        .when((n_start == 1) & (n_end == 1) & (unit_start == unit_end), "stable_unique")
        .when((n_start == 1) & (n_end == 1), "different_unitid")
        .otherwise("ambiguous_or_unmatched")
    )


def reasons(flags: dict[str, Column]) -> Column:
    """Names of the flags that hold, in the given order, as an array without repeats."""
    return F.array_distinct(F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in flags.items()])))
