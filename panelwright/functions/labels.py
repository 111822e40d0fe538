"""Missing codes by their labels, and reference periods by their table names."""

from __future__ import annotations

from decimal import Decimal, InvalidOperation

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Variables whose codes are states of a survey, never missing values.
STATUS_PREFIXES = ("PRCH", "STAT_", "LOCK_", "REV_", "PTA", "PTB_", "PTC_", "PTD_", "PTE")
#: Labels of one comparison-group code that mean no answer was given.
NO_GROUP = (
    "non-title iv institution, that did not respond to all component surveys",
    "non-title iv, institution that did not respond to all component surveys",
)


def missing_reason(variable: Column, code: Column, label: Column) -> Column:
    """Why a code is missing according to its label; null for codes that carry a meaning."""
    name = F.upper(F.split(variable, "__")[0])
    text = F.lower(F.btrim(F.regexp_replace(F.regexp_replace(F.btrim(label), r"\A\{+|\}+\z", ""), r"\s+", " ")))
    n = code.try_cast("decimal(38,10)")
    exempt = name.rlike(r"\A(" + "|".join(STATUS_PREFIXES) + ")") | ((name == "F1FHA") & (code == "0")) | ((name == "DFRCGID") & (n >= 0))
    return (
        F.when(F.coalesce(exempt, F.lit(False)), F.lit(None).cast("string"))
        .when((text == "not reported") | text.startswith("not reported -"), "not_reported")
        .when(text.isin("not applicable", "item not applicable") | text.startswith("not applicable,") | text.startswith("not applicable -"), "not_applicable")
        .when(text.isin("not available", "item not available"), "not_available")
        .when(text.startswith("not derived due to") | text.startswith("not derived -"), "not_derived")
        .when((name == "LOCALE") & (text == "not assigned"), "not_assigned")
        .when((name == "SECTOR") & (text == "sector unknown (not active)"), "unknown")
        .when((name == "DFRCGID") & (code == "-1") & text.isin(*NO_GROUP), "not_reported")
    )


def matches_code(column: Column, numeric: bool, code: str) -> Column:
    """True where a cell holds the code: as a number, or as text with optional zero decimals.

    Text is trimmed but not otherwise bent: a leading zero makes another value.
    """
    try:
        value = Decimal(code)
    except InvalidOperation:
        value = None
    if numeric:
        return F.coalesce(column == float(value), F.lit(False)) if value is not None and value.is_finite() else F.lit(False)
    text = F.btrim(column)
    if value is not None and value.is_finite() and value == value.to_integral_value():
        return F.coalesce(text.rlike(rf"\A{int(value)}(\.0+)?\z"), F.lit(False))
    return F.coalesce(text == code, F.lit(False))


def reference_start(table: Column) -> Column:
    """Start year that a table name such as ``SFA0809_P1`` tells; null unless the years follow."""
    a = F.regexp_extract(table, r"(?i)\ASFA(\d{2})(\d{2})", 1).try_cast("int")
    b = F.regexp_extract(table, r"(?i)\ASFA(\d{2})(\d{2})", 2).try_cast("int")
    return F.when(b == (a + 1) % 100, F.when(a >= 80, 1900 + a).otherwise(2000 + a))
