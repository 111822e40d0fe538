"""Canonical values of dirty codes, ids, dates, labels and truth tokens.

All functions take and give Columns and stay inside code generation.  "None" marks
(null, blank, ``.`` and negative codes) become null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLANKS = " \t\r\n\f   ﻿"

#: English month names as report files abbreviate them.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")


def strip(c: Column) -> Column:
    """Text without blanks of any kind at its ends; null stays null."""
    return F.btrim(c.cast("string"), F.lit(_BLANKS))


def number(c: Column) -> Column:
    """Exact decimal of a numeric spelling (``' 01'``, ``'1.0'``, ``'1.00'``), else null."""
    return strip(c).try_cast("decimal(38,10)")


def code_id(c: Column) -> Column:
    """Positive integral id as bigint; "none" marks, fractions and other text give null."""
    n = number(c)
    ok = (n > 0) & (n == F.floor(n)) & (n <= F.lit(9223372036854775807).cast("decimal(38,10)"))
    return F.when(ok, n.cast("bigint"))


def _plain(n: Column) -> Column:
    """Decimal text without trailing zeros."""
    return F.regexp_replace(F.regexp_replace(n.cast("string"), r"(\.\d*?)0+\z", "$1"), r"\.\z", "")


def code(c: Column) -> Column:
    """Canonical text of a code: equal for spellings of one number, null for "none".

    Text that is no number is compared in lower case without outer blanks.
    """
    s, n = strip(c), number(c)
    return F.when(s.isNull() | s.isin("", "."), F.lit(None).cast("string")).when(n < 0, F.lit(None).cast("string")).when(n.isNotNull(), _plain(n)).otherwise(F.lower(s))


def _month_number(name: Column) -> Column:
    at = F.instr(F.lit("".join(MONTHS)), F.lower(F.substring(name, 1, 3)))
    return F.when((at > 0) & (at % 3 == 1), F.lpad(((at + 2) / 3).cast("int").cast("string"), 2, "0"))


def date_code(c: Column) -> Column:
    """ISO text of a date in any of the forms in use; "none" gives null.

    Forms: ``yyyy-MM-dd`` and ``yyyy/MM/dd`` (a time may follow), ``M/d/yyyy`` and
    ``M-d-yyyy`` (month first where both are numbers), ``d-MMM-yyyy``, ``MMM d, yyyy``
    and ``yyyyMMdd``.  Anything else is treated by :func:`code`.
    """
    s = strip(c)

    def iso(y: Column, m: Column, d: Column) -> Column:
        return F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0"))

    def part(pattern: str, i: int) -> Column:
        return F.regexp_extract(s, pattern, i)

    ymd = r"\A(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})(?:[T ].*)?\z"
    mdy = r"\A(\d{1,2})[-/.](\d{1,2})[-/.](\d{4})(?:[T ].*)?\z"
    dby = r"\A(\d{1,2})[- ]([A-Za-z]{3})[A-Za-z]*\.?[- ,]+(\d{4})\z"
    bdy = r"\A([A-Za-z]{3})[A-Za-z]*\.? (\d{1,2})(?:st|nd|rd|th)?,? (\d{4})\z"
    num = r"\A((?:19|20)\d{2})(0[1-9]|1[0-2])(0[1-9]|[12]\d|3[01])(?:\.0+)?\z"
    return (
        F.when(s.rlike(ymd), iso(part(ymd, 1), part(ymd, 2), part(ymd, 3)))
        .when(s.rlike(mdy), iso(part(mdy, 3), part(mdy, 1), part(mdy, 2)))
        .when(s.rlike(dby), iso(part(dby, 3), _month_number(part(dby, 2)), part(dby, 1)))
        .when(s.rlike(bdy), iso(part(bdy, 3), _month_number(part(bdy, 1)), part(bdy, 2)))
        .when(s.rlike(num), iso(part(num, 1), part(num, 2), part(num, 3)))
        .otherwise(code(c))
    )


def award_start(c: Column) -> Column:
    """Start year of an award-year label (its first four digits), else null."""
    return F.regexp_extract(strip(c), r"\A(\d{4})", 1).try_cast("int")


def label(c: Column) -> Column:
    """Header or sheet name in lower case, trimmed, runs of white space as one blank."""
    return F.btrim(F.regexp_replace(F.lower(c), r"(?U)\s+", " "))


def truth(c: Column) -> Column:
    """Boolean of a truth token; null for unknown tokens and null."""
    s = F.lower(strip(c))
    return F.when(s.isin("true", "t", "1", "1.0", "yes", "y"), F.lit(True)).when(s.isin("false", "f", "0", "0.0", "no", "n"), F.lit(False))
