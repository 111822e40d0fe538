"""Identifier expressions: institution ids, award years, code spellings, token lists.

All take and give Columns.  Full matches use ``\\A...\\z`` because ``$`` would accept a
trailing line end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.functions import clean

#: Tokens that say "no match" in a list of unit ids.
NO_MATCH = ("", "-2", "no match", "no matches", "nan", "none", "<na>")


def full_opeid(c: Column) -> Column:
    """Eight-digit institution id of one to eight digits with optional zero decimals, else null.

    Ids are padded, never cut; all zeros and anything else give null.
    """
    s = clean.strip(c)
    padded = F.lpad(F.split(s, r"\.")[0], 8, "0")
    return F.when(s.rlike(r"\A[0-9]{1,8}(\.0+)?\z"), F.nullif(padded, F.lit("00000000")))


def opeid_root(c: Column) -> Column:
    """Six-character group root of an eight-digit id; for diagnostics, never for assignment."""
    return F.concat(F.lit("0"), F.substring(c, 2, 5))


def award_year_start(c: Column) -> Column:
    """Start year of ``YYYY``, ``YYYY-YY`` or ``YYYY-YYYY`` (hyphen or dash) if the end fits, else null."""
    s = clean.strip(c)
    y = F.regexp_extract(s, r"\A(\d{4})", 1).try_cast("int")
    end = F.regexp_extract(s, r"\A\d{4}[-–](\d{2}|\d{4})\z", 1)
    ok = F.when(s.rlike(r"\A\d{4}\z"), True).when(F.length(end) == 2, end.try_cast("int") == (y + 1) % 100).when(F.length(end) == 4, end.try_cast("int") == y + 1)
    return F.when(F.coalesce(ok, F.lit(False)), y)


def award_year_label(start: Column) -> Column:
    return F.concat(start.cast("string"), F.lit("-"), (start + 1).cast("string"))


def opeid_format(c: Column) -> Column:
    """Format class of a stored id: missing, not applicable, eight digits, alphanumeric branch, unrecognised.

    The stored text is judged as it is: blanks at its ends make it unrecognised.
    """
    return (
        F.when(c.isNull() | (c == ""), "source_missing")
        .when(c == "-2", "not_applicable")
        .when(c.rlike(r"\A[0-9]{8}\z") & (c != "00000000"), "numeric8_format_only_not_verified_match")
        .when(c.rlike(r"\A[0-9]{6}[A-Z][0-9]\z"), "ipeds_alpha_reporting_branch_not_exact_fsa_id")
        .otherwise("unrecognized_source_identifier")
    )


def opeid_numeric8(c: Column) -> Column:
    """The id if it may be looked up exactly."""
    return F.when(opeid_format(c) == "numeric8_format_only_not_verified_match", c)


def opeid_views(df: DataFrame, column: str) -> DataFrame:
    """Adds ``<column>__numeric8`` and ``<column>__format`` to a table with stored ids.

    Ids must be stored as text, as numbers lose their leading zeros, and without white space
    at their ends; both are checked before anything else is done.
    """
    kind = df.schema[column].dataType.simpleString()
    if kind != "string":
        raise TypeError(f"{column} is stored as {kind}, not as text")
    c = F.col(column)
    if not df.where(c != F.btrim(c)).isEmpty():
        raise ValueError(f"{column} has values with white space at their ends")
    return df.withColumns({f"{column}__numeric8": opeid_numeric8(c), f"{column}__format": opeid_format(c)})


def lossless_integer(c: Column) -> Column:
    """Integer of a canonical spelling only (``-?0|[1-9][0-9]*``), so nothing is lost; else null."""
    return F.when(c.rlike(r"\A(-?[1-9][0-9]*|0)\z"), c.try_cast("bigint"))


def canonical_code(c: Column) -> Column:
    """``'1.0'`` as ``'1'``; other text trimmed."""
    return F.regexp_replace(clean.strip(c), r"\.0+\z", "")


def integral(c: Column) -> Column:
    """Whole finite number of a tolerant numeric spelling, else null."""
    n = clean.strip(c).try_cast("double")
    return F.when(~F.isnan(n) & (F.abs(n) < 9e15) & (n == F.floor(n)), n.cast("bigint"))


def unit_tokens(c: Column) -> Column:
    """Struct of a list field parted by bars: distinct unit ids in order, unparsed tokens, complete.

    Six-digit ids (zero decimals allowed) are units; no-match words are nothing; any other
    token stays as unparsed text and makes the field incomplete.
    """
    tokens = F.transform(F.split(F.coalesce(c, F.lit("")), r"\|"), lambda t: F.btrim(t))
    ids = F.filter(tokens, lambda t: t.rlike(r"\A[1-9][0-9]{5}(\.0+)?\z"))
    units = F.array_distinct(F.transform(ids, lambda t: F.split(t, r"\.")[0].cast("bigint")))
    bad = F.filter(tokens, lambda t: ~t.rlike(r"\A[1-9][0-9]{5}(\.0+)?\z") & ~F.lower(t).isin(*NO_MATCH))
    return F.struct(units.alias("units"), bad.alias("unparsed"), (F.size(bad) == 0).alias("complete"))


def source_record_id(*parts: Column) -> Column:
    """Parts joined by bars; a null part is empty."""
    return F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
