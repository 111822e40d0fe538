"""Text functions that Spark does not have: likeness, UTF-16 length, exact decimals."""

from __future__ import annotations

import math
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.DoubleType())
def name_similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Matching-blocks ratio of two names (not an edit distance); null if either is null or empty."""
    return pd.Series([SequenceMatcher(None, x, y).ratio() if isinstance(x, str) and isinstance(y, str) and x and y else None for x, y in zip(a, b)], dtype="float64")


def name_key(c: Column) -> Column:
    """Name in lower case, words only, for comparing."""
    return F.btrim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", " "))


def utf16_units(c: Column) -> Column:
    """Length of a text as UTF-16 stores it."""
    return (F.octet_length(F.encode(c, "UTF-16LE")) / 2).cast("int")


def byte_excerpt(c: Column, budget: int) -> Column:
    """The longest start of a text within a budget of UTF-8 bytes, on a character boundary."""
    raw = F.encode(c, "UTF-8")
    # a character has four bytes at most, so one of four starts ends on a boundary
    starts = [F.try_validate_utf8(F.substring(raw, 1, max(0, budget - k)).cast("string")) for k in range(4)]
    return F.when(F.octet_length(c) <= budget, c).otherwise(F.coalesce(*starts))


@F.pandas_udf(T.BooleanType())
def fits_15_digits(values: pd.Series) -> pd.Series:
    """True if a number survives being written with fifteen significant digits."""
    return values.map(lambda v: None if v is None or pd.isna(v) else bool(math.isfinite(v) and float(f"{v:.15g}") == v))


@F.pandas_udf(T.BooleanType())
def within_one_ulp(a: pd.Series, b: pd.Series) -> pd.Series:
    """True if two numbers differ by one unit in the last place at most."""
    return pd.Series([None if pd.isna(x) or pd.isna(y) else abs(x - y) <= math.ulp(max(abs(x), abs(y))) for x, y in zip(a, b)], dtype="object")
