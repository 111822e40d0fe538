"""The current record of each unit and year of a directory delivered in members."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.functions import clean


def revised(member: Column) -> Column:
    """True for members named ``..._rv.csv`` or ``..._r.csv``."""
    return F.coalesce(F.lower(member).rlike(r"_rv?\.[a-z]+\z"), F.lit(False))


def current_records(directory: DataFrame, columns: list[str]) -> DataFrame:
    """One row per (ipeds_year, unitid): the revised record if there is one, else the latest.

    The revised member wins whatever was loaded last; among equals the latest ``loaded_at``
    wins, then the largest record, so repeated rows and ties give one fixed result.  Rows
    without year or unit name no record and are left out.  The choice is a ``max_by``
    aggregate: repeats collapse before the shuffle, so no key is hot after it.
    """
    body = F.struct(*[F.col(c) for c in columns])
    rank = F.struct(revised(F.col("ipeds_source_member")).alias("r"), F.col("loaded_at").alias("t"), body.alias("b"))
    known = directory.where(F.col("ipeds_year").isNotNull() & F.col("unitid").isNotNull())
    best = known.groupBy("ipeds_year", "unitid").agg(F.max(rank).alias("best"))
    return best.select("ipeds_year", "unitid", *[F.col("best.b")[c].alias(c) for c in columns])


def current_codes(directory: DataFrame, codes: dict[str, str]) -> DataFrame:
    """:func:`current_records` with cleaned columns; ``codes`` maps name to id, code or date."""
    how = {"id": clean.code_id, "code": clean.code, "date": clean.date_code}
    rows = current_records(directory, list(codes))
    return rows.select("ipeds_year", "unitid", *[how[kind](F.col(c)).alias(c) for c, kind in codes.items()])
