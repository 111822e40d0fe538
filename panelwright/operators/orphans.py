"""References to records that do not exist, per table, field and period."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.operators import skew
from panelwright.session import cut

KEY = ["ref_unitid", "ref_year"]


def references(source: DataFrame, table: str, record_key: str, year: str, fields: list[str]) -> DataFrame:
    """Long form of the reference columns of one table; null references are left out."""
    ref = F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).alias("ref_unitid")) for f in fields]))
    rows = source.select(F.col(record_key).alias("record_key"), F.col(year).alias("ref_year"), ref.alias("r"))
    return rows.select(F.lit(table).alias("source_table"), "r.field_name", "ref_year", "record_key", "r.ref_unitid").where("ref_unitid IS NOT NULL AND ref_year IS NOT NULL")


def counted(refs: DataFrame) -> DataFrame:
    """References pre-aggregated per key, period, table and field, written once.

    A key that holds a third of all rows is a few rows after the map side.
    """
    return cut(refs.groupBy(*KEY, "source_table", "field_name").agg(F.count(F.lit(1)).alias("n_references")))


def _keys(counts: DataFrame) -> tuple[DataFrame, int]:
    """(references per key, number from which a key is heavy)."""
    keys = counts.groupBy(*KEY).agg(F.sum("n_references").alias("n"))
    total = counts.agg(F.coalesce(F.sum("n_references"), F.lit(0)).alias("n")).collect()[0]["n"]
    return keys, skew.hot_limit(int(total))


def orphan_keys(counts: DataFrame, directory: DataFrame) -> DataFrame:
    """(ref_unitid, ref_year) named by a reference without a record, with counts and ``kind``.

    ``counts`` is a table of :func:`counted`.  Heavy keys (more than :func:`skew.hot_limit`
    references) are checked against the records broadcast for them alone; remaining keys take
    a shuffled anti-join.  Both orphan sets are united and told apart by the unit's first and
    last year.
    """
    keys, limit = _keys(counts)
    records = directory.select(F.col("unitid").alias("ref_unitid"), F.col("ipeds_year").alias("ref_year"))
    heavy, light = keys.where(F.col("n") > limit), keys.where(F.col("n") <= limit)
    heavy_records = records.join(F.broadcast(heavy.select(*KEY)), KEY, "left_semi").distinct()  # at most skew.MAX_HOT keys
    lost_heavy = heavy.join(F.broadcast(heavy_records), KEY, "left_anti")
    lost_light = light.hint("shuffle_merge").join(records, KEY, "left_anti")
    lost = lost_heavy.unionByName(lost_light)
    span = directory.groupBy(F.col("unitid").alias("ref_unitid")).agg(F.min("ipeds_year").alias("first_year"), F.max("ipeds_year").alias("last_year"))
    kind = F.when(F.col("first_year").isNull(), "never").when(F.col("first_year") > F.col("ref_year"), "not_yet").when(F.col("last_year") < F.col("ref_year"), "gone").otherwise("gap")
    return lost.join(span, "ref_unitid", "left").select(*KEY, F.col("n").alias("n_references"), kind.alias("kind"))


def orphan_rows(refs: DataFrame, counts: DataFrame, lost: DataFrame) -> DataFrame:
    """The references themselves whose key is lost, one row each.

    Rows of every heavy key, lost or not, are told by broadcast: those of a key that exists
    drop out before anything is shuffled.  Only rows of light keys meet by shuffle.
    """
    keys, limit = _keys(counts)
    heavy = keys.where(F.col("n") > limit).select(*KEY).join(lost.select(*KEY, "kind"), KEY, "left").withColumn("__heavy", F.lit(True))
    marked = refs.join(F.broadcast(heavy), KEY, "left")  # at most skew.MAX_HOT keys
    known = marked.where("__heavy AND kind IS NOT NULL").drop("__heavy")
    light = lost.where(F.col("n_references") <= limit).select(*KEY, "kind")
    rest = marked.where("__heavy IS NULL").drop("__heavy", "kind").join(light, KEY)
    return known.unionByName(rest).select("source_table", "field_name", "ref_year", "record_key", "ref_unitid", "kind")


def summary(counts: DataFrame, lost: DataFrame) -> DataFrame:
    """Orphan counts per table, field, period and kind, from pre-aggregated references."""
    return (
        counts.join(lost.select(*KEY, "kind"), KEY)
        .groupBy("source_table", "field_name", "ref_year", "kind")
        .agg(F.sum("n_references").alias("n_references"), F.countDistinct("ref_unitid").alias("n_units"))
    )


def union_references(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)
