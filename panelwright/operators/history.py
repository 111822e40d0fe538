"""History of changing attributes: versions with the period in which each held."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def versions(snapshots: DataFrame, entity: str, period: str, attributes: list[str]) -> DataFrame:
    """Longest runs of consecutive periods in which an entity's attributes stay equal.

    ``snapshots`` has at most one row per entity and (integer) period; nulls compare as equal
    values.  Each entity's rows become one sorted array of structs, which a higher-order
    function folds: a version is appended only where a value changes or a period is missing,
    and is lengthened otherwise.  The versions are then exploded with their end.  An entity's
    array holds one element per distinct period, so its size is bound by the calendar and not
    by the number of rows.  Rows without entity or period are left out; an empty table gives
    an empty one.

    Gives ``entity``, ``valid_from``, ``valid_to``, the attributes and ``n_periods``.
    """
    value = F.struct(*[F.col(a) for a in attributes])
    rows = snapshots.where(F.col(entity).isNotNull() & F.col(period).isNotNull()).select(entity, F.struct(F.col(period).cast("int").alias("p"), value.alias("v")).alias("__s"))
    grouped = rows.groupBy(entity).agg(F.array_sort(F.collect_list("__s")).alias("__a"))
    spec = snapshots.select(value.alias("v")).schema["v"].dataType.simpleString()
    start = F.expr(f"cast(array() as array<struct<f:int,t:int,v:{spec}>>)")

    def step(acc, x):
        last = F.element_at(acc, -1)
        same = (F.size(acc) > 0) & F.try_element_at(acc, F.lit(-1))["v"].eqNullSafe(x["v"]) & (F.try_element_at(acc, F.lit(-1))["t"] + 1 == x["p"])
        new = F.struct(x["p"].alias("f"), x["p"].alias("t"), x["v"].alias("v"))
        longer = F.struct(last["f"].alias("f"), x["p"].alias("t"), last["v"].alias("v"))
        return F.when(same, F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(longer))).otherwise(F.concat(acc, F.array(new)))

    folded = grouped.select(entity, F.explode(F.aggregate("__a", start, step)).alias("__v"))
    return folded.select(
        entity,
        F.col("__v.f").alias("valid_from"),
        F.col("__v.t").alias("valid_to"),
        *[F.col("__v.v")[a].alias(a) for a in attributes],
        (F.col("__v.t") - F.col("__v.f") + 1).alias("n_periods"),
    )
