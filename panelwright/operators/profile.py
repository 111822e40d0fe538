"""Column-level data quality profile of loads, and changes from load to load.

Everything follows from one exact table of value frequencies per load and column: rows are
unpivoted to (load, column, value) and counted, so a load of any size becomes its distinct
values, by partial aggregation.  Null rates, distinct counts, ranges, violations, medians
and the distances between loads (chi-square, population stability index, total variation)
are read from these frequencies.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LOAD = ["feed_no", "load_seq", "load_id"]


@dataclass(frozen=True)
class Rule:
    """What a column's values should look like: exact ``allowed`` texts, or ``whole`` numbers."""

    allowed: tuple[str, ...] = ()
    whole: bool = False


def deduplicated(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Rows with one ``key`` count once (latest ``loaded_at``, then the largest row).

    Rows without key cannot be told to be repeats, so each distinct one is kept.
    """
    body = F.struct(*[F.col(c) for c in columns])
    alone = F.when(F.col(key).isNull(), F.xxhash64(*[F.col(c) for c in columns], F.col("loaded_at")))
    best = rows.groupBy(F.col(key), alone.alias("__alone")).agg(F.max(F.struct(F.col("loaded_at").alias("t"), body.alias("b")))["b"].alias("b"))
    return best.select(key, *[F.col("b")[c].alias(c) for c in columns])


def frequencies(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(load, field_name, value, number) with the count ``n``; a null value is a row too.

    ``value`` is the column as text (NaN is ``'NaN'``, so not null); ``number`` is set for
    numeric columns.
    """
    types = dict(rows.dtypes)
    cells = []
    for c in columns:
        numeric = types[c] in ("double", "float", "int", "bigint", "smallint", "tinyint") or types[c].startswith("decimal")
        number = F.col(c).cast("double") if numeric else F.lit(None).cast("double")
        cells.append(F.struct(F.lit(c).alias("field_name"), F.col(c).cast("string").alias("value"), number.alias("number")))
    long = rows.select(*LOAD, F.explode(F.array(*cells)).alias("c")).select(*LOAD, "c.field_name", "c.value", "c.number")
    return long.groupBy(*LOAD, "field_name", "value", "number").agg(F.count(F.lit(1)).alias("n"))


def _whole() -> Column:
    v = F.col("number")
    return v.isNotNull() & ~F.isnan(v) & (v >= 0) & (v == F.floor(v).cast("double")) & (v < 1.7e308)


def _violates(rules: dict[str, Rule]) -> Column:
    bad = F.lit(False)
    for name, rule in rules.items():
        wrong = ~_whole() if rule.whole else ~F.col("value").isin(*rule.allowed)
        bad = F.when((F.col("field_name") == name) & F.col("value").isNotNull(), wrong).otherwise(bad)
    return F.coalesce(bad, F.lit(False))


def profile(freq: DataFrame, rules: dict[str, Rule]) -> DataFrame:
    """Per load and column: rows, nulls, NaN, distinct values, ranges, whole-number maximum, violations."""
    known = F.col("value").isNotNull()
    marked = freq.withColumn("bad", _violates(rules)).withColumn("whole", F.when(_whole(), F.col("number")))
    finite = F.when(~F.isnan("number"), F.col("number"))
    return marked.groupBy(*LOAD, "field_name").agg(
        F.sum("n").alias("n_rows"),
        F.sum(F.when(~known, F.col("n")).otherwise(0)).alias("n_null"),
        F.sum(F.when(F.isnan("number"), F.col("n")).otherwise(0)).alias("n_nan"),
        F.count("value").alias("n_distinct"),
        F.sum(F.when(F.col("bad"), F.col("n")).otherwise(0)).alias("n_violations"),
        F.min(finite).alias("min_number"),
        F.max(finite).alias("max_number"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
        F.max("whole").alias("max_whole"),
        F.sum(F.when(F.col("whole").isNotNull(), F.col("n")).otherwise(0)).alias("n_whole"),
    )


def medians(freq: DataFrame) -> DataFrame:
    """Exact median of the whole values from 0 up per load and column.

    Two narrow windows: first over logarithmic buckets of a load (a few thousand at most, as
    a double has), then over the values of the one or two buckets that hold the middle ranks.
    """
    keys = [*LOAD, "field_name"]
    whole = freq.where(_whole()).withColumn("bucket", F.floor(F.log2(F.col("number") + 1) * 64).cast("int"))
    buckets = whole.groupBy(*keys, "bucket").agg(F.sum("n").alias("m"))
    w = Window.partitionBy(*[F.coalesce(F.col(k).cast("string"), F.lit("\0")) for k in keys])
    ranked = buckets.withColumn("total", F.sum("m").over(w)).withColumn("before", F.sum("m").over(w.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)))
    ranked = ranked.withColumn("before", F.coalesce("before", F.lit(0))).withColumn("lo", F.floor((F.col("total") - 1) / 2)).withColumn("hi", F.floor(F.col("total") / 2))
    hits = F.array_distinct(F.array("lo", "hi"))
    held = ranked.withColumn("ranks", F.filter(hits, lambda r: (r >= F.col("before")) & (r < F.col("before") + F.col("m")))).where(F.size("ranks") > 0)
    names = [*keys, "bucket"]
    held = held.select(*[F.col(k).alias(f"h_{k}") for k in names], "before", "ranks")
    cond = reduce(lambda x, y: x & y, (F.col(k).eqNullSafe(F.col(f"h_{k}")) for k in names))
    inside = whole.join(held, cond).select(*names, "number", "n", "before", "ranks")
    v = Window.partitionBy(*[F.coalesce(F.col(k).cast("string"), F.lit("\0")) for k in keys], "bucket").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    at = F.col("before") + F.coalesce(F.sum("n").over(v), F.lit(0))
    placed = inside.withColumn("from", at).withColumn("got", F.filter("ranks", lambda r: (r >= F.col("from")) & (r < F.col("from") + F.col("n"))))
    per_rank = placed.select(*keys, "number", F.explode("got").alias("rank"))
    return per_rank.groupBy(*keys).agg(F.avg("number").alias("median_whole"))


def loads(freq: DataFrame) -> DataFrame:
    """Each load with the load before it of the same feed (null for the first)."""
    w = Window.partitionBy("feed_no").orderBy("load_seq", "load_id")
    known = freq.select(*LOAD).distinct().where("feed_no IS NOT NULL AND load_seq IS NOT NULL AND load_id IS NOT NULL")
    return known.withColumn("previous_id", F.lag("load_id").over(w)).withColumn("next_id", F.lead("load_id").over(w)).withColumn("next_seq", F.lead("load_seq").over(w))


def distances(freq: DataFrame, order: DataFrame) -> DataFrame:
    """Distances between the value shares (among non-nulls) of a load and the one before it.

    Every frequency goes to its own load with its share and to the next load as the share
    before; both meet by a partial aggregate on (load, column, value).  Null where either
    load has no non-null value.
    """
    known = freq.where("value IS NOT NULL")
    keys = [*LOAD, "field_name"]
    totals = known.groupBy(*keys).agg(F.sum("n").alias("total"))
    shares = known.join(totals, keys).join(order, LOAD)
    own = F.struct(F.col("load_id").alias("l"), F.col("load_seq").alias("q"), F.col("n").alias("n"), (F.col("n") / F.col("total")).alias("now"), F.lit(0.0).alias("was"), F.lit(0).cast("bigint").alias("m"))
    later = F.struct(F.col("next_id").alias("l"), F.col("next_seq").alias("q"), F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("now"), (F.col("n") / F.col("total")).alias("was"), F.col("n").alias("m"))
    both = shares.select("feed_no", "field_name", "value", F.explode(F.array(own, later)).alias("s")).where("s.l IS NOT NULL")
    met = both.groupBy("feed_no", F.col("s.q").alias("load_seq"), F.col("s.l").alias("load_id"), "field_name", "value").agg(F.sum("s.n").alias("n"), F.sum("s.m").alias("m"), F.sum("s.now").alias("now"), F.sum("s.was").alias("was"))
    floor = F.lit(1e-4)
    psi = (F.greatest("now", floor) - F.greatest("was", floor)) * F.log(F.greatest("now", floor) / F.greatest("was", floor))
    grouped = met.groupBy(*keys).agg(
        F.sum("n").alias("n_now"),
        F.sum("m").alias("n_was"),
        (F.sum(F.abs(F.col("now") - F.col("was"))) / 2).alias("total_variation"),
        F.sum(psi).alias("stability_index"),
        F.sum(F.pow(F.col("now") - F.col("was"), 2) / (F.col("now") + F.col("was"))).alias("__c"),
    )
    usable = (F.col("n_now") > 0) & (F.col("n_was") > 0)
    chi = F.col("__c") * F.col("n_now") * F.col("n_was") * 2 / (F.col("n_now") + F.col("n_was"))
    return grouped.select(*keys, *[F.when(usable, c).alias(n) for n, c in (("total_variation", F.col("total_variation")), ("stability_index", F.col("stability_index")), ("chi_square", chi))])


def compared(freq: DataFrame, rules: dict[str, Rule]) -> DataFrame:
    """The profile of each load beside that of the load before it, with distances."""
    keys = [*LOAD, "field_name"]
    order = loads(freq)
    own = profile(freq, rules).join(medians(freq), keys, "left")
    w = Window.partitionBy("feed_no", "field_name").orderBy("load_seq", "load_id")
    before = ["n_rows", "n_null", "max_whole", "median_whole"]
    lined = own.where("feed_no IS NOT NULL AND load_seq IS NOT NULL AND load_id IS NOT NULL")
    lined = lined.withColumns({f"previous_{c}": F.lag(c).over(w) for c in before})
    return lined.join(distances(freq, order), keys, "left")


#: Thresholds between loads; fixed values of the problem statement.
NULL_RATE, DISTRIBUTION, MEDIAN_RATIO, MAX_RATIO = 0.201, 0.251, 2.5, 20


def findings(both: DataFrame, rules: dict[str, Rule]) -> DataFrame:
    """(load_id, field_name, finding): pattern, constant, null_rate, distribution, value_range."""
    numeric = F.col("field_name").isin(*[k for k, r in rules.items() if r.whole])
    rate, was = F.col("n_null") / F.col("n_rows"), F.col("previous_n_null") / F.col("previous_n_rows")
    a, b = F.col("median_whole"), F.col("previous_median_whole")
    shifted = F.when(numeric, (a > MEDIAN_RATIO * b) | (b > MEDIAN_RATIO * a)).otherwise(F.col("total_variation") > DISTRIBUTION)
    checks = {
        "pattern": F.col("n_violations") > 0,
        "constant": F.col("n_distinct") == 1,
        "null_rate": F.abs(rate - was) > NULL_RATE,
        "distribution": shifted,
        "value_range": numeric & (F.col("max_whole") > MAX_RATIO * F.col("previous_max_whole")),
    }
    hits = F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in checks.items()]))
    return both.select("load_id", "field_name", F.explode(hits).alias("finding"))
