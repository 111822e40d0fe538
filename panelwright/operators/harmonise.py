"""Columns made from several: checked coalesce, choice by year, missing codes with a ledger, categories."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.functions import labels


class ConflictError(ValueError):
    """Two sources disagree, or a rule does not cover what it meets."""


def _known(df: DataFrame, c: str) -> Column:
    """The value, with NaN as null (sources that cannot tell them apart)."""
    return F.when(~F.isnan(c), F.col(c)) if dict(df.dtypes)[c] in ("double", "float") else F.col(c)


def coalesce_report(df: DataFrame, sources: list[str]) -> DataFrame:
    """One row: rows with several known sources, and those where they conflict."""
    known = F.array_compact(F.array(*[_known(df, c) for c in sources]))
    return df.agg(F.count_if(F.size(known) > 1).alias("overlap_rows"), F.count_if(F.size(F.array_distinct(known)) > 1).alias("conflict_rows"))


def coalesce_checked(df: DataFrame, sources: list[str], target: str) -> DataFrame:
    """First known source as ``target``; raises if any row has two different known values.

    An empty text is a value; null and NaN are not.
    """
    bad = coalesce_report(df, sources).collect()[0]["conflict_rows"]
    if bad:
        raise ConflictError(f"{target}: {bad} rows have different values in {sources}")
    return df.withColumn(target, F.coalesce(*[_known(df, c) for c in sources]))


@dataclass(frozen=True)
class YearRule:
    source: str
    first: int
    last: int


def year_partition(df: DataFrame, year: str, rules: list[YearRule], target: str, exempt: tuple[str, ...] = ()) -> DataFrame:
    """``target`` taken from the column whose years hold the row's year.

    Rules must not overlap and must cover every year present; a value of a source outside its
    years raises (columns in ``exempt``, such as statuses, may have some).
    """
    ordered = sorted(rules, key=lambda r: r.first)
    for a, b in zip(ordered, ordered[1:]):
        if b.first <= a.last:
            raise ConflictError(f"{target}: years of {a.source} and {b.source} overlap")
    if any(r.first > r.last for r in rules):
        raise ConflictError(f"{target}: a rule ends before it begins")
    inside = {r.source: F.lit(False) for r in rules}
    covered = F.lit(False)
    for r in rules:
        hit = F.coalesce(F.col(year).between(r.first, r.last), F.lit(False))
        inside[r.source] = inside[r.source] | hit
        covered = covered | hit
    stray = [F.count_if(~inside[c] & _known(df, c).isNotNull()).alias(f"s{i}") for i, c in enumerate(inside) if c not in exempt]
    row = df.agg(F.count_if(F.col(year).isNotNull() & ~covered).alias("open"), *stray).collect()[0].asDict()
    if row.pop("open"):
        raise ConflictError(f"{target}: some years are not covered")
    if any(row.values()):
        raise ConflictError(f"{target}: a source has values outside its years")
    pick = F.lit(None).cast(dict(df.dtypes)[rules[0].source])
    for r in rules:
        pick = F.when(F.col(year).between(r.first, r.last), _known(df, r.source)).otherwise(pick)
    return df.withColumn(target, pick)


@dataclass(frozen=True)
class MissingRule:
    column: str
    year: int
    code: str
    reason: str
    rule_id: str


def recode_missing(df: DataFrame, keys: list[str], year: str, rules: list[MissingRule]) -> tuple[DataFrame, DataFrame]:
    """(table with coded cells set to null, ledger of every such cell).

    The ledger has the keys, column, original value as text, reason and rule, and is enough to
    undo the change.  Two rules that hit one cell raise.  All rules of a column are one
    expression, and the ledger is unpivoted from the same pass over the columns concerned.
    """
    types = dict(df.dtypes)
    by_column: dict[str, list[MissingRule]] = {}
    for r in rules:
        by_column.setdefault(r.column, []).append(r)
    hits = {}
    for c, some in by_column.items():
        numeric = types[c] in ("double", "float", "int", "bigint", "smallint", "tinyint")
        told = [F.when((F.col(year) == r.year) & labels.matches_code(F.col(c), numeric, r.code), F.struct(F.lit(r.rule_id).alias("rule_id"), F.lit(r.reason).alias("reason"))) for r in some]
        hits[c] = F.array_compact(F.array(*told))
    if not hits:
        return df, df.select(*keys).limit(0).select(*keys, *[F.lit("").alias(c) for c in ("column", "original_value", "rule_id", "reason")])
    twice = df.agg(*[F.count_if(F.size(h) > 1).alias(c) for c, h in hits.items()]).collect()[0].asDict()
    if any(twice.values()):
        raise ConflictError(f"several rules hit one cell: {[c for c, n in twice.items() if n]}")
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("original_value"), F.try_element_at(h, F.lit(1)).alias("hit")) for c, h in hits.items()]))
    ledger = df.select(*keys, cells.alias("s")).where("s.hit IS NOT NULL").select(*keys, "s.column", "s.original_value", "s.hit.rule_id", "s.hit.reason")
    clean = df.withColumns({c: F.when(F.size(h) == 0, F.col(c)) for c, h in hits.items()})
    return clean, ledger


def restore_missing(clean: DataFrame, ledger: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Undo :func:`recode_missing` from the ledger."""
    wide = ledger.groupBy(*keys).pivot("column", columns).agg(F.first("original_value"))
    renamed = wide.select(*keys, *[F.col(f"`{c}`").alias(f"__{c}") for c in columns])
    types = dict(clean.dtypes)
    back = clean.join(renamed, keys, "left")
    return back.withColumns({c: F.coalesce(c, F.col(f"__{c}").cast(types[c])) for c in columns}).drop(*[f"__{c}" for c in columns])


def encode_categories(df: DataFrame, column: str, codes: dict[str, int], out: str) -> DataFrame:
    """Public integer code of each category; raises for a known value without a code.

    The table of codes is a parameter of bounded size and becomes a map literal.
    """
    table = F.create_map(*[x for k, v in codes.items() for x in (F.lit(k), F.lit(v))])
    coded = F.try_element_at(table, F.col(column))
    if df.where(F.col(column).isNotNull() & coded.isNull()).limit(1).count():
        raise ConflictError(f"{column} has values without a code")
    return df.withColumn(out, coded.cast("int"))


def numeric_category(df: DataFrame, column: str) -> DataFrame:
    """A category column as integers; raises unless every value is a canonical integer."""
    from panelwright.functions import ids

    n = ids.lossless_integer(F.col(column))
    if df.where(F.col(column).isNotNull() & n.isNull()).limit(1).count():
        raise ConflictError(f"{column} has values that are no canonical integers")
    return df.withColumn(column, n)


def missing_policy(values: DataFrame, lineage: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Rules for missing codes from exact source keys, with the decision on each code.

    The source key (year, source file, table, variable, number; upper case) of a value label
    must be in the lineage and in the dictionary, and all labels of a code must give one
    reason: ``rule``, ``rejected`` or ``retained``.
    """
    key = ["year", "source_file", "access_table_name", "varname", "varnumber"]

    def keyed(df: DataFrame) -> DataFrame:
        text = [F.upper(F.coalesce(F.col(c).cast("string"), F.lit(""))).alias(c) for c in key[1:]]
        return df.select(F.col("year").cast("int").alias("year"), *text, *[c for c in df.columns if c not in key])

    told = keyed(values).withColumn("reason", labels.missing_reason(F.col("analysis_column"), F.col("code"), F.col("label")))
    per = told.groupBy("analysis_column", *key, "code").agg(F.collect_set("reason").alias("reasons"), F.count_if(F.col("reason").isNull()).alias("n_other"), F.array_sort(F.collect_set("label")).alias("labels"))
    both = keyed(lineage.select(*key)).distinct().join(keyed(dictionary.select(*key)).distinct(), key, "left_semi").withColumn("exact", F.lit(True))
    judged = per.join(both, key, "left")
    decision = (
        F.when(F.size("reasons") == 0, "retained")
        .when(F.col("exact").isNull(), "rejected_no_exact_lineage_and_dictionary_key")
        .when((F.size("reasons") > 1) | (F.col("n_other") > 0), "rejected_contradictory_labels")
        .otherwise("rule")
    )
    return judged.select("analysis_column", *key, "code", "labels", F.try_element_at("reasons", F.lit(1)).alias("reason"), F.size("reasons").alias("reasons_count"), decision.alias("decision"))
