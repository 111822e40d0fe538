"""Codebooks and value labels: scoped joins, year-scoped labels, coverage of columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.operators.periods import year_ranges


def scoped_join(variables: DataFrame, codes: DataFrame, scope: list[str], name: str = "varname", number: str = "varnumber") -> DataFrame:
    """Codes of each variable in its exact scope.

    Scope and name must be equal; numbers must be equal only if both are known.  The
    condition on numbers is a residual of the equi-join.
    """
    c = codes.select(*[F.col(x).alias(f"__{x}") for x in [*scope, name, number]], *[x for x in codes.columns if x not in (*scope, name, number)])
    on = F.col(name) == F.col(f"__{name}")
    for s in scope:
        on = on & (F.col(s) == F.col(f"__{s}"))
    a, b = F.coalesce(F.col(number), F.lit("")), F.coalesce(F.col(f"__{number}"), F.lit(""))
    joined = variables.join(c, on & ((a == "") | (b == "") | (a == b)))
    return joined.drop(*[f"__{x}" for x in [*scope, name]]).withColumnRenamed(f"__{number}", f"code_{number}")


def exact_keys(lineage: DataFrame, dictionary: DataFrame, values: DataFrame, key: list[str]) -> DataFrame:
    """Value labels whose key is in the lineage and in the dictionary: two semi-joins."""
    return values.join(lineage.select(*key).distinct(), key, "left_semi").join(dictionary.select(*key).distinct(), key, "left_semi")


def scoped_labels(labels: DataFrame, variable: str, year: str, code: str, label: str) -> DataFrame:
    """(variable, code, labels): label text with the years it held, ``2004,2007: Yes; 2005: Included``.

    Raises if a code has two labels in one year.
    """
    twice = labels.groupBy(variable, code, year).agg(F.countDistinct(label).alias("n")).where("n > 1")
    if twice.limit(1).count():
        raise ValueError("a code has two labels in one year")
    ranges = year_ranges(labels, [variable, code, label], year, "years")
    first = labels.groupBy(variable, code, label).agg(F.min(year).alias("__f"))
    part = F.struct(F.col("__f"), F.concat_ws(": ", F.col("years"), F.col(label)).alias("t"))
    both = ranges.join(first, [variable, code, label]).select(variable, code, part.alias("s"))
    return both.groupBy(variable, code).agg(F.array_join(F.transform(F.array_sort(F.collect_list("s")), lambda x: x["t"]), "; ").alias("labels"))


def source_audit(dictionary: DataFrame, lineage: DataFrame | None) -> DataFrame:
    """Whether the table that values came from is the one the dictionary names, per year and variable.

    Columns of both: year, variable, variable_id, source_file, access_table_name; lineage may
    have transformation_id and lineage_role.  Names are compared without case.  Without any
    lineage every entry says so.
    """
    if lineage is None:
        return dictionary.select("year", "variable", F.lit(0).alias("lineage_source_count"), F.lit("lineage_unavailable").alias("source_metadata_status"))
    ident = ["variable_id", "source_file", "access_table_name"]
    low = [F.lower(F.btrim(F.coalesce(F.col(c), F.lit("")))).alias(c) for c in ident]
    role = F.lit(True)
    for c, good in (("transformation_id", "identity"), ("lineage_role", "direct")):
        if c in lineage.columns:
            role = role & (F.lower(F.btrim(F.coalesce(F.col(c), F.lit("")))) == good)
    origin = lineage.select("year", "variable", F.struct(*low).alias("o"), role.alias("plain")).groupBy("year", "variable").agg(F.array_sort(F.collect_set("o")).alias("origins"), F.every("plain").alias("plain"))
    want = dictionary.select("year", "variable", *low)
    j = want.join(origin, ["year", "variable"], "left")
    one = F.try_element_at("origins", F.lit(1))
    complete = (F.col("variable_id") != "") & (F.col("source_file") != "") & (F.col("access_table_name") != "")
    status = (
        F.when(~complete, "dictionary_source_identity_incomplete")
        .when(F.col("origins").isNull(), "lineage_entry_missing")
        .when(F.size("origins") != 1, "ambiguous_lineage_sources")
        .when((one["variable_id"] != F.col("variable_id")) | (one["source_file"] != F.col("source_file")), "variable_or_source_family_conflict")
        .when(one["access_table_name"] != F.col("access_table_name"), "source_table_conflict")
        .when(~F.col("plain"), "nonidentity_lineage_requires_review")
        .otherwise("verified_annual_source_identity")
    )
    return j.select("year", "variable", F.coalesce(F.size("origins"), F.lit(0)).alias("lineage_source_count"), status.alias("source_metadata_status"))


def definition_rules(dictionary: DataFrame, needed: dict[str, str], refused: str) -> DataFrame:
    """(year, variable, available, reference_start) from the wording of annual definitions.

    ``dictionary`` has year, variable, title, description and access_table_name.  A variable is
    available in a year if its wording matches its pattern in ``needed``; wording that matches
    ``refused`` (another population) raises, as does a second definition of a year.
    """
    from panelwright.functions import labels

    words = F.lower(F.concat_ws(" ", "title", "description"))
    rows = dictionary.where(F.col("variable").isin(*needed)).withColumn("words", words)
    twice = rows.groupBy("year", "variable").count().where("count > 1").limit(1).count()
    if twice or rows.where(F.col("words").rlike(refused)).limit(1).count():
        raise ValueError("an annual definition is ambiguous or describes another population")
    pattern = F.lit(None).cast("boolean")
    for name, regex in needed.items():
        pattern = F.when(F.col("variable") == name, F.col("words").rlike(regex)).otherwise(pattern)
    return rows.select("year", "variable", pattern.alias("available"), labels.reference_start(F.col("access_table_name")).alias("reference_start"))


def codebook(df: DataFrame, definitions: dict[str, str] | None = None) -> list[dict[str, str]]:
    """One entry per column: name, type, portable name, label, family, role of companion columns."""
    from panelwright.functions import names

    have = df.columns
    short = names.of(df.sparkSession, have, names.STATISTICS)
    measures = {c for c in have if f"{c}__status" in have}
    out = []
    for f in df.schema.fields:
        base, _, tail = f.name.rpartition("__")
        companion = base in measures and tail in ("status", "raw_token", "lower_bound", "upper_bound")
        out.append(
            {
                "canonical_name": f.name,
                "portable_name": short[f.name],
                "original_dtype": f.dataType.simpleString(),
                "family": f.name.split("__")[0] if "__" in f.name else "",
                "role": "companion" if companion else "measure" if f.name in measures else "attribute",
                "label": (definitions or {}).get(f.name, f.name.replace("__", " ").replace("_", " "))[:80],
            }
        )
    return out


def check_codebook(book: list[dict[str, str]], columns: list[str]) -> None:
    """Raises unless the codebook covers exactly these columns with valid, distinct short names."""
    if [b["canonical_name"] for b in book] != list(columns):
        raise ValueError("the codebook does not list the columns in their order")
    short = [b["portable_name"] for b in book]
    if len(set(short)) != len(short) or any(not 1 <= len(s) <= 32 for s in short):
        raise ValueError("portable names repeat or are too long")
    if any(not 1 <= len(b["label"]) <= 80 for b in book):
        raise ValueError("labels must have 1 to 80 letters")


def with_metadata(df: DataFrame, book: list[dict[str, str]]) -> DataFrame:
    """The table with its codebook in the schema's field metadata; it survives Parquet."""
    told = {b["canonical_name"]: b for b in book}
    return df.select(*[F.col(f"`{c}`").alias(c, metadata=told.get(c, {})) for c in df.columns])
