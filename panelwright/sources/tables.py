"""Typed and text tables: pruned Parquet, CSV with a null token, lineage, the annual directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from panelwright.functions import ids
from panelwright.sources import files

NULL_TOKEN = "__FSA_NULL__"
#: Options under which "", quotes, line ends, blanks and the literal NA come back as they were.
CSV = {"header": "true", "escape": '"', "multiLine": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def parquet(spark: SparkSession, path: str, columns: list[str] | None = None, where: str | None = None) -> DataFrame:
    """A Parquet table; columns that it lacks are left out, a filter on raw columns is pushed down."""
    df = spark.read.parquet(path)
    df = df.where(where) if where else df
    return df.select(*[c for c in columns if c in df.columns]) if columns else df


def typed_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV (gzipped or not) with the types of a codebook; only the null token is null."""
    return spark.read.schema(schema).options(**CSV, nullValue=NULL_TOKEN, emptyValue="").csv(path)


def text_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with all columns as text and no nulls."""
    df = spark.read.options(**CSV, inferSchema="false").csv(path)
    return df.na.fill("")


def lineage(table: DataFrame, columns: list[str], years: list[int], order: list[str]) -> DataFrame:
    """Distinct lineage records of some years, in a fixed order."""
    return table.where(F.col("year").isin(years)).select(*columns).distinct().orderBy(*order)


def directory(spark: SparkSession, folder: str, years: list[int]) -> tuple[DataFrame, DataFrame, list[dict[str, object]]]:
    """(records, rejects, sources) of the annual directory in a folder of archives or CSV files.

    Per year ``hdYYYY`` is joined with ``flagsYYYY`` where there is one; a year without a
    source is listed as missing, not skipped in silence.  Flags are available only where all
    four scope fields are there, whichever of the two files holds them.  Invalid ids become null and are
    listed among the rejects.  Years are united by column name.
    """
    from panelwright.sources.datasource import register

    register(spark)
    parts, listed = [], []
    for y in years:
        path = files.find_source(folder, f"hd{y}")
        listed.append({"ipeds_year": y, "path": path, "status": "loaded" if path else "missing_source"})
        if not path:
            continue
        hd = spark.read.format("zipcsv").option("stems", f"hd{y}").load(path)
        flags_path = files.find_source(folder, f"flags{y}")
        if flags_path:
            flags = spark.read.format("zipcsv").option("stems", f"flags{y}").load(flags_path).drop("_source", "_row")
            own = [c for c in flags.columns if c == "unitid" or c not in hd.columns]
            hd = hd.join(flags.select(*own).withColumn("__f", F.lit(True)), "unitid", "left")
            present = F.coalesce("__f", F.lit(False))
        else:
            present = F.lit(True)  # scope fields may be part of the directory itself
        there = {c.lower() for c in hd.columns} >= {"prch_f", "idx_f", "prch_sfa", "idx_sfa"}
        hd = hd.withColumn("ipeds_flags_available", present & F.lit(there)).drop("__f")
        parts.append(hd.withColumn("ipeds_year", F.lit(y)).withColumnRenamed("_source", "ipeds_source_member"))
    if not parts:
        raise FileNotFoundError(f"no directory source in {folder}")
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p, allowMissingColumns=True)
    rows = rows.withColumn("opeid8", ids.full_opeid(F.col("opeid"))).withColumn("unitid_text", F.col("unitid")).withColumn("unitid", ids.integral(F.col("unitid_text")))
    rejects = rows.where(F.col("unitid").isNull() | (F.col("unitid") <= 0) | (F.col("opeid8").isNull() & ~F.btrim(F.coalesce("opeid", F.lit(""))).isin("", "-2")))
    kept = rows.where("unitid > 0").drop("unitid_text", "_row")
    return kept, rejects.select("ipeds_year", "ipeds_source_member", "_row", "unitid_text", "opeid"), listed
