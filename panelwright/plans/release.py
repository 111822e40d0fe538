"""A release: one table as Parquet, CSV, workbooks and statistics files, with codebook, masks, schema and manifest."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.functions import names
from panelwright.operators import conserve, keys, metadata
from panelwright.sinks import bundle, store, tables, workbook
from panelwright.sources import streams
from panelwright.sources.tables import NULL_TOKEN, typed_csv


def export(df: DataFrame, target: str, key: list[str], about: dict[str, str], definitions: dict[str, str] | None = None, partition: str | None = None, year: str | None = None, families: dict[str, list[str]] | None = None) -> DataFrame:
    """Writes a release folder in one step and gives its inventory (path, bytes, sha256).

    The key is checked first.  Every format is read back and compared cell by cell with the
    table before the folder takes its name; a failure leaves nothing behind.  With ``year``
    (a whole number per row) there is one workbook per year; with ``families`` (column lists)
    there are statistics files, one per family and as many as its width and length need.
    """
    spark = df.sparkSession
    keys.require_key(df, key, "release")
    book = metadata.codebook(df, definitions)
    metadata.check_codebook(book, df.columns)
    with store.Staged(spark, target) as stage:
        tables.labelled_parquet(df, f"{stage.path}/parquet", book, partition, order=key)
        tables.token_csv(df, f"{stage.path}/csv")
        tables.masks(df, key, f"{stage.path}/null_masks")
        for kind, back in (("Parquet", spark.read.parquet(f"{stage.path}/parquet").select(*df.columns)), ("CSV", typed_csv(spark, f"{stage.path}/csv", df.schema))):
            unchanged(df, back, key, kind)
        if year:
            told = workbook.per_year(df, year, f"{stage.path}/workbooks", book, [f"{k}: {v}" for k, v in sorted(about.items())])
            told = told.collect()  # one row per calendar year
            if any(r["n_unequal"] for r in told):
                raise ValueError(f"cells changed in workbooks of {[r['year'] for r in told if r['n_unequal']]}")
        if families is not None:
            modules(df, f"{stage.path}/statistics", key, families, book)
        texts = {"codebook.json": book, "about.json": about, "schema.json": bundle.web_schema(book, "csv", key, NULL_TOKEN)}
        for name, value in texts.items():
            stage.write_text(name, json.dumps(value, indent=1, sort_keys=True))
        for kind, name in (("python", "load.py"), ("r", "load.R"), ("stata", "load.do")):
            stage.write_text(name, bundle.loader_script(kind, "csv", book, NULL_TOKEN))
        listed = [r.asDict() for r in store.inventory(spark, stage.path).orderBy("path").collect()]  # files, not rows
        stage.write_text("manifest.json", json.dumps(listed, indent=1))
    return store.inventory(spark, target)


def unchanged(df: DataFrame, back: DataFrame, key: list[str], kind: str) -> None:
    """Raises if a table read back differs from what was written, cell by cell."""
    bad = [r["column"] for r in conserve.cell_differences(df, back, key).where("mismatched_cells > 0").collect()]
    if bad:
        raise ValueError(f"cells changed in {kind}: {bad}")


def modules(df: DataFrame, folder: str, key: list[str], families: dict[str, list[str]], book: list[dict[str, str]]) -> list[str]:
    """Statistics files of a table's families, read back and compared; gives their paths.

    Columns take their portable names.  Null text is empty there, told apart by the masks.
    """
    spark = df.sparkSession
    label = {b["portable_name"]: b["label"] for b in book}
    short = names.of(spark, df.columns, names.STATISTICS)
    paths = []
    for name, columns in tables.topics(df.columns, key, families).items():
        if len(columns) == len(key):
            continue
        part = df.select(*[F.col(c).alias(short[c]) for c in columns])
        path = f"{folder}/{name}.dta"
        tables.stata(part, path, label)
        with streams.open_in(path) as f:
            import pandas as pd

            frame = pd.read_stata(f, convert_categoricals=False)
        back = spark.createDataFrame(frame).select(*[F.col(c).cast(part.schema[c].dataType).alias(c) for c in part.columns])
        numbers = [c for c, t in part.dtypes if t in ("double", "float")]
        back = back.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in numbers})
        filled = part.withColumns({c: F.coalesce(F.col(c), F.lit("")) for c, t in part.dtypes if t == "string"})
        unchanged(filled, back, [short[k] for k in key], f"the statistics file {name}")
        paths.append(path)
    return paths
