"""Tables as Parquet with metadata, CSV with a null token, statistics-program files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.operators.conserve import null_masks
from panelwright.operators.metadata import with_metadata
from panelwright.sources import streams
from panelwright.sources.tables import NULL_TOKEN


#: Bytes of a row group before compression.
ROW_GROUP = 128 * 1024 * 1024


def labelled_parquet(df: DataFrame, path: str, book: list[dict[str, str]], partition: str | None = None, order: list[str] | None = None, row_group: int = ROW_GROUP) -> None:
    """zstd Parquet with the codebook in the fields' metadata, rows in ``order`` within each file."""
    out = with_metadata(df, book)
    if partition:
        out = out.repartition(partition) if order is None else out.repartitionByRange(partition, *order)
    if order:
        out = out.sortWithinPartitions(*([partition] if partition else []), *order)
    writer = out.write.option("compression", "zstd").option("parquet.block.size", str(row_group))
    (writer.partitionBy(partition) if partition else writer).parquet(path)


def token_csv(df: DataFrame, path: str, compression: str = "gzip") -> None:
    """CSV in which only the reserved token is null; raises if a text is that token.

    Empty text, quotes, line ends, outer blanks and the literal NA come back as written.
    """
    texts = [c for c, t in df.dtypes if t == "string"]
    if texts:
        hit = df.agg(*[F.max(F.coalesce(F.col(c) == NULL_TOKEN, F.lit(False))).alias(c) for c in texts]).collect()[0]
        if any(hit):
            raise ValueError("a text equals the reserved null token")
    df.write.options(header="true", nullValue=NULL_TOKEN, escape='"', compression=compression, ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false").csv(path)


def masks(df: DataFrame, keys: list[str], path: str) -> None:
    """The sidecar that tells null from empty text for formats that cannot."""
    null_masks(df, keys).write.parquet(path)


def report_csv(df: DataFrame, path: str) -> None:
    """A small report as one CSV file."""
    df.coalesce(1).write.options(header="true", escape='"').csv(path)


#: Limits of the statistics program: texts beyond this are long strings; whole numbers beyond it are inexact.
LONG_TEXT, EXACT = 120, 2**53
TOPIC_COLUMNS = 2_048
#: Cells of one statistics file, which one process writes; a larger table is cut into modules or refused.
MODULE_CELLS = 50_000_000


def stata(df: DataFrame, path: str, variable_labels: dict[str, str], value_labels: dict[str, dict[int, str]] | None = None) -> int:
    """One module of at most MODULE_CELLS cells as a version 118 file; gives the number of rows.

    The size is checked before anything is gathered.  Null text is written as empty (write :func:`masks` beside it); infinite numbers and whole
    numbers that would lose digits raise.
    """
    import numpy as np

    n = df.count()
    if n * len(df.columns) > MODULE_CELLS:
        raise ValueError(f"{n} rows of {len(df.columns)} columns are too many for one file")
    frame = df.toPandas()
    for c in frame.columns:
        if frame[c].dtype == object:
            frame[c] = frame[c].map(lambda v: "" if v is None else str(v))
        elif np.issubdtype(frame[c].dtype, np.number):
            known = frame[c].dropna()
            if np.isinf(known.astype("float64")).any():
                raise ValueError(f"{c} has infinite numbers")
            if np.issubdtype(frame[c].dtype, np.integer) and (known.abs() > EXACT).any():
                raise ValueError(f"{c} has whole numbers beyond 2^53")
            if np.issubdtype(frame[c].dtype, np.integer) and frame[c].dtype.itemsize == 8:
                frame[c] = frame[c].astype("float64")
        elif frame[c].dtype == bool:
            frame[c] = frame[c].astype("int8")
    long = [c for c in frame.columns if frame[c].dtype == object and frame[c].str.len().max() > LONG_TEXT]
    with streams.open_out(path) as out:
        frame.to_stata(out, version=118, write_index=False, variable_labels={k: v[:80] for k, v in variable_labels.items() if k in frame}, convert_strl=long, value_labels=value_labels or None)
    return len(frame)


def topics(columns: list[str], keys: list[str], families: dict[str, list[str]]) -> dict[str, list[str]]:
    """Column lists of modules: the keys plus a family each, cut at the program's limit; all columns are in some."""
    rest = [c for c in columns if c not in keys]
    told = {c for some in families.values() for c in some}
    groups = {**families, "other": [c for c in rest if c not in told]}
    room = TOPIC_COLUMNS - len(keys)
    out = {}
    for name, some in groups.items():
        some = [c for c in some if c in rest]
        for i in range(0, len(some), room):
            out[name if len(some) <= room else f"{name}_{i // room + 1}"] = [*keys, *some[i : i + room]]
    return out
