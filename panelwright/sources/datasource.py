"""Spark data sources for archives and workbooks: ``zipcsv`` and ``xlsxsheet``.

A file is a partition, so many files are read in parallel, each in one task; all columns are
text, and every row keeps its place in the file.

    spark.dataSource.register(ZipCsvSource)
    spark.read.format("zipcsv").option("stems", "hd2010").schema(...).load(folder)
"""

from __future__ import annotations

import os
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from panelwright.sources import files, xlsx


class FilePartition(InputPartition):
    def __init__(self, path: str, stem: str):
        self.path, self.stem = path, stem


class _Reader(DataSourceReader):
    def __init__(self, schema: StructType, parts: list[FilePartition], sheet: str | None):
        self.names, self.parts, self.sheet = [f.name for f in schema.fields], parts, sheet
        self.whole = {f.name for f in schema.fields if f.dataType.simpleString() in ("int", "bigint")}

    def partitions(self) -> list[InputPartition]:
        return self.parts

    def _emit(self, source: str, number: int, row: dict[str, object]) -> tuple:
        extra = {"_source": source, "_row": number}
        return tuple(extra.get(n, row.get(n.lower(), row.get(n))) for n in self.names)

    def read(self, part: FilePartition) -> Iterator[tuple]:
        if self.sheet is not None:
            for row in xlsx.records(part.path, self.sheet):
                number = row.pop("_row")
                yield self._emit(os.path.basename(part.path), number, {k.strip().lower(): v for k, v in row.items()})
            return
        member, data = files.read_member(part.path, part.stem)
        head, body = files.csv_rows(data)
        for i, cells in enumerate(body, 2):
            yield self._emit(member.rsplit("/", 1)[-1], i, dict(zip(head, cells)))


class _Files(DataSource):
    sheet_option = False

    def schema(self) -> str:
        """All columns of the first file as text, with ``_source`` and ``_row``."""
        part = self._parts()[0]
        if self.sheet_option:
            head = [c or "" for c in next(xlsx.rows(part.path, self.options["sheet"]))[1]]
            head = [h.strip().lower() for h in head if h.strip()]
        else:
            head, _ = files.csv_rows(files.read_member(part.path, part.stem)[1])
        return ", ".join([*(f"`{h}` string" for h in head), "_source string", "_row int"])

    def _parts(self) -> list[FilePartition]:
        path = self.options["path"].removeprefix("file:")
        stems = [s for s in self.options.get("stems", "").split(",") if s]
        if os.path.isdir(path):
            if stems:
                found = [(s, files.find_source(path, s)) for s in stems]
                parts = [FilePartition(p, s) for s, p in found if p]
            else:
                parts = [FilePartition(os.path.join(path, n), os.path.splitext(n)[0]) for n in sorted(os.listdir(path)) if n.lower().endswith((".xlsx",) if self.sheet_option else (".zip", ".csv"))]
        else:
            parts = [FilePartition(path, (stems or [os.path.splitext(os.path.basename(path))[0]])[0])]
        if not parts:
            raise FileNotFoundError(f"nothing to read in {path}")
        return parts

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(schema, self._parts(), self.options.get("sheet") if self.sheet_option else None)


class ZipCsvSource(_Files):
    @classmethod
    def name(cls) -> str:
        return "zipcsv"


class XlsxSource(_Files):
    sheet_option = True

    @classmethod
    def name(cls) -> str:
        return "xlsxsheet"


def register(spark) -> None:
    """Makes both formats known to a session."""
    spark.dataSource.register(ZipCsvSource)
    spark.dataSource.register(XlsxSource)
