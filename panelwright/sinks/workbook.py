"""Workbooks with data, codebook, value labels and a readme, written as a stream.

A spreadsheet keeps fifteen digits and some characters it cannot hold at all.  The strict
writer refuses such cells; the ledger writer puts visible text in their place and records the
exact value of each, from which the table is restored.  The ledger is a sheet of the workbook
itself, as JSON text that no spreadsheet program decodes, in parts where it is long.
"""

from __future__ import annotations

import json
import math
import zipfile
from collections.abc import Iterable
from itertools import chain
from xml.sax.saxutils import escape

from panelwright.sources import streams, xlsx

MAX_ROWS, MAX_COLUMNS, MAX_TEXT = 1_048_576, 16_384, 32_767
_NS = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_R = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def column_letters(i: int) -> str:
    out = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        out = chr(65 + r) + out
    return out


def text_problem(s: str) -> str | None:
    """Why a text cannot stand in a cell as it is."""
    if len(s.encode("utf-16-le", "surrogatepass")) // 2 > MAX_TEXT:
        return "too_long"
    if any((ord(c) < 32 and c not in "\t\n") or ord(c) in (0xFFFE, 0xFFFF) or 0xD800 <= ord(c) < 0xE000 for c in s):
        return "control_characters"
    if "_x" in s and any(s[i : i + 2] == "_x" and s[i + 6 : i + 7] == "_" for i in range(len(s))):
        return "escape_sequence"
    return None


def number_exact(v: float) -> bool:
    return math.isfinite(v) and float(f"{v:.15g}") == float(v)


def _cell(ref: str, v: object) -> str:
    if v is None:
        return ""
    if isinstance(v, bool):
        return f'<c r="{ref}" t="b"><v>{int(v)}</v></c>'
    if isinstance(v, (int, float)):
        return f'<c r="{ref}"><v>{v!r}</v></c>'
    return f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{escape(str(v))}</t></is></c>'


class Writer:
    """Sheets one after the other; nothing but the current row is held."""

    def __init__(self, path: str):
        self.out = streams.open_out(path)
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_DEFLATED)
        self.names: list[str] = []

    def sheet(self, name: str, head: list[str], rows: Iterable[Iterable[object]]) -> int:
        if len(head) > MAX_COLUMNS:
            raise ValueError("too many columns for a sheet")
        self.names.append(name)
        n = 1
        with self.zip.open(f"xl/worksheets/sheet{len(self.names)}.xml", "w") as f:
            f.write(f'<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="{_NS}"><sheetData>'.encode())
            for i, row in enumerate(chain([head], rows), 1):
                if i > MAX_ROWS:
                    raise ValueError("too many rows for a sheet")
                cells = "".join(_cell(f"{column_letters(j)}{i}", v) for j, v in enumerate(row))
                f.write(f'<row r="{i}">{cells}</row>'.encode("utf-8", "surrogatepass"))
                n = i
            f.write(b"</sheetData></worksheet>")
        return n - 1

    def close(self) -> None:
        sheets = "".join(f'<sheet name="{escape(n)}" sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(self.names, 1))
        rels = "".join(f'<Relationship Id="rId{i}" Type="{_R}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(self.names) + 1))
        types = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for i in range(1, len(self.names) + 1))
        head = '<?xml version="1.0" encoding="UTF-8"?>'
        pkg = "http://schemas.openxmlformats.org/package/2006"
        self.zip.writestr("xl/workbook.xml", f'{head}<workbook xmlns="{_NS}" xmlns:r="{_R}"><sheets>{sheets}</sheets></workbook>')
        self.zip.writestr("xl/_rels/workbook.xml.rels", f'{head}<Relationships xmlns="{pkg}/relationships">{rels}</Relationships>')
        self.zip.writestr("_rels/.rels", f'{head}<Relationships xmlns="{pkg}/relationships"><Relationship Id="rId1" Type="{_R}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        self.zip.writestr("[Content_Types].xml", f'{head}<Types xmlns="{pkg}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>{types}</Types>')
        self.zip.close()
        self.out.close()


#: Characters of one part of a long exact value in the ledger sheet.
PART = 30_000


def visible(text: str) -> str:
    """A text as JSON that a spreadsheet program shows as it is: plain ASCII without escape sequences of its own."""
    return json.dumps(text).replace("_x", "\\u005fx")


def _ledger_rows(noted: list[dict[str, object]]) -> Iterable[list[object]]:
    for n in noted:
        shown = visible(str(n["exact"]))
        for k in range(0, len(shown), PART):
            yield [n["row"], n["column"], n["kind"], k // PART, "=" + shown[k : k + PART]]  # the sign keeps outer blanks and is dropped when read


def read_ledger(path: str) -> list[dict[str, object]]:
    """The ledger of a workbook that :func:`write` made with one."""
    parts: dict[tuple[int, str, str], list[tuple[int, str]]] = {}
    for r in xlsx.records(path, "Exact"):
        parts.setdefault((int(r["row"]), r["column"], r["kind"]), []).append((int(r["part"]), r["exact"][1:]))
    return [{"row": row, "column": c, "kind": k, "exact": json.loads("".join(t for _, t in sorted(p)))} for (row, c, k), p in parts.items()]


def unequal_cells(path: str, columns: list[str], rows: Iterable[tuple]) -> int:
    """Cells of a workbook that differ from the table it was made of, with its ledger put in."""
    bad = 0
    back = restore(list(xlsx.records(path, "Data")), read_ledger(path))
    rows = list(rows)
    for told, row in zip(back, rows):
        for c, v in zip(columns, row):
            got = told.get(c)
            if isinstance(v, bool) or v is None or isinstance(v, str):
                bad += got != (None if v is None else str(v))
            else:
                bad += got is None or type(v)(float(got) if isinstance(v, float) else int(got)) != v
    return bad + abs(len(back) - len(rows)) * len(columns)


def write(path: str, columns: list[str], rows: Iterable[tuple], book: list[dict[str, str]], labels: list[dict[str, object]], readme: list[str], ledger: bool = False) -> list[dict[str, object]]:
    """Sheets Data, Codebook, ValueLabels, README; gives the ledger of cells that needed one.

    Without ``ledger`` a cell that would not come back raises.  With it the sheet shows the
    exact number as text, or the text as JSON, and the ledger holds row, column, kind and
    exact value.  The file takes its place when it is whole.
    """
    noted: list[dict[str, object]] = []

    def safe() -> Iterable[list[object]]:
        for i, row in enumerate(rows, 2):
            out = []
            for c, v in zip(columns, row):
                kind = None
                if isinstance(v, str):
                    kind = text_problem(v)
                    shown: object = visible(v)[:PART] if kind else v  # the ledger has the whole
                elif isinstance(v, float) and not isinstance(v, bool):
                    kind = None if number_exact(v) else "inexact_number"
                    shown = repr(v) if kind else v
                elif isinstance(v, int) and not isinstance(v, bool) and abs(v) >= 10**15:
                    kind, shown = "inexact_number", str(v)
                else:
                    shown = v
                if kind:
                    if not ledger:
                        raise ValueError(f"row {i}, {c}: {kind}")
                    noted.append({"row": i, "column": c, "kind": kind, "exact": v if isinstance(v, str) else repr(v)})
                out.append(shown)
            yield out

    part = f"{path}.part"
    w = Writer(part)
    try:
        w.sheet("Data", columns, safe())
        w.sheet("Codebook", list(book[0]) if book else ["canonical_name"], [list(b.values()) for b in book])
        w.sheet("ValueLabels", list(labels[0]) if labels else ["canonical_name"], [list(b.values()) for b in labels])
        w.sheet("README", ["text"], [[line] for line in readme])
        if ledger:
            w.sheet("Exact", ["row", "column", "kind", "part", "exact"], _ledger_rows(noted))
        w.close()
    except Exception:
        w.zip.close()
        w.out.close()
        streams.remove(part)
        raise
    streams.move(part, path)
    return noted


def restore(records: list[dict[str, object]], noted: list[dict[str, object]]) -> list[dict[str, object]]:
    """Read-back rows (with ``_row``) with the exact values of the ledger put in."""
    exact = {(n["row"], n["column"]): n["exact"] for n in noted}
    return [{k: exact.get((r["_row"], k), v) for k, v in r.items()} for r in records]


def per_year(df, year: str, folder: str, book: list[dict[str, str]], readme: list[str]):
    """One workbook per year, each written and read back by one task; gives a manifest (year, path, rows, cells noted, cells that differ).

    ``folder`` is on a file system that all machines share.  The exact values of cells that a
    spreadsheet cannot hold are in the workbook's ledger.  A sheet holds about a million rows
    at most, which bounds a year's group; more raise.
    """
    import pandas as pd

    columns = df.columns
    whole = {f.name for f in df.schema.fields if f.dataType.typeName() in ("byte", "short", "integer", "long")}

    def plain(c: str, v: object) -> object:
        if v is None or v != v:
            return None
        return int(v) if c in whole else v.item() if hasattr(v, "item") else v

    def export(frame: pd.DataFrame) -> pd.DataFrame:
        y = int(frame[year].iloc[0])
        path = f"{folder.rstrip('/')}/{y}.xlsx"
        rows = [tuple(plain(c, v) for c, v in zip(columns, r)) for r in frame.itertuples(index=False, name=None)]
        noted = write(path, columns, rows, book, [], readme, ledger=True)
        return pd.DataFrame([(y, path, len(rows), len(noted), unequal_cells(path, columns, rows))], columns=["year", "path", "n_rows", "n_noted", "n_unequal"])

    return df.groupBy(year).applyInPandas(export, "year int, path string, n_rows long, n_noted long, n_unequal long")
