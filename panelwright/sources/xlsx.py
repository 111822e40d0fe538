"""Sheets of Office Open XML workbooks as text rows, read as a stream."""

from __future__ import annotations

import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree as ET

from panelwright.sources import streams

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"


def sheet_names(path: str) -> list[str]:
    with streams.open_in(path) as source, zipfile.ZipFile(source) as z:
        return [s.get("name") for s in ET.fromstring(z.read("xl/workbook.xml")).iter(f"{_MAIN}sheet")]


def _target(z: zipfile.ZipFile, sheet: str) -> str:
    book = ET.fromstring(z.read("xl/workbook.xml"))
    rid = next((s.get(f"{_REL}id") for s in book.iter(f"{_MAIN}sheet") if s.get("name") == sheet), None)
    if rid is None:
        raise ValueError(f"no sheet {sheet!r}")
    rels = ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))
    target = next(r.get("Target") for r in rels if r.get("Id") == rid)
    return target.lstrip("/") if target.startswith("/") else f"xl/{target}"


def _shared(z: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in z.namelist():
        return []
    return ["".join(t.text or "" for t in si.iter(f"{_MAIN}t")) for si in ET.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{_MAIN}si")]


def unescape(text: str) -> str:
    """``_x000A_`` and the like as the characters they stand for."""
    return re.sub(r"_x([0-9A-Fa-f]{4})_", lambda m: chr(int(m.group(1), 16)), text)


def column_number(reference: str) -> int:
    n = 0
    for c in re.match(r"[A-Z]+", reference).group(0):
        n = n * 26 + ord(c) - 64
    return n - 1


def rows(path: str, sheet: str) -> Iterator[tuple[int, list[str | None]]]:
    """(row number, cells) of every row; a cell that is not there is null, an empty text is empty."""
    with streams.open_in(path) as source, zipfile.ZipFile(source) as z:
        target, shared = _target(z, sheet), _shared(z)
        with z.open(target) as f:
            count = 0
            for _, row in ET.iterparse(f):
                if row.tag != f"{_MAIN}row":
                    continue
                count = int(row.get("r") or count + 1)
                cells: list[str | None] = []
                for c in row.iter(f"{_MAIN}c"):
                    at = column_number(c.get("r")) if c.get("r") else len(cells)
                    cells += [None] * (at - len(cells))
                    kind, value = c.get("t"), c.find(f"{_MAIN}v")
                    if kind == "inlineStr":
                        cells.append(unescape("".join(t.text or "" for t in c.iter(f"{_MAIN}t"))))
                    elif kind == "s":
                        cells.append(unescape(shared[int(value.text)]))
                    elif kind == "b":
                        cells.append("True" if value.text == "1" else "False")
                    else:
                        cells.append(value.text if value is not None else None)
                yield count, cells
                row.clear()


def records(path: str, sheet: str, columns: list[str] | None = None) -> Iterator[dict[str, object]]:
    """Rows below the header as dicts with ``_row``, the sheet's row number; the header must hold ``columns``."""
    head: list[str] | None = None
    for n, cells in rows(path, sheet):
        if head is None:
            head = [c or "" for c in cells]
            missing = set(columns or []) - set(head)
            if missing:
                raise ValueError(f"{sheet} lacks {sorted(missing)}")
            continue
        cells = cells + [None] * (len(head) - len(cells))
        yield {"_row": n, **{h: v for h, v in zip(head, cells) if h and (columns is None or h in columns)}}
