"""Finding and decoding source files on the driver or in a task."""

from __future__ import annotations

import gzip
import io
import json
import re
import zipfile
from pathlib import Path

#: Encodings tried in this order; the first that decodes wins (the last always does).
ENCODINGS = ("utf-8-sig", "cp1252", "latin1")


def decode(data: bytes) -> tuple[str, str]:
    """(text, encoding) of a text file of unknown encoding."""
    for name in ENCODINGS:
        try:
            return data.decode(name), name
        except UnicodeDecodeError:
            continue
    raise AssertionError("latin1 decodes everything")


def csv_rows(data: bytes) -> tuple[list[str], list[list[str]]]:
    """Header (lower case, trimmed) and rows of a CSV file, all as text; short rows are filled up."""
    import csv

    text, _ = decode(data)
    rows = list(csv.reader(io.StringIO(text, newline="")))
    if not rows:
        return [], []
    head = [h.strip().lower() for h in rows[0]]
    return head, [r[: len(head)] + [""] * (len(head) - len(r)) for r in rows[1:] if r]


def preferred_member(names: list[str], stem: str) -> str:
    """The CSV member of an archive: the revised one of ``stem`` if there is one, else the exact one."""
    found: dict[str, list[str]] = {}
    for n in names:
        base = n.rsplit("/", 1)[-1].lower()
        if base.endswith(".csv"):
            found.setdefault(base[:-4], []).append(n)
    stem = stem.lower()
    for wanted in ([f"{stem}_rv", f"{stem}_r"], [stem]):
        hits = [n for w in wanted for n in found.get(w, [])]
        if len(hits) > 1:
            raise ValueError(f"several members for {stem}: {hits}")
        if hits:
            return hits[0]
    raise FileNotFoundError(f"no member for {stem}")


def read_member(path: str, stem: str) -> tuple[str, bytes]:
    """(member name, bytes) of a ZIP archive, or the file itself if it is a plain CSV."""
    if not path.lower().endswith(".zip"):
        return path.rsplit("/", 1)[-1], Path(path).read_bytes()
    with zipfile.ZipFile(path) as z:
        name = preferred_member(z.namelist(), stem)
        return name, z.read(name)


def find_source(folder: str, stem: str) -> str | None:
    """The archive of ``stem``, or its CSV; null if there is neither; two of a kind raise."""
    by_suffix: dict[str, list[str]] = {}
    for p in sorted(Path(folder).iterdir()):
        if p.stem.lower() == stem.lower() and p.suffix.lower() in (".zip", ".csv"):
            by_suffix.setdefault(p.suffix.lower(), []).append(str(p))
    for suffix in (".zip", ".csv"):
        hits = by_suffix.get(suffix, [])
        if len(hits) > 1:
            raise ValueError(f"several sources for {stem}: {hits}")
        if hits:
            return hits[0]
    return None


def read_json(path: str) -> object:
    """A JSON file, gzipped or not."""
    data = Path(path).read_bytes()
    return json.loads(gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data)


def release_of(name: str) -> tuple[int, bool] | None:
    """(year, preliminary) that the name of a yearly workbook tells."""
    m = re.search(r"(19|20)\d{2}", name)
    return (int(m.group(0)), "prelim" in name.lower()) if m else None


def final_releases(paths: list[str]) -> dict[int, str]:
    """One workbook per year: the final one before a preliminary one; two of a kind raise."""
    found: dict[tuple[int, bool], list[str]] = {}
    for p in paths:
        told = release_of(Path(p).name)
        if told:
            found.setdefault(told, []).append(p)
    for key, some in found.items():
        if len(some) > 1:
            raise ValueError(f"several workbooks for {key}: {some}")
    years = {y for y, _ in found}
    return {y: (found.get((y, False)) or found[(y, True)])[0] for y in sorted(years)}
