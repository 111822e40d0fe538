"""Acquisition of source files: cached, verified, and logged; the fetcher is a parameter.

No network is needed to use a cache: a cached file must match the hash recorded for it.
"""

from __future__ import annotations

import hashlib
import json
import os
import struct
import zlib
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

Fetch = Callable[[str], tuple[int, bytes]]


def sha256(path: str | Path) -> str:
    h = hashlib.sha256()
    with open(path, "rb") as f:
        for block in iter(lambda: f.read(1 << 20), b""):
            h.update(block)
    return h.hexdigest()


def acquire(name: str, urls: list[str], folder: str, fetch: Fetch | None = None, valid: Callable[[bytes], bool] = bool) -> dict[str, object]:
    """One file into ``folder``: the first URL, the next only after an explicit 404.

    A cached file is used if its hash is the recorded one, else it counts as failed and is
    not replaced.  A new file is checked before it takes its place in one step.
    """
    path, note = Path(folder) / name, Path(folder) / f"{name}.provenance.json"
    if path.exists():
        told = json.loads(note.read_text()) if note.exists() else {}
        ok = told.get("sha256") == sha256(path)
        return {"name": name, "status": "cached" if ok else "failed", "reason": "" if ok else "cached file differs from its record", **({"sha256": told["sha256"]} if ok else {})}
    tried = []
    for url in urls if fetch else []:
        code, data = fetch(url)
        tried.append({"url": url, "code": code})
        if code == 404:
            continue
        if code != 200 or not valid(data):
            return {"name": name, "status": "failed", "reason": f"{url} answered {code}", "attempts": tried}
        part = path.with_suffix(path.suffix + ".part")
        part.write_bytes(data)
        os.replace(part, path)
        told = {"url": url, "sha256": sha256(path), "bytes": len(data), "attempts": tried}
        note.write_text(json.dumps(told, indent=2))
        return {"name": name, "status": "downloaded", **told}
    return {"name": name, "status": "failed", "reason": "no source", "attempts": tried}


def acquire_all(wanted: dict[str, list[str]], folder: str, fetch: Fetch | None = None, threads: int = 4) -> list[dict[str, object]]:
    """Several files at once; the log of each, in the order asked for."""
    with ThreadPoolExecutor(threads) as pool:
        return list(pool.map(lambda kv: acquire(kv[0], kv[1], folder, fetch), wanted.items()))


def zip_member(read: Callable[[int, int], bytes], size: int, member: str) -> bytes:
    """One member of a remote archive by byte ranges, its checksum verified; the archive is never read whole.

    ``read(start, end)`` gives the bytes from ``start`` up to ``end``.
    """
    tail = read(max(0, size - 66_000), size)
    at = tail.rfind(b"PK\x05\x06")
    if at < 0:
        raise ValueError("no archive")
    length, start = struct.unpack("<II", tail[at + 12 : at + 20])
    index = read(start, start + length)
    pos = 0
    while index[pos : pos + 4] == b"PK\x01\x02":
        method, crc, packed = struct.unpack("<H", index[pos + 10 : pos + 12])[0], *struct.unpack("<II", index[pos + 16 : pos + 24])
        n, extra, comment = struct.unpack("<HHH", index[pos + 28 : pos + 34])
        offset = struct.unpack("<I", index[pos + 42 : pos + 46])[0]
        name = index[pos + 46 : pos + 46 + n].decode("utf-8", "replace")
        if name == member:
            head = read(offset, offset + 30)
            a, b = struct.unpack("<HH", head[26:30])
            begin = offset + 30 + a + b
            data = read(begin, begin + packed)
            data = zlib.decompress(data, -15) if method == 8 else data
            if zlib.crc32(data) != crc:
                raise ValueError(f"{member} is damaged")
            return data
        pos += 46 + n + extra + comment
    raise FileNotFoundError(member)
