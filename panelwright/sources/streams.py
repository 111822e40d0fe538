"""Byte streams on any file system that a path names; a plain path is a folder that all machines share."""

from __future__ import annotations

import os
from typing import BinaryIO


def _resolved(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def _plain(path: str) -> str | None:
    if path.startswith("file:"):
        return "/" + path[5:].lstrip("/")
    return None if "://" in path else path


def open_in(path: str) -> BinaryIO:
    """A seekable stream to read."""
    local = _plain(path)
    if local is not None:
        return open(local, "rb")
    system, inner = _resolved(path)
    return system.open_input_file(inner)


def open_out(path: str) -> BinaryIO:
    """A stream to write; folders on the way are made."""
    local = _plain(path)
    if local is not None:
        os.makedirs(os.path.dirname(local) or ".", exist_ok=True)
        return open(local, "wb")
    system, inner = _resolved(path)
    return system.open_output_stream(inner)


def move(source: str, target: str) -> None:
    """Gives a whole file its name."""
    local = _plain(source)
    if local is not None:
        os.replace(local, _plain(target))
        return
    system, inner = _resolved(source)
    system.move(inner, _resolved(target)[1])


def remove(path: str) -> None:
    local = _plain(path)
    if local is not None:
        os.remove(local)
        return
    system, inner = _resolved(path)
    system.delete_file(inner)
