"""Public tokenizer files, read once per Python worker.  Their folder is a parameter."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass
from functools import lru_cache

import numpy as np

DEFAULT_FOLDER = "/opt/tokenizers"
DEFAULT_NAME = "byte_bpe_50k"


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write the 256 bytes.

    Printable Latin-1 bytes stand for themselves, the others are numbered from U+0100 on.
    """
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    out = {chr(b): b for b in own}
    for i, b in enumerate(b for b in range(256) if b not in set(own)):
        out[chr(256 + i)] = b
    return out


@dataclass(frozen=True)
class Merges:
    """Merge rules as sorted pair keys (left id * 2**20 + right id) with rank and new id."""

    keys: np.ndarray
    ranks: np.ndarray
    made: np.ndarray  # new id by rank
    byte_ids: np.ndarray  # id of each single byte
    byte_pairs: np.ndarray  # rank of each pair of bytes, NONE if they do not merge


NONE = np.int64(1 << 40)
SHIFT = 20


@lru_cache(maxsize=4)
def load(folder: str = DEFAULT_FOLDER, name: str = DEFAULT_NAME) -> Merges:
    with open(os.path.join(folder, f"{name}.json"), encoding="utf-8") as f:
        model = json.load(f)["model"]
    vocab = model["vocab"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    keys = np.array([(vocab[a] << SHIFT) | vocab[b] for a, b in pairs], dtype=np.int64)
    made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
    order = np.argsort(keys, kind="stable")
    letters = byte_letters()
    byte_ids = np.zeros(256, dtype=np.int64)
    for letter, b in letters.items():
        byte_ids[b] = vocab[letter]
    sorted_keys, ranks = keys[order], order.astype(np.int64)
    every = (byte_ids[:, None] << SHIFT) | byte_ids[None, :]
    table = find(sorted_keys, ranks, every.ravel()).reshape(256, 256)
    return Merges(sorted_keys, ranks, made, byte_ids, table)


def find(keys: np.ndarray, ranks: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Rank of each wanted pair, NONE where there is no such rule."""
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return np.where(keys[at] == wanted, ranks[at], NONE)
