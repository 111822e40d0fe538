"""Cuts UTF-8 texts into the pieces between which a byte-level tokenizer never merges.

The published pattern is ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``.
Instead of matching it text by text, the starts of all pieces of a batch are computed at once
from the classes of neighbouring characters:

* a change of class starts a piece;
* of a run of white space before another character the last one stands alone, and if it is a
  blank it joins the run after it;
* an apostrophe with one of the endings is a piece of its own unless other signs or a blank
  come right before it.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import regex

LETTER, DIGIT, SPACE, OTHER = 0, 1, 2, 3
#: The endings that follow an apostrophe.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """Class of every code point."""
    out = np.full(0x110000, OTHER, dtype=np.uint8)
    points = [*range(0xD800), *range(0xE000, 0x110000)]
    everything = "".join(map(chr, points))
    index = np.array(points, dtype=np.int64)
    for kind, pattern in ((LETTER, r"\p{L}+"), (DIGIT, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
        for m in regex.finditer(pattern, everything):
            out[index[m.start() : m.end()]] = kind
    return out


def decode(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes and the byte offset of each."""
    heads = np.flatnonzero((data & 0xC0) != 0x80)
    b = data[heads].astype(np.int32)
    if len(heads) == len(data):
        return b, heads
    wide = np.flatnonzero(b >= 0xC0)  # only these need more than their head byte
    h, lead, last = heads[wide], b[wide], len(data) - 1
    c1, c2, c3 = (data[np.minimum(h + k, last)].astype(np.int32) & 0x3F for k in (1, 2, 3))
    two, three = (lead & 0x1F) << 6 | c1, (lead & 0x0F) << 12 | c1 << 6 | c2
    four = (lead & 0x07) << 18 | c1 << 12 | c2 << 6 | c3
    point = b
    point[wide] = np.where(lead < 0xE0, two, np.where(lead < 0xF0, three, four))
    return point, heads


def starts(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """True where a piece starts; ``first`` is True at the first character of each text."""
    n = len(points)
    kind = classes()[points]
    start = first.copy()
    if n < 2:
        return start
    same_text = ~first[1:]
    start[1:] |= kind[1:] != kind[:-1]
    joint = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & same_text)  # last white space of a run
    start[joint] = True
    start[joint[points[joint] == 32] + 1] = False
    marks = np.flatnonzero(points == 39)
    if len(marks):
        before = marks - 1
        free = first[marks] | (kind[before] == LETTER) | (kind[before] == DIGIT) | ((kind[before] == SPACE) & (points[before] != 32))
        marks = marks[free]
        done = np.zeros(len(marks), dtype=bool)
        for ending in ENDINGS:
            k = len(ending)
            hit = ~done & (marks + k < n)
            for i, letter in enumerate(ending, 1):
                at = np.minimum(marks + i, n - 1)
                hit &= (points[at] == ord(letter)) & ~first[at]
            for i in range(1, k + 1):
                start[marks[hit] + i] = False
            after = marks[hit] + k + 1
            start[after[after < n]] |= kind[after[after < n]] != SPACE
            done |= hit
    return start
