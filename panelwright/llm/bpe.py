"""Byte-pair merges by a segment tree over adjacent pair ranks, for many pieces at once.

Each piece has a tree whose leaves are its adjacent pairs: ``rank << 32 | place``, or NONE if
the pair has no merge rule.  Inner nodes are the smaller child, so the root is the lowest rank
and, among equal ranks, the leftmost place.  A merge changes three leaves (the pair itself,
the one it swallows and the one before it) and their ancestors: O(log n).  It ends when the
root is NONE.

Pieces of like length form one array, so that one numpy step advances all their trees; a
piece of any length is merged exactly, none is cut.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from panelwright.llm import split
from panelwright.llm.vocabulary import NONE, SHIFT, Merges, find

PLACE = np.int64(32)
_EMPTY = NONE << np.int64(20)
#: Bytes of text handled together; pieces handled together times their length.
BATCH_BYTES, BATCH_CELLS = 6_000_000, 2_000_000


def _pull(tree: np.ndarray, rows: np.ndarray, node: np.ndarray) -> None:
    """Recomputes the ancestors of one leaf per row."""
    node = node >> 1
    while node[0]:
        tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])
        node = node >> 1


def merge_group(data: np.ndarray, at: np.ndarray, size: np.ndarray, rules: Merges) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of pieces ``data[at:at+size]``, in order, and the number of ids of each."""
    p, width = len(at), int(size.max())
    leaves = 1 << max(0, (width - 1) - 1).bit_length() if width > 1 else 1
    columns = np.arange(width)
    inside = columns[None, :] < size[:, None]
    raw = data[np.minimum(at[:, None] + columns[None, :], len(data) - 1)]
    symbol = rules.byte_ids[raw]
    after = np.broadcast_to(columns + 1, (p, width)).copy()
    before = np.broadcast_to(columns - 1, (p, width)).copy()
    tree = np.full((p, 2 * leaves), _EMPTY, dtype=np.int64)
    if width > 1:
        rank = rules.byte_pairs[raw[:, :-1], raw[:, 1:]]
        ok = inside[:, 1:] & (rank != NONE)
        tree[:, leaves : leaves + width - 1] = np.where(ok, (rank << PLACE) | columns[:-1], _EMPTY)
    level = leaves >> 1
    while level:
        tree[:, level : 2 * level] = np.minimum(tree[:, 2 * level : 4 * level : 2], tree[:, 2 * level + 1 : 4 * level : 2])
        level >>= 1
    alive = inside
    rows = np.flatnonzero(tree[:, 1] != _EMPTY)
    while len(rows):
        root = tree[rows, 1]
        place, made = root & 0xFFFFFFFF, rules.made[root >> PLACE]
        eaten = after[rows, place]
        nxt = after[rows, eaten]
        prv = before[rows, place]
        symbol[rows, place] = made
        after[rows, place] = nxt
        alive[rows, eaten] = False
        has_next, has_prev = nxt < size[rows], prv >= 0
        before[rows[has_next], nxt[has_next]] = place[has_next]
        right = np.full(len(rows), _EMPTY, dtype=np.int64)
        if has_next.any():
            r = find(rules.keys, rules.ranks, (made[has_next] << SHIFT) | symbol[rows[has_next], nxt[has_next]])
            right[has_next] = np.where(r != NONE, (r << PLACE) | place[has_next], _EMPTY)
        tree[rows, leaves + place] = right
        swallowed = np.minimum(eaten, leaves - 1)
        last = eaten > leaves - 1  # the last symbol starts no pair
        old = tree[rows, leaves + swallowed]
        tree[rows, leaves + swallowed] = np.where(last, old, _EMPTY)
        if has_prev.any():
            rp, pp = rows[has_prev], prv[has_prev]
            r = find(rules.keys, rules.ranks, (symbol[rp, pp] << SHIFT) | made[has_prev])
            tree[rp, leaves + pp] = np.where(r != NONE, (r << PLACE) | pp, _EMPTY)
            _pull(tree, rp, leaves + pp)
        _pull(tree, rows, leaves + place)
        _pull(tree, rows, leaves + swallowed)
        rows = rows[tree[rows, 1] != _EMPTY]
    return symbol[alive].astype(np.int32), alive.sum(axis=1)


def encode_pieces(data: np.ndarray, at: np.ndarray, size: np.ndarray, rules: Merges) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all pieces in order, number of ids per piece); pieces are grouped by length."""
    counts = np.ones(len(at), dtype=np.int64)
    groups = []
    width = np.maximum(1, size)
    bucket = np.where(width <= 9, width, np.int64(1) << np.ceil(np.log2(np.maximum(width - 1, 1))).astype(np.int64) + 4)
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    for group in np.split(order, cuts) if len(order) else []:
        w = int(size[group].max())
        step = max(1, BATCH_CELLS // w)
        for i in range(0, len(group), step):
            part = group[i : i + step]
            ids, n = merge_group(data, at[part], size[part], rules)
            counts[part] = n
            groups.append((part, ids, n))
    offset = np.concatenate([[0], np.cumsum(counts)])
    out = np.empty(int(offset[-1]), dtype=np.int32)
    for part, ids, n in groups:
        ends = np.cumsum(n)
        place = np.repeat(offset[part] - (ends - n), n) + np.arange(len(ids))
        out[place] = ids
    return out, counts


def _ranges(offsets: np.ndarray) -> list[tuple[int, int]]:
    """Runs of texts of about BATCH_BYTES; a longer text is a run of its own."""
    out, i, n = [], 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + BATCH_BYTES, side="right")) - 1
        j = min(n, max(i + 1, j))
        out.append((i, j))
        i = j
    return out


def encode_texts(texts: pa.Array, rules: Merges, body: np.ndarray | None = None):
    """Encodes a string array.

    Yields per run of texts: (first text, ids, number of ids per text, number of ids before
    the character ``body`` of each text or None).  Null and empty texts have no ids.
    """
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    _, off_buf, data_buf = texts.buffers()
    offsets = np.frombuffer(off_buf, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    everything = np.frombuffer(data_buf, dtype=np.uint8) if data_buf is not None else np.zeros(0, dtype=np.uint8)
    for i, j in _ranges(offsets):
        lo, hi = int(offsets[i]), int(offsets[j])
        n = j - i
        if lo == hi:
            zero = np.zeros(n, dtype=np.int64)
            yield i, np.zeros(0, dtype=np.int32), zero, zero
            continue
        data = everything[lo:hi]
        points, heads = split.decode(data)
        bounds = offsets[i : j + 1] - lo
        text_first = np.searchsorted(heads, bounds)  # index of each text's first character
        first = np.zeros(len(points), dtype=bool)
        first[text_first[:-1][bounds[:-1] < bounds[1:]]] = True
        at = np.flatnonzero(split.starts(points, first))
        byte_at = np.append(heads[at], hi - lo)
        pieces = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(np.ascontiguousarray(byte_at, dtype=np.int64)), pa.py_buffer(data)])
        coded = pieces.dictionary_encode()
        index = coded.indices.to_numpy(zero_copy_only=False)
        known = coded.dictionary
        _, o, d = known.buffers()
        uo = np.frombuffer(o, dtype=np.int64)[: len(known) + 1]
        ids, counts = encode_pieces(np.frombuffer(d, dtype=np.uint8), uo[:-1], np.diff(uo), rules)
        begin = np.cumsum(counts) - counts
        per = counts[index]
        ends = np.cumsum(per)
        flat = ids[np.repeat(begin[index] - (ends - per), per) + np.arange(int(ends[-1]))]
        total = np.append(0, ends)
        piece_of = np.searchsorted(at, text_first)  # first piece of each text
        per_text = np.diff(total[piece_of])
        ahead = None
        if body is not None:
            cut_at = np.minimum(text_first[:-1] + np.maximum(body[i:j], 0), text_first[1:])
            ahead = total[np.searchsorted(at, cut_at)] - total[piece_of[:-1]]
        yield i, flat, per_text, ahead
