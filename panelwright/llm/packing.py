"""Filling fixed-capacity containers with texts by vector bin packing.

An item has three sizes: tokens, segments (one each) and loss-bearing tokens.  Containers are
filled one after the other.  Into the open one goes the item that fits all three limits and
has the largest dot product of its sizes (as shares of the limits) with the room that is
left; it is closed when nothing fits.  Ties go to the item with more tokens, then the
smaller key.

Items are dealt to groups by hash, a few thousand each, and a group is packed by one task, so
the work is split evenly whatever the keys are.  Each group can leave one part-filled
container, a small share of its thousands of items; no item is dropped or moved to fit.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Items per group; a container holds a few items, so one part-filled one is under a thousandth.
GROUP_ITEMS = 8_000


@dataclass(frozen=True)
class Limits:
    tokens: int = 2_048
    segments: int = 64
    loss_tokens: int = 2_048


#: Copies of one row that a task opens at a time.
STEP = 10_000


def dealt(sizes: DataFrame, key: str = "doc_id") -> DataFrame:
    """Adds ``deal``, a number by which rows are dealt to groups, that depends on the rows alone.

    It is a hash of the row and of its number among equal rows (same key and sizes, which are
    interchangeable), so it is the same however the input is split, and a row that repeats
    without end is spread over all groups.  Repeats are counted by a partial aggregate and
    opened in steps, dealt out in between.
    """
    row = [key, "n_tokens", "n_head"]
    times = sizes.groupBy(*row).agg(F.count(F.lit(1)).alias("times"))
    once = times.where("times = 1").select(*row, F.lit(0).cast("bigint").alias("copy"))
    steps = times.where("times > 1").select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("times") - 1) / STEP))).alias("step")).repartition(*row, "step")
    low = F.col("step") * STEP
    more = steps.select(*row, F.explode(F.sequence(low, F.least(F.col("times") - 1, low + (STEP - 1)))).alias("copy"))
    return once.unionByName(more).withColumn("deal", F.xxhash64(*row, "copy")).drop("copy")


def pieces(sizes: DataFrame, limits: Limits, key: str = "doc_id") -> DataFrame:
    """Items: each text, or its consecutive pieces if it is longer than a container.

    ``sizes`` has ``n_tokens``, ``n_head`` (leading tokens that bear no loss) and ``deal``, a
    number that differs between rows and deals them to groups (see :func:`dealt`).  Pieces are
    ``limits.tokens`` long but for the last.  A text without tokens is one item of size 0.
    """
    cap = limits.tokens
    n = F.greatest(F.lit(1), F.ceil(F.col("n_tokens") / cap)).cast("int")
    cut = sizes.select(key, "deal", "n_tokens", "n_head", F.explode(F.sequence(F.lit(0), n - 1)).alias("piece"))
    first = F.col("piece").cast("bigint") * cap
    end = F.least("n_tokens", first + cap)
    loss = F.greatest(F.lit(0), end - F.greatest(first, F.col("n_head")))
    return cut.select(key, "deal", "piece", first.alias("first_token"), (end - first).alias("tokens"), loss.alias("loss_tokens"))


def pack_arrays(tokens: np.ndarray, loss: np.ndarray, limits: Limits) -> np.ndarray:
    """Container number of each item.  Equal items are handled as one class with a count.

    Within a class all items are alike, so only classes are compared: a group of thousands of
    items has at most that many classes, and the classes too large for the room are skipped
    by position, since classes are sorted by tokens.
    """
    order = np.lexsort((loss, tokens))
    t, v = tokens[order], loss[order]
    change = np.flatnonzero(np.concatenate([[True], (np.diff(t) != 0) | (np.diff(v) != 0)])) if len(t) else np.zeros(0, dtype=int)
    ct, cv = t[change].astype(np.float64), v[change].astype(np.float64)
    left = np.diff(np.append(change, len(t)))
    at = change.copy()  # next item of each class
    caps = np.array([limits.tokens, limits.segments, limits.loss_tokens], dtype=np.float64)
    out = np.full(len(t), -1, dtype=np.int64)
    remaining, box = len(t), 0
    while remaining:
        room = caps.copy()
        empty = True
        while remaining:
            hi = int(np.searchsorted(ct, room[0], side="right"))
            if hi == 0 or (room[1] < 1 and not empty):
                break
            score = ct[:hi] * (room[0] / caps[0] ** 2) + cv[:hi] * (room[2] / caps[2] ** 2) + room[1] / caps[1] ** 2
            score = np.where((left[:hi] > 0) & (cv[:hi] <= room[2]), score, -1.0)
            best = hi - 1 - int(np.argmax(score[::-1]))
            if score[best] < 0:
                break
            out[order[at[best]]] = box
            at[best] += 1
            left[best] -= 1
            remaining -= 1
            empty = False
            room -= (ct[best], 1.0, cv[best])
        if empty and remaining:  # an item beyond a limit on its own: it gets a container of its own
            best = int(np.flatnonzero(left)[-1])
            out[order[at[best]]] = box
            at[best] += 1
            left[best] -= 1
            remaining -= 1
        box += 1
        if remaining and box % 64 == 0:  # classes used up are dropped now and then
            keep = left > 0
            ct, cv, left, at = ct[keep], cv[keep], left[keep], at[keep]
    return out


def pack(items: DataFrame, limits: Limits, n_items: int, key: str = "doc_id") -> DataFrame:
    """Adds ``container`` (text, unique over all groups) to a table of :func:`pieces`.

    A piece that fills a container gets it alone, whatever the order.  Keys travel as text, so
    that null keys in a group leave long numbers exact.
    """
    groups = max(1, -(-n_items // GROUP_ITEMS))
    dealt = items.withColumn(key, F.col(key).cast("string")).withColumn("group", F.pmod(F.xxhash64("deal", "piece"), F.lit(groups)).cast("int"))
    kind = items.schema[key].dataType.simpleString()

    def fill(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values([key, "piece", "deal"], kind="stable").reset_index(drop=True)
        box = pack_arrays(frame["tokens"].to_numpy(), frame["loss_tokens"].to_numpy(), limits)
        frame["container"] = [f"{g}-{b}" for g, b in zip(frame.pop("group"), box)]
        return frame.drop(columns="deal")

    packed = dealt.groupBy("group").applyInPandas(fill, f"{key} string, piece int, first_token bigint, tokens bigint, loss_tokens bigint, container string")
    return packed.withColumn(key, F.col(key).cast(kind))
