"""Parent-child links to full hierarchies by heavy-path decomposition.

Nodes are (forest, node); a forest here is a component and a year.  Every node has at most
one parent, so a forest is a set of trees plus loops with trees that hang below them.

1. :func:`measure` doubles every node's pointer to an ancestor.  One round joins nodes with
   their targets and adds subtree sizes over twice the distance, so depth H takes log2(H)
   rounds.  A node whose pointer has passed the root is set aside; only the others go on, so
   work falls from round to round.  A round in which no node ends leaves only nodes on or
   below loops, because nodes of a tree exist at every depth up to the deepest.
2. :func:`chains` links each node to its child with the largest subtree (ties: the smallest
   id), which cuts a tree into chains; a path from the root meets at most log2(N) of them.
3. :func:`label` walks the chains level by level: a node's path is its parent chain's
   segments plus its own segment, its descendants are an interval of positions.

No step gathers a tree in one task: sizes are partial aggregates, hot parents are joined by
:func:`skew.lookup`, sibling offsets come from :func:`skew.prefix_sum`.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.operators import skew
from panelwright.session import cut

FOREST = ["component", "ipeds_year"]
NODE = [*FOREST, "unitid"]


def _pairs(column: str) -> list[tuple[str, str]]:
    return [*((f, f) for f in FOREST), (column, "unitid")]


def links(directory: DataFrame, parents: dict[str, str]) -> DataFrame:
    """Nodes with at least one link: component, ipeds_year, unitid, parent (null for a root).

    ``directory`` has one row per year and unit with cleaned parent columns; ``parents`` maps
    component to column.  A link is a parent id that names another unit with a record in the
    same year.
    """
    stacked = F.explode(F.array(*[F.struct(F.lit(c).alias("component"), F.col(p).alias("parent")) for c, p in parents.items()]))
    claims = directory.select("ipeds_year", "unitid", stacked.alias("s")).select("s.component", "ipeds_year", "unitid", "s.parent").where("parent IS NOT NULL AND parent <> unitid")
    known = directory.select("ipeds_year", F.col("unitid").alias("parent"), F.lit(True).alias("known"))
    targets = claims.select("component", "ipeds_year", "parent").distinct().join(known, ["ipeds_year", "parent"], "left_semi")
    n = claims.count()
    edges = skew.lookup(claims, targets.withColumn("known", F.lit(True)), [("component", "component"), ("ipeds_year", "ipeds_year"), ("parent", "parent")], {"known": "known"}, n).where("known").drop("known")
    tops = targets.select("component", "ipeds_year", F.col("parent").alias("unitid"), F.lit(None).cast("bigint").alias("parent"))
    return edges.select(*NODE, "parent").unionByName(tops).groupBy(*NODE).agg(F.max("parent").alias("parent"))


def measure(nodes: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """Acyclic nodes with subtree ``size``; nodes on or below loops; the number of nodes.

    What a node that was set aside is still owed by deeper nodes is kept in rows of its own
    and added up in the end.
    """
    every = cut(nodes.select(*NODE, "parent"))
    total = every.count()
    active = every.where("parent IS NOT NULL").select(*NODE, "parent", F.col("parent").alias("jump"), F.lit(1).cast("bigint").alias("size"))
    ended = [every.where("parent IS NULL").select(*NODE, "parent", F.lit(1).cast("bigint").alias("size"))]
    owed, n = [], active.count()
    while n:
        below = active.groupBy(*FOREST, F.col("jump").alias("unitid")).agg(F.sum("size").alias("more"))
        grown = active.withColumn("on", F.lit(True)).join(below, NODE, "full")
        moved = skew.lookup(grown, active, _pairs("jump"), {"next": "jump"}, n)
        moved = cut(moved.select(*NODE, "parent", F.col("next").alias("jump"), (F.coalesce("size", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("size"), "on"))
        owed.append(moved.where("on IS NULL").select(*NODE, "size"))
        ended.append(moved.where("on AND jump IS NULL").select(*NODE, "parent", "size"))
        active = moved.where("on AND jump IS NOT NULL").drop("on")
        left = active.count()
        if left == n:
            break
        n = left
    trees = reduce(DataFrame.unionByName, ended)
    if owed:
        late = reduce(DataFrame.unionByName, owed).groupBy(*NODE).agg(F.sum("size").alias("late"))
        trees = trees.join(late, NODE, "left").select(*NODE, "parent", (F.col("size") + F.coalesce("late", F.lit(0))).alias("size"))
    return cut(trees), active.select(*NODE, "parent"), total


def loops(cyclic: DataFrame) -> DataFrame:
    """For nodes on or below loops: ``on_loop`` and ``loop_root``, the loop's smallest id.

    Pointers double until their images stop shrinking (then they lie on loops only) and the
    smallest id over the doubled distance stops changing (then it is the whole loop's).
    """
    state = cut(cyclic.select(*NODE, F.col("parent").alias("jump"), F.col("unitid").alias("low")))
    n = state.count()
    if not n:
        return state.select(*NODE, F.lit(True).alias("on_loop"), F.col("low").alias("loop_root"))
    image = -1
    while True:
        nxt = skew.lookup(state, state, _pairs("jump"), {"jump2": "jump", "low2": "low"}, n)
        moved = nxt.select(*NODE, F.col("jump2").alias("jump"), F.least("low", "low2").alias("low"), (F.col("low2") < F.col("low")).alias("changed"))
        moved = cut(moved)
        targets = moved.select(*FOREST, F.col("jump").alias("unitid")).distinct()
        now = targets.count()
        lower = moved.where("changed").join(targets, NODE, "left_semi").limit(1).count()
        state = moved.drop("changed")
        if now == image and not lower:
            break
        image = now
    ring = targets.withColumn("on", F.lit(True))
    marked = state.join(ring, NODE, "left").select(*NODE, "jump", "low", F.col("on").isNotNull().alias("on_loop"))
    landed = skew.lookup(marked, state, _pairs("jump"), {"root": "low"}, n)
    return landed.select(*NODE, "on_loop", F.when(F.col("on_loop"), F.col("low")).otherwise(F.col("root")).alias("loop_root"))


def chains(trees: DataFrame, total: int) -> DataFrame:
    """Adds ``head`` and ``at``: the chain of each node and its place in it."""
    size = F.struct(F.col("size"), (-F.col("unitid")).alias("u"))
    heavy = trees.where("parent IS NOT NULL").groupBy(*FOREST, "parent").agg((-F.max(size)["u"]).alias("unitid")).withColumn("heavy", F.lit(True))
    marked = trees.join(heavy.select(*NODE, "heavy"), NODE, "left").withColumn("heavy", F.col("heavy").isNotNull())
    far, own = F.col("heavy"), [*NODE, "parent", "size", "heavy"]
    state = cut(marked.select(*own, F.when(far, F.col("parent")).alias("jump"), F.when(far, F.col("parent")).otherwise(F.col("unitid")).alias("head"), far.cast("int").alias("at")))
    done, open_ = [state.where("jump IS NULL")], state.where("jump IS NOT NULL")
    while not open_.isEmpty():
        there = reduce(DataFrame.unionByName, [*done, open_]).select(*FOREST, F.col("unitid").alias("jump"), F.col("jump").alias("jump2"), F.col("head").alias("head2"), F.col("at").alias("at2"))
        moved = cut(open_.join(there, [*FOREST, "jump"]).select(*own, F.col("jump2").alias("jump"), F.col("head2").alias("head"), (F.col("at") + F.col("at2")).alias("at")))  # a node has one heavy child: no key repeats
        done.append(moved.where("jump IS NULL"))
        open_ = moved.where("jump IS NOT NULL")
    return reduce(DataFrame.unionByName, done).drop("jump")


def label(trees: DataFrame, total: int, positions: bool = True) -> DataFrame:
    """root, depth, path segments and (with ``positions``) the interval of descendants.

    Gives per node: parent, size, head, at, root_unitid, tree_depth, segments (array of
    chain head and last place on it, from the root down), first_position and last_position
    within the root's tree; descendants of a node are the nodes after its first position up
    to its last.
    """
    rows = chains(trees, total)
    step = F.when(F.col("heavy"), F.lit(1).cast("bigint"))
    if positions:
        light = rows.where("parent IS NOT NULL AND NOT heavy")
        before = skew.prefix_sum(light.select(*NODE, "parent", "size"), [*FOREST, "parent"], "unitid", "size", "before").select(*NODE, "before")
        big = rows.where("heavy").select(*FOREST, F.col("parent").alias("unitid"), F.col("size").alias("heavy_size"))
        rows = rows.join(before, NODE, "left")
        rows = skew.lookup(rows, big, _pairs("parent"), {"heavy_size": "heavy_size"}, total)
        step = F.when(F.col("parent").isNull(), F.lit(0).cast("bigint")).when(F.col("heavy"), F.lit(1).cast("bigint")).otherwise(1 + F.coalesce("heavy_size", F.lit(0)) + F.coalesce("before", F.lit(0)))
    rows = cut(rows.select(*NODE, "parent", "size", "head", "at", step.alias("step")))
    heads = rows.where(F.col("unitid") == F.col("head"))
    segment = "array<struct<head:bigint,at:int>>"
    solved = heads.where("parent IS NULL").select(*FOREST, "head", F.col("unitid").alias("root_unitid"), F.lit(0).alias("top_depth"), F.lit(0).cast("bigint").alias("top_position"), F.expr(f"cast(array() as {segment})").alias("above"), F.lit(0).alias("level"))
    waiting = skew.lookup(heads.where("parent IS NOT NULL").select(*FOREST, "head", "parent", "step"), rows, _pairs("parent"), {"up_head": "head", "up_at": "at"}, total)
    waiting, solved, level = cut(waiting), cut(solved), 0
    left = waiting.count()
    parts = [solved]
    while left:  # at most log2(nodes) levels
        last = parts[-1].withColumnRenamed("head", "unitid")
        take = {"root_unitid": "root_unitid", "d": "top_depth", "p": "top_position", "a": "above"}
        tried = cut(skew.lookup(waiting, last, _pairs("up_head"), take, left))
        level += 1
        found = tried.where("root_unitid IS NOT NULL").select(
            *FOREST,
            "head",
            "root_unitid",
            (F.col("d") + F.col("up_at") + 1).alias("top_depth"),
            (F.col("p") + F.col("up_at") + F.col("step")).alias("top_position"),
            F.concat("a", F.array(F.struct(F.col("up_head").alias("head"), F.col("up_at").alias("at")))).alias("above"),
            F.lit(level).alias("level"),
        )
        parts.append(found)
        waiting = tried.where("root_unitid IS NULL").drop("root_unitid", "d", "p", "a")
        left = waiting.count()
    table = parts[0]
    for p in parts[1:]:
        table = table.unionByName(p)
    tops = table.withColumnRenamed("head", "unitid")
    take = {"root_unitid": "root_unitid", "top_depth": "top_depth", "top_position": "top_position", "above": "above"}
    out = skew.lookup(rows, tops, _pairs("head"), take, total)
    first = F.col("top_position") + F.col("at")
    return out.select(
        *NODE,
        "parent",
        "size",
        "head",
        "at",
        "root_unitid",
        (F.col("top_depth") + F.col("at")).cast("int").alias("tree_depth"),
        F.concat("above", F.array(F.struct(F.col("head"), F.col("at")))).alias("segments"),
        first.alias("first_position"),
        (first + F.col("size") - 1).alias("last_position"),
    )


#: Positions of one step of an interval; longer intervals are dealt out in steps of this length.
STEP = 10_000


def descendants(labelled: DataFrame) -> DataFrame:
    """(node, descendant, distance) from the intervals of positions that :func:`label` gives.

    The interval of a node names its descendants' positions, so a pair is found by an equal
    join on (forest, root, position), whose keys do not repeat on one side.  Long intervals
    are cut into steps and dealt out before they are opened.
    """
    depth = F.aggregate("segments", F.lit(0), lambda acc, s: acc + s["at"] + 1).alias("depth")
    known = labelled.select(*NODE, "root_unitid", "first_position", "last_position", depth)
    steps = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("last_position") - F.col("first_position") - 1) / STEP))
    parts = known.where("last_position > first_position").select("*", F.explode(steps).alias("step")).repartition(*NODE, "step")
    low = F.col("first_position") + 1 + F.col("step") * STEP
    spots = parts.select(*NODE, "root_unitid", "depth", F.explode(F.sequence(low, F.least("last_position", low + (STEP - 1)))).alias("spot"))
    there = known.select(*FOREST, "root_unitid", F.col("first_position").alias("spot"), F.col("unitid").alias("descendant"), F.col("depth").alias("below"))
    return spots.join(there, [*FOREST, "root_unitid", "spot"]).select(*NODE, "descendant", (F.col("below") - F.col("depth")).alias("distance"))


def paths(labelled: DataFrame, total: int) -> DataFrame:
    """The full path of each node (array from the root to the node).

    Chain arrays are built once and concatenated segment by segment; the output is as long
    as the paths themselves, which is what is asked for.
    """
    chain = labelled.groupBy(*FOREST, F.col("head").alias("unitid")).agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "unitid"))), lambda x: x["unitid"]).alias("nodes"))
    pieces = labelled.select(*NODE, F.posexplode("segments").alias("i", "s")).select(*NODE, "i", F.col("s.head").alias("seg"), F.col("s.at").alias("upto"))
    full = skew.lookup(pieces, chain, _pairs("seg"), {"nodes": "nodes"}, 4 * total)
    piece = F.struct(F.col("i"), F.slice("nodes", F.lit(1), F.col("upto") + 1).alias("part"))
    return full.groupBy(*NODE).agg(F.flatten(F.transform(F.array_sort(F.collect_list(piece)), lambda x: x["part"])).alias("path"))


def hierarchy(nodes: DataFrame, positions: bool = False) -> tuple[DataFrame, DataFrame, int]:
    """(labelled tree nodes, nodes on or below loops) of a table of :func:`links`."""
    trees, cyclic, total = measure(nodes)
    return label(trees, total, positions), loops(cyclic), total


def whole(nodes: DataFrame, positions: bool = False) -> tuple[DataFrame, int]:
    """(labelled nodes of trees and of the subtrees that hang below loops, number of nodes).

    Nodes on loops have no rows.  A subtree starts at the child of a loop node: paths and
    sizes are its own, its root is the loop's smallest id and its depth -2; positions of the
    subtrees below one loop follow each other, so that no two intervals meet.
    """
    trees, cyclic, total = measure(nodes)
    rings = cut(loops(cyclic))
    below = cyclic.join(rings.where("NOT on_loop").select(*NODE), NODE)
    on = rings.where("on_loop").select(*NODE, "on_loop")
    split = skew.lookup(below, on, _pairs("parent"), {"top": "on_loop"}, total)
    hung, _, n = measure(split.select(*NODE, F.when(F.col("top").isNull(), F.col("parent")).alias("parent")))
    rows = label(trees, total, positions)
    if not n:
        return rows, total
    told = cut(label(hung, n, positions).join(rings.select(*NODE, "loop_root"), NODE))
    tops = told.where("parent IS NULL").select(*FOREST, "loop_root", "unitid", "size")
    before = skew.prefix_sum(tops, [*FOREST, "loop_root"], "unitid", "size", "before").select(*FOREST, F.col("unitid").alias("top"), "before")
    placed = skew.lookup(told, before, [*((f, f) for f in FOREST), ("root_unitid", "top")], {"before": "before"}, n)
    moved = {c: F.col(c) + F.col("before") for c in ("first_position", "last_position")}
    placed = placed.withColumns({**moved, "root_unitid": F.col("loop_root"), "tree_depth": F.lit(-2)})
    return rows.unionByName(placed.select(*rows.columns)), total
