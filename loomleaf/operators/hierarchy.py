"""Parent-child links to full hierarchies: root, depth, path, nested-set range, descendants.

Subtree sizes are summed upward and preorder ranges allotted downward from prefix sums over
siblings. Both directions use pointer doubling, so a forest of depth d takes about log2(d)
rounds instead of d:

* upward:   with jump(v) the 2^k-th ancestor and size_k(v) the descendants nearer than 2^k,
            size_k+1(v) = size_k(v) + sum of size_k(u) over the u with jump(u) = v;
* downward: first(v) = first(parent) + offset among the siblings, summed along the path.

A node still unfinished when a round finishes nothing more lies on a circle or below one: if
the deepest node has depth d >= 2^k, nodes of every smaller depth exist, so some would finish.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomleaf import runtime
from loomleaf.runtime import counted, cut, hot_keys, lookup_join, release, running_total, stripped, union_all


def prerequisite_links(edges: DataFrame) -> DataFrame:
    """src, dst: the distinct prerequisite links with both ends neither null nor empty."""
    wanted = (F.lower(stripped("relation")) == "prerequisite") & (F.col("src") != "") & (F.col("dst") != "")
    return edges.where(wanted).select("src", "dst").distinct()


def _moving() -> dict[str, Column]:
    return {"moving": F.count_if(F.col("jump").isNotNull())}


def _hot_jumps(moving: DataFrame, rows: int) -> DataFrame | None:
    """The hot values of jump among so many rows; with few rows none can be hot and nothing is counted."""
    if rows <= runtime.HOT_ROWS:
        return None
    return hot_keys(moving.groupBy(F.col("jump").alias("key")).agg(F.count(F.lit(1)).alias("n_in")), "key", "n_in", rows)


def _upward(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Finished nodes (id, parent, depth, root_id, size) and the rest (id, parent, jump), which have jumped as far as the deepest finished node.

    A round is one job: sizes are summed by the node jumped to, which then, with its own place,
    is what the jumping nodes look up. Its rows are counted while they are written.
    """
    state = cut(
        nodes.select("id", "parent", F.col("parent").alias("jump"), F.when(F.col("parent").isNull(), 0).otherwise(1).cast("int").alias("depth"), F.coalesce("parent", "id").alias("root_id"), F.lit(1).cast("bigint").alias("size")),
        **_moving(),
    )
    active = counted(state, "moving")
    while active:
        moving = state.where("jump is not null")
        inbound = moving.groupBy(F.col("jump").alias("key")).agg(F.sum("size").alias("more"))
        grown = state.join(inbound, F.col("id") == F.col("key"), "left").select("id", "parent", "jump", "depth", "root_id", (F.col("size") + F.coalesce("more", F.lit(0))).alias("size"))
        above = state.select(F.col("id").alias("up"), F.col("jump").alias("up_jump"), F.col("depth").alias("up_depth"), F.col("root_id").alias("up_root"))
        moved = lookup_join(grown, above, ("jump", "up"), _hot_jumps(moving, active), spread="id").select(
            "id", "parent", F.col("up_jump").alias("jump"), (F.col("depth") + F.coalesce("up_depth", F.lit(0))).alias("depth"), F.coalesce("up_root", "root_id").alias("root_id"), "size"
        )
        before, state = state, cut(moved, **_moving())
        release(before)
        left = counted(state, "moving")
        if left == active:
            break
        active = left
    return state.where("jump is null").drop("jump"), state.where("jump is not null").select("id", "parent", "jump")


def _circles(rest: DataFrame) -> DataFrame:
    """id, circle: for each node on a circle or below one, the smallest id on that circle."""
    state = cut(rest.select("id", "jump"), rows=F.count(F.lit(1)))
    rows = counted(state, "rows")
    if not rows:
        return state.select("id", F.col("jump").alias("circle"))
    # Walk on up until the set of ancestors reached no longer shrinks: then it is the circles.
    reached = -1
    while True:
        ends = cut(state.select(F.col("jump").alias("key")).distinct(), keys=F.count(F.lit(1)))
        now = counted(ends, "keys")
        if now == reached:
            break
        reached = now
        above = state.join(ends, F.col("id") == F.col("key"), "left_semi").select(F.col("id").alias("up"), F.col("jump").alias("up_jump"))
        before, state = (state, ends), cut(lookup_join(state, above, ("jump", "up"), _hot_jumps(state, rows), spread="id", how="inner").select("id", F.col("up_jump").alias("jump")))
        release(*before)
    # On the circles every node has one successor and one predecessor: double the minimum.
    last = None
    ring = cut(rest.join(ends, F.col("id") == F.col("key"), "left_semi").select("id", F.col("parent").alias("jump"), F.least("id", "parent").alias("low")))
    while True:
        above = ring.select(F.col("id").alias("up"), F.col("jump").alias("up_jump"), F.col("low").alias("up_low"))
        step = cut(
            ring.join(above, F.col("jump") == F.col("up")).select("id", F.col("up_jump").alias("jump"), F.least("low", "up_low").alias("low"), (F.col("up_low") < F.col("low")).alias("changed")),
            changed=F.count_if("changed"),
        )
        release(last or ring)
        last, ring = step, step.drop("changed")
        if not counted(step, "changed"):
            break
    lows = ring.select(F.col("id").alias("up"), F.col("low").alias("circle"))
    return lookup_join(state, lows, ("jump", "up"), _hot_jumps(state, rows), spread="id").select("id", "circle")


def _sibling_offsets(tree: DataFrame, rows: int) -> DataFrame:
    """tree with offset: 1 + the sizes of the siblings before the node; of a root, its tree's place."""
    t = running_total(tree, "parent", "id", "size", "before", rows)
    own = F.when(F.col("parent").isNull(), 0).otherwise(1)
    return t.select("id", "parent", "depth", "root_id", "size", (F.col("before") + own).alias("offset"))


def _downward(tree: DataFrame, rows: int, with_path: bool) -> DataFrame:
    """tree with lft, rgt (the node's place in preorder and its last descendant's) and path."""
    t = _sibling_offsets(tree, rows)
    path = F.array("id") if with_path else F.lit(None).cast("array<string>")
    state = cut(t.select("id", "parent", "depth", "root_id", "size", F.col("parent").alias("jump"), F.col("offset").alias("lft"), path.alias("path")), **_moving())
    done = [state.where("jump is null")]
    while n := counted(state, "moving"):
        # Finished nodes rest in the tables of their rounds; only those still moving are written again.
        moving = state.where("jump is not null")
        hot = _hot_jumps(moving, n)
        places = union_all([*done, moving]).select(F.col("id").alias("up"), F.col("jump").alias("up_jump"), F.col("lft").alias("up_lft"), F.col("path").alias("up_path"))
        moved = lookup_join(moving, places, ("jump", "up"), hot, spread="id", how="inner").select(
            "id", "parent", "depth", "root_id", "size", F.col("up_jump").alias("jump"), (F.col("lft") + F.col("up_lft")).alias("lft"), F.concat("up_path", "path").alias("path")
        )
        state = cut(moved, **_moving())
        done.append(state.where("jump is null"))
    state = union_all(done)
    return state.select("id", "parent", "root_id", "depth", "lft", (F.col("lft") + F.col("size") - 1).alias("rgt"), "path")


def hierarchy(links: DataFrame, with_path: bool = True) -> DataFrame:
    """One row per id that is an end of a link: id, parent, root_id, depth, lft, rgt, path.

    links has src (parent) and dst (child), neither null. A node's descendants are those with
    lft in (its lft, its rgt]; rgt - lft is their number. path is the array of ids from the
    root to the node. On a circle of links, or below one, root_id is the circle's smallest
    id, depth is -1 and lft, rgt and path are null; a link from a node to itself is a circle.
    Repeated links change nothing. Should a node have several parents, the smallest is taken.
    No links give no rows.
    """
    nodes = cut(
        links.select(F.col("dst").alias("id"), F.col("src").alias("parent"))
        .unionByName(links.select(F.col("src").alias("id"), F.lit(None).cast("string").alias("parent")))
        .groupBy("id")
        .agg(F.min("parent").alias("parent")),
        rows=F.count(F.lit(1)),
    )
    rows = counted(nodes, "rows")
    done, rest = _upward(nodes)
    tree = _downward(done, rows, with_path)
    circles = _circles(rest)
    ringed = circles.join(rest, "id").select(
        "id", "parent", F.col("circle").alias("root_id"), F.lit(-1).alias("depth"), F.lit(None).cast("bigint").alias("lft"), F.lit(None).cast("bigint").alias("rgt"), F.lit(None).cast("array<string>").alias("path")
    )
    return tree.unionByName(ringed)


def _range_pairs(above: DataFrame, below: DataFrame, width: int) -> DataFrame:
    """outer_id, inner_id, distance where the outer node's range holds the inner node.

    The range join runs by bins of the preorder: an outer node is sent to the bins that its
    range covers, so hardly a pair is looked at that isn't one, and a bin meets at most
    `width` nodes and their ancestors.
    """
    outer = above.where("rgt > lft").select(F.col("id").alias("outer_id"), "lft", "rgt", F.col("depth").alias("d0"), F.explode(F.expr(f"sequence((lft + 1) div {width}, rgt div {width})")).alias("bin"))
    inner = below.where("lft is not null").select(F.col("id").alias("inner_id"), F.col("lft").alias("at"), F.col("depth").alias("d1"), F.expr(f"lft div {width}").alias("bin"))
    return outer.join(inner, "bin").where("at > lft and at <= rgt").select("outer_id", "inner_id", (F.col("d1") - F.col("d0")).alias("distance"))


def descendants(tree: DataFrame, of: DataFrame | None = None, width: int = 4096) -> DataFrame:
    """node_id, descendant_id, distance for every node of `of` (column id; all if not given).

    Nodes on or below circles have no range and no rows.
    """
    above = tree if of is None else tree.join(of.select("id").distinct(), "id", "left_semi")
    return _range_pairs(above, tree, width).withColumnsRenamed({"outer_id": "node_id", "inner_id": "descendant_id"})


def ancestors(tree: DataFrame, of: DataFrame | None = None, width: int = 4096) -> DataFrame:
    """node_id, ancestor_id, distance for every node of `of`: the same ranges seen from below."""
    below = tree if of is None else tree.join(of.select("id").distinct(), "id", "left_semi")
    return _range_pairs(tree, below, width).withColumnsRenamed({"outer_id": "ancestor_id", "inner_id": "node_id"}).select("node_id", "ancestor_id", "distance")
