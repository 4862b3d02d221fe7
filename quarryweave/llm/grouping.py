"""Consolidating pairwise matches into groups on a two-dimensional grid.

Vertices are hashed into ``p`` blocks, so that each edge falls into one cell (block of its smaller
end, block of its larger end).  Every cell runs a union-find over its own edges and answers with a
star: each vertex and the smallest vertex of its local tree.  The stars of one vertex, met in its row
and its column of the grid, are exchanged: a vertex that is a root nowhere takes the smallest of its
roots as parent and leaves the graph, its other roots being linked to that one; a vertex that is a
root in some cell stays.  The grid is halved each round and ends as one cell, where parents are
final; then the recorded parents are resolved backwards.

A cell with more than ``cell_edges`` edges (a vertex that a third of all edges touch) is split by a
hash of the edge: union-find over any part of the edges is valid, so no edge is left out.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarryweave.plans import materialise

#: Edges one task holds at most, and the least number of blocks a side of the first grid has.
CELL_EDGES = 200_000
FIRST_BLOCKS = 4

_STAR = "v string, root string"


def local_roots(u: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
    """Smallest vertex of each vertex's tree, by hooking the larger root under the smaller and halving paths."""
    parent = np.arange(n)
    while True:
        a, b = parent[u], parent[v]
        open_ = a != b
        if not open_.any():
            return parent
        u, v, a, b = u[open_], v[open_], a[open_], b[open_]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up


def _cell_stars(cell: pd.DataFrame) -> pd.DataFrame:
    codes, names = pd.factorize(pd.concat([cell["a"], cell["b"]], ignore_index=True), sort=True)
    half = len(cell)
    names = np.asarray(names, dtype=object)
    root = local_roots(codes[:half], codes[half:], len(names))
    child = np.flatnonzero(root != np.arange(len(names)))
    return pd.DataFrame({"v": names[child], "root": names[root[child]]})


def _stars(edges: DataFrame, blocks: int, cell_edges: int) -> DataFrame:
    block = lambda c: F.pmod(F.xxhash64(c, F.lit(blocks)), F.lit(blocks)).cast("int")
    placed = edges.withColumn("row", block(F.col("a"))).withColumn("col", block(F.col("b")))
    # blocks ** 2 rows, at most edges / cell_edges of them times a constant
    crowd = placed.groupBy("row", "col").count().filter(F.col("count") > cell_edges)
    crowd = crowd.select("row", "col", F.ceil(F.col("count") / cell_edges).cast("int").alias("parts"))
    placed = placed.join(crowd, ["row", "col"], "left").withColumn(
        "part", F.when(F.col("parts").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64("a", "b"), F.col("parts")).cast("int"))
    )
    return placed.groupBy("row", "col", "part").applyInPandas(lambda cell: _cell_stars(cell[["a", "b"]]), _STAR)


def consolidate(pairs: DataFrame, left: str, right: str, cell_edges: int = CELL_EDGES, first_blocks: int = FIRST_BLOCKS) -> DataFrame:
    """One row ``(id, group_id)`` for every id of either column; ``group_id`` is the smallest id of its group.

    Nulls name no vertex, a pair with one null end still names its other end, self-links and
    repeated pairs change nothing, an empty table gives no rows, other columns are ignored.
    """
    raw = pairs.select(F.col(left).cast("string").alias("l"), F.col(right).cast("string").alias("r"))
    raw = materialise(raw.select(F.least("l", "r").alias("a"), F.greatest("l", "r").alias("b")).distinct(), "pairs")
    vertices = raw.select(F.explode(F.array("a", "b")).alias("id")).filter(F.col("id").isNotNull()).distinct()
    edges = raw.filter("a is not null and b is not null and a <> b")

    left_over = edges.count()
    blocks = max(first_blocks, math.ceil(math.sqrt(left_over / cell_edges)))
    parents: list[DataFrame] = []
    while left_over:
        stars = materialise(_stars(edges, blocks, cell_edges), "stars")
        if blocks == 1 and left_over <= cell_edges:
            parents.append(stars.select(F.col("v").alias("id"), F.col("root").alias("parent")))
            break
        # a root's own row says that it stays; windows spill, so that a vertex may have roots in any number of cells
        tagged = stars.unionByName(stars.select(F.col("root").alias("v"), F.lit(None).cast("string").alias("root")).distinct())
        of_vertex = Window.partitionBy("v")
        met = tagged.withColumn("least", F.min("root").over(of_vertex)).withColumn("held", F.max(F.col("root").isNull()).over(of_vertex))
        met = materialise(met.filter("root is not null"), "exchange")
        parents.append(met.filter("not held and root = least").select(F.col("v").alias("id"), F.col("least").alias("parent")).distinct())
        linked = met.filter("not held and root <> least").select(F.col("least").alias("a"), F.col("root").alias("b"))
        kept = met.filter("held").select(F.col("root").alias("a"), F.col("v").alias("b"))
        edges = materialise(linked.unionByName(kept).distinct(), "edges")
        left_over = edges.count()
        blocks = max(1, blocks // 2)

    # the later rounds hold ever fewer vertices; each is written once, so that a plan reads two tables whatever their number
    resolved: DataFrame | None = None
    for step in reversed(parents):
        if resolved is None:
            resolved = materialise(step.select("id", F.col("parent").alias("group_id")), "resolved")
            continue
        known = resolved.select(F.col("id").alias("parent"), F.col("group_id").alias("above"))
        step = step.join(known, "parent", "left").select("id", F.coalesce("above", "parent").alias("group_id"))
        resolved = materialise(step.unionByName(resolved), "resolved")
    if resolved is None:
        return vertices.select("id", F.col("id").alias("group_id"))
    return vertices.join(resolved, "id", "left").select("id", F.coalesce("group_id", "id").alias("group_id"))
