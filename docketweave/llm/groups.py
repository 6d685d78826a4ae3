"""Consolidating pairwise links into groups on a two-dimensional grid of edge blocks.

Vertices are hashed into side x side blocks, so an edge belongs to the cell of its two ends' blocks
and a hub's edges are spread over a whole row and column. Each round
1. runs union-find inside every cell, which replaces its edges by stars to the cell's smallest vertex;
2. exchanges these representatives along rows and columns: a vertex's parent is the smallest
   representative that any cell names for it, and every other representative named for it
   gets an edge to that parent;
3. goes on with those edges only, which connect representatives; it ends when there are none.
The parents of all rounds are then composed from the last to the first. Vertex names are replaced by
order-preserving numbers, so the smallest number of a group is its smallest name.

Nothing is collected but the number of edges left after a round; tables between rounds are written to
the shared folder. Defined results: null or equal ends are no link; repeats and both orders
of a pair count once; an id in no link is absent; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketweave.session import Scratch, partitions_for, read

EDGES_PER_CELL = 250_000


def union_find(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vertices and the smallest vertex of each one's component, by hooking and pointer jumping."""
    vertices, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = ends[: len(a)], ends[len(a) :]
    parent = np.arange(len(vertices))
    while len(u):
        low, high = np.minimum(parent[u], parent[v]), np.maximum(parent[u], parent[v])
        np.minimum.at(parent, high, low)
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up
        u, v = parent[u], parent[v]
        open_ = u != v
        u, v = u[open_], v[open_]
    return vertices, vertices[parent]


def _stars(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Stars of the cells in this task's partition; a partition is a set of whole or split cells,
    and any set of edges may be compressed together."""
    held_a: list[np.ndarray] = []
    held_b: list[np.ndarray] = []
    held = 0

    def compress() -> tuple[np.ndarray, np.ndarray]:
        return union_find(np.concatenate(held_a), np.concatenate(held_b))

    for batch in batches:
        held_a.append(batch["a"].to_numpy())
        held_b.append(batch["b"].to_numpy())
        held += len(batch)
        if held > 8 * EDGES_PER_CELL:  # a forest has fewer edges than what it replaces
            v, r = compress()
            held_a, held_b, held = [v], [r], 0
    if held_a:
        v, r = compress()
        yield pd.DataFrame({"v": v, "r": r})


def components(edges: DataFrame, a: str, b: str, edges_per_cell: int = EDGES_PER_CELL) -> DataFrame:
    """(id, group_id) of every id in an edge; group_id is the smallest id connected to it."""
    spark = edges.sparkSession
    scratch = Scratch(spark, "groups")
    named = scratch.table(
        edges.select(F.col(a).alias("a"), F.col(b).alias("b"))
        .filter("a is not null and b is not null and a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )
    ids = named.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    width = max(2, partitions_for(spark) // 2)
    numbered = scratch.table(ids.repartitionByRange(width, "id").sortWithinPartitions("id").select("id", F.monotonically_increasing_id().alias("n")))
    left, right = numbered.select(F.col("id").alias("a"), F.col("n").alias("na")), numbered.select(F.col("id").alias("b"), F.col("n").alias("nb"))
    live = scratch.table(named.join(left, "a").join(right, "b").select(F.col("na").alias("a"), F.col("nb").alias("b")))
    scratch.drop(named)
    parents: list[DataFrame] = []
    count = live.count()
    while count:
        side = max(2, int(np.ceil(np.sqrt(count / edges_per_cell))))
        block = lambda c: F.pmod(F.xxhash64(c), F.lit(side))  # noqa: B023, E731
        cells = live.select("a", "b", (block("a") * side + block("b")).alias("cell")).repartition(min(side * side, 4 * partitions_for(spark)), "cell")
        named_for = scratch.table(cells.select("a", "b").mapInPandas(_stars, "v bigint, r bigint"))
        best = scratch.table(named_for.groupBy("v").agg(F.min("r").alias("p")))
        parents.append(best)
        after = scratch.table(
            named_for.join(best, "v").filter("r <> p").select(F.least("r", "p").alias("a"), F.greatest("r", "p").alias("b")).distinct()
        )
        scratch.drop(live)
        scratch.drop(named_for)
        live, count = after, after.count()
    if not parents:
        return numbered.select("id", F.col("id").alias("group_id"))
    # Representatives of one round are vertices of the next, unless they are settled.
    root = parents[-1]
    for up in reversed(parents[:-1]):
        above = root.select(F.col("v").alias("p"), F.col("p").alias("top"))
        root = scratch.table(up.join(above, "p", "left").select("v", F.coalesce("top", "p").alias("p")))
    names = numbered.select(F.col("n").alias("p"), F.col("id").alias("group_id"))
    return numbered.join(root, numbered["n"] == root["v"]).join(names, "p").select("id", "group_id")


#: The decisions that link, in upper case without outer blanks.
LINKING = ["MATCH", "MERGE_TIER0", "MERGE_TIER2"]


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    decisions = read(spark, sf_dir, "decisions")
    links = decisions.filter(F.upper(F.trim("decision")).isin(LINKING))
    return components(links, "mention_id_a", "mention_id_b").select(F.col("id").alias("mention_id"), "group_id")


def p2_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many groups there are of each size."""
    groups = p2_found(spark, sf_dir).groupBy("group_id").agg(F.count("*").alias("size"))
    return groups.groupBy("size").agg(F.count("*").alias("n_groups"))


_P2_GROUPS = """
WITH RECURSIVE raw AS (
  SELECT mention_id_a a, mention_id_b b FROM decisions
  WHERE upper(trim(decision)) IN ('MATCH', 'MERGE_TIER0', 'MERGE_TIER2')
    AND mention_id_a IS NOT NULL AND mention_id_b IS NOT NULL AND mention_id_a <> mention_id_b),
links AS (SELECT a, b FROM raw UNION SELECT b, a FROM raw),
reach(mention_id, other) AS (
  SELECT a, a FROM links UNION SELECT reach.mention_id, links.b FROM reach JOIN links ON links.a = reach.other),
groups AS (SELECT mention_id, min(other) AS group_id FROM reach GROUP BY mention_id)
"""

SQL = {
    "p2_found": _P2_GROUPS + "SELECT mention_id, group_id FROM groups",
    "p2_sizes": _P2_GROUPS
    + ", sizes AS (SELECT group_id, count(*) AS size FROM groups GROUP BY group_id) SELECT size, count(*) AS n_groups FROM sizes GROUP BY size",
}

QUERIES = {"p2_found": p2_found, "p2_sizes": p2_sizes}
