"""Connected components and constrained merging over edge tables."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketweave.session import Scratch


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) with the smallest id of each component, by alternating large and small stars.

    Every step is a partial aggregate and an equi-join, so a hub's edges are split by skew handling. Rounds grow with
    the logarithm of the longest chain; each is written to the shared folder, which cuts the lineage.
    """
    scratch = Scratch(edges.sparkSession, "components")
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    live = scratch.table(pairs)
    seen = None
    while True:
        both = live.union(live.select("v", "u"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").union(low.select("u", F.col("m").alias("v")))
        after = scratch.table(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
        state = after.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        scratch.drop(live)
        live = after
        if tuple(state) == seen:
            return live.select(F.col("u").alias("id"), F.col("v").alias("component")).union(live.select(F.col("v"), F.col("v")).distinct())
        seen = tuple(state)


def star_edges(rows: DataFrame, key: list[str], id_column: str = "mention_id") -> DataFrame:
    """(mention_id_a, mention_id_b): every member of a key group linked to its smallest id.

    The smallest id comes from a partial aggregate and not a window, so a key that very many rows share is never sorted in one task.
    """
    roots = rows.groupBy(*key).agg(F.min(id_column).alias("root"))
    return rows.join(roots, key).filter(F.col(id_column) != F.col("root")).select(F.col("root").alias("mention_id_a"), F.col(id_column).alias("mention_id_b")).distinct()


def constrained_components(edges: DataFrame, slots: DataFrame, order: str = "rank") -> DataFrame:
    """(id, component) where no component may hold two different names listed for different entries of one case.

    edges (a, b, rank); slots (id, ucid, entry, name). Plain components that break no rule stay as they are; only the
    others are merged greedily, in rank order, each on its own: the outcome equals one sequential pass over all edges.
    """
    scratch = Scratch(edges.sparkSession, "constrained")
    plain = scratch.table(connected_components(edges))
    held = slots.join(plain, "id").select("component", "ucid", "entry", "name").distinct()
    broken = held.groupBy("component", "ucid").agg(F.count_distinct("entry").alias("entries"), F.count_distinct("name").alias("names")).filter("entries > 1 and names > 1").select("component").distinct()
    broken = scratch.table(broken)
    fine = plain.join(broken, "component", "left_anti").select("id", "component")
    inside = scratch.table(edges.join(plain.withColumnRenamed("id", "a"), "a").join(broken, "component", "left_semi"))
    listed = scratch.table(slots.join(plain, "id").join(broken, "component", "left_semi").select("component", "id", "ucid", "entry", "name"))

    def merge(links: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        parent: dict[str, str] = {}

        def find(x: str) -> str:
            while parent.setdefault(x, x) != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        seats: dict[str, dict] = {}
        for r in own.itertuples():
            seats.setdefault(r.id, {}).setdefault(r.ucid, set()).add((r.entry, r.name))
        for r in links.sort_values([order, "a", "b"]).itertuples():
            x, y = find(r.a), find(r.b)
            if x == y:
                continue
            p, q = seats.get(x, {}), seats.get(y, {})
            if any(e != f and n != o for u in p.keys() & q.keys() for e, n in p[u] for f, o in q[u]):
                continue
            x, y = min(x, y), max(x, y)
            parent[y] = x
            merged = seats.setdefault(x, {})
            for u, s in seats.pop(y, {}).items():
                merged.setdefault(u, set()).update(s)
        ids = sorted({*links["a"], *links["b"]})
        return pd.DataFrame({"id": ids, "component": [find(i) for i in ids]})

    greedy = inside.groupBy("component").cogroup(listed.groupBy("component")).applyInPandas(merge, "id string, component string")
    return fine.union(greedy)
