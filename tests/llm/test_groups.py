import random

import numpy as np

from docketweave.llm import groups


def brute(edges):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {x: find(x) for x in parent}


def test_local_union_find():
    rng = np.random.default_rng(1)
    for _ in range(50):
        a, b = rng.integers(0, 40, 30), rng.integers(0, 40, 30)
        v, r = groups.union_find(a, b)
        want = brute(list(zip(a.tolist(), b.tolist())))
        assert dict(zip(v.tolist(), r.tolist())) == want


def test_grid_rounds_chains_and_hubs(spark):
    rng = random.Random(5)
    edges = [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(120)] + [("hub", f"h{i:03d}") for i in range(150)]
    edges += [(f"r{rng.randrange(90):02d}", f"r{rng.randrange(90):02d}") for _ in range(70)]
    rng.shuffle(edges)
    df = spark.createDataFrame([(a, b, 1) for a, b in edges], "a string, b string, id int")
    got = {r.id: r.group_id for r in groups.components(df, "a", "b", edges_per_cell=10).collect()}
    assert got == brute([e for e in edges if e[0] != e[1]])


def test_dirty_and_empty(spark):
    df = spark.createDataFrame([("b", "a"), ("a", "b"), ("a", None), ("x", "x"), (None, None), ("b", "a")], "a string, b string")
    assert sorted(map(tuple, groups.components(df, "a", "b").collect())) == [("a", "a"), ("b", "a")]
    assert groups.components(df.limit(0), "a", "b").count() == 0
