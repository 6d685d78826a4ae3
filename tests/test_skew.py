from itertools import combinations

from docketweave.operators.skew import group_pairs


def test_pairs_equal_brute_force(spark):
    rows = [("hot", i, f"n{i % 3}") for i in range(60)] + [(f"g{i % 7}", 100 + i, "x") for i in range(20)]
    df = spark.createDataFrame(rows, "grp string, id int, name string")
    got = sorted((r.id_a, r.id_b, r.name_a, r.name_b) for r in group_pairs(df, "grp", "id", ["name"], chunk=8).collect())
    want = sorted((a[1], b[1], a[2], b[2]) for a, b in combinations(sorted(rows, key=lambda r: r[1]), 2) if a[0] == b[0])
    assert got == want
    assert group_pairs(df.limit(0), "grp", "id").count() == 0
