import importlib
import json
import sys

import pytest

from docketweave.functions import text as T
from docketweave.operators.graph import connected_components, constrained_components
from pyspark.sql import functions as F


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "x string").select(column(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(
    "column, value, want",
    [
        (T.strip_honorifics, "The Honorable  Jane Roe", "jane roe"),
        (T.strip_honorifics, "Judge", ""),
        (T.strip_corp_suffixes, "Foo Bar Co., Inc.", "Foo Bar"),
        (T.strip_corp_suffixes, "foo,inc", "foo,inc"),
        (T.corp_core, "Alpha-Beta Gamma Delta Epsilon LLC", "alpha beta gamma delta"),
        (T.surname, "john smith jr", "smith"),
        (T.surname, None, None),
        (T.surname, "", None),
        (T.presentable, "o'connell-SMITH", "O'Connell-Smith"),
        (T.legal_form, "Foo L.P.", "lp"),
        (T.legal_form, "Inc", None),
        (T.email_domain, "a@B.example", "b.example"),
        (T.email_domain, "a@", None),
        (T.phone_key, "+1 (555) 123-4567", "5551234567"),
        (T.phone_key, "123", None),
        (T.iso_date, "02/26/2014", "2014-02-26"),
        (T.iso_date, "soon", None),
        (T.office_geo, "1 Main St\nSpring Falls, OH 12345-6789\nNA", "spring falls|OH"),
    ],
)
def test_functions(spark, column, value, want):
    assert one(spark, column, value) == want


def brute(edges):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {x: find(x) for x in parent}


def test_components(spark):
    import random

    rng = random.Random(3)
    edges = [(f"v{rng.randrange(60):02d}", f"v{rng.randrange(60):02d}") for _ in range(45)] + [(f"c{i:02d}", f"c{i + 1:02d}") for i in range(30)]
    edges = [e for e in edges if e[0] != e[1]]
    got = {r.id: r.component for r in connected_components(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert got == brute(edges)


def test_constrained_components_keep_listed_parties_apart(spark):
    edges = spark.createDataFrame([("a", "b", 1), ("b", "c", 2), ("x", "y", 1)], "a string, b string, rank int")
    slots = spark.createDataFrame([("a", "u1", 0, "ann"), ("c", "u1", 1, "cal"), ("x", "u2", 0, "xi"), ("y", "u3", 1, "yo")], "id string, ucid string, entry int, name string")
    got = {r.id: r.component for r in constrained_components(edges, slots).collect()}
    assert got == {"a": "a", "b": "a", "c": "c", "x": "x", "y": "x"}


def test_stream_resolves_once_and_replays(spark, tmp_path):
    from docketweave.streaming.incremental import resolve_batch, resolve_stream

    source = tmp_path / "in"
    source.mkdir()
    case = lambda name: json.dumps({"parties": [{"name": name, "counsel": [{"name": "Q", "entity_info": {"office_name": "Foo LLP"}}, {"name": "Q", "has_see_above": True, "entity_info": {}}]}]})
    (source / "a.json").write_text(case("Ann Roe"))
    (source / "broken.json").write_text("{")
    paths = [str(tmp_path / p) for p in ("registry", "out", "checkpoint")]
    resolve_stream(spark, str(source), *paths).awaitTermination(120)
    (source / "b.json").write_text(case("Ann Roe"))
    resolve_stream(spark, str(source), *paths).awaitTermination(120)
    out = spark.read.parquet(paths[1])
    assert out.count() == 6 and out.select("sjid").distinct().count() == 3  # one firm, and a namesake in each case
    assert out.filter("raw_name = 'Foo LLP'").count() == 4
    from docketweave.sources.cases import read_cases

    before = sorted(map(tuple, spark.read.parquet(paths[0]).collect()))
    resolve_batch(read_cases(spark, str(source)).filter("case_key = 'b.json'"), 1, paths[0], paths[1])
    assert sorted(map(tuple, spark.read.parquet(paths[0]).collect())) == before


def test_sinks(spark, small, tmp_path):
    from docketweave.plans.evaluation import triples
    from docketweave.sources.cases import write_turtle

    write_turtle(triples(spark, small), str(tmp_path / "t"))
    lines = [r.value for r in spark.read.text(str(tmp_path / "t")).collect()]
    assert lines and all(s.startswith("<urn:dw:") and s.endswith(" .") for s in lines)


def test_entry_and_absent_subpackage(spark):
    import __spark_entry__

    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).limit(1).count() == 1

    class Blocker:
        def find_spec(self, name, path=None, target=None):
            if name.startswith("docketweave.llm"):
                raise ImportError(name)

    held = {k: sys.modules.pop(k) for k in list(sys.modules) if k.startswith("docketweave.llm")}
    sys.meta_path.insert(0, Blocker())
    try:
        entry = importlib.reload(__spark_entry__)
        assert "p6_found" in entry.queries() and "p1_found" not in entry.queries()
    finally:
        sys.meta_path.pop(0)
        sys.modules.update(held)
        importlib.reload(__spark_entry__)
