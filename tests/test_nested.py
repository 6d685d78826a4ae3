import json

from hypothesis import given, settings
from hypothesis import strategies as st

from docketweave.operators.nested import CASE_TREE, StructuralIndex, flatten_json, walk_batch


def items(x):
    if isinstance(x, str):
        try:
            x = json.loads(x)
        except ValueError:
            return []
    if isinstance(x, list):
        return list(enumerate(x))
    if isinstance(x, dict) and x:
        return [(int(k), v) for k, v in x.items()] if all(k.isdigit() and k.isascii() for k in x) else [(0, x)]
    return []


def expected(text):
    try:
        doc = json.loads(text)
    except ValueError:
        return set()
    out = set()
    if isinstance(doc, dict):
        for i, p in items(doc.get("parties")):
            if isinstance(p, dict):
                out.add(("party", -1, i))
                out |= {("counsel", i, j) for j, c in items(p.get("counsel")) if isinstance(c, dict)}
        out |= {("docket", -1, i) for i, d in items(doc.get("docket")) if isinstance(d, dict)}
    return out


def found(text):
    return {r[1:4] for r in walk_batch([text], CASE_TREE)}


CASES = [
    '{"parties": [{"name": "A", "counsel": [{"name": "x"}, null, {"name": "y"}]}, null, {"name": "B"}], "docket": []}',
    '{"parties": {"0": {"name": "A", "counsel": {"name": "only"}}, "1": null, "2": {}}}',
    json.dumps({"parties": json.dumps([{"name": 'q"uo\\te', "counsel": json.dumps([{"a": 1}])}]), "docket": json.dumps({"docket_text": "[{,"})}),
    '{"docket": [1, "x", {"docket_text": "{[\\\\\\"]}"}], "parties": null}',
    '{ "parties" : [ { } , {\n"counsel":[ { } ]} ] }',
]


def test_shapes():
    for text in CASES:
        assert found(text) == expected(text), text


def test_unreadable_and_empty():
    for text in (None, "", " ", "<html>502</html>", '{"parties": [{"name": "A"}', "null", "[]", '"x"', "{}"):
        assert found(text) == set()


def test_envelopes():
    inner = {"parties": [{"name": "A"}]}
    for doc in ([inner], {"case": inner, "meta": {}}, {"data": {"case": inner}}):
        assert found(json.dumps(doc)) == {("party", -1, 0)}


def test_repeated_key_counts_last():
    assert found('{"parties": [{}, {}], "parties": [{}]}') == {("party", -1, 0)}


leaf = st.none() | st.booleans() | st.integers(-5, 5) | st.text(alphabet='a"\\{}[],: \n中é', max_size=6)
thing = st.recursive(leaf, lambda x: st.lists(x, max_size=3) | st.dictionaries(st.sampled_from(["counsel", "name", "0", "1", 'k"{']), x, max_size=3), max_leaves=10)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.dictionaries(st.sampled_from(["parties", "docket", "x"]), thing, max_size=3), min_size=1, max_size=4))
def test_against_parser(docs):
    texts = [json.dumps(d, ensure_ascii=False) for d in docs] + ["{", "]"]
    got = {(r[0], *r[1:4]) for r in walk_batch(texts, CASE_TREE)}
    assert got == {(i, *e) for i, t in enumerate(texts) for e in expected(t)}


def test_long_text():
    doc = {"parties": [{"name": "n" * 1000, "counsel": [{"i": i} for i in range(50)]} for _ in range(40)]}
    assert len(found(json.dumps(doc))) == 40 + 40 * 50
    assert StructuralIndex([b""]).containers == 0


def test_frame_with_clashing_columns(spark):
    df = spark.createDataFrame([(1, CASES[0], "z", 5), (2, None, "z", 5), (2, "{", "z", 5)], "case_key bigint, case_json string, fields string, node_kind int")
    out = flatten_json(df, "case_key", "case_json").collect()
    assert {(r.case_key, r.node_kind, r.parent_index, r.item_index) for r in out} == {(1, *e) for e in expected(CASES[0])}
    assert next(r.fields for r in out if r.node_kind == "party")["name"] == "A"
    assert flatten_json(df.limit(0), "case_key", "case_json").count() == 0


def test_any_depth_of_nesting():
    from docketweave.operators.nested import CASE_TREE, walk_batch, well_formed

    doc = '{"parties": [{"name": "A"}]}'
    wrapped = "[" * 40 + doc + "]" * 40
    inside = '{"case": ' * 30 + doc + "}" * 30
    deep = '{"parties": [{"name": "A"}], "x": ' + "[" * 20_000 + "]" * 20_000 + "}"
    for text in (wrapped, inside, deep):
        assert [r[:4] for r in walk_batch([text], CASE_TREE)] == [(0, "party", -1, 0)]
    assert walk_batch([deep[:-1], deep.replace("]", "}", 1)], CASE_TREE) == []


def test_grammar_equals_the_parser():
    import json

    from docketweave.operators.nested import well_formed

    good = ['{"a": [1, -2.5e3, true, null, "x\\u00e9\\n"], "b": {}}', " [] ", "0", '"s"', '{"a":{"b":[[]]}}']
    bad = ["", "{", "[1,]", '{"a"}', '{"a":1,}', "[1 2]", "01", "{1:2}", '"\\x"', "[]]", "nul", '{"a":1 "b":2}', "[,1]", '"\n"', ":"]
    for t in good + bad:
        try:
            json.loads(t)
            want = True
        except ValueError:
            want = False
        assert well_formed(t) == want, t
