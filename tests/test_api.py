import json

import docketweave as dw


def test_extract_and_resolve(spark, tmp_path):
    counsel = {"name": "Q", "is_pro_se": False, "entity_info": {"office_name": "Foo & Bar LLP", "email": "q@foo.example"}}
    doc = {"parties": [{"name": "Ann Roe", "role": "Plaintiff", "counsel": [counsel, {**counsel, "is_pro_se": True}]}, {"name": "Roe Inc.", "role": "Defendant", "counsel": None}]}
    (tmp_path / "a.json").write_text(json.dumps(doc))
    (tmp_path / "b.json").write_text("not json")
    (tmp_path / "c.txt").write_text("{}")
    mentions = dw.extract(dw.read_cases(spark, str(tmp_path)))
    got = {(r.entity_type, r.raw_name, r.normalized_name, r.office_class) for r in mentions.collect()}
    assert got == {("party", "Ann Roe", "ann roe", "other"), ("party", "Roe Inc.", "roe", "corporate"), ("firm", "Foo & Bar LLP", "foo & bar", "law_firm")}
    assert mentions.select("mention_id").distinct().count() == 3


def test_evaluate(spark):
    df = spark.createDataFrame([("m1", "g1", "p1"), ("m2", "g1", "p1"), ("m3", "g2", "p1")], "mention_id string, gold string, pred string")
    r = dw.evaluate(df).first()
    assert (r.precision, r.recall) == (round(5 / 9, 6), 1.0)
    assert dw.evaluate(df.limit(0)).first().precision is None
