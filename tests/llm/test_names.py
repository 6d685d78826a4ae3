import pytest
from pyspark.sql import functions as F

from docketweave.llm import names

FIELDS = "mention_id string, entity_type string, court string, raw_name string, presentable_name string, normalized_name string, stem string"


@pytest.mark.parametrize(
    "kind, raw, want",
    [
        ("judge", "SHALIRD, YUSUF R.", ("P", "shalird", "yusuf", "r", "", "")),
        ("judge", "Rilezer Elizabeth O.", ("P", "rilezer", "elizabeth", "o", "", "")),
        ("judge", "The Honorable T. K. Clarreck III", ("P", "clarreck", "t", "k", "iii", "")),
        ("judge", "William Fos esse", ("P", "fosesse", "william", "", "", "")),
        ("judge", "Chief Judge Forrutte", ("P", "forrutte", "", "", "", "")),
        ("party", "HaroldO Fompasse a/k/a Hal Fompasse", ("P", "fompasse", "harold", "o", "", "")),
        ("party", "Rboert Roe Jr. Deceased", ("P", "roe", "rboert", "", "jr", "")),
        ("firm", "Talmanni, Hutheston & Genneth, Professional Association (f/k/a T)", ("O", "talmanni hutheston genneth", "", "", "", "pa")),
        ("party", "Sannoric and Zurlend Ins. L.P. -", ("O", "sannoric zurlend insurance", "", "", "", "lp")),
    ],
)
def test_parse(kind, raw, want):
    assert names.parse_name(raw, kind) == want


def test_nothing_to_parse():
    for raw in (None, "", " ", "-", "***", "12"):
        p = names.parse_name(raw, "party")
        assert p is None or not p[1] or p[1].isdigit()
    names.parse_name("long " * 5000, "party")


def parsed(spark, rows):
    df = spark.createDataFrame(rows, "entity_type string, raw string")
    return {r.raw: (r.kind, r.stem, r.g1, r.g2, r.suffix, r.form) for r in names.parse_names(df).collect()}


def test_roles_are_learnt_from_the_corpus(spark):
    """Invented words only: what is a given name is told by layouts that leave no doubt, elsewhere in the corpus."""
    sure = ["Baker, Kevyn T.", "Kevyn R. Wexler", "Lyndra M. Okafur", "Okafur, Lyndra", "Tarquel, Lyndra P.", "Wexler, Osbeth", "Osbeth K. Tarquel"]
    sure += [f"Kevyn {c}. Surn{c.lower()}ame" for c in "ABCDEFG"]
    got = parsed(spark, [("judge", n) for n in [*sure, "Baker Kevyn T.", "Okafur Lyndra", "Lyndra Osbeth Tarquel", "Kvyen Wexler", "Baker Robert T."]])
    assert got["Baker Kevyn T."] == ("P", "baker", "kevyn", "t", "", "")
    assert got["Okafur Lyndra"] == ("P", "okafur", "lyndra", "", "", "")
    assert got["Lyndra Osbeth Tarquel"] == ("P", "tarquel", "lyndra", "osbeth", "", "")
    assert got["Kvyen Wexler"] == ("P", "wexler", "kevyn", "", "", "")
    assert got["Baker Robert T."] == ("P", "baker", "robert", "t", "", "")


def test_organisations_are_learnt_from_the_corpus(spark):
    rows = [("party", f"{n} Glimworks Inc.") for n in ("Abar", "Bebar", "Cibar")] + [("party", f"{n} Colloquy") for n in ("Dobar", "Ebar", "Fubar")]
    got = parsed(spark, [*rows, ("party", "Gabar Glimworks"), ("party", "Hubar Colloqvy"), ("party", "G. Bebar"), ("party", "Ann B. Roe")])
    assert got["Gabar Glimworks"] == ("O", "gabar glimworks", "", "", "", "") and got["Dobar Colloquy"][0] == "O"
    assert got["G. Bebar"][0] == got["Ann B. Roe"][0] == "P"


def test_third_given_names_tell_people_apart(spark):
    e = entities(spark, [("judge", "c", "Roe, Ann Beth Carol"), ("judge", "c", "Roe, Ann Beth Dolores"), ("judge", "c", "Roe, Ann Beth C.")])
    assert e["m0"] == e["m2"] != e["m1"]


def test_established_words_are_no_slips_of_each_other():
    assert names.stem_softness("c", "O", "quondam office", "quondam offices", [1, 40], [1, 30]) == 0
    assert 0 < names.stem_softness("c", "O", "quondam office", "quondam offcie", [1, 40], [1, 1])
    rare, common = names.stem_softness("c", "O", "quondam lines", "quondma lines", [3, 400], [1, 400]), names.stem_softness("c", "O", "quondam lines", "quondam liens", [3, 400], [3, 1])
    assert 0 < rare < common  # a slip in the rare word costs more
    assert names.stem_softness("*", "P", "martin", "marten", [60], [50]) == 0 < names.stem_softness("*", "P", "martin", "marten", [60], [1])


def entities(spark, rows):
    df = spark.createDataFrame([(f"m{i}", *r, None, (r[2] or "").lower() or None, "x") for i, r in enumerate(rows)], FIELDS)
    named = names.name_entities(df)
    out = df.select("mention_id", "entity_type", F.coalesce("court", F.lit("")).alias("court"), names.name_column().alias("raw")).join(named, ["entity_type", "court", "raw"])
    return {r.mention_id: r.entity for r in out.collect()}


def test_links(spark):
    rows = [
        ("judge", "c1", "Greta Naomi Cumposton"), ("judge", "c1", "G. N. Cumposton"), ("judge", "c1", "Cumpsoton, Greta N."), ("judge", "c2", "Greta Naomi Cumposton"),
        ("judge", "c1", "Samuel Vorlitor Sr."), ("judge", "c1", "Samuel Vorlitor Jr."), ("judge", "c1", "Samuel Vorlitor"),
        ("party", "c1", "Stinnoson Financial Inc."), ("party", "c1", "Stinnoson Financial Company"), ("party", "c3", "Stinnosno Financial, Incorporated"),
        ("firm", "c1", "Rulvodan Legal Group PLLC"), ("firm", "c1", "RulvodanLegal Group P.L.L.C."), ("party", None, None), ("party", "c1", "***"), ("judge", "c1", "Greta Naomi Cumposton"),
    ]
    e = entities(spark, rows)
    assert e["m0"] == e["m1"] == e["m2"] == e["m14"] != e["m3"]
    assert len({e["m4"], e["m5"], e["m6"]}) == 3
    assert e["m7"] == e["m9"] != e["m8"]
    assert e["m10"] == e["m11"]
    assert "m12" not in e and "m13" not in e


def test_stem_join_finds_every_slip(spark):
    """Against all pairs: every stem within one slip is found."""
    base = ["cumposton", "vorlitor", "stinnoson", "clolequist", "grerlumond", "dant"]
    slips = {s: [s[:i] + s[i + 1 :] for i in range(len(s))] + [s[:i] + "x" + s[i:] for i in range(len(s))] + [s[:i] + s[i + 1] + s[i] + s[i + 2 :] for i in range(len(s) - 1) if s[i] != s[i + 1]] for s in base}
    stems = sorted({*base, *(x for v in slips.values() for x in v)})
    df = spark.createDataFrame([("judge", "c", "P", s) for s in stems], "entity_type string, block string, kind string, stem string").withColumn("dfs", F.array(F.lit(1).cast("bigint")))
    found = {(r.x, r.y) for r in names.similar_stems(df).collect()}
    for s, variants in slips.items():
        for v in set(variants) - {s}:
            if len(v) > 2:
                assert (min(s, v), max(s, v)) in found, (s, v)


def test_stem_join_finds_two_slips(spark):
    """Judges' and firms' stems of 8 letters and more within two slips, also where few or no q-grams are left."""
    pairs = [("stutalcr", "suttaler"), ("abcdefgh", "acbdegfh"), ("vorlitorn", "volritonr"), ("cumposton", "cupmostno"), ("verrnotarn", "vermotam"), ("montgomery", "mantgomary")]
    df = spark.createDataFrame([("judge", "c", "P", s) for p in pairs for s in p], "entity_type string, block string, kind string, stem string").withColumn("dfs", F.array(F.lit(1).cast("bigint")))
    found = {(r.x, r.y) for r in names.similar_stems(df).collect()}
    assert all(names.stem_softness("c", "P", *p) > 0 and tuple(sorted(p)) in found for p in pairs), found
    one = df.filter("stem = 'suttaler'")
    assert [(r.x, r.y) for r in names.similar_stems(df.filter("stem <> 'suttaler'"), one).collect()] == [("suttaler", "stutalcr")]


def test_stem_join_reads_written_tables(spark):
    """The lineage of the stems, however long, is run once and not again by each side of the join."""
    df = spark.createDataFrame([("judge", "c", "P", s) for s in ("vorlitor", "volritor")], "entity_type string, block string, kind string, stem string").withColumn("dfs", F.array(F.lit(1).cast("bigint")))
    assert "LogicalRDD" in df._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" not in names.similar_stems(df)._jdf.queryExecution().optimizedPlan().toString()


def test_stems_of_one_slip_meet_only_near_ones(spark, monkeypatch):
    """Parties' stems that share q-grams but aren't near are in no common group: the join of 400 of them compares few pairs."""
    stems = [f"{a}{b}anderson"[:11] for a in "bcdfghjklmnpqrstvwxz" for b in ("bo", "cu", "di", "fa", "ge", "hy", "ji", "ko", "lu", "ma", "ne", "po", "qu", "ra", "si", "ta", "vo", "wu", "xe", "za")]
    written = []
    table = names.Scratch.table
    monkeypatch.setattr(names.Scratch, "table", lambda self, df, *a: (written.append(out := table(self, df, *a)), out)[1])
    df = spark.createDataFrame([("party", "*", "P", s) for s in stems], "entity_type string, block string, kind string, stem string").withColumn("dfs", F.array(F.lit(1).cast("bigint")))
    names.similar_stems(df)
    posted = next(t for t in written if {"ctx", "gram"} <= set(t.columns))
    groups = posted.groupBy("ctx", "gram").agg(F.count_distinct("sid").alias("n"))
    assert groups.agg(F.max("n")).first()[0] <= 30  # those that are alike but for one of the first letters; all 400 share "ers"


def test_empty(spark):
    df = spark.createDataFrame([], FIELDS)
    assert names.name_entities(df).count() == 0
