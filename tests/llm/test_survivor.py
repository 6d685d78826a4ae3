from docketweave.llm import survivor

MEMBER = "grp string, key string, entity_type string, docket_source string, filing_date string, presentable_name string, address string, phone string, email string, value string"
TRUST = "docket_source string, trust_rank int"
PLACE = "12 East Main Court\nSuite 5\nSpring, OH 12345"


def run(spark, rows):
    members = spark.createDataFrame([(*r, "x") for r in rows], MEMBER)
    trust = spark.createDataFrame([("a", 5), ("b", 2)], TRUST)
    return {(r.grp, r.field_name): r.key for r in survivor.survivors(members, trust).collect()}


def test_choice(spark):
    rows = [
        ("g", "1", "party", "a", "2020-01-01", "G. Roe", "12 E Main Ct, Ste 5, Spring, OH", "555-1234", "a at b.example"),
        ("g", "2", "party", "b", "01/31/2019", "Greta Naomi Roe", PLACE, "(216) 555-1234", "a@b.example"),
        ("g", "3", "party", "b", "2018-01-01", "Greta Naomi Roe presiding", PLACE.replace("Spring", "Sprong"), None, "NA"),
        ("g", "4", "party", "b", "2018-12-01", "GRETA NAOMI ROE", PLACE, "216.555.1234", " "),
        ("h", "5", "party", "a", "2020-01-01", "Ann Roe", None, None, None),
        ("k", "6", "firm", "b", "2020-01-01", "Foo & Bar LLP", None, None, None),
        ("k", "7", "firm", None, None, "Foo And Bar L.L.P.", None, "", None),
        ("k", "8", "firm", "a", "2020-01-01", "Foo Bar", None, "NA", None),
        ("k", "8", "firm", "a", "2020-01-01", "Foo Bar", None, "NA", None),
    ]
    assert run(spark, rows) == {("g", "presentable_name"): "2", ("g", "address"): "2", ("g", "phone"): "2", ("g", "email"): "2", ("k", "presentable_name"): "6"}


def test_ties_and_empty(spark):
    rows = [("g", k, "party", "a", "2020-01-01", "Greta Roe", None, None, None) for k in ("z", "b", "c")]
    assert run(spark, rows) == {("g", "presentable_name"): "b"}
    assert run(spark, []) == {}


def test_missing_dates_take_learnt_order(spark):
    """Elsewhere old@ was followed by new@, so an undated new@ is later than a dated old@."""
    rows = [("a", "1", "judge", "a", "2010-01-01", None, None, None, "old@x.example"), ("a", "2", "judge", "a", "2012-01-01", None, None, None, "new@x.example")]
    rows += [("b", "3", "judge", "a", "2015-01-01", None, None, None, "old@x.example"), ("b", "4", "judge", "a", None, None, None, None, "new@x.example")]
    rows += [("c", "5", "judge", "a", "2015-01-01", None, None, None, "new@x.example"), ("c", "6", "judge", "a", None, None, None, None, "other@x.example")]
    got = run(spark, rows)
    assert got[("a", "email")] == "2" and got[("c", "email")] == "5"
    assert got[("b", "email")] in ("3", "4")


def test_groups_without_dates_take_the_topologically_latest_value(spark):
    """a before b before c is learnt elsewhere in single steps; an undated group with a and c, or with a dated a, takes c."""
    steps = [("x1", "a"), ("x1", "b"), ("x2", "b"), ("x2", "c")]
    rows = [(g, f"{g}{v}", "judge", "a", f"20{10 + i}-01-01", None, None, None, f"{v}@x.example") for i, (g, v) in enumerate(steps)]
    rows += [("u", "1", "judge", "a", None, None, None, None, "a@x.example"), ("u", "2", "judge", "a", None, None, None, None, "c@x.example")]
    rows += [("w", "3", "judge", "a", "2020-01-01", None, None, None, "a@x.example"), ("w", "4", "judge", "a", None, None, None, None, "c@x.example"), ("w", "5", "judge", "a", None, None, None, None, "z@x.example")]
    rows += [("v", "6", "judge", "a", None, None, None, None, "b@x.example"), ("v", "7", "judge", "a", None, None, None, None, "z@x.example"), ("v", "8", "judge", "a", None, None, None, None, "a@x.example")]
    got = run(spark, rows)
    assert got[("u", "email")] == "2"
    assert got[("w", "email")] in ("3", "4")  # c follows a, so it is at least as late; ties go to the smaller key
    assert got[("v", "email")] == "6"  # b follows a; z is in no order


def test_precedence_with_a_cycle_ends(spark):
    rows = []
    for g, order in (("p", "ab"), ("q", "bc"), ("r", "ca")):
        rows += [(g, f"{g}{v}", "judge", "a", f"20{10 + i}-01-01", None, None, None, f"{v}@x.example") for i, v in enumerate(order)]
    rows += [("s", k, "judge", "a", None, None, None, None, f"{v}@x.example") for k, v in (("1", "a"), ("2", "b"))]
    assert run(spark, rows)[("s", "email")] == "1"
