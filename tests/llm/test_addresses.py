import pytest

from docketweave.llm.addresses import align, parse, same_building, same_place, tokens_of

BASE = "4701 South Fidaler Road\nSuite 568\nFrolmaven Springs, TX 43129"


@pytest.mark.parametrize(
    "text",
    ["4701 S. FIDALER RD. STE 568 FROLMAVEN SPRINGS TX 43129-5701", "Suite 568, 4701 S Fidaler Rd, Frolmaven Springs, Texas", "Frolmaven Springs, T.X. 43129; 4701 S. Fidlaer Raod; #568", "Gray Tower\n4701 South Fida1er Rd.\nRm 568\n**NA**\nTX 43129\nUSA"],
)
def test_same(text):
    assert same_building(parse(BASE), parse(text)) and parse(text)["unit"] == "568"


@pytest.mark.parametrize("text", ["4702 South Fidaler Road\nFrolmaven Springs, TX 43129", "4701 North Fidaler Road\nFrolmaven Springs, TX 43129", "4701 South Fidaler Court\nFrolmaven Springs, TX 43129", "4701 South Fidaler Road\nSuite 568\nGotax, TN 24667", "4701 South Bremral Road\nFrolmaven Springs, TX 43129"])
def test_other_place(text):
    assert not same_building(parse(BASE), parse(text))


def test_parts():
    assert parse("P. O. BOX 6928 CLOTTENE STATION JUMPALOV SPRINGS TN 54488-5816")["box"] == "6928"
    assert parse("9th Floor, 12 E Main Ct, Spring, FL")["unit"] == parse("12 East Main Court\nNinth Floor\nSpring, FL 11111")["unit"] == "floor9"
    assert parse("Filmallo, WA 65349; 1069 N Codash Ct.; Ste 362")["word"] == "court"
    assert parse(None) is parse("") is parse(" \n") is parse("NA") is parse("no number here")


def test_affine_gap():
    full, short = tokens_of(parse(BASE)), tokens_of(parse("4701 Fidaler Road, TX"))
    assert 0 < align(full, short) < 3 and align(full, full) == 0


def test_frame(spark):
    rows = [(1, BASE, "p"), (2, "4701 S Fidaler Rd, Ste. 568, Frolmaven Springs, TX", "p"), (3, BASE, "p"), (4, "4701 South Fidaler Road\nFrolmaven Springs, TX 43129", "p"), (5, None, "p"), (6, "", "p"), (7, "x" * 9000, "p"), (8, BASE.replace("568", "569").replace("4701", "88"), "p")]
    df = spark.createDataFrame(rows, "address_id bigint, address string, place string")
    got = {r.address_id: r.place for r in same_place(df, "address_id", "address").collect()}
    assert got[1] == got[2] == got[3] == got[4] != got[8] and not {5, 6, 7} & set(got)
    two = df.union(spark.createDataFrame([(9, BASE.replace("568", "570"), "p")], df.schema))
    got = {r.address_id: r.place for r in same_place(two, "address_id", "address").collect()}
    assert got[1] == got[2] and len({got[1], got[4], got[9]}) == 3
    assert same_place(df.limit(0), "address_id", "address").count() == 0


def test_isolated_slips_meet(spark):
    """Pairs that same_building accepts and no third spelling links; many, as the bands find a share of them by chance."""
    rows = []
    for i, (x, y, ends) in enumerate([("Main", "Mian", ("Frolmaven, TX 43129", "Frolmaven, TX")), ("Cedar", "Cdear", ("Frolmaven, TX 43129", "Frolmaven, TX")), ("Oa", "Ao", ("Frolmaven, TX", "Frolmaven 43129")), ("Kenilworth", "Eknliwotrh", ("Frolmaven, TX 43129", "Frolmaven 43129"))] * 8):
        rows += [(2 * i, f"{100 + i} {x} Street\n{ends[0]}"), (2 * i + 1, f"{100 + i} {y} Street\n{ends[1]}")]
    got = {r.address_id: r.place for r in same_place(spark.createDataFrame(rows, "address_id bigint, address string"), "address_id", "address").collect()}
    for i in range(0, len(rows), 2):
        assert same_building(parse(rows[i][1]), parse(rows[i + 1][1])), rows[i : i + 2]
        assert got[i] == got[i + 1], rows[i : i + 2]
    assert len(set(got.values())) == len(rows) // 2
