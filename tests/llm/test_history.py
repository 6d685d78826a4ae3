import uuid

import numpy as np
import pytest

from docketweave.llm import history, names
from docketweave.session import shared_dir

MENTION = "mention_id string, entity_type string, court string, raw_name string, presentable_name string, normalized_name string, email string, phone string, sjid string"
REGISTRY = "sjid string, mention_ids array<string>"


def mention(i, kind, court, name, email=None, phone=None):
    return (i, kind, court, name, None, None, email, phone, "clash")


def found(df):
    return {r.mention_id: r.sjid for r in df.collect()}


def test_known_and_new(spark):
    held = spark.createDataFrame(
        [mention("h1", "judge", "c1", "Greta Naomi Cumposton"), mention("h2", "party", "c1", "Stinnoson Financial Inc."), mention("h3", "party", "c1", "Stinnoson Financial Company"), mention("h4", "party", "c2", "Ruth Honnuwick", "r@m.example"), mention("h5", "party", "c2", "R. Honnuwick"), mention("h6", "judge", None, None), mention("h7", "firm", "c1", "  ***  ")],
        MENTION,
    )
    registry = spark.createDataFrame([("S1", ["h1", "h1"]), ("S2", ["h2"]), ("S4", ["h4", "h5", None]), (None, ["h3"])], REGISTRY)
    batch = spark.createDataFrame(
        [mention("h1", "judge", "c1", "damaged"), mention("n1", "judge", "c1", "Cumpsoton, Greta N."), mention("n2", "judge", "c2", "Greta Naomi Cumposton"), mention("n3", "party", "c5", "Stinnoson Financial Incorporated"), mention("n4", "party", "c1", "Stinnoson Financial Company"), mention("n5", "party", None, None), mention("n6", "party", "c1", "x" * 5000)],
        MENTION,
    )
    got = found(history.known_entities(held, registry, batch))
    assert got == {"h1": "S1", "n1": "S1", "n3": "S2"}
    assert history.known_entities(held, registry, batch.limit(0)).count() == 0
    assert history.known_entities(held.limit(0), registry.limit(0), batch).count() == 0


def slips(rng, stem, k):
    s = list(stem)
    for _ in range(k):
        i = int(rng.integers(0, len(s) - 1))
        match int(rng.integers(0, 4)):
            case 0:
                s[i], s[i + 1] = s[i + 1], s[i]
            case 1:
                del s[i]
            case 2:
                s.insert(i, str(rng.choice(list("aeiou"))))
            case _:
                s[i] = str(rng.choice(list("bcdfgh")))
    return "".join(s)


def test_search_equals_brute_force(spark):
    """The production path: the nearest cell, then all others that the bounds leave, over an index opened again, with many cells."""
    rng = np.random.default_rng(2)
    stems = sorted({"".join(rng.choice(list("abdeilmnorstu"), int(rng.integers(5, 14)))) for _ in range(600)})
    held = spark.createDataFrame([mention(f"h{i}", "judge", f"c{i % 2}", f"Greta {s.title()}") for i, s in enumerate(stems)], MENTION)
    registry = spark.createDataFrame([(f"S{i}", [f"h{i}"]) for i in range(len(stems))], REGISTRY)
    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}-brute"
    history.HistoryIndex.create(spark, path, held.filter("court = 'c0'"), registry, cells=40).append(held.filter("court = 'c1'"), registry)
    index = history.HistoryIndex.open(spark, path)
    queries = [slips(rng, s, 2 if len(s) >= 8 else 1) for s in stems[::5]]
    rows = [("judge", f"c{i}", "P", q, 4 if len(q) >= 8 else 2) for q in queries for i in (0, 1)]
    asked = spark.createDataFrame(rows, "entity_type string, block string, kind string, stem string, bound int")
    got = {(r.block, r.query, r.stem, r.distance) for only in (True, False) for r in index.search(asked, only).collect()}
    a, b = history.letter_vectors(queries), history.letter_vectors(stems)
    d = np.abs(a[:, None] - b[None]).sum(2)
    want = {(f"c{j % 2}", queries[i], stems[j], int(d[i, j])) for i in range(len(queries)) for j in range(len(stems)) if d[i, j] <= (4 if len(queries[i]) >= 8 else 2)}
    assert got == want
    assert index.probed["nearest"] + index.probed["others"] < 0.8 * len(set(rows)) * 40  # the bounds leave cells out


def test_search_where_very_many_ask_one_cell(spark, monkeypatch):
    """Cells whose stems and queries are both cut into pieces give each pair once."""
    monkeypatch.setattr(history, "CHUNK", 5)
    rng = np.random.default_rng(7)
    stems = sorted({"".join(rng.choice(list("abdeilmnorstu"), int(rng.integers(8, 12)))) for _ in range(60)})
    held = spark.createDataFrame([mention(f"h{i}", "judge", "c0", f"Greta {s.title()}") for i, s in enumerate(stems)], MENTION)
    registry = spark.createDataFrame([(f"S{i}", [f"h{i}"]) for i in range(len(stems))], REGISTRY)
    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}-asked"
    index = history.HistoryIndex.create(spark, path, held, registry, cells=4)
    queries = sorted({slips(rng, s, 1) for s in stems})
    asked = spark.createDataFrame([("judge", "c0", "P", q, 2) for q in queries], "entity_type string, block string, kind string, stem string, bound int")
    got = [(r.query, r.stem, r.distance) for only in (True, False) for r in index.search(asked, only).collect()]
    d = np.abs(history.letter_vectors(queries)[:, None] - history.letter_vectors(stems)[None]).sum(2)
    want = {(queries[i], stems[j], int(d[i, j])) for i, j in zip(*np.nonzero(d <= 2))}
    assert len(got) == len(set(got)) and set(got) == want


def test_reach_covers_all_accepted_slips():
    """Letter distances never exclude a pair that verification accepts, at any length of the stem."""
    rng = np.random.default_rng(3)
    seen = {}
    for _ in range(6000):
        s = "".join(rng.choice(list("abdeilmnorstu"), int(rng.integers(3, 16))))
        t = slips(rng, s, int(rng.integers(1, 3)))
        for block in ("c", "*"):
            if s != t and names.stem_softness(block, "P", s, t) > 0 and names._scan(s) != names._scan(t):
                two = len(s) >= 12 or (block != "*" and len(s) >= 8)
                d = np.abs(history.letter_vectors([s]) - history.letter_vectors([t])).sum()
                hit, n = seen.get(len(s), (0, 0))
                seen[len(s)] = (hit + (d <= (4 if two else 2)), n + 1)
    assert len(seen) > 10 and all(hit == n for hit, n in seen.values())


def test_two_sessions_append_and_reopen(spark):
    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}-two"
    first = spark.createDataFrame([mention("h1", "judge", "c1", "Greta Naomi Cumposton"), mention("h2", "firm", "c1", "Vorlitor & Quint LLP")], MENTION)
    history.HistoryIndex.create(spark, path, first, spark.createDataFrame([("S1", ["h1"])], REGISTRY), cells=3)
    batch = spark.createDataFrame([mention("n1", "judge", "c1", "G. N. Cumposton"), mention("n2", "firm", "c1", "Vorlitor & Zuzz, L.L.P."), mention("n3", "judge", "c1", "Omar Thrabble")], MENTION)
    second = history.HistoryIndex.open(spark.newSession(), path)
    assert found(second.match(batch)) == {"n1": "S1"}
    second.append(batch, spark.createDataFrame([("S1", ["n1"]), ("S2", ["n2", "h2"]), ("S3", ["n3"])], REGISTRY))
    third = history.HistoryIndex.open(spark, path)
    later = spark.createDataFrame([mention("m1", "firm", "c1", "Vorlitor and Zuzz LLP"), mention("m2", "judge", "c1", "Thrabble, Omar"), mention("n3", "judge", "c9", "redelivered")], MENTION)
    assert found(third.match(later)) == {"m1": "S2", "m2": "S3", "n3": "S3"}
    fs, at = history.HistoryIndex._fs(spark, path)
    fs.rename(at(f"{path}/parts/{third._parts()[0]}"), at(f"{path}/parts/half.tmp"))  # a part that was never completed is not seen
    assert len(history.HistoryIndex.open(spark, path)._parts()) == 1


def test_only_probed_zones_are_read(spark):
    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}-zones"
    rng = np.random.default_rng(5)
    stems = sorted({"".join(rng.choice(list("abdeilmnorstu"), int(rng.integers(3, 30)))) for _ in range(400)})
    held = spark.createDataFrame([mention(f"h{i}", "party", "c1", f"Greta B. {s.title()}") for i, s in enumerate(stems)], MENTION)
    index = history.HistoryIndex.create(spark, path, held, spark.createDataFrame([("S1", ["h1"])], REGISTRY), cells=160)
    asked = spark.createDataFrame([("party", "*", "P", stems[7], 2)], "entity_type string, block string, kind string, stem string, bound int")
    index.search(asked, only_nearest=True).collect()
    assert index.probed["zones read"] == 1 < len({r.zone for r in index._table("vectors").select("zone").distinct().collect()})


@pytest.mark.parametrize("listed", ["Robert Thornqist", "Thornqist"])
def test_unregistered_hit_does_not_stop(spark, listed):
    """A registered spelling one slip away is found beside an unregistered one at distance zero."""
    held = [mention("h1", "judge", "c1", "Robert James Thornquist"), mention("h2", "judge", "c1", listed)]
    others = [mention(f"o{i}", "judge", "c1", f"Ruth {w}") for i, w in enumerate(["Vorlitor", "Zempiric", "Abbadon", "Quillish", "Mumfort", "Tethering"])]
    registry = spark.createDataFrame([("S1", ["h1"])], REGISTRY)
    batch = spark.createDataFrame([mention("n1", "judge", "c1", "Robert James Thornqist")], MENTION)
    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}-stop-{len(listed)}"
    index = history.HistoryIndex.create(spark, path, spark.createDataFrame(held + others, MENTION), registry, cells=8)
    assert found(index.match(batch)) == {"n1": "S1"}


def test_slips_beyond_any_cosine(spark):
    """Two slips that leave few common q-grams are found in the query's own court."""
    held = spark.createDataFrame([mention(f"h{i}", "judge", "c1", n) for i, n in enumerate(["Greta Suttaler", "Omar Montgomery", "Ruth Vorlitor", "Ivan Cumposton"])], MENTION)
    registry = spark.createDataFrame([(f"S{i}", [f"h{i}"]) for i in range(4)], REGISTRY)
    batch = spark.createDataFrame([mention("n0", "judge", "c1", "Greta Stutalcr"), mention("n1", "judge", "c1", "Omar Mantgomary"), mention("n2", "judge", "c2", "Greta Stutalcr")], MENTION)
    assert found(history.known_entities(held, registry, batch)) == {"n0": "S0", "n1": "S1"}


def test_keys_find_what_letters_do_not_bound(spark):
    held = spark.createDataFrame([mention("h1", "judge", "c1", "Greta Vorlitor-Cumposton"), mention("h2", "firm", "c1", "Silbam Quexington LLP"), mention("h3", "judge", "c1", "Ruth Mimburn")], MENTION)
    registry = spark.createDataFrame([("S1", ["h1"]), ("S2", ["h2"]), ("S3", ["h3"])], REGISTRY)
    batch = spark.createDataFrame([mention("n1", "judge", "c1", "Greta Cumposton"), mention("n2", "firm", "c1", "S. Quexington LLP"), mention("n3", "judge", "c1", "Ruth Mirnbum")], MENTION)
    got = found(history.known_entities(held, registry, batch))
    assert got["n1"] == "S1" and got["n2"] == "S2"


def test_vectors():
    v = history.letter_vectors(["ab b", "", "é\U0001f600"])
    assert v[0, 0] == 1 and v[0, 1] == 2 and v[1].sum() == 0 and v[2].sum() == 2
