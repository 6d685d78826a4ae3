import numpy as np

from docketweave.llm import linkage

MENTION = "mention_id string, entity_type string, court string, raw_name string, presentable_name string, normalized_name string, year int, fjc_nid bigint, nid string"
DIRECTORY = "nid bigint, first_name string, middle_name string, last_name string, suffix string, court_name_1 string, court_name_2 string, commission_date_1 string, termination_date_1 string"


def test_label_model_recovers_truth():
    rng = np.random.default_rng(4)
    y = rng.random(4000) < 0.4
    votes = np.stack([np.where(rng.random(4000) < a, np.where(y, 1, 3), np.where(y, 3, 1)) for a in (0.95, 0.9, 0.8, 0.8)], 1)
    votes = np.concatenate([votes, votes[:, 2:3]], 1)  # a copy, which must not count twice
    patterns, inverse, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    model = linkage.LabelModel.fit(patterns, counts.astype(float))
    assert (2, 4) in model.joined
    q = model.posterior(patterns)[inverse.ravel()]
    assert ((q > 0.5) == y).mean() > 0.94 and abs(q.mean() - 0.4) < 0.05


def test_linking(spark):
    first = ["Greta", "Samuel", "Ruth", "Oscar", "Daniel", "Mei", "Ivan", "Vera"]
    last = ["Cumposton", "Vorlitor", "Honnuwick", "Trintath", "Zempiric", "Grupelin", "Halvondo", "Mirriberg"]
    directory = [(i, f, "Naomi", n, None, "Court One" if i % 2 else "Court Two", None, "1/2/1990", None) for i, (f, n) in enumerate(zip(first, last))]
    directory += [(90, "Ruth", "Naomi", "Honnuwick", None, "Court One", None, "1990-01-02", None), (91, None, None, None, None, None, None, None, None), directory[0]]
    mentions = [(f"m{i}", "judge", "c1" if i % 2 else "c2", f"{f} N. {n}", None, None, 2010, None, "x") for i, (f, n) in enumerate(zip(first, last))]
    mentions += [("t", "judge", "c2", "Cumpsoton, Greta", None, None, 2010, None, "x"), ("u", "judge", "c1", "Someone Else", None, None, 2010, None, "x"), ("v", "judge", None, None, None, None, None, None, "x")]
    m, d = spark.createDataFrame(mentions, MENTION), spark.createDataFrame(directory, DIRECTORY)
    c = spark.createDataFrame([("Court One", "c1"), ("Court Two", "c2")], "court_name string, court_code string")
    matches, named = linkage.link_to_directory(m, d, c)
    got = {r.raw: r.nid for r in named.join(matches, "entity").collect()}
    assert all(got[f"{f} N. {n}"] == i for i, (f, n) in enumerate(zip(first, last))) and got["Cumpsoton, Greta"] == 0 and "Someone Else" not in got
    assert linkage.link_to_directory(m.limit(0), d, c)[0].count() == 0
