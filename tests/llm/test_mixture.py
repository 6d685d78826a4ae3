import numpy as np
import pandas as pd
import pytest

from docketweave.llm import mixture

DOC = "doc_id bigint, text string, lang string, source string, n_tokens int"


def test_rake_meets_shares_and_caps():
    rng = np.random.default_rng(3)
    cells = pd.DataFrame([(s, x, t, int(rng.integers(50, 900))) for s in "abc" for x in ("en", "de") for t in range(3)], columns=["source", "lang", "topic", "tokens"])
    shares, repeats = {"a": 0.5, "b": 0.3, "c": 0.1, "none": 0.1}, {"a": 1, "b": 2, "c": 4, "none": 2}
    w = mixture.rake(cells, shares, repeats)
    got = (cells["tokens"] * w).groupby(cells["source"]).sum()
    assert np.allclose((got / got.sum()).to_numpy(), [5 / 9, 3 / 9, 1 / 9], atol=1e-6)
    assert all(w[i] <= repeats[s] + 1e-9 for i, s in enumerate(cells["source"]))


def test_mix(spark):
    docs = [(i, "word " * (5 + i % 40), "en" if i % 3 else None, "ab"[i % 2], 1) for i in range(600)] + [(900, None, "en", "a", 1), (901, " ", "en", "a", 1), (902, "x y", "en", None, 1), (903, "x y", "en", "unlisted", 1)]
    targets = spark.createDataFrame([("a", 0.6, 2), ("b", 0.2, 1), ("absent", 0.2, 3)], "source string, target_share double, max_repeats int")
    df = spark.createDataFrame(docs, DOC)
    drawn, report = mixture.mix(df, targets)
    shares = {r.source: (r.actual_share, r.most_repeats) for r in report.collect()}
    assert shares["a"][0] == pytest.approx(0.75, abs=0.02) and shares["b"][0] == pytest.approx(0.25, abs=0.02) and shares["absent"] == (0.0, 0)
    assert shares["a"][1] <= 2 and shares["b"][1] <= 1
    assert not {900, 901, 902, 903} & {r.doc_id for r in drawn.collect()}
    assert mixture.mix(df.limit(0), targets)[0].count() == 0


def test_topics_are_fitted_on_all_documents(spark):
    """Each of 5,000 documents counts: the centroids weighted by their documents sum to the sum of all."""
    rng = np.random.default_rng(6)
    texts = [" ".join(rng.choice(list("abcdefgh"), 6)) for _ in range(5000)]
    v = mixture.word_counts(texts)
    df = spark.createDataFrame([(i, bytearray(x.tobytes())) for i, x in enumerate(v)], "key bigint, v binary")
    centroids = mixture.fit_topics(df)
    near = (v @ centroids.T - 0.5 * (centroids**2).sum(1)).argmax(1)
    want = np.stack([v[near == c].mean(0) for c in range(len(centroids))])
    assert len(centroids) == mixture.TOPICS and np.abs(centroids - want).max() < 0.02
    assert (centroids == mixture.fit_topics(df.repartition(7))).all()
