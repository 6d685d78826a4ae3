import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docketweave.llm.tokens import ByteBPE, encode_corpus, vocabulary_path

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def both():
    t = tokenizers.Tokenizer.from_file(vocabulary_path())
    t.encode_special_tokens = True
    return ByteBPE(vocabulary_path()), t


def check(both, texts):
    ours, theirs = both
    offsets, ids = ours.encode(texts)
    got = [ids[offsets[i] : offsets[i + 1]].tolist() for i in range(len(texts))]
    assert got == [e.ids for e in theirs.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_odd_texts(both):
    check(both, [None, "", " ", "aaaaaaaaaaaaaaaaa", "<|endoftext|> it's  \n\n x", "क्षति é 中文 😀​\x1c\x85", "no\xa0break " * 400, "x" * 30_000])


@settings(max_examples=120, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=40), max_size=4))
def test_any_text(both, texts):
    check(both, texts)


def test_bounded_cache_changes_nothing(both, monkeypatch):
    monkeypatch.setattr("docketweave.llm.tokens.CACHE_WORDS", 3)
    check(both, ["alpha beta gamma delta", "epsilon alpha zeta"])
    check(both, ["theta alpha iota", "beta"])


def test_frame(spark):
    df = spark.createDataFrame([(1, "a b", "k"), (2, None, "k"), (3, "", "k"), (1, "a b", "k")], "doc_id bigint, text string, ids string")
    out = sorted((r.doc_id, r.ids) for r in encode_corpus(df, "doc_id", "text").collect())
    assert out == [(1, [64, 275]), (1, [64, 275]), (2, []), (3, [])]
    assert encode_corpus(df.limit(0), "doc_id", "text").count() == 0
