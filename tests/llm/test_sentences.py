import pytest

from docketweave.llm.sentences import boundaries, split_sentences


def cut(text):
    return [text[a:b] for a, b in boundaries(text)]


@pytest.mark.parametrize(
    "parts",
    [
        ["The court is not persuaded.", "It does not!", "Who signs for Grerleby Mfg. Corp.?", "Nothing turns on it."],
        ["Dr. A. H. Roe worked for Foo Savings Bank, N.A.", "By contrast, Mr. Doe did not."],
        ["Filing fee $553,963.55, receipt no. 16264-86172, was paid at 5:12 p.m. on Dec. 14, 2020.", "So ordered."],
        ["He is subject to Dkt. No. 92423.", "(Entered: 01/04/2005)"],
        ['Counsel replied, "We object. The record is closed." and sat down.', '"Is that your signature?" asked the judge.'],
        ["Herr Roe erschien um 9.30 Uhr, d. h. zu spät.", "Das Gericht hat am 12. März 2021 verhandelt.", "Laut Bl. 4 d. A.: die Klage ruht."],
        ["¿Compareció el Sr. Roe a la audiencia?", "El Dr. Roe vive en EE. UU. desde 2025."],
        ["« Je conteste. C'est faux », a répondu Me Roe.", "La requête n° 44 est rejetée !", "Le tribunal a entendu M. Roe."],
        ["Сумма иска, т. е. 59,19 млн руб., не оспаривается.", "Дело отложено!"],
        ["Εμφανίστηκε ο εναγόμενος;", "Βλ. σελ. 65 του φακέλου."],
        ["Same surname; middle initial compatible.", "Contacts differ: tel. no. ends 92."],
    ],
)
def test_spaced_scripts(parts):
    assert cut(" ".join(parts)) == parts


@pytest.mark.parametrize(
    "parts",
    [["证人说：“我没有签字。我不认识他。”随后离席。", "被告是否收到传票？", "赔偿金额为12.21万元。"], ["証人は「署名していない。知らない。」と述べた。", "損害額は90.13百万円である。", "ナキ株式会社は控訴を断念した！"]],
)
def test_scripts_without_spaces(parts):
    assert cut("".join(parts)) == parts


def test_other_scripts():
    for parts in (["आदेश सं. 43 की प्रति संलग्न है।", "क्या प्रतिवादी उपस्थित हुआ?"], ["انظر ص. 17 من الملف.", "هل حضر المدعى عليه الجلسة؟"], ['증인은 "서명하지 않았다. 모른다."라고 말했다.', "피고는 출석했습니까?"], ["ศาลนัดฟังคำพิพากษาในวันพุธ", "ค่าเสียหายเป็นเงิน 87.24 ล้านบาท"]):
        assert cut(" ".join(parts)) == parts


def test_lines():
    assert cut("Q. And then?\nA. No.\n(Whereupon, a recess was taken at 3:33 a.m.)\nA. He said, \"Sign it. Now!\" and left.") == ["Q. And then?", "A. No.", "(Whereupon, a recess was taken at 3:33 a.m.)", 'A. He said, "Sign it. Now!" and left.']
    assert cut("They lost.\n\nI. BACKGROUND\n\nThe rate rose\nfrom 41.19% to 98.64%.") == ["They lost.", "I. BACKGROUND", "The rate rose\nfrom 41.19% to 98.64%."]


def test_blank_and_cover():
    assert cut("") == cut(" \n\xa0") == cut(None) == []
    text = "  No stop here \xa0\n\n1. One. two (three. Four) !! ​…\n" * 50
    spans = boundaries(text)
    covered = set()
    for a, b in spans:
        assert text[a:b] == text[a:b].strip() and not covered & set(range(a, b))
        covered |= set(range(a, b))
    assert all(c.isspace() for i, c in enumerate(text) if i not in covered)


def test_frame_with_corpus_fallback(spark):
    rows = [(i, f"See Zq. {i} there. Case closed.", 1) for i in range(5)] + [(9, "The Zq. Roe stays.", 1), (10, None, 1), (11, "", 1), (12, "x" * 50_000, 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, start_pos int")
    out = {}
    for r in split_sentences(df, "doc_id", "text").collect():
        out.setdefault(r.doc_id, []).append((r.start_pos, r.end_pos))
    assert len(out[0]) == 2 and out[9] == [(0, 18)] and out[12] == [(0, 50_000)] and not {10, 11} & set(out)
    assert split_sentences(df.limit(0), "doc_id", "text").count() == 0


def test_capitals_are_counted_over_the_whole_text():
    from docketweave.llm.sentences import Lexicon

    capitals, plain = "MOTION TO DISMISS DENIED. " * 200, "The motion to dismiss is denied. " * 200
    assert not Lexicon(capitals + plain).shouting and Lexicon(capitals).shouting
    assert Lexicon("The motion is denied. " * 200 + capitals * 10).shouting and not Lexicon("12 . 3").shouting


def test_corpus_learns_abbreviations_that_no_document_proves(spark):
    """An invented abbreviation before a capital: open in each document, plain over the corpus. A word also used bare is none."""
    rows = [(i, f"It cited Vukov. Rev. Code § {i}. The rest is moot. He saw the quill. Nothing else moved in a quill so long.") for i in range(30)]
    rows += [(100, "It cited Vukov. Rev. Code § 3."), (101, "He filed at the Wexby. Nothing came of it.")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    text = dict(rows)
    out = {}
    for r in split_sentences(df, "doc_id", "text").orderBy("doc_id", "start_pos").collect():
        out.setdefault(r.doc_id, []).append(text[r.doc_id][r.start_pos : r.end_pos])
    assert out[100] == ["It cited Vukov. Rev. Code § 3."]
    assert out[3][:2] == ["It cited Vukov. Rev. Code § 3.", "The rest is moot."] and len(out[3]) == 4
    assert out[101] == ["He filed at the Wexby.", "Nothing came of it."]


def test_no_bound_on_words_headings_or_distance():
    word = "Quintessentialabbrev" * 4
    assert len(cut(f"See {word}. 4 and {word}. 5, then stop. It ends.")) == 2
    heading = "VERY LONG HEADING " * 12
    assert cut(f"They lost.\n\n{heading.strip()}\n\nThe rate rose again.") == ["They lost.", heading.strip(), "The rate rose again."]
