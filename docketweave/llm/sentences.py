"""Sentence boundaries across scripts, by document-centred disambiguation.

A stop is ambiguous only after an abbreviation, an initial or a number. What a word is, the document
itself says first: a word seen without a stop elsewhere in it is no abbreviation, one whose stop is followed
by a small letter, a digit or a comma is one; a capitalised word also seen in small letters
is no proper name, so it may open a sentence. What a document leaves open the corpus decides: a word that
has its stop far more often than words have one, for its length, is an abbreviation (the log-likelihood collocation test of Kiss and
Strunk), one mostly without is none. Only where that is silent too, a short list of usual abbreviations counts. Scripts
bring their own terminators: full-width stops, danda, the Arabic and Greek question marks, and spaces between Thai letters.

Each text is read once: a pass over the batches cuts at every stop that is not surely inside a sentence, notes the word before each
cut that hangs on the corpus, and counts the words. Counts are summed and joined to the noted words; then cuts are
taken back by offsets alone.

Defined results: null, empty and blank texts have no sentences; offsets are code points; a text without
any terminator is one sentence per paragraph; every character but outer white space is in exactly one
sentence; texts and words of any length are read whole. Only the two columns named are read.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketweave.session import Scratch, read

# Usual abbreviations that are followed by what they introduce, so their stop ends nothing.
LEADING = set(
    """mr mrs ms dr prof hon st no nos rev gen maj col capt lt sgt messrs mme mlle me mm hr fr herr vs v cf viz pp para paras
    art arts sec secs ex exh reg rep ch cl vol vols approx fed civ crim app tel fig figs eq dkt evid ctrm mfg dept ins univ assn natl intl bldg
    e.g i.e z.b d.h d.a u.a vgl bl abs nr bspw ca bzw usw.f núm pág págs exp sr.a sra sres dra d.ª p.ej pej
    al.n ст п т.е т.к т.д г-н см стр ул д р.с βλ σελ κ αρ άρθρ ص د सं डॉ श्री पृ p s n.b""".split()
)
# Usual abbreviations that may also stand at the end of a sentence.
TRAILING = set(
    """inc corp co ltd llc llp jr sr bros etc al esq p.c n.a p.a l.p u.s u.s.a ph.d j.d ll.m m.d b.a m.a a.m p.m
    jan feb mar apr jun jul aug sep sept oct nov dec cía uu ee.uu г руб млн тыс др usw ff""".split()
)
TIMES = {"a.m", "p.m"}
# English function words, which open sentences and follow no name as part of it.
STARTERS = set(
    """the a an this that these those it they he she we you i in on at by for from under upon after before when while if as
    there here why who what where how which is are was were does did do so per but no""".split()
)
SPEAKER = regex.compile(r"(?:[QA]\.|[qa]\.)(?=\s)|(?:THE|tHE|The) [A-Z]{3,}:|(?:MR|MS|MRS|mR|mS|mRS)\. \p{L}+:")
ITEM = regex.compile(r"(?:\(?\p{N}{1,3}[.)]|\(\p{L}{1,4}\)|[IVXLC]{1,6}\.|\p{L}\.)(?=\s)")
STOPS = ".!?…‽" + "。！？｡．" + "।॥" + "؟۔" + ";;"
CJK = "。！？｡．"
OPENERS = {"(": ")", "[": "]", "{": "}", "«": "»", "„": "“", "‹": "›", "「": "」", "『": "』", "（": "）", "【": "】", "《": "》", "〈": "〉", "“": "”"}
CLOSERS = set(OPENERS.values()) | {'"', "’", "'", "”", "“"}
CANDIDATE = regex.compile(r"[.!?…‽。！？｡．।॥؟۔;;]+|\n|\p{Thai}[  ​]+(?=\p{Thai})")
NEWLINES = str.maketrans({c: "\n" for c in "\r  \x85\x0b\x0c"})
WORD = regex.compile(r"[\p{L}\p{M}][\p{L}\p{M}'’ªº-]*(?:\.[\p{L}\p{M}]+)*")
# Letters with the marks that scripts of South and South-East Asia, Hebrew and Arabic set on them.
_L = r"[^\W\d_]|[\u0300-\u036f\u0591-\u05c7\u0610-\u061a\u064b-\u065f\u0670\u0900-\u0903\u093a-\u094f\u0951-\u0957\u0962\u0963\u0980-\u0dff\u0e31\u0e34-\u0e3a\u0e47-\u0e4e]"
TOKENS = re.compile(rf"((?:{_L})(?:{_L}|['’ªº-])*(?:\.(?:{_L})+)*)(\.[,;:)]|\.[ \n]{{1,2}}(?=[a-zß-öø-ÿα-ώа-я0-9])|\.?)")
MONTHS_DE = {"januar", "februar", "märz", "april", "mai", "juni", "juli", "august", "september", "oktober", "november", "dezember"}


SMALL_START = re.compile(r"[!?][\"'”’)]* +[a-zß-öø-ÿ]")
# Function words that go on after a name or an abbreviation, also in texts whose sentences start small.
GOING_ON = {"and", "of", "in", "on", "for", "at", "by", "is", "was", "to", "or", "vs", "v"}


class Lexicon:
    """What one document says about its own words. known holds what the corpus says of a word: True if it is an abbreviation."""

    def __init__(self, text: str, known: dict[str, bool] | None = None):
        self.known = known or {}
        self.tokens = TOKENS.findall(text)
        self.small = {w.lower() for w in {w for w, _ in self.tokens} if w[0].islower()}
        self.bare = Counter([w.lower() for w, stop in self.tokens if not stop])
        self.stopped = Counter([w.lower() for w, stop in self.tokens if stop])
        self.abbreviated = Counter([w.lower() for w, stop in self.tokens if len(stop) > 1])
        upper = sum(map(str.isupper, text))
        self.small_starts = SMALL_START.search(text) is not None
        self.shouting = upper > 0 and upper > 0.85 * (upper + sum(map(str.islower, text)))

    def opens(self, word: str) -> bool:
        """Whether a capitalised word may open a sentence: it is no name, as it is also written small."""
        low = word.lower()
        return low in STARTERS or (low in self.small and not self.shouting)

    def is_abbreviation(self, low: str) -> bool | None:
        """None where the document does not decide."""
        if self.bare[low]:
            return False if low not in LEADING and low not in TRAILING else None
        return True if self.abbreviated[low] > 1 and low not in self.small else None


def token_before(text: str, start: int, stop: int) -> str:
    """The token that ends at stop, not beyond start; of any length."""
    i = stop
    while i > start and ((c := text[i - 1]).isalnum() or c in "ªº'’.-" or unicodedata.category(c)[0] == "M"):
        i -= 1
    while i < stop and text[i] in ".-'’":
        i += 1
    return text[i:stop]


PAIRS = re.compile(r'[()\[\]{}«»„“”‹›「」『』（）【】《》〈〉"]|\n[^\S\n]*\n')
BREAKS = re.compile("[" + re.escape("".join(map(chr, NEWLINES))) + "]")
THAI, GREEK, LATIN = regex.compile(r"\p{Thai}"), regex.compile(r"\p{Greek}"), regex.compile(r"\p{Latin}")
UNSPACED = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Hangul}]")


def single_breaks(text: str) -> str:
    """The text with every kind of line break as one line feed, at the same offsets."""
    return text.replace("\r\n", " \n").translate(NEWLINES) if BREAKS.search(text) else text


def _paired(text: str) -> tuple[bytes | list[int], bytearray]:
    """Depth of matched brackets and quotations at each character, and where such a pair ends."""
    stack: list[tuple[str, int, str]] = []
    spans: list[tuple[int, int]] = []
    straight = -1
    for m in PAIRS.finditer(text):
        c, i = m.group(), m.start()
        if c[0] == "\n":
            stack, straight = [], -1  # a pair does not reach over a blank line
        elif c == '"':
            opening = i == 0 or text[i - 1].isspace() or text[i - 1] in "([«—–-:：:"
            if straight < 0:
                if opening or (i + 1 < len(text) and text[i + 1].isalnum()):
                    straight = i
            else:
                spans.append((straight, i))
                straight = -1
        elif stack and stack[-1][0] == c:
            spans.append((stack.pop()[1], i))
        elif c in OPENERS and not (c == "“" and any(s[0] == "“" for s in stack)):
            stack.append((OPENERS[c], i, c))
        else:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == c:
                    spans.append((stack[k][1], i))
                    del stack[k:]
                    break
    ends = bytearray(len(text) + 4)
    if not spans:
        return bytes(len(text) + 1), ends
    steps = [0] * (len(text) + 2)
    for lo, hi in spans:
        steps[lo + 1] += 1
        steps[hi + 1] -= 1
        ends[hi] = 1
    return list(accumulate(steps)), ends


def _heading(line: str) -> bool:
    return line.isupper() and line[-1:] not in ".!?,;" and sum(map(str.isalpha, line)) > 2


def _remark(line: str) -> bool:
    return line[:1] in "([" and line[-1:] in ")]"


def boundaries(text: str | None, known: dict[str, bool] | None = None, ask: dict[int, tuple[str, str]] | None = None, lexicon: Lexicon | None = None) -> list[tuple[int, int]]:
    """(start, end) of each sentence.

    With ``ask``, cuts that hang on the corpus are made and noted there: place of the cut -> the words before and after its stop. The
    first is empty where the cut stands only if the second often opens sentences.
    """
    if not text or text.isspace():
        return []
    raw = text
    text = single_breaks(text)
    n = len(text)
    lexicon = lexicon or Lexicon(text, known)
    depth, closes = _paired(text)
    lines = [s.strip() for s in text.split("\n") if s.strip()]
    ended = sum(s[-1] in STOPS or s[-1] in CLOSERS for s in lines)
    by_line = len(lines) > 1 and ended >= 0.6 * len(lines)
    cuts: list[int] = []
    start = 0

    def skip(i: int) -> int:
        while i < n and text[i].isspace():
            i += 1
        return i

    def cut(i: int) -> None:
        nonlocal start
        cuts.append(i)
        start = skip(i)

    start = skip(0)
    for m in CANDIDATE.finditer(text):
        i, j, c = m.start(), m.end(), m.group()
        if i < start and c[0] != "\n":
            continue
        if c[0] == "\n":
            if i < start:
                continue
            k = skip(i)
            if k >= n:
                continue
            gap = text[i:k]
            line = text[start:i].strip()
            rest = text[k : text.find("\n", k) if text.find("\n", k) >= 0 else n].strip()
            blank = gap.count("\n") > 1
            last = line[-1:]
            if not line or depth[i] > 0 and not blank:
                continue
            speaker = SPEAKER.match(text, k) is not None
            if _heading(line) and not lexicon.shouting:
                joined = False
            elif lexicon.shouting and _heading(line) and blank and last not in STOPS:
                joined = False
            elif ITEM.fullmatch(line + " ", 0, len(line)):
                joined = True
            elif blank:
                joined = last not in STOPS and last not in CLOSERS and rest[:1].islower() and (last == "," or last.islower() and not by_line)
            elif speaker or _remark(rest) and (last in STOPS or by_line) or (_heading(rest) and not lexicon.shouting):
                joined = False
            elif last in ".\u2026":
                joined = not _final(text, start, i, k, lexicon, ask, by_line, i)
            elif last in STOPS or (last in CLOSERS and len(line) > 1 and line[-2] in STOPS):
                joined = False
            elif by_line:
                joined = rest[:1].islower() or last in ",-–—"
            else:
                joined = not (ITEM.match(text, k) and text[k].isdigit() and last in ":;")
            if not joined:
                cut(i)
            continue
        if THAI.match(c):
            if depth[i] == 0:
                cut(i + 1)
            continue
        if depth[i] > 0 and not any(closes[j : j + 3]):
            continue
        end, inside = j, depth[i] > 0
        while end < n and (closes[end] or text[end] in "’'") and text[end] not in OPENERS:
            end += 1
        if inside and depth[min(end, n)] > 0:
            continue
        if c[0] in "\u037e;" and not (i and GREEK.match(text[i - 1])):
            continue
        if end >= n:
            continue
        k = skip(end)
        if k >= n:
            continue
        spaced = k > end
        ahead = text[k]
        line_break = "\n" in text[end:k]
        if inside or end > j:
            # A stop inside the quotation that ends here closes the outer sentence only before a new start.
            quoted = inside
            if quoted and not line_break:
                if c[0] in CJK or not spaced or not (ahead.isupper() or ahead in "\"“«([" or ahead.isdigit()):
                    continue
        if c[0] in CJK or c[0] in "।॥؟۔" or c[0] in "\u037e;":
            if not line_break or c[0] in CJK:
                cut(end)
            continue
        if line_break:
            continue  # decided at the line break
        if any(x in c for x in "!?\u203d"):
            if spaced or (ahead.isupper() and i and not text[i - 1].isspace()):
                if ahead in ",;:)" or (inside and ahead.islower()):
                    continue
                cut(end)
            elif not spaced and UNSPACED.match(ahead):
                cut(end)
            continue
        if not spaced:
            word = token_before(text, start, i)
            nxt = text[k + 1] if k + 1 < n else " "
            glued = ahead.isupper() and (nxt.islower() or nxt in " '") and (end > j or (len(word) > 2 and (word.islower() or word[1:].islower() or word.isdigit()) and "." not in word))
            chunk = text[text.rfind(" ", 0, i) + 1 : i]
            if glued and "//" not in chunk and "@" not in chunk and not lexicon.is_abbreviation(word.lower()) and word.lower() not in LEADING and word.lower() not in TRAILING and not (word[:1].isupper() and not word.isdigit() and end == j and len(word) < 4):
                cut(end)
            continue
        if ahead in ",;:)]":
            continue
        if len(c) > 1 or c == "\u2026":  # an ellipsis goes on unless a new sentence plainly starts
            follower = WORD.match(text, k)
            if follower and ahead.isupper() and follower.group().lower() not in ("i", "i'm", "i'd", "i've", "i’m") and (follower.group().lower() in STARTERS or follower.group().lower() in lexicon.small):
                cut(end)
            continue
        if _final(text, start, i, k, lexicon, ask, by_line, end):
            cut(end)
    out: list[tuple[int, int]] = []
    lo = 0
    for hi in [*cuts, n]:
        a, b = lo, hi
        while a < b and text[a].isspace():
            a += 1
        while b > a and text[b - 1].isspace():
            b -= 1
        if b > a:
            out.append((a, b))
        lo = hi
    assert len(text) == len(raw)
    return out


def _final(text: str, start: int, i: int, k: int, lexicon: Lexicon, ask: dict[int, tuple[str, str]] | None, by_line: bool, at: int) -> bool:
    """Whether the stop that ends before k, with i at or after it, ends a sentence; a cut there would be at ``at``."""
    stop = text.rfind(".", start, i + 1)
    if stop < 0 or text[stop + 1 : i].strip("  \"'”’»)]}“"):
        return True
    line_break = "\n" in text[stop:k]
    closed = stop + 1 < len(text) and not text[stop + 1].isspace()
    word = token_before(text, start, stop)
    low = word.lower()
    ahead = text[k]
    follower = WORD.match(text, k)
    nxt = follower.group() if follower else ""
    nlow = nxt.lower()
    if ITEM.fullmatch(text, start, stop + 1) or (ITEM.match(text, start) and stop < start + 5 and ITEM.match(text, start).end() == stop + 1):
        return False  # an item number or speaker mark belongs to what it introduces
    if SPEAKER.match(text, k) and line_break:
        return True
    if closed or not word:
        return True
    if word.isdigit() and len(word) <= 2 and nlow in MONTHS_DE:
        return False
    if word[0].isdigit():
        return True
    single = len(word) == 1 or (len(word) == 2 and word[0] == word[1] and word.isupper())
    if len(nxt) == 1 and text[k + 1 : k + 2] == ".":
        opens = False
    else:
        opens = ahead.isupper() and lexicon.opens(nxt) or nlow in STARTERS
    if low in ("no", "nos") and not (ahead.isdigit() or ahead in "#§" or ahead.islower()):
        return line_break or ITEM.match(text, start) is not None or opens
    if single and not word.isdigit():
        if word.islower() and LATIN.match(word):
            return ahead.isupper() and opens and low not in LEADING
        if not ahead.isupper():
            return line_break and by_line and not ahead.islower() and not ahead.isdigit()
        label = token_before(text, start, max(start, text.rfind(word, start, stop) - 1)).lower() in ("exhibit", "exhibits", "part", "appendix", "class", "section", "count", "schedule", "vitamin", "and")
        return (label and not line_break) or (opens and len(nxt) > 1)
    verdict = lexicon.known.get(low)
    if verdict is None:
        verdict = lexicon.is_abbreviation(low)
    listed = low in LEADING or low in TRAILING or "." in low
    if verdict is None and not listed and ask is not None and ahead.isalnum() and not (opens and ahead.isupper()):
        ask[at] = (low, nlow)  # cut, unless the corpus knows better
        return True
    if verdict is False and not listed:
        return True
    if low in LEADING:
        return False
    if low in ("sr", "jr"):  # a title if no name stands before it
        at_word = text.rfind(word, start, stop)
        named = token_before(text, start, max(start, at_word - 1)) or token_before(text, start, max(start, at_word - 2))
        if not named or named[0].islower():
            return False
    if low in TIMES:
        return ahead.isupper() or ahead in "\"“«([" or (line_break and by_line and not ahead.islower())
    if low in TRAILING or "." in low:
        if ahead.isdigit() or ahead in "§&":
            return line_break and by_line
        if ahead.islower():
            if lexicon.small_starts and low in TRAILING and nlow not in GOING_ON and ask is not None:
                ask[at] = ("", nlow)
                return True
            return False
        if lexicon.shouting:
            if nlow not in STARTERS and len(nlow) > 1 and low in TRAILING and ask is not None:
                ask[at] = ("", nlow)  # cut, if the corpus knows that the next word opens sentences
                return True
            return nlow in STARTERS
        if "." in low and low not in TRAILING or low in ("u.s", "u.s.a", "ee.uu"):
            return opens
        return True
    return not verdict or (opens and ahead.isupper())


def collocation(stopped: Column, bare: Column, all_stopped: Column, everything: Column, length: Column) -> Column:
    """Log-likelihood that a word keeps its stop, less for longer words and for those also seen without; about 0.3 and more is an abbreviation."""
    n = (stopped + bare).cast("double")
    p = all_stopped / everything
    q = F.lit(0.99)
    null = stopped * F.log(p) + bare * F.log(1 - p)
    kept = stopped * F.log(q) + bare * F.log(1 - q)
    penalty = F.exp(-length.cast("double")) * F.pow(length.cast("double"), -bare.cast("double"))
    return F.when(n > 0, -2 * (null - kept) * penalty).otherwise(0.0)


LEAST, SHARE = 0.3, 0.25
PASS = "key {kind}, lo array<int>, hi array<int>, at array<int>, word array<string>, next array<string>, seen array<string>, stopped array<bigint>, bare array<bigint>"


def split_sentences(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, start_pos, end_pos) of every sentence of every row of df; keys are unique."""
    kind = df.schema[key].dataType.simpleString()
    scratch = Scratch(df.sparkSession, "sentences")
    docs = df.select(F.col(key).alias("key"), F.col(text).alias("text")).filter(F.trim("text") != "")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            stopped: Counter[str] = Counter()
            bare: Counter[str] = Counter()
            first: Counter[str] = Counter()
            for k, t in zip(batch["key"].tolist(), batch["text"].tolist()):
                ask: dict[int, tuple[str, str]] = {}
                t = single_breaks(t)
                lexicon = Lexicon(t)
                stopped.update(lexicon.stopped)
                bare.update(lexicon.bare)
                found = boundaries(t, ask=ask, lexicon=lexicon)
                for i, (a, _) in enumerate(found):
                    if (not i or not any(found[i - 1][1] <= x <= a for x in ask)) and (m := WORD.match(t, a)):
                        first[m.group().lower()] += 1
                if found:
                    rows.append((k, [a for a, _ in found], [b for _, b in found], list(ask), [w for w, _ in ask.values()], [w for _, w in ask.values()], None, None, None))
            words = list(stopped)
            # Words never seen with a stop need no row: they are no abbreviations. Their number is kept under "".
            # "^" counts how often a word opens a sentence, and how often it is there at all.
            seen = [*words, "", *["^" + w for w in first]]
            with_stop = [*[stopped[w] for w in words], 0, *first.values()]
            without = [*[bare[w] for w in words], sum(bare.values()) - sum(bare[w] for w in words), *[bare[w] + stopped[w] for w in first]]
            rows.append((None, None, None, None, None, None, seen, with_stop, without))
            yield pd.DataFrame(rows, columns=["key", "lo", "hi", "at", "word", "next", "seen", "stopped", "bare"])

    done = scratch.table(docs.mapInPandas(run, PASS.format(kind=kind)))
    counted = done.filter("seen is not null").select(F.explode(F.arrays_zip("seen", "stopped", "bare")).alias("c")).groupBy("c.seen").agg(F.sum("c.stopped").alias("stopped"), F.sum("c.bare").alias("bare"))
    counted = scratch.table(counted)
    opening = counted.filter(F.col("seen").startswith("^") & (F.col("stopped") >= 5) & (F.col("stopped") * 10 >= F.col("bare"))).select(F.substring("seen", 2, 1 << 20).alias("next"), F.lit(1).alias("opens"))
    counted = counted.filter(~F.col("seen").startswith("^"))
    whole = counted.agg(F.sum("stopped").alias("all_stopped"), F.sum(F.col("stopped") + F.col("bare")).alias("everything"))  # one row
    asked = done.filter("size(at) > 0").select("key", F.explode(F.arrays_zip("at", "word", "next")).alias("q")).select("key", "q.at", "q.word", "q.next")
    asked = scratch.table(asked.join(opening, "next", "left").select("key", "at", "word", F.coalesce("opens", F.lit(0)).alias("opens")))
    # What follows an abbreviation seldom opens sentences elsewhere; what follows a word that just ends them does.
    before = asked.filter("word <> ''").groupBy("word").agg(F.avg("opens").alias("share"))
    scored = counted.filter("seen <> '' and stopped > 0").withColumnRenamed("seen", "word").join(before, "word").join(F.broadcast(whole))
    known = scored.filter((F.col("share") <= SHARE) & (collocation(F.col("stopped"), F.col("bare"), F.col("all_stopped"), F.col("everything"), F.length("word")) >= LEAST)).select("word")
    undone = asked.join(known, "word", "left_semi").select("key", "at").union(asked.filter("word = '' and opens = 0").select("key", "at"))
    back = undone.groupBy("key").agg(F.collect_set("at").alias("back"))
    cut = done.filter("key is not null").select("key", "lo", "hi", "at").join(back, "key", "left")
    # A cut taken back joins the sentences before and after it: the one ends, the other starts no more.
    last = F.size("lo") - 1
    ends = F.transform("lo", lambda start, i: (i == last) | ~F.exists("back", lambda x: (x >= F.col("hi")[i]) & (x <= F.col("lo")[i + 1])))
    joined = cut.withColumn("ends", F.when(F.col("back").isNull(), F.transform("lo", lambda x: F.lit(True))).otherwise(ends))
    spans = F.arrays_zip(
        F.filter("lo", lambda x, i: (i == 0) | F.col("ends")[F.greatest(i - 1, F.lit(0))]).alias("start_pos"),
        F.filter("hi", lambda x, i: F.col("ends")[i]).alias("end_pos"),
    )
    return joined.select(F.col("key").alias(key), F.inline(spans))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_sentences(read(spark, sf_dir, "documents"), "doc_id", "text")


QUERIES = {"p10_found": p10_found}
