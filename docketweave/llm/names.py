"""Variant spellings of names: parts of a name, and links between the names of one entity.

Mentions reduce to their different names. What a word is - given name, surname, word of organisations - is learnt from all
names at once: layouts that leave no doubt ("Last, First M.", "F. M. Last", "First M. Last", a legal form, "of") are counted
per word, a rare word one slip from a frequent given name is its misspelling, and these counts are joined back
to the names that have the word (learn, resolve). A dictionary of usual short forms and one of business abbreviations are
parameters. A name is then a stem (a person's surname, an organisation's core words), given names, a suffix and a legal form.

Stems are compared by a set-similarity join on the q-grams of their units with the rarest q-grams as prefix; two stems
meet only where they have a similar unit and the same words beside it, so no list of a common word is paired with itself.
A pair is verified by soft token similarity weighted by rarity: each part weighs its inverse document frequency, a pair of
words that are both established is no misspelling, an initial or short form counts as a partial match, and
two full parts that differ veto the pair. A name that leaves a part out may take it from its neighbours only if they
agree on it, in its own court first. Links join into entities.

Judges and firms belong to one court; parties may appear in several. Defined results: rows without any
name, and names with no letters, link to nothing; equal names of one court (for parties: of any) are one entity unless
their legal forms or suffixes differ; repeated rows count once; extra columns are ignored.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketweave.llm.addresses import within
from docketweave.llm.groups import components
from docketweave.operators.skew import CHUNK, group_pairs, split_sides
from docketweave.session import Scratch, read

# Usual English short forms of given names, as any public list of nicknames has them; the default of a parameter.
NICKNAMES = """abraham:abe albert:al,bert alexander:alex,sandy,al alfred:alf,fred amanda:mandy andrew:andy,drew anthony:tony arthur:art,artie
barbara:barb,babs benjamin:ben,benny catherine:cathy,cate charles:charlie,chuck,chas christine:chris,tina christopher:chris,kit,topher cynthia:cindy daniel:dan,danny
david:dave deborah:deb,debbie,debby donald:don,donnie dorothy:dot,dottie,dolly douglas:doug edward:ed,eddie,ted,ned,teddy eleanor:ellie,nell elizabeth:liz,beth,betsy,betty,lizzie,eliza,libby
eugene:gene florence:flo francis:frank,fran frederick:fred,freddie,rick,fritz gabriel:gabe gerald:gerry,jerry gregory:greg harold:hal,harry henry:hank,harry isabella:bella
jose:pepe jacob:jake jacqueline:jackie james:jim,jimmy,jamie jeffrey:jeff jennifer:jen,jenny jessica:jess john:jack,johnny jonathan:jon joseph:joe,joey joshua:josh judith:judy
katherine:kate,kathy,katie,kit,kay kenneth:ken,kenny lawrence:larry leonard:len,lenny,leo louis:lou margaret:maggie,meg,peggy,marge martin:marty mary:molly,polly matilda:tilda,mattie,tilly matthew:matt
michael:mike,mickey,mick nancy:nan nathaniel:nate,nat,nathan nicholas:nick pamela:pam patricia:pat,patty,tricia,trish peter:pete philip:phil raymond:ray rebecca:becky,becca
richard:dick,rich,richie,rick robert:bob,rob,bobby,bert ronald:ron,ronnie samuel:sam,sammy sarah:sally stephen:steve,stevie susan:sue,susie,suzy theodore:ted,theo,teddy
theresa:terry,tess thomas:tom,tommy timothy:tim victoria:vicky,vicki,tori vincent:vince,vinny virginia:ginny walter:walt william:bill,will,billy,liam,willie zachary:zach"""
# Families of legal forms; longer spellings first.
LEGAL_FORMS = [
    ("llc", "limited liability company|l ?l ?c"),
    ("llp", "limited liability partnership|l ?l ?p"),
    ("pllc", "professional limited liability company|p ?l ?l ?c"),
    ("pc", "professional corporation|p ?c"),
    ("pa", "professional association|p ?a"),
    ("lp", "limited partnership|l ?p"),
    ("na", "national association|n ?a"),
    ("inc", "incorporated|inc"),
    ("corp", "corporation|corp"),
    ("ltd", "limited|ltd"),
    ("co", "company|co"),
]
# Usual abbreviations of business words, as postal addressing standards list them; the default of a parameter.
BUSINESS_SHORT = """acad:academy admin:administration agcy:agency assn:association assoc:associates assocs:associates auth:authority bd:board bldrs:builders bros:brothers chem:chemical
cnty:county comm:communications comms:communications commn:commission constr:construction cons:consultants coop:cooperative ctr:center dept:department dist:distributors div:division edn:education elec:electric eng:engineering engrs:engineers
ent:enterprises equip:equipment exch:exchange fdn:foundation fed:federal fin:financial fl:floor gen:general govt:government grp:group gtr:greater hosp:hospital hwy:highway
ind:industries indus:industries inst:institute ins:insurance intl:international int'l:international int’l:international inv:investment labs:laboratories lib:library mach:machinery maint:maintenance med:medical mfg:manufacturing mgmt:management mkt:market mktg:marketing
mtg:mortgage mut:mutual natl:national nat'l:national off:office offs:offices pharm:pharmaceuticals prod:products prods:products props:properties publ:publishing rlty:realty rest:restaurant rr:railroad sav:savings sch:school sec:securities svc:service svcs:services
sys:systems tech:technologies tel:telephone transp:transport univ:university util:utilities whse:warehouse"""
SUFFIXES = {"jr": "jr", "junior": "jr", "sr": "sr", "senior": "sr", "ii": "ii", "iii": "iii", "iv": "iv", "2nd": "ii", "3rd": "iii"}
CONNECTORS = {"and", "the", "of", "for", "a", "an", "et"}


def short_forms(table: str) -> dict[str, str]:
    """Word to its full form, from "full:short,short" entries (names) or "short:full" (one each); two full forms are joined by a slash."""
    out: dict[str, str] = {}
    for entry in table.split():
        name, _, shorts = entry.partition(":")
        out[name] = name
        for short in filter(None, shorts.split(",")):
            out[short] = f"{out[short]}/{name}" if short in out and out[short] != short else name
    return out


CANON = short_forms(NICKNAMES)
EXPAND = dict(entry.split(":") for entry in BUSINESS_SHORT.split())

_ALIAS = regex.compile(r"\W*\b(?:f/?\s?k/?\s?a|a/?\s?k/?\s?a|d/?\s?b/?\s?a|t/a|[fatd]\.\s?[kb]?\.?\s?a\.|formerly known as|also known as|known as|doing business as|trading as)(?![\p{L}]).*$", regex.I | regex.S)
_PAREN = regex.compile(r"\([^)]*\)?|\[[^\]]*\]?")
_QUOTED = regex.compile(r"[\"“”][^\"“”]*[\"“”]|(?<=\s)'\p{L}+'(?=\s)")
_TAIL = regex.compile(
    r"[\s,;*–-]*(?:\battn\b.*|\bits successors and assigns|\ban? (?:\p{L}+ )?(?:corporation|company|partnership|association)|\bet\.? al\b\.?|\bpro\.? se\b|\bdeceased|\bindividually(?: and.*)?|\bin (?:his|her|their|its) (?:official )?(?:individual )?capacity.*"
    r"|\band (?:spouse|wife|husband)|\bon \d+/\d+\S*|\bpursuant to|\bpresiding|\breferred|\bterminated|\bas trustee.*|\btrustee|\bsigned|\bmotions?(?: terminated)?|\bcourtroom \S+|\bctrm\.? \S+|\bon behalf of .*|-\s*mag\b|\busm?d?j\b|#\s*\d+|\bno\.? \d+|[*,;–-]+)\s*$",
    regex.I | regex.S,
)
_HONORIFIC = regex.compile(r"^\W*(?:(?:the )?(?:hon(?:orable)?|chief|magistrate|district|senior|presiding|judge|justice|mr|mrs|ms|miss|dr|prof|sir|madam|us|u\.s)\b\.?(?:,\s)?\s*)+", regex.I)
_LAST_FIRST = regex.compile(r"^([^,]+),\s*([^,]+?)(?:,\s*(\w+))?$")
_CAMEL = regex.compile(r"(?<=\p{Ll})(?=\p{Lu})")
_WORD = regex.compile(r"[\p{L}\p{M}\d]+(?:['’][\p{L}\p{M}\d]+)*")
_FORMS = [(name, regex.compile(r"(?:^|[\s,])(?:" + pattern + r")$")) for name, pattern in LEGAL_FORMS]
_FORM_ENDS = tuple(word for _, pattern in LEGAL_FORMS for word in pattern.replace(" ?", "").split("|"))
_FORM_ENDS_GLUED = tuple(w.replace(" ", "") for w in _FORM_ENDS)
# Any of these must stand in a name for its slower pattern to match.
_ALIAS_SIGNS = ("k/", "b/", "k a", "b a", "/a", ".a", "a.", "fka", "aka", "dba", "fdba", "known", "trading", "doing")
_TAIL_SIGNS = ("attn", "assigns", ", a", " a ", " an ", " al", " pro", "deceas", "individ", "capacity", " and ", " on ", "pursuant", "presiding", "referred", "terminat", "trustee", "#", " no", "signed", "courtroom", "ctrm", "behalf", "mag", "motion", "usdj", "usmj", "usj")
_DIGITS = str.maketrans("015", "ols")
_MARKED = regex.compile(r"(?<=[a-z])\p{Mn}+")


def fold(low: str) -> str:
    """Latin letters without their accents, which are often left out."""
    return low if low.isascii() else unicodedata.normalize("NFC", _MARKED.sub("", unicodedata.normalize("NFD", low)))


LAYOUT = "entity_type string, raw string, kind string, words array<string>, turned int, torn int, suffix string, form string"


def read_layout(raw: str | None, entity_type: str | None, expand: Mapping[str, str] = EXPAND) -> tuple[str, list[str], int, int, str, str] | None:
    """(kind, words, turned, torn, suffix, form) of one name by its own signs alone; None for names without letters.

    kind is O, P, or ? where only the corpus can tell. turned counts the given names of "Last, First" (words are then in
    the usual order), else -1. torn: 1 if the last word starts with a small letter though the first does not, -1 if capitals
    and small letters are used as usual, 0 if they tell nothing.
    """
    if not raw:
        return None
    s = " ".join(raw.split())
    low = s.lower()
    if any(sign in low for sign in _ALIAS_SIGNS):
        s = _ALIAS.sub("", s)
    if "(" in s or "[" in s:
        s = _PAREN.sub(" ", s)
    if '"' in s or "'" in s or "\u201c" in s or "\u201d" in s:
        s = _QUOTED.sub(" ", s)
    while s and (s[-1] in "*,;\u2013- " or any(sign in low for sign in _TAIL_SIGNS)):
        cut = _TAIL.sub("", s)
        if cut == s:
            break
        s = cut
    s = s.strip(" ,;*-") if s[-1:] == "." and s[-2:-1].isalpha() and not s[-3:-2].isalpha() else s.strip(" .,;*-")
    if not s.isupper():
        s = _CAMEL.sub(" ", s)
    flat = fold(s.lower())
    if "." in flat:
        flat = flat.replace(".", "")
    flat = " ".join(flat.split()).strip(" ,-")
    form = ""
    sure = entity_type == "judge"
    if not sure:
        if flat.replace(" ", "").endswith(_FORM_ENDS_GLUED):
            for name, pattern in _FORMS:
                m = pattern.search(flat)
                if m and m.start() > 0:
                    form, flat = name, flat[: m.start()].rstrip(" ,&-")
                    break
        words = [expand.get(w, w) for w in _WORD.findall(flat)]
        if form or entity_type == "firm" or "&" in flat or any(w in ("of", "the", "for", "and") for w in words):
            words = [w if w.isdigit() else w.translate(_DIGITS) for w in words if w not in CONNECTORS]
            return ("O", words, -1, 0, "", form) if words else None
    flat = _HONORIFIC.sub("", flat)
    last_first = _LAST_FIRST.match(flat) if "," in flat else None
    suffix = ""
    if last_first and last_first.group(2).strip() not in SUFFIXES:
        head = [w for w in last_first.group(1).split() if w not in SUFFIXES]
        suffix = next((SUFFIXES[w] for w in flat.replace(",", " ").split() if w in SUFFIXES), "")
        given = [w for w in last_first.group(2).split() if w not in SUFFIXES]
        tokens, turned = given + head, len(given)
    else:
        tokens, turned = flat.replace(",", " ").split(), -1
    words = []
    for i, t in enumerate(tokens):
        t = t.strip("-'’&#")
        if t in SUFFIXES and i:
            suffix = SUFFIXES[t]
        elif t and any(c.isalpha() for c in t):
            words.append(t.translate(_DIGITS) if len(t) > 1 else t)
        elif i < turned:
            turned -= 1
    if not words:
        return None
    torn = 0 if s.isupper() or s.islower() else 1 if s[:1].isupper() and s.rsplit(" ", 1)[-1][:1].islower() else -1
    return ("P" if sure or suffix else "?", words, turned, torn, suffix, form)


def resolve_name(layout: tuple, canon: Mapping[str, str], org: frozenset[str] | set[str] = frozenset(), family_names: frozenset[str] | set[str] = frozenset()) -> tuple[str, str, str, str, str, str] | None:
    """(kind, stem, g1, g2, suffix, form) of a layout; absent parts are ''.

    canon: the full given name of each word of it that is known as one; org: its words known from organisations;
    family_names: its words known as surnames. An unknown middle word is a given name if the last word is a surname, or
    the capitals are sound and it makes no surname together with the last word; else it is a piece of a torn surname.
    All given names after the first are kept in g2, apart by blanks.
    """
    kind, words, turned, torn, suffix, form = layout
    words = list(words)
    known = lambda w: len(w) == 1 or w in canon
    if kind == "?" and turned < 0 and not any(w in canon for w in words):
        named = [w for w in words if w in org]
        # An initial leads a person's name, unless two words known from organisations follow.
        if named and (len(words[0]) > 1 or (len(words) > 2 and len(words[1]) > 1 and words[-1] in org and len(named) > 1)):
            kind = "O"
    if kind == "?" and turned >= 0 and not any(known(w) for w in words[:turned]) and any(w in org for w in words):
        kind, words, turned = "O", words[turned:] + words[:turned], -1
    if kind == "O":
        words = [EXPAND.get(w, w) for w in words if w not in CONNECTORS]
        return ("O", " ".join(words), "", "", "", form) if words else None
    if turned < 0 and len(words) > 1 and len(words[0]) > 1 and words[0] not in canon:
        if words[1] in canon or (len(words[1]) == 1 and len(words) > 2):
            tail = words[1:]
            if all(known(w) for w in tail):
                words, turned = tail + words[:1], len(tail)
    if turned < 0 and len(words) == 3 and torn > 0 and canon.get(words[1], words[1]) != words[1]:
        words = [words[0], words[1] + words[2]]  # a surname torn after letters that happen to be a short name
    if turned > 0:
        givens, family = words[:turned], words[turned:]
    else:
        k = 0
        settled = torn <= 0 and (words[-1] in family_names or (torn < 0 and "".join(words[-2:]) not in family_names))
        while k < len(words) - 1 and (k == 0 or known(words[k]) or (settled and words[k] not in family_names)):
            k += 1
        if k == 1 and len(words) == 2 and not known(words[0]) and (torn > 0 or "".join(words) in family_names):
            k = 0  # a surname typed in two pieces
        givens, family = words[:k], words[k:]
    if not family:
        givens, family = givens[:-1], givens[-1:]
    g = [w if len(w) == 1 else canon.get(w, w) for w in givens]
    stem = "".join(family).replace("'", "").replace("’", "")
    stem = " ".join(x for x in stem.split("-") if x)
    return ("P", stem, g[0] if g else "", " ".join(g[1:]), suffix, "") if stem else None


def parse_name(raw: str | None, entity_type: str | None, canon: Mapping[str, str] = CANON, org: frozenset[str] = frozenset()) -> tuple[str, str, str, str, str, str] | None:
    """One name with a given vocabulary; for many names parse_names learns it."""
    layout = read_layout(raw, entity_type)
    return resolve_name(layout, canon, org) if layout else None


PARSED = "entity_type string, raw string, kind string, stem string, g1 string, g2 string, suffix string, form string"


def layouts(df: DataFrame) -> DataFrame:
    """LAYOUT of every different (entity_type, raw)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for kind, raw in zip(batch["entity_type"].tolist(), batch["raw"].tolist()):
                p = read_layout(raw, kind)
                if p:
                    rows.append((kind, raw, *p))
            yield pd.DataFrame(rows, columns=["entity_type", "raw", "kind", "words", "turned", "torn", "suffix", "form"])

    return df.select("entity_type", "raw").distinct().mapInPandas(run, LAYOUT)


VOCABULARY = "word string, g bigint, s bigint, o bigint, l bigint, n bigint"


def learn(laid: DataFrame) -> DataFrame:
    """VOCABULARY: in how many names each word is surely a given name (g), a surname (s), of an organisation (o),
    last of an open name (l), and in how many it is at all (n). One aggregate over all words of all names."""
    n, turned = F.size("words"), F.col("turned")
    single = lambda i: F.length(F.try_element_at("words", F.lit(i))) == 1
    person = F.col("kind") != "O"
    middle = person & (turned < 0) & (n == 3) & single(2) & ~single(1) & ~single(3)  # First M. Last
    behind = person & (turned < 0) & (n == 3) & single(3) & ~single(1) & ~single(2)  # Last First M.
    lead = person & (turned < 0) & (n >= 2) & single(1) & ~single(-1)  # F. Last, F. M. Last
    rows = laid.select(
        (person & (turned > 0)).alias("comma"), "turned", middle.alias("middle"), behind.alias("behind"), lead.alias("lead"), n.alias("size"), (F.col("kind") == "O").alias("org"),
        (F.col("kind") == "?").alias("open"), F.posexplode("words").alias("at", "word"),
    ).filter(F.length("word") > 1)
    first, last = F.col("at") == 0, F.col("at") == F.col("size") - 1
    given = (F.col("comma") & (F.col("at") < F.col("turned"))) | (F.col("middle") & first) | (F.col("behind") & (F.col("at") == 1))
    family = (F.col("comma") & (F.col("at") >= F.col("turned"))) | (F.col("middle") & last) | (F.col("behind") & first) | (F.col("lead") & last)
    count = lambda c: F.sum(c.cast("bigint"))
    return rows.groupBy("word").agg(count(given).alias("g"), count(family).alias("s"), count(F.col("org")).alias("o"), count(F.col("open") & last & ~F.col("comma") & (F.col("size") > 1)).alias("l"), F.count("*").alias("n"))


def word_roles(vocabulary: DataFrame, nicknames: Mapping[str, str] = CANON) -> DataFrame:
    """(word, full, org, sur): the given name a word stands for, or null; whether it is known from organisations, as a surname.

    A word is a given name if it is one surely more often than a surname; the dictionary counts as one such use. A word
    with fewer sure uses as a surname than uses at all, and five times rarer than a given name one slip away, is that name
    misspelt; likewise for words of organisations of six letters or more. Slips are found by deletion neighbours: two words one edit or swap apart share one.
    """
    counts = ("g", "s", "o", "l", "n")
    listed = vocabulary.sparkSession.createDataFrame(list(nicknames.items()), "word string, formal string")  # the parameter, not data
    v = vocabulary.select("word", *counts, F.lit(None).cast("string").alias("formal")).union(listed.select("word", *[F.lit(0).cast("bigint") for _ in counts], "formal"))
    v = Scratch(vocabulary.sparkSession, "roles").table(v.groupBy("word").agg(*[F.sum(c).alias(c) for c in counts], F.max("formal").alias("formal")))
    v = v.withColumn("gg", F.col("g") + F.col("formal").isNotNull().cast("bigint"))
    v = v.withColumn("is_org", ((F.col("o") > 0) & (F.col("o") > F.col("gg") + F.col("s"))) | ((F.col("l") >= 3) & (F.col("s") == 0) & (F.col("gg") == 0)))
    given = v.filter("gg > s").select("word", F.coalesce("formal", "word").alias("full"), F.greatest("gg", "n").alias("uses"), "gg", "formal")
    length = F.length("word")
    cut = F.transform(F.sequence(F.lit(1), length), lambda i: F.concat(F.substring("word", F.lit(1), i - 1), F.substring("word", i + 1, length)))
    keys = F.explode(F.array_distinct(F.array_append(cut, F.col("word")))).alias("key")
    right = given.filter(length >= 3).select(F.col("word").alias("name"), "full", F.col("uses").alias("right_g"), (F.col("formal").isNull() | (F.col("formal") == F.col("word"))).alias("whole"), F.lit(False).alias("firm"), keys)
    right = right.union(v.filter(F.col("is_org") & (length >= 6)).select(F.col("word").alias("name"), "word", F.col("n").alias("right_g"), F.lit(True), F.lit(True), keys))
    wrong = v.filter((length >= 3) & F.col("formal").isNull() & (F.col("s") <= F.col("g")) & (F.col("n") > 0)).select("word", "n", keys)
    a, b, la, lb = F.col("word"), F.col("name"), F.length("word"), F.length("name")
    d = F.levenshtein("word", "name", 2)
    swapped = F.array_join(F.array_sort(F.split(a, "")), "") == F.array_join(F.array_sort(F.split(b, "")), "")
    slip = (d == 1) | ((d == 2) & (la == lb) & swapped)
    short = (lb < 5) | (la < 4)
    usual = ~short | ((F.substring(a, 1, 1) == F.substring(b, 1, 1)) & ((lb > 3) | F.col("whole")))
    misspelt = wrong.join(right, "key").filter((a != b) & slip & usual & (F.col("n") * 5 <= F.col("right_g")))
    misspelt = misspelt.groupBy("word").agg(F.max_by("full", F.when(~F.col("firm"), F.struct("right_g", "full"))).alias("meant"), F.max("firm").alias("slip_org"))
    roles = v.join(misspelt, "word", "left").select("word", F.coalesce("meant", F.when(F.col("gg") > F.col("s"), F.coalesce("formal", "word"))).alias("full"), (F.col("is_org") | F.coalesce("slip_org", F.lit(False))).alias("org"), (F.col("s") > F.col("gg")).alias("sur"))
    return roles.filter("full is not null or org or sur")


def resolve(laid: DataFrame, roles: DataFrame) -> DataFrame:
    """PARSED of every layout, each word's role joined in."""
    words = laid.filter("kind <> 'O'").select("entity_type", "raw", F.explode(F.array_distinct(F.when(F.size("words") > 1, F.array_append("words", F.concat(F.element_at("words", -2), F.element_at("words", -1)))).otherwise(F.col("words")))).alias("word"))
    known = words.join(roles, "word").groupBy("entity_type", "raw").agg(F.collect_list(F.struct("word", "full", "org", "sur")).alias("roles"))
    told = laid.join(known, ["entity_type", "raw"], "left").select(*laid.columns, F.col("roles.word").alias("rw"), F.col("roles.full").alias("rf"), F.col("roles.org").alias("ro"), F.col("roles.sur").alias("rs"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            columns = [b[c].tolist() for c in ("entity_type", "raw", "kind", "words", "turned", "torn", "suffix", "form", "rw", "rf", "ro", "rs")]
            for kind, raw, k, words, turned, torn, suffix, form, rw, rf, ro, rs in zip(*columns):
                canon, org, sur = {}, set(), set()
                if rw is not None:
                    for w, f, o, u in zip(rw, rf, ro, rs):
                        if f is not None:
                            canon[w] = f
                        if o:
                            org.add(w)
                        if u:
                            sur.add(w)
                p = resolve_name((k, words, turned, torn, suffix, form), canon, org, sur)
                if p and p[1]:
                    rows.append((kind, raw, *p))
            yield pd.DataFrame(rows, columns=["entity_type", "raw", "kind", "stem", "g1", "g2", "suffix", "form"])

    return told.mapInPandas(run, PARSED)


def parse_names(df: DataFrame, nicknames: Mapping[str, str] = CANON, scratch: Scratch | None = None) -> DataFrame:
    """Parts of every different (entity_type, raw), read with the vocabulary learnt from all of them."""
    scratch = scratch or Scratch(df.sparkSession, "parsed")
    laid = scratch.table(layouts(df))
    return resolve(laid, word_roles(learn(laid), nicknames))


def name_column() -> Column:
    """The name as typed; where that is missing, the best other one."""
    nz = lambda c: F.when(F.trim(c) != "", F.col(c))
    return F.coalesce(nz("raw_name"), nz("presentable_name"), nz("normalized_name"))


QGRAM = 3
SCANS = (("rn", "m"), ("vv", "w"), ("ri", "n"))


def qgrams(unit: Column) -> Column:
    """Padded q-grams of a unit with their places."""
    padded = F.concat(F.lit("_"), unit, F.lit("_"))
    return F.transform(F.sequence(F.lit(1), F.greatest(F.length(padded) - (QGRAM - 1), F.lit(1))), lambda i: F.struct(F.substring(padded, i, QGRAM).alias("gram"), i.alias("place")))


def scanned(unit: Column) -> Column:
    """_scan as a column."""
    for pair, letter in SCANS:
        unit = F.replace(unit, F.lit(pair), F.lit(letter))
    return unit


def two_slips(block: Column, length: Column) -> Column:
    """Whether stem_softness allows two slips in units of that length."""
    return (length >= 12) | ((block != "*") & (length >= 8))


def word_frequencies(parsed: DataFrame) -> DataFrame:
    """(entity_type, kind, word, df): in how many names each word of a stem is; an organisation's spellings of one stem count once."""
    person = F.col("kind") == "P"
    names = parsed.select("entity_type", "kind", "stem", *[F.when(person, F.col(c)).alias(c) for c in ("g1", "g2", "suffix")]).distinct()
    return names.select("entity_type", "kind", F.explode(F.array_distinct(F.split("stem", " "))).alias("word")).groupBy("entity_type", "kind", "word").agg(F.count("*").alias("df"))


def with_frequencies(parsed: DataFrame, words: DataFrame | None = None) -> DataFrame:
    """(entity_type, kind, stem, dfs): the frequency of each word of every stem; 1 for words that ``words`` does not have."""
    words = word_frequencies(parsed) if words is None else words
    stems = parsed.select("entity_type", "kind", "stem").distinct()
    placed = stems.select("entity_type", "kind", "stem", F.posexplode(F.split("stem", " ")).alias("at", "word")).join(words, ["entity_type", "kind", "word"], "left")
    return placed.groupBy("entity_type", "kind", "stem").agg(F.sort_array(F.collect_list(F.struct("at", F.coalesce("df", F.lit(1)).alias("df")))).getField("df").alias("dfs"))


ESTABLISHED, RATIO = 5, 20


def established(a: Column, b: Column) -> Column:
    """Two words that are both in use, by their frequencies: neither is a misspelling of the other."""
    return (F.least(a, b) >= ESTABLISHED) & (F.least(a, b) * RATIO >= F.greatest(a, b))


def rarity(df: Column | str) -> Column:
    """Inverse document frequency weight, 1 for a word of one name."""
    return 1 / (1 + F.log(F.greatest(F.col(df) if isinstance(df, str) else df, F.lit(1))))


STEM = ["entity_type", "block", "kind", "stem", "dfs"]


def similar_stems(stems: DataFrame, asked: DataFrame | None = None) -> DataFrame:
    """(entity_type, block, kind, x, y, dfs_x, dfs_y) of different stems of a block that may match softly, x < y.

    With ``asked``, more stems of the same columns, only the pairs of one of those, as x, with one of ``stems``.

    A unit is a whole stem without spaces or, of an organisation, one word together with the words beside it (the rest). Units
    are compared only if their rests are equal. One slip changes at most QGRAM + 1 of a unit's q-grams, so two units
    within k slips share one of the first k * (QGRAM + 1) + 1, rarest first, of each: that prefix is all that is
    joined. Units of which only one slip is allowed share what is left of them without one letter, swaps included; they meet on that alone, so
    their groups grow with the pairs to be found, not with the square of the units. Units with no q-gram left after their slips,
    and those alike but for what scans confuse, meet on keys of
    their own, as do stems of the same letters (words in another order, run together or torn), half a double name with
    the whole, and an initial with a word. The frequency of a q-gram bounds its group; if any is large, large groups are split.
    Postings hold the hash of a stem in place of it, and are written once for both sides; pairs get theirs back by a join.
    """
    scratch = Scratch(stems.sparkSession, "grams")
    every = stems.select(*STEM, F.lit(False).alias("asks"))
    if asked is not None:
        every = every.union(asked.select(*STEM, F.lit(True)))
    every = scratch.table(every.withColumn("sid", F.xxhash64("entity_type", "block", "kind", "stem")))
    every = every.select("*", F.split("stem", " ").alias("words"), F.replace("stem", F.lit(" "), F.lit("")).alias("whole"), F.xxhash64("entity_type", "block", "kind").alias("at"))
    several, org = F.size("words") > 1, F.col("kind") == "O"
    none = F.lit("")
    rest = lambda i: F.array_join(F.array_sort(F.filter("words", lambda w, j: j != i)), " ")
    unit = lambda u, r, df: F.struct(u.alias("unit"), r.alias("rest"), df.cast("bigint").alias("df"))
    whole = F.array(unit(F.col("whole"), none, F.when(several, F.lit(1)).otherwise(F.col("dfs")[0])))
    words = F.transform("words", lambda w, i: unit(w, rest(i), F.col("dfs")[i]))
    units = F.when(org & several, F.concat(whole, words)).otherwise(whole)
    held = every.select("stem", "kind", "block", "sid", "asks", "at", several.alias("several"), F.explode(units).alias("u")).select("stem", "kind", "block", "sid", "asks", "at", "several", "u.*")
    held = held.withColumn("ctx", F.xxhash64("at", "rest")).withColumn("two", two_slips(F.col("block"), F.length("unit")))
    length = F.length("unit")
    one = length <= F.when(F.col("block") == "*", 12).otherwise(8)  # the lengths of which a pair may be allowed one slip only
    held = held.withColumn("one", one)
    different = held.filter("two").select("unit").distinct()
    grams = different.select("unit", F.explode(qgrams(F.col("unit"))).alias("g")).select("unit", "g.gram", "g.place")
    frequency = scratch.table(grams.groupBy("gram").agg(F.count("*").alias("gdf")))
    largest = frequency.agg(F.max("gdf")).first()[0] or 0
    prefix = grams.join(frequency, "gram").groupBy("unit").agg(F.slice(F.sort_array(F.collect_list(F.struct("gdf", "gram", "place"))), 1, 2 * (QGRAM + 1) + 1).alias("s"))
    # Keys beside the q-grams, each with the unit it stands for; a unit has few of them.
    own = lambda key: F.struct(F.lit(1).cast("bigint").alias("gdf"), key.alias("gram"), F.lit(0).alias("place"))
    empty = F.array().cast("array<struct<gdf:bigint,gram:string,place:int>>")
    # A pair of which one unit is too short for two slips meets on what is left without one letter.
    cut = F.transform(F.sequence(F.lit(1), length), lambda i: own(F.concat(F.lit("~"), F.substring("unit", F.lit(1), i - 1), F.substring("unit", i + 1, length))))
    short = F.when(F.col("one"), F.array_append(cut, own(F.concat(F.lit("~"), F.col("unit"))))).otherwise(empty)
    # Two slips change all 8 q-grams of a unit of 8 letters only by swapping its letters 2, 3 and 6, 7; they meet with those sorted.
    pair = lambda i: F.array_join(F.array_sort(F.array(F.substring("unit", i, 1), F.substring("unit", i + 1, 1))), "")
    eight = F.when(F.col("two") & (length == 8), F.array(own(F.concat(F.lit("#"), F.substring("unit", 1, 1), pair(2), F.substring("unit", 4, 2), pair(6), F.substring("unit", 8, 1))))).otherwise(empty)
    scan = F.array(own(F.concat(F.lit("="), scanned(F.col("unit")))))
    # "@": all letters of a stem; "%": half a double name; "!": the first letter of a word beside the same others.
    sorted_letters = F.array_join(F.array_sort(F.split("unit", "")), "")
    same = F.when((F.col("rest") == "") & (org | F.col("several")), F.array(own(F.concat(F.lit("@"), F.when(org, sorted_letters).otherwise(F.col("unit")))))).when((F.col("rest") == "") & ~F.col("several"), F.array(own(F.concat(F.lit("@"), F.col("unit"))))).otherwise(empty)
    half = F.when(org, empty).when(F.col("several"), F.transform(F.split("stem", " "), lambda w: own(F.concat(F.lit("%"), w)))).otherwise(F.array(own(F.concat(F.lit("%"), F.col("unit")))))
    initial = F.when(org & (F.col("rest") != ""), F.array(own(F.concat(F.lit("!"), F.substring("unit", 1, 1))))).otherwise(empty)
    keys = F.array_distinct(F.concat(F.when(F.col("two"), F.coalesce("s", empty)).otherwise(empty), short, eight, scan, same, half, initial))
    columns = ["sid", "asks", "ctx", "unit", "two", "several", "df"]
    posted = scratch.table(held.join(prefix, "unit", "left").select(*columns, F.explode(keys).alias("k")).select(*columns, "k.*"))
    pieces = []
    if largest > CHUNK:
        left, right = split_sides(posted, F.col("gdf"), F.col("sid"))
        pieces = ["piece_a", "piece_b"]
    else:
        left = right = posted.drop("gdf")
    x, y = left.alias("x"), right.alias("y")
    lx, ly = F.length("x.unit"), F.length("y.unit")
    in_slips = (F.levenshtein("x.unit", "y.unit", 2) >= 0) | (F.col("x.two") & F.col("y.two") & (F.levenshtein("x.unit", "y.unit", 4) >= 0))
    sign = F.substring("x.gram", 1, 1)
    plain = (F.abs(lx - ly) <= 2) & (F.abs(F.col("x.place") - F.col("y.place")) <= 2) & ~established(F.col("x.df"), F.col("y.df")) & in_slips
    close = F.when(sign.isin("=", "@"), F.lit(True)).when(sign == "%", F.col("x.several") != F.col("y.several")).when(sign == "!", (lx == 1) != (ly == 1)).otherwise(plain)
    order = F.col("x.sid") < F.col("y.sid") if asked is None else F.col("x.asks") & ~F.col("y.asks") & (F.col("x.sid") != F.col("y.sid"))
    met = x.join(y, [*[F.col(f"x.{c}") == F.col(f"y.{c}") for c in ("ctx", "gram", *pieces)], order, close])
    pairs = met.select(F.col("x.sid").alias("sid_x"), F.col("y.sid").alias("sid_y")).distinct()
    names = every.select("sid", *STEM).distinct()
    of = lambda side, *keep: names.select(F.col("sid").alias(f"sid_{side}"), *keep, F.col("stem").alias(side), F.col("dfs").alias(f"dfs_{side}"))
    told = pairs.join(of("x", "entity_type", "block", "kind"), "sid_x").join(of("y"), "sid_y")
    turn = (F.col("x") > F.col("y")) if asked is None else F.lit(False)
    end = lambda c, d: F.when(turn, F.col(d)).otherwise(F.col(c)).alias(c)
    return told.select("entity_type", "block", "kind", end("x", "y"), end("y", "x"), end("dfs_x", "dfs_y"), end("dfs_y", "dfs_x"))


NEAR = "entity_type string, block string, kind string, x string, y string, soft double"


def _stem_verdict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Keeps stem pairs whose tokens match softly; softness is the similarity of the stems, 0 to 1."""
    for batch in batches:
        soft = [stem_softness(*row) for row in zip(*[batch[c].tolist() for c in ("block", "kind", "x", "y", "dfs_x", "dfs_y")])]
        out = batch.drop(columns=["dfs_x", "dfs_y"]).assign(soft=np.array(soft, float))
        yield out[out["soft"] > 0]


def verified_stems(pairs: DataFrame) -> DataFrame:
    """NEAR of candidate pairs of stems."""
    return pairs.mapInPandas(_stem_verdict, NEAR)


def _scan(s: str) -> str:
    """Letter pairs that scans confuse with one letter."""
    for pair, letter in SCANS:
        s = s.replace(pair, letter)
    return s


def _near(a: str, b: str, slips: int) -> float:
    if min(len(a), len(b)) < 3:
        return 1 - 1 / len(a) if len(a) == len(b) == 2 and a == b[::-1] else 0.0
    d = within(a, b, slips)
    if d > slips and _scan(a) == _scan(b):
        d = 1
    return 1 - d / max(len(a), len(b)) if d <= slips else 0.0


PART_OF_STEM = 0.8
COMMON = 0.25  # a word of lower rarity does not tell organisations apart by itself


def _weight(df: int) -> float:
    return 1 / (1 + np.log(max(df, 1)))


def stem_softness(block: str, kind: str, x: str, y: str, dfs_x=None, dfs_y=None) -> float:
    """0 if two stems differ, 0.99 if they are spelt alike but for spaces or order, PART_OF_STEM for one half of a double name.

    dfs: the frequencies of their words; without them all words count as rare. Shared words weigh their rarity, so a slip in
    the one rare word costs more than a slip beside rare words; two established words are no slip of each other.
    """
    a, b = x.replace(" ", ""), y.replace(" ", "")
    if a == b:
        return 0.99
    short = min(len(a), len(b))
    slips = 2 if short >= 12 or (block != "*" and short >= 8) else 1
    p, q = x.split(" "), y.split(" ")
    df = dict(zip(p, dfs_x if dfs_x is not None else [1] * len(p)))
    df |= dict(zip(q, dfs_y if dfs_y is not None else [1] * len(q)))
    in_use = lambda u, v: min(df[u], df[v]) >= ESTABLISHED and min(df[u], df[v]) * RATIO >= max(df[u], df[v])
    if kind == "P":
        if len(p) != len(q) and ((len(p) == 1 and x in q) or (len(q) == 1 and y in p)):
            return PART_OF_STEM
        return 0.0 if len(p) == len(q) == 1 and in_use(x, y) else _near(a, b, slips)
    left, right = sorted(set(p) - set(q)), sorted(set(q) - set(p))
    if not left and not right:
        return 0.99
    if len(left) == len(right) == 1:
        u, v = left[0], right[0]
        shared = sum(_weight(df[w]) for w in set(p) & set(q))
        if 1 in (len(u), len(v)):  # an initial for a word, beside another rare word
            return 0.85 if u[0] == v[0] and any(_weight(df[w]) >= COMMON and len(w) > 3 for w in set(p) & set(q)) else 0.0
        if in_use(u, v):
            return 0.0
        near = _near(u, v, 2 if block != "*" and min(len(u), len(v)) >= 8 else 1)
        w = _weight(max(df[u], df[v]))
        return (shared + w * near) / (shared + w) if near else 0.0
    # Words run together or torn apart, perhaps in another order.
    if "".join(sorted(a)) == "".join(sorted(b)) and len(left) + len(right) <= 3:
        return 0.95
    return _near(a, b, 1 if short < 12 else 2) if len(p) != len(q) else 0.0


def part_fits(x: Column, y: Column) -> Column:
    """Whether one part, as columns, can be the same in both names."""
    slash = lambda c: F.concat(F.lit("/"), c, F.lit("/"))
    either = slash(x).contains(slash(y)) | slash(y).contains(slash(x))
    short = (F.length(x) == 1) | (F.length(y) == 1)
    return (x == "") | (y == "") | (x == y) | either | (short & (F.substring(x, 1, 1) == F.substring(y, 1, 1))) | ((F.length(x) > 3) & (F.length(y) > 3) & (F.levenshtein(x, y, 1) >= 0))


def _slot(a: str, b: str) -> Column:
    """part_fits of every given name of two parts with its counterpart."""
    return F.forall(F.zip_with(F.split(a, " "), F.split(b, " "), lambda x, y: F.coalesce(part_fits(x, y), F.lit(True))), lambda fits: fits)


NODE = ["entity_type", "court", "kind", "stem", "g1", "g2", "suffix", "form"]


def name_nodes(mentions: DataFrame, scratch: Scratch) -> DataFrame:
    """(entity_type, court, raw, node, parts...): the reading of every different name of every court; a node is one reading in one court."""
    raw = mentions.select("entity_type", F.coalesce("court", F.lit("")).alias("court"), name_column().alias("raw")).filter("raw is not null and entity_type is not null").distinct()
    parsed = parse_names(raw, scratch=scratch)
    named = raw.join(parsed, ["entity_type", "raw"])
    return named.select("entity_type", "court", "raw", *[c for c in NODE if c not in ("entity_type", "court")], F.concat_ws("\x1f", *NODE).alias("node"))


WEIGHT_GIVEN, WEIGHT_MIDDLE, ACCEPT = 0.35, 0.2, 0.62


def meeting_keys(g1: Column) -> Column:
    """Keys of which two given names that fit share one: their first letters; a missing one has its own."""
    return F.when(g1 == "", F.array(F.lit(""))).otherwise(F.array_distinct(F.flatten(F.transform(F.split(g1, "/"), lambda g: F.array(F.substring(g, 1, 1), F.when(F.length(g) > 3, F.substring(g, 2, 1)).otherwise(F.substring(g, 1, 1)))))))


def link_nodes(nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """(a, b) of node ids of one entity, a < b."""
    block = F.when(F.col("entity_type") == "party", F.lit("*")).otherwise(F.col("court"))
    nodes = scratch.table(nodes.withColumn("block", block).join(with_frequencies(nodes), ["entity_type", "kind", "stem"]))
    stems = nodes.select(*STEM).distinct()
    near = scratch.table(verified_stems(similar_stems(stems)))
    # Every node also stands under the stems similar to its own; a pair meets under the stem of one of the two.
    back = near.select("entity_type", "block", "kind", F.col("y").alias("stem"), F.col("x").alias("under"), "soft")
    forth = near.select("entity_type", "block", "kind", F.col("x").alias("stem"), F.col("y").alias("under"), "soft")
    keys = ["entity_type", "block", "kind", "stem"]
    nodes = nodes.withColumn("rare", rarity(F.array_min("dfs")))
    own = nodes.withColumn("under", F.col("stem")).withColumn("soft", F.lit(1.0))
    away = nodes.join(back.unionByName(forth), keys)
    parts = ["node", "court", "g1", "g2", "suffix", "form", "rare"]
    # Names with different full given names never meet: both sides are spread over the letters these may begin with.
    # One without a given name meets those with one under "*" or "?", by its side; two with one never meet there.
    none = F.col("g1") == ""
    spread = lambda absent, present: F.explode(F.array_append(meeting_keys(F.col("g1")), F.when(none, absent).otherwise(present))).alias("letter")
    left = own.select(*[F.col(c).alias(f"{c}_a") for c in parts], "entity_type", "block", "kind", "under", spread(F.lit("*"), F.lit("?")))
    both = own.unionByName(away.select(own.columns))
    right = both.select(*[F.col(c).alias(f"{c}_b") for c in parts], "entity_type", "block", "kind", "under", "soft", spread(F.lit("?"), F.lit("*")))
    pairs = left.join(right, ["entity_type", "block", "kind", "under", "letter"]).filter("node_a <> node_b and (soft < 1 or node_a < node_b)")
    fits = _slot("g1_a", "g1_b") & _slot("g2_a", "g2_b")
    for part in ("suffix", "form"):
        x, y = F.col(f"{part}_a"), F.col(f"{part}_b")
        fits &= (x == "") | (y == "") | (x == y)
    # Soft similarity over the weights of the parts, the stem's by its rarity: a rare stem carries a name without given
    # names; a misspelt or common one needs them, or the court, to agree.
    g = lambda a, b, w: F.when((F.col(a) == "") | (F.col(b) == ""), 0.0).when(F.col(a) == F.col(b), w).otherwise(0.6 * w)
    weight = 0.7 + 0.6 * F.greatest("rare_a", "rare_b")
    score = weight * F.col("soft") + g("g1_a", "g1_b", WEIGHT_GIVEN) + g("g2_a", "g2_b", WEIGHT_MIDDLE)
    total = weight + WEIGHT_GIVEN * ((F.col("g1_a") != "") | (F.col("g1_b") != "")).cast("double") + WEIGHT_MIDDLE * ((F.col("g2_a") != "") & (F.col("g2_b") != "")).cast("double")
    pairs = pairs.filter(fits & (score >= ACCEPT * total))
    exact = F.col("soft") == 1
    same_court = F.col("court_a") == F.col("court_b")
    full = (F.length("g1_a") > 1) & (F.length("g1_b") > 1)
    whole = F.abs(F.col("soft") - PART_OF_STEM) > 1e-9
    pairs = pairs.filter(exact | (F.col("kind") == "O") | same_court | (full & whole))
    pairs = pairs.select("node_a", "node_b", "court_a", "court_b", *[f"{p}_{s}" for p in ("g1", "g2", "suffix", "form") for s in "ab"])
    return _agreeing(scratch.table(pairs)).select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct()


def _agreeing(pairs: DataFrame) -> DataFrame:
    """Drops links through which a name would take a part that its neighbours disagree on."""
    flip = pairs.select(*[F.col(c[:-1] + ("b" if c[-1] == "a" else "a")).alias(c) for c in pairs.columns])
    directed = pairs.unionByName(flip)
    # What b offers to a in each part that a leaves open.
    offers = []
    for part in ("g1", "g2", "suffix", "form"):
        a, b = F.col(f"{part}_a"), F.col(f"{part}_b")
        if part in ("g1", "g2"):
            offer = F.when((a == "") & (b != "") & ~b.contains("/"), F.substring(b, 1, 1)).when(((F.length(a) == 1) | a.contains("/")) & (F.length(b) > 1) & ~b.contains("/"), b)
        else:
            offer = F.when((a == "") & (b != ""), b)
        offers.append(offer.alias(f"o_{part}"))
    near = F.col("court_a") == F.col("court_b")
    directed = directed.select("node_a", "node_b", near.alias("near"), *offers)
    seen = directed.groupBy("node_a").agg(
        *[F.min(f"o_{p}").alias(f"lo_{p}") for p in ("g1", "g2", "suffix", "form")],
        *[F.max(f"o_{p}").alias(f"hi_{p}") for p in ("g1", "g2", "suffix", "form")],
        *[F.min(F.when(F.col("near"), F.col(f"o_{p}"))).alias(f"nlo_{p}") for p in ("g1", "g2", "suffix", "form")],
        *[F.max(F.when(F.col("near"), F.col(f"o_{p}"))).alias(f"nhi_{p}") for p in ("g1", "g2", "suffix", "form")],
    )
    judged = directed.join(seen, "node_a")
    bad = F.lit(False)
    for p in ("g1", "g2", "suffix", "form"):
        o, lo, hi, nlo, nhi = (F.col(f"{x}_{p}") for x in ("o", "lo", "hi", "nlo", "nhi"))
        agreed = (lo == hi) | ((nlo == nhi) & (o == nlo))
        bad |= o.isNotNull() & ~F.coalesce(agreed, F.lit(False))
    bad_pairs = judged.filter(bad).select(F.least("node_a", "node_b").alias("x"), F.greatest("node_a", "node_b").alias("y")).distinct()
    keyed = pairs.withColumn("x", F.least("node_a", "node_b")).withColumn("y", F.greatest("node_a", "node_b"))
    return keyed.join(bad_pairs, ["x", "y"], "left_anti")


def name_entities(mentions: DataFrame) -> DataFrame:
    """(entity_type, court, raw, node, entity, parts...): the entity of every different name of every court."""
    scratch = Scratch(mentions.sparkSession, "names")
    names = scratch.table(name_nodes(mentions, scratch))
    links = scratch.table(link_nodes(names.select("node", *NODE).distinct(), scratch))
    grouped = components(links, "a", "b")
    return names.join(grouped, names["node"] == grouped["id"], "left").select("entity_type", "court", "raw", "node", "stem", "g1", "g2", "suffix", F.coalesce("group_id", "node").alias("entity"))


def listed_ids(entities: DataFrame) -> DataFrame:
    return entities.select(F.explode("mention_ids").alias("mention_id")).filter("mention_id is not null").distinct()


def placed_mentions(mentions: DataFrame) -> DataFrame:
    """(mention_id, normalized_name, entity): the name entity of every mention, one row each; the operator's compact output."""
    named = name_entities(mentions).select("entity_type", "court", "raw", "entity")
    rows = mentions.select("mention_id", "entity_type", F.coalesce("court", F.lit("")).alias("court"), name_column().alias("raw"), "normalized_name")
    return rows.filter("mention_id is not null").join(named, ["entity_type", "court", "raw"]).select("mention_id", "normalized_name", "entity").distinct()


def p1_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(entity, mentions, spellings): every name entity with its number of mentions and of different names."""
    placed = placed_mentions(read(spark, sf_dir, "mentions"))
    return placed.groupBy("entity").agg(F.count_distinct("mention_id").alias("mentions"), F.count_distinct("normalized_name").alias("spellings"))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = placed_mentions(read(spark, sf_dir, "mentions")).filter("trim(normalized_name) <> ''")
    placed = placed.join(listed_ids(read(spark, sf_dir, "entities")), "mention_id", "left_anti")
    placed = Scratch(spark, "p1").table(placed)
    pairs = group_pairs(placed, "entity", "mention_id", ["normalized_name"])
    return pairs.filter("normalized_name_a <> normalized_name_b").select("mention_id_a", "mention_id_b").distinct()


QUERIES = {"p1_found": p1_found, "p1_classes": p1_classes}
