"""Postal addresses of one place, written differently.

An address text is read into parts (number, direction, street, street word, unit, box, station, town,
state, zip). Candidates come from MinHash bands over its token and q-gram shingles, each shingle joined with
the house or box number, as another number is another place; an exact join on that number and the street's bigrams adds
the pairs that the bands miss (slipped_pairs). A candidate pair is decided by the cost of the affine-gap alignment of
the two token sequences as typed: a run of left-out tokens costs one opening and little more, a short form in place of the word
that the dictionaries give for it (street words, directions, states, a parameter) little, misspellings their edit distance, and
different words, numbers or codes more than any pair may cost; a part that both have can't be left out. Verified links join into
buildings by grid components; in a building, rows without a unit belong to its unit if it has only one.

Defined results: null and blank addresses and texts without a number denote no place and pair with nothing;
equal texts are one place; the order of lines, case, punctuation, country and NA lines don't matter. Texts reduce to different
texts and then to different parts before any pairing, and bands that hold very many of these are split, every pair of pieces joined.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketweave.llm.groups import components
from docketweave.operators.skew import group_pairs, split_sides
from docketweave.session import Scratch, read

# Street words, directions, ordinals and states with their usual short forms.
STREET_WORDS = {
    "street": "st str",
    "avenue": "ave av aven",
    "boulevard": "blvd boul",
    "drive": "dr drv",
    "road": "rd",
    "lane": "ln",
    "court": "ct crt",
    "place": "pl plc",
    "parkway": "pkwy pky pkway",
    "highway": "hwy hiway",
    "terrace": "ter terr",
    "circle": "cir",
    "square": "sq",
    "way": "wy",
    "trail": "trl",
}
DIRECTIONS = {"n": "n", "north": "n", "s": "s", "south": "s", "e": "e", "east": "e", "w": "w", "west": "w", "ne": "ne", "nw": "nw", "se": "se", "sw": "sw"}
DIRECTIONS |= {"northeast": "ne", "northwest": "nw", "southeast": "se", "southwest": "sw"}
ORDINALS = "zeroth first second third fourth fifth sixth seventh eighth ninth tenth eleventh twelfth thirteenth fourteenth fifteenth sixteenth seventeenth eighteenth nineteenth twentieth".split()
STATES = dict(
    pair.split(":")
    for pair in """alabama:al alaska:ak arizona:az arkansas:ar california:ca colorado:co connecticut:ct delaware:de florida:fl georgia:ga
    hawaii:hi idaho:id illinois:il indiana:in iowa:ia kansas:ks kentucky:ky louisiana:la maine:me maryland:md massachusetts:ma michigan:mi
    minnesota:mn mississippi:ms missouri:mo montana:mt nebraska:ne nevada:nv new_hampshire:nh new_jersey:nj new_mexico:nm new_york:ny
    north_carolina:nc north_dakota:nd ohio:oh oklahoma:ok oregon:or pennsylvania:pa rhode_island:ri south_carolina:sc south_dakota:sd
    tennessee:tn texas:tx utah:ut vermont:vt virginia:va washington:wa west_virginia:wv wisconsin:wi wyoming:wy district_of_columbia:dc""".split()
)
CODES = set(STATES.values())
WORD_OF = {short: full for full, shorts in STREET_WORDS.items() for short in [full, *shorts.split()]}
PARTS = ["number", "direction", "street", "word", "unit", "box", "station", "town", "state", "zip"]

_BLANK = regex.compile(r"^\W*(?:n/?a|none|null|usa?|u\.s\.a?\.?|united states)?\W*$", regex.I)
_DOTTED = regex.compile(r"\b(\p{L})\.\s?(\p{L})\.(?!\p{L})")
_BOX = regex.compile(r"\b(?:post office box|p\s*o\s*b(?:ox)?|pobox|box)\W{0,2}([\dOoIl]+)\b", regex.I)
_ZIP = regex.compile(r"(?<![\d-])(\d{5})(?:-?\d{4})?(?![\d-])")
_FLOOR = regex.compile(r"\b(?:(\d{1,3})(?:st|nd|rd|th)?\s*(?:floor|flr|fl)\b|(\d{1,3})\s*/\s*f\b|(?:floor|flr|fl)\.?\s*#?(\d{1,3})(?!\d)|(" + "|".join(ORDINALS) + r")\s+(?:floor|flr|fl)\b)", regex.I)
_UNIT = regex.compile(r"(?:\b(?:suite|ste|suit|room|rm|unit|apartment|apt|number)\b[\s.\-#]*|#\s*)(\d+[\s-]?\p{L}?\b|\p{L}?\d+\b|\p{L}\b)", regex.I)
_BUILDING = regex.compile(r"^[\p{L} .'-]+\b(?:tower|building|bldg|plaza|center|centre)s?\W*$", regex.I)
_STATION = regex.compile(r"([\p{L}\d'-]+)\s+(?:station|sta)\b\.?", regex.I)
_TOKEN = regex.compile(r"[\p{L}\d]+(?:['-][\p{L}\d]+)*")


def within(a: str, b: str, most: int) -> int:
    """Edit distance with neighbour swaps, or most + 1 where it is larger."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, row = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            d = min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y))
            if before is not None and i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            new.append(d)
        if min(new) > most:
            return most + 1
        before, row = row, new
    return min(row[-1], most + 1)


def letters(token: str) -> str:
    """A name token with digits that scans put for letters."""
    return token.translate(str.maketrans("015", "ols")) if not token.isdigit() else token


def digits(token: str) -> str:
    return token.lower().translate(str.maketrans("oil", "011"))


@lru_cache(1 << 16)
def street_word(token: str) -> str | None:
    if token in WORD_OF:
        return WORD_OF[token]
    if len(token) > 3:
        for full in STREET_WORDS:
            if within(token, full, 1 if len(full) < 6 else 2) <= (1 if len(full) < 6 else 2) and token[0] == full[0]:
                return full
    return None


def parse(text: str | None) -> dict[str, str] | None:
    """Parts of an address, empty where absent; None if it denotes no place."""
    if not text:
        return None
    out = dict.fromkeys(PARTS, "")
    typed: dict[str, str] = {}
    lines = [s for s in regex.split(r"[\n;]", text) if not _BLANK.match(s)]
    lines = [s for s in lines if not (_BUILDING.match(s) and len(lines) > 1)]
    s = " , ".join(lines)
    s = regex.sub(r",\s*(?:n\.?a\.?|usa|u\.s\.a\.)\s*(?=,|$)", "", s, flags=regex.I)
    s = _DOTTED.sub(r"\1\2 ", s)

    def take(pattern: regex.Pattern, s: str, last: bool = False) -> tuple[regex.Match | None, str]:
        m = None
        for m in pattern.finditer(s):
            if not last:
                break
        return (m, s) if m is None else (m, s[: m.start()] + " , " + s[m.end() :])

    m, s = take(_BOX, s)
    if m:
        out["box"] = digits(m.group(1))
        m, s = take(_STATION, s)
        if m:
            out["station"] = letters(m.group(1).lower())
    m, s = take(_ZIP, s, last=True)
    zip_at = -1
    if m:
        out["zip"], zip_at = m.group(1), m.start()
    m, s2 = take(_FLOOR, s)
    if m:
        floor = m.group(1) or m.group(2) or m.group(3) or str(ORDINALS.index(m.group(4).lower()))
        out["unit"] = "floor" + floor.lstrip("0")
        zip_at = zip_at if zip_at < m.start() else zip_at + 3 - (m.end() - m.start())
        s = s2
    m, s2 = take(_UNIT, s)
    if m:
        out["unit"] = out["unit"] or regex.sub(r"[\s-]", "", m.group(1).lower()).lstrip("0")
        zip_at = zip_at if zip_at < m.start() else zip_at + 3 - (m.end() - m.start())
        s = s2
    tokens = [(t.group().lower(), t.start()) for t in _TOKEN.finditer(s)]
    segment = [s.count(",", 0, at) for _, at in tokens]
    words = [t for t, _ in tokens]
    used = [False] * len(words)
    # The state stands before the zip code or ends a segment.
    options = []
    for i, (w, at) in enumerate(tokens):
        code = w if w in CODES else STATES.get(w)
        width = 1
        if i + 1 < len(words) and f"{w}_{words[i + 1]}" in STATES:
            code, width = STATES[f"{w}_{words[i + 1]}"], 2
        if w == "ct":  # Court unless another street word stands before it
            before = [k for k in range(i) if segment[k] == segment[i]]
            numbered = any(words[k][0].isdigit() for k in before)
            if numbered and not any(street_word(words[k]) for k in before[1:]):
                code = None
        if code:
            j = i + width
            ends = j == len(words) or segment[j] != segment[i]
            if ends or (zip_at >= 0 and at < zip_at and (j == len(words) or tokens[j][1] > zip_at)):
                options.append((i, width, code))
    if options:
        before_zip = [o for o in options if zip_at >= 0 and tokens[o[0]][1] < zip_at]
        i, width, out["state"] = (before_zip or options)[-1]
        typed["state"] = " ".join(words[i : i + width])
        for k in range(i, i + width):
            used[k] = True
    start = next((i for i, w in enumerate(words) if not used[i] and regex.fullmatch(r"[\dOoIl]*\d[\dOoIl]*", w)), -1) if not out["box"] else -1
    if start >= 0:
        out["number"] = digits(words[start]).lstrip("0") or "0"
        used[start] = True
        i = start + 1
        while i < len(words) and segment[i] == segment[start] and words[i] in DIRECTIONS and not used[i] and not out["direction"]:
            out["direction"] = DIRECTIONS[words[i]]
            typed["direction"] = words[i]
            used[i] = True
            i += 1
        name: list[str] = []
        while i < len(words) and segment[i] == segment[start] and not used[i]:
            kind = street_word(words[i]) if name else None
            used[i] = True
            if kind:
                out["word"] = kind
                typed["word"] = words[i]
                i += 1
                break
            name.append(letters(words[i]))
            i += 1
        out["street"] = "".join(name)
    town = [letters(w) for i, w in enumerate(words) if not used[i] and not w.isdigit() and w not in ("usa", "na")]
    out["town"] = " ".join(town)
    if not out["box"] and not (out["number"] and out["street"]):
        return None
    out["typed"] = "|".join(f"{k}={v}" for k, v in typed.items())
    return out


def tokens_of(p: dict[str, str]) -> list[tuple[str, str]]:
    """The token sequence of the building: (part, token as typed), a town as one token."""
    typed = dict(x.split("=", 1) for x in p["typed"].split("|") if x)
    return [(k, typed.get(k) or p[k].replace(" ", "")) for k in PARTS if p[k] and k != "unit"]


#: Costs of an alignment; a pair is one building up to ACCEPT. BAR alone is more.
OPEN_COST, EXTEND_COST, SHORT_COST, BAR, ACCEPT = 0.6, 0.15, 0.05, 3.0, 2.6
#: What dictionaries say a typed token stands for, by part.
MEANING = {"word": street_word, "direction": DIRECTIONS.get, "state": lambda t: STATES.get(t.replace(" ", "_"), t if t in CODES else None)}


@lru_cache(1 << 18)
def substitution(part: str, a: str, b: str) -> float:
    """Cost of one typed token for another of the same part."""
    if a == b:
        return 0.0
    if part in MEANING:
        x, y = MEANING[part](a), MEANING[part](b)
        if x is None or x != y:
            return BAR
        return SHORT_COST + (0.0 if a in WORD_OF and b in WORD_OF or part != "word" else 0.1)
    if part in ("number", "box", "zip"):
        return BAR
    if part == "town":
        d = within(a, b, 3)
        return 0.3 * d if d <= 2 else 2.1 if d == 3 else BAR
    most = 1 if max(len(a), len(b)) <= 5 else 2 if max(len(a), len(b)) <= 9 else 3
    d = within(a, b, most)
    return BAR if d > most else 0.5 * d


def align(a: list[tuple[str, str]], b: list[tuple[str, str]]) -> float:
    """Least cost of turning one sequence into the other. A gap costs OPEN_COST and EXTEND_COST a token more; the number or
    box, and parts that both sequences have, cost BAR to leave out."""
    n, m = len(a), len(b)
    kept = {p for p, _ in a} & {p for p, _ in b} | {"number", "box"}
    big = 1000.0
    match = [[big] * (m + 1) for _ in range(n + 1)]
    up = [[big] * (m + 1) for _ in range(n + 1)]
    left = [[big] * (m + 1) for _ in range(n + 1)]
    match[0][0] = 0.0
    for i in range(n + 1):
        for j in range(m + 1):
            if i:
                extra = BAR if a[i - 1][0] in kept else 0.0
                up[i][j] = extra + min(min(match[i - 1][j], left[i - 1][j]) + OPEN_COST, up[i - 1][j] + EXTEND_COST)
            if j:
                extra = BAR if b[j - 1][0] in kept else 0.0
                left[i][j] = extra + min(min(match[i][j - 1], up[i][j - 1]) + OPEN_COST, left[i][j - 1] + EXTEND_COST)
            if i and j and a[i - 1][0] == b[j - 1][0]:
                match[i][j] = min(match[i - 1][j - 1], up[i - 1][j - 1], left[i - 1][j - 1]) + substitution(*a[i - 1], b[j - 1][1])
    return min(match[n][m], up[n][m], left[n][m])


def same_building(p: dict[str, str], q: dict[str, str]) -> bool:
    """Whether the alignment of two parsed addresses, units aside, is cheap enough. They need a town or zip code in common to be compared at all."""
    if not (p["town"] and q["town"]) and not (p["zip"] and q["zip"]):
        return False
    return align(tokens_of(p), tokens_of(q)) <= ACCEPT


def shingles(p: dict[str, str]) -> list[str]:
    """Tokens and padded trigrams of what the number stands in, each with the number."""
    anchor = p["box"] and "b" + p["box"] or p["number"]
    name = p["station"] if p["box"] else p["street"]
    out = {f"{anchor} {t}" for t in (name, p["zip"] or p["town"].replace(" ", ""), p["state"]) if t}
    padded = f"^{name}$"
    out |= {f"{anchor} {padded[i : i + 3]}" for i in range(len(padded) - 2)}
    return sorted(out)


_MULTIPLY = np.random.default_rng(7).integers(1, 2**61, 64, dtype=np.uint64) | np.uint64(1)
_ADD = np.random.default_rng(8).integers(0, 2**61, 64, dtype=np.uint64)


def bands(p: dict[str, str], count: int = 32, rows: int = 2) -> list[int]:
    """Hash values of the MinHash bands."""
    base = pd.util.hash_array(np.array(shingles(p), object), categorize=False)
    with np.errstate(over="ignore"):
        mixed = base[:, None] * _MULTIPLY[None, : count * rows] + _ADD[None, : count * rows]
        mixed ^= mixed >> np.uint64(29)
        low = mixed.min(axis=0).reshape(count, rows)
        key = low[:, 0]
        for r in range(1, rows):
            key = (key * np.uint64(0x9E3779B97F4A7C15)) ^ low[:, r]
        key ^= np.arange(count, dtype=np.uint64) << np.uint64(50)
    return key.astype(np.int64).tolist()


READ = [*PARTS, "typed"]
_PARSED = "text string, " + ", ".join(f"{k} string" for k in READ) + ", bands array<bigint>"


def _parse_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for t in batch["text"]:
            p = parse(t)
            if p:
                rows.append((t, *(p[k] for k in READ), bands(p)))
        yield pd.DataFrame(rows, columns=["text", *READ, "bands"])


def _verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        left = batch[[f"{k}_a" for k in READ]].to_numpy(object)
        right = batch[[f"{k}_b" for k in READ]].to_numpy(object)
        keep = [same_building(dict(zip(READ, x)), dict(zip(READ, y))) for x, y in zip(left, right)]
        yield batch.loc[keep, ["a", "b"]]


def slipped_pairs(nodes: DataFrame) -> DataFrame:
    """(a, b), a < b, of all nodes that same_building can accept, found without bands.

    Their number or box agrees, and their zip, or their towns where one has no zip. A swap changes three of a street's
    padded bigrams and any other slip two or less, so streets of three letters or more keep one within their slips;
    shorter ones and boxes meet on the number alone.
    """
    anchor = F.when(F.col("box") != "", F.concat(F.lit("b"), "box")).otherwise(F.col("number"))
    padded = F.concat(F.lit("^"), "street", F.lit("$"))
    grams = F.transform(F.sequence(F.lit(1), F.length(padded) - 1), lambda i: F.struct(F.substring(padded, i, 2).alias("gram"), i.alias("place")))
    alone = F.array(F.struct(F.lit("").alias("gram"), F.lit(1).alias("place")))
    grams = F.when(F.col("box") != "", alone).when(F.length("street") <= 2, F.concat(grams, alone)).otherwise(grams)
    posted = nodes.select("node", anchor.alias("anchor"), "state", "zip", F.replace("town", F.lit(" "), F.lit("")).alias("town"), "street", F.explode(grams).alias("g"))
    posted = posted.select("node", "anchor", "state", "zip", "town", "street", "g.gram", "g.place")
    x, y = posted.alias("x"), posted.alias("y")
    longer = F.greatest(F.length("x.street"), F.length("y.street"))
    # Slips as in substitution(); a swap is two edits.
    in_slips = F.when(longer <= 5, F.levenshtein("x.street", "y.street", 2)).when(longer <= 9, F.levenshtein("x.street", "y.street", 4)).otherwise(F.levenshtein("x.street", "y.street", 6)) >= 0
    met = (F.abs(F.col("x.place") - F.col("y.place")) <= 3) & in_slips
    same = lambda *cs: [F.col(f"x.{c}") == F.col(f"y.{c}") for c in cs]
    towns = (F.col("x.town") != "") & (F.col("y.town") != "") & (F.levenshtein("x.town", "y.town", 4) >= 0)
    by_zip = x.join(y, [*same("anchor", "gram", "zip"), F.col("x.zip") != "", F.col("x.node") < F.col("y.node"), met])
    # One side has no zip; both have a town. Rows of no state meet those of all.
    zipless = [F.col("x.zip") == "", F.col("x.node") != F.col("y.node"), towns, met]
    by_state = x.join(y, [*same("anchor", "gram", "state"), *zipless])
    no_state = x.join(y, [*same("anchor", "gram"), *zipless, F.col("x.state") == "", F.col("y.state") != ""])
    no_state_y = x.join(y, [*same("anchor", "gram"), *zipless, F.col("x.state") != "", F.col("y.state") == ""])
    ends = lambda df: df.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))
    return ends(by_zip).union(ends(by_state)).union(ends(no_state)).union(ends(no_state_y)).distinct()


def same_place(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, place) of every row whose address denotes a place; rows of one place share ``place``.

    Rows reduce first to their different texts, then to their different parts, so a text that a third of the rows
    share is compared once.
    """
    spark = df.sparkSession
    scratch = Scratch(spark, "places")
    rows = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    parsed = scratch.table(rows.filter("text is not null").select("text").distinct().mapInPandas(_parse_batches, _PARSED))
    signature = F.sha2(F.concat_ws("\x1f", *PARTS), 256)
    kept = scratch.table(parsed.withColumn("sig", signature))
    whole = kept.groupBy("sig").agg(*(F.first(k).alias(k) for k in READ), F.first("bands").alias("bands"))
    building = F.sha2(F.concat_ws("\x1f", *[k for k in PARTS if k != "unit"]), 256)
    nodes = scratch.table(whole.withColumn("node", building))
    distinct = nodes.groupBy("node").agg(*(F.first(k).alias(k) for k in READ if k != "unit"), F.first("bands").alias("bands")).withColumn("unit", F.lit(""))
    # Rows of different states are no candidates, so a street name found in every town meets only within its state; rows without one meet all.
    banded = distinct.select("node", "state", F.explode("bands").alias("band"))
    sizes = banded.groupBy("band").agg(F.count("*").alias("size"))
    left, right = split_sides(banded.join(sizes, "band"), F.col("size"), F.col("node"))
    keys = ["band", "piece_a", "piece_b"]
    x, y = left.select(F.col("node").alias("a"), "state", *keys), right.select(F.col("node").alias("b"), "state", *keys)
    within_state = x.filter("state <> ''").join(y, ["state", *keys]).filter("a < b").select("a", "b")
    stateless = x.filter("state = ''").drop("state").join(y.drop("state"), keys).filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pairs = within_state.union(stateless).union(slipped_pairs(distinct)).distinct()
    side = lambda s: distinct.select(F.col("node").alias(s), *(F.col(k).alias(f"{k}_{s}") for k in READ))
    candidates = pairs.join(side("a"), "a").join(side("b"), "b")
    links = scratch.table(candidates.mapInPandas(_verify, "a string, b string"))
    grouped = components(links, "a", "b")
    placed = nodes.select("sig", "node", "unit").join(grouped, nodes["node"] == grouped["id"], "left").select("sig", "unit", F.coalesce("group_id", "node").alias("building"))
    only = placed.filter("unit <> ''").groupBy("building").agg(F.min("unit").alias("low"), F.max("unit").alias("high"))
    resolved = placed.join(only, "building", "left").select(
        "sig", F.concat_ws("/", "building", F.when((F.col("unit") == "") & (F.col("low") == F.col("high")), F.col("low")).otherwise(F.col("unit"))).alias("place")
    )
    return rows.join(kept.select("text", "sig").join(resolved, "sig").select("text", "place"), "text").select(F.col("key").alias(key), "place")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = Scratch(spark, "p4").table(same_place(read(spark, sf_dir, "case_addresses"), "address_id", "address"))
    return group_pairs(placed, "place", "address_id")


QUERIES = {"p4_found": p4_found}
