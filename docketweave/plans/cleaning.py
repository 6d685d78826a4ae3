"""The normalisation chain, name validity and repair, learnt token profile, remaining merge rules, journal and audit helpers.

The chain's steps are Column functions in the order in which they are to be applied (normalize_name); each has a query of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docketweave.functions import text as T
from docketweave.operators.graph import connected_components, star_edges
from docketweave.session import read

# Prefixes, replacements and characters of the normalisation chain.
PROCEDURAL = [
    r"^\s*(?:counsel|attorneys?)\s+not\s+admitted\s+to\b.*?\b(?:bar|court)\b[\s:,;\-]*",
    r"^\s*not\s+admitted\s+to\b(?:\s+the)?(?:\s+practice\s+of)?(?:\s+this)?\s*\b(?:bar|court)\b[\s:,;\-]*",
    r"^\s*(?:counsel|attorney)\s+to\s+be\s+noticed\b[\s:,;\-]*",
]
REPLACE_REGEX = [(r"\b[Aa]ttys?\b\.?", "attorney"), (r"\b[Dd]ep't\b", "department"), (r"\b[Gg]ov't\b", "government"), (r"\b[Uu]\.[Ss]\.", "united states")]
DELETE, STRIP = "'’\"", ".,;:()*"
LITERALS = ["unknown", "none", "n/a", "na", "not available", "judge", "unassigned", "pro se"]
ADDRESS_TAIL = r"(?i)[\s,]+(?:[0-9]+ [A-Za-z .]+(?:street|st|avenue|ave|road|rd|suite|ste|floor)\b.*|suite [0-9]+.*|[A-Za-z .]+, [A-Z]{2} [0-9]{5}(?:-[0-9]{4})?)$"
JUNK = r"(?i)\b(?:interpreter|courtroom|case no|docket)\b|[0-9]:[0-9]{2}-(?:cv|cr)-[0-9]+"
CUTS = r"(?i)\s*(?:cause:|referred to|presiding\b|\(08\)|-\s*see\b|https?:).*$"
TRAILING = r"(?i)(?:[\s,;*-]+(?:deceased|pro se|et al\.?|pursuant to|terminated|signed|usdj|usmj|mag|motions?))+\s*[-;,*]*$"


def strip_name_prefixes(c: Column) -> Column:
    """Leading "us" and "u.s.", as often as they are there."""
    return F.trim(F.regexp_replace(c, r"^(?i)(?:(?:us |u\.s\. ?|us\. ?))+", ""))


def strip_procedural(c: Column) -> Column:
    """Leading notices about counsel; stacked ones fall one after the other."""
    for _ in range(2):
        for p in PROCEDURAL:
            c = F.regexp_replace(c, "(?is)" + p, "")
    return F.trim(c)


def replace_regex(c: Column) -> Column:
    for pattern, by in REPLACE_REGEX:
        c = F.regexp_replace(c, pattern, by)
    return c


def clean_chars(c: Column) -> Column:
    """Some characters vanish, others become blanks."""
    return T.squeeze(F.translate(F.translate(c, DELETE, ""), STRIP, " " * len(STRIP)))


def normalize_name(c: Column) -> Column:
    """The whole chain, in its order."""
    c = strip_procedural(T.strip_honorifics(c))
    c = F.replace(strip_name_prefixes(c), F.lit("&"), F.lit(" and "))
    return T.squeeze(T.strip_corp_suffixes(F.lower(clean_chars(replace_regex(c)))))


def strip_trailing_address(c: Column) -> Column:
    """An address at the end goes, as long as two words stay before it."""
    cut = T.squeeze(F.regexp_replace(c, ADDRESS_TAIL, ""))
    return F.when(F.size(F.split(cut, " ")) >= 2, cut).otherwise(T.squeeze(c))


def preclean(c: Column) -> Column:
    """Null for header junk; what follows a cut mark goes."""
    return F.when(~c.rlike(JUNK), T.nz(F.regexp_replace(c, CUTS, "")))


def strip_trailing_procedural(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, TRAILING, ""))


def repair_name(c: Column) -> Column:
    """Cut at a dash that stands free, without trailing initials; a generational suffix stays."""
    head = F.trim(F.regexp_replace(strip_trailing_procedural(c), r"\s[-–]\s.*$", ""))
    suffix = F.regexp_extract(head, r"(?i)[\s,]+(jr|sr|ii|iii|iv)\.?$", 1)
    core = F.regexp_replace(head, r"(?i)[\s,]+(?:jr|sr|ii|iii|iv)\.?$", "")
    core = F.regexp_replace(core, r"(?:\s+[A-Za-z]\.?)+$", "")
    return F.trim(F.concat(core, F.when(suffix != "", F.concat(F.lit(" "), F.lower(suffix))).otherwise("")))


def _over(column, where: str = "raw_name is not null", name: str = "name"):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return read(spark, sf_dir, "mentions").filter(where).select("mention_id", column().alias(name))

    return query


def token_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What judge names say of each word: in how many it is, in how many last after initials or known first words, and whether it is prose.

    A word is prose if it is last in several names, and in more than it is cleanly last in.
    """
    m = read(spark, sf_dir, "mentions").filter("entity_type = 'judge' and normalized_name is not null")
    names = m.select(F.array_join(T.core_tokens(F.col("normalized_name")), " ").alias("name")).distinct().filter("name <> ''")
    w = names.select("name", F.split("name", " ").alias("w"))
    firsts = w.filter("size(w) > 1 and length(w[0]) > 1").select(F.col("w")[0].alias("word")).groupBy("word").agg(F.count("*").alias("first"))
    tail = w.select("name", F.element_at("w", -1).alias("word"), F.col("w")[0].alias("lead"), F.size("w").alias("n"))
    known = firsts.filter("first >= 3").select(F.col("word").alias("lead"), F.lit(1).alias("given"))
    ends = tail.join(known, "lead", "left").groupBy("word").agg(F.count("*").alias("last"), F.sum(F.when((F.col("n") > 1) & ((F.length("lead") == 1) | F.col("given").isNotNull()), 1).otherwise(0)).alias("clean"))
    seen = w.select(F.explode(F.array_distinct("w")).alias("word")).groupBy("word").agg(F.count("*").alias("seen"))
    out = seen.join(ends, "word", "left").join(firsts, "word", "left").na.fill(0, ["last", "clean", "first"])
    return out.select("word", "seen", "last", "clean", "first", ((F.col("last") >= 2) & (F.col("last") > F.col("clean"))).alias("prose"), ((F.col("clean") > 0) & (F.col("first") == 0)).alias("protected"))


def rescue_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of names of several words: a single word that is among them is a name after all."""
    t = T.tokens(F.col("normalized_name"))
    rows = read(spark, sf_dir, "mentions").filter("entity_type = 'judge' and normalized_name is not null").select(t.alias("t")).filter("size(t) > 1")
    return rows.select(F.explode("t").alias("word")).distinct()


def embed_trigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default embedder: hashed trigrams of the compact text, of length one, as "place:weight" of its filled places."""
    text = F.concat(F.lit("^"), F.lower(F.regexp_replace("normalized_name", "[^A-Za-z ]", "")), F.lit("$"))
    m = read(spark, sf_dir, "mentions").filter("entity_type = 'judge' and normalized_name is not null").select(text.alias("text")).distinct()
    grams = m.select("text", F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.length("text") - 2, F.lit(1))), lambda i: F.substring("text", i, 3))).alias("g"))
    code = F.ascii(F.substring("g", 1, 1)) * 961 + F.ascii(F.substring("g", 2, 1)) * 31 + F.ascii(F.substring("g", 3, 1))
    counts = grams.groupBy("text", (code % 64).cast("int").alias("place")).agg(F.count("*").alias("n"))
    norms = counts.groupBy("text").agg(F.sqrt(F.sum(F.col("n") * F.col("n"))).alias("norm"))
    return counts.join(norms, "text").select("text", "place", F.round(F.col("n") / F.col("norm"), 6).alias("weight"))


def edges_of(mentions: DataFrame, kind: str, where: str, **keys: Column) -> DataFrame:
    rows = mentions.filter((F.col("entity_type") == kind) & F.expr(where)).select("mention_id", *[T.nz(c).alias(n) for n, c in keys.items()])
    return star_edges(rows.na.drop(), list(keys))


def _edges(kind: str, where: str = "true", **keys):
    return lambda spark, sf_dir: edges_of(read(spark, sf_dir, "mentions"), kind, where, **{n: c() for n, c in keys.items()})


_FIRST2 = lambda: F.array_join(F.slice(T.tokens(F.col("normalized_name")), 1, 2), " ")


def conjunction_vetoes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges of equal judge name and court with their outcome: two directory numbers forbid a merge."""
    m = read(spark, sf_dir, "mentions")
    edges = edges_of(m, "judge", "token_count >= 2", name=F.col("normalized_name"), court=F.col("court"))
    nid = m.groupBy("mention_id").agg(F.min("fjc_nid").alias("nid"))
    both = edges.join(nid.select(F.col("mention_id").alias("mention_id_a"), F.col("nid").alias("na")), "mention_id_a").join(nid.select(F.col("mention_id").alias("mention_id_b"), F.col("nid").alias("nb")), "mention_id_b")
    conflict = F.coalesce(F.col("na") != F.col("nb"), F.lit(False))
    return both.select("mention_id_a", "mention_id_b", F.when(conflict, "NO_MATCH").otherwise("MERGE_TIER0").alias("decision"), F.when(conflict, "tier0.fjc_nid_conflict:name_court").otherwise("tier0.name_court").alias("method"))


def alias_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mention whose raw name states an alias, and the mentions of its case that bear the alias."""
    m = read(spark, sf_dir, "mentions").filter("entity_type <> 'judge' and ucid is not null and raw_name is not null")
    plain = lambda c: T.squeeze(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " "))
    pattern = r"(?i)[\s,(]+(?:f/k/a|a/k/a|d/b/a)\s+(.*?)\)?\s*$"
    stated = m.filter(F.col("raw_name").rlike(pattern)).select(F.col("mention_id").alias("mention_id_a"), "ucid", plain(F.regexp_extract("raw_name", pattern, 1)).alias("alias")).filter("alias <> ''")
    bearers = m.select(F.col("mention_id").alias("mention_id_b"), "ucid", plain(F.col("raw_name")).alias("alias"))
    return stated.join(bearers, ["ucid", "alias"]).filter("mention_id_a <> mention_id_b").select("mention_id_a", "mention_id_b", "alias").distinct()


def _journal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "decisions").filter("mention_id_a is not null and mention_id_b is not null and mention_id_a <> mention_id_b")


def coerced_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions as typed, in the fixed vocabulary; what is none of it is uncertain. A schema fault is named."""
    d = read(spark, sf_dir, "decisions").select("decision_id", F.upper(F.trim("decision")).alias("said"), "confidence", "signals").distinct()
    word = F.when(F.col("said").isin("YES", "SAME", "MATCH", "MERGE_TIER0", "MERGE_TIER2"), "MATCH").when(F.col("said").isin("NO", "DIFFERENT", "NO_MATCH"), "NO_MATCH").otherwise("UNCERTAIN")
    fault = F.when(F.col("said").isNull(), "no_decision").when(F.col("confidence").isNull(), "no_confidence").when(~F.col("confidence").between(0, 100), "confidence_range").otherwise("ok")
    return d.select("decision_id", word.alias("coerced"), fault.alias("fault"), F.size(F.coalesce("signals", F.array().cast("array<string>"))).alias("n_signals")).distinct()


def numbered_journal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Continuing numbers of the journal's different decisions, by time and id; each type counts for itself."""
    d = read(spark, sf_dir, "decisions").filter("decision_id is not null").groupBy("entity_type", "decision_id").agg(F.min("decided_at").alias("at"))
    order = Window.partitionBy("entity_type").orderBy(F.asc_nulls_first("at"), "decision_id")
    return d.select("decision_id", "entity_type", F.row_number().over(order).alias("number"))


def marginal_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Similarity merges that exact keys had not made: pairs whose ends are in different groups of the exact merges."""
    d = _journal(spark, sf_dir).select(F.upper(F.trim("decision")).alias("decision"), F.least("mention_id_a", "mention_id_b").alias("a"), F.greatest("mention_id_a", "mention_id_b").alias("b")).distinct()
    groups = connected_components(d.filter("decision = 'MERGE_TIER0'"))
    side = lambda s: groups.select(F.col("id").alias(s), F.col("component").alias(f"group_{s}"))
    pairs = d.filter("decision = 'MERGE_TIER2'").join(side("a"), "a", "left").join(side("b"), "b", "left")
    new = ~F.coalesce(F.col("group_a") == F.col("group_b"), F.lit(False))
    return pairs.agg(F.count("*").alias("tier2_pairs"), F.coalesce(F.sum(new.cast("bigint")), F.lit(0)).alias("marginal"))


def routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why an uncertain pair is not sent on: it was decided elsewhere, its courts differ, or a name is too short; else it is routed."""
    d = _journal(spark, sf_dir).select("decision_id", F.upper(F.trim("decision")).alias("decision"), F.least("mention_id_a", "mention_id_b").alias("a"), F.greatest("mention_id_a", "mention_id_b").alias("b")).distinct()
    merged = d.filter("decision in ('MATCH', 'MERGE_TIER0', 'MERGE_TIER2')").select("a", "b", F.lit(True).alias("merged")).distinct()
    m = read(spark, sf_dir, "mentions").groupBy("mention_id").agg(F.min("court").alias("court"), F.max("token_count").alias("words"))
    side = lambda s: m.select(F.col("mention_id").alias(s), F.col("court").alias(f"court_{s}"), F.col("words").alias(f"words_{s}"))
    open_ = d.filter("decision = 'UNCERTAIN'").join(merged, ["a", "b"], "left").join(side("a"), "a").join(side("b"), "b")
    route = F.when(F.col("merged"), "SKIP_ALREADY_MERGED").when(F.coalesce(F.col("court_a") != F.col("court_b"), F.lit(True)), "SKIP_NOT_SAME_BLOCK").when(F.least("words_a", "words_b") < 2, "SKIP_HYGIENE").otherwise("ROUTED")
    return open_.select("decision_id", route.alias("route")).distinct()


def error_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per configuration: attempts, failures, and whether failures pass a tenth after a hundred attempts, which ends a run."""
    d = read(spark, sf_dir, "decisions").groupBy("config_version").agg(F.count("*").alias("attempts"), F.sum(F.when(F.upper(F.trim("decision")).isin("TIER3_ERROR", "ERROR") | F.col("decision").isNull(), 1).otherwise(0)).alias("failures"))
    return d.select("config_version", "attempts", "failures", ((F.col("attempts") >= 100) & (F.col("failures") * 10 > F.col("attempts"))).alias("abort"))


def parsed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix, largest number and count of the registry's ids."""
    e = read(spark, sf_dir, "entities").filter("sjid is not null").select("sjid").distinct()
    e = e.select(F.regexp_extract("sjid", "^([A-Za-z]+)([0-9]+)$", 1).alias("prefix"), F.regexp_extract("sjid", "^([A-Za-z]+)([0-9]+)$", 2).alias("serial")).filter("serial <> ''")
    return e.groupBy("prefix").agg(F.max(F.col("serial").cast("bigint")).alias("last"), F.count("*").alias("ids"))


def sibling_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry rows without a place or domain, completed from other rows of their id."""
    e = read(spark, sf_dir, "entities").filter("sjid is not null")
    best = e.groupBy("sjid").agg(F.min(T.nz("office_state")).alias("state"), F.min(T.nz("office_city")).alias("city"), F.max(F.size(F.coalesce("domains", F.array().cast("array<string>")))).alias("n_domains"))
    return e.select("entity_id", "sjid", T.nz("office_state").alias("s"), T.nz("office_city").alias("c")).join(best, "sjid").select("entity_id", "sjid", F.coalesce("s", "state").alias("office_state"), F.coalesce("c", "city").alias("office_city"), "n_domains").distinct()


def snippets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each document that names its case's judge: 200 characters before and after the first place."""
    d = read(spark, sf_dir, "documents").filter("ucid is not null and text is not null").select("doc_id", "ucid", F.lower("text").alias("t"))
    j = read(spark, sf_dir, "mentions").filter("entity_type = 'judge' and ucid is not null and length(trim(surname)) > 3").select("ucid", F.lower(F.trim("surname")).alias("name")).distinct()
    hit = d.join(j, "ucid").select("doc_id", "name", "t", F.expr("locate(name, t)").alias("at")).filter("at > 0")
    return hit.select("doc_id", "name", F.expr("substring(t, greatest(at - 200, 1), at - greatest(at - 200, 1) + length(name) + 200)").alias("snippet"))


def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many incoming names the history has: as they are, or by court, surname and first initial."""
    key = [F.coalesce("court", F.lit("")).alias("court"), "entity_type"]
    parts = lambda df: df.filter("normalized_name is not null").select(*key, F.lower(F.trim("normalized_name")).alias("name")).distinct()
    soft = F.concat_ws("|", T.surname(F.col("name")), F.substring("name", 1, 1))
    new, old = parts(read(spark, sf_dir, "incoming_mentions")).withColumn("soft", soft), parts(read(spark, sf_dir, "mentions")).withColumn("soft", soft)
    exact = new.join(old.select("court", "entity_type", "name").withColumn("exact", F.lit(1)), ["court", "entity_type", "name"], "left")
    both = exact.join(old.select("court", "entity_type", "soft").distinct().withColumn("near", F.lit(1)), ["court", "entity_type", "soft"], "left")
    return both.groupBy("entity_type").agg(F.count("*").alias("names"), F.count("exact").alias("exact"), F.count(F.when(F.col("exact").isNull(), F.col("near"))).alias("soft"))


def before_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same measures over the first twenty batches and over all, side by side."""
    m = read(spark, sf_dir, "mentions")
    measure = lambda df, label: df.groupBy("entity_type").agg(F.count_distinct("mention_id").alias(f"mentions_{label}"), F.count_distinct("normalized_name").alias(f"names_{label}"), F.count_distinct("ucid").alias(f"cases_{label}"))
    return measure(m, "after").join(measure(m.filter("batch_no <= 20"), "before"), "entity_type", "left")


def taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Journal rows by what is wrong with them."""
    kind = F.when(F.col("mention_id_a").isNull() | F.col("mention_id_b").isNull(), "missing_id").when(F.col("mention_id_a") == F.col("mention_id_b"), "self_pair").when(F.col("decision").isNull(), "no_decision").when(F.col("confidence").isNull(), "no_confidence").otherwise("sound")
    return read(spark, sf_dir, "decisions").groupBy("entity_type", kind.alias("kind")).agg(F.count("*").alias("rows"))


def exploded_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source kind list_of_strings: each filled entry of a list, with its place."""
    m = read(spark, sf_dir, "mentions").filter("co_mentions is not null").select("mention_id", "co_mentions").distinct()
    return m.select("mention_id", F.posexplode("co_mentions").alias("place", "value")).filter("trim(value) <> ''")


def stable_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry ids by stable key: the number, a firm's own domain, or name and court; keys that name several ids are marked."""
    e = read(spark, sf_dir, "entities").filter("sjid is not null")
    first = lambda c: F.array_min(F.col(c))
    key = F.coalesce(F.concat(F.lit("nid:"), first("fjc_nids").cast("string")), F.when(F.col("entity_type") == "firm", F.concat(F.lit("dom:"), first("domains"), F.lit("|"), "normalized_name")), F.concat(F.lit("nc:"), F.col("normalized_name"), F.lit("|"), F.coalesce(first("courts"), F.lit(""))))
    return e.select("entity_type", key.alias("stable_key"), "sjid").filter("stable_key is not null").groupBy("entity_type", "stable_key").agg(F.min("sjid").alias("sjid"), (F.count_distinct("sjid") > 1).alias("clash"))


QUERIES = {
    "strip_name_prefixes": _over(lambda: strip_name_prefixes(F.lower("raw_name"))),
    "replace_tokens": _over(lambda: T.squeeze(F.replace("raw_name", F.lit("&"), F.lit(" and ")))),
    "replace_regex": _over(lambda: replace_regex(F.col("raw_name"))),
    "strip_procedural": _over(lambda: strip_procedural(F.coalesce("office_name", "raw_name"))),
    "clean_chars": _over(lambda: clean_chars(F.col("raw_name"))),
    "normalize_name": _over(lambda: normalize_name(F.col("raw_name"))),
    "strip_trailing_address": _over(lambda: strip_trailing_address(F.coalesce("office_name", "raw_name"))),
    "embed_text": _over(lambda: F.concat_ws(" ", F.lit("Judge:"), "presentable_name", "court", F.col("year").cast("string")), "entity_type = 'judge'", "text"),
    "drop_literals": lambda spark, sf_dir: read(spark, sf_dir, "mentions").filter(~F.lower(F.trim(F.replace("raw_name", F.lit("."), F.lit("")))).isin(LITERALS)).select("mention_id").distinct(),
    "preclean_junk": _over(lambda: preclean(F.col("raw_name"))),
    "strip_trailing_procedural": _over(lambda: strip_trailing_procedural(F.col("raw_name"))),
    "repair_name": _over(lambda: repair_name(F.col("raw_name")), "entity_type = 'judge' and raw_name is not null"),
    "token_profile": token_profile,
    "rescue_sets": rescue_sets,
    "embed_trigrams": embed_trigrams,
    "tier0_judge_name_office_court": _edges("judge", "token_count >= 2", name=lambda: F.col("normalized_name"), office=lambda: F.col("office_name"), court=lambda: F.col("court")),
    "tier0_firm_first2_domain": _edges("firm", "token_count >= 2", first2=_FIRST2, domain=lambda: F.col("domain")),
    "tier0_party_core_court": _edges("party", "true", core=lambda: F.when(T.office_class(F.col("raw_name")) == "corporate", T.corp_core(F.col("raw_name"))), court=lambda: F.col("court")),
    "conjunction_vetoes": conjunction_vetoes,
    "alias_links": alias_links,
    "coerced_decisions": coerced_decisions,
    "numbered_journal": numbered_journal,
    "marginal_recall": marginal_recall,
    "routing": routing,
    "error_rate": error_rate,
    "parsed_ids": parsed_ids,
    "sibling_fill": sibling_fill,
    "snippets": snippets,
    "coverage": coverage,
    "before_after": before_after,
    "taxonomy": taxonomy,
    "list_of_strings": exploded_strings,
    "stable_keys": stable_keys,
}

_TITLES = "the honorable|magistrate judge|chief judge|honorable|justice|judge|hon|mrs|mr|ms|dr"
_SUFFIX = "incorporated|corporation|company|limited|corp|pllc|inc|llc|llp|ltd|plc|co|lp|pc|pa"
_TOK = r"list_filter(string_split(trim(regexp_replace(lower(normalized_name), '\s+', ' ', 'g')), ' '), lambda t: t <> '')"
_CORE = _TOK.replace("t <> ''", "t NOT IN ('', 'jr', 'sr', 'ii', 'iii', 'iv')")


def _q(s: str) -> str:
    return s.replace("'", "''")


def _squeeze(x: str) -> str:
    return rf"trim(regexp_replace({x}, '\s+', ' ', 'g'))"


def _honor(x: str) -> str:
    low = _squeeze(f"lower({x})")
    return rf"trim(regexp_replace(regexp_replace(regexp_replace({low}, '^(?:(?:{_TITLES})[ .]+)+', ''), '(?:[ ,.]+(?:{_TITLES})\.?)+$', ''), '^(?:{_TITLES})\.?$', ''))"


def _proc(x: str) -> str:
    for _ in range(2):
        for p in PROCEDURAL:
            x = f"regexp_replace({x}, '(?is){p}', '')"
    return f"trim({x})"


def _regexes(x: str) -> str:
    for p, by in REPLACE_REGEX:
        x = f"regexp_replace({x}, '{_q(p)}', '{by}', 'g')"
    return x


def _chars(x: str) -> str:
    for ch in DELETE:
        x = f"replace({x}, '{_q(ch)}', '')"
    for ch in STRIP:
        x = f"replace({x}, '{ch}', ' ')"
    return _squeeze(x)


def _prefixes(x: str) -> str:
    return rf"trim(regexp_replace({x}, '^(?i)(?:(?:us |u\.s\. ?|us\. ?))+', ''))".replace("^(?i)", "(?i)^")


def _corp(x: str) -> str:
    return rf"regexp_replace(trim({x}), '(?i)(?:[ ,.]* (?:{_SUFFIX})\.?)+$', '')"


def _each(expression: str, where: str = "raw_name IS NOT NULL", name: str = "name") -> str:
    return f"SELECT mention_id, {expression} AS {name} FROM mentions WHERE {where}"


def _star_sql(rows: str, key: str) -> str:
    return f"WITH r AS ({rows}), k AS (SELECT mention_id, min(mention_id) OVER (PARTITION BY {key}) AS root FROM r) SELECT DISTINCT root AS mention_id_a, mention_id AS mention_id_b FROM k WHERE root <> mention_id"


_N = "nullif(trim({}), '')".format
_TRAIL = f"trim(regexp_replace(raw_name, '{TRAILING}', ''))"
_HEAD = rf"trim(regexp_replace({_TRAIL}, '\s[-–]\s.*$', ''))"
_ADDR = _squeeze(f"regexp_replace(coalesce(office_name, raw_name), '{ADDRESS_TAIL}', '')")
_COREX = rf"array_to_string(string_split({_corp(_squeeze("regexp_replace(lower(raw_name), '[-–—]', ' ', 'g')"))}, ' ')[1:4], ' ')"
_CORP_CLASS = "CASE " + " ".join(f"WHEN regexp_matches(lower(raw_name), '{p}') THEN '{label}'" for label, p in T.OFFICE_CLASSES) + " END"
_J = "SELECT * FROM decisions WHERE mention_id_a IS NOT NULL AND mention_id_b IS NOT NULL AND mention_id_a <> mention_id_b"
_PAIRS = f"SELECT DISTINCT decision_id, upper(trim(decision)) AS decision, least(mention_id_a, mention_id_b) AS a, greatest(mention_id_a, mention_id_b) AS b FROM ({_J})"
_PLAIN = "trim(regexp_replace(lower({}), '[^a-z0-9]+', ' ', 'g'))".format
SQL = {
    "strip_name_prefixes": _each(_prefixes("lower(raw_name)")),
    "replace_tokens": _each(_squeeze("replace(raw_name, '&', ' and ')")),
    "replace_regex": _each(_regexes("raw_name")),
    "strip_procedural": _each(_proc("coalesce(office_name, raw_name)")),
    "clean_chars": _each(_chars("raw_name")),
    "normalize_name": _each(_squeeze(_corp("lower(" + _chars(_regexes("replace(" + _prefixes(_proc(_honor("raw_name"))) + ", '&', ' and ')")) + ")"))),
    "strip_trailing_address": _each(f"CASE WHEN len(string_split({_ADDR}, ' ')) >= 2 THEN {_ADDR} ELSE {_squeeze('coalesce(office_name, raw_name)')} END"),
    "embed_text": _each("concat_ws(' ', 'Judge:', presentable_name, court, CAST(year AS VARCHAR))", "entity_type = 'judge'", "text"),
    "drop_literals": f"SELECT DISTINCT mention_id FROM mentions WHERE lower(trim(replace(raw_name, '.', ''))) NOT IN ({', '.join(f'{chr(39)}{x}{chr(39)}' for x in LITERALS)})",
    "preclean_junk": _each(f"CASE WHEN NOT regexp_matches(raw_name, '{JUNK}') THEN nullif(trim(regexp_replace(raw_name, '{CUTS}', '')), '') END"),
    "strip_trailing_procedural": _each(_TRAIL),
    "repair_name": rf"""WITH h AS (SELECT mention_id, {_HEAD} AS head FROM mentions WHERE entity_type = 'judge' AND raw_name IS NOT NULL)
      SELECT mention_id, trim(regexp_replace(regexp_replace(head, '(?i)[\s,]+(?:jr|sr|ii|iii|iv)\.?$', ''), '(?:\s+[A-Za-z]\.?)+$', '') || CASE WHEN regexp_extract(head, '(?i)[\s,]+(jr|sr|ii|iii|iv)\.?$', 1) <> '' THEN ' ' || lower(regexp_extract(head, '(?i)[\s,]+(jr|sr|ii|iii|iv)\.?$', 1)) ELSE '' END) AS name FROM h""",
    "token_profile": f"""WITH n AS (SELECT DISTINCT array_to_string({_CORE}, ' ') AS name FROM mentions WHERE entity_type = 'judge' AND normalized_name IS NOT NULL), w AS (SELECT name, string_split(name, ' ') AS w FROM n WHERE name <> ''),
      f AS (SELECT w[1] AS word, count(*) AS first FROM w WHERE len(w) > 1 AND length(w[1]) > 1 GROUP BY w[1]),
      e AS (SELECT w[-1] AS word, count(*) AS last, CAST(sum(CASE WHEN len(w) > 1 AND (length(w[1]) = 1 OR coalesce(f.first, 0) >= 3) THEN 1 ELSE 0 END) AS BIGINT) AS clean FROM w LEFT JOIN f ON f.word = w[1] GROUP BY w[-1]),
      s AS (SELECT word, count(*) AS seen FROM (SELECT unnest(list_distinct(w)) AS word FROM w) GROUP BY word),
      o AS (SELECT s.word, seen, coalesce(last, 0) AS last, coalesce(clean, 0) AS clean, coalesce(first, 0) AS first FROM s LEFT JOIN e ON e.word = s.word LEFT JOIN f ON f.word = s.word)
      SELECT *, last >= 2 AND last > clean AS prose, clean > 0 AND first = 0 AS protected FROM o""",
    "rescue_sets": f"SELECT DISTINCT unnest(t) AS word FROM (SELECT {_TOK} AS t FROM mentions WHERE entity_type = 'judge' AND normalized_name IS NOT NULL) WHERE len(t) > 1",
    "embed_trigrams": """WITH m AS (SELECT DISTINCT '^' || lower(regexp_replace(normalized_name, '[^A-Za-z ]', '', 'g')) || '$' AS text FROM mentions WHERE entity_type = 'judge' AND normalized_name IS NOT NULL),
      g AS (SELECT text, substr(text, i, 3) AS g FROM (SELECT text, unnest(range(1, greatest(length(text) - 2, 1) + 1)) AS i FROM m)),
      c AS (SELECT text, CAST((ascii(substr(g, 1, 1)) * 961 + ascii(substr(g, 2, 1)) * 31 + ascii(substr(g, 3, 1))) % 64 AS INTEGER) AS place, count(*) AS n FROM g GROUP BY ALL)
      SELECT text, place, round(n / sqrt(sum(n * n) OVER (PARTITION BY text)), 6) AS weight FROM c""",
    "tier0_judge_name_office_court": _star_sql(f"SELECT mention_id, normalized_name AS name, office_name AS office, court FROM mentions WHERE entity_type = 'judge' AND token_count >= 2 AND {_N('normalized_name')} IS NOT NULL AND {_N('office_name')} IS NOT NULL AND {_N('court')} IS NOT NULL", "trim(name), trim(office), trim(court)"),
    "tier0_firm_first2_domain": _star_sql(f"SELECT * FROM (SELECT mention_id, array_to_string({_TOK}[1:2], ' ') AS first2, {_N('domain')} AS domain FROM mentions WHERE entity_type = 'firm' AND token_count >= 2) WHERE first2 <> '' AND domain IS NOT NULL", "first2, domain"),
    "tier0_party_core_court": _star_sql(f"SELECT * FROM (SELECT mention_id, trim({_COREX}) AS core, {_N('court')} AS court FROM mentions WHERE entity_type = 'party' AND {_CORP_CLASS} = 'corporate') WHERE core <> '' AND court IS NOT NULL", "core, court"),
    "conjunction_vetoes": "WITH e AS (" + _star_sql(f"SELECT mention_id, {_N('normalized_name')} AS name, {_N('court')} AS court FROM mentions WHERE entity_type = 'judge' AND token_count >= 2 AND {_N('normalized_name')} IS NOT NULL AND {_N('court')} IS NOT NULL", "name, court")
    + """), n AS (SELECT mention_id, min(fjc_nid) AS nid FROM mentions GROUP BY mention_id)
      SELECT mention_id_a, mention_id_b, CASE WHEN coalesce(x.nid <> y.nid, false) THEN 'NO_MATCH' ELSE 'MERGE_TIER0' END AS decision, CASE WHEN coalesce(x.nid <> y.nid, false) THEN 'tier0.fjc_nid_conflict:name_court' ELSE 'tier0.name_court' END AS method
      FROM e JOIN n x ON x.mention_id = mention_id_a JOIN n y ON y.mention_id = mention_id_b""",
    "alias_links": rf"""WITH m AS (SELECT * FROM mentions WHERE entity_type <> 'judge' AND ucid IS NOT NULL AND raw_name IS NOT NULL),
      s AS (SELECT mention_id, ucid, {_PLAIN(r"regexp_extract(raw_name, '(?i)[\s,(]+(?:f/k/a|a/k/a|d/b/a)\s+(.*?)\)?\s*$', 1)")} AS alias FROM m WHERE regexp_matches(raw_name, '(?i)[\s,(]+(?:f/k/a|a/k/a|d/b/a)\s+(.*?)\)?\s*$'))
      SELECT DISTINCT s.mention_id AS mention_id_a, m.mention_id AS mention_id_b, alias FROM s JOIN m ON m.ucid = s.ucid AND {_PLAIN('m.raw_name')} = alias WHERE alias <> '' AND s.mention_id <> m.mention_id""",
    "coerced_decisions": """SELECT DISTINCT decision_id, CASE WHEN said IN ('YES', 'SAME', 'MATCH', 'MERGE_TIER0', 'MERGE_TIER2') THEN 'MATCH' WHEN said IN ('NO', 'DIFFERENT', 'NO_MATCH') THEN 'NO_MATCH' ELSE 'UNCERTAIN' END AS coerced,
      CASE WHEN said IS NULL THEN 'no_decision' WHEN confidence IS NULL THEN 'no_confidence' WHEN confidence NOT BETWEEN 0 AND 100 THEN 'confidence_range' ELSE 'ok' END AS fault, CAST(coalesce(len(signals), 0) AS INTEGER) AS n_signals FROM (SELECT *, upper(trim(decision)) AS said FROM decisions)""",
    "numbered_journal": "SELECT decision_id, entity_type, CAST(row_number() OVER (PARTITION BY entity_type ORDER BY decided NULLS FIRST, decision_id) AS INTEGER) AS number FROM (SELECT entity_type, decision_id, min(decided_at) AS decided FROM decisions WHERE decision_id IS NOT NULL GROUP BY ALL)",
    "marginal_recall": f"""WITH RECURSIVE d AS (SELECT DISTINCT decision, a, b FROM ({_PAIRS})), e AS (SELECT a, b FROM d WHERE decision = 'MERGE_TIER0' UNION SELECT b, a FROM d WHERE decision = 'MERGE_TIER0'),
      reach(id, other) AS (SELECT a, a FROM e UNION SELECT reach.id, e.b FROM reach JOIN e ON e.a = reach.other), g AS (SELECT id, min(other) AS c FROM reach GROUP BY id)
      SELECT count(*) AS tier2_pairs, CAST(coalesce(sum(CASE WHEN coalesce(x.c = y.c, false) THEN 0 ELSE 1 END), 0) AS BIGINT) AS marginal FROM d LEFT JOIN g x ON x.id = a LEFT JOIN g y ON y.id = b WHERE decision = 'MERGE_TIER2'""",
    "routing": f"""WITH d AS ({_PAIRS}), k AS (SELECT DISTINCT a, b, true AS merged FROM d WHERE decision IN ('MATCH', 'MERGE_TIER0', 'MERGE_TIER2')), m AS (SELECT mention_id, min(court) AS court, max(token_count) AS words FROM mentions GROUP BY mention_id)
      SELECT DISTINCT decision_id, CASE WHEN merged THEN 'SKIP_ALREADY_MERGED' WHEN coalesce(x.court <> y.court, true) THEN 'SKIP_NOT_SAME_BLOCK' WHEN least(x.words, y.words) < 2 THEN 'SKIP_HYGIENE' ELSE 'ROUTED' END AS route
      FROM d LEFT JOIN k USING (a, b) JOIN m x ON x.mention_id = a JOIN m y ON y.mention_id = b WHERE decision = 'UNCERTAIN'""",
    "error_rate": "SELECT *, attempts >= 100 AND failures * 10 > attempts AS abort FROM (SELECT config_version, count(*) AS attempts, CAST(sum(CASE WHEN upper(trim(decision)) IN ('TIER3_ERROR', 'ERROR') OR decision IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS failures FROM decisions GROUP BY config_version)",
    "parsed_ids": "SELECT regexp_extract(sjid, '^([A-Za-z]+)([0-9]+)$', 1) AS prefix, max(CAST(regexp_extract(sjid, '^([A-Za-z]+)([0-9]+)$', 2) AS BIGINT)) AS last, count(*) AS ids FROM (SELECT DISTINCT sjid FROM entities WHERE regexp_matches(sjid, '^[A-Za-z]+[0-9]+$')) GROUP BY 1",
    "sibling_fill": f"""WITH b AS (SELECT sjid, min({_N('office_state')}) AS state, min({_N('office_city')}) AS city, CAST(max(coalesce(len(domains), 0)) AS INTEGER) AS n_domains FROM entities WHERE sjid IS NOT NULL GROUP BY sjid)
      SELECT DISTINCT entity_id, sjid, coalesce({_N('office_state')}, state) AS office_state, coalesce({_N('office_city')}, city) AS office_city, n_domains FROM entities JOIN b USING (sjid)""",
    "snippets": """WITH j AS (SELECT DISTINCT ucid, lower(trim(surname)) AS name FROM mentions WHERE entity_type = 'judge' AND ucid IS NOT NULL AND length(trim(surname)) > 3), d AS (SELECT doc_id, ucid, lower(text) AS t FROM documents WHERE ucid IS NOT NULL AND text IS NOT NULL),
      h AS (SELECT doc_id, name, t, strpos(t, name) AS pos FROM d JOIN j USING (ucid)) SELECT doc_id, name, substr(t, greatest(pos - 200, 1), pos - greatest(pos - 200, 1) + length(name) + 200) AS snippet FROM h WHERE pos > 0""",
    "coverage": rf"""WITH p AS (SELECT DISTINCT src, coalesce(court, '') AS court, entity_type, lower(trim(normalized_name)) AS name FROM (SELECT 1 AS src, court, entity_type, normalized_name FROM incoming_mentions UNION ALL SELECT 0, court, entity_type, normalized_name FROM mentions) WHERE normalized_name IS NOT NULL),
      s AS (SELECT *, concat_ws('|', {_CORE.replace('normalized_name', 'name')}[-1], substr(name, 1, 1)) AS soft FROM p),
      n AS (SELECT a.entity_type, EXISTS (SELECT 1 FROM s b WHERE b.src = 0 AND b.court = a.court AND b.entity_type = a.entity_type AND b.name = a.name) AS ex, EXISTS (SELECT 1 FROM s b WHERE b.src = 0 AND b.court = a.court AND b.entity_type = a.entity_type AND b.soft = a.soft) AS near FROM s a WHERE src = 1)
      SELECT entity_type, count(*) AS names, count(*) FILTER (ex) AS exact, count(*) FILTER (near AND NOT ex) AS soft FROM n GROUP BY entity_type""",
    "before_after": """SELECT entity_type, count(DISTINCT mention_id) AS mentions_after, count(DISTINCT normalized_name) AS names_after, count(DISTINCT ucid) AS cases_after,
      nullif(count(DISTINCT mention_id) FILTER (batch_no <= 20), 0) AS mentions_before, CASE WHEN count(*) FILTER (batch_no <= 20) > 0 THEN count(DISTINCT normalized_name) FILTER (batch_no <= 20) END AS names_before, CASE WHEN count(*) FILTER (batch_no <= 20) > 0 THEN count(DISTINCT ucid) FILTER (batch_no <= 20) END AS cases_before FROM mentions GROUP BY entity_type""",
    "taxonomy": "SELECT entity_type, CASE WHEN mention_id_a IS NULL OR mention_id_b IS NULL THEN 'missing_id' WHEN mention_id_a = mention_id_b THEN 'self_pair' WHEN decision IS NULL THEN 'no_decision' WHEN confidence IS NULL THEN 'no_confidence' ELSE 'sound' END AS kind, count(*) AS rows FROM decisions GROUP BY ALL",
    "list_of_strings": "SELECT mention_id, CAST(place - 1 AS INTEGER) AS place, value FROM (SELECT mention_id, unnest(co_mentions) AS value, generate_subscripts(co_mentions, 1) AS place FROM (SELECT DISTINCT mention_id, co_mentions FROM mentions WHERE co_mentions IS NOT NULL)) WHERE trim(value) <> ''",
    "stable_keys": """SELECT entity_type, stable_key, min(sjid) AS sjid, count(DISTINCT sjid) > 1 AS clash FROM (SELECT entity_type, sjid, coalesce('nid:' || CAST(list_min(fjc_nids) AS VARCHAR), CASE WHEN entity_type = 'firm' THEN 'dom:' || list_min(domains) || '|' || normalized_name END,
      'nc:' || normalized_name || '|' || coalesce(list_min(courts), '')) AS stable_key FROM entities WHERE sjid IS NOT NULL) WHERE stable_key IS NOT NULL GROUP BY entity_type, stable_key""",
}
