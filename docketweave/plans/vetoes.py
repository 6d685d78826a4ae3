"""Pair vetoes: facts of each name computed once per row, predicates over two rows, and the ordered verdict.

A pair meets by court and the first or last word of its names (parties, firms), or by court and surname (judges). Every
predicate is a Boolean expression over the facts of both sides (suffixes _a and _b), so all vetoes of a pair are one
projection after one join. Large blocks are split (operators.skew).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketweave.functions import text as T
from docketweave.operators.skew import split_sides
from docketweave.plans.normalisation import _form_case
from docketweave.session import read

# Words of the identity exclusions.
STOP = ["and", "of", "the", "for", "to", "a", "an", "in", "at", "as", "by", "co", "inc", "corp", "llc", "ltd", "l", "p", "c", "et", "al", "no"]
GENERIC = ["gasket", "industries", "services", "fund", "trust", "holdings", "products", "manufacturing", "supply", "equipment", "group", "partners", "associates", "international", "national", "american", "asbestos", "liability", "specialty", "systems", "lines", "bank", "usa", "na", "us", "product", "world", "enterprises"]
SUBUNITS = ["department", "dept", "police", "fire", "sheriff", "office", "bureau", "commission", "committee", "agency", "authority", "board", "division", "unit", "precinct", "shareholder"]
PLAN_MARKERS = ["fund", "trust", "plan"]
PLAN_TYPES = ["health", "welfare", "pension", "retirement", "savings", "annuity", "security", "vacation", "apprenticeship", "training"]
JURISDICTIONS = ["commonwealth of", "district of", "village of", "borough of", "county of", "state of", "city of", "town of"]
DIVISIONS = ["/division", " division", "/services", "subsidiary", "sub,", "subfund", " group", "/group"]
PLAINTIFFS, DEFENDANTS = ["plaintiff", "petitioner", "appellant"], ["defendant", "respondent", "appellee"]
FIRM_STOP = ["llp", "llc", "pc", "pa", "ltd", "inc", "pllc", "lpa", "law", "firm", "office", "offices", "associates", "group", "p", "c", "and", "of", "the"]
DOE = r"\b(john|jane)\s*/?\s*(john|jane)?\s*does?\b|\bdoes?\s+[0-9]|\bdoe\s+subscriber\b"
GENERIC_ALL = sorted({*GENERIC, *T.CORP_SUFFIXES, *STOP})


def _in(words: list[str]) -> str:
    return ", ".join(f"'{w}'" for w in words)


_JURISDICTION = "^(" + "|".join(JURISDICTIONS) + ")( .*)?$"


def party_facts(mentions: DataFrame, kind: str = "party") -> DataFrame:
    """One row per court and name: what the identity vetoes look at. A value that several mentions give is the smallest."""
    m = mentions.filter((F.col("entity_type") == kind) & F.col("normalized_name").isNotNull() & F.col("court").isNotNull())
    low = lambda c: F.min(F.lower(F.trim(c)))
    m = m.groupBy("court", F.lower(F.trim("normalized_name")).alias("name")).agg(
        low("raw_name").alias("raw"), F.min(T.nz("ucid")).alias("ucid"), low("party_role").alias("role"), F.min(T.nz("pacer_id")).alias("pacer"), F.min(T.legal_form(F.col("raw_name"))).alias("form"),
        F.min(T.domain_key(F.col("domain"))).alias("domain"), F.min(T.phone_key(F.col("phone"))).alias("phone"), F.min(T.address_key(F.col("address"))).alias("address"), F.min(T.office_geo(F.col("address"))).alias("geo"),
    )
    words = F.filter(F.split(F.regexp_replace("name", "[^a-z0-9]+", " "), " "), lambda t: (t != "") & ~t.isin(STOP))
    m = m.withColumn("toks", words).withColumn("cls", T.office_class(F.coalesce("raw", "name")))
    return m.select(
        "*",
        F.array_distinct(F.filter("toks", lambda t: ~t.isin(GENERIC_ALL))).alias("dist"), F.array_distinct(F.filter("toks", lambda t: t.isin(GENERIC_ALL))).alias("gen"),
        F.array_sort(F.array_distinct(F.transform(F.filter(F.split(F.regexp_replace(F.concat_ws(" ", "name", "raw"), "[^a-z0-9]+", " "), " "), lambda t: t.isin("jr", "sr", "ii", "iii", "iv", "2nd", "3rd", "4th", "junior", "senior")), lambda t: F.when(t == "junior", "jr").when(t == "senior", "sr").otherwise(t)))).alias("gens"),
        F.when(F.arrays_overlap("toks", F.array(*map(F.lit, PLAN_MARKERS))), F.filter("toks", lambda t: t.isin(PLAN_TYPES))).otherwise(F.array().cast("array<string>")).alias("plans"),
        F.when(F.col("name").rlike(_JURISDICTION), F.trim(F.regexp_replace(F.regexp_extract("name", _JURISDICTION, 2), r"\b(ex|rel)\b", ""))).alias("rest"),
        F.filter(F.array(*map(F.lit, DIVISIONS)), lambda d: F.contains(F.concat(F.lit(" "), F.concat_ws(" ", "name", "raw"), F.lit(" ")), d)).alias("divisions"),
        F.concat_ws(" ", "name", "raw").rlike(DOE).alias("doe"),
        F.when(F.arrays_overlap(F.split("role", "[^a-z]+"), F.array(*map(F.lit, PLAINTIFFS))), "p").when(F.arrays_overlap(F.split("role", "[^a-z]+"), F.array(*map(F.lit, DEFENDANTS))), "d").alias("side"),
        F.coalesce(F.col("raw").rlike("^p/o([^a-z]|$)"), F.lit(False)).alias("title"),
        F.when(F.col("raw").rlike("[a-z]{3,}.*/|/.*[a-z]{3,}"), F.array_sort(F.transform(F.split("raw", "/"), lambda p: F.trim(F.replace(p, F.lit("-"), F.lit(" ")))))).alias("slashes"),
        F.filter(F.split(F.regexp_replace("name", "[^a-z0-9]+", " "), " "), lambda t: (F.length(t) >= 2) & ~t.isin(FIRM_STOP)).alias("content"),
    )


def party_pairs(facts: DataFrame) -> DataFrame:
    """Facts of both sides of every pair of names of a court that share their first or last word, name_a < name_b."""
    keyed = facts.withColumn("key", F.explode(F.array_distinct(F.filter(F.array(F.try_element_at("toks", F.lit(1)), F.try_element_at("toks", F.lit(-1))), lambda t: t.isNotNull()))))
    sizes = keyed.groupBy("court", "key").agg(F.count("*").alias("_n"))
    left, right = split_sides(keyed.join(sizes, ["court", "key"]), F.col("_n"), F.col("name"))
    columns = [c for c in facts.columns if c != "court"]
    a = left.select("court", "key", "piece_a", "piece_b", *[F.col(c).alias(f"{c}_a") for c in columns])
    b = right.select("court", "key", "piece_a", "piece_b", *[F.col(c).alias(f"{c}_b") for c in columns])
    met = a.join(b, ["court", "key", "piece_a", "piece_b"]).filter("name_a < name_b")
    # A pair that shares both words is kept under the smaller one.
    ends = lambda s: F.array(F.element_at(f"toks_{s}", 1), F.element_at(f"toks_{s}", -1))
    return met.filter(F.col("key") == F.array_min(F.array_intersect(ends("a"), ends("b")))).drop("key", "piece_a", "piece_b")



#: Predicates in the order in which the first counts: name -> (Spark SQL, DuckDB SQL).
IDENTITY: dict[str, tuple[str, str]] = {
    "corporate_shared_prefix": ("cls_a = 'corporate' and cls_b = 'corporate' and size(toks_a) > 1 and size(toks_b) > 1 and toks_a[0] = toks_b[0] and toks_a[1] <> toks_b[1]", "cls_a = 'corporate' and cls_b = 'corporate' and len(toks_a) > 1 and len(toks_b) > 1 and toks_a[1] = toks_b[1] and toks_a[2] <> toks_b[2]"),
    "government_jurisdiction": ("rest_a <> rest_b", "rest_a <> rest_b"),
    "fund_plan_type": ("size(plans_a) > 0 and size(plans_b) > 0 and not arrays_overlap(plans_a, plans_b)", "len(plans_a) > 0 and len(plans_b) > 0 and not list_has_any(plans_a, plans_b)"),
    "generational_suffix": ("gens_a <> gens_b and not ((size(gens_a) = 0 or size(gens_b) = 0) and coalesce(ucid_a = ucid_b and role_a = role_b, false))", "gens_a <> gens_b and not ((len(gens_a) = 0 or len(gens_b) = 0) and coalesce(ucid_a = ucid_b and role_a = role_b, false))"),
    "legal_entity_form": ("form_a <> form_b", "form_a <> form_b"),
    "division_subsidiary": ("divisions_a <> divisions_b or slashes_a <> slashes_b", "divisions_a <> divisions_b or slashes_a <> slashes_b"),
    "parent_subunit": (
        "(size(toks_a) < size(toks_b) and slice(toks_b, 1, size(toks_a)) = toks_a and (exists(slice(toks_b, size(toks_a) + 1, 99), t -> t in (SUB)) or size(filter(slice(toks_b, size(toks_a) + 1, 99), t -> t not in (GEN))) >= 2)) or (size(toks_b) < size(toks_a) and slice(toks_a, 1, size(toks_b)) = toks_b and (exists(slice(toks_a, size(toks_b) + 1, 99), t -> t in (SUB)) or size(filter(slice(toks_a, size(toks_b) + 1, 99), t -> t not in (GEN))) >= 2))",
        "(len(toks_a) < len(toks_b) and toks_b[1:len(toks_a)] = toks_a and (len(list_filter(toks_b[len(toks_a) + 1:], lambda t: t in (SUB))) > 0 or len(list_filter(toks_b[len(toks_a) + 1:], lambda t: t not in (GEN))) >= 2)) or (len(toks_b) < len(toks_a) and toks_a[1:len(toks_b)] = toks_b and (len(list_filter(toks_a[len(toks_b) + 1:], lambda t: t in (SUB))) > 0 or len(list_filter(toks_a[len(toks_b) + 1:], lambda t: t not in (GEN))) >= 2))",
    ),
    "generic_word_overlap": (
        "not arrays_overlap(dist_a, dist_b) and not exists(dist_a, t -> exists(dist_b, u -> least(length(t), length(u)) >= 5 and levenshtein(t, u) <= 1)) and arrays_overlap(gen_a, gen_b) and size(dist_a) + size(dist_b) > 0",
        "not list_has_any(dist_a, dist_b) and len(list_filter(dist_a, lambda t: len(list_filter(dist_b, lambda u: least(length(t), length(u)) >= 5 and levenshtein(t, u) <= 1)) > 0)) = 0 and list_has_any(gen_a, gen_b) and len(dist_a) + len(dist_b) > 0",
    ),
    "person_vs_org": ("not coalesce(pacer_a = pacer_b, false) and ((cls_a = 'other' and cls_b = 'corporate') or (cls_b = 'other' and cls_a = 'corporate')) and size(array_intersect(dist_a, dist_b)) < 2", "not coalesce(pacer_a = pacer_b, false) and ((cls_a = 'other' and cls_b = 'corporate') or (cls_b = 'other' and cls_a = 'corporate')) and len(list_intersect(dist_a, dist_b)) < 2"),
    "placeholder": ("doe_a or doe_b", "doe_a or doe_b"),
    "opposing_roles": ("not coalesce(pacer_a = pacer_b, false) and side_a <> side_b", "not coalesce(pacer_a = pacer_b, false) and side_a <> side_b"),
    "person_title_prefix": ("title_a <> title_b", "title_a <> title_b"),
}
#: Predicates beside the ordered ones.
BESIDE: dict[str, tuple[str, str]] = {
    "ucid_only": (
        "coalesce(ucid_a = ucid_b, false) and not coalesce(pacer_a = pacer_b, false) and not coalesce(domain_a = domain_b, false) and not coalesce(phone_a = phone_b, false) and not coalesce(address_a = address_b, false)",
    )
    * 2,
    "lacks_corroboration": (
        "not (coalesce(pacer_a = pacer_b, false) or coalesce(domain_a = domain_b, false) or coalesce(phone_a = phone_b, false) or coalesce(address_a = address_b, false) or (size(dist_a) > 0 and array_sort(dist_a) = array_sort(dist_b)))",
        "not (coalesce(pacer_a = pacer_b, false) or coalesce(domain_a = domain_b, false) or coalesce(phone_a = phone_b, false) or coalesce(address_a = address_b, false) or (len(dist_a) > 0 and list_sort(dist_a) = list_sort(dist_b)))",
    ),
    "compatible_name_core": ("size(dist_a) > 0 and size(dist_b) > 0 and size(array_intersect(dist_a, dist_b)) >= 0.8 * greatest(size(dist_a), size(dist_b))", "len(dist_a) > 0 and len(dist_b) > 0 and len(list_intersect(dist_a, dist_b)) >= 0.8 * greatest(len(dist_a), len(dist_b))"),
}
FIRMS: dict[str, tuple[str, str]] = {
    "firm_contacts_block": (
        "not (domain_a <=> domain_b) and not (phone_a <=> phone_b) and not (address_a <=> address_b) and not arrays_overlap(zip_with(content_a, slice(content_a, 2, 99), (x, y) -> coalesce(x || ' ' || y, '<')), zip_with(content_b, slice(content_b, 2, 99), (x, y) -> coalesce(x || ' ' || y, '>')))",
        "domain_a is distinct from domain_b and phone_a is distinct from phone_b and address_a is distinct from address_b and not list_has_any(list_transform(list_zip(content_a, content_a[2:]), lambda z: coalesce(z[1] || ' ' || z[2], '<')), list_transform(list_zip(content_b, content_b[2:]), lambda z: coalesce(z[1] || ' ' || z[2], '>')))",
    ),
    "institutional_geo": ("cls_a in ('public_defender', 'government') and cls_b in ('public_defender', 'government') and geo_a <> geo_b",) * 2,
    "private_cross_geo": (
        "cls_a not in ('public_defender', 'government') and cls_b not in ('public_defender', 'government') and geo_a <> geo_b and not coalesce(domain_a = domain_b, false) and not coalesce(phone_a = phone_b, false) and not coalesce(address_a = address_b, false)",
    )
    * 2,
}


def _fill(text: str) -> str:
    return text.replace("SUB", _in(SUBUNITS)).replace("GEN)", _in(GENERIC_ALL) + ")")


def pairs_of(spark: SparkSession, sf_dir: str, kind: str = "party") -> DataFrame:
    return party_pairs(party_facts(read(spark, sf_dir, "mentions"), kind))


def _only(name: str, table: dict[str, tuple[str, str]], kind: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return pairs_of(spark, sf_dir, kind).filter(_fill(table[name][0])).select("court", "name_a", "name_b")

    return query


def identity_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first identity veto of every candidate pair of parties with its method, ok where none applies, and all that apply."""
    pairs = pairs_of(spark, sf_dir)
    hit = [F.when(F.coalesce(F.expr(_fill(p)), F.lit(False)), F.lit(n)) for n, (p, _) in IDENTITY.items()]
    every = F.array_compact(F.array(*hit))
    return pairs.select("court", "name_a", "name_b", F.coalesce(*hit, F.lit("ok")).alias("verdict"), F.array_join(every, ",").alias("signals"), F.when(F.size(every) > 0, F.concat(F.lit("tier2."), F.coalesce(*hit))).alias("method"))


def judge_names(mentions: DataFrame) -> DataFrame:
    """(court, name, nid, w, first, last): different judge names of a court with the words that the name gate compares."""
    words = T.core_tokens(F.regexp_replace(F.lower("normalized_name"), "[^a-z0-9'-]+", " "))
    m = mentions.filter("entity_type = 'judge' and normalized_name is not null and court is not null").groupBy("court", F.lower(F.trim("normalized_name")).alias("name")).agg(F.min("fjc_nid").alias("nid"), F.min("normalized_name").alias("normalized_name"))
    return m.withColumn("w", words).filter("size(w) > 0").select("court", "name", "nid", "w", F.col("w")[0].alias("first"), F.element_at("w", -1).alias("last"))


def judge_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of judge names of one court whose last words begin alike."""
    j = judge_names(read(spark, sf_dir, "mentions")).withColumn("key", F.substring("last", 1, 2))
    side = lambda s: j.select("court", "key", *[F.col(c).alias(f"{c}_{s}") for c in ("name", "nid", "w", "first", "last")])
    return side("a").join(side("b"), ["court", "key"]).filter("name_a < name_b")


#: The name gate: what each part of it says of a pair of names.
GATE: dict[str, tuple[str, str]] = {
    "surnames_compatible": (
        "levenshtein(last_a, last_b) <= 1 or startswith(last_a, last_b || '-') or startswith(last_b, last_a || '-') or endswith(last_a, '-' || last_b) or endswith(last_b, '-' || last_a)",
        "levenshtein(last_a, last_b) <= 1 or starts_with(last_a, last_b || '-') or starts_with(last_b, last_a || '-') or ends_with(last_a, '-' || last_b) or ends_with(last_b, '-' || last_a)",
    ),
    "shared_distinctive_token": ("exists(array_intersect(w_a, w_b), t -> length(t) >= 3)", "len(list_filter(list_intersect(w_a, w_b), lambda t: length(t) >= 3)) > 0"),
    "given_names_incompatible": (
        "size(w_a) > 1 and size(w_b) > 1 and length(first_a) > 1 and length(first_b) > 1 and not startswith(first_a, first_b) and not startswith(first_b, first_a) and not array_contains(slice(w_b, 2, 99), first_a) and not array_contains(slice(w_a, 2, 99), first_b)",
        "len(w_a) > 1 and len(w_b) > 1 and length(first_a) > 1 and length(first_b) > 1 and not starts_with(first_a, first_b) and not starts_with(first_b, first_a) and not list_contains(w_b[2:], first_a) and not list_contains(w_a[2:], first_b)",
    ),
    "all_initials_incompatible": (
        "(forall(slice(w_a, 1, size(w_a) - 1), t -> length(t) = 1) and size(w_a) > 1 and size(w_b) > 1 and substring(first_a, 1, 1) <> substring(first_b, 1, 1)) or (forall(slice(w_b, 1, size(w_b) - 1), t -> length(t) = 1) and size(w_a) > 1 and size(w_b) > 1 and substring(first_a, 1, 1) <> substring(first_b, 1, 1))",
        "(len(list_filter(w_a[1:-2], lambda t: length(t) <> 1)) = 0 and len(w_a) > 1 and len(w_b) > 1 and substr(first_a, 1, 1) <> substr(first_b, 1, 1)) or (len(list_filter(w_b[1:-2], lambda t: length(t) <> 1)) = 0 and len(w_a) > 1 and len(w_b) > 1 and substr(first_a, 1, 1) <> substr(first_b, 1, 1))",
    ),
    "punct_fold_compatible": ("replace(array_join(w_a, ''), '-', '') = replace(array_join(w_b, ''), '-', '')", "replace(array_to_string(w_a, ''), '-', '') = replace(array_to_string(w_b, ''), '-', '')"),
    "truncated_span_missing_given": (
        "(size(w_a) = 2 and size(w_b) > 2 and size(array_except(w_a, w_b)) > 0 and length(first_b) > 1 and not array_contains(w_a, first_b) and array_contains(w_b, first_a)) or (size(w_b) = 2 and size(w_a) > 2 and size(array_except(w_b, w_a)) > 0 and length(first_a) > 1 and not array_contains(w_b, first_a) and array_contains(w_a, first_b))",
        "(len(w_a) = 2 and len(w_b) > 2 and len(list_filter(w_a, lambda t: not list_contains(w_b, t))) > 0 and length(first_b) > 1 and not list_contains(w_a, first_b) and list_contains(w_b, first_a)) or (len(w_b) = 2 and len(w_a) > 2 and len(list_filter(w_b, lambda t: not list_contains(w_a, t))) > 0 and length(first_a) > 1 and not list_contains(w_b, first_a) and list_contains(w_a, first_b))",
    ),
}
_COMPATIBLE = "(coalesce(nid_a = nid_b, false) or ({punct_fold_compatible}) or ((({surnames_compatible}) or ({shared_distinctive_token})) and not ({given_names_incompatible}) and not ({all_initials_incompatible}) and not ({truncated_span_missing_given})))"


def compatible(dialect: int) -> str:
    return _COMPATIBLE.format(**{n: p[dialect] for n, p in GATE.items()})


def name_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part of the name gate, and the whole, for every pair of judge names of a court."""
    flag = lambda e: F.coalesce(F.expr(e), F.lit(False))
    return judge_pairs(spark, sf_dir).select("court", "name_a", "name_b", *[flag(p).alias(n) for n, (p, _) in GATE.items()], flag(compatible(0)).alias("names_compatible"))


QUERIES = {f"veto_{n}": _only(n, IDENTITY, "party") for n in IDENTITY} | {f"pair_{n}": _only(n, BESIDE, "party") for n in BESIDE} | {f"pair_{n}": _only(n, FIRMS, "firm") for n in FIRMS} | {"identity_verdict": identity_verdict, "name_gate": name_gate}

_GEO = r"^\s*([A-Za-z .''-]+), ([A-Z]{2})(?: [0-9-]+)?\s*$"
_DIG = "regexp_replace(phone, '[^0-9]', '', 'g')"
_TEN = f"CASE WHEN length({_DIG}) = 11 AND starts_with({_DIG}, '1') THEN substr({_DIG}, 2, 10) ELSE {_DIG} END"


def _class_sql(x: str) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({x}, '{p}') THEN '{label}'" for label, p in T.OFFICE_CLASSES) + " ELSE 'other' END"


def _facts_sql(kind: str) -> str:
    plain = "list_filter(string_split(regexp_replace({}, '[^a-z0-9]+', ' ', 'g'), ' '), lambda t: {})"
    line = f"list_filter(list_transform(list_reverse(string_split(address, chr(10))), lambda s: regexp_extract(s, '{_GEO}', 0)), lambda s: s <> '')[1]"
    squeezed = r"trim(regexp_replace(regexp_replace(lower(address), '[^a-z0-9\s]', '', 'g'), '\s+', ' ', 'g'))"
    both = "concat_ws(' ', name, raw)"
    role = lambda words: f"list_has_any(string_split_regex(role, '[^a-z]+'), [{_in(words)}])"
    return rf"""WITH g AS (SELECT court, lower(trim(normalized_name)) AS name, min(lower(trim(raw_name))) AS raw, min(nullif(trim(ucid), '')) AS ucid, min(lower(trim(party_role))) AS role, min(nullif(trim(pacer_id), '')) AS pacer, min({_form_case()}) AS form,
        min(nullif(regexp_replace(lower(trim(domain)), '^www\.', ''), '')) AS domain, min(CASE WHEN length({_TEN}) >= 7 THEN {_TEN} END) AS phone, min(CASE WHEN length({squeezed}) >= 8 THEN {squeezed} END) AS address,
        min(CASE WHEN {line} IS NOT NULL THEN concat(lower(regexp_extract({line}, '{_GEO}', 1)), '|', regexp_extract({line}, '{_GEO}', 2)) END) AS geo
      FROM mentions WHERE entity_type = '{kind}' AND normalized_name IS NOT NULL AND court IS NOT NULL GROUP BY court, lower(trim(normalized_name))),
    t AS (SELECT *, {plain.format('name', f"t <> '' AND t NOT IN ({_in(STOP)})")} AS toks, {_class_sql('coalesce(raw, name)')} AS cls FROM g),
    f AS (SELECT *, list_distinct(list_filter(toks, lambda t: t NOT IN ({_in(GENERIC_ALL)}))) AS dist, list_distinct(list_filter(toks, lambda t: t IN ({_in(GENERIC_ALL)}))) AS gen,
        list_sort(list_distinct(list_transform({plain.format(both, "t IN ('jr', 'sr', 'ii', 'iii', 'iv', '2nd', '3rd', '4th', 'junior', 'senior')")}, lambda t: CASE t WHEN 'junior' THEN 'jr' WHEN 'senior' THEN 'sr' ELSE t END))) AS gens,
        CASE WHEN list_has_any(toks, [{_in(PLAN_MARKERS)}]) THEN list_filter(toks, lambda t: t IN ({_in(PLAN_TYPES)})) ELSE [] END AS plans,
        CASE WHEN regexp_matches(name, '{_JURISDICTION}') THEN trim(regexp_replace(regexp_extract(name, '{_JURISDICTION}', 2), '\b(ex|rel)\b', '', 'g')) END AS rest,
        list_filter([{_in(DIVISIONS)}], lambda d: contains(concat(' ', {both}, ' '), d)) AS divisions, regexp_matches({both}, '{DOE}') AS doe,
        CASE WHEN {role(PLAINTIFFS)} THEN 'p' WHEN {role(DEFENDANTS)} THEN 'd' END AS side, coalesce(regexp_matches(raw, '^p/o([^a-z]|$)'), false) AS title,
        CASE WHEN regexp_matches(raw, '[a-z]{{3,}}.*/|/.*[a-z]{{3,}}') THEN list_sort(list_transform(string_split(raw, '/'), lambda p: trim(replace(p, '-', ' ')))) END AS slashes,
        {plain.format('name', f"length(t) >= 2 AND t NOT IN ({_in(FIRM_STOP)})")} AS content FROM t),
    k AS (SELECT DISTINCT court, name, key FROM (SELECT court, name, toks[1] AS key FROM f UNION ALL SELECT court, name, toks[-1] FROM f) WHERE key IS NOT NULL),
    m AS (SELECT DISTINCT a.court, a.name AS name_a, b.name AS name_b FROM k a JOIN k b ON a.court = b.court AND a.key = b.key AND a.name < b.name),
    p AS (SELECT m.court, m.name_a, m.name_b, {', '.join(f'{s}.{c} AS {c}_{s}' for s in 'ab' for c in ('ucid', 'role', 'pacer', 'form', 'domain', 'phone', 'address', 'geo', 'toks', 'cls', 'dist', 'gen', 'gens', 'plans', 'rest', 'divisions', 'doe', 'side', 'title', 'slashes', 'content'))}
      FROM m JOIN f a ON a.court = m.court AND a.name = m.name_a JOIN f b ON b.court = m.court AND b.name = m.name_b) """


_JUDGES = r"""WITH j AS (SELECT court, name, nid, w, w[1] AS first, w[-1] AS last FROM (SELECT court, lower(trim(normalized_name)) AS name, min(fjc_nid) AS nid,
      list_filter(string_split(trim(regexp_replace(regexp_replace(lower(min(normalized_name)), '[^a-z0-9''-]+', ' ', 'g'), '\s+', ' ', 'g')), ' '), lambda t: t NOT IN ('', 'jr', 'sr', 'ii', 'iii', 'iv')) AS w
      FROM mentions WHERE entity_type = 'judge' AND normalized_name IS NOT NULL AND court IS NOT NULL GROUP BY court, lower(trim(normalized_name))) WHERE len(w) > 0),
    p AS (SELECT a.court, a.name AS name_a, b.name AS name_b, a.nid AS nid_a, b.nid AS nid_b, a.w AS w_a, b.w AS w_b, a.first AS first_a, b.first AS first_b, a.last AS last_a, b.last AS last_b
      FROM j a JOIN j b ON a.court = b.court AND substr(a.last, 1, 2) = substr(b.last, 1, 2) AND a.name < b.name) """

_CASES = " ".join(f"WHEN coalesce({_fill(p[1])}, false) THEN '{n}'" for n, p in IDENTITY.items())
_ALL = "list_filter([" + ", ".join(f"CASE WHEN coalesce({_fill(p[1])}, false) THEN '{n}' END" for n, p in IDENTITY.items()) + "], lambda x: x IS NOT NULL)"
SQL = (
    {f"veto_{n}": _facts_sql("party") + f"SELECT court, name_a, name_b FROM p WHERE {_fill(p[1])}" for n, p in IDENTITY.items()}
    | {f"pair_{n}": _facts_sql("party") + f"SELECT court, name_a, name_b FROM p WHERE {_fill(p[1])}" for n, p in BESIDE.items()}
    | {f"pair_{n}": _facts_sql("firm") + f"SELECT court, name_a, name_b FROM p WHERE {_fill(p[1])}" for n, p in FIRMS.items()}
    | {
        "identity_verdict": _facts_sql("party") + f"SELECT court, name_a, name_b, CASE {_CASES} ELSE 'ok' END AS verdict, array_to_string({_ALL}, ',') AS signals, 'tier2.' || CASE {_CASES} END AS method FROM p",
        "name_gate": _JUDGES + "SELECT court, name_a, name_b, " + ", ".join(f"coalesce({p[1]}, false) AS {n}" for n, p in GATE.items()) + f", coalesce({compatible(1)}, false) AS names_compatible FROM p",
    }
)
