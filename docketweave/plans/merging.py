"""Exact-key merges, within-case anchoring and blocking over mentions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketweave.functions import text as T
from docketweave.operators.graph import connected_components, star_edges
from docketweave.session import read

#: Merge rules: entity type, extra condition, key expressions. A row with any missing key part takes no part.
RULES: dict[str, tuple[str, str, list[str]]] = {
    "judge_name_case": ("judge", "true", ["normalized_name", "ucid"]),
    "judge_name_court": ("judge", "token_count >= 2", ["normalized_name", "court"]),
    "judge_name_court_year": ("judge", "token_count >= 2", ["normalized_name", "court", "year"]),
    "judge_name_email": ("judge", "true", ["normalized_name", "email"]),
    "judge_nid": ("judge", "true", ["fjc_nid"]),
    "firm_name_domain_court": ("firm", "true", ["normalized_name", "domain", "court"]),
    "firm_name_domain": ("firm", "true", ["normalized_name", "domain"]),
    "firm_name_address": ("firm", "true", ["normalized_name", "address"]),
    "firm_name_phone": ("firm", "true", ["normalized_name", "phone"]),
    "firm_name_court": ("firm", "token_count >= 2", ["normalized_name", "court"]),
    "party_name_case": ("party", "true", ["normalized_name", "ucid"]),
    "party_name_court_pacer": ("party", "true", ["normalized_name", "court", "pacer_id"]),
    "party_name_court": ("party", "token_count >= 2", ["normalized_name", "court"]),
}


#: Rules that need an identifying domain, and from how many firms (by the first word of the name) a domain identifies none.
OWN_DOMAIN, SHARED_BY = {"firm_name_domain"}, 5


def shared_domains(mentions: DataFrame, firms: int = SHARED_BY) -> DataFrame:
    """(domain): domains that differently named firms use, such as those of mail providers; learnt from all mentions."""
    first = T.tokens(F.col("normalized_name"))[0]
    rows = mentions.filter("entity_type = 'firm'").select(T.nz("domain").alias("domain"), first.alias("first")).na.drop()
    return rows.groupBy("domain").agg(F.count_distinct("first").alias("firms")).filter(F.col("firms") >= firms).select("domain")


def rule_edges(mentions: DataFrame, rule: str) -> DataFrame:
    kind, condition, key = RULES[rule]
    if rule in OWN_DOMAIN:
        mentions = mentions.join(shared_domains(mentions), "domain", "left_anti")
    rows = mentions.filter((F.col("entity_type") == kind) & F.expr(condition)).select("mention_id", *[T.nz(F.col(k).cast("string")).alias(k) for k in key])
    return star_edges(rows.na.drop(subset=key), key)


def form_edges(mentions: DataFrame) -> DataFrame:
    """Parties with one name and one family of legal form."""
    rows = mentions.filter("entity_type = 'party'").select("mention_id", T.nz("normalized_name").alias("name"), T.legal_form(F.col("raw_name")).alias("form"))
    return star_edges(rows.na.drop(), ["name", "form"])


def alias_edges(mentions: DataFrame, groups: dict[str, str]) -> DataFrame:
    """Mentions whose names belong to one alias group, wherever they stand."""
    table = mentions.sparkSession.createDataFrame(list(groups.items()), "name string, alias_group string")
    rows = mentions.select("mention_id", F.col("normalized_name").alias("name")).join(F.broadcast(table), "name")  # the configured groups
    return star_edges(rows, ["alias_group"])


#: "Name (f/k/a Other)" and the like: both names are one entity.
ALIAS = r"(?i)^(.*?)[\s,(]+(?:f/k/a|a/k/a|d/b/a)\s+(.*?)\)?\s*$"


def stated_aliases(mentions: DataFrame) -> DataFrame:
    """(name, alias_group): normalised names that a raw name states to be one, grouped under the smaller of the two."""
    plain = lambda i: T.squeeze(F.regexp_replace(F.lower(F.regexp_extract("raw_name", ALIAS, i)), r"[^a-z0-9]+", " "))
    pairs = mentions.filter(F.col("raw_name").rlike(ALIAS)).select(plain(1).alias("a"), plain(2).alias("b")).filter("a <> '' and b <> '' and a <> b").distinct()
    grouped = connected_components(pairs, "a", "b")
    return grouped.select(F.col("id").alias("name"), F.col("component").alias("alias_group"))


def alias_group_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mentions of one court whose names are stated to be aliases somewhere in it are linked to the smallest."""
    m = read(spark, sf_dir, "mentions").filter("entity_type <> 'judge' and court is not null")
    plain = T.squeeze(F.regexp_replace(F.lower("raw_name"), r"[^a-z0-9]+", " "))
    rows = m.select("mention_id", "court", plain.alias("name")).join(stated_aliases(m), "name")
    return star_edges(rows, ["court", "alias_group"])


def _rule_query(rule: str):
    return lambda spark, sf_dir: rule_edges(read(spark, sf_dir, "mentions"), rule)


def prefix_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Within a case, a two-token name that begins a three-token name; joined on case and both tokens."""
    t = F.split("normalized_name", " ")
    m = read(spark, sf_dir, "mentions").filter("entity_type = 'judge' and normalized_name is not null and ucid is not null").select("mention_id", "ucid", t.alias("t"))
    short = m.filter("size(t) = 2 and length(t[0]) >= 5").select(F.col("mention_id").alias("mention_id_a"), "ucid", F.col("t")[0].alias("f"), F.col("t")[1].alias("l"))
    long = m.filter("size(t) = 3").select(F.col("mention_id").alias("mention_id_b"), "ucid", F.col("t")[0].alias("f"), F.col("t")[1].alias("l"))
    return short.join(long, ["ucid", "f", "l"]).select("mention_id_a", "mention_id_b").distinct()


def truncated_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Within a case, a two-token name whose tokens all stand in a longer name; joined on case and first token."""
    m = read(spark, sf_dir, "mentions").filter("entity_type = 'judge' and normalized_name is not null and ucid is not null").select("mention_id", "ucid", F.split("normalized_name", " ").alias("t"))
    short = m.filter("size(t) = 2").select(F.col("mention_id").alias("mention_id_a"), "ucid", F.col("t")[0].alias("w"), F.col("t")[1].alias("other"))
    long = m.filter("size(t) >= 3").select(F.col("mention_id").alias("mention_id_b"), "ucid", "t", F.explode(F.array_distinct("t")).alias("w"))
    return short.join(long, ["ucid", "w"]).filter(F.array_contains("t", F.col("other"))).select("mention_id_a", "mention_id_b").distinct()


def short_anchor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-token judge names of a case attached to its only matching longer name, or the reason why not."""
    m = read(spark, sf_dir, "mentions").filter("entity_type = 'judge' and normalized_name is not null and ucid is not null").select("mention_id", "ucid", "normalized_name").distinct()
    shorts = m.filter("normalized_name not like '% %' and length(normalized_name) >= 2").select("mention_id", "ucid", F.col("normalized_name").alias("token"))
    anchors = m.filter("normalized_name like '% %'").select("ucid", F.col("normalized_name").alias("anchor"), T.surname(F.col("normalized_name")).alias("last")).distinct()
    near = F.levenshtein("token", "last", 1) >= 0
    hits = shorts.join(anchors, "ucid").filter(near).groupBy("mention_id").agg(F.count_distinct("anchor").alias("n"), F.min("anchor").alias("anchor"))
    return shorts.select("mention_id").distinct().join(hits, "mention_id", "left").select(
        "mention_id", F.when(F.col("n") == 1, F.col("anchor")).alias("anchor"), F.when(F.col("n") == 1, "attached").when(F.col("n") > 1, "many").otherwise("none").alias("outcome")
    )


def blocks(mentions: DataFrame) -> DataFrame:
    """(mention_id, entity_type, block_key): every blocking key of every mention; a shared one where it has none."""
    k = lambda prefix, *parts: F.when(F.greatest(*[F.col(p).isNull().cast("int") for p in parts], F.lit(0)) == 0, F.concat(F.lit(prefix + "::"), F.array_join(F.array(*parts), "|")))
    m = mentions.select(
        "mention_id", "entity_type", T.nz("court").alias("court"), T.surname(F.col("normalized_name")).alias("last"), T.nz("domain").alias("domain"), T.phone_key(F.col("phone")).alias("phone"),
        F.nullif(T.initials(F.col("normalized_name")), F.lit("")).alias("ini"), F.array_join(F.slice(T.tokens(F.col("normalized_name")), 1, 2), " ").alias("first2"),
    )
    judge = F.array(k("surname", "court", "last"), k("initials", "court", "ini"))
    firm = F.array(k("domain", "court", "domain"), k("phone", "phone"), k("surname", "court", "last"))
    party = F.array(k("first2", "court", "first2"), k("surname", "court", "last"), k("initials", "court", "ini"))
    keys = F.array_distinct(F.array_compact(F.when(F.col("entity_type") == "judge", judge).when(F.col("entity_type") == "firm", firm).otherwise(party)))
    return m.select("mention_id", "entity_type", F.explode(F.when(F.size(keys) > 0, keys).otherwise(F.array(F.lit("_UNBLOCKED_")))).alias("block_key")).distinct()


def block_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks(read(spark, sf_dir, "mentions"))


def block_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks(read(spark, sf_dir, "mentions")).groupBy("entity_type", "block_key").agg(F.count("*").alias("members")).filter("members > 1")


def tier0_edges(mentions: DataFrame, kind: str) -> DataFrame:
    """All exact-key edges of one entity type."""
    out = None
    for rule, (of, _, _) in RULES.items():
        if of == kind:
            edges = rule_edges(mentions, rule)
            out = edges if out is None else out.union(edges)
    return out.distinct()


def components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of party mentions under name and case, or name, court and account number."""
    m = read(spark, sf_dir, "mentions")
    edges = rule_edges(m, "party_name_case").union(rule_edges(m, "party_name_court_pacer"))
    return connected_components(edges, "mention_id_a", "mention_id_b").select(F.col("id").alias("mention_id"), "component")


QUERIES = {f"tier0_{rule}": _rule_query(rule) for rule in RULES} | {
    "tier0_party_name_form": lambda spark, sf_dir: form_edges(read(spark, sf_dir, "mentions")),
    "alias_group_merge": alias_group_merge,
    "shared_domains": lambda spark, sf_dir: shared_domains(read(spark, sf_dir, "mentions")),
    "prefix_span": prefix_span,
    "truncated_span": truncated_span,
    "short_anchor": short_anchor,
    "block_keys": block_keys,
    "block_sizes": block_sizes,
    "components": components,
}


def _star(key: list[str], rows: str) -> str:
    names = ", ".join(key)
    return f"""WITH r AS ({rows}), k AS (SELECT mention_id, min(mention_id) OVER (PARTITION BY {names}) AS root FROM r)
    SELECT DISTINCT root AS mention_id_a, mention_id AS mention_id_b FROM k WHERE root <> mention_id"""


_SHARED = f"""SELECT domain FROM (SELECT nullif(trim(domain), '') AS domain, string_split(trim(regexp_replace(lower(normalized_name), '\\s+', ' ', 'g')), ' ')[1] AS first FROM mentions WHERE entity_type = 'firm')
    WHERE domain IS NOT NULL AND first IS NOT NULL AND first <> '' GROUP BY domain HAVING count(DISTINCT first) >= {SHARED_BY}"""


def _rows(rule: str) -> str:
    kind, condition, key = RULES[rule]
    value = lambda c: f"nullif(trim(CAST({c} AS VARCHAR)), '')"
    if rule in OWN_DOMAIN:
        condition += f" AND domain NOT IN ({_SHARED})"
    return f"SELECT mention_id, {', '.join(f'{value(c)} AS {c}' for c in key)} FROM mentions WHERE entity_type = '{kind}' AND {condition} AND " + " AND ".join(f"{value(c)} IS NOT NULL" for c in key)


def _last(name: str) -> str:
    return f"list_filter(string_split(trim(regexp_replace(lower({name}), '\\s+', ' ', 'g')), ' '), lambda t: t NOT IN ('jr', 'sr', 'ii', 'iii', 'iv', ''))[-1]"


def _form_sql() -> str:
    from docketweave.plans.normalisation import _form_case

    return _star(["name", "form"], f"SELECT * FROM (SELECT mention_id, nullif(trim(normalized_name), '') AS name, {_form_case()} AS form FROM mentions WHERE entity_type = 'party') WHERE name IS NOT NULL AND form IS NOT NULL")


_TOK = "list_filter(string_split(trim(regexp_replace(lower(normalized_name), '\\s+', ' ', 'g')), ' '), lambda t: t <> '')"
_DIGITS = "regexp_replace(phone, '[^0-9]', '', 'g')"
_BLOCKS = f"""WITH m AS (SELECT mention_id, entity_type, nullif(trim(court), '') AS court, {_last('normalized_name')} AS l, nullif(trim(domain), '') AS domain,
    CASE WHEN length(CASE WHEN length({_DIGITS}) = 11 AND starts_with({_DIGITS}, '1') THEN substr({_DIGITS}, 2, 10) ELSE {_DIGITS} END) >= 7 THEN CASE WHEN length({_DIGITS}) = 11 AND starts_with({_DIGITS}, '1') THEN substr({_DIGITS}, 2, 10) ELSE {_DIGITS} END END AS phone,
    nullif(array_to_string(list_transform({_TOK}, lambda t: substr(t, 1, 1)), '|'), '') AS ini, array_to_string({_TOK}[1:2], ' ') AS first2 FROM mentions),
  k AS (
    SELECT mention_id, entity_type, 'surname::' || court || '|' || l AS block_key FROM m UNION
    SELECT mention_id, entity_type, 'initials::' || court || '|' || ini FROM m WHERE entity_type <> 'firm' UNION
    SELECT mention_id, entity_type, 'domain::' || court || '|' || domain FROM m WHERE entity_type = 'firm' UNION
    SELECT mention_id, entity_type, 'phone::' || phone FROM m WHERE entity_type = 'firm' UNION
    SELECT mention_id, entity_type, 'first2::' || court || '|' || first2 FROM m WHERE entity_type = 'party'),
  b AS (SELECT * FROM k WHERE block_key IS NOT NULL UNION SELECT DISTINCT mention_id, entity_type, '_UNBLOCKED_' FROM m WHERE mention_id NOT IN (SELECT mention_id FROM k WHERE block_key IS NOT NULL)) """
_JUDGES = "SELECT DISTINCT mention_id, ucid, normalized_name, string_split(normalized_name, ' ') AS t FROM mentions WHERE entity_type = 'judge' AND normalized_name IS NOT NULL AND ucid IS NOT NULL"

SQL = {f"tier0_{rule}": _star(RULES[rule][2], _rows(rule)) for rule in RULES} | {
    "tier0_party_name_form": _form_sql(),
    "shared_domains": _SHARED,
    "alias_group_merge": r"""WITH RECURSIVE m AS (SELECT * FROM mentions WHERE entity_type <> 'judge' AND court IS NOT NULL),
      p AS (SELECT DISTINCT trim(regexp_replace(lower(regexp_extract(raw_name, 'PATTERN', 1)), '[^a-z0-9]+', ' ', 'g')) AS a, trim(regexp_replace(lower(regexp_extract(raw_name, 'PATTERN', 2)), '[^a-z0-9]+', ' ', 'g')) AS b
        FROM m WHERE regexp_matches(raw_name, 'PATTERN')),
      e AS (SELECT a, b FROM p WHERE a <> '' AND b <> '' AND a <> b UNION SELECT b, a FROM p WHERE a <> '' AND b <> '' AND a <> b),
      reach(name, other) AS (SELECT a, a FROM e UNION SELECT reach.name, e.b FROM reach JOIN e ON e.a = reach.other),
      g AS (SELECT name, min(other) AS alias_group FROM reach GROUP BY name),
      r AS (SELECT mention_id, court, alias_group FROM m JOIN g ON g.name = trim(regexp_replace(lower(raw_name), '[^a-z0-9]+', ' ', 'g'))),
      k AS (SELECT mention_id, min(mention_id) OVER (PARTITION BY court, alias_group) AS root FROM r)
      SELECT DISTINCT root AS mention_id_a, mention_id AS mention_id_b FROM k WHERE root <> mention_id""".replace("PATTERN", ALIAS),
    "prefix_span": f"WITH j AS ({_JUDGES}) SELECT DISTINCT a.mention_id AS mention_id_a, b.mention_id AS mention_id_b FROM j a JOIN j b ON a.ucid = b.ucid AND len(a.t) = 2 AND len(b.t) = 3 AND length(a.t[1]) >= 5 AND a.t[1] = b.t[1] AND a.t[2] = b.t[2]",
    "truncated_span": f"WITH j AS ({_JUDGES}) SELECT DISTINCT a.mention_id AS mention_id_a, b.mention_id AS mention_id_b FROM j a JOIN j b ON a.ucid = b.ucid AND len(a.t) = 2 AND len(b.t) >= 3 AND list_contains(b.t, a.t[1]) AND list_contains(b.t, a.t[2])",
    "short_anchor": f"""WITH j AS ({_JUDGES}), s AS (SELECT DISTINCT mention_id, ucid, normalized_name AS token FROM j WHERE normalized_name NOT LIKE '% %' AND length(normalized_name) >= 2),
      a AS (SELECT DISTINCT ucid, normalized_name AS anchor, {_last('normalized_name')} AS l FROM j WHERE normalized_name LIKE '% %'),
      h AS (SELECT s.mention_id, count(DISTINCT anchor) AS n, min(anchor) AS anchor FROM s JOIN a ON s.ucid = a.ucid AND levenshtein(token, l) <= 1 GROUP BY s.mention_id)
      SELECT s.mention_id, CASE WHEN n = 1 THEN anchor END AS anchor, CASE WHEN n = 1 THEN 'attached' WHEN n > 1 THEN 'many' ELSE 'none' END AS outcome FROM (SELECT DISTINCT mention_id FROM s) s LEFT JOIN h ON s.mention_id = h.mention_id""",
    "block_keys": _BLOCKS + "SELECT mention_id, entity_type, block_key FROM b",
    "block_sizes": _BLOCKS + "SELECT entity_type, block_key, count(*) AS members FROM b GROUP BY ALL HAVING count(*) > 1",
    "components": f"""WITH RECURSIVE e0 AS (SELECT * FROM ({_star(RULES['party_name_case'][2], _rows('party_name_case'))}) UNION SELECT * FROM ({_star(RULES['party_name_court_pacer'][2], _rows('party_name_court_pacer'))})),
      e AS (SELECT mention_id_a a, mention_id_b b FROM e0 UNION SELECT mention_id_b, mention_id_a FROM e0),
      reach(id, other) AS (SELECT a, a FROM e UNION SELECT reach.id, e.b FROM reach JOIN e ON e.a = reach.other)
      SELECT id AS mention_id, min(other) AS component FROM reach GROUP BY id""",
}
