"""Entity records, safety splits, the registry and its increments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docketweave.functions import text as T
from docketweave.operators.graph import connected_components, constrained_components
from docketweave.plans import merging
from docketweave.session import read


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sjid, mention_id) of the registry, each once."""
    e = read(spark, sf_dir, "entities")
    return e.select("sjid", F.explode("mention_ids").alias("mention_id")).filter("sjid is not null and mention_id is not null").distinct()


def placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry members with their mention rows, repeated deliveries once."""
    columns = ["entity_type", "normalized_name", "presentable_name", "court", "ucid", "fjc_nid", "domain", "party_enum", "source_file", "filing_date"]
    m = read(spark, sf_dir, "mentions").groupBy("mention_id").agg(*[F.min(c).alias(c) for c in columns])
    return members(spark, sf_dir).join(m, "mention_id")


def resolve(mentions: DataFrame, kind: str = "party") -> DataFrame:
    """(mention_id, component) of one entity type by all exact-key rules; single mentions stand alone."""
    groups = connected_components(merging.tier0_edges(mentions, kind), "mention_id_a", "mention_id_b")
    ids = mentions.filter(F.col("entity_type") == kind).select("mention_id").distinct()
    return ids.join(groups, ids["mention_id"] == groups["id"], "left").select("mention_id", F.coalesce("component", "mention_id").alias("component"))


def entity_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities of the registry rebuilt from their members: modal name, courts, cases, numbers, domains."""
    p = placed(spark, sf_dir)
    names = p.filter("normalized_name is not null").groupBy("sjid", "normalized_name").agg(F.count("*").alias("n"))
    modal = names.groupBy("sjid").agg(F.min(F.struct((-F.col("n")).alias("n"), "normalized_name"))["normalized_name"].alias("canonical_name"))
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ";")
    out = p.groupBy("sjid").agg(
        F.count("*").alias("n_mentions"), joined("court").alias("courts"), F.count_distinct("ucid").alias("n_cases"), joined(F.col("fjc_nid").cast("string")).alias("fjc_nids"), joined(F.when(~F.col("domain").startswith("mail"), F.col("domain"))).alias("domains")
    )
    return out.join(modal, "sjid", "left")


def component_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Serial numbers of components by falling size and smallest id, ranked within each size."""
    sizes = resolve(read(spark, sf_dir, "mentions")).groupBy("component").agg(F.count("*").alias("size"))
    counts = sizes.groupBy("size").agg(F.count("*").alias("n"))
    ahead = counts.alias("a").join(counts.alias("b"), F.col("b.size") > F.col("a.size"), "left").groupBy(F.col("a.size").alias("size")).agg(F.coalesce(F.sum("b.n"), F.lit(0)).alias("ahead"))
    serial = F.col("ahead") + F.row_number().over(Window.partitionBy("size").orderBy("component")) - 1
    return sizes.join(ahead, "size").select("component", "size", serial.cast("bigint").alias("serial"))


def coparty_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups under court and first token that would put two listed parties of one case together."""
    m = read(spark, sf_dir, "mentions").filter("entity_type = 'party' and normalized_name is not null and party_enum is not null")
    m = m.select(F.concat_ws("|", "court", T.tokens(F.col("normalized_name"))[0]).alias("grp"), "ucid", "party_enum", "normalized_name").distinct()
    return m.groupBy("grp", "ucid").agg(F.count_distinct("party_enum").alias("entries"), F.count_distinct("normalized_name").alias("names")).filter("entries > 1 and names > 1")


def constrained_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parties merged by name and court unless two listed parties of one case would meet."""
    m = read(spark, sf_dir, "mentions")
    edges = merging.rule_edges(m, "party_name_court").select(F.col("mention_id_a").alias("a"), F.col("mention_id_b").alias("b"), F.lit(1).alias("rank"))
    slots = m.filter("entity_type = 'party' and party_enum is not null and normalized_name is not null").select(F.col("mention_id").alias("id"), "ucid", F.col("party_enum").alias("entry"), F.col("normalized_name").alias("name")).distinct()
    return constrained_components(edges, slots).select(F.col("id").alias("mention_id"), "component")


def nid_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judge groups under name and court; groups of several directory numbers fall apart into single mentions."""
    m = read(spark, sf_dir, "mentions").filter("entity_type = 'judge' and normalized_name is not null").groupBy("mention_id").agg(F.min("normalized_name").alias("name"), F.min("court").alias("court"), F.min("fjc_nid").alias("nid"))
    nids = m.groupBy("name", "court").agg(F.count_distinct("nid").alias("nids"), F.min("mention_id").alias("root"))
    return m.join(nids, ["name", "court"]).select("mention_id", F.when(F.col("nids") > 1, F.col("mention_id")).otherwise(F.col("root")).alias("component"))


def registry_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "entities").filter("sjid is not null")
    flat = lambda c: F.array_join(F.array_sort(F.array_distinct(F.col(c).cast("array<string>"))), ";").alias(c)
    return e.select("sjid", "entity_type", "canonical_name", flat("courts"), flat("fjc_nids"), flat("domains"), "office_state", "office_city").distinct()


def registry_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incoming mentions met by registry entities under name and court, or directory number."""
    e = read(spark, sf_dir, "entities").filter("sjid is not null")
    i = read(spark, sf_dir, "incoming_mentions").filter("mention_id is not null")
    by_name = i.select("mention_id", "entity_type", "normalized_name", "court").join(e.select("sjid", "entity_type", "normalized_name", F.explode("courts").alias("court")).distinct(), ["entity_type", "normalized_name", "court"])
    by_nid = i.select("mention_id", F.col("fjc_nid").alias("nid")).join(e.select("sjid", F.explode("fjc_nids").alias("nid")).distinct(), "nid")
    return by_name.select("mention_id", "sjid", F.lit("name_court").alias("via")).union(by_nid.select("mention_id", "sjid", F.lit("nid").alias("via"))).distinct()


def registry_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One outcome for every incoming mention: the best candidate, number before name, or NEW_ENTITY."""
    prio = F.when(F.col("via") == "nid", 0).otherwise(1)
    best = registry_candidates(spark, sf_dir).groupBy("mention_id").agg(F.min(F.struct(prio.alias("p"), "sjid")).alias("b"))
    i = read(spark, sf_dir, "incoming_mentions").filter("mention_id is not null").select("mention_id").distinct()
    return i.join(best, "mention_id", "left").select("mention_id", F.col("b.sjid").alias("sjid"), F.when(F.col("b").isNull(), "NEW_ENTITY").when(F.col("b.p") == 0, "incremental.link_fjc_nid").otherwise("incremental.link_tier0").alias("method"))


def absorb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry entities with the courts and mentions of the incoming rows linked to them."""
    linked = registry_assign(spark, sf_dir).filter("sjid is not null").select("mention_id", "sjid")
    i = read(spark, sf_dir, "incoming_mentions").groupBy("mention_id").agg(F.min("court").alias("court"))
    own = members(spark, sf_dir)
    courts = read(spark, sf_dir, "entities").filter("sjid is not null").select("sjid", F.explode("courts").alias("court"))
    all_courts = courts.union(linked.join(i, "mention_id").select("sjid", "court")).groupBy("sjid").agg(F.array_join(F.array_sort(F.collect_set("court")), ";").alias("courts"))
    counts = own.union(linked.select("sjid", "mention_id")).groupBy("sjid").agg(F.count_distinct("mention_id").alias("n_mentions"))
    return counts.join(all_courts, "sjid")


def cross_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return placed(spark, sf_dir).groupBy("sjid").agg(F.count_distinct("source_file").alias("files")).filter("files > 1")


def entity_signature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What identifies an entity across runs: its number, else its first domain, else name and first court."""
    e = read(spark, sf_dir, "entities").filter("sjid is not null")
    sig = F.when(F.size("fjc_nids") > 0, F.concat(F.lit("nid:"), F.array_min("fjc_nids").cast("string"))).when(F.size("domains") > 0, F.concat(F.lit("dom:"), F.array_min("domains"))).otherwise(F.concat(F.lit("nc:"), F.coalesce("normalized_name", F.lit("")), F.lit("|"), F.coalesce(F.array_min("courts"), F.lit(""))))
    return e.select("sjid", sig.alias("signature")).distinct()


def signature_clashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entity_signature(spark, sf_dir).groupBy("signature").agg(F.count_distinct("sjid").alias("ids"), F.min("sjid").alias("first_id")).filter("ids > 1")


QUERIES = {
    f.__name__: f
    for f in (entity_record, component_order, coparty_violations, constrained_merge, nid_split, registry_projection, registry_candidates, registry_assign, absorb, cross_file, entity_signature, signature_clashes)
}

_M = "SELECT DISTINCT sjid, mention_id FROM (SELECT sjid, unnest(mention_ids) AS mention_id FROM entities) WHERE sjid IS NOT NULL AND mention_id IS NOT NULL"
_PLACED = f"m AS ({_M}), r AS (SELECT mention_id, min(entity_type) AS entity_type, min(normalized_name) AS normalized_name, min(presentable_name) AS presentable_name, min(court) AS court, min(ucid) AS ucid, min(fjc_nid) AS fjc_nid, min(domain) AS domain, min(party_enum) AS party_enum, min(source_file) AS source_file, min(filing_date) AS filing_date FROM mentions GROUP BY mention_id), p AS (SELECT * FROM m JOIN r USING (mention_id)) "
_CAND = """c AS (SELECT DISTINCT i.mention_id, e.sjid, 'name_court' AS via FROM incoming_mentions i JOIN (SELECT DISTINCT sjid, entity_type, normalized_name, unnest(courts) AS court FROM entities WHERE sjid IS NOT NULL) e ON i.entity_type = e.entity_type AND i.normalized_name = e.normalized_name AND i.court = e.court WHERE i.mention_id IS NOT NULL
  UNION SELECT DISTINCT i.mention_id, e.sjid, 'nid' FROM incoming_mentions i JOIN (SELECT DISTINCT sjid, unnest(fjc_nids) AS nid FROM entities WHERE sjid IS NOT NULL) e ON i.fjc_nid = e.nid WHERE i.mention_id IS NOT NULL)"""
_ASSIGN = _CAND + """, b AS (SELECT mention_id, sjid, via, row_number() OVER (PARTITION BY mention_id ORDER BY CASE WHEN via = 'nid' THEN 0 ELSE 1 END, sjid) AS k FROM c),
  a AS (SELECT i.mention_id, b.sjid, CASE WHEN b.sjid IS NULL THEN 'NEW_ENTITY' WHEN via = 'nid' THEN 'incremental.link_fjc_nid' ELSE 'incremental.link_tier0' END AS method FROM (SELECT DISTINCT mention_id FROM incoming_mentions WHERE mention_id IS NOT NULL) i LEFT JOIN b ON i.mention_id = b.mention_id AND k = 1)"""
_SIG = """s AS (SELECT DISTINCT sjid, CASE WHEN len(fjc_nids) > 0 THEN 'nid:' || list_min(fjc_nids) WHEN len(domains) > 0 THEN 'dom:' || list_min(domains) ELSE 'nc:' || coalesce(normalized_name, '') || '|' || coalesce(list_min(courts), '') END AS signature FROM entities WHERE sjid IS NOT NULL)"""
_FLAT = "array_to_string(list_sort(list_distinct(CAST({0} AS VARCHAR[]))), ';') AS {0}"


def _party_groups() -> str:
    edges = " UNION ".join(f"SELECT * FROM ({merging._star(key, merging._rows(rule))})" for rule, (kind, _, key) in merging.RULES.items() if kind == "party")
    return f"""WITH RECURSIVE e0 AS ({edges}), e AS (SELECT mention_id_a a, mention_id_b b FROM e0 UNION SELECT mention_id_b, mention_id_a FROM e0), reach(id, other) AS (SELECT a, a FROM e UNION SELECT reach.id, e.b FROM reach JOIN e ON e.a = reach.other),
      g AS (SELECT id, min(other) AS component FROM reach GROUP BY id), i AS (SELECT DISTINCT mention_id FROM mentions WHERE entity_type = 'party'), z AS (SELECT mention_id, coalesce(component, mention_id) AS component FROM i LEFT JOIN g ON id = mention_id) """


SQL = {
    "entity_record": f"""WITH {_PLACED}, n AS (SELECT sjid, normalized_name, row_number() OVER (PARTITION BY sjid ORDER BY count(*) DESC, normalized_name) AS k FROM p WHERE normalized_name IS NOT NULL GROUP BY sjid, normalized_name),
      o AS (SELECT sjid, count(*) AS n_mentions, coalesce(string_agg(DISTINCT court, ';' ORDER BY court), '') AS courts, count(DISTINCT ucid) AS n_cases, coalesce(string_agg(DISTINCT CAST(fjc_nid AS VARCHAR), ';' ORDER BY CAST(fjc_nid AS VARCHAR)), '') AS fjc_nids,
        coalesce(string_agg(DISTINCT CASE WHEN NOT starts_with(domain, 'mail') THEN domain END, ';' ORDER BY CASE WHEN NOT starts_with(domain, 'mail') THEN domain END), '') AS domains FROM p GROUP BY sjid)
      SELECT o.*, normalized_name AS canonical_name FROM o LEFT JOIN n ON o.sjid = n.sjid AND k = 1""",
    "component_order": _party_groups() + ", s AS (SELECT component, count(*) AS size FROM z GROUP BY component) SELECT component, size, row_number() OVER (ORDER BY size DESC, component) - 1 AS serial FROM s",
    "coparty_violations": "WITH m AS (SELECT DISTINCT concat_ws('|', court, list_filter(string_split(trim(regexp_replace(lower(normalized_name), '\\s+', ' ', 'g')), ' '), lambda t: t <> '')[1]) AS grp, ucid, party_enum, normalized_name FROM mentions WHERE entity_type = 'party' AND normalized_name IS NOT NULL AND party_enum IS NOT NULL) SELECT grp, ucid, count(DISTINCT party_enum) AS entries, count(DISTINCT normalized_name) AS names FROM m GROUP BY grp, ucid HAVING count(DISTINCT party_enum) > 1 AND count(DISTINCT normalized_name) > 1",
    "nid_split": "WITH m AS (SELECT mention_id, min(normalized_name) AS name, min(court) AS court, min(fjc_nid) AS nid FROM mentions WHERE entity_type = 'judge' AND normalized_name IS NOT NULL GROUP BY mention_id), g AS (SELECT name, court, count(DISTINCT nid) AS nids, min(mention_id) AS root FROM m GROUP BY name, court) SELECT mention_id, CASE WHEN nids > 1 THEN mention_id ELSE root END AS component FROM m JOIN g ON m.name = g.name AND m.court IS NOT DISTINCT FROM g.court",
    "registry_projection": f"SELECT DISTINCT sjid, entity_type, canonical_name, {_FLAT.format('courts')}, {_FLAT.format('fjc_nids')}, {_FLAT.format('domains')}, office_state, office_city FROM entities WHERE sjid IS NOT NULL",
    "registry_candidates": f"WITH {_CAND} SELECT * FROM c",
    "registry_assign": f"WITH {_ASSIGN} SELECT * FROM a",
    "absorb": f"""WITH {_ASSIGN}, m AS ({_M}), l AS (SELECT sjid, mention_id FROM a WHERE sjid IS NOT NULL), n AS (SELECT sjid, count(DISTINCT mention_id) AS n_mentions FROM (SELECT * FROM m UNION ALL SELECT * FROM l) GROUP BY sjid),
      k AS (SELECT sjid, unnest(courts) AS court FROM entities WHERE sjid IS NOT NULL UNION SELECT l.sjid, i.court FROM l JOIN (SELECT mention_id, min(court) AS court FROM incoming_mentions GROUP BY mention_id) i USING (mention_id))
      SELECT n.sjid, n_mentions, string_agg(DISTINCT court, ';' ORDER BY court) AS courts FROM n JOIN k USING (sjid) GROUP BY n.sjid, n_mentions""",
    "cross_file": f"WITH {_PLACED} SELECT sjid, count(DISTINCT source_file) AS files FROM p GROUP BY sjid HAVING count(DISTINCT source_file) > 1",
    "entity_signature": f"WITH {_SIG} SELECT * FROM s",
    "signature_clashes": f"WITH {_SIG} SELECT signature, count(DISTINCT sjid) AS ids, min(sjid) AS first_id FROM s GROUP BY signature HAVING count(DISTINCT sjid) > 1",
}
