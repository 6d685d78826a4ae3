"""Name repair, validity, open-schema walks, agency lookup, reunions and the remaining audits."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketweave.functions import text as T
from docketweave.operators.graph import connected_components, star_edges
from docketweave.plans.clustering import placed
from docketweave.session import read

LOCATION = r"^(.*\S)\s*(?: - |, )([A-Z][A-Za-z .]+(?: Falls| Heights| Springs)?, [A-Z]{2})$"


def location_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Street part and trailing "City, ST" of one-line addresses without a zip code."""
    a = F.trim(F.regexp_replace(F.regexp_replace("address", "\n", ", "), r"[ -]*\d{5}(?:-\d{4})?.*$", ""))
    m = read(spark, sf_dir, "mentions").filter("address is not null").select("mention_id", a.alias("a"))
    return m.select("mention_id", F.nullif(F.regexp_extract("a", LOCATION, 1), F.lit("")).alias("core"), F.nullif(F.regexp_extract("a", LOCATION, 2), F.lit("")).alias("location")).filter("location is not null")


def name_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names cut at a colon and at the first all-small word after the second token."""
    head = F.trim(F.regexp_extract("raw_name", r"^([^:]*)", 1))
    words = F.split(head, r"\s+")
    small = F.filter(F.transform(words, lambda w, i: F.when((i >= 2) & w.rlike("^[a-z]+$"), i)), lambda i: i.isNotNull())
    cut = F.array_join(F.slice(words, F.lit(1), F.coalesce(F.try_element_at(small, F.lit(1)), F.size(words))), " ")
    return read(spark, sf_dir, "mentions").filter("entity_type = 'judge' and raw_name is not null").select("mention_id", cut.alias("span"))


REASONS = [("empty", lambda n: n.isNull()), ("digits", lambda n: n.rlike("[0-9]")), ("single_letter_name", lambda n: n.rlike("^[a-z]$")), ("too_long", lambda n: F.length(n) > 120), ("procedural", lambda n: n.rlike(r"\b(motion|motions|hearing|order|pursuant|referred|terminated)\b"))]


def validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every name with its reasons for quarantine; none means it is kept."""
    n = T.nz("normalized_name")
    reasons = F.array_join(F.array_compact(F.array(*[F.when(test(n), F.lit(label)) for label, test in REASONS])), ",")
    return read(spark, sf_dir, "mentions").select("mention_id", reasons.alias("reasons"), (reasons == "").alias("kept"))


def _leaves(value: object, path: str) -> Iterator[tuple[str, str]]:
    todo = [(path, value)]
    while todo:
        at, v = todo.pop()
        if isinstance(v, dict):
            todo += [(f"{at}.{'#' if k.isdigit() else k}" if at else k, x) for k, x in v.items()]
        elif isinstance(v, list):
            todo += [(at + "[]", x) for x in v]
        elif isinstance(v, str) and v.strip():
            yield at, v


def _walk_leaves(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows: dict[str, list[int]] = {}
        for t in b["case_json"]:
            try:
                doc = json.loads(t) if t else None
            except ValueError:
                continue
            for path, v in _leaves(doc, ""):
                c = rows.setdefault(path, [0, 0])
                c[0] += 1
                c[1] += 3 <= len(v) <= 120
        yield pd.DataFrame([(p, *c) for p, c in rows.items()], columns=["path", "n", "name_like"]).astype({"n": "int64", "name_like": "int64"})


def leaf_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every path pattern of string leaves in the readable documents, without a schema; counted per batch, then summed."""
    counts = read(spark, sf_dir, "case_docs").select("case_json").mapInPandas(_walk_leaves, "path string, n bigint, name_like bigint")
    return counts.groupBy("path").agg(F.sum("n").alias("n"), F.sum("name_like").alias("name_like"))


def agency_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Public bodies by whole name, in either order of their parts; a variant that two bodies claim names neither."""
    m = read(spark, sf_dir, "mentions").filter("entity_type = 'party' and normalized_name like '% county department of %'").select("mention_id", "normalized_name").distinct()
    body = F.regexp_extract("normalized_name", r"^(\S+) county department of (.+)$", 2)
    place = F.regexp_extract("normalized_name", r"^(\S+) county department of (.+)$", 1)
    names = m.select("normalized_name", F.concat_ws("/", place, body).alias("agency")).distinct()
    variants = names.select("agency", F.explode(F.array("normalized_name", F.concat(F.split("agency", "/")[1], F.lit(" department of "), F.split("agency", "/")[0], F.lit(" county")))).alias("variant")).distinct()
    unique = variants.groupBy("variant").agg(F.count_distinct("agency").alias("n"), F.min("agency").alias("agency")).filter("n = 1")
    return m.join(unique, m["normalized_name"] == unique["variant"]).select("mention_id", "agency")


def transfer_partners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judges of one case number in two courts, as partners of a transfer."""
    m = read(spark, sf_dir, "mentions").filter("entity_type = 'judge' and normalized_name is not null and case_id is not null").select("case_id", "court", "normalized_name").distinct()
    a, b = m.select("case_id", F.col("court").alias("court_a"), F.col("normalized_name").alias("judge")), m.select("case_id", F.col("court").alias("court_b"), F.col("normalized_name").alias("partner"))
    return a.join(b, "case_id").filter("court_a <> court_b and judge <> partner").groupBy("judge").agg(F.array_join(F.array_sort(F.collect_set("partner")), ";").alias("partners"))


def punct_fold_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry entities that share a punctuation-fold key of one type, as groups."""
    e = read(spark, sf_dir, "entities").filter("sjid is not null and normalized_name is not null and entity_type <> 'judge'")
    rows = e.select("sjid", "entity_type", F.explode(T.punct_fold_keys(F.col("normalized_name"))).alias("k")).filter("k <> 'tok:'").distinct()
    edges = star_edges(rows, ["entity_type", "k"], "sjid")
    return connected_components(edges, "mention_id_a", "mention_id_b").select(F.col("id").alias("sjid"), "component")


def generation_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judge groups under court and name without suffix, split by generational suffix where two suffixes meet."""
    core = F.array_join(T.core_tokens(F.col("normalized_name")), " ")
    gen = F.array_join(F.array_sort(F.array_distinct(F.filter(T.tokens(F.col("normalized_name")), lambda t: t.isin(T.GENERATIONS)))), ",")
    m = read(spark, sf_dir, "mentions").filter("entity_type = 'judge' and normalized_name is not null").select("mention_id", "court", core.alias("core"), gen.alias("gen")).distinct()
    several = m.filter("gen <> ''").groupBy("court", "core").agg(F.count_distinct("gen").alias("gens"))
    return m.join(several, ["court", "core"], "left").select("mention_id", F.concat_ws("|", "court", "core", F.when(F.col("gens") > 1, F.col("gen")).otherwise("")).alias("grp"))


def placeholder_cross_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of one token that occur in several cases of a court."""
    m = read(spark, sf_dir, "mentions").filter("token_count = 1 and normalized_name is not null")
    return m.groupBy("court", "normalized_name").agg(F.count_distinct("ucid").alias("cases")).filter("cases > 1")


def gold_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How a registry name is found among the mentions: exactly, by core, by surname and initial, or not."""
    e = read(spark, sf_dir, "entities").filter("sjid is not null and entity_type = 'judge' and normalized_name is not null").select("sjid", "normalized_name").distinct()
    m = read(spark, sf_dir, "mentions").filter("entity_type = 'judge' and normalized_name is not null").select("normalized_name").distinct()
    core = lambda: F.array_join(T.core_tokens(F.col("normalized_name")), " ")
    soft = lambda: F.concat(T.surname(F.col("normalized_name")), F.lit("|"), F.substring("normalized_name", 1, 1))
    keyed = e.select("sjid", "normalized_name", core().alias("core"), soft().alias("soft"))
    a = m.withColumn("exact", F.lit(1))
    b, c = m.select(core().alias("core"), F.lit(1).alias("by_core")).distinct(), m.select(soft().alias("soft"), F.lit(1).alias("by_soft")).distinct()
    out = keyed.join(a, "normalized_name", "left").join(b, "core", "left").join(c, "soft", "left")
    return out.select("sjid", "normalized_name", F.when(F.col("exact") == 1, "exact").when(F.col("by_core") == 1, "core").when(F.col("by_soft") == 1, "soft").otherwise("none").alias("aligned"))


def excused_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positive decisions between two entities that share a directory number, which do not count as errors."""
    p = placed(spark, sf_dir).select("mention_id", "sjid", "fjc_nid")
    d = read(spark, sf_dir, "decisions").filter("upper(trim(decision)) in ('MATCH', 'MERGE_TIER0', 'MERGE_TIER2')").select("decision_id", "mention_id_a", "mention_id_b").distinct()
    a, b = p.toDF("mention_id_a", "sa", "na"), p.toDF("mention_id_b", "sb", "nb")
    return d.join(a, "mention_id_a").join(b, "mention_id_b").filter("sa <> sb").select("decision_id", (F.coalesce(F.col("na") == F.col("nb"), F.lit(False))).alias("excused"))


def uri_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percent-encoded keys and short content hashes of the registry's names."""
    e = read(spark, sf_dir, "entities").filter("sjid is not null and canonical_name is not null")
    return e.select("sjid", F.replace(F.url_encode("canonical_name"), F.lit("+"), F.lit("%20")).alias("uri_key"), F.substring(F.sha1("canonical_name"), 1, 12).alias("alias_key")).distinct()


QUERIES = {
    f.__name__: f
    for f in (location_split, name_span, validity, leaf_paths, agency_lookup, transfer_partners, punct_fold_union, generation_split, placeholder_cross_case, gold_alignment, excused_pairs, uri_keys)
}

_T = "list_filter(string_split(trim(regexp_replace(lower(normalized_name), '\\s+', ' ', 'g')), ' '), lambda t: t <> '')"
_GEN = "('jr', 'sr', 'ii', 'iii', 'iv')"
_CORE = f"array_to_string(list_filter({_T}, lambda t: t NOT IN {_GEN}), ' ')"
_SOFT = f"list_filter({_T}, lambda t: t NOT IN {_GEN})[-1] || '|' || substr(normalized_name, 1, 1)"
_FOLDW = "list_filter(string_split(trim(regexp_replace(lower(normalized_name), '[^a-z0-9]+', ' ', 'g')), ' '), lambda t: t NOT IN ('and', 'the', 'of', ''))"


def _placed_sql() -> str:
    from docketweave.plans.clustering import _PLACED

    return _PLACED


SQL = {
    "location_split": rf"WITH m AS (SELECT mention_id, trim(regexp_replace(replace(address, chr(10), ', '), '[ -]*\d{{5}}(?:-\d{{4}})?.*$', '')) AS a FROM mentions WHERE address IS NOT NULL) SELECT mention_id, nullif(regexp_extract(a, '{LOCATION}', 1), '') AS core, nullif(regexp_extract(a, '{LOCATION}', 2), '') AS location FROM m WHERE regexp_extract(a, '{LOCATION}', 2) <> ''",
    "name_span": r"""WITH w AS (SELECT mention_id, regexp_split_to_array(trim(regexp_extract(raw_name, '^([^:]*)', 1)), '\s+') AS w FROM mentions WHERE entity_type = 'judge' AND raw_name IS NOT NULL),
      c AS (SELECT mention_id, w, list_filter(list_transform(w, lambda x, i: CASE WHEN i >= 3 AND regexp_matches(x, '^[a-z]+$') THEN i - 1 END), lambda x: x IS NOT NULL)[1] AS k FROM w) SELECT mention_id, array_to_string(w[1:coalesce(k, len(w))], ' ') AS span FROM c""",
    "validity": r"""WITH n AS (SELECT mention_id, nullif(trim(normalized_name), '') AS n FROM mentions), r AS (SELECT mention_id, concat_ws(',', CASE WHEN n IS NULL THEN 'empty' END, CASE WHEN regexp_matches(n, '[0-9]') THEN 'digits' END, CASE WHEN regexp_matches(n, '^[a-z]$') THEN 'single_letter_name' END,
      CASE WHEN length(n) > 120 THEN 'too_long' END, CASE WHEN regexp_matches(n, '\b(motion|motions|hearing|order|pursuant|referred|terminated)\b') THEN 'procedural' END) AS reasons FROM n) SELECT mention_id, reasons, reasons = '' AS kept FROM r""",
    "agency_lookup": r"""WITH m AS (SELECT DISTINCT mention_id, normalized_name, regexp_extract(normalized_name, '^(\S+) county department of (.+)$', 1) AS p, regexp_extract(normalized_name, '^(\S+) county department of (.+)$', 2) AS b FROM mentions WHERE entity_type = 'party' AND normalized_name LIKE '% county department of %'),
      v AS (SELECT p || '/' || b AS agency, normalized_name AS variant FROM m UNION SELECT p || '/' || b, b || ' department of ' || p || ' county' FROM m), u AS (SELECT variant, min(agency) AS agency FROM v GROUP BY variant HAVING count(DISTINCT agency) = 1)
      SELECT DISTINCT mention_id, agency FROM m JOIN u ON normalized_name = variant""",
    "transfer_partners": "WITH m AS (SELECT DISTINCT case_id, court, normalized_name AS n FROM mentions WHERE entity_type = 'judge' AND normalized_name IS NOT NULL AND case_id IS NOT NULL) SELECT a.n AS judge, string_agg(DISTINCT b.n, ';' ORDER BY b.n) AS partners FROM m a JOIN m b ON a.case_id = b.case_id AND a.court <> b.court AND a.n <> b.n GROUP BY a.n",
    "punct_fold_union": f"""WITH RECURSIVE k AS (SELECT DISTINCT sjid, entity_type, unnest(CASE WHEN length(array_to_string({_FOLDW}, '')) >= 6 THEN ['tok:' || array_to_string({_FOLDW}, ' '), 'join:' || array_to_string({_FOLDW}, '')] ELSE ['tok:' || array_to_string({_FOLDW}, ' ')] END) AS k FROM entities WHERE sjid IS NOT NULL AND normalized_name IS NOT NULL AND entity_type <> 'judge'),
      e AS (SELECT DISTINCT a.sjid AS a, b.sjid AS b FROM k a JOIN k b ON a.entity_type = b.entity_type AND a.k = b.k AND a.sjid <> b.sjid AND a.k <> 'tok:'), reach(id, other) AS (SELECT a, a FROM e UNION SELECT reach.id, e.b FROM reach JOIN e ON e.a = reach.other)
      SELECT id AS sjid, min(other) AS component FROM reach GROUP BY id""",
    "generation_split": f"""WITH m AS (SELECT DISTINCT mention_id, court, {_CORE} AS core, array_to_string(list_sort(list_distinct(list_filter({_T}, lambda t: t IN {_GEN}))), ',') AS gen FROM mentions WHERE entity_type = 'judge' AND normalized_name IS NOT NULL),
      s AS (SELECT court, core, count(DISTINCT gen) AS gens FROM m WHERE gen <> '' GROUP BY court, core) SELECT mention_id, concat_ws('|', m.court, m.core, CASE WHEN gens > 1 THEN gen ELSE '' END) AS grp FROM m LEFT JOIN s ON m.court = s.court AND m.core = s.core""",
    "placeholder_cross_case": "SELECT court, normalized_name, count(DISTINCT ucid) AS cases FROM mentions WHERE token_count = 1 AND normalized_name IS NOT NULL GROUP BY court, normalized_name HAVING count(DISTINCT ucid) > 1",
    "gold_alignment": f"""WITH e AS (SELECT DISTINCT sjid, normalized_name FROM entities WHERE sjid IS NOT NULL AND entity_type = 'judge' AND normalized_name IS NOT NULL), m AS (SELECT DISTINCT normalized_name FROM mentions WHERE entity_type = 'judge' AND normalized_name IS NOT NULL),
      k AS (SELECT {_CORE} AS core, {_SOFT} AS soft FROM m) SELECT sjid, normalized_name, CASE WHEN normalized_name IN (SELECT normalized_name FROM m) THEN 'exact' WHEN {_CORE} IN (SELECT core FROM k WHERE core IS NOT NULL) THEN 'core' WHEN {_SOFT} IN (SELECT soft FROM k WHERE soft IS NOT NULL) THEN 'soft' ELSE 'none' END AS aligned FROM e""",
    "excused_pairs": f"WITH {_placed_sql()}, d AS (SELECT DISTINCT decision_id, mention_id_a, mention_id_b FROM decisions WHERE upper(trim(decision)) IN ('MATCH', 'MERGE_TIER0', 'MERGE_TIER2')) SELECT decision_id, coalesce(a.fjc_nid = b.fjc_nid, false) AS excused FROM d JOIN p a ON a.mention_id = mention_id_a JOIN p b ON b.mention_id = mention_id_b WHERE a.sjid <> b.sjid",
}
