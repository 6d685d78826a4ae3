"""Sources, filters and table functions: case scans, evidence, spans, aliases, hygiene, profiles, directory links."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docketweave.functions import text as T
from docketweave.session import read


def scan_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "case_docs")
    return c.groupBy("court").agg(F.count("*").alias("n_docs"), F.count_distinct("ucid").alias("n_cases"), F.min("source_file").alias("first_file"), F.max("batch_no").alias("last_batch"))


def processed_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries whose file and content were not processed in an earlier batch."""
    c = read(spark, sf_dir, "case_docs").select("case_key", "source_file", "batch_no", F.sha2("case_json", 256).alias("digest"))
    first = c.groupBy("source_file", "digest").agg(F.min("batch_no").alias("first_batch"))
    return c.join(first, ["source_file", "digest"]).filter("batch_no = first_batch").select("case_key", "digest")


def record_copy_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offices of a case filled from the fullest row of the same name that has an address."""
    value = lambda c: F.when(F.upper(F.trim(c)) != "NA", T.nz(c))
    m = read(spark, sf_dir, "mentions").filter("entity_type = 'firm' and ucid is not null and normalized_name is not null")
    m = m.select("mention_id", "ucid", "normalized_name", *[value(c).alias(c) for c in ("address", "phone", "email")]).distinct()
    fill = sum(F.col(c).isNotNull().cast("int") for c in ("address", "phone", "email"))
    best = Window.partitionBy("ucid", "normalized_name").orderBy(F.desc("fill"), "mention_id", "address", "phone", "email")
    donors = m.filter("address is not null").withColumn("fill", fill).withColumn("rank", F.row_number().over(best)).filter("rank = 1")
    donors = donors.select("ucid", "normalized_name", *[F.col(c).alias(f"d_{c}") for c in ("address", "phone", "email")])
    return m.join(donors, ["ucid", "normalized_name"], "left").select("mention_id", *[F.coalesce(c, f"d_{c}").alias(c) for c in ("address", "phone", "email")]).distinct()


def neg_evidence_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judge spans of docket text that are no party or counsel name of their case."""
    m = read(spark, sf_dir, "mentions")
    spans = m.filter("entity_type = 'judge' and docket_source = 'line_entry' and normalized_name is not null").select("mention_id", "ucid", "normalized_name").distinct()
    listed = m.filter("entity_type <> 'judge'").select("ucid", "normalized_name").distinct()
    return spans.join(listed, ["ucid", "normalized_name"], "left_anti").select("mention_id")


def co_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Other names of the same case, sorted."""
    m = read(spark, sf_dir, "mentions").filter("normalized_name is not null and ucid is not null").select("mention_id", "ucid", "normalized_name").distinct()
    names = m.groupBy("ucid").agg(F.array_sort(F.collect_set("normalized_name")).alias("names"))
    return m.join(names, "ucid").select("mention_id", F.array_join(F.array_remove("names", F.col("normalized_name")), ";").alias("others"))


def case_sidecar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judges and firms of each case."""
    m = read(spark, sf_dir, "mentions").filter("ucid is not null")
    names = lambda kind: F.array_join(F.array_sort(F.collect_set(F.when(F.col("entity_type") == kind, F.col("normalized_name")))), ";")
    return m.groupBy("ucid").agg(names("judge").alias("judges"), names("firm").alias("firms"), F.count_distinct("mention_id").alias("n_mentions"))


SPAN = r"(?:Judge|Hon\.|Honorable) ((?:[A-Z][a-z]+|[A-Z]\.) (?:(?:[A-Z]\.|[A-Z][a-z]+) )?[A-Z][a-z]+(?:-[A-Z][a-z]+)?)"
TRANSFER = r"(?:[Tt]ransferred|[Rr]eassigned) to (?:the )?(?:Chief |Magistrate )?(?:Judge|Hon\.|Honorable) ((?:[A-Z][a-z]+|[A-Z]\.)(?: [A-Z]\.)?(?: [A-Z][a-z]+)?)"
ALIAS = r"(?i)(?:\bf/k/a|\ba/k/a|\bd/b/a|\ba\.k\.a\.|\bdba|\btrading as) ([^()]+)"


def docket_judge_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents").filter("text is not null")
    return d.select("doc_id", F.posexplode(F.regexp_extract_all("text", F.lit(SPAN), F.lit(1))).alias("span_no", "raw_name")).select("doc_id", F.col("span_no").cast("int").alias("span_no"), "raw_name")


def transfer_clues(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents").filter("text is not null")
    return d.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(TRANSFER), F.lit(1))).alias("to_name")).groupBy("to_name").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc"))


def alias_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alias text after an fka, aka or dba marker."""
    m = read(spark, sf_dir, "mentions").filter("raw_name is not null").select("mention_id", F.trim(F.regexp_extract("raw_name", ALIAS, 1)).alias("alias"))
    return m.filter("alias <> ''")


def hygiene(mentions: DataFrame) -> DataFrame:
    """keep, same_ucid_only or quarantine, by the shape of the name."""
    t = T.tokens(F.col("normalized_name"))
    n, ini = F.size(t), F.size(F.filter(t, lambda x: F.length(x) == 1))
    action = F.when(F.coalesce(n, F.lit(0)) <= 0, "quarantine").when((n == 1) & (F.length(t[0]) <= 2), "quarantine").when((n == 1) | (ini * 2 >= n), "same_ucid_only").otherwise("keep")
    return mentions.select("mention_id", "entity_type", action.alias("action"))


def hygiene_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hygiene(read(spark, sf_dir, "mentions"))


def info_barrier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reasons why a name says too little to be merged on."""
    t = T.tokens(F.col("normalized_name"))
    n, ini = F.size(t), F.size(F.filter(t, lambda x: F.length(x) == 1))
    m = read(spark, sf_dir, "mentions").filter("normalized_name is not null")
    reasons = F.array_compact(F.array(F.when(n == 1, F.lit("single_token")), F.when((n >= 2) & (ini * 2 >= n), F.lit("initials"))))
    return m.select("mention_id", F.array_join(reasons, ",").alias("reasons")).filter("reasons <> ''")


def token_company(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each last token of a judge's name: how many names it ends, and in how many courts."""
    m = read(spark, sf_dir, "mentions").filter("entity_type = 'judge' and normalized_name is not null").select("normalized_name", "court").distinct()
    return m.select(T.surname(F.col("normalized_name")).alias("token"), "normalized_name", "court").filter("token is not null").groupBy("token").agg(F.count_distinct("normalized_name").alias("names"), F.count_distinct("court").alias("courts"))


NOISE_TOKENS = ["presiding", "referred", "signed", "mag", "to", "terminated"]


def resolve_surname(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last token that is no suffix, noise or fragment, else the first."""
    m = read(spark, sf_dir, "mentions").filter("entity_type = 'judge' and normalized_name is not null")
    t = T.tokens(F.col("normalized_name"))
    kept = F.filter(t, lambda x: ~x.isin(*NOISE_TOKENS, *T.GENERATIONS) & (F.length(x) >= 3) & ~x.rlike("[0-9]"))
    return m.select("mention_id", F.coalesce(F.try_element_at(kept, F.lit(-1)), F.try_element_at(t, F.lit(1))).alias("resolved"))


def directory_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judge mentions linked to the directory by exact name and court; a key of several judges links nothing."""
    d = read(spark, sf_dir, "judge_directory").filter("nid is not null")
    codes = read(spark, sf_dir, "court_crosswalk").select(F.col("court_name").alias("court_name_1"), F.col("court_code").alias("court")).distinct()
    part = lambda c: T.nz(F.regexp_replace(F.lower(c), r"\.", ""))
    forms = d.join(codes, "court_name_1").select(
        "nid", "court",
        F.explode(F.array(F.concat_ws(" ", part("first_name"), part("middle_name"), part("last_name"), part("suffix")), F.concat_ws(" ", part("first_name"), part("last_name"), part("suffix")))).alias("normalized_name"),
    )
    unique = forms.groupBy("normalized_name", "court").agg(F.count_distinct("nid").alias("n"), F.min("nid").alias("nid")).filter("n = 1")
    m = read(spark, sf_dir, "mentions").filter("entity_type = 'judge' and normalized_name is not null").select("mention_id", "normalized_name", "court").distinct()
    return m.join(unique, ["normalized_name", "court"]).select("mention_id", "nid")


QUERIES = {
    f.__name__: f
    for f in (scan_cases, processed_dedup, record_copy_fill, neg_evidence_anti, co_mentions, case_sidecar, docket_judge_spans, transfer_clues, alias_parse, hygiene_split, info_barrier, token_company, resolve_surname, directory_link)
}

_T = "list_filter(string_split(trim(regexp_replace(lower(normalized_name), '\\s+', ' ', 'g')), ' '), lambda t: t <> '')"
_LAST = f"list_filter({_T}, lambda t: t NOT IN ('jr', 'sr', 'ii', 'iii', 'iv'))[-1]"
_V = "CASE WHEN upper(trim({0})) <> 'NA' THEN nullif(trim({0}), '') END AS {0}"
_P = "nullif(trim(replace(lower({0}), '.', '')), '')"
SQL = {
    "scan_cases": "SELECT court, count(*) AS n_docs, count(DISTINCT ucid) AS n_cases, min(source_file) AS first_file, max(batch_no) AS last_batch FROM case_docs GROUP BY court",
    "processed_dedup": "WITH c AS (SELECT case_key, batch_no, sha256(case_json) AS digest, min(batch_no) OVER (PARTITION BY source_file, sha256(case_json)) AS f FROM case_docs) SELECT case_key, digest FROM c WHERE batch_no = f",
    "record_copy_fill": f"""WITH m AS (SELECT DISTINCT mention_id, ucid, normalized_name, {_V.format('address')}, {_V.format('phone')}, {_V.format('email')} FROM mentions WHERE entity_type = 'firm' AND ucid IS NOT NULL AND normalized_name IS NOT NULL),
      d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ucid, normalized_name ORDER BY (address IS NOT NULL)::INT + (phone IS NOT NULL)::INT + (email IS NOT NULL)::INT DESC, mention_id, address NULLS FIRST, phone NULLS FIRST, email NULLS FIRST) AS r FROM m WHERE address IS NOT NULL) WHERE r = 1)
      SELECT DISTINCT m.mention_id, coalesce(m.address, d.address) AS address, coalesce(m.phone, d.phone) AS phone, coalesce(m.email, d.email) AS email FROM m LEFT JOIN d ON m.ucid = d.ucid AND m.normalized_name = d.normalized_name""",
    "neg_evidence_anti": "SELECT DISTINCT mention_id FROM mentions a WHERE entity_type = 'judge' AND docket_source = 'line_entry' AND normalized_name IS NOT NULL AND NOT EXISTS (SELECT 1 FROM mentions b WHERE b.entity_type <> 'judge' AND b.ucid = a.ucid AND b.normalized_name = a.normalized_name)",
    "co_mentions": "WITH m AS (SELECT DISTINCT mention_id, ucid, normalized_name FROM mentions WHERE normalized_name IS NOT NULL AND ucid IS NOT NULL), n AS (SELECT ucid, list_sort(list(DISTINCT normalized_name)) AS names FROM m GROUP BY ucid) SELECT mention_id, array_to_string(list_filter(names, lambda x: x <> normalized_name), ';') AS others FROM m JOIN n USING (ucid)",
    "case_sidecar": """SELECT ucid, coalesce(string_agg(DISTINCT CASE WHEN entity_type = 'judge' THEN normalized_name END, ';' ORDER BY CASE WHEN entity_type = 'judge' THEN normalized_name END), '') AS judges,
      coalesce(string_agg(DISTINCT CASE WHEN entity_type = 'firm' THEN normalized_name END, ';' ORDER BY CASE WHEN entity_type = 'firm' THEN normalized_name END), '') AS firms, count(DISTINCT mention_id) AS n_mentions FROM mentions WHERE ucid IS NOT NULL GROUP BY ucid""",
    "docket_judge_spans": f"WITH s AS (SELECT doc_id, regexp_extract_all(text, '{SPAN}', 1) AS l FROM documents WHERE text IS NOT NULL) SELECT doc_id, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS span_no, unnest(l) AS raw_name FROM s",
    "transfer_clues": f"WITH s AS (SELECT doc_id, unnest(regexp_extract_all(text, '{TRANSFER}', 1)) AS to_name FROM documents WHERE text IS NOT NULL) SELECT to_name, count(*) AS n, min(doc_id) AS first_doc FROM s GROUP BY to_name",
    "alias_parse": f"SELECT * FROM (SELECT mention_id, trim(regexp_extract(raw_name, '{ALIAS}', 1)) AS alias FROM mentions WHERE raw_name IS NOT NULL) WHERE alias <> ''",
    "hygiene_split": f"""WITH t AS (SELECT mention_id, entity_type, {_T} AS t FROM mentions), n AS (SELECT *, len(t) AS n, len(list_filter(t, lambda x: length(x) = 1)) AS i FROM t)
      SELECT mention_id, entity_type, CASE WHEN coalesce(n, 0) <= 0 THEN 'quarantine' WHEN n = 1 AND length(t[1]) <= 2 THEN 'quarantine' WHEN n = 1 OR i * 2 >= n THEN 'same_ucid_only' ELSE 'keep' END AS action FROM n""",
    "info_barrier": f"""WITH t AS (SELECT mention_id, {_T} AS t FROM mentions WHERE normalized_name IS NOT NULL), n AS (SELECT mention_id, len(t) AS n, len(list_filter(t, lambda x: length(x) = 1)) AS i FROM t)
      SELECT mention_id, CASE WHEN n = 1 THEN 'single_token' ELSE 'initials' END AS reasons FROM n WHERE n = 1 OR (n >= 2 AND i * 2 >= n)""",
    "token_company": f"WITH m AS (SELECT DISTINCT normalized_name, court, {_LAST} AS token FROM mentions WHERE entity_type = 'judge' AND normalized_name IS NOT NULL) SELECT token, count(DISTINCT normalized_name) AS names, count(DISTINCT court) AS courts FROM m WHERE token IS NOT NULL GROUP BY token",
    "resolve_surname": f"""WITH t AS (SELECT mention_id, {_T} AS t FROM mentions WHERE entity_type = 'judge' AND normalized_name IS NOT NULL)
      SELECT mention_id, coalesce(list_filter(t, lambda x: x NOT IN ('presiding', 'referred', 'signed', 'mag', 'to', 'terminated', 'jr', 'sr', 'ii', 'iii', 'iv') AND length(x) >= 3 AND NOT regexp_matches(x, '[0-9]'))[-1], t[1]) AS resolved FROM t""",
    "directory_link": f"""WITH d AS (SELECT nid, court_code AS court, {_P.format('first_name')} AS f, {_P.format('middle_name')} AS m, {_P.format('last_name')} AS l, {_P.format('suffix')} AS s FROM judge_directory JOIN (SELECT DISTINCT court_name, court_code FROM court_crosswalk) ON court_name = court_name_1 WHERE nid IS NOT NULL),
      forms AS (SELECT nid, court, concat_ws(' ', f, m, l, s) AS normalized_name FROM d UNION SELECT nid, court, concat_ws(' ', f, l, s) FROM d),
      u AS (SELECT normalized_name, court, min(nid) AS nid FROM forms GROUP BY normalized_name, court HAVING count(DISTINCT nid) = 1)
      SELECT DISTINCT mention_id, u.nid FROM mentions JOIN u USING (normalized_name, court) WHERE entity_type = 'judge'""",
}
