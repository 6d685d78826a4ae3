"""Similarity joins, vetoes and adjudication of pairs."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docketweave.functions import text as T
from docketweave.session import read

#: Thresholds of the similarity bands over the sample vectors.
MIN_SIM, AUTO_SIM, TOP_K = 0.25, 0.35, 25


def dot(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(F.col(a), F.col(b), lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def block_reps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One representative per directory number (or mention) of a court's surname block."""
    m = read(spark, sf_dir, "mentions").filter("entity_type = 'judge' and normalized_name is not null")
    rows = m.select("mention_id", F.concat_ws("|", "court", T.surname(F.col("normalized_name"))).alias("block_key"), F.coalesce(F.col("fjc_nid").cast("string"), "normalized_name").alias("root"))
    return rows.groupBy("block_key", "root").agg(F.min("mention_id").alias("rep"))


def cosine_pairs(vectors: DataFrame, least: float = MIN_SIM) -> DataFrame:
    """(a, b, sim) of one block with at least that similarity; pairs below it never leave the join."""
    v = vectors.select("vec_id", "label", "embedding")
    a = v.select(F.col("vec_id").alias("a"), "label", F.col("embedding").alias("x"))
    b = v.select(F.col("vec_id").alias("b"), "label", F.col("embedding").alias("y"))
    sim = dot("x", "y")
    return a.join(b, "label").filter((F.col("a") < F.col("b")) & (sim >= least)).select("a", "b", F.round(sim, 6).alias("sim"))


def block_pairs_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cosine_pairs(read(spark, sf_dir, "embeddings"))


def topk_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The TOP_K nearest of all vectors for every vector whose id is divisible by 100; the queries go to the rows in blocks."""
    v = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    queries = v.filter("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("x"))
    blocks = queries.groupBy(F.pmod(F.xxhash64("query_id"), F.lit(16)).alias("part")).agg(F.collect_list(F.struct("query_id", "x")).alias("qs"))
    pairs = v.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(15)))).join(blocks, "part").select("vec_id", "embedding", F.explode("qs").alias("q"))
    scored = pairs.filter("vec_id <> q.query_id").select(F.col("q.query_id").alias("query_id"), "vec_id", F.round(dot("embedding", "q.x"), 6).alias("sim"))
    order = Window.partitionBy("query_id").orderBy(F.desc("sim"), "vec_id")
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= TOP_K).select("query_id", "vec_id", "sim", "rank")


def band_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = cosine_pairs(read(spark, sf_dir, "embeddings"))
    return pairs.select("a", "b", F.when(F.col("sim") >= AUTO_SIM, "MERGE_TIER2").otherwise("AMBIGUOUS").alias("band"), F.round(F.col("sim") * 100).cast("int").alias("confidence"))


def candidate_pairs(mentions: DataFrame) -> DataFrame:
    """Pairs of different party names that begin alike in one court, with both sides' facts."""
    m = mentions.filter("entity_type = 'party' and normalized_name is not null").select("court", "normalized_name", "raw_name", "party_role", T.legal_form(F.col("raw_name")).alias("form"))
    m = m.groupBy("court", "normalized_name").agg(F.min("raw_name").alias("raw_name"), F.min("party_role").alias("role"), F.min("form").alias("form"))
    t = T.tokens(F.col("normalized_name"))
    m = m.withColumn("lead", t[0]).withColumn("gen", F.array_join(F.filter(t, lambda x: x.isin(T.GENERATIONS)), ","))
    side = lambda s: m.select("court", "lead", *[F.col(c).alias(f"{c}_{s}") for c in ("normalized_name", "role", "form", "gen")])
    return side("a").join(side("b"), ["court", "lead"]).filter("normalized_name_a < normalized_name_b")


PLAINTIFF, DEFENDANT = ["Plaintiff", "Petitioner", "Appellant"], ["Defendant", "Respondent", "Appellee"]


def verdict() -> Column:
    """The first veto that applies to a candidate pair, in order; ok where none does."""
    opposing = (F.col("role_a").isin(PLAINTIFF) & F.col("role_b").isin(DEFENDANT)) | (F.col("role_a").isin(DEFENDANT) & F.col("role_b").isin(PLAINTIFF))
    sub = F.col("normalized_name_b").startswith(F.concat(F.col("normalized_name_a"), F.lit(" "))) & F.col("normalized_name_b").rlike(r"\b(department|division|office|branch)\b")
    return (
        F.when(F.col("gen_a") != F.col("gen_b"), "generational_suffix")
        .when(F.col("form_a") != F.col("form_b"), "legal_entity_form")
        .when(sub, "parent_subunit")
        .when(opposing, "opposing_roles")
        .otherwise("ok")
    )


def veto_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candidate_pairs(read(spark, sf_dir, "mentions")).select("court", "normalized_name_a", "normalized_name_b", verdict().alias("verdict"))


def role_conflict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names that stand on both sides of one case."""
    side = F.when(F.col("party_role").isin(PLAINTIFF), "p").when(F.col("party_role").isin(DEFENDANT), "d")
    m = read(spark, sf_dir, "mentions").filter("entity_type = 'party' and normalized_name is not null").select("ucid", "normalized_name", side.alias("side")).filter("side is not null")
    return m.groupBy("ucid", "normalized_name").agg(F.count_distinct("side").alias("sides")).filter("sides > 1").select("ucid", "normalized_name")


def geo_conflict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Office names that are found in several cities."""
    geo = T.office_geo(F.col("address"))
    m = read(spark, sf_dir, "mentions").filter("entity_type = 'firm' and normalized_name is not null").select("normalized_name", geo.alias("geo")).filter("geo is not null")
    return m.groupBy("normalized_name").agg(F.count_distinct("geo").alias("cities"), F.min("geo").alias("first_city"), F.max("geo").alias("last_city")).filter("cities > 1")


def _ratios(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """100 * 2 * LCS / (|a| + |b|), by bit-parallel longest common subsequences."""
    for b in batches:
        out = []
        for x, y in zip(b["normalized_name_a"], b["normalized_name_b"]):
            masks: dict[str, int] = {}
            for i, ch in enumerate(x):
                masks[ch] = masks.get(ch, 0) | (1 << i)
            s = full = (1 << len(x)) - 1
            for ch in y:
                u = s & masks.get(ch, 0)
                s = ((s + u) | (s - u)) & full
            out.append(round(200.0 * (len(x) - bin(s).count("1")) / max(1, len(x) + len(y)), 6))
        yield b[["court", "normalized_name_a", "normalized_name_b"]].assign(ratio=out)


def fuzz_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Similarity of candidate names by longest common subsequence."""
    pairs = candidate_pairs(read(spark, sf_dir, "mentions")).select("court", "normalized_name_a", "normalized_name_b")
    return pairs.mapInPandas(_ratios, "court string, normalized_name_a string, normalized_name_b string, ratio double")


def _decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "decisions").filter("mention_id_a is not null and mention_id_b is not null and mention_id_a <> mention_id_b")
    return d.withColumn("decision", F.upper(F.trim("decision")))


def budget_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Undecided pairs by nearness to the middle of the band; the first 15 % are within the budget."""
    d = _decisions(spark, sf_dir).filter("decision in ('UNCERTAIN', 'SKIP_BUDGET') and confidence is not null").select("decision_id", F.abs(F.col("confidence") - 60).alias("off")).distinct()
    total = d.agg(F.greatest(F.floor(F.count("*") * 0.15), F.lit(1)).alias("budget"))
    # Rank over counts of each distance, of which there are few, then within one distance.
    steps = d.groupBy("off").agg(F.count("*").alias("n"))
    before = steps.alias("s").join(steps.alias("t"), F.col("t.off") < F.col("s.off"), "left").groupBy(F.col("s.off").alias("off")).agg(F.coalesce(F.sum("t.n"), F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("off").orderBy("decision_id"))
    return d.withColumn("within", within).join(before, "off").crossJoin(total).select("decision_id", (F.col("before") + F.col("within")).cast("bigint").alias("rank"), (F.col("before") + F.col("within") <= F.col("budget")).alias("in_budget"))


FACTS = ["same_court", "same_case", "same_name", "same_email", "same_phone", "same_surname"]


def facts(decisions: DataFrame, mentions: DataFrame) -> DataFrame:
    """The truth of each checkable claim about a decided pair."""
    m = mentions.groupBy("mention_id").agg(*[F.min(c).alias(c) for c in ("court", "ucid", "normalized_name", "email", "phone", "surname")])
    side = lambda s: m.select(F.col("mention_id").alias(f"mention_id_{s}"), *[F.col(c).alias(f"{c}_{s}") for c in ("court", "ucid", "normalized_name", "email", "phone", "surname")])
    same = lambda c: F.coalesce(T.nz(f"{c}_a") == T.nz(f"{c}_b"), F.lit(False))
    pairs = decisions.select("decision_id", "mention_id_a", "mention_id_b", "decision", "confidence", "signals").distinct()
    joined = pairs.join(side("a"), "mention_id_a").join(side("b"), "mention_id_b")
    columns = dict(zip(FACTS, ("court", "ucid", "normalized_name", "email", "phone", "surname")))
    return joined.select("decision_id", "decision", "confidence", "signals", *[same(c).alias(f) for f, c in columns.items()])


def truth_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts(_decisions(spark, sf_dir), read(spark, sf_dir, "mentions")).select("decision_id", *FACTS).distinct()


def citation_verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions after their cited signals are checked: a false claim makes a pair uncertain."""
    t = facts(_decisions(spark, sf_dir), read(spark, sf_dir, "mentions"))
    false_claim = F.coalesce(F.array_contains("signals", "same_ucid") & ~F.col("same_case"), F.lit(False)) | F.coalesce(F.array_contains("signals", "surname_only") & ~F.col("same_surname"), F.lit(False))
    final = F.when(F.col("decision").isin("MATCH", "NO_MATCH") & (F.size("signals") == 0), "UNCERTAIN").when(false_claim, "UNCERTAIN").otherwise(F.col("decision"))
    return t.select("decision_id", "decision", final.alias("verified")).distinct()


def match_bar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches that no discriminating fact supports."""
    t = facts(_decisions(spark, sf_dir), read(spark, sf_dir, "mentions")).filter("decision = 'MATCH'")
    return t.filter("not (same_email or same_phone or (same_name and same_court))").select("decision_id").distinct()


def abstain_rails(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = facts(_decisions(spark, sf_dir), read(spark, sf_dir, "mentions"))
    rail = F.when(F.col("confidence").isNull() | (F.col("confidence") < 60), "UNCERTAIN").when(F.col("same_case") & ~F.col("same_surname") & (F.col("decision") == "MATCH"), "NO_MATCH").otherwise(F.col("decision"))
    return t.select("decision_id", "confidence", rail.alias("railed")).distinct()


def shared_case_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Party names that share a surname in one court and a judge between their cases."""
    m = read(spark, sf_dir, "mentions").filter("ucid is not null and normalized_name is not null")
    judges = m.filter("entity_type = 'judge'").select("ucid", F.col("normalized_name").alias("judge")).distinct()
    p = m.filter("entity_type = 'party'").select("court", T.surname(F.col("normalized_name")).alias("last"), "normalized_name", "ucid").distinct().join(judges, "ucid").select("court", "last", "judge", "normalized_name").distinct()
    a, b = p.withColumnRenamed("normalized_name", "name_a"), p.withColumnRenamed("normalized_name", "name_b")
    return a.join(b, ["court", "last", "judge"]).filter("name_a < name_b").groupBy("court", "name_a", "name_b").agg(F.count_distinct("judge").alias("shared_judges"))


QUERIES = {
    f.__name__: f
    for f in (block_reps, block_pairs_cosine, topk_probe, band_split, veto_verdict, role_conflict, geo_conflict, fuzz_ratio, budget_rank, truth_table, citation_verify, match_bar, abstain_rails, shared_case_pairs)
}

_TOK = "list_filter(string_split(trim(regexp_replace(lower(normalized_name), '\\s+', ' ', 'g')), ' '), lambda t: t <> '')"
_LAST = f"list_filter({_TOK}, lambda t: t NOT IN ('jr', 'sr', 'ii', 'iii', 'iv'))[-1]"
_PAIRS = "SELECT p.vec_id AS a, q.vec_id AS b, round(list_inner_product(p.embedding::DOUBLE[], q.embedding::DOUBLE[]), 6) AS sim, list_inner_product(p.embedding::DOUBLE[], q.embedding::DOUBLE[]) AS exact FROM embeddings p JOIN embeddings q ON p.label = q.label AND p.vec_id < q.vec_id"
_D = "SELECT DISTINCT decision_id, mention_id_a, mention_id_b, upper(trim(decision)) AS decision, confidence, signals FROM decisions WHERE mention_id_a IS NOT NULL AND mention_id_b IS NOT NULL AND mention_id_a <> mention_id_b"


def _facts_sql() -> str:
    columns = ("court", "ucid", "normalized_name", "email", "phone", "surname")
    m = ", ".join(f"min({c}) AS {c}" for c in columns)
    same = ", ".join(f"coalesce(nullif(trim(a.{c}), '') = nullif(trim(b.{c}), ''), false) AS {f}" for f, c in zip(FACTS, columns))
    return f"WITH d AS ({_D}), m AS (SELECT mention_id, {m} FROM mentions GROUP BY mention_id), t AS (SELECT decision_id, decision, confidence, signals, {same} FROM d JOIN m a ON a.mention_id = mention_id_a JOIN m b ON b.mention_id = mention_id_b) "


def _candidates_sql() -> str:
    from docketweave.plans.normalisation import _form_case

    return f"""WITH m AS (SELECT court, normalized_name, min(party_role) AS role, min({_form_case()}) AS form FROM mentions WHERE entity_type = 'party' AND normalized_name IS NOT NULL GROUP BY court, normalized_name),
      n AS (SELECT *, {_TOK}[1] AS lead, array_to_string(list_filter({_TOK}, lambda t: t IN ('jr', 'sr', 'ii', 'iii', 'iv')), ',') AS gen FROM m),
      c AS (SELECT a.court, a.normalized_name AS normalized_name_a, b.normalized_name AS normalized_name_b, a.role AS role_a, b.role AS role_b, a.form AS form_a, b.form AS form_b, a.gen AS gen_a, b.gen AS gen_b
        FROM n a JOIN n b ON a.court = b.court AND a.lead = b.lead AND a.normalized_name < b.normalized_name) """


SQL = {
    "block_reps": f"WITH r AS (SELECT mention_id, concat_ws('|', court, {_LAST}) AS block_key, coalesce(CAST(fjc_nid AS VARCHAR), normalized_name) AS root FROM mentions WHERE entity_type = 'judge' AND normalized_name IS NOT NULL) SELECT block_key, root, min(mention_id) AS rep FROM r GROUP BY block_key, root",
    "block_pairs_cosine": f"SELECT a, b, sim FROM ({_PAIRS}) WHERE exact >= {MIN_SIM}",
    "topk_probe": f"WITH s AS (SELECT q.vec_id AS query_id, v.vec_id, round(list_inner_product(v.embedding::DOUBLE[], q.embedding::DOUBLE[]), 6) AS sim FROM embeddings q JOIN embeddings v ON q.vec_id % 100 = 0 AND v.vec_id <> q.vec_id) SELECT query_id, vec_id, sim, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, vec_id) AS rank FROM s) WHERE rank <= {TOP_K}",
    "band_split": f"SELECT a, b, CASE WHEN sim >= {AUTO_SIM} THEN 'MERGE_TIER2' ELSE 'AMBIGUOUS' END AS band, CAST(round(sim * 100) AS INTEGER) AS confidence FROM ({_PAIRS}) WHERE exact >= {MIN_SIM}",
    "veto_verdict": _candidates_sql()
    + r"""SELECT court, normalized_name_a, normalized_name_b, CASE WHEN gen_a <> gen_b THEN 'generational_suffix' WHEN form_a <> form_b THEN 'legal_entity_form'
      WHEN starts_with(normalized_name_b, normalized_name_a || ' ') AND regexp_matches(normalized_name_b, '\b(department|division|office|branch)\b') THEN 'parent_subunit'
      WHEN (role_a IN ('Plaintiff', 'Petitioner', 'Appellant') AND role_b IN ('Defendant', 'Respondent', 'Appellee')) OR (role_b IN ('Plaintiff', 'Petitioner', 'Appellant') AND role_a IN ('Defendant', 'Respondent', 'Appellee')) THEN 'opposing_roles' ELSE 'ok' END AS verdict FROM c""",
    "role_conflict": """WITH m AS (SELECT ucid, normalized_name, CASE WHEN party_role IN ('Plaintiff', 'Petitioner', 'Appellant') THEN 'p' WHEN party_role IN ('Defendant', 'Respondent', 'Appellee') THEN 'd' END AS side FROM mentions WHERE entity_type = 'party' AND normalized_name IS NOT NULL)
      SELECT ucid, normalized_name FROM m WHERE side IS NOT NULL GROUP BY ucid, normalized_name HAVING count(DISTINCT side) > 1""",
    "geo_conflict": """WITH l AS (SELECT normalized_name, list_filter(list_transform(list_reverse(string_split(address, chr(10))), lambda s: regexp_extract(s, '^\\s*([A-Za-z .''-]+), ([A-Z]{2})(?: [0-9-]+)?\\s*$', 0)), lambda s: s <> '')[1] AS line FROM mentions WHERE entity_type = 'firm' AND normalized_name IS NOT NULL),
      g AS (SELECT normalized_name, concat(lower(regexp_extract(line, '^\\s*([A-Za-z .''-]+), ([A-Z]{2})(?: [0-9-]+)?\\s*$', 1)), '|', regexp_extract(line, '^\\s*([A-Za-z .''-]+), ([A-Z]{2})(?: [0-9-]+)?\\s*$', 2)) AS geo FROM l WHERE line IS NOT NULL)
      SELECT normalized_name, count(DISTINCT geo) AS cities, min(geo) AS first_city, max(geo) AS last_city FROM g GROUP BY normalized_name HAVING count(DISTINCT geo) > 1""".replace("\\\\", "\\"),
    "budget_rank": f"WITH d AS (SELECT DISTINCT decision_id, abs(confidence - 60) AS off FROM ({_D}) WHERE decision IN ('UNCERTAIN', 'SKIP_BUDGET') AND confidence IS NOT NULL) SELECT decision_id, row_number() OVER (ORDER BY off, decision_id) AS rank, row_number() OVER (ORDER BY off, decision_id) <= greatest(floor((SELECT count(*) FROM d) * 0.15), 1) AS in_budget FROM d",
    "truth_table": _facts_sql() + f"SELECT DISTINCT decision_id, {', '.join(FACTS)} FROM t",
    "citation_verify": _facts_sql()
    + """SELECT DISTINCT decision_id, decision, CASE WHEN decision IN ('MATCH', 'NO_MATCH') AND len(signals) = 0 THEN 'UNCERTAIN'
      WHEN coalesce(list_contains(signals, 'same_ucid') AND NOT same_case, false) OR coalesce(list_contains(signals, 'surname_only') AND NOT same_surname, false) THEN 'UNCERTAIN' ELSE decision END AS verified FROM t""",
    "match_bar": _facts_sql() + "SELECT DISTINCT decision_id FROM t WHERE decision = 'MATCH' AND NOT (same_email OR same_phone OR (same_name AND same_court))",
    "abstain_rails": _facts_sql() + "SELECT DISTINCT decision_id, confidence, CASE WHEN confidence IS NULL OR confidence < 60 THEN 'UNCERTAIN' WHEN same_case AND NOT same_surname AND decision = 'MATCH' THEN 'NO_MATCH' ELSE decision END AS railed FROM t",
    "shared_case_pairs": f"""WITH m AS (SELECT * FROM mentions WHERE ucid IS NOT NULL AND normalized_name IS NOT NULL), j AS (SELECT DISTINCT ucid, normalized_name AS judge FROM m WHERE entity_type = 'judge'),
      p AS (SELECT DISTINCT court, {_LAST} AS l, judge, normalized_name FROM m JOIN j USING (ucid) WHERE entity_type = 'party')
      SELECT a.court, a.normalized_name AS name_a, b.normalized_name AS name_b, count(DISTINCT a.judge) AS shared_judges FROM p a JOIN p b ON a.court = b.court AND a.l = b.l AND a.judge = b.judge AND a.normalized_name < b.normalized_name GROUP BY ALL""",
}
