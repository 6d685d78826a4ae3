"""Triples, quality measures, audits and invariants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docketweave.functions import text as T
from docketweave.plans.clustering import members, placed
from docketweave.session import read

NAMESPACE = "urn:dw:"


def predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(mention_id, gold, pred): registry id against grouping by type, name and court."""
    key = F.concat_ws("|", "entity_type", "normalized_name", "court")
    return placed(spark, sf_dir).filter("normalized_name is not null").select("mention_id", F.col("sjid").alias("gold"), key.alias("pred"))


def _pairs(n: str) -> Column:
    return F.coalesce(F.sum(F.col(n) * (F.col(n) - 1) / 2), F.lit(0.0))


def pairwise_prf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairwise precision, recall and F1 from contingency counts; no pair is built."""
    p = predicted(spark, sf_dir)
    cells = p.groupBy("gold", "pred").agg(F.count("*").alias("n"))
    both = cells.agg(_pairs("n").alias("both"))
    gold = cells.groupBy("gold").agg(F.sum("n").alias("n")).agg(_pairs("n").alias("gold"))
    pred = cells.groupBy("pred").agg(F.sum("n").alias("n")).agg(_pairs("n").alias("pred"))
    row = both.crossJoin(gold).crossJoin(pred)  # three single rows
    p_, r_ = F.col("both") / F.col("pred"), F.col("both") / F.col("gold")
    return row.select(F.round(p_, 6).alias("precision"), F.round(r_, 6).alias("recall"), F.round(2 * p_ * r_ / (p_ + r_), 6).alias("f1"))


def b_cubed(p: DataFrame) -> DataFrame:
    cells = p.groupBy("gold", "pred").agg(F.count("*").alias("n"))
    g, q = cells.groupBy("gold").agg(F.sum("n").alias("g")), cells.groupBy("pred").agg(F.sum("n").alias("p"))
    c = cells.join(g, "gold").join(q, "pred")
    total = F.sum("n")
    return c.agg(F.round(F.sum(F.col("n") * F.col("n") / F.col("p")) / total, 6).alias("precision"), F.round(F.sum(F.col("n") * F.col("n") / F.col("g")) / total, 6).alias("recall"))


def b3_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b_cubed(predicted(spark, sf_dir))


def b3_shared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B-cubed over the mentions that lie in a gold entity of two or more."""
    p = predicted(spark, sf_dir)
    return b_cubed(p.join(p.groupBy("gold").agg(F.count("*").alias("n")).filter("n > 1").select("gold"), "gold", "left_semi"))


def id_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Directory numbers spread over several entities, and entities with several numbers."""
    p = placed(spark, sf_dir).filter("fjc_nid is not null")
    a = p.groupBy(F.col("fjc_nid").cast("string").alias("key")).agg(F.count_distinct("sjid").alias("n")).filter("n > 1").withColumn("kind", F.lit("split"))
    b = p.groupBy(F.col("sjid").alias("key")).agg(F.count_distinct("fjc_nid").alias("n")).filter("n > 1").withColumn("kind", F.lit("merge"))
    return a.union(b)


def name_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = placed(spark, sf_dir).filter("normalized_name is not null")
    return p.groupBy("entity_type", "normalized_name").agg(F.count_distinct("sjid").alias("ids")).filter("ids > 1")


def coparty_merges(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = placed(spark, sf_dir).filter("entity_type = 'party' and party_enum is not null")
    return p.groupBy("sjid", "ucid").agg(F.count_distinct("party_enum").alias("entries"), F.count_distinct("normalized_name").alias("names")).filter("entries > 1 and names > 1")


def junk_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    junk = F.col("raw_name").rlike(r" [a-z]+$") | F.col("raw_name").contains(":") | F.col("raw_name").rlike(r"[a-z][A-Z]")
    return read(spark, sf_dir, "mentions").filter(junk).groupBy("entity_type", "raw_name").agg(F.count("*").alias("n"))


def partition_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups that one partition joins and the other splits, by full outer join on the mention."""
    key = F.concat_ws("|", "entity_type", "normalized_name")
    after = read(spark, sf_dir, "mentions").filter("normalized_name is not null").groupBy("mention_id").agg(F.min(key).alias("after"))
    both = members(spark, sf_dir).join(after, "mention_id", "full").select(F.coalesce("sjid", F.lit("<new mention>")).alias("before"), F.coalesce("after", F.lit("<dropped mention>")).alias("after")).distinct()
    merges = both.groupBy(F.col("after").alias("grp")).agg(F.count_distinct("before").alias("n")).filter("n > 1").withColumn("kind", F.lit("merge"))
    splits = both.groupBy(F.col("before").alias("grp")).agg(F.count_distinct("after").alias("n")).filter("n > 1").withColumn("kind", F.lit("split"))
    return merges.union(splits)


def multiset_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mentions of the history that differ from their incoming redelivery, as multisets without volatile fields."""
    columns = ["mention_id", "raw_name", "court", "ucid", "role"]
    m, i = read(spark, sf_dir, "mentions").select(*columns), read(spark, sf_dir, "incoming_mentions").select(*columns)
    return i.exceptAll(m)


def stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten audit rows of every entity type and source, by a seeded hash order."""
    m = read(spark, sf_dir, "mentions").select("mention_id", "entity_type", "docket_source").distinct()
    order = Window.partitionBy("entity_type", "docket_source").orderBy("h", "mention_id")
    return m.withColumn("h", F.sha1(F.concat("mention_id", F.lit("#7")))).withColumn("k", F.row_number().over(order)).filter("k <= 10").select("mention_id", "entity_type", "docket_source", "k")


def structural_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of each decision on pairs that the registry holds to be the same or different."""
    d = read(spark, sf_dir, "decisions").select("decision_id", "mention_id_a", "mention_id_b", F.upper(F.trim("decision")).alias("decision")).distinct()
    g = members(spark, sf_dir)
    a, b = g.select(F.col("mention_id").alias("mention_id_a"), F.col("sjid").alias("sa")), g.select(F.col("mention_id").alias("mention_id_b"), F.col("sjid").alias("sb"))
    t = d.join(a, "mention_id_a").join(b, "mention_id_b").select("decision", F.when(F.col("sa") == F.col("sb"), "SAME").otherwise("DIFFERENT").alias("truth"))
    return t.groupBy("truth", "decision").agg(F.count("*").alias("n"))


def fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One hash a court over its mentions' canonical rows, independent of row order."""
    m = read(spark, sf_dir, "mentions").select("court", F.md5(F.concat_ws("|", "mention_id", F.coalesce("raw_name", F.lit("")), F.coalesce("role", F.lit("")))).alias("h"))
    digits = F.conv(F.substring("h", 1, 10), 16, 10).cast("bigint")
    return m.groupBy("court").agg(F.count("*").alias("n"), F.sum(digits).alias("checksum"))


def invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Violations of the registry's invariants by name; zero everywhere in a sound registry."""
    p = placed(spark, sf_dir)
    several = p.groupBy("mention_id").agg(F.count_distinct("sjid").alias("n")).filter("n > 1")
    nids = p.groupBy("sjid").agg(F.count_distinct("fjc_nid").alias("n")).filter("n > 1")
    types = p.groupBy("sjid").agg(F.count_distinct("entity_type").alias("n")).filter("n > 1")
    missing = members(spark, sf_dir).join(read(spark, sf_dir, "mentions").select("mention_id").distinct(), "mention_id", "left_anti")
    count = lambda df, name: df.agg(F.count("*").alias("violations")).withColumn("invariant", F.lit(name))
    return count(several, "mention_in_one_entity").union(count(nids, "one_number_per_entity")).union(count(types, "one_type_per_entity")).union(count(missing, "members_exist"))


def decision_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "decisions").select(F.coalesce("method", F.lit("?")).alias("method"), F.upper(F.trim("decision")).alias("decision"))
    return d.rollup("method", "decision").agg(F.count("*").alias("n"))


def run_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = read(spark, sf_dir, "mentions")
    return m.groupBy("entity_type", "extraction_method").agg(F.count("*").alias("n_rows"), F.count_distinct("mention_id").alias("n_mentions"), F.count_distinct("ucid").alias("n_cases"))


def name_validity_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First and last filing date of every name of every entity."""
    p = placed(spark, sf_dir).select("sjid", F.col("presentable_name").alias("label"), T.iso_date(F.col("filing_date")).alias("day")).filter("label is not null and day is not null")
    return p.groupBy("sjid", "label").agg(F.min("day").alias("valid_from"), F.max("day").alias("valid_to"))


def triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(s, p, o) of the registry: types, names, courts, members, numbers and domains."""
    e = read(spark, sf_dir, "entities").filter("sjid is not null")
    subject = F.concat(F.lit(NAMESPACE), F.col("sjid")).alias("s")
    escaped = F.replace(F.replace(F.replace("canonical_name", F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit("\n"), F.lit("\\n"))
    one = lambda p, o: e.select(subject, F.lit(p).alias("p"), o.alias("o")).withColumn("o", F.col("o").cast("string"))
    parts = [one("type", F.col("entity_type")), one("name", escaped), one("court", F.explode("courts")), one("nid", F.explode("fjc_nids")), one("domain", F.explode("domains"))]
    member = members(spark, sf_dir).select(F.concat(F.lit(NAMESPACE), F.col("mention_id")).alias("s"), F.lit("resolvedTo").alias("p"), F.concat(F.lit(NAMESPACE), F.col("sjid")).alias("o"))
    out = member
    for t in parts:
        out = out.union(t)
    return out.filter("o is not null").distinct()


def triples_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return triples(spark, sf_dir).groupBy("p").agg(F.count("*").alias("n"), F.count_distinct("s").alias("subjects"))


def entities_per_court(spark: SparkSession, sf_dir: str) -> DataFrame:
    return triples(spark, sf_dir).filter("p = 'court'").groupBy(F.col("o").alias("court")).agg(F.count_distinct("s").alias("entities"))


def low_confidence_merges(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "decisions").filter("upper(trim(decision)) in ('MATCH', 'MERGE_TIER2') and confidence < 80")
    return d.select("decision_id", "confidence").distinct().orderBy("confidence", "decision_id").limit(50)


def evidence_trail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many decisions of each kind stand behind every entity."""
    d = read(spark, sf_dir, "decisions").select("decision_id", F.upper(F.trim("decision")).alias("decision"), F.explode(F.array("mention_id_a", "mention_id_b")).alias("mention_id")).distinct()
    return d.join(members(spark, sf_dir), "mention_id").groupBy("sjid", "decision").agg(F.count_distinct("decision_id").alias("n"))


def insert_safety(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incoming ids by what an insert would do: those to create must be absent from the history, reused ones present."""
    i = read(spark, sf_dir, "incoming_mentions").select("mention_id").filter("mention_id is not null").distinct()
    held = read(spark, sf_dir, "mentions").select("mention_id").distinct()
    return i.join(held, "mention_id", "left_anti").withColumn("action", F.lit("CREATE")).union(i.join(held, "mention_id", "left_semi").withColumn("action", F.lit("REUSE")))


QUERIES = {
    f.__name__: f
    for f in (
        pairwise_prf, b3_full, b3_shared, id_splits, name_splits, coparty_merges, junk_names, partition_diff, multiset_diff, stratified_sample, structural_rates, fingerprint, invariants,
        decision_rollup, run_counts, name_validity_window, triples_counts, entities_per_court, low_confidence_merges, evidence_trail, insert_safety,
    )
}


def _sql() -> dict[str, str]:
    from docketweave.plans.clustering import _M, _PLACED

    p = f"WITH {_PLACED}, x AS (SELECT mention_id, sjid AS gold, concat_ws('|', entity_type, normalized_name, court) AS pred FROM p WHERE normalized_name IS NOT NULL)"
    cells = ", c AS (SELECT gold, pred, count(*) AS n FROM x GROUP BY gold, pred), g AS (SELECT gold, sum(n) AS g FROM c GROUP BY gold), q AS (SELECT pred, sum(n) AS p FROM c GROUP BY pred)"
    b3 = " SELECT round(sum(n * n / p) / sum(n), 6) AS precision, round(sum(n * n / g) / sum(n), 6) AS recall FROM c JOIN g USING (gold) JOIN q USING (pred)"
    escaped = "replace(replace(replace(canonical_name, chr(92), chr(92) || chr(92)), chr(34), chr(92) || chr(34)), chr(10), chr(92) || 'n')"
    one = lambda name, value: f"SELECT 'urn:dw:' || sjid AS s, '{name}' AS p, CAST({value} AS VARCHAR) AS o FROM entities WHERE sjid IS NOT NULL"
    triples_sql = f"WITH m AS ({_M}), t AS (SELECT * FROM (" + " UNION ".join([one("type", "entity_type"), one("name", escaped), one("court", "unnest(courts)"), one("nid", "unnest(fjc_nids)"), one("domain", "unnest(domains)"), "SELECT 'urn:dw:' || mention_id, 'resolvedTo', 'urn:dw:' || sjid FROM m"]) + ") WHERE o IS NOT NULL) "
    iso = "CASE WHEN regexp_matches(filing_date, '^[0-9]{2}/[0-9]{2}/[0-9]{4}$') THEN concat(substr(filing_date, 7, 4), '-', substr(filing_date, 1, 2), '-', substr(filing_date, 4, 2)) WHEN regexp_matches(filing_date, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$') THEN filing_date END"
    return {
        "pairwise_prf": p + cells + ", s AS (SELECT (SELECT sum(n * (n - 1) / 2) FROM c) AS b, (SELECT sum(g * (g - 1) / 2) FROM g) AS g, (SELECT sum(p * (p - 1) / 2) FROM q) AS p) SELECT round(b / p, 6) AS precision, round(b / g, 6) AS recall, round(2 * (b / p) * (b / g) / (b / p + b / g), 6) AS f1 FROM s",
        "b3_full": p + cells + b3,
        "b3_shared": p.replace("x AS (", "x0 AS (") + ", x AS (SELECT * FROM x0 WHERE gold IN (SELECT gold FROM x0 GROUP BY gold HAVING count(*) > 1))" + cells + b3,
        "id_splits": f"WITH {_PLACED} SELECT CAST(fjc_nid AS VARCHAR) AS key, count(DISTINCT sjid) AS n, 'split' AS kind FROM p WHERE fjc_nid IS NOT NULL GROUP BY 1 HAVING count(DISTINCT sjid) > 1 UNION ALL SELECT sjid, count(DISTINCT fjc_nid), 'merge' FROM p WHERE fjc_nid IS NOT NULL GROUP BY 1 HAVING count(DISTINCT fjc_nid) > 1",
        "name_splits": f"WITH {_PLACED} SELECT entity_type, normalized_name, count(DISTINCT sjid) AS ids FROM p WHERE normalized_name IS NOT NULL GROUP BY ALL HAVING count(DISTINCT sjid) > 1",
        "coparty_merges": f"WITH {_PLACED} SELECT sjid, ucid, count(DISTINCT party_enum) AS entries, count(DISTINCT normalized_name) AS names FROM p WHERE entity_type = 'party' AND party_enum IS NOT NULL GROUP BY sjid, ucid HAVING count(DISTINCT party_enum) > 1 AND count(DISTINCT normalized_name) > 1",
        "junk_names": "SELECT entity_type, raw_name, count(*) AS n FROM mentions WHERE regexp_matches(raw_name, ' [a-z]+$') OR contains(raw_name, ':') OR regexp_matches(raw_name, '[a-z][A-Z]') GROUP BY entity_type, raw_name",
        "partition_diff": f"""WITH m AS ({_M}), a AS (SELECT mention_id, min(concat_ws('|', entity_type, normalized_name)) AS after FROM mentions WHERE normalized_name IS NOT NULL GROUP BY mention_id),
          b AS (SELECT DISTINCT coalesce(sjid, '<new mention>') AS before, coalesce(after, '<dropped mention>') AS after FROM m FULL JOIN a USING (mention_id))
          SELECT after AS grp, count(DISTINCT before) AS n, 'merge' AS kind FROM b GROUP BY after HAVING count(DISTINCT before) > 1 UNION ALL SELECT before, count(DISTINCT after), 'split' FROM b GROUP BY before HAVING count(DISTINCT after) > 1""",
        "multiset_diff": "SELECT mention_id, raw_name, court, ucid, role FROM incoming_mentions EXCEPT ALL SELECT mention_id, raw_name, court, ucid, role FROM mentions",
        "stratified_sample": "SELECT mention_id, entity_type, docket_source, CAST(k AS INTEGER) AS k FROM (SELECT *, row_number() OVER (PARTITION BY entity_type, docket_source ORDER BY sha1(mention_id || '#7'), mention_id) AS k FROM (SELECT DISTINCT mention_id, entity_type, docket_source FROM mentions)) WHERE k <= 10",
        "structural_rates": f"WITH m AS ({_M}), d AS (SELECT DISTINCT decision_id, mention_id_a, mention_id_b, upper(trim(decision)) AS decision FROM decisions) SELECT CASE WHEN a.sjid = b.sjid THEN 'SAME' ELSE 'DIFFERENT' END AS truth, decision, count(*) AS n FROM d JOIN m a ON a.mention_id = mention_id_a JOIN m b ON b.mention_id = mention_id_b GROUP BY ALL",
        "fingerprint": "SELECT court, count(*) AS n, CAST(sum(CAST(concat('0x', substr(md5(concat_ws('|', mention_id, coalesce(raw_name, ''), coalesce(role, ''))), 1, 10)) AS BIGINT)) AS BIGINT) AS checksum FROM mentions GROUP BY court",
        "invariants": f"""WITH {_PLACED} SELECT count(*) AS violations, 'mention_in_one_entity' AS invariant FROM (SELECT mention_id FROM p GROUP BY mention_id HAVING count(DISTINCT sjid) > 1)
          UNION ALL SELECT count(*), 'one_number_per_entity' FROM (SELECT sjid FROM p GROUP BY sjid HAVING count(DISTINCT fjc_nid) > 1) UNION ALL SELECT count(*), 'one_type_per_entity' FROM (SELECT sjid FROM p GROUP BY sjid HAVING count(DISTINCT entity_type) > 1)
          UNION ALL SELECT count(*), 'members_exist' FROM m WHERE mention_id NOT IN (SELECT mention_id FROM mentions WHERE mention_id IS NOT NULL)""",
        "decision_rollup": "WITH d AS (SELECT coalesce(method, '?') AS method, upper(trim(decision)) AS decision FROM decisions) SELECT method, decision, count(*) AS n FROM d GROUP BY ROLLUP (method, decision)",
        "run_counts": "SELECT entity_type, extraction_method, count(*) AS n_rows, count(DISTINCT mention_id) AS n_mentions, count(DISTINCT ucid) AS n_cases FROM mentions GROUP BY ALL",
        "name_validity_window": f"WITH {_PLACED}, y AS (SELECT sjid, presentable_name AS label, {iso} AS day FROM p) SELECT sjid, label, min(day) AS valid_from, max(day) AS valid_to FROM y WHERE label IS NOT NULL AND day IS NOT NULL GROUP BY sjid, label",
        "triples_counts": triples_sql + "SELECT p, count(*) AS n, count(DISTINCT s) AS subjects FROM t GROUP BY p",
        "entities_per_court": triples_sql + "SELECT o AS court, count(DISTINCT s) AS entities FROM t WHERE p = 'court' GROUP BY o",
        "low_confidence_merges": "SELECT DISTINCT decision_id, confidence FROM decisions WHERE upper(trim(decision)) IN ('MATCH', 'MERGE_TIER2') AND confidence < 80 ORDER BY confidence, decision_id LIMIT 50",
        "evidence_trail": f"WITH m AS ({_M}), d AS (SELECT DISTINCT decision_id, upper(trim(decision)) AS decision, unnest([mention_id_a, mention_id_b]) AS mention_id FROM decisions) SELECT sjid, decision, count(DISTINCT decision_id) AS n FROM d JOIN m USING (mention_id) GROUP BY sjid, decision",
        "insert_safety": "SELECT DISTINCT mention_id, CASE WHEN mention_id IN (SELECT mention_id FROM mentions) THEN 'REUSE' ELSE 'CREATE' END AS action FROM incoming_mentions WHERE mention_id IS NOT NULL",
    }


SQL = _sql()
