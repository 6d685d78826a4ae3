"""Matching entities across sources without keys, by a label model over matching functions.

Mentions reduce to name entities, each with a profile of its best-attested parts; directory rows are read by the same
parser. Candidates share a similar surname in one court, or the same surname and first initial anywhere. Matching
functions vote on each candidate with a level (agree, weakly agree, silent, disagree). A generative model learns from the
vote patterns alone how often each function gives each level for matches and for others, by expectation
maximisation; functions that stay dependent given the truth are joined into one. Its posterior is the
confidence of a match. Only counts of vote patterns reach the driver: at most the product of the levels.

Defined results: mentions without a readable name and directory rows without a name or number match nothing;
repeated rows count once; two directory rows that tie for one entity leave it unmatched; empty sources give
an empty result.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docketweave.llm import names
from docketweave.session import Scratch, read

VOTES = ["v_surname", "v_first", "v_middle", "v_suffix", "v_court", "v_dates", "v_number"]
SILENT, AGREE, WEAK, DISAGREE = 0, 1, 2, 3
LEVELS = 4


class LabelModel:
    """Two-class generative model of categorical votes, fitted to counts of vote patterns."""

    def __init__(self, joined: list[tuple[int, ...]], prior: float, tables: list[np.ndarray]):
        self.joined, self.prior, self.tables = joined, prior, tables

    @staticmethod
    def _codes(patterns: np.ndarray, group: tuple[int, ...]) -> np.ndarray:
        return reduce(lambda c, i: c * LEVELS + patterns[:, i], group, np.zeros(len(patterns), np.int64))

    @staticmethod
    def _em(patterns: np.ndarray, counts: np.ndarray, joined: list[tuple[int, ...]], rounds: int = 60) -> tuple["LabelModel", np.ndarray]:
        # Start from the share of agreeing votes among those that speak.
        agree = (patterns == AGREE).sum(1) + 0.5 * (patterns == WEAK).sum(1)
        against = (patterns == DISAGREE).sum(1)
        q = np.clip((agree - 1.5 * against) / patterns.shape[1], 0.02, 0.98)
        codes = [LabelModel._codes(patterns, g) for g in joined]
        model = LabelModel(joined, 0.5, [])
        for _ in range(rounds):
            model.prior = float(np.clip((counts * q).sum() / counts.sum(), 1e-4, 1 - 1e-4))
            model.tables = []
            for g, c in zip(joined, codes):
                size = LEVELS ** len(g)
                t = np.stack([np.bincount(c, counts * (1 - q), size), np.bincount(c, counts * q, size)]) + 0.5 / size
                model.tables.append(t / t.sum(1, keepdims=True))
            new = model.posterior(patterns)
            if np.abs(new - q).max() < 1e-6:
                break
            q = new
        return model, q

    @staticmethod
    def fit(patterns: np.ndarray, counts: np.ndarray, dependent: float = 0.05) -> "LabelModel":
        """dependent: mutual information given the truth, in nats, from which two functions are joined."""
        joined = [(i,) for i in range(patterns.shape[1])]
        taken: set[int] = set()
        pairs = list(combinations(range(patterns.shape[1]), 2))
        # Near-copies come first: they would otherwise pass for the truth themselves.
        ones = np.ones(len(patterns))
        for i, j in pairs:
            own = min(LabelModel._information(patterns, counts, ones, i, i), LabelModel._information(patterns, counts, ones, j, j))
            if own > 0 and not {i, j} & taken and LabelModel._information(patterns, counts, ones, i, j) >= 0.9 * own:
                taken |= {i, j}
                joined = [g for g in joined if g not in ((i,), (j,))] + [(i, j)]
        model, q = LabelModel._em(patterns, counts, joined)
        found = [(LabelModel._information(patterns, counts, q, i, j), i, j) for i, j in pairs]
        before = len(taken)
        for information, i, j in sorted(found, reverse=True):
            if information >= dependent and not {i, j} & taken:
                taken |= {i, j}
                joined = [g for g in joined if g not in ((i,), (j,))] + [(i, j)]
        if len(taken) > before:
            model, _ = LabelModel._em(patterns, counts, joined)
        return model

    @staticmethod
    def _information(patterns: np.ndarray, counts: np.ndarray, q: np.ndarray, i: int, j: int) -> float:
        total = 0.0
        for weight in (counts * q, counts * (1 - q)):
            t = np.bincount(patterns[:, i] * LEVELS + patterns[:, j], weight, LEVELS**2).reshape(LEVELS, LEVELS)
            if (s := t.sum()) > 0:
                t = t / s
                outer = t.sum(1, keepdims=True) * t.sum(0, keepdims=True)
                seen = t > 0
                total += s / counts.sum() * float((t[seen] * np.log(t[seen] / outer[seen])).sum())
        return total

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        odds = np.full(len(patterns), np.log(self.prior / (1 - self.prior)))
        for g, t in zip(self.joined, self.tables):
            c = self._codes(patterns, g)
            odds += np.log(t[1, c] / t[0, c])
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def _compare(a: str, b: str):
    """Level of agreement of two name parts."""
    x, y = F.col(a), F.col(b)
    either = F.concat(F.lit("/"), x, F.lit("/")).contains(F.concat(F.lit("/"), y, F.lit("/"))) | F.concat(F.lit("/"), y, F.lit("/")).contains(F.concat(F.lit("/"), x, F.lit("/")))
    initial = ((F.length(x) == 1) | (F.length(y) == 1)) & (F.substring(x, 1, 1) == F.substring(y, 1, 1))
    slip = (F.length(x) > 3) & (F.length(y) > 3) & (F.levenshtein(x, y, 1) >= 0)
    return F.when((x == "") | (y == ""), SILENT).when(x == y, AGREE).when(initial | either | slip, WEAK).otherwise(DISAGREE)


def directory_rows(directory: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """(nid, court, stem, g1, g2, suffix, from_year, to_year): one row per judge, reading of the name and court."""
    # Written as "Last, First Middle, Suffix", so the columns' knowledge of what is a given name is kept.
    part = lambda c: F.when(F.trim(c) != "", F.trim(c))
    full = F.concat_ws(", ", part("last_name"), F.nullif(F.concat_ws(" ", part("first_name"), part("middle_name")), F.lit("")), part("suffix"))
    year = lambda c: F.regexp_extract(c, r"(?:19|20)\d\d", 0).cast("int")
    rows = directory.filter("nid is not null and trim(last_name) <> ''").select(
        "nid", full.alias("raw"), F.lit("judge").alias("entity_type"), year("commission_date_1").alias("from_year"), year("termination_date_1").alias("to_year"),
        F.explode(F.array_distinct(F.array("court_name_1", F.coalesce("court_name_2", "court_name_1")))).alias("court_name"),
    ).distinct()
    codes = crosswalk.select(F.trim("court_name").alias("court_name"), F.col("court_code").alias("court")).distinct()
    parsed = names.parse_names(rows)
    coded = rows.withColumn("court_name", F.trim("court_name")).join(codes, "court_name", "left")
    return coded.join(parsed, ["entity_type", "raw"]).select("nid", F.coalesce("court", F.lit("")).alias("court"), "stem", "g1", "g2", "suffix", "from_year", "to_year")


def judge_profiles(mentions: DataFrame, named: DataFrame) -> DataFrame:
    """One row per name entity: its court, stems, best parts, years and known numbers."""
    rows = mentions.select("entity_type", F.coalesce("court", F.lit("")).alias("court"), names.name_column().alias("raw"), "year", "fjc_nid")
    counted = rows.groupBy("entity_type", "court", "raw").agg(
        F.count("*").alias("n"), F.min("year").alias("first_year"), F.max("year").alias("last_year"), F.min("fjc_nid").alias("low_nid"), F.max("fjc_nid").alias("high_nid")
    )
    part = lambda c: F.coalesce(F.max_by(F.when(F.length(c) > 1, F.col(c)), F.when(F.length(c) > 1, F.struct("n", c))), F.max(c), F.lit(""))
    return (
        counted.join(named, ["entity_type", "court", "raw"])
        .groupBy("entity", "court")
        .agg(
            F.collect_set("stem").alias("stems"), part("g1").alias("g1"), part("g2").alias("g2"), F.max("suffix").alias("suffix"),
            F.min("first_year").alias("first_year"), F.max("last_year").alias("last_year"), F.min("low_nid").alias("low_nid"), F.max("high_nid").alias("high_nid"),
        )
    )


def link_to_directory(mentions: DataFrame, directory: DataFrame, crosswalk: DataFrame, least: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """(matches, named): matches has (entity, nid, confidence); named maps names to entities."""
    spark = mentions.sparkSession
    scratch = Scratch(spark, "linkage")
    named = scratch.table(names.name_entities(mentions))
    profiles = scratch.table(judge_profiles(mentions, named))
    listed = scratch.table(directory_rows(directory, crosswalk))
    ours = profiles.select("entity", "court", F.substring("g1", 1, 1).alias("letter"), F.explode("stems").alias("stem"))
    stems = ours.select("court", "stem").union(listed.select("court", "stem")).distinct()
    blocks = stems.select(F.lit("judge").alias("entity_type"), F.col("court").alias("block"), F.lit("P").alias("kind"), "stem")
    frequencies = names.with_frequencies(named.select("entity_type", F.lit("P").alias("kind"), "stem", "g1", "g2", "suffix").union(listed.select(F.lit("judge"), F.lit("P"), "stem", "g1", "g2", "suffix")))
    near = names.verified_stems(names.similar_stems(blocks.join(frequencies, ["entity_type", "kind", "stem"])))
    near = scratch.table(near.select(F.col("block").alias("court"), "x", "y", "soft"))
    both = near.select("court", F.col("x").alias("stem"), F.col("y").alias("near_stem"), "soft").union(near.select("court", F.col("y").alias("stem"), F.col("x").alias("near_stem"), "soft"))
    # The same surname meets in one court, or anywhere with the same first initial: never by the bare surname.
    one = F.lit(1.0).alias("soft")
    here = ours.join(listed.select("nid", "court", "stem").distinct(), ["court", "stem"]).select("entity", "nid", one)
    lettered = listed.select("nid", "stem", F.substring("g1", 1, 1).alias("letter")).distinct()
    anywhere = ours.filter("letter <> ''").join(lettered, ["stem", "letter"]).select("entity", "nid", one)
    fuzzy = ours.join(both, ["court", "stem"]).join(listed.select("nid", "court", F.col("stem").alias("near_stem")).distinct(), ["court", "near_stem"]).select("entity", "nid", "soft")
    pairs = here.union(anywhere).union(fuzzy).groupBy("entity", "nid").agg(F.max("soft").alias("soft"))
    best = listed.groupBy("nid").agg(
        F.collect_set("court").alias("courts"), F.max_by("g1", F.length("g1")).alias("dg1"), F.max_by("g2", F.length("g2")).alias("dg2"), F.max("suffix").alias("dsuffix"), F.min("from_year").alias("from_year"), F.max("to_year").alias("to_year")
    )
    full = pairs.join(profiles, "entity").join(best, "nid")
    in_court = F.array_contains("courts", F.col("court"))
    initials = F.substring("g1", 1, 1) == F.substring("dg1", 1, 1)
    full = full.filter(in_court | ((F.col("soft") == 1) & initials))
    year_ok = (F.col("last_year") >= F.col("from_year")) & (F.col("to_year").isNull() | (F.col("first_year") <= F.col("to_year") + 15))
    suffix = F.when((F.col("suffix") == "") & (F.col("dsuffix") == ""), SILENT).when(F.col("suffix") == F.col("dsuffix"), AGREE).when((F.col("suffix") == "") | (F.col("dsuffix") == ""), WEAK).otherwise(DISAGREE)
    number = F.when(F.col("low_nid").isNull(), SILENT).when((F.col("low_nid") == F.col("nid")) & (F.col("high_nid") == F.col("nid")), AGREE).when((F.col("low_nid") == F.col("nid")) | (F.col("high_nid") == F.col("nid")), WEAK).otherwise(DISAGREE)
    voted = scratch.table(
        full.select(
            "entity", "nid",
            F.when(F.col("soft") == 1, AGREE).otherwise(WEAK).alias("v_surname"), _compare("g1", "dg1").alias("v_first"), _compare("g2", "dg2").alias("v_middle"), suffix.alias("v_suffix"),
            F.when(in_court, AGREE).otherwise(DISAGREE).alias("v_court"), F.when(F.col("from_year").isNull() | F.col("last_year").isNull(), SILENT).when(year_ok, AGREE).otherwise(DISAGREE).alias("v_dates"), number.alias("v_number"),
        )
    )
    counts = voted.groupBy(*VOTES).agg(F.count("*").alias("n")).collect()  # at most LEVELS ** len(VOTES) rows
    if not counts:
        return voted.select("entity", "nid", F.lit(0.0).alias("confidence")), named
    patterns = np.array([[r[v] for v in VOTES] for r in counts], np.int64)
    q = LabelModel.fit(patterns, np.array([r["n"] for r in counts], float)).posterior(patterns)
    table = spark.createDataFrame([(*map(int, p), float(c)) for p, c in zip(patterns, q)], ", ".join(f"{v} int" for v in VOTES) + ", confidence double")
    scored = voted.join(F.broadcast(table), VOTES).filter(F.col("confidence") >= least)
    order = Window.partitionBy("entity").orderBy(F.desc("confidence"), "nid")
    ranked = scored.select("entity", "nid", "confidence").withColumn("rank", F.row_number().over(order)).withColumn("next", F.lead("confidence").over(order))
    return ranked.filter("rank = 1 and (next is null or next < confidence)").select("entity", "nid", "confidence"), named


def p7_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(mention_id, nid, confidence) of every judge mention whose judge is in the directory."""
    judges = read(spark, sf_dir, "mentions").filter("entity_type = 'judge'")
    matches, named = link_to_directory(judges, read(spark, sf_dir, "judge_directory"), read(spark, sf_dir, "court_crosswalk"))
    rows = judges.filter("mention_id is not null").select("mention_id", F.lit("judge").alias("entity_type"), F.coalesce("court", F.lit("")).alias("court"), names.name_column().alias("raw"))
    placed = named.join(matches, "entity").select("entity_type", "court", "raw", "nid", "confidence")
    return rows.join(placed, ["entity_type", "court", "raw"]).select("mention_id", F.col("nid").cast("bigint").alias("nid"), F.round("confidence", 6).alias("confidence")).distinct()


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    judges = read(spark, sf_dir, "mentions").filter("entity_type = 'judge'")
    open_ids = judges.groupBy("mention_id").agg(F.max("fjc_nid").alias("known")).filter("known is null").select("mention_id")
    listed = names.listed_ids(read(spark, sf_dir, "entities"))
    return p7_matches(spark, sf_dir).join(open_ids, "mention_id", "left_semi").join(listed, "mention_id", "left_anti").select("mention_id", "nid").distinct()


QUERIES = {"p7_found": p7_found, "p7_matches": p7_matches}
