"""The surviving value of each field of a group of duplicates.

Values are read into parts; the parts a group is known by are the most attested ones, so a complete value has all of
them, an undamaged one spells them alike, and a correctly written one has nothing else. Among equals the more
trusted source wins, then the more current row. Currency comes from the row's date. Where dates
are missing, value-transition precedence is learnt from all dated rows (value a was followed directly by value b) and closed
over any number of steps; it makes each group's values a partial order. An undated row ranks with the latest dated value of its
group that its value is or follows, and among undated values of one day the topologically latest win, also in
groups that have no date at all.

Only aggregates and joins over different values are used, and a window over the different dated values of a group and field. Defined results: null, blank and NA values
are none; a field without any value has no row; groups of fewer than two present members are left out; repeated rows
count once; ties go to the smallest key; a source without a trust rank ranks below all others.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docketweave.llm import addresses, names
from docketweave.session import Scratch, read

FIELDS = ["presentable_name", "address", "phone", "email"]
NAME_PARTS = ["stem", "g1", "g2", "suffix", "form"]
PLACE_PARTS = ["direction", "street", "word", "unit", "station", "town", "state", "zip"]


def _plain(s: str) -> str:
    s = regex.sub(r"(?<=\b\p{L})\.(?=\p{L}\b)", "", names.fold(s.lower()).replace("&", " and "))
    return regex.sub(r"[^\p{L}\p{M}\d]+", " ", regex.sub(r"[.'’]", "", s)).strip()


@lru_cache(1 << 16)
def read_name(value: str, kind: str, stem: str, g1: str, g2: str, suffix: str, form: str) -> tuple[bool, str, str, str, str, str]:
    """(plain, stem, g1, g2, suffix, form) of a value read by names.parse_names; plain: exactly these parts in their usual order, nothing else."""
    literal = _plain(value)
    if kind == "O":
        core = literal
        for _, pattern in names._FORMS:
            m = pattern.search(literal)
            if m and m.start() > 0:
                core = literal[: m.start()].strip()
                break
        words = [w for w in core.split(" ") if w not in names.CONNECTORS]
        return (words == stem.split(" ") and not core.startswith("the ") and core.split(" ")[-1] != "and" and not regex.search(r"[*;]|[-–]\s*$|\s,|,\S", value), core, "", "", "", form)
    expected = " ".join(x for x in (g1, g2, stem, suffix) if x)
    usual = _plain(regex.sub(r"\bjunior\b", "jr", regex.sub(r"\bsenior\b", "sr", value.lower())))
    plain = usual == _plain(expected) and "/" not in g1 and not regex.search(r"[,*;]\s*$|[-–]\s*$", value) and not regex.search(r"\d", value)
    return (plain, stem, g1, g2, suffix, "")


@lru_cache(1 << 16)
def read_place(value: str) -> tuple | None:
    """(sound, anchor, parts...): sound if no part is missing in itself or oddly written."""
    p = addresses.parse(value)
    if p is None:
        return None
    anchor = "b" + p["box"] if p["box"] else p["number"]
    whole = bool(p["town"] and p["state"] and p["zip"] and (p["box"] or (p["street"] and p["word"])))
    odd = regex.search(r"(?:^|[\n;,])\s*\W*n\.?/?a\.?\W*(?:[\n;,]|$)", value, regex.I) or regex.search(r"\b\p{L}\.\s?\p{L}\.(?=\s*(?:\d|\n|$|;))", value)
    damaged = regex.search(r"\p{L}\d\p{L}|\p{L}{2}\d", value) is not None
    word = p["word"]
    if word:
        tokens = regex.findall(r"\p{L}+", value.lower())
        damaged = damaged or not any(names_word in tokens for names_word in [word, *addresses.STREET_WORDS[word].split()])
    return (whole and not odd and not damaged, anchor, *(p[k] for k in PLACE_PARTS))


_READ = "name_plain boolean, " + ", ".join(f"n_{p} string" for p in NAME_PARTS) + ", place_sound boolean, anchor string, " + ", ".join(f"a_{p} string" for p in PLACE_PARTS)


def _read_values(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    name_columns = ["name_plain", *[f"n_{p}" for p in NAME_PARTS]]
    place_columns = ["place_sound", "anchor", *[f"a_{p}" for p in PLACE_PARTS]]
    for b in batches:
        parts = [b[c].tolist() for c in ("presentable_name", "kind", *NAME_PARTS)]
        n = [read_name(*v) if v[0] and v[1] else None for v in zip(*parts)]
        a = [read_place(v) if v else None for v in b["address"]]
        left = pd.DataFrame([x or (None,) * len(name_columns) for x in n], columns=name_columns, index=b.index)
        right = pd.DataFrame([x or (None,) * len(place_columns) for x in a], columns=place_columns, index=b.index)
        yield pd.concat([b.drop(columns=["kind", *NAME_PARTS]), left, right], axis=1)


def present(c: str) -> Column:
    """The value, or null where it is blank or NA."""
    v = F.trim(F.regexp_replace(c, r"^[\s ]+|[\s ]+$", ""))
    return F.when((v != "") & ~F.upper(v).isin("NA", "N/A", "N.A.", "NONE", "NULL"), F.col(c))


def iso_date(c: str) -> Column:
    """yyyymmdd of yyyy-mm-dd or mm/dd/yyyy, as a number; null for others."""
    iso = F.regexp_extract(c, r"^\s*((?:19|20)\d\d)-(\d\d?)-(\d\d?)", 0)
    parts = F.when(iso != "", F.split(F.trim(iso), "-"))
    us = F.regexp_extract(c, r"^\s*(\d\d?)/(\d\d?)/((?:19|20)\d\d)", 0)
    flipped = F.split(F.trim(us), "/")
    return F.coalesce(
        parts[0].cast("int") * 10000 + parts[1].cast("int") * 100 + parts[2].cast("int"),
        F.when(us != "", flipped[2].cast("int") * 10000 + flipped[0].cast("int") * 100 + flipped[1].cast("int")),
    )


def precedence(known: DataFrame) -> DataFrame:
    """(field_name, earlier, value): value transitions learnt from all dated rows, value directly after earlier in more groups than before it."""
    order = Window.partitionBy("grp", "field_name").orderBy("day", "value")
    steps = known.withColumn("after", F.lead("value").over(order)).filter("after is not null").groupBy("field_name", "value", "after").agg(F.count("*").alias("n"))
    back = steps.select("field_name", F.col("after").alias("value"), F.col("value").alias("after"), F.col("n").alias("m"))
    return steps.join(back, ["field_name", "value", "after"], "left").filter("n > coalesce(m, 0)").select("field_name", F.col("value").alias("earlier"), F.col("after").alias("value"))


def partial_orders(values: DataFrame, precedes: DataFrame, scratch: Scratch) -> DataFrame:
    """(grp, field_name, earlier, value): the learnt precedence of each group's own values, closed over any number of steps.

    Steps through values that the group lacks count too: the learnt pairs are closed first, by doubling paths until none is
    new, over values that some undated group has or that lie between such.
    """
    closed = scratch.table(precedes.distinct())
    n = closed.count()
    while n:
        on = closed.select("field_name", F.col("value").alias("via"), F.col("earlier").alias("first"))
        longer = on.join(closed.select("field_name", F.col("earlier").alias("via"), "value"), ["field_name", "via"]).select("field_name", F.col("first").alias("earlier"), "value")
        after = scratch.table(closed.union(longer).filter("earlier <> value").distinct())
        more = after.count()
        scratch.drop(closed)
        closed = after
        if more == n:
            break
        n = more
    mine = values.select("grp", "field_name", "value").distinct()
    return mine.join(closed, ["field_name", "value"]).join(mine.withColumnRenamed("value", "earlier"), ["grp", "field_name", "earlier"]).select("grp", "field_name", "earlier", "value")


def dated(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """rows(grp, field_name, key, value, day, ...) with currency and place: rows of greater currency, then of greater place, are later.

    currency is the day, or for an undated row the latest day of a value of its group that is its own or that it follows. place is
    the topological place of an undated value in its group's partial order: less the number of values that follow it
    and that it does not follow itself, so the topologically latest values have 0.
    """
    undated = rows.filter("day is null").select("grp", "field_name", "value").distinct()
    if undated.isEmpty():
        return rows.withColumn("currency", F.col("day")).withColumn("place", F.lit(0)).drop("day")
    known = scratch.table(rows.filter("day is not null").groupBy("grp", "field_name", "value").agg(F.max("day").alias("day")))
    values = rows.join(undated.select("grp", "field_name").distinct(), ["grp", "field_name"]).select("grp", "field_name", "value").distinct()
    orders = scratch.table(partial_orders(values, precedence(known), scratch))
    same = undated.join(known, ["grp", "field_name", "value"]).select("grp", "field_name", "value", "day")
    later = orders.join(known.withColumnRenamed("value", "earlier"), ["grp", "field_name", "earlier"]).join(undated, ["grp", "field_name", "value"]).select("grp", "field_name", "value", "day")
    inferred = same.union(later).groupBy("grp", "field_name", "value").agg(F.max("day").alias("inferred"))
    both = orders.select("grp", "field_name", F.col("value").alias("earlier"), F.col("earlier").alias("value"), F.lit(1).alias("back"))
    strictly = orders.join(both, ["grp", "field_name", "earlier", "value"], "left").filter("back is null")
    place = strictly.groupBy("grp", "field_name", F.col("earlier").alias("value")).agg((-F.count_distinct(strictly["value"])).cast("int").alias("followers"))
    out = rows.join(inferred, ["grp", "field_name", "value"], "left").join(place, ["grp", "field_name", "value"], "left")
    return out.withColumn("currency", F.coalesce("day", "inferred", F.lit(0))).withColumn("place", F.when(F.col("day").isNull(), F.coalesce("followers", F.lit(0))).otherwise(0)).drop("day", "inferred", "followers")


def survivors(members: DataFrame, trust: DataFrame) -> DataFrame:
    """(grp, field_name, key): members has grp, key, entity_type, docket_source, filing_date and the FIELDS."""
    spark = members.sparkSession
    scratch = Scratch(spark, "survivors")
    ranks = trust.groupBy(F.col("docket_source")).agg(F.max("trust_rank").alias("trust"))
    clean = members.select("grp", "key", "entity_type", "docket_source", "filing_date", *[present(f).alias(f) for f in FIELDS]).dropDuplicates(["grp", "key"])
    kept = clean.select("grp", "key", "entity_type", "docket_source", iso_date("filing_date").alias("day"), *FIELDS)
    schema = "grp string, key string, docket_source string, day int, " + ", ".join(f"{f} string" for f in FIELDS) + ", " + _READ
    kept = scratch.table(kept)
    read = names.parse_names(kept.select("entity_type", F.col("presentable_name").alias("raw")).filter("raw is not null and entity_type is not null"), scratch=scratch)
    told = kept.join(read.withColumnRenamed("raw", "presentable_name"), ["entity_type", "presentable_name"], "left")
    parsed = scratch.table(told.select("grp", "key", "docket_source", "day", *FIELDS, "kind", *NAME_PARTS).mapInPandas(_read_values, schema))
    full = lambda c: F.when(F.length(c) > 1, F.col(c))
    filled = lambda c: F.when(F.col(c) != "", F.col(c))
    plain = lambda c: F.when(F.col("name_plain"), F.col(c))
    known = parsed.groupBy("grp").agg(
        F.count("*").alias("size"),
        F.coalesce(F.mode(plain("n_stem"), True), F.mode("n_stem", True)).alias("k_stem"),
        F.coalesce(F.mode(F.when(F.col("name_plain"), full("n_g1")), True), F.mode(full("n_g1"), True), F.mode(filled("n_g1"), True), F.lit("")).alias("k_g1"),
        F.coalesce(F.mode(full("n_g2"), True), F.mode(filled("n_g2"), True), F.lit("")).alias("k_g2"),
        F.coalesce(F.mode(filled("n_suffix"), True), F.lit("")).alias("k_suffix"),
        F.coalesce(F.mode(filled("n_form"), True), F.lit("")).alias("k_form"),
    )
    places = parsed.filter("anchor is not null").groupBy("grp", "anchor").agg(*[F.coalesce(F.mode(filled(f"a_{p}"), True), F.lit("")).alias(f"p_{p}") for p in PLACE_PARTS])
    judged = parsed.join(known.filter("size > 1"), "grp").join(places, ["grp", "anchor"], "left").join(ranks, "docket_source", "left")
    good_name = F.col("name_plain")
    for p in NAME_PARTS:
        good_name &= F.col(f"n_{p}") == F.col(f"k_{p}")
    good_place = F.col("place_sound")
    for p in PLACE_PARTS:
        good_place &= F.col(f"a_{p}") == F.col(f"p_{p}")
    digits = F.regexp_replace("phone", r"\D", "")
    good_phone = ((F.length(digits) == 10) | ((F.length(digits) == 11) & digits.startswith("1"))) & ~F.col("phone").rlike(r"\p{L}")
    good_email = F.trim("email").rlike(r"^[^@\s,;]+@[^@\s,;.]+(\.[^@\s,;.]+)+$")
    good = dict(zip(FIELDS, (good_name, good_place, good_phone, good_email)))
    entry = lambda f: F.struct(F.lit(f).alias("field_name"), F.col(f).alias("value"), F.coalesce(good[f], F.lit(False)).alias("good"))
    rows = judged.select("grp", "key", "day", F.coalesce("trust", F.lit(-1)).alias("trust"), F.explode(F.array(*[entry(f) for f in FIELDS])).alias("e"))
    rows = rows.select("grp", "key", "day", "trust", "e.*").filter("value is not null")
    best = dated(rows, scratch).groupBy("grp", "field_name").agg(F.min(F.struct((~F.col("good")).alias("bad"), (-F.col("trust")).alias("t"), (-F.col("currency")).alias("c"), (-F.col("place")).alias("p"), "key")).alias("b"))
    return best.select("grp", "field_name", F.col("b.key").alias("key"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    of = read(spark, sf_dir, "entities").select(F.col("sjid").alias("grp"), F.explode("mention_ids").alias("key")).filter("grp is not null and key is not null").distinct()
    columns = ["entity_type", "docket_source", "filing_date", *FIELDS]
    members = read(spark, sf_dir, "mentions").select(F.col("mention_id").alias("key"), *columns).join(of, "key")
    return survivors(members, read(spark, sf_dir, "source_trust")).select(F.col("grp").alias("sjid"), "field_name", F.col("key").alias("mention_id"))


QUERIES = {"p5_found": p5_found}
