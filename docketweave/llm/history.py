"""New batches against all accepted history, by a persisted inverted file of vector cells.

HistoryIndex keeps, in a shared folder, what later batches need of all accepted mentions: the different readings of their names
with the registered entity that bears them, each stem's full vector (counts of its letters) in the cell of its nearest
centroid, the counts from which names are read, contacts, and delivered ids. It is opened by any later session; append adds
a part without reading the others, under a name that becomes visible only when all of it is written.

Distances are sums of absolute differences (L1). One slip changes a letter vector by two at most, so a stem within k slips
of a query is within 2k. Cells live in a projection that folds the letters into FOLDS sums, which never lengthens a distance:
a cell whose nearest or farthest member is further from its centroid than the query's distance less or plus 2k allows holds no
match. A query probes its nearest cell first. The distance of the best verified match there that is registered becomes its new
bound, and it probes just those other cells that may hold a match at most as near; unregistered hits never stop it. Candidates are
reranked by the distance of their full vectors and verified by the soft similarity of problem 1. Matches that letters can't
bound (half a double name, an initial for a word, letters that scans confuse) are found by keys kept in the index.
Only cells that a batch probes are read, a folder a zone of cells.

Centroids are fitted on at most SAMPLE stems, their number grows with the square root of all stems; every stem is indexed.
Defined results: rows without a readable name, and names whose best matches disagree on the entity, are new; a
redelivered mention keeps its entity; repeated rows count once; empty batches give nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docketweave.llm import names
from docketweave.session import Scratch, read, shared_dir

LETTERS, FOLDS, SAMPLE, CHUNK, ZONE = 27, 8, 20_000, 20_000, 16
UNBOUNDED = 1 << 20
PARTS = ["g1", "g2", "suffix", "form"]
STEM = ["entity_type", "block", "kind", "stem"]
NODE = ["entity_type", "court", "kind", "stem", *PARTS]


def letter_vectors(stems: list[str]) -> np.ndarray:
    """How often each letter is in each stem, other characters folded onto LETTERS places; spaces don't count."""
    out = np.zeros((len(stems), LETTERS), np.int16)
    joined = [s.replace(" ", "") for s in stems]
    codes = np.frombuffer("".join(joined).encode("utf-32-le"), np.uint32).astype(np.int64)
    place = np.where((codes >= 97) & (codes < 123), codes - 97, codes % LETTERS)
    row = np.repeat(np.arange(len(stems)), [len(s) for s in joined])
    np.add.at(out, (row, place), 1)
    return out


class Cells:
    """Centroids in the folded space, and how near and far the members of each cell are; at most a few per square root of the stems."""

    def __init__(self, folds: np.ndarray, centroids: np.ndarray):
        self.folds, self.centroids = folds, centroids
        self.low, self.high = np.full(len(centroids), np.inf), np.full(len(centroids), -np.inf)

    @staticmethod
    def fit(stems: list[str], cells: int) -> Cells:
        v = letter_vectors(stems or [""])
        # Letters go to the fold with the least load so far, the most frequent first.
        folds, load = np.zeros(LETTERS, np.int64), np.zeros(FOLDS)
        for letter in np.argsort(-v.sum(0), kind="stable"):
            folds[letter] = load.argmin()
            load[folds[letter]] += v[:, letter].sum() + 1
        out = Cells(folds, np.zeros((0, FOLDS)))
        points = out.fold(v)
        rng = np.random.default_rng(11)
        at = points[rng.choice(len(points), min(cells, len(points)), replace=False)].astype(float)
        for _ in range(6):
            out.centroids = at
            near = out.distances(points).argmin(1)
            at = np.array([np.median(points[near == c], 0) if (near == c).any() else at[c] for c in range(len(at))])
        return Cells(folds, at[np.argsort(at.sum(1), kind="stable")])

    def fold(self, v: np.ndarray) -> np.ndarray:
        out = np.zeros((len(v), FOLDS), np.int64)
        for letter, f in enumerate(self.folds):
            out[:, f] += v[:, letter]
        return out

    def distances(self, folded: np.ndarray) -> np.ndarray:
        out = np.empty((len(folded), len(self.centroids)))
        for c, at in enumerate(self.centroids):
            out[:, c] = np.abs(folded - at).sum(1)
        return out


def reach(block: Column, length: Column) -> Column:
    """The largest letter distance of two stems that stem_softness can accept for their slips."""
    return 2 + 2 * names.two_slips(block, length).cast("int")


def lookup_keys(kind: Column, stem: Column) -> Column:
    """Keys of the matches that letter distances don't bound; each with the side of the pair it stands on, 2 for either."""
    words = F.split(stem, " ")
    several = F.size(words) > 1
    whole = F.replace(stem, F.lit(" "), F.lit(""))
    key = lambda k, side: F.struct(k.alias("key"), F.lit(side).alias("side"))
    scan = F.array(key(F.concat(F.lit("="), names.scanned(whole)), 2))
    half = F.when(several, F.transform(words, lambda w: key(F.concat(F.lit("%"), w), 0))).otherwise(F.array(key(F.concat(F.lit("%"), whole), 1)))
    rest = lambda i: F.array_join(F.array_sort(F.filter(words, lambda w, j: j != i)), " ")
    initial = F.transform(words, lambda w, i: F.struct(F.concat(F.lit("!"), F.substring(w, 1, 1), F.lit(" "), rest(i)).alias("key"), (F.length(w) == 1).cast("int").alias("side")))
    return F.array_distinct(F.concat(scan, F.when(kind == "O", F.when(several, initial).otherwise(F.array().cast("array<struct<key:string,side:int>>"))).otherwise(half)))


def contact_keys(mentions: DataFrame, extra: list[str]) -> DataFrame:
    """(extra..., key): a person's e-mail and full telephone numbers, an organisation's own domain."""
    email = F.lower(F.regexp_replace(F.trim("email"), r"\s+at\s+", "@"))
    email = F.when(email.rlike(r"^[^@\s]+@[^@\s]+\.[^@\s]+$"), F.concat(F.lit("e:"), email))
    digits = F.regexp_replace("phone", r"\D", "")
    phone = F.when(F.length(digits) >= 10, F.concat(F.lit("p:"), F.substring(digits, -10, 10)))
    return mentions.select(*extra, F.explode(F.array_compact(F.array(email, phone))).alias("key")).distinct()


def typed_rows(mentions: DataFrame) -> DataFrame:
    rows = mentions.filter("mention_id is not null and entity_type is not null")
    return rows.select("mention_id", "entity_type", F.coalesce("court", F.lit("")).alias("court"), names.name_column().alias("raw"), "email", "phone")


BLOCK = "case when entity_type = 'party' then '*' else court end"
VECTORS = "entity_type string, block string, kind string, stem string, cell int, away double, vector binary, zone int"
HITS = "entity_type string, block string, kind string, query string, stem string, distance int"


class HistoryIndex:
    """The persisted index; create it once, open it in later sessions, match batches and append them."""

    def __init__(self, spark: SparkSession, path: str, cells: Cells):
        self.spark, self.path, self.cells = spark, path, cells
        self.scratch = Scratch(spark, "match")
        self.probed: dict[str, float] = {}

    # Files

    @staticmethod
    def _fs(spark: SparkSession, path: str):
        jvm = spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path

    @classmethod
    def create(cls, spark: SparkSession, path: str, history: DataFrame, registry: DataFrame, cells: int | None = None, sample: int = SAMPLE) -> HistoryIndex:
        """Fits the centroids on at most ``sample`` stems of history and appends all of it."""
        index = cls(spark, path, Cells(np.zeros(LETTERS, np.int64), np.zeros((1, FOLDS))))
        rows, nodes, laid = index._read(history, registry)
        stems = nodes.select("stem").distinct()
        n = stems.count()
        chosen = [r["stem"] for r in stems.orderBy(F.xxhash64("stem"), "stem").limit(sample).collect()]
        index.cells = Cells.fit(chosen, cells or max(4, int(np.ceil(2 * np.sqrt(n)))))
        c = index.cells
        spark.createDataFrame([(i, [float(x) for x in at]) for i, at in enumerate(c.centroids)], "cell int, at array<double>").coalesce(1).write.parquet(f"{path}/centroids")
        spark.createDataFrame([(i, int(f)) for i, f in enumerate(c.folds)], "letter int, fold int").coalesce(1).write.parquet(f"{path}/folds")
        index._write(rows, nodes, laid)
        return cls.open(spark, path)

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> HistoryIndex:
        """The index in that folder, with all parts that are complete."""
        centroids = sorted((r["cell"], r["at"]) for r in spark.read.parquet(f"{path}/centroids").collect())
        folds = sorted((r["letter"], r["fold"]) for r in spark.read.parquet(f"{path}/folds").collect())
        index = cls(spark, path, Cells(np.array([f for _, f in folds], np.int64), np.array([a for _, a in centroids], float).reshape(-1, FOLDS)))
        seen = index._table("cells").groupBy("cell").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect()  # a row a cell
        for r in seen:
            index.cells.low[r["cell"]], index.cells.high[r["cell"]] = r["low"], r["high"]
        return index

    def _parts(self) -> list[str]:
        fs, path = self._fs(self.spark, self.path)
        at = path(f"{self.path}/parts")
        found = fs.listStatus(at) if fs.exists(at) else []
        return sorted(n for n in (s.getPath().getName() for s in found) if not n.endswith(".tmp"))

    def _table(self, name: str) -> DataFrame:
        parts = self._parts()
        if not parts:
            raise FileNotFoundError(f"no complete part in {self.path}")
        reader = self.spark.read.schema(VECTORS) if name == "vectors" else self.spark.read  # a part without names has no folder to tell them from
        return reduce(DataFrame.unionByName, [reader.parquet(f"{self.path}/parts/{p}/{name}") for p in parts])

    def _read(self, mentions: DataFrame, registry: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
        """(rows with sjid, nodes, layouts) of accepted mentions; earlier parts only add their counts of words."""
        of = registry.select("sjid", F.explode("mention_ids").alias("mention_id")).filter("sjid is not null and mention_id is not null")
        of = of.groupBy("mention_id").agg(F.min("sjid").alias("sjid"))
        rows = self.scratch.table(typed_rows(mentions).join(of, "mention_id", "left"))
        laid = self.scratch.table(names.layouts(rows.filter("raw is not null")))
        parsed = names.resolve(laid, names.word_roles(self._vocabulary(names.learn(laid))))
        borne = rows.groupBy("entity_type", "court", "raw", "sjid").agg(F.count("*").alias("n"))
        nodes = borne.join(parsed, ["entity_type", "raw"]).withColumn("block", F.expr(BLOCK)).groupBy(*STEM, "court", *PARTS, "sjid").agg(F.sum("n").alias("n"))
        return rows, self.scratch.table(nodes), laid

    def _vocabulary(self, new: DataFrame) -> DataFrame:
        held = self._table("vocabulary").unionByName(new) if self._parts() else new
        return held.groupBy("word").agg(*[F.sum(c).alias(c) for c in ("g", "s", "o", "l", "n")])

    def append(self, mentions: DataFrame, registry: DataFrame) -> None:
        """Adds accepted mentions as a new part; no other part's names or vectors are read."""
        self._write(*self._read(mentions, registry))
        self.cells = HistoryIndex.open(self.spark, self.path).cells

    def _write(self, rows: DataFrame, nodes: DataFrame, laid: DataFrame) -> None:
        part = uuid.uuid4().hex
        base = f"{self.path}/parts/{part}.tmp"
        fitted = self.cells

        def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                v = letter_vectors(b["stem"].tolist())
                d = fitted.distances(fitted.fold(v))
                cell = d.argmin(1).astype(np.int32)
                yield b.assign(cell=cell, away=d[np.arange(len(d)), cell], vector=[x.tobytes() for x in v], zone=cell // ZONE)

        placed = nodes.select(*STEM).distinct().mapInPandas(place, VECTORS).repartition("zone")
        placed.sortWithinPartitions("zone", "cell").write.partitionBy("zone").parquet(f"{base}/vectors")
        held = self.spark.read.schema(VECTORS).parquet(f"{base}/vectors")
        tables = {
            "nodes": nodes,
            "keys": nodes.select(*STEM).distinct().select(*STEM, F.explode(lookup_keys(F.col("kind"), F.col("stem"))).alias("k")).select(*STEM, "k.*"),
            "words": names.word_frequencies(nodes),
            "vocabulary": names.learn(laid),
            "contacts": contact_keys(rows.filter("sjid is not null"), ["sjid"]),
            "ids": rows.filter("sjid is not null").select("mention_id", "sjid").distinct(),
            "cells": held.groupBy("cell").agg(F.min("away").alias("low"), F.max("away").alias("high"), F.count("*").alias("n")),
        }
        for name, df in tables.items():
            df.write.parquet(f"{base}/{name}")
        fs, path = self._fs(self.spark, base)
        fs.rename(path(base), path(base.removesuffix(".tmp")))

    # Search

    def search(self, queries: DataFrame, only_nearest: bool) -> DataFrame:
        """HITS of queries (entity_type, block, kind, stem, bound) within their bound, from stems of their type, block and kind.

        With only_nearest each query's nearest cell is probed, else all others that may hold a stem within its bound.
        """
        fitted = self.cells
        sizes = {r["cell"]: r["n"] for r in self._table("cells").groupBy("cell").agg(F.sum("n").alias("n")).collect()}  # a row a cell
        chunks = np.array([max(1, -(-sizes.get(c, 0) // CHUNK)) for c in range(len(fitted.centroids))])

        def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                d = fitted.distances(fitted.fold(letter_vectors(b["stem"].tolist())))
                near, bound = d.argmin(1), b["bound"].to_numpy()[:, None]
                if only_nearest:
                    q, c = np.arange(len(b)), near
                else:
                    open_ = (d - fitted.high <= bound) & (fitted.low - d <= bound)
                    open_[np.arange(len(b)), near] = False
                    q, c = np.nonzero(open_)
                times = chunks[c]
                k = np.concatenate([np.arange(t) for t in times]) if len(times) else np.zeros(0, np.int64)
                q, c = np.repeat(q, times), np.repeat(c, times).astype(np.int32)
                yield pd.DataFrame({"entity_type": b["entity_type"].to_numpy()[q], "block": b["block"].to_numpy()[q], "kind": b["kind"].to_numpy()[q], "query": b["stem"].to_numpy()[q],
                                    "bound": b["bound"].to_numpy()[q].astype(np.int32), "cell": c, "zone": c // ZONE, "chunk": k.astype(np.int32), "piece": (pd.util.hash_array(b["stem"].to_numpy(object))[q] % np.uint64(1 << 20)).astype(np.int64)})

        probed = queries.mapInPandas(probe, "entity_type string, block string, kind string, query string, bound int, cell int, zone int, chunk int, piece bigint")
        probed = self.scratch.table(probed)
        asked = probed.groupBy("cell", "zone").agg(F.count("*").alias("n")).collect()  # at most a row a cell
        self.probed["nearest" if only_nearest else "others"] = sum(r["n"] for r in asked)
        self.probed["zones read"] = len({r["zone"] for r in asked})
        # Queries of a cell that very many ask are split too; each piece meets every chunk of the cell.
        many = np.ones(len(fitted.centroids), np.int64)
        for r in asked:
            many[r["cell"]] = max(1, -(-r["n"] // CHUNK))
        table = lambda counts: F.array(*[F.lit(int(n)) for n in counts])[F.col("cell")]
        if many.max() > 1:
            probed = probed.withColumn("piece", F.pmod("piece", table(many)).cast("int"))
        else:
            probed = probed.withColumn("piece", F.lit(0))
        rows = self._table("vectors").filter(F.col("zone").isin([r["zone"] for r in asked] or [-1]))
        rows = rows.select(*STEM, "cell", "vector", (F.pmod(F.hash("stem"), table(chunks)) if chunks.max() > 1 else F.lit(0)).alias("chunk"))
        rows = rows.withColumn("piece", F.explode(F.sequence(F.lit(0), table(many) - 1)) if many.max() > 1 else F.lit(0))

        def rerank(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
            columns = ["entity_type", "block", "kind", "query", "stem", "distance"]
            out = []
            if len(asked) and len(held):
                groups = {key: h for key, h in held.groupby(["entity_type", "block", "kind"], sort=False)}
                for key, q in asked.groupby(["entity_type", "block", "kind"], sort=False):
                    h = groups.get(key)
                    if h is None:
                        continue
                    stems = h["stem"].to_numpy()
                    rows = np.frombuffer(b"".join(h["vector"]), np.int16).reshape(len(h), LETTERS)
                    wanted, bound = q["query"].to_numpy(), q["bound"].to_numpy()
                    v = letter_vectors(wanted.tolist())
                    size, sizes = v.sum(1), rows.sum(1)
                    step = max(1, 2_000_000 // (len(h) * LETTERS))
                    for lo in range(0, len(wanted), step):
                        hi = lo + step
                        d = np.abs(v[lo:hi, None, :] - rows[None]).sum(2)
                        i, j = np.nonzero(d <= bound[lo:hi, None])
                        if len(i):
                            out.append(pd.DataFrame({"entity_type": key[0], "block": key[1], "kind": key[2], "query": wanted[lo + i], "stem": stems[j], "distance": d[i, j].astype(np.int32)}))
            return pd.concat(out)[columns] if out else pd.DataFrame(columns=columns)

        keys = ["cell", "chunk", "piece"]
        return probed.groupBy(*keys).cogroup(rows.groupBy(*keys)).applyInPandas(rerank, HITS)

    def keyed(self, queries: DataFrame) -> DataFrame:
        """HITS by lookup keys, all at the distance UNBOUNDED: they leave a query's bound as it is."""
        asked = queries.select(*STEM[:3], F.col("stem").alias("query"), F.explode(lookup_keys(F.col("kind"), F.col("stem"))).alias("k")).select(*STEM[:3], "query", "k.*")
        held = self._table("keys").withColumnRenamed("side", "other")
        met = asked.join(held, [*STEM[:3], "key"]).filter("(side = 2 or side + other = 1) and query <> stem")
        return met.select(*STEM[:3], "query", "stem", F.lit(UNBOUNDED).alias("distance"))

    def match(self, batch: DataFrame) -> DataFrame:
        """(mention_id, sjid) of the rows of batch whose entity is registered."""
        scratch = self.scratch
        new = scratch.table(typed_rows(batch).distinct())
        laid = scratch.table(names.layouts(new.filter("raw is not null")))
        parsed = scratch.table(names.resolve(laid, names.word_roles(self._vocabulary(names.learn(laid)))))
        read_as = scratch.table(new.join(parsed, ["entity_type", "raw"]).withColumn("block", F.expr(BLOCK)))
        wanted = read_as.select("block", *NODE).distinct()
        words = self._table("words").groupBy("entity_type", "kind", "word").agg(F.sum("df").alias("df"))
        stems = scratch.table(wanted.select(*STEM).distinct().withColumn("bound", reach(F.col("block"), F.length(F.replace("stem", F.lit(" "), F.lit(""))))))
        nodes = self._table("nodes")

        def verified(hits: DataFrame) -> DataFrame:
            """Name-level matches of the hits: the query's node, the entity or null, score and distance."""
            met = hits.groupBy(*STEM[:3], "query", "stem").agg(F.min("distance").alias("distance"))
            met = scratch.table(met)
            both = met.select("entity_type", "kind", "stem").union(met.select("entity_type", "kind", F.col("query").alias("stem")))
            dfs = scratch.table(names.with_frequencies(both, words))
            pairs = met.join(dfs.withColumnRenamed("dfs", "dfs_y"), ["entity_type", "kind", "stem"]).join(dfs.select("entity_type", "kind", F.col("stem").alias("query"), F.col("dfs").alias("dfs_x")), ["entity_type", "kind", "query"])
            soft = pairs.mapInPandas(_soft_hits, HITS + ", soft double, rare double")
            q = wanted.select(*STEM[:3], F.col("stem").alias("query"), F.col("court").alias("court_a"), *[F.col(p).alias(f"{p}_a") for p in PARTS])
            h = nodes.select(*STEM, F.col("court").alias("court_b"), *[F.col(p).alias(f"{p}_b") for p in PARTS], "sjid")
            met = q.join(soft, [*STEM[:3], "query"]).join(h, STEM)
            fits = names._slot("g1_a", "g1_b") & names._slot("g2_a", "g2_b")
            for p in ("suffix", "form"):
                x, y = F.col(f"{p}_a"), F.col(f"{p}_b")
                fits &= (x == "") | (y == "") | (x == y)
            full = (F.length("g1_a") > 1) & (F.length("g1_b") > 1)
            near = F.col("court_a") == F.col("court_b")
            # An entity one of whose names contradicts the query is not the query's, though a vaguer name of it may fit.
            of_query = ["entity_type", "court_a", "kind", "query", *[f"{p}_a" for p in PARTS], "sjid"]
            allowed = ((F.col("soft") >= 0.99) | (F.col("kind") == "O") | near | full) & ((F.abs(F.col("soft") - names.PART_OF_STEM) > 1e-9) | near)
            agree = [F.when(F.col(f"{p}_a") == F.col(f"{p}_b"), 1.0).otherwise(0.0) for p in PARTS]
            score = (1.7 + 0.6 * F.col("rare")) * F.col("soft") + agree[0] + agree[1] + 1.5 * agree[2] + 1.5 * agree[3] + 0.5 * near.cast("double")
            best = met.groupBy(*of_query).agg(
                F.max((~fits & F.col("sjid").isNotNull()).cast("int")).alias("against"), F.max(F.when(fits & allowed, score)).alias("score"), F.min(F.when(fits & allowed, F.col("distance"))).alias("distance")
            )
            best = best.filter("against = 0 and score is not null")
            return best.select("entity_type", F.col("court_a").alias("court"), "kind", F.col("query").alias("stem"), *[F.col(f"{p}_a").alias(p) for p in PARTS], "sjid", "score", "distance")

        first = scratch.table(verified(self.search(stems, only_nearest=True).union(self.keyed(stems))))
        # The nearest registered match bounds what is still to be probed; a query asks for the widest of its nodes' bounds.
        best = first.filter("sjid is not null").groupBy(*NODE).agg(F.min("distance").alias("best"))
        left = wanted.join(best, NODE, "left").groupBy(*STEM).agg(F.max(F.coalesce("best", F.lit(UNBOUNDED))).alias("best"))
        left = stems.join(left, STEM).select(*STEM, F.least("bound", "best").cast("int").alias("bound")).filter("bound > 0")
        second = scratch.table(verified(self.search(left, only_nearest=False)))
        matched = scratch.table(first.unionByName(second).groupBy(*NODE, "sjid").agg(F.max("score").alias("score")))
        # Contacts shared with an entity decide between several.
        options = read_as.join(matched, NODE).groupBy("mention_id", "sjid").agg(F.max("score").alias("score"))
        shared = contact_keys(read_as, ["mention_id"]).join(self._table("contacts"), "key").select("mention_id", "sjid").distinct().withColumn("contact", F.lit(1))
        scored = options.join(shared, ["mention_id", "sjid"], "left").withColumn("score", F.col("score") + 3 * F.coalesce("contact", F.lit(0)))
        order = Window.partitionBy("mention_id").orderBy(F.desc("score"), F.asc_nulls_last("sjid"))
        ranked = scored.withColumn("rank", F.row_number().over(order)).withColumn("next", F.lead("score").over(order))
        chosen = ranked.filter("rank = 1 and sjid is not null and (next is null or next < score)").select("mention_id", "sjid")
        ids = self._table("ids").groupBy("mention_id").agg(F.min("sjid").alias("sjid"))
        again = scratch.table(new.select("mention_id").distinct().join(ids, "mention_id"))
        return again.select("mention_id", "sjid").union(chosen.join(again, "mention_id", "left_anti").select("mention_id", "sjid")).distinct()


def _soft_hits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        columns = [b[c].tolist() for c in ("block", "kind", "query", "stem", "dfs_x", "dfs_y")]
        soft = [1.0 if q == s else names.stem_softness(t, k, q, s, x, y) for t, k, q, s, x, y in zip(*columns)]
        rare = [names._weight(min(min(x), min(y))) for x, y in zip(columns[4], columns[5])]
        out = b[["entity_type", "block", "kind", "query", "stem", "distance"]].assign(soft=np.array(soft, float), rare=np.array(rare, float))
        yield out[out["soft"] > 0]


def known_entities(history: DataFrame, registry: DataFrame, batch: DataFrame, path: str | None = None) -> DataFrame:
    """(mention_id, sjid) of the rows of batch whose entity is in the registry, through an index written and opened again."""
    spark = history.sparkSession
    path = path or f"{shared_dir(spark)}/history-{uuid.uuid4().hex}"
    HistoryIndex.create(spark, path, history, registry)
    return HistoryIndex.open(spark, path).match(batch)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return known_entities(read(spark, sf_dir, "mentions"), read(spark, sf_dir, "entities"), read(spark, sf_dir, "incoming_mentions"))


QUERIES = {"p3_found": p3_found}
