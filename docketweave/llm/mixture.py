"""Mixing sources to target weights, by iterative proportional fitting of token weights.

Documents are grouped into cells of source, language and topic. The cells' token sums are raked until
the sources have their target shares and languages and topics keep their shares of the corpus, with no cell's
weight above the repeats that its source allows; the source shares are fitted last. The total is the largest at which
every source can reach its share. A cell's weight is the expected number of uses of each of its documents; documents are
drawn by systematic sampling in buckets ordered by length, so drawn tokens stay close to the fitted ones.

Topics come from nearest centroids of hashed word counts, fitted on all documents: a pass over the texts writes their counts, each round
of the fit reads these. Only the cells' sums, and those of each task's documents by nearest centroid, reach the driver. Defined results: null, empty and blank texts have no tokens and are never drawn; null and unlisted sources take
no part; a listed source without tokens gets nothing and its share goes to the others in proportion, as reported.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docketweave.llm.tokens import ByteBPE, vocabulary_path
from docketweave.session import Scratch, read

TOPICS, TOPIC_DIM, ROUNDS, BUCKET_ROWS, BATCH_CHARS = 8, 64, 10, 20_000, 4_000_000
#: So many languages, those of most documents, have a cell of their own; all others share one. This bounds the table of cells, not the documents.
LANGUAGES = 32


def word_counts(texts: list[str]) -> np.ndarray:
    """Log counts of hashed words, a row each, of length one."""
    out = np.zeros((len(texts), TOPIC_DIM), np.float32)
    for row, t in zip(out, texts):
        words = (t or "").lower().split()
        if words:
            at = pd.util.hash_array(np.array(words, object), categorize=True) % TOPIC_DIM
            row += np.log1p(np.bincount(at.astype(np.int64), minlength=TOPIC_DIM)).astype(np.float32)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def _nearest(b: pd.DataFrame, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    v = np.frombuffer(b"".join(b["v"]), np.float32).reshape(len(b), TOPIC_DIM)
    return v, (v @ centroids.T - 0.5 * (centroids**2).sum(1)).argmax(1)


def fit_topics(counted: DataFrame) -> np.ndarray:
    """Centroids of all rows of counted (key, v: word_counts as bytes), by rounds of sums over all of them.

    Each starts at a document, those first by the hash of their keys. Sums are in whole steps of 1e-6, so
    that their order, which differs between runs, changes nothing.
    """
    first = counted.orderBy(F.xxhash64("key"), "key").limit(TOPICS).collect()
    centroids = np.stack([np.frombuffer(r["v"], np.float32) for r in first]).astype(float) if first else np.zeros((1, TOPIC_DIM))
    for _ in range(ROUNDS):
        at = centroids

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros((len(at), TOPIC_DIM + 1), np.int64)  # noqa: B023
            for b in batches:
                if len(b):
                    v, near = _nearest(b, at)  # noqa: B023
                    np.add.at(total, near, np.concatenate([np.rint(v.astype(float) * 1e6), np.ones((len(v), 1))], 1).astype(np.int64))
            yield pd.DataFrame({"c": np.arange(len(total), dtype=np.int32), "sums": total.tolist()})

        sums = np.zeros((len(at), TOPIC_DIM + 1), np.int64)
        for r in counted.select("v").mapInPandas(run, "c int, sums array<bigint>").groupBy("c").agg(*[F.sum(F.col("sums")[i]).alias(str(i)) for i in range(TOPIC_DIM + 1)]).collect():
            sums[r["c"]] = r[1:]
        some = sums[:, -1] > 0
        centroids = at.copy()
        centroids[some] = sums[some, :-1] / 1e6 / sums[some, -1:]
        if np.abs(centroids - at).max() < 1e-6:
            break
    return centroids


def sized(docs: DataFrame, key: str, text: str, path: str | None = None) -> DataFrame:
    """docs with n_tokens and topic, without the text; one pass over the texts."""
    path = path or vocabulary_path()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = ByteBPE.load(path)
        for whole in batches:
            # Encoded in pieces of bounded size, a text never in two.
            piece = whole["_text"].str.len().cumsum() // BATCH_CHARS
            for _, b in whole.groupby(piece, sort=False):
                offsets, _ = bpe.encode(b["_text"].tolist())
                v = word_counts(b["_text"].tolist())
                yield b.drop(columns="_text").assign(n_tokens=np.diff(offsets).astype(np.int64), v=[x.tobytes() for x in v])

    common = docs.filter("lang is not null").groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()
    kept = docs.select(F.col(key).alias("key"), "source", F.when(F.col("lang").isin([r["lang"] for r in common]), F.col("lang")).otherwise("other").alias("lang"), F.col(text).alias("_text"))
    kind = docs.schema[key].dataType.simpleString()
    scratch = Scratch(docs.sparkSession, "topics")
    counted = scratch.table(kept.filter(F.trim("_text") != "").mapInPandas(run, f"key {kind}, source string, lang string, n_tokens bigint, v binary"))
    centroids = fit_topics(counted)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                yield b.drop(columns="v").assign(topic=_nearest(b, centroids)[1].astype(np.int32))

    return counted.mapInPandas(place, f"key {kind}, source string, lang string, n_tokens bigint, topic int")


def rake(cells: pd.DataFrame, shares: dict[str, float], repeats: dict[str, int], rounds: int = 200) -> np.ndarray:
    """Weight of each cell (source, lang, topic, tokens)."""
    tokens = cells["tokens"].to_numpy(float)
    source = cells["source"].to_numpy()
    present = {s: tokens[source == s].sum() for s in shares}
    usable = {s: shares[s] for s in shares if present[s] > 0 and shares[s] > 0}
    if not usable:
        return np.zeros(len(cells))
    scale = sum(usable.values())
    goal = {s: v / scale for s, v in usable.items()}
    total = min(repeats[s] * present[s] / goal[s] for s in goal)
    cap = np.array([repeats[s] for s in source], float)
    weight = np.array([goal.get(s, 0) * total / present[s] if present.get(s) else 0.0 for s in source])
    margins = [(cells[c].to_numpy(), {k: t / tokens.sum() * total for k, t in cells.groupby(c)["tokens"].sum().items()}) for c in ("lang", "topic")]

    def fit_sources() -> None:
        for s, share in goal.items():
            mine = source == s
            for _ in range(20):  # what the cap cuts off goes to the source's other cells
                have = (weight[mine] * tokens[mine]).sum()
                if have <= 0:
                    weight[mine] = share * total / present[s]
                    continue
                weight[mine] = np.minimum(weight[mine] * (share * total / have), cap[mine])
                if abs((weight[mine] * tokens[mine]).sum() - share * total) <= 1e-9 * total:
                    break

    for _ in range(rounds):
        before = weight.copy()
        for values, targets in margins:
            for k, target in targets.items():
                mine = values == k
                have = (weight[mine] * tokens[mine]).sum()
                if have > 0:
                    weight[mine] = np.minimum(weight[mine] * (target / have), cap[mine])
        fit_sources()
        if np.abs(weight - before).max() < 1e-7:
            break
    return weight


def mix(docs: DataFrame, targets: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 17) -> tuple[DataFrame, DataFrame]:
    """(drawn, report): drawn has (key, source, n_tokens, copies >= 1), report one row per listed source."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "mixture")
    listed = targets.filter("source is not null").groupBy("source").agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    of_source = {r["source"]: (r["target_share"] or 0.0, r["max_repeats"] or 0) for r in listed.collect()}  # one row per listed source
    documents = scratch.table(sized(docs.filter(F.col("source").isin(list(of_source))), key, text))
    cells = documents.groupBy("source", "lang", "topic").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("n")).toPandas()  # sources x languages x topics
    weights = rake(cells, {s: v[0] for s, v in of_source.items()}, {s: v[1] for s, v in of_source.items()})
    buckets = (cells.groupby("source")["n"].sum() // BUCKET_ROWS + 1).to_dict()
    table = spark.createDataFrame(
        [(*map(str, r[:2]), int(r[2]), float(w), int(buckets[r[0]])) for r, w in zip(cells[["source", "lang", "topic"]].itertuples(index=False), weights)],
        "source string, lang string, topic int, weight double, buckets int",
    )
    bucket = Window.partitionBy("source", "bucket").orderBy("n_tokens", "key").rowsBetween(Window.unboundedPreceding, 0)
    whole, part = F.floor("weight"), F.col("weight") - F.floor("weight")
    begin = F.pmod(F.xxhash64("source", "bucket", F.lit(seed)), F.lit(1 << 20)) / F.lit(float(1 << 20))
    upto = F.round(F.sum(part).over(bucket), 9) + begin
    drawn = (
        documents.join(F.broadcast(table), ["source", "lang", "topic"])
        .withColumn("bucket", F.pmod(F.xxhash64("key", F.lit(seed)), F.col("buckets")))
        .withColumn("upto", upto)
        .withColumn("copies", (whole + F.floor("upto") - F.floor(F.round(F.col("upto") - part, 9))).cast("int"))
        .filter("copies > 0 and n_tokens > 0")
        .select(F.col("key").alias(key), "source", "n_tokens", "copies")
    )
    drawn = scratch.table(drawn)
    used = drawn.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("tokens"), F.count("*").alias("documents"), F.max("copies").alias("most_repeats"))
    total = used.agg(F.sum("tokens").alias("total"))
    report = listed.join(used, "source", "left").crossJoin(total).select(  # the total is one row
        "source", "target_share", F.round(F.coalesce(F.col("tokens") / F.col("total"), F.lit(0.0)), 6).alias("actual_share"), F.coalesce("tokens", F.lit(0)).alias("tokens"), F.coalesce("documents", F.lit(0)).alias("documents"), F.coalesce("most_repeats", F.lit(0)).alias("most_repeats"),
    )
    return drawn, report


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents"), read(spark, sf_dir, "mix_targets"))[0]


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents"), read(spark, sf_dir, "mix_targets"))[1]


QUERIES = {"p9_mix": p9_mix, "p9_shares": p9_shares}
