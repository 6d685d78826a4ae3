"""Self-joins whose groups may be very uneven: a large group is cut into pieces and joined piece by piece."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK = 4096


def split_sides(rows: DataFrame, size: Column, by: Column, chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """Both sides of a self-join of rows; join them on the key and piece_a and piece_b.

    size bounds the rows of a row's group from above. A group of more than ``chunk`` rows is hashed by ``by`` into
    pieces, and every pair of its pieces is a group of its own of about chunk x chunk pairs. Each pair of rows meets once.
    """
    pieces = F.ceil(size / F.lit(chunk)).cast("int")
    marked = rows.withColumn("_pieces", F.greatest(pieces, F.lit(1)))
    piece = F.pmod(F.xxhash64(by), F.col("_pieces")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("_pieces") - 1))
    left = marked.withColumn("piece_a", piece).withColumn("piece_b", every).drop("_pieces")
    right = marked.withColumn("piece_b", piece).withColumn("piece_a", every).drop("_pieces")
    return left, right


def group_pairs(rows: DataFrame, group: str, item: str, keep: list[str] = [], chunk: int = CHUNK) -> DataFrame:  # noqa: B006
    """(item_a, item_b, keep_a..., keep_b...) of the different items of every group, item_a < item_b."""
    sizes = rows.groupBy(group).agg(F.count("*").alias("_size"))
    left, right = split_sides(rows.select(group, item, *keep).join(sizes, group), F.col("_size"), F.col(item), chunk)
    a = left.select(group, "piece_a", "piece_b", F.col(item).alias(f"{item}_a"), *[F.col(c).alias(f"{c}_a") for c in keep])
    b = right.select(group, "piece_a", "piece_b", F.col(item).alias(f"{item}_b"), *[F.col(c).alias(f"{c}_b") for c in keep])
    return a.join(b, [group, "piece_a", "piece_b"]).filter(F.col(f"{item}_a") < F.col(f"{item}_b")).drop(group, "piece_a", "piece_b")
