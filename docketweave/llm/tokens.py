"""Corpus encoding with a public byte-level BPE, by batched numpy merge rounds.

The different words of a batch lie in one flat array of symbols. In each round every word's
lowest-rank adjacent pair is found at once, by binary search over the sorted keys of the known
pairs and a segmented minimum, and merged wherever it occurs in that word; words without a known
pair leave the array. Words already encoded by this worker come from a bounded cache.

Defined results: null and empty texts give an empty list; every other text is encoded whole,
special tokens are ordinary text. The vocabulary file's path is a parameter; each worker reads
it once, so it must be readable at that path on every executor.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docketweave.session import read

CACHE_WORDS = 400_000
NO_RANK = np.iinfo(np.int32).max
_LOADED: dict[str, "ByteBPE"] = {}


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _letters_of_bytes() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabularies, by their public rule."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    out = {chr(b): b for b in shown}
    extra = 0
    for b in range(256):
        if b not in shown:
            out[chr(256 + extra)] = b
            extra += 1
    return out


class ByteBPE:
    """A byte-level BPE read from a tokenizers JSON file."""

    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, merges = model["vocab"], model["merges"]
        self.size = max(vocab.values()) + 1
        self.of_byte = np.zeros(256, np.int64)
        for letter, b in _letters_of_bytes().items():
            self.of_byte[b] = vocab[letter]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.merged = keys[order], order.astype(np.int32), merged[order]
        self.split = regex.compile(self.PATTERN).findall
        self.cache: dict[str, list[int]] = {}

    @staticmethod
    def load(path: str) -> "ByteBPE":
        if path not in _LOADED:
            _LOADED[path] = ByteBPE(path)
        return _LOADED[path]

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        """Ids of each word; words are not empty."""
        lengths = np.fromiter((len(w) for w in words), np.int64, len(words))
        symbols = self.of_byte[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), lengths)
        out: list[list[int]] = [[]] * len(words)
        while len(symbols):
            at = np.full(len(symbols), -1)
            rank = np.full(len(symbols), NO_RANK, np.int32)
            inner = np.flatnonzero(word[1:] == word[:-1])
            if len(inner):
                keys = symbols[inner] * self.size + symbols[inner + 1]
                found = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
                known = self.keys[found] == keys
                at[inner[known]] = found[known]
                rank[inner[known]] = self.ranks[found[known]]
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            lowest = np.minimum.reduceat(rank, first)
            sizes = np.diff(np.append(first, len(word)))
            done = lowest == NO_RANK
            if done.any():
                listed = symbols.tolist()
                for i in np.flatnonzero(done).tolist():
                    out[word[first[i]]] = listed[first[i] : first[i] + sizes[i]]
            best = np.repeat(lowest, sizes)
            take = (rank == best) & (best != NO_RANK)
            # A pair of one symbol twice may overlap itself: of a run of hits every second one counts.
            where = np.flatnonzero(take)
            if len(where) > 1:
                run = np.concatenate([[True], (np.diff(where) != 1) | (word[where[1:]] != word[where[:-1]])])
                begin = np.maximum.accumulate(np.where(run, np.arange(len(where)), 0))
                where = where[(np.arange(len(where)) - begin) % 2 == 0]
            keep = np.repeat(~done, sizes)
            symbols = symbols.copy()
            symbols[where] = self.merged[at[where]]
            keep[where + 1] = False
            symbols, word = symbols[keep], word[keep]
        return out

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Offsets (one more than texts) and flat ids."""
        parts = [self.split(t) if t else [] for t in texts]
        words = list(chain.from_iterable(parts))
        missing = list({w for w in words if w not in self.cache})
        if missing:
            if len(self.cache) + len(missing) > CACHE_WORDS:
                self.cache = {w: self.cache[w] for w in set(words) if w in self.cache}
            self.cache.update(zip(missing, self.encode_words([w.encode() for w in missing])))
        ids = [self.cache[w] for w in words]
        counts = np.fromiter((len(x) for x in ids), np.int64, len(ids))
        upto = np.concatenate([[0], np.cumsum(counts)])
        ends = np.cumsum(np.fromiter((len(p) for p in parts), np.int64, len(parts)))
        offsets = np.concatenate([[0], upto[ends]]).astype(np.int32)
        return offsets, np.fromiter(chain.from_iterable(ids), np.int32, int(upto[-1]))


def encode_corpus(df: DataFrame, key: str, text: str, path: str | None = None, batch_chars: int = 1 << 20) -> DataFrame:
    """(key, ids array<int>) for every row of df; a map over partitions without a shuffle."""
    path = path or vocabulary_path()
    schema = T.StructType([T.StructField(key, df.schema[key].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBPE.load(path)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1).to_pylist()
            lo, held = 0, 0
            for i, t in enumerate(texts):
                held += len(t or "")
                if held >= batch_chars or i + 1 == len(texts):
                    offsets, ids = bpe.encode(texts[lo : i + 1])
                    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32()))
                    yield pa.RecordBatch.from_arrays([keys.slice(lo, i + 1 - lo), lists], names=[key, "ids"])
                    lo, held = i + 1, 0

    return df.select(F.col(key).alias(key), F.col(text).cast("string").alias("_text")).mapInArrow(run, schema)


def count_tokens(df: DataFrame, key: str, text: str, path: str | None = None) -> DataFrame:
    """(key, n_tokens) without moving the ids out of Python."""
    return encode_corpus(df, key, text, path).select(key, F.size("ids").cast("bigint").alias("n_tokens"))


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_corpus(read(spark, sf_dir, "documents"), "doc_id", "text")


QUERIES = {"p8_ids": p8_ids}
