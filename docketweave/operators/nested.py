"""Nested JSON text to linked flat tables, by vectorised structural indexing.

A batch of documents is one byte buffer. Quote, escape and bracket bitmaps are computed over the
whole buffer at once; nesting depth is a prefix sum over the structural characters outside
strings; a stable sort by level lines every container's separators up behind its opening
bracket, which gives the span, place and parent of every value without a recursive parser.

Defined results
- A text that is not valid JSON (null, empty, cut off, markup) gives no rows.
- An envelope (a list around the document, or an object under ``case`` or ``data``) is looked through.
- A list may be written as an array, as an object with number keys, as one bare object
  (place 0), or as a string that itself holds JSON; null and scalar places are no objects but
  keep their number.
- A repeated key counts by its last value. Very long texts need only a buffer of their own size.
- Nesting of any depth is read; a text that is nested too deep for the JSON parser is judged by its grammar.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUOTE, BACKSLASH = 34, 92
OPEN, CLOSE, COMMA, COLON = 1, 2, 3, 4
_KIND = np.zeros(256, np.int8)
for _chars, _kind in (("{[", OPEN), ("}]", CLOSE), (",", COMMA), (":", COLON)):
    for _c in _chars:
        _KIND[ord(_c)] = _kind
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 13]] = True

ENVELOPES = (b"case", b"data")
NODE_SCHEMA = T.StructType(
    [
        T.StructField("node_kind", T.StringType()),
        T.StructField("parent_index", T.IntegerType()),
        T.StructField("item_index", T.IntegerType()),
        T.StructField("fields", T.MapType(T.StringType(), T.StringType())),
    ]
)


class StructuralIndex:
    """Spans, places and parents of all values of a batch of JSON documents.

    Value v: ``container[v]`` (its container's number), ``place[v]`` (0-based), key span
    ``key_lo/key_hi[v]`` (-1 in arrays), value span ``lo/hi[v]``, and ``child[v]`` (the
    container it opens, -1 for scalars). ``first[c]:first[c+1]`` are the values of container c.
    """

    def __init__(self, docs: list[bytes]):
        self.buf = b"\n".join(docs) + b"\n"
        buf = np.frombuffer(self.buf, np.uint8)
        lengths = np.fromiter((len(d) for d in docs), np.int64, len(docs))
        self.start = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]]).astype(np.int64)
        self.end = self.start + lengths
        quotes = np.flatnonzero(buf == QUOTE)
        slashes = buf == BACKSLASH
        if slashes.any() and len(quotes):
            where = np.arange(len(buf), dtype=np.int64)
            plain = np.maximum.accumulate(np.where(slashes, -1, where))
            before = np.maximum(quotes - 1, 0)
            run = np.where(quotes > 0, before - plain[before], 0)
            quotes = quotes[run % 2 == 0]
        kinds = _KIND[buf]
        marks = np.flatnonzero(kinds)
        doc = np.searchsorted(self.start, marks, "right") - 1
        upto = np.searchsorted(quotes, marks)
        at_start = np.searchsorted(quotes, self.start)
        outside = (upto - at_start[doc]) % 2 == 0
        pos, doc = marks[outside], doc[outside]
        kind = kinds[pos]
        step = np.where(kind == OPEN, 1, np.where(kind == CLOSE, -1, 0))
        depth = np.cumsum(step)
        base = np.concatenate([[0], depth])[np.searchsorted(pos, self.start)]
        depth = depth - base[doc]
        level = depth + (kind == CLOSE)
        # A container's marks become neighbours: sorted by document and level, then by place.
        order = np.lexsort((pos, level, doc))
        pos, kind, doc = pos[order], kind[order], doc[order]
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        is_open = kind == OPEN
        number = np.cumsum(is_open) - 1
        self.containers = int(is_open.sum())
        self.open_pos = pos[is_open]
        self.is_object = buf[self.open_pos] == ord("{")
        self.doc_of = doc[is_open]
        n = len(pos)
        following = np.minimum(np.arange(n) + 1, max(n - 1, 0))
        in_object = self.is_object[number] if n else np.zeros(0, bool)
        starts = np.flatnonzero(np.where(in_object, kind == COLON, is_open | (kind == COMMA)))
        ends = following[starts]
        valid = (ends > starts) & ((kind[ends] == COMMA) | (kind[ends] == CLOSE))
        starts, ends = starts[valid], ends[valid]
        lo, hi = self._trim(buf, pos[starts] + 1, pos[ends])
        commas = np.cumsum(kind == COMMA)
        opens = np.flatnonzero(is_open)
        self.container = number[starts]
        self.place = (commas[starts] - commas[opens[self.container]]).astype(np.int64)
        filled = hi > lo
        self.container, self.place, lo, hi, starts = self.container[filled], self.place[filled], lo[filled], hi[filled], starts[filled]
        self.lo, self.hi = lo, hi
        keyed = self.is_object[self.container] if len(self.container) else np.zeros(0, bool)
        key_lo, key_hi = self._trim(buf, pos[np.maximum(starts - 1, 0)] + 1, pos[starts])
        self.key_lo, self.key_hi = np.where(keyed, key_lo, -1), np.where(keyed, key_hi, -1)
        opener = np.sort(self.open_pos)
        by_pos = np.argsort(self.open_pos, kind="stable")
        at = np.searchsorted(opener, lo)
        hit = (at < len(opener)) & (opener[np.minimum(at, max(len(opener) - 1, 0))] == lo) if len(opener) else np.zeros(len(lo), bool)
        self.child = np.where(hit, by_pos[np.minimum(at, max(len(by_pos) - 1, 0))], -1) if len(opener) else np.full(len(lo), -1)
        self.first = np.searchsorted(self.container, np.arange(self.containers + 1))
        self.bytes = buf

    @staticmethod
    def _trim(buf: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Spans without outer white space; a few rounds, as indents are short runs."""
        lo, hi = lo.copy(), hi.copy()
        todo = np.flatnonzero((lo < hi) & _SPACE[buf[np.minimum(lo, len(buf) - 1)]])
        while len(todo):
            lo[todo] += 1
            todo = todo[(lo[todo] < hi[todo])]
            todo = todo[_SPACE[buf[lo[todo]]]]
        todo = np.flatnonzero((lo < hi) & _SPACE[buf[np.maximum(hi - 1, 0)]])
        while len(todo):
            hi[todo] -= 1
            todo = todo[(lo[todo] < hi[todo])]
            todo = todo[_SPACE[buf[hi[todo] - 1]]]
        return lo, hi

    def key(self, v: int) -> bytes:
        raw = self.buf[self.key_lo[v] + 1 : self.key_hi[v] - 1]
        return json.loads(b'"' + raw + b'"').encode() if b"\\" in raw else raw

    def text(self, v: int) -> bytes:
        return self.buf[self.lo[v] : self.hi[v]]

    def members(self, c: int) -> dict[bytes, int]:
        """Value numbers of an object by key; the last of a repeated key."""
        return {self.key(v): v for v in range(self.first[c], self.first[c + 1])}

    def root(self, d: int) -> int:
        """Container that document d consists of, or -1."""
        lo, hi = self._trim(self.bytes, self.start[d : d + 1], self.end[d : d + 1])
        found = np.flatnonzero(self.open_pos == lo[0]) if hi[0] > lo[0] else ()
        return int(found[0]) if len(found) else -1

    def roots(self) -> np.ndarray:
        lo, hi = self._trim(self.bytes, self.start, self.end)
        out = np.full(len(lo), -1)
        if self.containers:
            order = np.argsort(self.open_pos, kind="stable")
            at = np.minimum(np.searchsorted(self.open_pos[order], lo), self.containers - 1)
            hit = (hi > lo) & (self.open_pos[order][at] == lo)
            out[hit] = order[at[hit]]
        return out


_TOKEN = re.compile(r'[ \t\n\r]*(?:([{}\[\],:])|("(?:[^"\\\x00-\x1f]|\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4}))*")|(-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?|true|false|null))')


def well_formed(text: str) -> bool:
    """Whether a text is JSON, at any depth of nesting: one pass over its tokens with a stack of open brackets."""
    stack: list[str] = []
    # What may come next: a value (v), a value or ] (a), a key or } (k), a key (K), a colon (:), a comma or the end of the container (,), nothing (end).
    state, at = "v", 0
    while m := _TOKEN.match(text, at):
        mark, string, scalar = m.groups()
        at = m.end()
        if mark in ("{", "[") and state in "va":
            stack.append(mark)
            state = "k" if mark == "{" else "a"
            continue
        if mark == "}" and stack and stack[-1] == "{" and state in "k,":
            stack.pop()
        elif mark == "]" and stack and stack[-1] == "[" and state in "a,":
            stack.pop()
        elif mark == "," and state == "," and stack:
            state = "K" if stack[-1] == "{" else "v"
            continue
        elif mark == ":" and state == ":":
            state = "v"
            continue
        elif string and state in "kK":
            state = ":"
            continue
        elif not ((string or scalar) and state in "va"):
            return False
        state = "," if stack else "-"
    return state == "-" and not text[at:].strip(" \t\n\r")


def _readable(text: bytes) -> bool:
    try:
        json.loads(text)
    except RecursionError:
        return well_formed(text.decode("utf-8", "surrogatepass"))
    except ValueError:
        return False
    return True


class _Walk:
    """Objects of one batch, level by level along a tree of list names."""

    def __init__(self, docs: list[bytes], tree: dict, fields: bool):
        self.tree, self.fields = tree, fields
        self.out: list[tuple[int, str, int, int, dict | None]] = []
        self.deferred: list[tuple[int, str, int, bytes, dict]] = []
        index = StructuralIndex(docs)
        for d, c in enumerate(index.roots().tolist()):
            if c >= 0:
                self._document(index, d, c)
        while self.deferred:  # lists held in strings are indexed again, all of one level at once
            todo, self.deferred = self.deferred, []
            index = StructuralIndex([t[3] for t in todo])
            roots = index.roots().tolist()
            for (d, kind, parent, _, sub), c in zip(todo, roots):
                if c >= 0:
                    self._container(index, d, kind, parent, c, sub)

    def _document(self, index: StructuralIndex, d: int, c: int) -> None:
        todo = [c]  # containers still to look through, the next one last
        while todo:
            c = todo.pop()
            if not index.is_object[c]:
                inner = index.child[index.first[c] : index.first[c + 1]]
                todo += inner[inner >= 0][::-1].tolist()
                continue
            members = index.members(c)
            if not any(name.encode() in members for name in self.tree):
                held = (members.get(name, -1) for name in ENVELOPES)
                v = next((v for v in held if v >= 0 and index.child[v] >= 0), -1)
                if v >= 0:
                    todo.append(int(index.child[v]))
                    continue
            self._lists(index, d, -1, members, self.tree)

    def _lists(self, index: StructuralIndex, d: int, parent: int, members: dict[bytes, int], tree: dict) -> None:
        for name, (kind, sub) in tree.items():
            v = members.get(name.encode(), -1)
            if v < 0:
                continue
            if index.child[v] >= 0:
                self._container(index, d, kind, parent, int(index.child[v]), sub)
            elif index.bytes[index.lo[v]] == QUOTE:
                inner = json.loads(index.text(v))
                if inner.lstrip()[:1] in ("[", "{") and _readable(inner.encode("utf-8", "surrogatepass")):
                    self.deferred.append((d, kind, parent, inner.encode("utf-8", "surrogatepass"), sub))

    def _container(self, index: StructuralIndex, d: int, kind: str, parent: int, c: int, sub: dict) -> None:
        lo, hi = int(index.first[c]), int(index.first[c + 1])
        if not index.is_object[c]:
            items = zip(index.place[lo:hi].tolist(), index.child[lo:hi].tolist())
        else:
            members = index.members(c)
            if members and all(k.isdigit() for k in members):
                items = ((int(k), int(index.child[v])) for k, v in members.items())
            elif members:
                items = [(0, c)]
            else:
                items = []
        for place, child in items:
            if child >= 0 and index.is_object[child]:
                members = index.members(child) if sub or self.fields else {}
                self.out.append((d, kind, parent, place, self._scalars(index, members, sub) if self.fields else None))
                self._lists(index, d, place, members, sub)

    def _scalars(self, index: StructuralIndex, members: dict[bytes, int], sub: dict) -> dict[str, str]:
        out: dict[str, str] = {}
        todo = [("", members)]
        while todo:
            prefix, at = todo.pop()
            for key, v in at.items():
                name = prefix + key.decode("utf-8", "replace")
                if not prefix and name in sub:
                    continue
                child = int(index.child[v])
                if child >= 0 and index.is_object[child]:
                    todo.append((name + ".", index.members(child)))
                else:
                    raw = index.text(v)
                    if raw != b"null":
                        value = json.loads(raw) if raw[:1] == b'"' else raw.decode("utf-8", "replace")
                        out[name] = value.encode("utf-8", "replace").decode()
        return out


def walk_batch(texts: list[str | None], tree: dict, fields: bool = False) -> list[tuple[int, str, int, int, dict | None]]:
    """(document, kind, parent's place or -1, own place, fields) of every object in the readable texts."""
    docs = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]
    keep = [i for i, d in enumerate(docs) if d and _readable(d)]
    found = _Walk([docs[i] for i in keep], tree, fields).out if keep else []
    return [(keep[d], *rest) for d, *rest in found]


#: The lists of a case document: name -> (kind of its objects, lists inside them).
CASE_TREE = {"parties": ("party", {"counsel": ("counsel", {})}), "docket": ("docket", {})}


def flatten_json(df: DataFrame, key: str, text: str, tree: dict = CASE_TREE, fields: bool = True, batch_bytes: int = 8 << 20) -> DataFrame:
    """One row per object of the lists in ``tree``: key, node_kind, parent_index, item_index, fields.

    parent_index is the place of the enclosing object, -1 at the top. Only the two columns named
    are read, so other columns may have any name. No shuffle: each input partition becomes one of the output.
    """
    schema = T.StructType([T.StructField(key, df.schema[key].dataType), *NODE_SCHEMA.fields])

    def emit(keys: pa.Array, texts: list[str | None]) -> pa.RecordBatch:
        rows = walk_batch(texts, tree, fields)
        arrays = [
            keys.take(pa.array([r[0] for r in rows], pa.int64())),
            pa.array([r[1] for r in rows], pa.string()),
            pa.array([r[2] for r in rows], pa.int32()),
            pa.array([r[3] for r in rows], pa.int32()),
            pa.array([None if r[4] is None else list(r[4].items()) for r in rows], pa.map_(pa.string(), pa.string())),
        ]
        return pa.RecordBatch.from_arrays(arrays, names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1).to_pylist()
            lo, held = 0, 0
            for i, t in enumerate(texts):
                held += len(t or "")
                if held > batch_bytes or i + 1 == len(texts):
                    yield emit(keys.slice(lo, i + 1 - lo), texts[lo : i + 1])
                    lo, held = i + 1, 0

    return df.select(F.col(key).alias("_key"), F.col(text).alias("_text")).mapInArrow(run, schema)
