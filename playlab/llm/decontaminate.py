"""Benchmark decontamination by Wu-Manber multi-pattern search (operator 12).

Wu, Manber, "A Fast Algorithm for Multi-Pattern Searching" (1994).  A text's words are
``[0-9a-z]`` and non-ASCII characters after lower-casing A-Z.  A benchmark window is
``window`` consecutive words of an item, or all words of a shorter item; it occurs where
a document has these words in a row.

Texts become their words, each with one space before and after it, so a window is a
byte string and its occurrences are those of the string:

* windows are grouped by length (powers of two).  A group looks at windows of ``m`` bytes,
  its shortest pattern (256 at most), and at blocks of ``b = min(8, m)`` bytes;
* the shift table gives for the (hashed) block at a window's end how far the window
  can move without missing a pattern: ``m - b + 1`` for a block that no pattern has;
* at shift 0 the hash of the block and of the window's first block selects a bucket of
  patterns, and direct comparison of their whole bytes decides.

Cursors of many stretches of text move together, as NumPy arrays.

Bounds: the (window, item) pairs are dealt by hash into shards of at most about
``shard_bytes``; a shard's pairs are fetched and broadcast, and documents pass it in a narrow
map.  Usually there is one shard; with several, each is a pass over the documents, whose
state between passes lies in the shared folder.  Neither documents nor matches
are shuffled, so hot sources and copies gather nowhere.

Results: null or wordless text has no words and no hits; null or wordless items
have no windows; a null item id counts as ''; items of one id are one item; repeated
documents each get their row; an empty benchmark leaves all clean; an empty table gives
no rows; further columns are kept, except those named like a result, which it replaces.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlab.llm.common import mix64, slices
from playlab.session import ship_package, write_stage

STRETCH = 512  # bytes of text per cursor
SLICE = 4 << 20  # bytes of text searched at once
LONGEST = 256  # bytes of a pattern that the shift table looks at; the comparison is of all bytes
PAIR_BYTES = 200  # what a (window, item) pair costs in a task's tables besides its bytes

_KEEP = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
_MASKS = np.array([(1 << 8 * b) - 1 for b in range(9)], np.uint64)


def normal(text: str | None) -> bytes:
    """The words of a text, one space before, between and after them ('' without words)."""
    words = (text or "").encode().translate(_KEEP).split()
    return b" " + b" ".join(words) + b" " if words else b""


def windows(text: str | None, window: int) -> list[bytes]:
    """The distinct windows of an item, in order."""
    words = normal(text).split()
    if not words:
        return []
    last = max(len(words) - window, 0)
    return list(dict.fromkeys(b" " + b" ".join(words[i:i + window]) + b" " for i in range(last + 1)))


def _blocks(data: bytes) -> np.ndarray:
    """The eight bytes from every place on, as one number (zeros after the end)."""
    return np.ndarray((len(data),), "<u8", data + bytes(8), 0, (1,))


class _Group:
    """Shift table and buckets of patterns of similar length."""

    def __init__(self, patterns: dict[bytes, object]):
        self.m = m = min(LONGEST, min(map(len, patterns)))
        self.b = b = min(8, m)
        self.mask = _MASKS[b]
        heads = b"".join(p[:m] for p in patterns)
        at = _blocks(heads).reshape(len(patterns), m)[:, :m - b + 1] & self.mask
        self.bits = max(10, int(4 * len(np.unique(at))).bit_length())
        self.shift = np.full(1 << self.bits, m - b + 1, np.int32)
        for j in range(m - b + 1):  # later blocks have smaller shifts, so they are written last
            self.shift[self._slot(at[:, j])] = m - b - j
        self.buckets: dict[int, dict[int, dict[bytes, object]]] = {}
        keys = self._key(at[:, -1], at[:, 0])
        for key, (p, value) in zip(keys.tolist(), patterns.items()):
            self.buckets.setdefault(key, {}).setdefault(len(p), {})[p] = value
        self.keys = np.unique(keys)

    def _slot(self, blocks: np.ndarray) -> np.ndarray:
        return (blocks * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)

    @staticmethod
    def _key(last: np.ndarray, first: np.ndarray) -> np.ndarray:
        return mix64(last ^ mix64(first))

    def search(self, data: bytes, blocks: np.ndarray):
        """(place, value) of every occurrence of a pattern."""
        n = len(data) - self.m + 1
        if n <= 0:
            return
        place = np.arange(0, n, STRETCH)
        end = np.minimum(place + STRETCH, n)
        back = self.m - self.b
        while len(place):
            last = blocks[place + back] & self.mask
            step = self.shift[self._slot(last)]
            zero = np.flatnonzero(step == 0)
            if len(zero):
                here = place[zero]
                key = self._key(last[zero], blocks[here] & self.mask)
                found = self.keys[np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)] == key
                for p, k in zip(here[found].tolist(), key[found].tolist()):
                    for size, table in self.buckets[k].items():
                        value = table.get(data[p:p + size])
                        if value is not None:
                            yield p, size, value
                step[zero] = 1
            place = place + step
            more = place < end
            place, end = place[more], end[more]


class WuManber:
    """Finds all occurrences of byte strings; ``patterns`` maps each to a value that is not None."""

    def __init__(self, patterns: dict[bytes, object]):
        by_size: dict[int, dict] = {}
        for p, value in patterns.items():
            by_size.setdefault(len(p).bit_length(), {})[p] = value
        self.groups = [_Group(g) for g in by_size.values()]

    def search(self, data: bytes):
        blocks = _blocks(data)
        for group in self.groups:
            yield from group.search(data, blocks)


def _hits(texts: list[str | None], search: WuManber):
    """Per text: number of words, word ranges of the occurrences, item ids."""
    data = b" \n ".join([(t or "").encode().translate(_KEEP) for t in texts])
    raw = np.frombuffer(b" " + data + b" ", np.uint8)
    space = raw == 32
    keep = ~space
    keep[1:] |= ~space[:-1]
    keep[0] = True
    raw = raw[keep]
    space = raw == 32
    starts = np.flatnonzero(space[:-1] & ~space[1:])  # the space before each word, and before each line end
    lines = np.flatnonzero(raw[starts + 1] == 10)
    before = np.r_[0, lines - np.arange(len(lines)), len(starts) - len(lines)]  # words before each text
    starts = np.delete(starts, lines)
    counts = np.diff(before)
    out: dict[int, tuple[list, set]] = {}
    for place, size, items in search.search(raw.tobytes()):
        first = int(np.searchsorted(starts, place))
        doc = int(np.searchsorted(before, first, "right")) - 1
        ranges, found = out.setdefault(doc, ([], set()))
        first -= int(before[doc])
        ranges.append((first, first + items[0]))
        found.update(items[1])
    return counts, out


def merged(ranges) -> list[tuple[int, int]]:
    """Ranges joined where they touch or overlap."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


_TABLES: dict[str, WuManber] = {}


def _tables(name: str, pairs: bytes) -> WuManber:
    """The search of a shard, built once in each Python worker."""
    if name not in _TABLES:
        _TABLES.clear()
        patterns: dict[bytes, tuple[int, list]] = {}
        for batch in pa.ipc.open_stream(pairs):
            for p, item in zip(batch.column("pattern").to_pylist(), batch.column("item").to_pylist()):
                patterns.setdefault(p, (p.count(b" ") - 1, []))[1].append(item)
        _TABLES[name] = WuManber(patterns)
    return _TABLES[name]


_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
_RANGES = T.ArrayType(T.StructType().add("start", "long").add("end", "long"))
_NEW = (T.StructType().add("n_words", "long").add("n_hit", "long").add("spans", _RANGES)
        .add("items", T.ArrayType(T.StringType())).add("contaminated", "boolean").fields)


def benchmark_windows(bench: DataFrame, window: int = 10, item: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct (item, pattern) of a benchmark table."""
    def cut(batches):
        for batch in batches:
            ids, texts = (batch.column(i).to_pylist() for i in range(2))
            rows = [(i, p) for i, t in zip(ids, texts) for p in windows(t, window)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()),
                                              pa.array([r[1] for r in rows], pa.binary())], names=["item", "pattern"])

    return (bench.select(F.coalesce(F.col(f"`{item}`").cast("string"), F.lit("")).alias("item"),
                         F.col(f"`{text}`").alias("text"))
            .where("text is not null").mapInArrow(cut, "item string, pattern binary").distinct())


def decontaminate(docs: DataFrame, bench: DataFrame, window: int = 10, text: str = "text", item: str = "item_id",
                  item_text: str = "text", shard_bytes: int = 32 << 20) -> DataFrame:
    """All columns of ``docs`` with ``n_words``, ``n_hit``, ``spans`` (ranges of hit words, numbered from 0),
    ``items`` (sorted ids of the items with an occurring window) and ``contaminated``."""
    spark = docs.sparkSession
    ship_package(spark)
    pairs = write_stage(benchmark_windows(bench, window, item, item_text), "benchmark-windows")
    size = pairs.agg(F.sum(F.length("pattern") + F.octet_length("item") + PAIR_BYTES)).first()[0] or 0
    shards = max(1, -(-size // shard_bytes))
    new = {f.name for f in _NEW}
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in new])
    names, own = docs.columns, len(docs.columns)
    at = names.index(text)
    docs = docs.toDF(*[f"own{i}" for i in range(own)])  # a name with a dot can't enter the map below
    schema = T.StructType(docs.schema.fields + list(_NEW))

    def passing(name, shared):
        def search(batches):
            tables = _tables(name, shared.value)
            for batch in batches:
                texts = batch.column(at).to_pylist()
                earlier = {}
                if batch.num_columns > own:  # state of the shards before this one
                    spans, items = (batch.column(own + i).to_pylist() for i in (2, 3))
                    earlier = {i: (s, x) for i, (s, x) in enumerate(zip(spans, items)) if s}
                n_words, n_hit, spans, items = [], [], [], []
                for i, j in slices([len(t or "") for t in texts], SLICE):
                    counts, found = _hits(texts[i:j], tables)
                    n_words += counts.tolist()
                    for doc in range(i, j):
                        ranges, ids = found.get(doc - i, ([], set()))
                        if doc in earlier:
                            ranges = ranges + [(s["start"], s["end"]) for s in earlier[doc][0]]
                            ids = ids.union(earlier[doc][1])
                        ranges = merged(ranges) if ranges else ranges
                        n_hit.append(sum(b - a for a, b in ranges))
                        spans.append(ranges)
                        items.append(sorted(ids))
                columns = [pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()),
                           pa.array([[{"start": a, "end": b} for a, b in s] for s in spans], pa.list_(_SPAN)),
                           pa.array(items, pa.list_(pa.string())), pa.array([h > 0 for h in n_hit], pa.bool_())]
                yield pa.RecordBatch.from_arrays([*batch.columns[:own], *columns], names=schema.names)

        return search

    for s in range(shards):
        part = pairs if shards == 1 else pairs.where(F.pmod(F.xxhash64("pattern", "item"), F.lit(shards)) == s)
        rows = part.toArrow()
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, rows.schema) as stream:
            stream.write_table(rows)
        shared = spark.sparkContext.broadcast(sink.getvalue().to_pybytes())
        docs = docs.mapInArrow(passing(uuid.uuid4().hex, shared), schema)
        if s < shards - 1:
            docs = write_stage(docs, "decontaminate-pass")
    return docs.toDF(*names, *[f.name for f in _NEW])
