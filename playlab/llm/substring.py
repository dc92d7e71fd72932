"""Substring deduplication with suffix automata of reference shards (operator 3).

A word goes if it lies in a window of ``window`` consecutive words that also starts
earlier: in a document before (by doc_id), or earlier in the same one.  Windows are
judged on the input.

An automaton of the whole corpus cannot be broadcast, and every document against
every shard's automaton would be quadratic.  So passages are routed to the one
shard that can hold their like:

1. Every window has an anchor, its ``GRAM`` consecutive words of smallest hash;
   equal windows have equal anchors.  The consecutive windows of a text with one anchor
   are a segment.  Anchors found once in the corpus cannot repeat a window and go.
2. Segments of equal content are one class.  All but the first of a class repeat
   it whole.  An anchor with a single class is decided by that.
3. The first segments of anchors with several classes (their texts differ around
   the anchor) go, with their words, to the anchor's shard.  There a suffix
   automaton grows over the segments in corpus order; each segment streams through the
   automaton of those before it, and where its matching statistics reach the
   window's length, the maximal span is removed.
4. An anchor with more than ``BLOCK`` classes is dealt over several shards; windows
   that survive in a shard are then compared across its shards by their hashes.

So the number of copies of a passage never gathers in one task, only up to
``BLOCK`` different contexts of an anchor do.  Removed spans return by document.

Edge cases: null text has no words; texts shorter than a window lose nothing;
a null doc_id is before all others; different texts under one doc_id are
documents of their own, in the order of their texts' hashes; exactly repeated rows are
one document and get the same result; an empty table gives no rows; further
columns are kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlab.llm.common import Words, as_long, ngram_hashes, slices, span_hashes, text_key
from playlab.session import ship_package, write_stage

GRAM = 6
BLOCK = 4000
_LOWEST = -(1 << 63)


class SuffixAutomaton:
    """Automaton of all factors of the sequences added so far (states as parallel lists)."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length = [-1], [0]

    def _state(self, length: int, step: dict, link: int) -> int:
        self.next.append(step)
        self.length.append(length)
        self.link.append(link)
        return len(self.length) - 1

    def _split(self, p: int, symbol, q: int) -> int:
        """State for the longest factor that ends p's with symbol: q, or a copy of q that is as short."""
        if self.length[q] == self.length[p] + 1:
            return q
        copy = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(symbol) == q:
            self.next[p][symbol] = copy
            p = self.link[p]
        return copy

    def add(self, sequence):
        last = 0
        for symbol in sequence:
            q = self.next[last].get(symbol)
            if q is not None:
                last = self._split(last, symbol, q)
                continue
            state = self._state(self.length[last] + 1, {}, 0)
            p = last
            while p >= 0 and symbol not in self.next[p]:
                self.next[p][symbol] = state
                p = self.link[p]
            if p >= 0:
                self.link[state] = self._split(p, symbol, self.next[p][symbol])
            last = state

    def matching(self, sequence) -> list[int]:
        """At each place, how many symbols up to it are a factor of what was added."""
        out, state, size = [], 0, 0
        for symbol in sequence:
            while state and symbol not in self.next[state]:
                state = self.link[state]
                size = self.length[state]
            if symbol in self.next[state]:
                state = self.next[state][symbol]
                size += 1
            else:
                size = 0
            out.append(size)
        return out


def leftmost_minimum(h: np.ndarray, width: int) -> np.ndarray:
    """Index of the smallest value (the first of equals) in every run of ``width`` values."""
    at, size = np.arange(len(h)), 1
    while size * 2 <= width:
        left, right = at[:-size], at[size:]
        at = np.where(h[left] <= h[right], left, right)
        size *= 2
    rest = width - size
    if rest:
        left, right = at[:len(at) - rest], at[rest:]
        at = np.where(h[left] <= h[right], left, right)
    return at


def segments(words: Words, window: int):
    """(document, first window, windows, anchor hash, content hash) of every segment of some texts."""
    n = len(words.hashes)
    doc_of = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    gram = min(GRAM, window)
    none = np.zeros(0, np.int64)
    if n < window:
        return none, none, none, none, none
    h = ngram_hashes(words.hashes, gram)
    at = leftmost_minimum(h, window - gram + 1)
    start = np.flatnonzero(doc_of[:len(at)] == doc_of[window - 1:])
    if not len(start):
        return none, none, none, none, none
    at = at[start]
    new = np.flatnonzero(np.r_[True, (np.diff(at) != 0) | (np.diff(start) != 1)])
    size = np.diff(np.r_[new, len(start)])
    most = 15  # windows that a segment's position can count; longer ones continue as another
    if len(size) and size.max() > most:
        parts = -(-size // most)
        new = np.concatenate([np.arange(a, a + s, most) for a, s in zip(new, size)])
        size = np.minimum(most, np.repeat(size, parts) - (new - np.repeat(new[np.r_[0, np.cumsum(parts)[:-1]]], parts)))
    first = start[new]
    content = span_hashes(words.hashes, first, first + size + window - 1)
    doc = doc_of[first]
    return doc, first - words.first[doc], size, as_long(h[at[new]]), as_long(content)


def _place(first, size):
    return (first << 4) | size


def _not_first():
    return ~F.struct("d", "t", "p").eqNullSafe(F.col("first"))


def deduplicate(docs: DataFrame, window: int = 20, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of ``docs`` with ``n_words``, ``n_removed`` and ``kept`` (kept words joined by one space)."""
    spark = docs.sparkSession
    ship_package(spark)
    text_hash = text_key(text)
    d = F.coalesce(F.col(key).cast("long"), F.lit(_LOWEST))
    rows = docs.where(F.col(text).isNotNull()).select(d.alias("d"), text_hash.alias("t"), F.col(text).alias("text"))

    def anchor(batches):
        for batch in batches:
            ds, ts = (batch.column(i).to_numpy() for i in range(2))
            texts = batch.column(2).to_pylist()
            for i, j in slices([len(x) for x in texts]):
                doc, first, size, anchors, content = segments(Words(texts[i:j]), window)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchors), pa.array(content), pa.array(ds[i:j][doc]), pa.array(ts[i:j][doc]),
                     pa.array(_place(first, size))], names=["anchor", "content", "d", "t", "p"])

    found = rows.mapInArrow(anchor, "anchor long, content long, d long, t long, p long")
    # a stage of its own: the join below then has plain sides, whose hot anchors Spark can split
    repeated = write_stage(found.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"),
                           "substring-anchors")
    again = write_stage(found.join(repeated, "anchor"), "substring-repeated")
    classes = write_stage(again.groupBy("anchor", "content").agg(F.min(F.struct("d", "t", "p")).alias("first")),
                          "substring-classes")
    several = write_stage(classes.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1"), "substring-several")

    # copies of a class: all their windows go
    copies = (again.join(classes, ["anchor", "content"]).where(_not_first())
              .select("d", "t", "p"))

    # first segments around an anchor that has several: to the automata, with their words
    wanted = (classes.join(several, "anchor")
              .withColumn("blocks", F.ceil(F.col("n") / BLOCK))
              .select(F.col("first.d").alias("d"), F.col("first.t").alias("t"),
                      F.struct("anchor", F.col("first.p").alias("p"),
                               F.pmod(F.xxhash64("content"), "blocks").alias("block"), "blocks").alias("s"))
              .groupBy("d", "t").agg(F.collect_list("s").alias("wanted")))

    def cut(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                d_, t_, x, want = (batch.column(i)[r].as_py() for i in range(4))
                words = Words([x])
                out = []
                for s in want:
                    first, size = s["p"] >> 4, s["p"] & 15
                    a, b = words.starts[first], words.ends[first + size + window - 2]
                    out.append((s["anchor"], s["block"], s["blocks"], d_, t_, s["p"], b" ".join(words.data[a:b].split())))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out), [pa.int64()] * 6 + [pa.binary()])],
                    names=["anchor", "block", "blocks", "d", "t", "p", "words"])

    passages = write_stage(
        rows.dropDuplicates(["d", "t"]).join(wanted, ["d", "t"]).select("d", "t", "text", "wanted")
        .mapInArrow(cut, "anchor long, block long, blocks long, d long, t long, p long, words binary"), "substring-passages")
    shards = max(1, -(-passages.count() // BLOCK))

    def match(group: pa.Table) -> pa.Table:
        group = group.sort_by([(c, "ascending") for c in ("d", "t", "p")])
        automaton, number, out = SuffixAutomaton(), {}, []
        for blocks_, d_, t_, p, raw in zip(*(group.column(c).to_pylist() for c in ("blocks", "d", "t", "p", "words"))):
            words = raw.split(b" ")
            seq = [number.setdefault(w, len(number)) for w in words]
            first, size = p >> 4, p & 15
            reach = automaton.matching(seq)[window - 1:]
            gone = [i for i in range(size) if reach[i] >= window]
            runs = np.split(gone, np.flatnonzero(np.diff(gone) != 1) + 1) if gone else []
            out += [(d_, t_, _place(first + int(run[0]), len(run)), None) for run in runs]
            if blocks_ > 1:
                h = as_long(ngram_hashes(Words([raw.decode()]).hashes, window))
                out += [(d_, t_, _place(first + i, 1), int(h[i]))
                        for i in range(size) if reach[i] < window]
            automaton.add(seq)
        cols = list(zip(*out)) if out else [[], [], [], []]
        return pa.table({c: pa.array(v, pa.int64()) for c, v in zip(("d", "t", "p", "hash"), cols)})

    shard = F.pmod(F.xxhash64("anchor", "block"), F.lit(shards))
    matched = write_stage(passages.withColumn("shard", shard).groupBy("shard")
                          .applyInArrow(match, "d long, t long, p long, hash long"), "substring-matched")
    alive = matched.where("hash is not null")
    earliest = alive.groupBy("hash").agg(F.min(F.struct("d", "t", "p")).alias("first"))
    across = (alive.join(earliest, "hash").where(_not_first())
              .select("d", "t", "p"))

    spans = (copies.unionByName(matched.where("hash is null").select("d", "t", "p")).unionByName(across)
             .groupBy("d", "t").agg(F.collect_set("p").alias("spans")))
    spans = write_stage(spans, "substring-spans")

    @F.pandas_udf("n_words long, n_removed long, kept string")
    def keep(texts, spans_):
        import pandas as pd

        out = []
        for x, places in zip(texts, spans_):
            if x is None:
                out.append((0, 0, ""))
                continue
            words = x.encode().split()
            if places is None or not len(places):
                out.append((len(words), 0, b" ".join(words).decode()))
                continue
            p = np.asarray(places, np.int64)
            first, size = p >> 4, p & 15
            edge = np.zeros(len(words) + 1, np.int64)
            np.add.at(edge, first, 1)
            np.add.at(edge, first + size + window - 1, -1)
            gone = np.cumsum(edge[:-1]) > 0
            out.append((len(words), int(gone.sum()), b" ".join(w for w, g in zip(words, gone) if not g).decode()))
        return pd.DataFrame(out, columns=["n_words", "n_removed", "kept"])

    keep = keep.asNondeterministic()  # run once, also where its results are filtered
    new = ("n_words", "n_removed", "kept")
    names = [c for c in docs.columns if c not in new]
    joined = (docs.select(*[F.col(f"`{c}`") for c in names], d.alias("__d"), text_hash.alias("__t"))
              .join(spans.select(F.col("d").alias("__d"), F.col("t").alias("__t"), F.col("spans").alias("__spans")),
                    ["__d", "__t"], "left")
              .withColumn("__k", keep(F.col(text), F.col("__spans"))))
    return joined.select(*[F.col(f"`{c}`") for c in names], *[F.col(f"__k.{c}").alias(c) for c in new])
