"""Periodic runs of words by maximal pairs (operator 11).

Words are ``[^\\x20\\x09-\\x0D]+``.  A run is a stretch of a text with smallest period q
(words q apart are equal) and at least ``max(min_length, 2 q)`` words that no neighbouring
word extends with that period.  A text's runs are found from its suffix structure:

1. A run of length L and period q is the pair of equal stretches of l = L - q >= q words at
   its start and q words on.  As L >= min_length, l >= g = ceil(min_length / 2), so
   both ends of a pair begin with a g-gram that the text repeats.  Only such places go on;
   grams are told apart by their words (a hash only finds texts' once-only grams).
2. Their suffixes are sorted by doubling (g, 2g, 4g ... words); the ranks of the rounds give
   the common prefix (LCP) of neighbours.
3. A stack walks the LCP-interval tree bottom-up.  A node of value l keeps its places in order,
   each with the class of its left word.  Places i < j of different children and different left
   classes are a maximal pair: l equal words that neither side extends.  Those with
   d = j - i <= l and l + d >= min_length are exactly the runs (i, l + d, d).  Only
   neighbours in the node's order need comparing: between i and j of a run with smallest
   period d, the l words occur nowhere else (two overlapping shifts would give a smaller
   period), and neighbours that qualify have no smaller period for the same reason.
   Small children are dealt into the largest, so a place moves O(log n) times.

Texts are handled in slices inside a narrow map: nothing is shuffled, and a task holds one slice
(1 MB, or one longer text) with one integer per word and round.

Results: null, empty and wordless texts have no runs and an empty ``collapsed``; equal
runs cannot occur; repeated documents each get their row; an empty table gives no rows;
further columns are kept, except those named like a result, which it replaces.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlab.llm.common import Numbering, mix64, slices
from playlab.session import ship_package


def repeated_grams(words: np.ndarray, doc: np.ndarray, end: np.ndarray, g: int):
    """Places whose g words start at another place of the same text too, and their groups' numbers."""
    n = len(words)
    if n < g:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    spread = mix64(words)
    h = mix64(doc[:n - g + 1])
    for i in range(g):
        h = h * np.uint64(0x9E3779B97F4A7C15) + spread[i:n - g + 1 + i]
    h = mix64(h)
    h[np.arange(n - g + 1) + g > end[:n - g + 1]] = 0  # grams that leave their text; not looked at below
    order = np.argsort(h)
    same = h[order][1:] == h[order][:-1]
    again = np.r_[False, same] | np.r_[same, False]
    place = np.sort(order[again])
    place = place[place + g <= end[place]]
    group = doc[place]
    for i in range(g):  # exact: refine by one word after the other
        group = np.unique(group * np.int64(len(words) + 1) + words[place + i], return_inverse=True)[1]
    size = np.bincount(group, minlength=1)
    more = size[group] > 1
    return place[more], group[more]


def packed_grams(words: np.ndarray, end: np.ndarray, g: int) -> list[np.ndarray]:
    """The g words from every place on, as numbers that compare like the words (0: after the text's end)."""
    n = len(words)
    bits = int(words.max() + 1).bit_length()
    per = 63 // bits
    place = np.arange(n + 1)
    stop = np.r_[end, n]
    out = []
    for a in range(0, g, per):
        number = np.zeros(n + 1, np.int64)
        for i in range(a, min(a + per, g)):
            word = np.zeros(n + 1, np.int64)
            word[:n - i] = words[i:] + 1
            word[place + i >= stop] = 0
            number = (number << bits) | word
        out.append(number)
    return out


def suffix_order(place: np.ndarray, group: np.ndarray, words: np.ndarray, end: np.ndarray, g: int):
    """The places such that suffixes with a common prefix of g words or more are next to each other, whatever its
    length, and the ranks of every place by round.

    Round k tells suffixes apart by their first g * 2**k words; a rank is the first slot of
    the suffix's group, or a number of its own for places outside.
    """
    n, slots = len(words), len(place)
    grams = packed_grams(words, end, g)
    order = np.lexsort((place, group))
    order_place, new = place[order], np.r_[True, np.diff(group[order]) != 0]
    rank = np.arange(slots, slots + n + 1, dtype=np.int32)
    active = np.arange(slots)
    ranks, step = [], g
    while True:
        first = active[np.flatnonzero(new)]
        size = np.diff(np.r_[np.flatnonzero(new), len(new)])
        rank = rank.copy()
        rank[order_place[active]] = np.repeat(first, size)
        ranks.append(rank)
        active = active[np.repeat(size > 1, size)]
        if not len(active):
            return order_place, ranks
        p = order_place[active]
        after = np.where(p + step < end[p], p + step, n)
        # the next words first: they order suffixes that part within them, too
        by = np.lexsort((rank[after], *[w[after] for w in reversed(grams)], rank[p]))
        p, after = p[by], after[by]
        order_place[active] = p
        new = np.r_[True, (np.diff(rank[p]) != 0) | (np.diff(rank[after]) != 0)]
        step *= 2


def common_prefixes(order: np.ndarray, ranks: list, words: np.ndarray, end: np.ndarray, g: int) -> np.ndarray:
    """Words that each suffix in order shares with the one before (0: another first gram)."""
    n = len(words)
    i, j = order[:-1], order[1:]
    size = np.zeros(len(i), np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        equal = ranks[k][np.minimum(i + size, n)] == ranks[k][np.minimum(j + size, n)]
        size += equal * (g << k)
    going = size >= g
    last = np.maximum(i, j)
    for _ in range(g - 1):
        going &= last + size < end[last]
        going &= words[np.minimum(i + size, n - 1)] == words[np.minimum(j + size, n - 1)]
        size += going
    return np.r_[0, size]


def _join(children: list[list[int]], size: int, left: list[int], least: int, out: list) -> list[int]:
    """Joins the children of a node of value ``size``; adds the runs of its maximal pairs to ``out``."""
    at = max(range(len(children)), key=lambda c: len(children[c]))
    all_, of = children[at], {}
    for c, places in enumerate(children):
        if c != at:
            for p in places:
                of[p] = c
    if len(of) * 16 < len(all_):
        for p in of:
            insort(all_, p)
    else:
        all_ = sorted([*all_, *of])
    n = len(all_)
    for p, c in of.items():
        k = bisect_left(all_, p)
        if k:
            i = all_[k - 1]
            d = p - i
            if d <= size and size + d >= least and of.get(i, at) != c and left[i] != left[p]:
                out.append((i, size + d, d))
        if k + 1 < n:
            j = all_[k + 1]
            d = j - p
            if d <= size and size + d >= least and j not in of and left[j] != left[p]:
                out.append((p, size + d, d))
    return all_


def find_runs(words: np.ndarray, first: np.ndarray, min_length: int) -> list[tuple[int, int, int]]:
    """(first word, length, period) of every run; texts are words[first[k]:first[k + 1]]."""
    g = max(1, -(-min_length // 2))
    n = len(words)
    lengths = np.diff(first)
    doc = np.repeat(np.arange(len(lengths)), lengths)
    end = np.repeat(first[1:], lengths)
    place, group = repeated_grams(words, doc, end, g)
    if not len(place):
        return []
    order, ranks = suffix_order(place, group, words, end, g)
    shared = common_prefixes(order, ranks, words, end, g)
    starts = np.flatnonzero(shared < g)
    # a group whose places are farther apart than any of its suffixes agree has no run
    slots = np.lexsort((order, ranks[0][order]))
    gap = np.r_[n + 1, np.diff(order[slots])]
    gap[starts] = n + 1
    useful = np.minimum.reduceat(gap, starts) <= np.maximum.reduceat(shared, starts)
    left = np.r_[-1, words[:-1]]
    left[first[:-1][lengths > 0]] = -1
    left, out = left.tolist(), []
    stops = np.r_[starts[1:], len(order)]
    for a, b in zip(starts[useful].tolist(), stops[useful].tolist()):
        stack: list[tuple[int, list]] = []
        places, values = order[a:b].tolist(), shared[a + 1:b].tolist()
        for p, value in zip(places, values + [0]):
            last = [p]
            while stack and stack[-1][0] > value:
                size, children = stack.pop()
                children.append(last)
                last = _join(children, size, left, min_length, out)
            if stack and stack[-1][0] == value:
                stack[-1][1].append(last)
            else:
                stack.append((value, [last]))
    return out


_RUNS = T.ArrayType(T.StructType().add("start", "long").add("length", "long").add("period", "long"))
_NEW = T.StructType().add("runs", _RUNS).add("collapsed", "string").fields
_RUN = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])


def periodic_runs(docs: DataFrame, min_length: int = 12, text: str = "text") -> DataFrame:
    """All columns of ``docs`` with ``runs`` (start, length, period; by start, then period) and ``collapsed``:
    the words left when every run keeps its first period only, joined by one space."""
    ship_package(docs.sparkSession)
    new = {f.name for f in _NEW}
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in new])
    names = docs.columns
    at = names.index(text)
    docs = docs.toDF(*[f"own{i}" for i in range(len(names))])  # a name with a dot can't enter the map below

    def scan(batches):
        for batch in batches:
            texts = batch.column(at).to_pylist()
            runs, kept = [], []
            for i, j in slices([len(t or "") for t in texts]):
                words = [(t or "").encode().split() for t in texts[i:j]]
                first = np.zeros(len(words) + 1, np.int64)
                np.cumsum([len(w) for w in words], out=first[1:])
                number = Numbering()
                ids = np.fromiter((number[w] for ws in words for w in ws), np.int64, first[-1])
                found: dict[int, list] = {}
                for s, length, q in find_runs(ids, first, min_length):
                    doc = int(np.searchsorted(first, s, "right")) - 1
                    found.setdefault(doc, []).append((s - int(first[doc]), length, q))
                for doc, ws in enumerate(words):
                    mine = sorted(found.get(doc, []), key=lambda r: (r[0], r[2]))
                    runs.append([dict(zip(("start", "length", "period"), r)) for r in mine])
                    if mine:
                        edge = np.zeros(len(ws) + 1, np.int64)
                        s, length, q = np.array(mine).T
                        np.add.at(edge, s + q, 1)
                        np.add.at(edge, s + length, -1)
                        ws = [ws[k] for k in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]
                    kept.append(b" ".join(ws).decode())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(runs, pa.list_(_RUN)), pa.array(kept, pa.string())],
                                             names=[*batch.schema.names, "runs", "collapsed"])

    return docs.mapInArrow(scan, T.StructType(docs.schema.fields + list(_NEW))).toDF(*names, *[f.name for f in _NEW])
