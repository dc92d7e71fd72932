"""Exact Jaccard join on word shingles with set-relation skipping (operator 8).

Two documents link when their sets of distinct shingles have a Jaccard similarity
of at least ``threshold``.  Equal sets are one class from the start.

Index: linked sets x, y differ in at most H shingles, H from the largest sizes that can
meet.  Shingles are dealt by hash into parts, of which more than H hold some, so one part
that holds some is equal in both; the index has a list per (size class, part, content of
the part).  A set that fills no more than H parts is listed by its empty parts too.  Sets of
neighbouring size classes share an index.  A list entry comes from a whole part, so
frequent shingles alone make no long lists.  Copies in a batch of texts are listed once,
and lists of the same sets once.  Sets of a list stay together only if their parity
bitmaps, which never differ in more bits than the sets do in shingles, leave a link
possible; the components of what remains are the units to compare.

Within a unit, sets are taken by size.  Index lists hold a set's rarest shingles with
their positions, in blocks by position; a block is skipped whole when its
positions leave too few shingles for the threshold, and so are sets already connected
and those whose bitmaps rule a link out, before any list is read.
A set y that is highly similar to a computed set r gets its answers from r's: the
overlap with z is r's overlap, less what r has and y has not of z, plus the
reverse, exact by a few lookups.

Units of more than ``BLOCK`` classes are compared block against block, so no task
holds more than two blocks; copies never enter, as equal sets are one class.

Edge cases: null or empty text, or one without words, has an empty set and links with
nothing; texts with fewer words than a shingle are one shingle, the whole
sequence; repeated rows and rows that share an id are documents of their own; a null
id stays null and counts as smaller than all others; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlab.llm.common import Words, as_long, mix64, ngram_hashes, slices, span_hashes
from playlab.llm.graph import components
from playlab.session import ship_package, write_stage

BLOCK = 2000  # classes of a unit that one task holds of either side
LIST_ROWS = 20_000  # list entries judged by one task
POSITIONS = 8  # positions in a block of an index list
SIMILAR = 0.95  # sets this alike pass on their answers
_LOWEST = -(1 << 63)


def shingle_sets(texts, size: int):
    """Sorted distinct shingle hashes of each text."""
    words = Words(texts, lower=True)
    grams = ngram_hashes(words.hashes, size)
    for a, b in zip(words.first, words.first[1:]):
        if b - a >= size:
            yield np.unique(grams[a:b - size + 1])
        elif b > a:
            yield span_hashes(words.hashes, np.array([a]), np.array([b]))
        else:
            yield np.zeros(0, np.uint64)


def classes_of(sets: list[np.ndarray]) -> np.ndarray:
    """Identity of each set: a hash of its size, sum and mixed sum; 0 for an empty one."""
    n = np.array([len(s) for s in sets], np.int64)
    out, some = np.zeros(len(sets), np.int64), np.flatnonzero(n)
    if len(some):
        s, start = np.concatenate(sets), (np.cumsum(n) - n)[some]
        parts = np.stack([n[some].astype(np.uint64), np.add.reduceat(s, start), np.add.reduceat(mix64(s), start)], axis=1)
        first = 3 * np.arange(len(some))
        out[some] = as_long(span_hashes(parts.ravel(), first, first + 3))
    return out


class SizeClasses:
    """Ranges of set sizes; a set's partners lie in its own range or a neighbouring one."""

    def __init__(self, threshold: Fraction):
        self.t, self.low, self.dealt, self.most = threshold, [1], {}, {}

    def _reach(self, n: int):
        while self.low[-1] <= n:
            self.low.append(math.floor(Fraction(self.low[-1]) / self.t) + 1)

    def of(self, n: np.ndarray) -> np.ndarray:
        self._reach(int(n.max()))
        return np.searchsorted(self.low, n, side="right") - 1

    def differences(self, c: int) -> int:
        """Most shingles in which a set of range c can differ from a linked set no smaller range."""
        if c not in self.most:
            self._reach(self.low[-1])
            largest = self.low[c + 1] - 1
            self.most[c] = math.floor((1 - self.t) / (1 + self.t) * (largest + math.floor(largest / self.t)))
        return self.most[c]

    def parts(self, c: int) -> int:
        """Parts of range c: so many that sets of its smallest size fill more than the differences can touch."""
        if c not in self.dealt:
            need = m = self.differences(c) + 1
            while need > 1:
                empty = math.exp(-self.low[c] / m)
                if m * (1 - empty) - 3 * math.sqrt(m * empty) >= need or m >= 2 * need:
                    break
                m += max(1, m // 50)
            self.dealt[c] = m
        return self.dealt[c]


def signatures(sets: list[np.ndarray], sizes: SizeClasses) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the parts of sets, none empty, each for its own size range and the one below; and whose each is."""
    n = np.array([len(s) for s in sets], np.int64)
    s, own = np.concatenate(sets), sizes.of(n)
    mixed, out, of = mix64(s), [], []
    for c in (own, own - 1):
        ranges, which = np.unique(c, return_inverse=True)
        # a range of one part has none: only equal sets can link, and these are one class
        parts = np.array([sizes.parts(r) if r >= 0 else 1 for r in ranges.tolist()], np.int64)[which]
        few = np.array([sizes.differences(r) if r >= 0 else 0 for r in ranges.tolist()], np.int64)[which]
        base = np.cumsum(parts) - parts
        c = np.maximum(c, 0).astype(np.uint64)
        slot = (mix64(s + np.repeat(c, n)) % np.repeat(parts.astype(np.uint64), n)).astype(np.int64) + np.repeat(base, n)
        counts = np.bincount(slot, minlength=int(parts.sum()))
        sums = np.zeros(len(counts), np.uint64)
        np.add.at(sums, slot, mixed)
        owner = np.repeat(np.arange(len(sets)), parts)
        tag = mix64((c << np.uint64(32))[owner] + (np.arange(len(counts)) - base[owner]).astype(np.uint64))
        listed = (parts > 1)[owner]
        full = np.flatnonzero((counts > 0) & listed)
        out.append(mix64(sums[full] * np.uint64(0x9E3779B97F4A7C15) + tag[full] + counts[full].astype(np.uint64)))
        # the equal part may be one that is empty in both
        few = np.bincount(owner[full], minlength=len(sets)) <= few
        empty = np.flatnonzero((counts == 0) & (listed & few[owner]))
        out.append(mix64(tag[empty]))
        of += [owner[full], owner[empty]]
    return np.concatenate(out), np.concatenate(of)


def parities(sets: list[np.ndarray], widths: np.ndarray) -> np.ndarray:
    """Bitmaps of the sets, so many bits each (powers of two), one after another; each shingle turns one bit over.

    Bitmaps of two sets differ in no more bits than the sets do in shingles.  One of
    half the length is the two halves laid over each other.
    """
    n = np.array([len(s) for s in sets], np.int64)
    mixed = mix64(np.concatenate(sets) + np.uint64(77)) if len(sets) else np.zeros(0, np.uint64)
    bit = (mixed & np.repeat(widths - 1, n).astype(np.uint64)).astype(np.int64) + np.repeat(np.cumsum(widths) - widths, n)
    bits = np.bincount(bit, minlength=int(widths.sum())) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little")


def width_of(n: int) -> int:
    """About two bits a shingle."""
    return max(64, 1 << (2 * n).bit_length()) if n else 64


def bitmaps(sets: list[np.ndarray]) -> list[bytes]:
    widths = np.array([width_of(len(s)) for s in sets], np.int64)
    raw, end = parities(sets, widths).tobytes(), (np.cumsum(widths) // 8).tolist()
    return [raw[i:j] for i, j in zip([0, *end], end)]


def plausible(sizes: np.ndarray, bitmaps: list[bytes], t: Fraction) -> list[int]:
    """Root per set of a list: sets whose bitmaps leave a link possible, directly or in steps, share one."""
    width = min(map(len, bitmaps))
    rows = []
    for raw in bitmaps:
        b = np.frombuffer(raw, np.uint64)
        while len(b) * 8 > width:
            b = b[:len(b) // 2] ^ b[len(b) // 2:]
        rows.append(b)
    rows, n = np.stack(rows), len(sizes)
    root = np.arange(n)
    p, q = t.numerator, t.denominator
    for i in range(n - 1):
        others = np.flatnonzero(root[i + 1:] != root[i]) + i + 1
        if not len(others):
            continue
        m = sizes[others]
        apart = np.bitwise_count(rows[others] ^ rows[i]).sum(axis=1)
        near = ((apart * (q + p) <= (q - p) * (m + sizes[i]))
                & (np.minimum(m, sizes[i]) * q >= np.maximum(m, sizes[i]) * p))
        for r in np.unique(root[others[near]]):
            root[root == r] = root[i]
    return root.tolist()


class Index:
    """Links among sets (or of sets to the sets of another side) by positional lists and passed-on answers."""

    def __init__(self, sets: list[np.ndarray], threshold: Fraction):
        self.t = threshold
        self.sets = sets
        everything, df = np.unique(np.concatenate(sets), return_counts=True) if sets else (np.zeros(0, np.uint64),) * 2
        rank = np.empty(len(everything), np.int64)
        rank[np.lexsort((everything, df))] = np.arange(len(everything))
        self.tokens = [np.sort(rank[np.searchsorted(everything, s)]) for s in sets]  # rarest first
        self.alone = int(np.count_nonzero(df == 1))  # a shingle of one set only needs no list
        self.sizes = np.array([len(s) for s in sets], np.int64)
        width = width_of(int(self.sizes.mean())) if sets else 64
        self.bits = parities(sets, np.full(len(sets), width)).view(np.uint64).reshape(len(sets), width // 64)
        self.lists: dict[int, dict[int, set[int]]] = defaultdict(dict)
        self.listed = np.zeros(len(sets), bool)
        self.root = np.arange(len(sets))
        self.frozen: dict[int, frozenset] = {}
        self.teacher: dict[int, tuple[int, list[int], list[int]]] = {}
        self.overlaps: dict[tuple[int, int], int] = {}

    def _members(self, i: int) -> frozenset:
        if i not in self.frozen:
            if len(self.frozen) > 512:
                self.frozen.clear()
            self.frozen[i] = frozenset(self.tokens[i].tolist())
        return self.frozen[i]

    def overlap(self, x: int, z: int) -> int:
        """Size of the intersection; from a similar set's answer if there is one."""
        if x in self.teacher:
            r, more, less = self.teacher[x]
            if (r, z) in self.overlaps:
                held = self._members(z)
                return self.overlaps[r, z] + sum(t in held for t in more) - sum(t in held for t in less)
        n = len(np.intersect1d(self.tokens[x], self.tokens[z], assume_unique=True))
        self.overlaps[x, z] = n
        return n

    def least(self, n: int, m: int) -> int:
        """Smallest overlap of linked sets of these sizes."""
        return math.ceil(self.t * (n + m) / (1 + self.t))

    def _prefix(self, i: int) -> list[tuple[int, int]]:
        """(position, shingle) of those of which a linked set must hold one."""
        n = len(self.tokens[i])
        prefix = self.tokens[i][:n - math.ceil(self.t * n) + 1]
        first = int(np.searchsorted(prefix, self.alone))
        return list(enumerate(prefix[first:].tolist(), first))

    def _apart(self, x: int, others: np.ndarray) -> np.ndarray:
        return others[self.root[others] != self.root[x]]

    def possible(self, x: int, smallest: int) -> np.ndarray:
        """Listed sets not yet connected with x whose size and bitmap leave a link possible."""
        others = self._apart(x, np.flatnonzero(self.listed & (self.sizes >= smallest)))
        p, q = self.t.numerator, self.t.denominator
        apart = np.bitwise_count(self.bits[others] ^ self.bits[x]).sum(axis=1, dtype=np.int64)
        return others[apart * (q + p) <= (q - p) * (self.sizes[others] + self.sizes[x])]

    def probe(self, x: int):
        n = len(self.tokens[x])
        smallest = math.ceil(self.t * n)
        left = set(self.possible(x, smallest).tolist())
        need, largest = self.least(n, smallest), math.floor(n / self.t)
        for p, token in self._prefix(x):
            if not left:
                return
            for block, entries in self.lists.get(token, {}).items():
                # the most that any entry of the block and x can still share
                if 1 + min(n - p - 1, largest - block * POSITIONS - 1) < need:
                    continue
                for z in left & entries:
                    if z in left:
                        left.discard(z)
                        if self.overlap(x, z) >= self.least(n, len(self.tokens[z])):
                            self._link(x, z)
                            left = set(self._apart(x, np.fromiter(left, np.int64, len(left))).tolist())

    def _link(self, x: int, z: int):
        self.root[self.root == self.root[x]] = self.root[z]
        if x in self.teacher:
            return
        r = self.teacher[z][0] if z in self.teacher else z
        more = np.setdiff1d(self.tokens[x], self.tokens[r], assume_unique=True)
        less = np.setdiff1d(self.tokens[r], self.tokens[x], assume_unique=True)
        if len(more) + len(less) <= (1 - SIMILAR) * len(self.tokens[x]):
            self.teacher[x] = (r, more.tolist(), less.tolist())

    def add(self, i: int):
        for p, token in self._prefix(i):
            self.lists[token].setdefault(p // POSITIONS, set()).add(i)
        self.listed[i] = True

    def run(self, side=None):
        """Link the sets; with ``side`` (0 or 1 per set) only sets of different sides."""
        order = sorted(range(len(self.sets)), key=lambda i: len(self.sets[i]))
        both = [(self.lists, self.listed), (defaultdict(dict), np.zeros(len(self.sets), bool))]
        for i in order:
            self.lists, self.listed = both[1 - side[i] if side else 0]
            self.probe(i)
            self.lists, self.listed = both[side[i] if side else 0]
            self.add(i)
        return self.root.tolist()


def jaccard_groups(docs: DataFrame, threshold: Fraction = Fraction(9, 10), shingle: int = 3, key: str = "doc_id",
                   text: str = "text", one_per_group: bool = False) -> DataFrame:
    """All columns of ``docs`` with ``n_shingles`` and ``component_id``, the smallest key reachable by links.

    ``one_per_group``: only one row of each group, that of the smallest key (of one key's texts
    the one with the smallest hash); a document repeated exactly stays once.
    """
    spark = docs.sparkSession
    ship_package(spark)

    @F.pandas_udf("n long, class long, bits binary")
    def describe(texts):
        import pandas as pd

        n, ids, bits = [], [], []
        values = list(texts)
        for i, j in slices([len(x or "") for x in values]):
            sets = list(shingle_sets(values[i:j], shingle))
            n += map(len, sets)
            ids += classes_of(sets).tolist()
            bits += bitmaps(sets)
        return pd.DataFrame({"n": np.array(n, np.int64), "class": np.array(ids, np.int64), "bits": bits})

    d = F.coalesce(F.col(key).cast("long"), F.lit(_LOWEST))
    text_hash = F.coalesce(F.xxhash64(F.col(text)), F.lit(0))
    described = write_stage(docs.select(d.alias("d"), text_hash.alias("t"), F.col(text).alias("text"))
                            .select("d", "t", describe("text").alias("s")).select("d", "t", "s.*"), "jaccard-sets")

    def sign(batches):
        sizes = SizeClasses(threshold)
        for batch in batches:
            texts, sigs, classes = batch.column(0).to_pylist(), [], []
            for i, j in slices([len(x) for x in texts]):
                if sets := [s for s in shingle_sets(texts[i:j], shingle) if len(s)]:
                    sig, of = signatures(sets, sizes)
                    sigs.append(sig)
                    classes.append(classes_of(sets)[of])
            if sigs:  # copies within the batch send their entries once
                s, c = np.concatenate(sigs), np.concatenate(classes)
                order = np.lexsort((c, s))
                s, c = s[order], c[order]
                new = np.r_[True, (s[1:] != s[:-1]) | (c[1:] != c[:-1])] if len(s) else np.zeros(0, bool)
                yield pa.RecordBatch.from_arrays([pa.array(as_long(s[new])), pa.array(c[new])], names=["sig", "class"])

    def gather(batches):
        """The lists come sorted: those with several classes, equal ones of a task once, as (list, class)."""
        sig, cls = np.zeros(0, np.int64), np.zeros(0, np.int64)
        seen: set[int] = set()

        def whole(sig, cls):
            new = np.r_[True, (sig[1:] != sig[:-1]) | (cls[1:] != cls[:-1])]
            sig, cls = sig[new], cls[new]
            start = np.flatnonzero(np.r_[True, sig[1:] != sig[:-1]])
            size = np.diff(np.r_[start, len(sig)])
            name = as_long(mix64(np.add.reduceat(mix64(cls.view(np.uint64)), start) + size.astype(np.uint64)))
            _, first = np.unique(name, return_index=True)
            first = np.array([f for f in first if size[f] > 1 and int(name[f]) not in seen], np.int64)
            if len(seen) > 1_000_000:
                seen.clear()
            seen.update(name[first].tolist())
            pick = np.repeat(start[first] - np.r_[0, np.cumsum(size[first])[:-1]], size[first]) + np.arange(size[first].sum())
            return pa.RecordBatch.from_arrays([pa.array(np.repeat(name[first], size[first])), pa.array(cls[pick])],
                                              names=["list", "class"])

        for batch in batches:
            sig = np.concatenate([sig, batch.column(0).to_numpy()])
            cls = np.concatenate([cls, batch.column(1).to_numpy()])
            if len(sig):
                cut = int(np.searchsorted(sig, sig[-1]))  # the last list may go on
                if cut:
                    yield whole(sig[:cut], cls[:cut])
                    sig, cls = sig[cut:], cls[cut:]
        if len(sig):
            yield whole(sig, cls)

    def judge(group: pa.Table) -> pa.Table:
        group = group.sort_by([("list", "ascending"), ("class", "ascending")])
        name, cls, n = (group.column(c).to_numpy() for c in ("list", "class", "n"))
        bits, a, b = group.column("bits").to_pylist(), [], []
        cuts = np.r_[np.flatnonzero(np.r_[True, name[1:] != name[:-1]]), len(name)].tolist()
        for i, j in zip(cuts, cuts[1:]):
            for k, r in enumerate(plausible(n[i:j], bits[i:j], threshold)):
                if r != k:
                    a.append(cls[i + k])
                    b.append(cls[i + r])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    lists = (docs.where(F.col(text).isNotNull()).select(F.col(text).alias("text"))
             .mapInArrow(sign, "sig long, class long"))
    dealt = lists.repartition("sig").sortWithinPartitions("sig", "class")
    shared = write_stage(dealt.mapInArrow(gather, "list long, class long").distinct(), "jaccard-lists")
    buckets = max(1, -(-shared.count() // LIST_ROWS))
    one = described.groupBy("class").agg(F.first("n").alias("n"), F.first("bits").alias("bits"))
    together = write_stage(shared.join(one, "class").withColumn("bucket", F.pmod("list", F.lit(buckets)))
                           .groupBy("bucket").applyInArrow(judge, "a long, b long").distinct(), "jaccard-together")
    units = components(together).select(F.col("id").alias("class"), F.col("component").alias("unit"))
    units = write_stage(units, "jaccard-units")

    # one text of every class to compare, as its set
    first = (described.join(units, "class").groupBy("class", "unit").agg(F.min(F.struct("d", "t")).alias("f"))
             .select("class", "unit", F.col("f.d").alias("d"), F.col("f.t").alias("t")))

    def load(batches):
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for i, j in slices([len(x) for x in texts]):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i),
                     pa.array([s.tobytes() for s in shingle_sets(texts[i:j], shingle)], pa.binary())],
                    names=["class", "unit", "shingles"])

    texts = (docs.where(F.col(text).isNotNull()).select(d.alias("d"), text_hash.alias("t"), F.col(text).alias("text"))
             .join(first, ["d", "t"]).dropDuplicates(["class"]).select("class", "unit", "text"))
    sets = write_stage(texts.mapInArrow(load, "class long, unit long, shingles binary"), "jaccard-shingles")
    blocks = sets.groupBy("unit").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    i, all_blocks = F.col("i"), F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    cells = (sets.join(blocks, "unit").withColumn("i", F.pmod(F.xxhash64("class"), "blocks"))
             .withColumn("j", F.explode(all_blocks))
             .select("unit", F.least(i, "j").alias("lo"), F.greatest(i, "j").alias("hi"), "i", "class", "shingles"))

    def link(group: pa.Table) -> pa.Table:
        ids = group.column("class").to_numpy()
        sets_ = [np.frombuffer(x, np.uint64) for x in group.column("shingles").to_pylist()]
        lo, hi = group.column("lo")[0].as_py(), group.column("hi")[0].as_py()
        side = None if lo == hi else [int(b == hi) for b in group.column("i").to_pylist()]
        root = Index(sets_, threshold).run(side)
        far = [k for k, r in enumerate(root) if r != k]
        return pa.table({"a": pa.array(ids[far], pa.int64()), "b": pa.array(ids[[root[k] for k in far]], pa.int64())})

    links = write_stage(cells.groupBy("unit", "lo", "hi").applyInArrow(link, "a long, b long"), "jaccard-links")
    group_of = components(links).select(F.col("id").alias("class"), "component")
    # an empty set is a group of its own per row
    grouped = write_stage(described.join(write_stage(group_of, "jaccard-components"), "class", "left").select(
        "d", "t", "n", F.when(F.col("n") > 0, F.coalesce("component", "class")).alias("g")), "jaccard-grouped")
    smallest = write_stage(grouped.where("g is not null").groupBy("g").agg(F.min(F.struct("d", "t")).alias("least")),
                           "jaccard-least")
    is_least = (F.col("d") == F.col("least.d")) & (F.col("t") == F.col("least.t"))
    answer = write_stage(grouped.join(smallest, "g", "left")
                         .select("d", "t", "n", F.coalesce("least.d", "d").alias("c"),
                                 F.coalesce(is_least, F.lit(True)).alias("kept")), "jaccard-groups").dropDuplicates(["d", "t"])
    names = [c for c in docs.columns if c not in ("n_shingles", "component_id")]
    joined = (docs.select(*[F.col(f"`{c}`") for c in names], d.alias("__d"), text_hash.alias("__t"))
              .join(answer.select(F.col("d").alias("__d"), F.col("t").alias("__t"), F.col("n").alias("n_shingles"),
                                  F.col("c").alias("__c"), F.col("kept").alias("__kept")), ["__d", "__t"], "left"))
    if one_per_group:
        joined = joined.where("__kept").dropDuplicates(["__d", "__t"])
    return joined.select(*[F.col(f"`{c}`") for c in names], "n_shingles",
                         F.when(F.col("__c") != _LOWEST, F.col("__c")).alias("component_id"))
