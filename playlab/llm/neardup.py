"""Embedding near-duplicates by sorted projection passes (operator 5).

Equal vectors are one class with a count.  Each pass draws random hyperplanes,
gives every class the signs of its projections as one bit string, and orders
the classes lexicographically by it; each is compared with its next ``WINDOW``
neighbours.  Pairs with cosine >= ``threshold`` in double precision are kept, and
all passes' pairs are united by connected components.

One pass puts a pair at the threshold into one window with a probability that falls
with the number of classes around it, and how many there are depends on the data: rows
in one cone share their leading bits.  So the number of passes is measured, at every size
in the same way.  Up to ``PROBES`` sampled classes get a partner made at the threshold, which
is ordered along with the classes but makes no links.  A probe is found once its partner has
met a class of the component of its own class.  The probes are cut into ``STRATA`` by the density
around them, and passes go on until each stratum, the densest too, has found the share
``recall``.  A first round has the passes that evenly spread vectors need.  Passes are
independent, so each adds to every stratum's share; there is no other end and no other way.

Vectors stay where they are.  What a pass sorts is a class's *sketch*, one byte per component with a
bound of its error, from which follow a lower and an upper bound of a cosine.  Where both are on
one side of the threshold the pair is decided; the few others are compared exactly, in double precision,
by a join with the vectors.

A pass is one exchange by range and one sort.  Its tasks slide the window along their
sorted rows and hold ``WINDOW`` rows and one batch.  Rows of one key stand in random order, so
no run of equal keys, however long, lands in one task or is cut at the same places in every pass.  A window does
not reach over the border of a task's range; what that loses is part of the recall measured.
A task sends one link per row (to the smallest id its batch reaches there).
Groups larger than the window are no loss: chains of windows connect them, and
the links of a component's members are counted afterwards block against block,
all of them, within the component.

Edge cases: vectors that are null, empty, zero or hold a null, NaN or infinite
component link with nothing; equal vectors link (each counts the other); vectors of
different length never link; rows that share an id are one node of the graph and
each returned; a null id is returned unlinked with a null component; an empty
table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlab.llm.common import mix64
from playlab.llm.graph import components
from playlab.llm.topk import finite
from playlab.session import ship_package, write_stage

WINDOW = 48
RANGE = 1 << 16  # rows of a pass that one task sorts
BITS = 48
TIES = 15  # random bits below the signs
GROUP = 1024  # members of a component that one task holds of either side
PROBES = 1000
STRATA = 10


def passes_for(n: int, threshold: float, recall: float, window: int = WINDOW) -> int:
    """Passes after which a pair at the threshold has met with probability ``recall``, of evenly spread vectors."""
    agree = 1 - math.acos(threshold) / math.pi
    p = agree ** max(0.0, math.log2(max(n, 1) / window))
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - p))) if p < 1 else 1


def sign_keys(unit: np.ndarray, cls: np.ndarray, number: int, seed: int) -> np.ndarray:
    """Bit strings of one pass as integers whose order is lexicographic, ties in an order of the pass's own."""
    rng = np.random.default_rng([seed, number, unit.shape[1]])
    bits = unit @ rng.standard_normal((unit.shape[1], BITS)) > 0
    signs = bits.astype(np.int64) @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))
    tie = mix64(cls.view(np.uint64) + np.uint64(rng.integers(1 << 62))) >> np.uint64(64 - TIES)
    return (signs << TIES) | tie.astype(np.int64)


def encode(unit: np.ndarray) -> pa.Array:
    """Sketches of unit vectors: scale and error bound in single precision, then a byte per component."""
    n, dim = unit.shape
    scale = (np.abs(unit).max(axis=1) / 127).astype(np.float32)
    cells = np.clip(np.rint(unit / scale[:, None]), -127, 127)
    error = np.linalg.norm(unit - cells * scale[:, None].astype(np.float64), axis=1)
    out = np.empty((n, 8 + dim), np.uint8)
    out[:, :4] = scale[:, None].view(np.uint8)
    out[:, 4:8] = np.nextafter(error.astype(np.float32), np.float32(np.inf))[:, None].view(np.uint8)
    out[:, 8:] = cells.astype(np.int8).view(np.uint8)
    ends = np.arange(n + 1, dtype=np.int32) * (8 + dim)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(out.tobytes())])


def decode(sketches: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Approximate vectors of sketches of one length, and the bounds of their errors."""
    n = len(sketches)
    ends = np.frombuffer(sketches.buffers()[1], np.int32)[sketches.offset:sketches.offset + n + 1]
    raw = np.frombuffer(sketches.buffers()[2], np.uint8)[ends[0]:ends[-1]].reshape(n, -1)
    scale, error = (raw[:, i:i + 4].copy().view(np.float32)[:, 0].astype(np.float64) for i in (0, 4))
    return raw[:, 8:].view(np.int8) * scale[:, None], error


def _units(column) -> np.ndarray:
    m = np.asarray(column.combine_chunks().flatten() if isinstance(column, pa.ChunkedArray)
                   else column.flatten(), np.float64).reshape(len(column), -1)
    m = m / np.abs(m).max(axis=1, keepdims=True)  # keeps squares of extreme numbers finite
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def _roots(n: int, a: np.ndarray, b: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Position of the smallest id that each position reaches by the links (a, b)."""
    root = np.arange(n)
    while len(a):
        low = np.where(ids[root[a]] <= ids[root[b]], root[a], root[b])
        before = root.copy()
        for side in (a, b):
            # the target root takes the smallest id offered
            order = np.argsort(-ids[low], kind="stable")
            better = ids[low[order]] < ids[root[root[side[order]]]]
            root[root[side[order[better]]]] = low[order[better]]
        while not np.array_equal(root, root[root]):
            root = root[root]
        if np.array_equal(root, before):
            break
    return root


def probe_pairs(units: list[np.ndarray], threshold: float, seed: int) -> tuple[list[np.ndarray], np.ndarray]:
    """A partner at the threshold for each unit vector, half at random and half towards a
    near one of the others; and the vectors' strata by the density around them."""
    rng = np.random.default_rng([seed, len(units)])
    partners, density = [], np.zeros(len(units))
    lengths = np.array([len(u) for u in units])
    aim = min(1.0, threshold + 1e-9)
    for i, u in enumerate(units):
        others = np.flatnonzero(lengths == len(u))
        others = others[others != i]
        side = rng.standard_normal(len(u))
        side -= (side @ u) * u
        side /= np.linalg.norm(side) or 1.0
        if len(others):
            cosine = np.stack([units[j] for j in others]) @ u
            near = np.argsort(-cosine)[:max(1, len(others) // 20)]
            density[i] = cosine[near].mean()
            towards = units[others[rng.choice(near)]]
            towards = towards - (towards @ u) * u
            if np.linalg.norm(towards) > 1e-9:
                side += towards / np.linalg.norm(towards)
                side /= np.linalg.norm(side) or 1.0
        partners.append(aim * u + math.sqrt(1 - aim * aim) * side)
    place = np.argsort(np.argsort(density, kind="stable"), kind="stable")
    return partners, place * STRATA // max(1, len(units))


def passes_left(done: int, found: float, recall: float) -> int:
    """Further passes that a stratum needs which found the share ``found`` in ``done`` passes."""
    if found >= recall:
        return 0
    if found <= 0:
        return 3 * done
    need = math.ceil(math.log(1 - recall) / math.log(1 - found) * done)
    return min(3 * done, max(1, need - done))


def _of_one_length(batches, column: str):
    """The batches' rows, apart by the length of a list column."""
    for batch in batches:
        lengths = batch.column(column).value_lengths().to_numpy(zero_copy_only=False)
        for size in np.unique(lengths):
            yield int(size), batch.filter(pa.array(lengths == size))


def _sketched(items: DataFrame) -> DataFrame:
    def sketch(batches):
        for size, part in _of_one_length(batches, "v"):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(part.num_rows, size, np.int32)), part.column("class"), part.column("probe"), encode(_units(part.column("v")))],
                names=["dim", "class", "probe", "sketch"])

    return items.select("class", "probe", "v").mapInArrow(sketch, "dim int, class long, probe int, sketch binary")


def _groups(classes: DataFrame, n: int, threshold: float, recall: float, seed: int) -> DataFrame:
    """(id, component) of the classes that have links."""
    spark = classes.sparkSession
    drawn = classes.where(F.size("v") > 1).orderBy(F.xxhash64("class", F.lit(3)), "class").limit(PROBES).select("class", "v").collect()
    units = [_units(pa.array([r["v"]]))[0] for r in drawn]
    partners, stratum = probe_pairs(units, threshold, seed)
    # a partner that rounding puts below the threshold measures nothing
    usable = [i for i, (u, w) in enumerate(zip(units, partners)) if u @ w / np.linalg.norm(w) >= threshold + 1e-12]
    sources, partners, stratum = [drawn[i]["class"] for i in usable], [partners[i] for i in usable], stratum[usable]
    numbers = np.random.default_rng(seed).integers(-(1 << 63), (1 << 63) - 1, len(sources)).tolist()
    probes = spark.createDataFrame([(c, v.tolist(), i) for i, (c, v) in enumerate(zip(numbers, partners))],
                                   "class long, v array<double>, probe int")
    items = classes.select("class", "v", F.lit(-1).alias("probe")).unionByName(probes)
    sketches = write_stage(_sketched(items), "neardup-sketches")
    of_probe = spark.createDataFrame(list(enumerate(sources)), "probe int, source long")
    found, done, more = None, 0, passes_for(n, threshold, recall)
    while True:
        part = write_stage(_window_links(items, sketches, n + len(sources), range(done, done + more), threshold, seed), "neardup-found")
        found = part if found is None else found.unionByName(part)
        done += more
        group_of = write_stage(components(found.where("probe < 0").select("a", "b").distinct()), "neardup-groups")
        of_class, of_source = (group_of.select(F.col("id").alias(c), F.col("component").alias(f"{c}_group")) for c in ("a", "source"))
        met = (found.where("probe >= 0").select("probe", "a").distinct().join(of_probe, "probe")
               .join(of_class, "a", "left").join(of_source, "source", "left")
               .where(F.coalesce("a_group", "a") == F.coalesce("source_group", "source")).select("probe").distinct().collect())
        hit = np.zeros(len(sources))
        hit[[r.probe for r in met]] = 1
        more = max((passes_left(done, float(hit[stratum == s].mean()), recall) for s in np.unique(stratum)), default=0)
        if not more:
            return group_of


def slide(batches, threshold: float):
    """Pairs (a, b, probe, sure) that a window of ``WINDOW`` further rows shows along sorted sketches."""
    carry = None
    for batch in batches:
        lead = np.stack([batch.column(c).to_numpy() for c in ("dim", "pass")])
        cuts = [0, *(np.flatnonzero((lead[:, 1:] != lead[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for i, j in zip(cuts, cuts[1:]):
            if i == j:
                continue
            rows = (*decode(batch.column("sketch").slice(i, j - i)), *(batch.column(c).to_numpy()[i:j] for c in ("class", "probe")))
            before = 0
            if carry and carry[0] == tuple(lead[:, i]):
                before = len(carry[1][1])
                rows = tuple(np.concatenate(x) for x in zip(carry[1], rows))
            near, error, cls, probe = rows
            pairs = []
            for step in range(1, min(WINDOW, len(cls) - 1) + 1):
                left = np.arange(max(0, before - step), len(cls) - step)  # pairs within the carried rows were seen
                right = left + step
                cosine = np.einsum("ij,ij->i", near[left], near[right])
                slack = error[right] + error[left] * (1 + error[right]) + 1e-9
                some = cosine + slack >= threshold
                pairs.append((left[some], right[some], (cosine - slack >= threshold)[some]))
            carry = tuple(lead[:, i]), tuple(x[-WINDOW:] for x in rows)
            if not pairs:
                continue
            a, b, sure = (np.concatenate(x) for x in zip(*pairs))
            real = (probe[a] < 0) & (probe[b] < 0)
            root = _roots(len(cls), a[real & sure], b[real & sure], cls)
            far = np.flatnonzero(root != np.arange(len(cls)))
            open_ = real & ~sure & (root[a] != root[b])
            partner, other, sure = np.r_[a, b], np.r_[b, a], np.r_[sure, sure]
            shown = (probe[partner] >= 0) & (probe[other] < 0)
            none = np.full(len(far) + int(open_.sum()), -1, np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.r_[cls[far], cls[a[open_]], cls[other[shown]]], pa.int64()),
                 pa.array(np.r_[cls[root[far]], cls[b[open_]], cls[partner[shown]]], pa.int64()),
                 pa.array(np.r_[none, probe[partner[shown]]], pa.int32()),
                 pa.array(np.r_[np.ones(len(far), bool), np.zeros(int(open_.sum()), bool), sure[shown]])],
                names=["a", "b", "probe", "sure"])


def _window_links(items: DataFrame, sketches: DataFrame, n: int, passes: range, threshold: float, seed: int) -> DataFrame:
    """Links (a, b, probe) that the windows of some passes show: of classes with probe -1, or of a
    probe's partner to the class a."""

    def keys(batches):
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                near, cls = decode(part.column("sketch"))[0], part.column("class").to_numpy()
                for p in passes:
                    yield pa.RecordBatch.from_arrays(
                        [part.column("dim"), pa.array(np.full(len(cls), p, np.int32)), pa.array(sign_keys(near, cls, p, seed)),
                         part.column("class"), part.column("probe"), part.column("sketch")],
                        names=["dim", "pass", "key", "class", "probe", "sketch"])

    def verify(batches):
        for _, part in _of_one_length(batches, "va"):
            cosine = np.einsum("ij,ij->i", _units(part.column("va")), _units(part.column("vb")))
            yield part.select(["a", "b", "probe"]).filter(pa.array(cosine >= threshold))

    order = ["dim", "pass", "key", "class", "probe"]
    parts = max(1, math.ceil(n * len(passes) / RANGE))
    shown = write_stage(
        sketches.mapInArrow(keys, "dim int, pass int, key long, class long, probe int, sketch binary")
        .repartitionByRange(parts, *order).sortWithinPartitions(*order)
        .mapInArrow(lambda batches: slide(batches, threshold), "a long, b long, probe int, sure boolean"), "neardup-shown")
    pair = ["a", "b", "probe"]
    exact = (shown.where("not sure").select(*pair).distinct()
             .join(items.where("probe < 0").select(F.col("class").alias("a"), F.col("v").alias("va")), "a")
             .join(items.select(F.col("class").alias("b"), "probe", F.col("v").alias("vb")), ["b", "probe"]))
    return shown.where("sure").select(*pair).unionByName(
        exact.select(*pair, "va", "vb").mapInArrow(verify, "a long, b long, probe int")).distinct()


def near_duplicates(vectors: DataFrame, threshold: float = 0.9, recall: float = 0.95, key: str = "vec_id",
                    vector: str = "embedding", seed: int = 5) -> DataFrame:
    """(key, n_links, component_id, kept) for every row."""
    spark = vectors.sparkSession
    ship_package(spark)
    rows = vectors.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    usable = F.col("id").isNotNull() & finite("v") & F.coalesce(F.exists("v", lambda x: x != 0.0), F.lit(False))
    classes = write_stage(rows.where(usable).distinct().groupBy("v").agg(F.min("id").alias("rep"), F.count("*").alias("n"))
                          .withColumn("class", F.xxhash64("v", F.lit(seed))), "neardup-classes")
    same = rows.where(usable).select("id", "v").distinct().join(classes.select("v", "rep", "class"), "v")
    members = write_stage(same.select("id", "rep", "class"), "neardup-members")
    n = classes.count()
    group_of = _groups(classes, n, threshold, recall, seed)

    # links of every member of a component, counted block against block
    inside = group_of.join(classes, group_of.id == classes["class"]).select("component", "class", "n", "v")
    sized = inside.join(inside.groupBy("component").agg(F.ceil(F.count("*") / GROUP).alias("blocks")), "component")
    sized = write_stage(sized.withColumn("i", F.pmod(F.xxhash64("class", F.lit(1)), "blocks")), "neardup-inside")
    left = sized.withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    right = left.select("component", F.col("j").alias("i"), F.col("i").alias("j"), "class", "n", "v")
    right = right.toDF(*right.columns)
    cell = ["component", "i", "j"]

    def count(a: pa.Table, b: pa.Table) -> pa.Table:
        if not a.num_rows or not b.num_rows:
            return pa.table({"class": pa.array([], pa.int64()), "links": pa.array([], pa.int64())})
        near = _units(a.column("v")) @ _units(b.column("v")).T >= threshold
        near &= a.column("class").to_numpy()[:, None] != b.column("class").to_numpy()[None, :]
        return pa.table({"class": a.column("class"), "links": pa.array(near @ b.column("n").to_numpy(), pa.int64())})

    counted = (left.select(*cell, "class", "v").groupBy(*cell)
               .cogroup(right.select(*cell, "class", "n", "v").groupBy(*cell))
               .applyInArrow(count, "class long, links long").groupBy("class").agg(F.sum("links").alias("links")))

    # components over ids: an id may stand in several classes, a class on several ids
    by_class = (members.join(classes.select("class", F.col("n").alias("copies")), "class")
                .join(group_of.withColumnRenamed("id", "class"), "class", "left")
                .join(counted, "class", "left")
                .select("id", "class", F.coalesce("component", "class").alias("component"),
                        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links")))
    by_class = write_stage(by_class, "neardup-classes-of-ids")
    first = by_class.groupBy("component").agg(F.min("id").alias("first"))
    one_each = by_class.join(first, "component").groupBy("id").agg(
        F.sum("links").alias("links"), F.min("first").alias("first"))
    out = rows.select("id").join(one_each, "id", "left")
    component = F.coalesce("first", "id")
    return out.select(F.col("id").alias(key), F.coalesce("links", F.lit(0)).alias("n_links"),
                      component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
