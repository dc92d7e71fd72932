"""SMOTE-NC oversampling and class balancing.

Chawla et al., "SMOTE: Synthetic Minority Over-sampling Technique", JAIR 16
(2002), section 6.1 (SMOTE-NC).  Every class but the largest is raised to the
largest class's count with synthetic rows:

1. class c has n_c rows; target T = max n_c; g_c = T - n_c new rows.
2. distance^2 = sum of squared numeric differences + m_c^2 * (number of
   differing categories), m_c = median over numeric columns of the
   within-class population standard deviation.
3. k' = min(k, n_c - 1) nearest neighbours of a row in its class by
   (distance^2 rounded to 6 decimals, key), the row itself excluded.
4. every row makes q_c = g_c // n_c synthetic rows, and the r_c = g_c % n_c
   rows with the smallest hash(key, 'base') one more.  Synthetic row t of a
   base row takes neighbour number 1 + hash(key, t, 'nbr') % k' and gap
   u = hash(key, t, 'gap') / 2**32: numeric = base + u * (neighbour - base);
   each categorical = the most frequent value among the k' neighbours (ties
   to the smallest).  A class of one row is copied.

Synthetic rows keep the base row's key and get ``synth`` = t + 1 (0 for
original rows), so (key, synth) identifies every output row.

Exact k-nearest neighbours without all pairs of a class
--------------------------------------------------------
The distance is Euclidean in an embedding (each category a one-hot block
scaled by m_c / sqrt 2), so the triangle inequality holds.  Following the
pivot partitioning of Lu, Shen, Chen and Ooi, "Efficient Processing of k
Nearest Neighbor Joins using MapReduce", PVLDB 5(10), 2012:

* each class picks P_c = ceil(n_c / cell_rows) pivot rows by key hash, within
  a global budget of ``max_pivots`` (and of MAX_PIVOT_BYTES) shared in
  proportion to class size; the pivot table is therefore bounded, and it
  reaches the tasks once per executor as a broadcast;
* the pivots form a tree of two levels: about sqrt(P_c) of them head groups,
  and every pivot belongs to the group of its nearest head.  A row goes to the
  nearest head's group and there to the cell of its nearest pivot, so it is
  compared with about 2 sqrt(P_c) pivots (``assign``);
* a cell above ``BLOCK_CELLS * cell_rows`` rows is dealt into blocks by key hash;
* rows travel as a vector-approximation file (Weber, Schek and Blott, "A Quantitative Analysis and Performance
  Study for Similarity-Search Methods in High-Dimensional Spaces", VLDB 1998): two bytes per numeric
  column (``Quantiser``: one of 256 cells of equal depth, then one of 256 equal parts of the cell)
  and the length of the error that this makes.  The approximate distance, less and plus that
  error, gives lower and upper bounds of the exact one; categories stay as they are;
* ``near``: each query scans the approximations of its own block.  The k'-th smallest upper bound
  bounds the query's search: it visits only the cells that can hold
  a row within that bound.  A group or cell j is skipped when the ball
  around its pivot is too far, d(q, p_j) - R_j > bound, when the plane between
  p_j and the pivot p_i nearest to the query is, (d(q, p_j)^2 - d(q, p_i)^2) / (2 |p_i p_j|) > bound
  (rows of cell j are on p_j's side), or when the box of its rows' numeric columns is;
* ``far``: the queries travel to the blocks they visit (rows stay in theirs), at
  most about ``VISIT_CELLS * cell_rows`` of them per task, and scan the approximations there;
* rows whose lower bound is within the k'-th upper bound of all visited blocks survive.  Only their values
  are fetched, once, by key, and only for them is the exact distance computed.

No candidate is ever dropped: the bounds only skip rows that provably cannot
be neighbours, so the result equals brute force.  No task holds more than one
block and its share of visitors.  How many cells a query visits depends on the
data's intrinsic dimension; the rows compared exactly do not grow (README, measured).

Contract: ``key`` is unique among the input rows; a key that two query rows share is
an error.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlab.functions.columns import KEY, LABEL
from playlab.functions.hashing import uniform_hash, unit_hash
from playlab.operators.sampling import mark_smallest
from playlab.session import materialize, ship_package

MAX_PIVOTS = 262_144    # over all classes; bounds what is broadcast to the tasks
MAX_PIVOT_BYTES = 256 << 20
CELL_ROWS = 1000        # rows per cell aimed for
BLOCK_CELLS = 4         # a block holds at most about so many times ``cell_rows`` rows
VISIT_CELLS = 8         # visitors per task, likewise
_BLOCK_ENTRIES = 4_000_000  # distance entries per numpy block (about 32 MB)
SLACK = 1e-3               # covers the rounding of distance^2 that orders neighbours
QUANTILES = 255            # cuts per numeric column
ROUNDING = 2e-6            # distance^2 is rounded to 6 decimals before it orders neighbours


def class_stats(df: DataFrame, label: str, numeric, categorical=()) -> dict:
    """{class: (n_c, m_c)} from one aggregate (C rows reach the driver).

    The same pass counts NaN/NULL inputs, which SMOTE-NC cannot use.
    """
    missing = [F.col(c).isNull() for c in list(numeric) + list(categorical)] + [F.isnan(c) for c in numeric]
    bad = F.greatest(*[m.cast("int") for m in missing], F.lit(0)) > 0
    aggs = [F.count(F.lit(1)).alias("_n"), F.count_if(bad).alias("_bad")]
    aggs += [F.stddev_pop(c).alias(f"_s{i}") for i, c in enumerate(numeric)]
    out = {}
    for r in df.groupBy(label).agg(*aggs).collect():
        if r["_bad"]:
            raise ValueError("SMOTE-NC needs inputs without NaN or NULL: impute first")
        sds = [r[f"_s{i}"] for i in range(len(numeric))]
        sds = [s for s in sds if s is not None and not math.isnan(s)]
        out[r[label]] = (int(r["_n"]), float(np.median(sds)) if sds else 0.0)
    return out


def _dist2(xn, xc, pn, pc, m2):
    """Squared distances between rows and reference rows (numeric parts xn/pn,
    categorical parts as integer codes xc/pc; a differing code adds m2)."""
    d = np.zeros((xn.shape[0], pn.shape[0]))
    for j in range(xn.shape[1]):
        diff = xn[:, j:j + 1] - pn[None, :, j]
        d += diff * diff
    for j in range(xc.shape[1]):
        d += m2 * (xc[:, j:j + 1] != pc[None, :, j])
    return d


def _block_rows(width: int) -> int:
    """Rows per numpy block so a block's distance matrix stays near 32 MB."""
    return max(1, _BLOCK_ENTRIES // max(1, width))


def _dist(xn, xc, pn, pc, m2):
    return np.sqrt(_dist2(xn, xc, pn, pc, m2))


def _codes(frame: pd.DataFrame, categorical, vocab) -> np.ndarray:
    """Codes of the rows' categories in the vocabularies (-1: not there)."""
    if not categorical:
        return np.zeros((len(frame), 0), dtype=np.int64)
    return np.stack([v.get_indexer(frame[x].astype(object)) for x, v in zip(categorical, vocab)], axis=1)


def _vocab(frame: pd.DataFrame, categorical) -> list:
    return [pd.Index(pd.unique(frame[x].astype(object))) for x in categorical]


class _ClassPivots:
    """One class's pivots as a tree of two levels: heads, and per head its group of cells."""

    def __init__(self, rows: pd.DataFrame, numeric, categorical, key, m, least: int):
        rows = rows.sort_values(key, kind="stable")
        rows = rows.iloc[np.random.default_rng(0).permutation(len(rows))]  # heads whatever the keys' order
        self.numeric, self.categorical, self.m2 = numeric, categorical, m * m
        self.vocab = _vocab(rows, categorical)
        pn, pc = self.parts(rows)
        n = len(rows)
        heads = max(1, min(math.isqrt(n - 1) + 1, n // max(1, least)))
        self.hn, self.hc = pn[:heads], pc[:heads]
        step = _block_rows(heads)
        group = np.concatenate([_dist(pn[s:s + step], pc[s:s + step], self.hn, self.hc, self.m2).argmin(axis=1)
                                for s in range(0, n, step)])
        order = np.argsort(group, kind="stable")
        self.pn, self.pc = pn[order], pc[order]
        self.first = np.searchsorted(group[order], np.arange(heads + 1))  # group j: cells first[j] .. first[j + 1]
        self.rows_at_once = _block_rows(max(heads, int(np.diff(self.first).max())))

    def parts(self, frame: pd.DataFrame):
        return (frame[self.numeric].to_numpy(float).reshape(len(frame), len(self.numeric)),
                _codes(frame, self.categorical, self.vocab))

    def _cells(self, j: int):
        cells = slice(self.first[j], self.first[j + 1])
        return self.pn[cells], self.pc[cells]

    def nearest(self, xn, xc):
        """(cell, distance to its pivot, distance to its head, pivots compared) of each row."""
        head = _dist(xn, xc, self.hn, self.hc, self.m2)
        group = head.argmin(axis=1)
        cell, dist = np.zeros(len(xn), np.int64), np.zeros(len(xn))
        for j in np.unique(group):
            at = np.flatnonzero(group == j)
            d = _dist(xn[at], xc[at], *self._cells(j), self.m2)
            i = d.argmin(axis=1)
            cell[at], dist[at] = self.first[j] + i, d[np.arange(len(at)), i]
        return cell, dist, head[np.arange(len(xn)), group], len(self.hn) + np.diff(self.first)[group]

    def _may_hold(self, d, pn, pc, radius, bound):
        """Which pivots' rows can lie within the bound of each query, given its distances ``d``."""
        at = d.argmin(axis=1)
        own, inv = np.unique(at, return_inverse=True)
        gap = 2 * _dist(pn[own], pc[own], pn, pc, self.m2)[inv]
        d2 = d * d
        past = d2 * (1 - 1e-12) - d2[np.arange(len(d)), at][:, None]
        plane = np.divide(past, gap, out=np.zeros_like(d), where=gap > 0)
        return np.maximum(d - radius[None, :], plane) <= bound[:, None]

    def visits(self, xn, xc, bound, stats, need: int):
        """(query, cell) pairs: the cells that can hold a row within the query's bound.

        Without a bound (infinite), the balls of the nearest groups with ``need`` rows in all give one.
        """
        head = _dist(xn, xc, self.hn, self.hc, self.m2)
        open_ = np.flatnonzero(np.isinf(bound))
        if len(open_):
            far = head[open_] + np.where(stats.head_rows > 0, stats.head_radius, np.inf)[None, :]
            order = np.argsort(far, axis=1, kind="stable")
            held = np.cumsum(stats.head_rows[order], axis=1) >= need
            pick = order[np.arange(len(open_)), held.argmax(axis=1)]
            bound = bound.copy()
            bound[open_] = far[np.arange(len(open_)), pick] + SLACK
        groups = self._may_hold(head, self.hn, self.hc, stats.head_radius, bound)
        rows, cells = [], []
        for j in np.flatnonzero(groups.any(axis=0)):
            at = np.flatnonzero(groups[:, j])
            lo, hi = self.first[j], self.first[j + 1]
            d = _dist(xn[at], xc[at], *self._cells(j), self.m2)
            may = self._may_hold(d, *self._cells(j), stats.radius[lo:hi], bound[at])
            may &= stats.box_distance(xn[at], lo, hi) <= bound[at][:, None]
            r, c = np.nonzero(may)
            rows.append(at[r])
            cells.append(lo + c)
        if not rows:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(rows), np.concatenate(cells)


class _CellStats:
    """Per cell its rows' largest distance to the pivot and its blocks; per group the same for the head."""

    def __init__(self, pivots: _ClassPivots, cells: pd.DataFrame):
        n = len(pivots.pn)
        self.radius, self.blocks = np.full(n, -np.inf), np.zeros(n, np.int64)
        at = cells["_cell"].to_numpy(int)
        self.radius[at], self.blocks[at] = cells["_r"].to_numpy(float), cells["_b"].to_numpy(int)
        group = np.searchsorted(pivots.first, at, side="right") - 1
        heads = len(pivots.hn)
        self.head_radius, self.head_rows = np.full(heads, -np.inf), np.zeros(heads, np.int64)
        np.maximum.at(self.head_radius, group, cells["_hr"].to_numpy(float))
        np.add.at(self.head_rows, group, cells["_n"].to_numpy(int))
        self.least, self.largest = (np.zeros((n, pivots.pn.shape[1])) for _ in range(2))
        for j in range(pivots.pn.shape[1]):
            self.least[at, j], self.largest[at, j] = cells[f"_lo{j}"].to_numpy(float), cells[f"_hi{j}"].to_numpy(float)

    def box_distance(self, xn, lo: int, hi: int) -> np.ndarray:
        """Distance of each query to the box of the numeric columns of cells lo .. hi."""
        d = np.zeros((len(xn), hi - lo))
        for j in range(xn.shape[1]):
            gap = np.maximum(self.least[None, lo:hi, j] - xn[:, j:j + 1], xn[:, j:j + 1] - self.largest[None, lo:hi, j])
            d += np.maximum(gap, 0) ** 2
        return np.sqrt(d)


class Quantiser:
    """Two bytes per numeric column: a cell between cuts (of about equal depth), and a 256th part of the cell."""

    def __init__(self, edges: list[list[float]]):
        """``edges``: per column its least value, cuts in order, its largest value."""
        self.edges = [np.unique(np.asarray(e, float)) for e in edges]

    def _decode(self, j: int, code: np.ndarray) -> np.ndarray:
        e = self.edges[j]
        if len(e) < 2:
            return np.full(len(code), e[0] if len(e) else 0.0)
        lo, hi = e[code >> 8], e[(code >> 8) + 1]
        return lo + (hi - lo) * (((code & 255) + 0.5) / 256)

    def encode(self, x: np.ndarray):
        """(codes, error): uint16 per column, and an upper bound of the distance to the decoded row."""
        codes, error = np.zeros(x.shape, np.uint16), np.zeros(len(x))
        for j, e in enumerate(self.edges):
            if len(e) > 1:
                cell = np.clip(np.searchsorted(e, x[:, j], side="right") - 1, 0, len(e) - 2)
                part = np.floor((x[:, j] - e[cell]) / (e[cell + 1] - e[cell]) * 256)
                codes[:, j] = (cell << 8) | np.clip(part, 0, 255).astype(np.int64)
            error += (x[:, j] - self._decode(j, codes[:, j].astype(np.int64))) ** 2
        return codes, np.sqrt(error) * (1 + 1e-9)

    def decode(self, codes: np.ndarray) -> np.ndarray:
        return np.stack([self._decode(j, codes[:, j].astype(np.int64)) for j in range(codes.shape[1])], axis=1) \
            if codes.shape[1] else np.zeros(codes.shape)


def quantiser(df: DataFrame, numeric) -> Quantiser:
    """Cuts of the numeric columns from one aggregate (257 numbers per column reach the driver)."""
    shares = [(i + 1) / (QUANTILES + 1) for i in range(QUANTILES)]
    aggs = [F.concat(F.array(F.min(F.col(c).cast("double"))), F.percentile_approx(F.col(c).cast("double"), shares, 10_000),
                     F.array(F.max(F.col(c).cast("double")))) for c in numeric]
    return Quantiser(list(df.agg(*aggs).first())) if numeric else Quantiser([])


def _survivors(qn, qc, qk, cn, cc, ck, error, k: int, m2: float, bound=None):
    """(query, candidate, lower, upper): the candidates that can be among each query's k nearest.

    ``cn`` are decoded approximations, ``error`` their errors.  Bounds are of the squared distance.  Candidates
    whose lower bound passes the k-th smallest upper bound (or the query's ``bound``) cannot; the
    query itself is excluded.
    """
    out = []
    step = _block_rows(len(cn))
    for s in range(0, len(qn), step):
        q = slice(s, s + step)
        flat = np.sqrt(_dist2(qn[q], qc[q][:, :0], cn, cc[:, :0], m2))
        differ = _dist2(qn[q][:, :0], qc[q], cn[:, :0], cc, m2)
        upper = (flat + error[None, :]) ** 2 + differ
        lower = np.maximum(flat - error[None, :], 0) ** 2 + differ
        own = qk[q, None] == ck[None, :]
        upper[own] = lower[own] = np.inf
        most = np.full(len(upper), np.inf) if bound is None else bound[q].astype(float)
        if 0 < k <= upper.shape[1]:
            most = np.minimum(most, np.partition(upper, k - 1, axis=1)[:, k - 1])
        r, c = np.nonzero((lower <= (most * (1 + 1e-9) + ROUNDING)[:, None]) & ~own)
        out.append((s + r, c, lower[r, c], upper[r, c]))
    if not out:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, float, float))
    return tuple(np.concatenate(x) for x in zip(*out))


def _modes(values: np.ndarray) -> list:
    """Per row, the most frequent value; ties go to the smallest value."""
    codes, uniq = pd.factorize(values.ravel(), sort=True)
    srt = np.sort(codes.reshape(values.shape), axis=1)
    same = (srt[:, :, None] == srt[:, None, :]).sum(axis=2)
    best = srt[np.arange(len(srt)), same.argmax(axis=1)]  # first maximum = smallest value
    return np.asarray(uniq, dtype=object)[best].tolist()


def _pick_pivots(df, label, key, counts, seed, cell_rows, max_pivots, columns) -> pd.DataFrame:
    """Pivot rows per class: the P_c rows with the smallest hash(key, 'pivot').

    P_c = ceil(n_c / cell_rows), but all classes together stay within
    ``max_pivots`` (shared in proportion to class size, at least one each).
    """
    total = sum(n for n, _ in counts.values())
    want = {c: max(1, min(math.ceil(n / cell_rows), (max_pivots * n) // total)) for c, (n, _) in counts.items()}
    chosen = mark_smallest(df, label, key, "pivot", seed, want, "_p").where("_p").select(*columns)
    return chosen.toPandas()  # at most max_pivots + classes rows, through Arrow


def _mode(values):
    """Most frequent element of an array column; ties go to the smallest."""
    times = lambda v: F.size(F.filter(values, lambda x: x == v))
    kinds = F.array_sort(F.array_distinct(values))
    most = F.array_max(F.transform(values, times))
    return F.get(F.filter(kinds, lambda v: times(v) == most), F.lit(0))


def smotenc(df: DataFrame, label: str = LABEL, categorical=None, numeric=None, key: str = KEY,
            k: int = 5, seed: int = 42, cell_rows: int = CELL_ROWS, max_pivots: int = MAX_PIVOTS,
            copy_groups: bool = True, pivot_prune_min: int = 1,
            diagnostics: dict | None = None) -> DataFrame:
    """Oversample every class to the largest class's count.

    ``pivot_prune_min``: fewest pivots per group of the pivot tree, on average.
    ``diagnostics``, when given, receives row counts of the kNN passes
    (extra jobs; for measuring how well the bounds prune).
    """
    numeric = list(numeric)
    categorical = list(categorical)
    ship_package(df.sparkSession)
    # reused by every pass below; a row without a label belongs to no class
    df = materialize(df.where(F.col(label).isNotNull()))
    stats = class_stats(df, label, numeric, categorical)
    originals = df.withColumn("synth", F.lit(0))
    if not stats:
        return originals
    target = max(n for n, _ in stats.values())
    plan = {c: (n, m, target - n) for c, (n, m) in stats.items() if target - n > 0}
    if not plan:
        return originals

    # base rows: q_c copies each, plus one more for the r_c smallest base hashes
    lab = F.col(label)
    quot = F.create_map(*[x for c, (n, _, g) in plan.items() for x in (F.lit(c), F.lit(g // n))])[lab]
    work = mark_smallest(df.where(lab.isin(list(plan))), label, key, "base", seed,
                         {c: g % n for c, (n, _, g) in plan.items()}, "_extra")
    work = materialize(work.withColumn("_m", quot + F.col("_extra").cast("int")).drop("_extra"))

    counts = {c: (n, m) for c, (n, m, _) in plan.items()}
    kk = {c: min(k, n - 1) for c, (n, _) in counts.items()}
    kk_col = F.create_map(*[x for c, v in kk.items() for x in (F.lit(c), F.lit(v))])[lab]
    cols = [label, key, "_m"] + numeric + categorical

    # Groups of exact copies.  With m_c > 0 a row's distance 0 neighbours are
    # exactly its copies, so a row with at least k' copies has only copies as
    # neighbours and its synthetic rows are copies of it; other rows can only
    # ever pick the k'+1 smallest keys of such a group.  Those groups leave the
    # kNN passes (however large, no cell holds them), keeping k'+1 members.
    knn, copy_queries = work, None
    feats = numeric + categorical
    short = [c for c in plan if counts[c][1] > 0 and kk[c] > 0]
    if copy_groups and short and feats:
        sizes = work.groupBy(label, *feats).agg(F.count(F.lit(1)).alias("_cg"))  # combined map-side
        big_group = lab.isin(short) & (F.col("_cg") >= kk_col + 1)
        if sizes.where(big_group).limit(1).count():
            marked = work.join(sizes, [label, *feats])  # a hot group is split by AQE's skew join
            big = big_group
            w_copy = Window.partitionBy(label, *feats).orderBy(key)
            reps = (marked.where(big).withColumn("_rk", F.row_number().over(w_copy))
                    .where(F.col("_rk") <= F.lit(k + 1))  # literal limit: top rows kept per task before the shuffle
                    .where(F.col("_rk") <= kk_col + 1)
                    .withColumn("_m", F.lit(0)).drop("_rk", "_cg"))
            copy_queries = marked.where(big & (F.col("_m") > 0)).drop("_cg")
            knn = materialize(marked.where(~big).drop("_cg").unionByName(reps))

    max_pivots = min(max_pivots, MAX_PIVOT_BYTES // (16 * len(numeric) + 96 * len(categorical) + 64))
    pivot_rows = _pick_pivots(knn, label, key, counts, seed, cell_rows, max_pivots, cols)
    piv = {c: _ClassPivots(g, numeric, categorical, key, counts[c][1], pivot_prune_min)
           for c, g in pivot_rows.groupby(label)}
    piv_bc = df.sparkSession.sparkContext.broadcast(piv)  # bounded above; once per executor

    # the cell of every row
    def assign(batches):
        piv = piv_bc.value
        for pdf in batches:
            xn = pdf[numeric].to_numpy(float).reshape(len(pdf), len(numeric))
            codes, error = approx_bc.value.encode(xn)
            rows = pdf.drop(columns=numeric).assign(_x=xn.tolist(), _code=[c.tobytes() for c in codes], _err=error)
            out = {x: np.zeros(len(pdf)) for x in ("_cell", "_d", "_hd", "_compared")}
            for c, pos in pdf.groupby(label).indices.items():
                step = piv[c].rows_at_once
                for s in range(0, len(pos), step):
                    at = pos[s:s + step]
                    for x, v in zip(out.values(), piv[c].nearest(*piv[c].parts(pdf.iloc[at]))):
                        x[at] = v
            yield rows.assign(**{x: v.astype(np.int32) if x in ("_cell", "_compared") else v for x, v in out.items()})

    approx_bc = df.sparkSession.sparkContext.broadcast(quantiser(knn, numeric))  # 257 numbers per column
    assigned = materialize(knn.select(*cols).mapInPandas(assign, T.StructType(
        [work.schema[c] for c in cols if c not in numeric]
        + [T.StructField("_x", T.ArrayType(T.DoubleType())), T.StructField("_code", T.BinaryType()),
           T.StructField("_err", T.DoubleType()), T.StructField("_cell", T.IntegerType()), T.StructField("_d", T.DoubleType()),
           T.StructField("_hd", T.DoubleType()), T.StructField("_compared", T.IntegerType())])))
    boxes = [f(F.element_at("_x", j + 1)).alias(f"{name}{j}") for j in range(len(numeric))
             for f, name in ((F.min, "_lo"), (F.max, "_hi"))]
    cells = materialize(assigned.groupBy(label, "_cell").agg(
        F.count(F.lit(1)).alias("_n"), F.max("_d").alias("_r"), F.max("_hd").alias("_hr"), *boxes)
        .withColumn("_b", F.ceil(F.col("_n") / (BLOCK_CELLS * cell_rows)).cast("int")))
    cell_rows_ = cells.toPandas()  # one row per cell: bounded by the pivot budget, through Arrow
    stats = {c: _CellStats(piv[c], g) for c, g in cell_rows_.groupby(label)}
    stats_bc = df.sparkSession.sparkContext.broadcast(stats)
    # a row travels as its approximation; a query's values go with it
    members = (assigned.join(cells.select(label, "_cell", "_b"), [label, "_cell"])
               .withColumn("_blk", F.pmod(F.xxhash64(key), F.col("_b")).cast("int"))
               .select(label, key, "_m", *categorical, F.when(F.col("_m") > 0, F.col("_x")).alias("_x"), "_code", "_err",
                       "_cell", "_blk"))

    lists = [T.StructField("_lb", T.ArrayType(T.DoubleType())), T.StructField("_ub", T.ArrayType(T.DoubleType())),
             T.StructField("_nk", T.ArrayType(df.schema[key].dataType))]
    near_schema = T.StructType(
        [df.schema[label], df.schema[key], T.StructField("_x", T.ArrayType(T.DoubleType()))]
        + [df.schema[x] for x in categorical] + [T.StructField("_bound", T.DoubleType())] + lists
        + [T.StructField("_tc", T.ArrayType(T.IntegerType())), T.StructField("_tb", T.ArrayType(T.IntegerType()))])
    far_schema = T.StructType([df.schema[label], df.schema[key]] + lists)

    def none(schema):
        return pd.DataFrame({f.name: pd.Series([], dtype=object) for f in schema.fields})

    def values(frame):
        return np.array(frame["_x"].tolist(), float).reshape(len(frame), len(numeric))

    def scan(c, q, qn, rows, bound=None):
        """Per query the keys of the rows that can be neighbours, with their bounds."""
        vocab = _vocab(rows, categorical)
        codes = np.frombuffer(b"".join(rows["_code"]), np.uint16).reshape(len(rows), len(numeric))
        keys = rows[key].to_numpy()
        r, at, lower, upper = _survivors(qn, _codes(q, categorical, vocab), q[key].to_numpy(), approx_bc.value.decode(codes),
                                         _codes(rows, categorical, vocab), keys, rows["_err"].to_numpy(float), kk[c],
                                         counts[c][1] ** 2, bound)
        cut = np.searchsorted(r, np.arange(1, len(q)))
        return {f: [part.tolist() for part in np.split(v, cut)] for f, v in (("_lb", lower), ("_ub", upper), ("_nk", keys[at]))}

    # each query among its own block, and the blocks it has to visit
    def near(rows):
        c = rows[label].iloc[0]
        q = rows[rows["_m"].to_numpy() > 0]
        if q.empty:
            return none(near_schema)
        pv, st = piv_bc.value[c], stats_bc.value[c]
        qn = values(q)
        out = pd.DataFrame({label: q[label].to_numpy(), key: q[key].to_numpy(), "_x": qn.tolist()})
        for x in categorical:
            out[x] = q[x].to_numpy()
        k_ = kk[c]
        found = scan(c, q, qn, rows)
        kth = np.array([sorted(u)[k_ - 1] if len(u) >= k_ > 0 else np.inf for u in found["_ub"]])
        out["_bound"] = kth
        for f, v in found.items():
            out[f] = v
        to_cell, to_block = [[] for _ in range(len(q))], [[] for _ in range(len(q))]
        if k_:
            own = int(rows["_cell"].iloc[0]), int(rows["_blk"].iloc[0])
            qc = _codes(q, categorical, pv.vocab)
            for s in range(0, len(q), pv.rows_at_once):
                e = s + pv.rows_at_once
                for r, cell in zip(*pv.visits(qn[s:e], qc[s:e], np.sqrt(kth[s:e]) + SLACK, st, k_ + 1)):
                    for b in range(st.blocks[cell]):
                        if (cell, b) != own:
                            to_cell[s + r].append(int(cell))
                            to_block[s + r].append(b)
        out["_tc"], out["_tb"] = to_cell, to_block
        return out

    first = materialize(members.groupBy(label, "_cell", "_blk").applyInPandas(near, near_schema))
    visits = (first.withColumn("_to", F.explode(F.arrays_zip("_tc", "_tb")))
              .select(label, key, "_x", *categorical, "_bound", F.col("_to._tc").alias("_cell"),
                      F.col("_to._tb").alias("_blk")))
    place = [label, "_cell", "_blk"]
    shares = materialize(visits.groupBy(*place).agg(F.count(F.lit(1)).alias("_visits"))
                         .withColumn("_parts", F.ceil(F.col("_visits") / (VISIT_CELLS * cell_rows)).cast("int")))
    hosts = (members.drop("_x", "_m").join(shares, place).drop("_visits")
             .withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).drop("_parts"))
    guests = (visits.join(shares, place).drop("_visits")
              .withColumn("_part", F.pmod(F.xxhash64(key), F.col("_parts")).cast("int")).drop("_parts"))

    # visitors of one block: its rows that can be within their bounds
    def far(rows, q):
        if rows.empty or q.empty:
            return none(far_schema)
        found = scan(q[label].iloc[0], q, values(q), rows, q["_bound"].to_numpy(float))
        out = pd.DataFrame({label: q[label].to_numpy(), key: q[key].to_numpy(), **found})
        return out[[len(n) > 0 for n in found["_nk"]]]

    more = (hosts.groupBy(*place, "_part").cogroup(guests.groupBy(*place, "_part"))
            .applyInPandas(far, far_schema))

    # survivors of all visited blocks: lower bound within the k'-th upper bound
    entries = F.arrays_zip("_lb", "_ub", "_nk")
    both = (first.select(label, key, entries.alias("_e"), F.lit(1).alias("_own"))
            .unionByName(more.select(label, key, entries.alias("_e"), F.lit(0).alias("_own"))))
    merged = (both.groupBy(label, key).agg(F.flatten(F.collect_list("_e")).alias("_e"), F.sum("_own").alias("_own"))
              .withColumn("_e", F.when(F.col("_own") == 1, F.col("_e")).otherwise(
                  F.raise_error(F.lit("SMOTE-NC needs a unique key: two rows share one"))))
              .withColumn("_most", F.coalesce(F.get(F.array_sort(F.col("_e._ub")), kk_col - 1), F.lit(math.inf))))
    pairs = materialize(merged.select(label, key, F.explode(F.filter(
        "_e", lambda e: e["_lb"] <= F.col("_most") * (1 + 1e-9) + ROUNDING)).alias("_e"))
        .select(label, key, F.col("_e._nk").alias("_nk")))
    if diagnostics is not None:
        n_visits = visits.count()
        diagnostics.update(rows=knn.count(), sent=hosts.count() + n_visits, visits=n_visits,
                           queries=knn.where(F.col("_m") > 0).count(), cells=len(cell_rows_), exact=pairs.count(),
                           scanned=shares.join(members.groupBy(*place).count(), place)
                           .agg(F.sum(F.col("count") * F.col("_visits"))).first()[0],
                           compared=assigned.agg(F.avg("_compared")).first()[0],
                           copy_queries=0 if copy_queries is None else copy_queries.count())

    # their values, fetched by key, and the k' nearest by (distance^2 rounded, key)
    found = {x: f"_n_{i}" for i, x in enumerate(numeric + categorical)}
    fetched = knn.select(F.col(key).alias("_nk"), *[F.col(x).alias(f) for x, f in found.items()])
    m2 = F.create_map(*[x for c, (_, m) in counts.items() for x in (F.lit(c), F.lit(float(m) * float(m)))])[lab]
    square = F.lit(0.0)
    for x in numeric:
        diff = F.col(x).cast("double") - F.col(found[x]).cast("double")
        square = square + diff * diff
    for x in categorical:
        square = square + m2 * (~F.col(x).eqNullSafe(F.col(found[x]))).cast("double")
    base = knn.where(F.col("_m") > 0)
    exact = (pairs.join(fetched, "_nk").join(base.select(label, key, *numeric, *categorical), [label, key])
             .select(label, key, F.struct(F.round(square, 6).alias("_nd"), "_nk",
                                          F.array(*[F.col(found[x]).cast("double") for x in numeric]).alias("_nx"),
                                          *[F.col(found[x]) for x in categorical]).alias("_e")))
    nbrs = (exact.groupBy(label, key).agg(F.slice(F.array_sort(F.collect_list("_e")), F.lit(1), kk_col).alias("_e"))
            .select(label, key, F.col("_e._nx").alias("_nbr"),
                    *[_mode(F.col("_e").getField(found[x])).alias(f"_mode_{x}") for x in categorical]))

    # synthesis: one output row per (base row, t), no per-row Python
    base = base.join(nbrs, [label, key], "left").withColumn("_k", kk_col)
    t = F.col("_t")
    ex = base.withColumn("_t", F.explode(F.sequence(F.lit(0), F.col("_m") - 1)))
    pick = F.when(F.col("_k") > 0, (uniform_hash(key, "nbr", seed, t) % F.col("_k")).cast("int"))
    ex = ex.withColumn("_pick", pick).withColumn("_u", unit_hash(key, "gap", seed, t))
    out_cols = []
    for f in df.schema.fields:
        c = f.name
        if c in numeric:
            j = numeric.index(c)
            nb = F.element_at(F.element_at(F.col("_nbr"), F.col("_pick") + 1), j + 1)
            v = F.when(F.col("_k") > 0, F.col(c) + F.col("_u") * (nb - F.col(c))).otherwise(F.col(c))
            if isinstance(f.dataType, (T.IntegerType, T.LongType, T.ShortType)):
                v = F.round(v).cast(f.dataType)
            out_cols.append(v.alias(c))
        elif c in categorical:
            out_cols.append(F.when(F.col("_k") > 0, F.col(f"_mode_{c}")).otherwise(F.col(c)).alias(c))
        else:
            out_cols.append(F.col(c))
    synthetic = ex.select(*out_cols, (t + 1).alias("synth"))
    if copy_queries is not None:
        copies = copy_queries.withColumn("_t", F.explode(F.sequence(F.lit(0), F.col("_m") - 1)))
        synthetic = synthetic.unionByName(copies.select(*df.columns, (t + 1).alias("synth")))
    return originals.unionByName(synthetic)


def balance(df: DataFrame, label: str = LABEL, key: str = KEY, categorical=None, numeric=None,
            seed: int = 42, k: int = 5, rounds: int = 2) -> DataFrame:
    """Undersample the two largest classes, then SMOTE-NC the rest up.

    Column order is that of the input, plus ``synth``.
    """
    from playlab.operators.sampling import undersample
    from playlab.operators.clean import column_roles

    if categorical is None or numeric is None:
        roles = column_roles(df, key=key, label=label)
        categorical = [n for n, _, r in roles if r == "categorical"] if categorical is None else categorical
        numeric = [n for n, _, r in roles if r == "numeric"] if numeric is None else numeric
    cut = undersample(materialize(df), label=label, key=key, seed=seed, rounds=rounds)
    out = smotenc(cut, label=label, categorical=categorical, numeric=numeric, key=key, k=k, seed=seed)
    return out.select(*df.columns, "synth")
