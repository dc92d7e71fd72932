"""Exact top-k by inner product with a KD-tree per shard (operator 2).

The vectors are dealt into shards of about ``SHARD_ROWS`` rows.  A shard's KD-tree
splits at the median of the widest dimension, and every node keeps the tight
bounding box of its rows and its smallest id.  The largest inner product that a
box allows, ``sum(max(q*low, q*high))``, orders a best-first traversal: the search
of a query ends when the best open box cannot beat its k-th answer so far (a box
that can only tie is skipped if its smallest id is larger).

The queries travel in blocks.  Each block first meets one shard; the k-th score
found there goes with it to all other shards, where it cuts the traversal from
the start, and every shard returns only answers that reach it.  A last
window keeps k answers per query.  Every query meets every shard, so the result
is exact; the work grows with queries x shards, the queries being a stated set.

Edge cases: rows with a null id or vector, or a null, NaN or infinite component,
take no part; vectors meet vectors of their own length only; exactly repeated
rows count once; rows with a query's id are its own and no candidates; fewer
candidates than k give fewer answers; an empty table gives none.
"""

from __future__ import annotations

import heapq
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playlab.session import ship_package, write_stage

SHARD_ROWS = 16384
BLOCK_QUERIES = 256
LEAF_ROWS = 128


class Tree:
    """KD-tree over integer vectors: nodes as arrays, leaves as ranges of the reordered rows."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        order = np.arange(len(ids))
        nodes = []  # first row, end row, left child, right child
        stack = [(0, len(ids), -1, 0)]
        while stack:
            a, b, parent, side = stack.pop()
            me = len(nodes)
            nodes.append([a, b, -1, -1])
            if parent >= 0:
                nodes[parent][2 + side] = me
            if b - a > LEAF_ROWS:
                part = rows[order[a:b]]
                wide = int(np.argmax(part.max(axis=0) - part.min(axis=0)))
                mid = (b - a) // 2
                order[a:b] = order[a:b][np.argpartition(part[:, wide], mid)]
                stack += [(a, a + mid, me, 0), (a + mid, b, me, 1)]
        self.nodes = np.array(nodes)
        self.ids = ids[order]
        self.rows = rows[order]
        self.low = np.stack([self.rows[a:b].min(axis=0) for a, b, _, _ in nodes])
        self.high = np.stack([self.rows[a:b].max(axis=0) for a, b, _, _ in nodes])
        self.least = np.array([self.ids[a:b].min() for a, b, _, _ in nodes])

    def search(self, ids: np.ndarray, queries: np.ndarray, k: int, bound: dict):
        """Answers (query index, id, score) that reach the query's bound, if it has one."""
        top = max(int(np.abs(self.rows).max(initial=0)), int(np.abs(queries).max(initial=0)))
        kind = np.float64 if top * top * queries.shape[1] < 1 << 53 else np.int64  # both exact
        q = queries.astype(kind)
        rows, low, high = self.rows.astype(kind), self.low.astype(kind), self.high.astype(kind)
        best = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T  # queries x nodes
        for i in range(len(q)):
            at_least = bound.get(i)
            found: list[tuple[int, int]] = []  # heap of (score, -id): the worst first
            upper = best[i]
            heap = [(-upper[0], int(self.least[0]), 0)]
            while heap:
                neg, least, node = heapq.heappop(heap)
                if at_least is not None and -neg < at_least:
                    break
                if len(found) == k and (-neg, -least) < found[0]:
                    break
                a, b, left, right = self.nodes[node]
                if left >= 0:
                    for child in (left, right):
                        heapq.heappush(heap, (-upper[child], int(self.least[child]), int(child)))
                    continue
                score = rows[a:b] @ q[i]
                floor = found[0][0] if len(found) == k else at_least
                good = np.flatnonzero((self.ids[a:b] != ids[i]) & (score >= floor if floor is not None else True))
                for j in good:
                    item = (int(score[j]), -int(self.ids[a + j]))
                    if len(found) < k:
                        heapq.heappush(found, item)
                    elif item > found[0]:
                        heapq.heapreplace(found, item)
            for s, neg_id in found:
                yield i, -neg_id, s


def _small(m: np.ndarray) -> np.ndarray:
    for kind in (np.int16, np.int32):
        if len(m) == 0 or (m.min() >= np.iinfo(kind).min and m.max() <= np.iinfo(kind).max):
            return m.astype(kind)
    return m


def _matrix(column) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(flat.flatten()).reshape(len(flat), -1)


def finite(vector: str) -> Column:
    """Neither null nor empty, and every component a finite number."""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))),
                      F.lit(False)) & (F.size(vector) > 0)


def topk(vectors: DataFrame, is_query: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding",
         scale: float = 256.0) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best by inner product of floor(scale * x)."""
    spark = vectors.sparkSession
    ship_package(spark)
    whole = F.transform(F.col(vector).cast("array<double>"), lambda x: F.floor(F.lit(scale) * x))
    rows = (vectors.where(F.col(key).isNotNull() & finite(vector))
            .select(F.col(key).alias("id"), whole.alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"))
            .dropDuplicates(["id", "v"]).withColumn("dim", F.size("v")))
    rows = write_stage(rows, "topk-rows")
    # per length of vector: how many shards and query blocks
    sizes = rows.groupBy("dim").agg(F.count("*").alias("n"), F.sum(F.col("q").cast("long")).alias("nq"))
    plan = sizes.select("dim", F.ceil(F.col("n") / SHARD_ROWS).alias("shards"),
                        F.greatest(F.lit(1), F.ceil(F.col("nq") / BLOCK_QUERIES)).alias("blocks"))
    plan = write_stage(plan, "topk-plan")
    dealt = rows.join(plan, "dim")

    def build(group: pa.Table) -> pa.Table:
        tree = Tree(group.column("id").to_numpy(), _small(_matrix(group.column("v"))))
        return pa.table({"dim": group.column("dim")[:1], "shard": group.column("shard")[:1],
                         "tree": pa.array([pickle.dumps(tree)], pa.binary())})

    def gather(group: pa.Table) -> pa.Table:
        ids, m = group.column("id").to_numpy(), _small(_matrix(group.column("v")))
        return pa.table({c: group.column(c)[:1] for c in ("dim", "block", "shards")}
                        | {"queries": pa.array([pickle.dumps((ids, m))], pa.binary())})

    trees = write_stage(
        dealt.select("dim", F.expr("pmod(xxhash64(id, v), shards)").alias("shard"), "id", "v")
        .groupBy("dim", "shard").applyInArrow(build, "dim int, shard long, tree binary"), "topk-trees")
    blocks = write_stage(
        dealt.where("q").select("dim", F.expr("pmod(xxhash64(id, v, 1), blocks)").alias("block"), "shards", "id", "v")
        .groupBy("dim", "block").applyInArrow(gather, "dim int, block long, shards long, queries binary"),
        "topk-blocks")

    def search(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                dim, block, _, raw, tree, kth = (batch.column(i)[r].as_py() for i in range(6))
                ids, m = pickle.loads(raw)
                got = list(pickle.loads(tree).search(ids, m, k, dict(kth or ())))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x] * len(got), t) for x, t in ((dim, pa.int32()), (block, pa.int64()))]
                    + [pa.array([g[i] for g in got], pa.int64()) for i in range(3)]
                    + [pa.array([int(ids[g[0]]) for g in got], pa.int64())],
                    names=["dim", "block", "n", "vec_id", "score", "query_id"])

    found_schema = "dim int, block long, n long, vec_id long, score long, query_id long"
    none = F.lit(None).cast("map<long,long>").alias("kth")
    at_home = blocks.withColumn("shard", F.pmod("block", "shards"))
    first = write_stage(at_home.join(trees, ["dim", "shard"]).select("dim", "block", "shard", "queries", "tree", none)
                        .mapInArrow(search, found_schema), "topk-first")
    # the k-th score of each query so far; a query with fewer answers has no bound yet
    kth = (first.groupBy("dim", "block", "n").agg(F.count("*").alias("c"), F.min("score").alias("s"))
           .where(F.col("c") == k).groupBy("dim", "block")
           .agg(F.map_from_entries(F.collect_list(F.struct("n", "s"))).alias("kth")))
    bounded = at_home.join(kth, ["dim", "block"], "left")
    others = (bounded.withColumn("home", F.col("shard"))
              .withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)))
              .where("shard <> home"))
    rest = (others.join(trees, ["dim", "shard"]).select("dim", "block", "shard", "queries", "tree", "kth")
            .mapInArrow(search, found_schema))
    order = Window.partitionBy("dim", "block", "n").orderBy(F.desc("score"), "vec_id")
    return (first.unionByName(rest).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
