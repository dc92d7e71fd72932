"""Fitted classifiers as tables, scored by joins (M1, M2, M4, M8).

A fitted model becomes rows that any engine can read and score:

* linear (logistic regression): (class, slot, weight), slot -1 for the intercepts;
* forest (random forest): (tree, node, feature, threshold, left, right, votes), feature -1 in
  leaves; ``votes`` are a leaf's class shares;
* network (multilayer perceptron): (layer, source, target, weight), source -1 for the biases.

``score_*`` take rows of (key, slot, value), a feature vector in long form without its zeros:

* a linear score is one join on the slot and one sum per (key, class);
* a forest moves (key, tree) from node to node, one join per level;
* a network joins activations with the weights of the next layer and sums them, layer by layer.

Predictions are the class of the largest score, at ties the smallest.  ``save_version``
writes a model's tables and description to a new version folder; ``load_version`` reads one back in any session.
"""

from __future__ import annotations

import json

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlab.operators.features import vector_entries
from playlab.session import shared_dir


def entries(df: DataFrame, features: str, key: str) -> DataFrame:
    """(key, slot, value) of the entries of a feature vector that are not zero."""
    return (df.select(key, F.explode(vector_entries(features)).alias("e"))
            .select(key, F.col("e.slot").alias("slot"), F.col("e.value").alias("value")))


def _argmax(scores: DataFrame, key: str) -> DataFrame:
    """(key, prediction) from (key, class, score): the largest score, at ties the smallest class."""
    best = F.max_by("class", F.struct("score", (-F.col("class")).alias("c")))
    return scores.groupBy(key).agg(best.cast("double").alias("prediction"))


# ---------------------------------------------------------------- linear
def linear_table(spark: SparkSession, model) -> DataFrame:
    """(class, slot, weight) of a logistic regression; two classes get weights for the second, zeros for the first."""
    w, b = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    first = 1 if len(b) == 1 else 0
    rows = [(c + first, -1, float(v)) for c, v in enumerate(b)] + ([(0, -1, 0.0)] if first else [])
    rows += [(c + first, j, float(v)) for c, ws in enumerate(w) for j, v in enumerate(ws) if v != 0.0]
    return spark.createDataFrame(rows, "class int, slot int, weight double")


def score_linear(table: DataFrame, rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """(key, prediction); ``keys`` are all rows to score (those without entries have the intercepts only)."""
    bias = keys.select(key, F.lit(-1).alias("slot"), F.lit(1.0).alias("value"))  # the intercept is a slot of value 1
    parts = (rows.select(key, "slot", "value").unionByName(bias).join(table, "slot")
             .groupBy(key, "class").agg(F.sum(F.col("value") * F.col("weight")).alias("score")))
    return _argmax(parts, key)


# ---------------------------------------------------------------- forest
def forest_table(spark: SparkSession, model) -> DataFrame:
    """(tree, node, feature, threshold, left, right, votes) of a random forest, from the data it saves itself."""
    path = shared_dir(spark, "forest")
    model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data")
    node = F.col("nodeData") if "nodeData" in nodes.columns else F.struct("*")
    flat = nodes.select(F.col("treeID").cast("int").alias("tree"), node.alias("n"))
    leaf = F.col("n.leftChild") < 0
    total = F.aggregate("n.impurityStats", F.lit(0.0), lambda a, x: a + x)
    return flat.select("tree", F.col("n.id").alias("node"),
                       F.when(leaf, -1).otherwise(F.col("n.split.featureIndex")).alias("feature"),
                       F.when(~leaf, F.get("n.split.leftCategoriesOrThreshold", F.lit(0))).alias("threshold"),
                       F.col("n.leftChild").alias("left"), F.col("n.rightChild").alias("right"),
                       F.when(leaf, F.transform("n.impurityStats", lambda x: F.when(total > 0, x / total).otherwise(0.0)))
                       .alias("votes"))


def score_forest(table: DataFrame, df: DataFrame, features: str, key: str, trees: int, depth: int) -> DataFrame:
    """(key, prediction) of rows with a feature vector; one join per level, for ``trees`` trees of at most ``depth`` levels.

    A row visits one node per tree and level, so it carries its values with it and is not shuffled while the
    table of nodes is small enough to broadcast.  Splits are on ordered features (no categorical ones).
    """
    at = df.select(key, F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"), vector_to_array(features).alias("x"),
                   F.lit(0).alias("node"))
    split = table.where("feature >= 0").select("tree", "node", "feature", "threshold", "left", "right")
    for _ in range(depth):
        at = (at.join(split, ["tree", "node"], "left")
              .select(key, "tree", "x", F.when(F.col("feature").isNull(), F.col("node")).when(
                  F.get("x", F.col("feature")) <= F.col("threshold"), F.col("left")).otherwise(F.col("right")).alias("node")))
    votes = (at.select(key, "tree", "node").join(table.where("feature = -1").select("tree", "node", "votes"), ["tree", "node"])
             .select(key, F.posexplode("votes").alias("class", "score")))
    return _argmax(votes.groupBy(key, "class").agg(F.sum("score").alias("score")), key)


# ---------------------------------------------------------------- network
def network_table(spark: SparkSession, model) -> DataFrame:
    """(layer, source, target, weight) of a multilayer perceptron; layer 0 takes the features."""
    layers, w = list(model.getLayers()), model.weights.toArray()
    rows, at = [], 0
    for layer, (n_in, n_out) in enumerate(zip(layers, layers[1:])):
        matrix = w[at:at + n_in * n_out].reshape(n_in, n_out)  # column-major (out x in)
        at += n_in * n_out
        rows += [(layer, s, t, float(matrix[s, t])) for s in range(n_in) for t in range(n_out)]
        rows += [(layer, -1, t, float(v)) for t, v in enumerate(w[at:at + n_out])]
        at += n_out
    return spark.createDataFrame(rows, "layer int, source int, target int, weight double")


def score_network(table: DataFrame, rows: DataFrame, keys: DataFrame, key: str, layers: int) -> DataFrame:
    """(key, prediction): activations joined with the weights of each of the ``layers`` weight layers.

    Hidden units are sigmoids.  The last layer's softmax keeps the order of its sums, so these decide.
    """
    now = rows.select(key, F.col("slot").alias("source"), "value")
    for layer in range(layers):
        weights = table.where(F.col("layer") == layer)
        start = keys.select(key, F.lit(-1).alias("source"), F.lit(1.0).alias("value"))  # the bias is a unit of value 1
        sums = (now.unionByName(start).join(weights, "source")
                .groupBy(key, "target").agg(F.sum(F.col("value") * F.col("weight")).alias("z")))
        now = sums.select(key, F.col("target").alias("source"),
                          (F.col("z") if layer == layers - 1 else 1 / (1 + F.exp(-F.col("z")))).alias("value"))
    return _argmax(now.select(key, F.col("source").alias("class"), F.col("value").alias("score")), key)


# ---------------------------------------------------------------- versions
def _versions(spark: SparkSession, root: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()]
    done = [n for n in names if n.startswith("v") and n[1:].isdigit()
            and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{n}/description"))]
    return sorted(int(n[1:]) for n in done)


def save_version(spark: SparkSession, root: str, tables: dict[str, DataFrame], description: dict) -> int:
    """Writes ``tables`` and a description as the next version below ``root``.

    The description is written last: a version without it was cut off and does not count.
    """
    version = max(_versions(spark, root), default=0) + 1
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{root}/v{version}/{name}")
    text = json.dumps({**description, "tables": sorted(tables)})
    spark.createDataFrame([(text,)], "description string").write.parquet(f"{root}/v{version}/description")
    return version


def load_version(spark: SparkSession, root: str, version: int | None = None) -> tuple[dict[str, DataFrame], dict]:
    """(tables, description) of a version, the latest by default."""
    found = _versions(spark, root)
    if not found or (version is not None and version not in found):
        raise FileNotFoundError(f"no version {version or ''} below {root}")
    at = f"{root}/v{version or found[-1]}"
    description = json.loads(spark.read.parquet(f"{at}/description").first().description)
    return {name: spark.read.parquet(f"{at}/{name}") for name in description["tables"]}, description
