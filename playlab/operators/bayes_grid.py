"""A whole smoothing grid of multinomial naive Bayes from one set of sufficient statistics (M6).

Class counts and per-class sums of the feature vector do not depend on the smoothing, so

1. one aggregate by (side of the split, class) gives them for the training part,
2. the log priors and likelihoods of all grid entries follow in closed form, and
3. one pass over the validation part scores every row with all entries (a matrix product
   per Arrow batch) and counts (entry, actual, predicted).

Two passes, whatever the grid's size.  The driver holds, as for a single fitted model, classes x
features numbers, times the grid entries.  Features must not be negative.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_ROWS = 4096  # rows per matrix product


def applies(estimator, param_maps) -> bool:
    """Whether the grid is one of smoothings of an unweighted multinomial naive Bayes without thresholds."""
    return (isinstance(estimator, NaiveBayes) and estimator.getModelType() == "multinomial"
            and not estimator.isSet("weightCol") and not estimator.isSet("thresholds") and len(param_maps) > 0
            and all({p.name for p in m} <= {"smoothing"} for m in param_maps))


def statistics(df: DataFrame, features: str, label: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(classes in order, rows per class, feature sums per class) from one aggregate."""
    rows = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"), Summarizer.sum(F.col(features)).alias("s")).collect()
    rows.sort(key=lambda r: r[label])
    if not rows:
        raise ValueError("naive Bayes needs training rows")
    sums = np.array([r.s.toArray() for r in rows])
    if (sums < 0).any():
        raise ValueError("multinomial naive Bayes needs features that are not negative")
    return np.array([r[label] for r in rows], float), np.array([r.n for r in rows], float), sums


def log_parameters(counts: np.ndarray, sums: np.ndarray, smoothings) -> tuple[np.ndarray, np.ndarray]:
    """(priors: entries x classes, likelihoods: entries x classes x features)."""
    lam = np.asarray(smoothings, float)[:, None]
    pi = np.log(counts[None, :] + lam) - np.log(counts.sum() + lam * len(counts))
    lam = lam[:, :, None]
    theta = np.log(sums[None] + lam) - np.log(sums.sum(axis=1)[None, :, None] + lam * sums.shape[1])
    return pi, theta


def confusion_counts(df: DataFrame, features: str, label: str, classes: np.ndarray, pi: np.ndarray,
                     theta: np.ndarray) -> DataFrame:
    """(entry, actual, predicted, n) of all grid entries from one pass over ``df``."""
    entries, n_classes, width = theta.shape
    weights = df.sparkSession.sparkContext.broadcast((pi, theta.reshape(entries * n_classes, width).T.copy(), classes))

    def count(batches):
        pi_, by_slot, known = weights.value
        for batch in batches:
            actual = batch.column(0).to_numpy(zero_copy_only=False)
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            seen: dict = {}
            for s in range(0, len(x), _ROWS):
                raw = (x[s:s + _ROWS] @ by_slot).reshape(-1, entries, n_classes) + pi_[None]
                predicted = known[raw.argmax(axis=2)]
                for g in range(entries):
                    pairs, n = np.unique(np.stack([actual[s:s + _ROWS], predicted[:, g]]), axis=1, return_counts=True)
                    for a, p, m in zip(*pairs, n):
                        seen[g, a, p] = seen.get((g, a, p), 0) + int(m)
            keys = list(zip(*seen)) or [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[0], pa.int32()), pa.array(keys[1], pa.float64()), pa.array(keys[2], pa.float64()),
                 pa.array(list(seen.values()), pa.int64())], names=["entry", "actual", "predicted", "n"])

    return (df.select(F.col(label).cast("double"), vector_to_array(features))
            .mapInArrow(count, "entry int, actual double, predicted double, n long")
            .groupBy("entry", "actual", "predicted").agg(F.sum("n").alias("n")))


def metric_of(rows, name: str) -> float:
    """A multiclass metric from (actual, predicted, n) rows, weighted by the actual classes."""
    total = sum(n for _, _, n in rows)
    if not total:
        return 0.0
    actual, predicted, both = {}, {}, {}
    for a, p, n in rows:
        actual[a] = actual.get(a, 0) + n
        predicted[p] = predicted.get(p, 0) + n
        if a == p:
            both[a] = n
    if name == "accuracy":
        return sum(both.values()) / total
    out = 0.0
    for c, n in actual.items():
        tp = both.get(c, 0)
        precision = tp / predicted[c] if c in predicted else 0.0
        recall = tp / n
        f1 = 2 * precision * recall / (precision + recall) if tp else 0.0
        out += {"f1": f1, "weightedPrecision": precision, "weightedRecall": recall}[name] * n / total
    return out


METRICS = ("accuracy", "f1", "weightedPrecision", "weightedRecall")


def scores(df: DataFrame, inside: Column, smoothings, metric: str, features: str, label: str) -> list[float]:
    """The metric of every smoothing, fitted where ``inside`` holds and scored elsewhere."""
    classes, counts, sums = statistics(df.where(inside), features, label)
    pi, theta = log_parameters(counts, sums, smoothings)
    found: dict[int, list] = {}
    for r in confusion_counts(df.where(~inside), features, label, classes, pi, theta).collect():
        found.setdefault(r.entry, []).append((r.actual, r.predicted, r.n))
    return [metric_of(found.get(g, []), metric) for g in range(len(smoothings))]
