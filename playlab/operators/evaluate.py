"""Multiclass and multilabel evaluation as DataFrame aggregates.

All multiclass numbers come from one aggregate, the confusion counts
``(label, prediction) -> n`` (at most C*C rows, combined map-side), instead
of one pass per evaluator plus an RDD of Python tuples.  Definitions follow
Spark's ``MulticlassMetrics``:

- accuracy            = sum of diagonal / N
- precision(l)        = tp / predicted(l), 0 when nothing is predicted as l
- recall(l)           = tp / actual(l)
- f1(l)               = 2 p r / (p + r), 0 when p + r = 0
- weighted x          = sum over actual labels of x(l) * actual(l) / N
- precisionByLabel    = precision of ``metric_label`` (default 0.0)

Multilabel numbers follow ``MultilabelMetrics`` (per-document averages); a
ratio with a zero denominator counts as 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LABEL_COL = "play_type_idx"
PREDICTION_COL = "prediction"


def confusion_counts(pred: DataFrame, label: str = LABEL_COL, prediction: str = PREDICTION_COL) -> DataFrame:
    """(actual, predicted, n) for every observed pair (E7, long form)."""
    return (pred.groupBy(F.col(label).cast("double").alias("actual"),
                         F.col(prediction).cast("double").alias("predicted"))
                .agg(F.count(F.lit(1)).alias("n")))


def confusion_matrix(pred: DataFrame, label: str = LABEL_COL, prediction: str = PREDICTION_COL,
                     form: str = "long") -> DataFrame:
    """Confusion matrix, rows actual and columns predicted.

    ``long``: observed (actual, predicted, n).  ``wide``: one row per actual
    label, one column per label of actual or predicted, zeros filled.
    ``reference``: as Spark's ``MulticlassMetrics.confusionMatrix``: rows and
    columns are the labels present among the actual values only.
    """
    counts = confusion_counts(pred, label, prediction)
    if form == "long":
        return counts
    labels_df = counts.select(F.col("actual").alias("l")).union(counts.select(F.col("predicted").alias("l")))
    if form == "reference":
        labels_df = counts.select(F.col("actual").alias("l"))
        counts = counts.join(labels_df.distinct().withColumnRenamed("l", "predicted"), "predicted", "left_semi")
    labels = [r["l"] for r in labels_df.distinct().orderBy("l").collect()]  # at most C values
    wide = counts.groupBy("actual").pivot("predicted", labels).agg(F.sum("n")).na.fill(0)
    return wide.orderBy("actual")


def _per_label(counts: DataFrame, by=()) -> DataFrame:
    """Per-label numbers from confusion counts, separately per value of the ``by`` columns."""
    n, diag = F.col("n"), F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(F.lit(0))
    sides = F.array(
        F.struct(F.col("actual").alias("label"), n.alias("n_actual"), F.lit(0).cast("bigint").alias("n_predicted"),
                 diag.cast("bigint").alias("tp")),
        F.struct(F.col("predicted").alias("label"), F.lit(0).cast("bigint").alias("n_actual"),
                 n.alias("n_predicted"), F.lit(0).cast("bigint").alias("tp")))
    s = (counts.select(*by, F.explode(sides).alias("s")).select(*by, "s.*")
         .groupBy(*by, "label").agg(*[F.sum(x).alias(x) for x in ("n_actual", "n_predicted", "tp")]))
    p = F.when(F.col("n_predicted") > 0, F.col("tp") / F.col("n_predicted")).otherwise(0.0)
    r = F.when(F.col("n_actual") > 0, F.col("tp") / F.col("n_actual")).otherwise(0.0)
    s = s.withColumn("precision", p).withColumn("recall", r)
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(0.0)
    return s.withColumn("f1", f1)


def per_label(pred: DataFrame, label: str = LABEL_COL, prediction: str = PREDICTION_COL) -> DataFrame:
    """(label, n_actual, n_predicted, tp, precision, recall, f1) per label seen anywhere.

    Each confusion cell counts once for its actual label and once for its
    predicted label; one more grouped sum gives the per-label totals, so no
    join is needed.
    """
    return _per_label(confusion_counts(pred, label, prediction))


def metrics_of_counts(counts: DataFrame, metric_label: float = 0.0, by=()) -> DataFrame:
    """The metrics E1-E5 from confusion counts, one row per value of the ``by`` columns."""
    n = F.sum("n_actual")
    return _per_label(counts, by).groupBy(*by).agg(
        (F.sum("tp") / n).alias("accuracy"),
        (F.sum(F.col("f1") * F.col("n_actual")) / n).alias("f1"),
        F.coalesce(F.max(F.when(F.col("label") == F.lit(float(metric_label)), F.col("precision"))),
                   F.lit(0.0)).alias("precision_by_label"),
        (F.sum(F.col("precision") * F.col("n_actual")) / n).alias("weighted_precision"),
        (F.sum(F.col("recall") * F.col("n_actual")) / n).alias("weighted_recall"),
    )


def metrics(pred: DataFrame, label: str = LABEL_COL, prediction: str = PREDICTION_COL,
            metric_label: float = 0.0) -> DataFrame:
    """One row: accuracy, f1, precision_by_label, weighted_precision, weighted_recall."""
    return metrics_of_counts(confusion_counts(pred, label, prediction), metric_label)


def frame_counts(pred: DataFrame, frames: dict, label: str = LABEL_COL,
                 prediction: str = PREDICTION_COL) -> DataFrame:
    """(frame, actual, predicted, n) for several parts of one prediction frame, in one pass.

    ``frames`` maps a name to the condition of its rows; rows may belong to several.
    """
    names = F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in frames.items()]))
    counts = (pred.groupBy(names.alias("_frames"), F.col(label).cast("double").alias("actual"),
                           F.col(prediction).cast("double").alias("predicted"))
              .agg(F.count(F.lit(1)).alias("n")))
    return counts.select(F.explode("_frames").alias("frame"), "actual", "predicted", "n")


def metric_report(frames: dict, label: str = LABEL_COL, prediction: str = PREDICTION_COL,
                  metric_label: float = 0.0, digits: int | None = 6, pred: DataFrame | None = None) -> DataFrame:
    """All metrics, one row per named prediction frame.

    With ``pred``, ``frames`` are conditions on it and one pass serves them all (a
    frame without rows has no row); otherwise they are DataFrames.
    """
    if pred is not None:
        counts = frame_counts(pred, frames, label, prediction)
    else:
        counts = None
        for name, frame in frames.items():
            c = confusion_counts(frame, label, prediction).select(F.lit(name).alias("frame"), "*")
            counts = c if counts is None else counts.unionByName(c)
    m = metrics_of_counts(counts, metric_label, ["frame"])
    return m if digits is None else m.select("frame", *[F.round(c, digits).alias(c) for c in m.columns[1:]])


def _sizes(df: DataFrame, predictions: str, labels: str) -> DataFrame:
    p, l = F.col(predictions), F.col(labels)
    return df.select(
        F.size(F.array_intersect(p, l)).alias("_i"), F.size(p).alias("_p"), F.size(l).alias("_l"),
        F.size(F.array_union(p, l)).alias("_u"))


def multilabel_metrics(df: DataFrame, predictions: str = "predictions", labels: str = "labels") -> DataFrame:
    """One row: recall, precision, f1, accuracy averaged over documents."""
    s = _sizes(df, predictions, labels)
    i, p, l, u = (F.col(c) for c in ("_i", "_p", "_l", "_u"))

    def ratio(a, b):
        return F.when(b > 0, a / b).otherwise(0.0)

    return s.agg(
        F.avg(ratio(i, l)).alias("recall"),
        F.avg(ratio(i, p)).alias("precision"),
        F.avg(ratio(2 * i, p + l)).alias("f1"),
        F.avg(ratio(i, u)).alias("accuracy"),
    )


def multilabel_by_label(df: DataFrame, predictions: str = "predictions", labels: str = "labels") -> DataFrame:
    """(label, precision, recall, f1) for each label found in the label sets.

    Each document emits one (label, in_prediction, in_labels) row per label
    it mentions; a grouped sum then gives tp, fp and fn.  No document key or
    join is needed.
    """
    p, l = F.col(predictions), F.col(labels)
    marks = F.transform(F.array_union(p, l), lambda x: F.struct(
        x.alias("label"), F.array_contains(p, x).alias("in_p"), F.array_contains(l, x).alias("in_l")))
    e = df.select(F.explode(marks).alias("m")).select("m.*")
    g = e.groupBy("label").agg(
        F.count_if(F.col("in_p") & F.col("in_l")).alias("tp"),
        F.count_if(F.col("in_p") & ~F.col("in_l")).alias("fp"),
        F.count_if(~F.col("in_p") & F.col("in_l")).alias("fn"))
    g = g.where(F.col("tp") + F.col("fn") > 0)  # labels that occur in some label set
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return g.select(
        "label",
        F.when(tp + fp > 0, tp / (tp + fp)).otherwise(0.0).alias("precision"),
        F.when(tp + fn > 0, tp / (tp + fn)).otherwise(0.0).alias("recall"),
        F.when(2 * tp + fp + fn > 0, 2 * tp / (2 * tp + fp + fn)).otherwise(0.0).alias("f1"))


def multilabel_label_set(df: DataFrame, labels: str = "labels") -> DataFrame:
    """Distinct labels over all label sets."""
    return df.select(F.explode(F.col(labels)).alias("label")).distinct()
