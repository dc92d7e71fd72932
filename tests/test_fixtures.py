"""Literal fixtures with hand-checked values (FIXTURES.md section 4)."""

import math

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, MultilabelClassificationEvaluator
from pyspark.sql import functions as F

from playlab.operators import aggregates as A
from playlab.operators import clean as P
from playlab.operators import evaluate as E
from playlab.operators import sampling as R


@pytest.fixture()
def pred5(spark):
    rows = [(0.0, 0.0), (1.0, 0.0), (2.0, 1.0), (1.0, 1.0), (0.0, 1.0)]
    return spark.createDataFrame(rows, "prediction double, play_type_idx double")


@pytest.fixture()
def multilabel7(spark):
    rows = [([0.0, 1.0], [0.0, 2.0]), ([0.0, 2.0], [0.0, 1.0]), ([], [0.0]), ([2.0], [2.0]),
            ([2.0, 0.0], [2.0, 0.0]), ([0.0, 1.0, 2.0], [0.0, 1.0]), ([1.0], [1.0, 2.0])]
    return spark.createDataFrame(rows, "predictions array<double>, labels array<double>")


@pytest.fixture()
def nan_null4(spark):
    nan = float("nan")
    rows = [(1, "punt", nan, 1.0), (2, "punt", None, 2.0), (3, "run", 5.0, 3.0), (3, "run", 5.0, 3.0),
            (4, "spike", 6.0, nan)]
    return spark.createDataFrame(rows, "row_id long, play_type string, temp double, wind double")


def test_multiclass_metrics(pred5):
    m = E.metrics(pred5).first()
    assert m["accuracy"] == pytest.approx(0.4)
    assert m["f1"] == pytest.approx(0.44)
    assert m["precision_by_label"] == pytest.approx(0.5)
    assert m["weighted_precision"] == pytest.approx(0.5)
    assert m["weighted_recall"] == pytest.approx(0.4)


@pytest.mark.parametrize("name,ours", [("accuracy", "accuracy"), ("f1", "f1"),
                                        ("precisionByLabel", "precision_by_label"),
                                        ("weightedPrecision", "weighted_precision"),
                                        ("weightedRecall", "weighted_recall")])
def test_metrics_agree_with_spark_evaluator(pred5, name, ours):
    ev = MulticlassClassificationEvaluator(labelCol="play_type_idx", predictionCol="prediction", metricName=name)
    assert E.metrics(pred5).first()[ours] == pytest.approx(ev.evaluate(pred5))


def test_confusion_reference_form(pred5):
    wide = E.confusion_matrix(pred5, form="reference").collect()
    assert [[r[c] for c in ("0.0", "1.0")] for r in wide] == [[1, 1], [1, 1]]
    long = {(r.actual, r.predicted): r.n for r in E.confusion_matrix(pred5).collect()}
    assert long[(1.0, 2.0)] == 1 and sum(long.values()) == 5


def test_multilabel(multilabel7):
    m = E.multilabel_metrics(multilabel7).first()
    assert m["recall"] == pytest.approx(0.642857, abs=1e-6)
    assert m["precision"] == pytest.approx(0.666667, abs=1e-6)
    assert m["f1"] == pytest.approx(0.638095, abs=1e-6)
    assert m["accuracy"] == pytest.approx(0.547619, abs=1e-6)
    by = {r.label: r for r in E.multilabel_by_label(multilabel7).collect()}
    assert by[0.0].precision == pytest.approx(1.0)
    assert by[0.0].recall == pytest.approx(0.8)
    assert by[0.0].f1 == pytest.approx(0.888889, abs=1e-6)
    assert sorted(r.label for r in E.multilabel_label_set(multilabel7).collect()) == [0.0, 1.0, 2.0]


@pytest.mark.parametrize("metric,ours", [("recall", "recall"), ("precision", "precision"),
                                         ("f1Measure", "f1"), ("accuracy", "accuracy")])
def test_multilabel_agrees_with_spark(multilabel7, metric, ours):
    ev = MultilabelClassificationEvaluator(predictionCol="predictions", labelCol="labels", metricName=metric)
    assert E.multilabel_metrics(multilabel7).first()[ours] == pytest.approx(ev.evaluate(multilabel7))


def test_nan_null_rules(nan_null4):
    assert P.require_not_null(nan_null4, ["temp"]).count() == 4      # NaN kept
    assert nan_null4.na.drop().count() == 2                          # na.drop also drops NaN
    assert A.nan_mean_value(nan_null4, "temp") == pytest.approx(16 / 3)
    filled = A.impute(nan_null4, {"temp": 0.0, "wind": 0.0})
    rest = sorted(r.row_id for r in R.remainder(nan_null4, filled).collect())
    assert rest == [1, 2, 4]                                         # EXCEPT DISTINCT of the fill
    assert P.require_value(nan_null4, ["temp", "wind"]).count() == 2
    assert P.exclude(nan_null4, "play_type", "spike").count() == 4


def test_nan_to_keeps_null(nan_null4):
    out = {r.row_id: r.temp for r in P.nan_to(nan_null4, "temp", 0.0).collect()}
    assert out[1] == 0.0 and out[2] is None


def test_profile_and_null_counts(nan_null4):
    prof = {r.column_name: (r.null_count, r.nan_count) for r in A.null_counts(nan_null4).select(
        "column_name", F.col("n_missing").alias("null_count"), F.lit(0).alias("nan_count")).collect()}
    assert prof["temp"][0] == 2 and prof["wind"][0] == 1
    from playlab.sources.io import profile
    p = {r.column_name: (r.null_count, r.nan_count) for r in profile(nan_null4).collect()}
    assert p["temp"] == (1, 1) and p["wind"] == (0, 1) and p["play_type"] == (0, 0)


def test_blank_and_label_last(spark):
    df = spark.createDataFrame([("", "a"), (None, "b"), ("x", "c")], "surface string, play_type string")
    out = [r.surface for r in P.blank_to(df, "surface").collect()]
    assert out == ["Undefined", None, "x"]
    assert P.label_last(df.select("play_type", "surface")).columns == ["surface", "play_type"]
    assert P.project(df, ["play_type", "missing", "surface"]).columns == ["play_type", "surface"]


def test_undersample_targets():
    assert R.undersample_targets({"a": 10, "b": 5, "c": 3}, 1) == {"a": 3, "b": 5, "c": 3}
    assert R.undersample_targets({"a": 10, "b": 5, "c": 3}, 2) == {"a": 3, "b": 3, "c": 3}
    assert R.undersample_targets({"a": 4, "b": 4, "c": 1}, 1) == {"a": 1, "b": 4, "c": 1}


def test_param_grids():
    from playlab.operators import models as M
    assert len(M.grid(M.classifier("lr"), M.LR_GRID)) == 42
    assert len(M.grid(M.classifier("lr"), M.LR_HOLDOUT_GRID)) == 126
    assert len(M.grid(M.classifier("rf"), M.RF_GRID)) == 18
    assert len(M.grid(M.classifier("nb"), M.NB_GRID)) == 19
    assert M.NB_GRID["smoothing"][0] == 0.05 and M.NB_GRID["smoothing"][-1] == 0.95
    assert not math.isnan(M.NB_GRID["smoothing"][2])


def test_label_order_matches_string_indexer(spark):
    from pyspark.ml.feature import StringIndexer
    from playlab.functions.rules import label_order
    df = spark.createDataFrame([(x,) for x in "bbaaccd"], "play_type string")
    assert label_order(df) == StringIndexer(inputCol="play_type", outputCol="i").fit(df).labels


def test_usable_categoricals(spark):
    from playlab.operators.features import usable_categoricals
    df = spark.createDataFrame([("a", 1, "x"), ("b", 1, "x"), ("a", 1, "y")], "s string, i int, t string")
    assert usable_categoricals(df, ["s", "i", "t"]) == (["s", "t"], ["i"])


def test_label_invalid_skip(spark):
    from playlab.operators.features import feature_pipeline
    train = spark.createDataFrame([("a", 1.0, "x"), ("b", 2.0, "y"), ("a", 3.0, "y")],
                                  "cat string, v double, play_type string")
    test = spark.createDataFrame([("a", 1.0, "x"), ("b", 2.0, "z")], "cat string, v double, play_type string")
    model = feature_pipeline(["cat"], ["v"], label_invalid="skip").fit(train)
    assert model.transform(test).count() == 1
