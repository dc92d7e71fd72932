"""Classifiers, grids, tuning and scoring (M1-M8).

Models are Spark ML estimators; their training loops run on the executors
(one aggregate per iteration / tree level).  Tuning fits the feature
stages once, caches the feature frame, and fits every grid entry of the
classifier on it (a grid of naive Bayes smoothings takes two passes in all, ``bayes_grid``); the split into train and validation rows is the key hash
of ``tv_split``, so it does not change with the partition layout.
"""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    LogisticRegression, MultilayerPerceptronClassifier, NaiveBayes, RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from playlab.functions.columns import KEY, LABEL_INDEX
from playlab.operators import bayes_grid
from playlab.operators.sampling import in_split, tv_split

# The reference's search grids.
LR_GRID = {"regParam": [0.0, 0.1, 0.09, 0.05, 0.01, 0.005], "maxIter": [50],
           "elasticNetParam": [0.0, 0.01, 0.5, 0.8, 0.85, 0.9, 1.0]}
LR_HOLDOUT_GRID = {"regParam": [0.0, 0.005, 0.01, 0.05, 0.09, 0.1], "maxIter": [10, 25, 50],
                   "elasticNetParam": [0.0, 0.01, 0.5, 0.8, 0.85, 0.9, 1.0]}
RF_GRID = {"numTrees": [10, 50, 100], "maxDepth": [5, 10, 15], "impurity": ["gini", "entropy"]}
# smoothing 0.05, 0.10, ..., 0.95 (19 values)
NB_GRID = {"smoothing": [round(0.05 * i, 2) for i in range(1, 20)]}
RF_SEED = 42
MLP_SEED = 2002


def classifier(kind: str, features: str = "scaledFeatures", label: str = LABEL_INDEX, **params):
    """A classifier estimator: ``lr`` (M1), ``rf`` (M2), ``nb`` (M3), ``mlp`` (M4)."""
    if kind == "lr":
        return LogisticRegression(featuresCol=features, labelCol=label, **params)
    if kind == "rf":
        params.setdefault("seed", RF_SEED)
        return RandomForestClassifier(featuresCol=features, labelCol=label, **params)
    if kind == "nb":
        return NaiveBayes(featuresCol=features, labelCol=label, **params)
    if kind == "mlp":
        params.setdefault("seed", MLP_SEED)
        params.setdefault("solver", "gd")
        return MultilayerPerceptronClassifier(featuresCol=features, labelCol=label, **params)
    raise ValueError(f"unknown classifier {kind!r}")


def vector_size(df: DataFrame, column: str) -> int:
    """Length of a vector column, read from its ML attribute metadata."""
    meta = df.schema[column].metadata.get("ml_attr", {})
    if "num_attrs" in meta:
        return int(meta["num_attrs"])
    attrs = meta.get("attrs", {})
    return sum(len(v) for v in attrs.values())


def mlp_layers(features_df: DataFrame, features: str, hidden, n_classes: int) -> list:
    """[n_features, *hidden, n_classes], the input size taken from metadata."""
    return [vector_size(features_df, features), *hidden, n_classes]


def grid(estimator, spec: dict) -> list:
    """Cross product of parameter values as a list of ParamMaps (M5)."""
    b = ParamGridBuilder()
    for name, values in spec.items():
        b = b.addGrid(estimator.getParam(name), list(values))
    return b.build()


def grid_rows(param_maps) -> list:
    """(param_index, params as JSON) per grid entry."""
    return [(i, json.dumps({p.name: v for p, v in sorted(m.items(), key=lambda kv: kv[0].name)}))
            for i, m in enumerate(param_maps)]


@dataclass
class Tuned:
    best_model: object       # classifier model refitted on all rows
    best_index: int
    param_maps: list
    metrics: list            # validation metric per grid entry
    metric_name: str

    def metrics_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(i, p, float(m)) for (i, p), m in zip(grid_rows(self.param_maps), self.metrics)]
        schema = T.StructType([T.StructField("param_index", T.IntegerType()),
                               T.StructField("params", T.StringType()),
                               T.StructField(self.metric_name, T.DoubleType())])
        return spark.createDataFrame(rows, schema)


def tune(features_df: DataFrame, estimator, param_maps, metric: str = "accuracy", ratio: float = 0.8,
         seed: int = 42, key: str = KEY, parallelism: int = 2, label: str = LABEL_INDEX) -> Tuned:
    """Train/validation search over ``param_maps`` (M6), then refit the best on all rows.

    ``features_df`` already holds the feature vector; it is persisted once
    (memory and disk, so a lost executor recomputes only its blocks) and
    released after the refit.
    """
    evaluator = MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction", metricName=metric)
    features_df = features_df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        train, valid = tv_split(features_df, ratio, seed, key)
        scores = [None] * len(param_maps)

        def run(i):
            model = estimator.fit(train, param_maps[i])
            return i, evaluator.evaluate(model.transform(valid))

        if bayes_grid.applies(estimator, param_maps) and metric in bayes_grid.METRICS:
            smoothings = [estimator.copy(m).getSmoothing() for m in param_maps]
            scores = bayes_grid.scores(features_df, in_split(features_df, ratio, seed, key), smoothings, metric,
                                       estimator.getFeaturesCol(), label)
        else:
            with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
                for i, s in pool.map(run, range(len(param_maps))):
                    scores[i] = s
        best = max(range(len(scores)), key=lambda i: (scores[i], -i)) if evaluator.isLargerBetter() else \
            min(range(len(scores)), key=lambda i: (scores[i], i))
        best_model = estimator.fit(features_df, param_maps[best])
    finally:
        features_df.unpersist()
    return Tuned(best_model, best, param_maps, scores, metric)


def tune_pipeline(train: DataFrame, features: Pipeline, estimator, param_maps, metric: str = "accuracy",
                  ratio: float = 0.8, seed: int = 42, parallelism: int = 2, label: str = LABEL_INDEX) -> Tuned:
    """The reference's search: ``TrainValidationSplit`` over the whole pipeline, so
    every grid entry refits the feature stages on its 80% (M6, ``refit_features``).

    The split is Spark's seeded ``randomSplit``; results then depend on the
    partition layout, unlike ``tune``.
    """
    from pyspark.ml.tuning import TrainValidationSplit

    evaluator = MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction", metricName=metric)
    pipe = Pipeline(stages=features.getStages() + [estimator])
    tvs = TrainValidationSplit(estimator=pipe, estimatorParamMaps=param_maps, evaluator=evaluator,
                               trainRatio=ratio, seed=seed, parallelism=parallelism)
    fitted = tvs.fit(train)
    scores = list(fitted.validationMetrics)
    best = max(range(len(scores)), key=lambda i: (scores[i], -i)) if evaluator.isLargerBetter() else \
        min(range(len(scores)), key=lambda i: (scores[i], i))
    return Tuned(fitted.bestModel, best, param_maps, scores, metric)


def best_params(spark: SparkSession, model) -> DataFrame:
    """(param, value) of a fitted model's parameters, values as text (M7)."""
    stage = model.stages[-1] if isinstance(model, PipelineModel) else model
    rows = sorted((p.name, str(v)) for p, v in stage.extractParamMap().items())
    return spark.createDataFrame(rows, "param string, value string")


def fit(df: DataFrame, features: Pipeline, clf) -> PipelineModel:
    """Feature stages and classifier as one fitted pipeline."""
    return Pipeline(stages=features.getStages() + [clf]).fit(df)


def score(model, df: DataFrame) -> DataFrame:
    """Predictions of a fitted model (M8): a narrow per-row map."""
    return model.transform(df)


def nb_parameters(spark: SparkSession, model) -> DataFrame:
    """Naive Bayes log priors and log likelihoods in long form (M3):
    (kind, class_index, feature, value), feature -1 for the priors.
    The matrix is classes x features, both small."""
    stage = model.stages[-1] if isinstance(model, PipelineModel) else model
    pi = stage.pi.toArray()
    theta = stage.theta.toArray()
    rows = [("pi", int(c), -1, float(v)) for c, v in enumerate(pi)]
    rows += [("theta", int(c), int(j), float(theta[c, j]))
             for c in range(theta.shape[0]) for j in range(theta.shape[1])]
    return spark.createDataFrame(rows, "kind string, class_index int, feature int, value double")
