"""One modelling run, as a single call.

prepare -> (balance) -> feature pipeline fitted once on training rows ->
grid search of the classifier -> best model -> scores, metric report and
confusion matrices on the test frame (and a held-out season).  Every step is
an operator of this package; nothing here touches rows on the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlab.functions.columns import KEY
from playlab.operators import evaluate as E
from playlab.operators import features as FE
from playlab.operators import models as M
from playlab.operators.aggregates import impute
from playlab.operators.clean import blank_to
from playlab.plans.prepare import prepare, season_test

# scaler per classifier: min-max to [1, 2] keeps naive Bayes inputs positive
SCALER = {"lr": "maxabs", "rf": "maxabs", "nb": "minmax", "mlp": "maxabs"}


@dataclass
class Experiment:
    model: PipelineModel
    tuned: M.Tuned
    scored: dict          # frame name -> predictions
    report: DataFrame     # one row of metrics per frame
    confusion: DataFrame  # (frame, actual, predicted, n)
    dropped: list         # categoricals left out: a single value in training


def experiment(plays: DataFrame, kind: str, grid_spec: dict, categorical, numeric, *, balanced: bool = False,
               holdout: int | None = None, metric: str = "accuracy", seed: int = 42,
               parallelism: int = 2, hidden=(16,), refit_features: bool = False,
               label_invalid: str = "error") -> Experiment:
    """Tune ``kind`` over ``grid_spec`` and evaluate it.

    ``holdout``: train and test come from seasons before it, the season itself
    is a second test frame, and ``season`` is not a feature.  ``balanced``:
    fit on the undersampled and SMOTE-NC-oversampled training frame.
    ``refit_features``: search as the reference does, refitting the feature
    stages for every grid entry (``TrainValidationSplit`` over the pipeline).
    """
    prep = prepare(plays, end=holdout,  # without a holdout every season trains
                   balanced=balanced, seed=seed,
                   categorical=list(categorical) if balanced else None,
                   numeric=list(numeric) if balanced else None)
    train = prep.balanced if balanced else prep.train
    frames = {"test": prep.test}
    if holdout is not None:
        frames["holdout"] = impute(season_test(plays, holdout), prep.fill)
        categorical = [c for c in categorical if c != "season"]
        train = train.drop("season")
        frames = {k: v.drop("season") for k, v in frames.items()}
    train = blank_to(train, "surface")
    frames = {k: blank_to(v, "surface") for k, v in frames.items()}
    categorical, dropped = FE.usable_categoricals(train, categorical)  # one-hot needs two values

    feature_stages = FE.feature_pipeline(categorical, numeric, kind=SCALER[kind], label="play_type",
                                         handle_invalid="keep", label_invalid=label_invalid)
    features = feature_stages.fit(train)
    ftrain = features.transform(train)
    params = {}
    if kind == "mlp":
        n_classes = len(features.stages[0].labels)
        params["layers"] = M.mlp_layers(ftrain, "scaledFeatures", list(hidden), n_classes)
    clf = M.classifier(kind, **params)
    if refit_features:
        tuned = M.tune_pipeline(train, feature_stages, clf, M.grid(clf, grid_spec), metric=metric, seed=seed,
                                parallelism=parallelism)
        model = tuned.best_model
    else:
        tuned = M.tune(ftrain, clf, M.grid(clf, grid_spec), metric=metric, seed=seed, key=KEY,
                       parallelism=parallelism)
        model = PipelineModel(features.stages + [tuned.best_model])
    scored = {k: M.score(model, v) for k, v in frames.items()}
    report = E.metric_report(scored)
    confusion = None
    for k, v in scored.items():
        part = E.confusion_matrix(v).select(F.lit(k).alias("frame"), "*")
        confusion = part if confusion is None else confusion.unionByName(part)
    return Experiment(model, tuned, scored, report, confusion, dropped)
