"""The naive Bayes grid from sufficient statistics against one fit per entry."""

import numpy as np
import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.linalg import Vectors

from playlab.operators import bayes_grid
from playlab.operators import models as M
from playlab.operators.sampling import tv_split


def frame(spark, n=400):
    rng = np.random.default_rng(8)
    label = rng.integers(0, 3, n)
    x = rng.poisson(1 + 2 * np.eye(3, 6)[label]).astype(float) + 1
    rows = [(i, float(c), Vectors.dense(v) if i % 2 else Vectors.sparse(6, {j: w for j, w in enumerate(v)}))
            for i, (c, v) in enumerate(zip(label.tolist(), x.tolist()))]
    return spark.createDataFrame(rows, ["row_id", "play_type_idx", "scaledFeatures"]).repartition(3)


@pytest.mark.parametrize("metric", bayes_grid.METRICS)
def test_equals_one_fit_per_entry(spark, metric):
    df = frame(spark)
    est = M.classifier("nb")
    grid = M.grid(est, {"smoothing": [0.05, 0.5, 1.0, 50.0]})
    tuned = M.tune(df, est, grid, metric=metric)
    train, valid = tv_split(df, 0.8, 42, "row_id")
    score = MulticlassClassificationEvaluator(labelCol="play_type_idx", metricName=metric)
    want = [score.evaluate(est.fit(train, g).transform(valid)) for g in grid]
    assert np.allclose(tuned.metrics, want)
    assert tuned.best_index == int(np.argmax(np.round(want, 12)))


def test_parameters_equal_the_fitted_model(spark):
    df = frame(spark)
    classes, counts, sums = bayes_grid.statistics(df, "scaledFeatures", "play_type_idx")
    pi, theta = bayes_grid.log_parameters(counts, sums, [0.3])
    model = M.classifier("nb", smoothing=0.3).fit(df)
    assert classes.tolist() == [0.0, 1.0, 2.0]
    assert np.allclose(pi[0], model.pi.toArray()) and np.allclose(theta[0], model.theta.toArray())


def test_where_it_applies(spark):
    nb, lr = M.classifier("nb"), M.classifier("lr")
    assert bayes_grid.applies(nb, M.grid(nb, M.NB_GRID)) and len(M.grid(nb, M.NB_GRID)) == 19
    assert not bayes_grid.applies(lr, M.grid(lr, {"regParam": [0.1]}))
    assert not bayes_grid.applies(M.classifier("nb", modelType="gaussian"), M.grid(nb, M.NB_GRID))
    with pytest.raises(ValueError):
        bad = spark.createDataFrame([(1, 0.0, Vectors.dense([-1.0]))], ["row_id", "play_type_idx", "scaledFeatures"])
        bayes_grid.statistics(bad, "scaledFeatures", "play_type_idx")


def test_two_passes_whatever_the_grid(spark):
    """An accumulator in the features' lineage: every row is read twice for the search and by the last fit."""
    seen = spark.sparkContext.accumulator(0)
    df = frame(spark, 100)

    def touch(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    counted = df.select("row_id", "play_type_idx").mapInArrow(touch, "row_id long, play_type_idx double")
    joined = counted.join(df.select("row_id", "scaledFeatures"), "row_id")
    reads = []
    for grid in ([0.5], M.NB_GRID["smoothing"]):
        before = seen.value
        bayes_grid.scores(joined, joined.row_id % 5 > 0, grid, "accuracy", "scaledFeatures", "play_type_idx")
        reads.append(seen.value - before)
    assert reads[0] == reads[1] <= 200
