"""A certificate that a logistic regression is fitted (M1).

The loss of a multinomial logistic regression with an L2 penalty is convex, so its minimum is where the
gradient is zero.  For the weight of class c and feature j that says

    mean(x_j p_c) + regParam s_j^2 w_cj = mean(x_j [label = c]),

with the fitted probabilities p, and s_j the feature's standard deviation (Spark penalises
standardised features).  The right side follows from the rows alone; the left side from the model.  One pass
sums both sides (a matrix product per Arrow batch), whatever the iterations of the fit.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def gradient_table(model, df: DataFrame) -> DataFrame:
    """(class_index, feature, observed, gradient) of a multinomial fit on ``df``; feature -1 is the intercept."""
    if model.getElasticNetParam() != 0.0 and model.getRegParam() != 0.0:
        raise ValueError("an L1 penalty has no gradient at zero weights")
    features, label = model.getFeaturesCol(), model.getLabelCol()
    row = df.agg(F.count(F.lit(1)).alias("n"), Summarizer.variance(F.col(features)).alias("v")).first()
    n, variance = row.n, row.v.toArray()
    penalty = model.getRegParam() * (variance if model.getStandardization() else np.ones(len(variance)))
    pull = np.c_[np.zeros(model.numClasses), penalty[None, :] * model.coefficientMatrix.toArray()]
    classes, width = pull.shape

    def sums(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x, p = (batch.column(i).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1) for i in (1, 2))
            x = np.c_[np.ones(len(x)), x]
            actual = np.eye(classes)[batch.column(0).to_numpy(zero_copy_only=False).astype(int)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.arange(classes, dtype=np.int32), width)),
                 pa.array(np.tile(np.arange(-1, width - 1, dtype=np.int32), classes)),
                 pa.array((actual.T @ x).ravel()), pa.array((p.T @ x).ravel())],
                names=["class_index", "feature", "observed", "fitted"])

    flat = df.sparkSession.createDataFrame(
        [(c, j - 1, float(pull[c, j])) for c in range(classes) for j in range(width)], "class_index int, feature int, pull double")
    scored = model.transform(df).select(F.col(label).cast("double"), vector_to_array(features), vector_to_array(model.getProbabilityCol()))
    total = (scored.mapInArrow(sums, "class_index int, feature int, observed double, fitted double")
             .groupBy("class_index", "feature").agg((F.sum("observed") / n).alias("observed"), (F.sum("fitted") / n).alias("fitted")))
    return total.join(flat, ["class_index", "feature"]).select(
        "class_index", "feature", "observed", (F.col("fitted") + F.col("pull") - F.col("observed")).alias("gradient"))
