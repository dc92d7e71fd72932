"""A fixed, deterministic play-type rule used to produce (label, prediction) pairs.

The evaluation queries need predictions without fitting a model; this rule
calls the play from the distance to go.  Band edges (fixed values):
ydstogo < 50 punt, < 75 field_goal, < 90 pass, < 96 run, otherwise no_play.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlab.functions.columns import LABEL, LABEL_INDEX

BANDS = [(50, "punt"), (75, "field_goal"), (90, "pass"), (96, "run")]
LAST_BAND = "no_play"


def band(column) -> Column:
    y = F.col(column) if isinstance(column, str) else column
    expr = None
    for edge, name in BANDS:
        expr = F.when(y < edge, name) if expr is None else expr.when(y < edge, name)
    return expr.otherwise(LAST_BAND)


def band_sql(expr: str) -> str:
    whens = " ".join(f"when {expr} < {edge} then '{name}'" for edge, name in BANDS)
    return f"(case {whens} else '{LAST_BAND}' end)"


def label_order(df: DataFrame, label: str = LABEL) -> list:
    """Labels by descending frequency, ties alphabetical: StringIndexer's order.

    One grouped count; one row per class reaches the driver.
    """
    rows = df.where(F.col(label).isNotNull()).groupBy(label).count().collect()
    return [r[label] for r in sorted(rows, key=lambda r: (-r["count"], str(r[label])))]


def rule_predictions(df: DataFrame, label: str = LABEL, index: str = LABEL_INDEX) -> DataFrame:
    """Adds ``index`` (as StringIndexer: by frequency, ties alphabetical),
    ``prediction`` (the rule's play type under the same index) and multilabel
    ``labels`` / ``predictions`` arrays.

    The label list has one entry per class, so the lookup map is small and
    bounded by the number of classes.
    """
    labels = label_order(df, label)
    lookup = F.create_map(*[x for i, lab in enumerate(labels) for x in (F.lit(lab), F.lit(float(i)))])
    out = df.withColumn(index, lookup[F.col(label)]).withColumn("prediction", lookup[band("ydstogo")])
    windy = ~F.isnan("wind") & (F.col("wind") > 20)
    labels = F.array_distinct(F.when(windy, F.array(F.col(index), lookup[F.lit("run")]))
                              .otherwise(F.array(F.col(index))))
    preds = F.when(F.isnan("temp"), F.array().cast("array<double>")).otherwise(
        F.array_distinct(F.array(lookup[band(F.col("ydstogo") - 3)], lookup[band(F.col("ydstogo") + 3)])))
    return out.withColumn("labels", labels).withColumn("predictions", preds)
