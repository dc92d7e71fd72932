"""Feature engineering with Spark ML stages.

- F1 ``DictionaryIndexer`` (``dictionary.py``): category -> index by descending frequency, ties in
  alphabetical order of the value's text; numbers are indexed as text.  The label, whose values are the classes,
  has Spark's ``StringIndexer``.
- F2 ``OneHotEncoder``: sparse vector, the last category dropped.
- F3/F4 ``VectorAssembler``: ``skip`` drops rows with NaN/NULL inputs,
  ``error`` fails on them.
- F5 ``MaxAbsScaler``, F6 ``MinMaxScaler(min=1, max=2)`` (positive features
  for multinomial naive Bayes; a constant feature maps to 1.5).
- F7 the four as one ``Pipeline``, fitted on training rows only.

Fitting costs one aggregate per stage (category counts, column extremes).
Indexing joins the dictionary of a column; every other transform is a narrow, per-row map.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import (
    MaxAbsScaler, MinMaxScaler, OneHotEncoder, StringIndexer, VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlab.functions.columns import LABEL, LABEL_INDEX
from playlab.operators.dictionary import DictionaryIndexer


def idx(c: str) -> str:
    return f"{c}_idx"


def vec(c: str) -> str:
    return f"{c}_vec"


def index(columns, handle_invalid: str = "error") -> DictionaryIndexer:
    """One indexer for many columns; outputs are always ``<column>_idx`` (F1)."""
    return DictionaryIndexer(inputCols=list(columns), outputCols=[idx(c) for c in columns],
                             handleInvalid=handle_invalid)


def label_indexer(label: str = LABEL, output: str = LABEL_INDEX, handle_invalid: str = "error") -> StringIndexer:
    return StringIndexer(inputCol=label, outputCol=output, handleInvalid=handle_invalid)


def one_hot(columns, handle_invalid: str = "error") -> OneHotEncoder:
    """Index columns -> ``<column>_vec`` sparse vectors, last category dropped (F2)."""
    return OneHotEncoder(inputCols=[idx(c) for c in columns], outputCols=[vec(c) for c in columns],
                         handleInvalid=handle_invalid)


def assemble(inputs, output: str = "features", handle_invalid: str = "skip") -> VectorAssembler:
    """Concatenate numeric columns and vectors (F3 ``skip``, F4 ``error``)."""
    return VectorAssembler(inputCols=list(inputs), outputCol=output, handleInvalid=handle_invalid)


def scaler(kind: str = "maxabs", input_col: str = "features", output_col: str = "scaledFeatures"):
    """``maxabs`` (F5) or ``minmax`` to [1, 2]."""
    if kind == "maxabs":
        return MaxAbsScaler(inputCol=input_col, outputCol=output_col)
    if kind == "minmax":
        return MinMaxScaler(min=1.0, max=2.0, inputCol=input_col, outputCol=output_col)
    raise ValueError(f"unknown scaler {kind!r}")


def usable_categoricals(df: DataFrame, columns) -> tuple[list, list]:
    """Split categoricals into (usable, constant): one-hot needs two distinct values.

    One aggregate of min and max per column decides it.
    """
    columns = list(columns)
    if not columns:
        return [], []
    row = df.agg(*[(F.min(F.col(c).cast("string")) != F.max(F.col(c).cast("string"))).alias(c)
                   for c in columns]).first()
    usable = [c for c in columns if row[c]]
    return usable, [c for c in columns if not row[c]]


def feature_pipeline(categorical, numeric, kind: str | None = "maxabs", label: str | None = LABEL,
                     handle_invalid: str = "error", assemble_invalid: str = "skip",
                     one_hot_only: bool = False, label_invalid: str = "error") -> Pipeline:
    """Index -> one-hot -> assemble -> scale as one estimator.

    ``label`` adds the label indexer (``play_type_idx``); ``handle_invalid``
    applies to the category indexer and encoder ("keep" for scoring frames
    with categories unseen in training); ``label_invalid="skip"`` drops rows
    whose label was unseen in training instead of failing.
    """
    stages = [index(categorical, handle_invalid), one_hot(categorical, handle_invalid)]
    inputs = ([] if one_hot_only else list(numeric)) + [vec(c) for c in categorical]
    stages.append(assemble(inputs, "features", assemble_invalid))
    if kind:
        stages.append(scaler(kind))
    if label:
        stages.insert(0, label_indexer(label, handle_invalid=label_invalid))
    return Pipeline(stages=stages)


def explode_vector(df: DataFrame, column: str, key: str, keep_zeros: bool = False) -> DataFrame:
    """(key, slot, value) per vector entry; zeros dropped unless asked for."""
    return df.select(key, F.explode(vector_entries(column, keep_zeros)).alias("e")).select(key, "e.slot", "e.value")


def vector_entries(column: str, keep_zeros: bool = False):
    """Array of (slot, value); zeros are left out before anything is exploded."""
    entries = F.transform(vector_to_array(column), lambda v, i: F.struct(i.alias("slot"), v.alias("value")))
    return entries if keep_zeros else F.filter(entries, lambda e: e.value != 0.0)
