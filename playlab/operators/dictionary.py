"""Distributed dictionary encoding of categorical columns (F1).

``DictionaryIndexer`` numbers the values of each column by descending frequency, ties by
the value's text, like ``StringIndexer``, and is a stage of the same pipelines.  But the values
stay in a table: nothing holds a column's values on the driver or in one task.

1. One aggregate counts (column, value) for all columns, combined map-side.
2. The counts are range-partitioned and sorted by (column, count descending, value), and written
   with their partition and place in it.
3. A value's index is its place plus an offset per (partition, column); the driver adds up
   these offsets, one row per partition and column boundary.
4. ``transform`` joins each column with its part of the dictionary.  Spark broadcasts a part it measures as
   small, and shuffles otherwise, where AQE splits hot values.

NULL has no index: it is invalid, as is a value unseen in fitting.  ``handle_invalid`` decides:
``error`` fails, ``keep`` gives the number of values, ``skip`` drops the row.
"""

from __future__ import annotations

from __future__ import annotations

from pyspark.ml import Estimator, Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlab.session import materialize

_POSITION = (1 << 33) - 1  # low bits of monotonically_increasing_id: the place in the partition


def dictionary(df: DataFrame, columns) -> tuple[DataFrame, list[int]]:
    """((column number, value, index) of every value, number of values per column)."""
    columns = list(columns)
    pairs = F.array(*[F.struct(F.lit(j).alias("column"), F.col(f"`{c}`").cast("string").alias("value"))
                      for j, c in enumerate(columns)])
    counts = (df.select(F.explode(pairs).alias("p")).select("p.column", "p.value").where("value is not null")
              .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))
    order = ["column", F.desc("n"), "value"]
    placed = materialize(counts.repartitionByRange(*order).sortWithinPartitions(*order)
                         .select("column", "value", F.spark_partition_id().alias("part"),
                                 F.monotonically_increasing_id().bitwiseAND(_POSITION).alias("place")))
    pieces = sorted(placed.groupBy("part", "column").agg(F.count(F.lit(1)), F.min("place")).collect())
    sizes, offsets = [0] * len(columns), []
    for part, column, n, first in pieces:
        offsets.append((part, column, sizes[column] - first))
        sizes[column] += n
    shift = df.sparkSession.createDataFrame(offsets, "part int, column int, shift long")
    found = materialize(placed.join(shift, ["part", "column"])
                        .select("column", "value", (F.col("place") + F.col("shift")).cast("double").alias("index")))
    return found, sizes


class DictionaryIndexer(Estimator):
    """Estimator with the parameters of ``StringIndexer`` that the pipelines use."""

    def __init__(self, inputCols, outputCols, handleInvalid: str = "error"):
        super().__init__()
        if handleInvalid not in ("error", "keep", "skip"):
            raise ValueError(f"unknown handleInvalid {handleInvalid!r}")
        self.input_cols, self.output_cols, self.handle_invalid = list(inputCols), list(outputCols), handleInvalid

    def _fit(self, dataset: DataFrame) -> DictionaryIndexerModel:
        if not self.input_cols:
            return DictionaryIndexerModel(self, None, [])
        return DictionaryIndexerModel(self, *dictionary(dataset, self.input_cols))


class DictionaryIndexerModel(Model):
    def __init__(self, indexer: DictionaryIndexer, values: DataFrame | None, sizes: list[int]):
        super().__init__()
        self.input_cols, self.output_cols = indexer.input_cols, indexer.output_cols
        self.handle_invalid, self.values, self.sizes = indexer.handle_invalid, values, sizes

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = dataset
        for j, (source, target, size) in enumerate(zip(self.input_cols, self.output_cols, self.sizes)):
            value, index = f"__value_{target}", f"__index_{target}"
            part = self.values.where(F.col("column") == j).select(F.col("value").alias(value), F.col("index").alias(index))
            names = [c for c in out.columns if c != target]
            out = out.join(part, F.col(f"`{source}`").cast("string") == F.col(value),
                           "inner" if self.handle_invalid == "skip" else "left")
            found = F.col(index)
            if self.handle_invalid == "keep":
                found = F.coalesce(found, F.lit(float(size)))
            elif self.handle_invalid == "error":
                found = F.coalesce(found, F.raise_error(F.concat(
                    F.lit(f"column {source} has a value without an index: "),
                    F.coalesce(F.col(f"`{source}`").cast("string"), F.lit("NULL")))).cast("double"))
            attribute = {"ml_attr": {"type": "nominal", "name": target,
                                     "num_vals": size + (self.handle_invalid == "keep")}}
            out = out.select(*[F.col(f"`{c}`") for c in names], found.alias(target, metadata=attribute))
        return out
