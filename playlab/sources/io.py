"""Profiling, CSV reports and first rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FLOATING = (T.FloatType, T.DoubleType)


def profile(df: DataFrame) -> DataFrame:
    """NULL and NaN counts per column, in one pass: (column_name, null_count, nan_count).

    NaN is only possible in float/double columns; elsewhere its count is 0.
    One aggregate computes every count (partial aggregation map-side, a
    single-row final), then ``stack`` turns it into one row per column.
    """
    aggs = []
    for f in df.schema.fields:
        c = F.col(f.name)
        aggs.append(F.count_if(c.isNull()).alias(f"{f.name}__null"))
        nan = F.count_if(F.isnan(c)) if isinstance(f.dataType, _FLOATING) else F.lit(0).cast("bigint")
        aggs.append(nan.alias(f"{f.name}__nan"))
    wide = df.agg(*aggs)
    stack_args = ", ".join(
        f"'{f.name}', `{f.name}__null`, `{f.name}__nan`" for f in df.schema.fields)
    return wide.selectExpr(
        f"stack({len(df.schema.fields)}, {stack_args}) as (column_name, null_count, nan_count)")


def write_csv(df: DataFrame, path: str) -> str:
    """Write a report as CSV with a header row; returns the folder."""
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a report written by ``write_csv`` back with its schema."""
    return spark.read.option("header", True).schema(schema).csv(path)


def head(df: DataFrame, n: int, order) -> DataFrame:
    """First ``n`` rows in a stated order (a global top-n, not an arbitrary sample).

    ``orderBy(...).limit(n)`` plans as TakeOrderedAndProject: every task keeps
    its own n best rows and only those reach the final merge.
    """
    order = [order] if isinstance(order, str) else list(order)
    return df.orderBy(*order).limit(n)
