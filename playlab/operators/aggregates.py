"""Aggregations, distinct values, imputation (A1-A10).

Each is one hash aggregate (partial per task, final after the shuffle of the
small partial results), so skewed values cost no more than others: a hot
value is combined map-side before anything moves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FLOATING = (T.FloatType, T.DoubleType)


def nan_free(column: str) -> Column:
    """The value, or NULL when it is NaN (aggregates then skip it)."""
    c = F.col(column)
    return F.when(~F.isnan(c), c)


def nan_mean(df: DataFrame, column: str, alias: str | None = None) -> DataFrame:
    """Mean of a column without NaN and NULL, as a one-row frame (A1).

    A plain ``avg`` over a NaN is NaN, so NaN is turned into NULL first.
    """
    return df.agg(F.avg(nan_free(column)).alias(alias or f"{column}_mean"))


def nan_mean_value(df: DataFrame, column: str):
    """The A1 mean as a Python float (one small job; None for no values)."""
    return nan_mean(df, column, "m").first()["m"]


def impute(df: DataFrame, values: dict) -> DataFrame:
    """Fill NaN and NULL in the named columns with the given constants (A2)."""
    return df.na.fill(values)


def rounded_mean(df: DataFrame, column: str, digits: int = 2, alias: str | None = None) -> DataFrame:
    """NaN-free mean rounded to ``digits`` (A3)."""
    return df.agg(F.round(F.avg(nan_free(column)), digits).alias(alias or f"{column}_mean"))


def count_by(df: DataFrame, *keys: str, alias: str = "n") -> DataFrame:
    """Rows per group."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(alias))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of one column."""
    return df.select(column).distinct()


def value_counts(df: DataFrame, column: str, alias: str = "n") -> DataFrame:
    """Counts per value, most frequent first, missing values left out.

    Rows are ordered by (count desc, value); the order is part of the result.
    """
    return (df.where(F.col(column).isNotNull())
              .groupBy(column).agg(F.count(F.lit(1)).alias(alias))
              .orderBy(F.col(alias).desc(), F.col(column)))


def null_counts(df: DataFrame) -> DataFrame:
    """Missing values per column, NaN counted as missing: (column_name, n_missing).

    One aggregate over all columns, then ``stack`` to long form.
    """
    aggs = []
    for f in df.schema.fields:
        c = F.col(f.name)
        miss = c.isNull() | F.isnan(c) if isinstance(f.dataType, _FLOATING) else c.isNull()
        aggs.append(F.count_if(miss).alias(f.name))
    wide = df.agg(*aggs)
    args = ", ".join(f"'{f.name}', `{f.name}`" for f in df.schema.fields)
    return wide.selectExpr(f"stack({len(df.schema.fields)}, {args}) as (column_name, n_missing)")


def label_index_map(df: DataFrame, label: str = "play_type", index: str = "play_type_idx") -> DataFrame:
    """Distinct (label, index) pairs, ordered by index."""
    return df.select(label, index).distinct().orderBy(index)


def column_list(df: DataFrame) -> DataFrame:
    """(position, column_name, n_non_null) for every column of a frame (A10).

    The names come from the schema; the non-NULL counts from one aggregate.
    """
    fields = df.schema.fields
    wide = df.agg(*[F.count(F.col(f.name)).alias(f.name) for f in fields])
    args = ", ".join(f"{i}, '{f.name}', `{f.name}`" for i, f in enumerate(fields))
    return wide.selectExpr(f"stack({len(fields)}, {args}) as (position, column_name, n_non_null)")
