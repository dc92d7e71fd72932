"""Projections, filters and scalar rewrites.

All are narrow transformations: no shuffle, and filters on scan columns reach
the parquet reader as ``PushedFilters``.  Several conditions are combined into
one predicate instead of a chain of ``where`` calls.

NaN rules: ``isNotNull`` keeps NaN (dome games have NaN weather), so cleaning
never uses ``na.drop``, which would drop NaN as well.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlab.functions.columns import (
    BLANK_REPLACEMENT, EXCLUDED_LABEL, FOURTH_DOWN, INTEGER_CATEGORIES, KEY, LABEL,
    NULL_CHECKED,
)


def project(df: DataFrame, columns) -> DataFrame:
    """Keep the listed columns that exist, in list order; ignore missing ones."""
    present = set(df.columns)
    return df.select(*[c for c in columns if c in present])


def fourth_down(df: DataFrame, column: str = "down", value: float = FOURTH_DOWN) -> DataFrame:
    """``down == 4.0``; NULL and NaN never equal 4."""
    return df.where(F.col(column) == F.lit(value))


def all_not_null(columns) -> Column:
    return reduce(and_, [F.col(c).isNotNull() for c in columns])


def require_not_null(df: DataFrame, columns=None) -> DataFrame:
    """Rows with no NULL in the named columns, or in every column (P3, P4). NaN is kept."""
    cols = list(columns) if columns is not None else df.columns
    return df.where(all_not_null(cols)) if cols else df


def require_value(df: DataFrame, columns) -> DataFrame:
    """Rows whose named columns are neither NULL nor NaN (P5)."""
    conds = []
    for c in columns:
        cond = F.col(c).isNotNull()
        if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType)):
            cond = cond & ~F.isnan(c)
        conds.append(cond)
    return df.where(reduce(and_, conds))


def exclude(df: DataFrame, column: str = LABEL, value: str = EXCLUDED_LABEL) -> DataFrame:
    """``column != value``; a NULL in ``column`` is rejected too."""
    return df.where(F.col(column) != F.lit(value))


def drop_columns(df: DataFrame, *columns: str) -> DataFrame:
    """Drop named columns."""
    return df.drop(*columns)


def column_roles(df: DataFrame, exclude=INTEGER_CATEGORIES, key: str = KEY, label: str = LABEL):
    """(name, role) per column: numeric = non-string minus exclusions.

    Returns a Python list: it is read from the schema, no data is touched.
    """
    roles = []
    for f in df.schema.fields:
        if f.name == key:
            role = "key"
        elif f.name == label:
            role = "label"
        elif isinstance(f.dataType, T.StringType) or f.name in exclude:
            role = "categorical"
        else:
            role = "numeric"
        roles.append((f.name, f.dataType.simpleString(), role))
    return roles


def numeric_columns(df: DataFrame, exclude=INTEGER_CATEGORIES, key: str = KEY, label: str = LABEL):
    return [n for n, _, r in column_roles(df, exclude, key, label) if r == "numeric"]


def categorical_columns(df: DataFrame, exclude=INTEGER_CATEGORIES, key: str = KEY, label: str = LABEL):
    return [n for n, _, r in column_roles(df, exclude, key, label) if r == "categorical"]


def select_by_dtype(df: DataFrame, exclude=INTEGER_CATEGORIES, key: str = KEY, label: str = LABEL) -> DataFrame:
    """Project the key and the numeric feature columns chosen by type."""
    keep = ([key] if key in df.columns else []) + numeric_columns(df, exclude, key, label)
    return df.select(*keep)


def blank_to(df: DataFrame, column: str, value: str = BLANK_REPLACEMENT) -> DataFrame:
    """Empty-string category -> ``value``; NULL stays NULL."""
    c = F.col(column)
    return df.withColumn(column, F.when(c == "", F.lit(value)).otherwise(c))


def minutes_remaining(column: str = "quarter_seconds_remaining", alias: str = "quarter_min_remaining") -> Column:
    """``round(seconds / 60, 2)`` (P10)."""
    return F.round(F.col(column) / 60, 2).alias(alias)


def report(df: DataFrame, columns, seconds: str = "quarter_seconds_remaining") -> DataFrame:
    """Report columns with seconds shown as rounded minutes (P10)."""
    out = []
    for c in columns:
        out.append(minutes_remaining(seconds) if c == seconds else F.col(c))
    return df.select(*out)


def team_season(df: DataFrame, team: str, season: str | int | None = None, team_col: str = "posteam") -> DataFrame:
    """One team's rows, optionally of one season given as text or number.

    A string season literal is compared with the integer column by Spark's
    implicit cast, as in the reference.
    """
    cond = F.col(team_col) == F.lit(team)
    if season is not None:
        cond = cond & (F.col("season") == F.lit(season))
    return df.where(cond)


def misclassified(pred: DataFrame, team: str, label_col: str = "play_type_idx",
                  prediction_col: str = "prediction", team_col: str = "posteam") -> DataFrame:
    """One team's rows whose prediction differs from the label index."""
    return pred.where((F.col(team_col) == F.lit(team)) & (F.col(label_col) != F.col(prediction_col)))


def cast_label_float(df: DataFrame, column: str = "play_type_idx") -> DataFrame:
    """Label index as float32."""
    return df.withColumn(column, F.col(column).cast(T.FloatType()))


def nan_to(df: DataFrame, column: str, value: float = 0.0) -> DataFrame:
    """NaN -> ``value``; NULL stays NULL (P14).  JVM-side, no Python UDF."""
    return df.withColumn(column, F.nanvl(F.col(column), F.lit(float(value))))


def label_last(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Same columns with the label moved to the end."""
    return df.select(*[c for c in df.columns if c != label], label)


def clean(df: DataFrame, all_columns: bool = True, label: str = LABEL,
          null_checked=NULL_CHECKED, excluded: str = EXCLUDED_LABEL) -> DataFrame:
    """Fourth downs, no NULL (in the three named or in every column), no excluded label.

    Built as a single predicate so Catalyst pushes it to the scan at once.
    """
    cols = list(df.columns) if all_columns else list(null_checked)
    cond = (F.col("down") == F.lit(FOURTH_DOWN)) & all_not_null(cols) & (F.col(label) != F.lit(excluded))
    return df.where(cond)
