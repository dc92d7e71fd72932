"""From raw plays to model-ready frames.

``prepare`` is one lazy plan per output frame: scan (season range) ->
projection -> one combined cleaning predicate -> hash sample / hash
remainder -> fill.  One action runs before the caller's: the cleaned rows are
written once as Parquet to the shared folder (later scans read the columns they
need), and the same job observes the training mean of ``temp`` and the training rows
per class.  Train and test are exact complements of the cleaned rows, found by two
filters without a join.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlab.functions.columns import (
    KEY, LABEL, REFERENCE_COLUMNS, SAMPLE_FRACTIONS,
)
from playlab.operators.aggregates import impute, nan_free, nan_mean_value
from playlab.operators.clean import clean, project
from playlab.operators.sampling import StratifiedSplit
from playlab.session import materialize
from playlab.sources.plays import scan_table


@dataclass
class Prepared:
    train: DataFrame
    test: DataFrame
    balanced: DataFrame | None
    fill: dict
    class_counts: dict  # training rows per class of the sample's fractions

    def frames(self) -> DataFrame:
        """All frames stacked, with a ``split`` column naming each."""
        train, test = self.train, self.test
        if self.balanced is not None:  # original rows carry synth = 0
            train, test = train.withColumn("synth", F.lit(0)), test.withColumn("synth", F.lit(0))
        out = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
        if self.balanced is not None:
            out = out.unionByName(self.balanced.withColumn("split", F.lit("balanced")))
        return out


def cleaned(df: DataFrame, start: int | None = None, end: int | None = None, key: str = KEY,
            all_columns: bool = True) -> DataFrame:
    """Reference columns (plus the key), fourth downs, NULL rule, no kneels; of a season range if one is given."""
    return clean(project(scan_table(df, start, end), [key] + REFERENCE_COLUMNS), all_columns=all_columns)


def training_fill(train: DataFrame) -> dict:
    """wind -> 0, temp -> NaN-free training mean (one small aggregate job)."""
    mean = nan_mean_value(train, "temp")
    return {"wind": 0.0, "temp": float(mean) if mean is not None else 0.0}


def prepare(df: DataFrame, end: int | None = None, start: int | None = None, balanced: bool = False,
            reference_order: bool = False, key: str = KEY, label: str = LABEL,
            fractions: dict | None = None, seed: int = 42, smote_k: int = 5,
            categorical=None, numeric=None) -> Prepared:
    """(train, test, balanced) frames of the reference's data pipeline.

    Default order: split first, then fill both frames with the *training*
    values, so the test set is disjoint from train and scored in full.
    ``reference_order=True`` reproduces the reference: fill the sample, then
    test = cleaned EXCEPT DISTINCT filled sample (filled rows leak back into
    test) and the test frame is not filled.
    """
    # the cleaned rows feed the mean, train, test (and balancing): read the
    # raw tables once and reuse the written fourth-down subset
    rows = cleaned(df, start, end, key)
    split = StratifiedSplit(label, dict(SAMPLE_FRACTIONS if fractions is None else fractions), seed, key)
    chosen = split.in_sample(rows)
    classes = sorted(split.fractions)
    rows, seen = materialize(rows, observe={
        "temp": F.avg(F.when(chosen, nan_free("temp"))),
        **{f"class {i}": F.count_if(chosen & (F.col(label) == c)) for i, c in enumerate(classes)}})
    sample = split.sample(rows)
    fill = {"wind": 0.0, "temp": float(seen["temp"]) if seen["temp"] is not None else 0.0}
    train = impute(sample, fill)
    if reference_order:
        test = rows.subtract(train)
    else:
        test = impute(split.remainder(rows), fill)
    bal = None
    if balanced:
        from playlab.operators.smotenc import balance
        bal = balance(train, label=label, key=key, seed=seed, k=smote_k,
                      categorical=categorical, numeric=numeric)
    return Prepared(train, test, bal, fill, {c: seen[f"class {i}"] for i, c in enumerate(classes)})


def base_frame(df: DataFrame, end: int | None = None, start: int | None = None, key: str = KEY,
               label: str = LABEL, seed: int = 42) -> DataFrame:
    """Filled training sample with the three-column NULL rule only."""
    rows = cleaned(df, start, end, key, all_columns=False)
    sample = StratifiedSplit(label, dict(SAMPLE_FRACTIONS), seed, key).sample(rows)
    return impute(sample, training_fill(sample))


def season_test(df: DataFrame, season: int, key: str = KEY) -> DataFrame:
    """One season, cleaned, neither sampled nor filled."""
    return cleaned(df, season, season + 1, key)
