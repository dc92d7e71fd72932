"""Plan shape guards over the registered queries."""

import pytest

import __spark_entry__ as E

from conftest import SF001

# queries whose building fits models (many jobs); their scoring plans are per-row maps
_MODEL = {"logistic_regression", "random_forest", "mlp", "tune", "best_params", "score", "naive_bayes"}


def global_windows(plan: str) -> list:
    """Window operators without PARTITION BY (they move every row into one task).

    Spark prints ``Window [functions], [partition keys], [order]`` and leaves
    out the partition group when it is empty.
    """
    found = []
    for line in plan.splitlines():
        at = line.find("Window [")
        if at < 0:
            continue
        text, depth, groups = line[at + len("Window "):], 0, 0
        for ch in text:
            if ch == "[":
                depth += 1
                if depth == 1:
                    groups += 1
            elif ch == "]":
                depth -= 1
        if groups < 3:
            found.append(line.strip())
    return found


def test_global_window_detector(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    df = spark.range(10)
    glob = df.withColumn("r", F.row_number().over(Window.orderBy("id")))
    part = df.withColumn("r", F.row_number().over(Window.partitionBy(F.col("id") % 2).orderBy("id")))
    assert global_windows(glob._jdf.queryExecution().executedPlan().toString())
    assert not global_windows(part._jdf.queryExecution().executedPlan().toString())


@pytest.mark.parametrize("name", sorted(set(E.queries()) - _MODEL))
def test_no_pairwise_joins_or_global_windows(spark, name):
    df = E.queries()[name](spark, SF001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert not global_windows(plan)


def test_filters_reach_the_scan(spark):
    from playlab.plans.prepare import cleaned
    from playlab.sources.plays import scan
    from playlab.session import shared_dir
    from playlab.sources.plays import plays, write_partitioned

    path = shared_dir(spark, "plan-scan")
    write_partitioned(plays(spark, SF001), path)
    df = cleaned(scan(spark, path, 1995, 2001))
    plan = df._jdf.queryExecution().executedPlan().toString()
    cut = plan[plan.index("PartitionFilters"):].split("PushedFilters")[0]
    assert "season" in cut and ">= 1995" in cut and "< 2001" in cut, cut
    assert "PushedFilters: [EqualTo(down,4.0)" in plan


def test_one_hot_scans_once_and_prepare_frames_prune(spark):
    """One pass for all columns; later scans of the cleaned rows are pruned Parquet scans."""
    from playlab.plans.queries import QUERIES

    plan = QUERIES["one_hot"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    assert "ExistingRDD" not in plan
    plan = QUERIES["column_list"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "ExistingRDD" not in plan


def test_season_outside_the_fixture_is_kept(spark):
    """Only the season operators cut by season."""
    from pyspark.sql import functions as F
    from playlab.plans.prepare import cleaned
    from playlab.sources.plays import plays

    df = plays(spark, SF001).withColumn("season", F.lit(2030))
    assert cleaned(df).count() == cleaned(plays(spark, SF001)).count() > 0


def test_metric_report_scans_once(spark):
    """Several frames of one prediction frame: as many scans as one frame alone needs."""
    scans = [E.queries()[q](spark, SF001)._jdf.queryExecution().executedPlan().toString().count("FileScan parquet")
             for q in ("metric_report", "accuracy")]
    assert scans[0] == scans[1], scans
