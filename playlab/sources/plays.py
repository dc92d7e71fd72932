"""The plays table.

``plays(spark, sf_dir)`` derives a play-shaped table from the driver's
``orders`` and ``customer`` parquet files (the recipe of FIXTURES.md section 2):
one row per order, NaN and NULL weather, an empty category, a NULL label and
five imbalanced play types.  Only the needed columns are read, so the scans
carry a pruned ``ReadSchema``; the join is left to Catalyst/AQE, which
broadcasts ``customer`` only while its measured size is under
``spark.sql.autoBroadcastJoinThreshold`` and otherwise sort-merge joins on
the customer key.

``scan`` reads a season-partitioned plays dataset (``write_partitioned``
makes one) with a season range, which becomes partition pruning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PLAYS_SCHEMA = T.StructType([
    T.StructField("row_id", T.LongType()),
    T.StructField("season", T.IntegerType()),
    T.StructField("week", T.IntegerType()),
    T.StructField("season_type", T.StringType()),
    T.StructField("posteam", T.StringType()),
    T.StructField("roof", T.StringType()),
    T.StructField("surface", T.StringType()),
    T.StructField("down", T.DoubleType()),
    T.StructField("ydstogo", T.DoubleType()),
    T.StructField("quarter_seconds_remaining", T.DoubleType()),
    T.StructField("ep", T.DoubleType()),
    T.StructField("temp", T.DoubleType()),
    T.StructField("wind", T.DoubleType()),
    T.StructField("play_type", T.StringType()),
])




def plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Play-shaped table derived from orders and customer."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    j = orders.join(customer, orders.o_custkey == customer.c_custkey)

    key, cust, price = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_totalprice")
    doy = F.dayofyear("o_orderdate")
    cents = price % 100
    dome = cust % 3 == 0
    label = (
        F.when(key % 97 == 0, F.lit(None).cast("string"))
        .when(cents < 55, "punt")
        .when(cents < 80, "field_goal")
        .when(cents < 89, "pass")
        .when(cents < 95, "run")
        .when(cents < 98.5, "no_play")
        .otherwise("qb_kneel")
    )
    return j.select(
        key.alias("row_id"),
        F.year("o_orderdate").cast("int").alias("season"),
        (F.floor((doy - 1) / 7).cast("int") + 1).alias("week"),
        F.when(doy > 310, "POST").otherwise("REG").alias("season_type"),
        F.concat(F.lit("T"), F.col("c_nationkey").cast("string")).alias("posteam"),
        F.col("c_mktsegment").alias("roof"),
        F.when(key % 11 == 0, "").otherwise(F.col("o_orderstatus")).alias("surface"),
        (1 + key % 4).cast("double").alias("down"),
        F.floor(cents).cast("double").alias("ydstogo"),
        (key * 37 % 900).cast("double").alias("quarter_seconds_remaining"),
        F.col("c_acctbal").alias("ep"),
        F.when(dome, F.lit(float("nan"))).otherwise((30 + F.floor(price) % 60).cast("double")).alias("temp"),
        F.when(key % 51 == 0, F.lit(None).cast("double"))
        .when(dome, F.lit(float("nan")))
        .otherwise((key % 25).cast("double")).alias("wind"),
        label.alias("play_type"),
    )


def write_partitioned(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write plays as parquet partitioned by season (one folder per season).

    The rows are rebalanced by season: Spark joins small seasons and splits a
    large one over as many tasks as its size asks for (adaptive execution, by
    ``advisoryPartitionSizeInBytes``), so neither a task nor a file holds a
    season of any size.
    """
    df.hint("rebalance", "season").write.mode(mode).partitionBy("season").parquet(path)


def scan(spark: SparkSession, path: str, start: int, end: int, columns=None) -> DataFrame:
    """Seasons ``start`` <= season < ``end`` of a season-partitioned dataset.

    The range predicate is on the partition column, so only the matching
    season folders are listed and read (PartitionFilters in the plan).
    """
    df = spark.read.schema(PLAYS_SCHEMA).parquet(path)
    df = df.where((F.col("season") >= start) & (F.col("season") < end))
    return df.select(*columns) if columns else df


def scan_table(df: DataFrame, start: int | None = None, end: int | None = None) -> DataFrame:
    """The same season range over an already-built plays frame; an end that is None is open."""
    if start is not None:
        df = df.where(F.col("season") >= start)
    return df if end is None else df.where(F.col("season") < end)
