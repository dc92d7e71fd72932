"""Dictionary encoding against StringIndexer, with odd rows and many values."""

import pytest
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.sql import functions as F

from playlab.operators.dictionary import DictionaryIndexer, dictionary


def frame(spark):
    rows = [(i, ["b", "a", "c", "", "é"][i % 5], float(i % 7), None if i % 11 == 0 else i % 3) for i in range(400)]
    rows += [(400 + i, "hot", 1.0, 2) for i in range(300)]
    return spark.createDataFrame(rows, "id long, s string, x double, `odd.name` int").repartition(5)


def test_equals_string_indexer(spark):
    df = frame(spark)
    ours = DictionaryIndexer(["s", "x"], ["s_idx", "x_idx"]).fit(df).transform(df)
    spark_ = StringIndexer(inputCols=["s", "x"], outputCols=["s_idx", "x_idx"]).fit(df).transform(df)
    assert ours.columns == spark_.columns
    assert sorted(ours.collect(), key=str) == sorted(spark_.collect(), key=str)


def test_invalid_values(spark):
    df = frame(spark)
    new = spark.createDataFrame([(1, "a", 1.0, 1), (2, "new", 1.0, None), (3, None, 1.0, 0)], df.schema)
    index = lambda how: DictionaryIndexer(["s"], ["i"], how).fit(df).transform(new)
    assert [r.i for r in index("keep").orderBy("id").collect()][1:] == [6.0, 6.0]
    assert [r.id for r in index("skip").collect()] == [1]
    with pytest.raises(Exception, match="without an index"):
        index("error").collect()
    odd = DictionaryIndexer(["odd.name"], ["i"], "keep").fit(df).transform(df)
    assert {r.i for r in odd.where("`odd.name` is null").collect()} == {3.0}


def test_one_hot_takes_the_size_from_the_index(spark):
    df = frame(spark)
    enc = OneHotEncoder(inputCols=["i"], outputCols=["v"])
    indexed = DictionaryIndexer(["s"], ["i"]).fit(df).transform(df)
    assert enc.fit(indexed).categorySizes == [6]


def test_empty_frame_and_no_columns(spark):
    df = frame(spark)
    assert DictionaryIndexer(["s"], ["i"]).fit(df.limit(0)).transform(df.limit(0)).count() == 0
    assert DictionaryIndexer([], []).fit(df).transform(df).columns == df.columns


def test_five_million_values(spark):
    """The driver gets one row per partition and column; the index follows count, then text, over partitions."""
    n = 5_000_000
    df = spark.range(0, n + 1000, numPartitions=8).select(F.when(F.col("id") < n, F.col("id")).otherwise(n - 1).alias("v"))
    values, sizes = dictionary(df, ["v"])
    assert sizes == [n]
    row = values.agg(F.countDistinct("index").alias("d"), F.min("index").alias("lo"), F.max("index").alias("hi")).first()
    assert (row.d, row.lo, row.hi) == (n, 0.0, n - 1)
    assert values.where("index = 0").first().value == str(n - 1)
    first = [r.value for r in values.where("index between 1 and 4").orderBy("index").collect()]
    assert first == ["0", "1", "10", "100"]
