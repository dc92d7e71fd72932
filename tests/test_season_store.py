"""The season store writes what changed, and nothing else."""

import pyspark.sql.functions as F
import pytest

from playlab.operators.aggregates import nan_mean_value
from playlab.operators.sampling import StratifiedSplit
from playlab.plans.prepare import cleaned, prepare
from playlab.sources.plays import plays
from playlab.sources.season_store import SeasonStore

SF001 = "/root/testdata/sf0.001"


@pytest.fixture()
def table(spark):
    return plays(spark, SF001).where("season < 1998").cache()


def rows(df):
    return sorted(map(repr, df.collect()))


def test_unchanged_table_writes_nothing(spark, table, tmp_path):
    store = SeasonStore(spark, str(tmp_path))
    seasons = sorted(r.season for r in table.select("season").distinct().collect())
    assert store.refresh(table) == seasons
    before = sorted(p.name for p in tmp_path.rglob("*"))
    assert SeasonStore(spark, str(tmp_path)).refresh(table.repartition(7)) == []  # as another application would
    assert sorted(p.name for p in tmp_path.rglob("*")) == before
    assert rows(store.scan()) == rows(table)


def test_changed_season_writes_one_folder(spark, table, tmp_path):
    store = SeasonStore(spark, str(tmp_path))
    store.refresh(table)
    key = table.where("season = 1996").agg(F.min("row_id")).first()[0]
    new = table.withColumn("wind", F.when(F.col("row_id") == key, F.lit(None).cast("double")).otherwise(F.col("wind")))
    new = new.withColumn("ep", F.when(F.col("row_id") == key, 1.5).otherwise(F.col("ep")))
    known = {p.name for p in tmp_path.glob("version=*")}
    assert store.refresh(new) == [1996]
    added = [p for p in tmp_path.glob("version=*") if p.name not in known]
    assert [q.name for p in added for q in p.glob("season=*")] == ["season=1996"]
    assert rows(store.scan()) == rows(new)  # nothing stale, in this reader or another
    assert rows(SeasonStore(spark, str(tmp_path)).scan(1996, 1997)) == rows(new.where("season = 1996"))


def test_null_moved_between_columns_is_seen(spark, table, tmp_path):
    one = table.limit(1).select(*[F.lit(None).cast("double").alias(c) if c == "wind" else F.lit(2.0).alias(c) if c == "temp"
                                  else F.col(c) for c in table.columns])
    other = one.withColumn("wind", F.lit(2.0)).withColumn("temp", F.lit(None).cast("double"))
    store = SeasonStore(spark, str(tmp_path))
    assert len(store.refresh(one)) == 1 and len(store.refresh(other)) == 1
    assert rows(store.scan()) == rows(other)


def test_gone_null_repeated_and_empty(spark, table, tmp_path):
    store = SeasonStore(spark, str(tmp_path))
    odd = table.unionByName(table.where("season = 1995")).withColumn(
        "season", F.when(F.col("season") == 1997, F.lit(None).cast("int")).otherwise(F.col("season")))
    store.refresh(odd)
    assert rows(store.scan()) == rows(odd)
    assert store.scan(1900, 2100).where("season is null").count() == 0
    store.refresh(table.where("season = 1996"))
    assert rows(store.scan()) == rows(table.where("season = 1996"))
    store.refresh(table.limit(0))
    assert store.manifest() == {} and store.scan().count() == 0
    assert store.refresh(table.limit(0)) == []


def test_unfinished_refresh_leaves_the_state_before(spark, table, tmp_path):
    store = SeasonStore(spark, str(tmp_path))
    store.refresh(table)
    want = rows(store.scan())
    broken = tmp_path / "manifest" / "000000000009-cut"  # a manifest whose job never committed
    broken.mkdir()
    (broken / "part-0.parquet").write_bytes(b"")
    assert rows(store.scan()) == want


def test_scan_lists_only_its_seasons(spark, table, tmp_path):
    store = SeasonStore(spark, str(tmp_path))
    store.refresh(table)
    files = store.scan(1996, 1997).inputFiles()
    assert files and all("season=1996" in f for f in files)


def test_prepare_observes_what_a_second_read_would_find(spark):
    df = plays(spark, SF001)
    prep = prepare(df)
    sample = StratifiedSplit().sample(cleaned(df))
    assert prep.fill["temp"] == pytest.approx(nan_mean_value(sample, "temp"), abs=1e-9)
    counts = {r["play_type"]: r["count"] for r in sample.groupBy("play_type").count().collect()}
    assert {c: n for c, n in prep.class_counts.items() if n} == counts


def test_prepare_reads_the_plays_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = plays(spark, SF001)
    total = df.count()
    prep = prepare(df.mapInArrow(count, df.schema))
    prep.train.count(), prep.test.count()
    assert seen.value == total


def test_prepare_on_an_empty_table_and_all_seasons(spark):
    df = plays(spark, SF001)
    empty = prepare(df.limit(0))
    assert empty.fill == {"wind": 0.0, "temp": 0.0} and empty.train.count() == 0
    later = df.withColumn("season", F.col("season") + 40)
    assert prepare(later).test.count() == prepare(df).test.count() > 0
