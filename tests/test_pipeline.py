"""Invariants of the data pipeline on the driver tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from playlab.operators import sampling as R
from playlab.operators import smotenc as SM
from playlab.plans import oracle as O
from playlab.plans.prepare import cleaned, prepare
from playlab.sources.plays import plays

from conftest import SF001, SF01


def _keys(df, key="row_id"):
    return sorted(r[0] for r in df.select(key).collect())


def test_fixture_counts(spark):
    df = plays(spark, SF01)
    assert df.count() == 15000
    fourth = df.where(F.col("down") == 4.0)
    assert fourth.count() == 3750
    clean = cleaned(df)
    counts = {r.play_type: r["count"] for r in clean.groupBy("play_type").count().collect()}
    assert counts == {"punt": 1989, "field_goal": 938, "pass": 326, "run": 212, "no_play": 129}


def test_train_test_disjoint_and_complete(spark):
    df = plays(spark, SF001)
    prep = prepare(df)
    rows, train, test = _keys(cleaned(df)), _keys(prep.train), _keys(prep.test)
    assert not set(train) & set(test)
    assert sorted(train + test) == rows
    # the reference order leaks filled rows back into test
    leaky = prepare(df, reference_order=True)
    assert set(_keys(leaky.test)) & set(train)


@pytest.mark.parametrize("parts", [1, 7, 64])
def test_hash_operators_ignore_partitioning(spark, parts):
    rows = cleaned(plays(spark, SF001))
    base = _keys(R.sample_by(rows))
    re = rows.repartition(parts)
    assert _keys(R.sample_by(re)) == base
    assert _keys(R.tv_split(re)[0]) == _keys(R.tv_split(rows)[0])
    assert _keys(R.undersample(re, rounds=2)) == _keys(R.undersample(rows, rounds=2))


def test_undersample_counts(spark):
    train = prepare(plays(spark, SF01)).train
    n = {r.play_type: r["count"] for r in train.groupBy("play_type").count().collect()}
    cut = {r.play_type: r["count"] for r in R.undersample(train, rounds=2).groupBy("play_type").count().collect()}
    order = sorted(n, key=lambda c: (-n[c], c))
    low = min(n.values())
    assert cut[order[0]] == low and cut[order[1]] == low
    assert all(cut[c] == n[c] for c in order[2:])


@pytest.mark.parametrize("inline", [10_000, 0])
def test_mark_smallest_refines_its_bins(spark, monkeypatch, inline):
    """Radix selection: the boundary bin is refined until it holds few rows; the rows chosen stay the same."""
    monkeypatch.setattr(R, "MAX_INLINE_CLASSES", inline)
    train = prepare(plays(spark, SF001)).train
    want = {"punt": 40, "field_goal": 11, "pass": 10 ** 9}
    plain = _keys(R.mark_smallest(train, "play_type", "row_id", "x", 42, want, "_s").where("_s"))
    dg = {}
    fine = _keys(R.mark_smallest(train, "play_type", "row_id", "x", 42, want, "_s", bits=2, most=1, diagnostics=dg).where("_s"))
    assert fine == plain and dg["ranked"] <= 1 and dg["bits"] > 2


def test_mark_smallest_of_one_class_of_ten_million(spark):
    n, want = 10_000_000, 4_321_987
    df = spark.range(0, n, numPartitions=8).select(F.col("id").alias("row_id"), F.lit("x").alias("play_type"))
    dg = {}
    out = R.mark_smallest(df, "play_type", "row_id", "big", 42, {"x": want}, "_s", bits=8, most=20, diagnostics=dg)
    assert dg["ranked"] <= 20 and dg["bits"] == 24
    h = R.uniform_hash("row_id", "big", 42)
    row = out.groupBy("_s").agg(F.count(F.lit(1)).alias("n"), F.min(h).alias("lo"), F.max(h).alias("hi")).collect()
    by = {r._s: r for r in row}
    assert by[True].n == want and by[False].n == n - want and by[True].hi <= by[False].lo


def test_mark_smallest_with_small_bins(spark):
    train = prepare(plays(spark, SF01)).train
    want = {"punt": 100, "field_goal": 5000, "pass": 0}
    a = R.mark_smallest(train, "play_type", "row_id", "x", 42, want, "_s", bits=16).where("_s")
    b = R.mark_smallest(train, "play_type", "row_id", "x", 42, want, "_s", bits=2).where("_s")
    assert _keys(a) == _keys(b)
    got = {r.play_type: r["count"] for r in a.groupBy("play_type").count().collect()}
    assert got["punt"] == 100 and got["field_goal"] == train.where("play_type = 'field_goal'").count()
    assert "pass" not in got


@pytest.mark.parametrize("cell_rows,max_pivots,pivot_prune_min", [
    (8, SM.MAX_PIVOTS, 4096), (4, 7, 4096), (6, SM.MAX_PIVOTS, 0)])
def test_smotenc_cells_match_one_block(spark, cell_rows, max_pivots, pivot_prune_min):
    train = prepare(plays(spark, SF001)).train.cache()
    one = SM.smotenc(train, categorical=O.SMOTE_CATS, numeric=O.SMOTE_NUMS, cell_rows=10 ** 6)
    many = SM.smotenc(train, categorical=O.SMOTE_CATS, numeric=O.SMOTE_NUMS, cell_rows=cell_rows,
                      max_pivots=max_pivots, pivot_prune_min=pivot_prune_min)
    cols = ["row_id", "synth"] + O.SMOTE_NUMS + O.SMOTE_CATS + ["play_type"]
    a = sorted(tuple(r) for r in one.select(*cols).collect())
    b = sorted(tuple(r) for r in many.select(*cols).collect())
    assert a == b


def test_smotenc_invariants(spark):
    train = prepare(plays(spark, SF001)).train
    out = SM.smotenc(train, categorical=O.SMOTE_CATS, numeric=O.SMOTE_NUMS, cell_rows=16)
    counts = {r.play_type: r["count"] for r in out.groupBy("play_type").count().collect()}
    assert len(set(counts.values())) == 1                  # every class raised to the largest
    syn = out.where("synth > 0").alias("s")
    base = train.alias("b")
    j = syn.join(base, F.col("s.row_id") == F.col("b.row_id"))
    # each synthetic numeric value lies between the base value and some class member: check the range
    rng = train.groupBy("play_type").agg(*[F.min(c).alias(f"lo_{c}") for c in O.SMOTE_NUMS],
                                          *[F.max(c).alias(f"hi_{c}") for c in O.SMOTE_NUMS])
    chk = syn.join(rng, "play_type")
    for c in O.SMOTE_NUMS:
        assert chk.where((F.col(c) < F.col(f"lo_{c}") - 1e-9) | (F.col(c) > F.col(f"hi_{c}") + 1e-9)).count() == 0
    # synthetic categories exist in their class
    for c in O.SMOTE_CATS:
        assert syn.join(train.select("play_type", c).distinct(), ["play_type", c], "left_anti").count() == 0
    assert j.count() == syn.count()
    # (row_id, synth) is unique
    assert out.select("row_id", "synth").distinct().count() == out.count()


def test_smotenc_rejects_nan(spark):
    rows = cleaned(plays(spark, SF001))
    with pytest.raises(ValueError):
        SM.smotenc(rows, categorical=O.SMOTE_CATS, numeric=O.SMOTE_NUMS)


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())


def test_smotenc_exact_comparisons_do_not_grow(spark):
    """Rows compared exactly per query stay near k, whatever the rows (8 dimensions, normal data)."""
    per_query = []
    for n in (1000, 4000):
        rng = np.random.default_rng(n)
        x, cats = rng.normal(size=(n, 6)), rng.integers(0, 3, (n, 2))
        rows = [(i, "small", *map(float, x[i]), *(f"c{v}" for v in cats[i])) for i in range(n)]
        rows += [(n + i, "large", *[float(i)] * 6, "c0", "c0") for i in range(2 * n)]
        nums, names = [f"x{j}" for j in range(6)], ["a", "b"]
        df = spark.createDataFrame(rows, "row_id long, play_type string, " + ", ".join(f"{c} double" for c in nums)
                                   + ", a string, b string")
        dg = {}
        SM.smotenc(df, categorical=names, numeric=nums, cell_rows=200, diagnostics=dg)
        per_query.append(dg["exact"] / dg["queries"])
    assert 5 <= per_query[0] <= 10 and per_query[1] <= 1.5 * per_query[0]


def test_smotenc_tiny_classes(spark):
    rows = [(1, "a", 1.0, "x"), (2, "a", 2.0, "y"), (3, "a", 3.0, "x"), (4, "a", 4.0, "x"),
            (5, "b", 10.0, "y"), (6, "b", 20.0, "z"), (7, "c", 5.0, "q")]
    df = spark.createDataFrame(rows, "row_id long, play_type string, v double, cat string")
    out = SM.smotenc(df, categorical=["cat"], numeric=["v"], cell_rows=1)
    got = {r.play_type: r["count"] for r in out.groupBy("play_type").count().collect()}
    assert got == {"a": 4, "b": 4, "c": 4}
    # a single-row class is copied; a two-row class interpolates towards its other row
    c_rows = out.where("play_type = 'c'").collect()
    assert {(r.v, r.cat) for r in c_rows} == {(5.0, "q")}
    for r in out.where("play_type = 'b' and synth > 0").collect():
        assert 10.0 <= r.v <= 20.0
        assert r.cat == ("z" if r.row_id == 5 else "y")


@pytest.mark.parametrize("parts", [1, 7])
def test_smotenc_ignores_partitioning(spark, parts):
    train = prepare(plays(spark, SF001)).train
    cols = ["row_id", "synth"] + O.SMOTE_NUMS + O.SMOTE_CATS + ["play_type"]
    base = SM.smotenc(train, categorical=O.SMOTE_CATS, numeric=O.SMOTE_NUMS, cell_rows=20)
    other = SM.smotenc(train.repartition(parts), categorical=O.SMOTE_CATS, numeric=O.SMOTE_NUMS, cell_rows=20)
    assert sorted(tuple(r) for r in base.select(*cols).collect()) == \
        sorted(tuple(r) for r in other.select(*cols).collect())


def test_smotenc_copy_groups(spark):
    # the training rows plus nine copies of each punt and pass row (new keys)
    train = prepare(plays(spark, SF001)).train
    extra = None
    for i in range(1, 10):
        part = train.where("play_type in ('punt', 'pass')").withColumn("row_id", F.col("row_id") * 100 + i)
        extra = part if extra is None else extra.unionByName(part)
    df = train.unionByName(extra).cache()
    cols = ["row_id", "synth"] + O.SMOTE_NUMS + O.SMOTE_CATS + ["play_type"]
    dg = {}
    fast = SM.smotenc(df, categorical=O.SMOTE_CATS, numeric=O.SMOTE_NUMS, cell_rows=50, diagnostics=dg)
    plain = SM.smotenc(df, categorical=O.SMOTE_CATS, numeric=O.SMOTE_NUMS, cell_rows=50, copy_groups=False)
    assert dg["copy_queries"] > 0
    assert sorted(tuple(r) for r in fast.select(*cols).collect()) == \
        sorted(tuple(r) for r in plain.select(*cols).collect())


def test_many_classes_join_path_matches_inline(spark, monkeypatch):
    train = prepare(plays(spark, SF01)).train
    want = {"punt": 100, "field_goal": 5000, "pass": 0, "run": 7}
    inline = _keys(R.mark_smallest(train, "play_type", "row_id", "x", 42, want, "_s").where("_s"))
    cut_inline = _keys(R.undersample(train, rounds=2))
    monkeypatch.setattr(R, "MAX_INLINE_CLASSES", 1)
    joined = _keys(R.mark_smallest(train, "play_type", "row_id", "x", 42, want, "_s").where("_s"))
    assert joined == inline
    assert _keys(R.undersample(train, rounds=2)) == cut_inline


def test_keyless_ranking_with_copies(spark):
    train = prepare(plays(spark, SF001)).train.drop("row_id")
    copies = train.where("play_type = 'punt'").limit(1)
    df = train
    for _ in range(6):  # one punt row repeated: 64 extra copies
        copies = copies.unionByName(copies)
    df = train.unionByName(copies).cache()
    n = {r.play_type: r["count"] for r in df.groupBy("play_type").count().collect()}
    want = {"punt": n["punt"] // 2, "field_goal": 3}
    out = R.mark_smallest(df, "play_type", None, "x", 42, want, "_s", bits=1)
    got = {r.play_type: r["count"] for r in out.where("_s").groupBy("play_type").count().collect()}
    assert got == want
    assert out.count() == df.count()
    # the same rows whatever the partitioning
    a = sorted(tuple(r) for r in out.where("_s").collect())
    b = sorted(tuple(r) for r in R.mark_smallest(df.repartition(5), "play_type", None, "x", 42, want, "_s",
                                                 bits=1).where("_s").collect())
    assert a == b
