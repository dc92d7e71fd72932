"""Models as tables: scored by joins, by SQL over the written tables, and after reloading."""

import duckdb
import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from playlab.operators import model_tables as MT
from playlab.operators import models as M
from playlab.operators.optimality import gradient_table

D = 6


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(4)
    label = rng.integers(0, 3, 500)
    x = rng.normal(size=(500, D)) + np.eye(3, D)[label]
    x[rng.random((500, D)) < 0.3] = 0.0
    x[7] = 0.0  # a row without entries
    data = [(i, float(c), v) for i, (c, v) in enumerate(zip(label.tolist(), x.tolist()))]
    df = spark.createDataFrame(data, "row_id long, play_type_idx double, x array<double>").repartition(3)
    return df.select("row_id", "play_type_idx", array_to_vector("x").alias("scaledFeatures")).cache()


def predictions(df):
    return {r.row_id: r.prediction for r in df.collect()}


def by_sql(sql, path, **tables):
    con = duckdb.connect()
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(str(path / name))
        con.execute(f"create view {name} as select * from read_parquet('{path / name}/*.parquet')")
    return dict(con.execute(sql).fetchall())


def test_forest(spark, rows, tmp_path):
    model = M.classifier("rf", numTrees=7, maxDepth=4).fit(rows)
    want = predictions(model.transform(rows))
    table = MT.forest_table(spark, model)
    assert table.where("feature = -1 and votes is null").count() == 0
    assert predictions(MT.score_forest(table, rows, "scaledFeatures", "row_id", 7, 4)) == want
    entries = MT.entries(rows, "scaledFeatures", "row_id")
    got = by_sql("""
        with recursive walk as (
            select k.row_id, n.tree, n.node from keys k, nodes n where n.node = 0
            union all
            select w.row_id, w.tree, case when coalesce(e.value, 0.0) <= n.threshold then n."left" else n."right" end
            from walk w join nodes n on n.tree = w.tree and n.node = w.node and n.feature >= 0
            left join entries e on e.row_id = w.row_id and e.slot = n.feature),
        leaves as (select w.row_id, n.votes from walk w join nodes n on n.tree = w.tree and n.node = w.node and n.feature = -1),
        sums as (select row_id, c, sum(votes[c + 1]) as v from leaves, unnest(range(3)) as u(c) group by row_id, c)
        select row_id, cast(c as double) from sums qualify row_number() over (partition by row_id order by v desc, c) = 1""",
                 tmp_path, nodes=table, entries=entries, keys=rows.select("row_id"))
    assert sum(got[k] != want[k] for k in want) == 0


def test_network(spark, rows, tmp_path):
    model = M.classifier("mlp", layers=[D, 5, 4, 3], maxIter=30).fit(rows)
    want = predictions(model.transform(rows))
    table, entries = MT.network_table(spark, model), MT.entries(rows, "scaledFeatures", "row_id")
    assert predictions(MT.score_network(table, entries, rows, "row_id", 3)) == want
    layer = lambda i, before: f"""
        z{i} as (select a.row_id, w.target as source, sum(a.value * w.weight) as z
                 from (select row_id, source, value from {before} union all select row_id, -1, 1.0 from keys) a
                 join weights w on w.source = a.source and w.layer = {i} group by a.row_id, w.target),
        a{i} as (select row_id, source, 1 / (1 + exp(-z)) as value from z{i})"""  # noqa: E731
    got = by_sql(f"""with a as (select row_id, slot as source, value from entries), {layer(0, "a")}, {layer(1, "a0")}, {layer(2, "a1")}
                     select row_id, cast(source as double) from z2
                     qualify row_number() over (partition by row_id order by z desc, source) = 1""",
                 tmp_path, weights=table, entries=entries, keys=rows.select("row_id"))
    assert got == want


def test_network_loss_falls(rows):
    """The objective the fit reports falls over its iterations, and more iterations fit better."""
    long = M.classifier("mlp", layers=[D, 5, 3], maxIter=60, solver="l-bfgs").fit(rows).summary()
    history = list(long.objectiveHistory)
    assert len(history) > 5 and history[-1] < history[0]
    assert all(b <= a + 1e-9 for a, b in zip(history, history[1:]))


def test_linear_versions(spark, rows, tmp_path):
    root = str(tmp_path / "models")
    with pytest.raises(FileNotFoundError):
        MT.load_version(spark, root)
    want = {}
    for reg in (0.01, 0.5):
        model = M.classifier("lr", maxIter=40, regParam=reg).fit(rows)
        v = MT.save_version(spark, root, {"linear": MT.linear_table(spark, model)}, {"regParam": reg})
        want[v] = predictions(model.transform(rows))
    spark.range(1).write.parquet(root + "/v3/linear")  # cut off before its description
    other = spark.newSession()
    entries = MT.entries(rows, "scaledFeatures", "row_id")
    for version in (1, 2, None):
        tables, description = MT.load_version(other, root, version)
        assert description["regParam"] == {1: 0.01, 2: 0.5, None: 0.5}[version]
        linear = spark.read.schema(tables["linear"].schema).parquet(f"{root}/v{version or 2}/linear")
        assert predictions(MT.score_linear(linear, entries, rows, "row_id")) == want[version or 2]
    got = by_sql("""with s as (select k.row_id, b.class, b.weight + coalesce(sum(e.value * w.weight), 0.0) as v
                               from keys k join linear b on b.slot = -1
                               left join entries e on e.row_id = k.row_id left join linear w on w.class = b.class and w.slot = e.slot
                               group by k.row_id, b.class, b.weight)
                    select row_id, cast(class as double) from s qualify row_number() over (partition by row_id order by v desc, class) = 1""",
                 tmp_path, linear=MT.load_version(spark, root, 2)[0]["linear"], entries=entries, keys=rows.select("row_id"))
    assert got == want[2]


def test_two_classes(spark, rows):
    two = rows.where("play_type_idx < 2")
    model = M.classifier("lr", maxIter=20).fit(two)
    got = MT.score_linear(MT.linear_table(spark, model), MT.entries(two, "scaledFeatures", "row_id"), two, "row_id")
    assert predictions(got) == predictions(model.transform(two))


def test_gradient_tells_a_fit_from_a_start(spark, rows):
    good = gradient_table(M.classifier("lr", maxIter=300, tol=1e-9, regParam=0.02).fit(rows), rows)
    poor = gradient_table(M.classifier("lr", maxIter=1, regParam=0.02).fit(rows), rows)
    worst = lambda t: t.agg(F.max(F.abs("gradient"))).first()[0]
    assert good.count() == 3 * (D + 1) and worst(good) < 1e-4 < 1e-2 < worst(poor)
    share = rows.groupBy("play_type_idx").count().collect()
    have = {r.class_index: r.observed for r in good.where("feature = -1").collect()}
    assert all(abs(have[int(r.play_type_idx)] - r["count"] / 500) < 1e-12 for r in share)
    with pytest.raises(ValueError):
        gradient_table(M.classifier("lr", regParam=0.1, elasticNetParam=0.5).fit(rows), rows)
