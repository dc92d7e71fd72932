"""Query registry: one entry per operator of the inventory.

Each query is ``fn(spark, sf_dir) -> DataFrame`` over the driver's tables
(``plays`` derived from orders and customer) and, where the result is
expressible in plain SQL, an oracle statement with the same column names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlab.functions.columns import (
    FIRST_SEASON, HOLDOUT_SEASON, KEY, LABEL, NULL_CHECKED, REFERENCE_COLUMNS,
)
from playlab.functions.rules import rule_predictions
from playlab.operators import aggregates as A
from playlab.operators import clean as P
from playlab.operators import evaluate as E
from playlab.operators import features as FE
from playlab.operators import model_tables as MT
from playlab.operators import models as M
from playlab.operators import sampling as R
from playlab.operators import smotenc as SM
from playlab.operators.optimality import gradient_table
from playlab.plans import oracle as O
from playlab.plans.prepare import base_frame, cleaned, prepare, season_test, training_fill
from playlab.session import materialize, shared_dir, stable_dir
from playlab.sources import io as S
from playlab.sources.plays import plays
from playlab.sources.season_store import SeasonStore

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return wrap


def r6(c):
    return F.round(c if not isinstance(c, str) else F.col(c), 6)


def _fourth(spark, d):
    return P.fourth_down(plays(spark, d))


def _clean(spark, d):
    return cleaned(plays(spark, d))


def _split():
    return R.StratifiedSplit()


# ---------------------------------------------------------------- sources
def _seasons(spark, d) -> SeasonStore:
    """The plays as a season-partitioned dataset below the shared folder, brought up to date.

    It outlives the application: only seasons that changed since are written.
    """
    base = stable_dir(spark, "plays-by-season", d)
    store = SeasonStore(spark, base)
    store.refresh(plays(spark, d))
    return store


@query("season_scan", O.with_base(
    f"select * from plays where season >= {FIRST_SEASON} and season < {HOLDOUT_SEASON}"))
def q_season_scan(spark, d):
    return _seasons(spark, d).scan(FIRST_SEASON, HOLDOUT_SEASON)


@query("single_season_scan", O.with_base(f"select * from plays where season = {HOLDOUT_SEASON}"))
def q_single_season_scan(spark, d):
    return _seasons(spark, d).scan(HOLDOUT_SEASON, HOLDOUT_SEASON + 1)


def _profile_sql():
    parts = []
    for c in O.PLAY_COLS:
        nan = f"count(*) filter (where isnan({c}))" if c in (
            "down", "ydstogo", "quarter_seconds_remaining", "ep", "temp", "wind") else "cast(0 as bigint)"
        parts.append(f"select '{c}' as column_name, count(*) filter (where {c} is null) as null_count, "
                     f"{nan} as nan_count from plays")
    return O.with_base(" union all ".join(parts))


@query("nan_null_profile", _profile_sql())
def q_nan_null_profile(spark, d):
    return S.profile(plays(spark, d))


_REPORT_COLS = ["row_id", "posteam", "season", "ydstogo", "quarter_seconds_remaining", "play_type"]
_REPORT_SCHEMA = T.StructType([
    T.StructField("row_id", T.LongType()), T.StructField("posteam", T.StringType()),
    T.StructField("season", T.IntegerType()), T.StructField("ydstogo", T.DoubleType()),
    T.StructField("quarter_min_remaining", T.DoubleType()), T.StructField("play_type", T.StringType()),
])


@query("csv_export", O.with_base(
    "select row_id, posteam, season, ydstogo, round(quarter_seconds_remaining / 60, 2) as "
    "quarter_min_remaining, play_type from clean where posteam = 'T7' and season = '2000'"))
def q_csv_export(spark, d):
    rep = P.report(P.team_season(_clean(spark, d), "T7", "2000"), _REPORT_COLS)
    path = S.write_csv(rep, shared_dir(spark, "csv-export"))
    return S.read_csv(spark, path, _REPORT_SCHEMA)


@query("top_rows", O.with_base("select * from clean order by row_id limit 10"))
def q_top_rows(spark, d):
    return S.head(_clean(spark, d), 10, KEY)


# ---------------------------------------------------------------- projections and filters
_PROJ = [c for c in [KEY] + REFERENCE_COLUMNS if c in O.PLAY_COLS]


@query("project_existing", O.with_base(f"select {', '.join(_PROJ)} from plays"))
def q_project_existing(spark, d):
    return P.project(plays(spark, d), [KEY] + REFERENCE_COLUMNS)


@query("filter_fourth_down", O.with_base("select * from fourth"))
def q_filter_fourth_down(spark, d):
    return _fourth(spark, d)


@query("not_null_named", O.with_base(
    "select * from fourth where play_type is not null and temp is not null and wind is not null"))
def q_not_null_named(spark, d):
    return P.require_not_null(_fourth(spark, d), NULL_CHECKED)


@query("not_null_all", O.with_base(
    "select * from fourth where " + " and ".join(f"{c} is not null" for c in O.PLAY_COLS)))
def q_not_null_all(spark, d):
    return P.require_not_null(_fourth(spark, d))


@query("not_nan_named", O.with_base(
    "select * from fourth where temp is not null and not isnan(temp) "
    "and wind is not null and not isnan(wind)"))
def q_not_nan_named(spark, d):
    return P.require_value(_fourth(spark, d), ["temp", "wind"])


@query("exclude_label", O.with_base("select * from fourth where play_type <> 'qb_kneel'"))
def q_exclude_label(spark, d):
    return P.exclude(_fourth(spark, d))


@query("drop_columns", O.with_base("select * exclude (season) from clean"))
def q_drop_columns(spark, d):
    return P.drop_columns(_clean(spark, d), "season")


@query("select_by_dtype", O.with_base(
    "select row_id, quarter_seconds_remaining, down, ydstogo, ep, wind, temp from clean"))
def q_select_by_dtype(spark, d):
    return P.select_by_dtype(_clean(spark, d))


@query("blank_to_undefined", O.with_base(
    "select * replace (case when surface = '' then 'Undefined' else surface end as surface) from fourth"))
def q_blank_to_undefined(spark, d):
    return P.blank_to(_fourth(spark, d), "surface")


@query("minutes_remaining", O.with_base(
    "select row_id, posteam, ydstogo, round(quarter_seconds_remaining / 60, 2) as quarter_min_remaining, "
    "play_type, season from clean"))
def q_minutes_remaining(spark, d):
    return P.report(_clean(spark, d), ["row_id", "posteam", "ydstogo", "quarter_seconds_remaining",
                                       "play_type", "season"])


@query("team_season_filter", O.with_base("select * from clean where posteam = 'T7' and season = '2000'"))
def q_team_season_filter(spark, d):
    return P.team_season(_clean(spark, d), "T7", "2000")


@query("nan_to_const", O.with_base(
    "select row_id, case when isnan(wind) then 0.0 else wind end as wind from fourth"))
def q_nan_to_const(spark, d):
    return P.nan_to(_fourth(spark, d), "wind", 0.0).select(KEY, "wind")


@query("label_last", O.with_base(
    "select * exclude (play_type), play_type from clean"))
def q_label_last(spark, d):
    return P.label_last(_clean(spark, d))


# ---------------------------------------------------------------- aggregates
@query("nan_safe_mean", O.with_base("select round(m, 6) as temp_mean from tmean"))
def q_nan_safe_mean(spark, d):
    return A.nan_mean(_split().sample(_clean(spark, d)), "temp").select(r6("temp_mean").alias("temp_mean"))


@query("impute", O.with_base("select row_id, wind, round(temp, 6) as temp from train"))
def q_impute(spark, d):
    sample = _split().sample(_clean(spark, d))
    return A.impute(sample, training_fill(sample)).select(KEY, "wind", r6("temp").alias("temp"))


@query("rounded_mean", O.with_base(
    "select round(avg(case when not isnan(temp) then temp end), 2) as temp_mean from fourth"))
def q_rounded_mean(spark, d):
    return A.rounded_mean(_fourth(spark, d), "temp")


@query("count_by_key", O.with_base("select play_type, count(*) as n from clean group by play_type"))
def q_count_by_key(spark, d):
    return A.count_by(_clean(spark, d), LABEL)


@query("count_by_pair", O.with_base(
    "select play_type, play_type_idx, count(*) as n from pred group by play_type, play_type_idx",
    O.rule_ctes("clean")))
def q_count_by_pair(spark, d):
    return A.count_by(rule_predictions(_clean(spark, d)), LABEL, "play_type_idx")


@query("distinct_values", O.with_base("select distinct surface from clean"))
def q_distinct_values(spark, d):
    return A.distinct_values(_clean(spark, d), "surface")


@query("value_counts", O.with_base(
    "select surface, count(*) as n from fourth where surface is not null group by surface "
    "order by n desc, surface"))
def q_value_counts(spark, d):
    return A.value_counts(_fourth(spark, d), "surface")


def _null_counts_sql():
    floats = {"down", "ydstogo", "quarter_seconds_remaining", "ep", "temp", "wind"}
    parts = []
    for c in O.PLAY_COLS:
        cond = f"{c} is null or isnan({c})" if c in floats else f"{c} is null"
        parts.append(f"select '{c}' as column_name, count(*) filter (where {cond}) as n_missing from fourth")
    return O.with_base(" union all ".join(parts))


@query("null_counts", _null_counts_sql())
def q_null_counts(spark, d):
    return A.null_counts(_fourth(spark, d))


def _column_list_sql():
    parts = [f"select {i} as position, '{c}' as column_name, count({c}) as n_non_null from train"
             for i, c in enumerate(O.CLEAN_COLS)]
    return O.with_base(" union all ".join(parts))


@query("column_list", _column_list_sql())
def q_column_list(spark, d):
    return A.column_list(prepare(plays(spark, d)).train)


# ---------------------------------------------------------------- sampling and splitting
@query("stratified_sample", O.with_base("select * from sampled"))
def q_stratified_sample(spark, d):
    return R.sample_by(_clean(spark, d))


@query("stratified_sample_native")
def q_stratified_sample_native(spark, d):
    return R.sample_by(_clean(spark, d), method="native")


@query("sample_remainder", O.with_base("select * from clean except select * from sampled"))
def q_sample_remainder(spark, d):
    rows = _clean(spark, d)
    return R.remainder(rows, _split().sample(rows))


@query("sample_remainder_keyed", O.with_base("select * from rest"))
def q_sample_remainder_keyed(spark, d):
    return _split().remainder(_clean(spark, d))


@query("leaky_remainder", O.with_base(
    "select * from (select * from clean except select * from train)",))
def q_leaky_remainder(spark, d):
    rows = _clean(spark, d)
    sample = _split().sample(rows)
    return R.remainder(rows, A.impute(sample, training_fill(sample)))


@query("season_holdout", O.with_base(
    f"select * exclude (season), 'train' as split from clean where season < {HOLDOUT_SEASON} "
    f"union all select * exclude (season), 'test' as split from clean where season = {HOLDOUT_SEASON}"))
def q_season_holdout(spark, d):
    train, test = R.season_split(_clean(spark, d), HOLDOUT_SEASON)
    return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))


@query("train_validation_split", O.with_base(
    f"select *, case when {O.h('row_id', 'split')} < 0.8 * 4294967296.0 then 'train' "
    "else 'validation' end as split from clean"))
def q_train_validation_split(spark, d):
    train, val = R.tv_split(_clean(spark, d), 0.8, 42)
    return train.withColumn("split", F.lit("train")).unionByName(val.withColumn("split", F.lit("validation")))


def _undersample_sql(rounds: int) -> str:
    ranked = f"""
counts as (select play_type, count(*) as n from train group by play_type),
ranked as (select play_type, n, row_number() over (order by n desc, play_type) as rk,
                  min(n) over () as n_min from counts),
targets as (select play_type, case when rk <= {rounds} then n_min else n end as target from ranked),
ordered as (select t.*, row_number() over (partition by t.play_type
              order by {O.h('t.row_id', 'rank')}, t.row_id) as rn from train t)"""
    body = ("select o.* exclude (rn) replace (round(o.temp, 6) as temp) from ordered o "
            "join targets g on o.play_type = g.play_type where o.rn <= g.target")
    return O.with_base(body, ranked)


@query("undersample_majority", _undersample_sql(1))
def q_undersample_majority(spark, d):
    out = R.undersample(prepare(plays(spark, d)).train, rounds=1)
    return out.withColumn("temp", r6("temp"))


@query("undersample_twice", _undersample_sql(2))
def q_undersample_twice(spark, d):
    out = R.undersample(prepare(plays(spark, d)).train, rounds=2)
    return out.withColumn("temp", r6("temp"))


# ---------------------------------------------------------------- compositions
@query("base_frame", O.with_base(
    """select * replace (round(temp, 6) as temp) from (
         select * replace (case when wind is null or isnan(wind) then 0.0 else wind end as wind,
                           case when temp is null or isnan(temp) then (select m from bm) else temp end as temp)
         from bs)""",
    f"""bclean as (select {', '.join(O.CLEAN_COLS)} from plays
          where season >= 1995 and season < 2002 and down = 4.0 and play_type is not null
            and temp is not null and wind is not null and play_type <> 'qb_kneel'),
bs as (select * from bclean where {O.IN_SAMPLE}),
bm as (select avg(case when not isnan(temp) then temp end) as m from bs)"""))
def q_base_frame(spark, d):
    return base_frame(plays(spark, d)).withColumn("temp", r6("temp"))


@query("season_test_frame", O.with_base(f"select * from clean where season = {HOLDOUT_SEASON}"))
def q_season_test_frame(spark, d):
    return season_test(plays(spark, d), HOLDOUT_SEASON)


# ---------------------------------------------------------------- evaluation (rule predictions)

_RULE = O.rule_ctes("clean")


def _pred(spark, d):
    return rule_predictions(_clean(spark, d))


def _metric_query(name: str, column: str):
    sql = O.with_base(f"select {column} from ({O.metric_select()})", _RULE + "," + O.metric_ctes("pred"))

    @query(name, sql)
    def q(spark, d):
        return E.metrics(_pred(spark, d)).select(r6(column).alias(column))
    q.__name__ = f"q_{name}"
    return q


_metric_query("accuracy", "accuracy")
_metric_query("weighted_f1", "f1")
_metric_query("precision_by_label", "precision_by_label")
_metric_query("weighted_precision", "weighted_precision")
_metric_query("weighted_recall", "weighted_recall")


@query("metric_report", O.with_base(
    f"select 'all' as frame, * from ({O.metric_select()}) "
    f"union all select 'holdout' as frame, * from ({O.metric_select('_h')})",
    _RULE + "," + O.metric_ctes("pred") + ","
    + O.metric_ctes(f"(select * from pred where season = {HOLDOUT_SEASON})", "_h")))
def q_metric_report(spark, d):
    pred = _pred(spark, d)
    return E.metric_report({"all": F.lit(True), "holdout": F.col("season") == HOLDOUT_SEASON}, pred=pred)


@query("confusion_matrix", O.with_base(
    "select play_type_idx as actual, prediction as predicted, count(*) as n from pred group by 1, 2", _RULE))
def q_confusion_matrix(spark, d):
    return E.confusion_matrix(_pred(spark, d))


@query("predicted_distribution", O.with_base(
    "select prediction, count(*) as n from pred group by prediction", _RULE))
def q_predicted_distribution(spark, d):
    return A.count_by(_pred(spark, d), "prediction")


@query("actual_distribution", O.with_base(
    "select play_type_idx, count(*) as n from pred group by play_type_idx", _RULE))
def q_actual_distribution(spark, d):
    return A.count_by(_pred(spark, d), "play_type_idx")


@query("label_index_map", O.with_base(
    "select distinct play_type, play_type_idx from pred", _RULE))
def q_label_index_map(spark, d):
    return A.label_index_map(_pred(spark, d))


@query("misclassified", O.with_base(
    "select row_id, posteam, play_type, play_type_idx, prediction from pred "
    "where posteam = 'T7' and play_type_idx <> prediction", _RULE))
def q_misclassified(spark, d):
    return P.misclassified(_pred(spark, d), "T7").select(
        KEY, "posteam", LABEL, "play_type_idx", "prediction")


@query("cast_label_float", O.with_base(
    "select row_id, prediction, cast(play_type_idx as float) as play_type_idx from pred", _RULE))
def q_cast_label_float(spark, d):
    return P.cast_label_float(_pred(spark, d)).select(KEY, "prediction", "play_type_idx")


_ML = """
ml as (select len(list_intersect(predictions, labels)) as i, len(predictions) as np,
              len(labels) as nl, len(list_distinct(list_concat(predictions, labels))) as nu from pred)"""


@query("multilabel_metrics", O.with_base(
    """select round(avg(case when nl > 0 then i / nl else 0.0 end), 6) as recall,
              round(avg(case when np > 0 then i / np else 0.0 end), 6) as precision,
              round(avg(case when np + nl > 0 then 2.0 * i / (np + nl) else 0.0 end), 6) as f1,
              round(avg(case when nu > 0 then i / nu else 0.0 end), 6) as accuracy from ml""",
    _RULE + "," + _ML))
def q_multilabel_metrics(spark, d):
    m = E.multilabel_metrics(_pred(spark, d))
    return m.select(*[r6(c).alias(c) for c in m.columns])


@query("multilabel_by_label", O.with_base(
    """select label, round(case when tp + fp > 0 then tp / (tp + fp) else 0.0 end, 6) as precision,
              round(case when tp + fn > 0 then tp / (tp + fn) else 0.0 end, 6) as recall,
              round(case when 2 * tp + fp + fn > 0 then 2.0 * tp / (2 * tp + fp + fn) else 0.0 end, 6) as f1
       from (select label, cast(count(*) filter (where in_p and in_l) as double) as tp,
                    cast(count(*) filter (where in_p and not in_l) as double) as fp,
                    cast(count(*) filter (where not in_p and in_l) as double) as fn
             from (select u.label, list_contains(predictions, u.label) as in_p,
                          list_contains(labels, u.label) as in_l
                   from pred, unnest(list_distinct(list_concat(predictions, labels))) as u(label))
             group by label) where tp + fn > 0""",
    _RULE))
def q_multilabel_by_label(spark, d):
    m = E.multilabel_by_label(_pred(spark, d))
    return m.select("label", *[r6(c).alias(c) for c in ("precision", "recall", "f1")])


@query("multilabel_label_set", O.with_base(
    "select distinct u.label from pred, unnest(labels) as u(label)", _RULE))
def q_multilabel_label_set(spark, d):
    return E.multilabel_label_set(_pred(spark, d))


# ---------------------------------------------------------------- features

# categorical and numeric feature columns present in the plays fixture, in the
# reference's order (categoricals as indexed there, numerics by the dtype rule)
CATS = ["season_type", "posteam", "week", "season", "roof", "surface"]
NUMS = ["quarter_seconds_remaining", "down", "ydstogo", "ep", "wind", "temp"]


def _ftrain(spark, d):
    return P.blank_to(prepare(plays(spark, d)).train, "surface")


def _fclean(spark, d):
    return P.blank_to(_clean(spark, d), "surface")


def _explode(df, column):
    return FE.explode_vector(df, column, KEY).select(KEY, "slot", r6("value").alias("value"))


_IDX_JOINS = " ".join(
    f"join ix_{c} on cast(fu.{c} as varchar) = cast(ix_{c}.v as varchar)" for c in CATS)


@query("string_index", O.with_base(
    "select fu.row_id, " + ", ".join(f"ix_{c}.i as {c}_idx" for c in CATS)
    + ", lx.i as play_type_idx from fu " + _IDX_JOINS + " join lx on fu.play_type = lx.v",
    O.feature_ctes("train", CATS, NUMS)))
def q_string_index(spark, d):
    tr = _ftrain(spark, d)
    model = Pipeline(stages=[FE.label_indexer(), FE.index(CATS)]).fit(tr)
    return model.transform(tr).select(KEY, *[FE.idx(c) for c in CATS], "play_type_idx")


@query("one_hot", O.with_base(
    " union all ".join(
        f"select fu.row_id, '{c}' as column_name, cast(ix.i as integer) as slot, cast(1.0 as double) as value "
        f"from fu join ix_{c} ix on cast(fu.{c} as varchar) = cast(ix.v as varchar) where ix.i < ix.nd - 1"
        for c in CATS),
    O.feature_ctes("train", CATS, NUMS)))
def q_one_hot(spark, d):
    tr = _ftrain(spark, d)
    enc = Pipeline(stages=[FE.index(CATS), FE.one_hot(CATS)]).fit(tr).transform(tr)
    def named(c):
        return F.transform(FE.vector_entries(FE.vec(c)), lambda e: F.struct(
            F.lit(c).alias("column_name"), e.slot.alias("slot"), e.value.alias("value")))

    return enc.select(KEY, F.explode(F.concat(*[named(c) for c in CATS])).alias("e")).select(KEY, "e.column_name", "e.slot", "e.value")


@query("assemble_skip", O.with_base("select row_id, slot, round(value, 6) as value from fe",
                                    O.feature_ctes("clean", CATS, NUMS)))
def q_assemble_skip(spark, d):
    rows = _fclean(spark, d)
    pipe = FE.feature_pipeline(CATS, NUMS, kind=None, label=None, assemble_invalid="skip")
    return _explode(pipe.fit(rows).transform(rows), "features")


@query("assemble_strict", O.with_base("select row_id, slot, round(value, 6) as value from fe",
                                      O.feature_ctes("train", CATS, NUMS, numeric=False)))
def q_assemble_strict(spark, d):
    tr = _ftrain(spark, d)
    pipe = FE.feature_pipeline(CATS, NUMS, kind=None, label=None, assemble_invalid="error", one_hot_only=True)
    return _explode(pipe.fit(tr).transform(tr), "features")


@query("max_abs_scale", O.with_base(
    "select fe.row_id, fe.slot, round(fe.value / fs.m, 6) as value from fe join fs using (slot)",
    O.feature_ctes("train", CATS, NUMS, one_hot=False)))
def q_max_abs_scale(spark, d):
    tr = _ftrain(spark, d)
    model = Pipeline(stages=[FE.assemble(NUMS), FE.scaler("maxabs")]).fit(tr)
    return _explode(model.transform(tr), "scaledFeatures")


@query("min_max_scale", O.with_base(
    """select fx.row_id, fs.slot,
              round(case when fs.hi = fs.lo then 1.5
                         else (coalesce(fe.value, 0.0) - fs.lo) / (fs.hi - fs.lo) + 1.0 end, 6) as value
       from fx join fs on true left join fe on fe.row_id = fx.row_id and fe.slot = fs.slot""",
    O.feature_ctes("train", CATS, NUMS, one_hot=False)))
def q_min_max_scale(spark, d):
    tr = _ftrain(spark, d)
    model = Pipeline(stages=[FE.assemble(NUMS), FE.scaler("minmax")]).fit(tr)
    return _explode(model.transform(tr), "scaledFeatures")


@query("feature_pipeline", O.with_base(
    "select fe.row_id, fe.slot, round(fe.value / fs.m, 6) as value from fe join fs using (slot)",
    O.feature_ctes("train", CATS, NUMS)))
def q_feature_pipeline(spark, d):
    tr = _ftrain(spark, d)
    model = FE.feature_pipeline(CATS, NUMS, kind="maxabs", label="play_type").fit(tr)
    return _explode(model.transform(tr), "scaledFeatures")


# ---------------------------------------------------------------- models
def _frames(spark, d, end=None):
    prep = prepare(plays(spark, d), end=end)
    return P.blank_to(prep.train, "surface"), P.blank_to(prep.test, "surface"), prep.fill


def _predictions(model, df):
    return M.score(model, df).select(KEY, "play_type_idx", "prediction")


def _scoring_features(kind="maxabs", cats=CATS):
    # rows whose label was not seen in training are left out of the scores
    return FE.feature_pipeline(cats, NUMS, kind=kind, label="play_type", handle_invalid="keep", label_invalid="skip")


@query("logistic_regression")
def q_logistic_regression(spark, d):
    tr, te, _ = _frames(spark, d)
    model = M.fit(tr, _scoring_features(), M.classifier("lr", maxIter=50, regParam=0.01))
    return _predictions(model, te)


_GRADIENT_BOUND = 1e-4


@query("logistic_optimality", O.with_base("""
select cast(cl.i as integer) as class_index, cast(sl.slot as integer) as feature,
       round(coalesce(s.v, 0.0) / (select count(*) from fx), 6) as observed, true as optimal
from (select distinct i from lx) cl
join (select u.slot from fd, unnest(range(-1, cast(fd.d as bigint))) as u(slot)) sl on true
left join (select lx.i, e.slot, sum(e.value) as v
           from (select fe.row_id, fe.slot, fe.value / fs.m as value from fe join fs using (slot)
                 union all select row_id, -1, 1.0 from fx) e
           join fx on fx.row_id = e.row_id join lx on fx.play_type = lx.v group by lx.i, e.slot) s
     on s.i = cl.i and s.slot = sl.slot""", O.feature_ctes("train", CATS, NUMS)))
def q_logistic_optimality(spark, d):
    """Per weight the observed moment, and whether the loss's gradient there is within the bound (M1)."""
    tr = _ftrain(spark, d)
    rows = materialize(FE.feature_pipeline(CATS, NUMS, kind="maxabs", label="play_type").fit(tr).transform(tr)
                       .select("play_type_idx", "scaledFeatures"))
    model = M.classifier("lr", maxIter=500, tol=1e-9, regParam=0.01).fit(rows)
    return gradient_table(model, rows).select("class_index", "feature", r6("observed").alias("observed"),
                                              (F.abs("gradient") <= _GRADIENT_BOUND).alias("optimal"))


@query("random_forest")
def q_random_forest(spark, d):
    tr, te, _ = _frames(spark, d)
    model = M.fit(tr, _scoring_features(), M.classifier("rf", numTrees=20, maxDepth=5))
    return _predictions(model, te)


_NB_SMOOTHING = 1.0


def _nb_sql():
    lam = _NB_SMOOTHING
    body = f"""
cls as (select lx.i as c, count(*) as n from fx join lx on fx.play_type = lx.v group by lx.i),
slots as (select slot, m, lo, hi from fs),
sums as (select lx.i as c, fe.slot, sum(fe.value) as sv from fe join fx using (row_id)
         join lx on fx.play_type = lx.v group by lx.i, fe.slot),
sc as (select cls.c, slots.slot,
              case when slots.hi = slots.lo then 1.5 * cls.n
                   else (coalesce(sums.sv, 0.0) - cls.n * slots.lo) / (slots.hi - slots.lo) + cls.n end as s
       from cls join slots on true left join sums on sums.c = cls.c and sums.slot = slots.slot),
st as (select c, sum(s) as tot from sc group by c)"""
    sel = f"""
select 'pi' as kind, cast(c as integer) as class_index, -1 as feature,
       round(ln(n + {lam}) - ln((select sum(n) from cls) + {lam} * (select count(*) from cls)), 6) as value
from cls
union all
select 'theta' as kind, cast(sc.c as integer) as class_index, sc.slot as feature,
       round(ln(sc.s + {lam}) - ln(st.tot + {lam} * (select d from fd)), 6) as value
from sc join st using (c)"""
    return O.with_base(sel, O.feature_ctes("train", CATS, NUMS) + "," + body)


@query("naive_bayes", _nb_sql())
def q_naive_bayes(spark, d):
    tr = _ftrain(spark, d)
    model = M.fit(tr, FE.feature_pipeline(CATS, NUMS, kind="minmax", label="play_type"),
                  M.classifier("nb", smoothing=_NB_SMOOTHING))
    return M.nb_parameters(spark, model).withColumn("value", r6("value"))


@query("mlp")
def q_mlp(spark, d):
    tr, te, _ = _frames(spark, d)
    feats = _scoring_features().fit(tr)
    ftr = feats.transform(tr)
    n_classes = len(feats.stages[0].labels)
    layers = M.mlp_layers(ftr, "scaledFeatures", [16], n_classes)
    clf = M.classifier("mlp", layers=layers, maxIter=50).fit(ftr)
    return clf.transform(feats.transform(te)).select(KEY, "play_type_idx", "prediction")


# both scores of every test row whose label training has seen: the library's and the tables'
def _agree_sql(column: str = "", source: str = "") -> str:
    valid = " and ".join(f"{n} is not null and not isnan({n})" for n in NUMS)
    return O.with_base(
        f"select {column}fx.row_id, lx.i as play_type_idx, true as agrees from fx join lx on fx.play_type = lx.v{source}",
        f"""lx as (select play_type as v, cast(row_number() over (order by count(*) desc, play_type) - 1 as double) as i
                   from train group by play_type),
            fx as (select * from test where {valid})""")


def _agreement(scored, predicted):
    return (scored.join(predicted.withColumnRenamed("prediction", "by_tables"), KEY, "left")
            .select(KEY, "play_type_idx", F.col("prediction").eqNullSafe(F.col("by_tables")).alias("agrees")))


@query("random_forest_tables", _agree_sql())
def q_random_forest_tables(spark, d):
    """The forest as a table of nodes, scored by one join per level, against the model's own predictions (M2)."""
    tr, te, _ = _frames(spark, d)
    feats = _scoring_features().fit(tr)
    clf = M.classifier("rf", numTrees=20, maxDepth=5).fit(feats.transform(tr))
    rows = materialize(clf.transform(feats.transform(te)).select(KEY, "play_type_idx", "scaledFeatures", "prediction"))
    nodes = materialize(MT.forest_table(spark, clf))
    return _agreement(rows, MT.score_forest(nodes, rows, "scaledFeatures", KEY, trees=20, depth=5))


@query("mlp_tables", _agree_sql())
def q_mlp_tables(spark, d):
    """The network as a table of weights, scored layer by layer, against the model's own predictions (M4)."""
    tr, te, _ = _frames(spark, d)
    feats = _scoring_features().fit(tr)
    ftr = feats.transform(tr)
    layers = M.mlp_layers(ftr, "scaledFeatures", [16], len(feats.stages[0].labels))
    clf = M.classifier("mlp", layers=layers, maxIter=50).fit(ftr)
    rows = materialize(clf.transform(feats.transform(te)).select(KEY, "play_type_idx", "scaledFeatures", "prediction"))
    weights = MT.network_table(spark, clf)
    return _agreement(rows, MT.score_network(weights, MT.entries(rows, "scaledFeatures", KEY), rows, KEY, 2))


_TUNE_SMOOTHING = M.NB_GRID["smoothing"]


def _tune_sql(sel, source="train", base="row_id", before=""):
    """``sel`` over acc(param_index, accuracy) and lam(param_index, l).

    Naive Bayes in closed form on the hash split's first part, scored on the second.

    Scaled values are at least 1 and a constant slot is 1.5, so every row has every slot."""
    inside = f"{O.h('fx.' + base, 'split', 42)} < 0.8 * 4294967296"
    body = f"""
tv as (select fx.row_id, lx.i as c, {inside} as train from fx join lx on fx.play_type = lx.v),
slots as (select u.slot, coalesce(fs.lo, 0.0) as lo, coalesce(fs.hi, 0.0) as hi
          from fd, unnest(range(cast(fd.d as bigint))) as u(slot) left join fs on fs.slot = u.slot),
xs as (select tv.row_id, tv.c, tv.train, slots.slot,
              case when slots.hi = slots.lo then 1.5
                   else (coalesce(fe.value, 0.0) - slots.lo) / (slots.hi - slots.lo) + 1.0 end as x
       from tv join slots on true left join fe on fe.row_id = tv.row_id and fe.slot = slots.slot),
lam as (select * from (values {', '.join(f'({i}, {v})' for i, v in enumerate(_TUNE_SMOOTHING))}) as t(param_index, l)),
cls as (select c, count(*) as n from tv where train group by c),
sc as (select c, slot, sum(x) as s from xs where train group by c, slot),
ct as (select c, sum(s) as tot from sc group by c),
pi as (select param_index, c, ln(n + l) - ln((select sum(n) from cls) + l * (select count(*) from cls)) as v from cls, lam),
th as (select param_index, sc.c, slot, ln(s + l) - ln(tot + l * (select d from fd)) as v from sc join ct using (c), lam),
raw as (select th.param_index, xs.row_id, xs.c as actual, th.c, sum(xs.x * th.v) + any_value(pi.v) as v
        from xs join th using (slot) join pi on pi.param_index = th.param_index and pi.c = th.c
        where not xs.train group by th.param_index, xs.row_id, xs.c, th.c),
best as (select param_index, row_id, actual, c,
                row_number() over (partition by param_index, row_id order by v desc, c) as rk from raw),
acc as (select param_index, cast(count(*) filter (where actual = c) as double) / count(*) as accuracy
        from best where rk = 1 group by param_index)"""
    return O.with_base(sel, before + O.feature_ctes(source, CATS, NUMS) + "," + body)


_TUNE_METRICS = """select cast(param_index as integer) as param_index, concat('{"smoothing": ', cast(l as double), '}') as params,
                          accuracy from acc join lam using (param_index)"""
_TUNE_BEST = """select * from (values ('featuresCol', 'scaledFeatures'), ('labelCol', 'play_type_idx'), ('modelType', 'multinomial'),
                   ('predictionCol', 'prediction'), ('probabilityCol', 'probability'),
                   ('rawPredictionCol', 'rawPrediction')) as t(param, value)
                union all select 'smoothing', cast(cast(l as double) as varchar) from
                  (select l from acc join lam using (param_index) order by accuracy desc, param_index limit 1)"""
# a balanced row is known by its key and synth; its copies and its base row share the key's side of the split
_SM_KEYED = "smk as (select * exclude (row_id, synth), row_id as base_id, row_id * 1000000 + synth as row_id from sm),"


def _tuned(spark, d):
    tr = _ftrain(spark, d)
    feats = FE.feature_pipeline(CATS, NUMS, kind="minmax", label="play_type").fit(tr)
    est = M.classifier("nb")
    return M.tune(feats.transform(tr), est, M.grid(est, {"smoothing": _TUNE_SMOOTHING}), metric="accuracy")


@query("tune", _tune_sql(_TUNE_METRICS))
def q_tune(spark, d):
    return _tuned(spark, d).metrics_frame(spark)


@query("tune_balanced", _tune_sql(
    _TUNE_METRICS, "smk", "base_id",
    O.undersample_ctes("train", 2, "us2") + "," + O.smote_ctes("us2") + "," + _SM_KEYED))
def q_tune_balanced(spark, d):
    """The search on the balanced frame; a synthetic row stays on its base row's side of the split."""
    tr = P.blank_to(SM.balance(prepare(plays(spark, d)).train), "surface")
    feats = FE.feature_pipeline(CATS, NUMS, kind="minmax", label="play_type").fit(tr)
    est = M.classifier("nb")
    return M.tune(feats.transform(tr), est, M.grid(est, {"smoothing": _TUNE_SMOOTHING}),
                  metric="accuracy").metrics_frame(spark)


@query("best_params", _tune_sql(_TUNE_BEST))
def q_best_params(spark, d):
    return M.best_params(spark, _tuned(spark, d).best_model)


@query("score")
def q_score(spark, d):
    df = plays(spark, d)
    cats = [c for c in CATS if c != "season"]
    prep = prepare(df, end=HOLDOUT_SEASON)
    train = P.blank_to(prep.train.drop("season"), "surface")
    test = P.blank_to(prep.test.drop("season"), "surface")
    holdout = P.blank_to(A.impute(season_test(df, HOLDOUT_SEASON), prep.fill).drop("season"), "surface")
    model = M.fit(train, _scoring_features(cats=cats), M.classifier("lr", maxIter=50, regParam=0.01))
    return (_predictions(model, test).withColumn("frame", F.lit("test"))
            .unionByName(_predictions(model, holdout).withColumn("frame", F.lit("holdout"))))


@query("score_versions", _agree_sql("v.version, ", ", unnest([1, 2]) as v(version)"))
def q_score_versions(spark, d):
    """Two versions of a model saved as tables, loaded again and scored from these, against the models' own predictions (M8)."""
    tr, te, _ = _frames(spark, d)
    feats = _scoring_features().fit(tr)
    ftr, fte = feats.transform(tr), feats.transform(te)
    root, out = shared_dir(spark, "models"), None
    for reg in (0.01, 0.1):
        model = M.classifier("lr", maxIter=50, regParam=reg).fit(ftr)
        version = MT.save_version(spark, root, {"linear": MT.linear_table(spark, model)}, {"kind": "lr", "regParam": reg})
        tables, _ = MT.load_version(spark, root, version)
        rows = materialize(model.transform(fte).select(KEY, "play_type_idx", "scaledFeatures", "prediction"))
        part = _agreement(rows, MT.score_linear(tables["linear"], MT.entries(rows, "scaledFeatures", KEY), rows, KEY))
        part = part.withColumn("version", F.lit(version))
        out = part if out is None else out.unionByName(part)
    return out


# ---------------------------------------------------------------- SMOTE-NC, balancing, flagship

_SM_ROUND = ", ".join(f"round({c}, 6) as {c}" for c in O.SMOTE_NUMS)


def _rounded(df):
    return df.select(*[r6(c).alias(c) if c in O.SMOTE_NUMS else F.col(c) for c in df.columns])


@query("smotenc_oversample", O.with_base(
    f"select * replace ({_SM_ROUND}) from sm", O.smote_ctes("train")))
def q_smotenc_oversample(spark, d):
    tr = prepare(plays(spark, d)).train
    return _rounded(SM.smotenc(tr, categorical=O.SMOTE_CATS, numeric=O.SMOTE_NUMS))


@query("balance_classes", O.with_base(
    f"select * replace ({_SM_ROUND}) from sm",
    O.undersample_ctes("train", 2, "us2") + "," + O.smote_ctes("us2")))
def q_balance_classes(spark, d):
    return _rounded(SM.balance(prepare(plays(spark, d)).train))


@query("prepare", O.with_base(
    f"""select * replace ({_SM_ROUND}), 0 as synth, 'train' as split from train
        union all select * replace ({_SM_ROUND}), 0 as synth, 'test' as split from test
        union all select * replace ({_SM_ROUND}), 'balanced' as split from sm""",
    O.undersample_ctes("train", 2, "us2") + "," + O.smote_ctes("us2")))
def q_prepare(spark, d):
    return _rounded(prepare(plays(spark, d), balanced=True).frames())
