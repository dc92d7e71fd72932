"""Plain-SQL statements of every checked query, for an independent engine.

They restate the semantics from scratch (no Spark), over the same parquet
tables registered as views.  The shared CTE chain mirrors the fixture and
pipeline: plays -> fourth -> clean -> sampled / rest -> train / test.
"""

from __future__ import annotations

from playlab.functions.columns import SAMPLE_FRACTIONS
from playlab.functions.hashing import sql_uniform_hash

PLAYS_SQL = """
select o_orderkey as row_id,
  cast(extract(year from o_orderdate) as int) as season,
  cast(floor((extract(doy from o_orderdate) - 1) / 7) as int) + 1 as week,
  case when extract(doy from o_orderdate) > 310 then 'POST' else 'REG' end as season_type,
  concat('T', cast(c_nationkey as varchar)) as posteam,
  c_mktsegment as roof,
  case when o_orderkey % 11 = 0 then '' else o_orderstatus end as surface,
  cast(1 + o_orderkey % 4 as double) as down,
  cast(floor(o_totalprice % 100) as double) as ydstogo,
  cast(o_orderkey * 37 % 900 as double) as quarter_seconds_remaining,
  c_acctbal as ep,
  case when o_custkey % 3 = 0 then cast('NaN' as double)
       else cast(30 + floor(o_totalprice) % 60 as double) end as temp,
  case when o_orderkey % 51 = 0 then cast(null as double)
       when o_custkey % 3 = 0 then cast('NaN' as double)
       else cast(o_orderkey % 25 as double) end as wind,
  case when o_orderkey % 97 = 0 then cast(null as varchar)
       when o_totalprice % 100 < 55 then 'punt'
       when o_totalprice % 100 < 80 then 'field_goal'
       when o_totalprice % 100 < 89 then 'pass'
       when o_totalprice % 100 < 95 then 'run'
       when o_totalprice % 100 < 98.5 then 'no_play'
       else 'qb_kneel' end as play_type
from orders join customer on o_custkey = c_custkey
"""

PLAY_COLS = ["row_id", "season", "week", "season_type", "posteam", "roof", "surface", "down",
             "ydstogo", "quarter_seconds_remaining", "ep", "temp", "wind", "play_type"]
# columns of the cleaned frame: the key, then the reference's list order
CLEAN_COLS = ["row_id", "season_type", "week", "posteam", "quarter_seconds_remaining", "down",
              "ydstogo", "play_type", "ep", "season", "wind", "temp", "roof", "surface"]


def h(key: str, purpose: str, seed: int = 42) -> str:
    return sql_uniform_hash(key, purpose, seed)


def frac_sql(label: str = "play_type", fractions: dict = SAMPLE_FRACTIONS) -> str:
    whens = " ".join(f"when {label} = '{k}' then {float(v)}" for k, v in sorted(fractions.items()))
    return f"(case {whens} else 0.0 end)"


IN_SAMPLE = f"{h('row_id', 'sample')} < {frac_sql()} * 4294967296.0"
NOT_NULL_ALL = " and ".join(f"{c} is not null" for c in CLEAN_COLS)


def fill_sql(col: str, value: str) -> str:
    return f"case when {col} is null or isnan({col}) then {value} else {col} end"


BASE_CTES = f"""
plays as ({PLAYS_SQL}),
fourth as (select * from plays where down = 4.0),
clean as (
  select {', '.join(CLEAN_COLS)} from plays
  where down = 4.0 and {NOT_NULL_ALL}
    and play_type <> 'qb_kneel'),
sampled as (select * from clean where {IN_SAMPLE}),
rest as (select * from clean where not ({IN_SAMPLE})),
tmean as (select avg(case when not isnan(temp) then temp end) as m from sampled),
train as (select * replace ({fill_sql('wind', '0.0')} as wind,
                            {fill_sql('temp', '(select m from tmean)')} as temp) from sampled),
test as (select * replace ({fill_sql('wind', '0.0')} as wind,
                           {fill_sql('temp', '(select m from tmean)')} as temp) from rest)
"""


def with_base(body: str, extra_ctes: str = "") -> str:
    ctes = BASE_CTES.strip()
    if extra_ctes:
        ctes += ",\n" + extra_ctes.strip()
    return f"with {ctes}\n{body}"


def rule_ctes(source: str = "clean") -> str:
    """Label index and rule predictions over ``source`` (mirrors functions.rules)."""
    from playlab.functions.rules import band_sql
    return f"""
lidx as (select play_type as lt,
           cast(row_number() over (order by count(*) desc, play_type) - 1 as double) as li
         from {source} group by play_type),
pred as (select c.*, a.li as play_type_idx, b.li as prediction,
           case when not isnan(c.wind) and c.wind > 20
                then list_distinct([a.li, (select li from lidx where lt = 'run')]) else [a.li] end as labels,
           case when isnan(c.temp) then cast([] as double[])
                else list_distinct([(select li from lidx where lt = {band_sql('c.ydstogo - 3')}),
                                    (select li from lidx where lt = {band_sql('c.ydstogo + 3')})]) end as predictions
         from {source} c join lidx a on c.play_type = a.lt
         join lidx b on {band_sql('c.ydstogo')} = b.lt)"""


def metric_ctes(pred: str, suffix: str = "") -> str:
    """Per-label stats pf{suffix} over a (play_type_idx, prediction) relation."""
    return f"""
cc{suffix} as (select play_type_idx as actual, prediction as predicted, count(*) as n from {pred} group by 1, 2),
pl{suffix} as (select l as label, cast(sum(na) as double) as na, cast(sum(np) as double) as np,
                 cast(sum(tp) as double) as tp from (
    select actual as l, n as na, 0 as np, case when actual = predicted then n else 0 end as tp from cc{suffix}
    union all select predicted as l, 0 as na, n as np, 0 as tp from cc{suffix}) group by l),
pm{suffix} as (select *, case when np > 0 then tp / np else 0.0 end as p,
                  case when na > 0 then tp / na else 0.0 end as r from pl{suffix}),
pf{suffix} as (select *, case when p + r > 0 then 2 * p * r / (p + r) else 0.0 end as f from pm{suffix})"""


def metric_select(suffix: str = "", metric_label: float = 0.0) -> str:
    return f"""select round(sum(tp) / sum(na), 6) as accuracy,
       round(sum(f * na) / sum(na), 6) as f1,
       round(coalesce(max(case when label = {metric_label} then p end), 0.0), 6) as precision_by_label,
       round(sum(p * na) / sum(na), 6) as weighted_precision,
       round(sum(r * na) / sum(na), 6) as weighted_recall
from pf{suffix}"""


def feature_ctes(source: str, cats, nums, one_hot: bool = True, numeric: bool = True) -> str:
    """CTEs giving ``fe(row_id, slot, value)``: the assembled vector's non-zero
    entries (numeric columns first, then one-hot blocks with the last category
    dropped), ``fx`` the rows kept (no NaN/NULL numeric input) and ``fs`` the
    per-slot statistics (max |v|, min and max including zeros) over ``fx``.
    Also ``lx`` (label index) and ``ix_<c>`` (category index) per column."""
    parts = [f"fu as (select * replace (case when surface = '' then 'Undefined' else surface end as surface) "
             f"from {source})"]
    for c in cats:
        parts.append(
            f"ix_{c} as (select {c} as v, cast(row_number() over (order by count(*) desc, "
            f"cast({c} as varchar)) - 1 as double) as i, count(*) over () as nd from fu group by {c})")
    parts.append("lx as (select play_type as v, cast(row_number() over (order by count(*) desc, play_type) - 1 "
                 "as double) as i from fu group by play_type)")
    valid = " and ".join(f"{n} is not null and not isnan({n})" for n in nums) if numeric and nums else "true"
    parts.append(f"fx as (select * from fu where {valid})")
    pieces = []
    offset = "0"
    if numeric:
        for j, n in enumerate(nums):
            pieces.append(f"select row_id, {j} as slot, {n} as value from fx where {n} <> 0")
        offset = str(len(nums))
    if one_hot:
        for c in cats:
            pieces.append(f"select fx.row_id, cast({offset} + ix.i as integer) as slot, cast(1.0 as double) as value "
                          f"from fx join ix_{c} ix on cast(fx.{c} as varchar) = cast(ix.v as varchar) "
                          f"where ix.i < ix.nd - 1")
            offset = f"({offset} + (select max(nd) - 1 from ix_{c}))"
    parts.append("fe as (" + " union all ".join(pieces) + ")")
    parts.append(f"fd as (select {offset} as d)")
    parts.append("fs as (select slot, max(abs(value)) as m, "
                 "case when count(*) < (select count(*) from fx) then least(min(value), 0.0) else min(value) end as lo, "
                 "case when count(*) < (select count(*) from fx) then greatest(max(value), 0.0) else max(value) end as hi, "
                 "sum(value) as sv from fe group by slot)")
    return ",\n".join(parts)


SMOTE_NUMS = ["quarter_seconds_remaining", "down", "ydstogo", "ep", "wind", "temp"]
SMOTE_CATS = ["season_type", "week", "posteam", "season", "roof", "surface"]


def smote_ctes(src: str, k: int = 5, seed: int = 42) -> str:
    """Brute-force SMOTE-NC over relation ``src``; result relation ``sm``
    (all original rows with synth 0, then the synthetic rows)."""
    nums, cats = SMOTE_NUMS, SMOTE_CATS
    sd_cols = ", ".join(f"stddev_pop({c}) as s{i}" for i, c in enumerate(nums))
    sd_list = ", ".join(f"s{i}" for i in range(len(nums)))
    d2 = " + ".join(f"(a.{c} - c.{c}) * (a.{c} - c.{c})" for c in nums)
    dc = " + ".join(f"case when a.{c} <> c.{c} then 1 else 0 end" for c in cats)
    hnbr = ("cast(concat('0x', substr(md5(concat(cast(p.row_id as varchar), ':', cast(p.t as varchar), "
            f"':nbr:{seed}')), 1, 8)) as bigint)")
    hgap = ("cast(concat('0x', substr(md5(concat(cast(p.row_id as varchar), ':', cast(p.t as varchar), "
            f"':gap:{seed}')), 1, 8)) as bigint)")
    modes = []
    for c in cats:
        modes.append(f"""
md_{c} as (select qid, v as {c} from (
    select qid, v, row_number() over (partition by qid order by cn desc, v) as rn
    from (select nb.qid, c.{c} as v, count(*) as cn from nb join {src} c on c.row_id = nb.cid
          group by nb.qid, c.{c})) where rn = 1)""")
    num_out = ", ".join(
        f"case when p.k > 0 then p.{c} + p.u * (c.{c} - p.{c}) else p.{c} end as {c}" for c in nums)
    cat_out = ", ".join(f"coalesce(md_{c}.{c}, p.{c}) as {c}" for c in cats)
    mode_joins = " ".join(f"left join md_{c} on md_{c}.qid = p.row_id" for c in cats)
    return f"""
scnt as (select play_type, count(*) as n from {src} group by play_type),
splan as (select play_type, n, (select max(n) from scnt) - n as g,
                 least({k}, n - 1) as k from scnt where n < (select max(n) from scnt)),
ssd as (select play_type, {sd_cols} from {src} group by play_type),
smed as (select play_type, median(s) as m from (select play_type, unnest([{sd_list}]) as s from ssd)
         group by play_type),
sb as (select u.*, p.k, p.g // p.n + case when row_number() over (partition by u.play_type
              order by {h('u.row_id', 'base', seed)}, u.row_id) - 1 < p.g % p.n then 1 else 0 end as mcount
       from {src} u join splan p using (play_type)),
nn as (select a.row_id as qid, c.row_id as cid, a.k,
              row_number() over (partition by a.row_id order by
                round({d2} + smed.m * smed.m * ({dc}), 6), c.row_id) as nr
       from sb a join {src} c on a.play_type = c.play_type and a.row_id <> c.row_id
       join smed on smed.play_type = a.play_type where a.mcount > 0),
nb as (select * from nn where nr <= k),
{','.join(m.strip() for m in modes)},
st as (select sb.*, r.t from sb, unnest(range(sb.mcount)) as r(t) where sb.mcount > 0),
sp as (select p.*, case when p.k > 0 then {hnbr} % p.k + 1 end as pick,
              {hgap} / 4294967296.0 as u from st p),
sm as (select {', '.join(CLEAN_COLS)}, 0 as synth from {src}
       union all
       select p.row_id, p.season_type, p.week, p.posteam, p.quarter_seconds_remaining, p.down, p.ydstogo,
              p.play_type, p.ep, p.season, p.wind, p.temp, p.roof, p.surface, cast(p.t + 1 as integer) as synth
       from (select p.row_id, p.play_type, p.t, {num_out}, {cat_out}
             from (select * replace (t as t) from sp) p
             left join nb on nb.qid = p.row_id and nb.nr = p.pick
             left join {src} c on c.row_id = nb.cid {mode_joins}) p)"""


def undersample_ctes(src: str, rounds: int, out: str, seed: int = 42) -> str:
    """Rows of ``src`` after ``rounds`` majority cuts, as relation ``out``."""
    return f"""
{out}_counts as (select play_type, count(*) as n from {src} group by play_type),
{out}_ranked as (select play_type, n, row_number() over (order by n desc, play_type) as rk,
                  min(n) over () as n_min from {out}_counts),
{out}_targets as (select play_type, case when rk <= {rounds} then n_min else n end as target
                  from {out}_ranked),
{out}_ordered as (select t.*, row_number() over (partition by t.play_type
              order by {h('t.row_id', 'rank', seed)}, t.row_id) as rn from {src} t),
{out} as (select o.* exclude (rn) from {out}_ordered o join {out}_targets g
          on o.play_type = g.play_type where o.rn <= g.target)"""
