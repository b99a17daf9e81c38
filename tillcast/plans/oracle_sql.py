"""Independent DuckDB SQL for every SQL-expressible query.

Written by hand from the semantics (not generated from the Spark code), so
it is a real second opinion. Each oracle is ``WITH <adapters>, <steps>``
followed by its own SELECT; DuckDB skips the CTEs a query does not use.
Computed doubles are rounded to 6 places on both sides.
"""

from __future__ import annotations

from tillcast.config import FIXTURE
from tillcast.sources.fixtures import adapter_cte_sql

P = FIXTURE
OB = "B1"  # override branch of the fixture
Y0, Y1 = P.start_year, P.end_year
TRAIN_END = P.train_end.isoformat()
# Sign, days, hours, minutes, seconds, fraction of a duration text.
TIME_RE = r"^\s*([-+]?)\s*([0-9]+\s+days?,?\s+)?([0-9]{1,6}):([0-9]{1,7}):([0-9]{1,9})(?:[.]([0-9]+))?\s*$"

# Prefix and department, written out here a second time so that
# a slip in the engine's table shows.
PREFIXES = [
    ("ADD", "ADD ONS"),
    ("BAH", "BIGGS AT HOME"),
    ("BDS", "BDS"),
    ("BEEF", "SIZZLERS"),
    ("BEF", "SIZZLERS"),
    ("BEV", "BEVERAGES"),
    ("BLK", "BULK ORDER"),
    ("BRK", "BREAKFAST"),
    ("BL", "BIGGS LOYALTY"),
    ("BO", "BULK ORDER"),
    ("BS", "BURGERS AND SANDWICHES"),
    ("BULK", "BULK ORDER"),
    ("CHM", "CHICKEN MEALS"),
    ("CKS", "CAKES"),
    ("CLM", "CLASSIC MEALS"),
    ("DEL", "FOOD PANDA"),
    ("EVENT", "EVENT"),
    ("F", "FUNCTION"),
    ("FND", "BURGERS AND SANDWICHES"),
    ("FP", "FP COFFEE"),
    ("GB", "GO BIGG"),
    ("KEF", "KIDS EAT FREE"),
    ("MI", "BIGGS MERCH ITEMS"),
    ("MOM", "MOM KNOWS BEST"),
    ("MP", "MARKETING PROMOS"),
    ("NES", "NESPRESSO"),
    ("PARTY", "PARTY PACKS"),
    ("PI", "PREMIUM ITEMS"),
    ("PP", "PARTY PACKS"),
    ("PREM", "PREMIUM ITEMS"),
    ("PST", "PASTA DISHES"),
    ("REP", "REPRESENTATION"),
    ("RND", "RND"),
    ("RSD", "RSD PROMOS"),
    ("SAL", "SALAD DRESSINGS"),
    ("SHK", "SHAKES"),
    ("SID", "TOPSIDERS"),
    ("SIZ", "SIZZLERS"),
    ("SLD", "SALAD DELIGHTS"),
    ("SUP", "SOUP"),
    ("TEST", "TEST MARKET"),
    ("UP", "UPGRADES"),
    ("XTR", "EXTRAS"),
]


def _prefix_values() -> str:
    rows = ", ".join(f"('{k}', '{v}')" for k, v in PREFIXES)
    return f"select * from (values {rows}) as t(prefix, prefix_dept)"


STEPS = f"""
prefix_map AS ({_prefix_values()}),
clean_tx AS (
  select data_id, branch, ite_code, quantity, dep_code,
    try_cast(date as date) as date,
    case when regexp_matches(time, '{TIME_RE}') then
      lpad(cast((t // 1000000) // 3600 as varchar), 2, '0') || ':' ||
      lpad(cast(((t // 1000000) % 3600) // 60 as varchar), 2, '0') || ':' ||
      lpad(cast((t // 1000000) % 60 as varchar), 2, '0') ||
      case when t % 1000000 = 0 then '' else '.' || lpad(cast(t % 1000000 as varchar), 6, '0') end
    end as time,
    coalesce(type, 'D') as type
  from (
    select *, (((case when regexp_extract(time, '{TIME_RE}', 1) = '-'
                        and regexp_extract(time, '{TIME_RE}', 2) = '' then -1 else 1 end) *
       ((cast(nullif(regexp_extract(time, '{TIME_RE}', 3), '') as bigint) * 3600 +
         cast(nullif(regexp_extract(time, '{TIME_RE}', 4), '') as bigint) * 60 +
         cast(nullif(regexp_extract(time, '{TIME_RE}', 5), '') as bigint)) * 1000000000 +
        coalesce(cast(nullif(rpad(substr(regexp_extract(time, '{TIME_RE}', 6), 1, 9), 9, '0'), '000000000') as bigint), 0)))
       % 86400000000000 + 86400000000000) % 86400000000000 // 1000 as t
    from v_rd5000)
),
pm_raw AS (
  select distinct p.incode, p.ite_desc, p.dep_code, p.branch, d.dept_name
  from v_rd5500 p left join v_rd1800 d
    on p.branch is not distinct from d.branch and p.dep_code is not distinct from d.dept_code
),
pm_pref AS (
  select r.*, nullif(regexp_extract(r.incode, '^[A-Z]+', 0), '') as prefix from pm_raw r
),
pm_std AS (
  select x.incode, x.ite_desc, x.dep_code, x.branch,
    coalesce(case
      when x.branch = '{OB}' and x.incode = 'SID12' then 'PASTA DISHES'
      when x.branch = '{OB}' and x.dep_code = 42 then 'BIGGS LOYALTY'
      when x.branch = '{OB}' and x.dep_code in (53, 54) then 'NANAYS FAVORITE'
      else m.prefix_dept end, x.dept_name) as dept_name_std
  from pm_pref x left join prefix_map m on m.prefix = x.prefix
),
pm AS (
  select s.incode, s.ite_desc, s.dep_code, s.branch, s.dept_name_std,
    i.ite_desc_std, i.status, i.food_type,
    case when d.cat_flag = 'ignore' then 'ignore' else coalesce(i.cat_flag, d.cat_flag) end as cat_flag
  from pm_std s left join v_item_map i on i.ite_desc = s.ite_desc
    left join v_dept_map d on d.dep_desc = s.dept_name_std
),
tx_joined AS (
  select t.data_id, t.branch, t.ite_code, t.quantity, t.dep_code, t.date, t.time, t.type,
    pm.ite_desc, pm.dept_name_std, pm.ite_desc_std, pm.status, pm.food_type, pm.cat_flag
  from clean_tx t left join pm
    on t.branch is not distinct from pm.branch and t.ite_code is not distinct from pm.incode
   and t.dep_code is not distinct from pm.dep_code
),
master AS (
  select data_id, branch, quantity, date, time, type, dept_name_std, ite_desc_std, food_type, cat_flag
  from tx_joined where cat_flag is distinct from 'ignore' and status = 'active'
),
daily AS (
  select branch, ite_desc_std, date, coalesce(sum(quantity), 0.0) as quantity
  from master where branch is not null and ite_desc_std is not null and date is not null
  group by 1, 2, 3
),
totals AS (
  select branch, ite_desc_std, coalesce(sum(quantity), 0.0) as quantity from daily
  where date between make_date({Y0}, 1, 1) and make_date({Y1}, 12, 31) group by 1, 2
),
top AS (
  select * from (
    select branch, ite_desc_std, quantity,
      cast(row_number() over (partition by branch order by quantity desc, ite_desc_std asc) as integer) as rank
    from totals) where rank <= {P.top_n}
),
daily_top AS (
  select d.* from daily d where exists
    (select 1 from top t where t.branch = d.branch and t.ite_desc_std = d.ite_desc_std)
)
"""


H = 30  # horizon of the fixture train_end (2000-03-31 -> 2000-04-30)
K = P.iqr_k
EPS = "2.220446049250313e-16"


def _capped(name: str, base: str) -> str:
    """L3 over ``base``: calendar, IQR flag, month median, cap."""
    return f"""{name} AS (
  select * exclude (q1, q3), cast(case when anomaly then typical else quantity end as double) as quantity_cap
  from (
    select c.*, median(quantity) over (partition by branch, ite_desc_std, month) as typical
    from (
      select b.*, coalesce(quantity < q1 - {K} * (q3 - q1) or quantity > q3 + {K} * (q3 - q1), false) as anomaly
      from (
        select d.*, cast(isodow(date) - 1 as integer) as dayofweek, cast(month(date) as integer) as month,
          cast(weekofyear(date) as integer) as week,
          quantile_cont(quantity, 0.25) over (partition by branch, ite_desc_std) as q1,
          quantile_cont(quantity, 0.75) over (partition by branch, ite_desc_std) as q3
        from {base} d) b) c))"""


STEPS += f""",
daily_top_y AS (
  select * from daily_top where date between make_date({Y0}, 1, 1) and make_date({Y1}, 12, 31)
),
{_capped("capped_y", "daily_top_y")},
{_capped("capped_all", "daily_top")},
fser AS (select branch, ite_desc_std, date, quantity_cap from capped_all),
test_part AS (
  select branch, ite_desc_std, date, quantity_cap from (
    select f.*, row_number() over (partition by branch, ite_desc_std order by date) as rn
    from fser f where date >= date '{TRAIN_END}') where rn <= {H}
),
pairs AS (
  select t.branch, t.ite_desc_std, t.quantity_cap as y, c.typical as f
  from test_part t join capped_all c using (branch, ite_desc_std, date)
  where t.quantity_cap is not null and c.typical is not null
)
"""


PHI, THETA = 0.4, -0.3  # given coefficients of the fixed forecast

# The innovations recursion of ARMA(1,1) on the first differences w of each
# training series, one step a day: e = w - x, x' = phi w + theta e / r,
# r' = 1 + theta^2 - theta^2 / r.
STEPS += f""",
fit_rows AS (
  select branch, ite_desc_std, date, quantity_cap as y,
    row_number() over w - 1 as t, quantity_cap - lag(quantity_cap) over w as w,
    count(*) over (partition by branch, ite_desc_std) as n
  from fser where date <= date '{TRAIN_END}' and quantity_cap is not null
  window w as (partition by branch, ite_desc_std order by date)
),
fit_kind AS (
  select branch, ite_desc_std, max(n) as n, last(y order by t) as y_last,
    case when max(n) - 1 >= 3 and max(w) <> min(w) then 'ok' else 'flat' end as status
  from fit_rows group by all
),
state AS (
  select branch, ite_desc_std, cast(0 as bigint) as t, cast(0.0 as double) as x,
    cast((1 + 2 * {THETA} * {PHI} + {THETA} * {THETA}) / (1 - {PHI} * {PHI}) as double) as r
  from fit_kind
  union all
  select s.branch, s.ite_desc_std, s.t + 1, {PHI}::double * f.w + {THETA}::double / s.r * (f.w - s.x),
    1 + {THETA}::double * {THETA}::double - {THETA}::double * {THETA}::double / s.r
  from state s join fit_rows f on f.branch = s.branch and f.ite_desc_std = s.ite_desc_std and f.t = s.t + 1
),
ahead AS (
  select k.branch, k.ite_desc_std, k.status, k.y_last, s.x, cast(date '{TRAIN_END}' + cast(h.h as integer) as date) as date, h.h
  from fit_kind k join state s on s.branch = k.branch and s.ite_desc_std = k.ite_desc_std and s.t = k.n - 1
    cross join (select range as h from range(1, {H} + 1)) h
),
walk_pairs AS (
  select t.branch, t.ite_desc_std, t.quantity_cap as y, a.y_last as f
  from test_part t join ahead a using (branch, ite_desc_std, date)
  where a.status = 'ok' and t.quantity_cap is not null
),
walk_scores AS (
  select branch, ite_desc_std, round(avg(abs(y - f)), 2) as mae,
    cast(cast(avg(abs(y - f) / greatest(abs(y), {EPS})) * 100.0 as float) as double) as mape, count(*) as n
  from walk_pairs group by all
)
"""


def _dict(c: str) -> str:
    return f"""dict_{c} AS (
  select v, cast(dense_rank() over (order by v) - 1 as integer) as code
  from (select distinct coalesce(cast({c} as varchar), 'None') as v from ml_split where not is_test))"""


STEPS += f""",
ml_split AS (
  select l.l_orderkey, l.l_linenumber, p.p_type, p.p_brand, l.l_returnflag,
    cast(p.p_size as double) as p_size, l.l_quantity, l.l_extendedprice as target,
    substr(md5(concat_ws('|', cast(l.l_orderkey as varchar), cast(l.l_linenumber as varchar), '{P.seed}')), 1, 8)
      < '{format(int(P.test_fraction * 2**32), "08x")}' as is_test
  from lineitem l join part p on p.p_partkey = l.l_partkey
),
{_dict("p_type")},
{_dict("p_brand")},
{_dict("l_returnflag")},
report AS (
  select quantity as y, typical as f,
    case when date <= date '{TRAIN_END}' then 'reference' else 'current' end as dataset
  from capped_all where quantity is not null and typical is not null
)
"""


def _with(select: str) -> str:
    return f"WITH RECURSIVE {adapter_cte_sql()},\n{STEPS.strip()}\n{select}"


SELECTS: dict[str, str] = {
    "clean_transactions": "select * from clean_tx",
    "source_filter": f"""select data_id, branch, ite_code, quantity, dep_code, date, time, type from v_rd5000
        where try_cast(date as date) > date '{Y0}-01-01' and branch in ('B1', 'B2')""",
    "product_master": "select * from pm_raw",
    "dept_prefix": """select branch, incode, prefix, m.prefix_dept from pm_pref
        left join prefix_map m using (prefix)""",
    "dept_overrides": "select * from pm_std",
    "item_dept_flags": "select * from pm",
    "transaction_product_join": "select * from tx_joined",
    "transaction_product_join_bucketed": "select * from tx_joined",
    "transaction_master": "select * from master",
    "daily_quantity": "select * from daily",
    "branch_item_totals": "select * from totals",
    "top_items": "select * from top",
    "daily_top_items": "select * from daily_top",
    "calendar_features": """select d.*, cast(isodow(date) - 1 as integer) as dayofweek,
        cast(month(date) as integer) as month, cast(weekofyear(date) as integer) as week from daily_top d""",
    "iqr_flags": f"""select *, coalesce(quantity < q1 - {K} * (q3 - q1) or quantity > q3 + {K} * (q3 - q1), false) as anomaly
        from (select d.*, quantile_cont(quantity, 0.25) over w as q1, quantile_cont(quantity, 0.75) over w as q3
              from daily_top d window w as (partition by branch, ite_desc_std))""",
    "zscore_flags": f"""select branch, ite_desc_std, date, quantity, round(mean, 6) as mean, round(std, 6) as std,
          coalesce(abs(quantity - mean) / nullif(std, 0) > {P.z_k}, false) as anomaly
        from (select d.*, avg(quantity) over w as mean, stddev_samp(quantity) over w as std
              from daily_top d window w as (partition by branch, ite_desc_std))""",
    "seasonal_median": """select branch, ite_desc_std, cast(month(date) as integer) as month,
        median(quantity) as typical from daily_top_y group by all""",
    "capped_daily": "select * from capped_y",
    "forecast_horizon": """select distinct date as train_end,
        cast(date_diff('day', date, last_day(date + 1)) as integer) as horizon from clean_tx where date is not null""",
    "forecast_calendar": f"""select l.branch, l.ite_desc_std, l.last_date, cast(l.last_date + cast(1 + t.i as integer) as date) as date,
          cast(t.i + 1 as integer) as step
        from (select branch, ite_desc_std, max(date) as last_date from fser where date <= date '{TRAIN_END}' group by all) l
        cross join (select range as i from range(0, {H})) t""",
    "series_keys": """select branch, ite_desc_std, min(date) as first_date, max(date) as last_date,
          count(*) as n_days from fser group by branch, ite_desc_std""",
    "train_test_cut": f"""select *, 'train' as part from fser where date <= date '{TRAIN_END}'
        union all select *, 'test' as part from test_part""",
    "train_test_cut_days": f"""select *, 'train' as part from fser where date <= date '{TRAIN_END}'
        union all select *, 'test' as part from fser
        where date > date '{TRAIN_END}' and date <= date '{TRAIN_END}' + {H}""",
    "lag_features": """select d.*, lag(quantity, 1) over w as quantity_lag1, lag(quantity, 7) over w as quantity_lag7
        from daily_top d window w as (partition by branch, ite_desc_std order by date)""",
    "series_difference": """select f.*, quantity_cap - lag(quantity_cap, 1) over
        (partition by branch, ite_desc_std order by date) as quantity_cap_diff from fser f""",
    "forecast_metrics": f"""select branch, ite_desc_std, round(avg(abs(y - f)), 6) as mae,
          cast(cast(avg(abs(y - f) / greatest(abs(y), {EPS})) * 100.0 as float) as double) as mape, count(*) as n
        from pairs group by all""",
    "arima_fixed": f"""select branch, ite_desc_std, date, status,
          round(case when status = 'ok' then y_last + x * (1 - power({PHI}::double, h)) / (1 - {PHI}::double) else y_last end, 2) as forecast
        from ahead""",
    "arima_random_walk": "select branch, ite_desc_std, date, round(y_last, 2) as forecast, status from ahead",
    "arima_random_walk_evaluation": "select * from walk_scores",
    "arima_random_walk_listing": f"""select branch || ' | ' || ite_desc_std || ': MAE=' || round(mae::varchar::decimal(38, 10), 2)::varchar
          || ', MAPE=' || case when mape >= 1e15 then printf('%.5e', mape)
            else round(mape::varchar::decimal(38, 10), 2)::varchar end || '%' as line
        from (select branch, ite_desc_std, round(avg(abs(y - f)), 6) as mae,
                (avg(abs(y - f) / greatest(abs(y), {EPS})) * 100.0)::float::double as mape
              from walk_pairs group by all)""",
    "csv_mappings": """select 'item' as mapping, ite_desc as name, cat_flag from v_item_map
        union all select 'department', dep_desc, cat_flag from v_dept_map""",
    "csv_daily": "select * from daily_top",
    "csv_inferred": "select * from top",
    "daily_head": "select * from daily_top order by quantity desc, branch, ite_desc_std, date limit 5",
    "prediction_counts": """select case when is_test then 'test' else 'train' end as dataset,
          count(*) as n_rows, count(*) as n_predictions from ml_split group by all""",
    "batch_score_fixed": """select vec_id, cast(first(c order by s desc, c) as integer) as prediction from (
          select vec_id, c.c, sum(x * ((c.c * 7 + i * 3) % 11 - 5)) as s
          from (select vec_id, unnest(range(len(embedding))) as i, unnest(embedding)::double as x from embeddings)
            cross join (select range as c from range(0, 5)) c group by all)
        group by vec_id""",
    "event_daily": """select event_type, cast(ts as date) as date, round(coalesce(sum(value), 0.0), 6) as value
        from events where event_type is not null and ts is not null group by all""",
    "hash_split": "select l_orderkey, l_linenumber, is_test from ml_split",
    "label_encode": """select s.l_orderkey, s.l_linenumber, s.p_type, s.p_brand, s.l_returnflag,
          coalesce(a.code, -1) as p_type_idx, coalesce(b.code, -1) as p_brand_idx,
          coalesce(c.code, -1) as l_returnflag_idx
        from ml_split s
        left join dict_p_type a on a.v = coalesce(cast(s.p_type as varchar), 'None')
        left join dict_p_brand b on b.v = coalesce(cast(s.p_brand as varchar), 'None')
        left join dict_l_returnflag c on c.v = coalesce(cast(s.l_returnflag as varchar), 'None')""",
    "regression_report": """select dataset, count(*) as n, round(avg(f - y), 6) as mean_error,
          round(avg(abs(y - f)), 6) as mae,
          cast(cast(avg(abs(y - f) / greatest(abs(y), 2.220446049250313e-16)) as float) as double) as mape,
          round(sqrt(avg((y - f) * (y - f))), 6) as rmse,
          round(1.0 - sum((y - f) * (y - f)) / nullif(sum((y - ybar) * (y - ybar)), 0), 6) as r2,
          round(quantile_cont(f - y, 0.05), 6) as p05, round(quantile_cont(f - y, 0.5), 6) as p50,
          round(quantile_cont(f - y, 0.95), 6) as p95
        from (select *, avg(y) over (partition by dataset) as ybar from report) group by dataset""",
    "error_histogram": """select dataset, bin, count(*) as n,
          case when bin > 0 then cast(-50.0 + (bin - 1) * 5.0 as double) end as bin_lo,
          case when bin <= 20 then cast(-50.0 + bin * 5.0 as double) end as bin_hi
        from (select dataset, cast(case when f - y < -50.0 then 0 when f - y >= 50.0 then 21
                else floor(((f - y) - -50.0) / 5.0) + 1 end as integer) as bin from report)
        group by dataset, bin""",
    "dup_keys": """select branch, incode, dep_code, count(*) as n_rows, count(distinct ite_desc) as n_ite_desc
        from pm group by branch, incode, dep_code having count(*) > 1""",
    "dept_key_repeats": """select branch, dept_code, count(*) as n_rows, count(distinct dept_name) as n_dept_name
        from v_rd1800 group by branch, dept_code having count(*) > 1""",
    "unmatched_depts": """select dept_name_std, count(*) as n_products from pm p
        where not exists (select 1 from v_dept_map m where m.dep_desc = p.dept_name_std)
        group by dept_name_std""",
    "masked_metrics": f"""select branch, ite_desc_std,
          round(avg(case when abs(y) > {P.mape_threshold} then abs(y - f) end), 6) as mae,
          cast(cast(avg(case when abs(y) > {P.mape_threshold} then abs(y - f) / greatest(abs(y), {EPS}) end) as float) as double) as mape,
          round(sqrt(avg(case when abs(y) > {P.mape_threshold} then (y - f) * (y - f) end)), 6) as rmse,
          count(case when abs(y) > {P.mape_threshold} then 1 end) as n
        from pairs group by all""",
}


# Additive attribution by its definition: the worth of every coalition of the three features
# (bits 1, 2, 4), members follow the row, the others are averaged by cover.
_ML_ROWS = """select l.l_orderkey, l.l_linenumber, l.l_quantity::double as q, p.p_size::double as p,
      l.l_linenumber::double as n, l.l_extendedprice::double as y
    from lineitem l join part p on p.p_partkey = l.l_partkey"""
SELECTS["tree_attribution_fixed"] = f"""select l_orderkey, l_linenumber, round(v[8], 6) as prediction, round(v[1], 6) as base,
      round((v[2] - v[1]) / 3 + (v[4] - v[3] + v[6] - v[5]) / 6 + (v[8] - v[7]) / 3, 6) as part_l_quantity,
      round((v[3] - v[1]) / 3 + (v[4] - v[2] + v[7] - v[5]) / 6 + (v[8] - v[6]) / 3, 6) as part_p_size,
      round((v[5] - v[1]) / 3 + (v[6] - v[2] + v[7] - v[3]) / 6 + (v[8] - v[4]) / 3, 6) as part_l_linenumber
    from (
      select l_orderkey, l_linenumber, id, list(t0 + t1 order by s) as v from (
        select *,
          case when s & 1 = 1 then case when q <= 24 then low else high end else 0.48::double * low + 0.52::double * high end as t0,
          case when s & 2 = 2 then case when p <= 25 then -500.0::double else deep end else 0.5 * -500.0::double + 0.5 * deep end as t1
        from (
          select *, case when s & 4 = 4 then case when n <= 3 then 4000.0::double else far end
              else (300 * 4000.0::double + 220 * far) / 520 end as high,
            case when s & 2 = 2 then case when p <= 10 then 1000.0::double else 2000.0 end
              else (100 * 1000.0::double + 380 * 2000.0) / 480 end as low,
            case when s & 1 = 1 then case when q <= 10 then 250.0::double else 900.0 end
              else (90 * 250.0::double + 410 * 900.0) / 500 end as deep
          from (
            select r.*, c.s, case when s & 1 = 1 then case when q <= 40 then 5000.0::double else 7000.0 end
                else (120 * 5000.0::double + 100 * 7000.0) / 220 end as far
            from (select row_number() over () as id, * from ({_ML_ROWS})) r cross join (select range as s from range(0, 8)) c
          )
        )
      ) group by l_orderkey, l_linenumber, id
    )"""

# One leaf-wise tree with three leaves: the root's best split, then the better of its children's.
SELECTS["leafwise_tree"] = f"""select * from (
      with f as (
        select y - avg(y) over () as r, least(floor(q / 5), 9)::int as bq, least(floor(p / 5), 9)::int as bp from ({_ML_ROWS})
      ), h0 as (
        select 1 as node, 0 as feature, bq as bin, -sum(r) as g, count(*) as h from f group by all
        union all select 1, 1, bp, -sum(r), count(*) from f group by all
      ), s0 as (
        select node, feature, bin, gl, hl, g, h, gl * gl / (hl + 1) + (g - gl) * (g - gl) / (h - hl + 1) - g * g / (h + 1) as gain
        from (select node, feature, bin, sum(g) over c as gl, sum(h) over c as hl, sum(g) over w as g, sum(h) over w as h from h0
              window c as (partition by node, feature order by bin), w as (partition by node, feature))
        where hl >= 20 and h - hl >= 20
      ), b0 as (
        select * from s0 where gain > 0 order by gain desc, feature, bin limit 1
      ), f1 as (
        select f.*, case when case b.feature when 0 then bq else bp end <= b.bin then 2 else 3 end as node from f, b0 b
      ), h1 as (
        select node, 0 as feature, bq as bin, -sum(r) as g, count(*) as h from f1 group by all
        union all select node, 1, bp, -sum(r), count(*) from f1 group by all
      ), s1 as (
        select node, feature, bin, gl, hl, g, h, gl * gl / (hl + 1) + (g - gl) * (g - gl) / (h - hl + 1) - g * g / (h + 1) as gain
        from (select node, feature, bin, sum(g) over c as gl, sum(h) over c as hl, sum(g) over w as g, sum(h) over w as h from h1
              window c as (partition by node, feature order by bin), w as (partition by node, feature))
        where hl >= 20 and h - hl >= 20
      ), b1 as (
        select * from s1 where gain > 0 order by gain desc, node, feature, bin limit 1
      ), f2 as (
        select f1.*, case when f1.node <> b.node then f1.node
          when case b.feature when 0 then bq else bp end <= b.bin then 2 * f1.node else 2 * f1.node + 1 end as leaf from f1, b1 b
      )
      select node::int as node, case feature when 0 then 'l_quantity' else 'p_size' end as feature, 5.0::double * (bin + 1) as threshold,
        round(sqrt(gain / h), 4) as gain, null::double as value, h::bigint as cover
      from (select * from b0 union all select * from b1)
      union all
      select leaf::int, null, null, null, round(0.5 * sum(r) / (count(*) + 1), 6), count(*)::bigint from f2 group by leaf
    )"""


# Two-sample distances by plain windows over all rows of a column.
_DRIFT_NUMBERS = ["quantity", "quantity_cap", "gap", "month", "dayofweek"]
_DRIFT_TEXTS = ["branch", "ite_desc_std"]
SELECTS["column_drift"] = f"""select * from (
      with base as (
        select *, date <= date '{TRAIN_END}' as ref, case when anomaly then quantity - typical end as gap,
          month(date) as mm, isodow(date) - 1 as dow from capped_all
      ), nums as (
        {" union all ".join(f"select '{c}' as col, ref, {dict(month='mm', dayofweek='dow').get(c, c)}::double as v from base" for c in _DRIFT_NUMBERS)}
      ), vals as (
        select col, v, count(*) filter (ref) as r, count(*) filter (not ref) as c from nums where v is not null group by all
      ), cum as (
        select *, coalesce(sum(r) over b, 0) as rb, coalesce(sum(c) over b, 0) as cb, sum(r) over w as rn, sum(c) over w as cn from vals
        window b as (partition by col order by v rows between unbounded preceding and 1 preceding), w as (partition by col)
      ), gaps as (
        select *, round(abs((rb + r) / rn - (cb + c) / cn), 12) as g, least((rb * 10) // rn, 9) as bin from cum
      ), far as (
        select col, max(rn)::bigint as n_reference, max(cn)::bigint as n_current, max(g) as ks,
          min(v) filter (g = mg) as ks_at from (select *, max(g) over (partition by col) as mg from gaps) group by col
      ), bins as (
        select col, greatest(sum(r) / max(rn), 1e-4) as p, greatest(sum(c) / max(cn), 1e-4) as q from gaps group by col, bin
      ), texts as (
        {" union all ".join(f"select '{c}' as col, ref, {c} as v from base" for c in _DRIFT_TEXTS)}
      ), tvals as (
        select col, coalesce(v, 'None') as v, count(*) filter (ref) as r, count(*) filter (not ref) as c from texts group by all
      ), tshare as (
        select col, greatest(r / sum(r) over (partition by col), 1e-4) as p, greatest(c / sum(c) over (partition by col), 1e-4) as q from tvals
      ), none as (
        select col, count(*) filter (ref and v is null) as nr, count(*) filter (not ref and v is null) as nc from nums group by col
        union all select col, count(*) filter (ref and v is null), count(*) filter (not ref and v is null) from texts group by col
      )
      select f.col as "column", n_reference, n_current, nr as nulls_reference, nc as nulls_current, round(ks, 6) as ks, ks_at,
        (select round(sum((q - p) * ln(q / p)), 6) from bins b where b.col = f.col) as psi
      from far f join none n on n.col = f.col
      union all
      select t.col, t.n_reference, t.n_current, nr, nc, null, null,
        (select round(sum((q - p) * ln(q / p)), 6) from tshare b where b.col = t.col)
      from (select col, sum(r)::bigint as n_reference, sum(c)::bigint as n_current from tvals group by col) t join none n on n.col = t.col
    )"""

# The likelihood by its recursion at every point of the grid, for every series that can be
# fitted: no fit may be worse than the grid's best, and none has a better neighbour.
SELECTS["arima_certificate"] = """select * from (
      with recursive points as (
        select i.v / 10.0::double as phi, j.v / 10.0::double as theta
        from (select unnest([-9, -6, -3, 0, 3, 6, 9]) as v) i cross join (select unnest([-9, -6, -3, 0, 3, 6, 9]) as v) j
      ), walk as (
        select k.branch, k.ite_desc_std, p.phi, p.theta, 0 as t, 0.0::double as s, 0.0::double as l, 0.0::double as x,
          (1 + 2 * p.theta * p.phi + p.theta * p.theta) / (1 - p.phi * p.phi) as r
        from fit_kind k cross join points p where k.status = 'ok'
        union all
        select a.branch, a.ite_desc_std, phi, theta, a.t + 1, s + (f.w - x) * (f.w - x) / r, l + ln(r),
          phi * f.w + theta / r * (f.w - x), 1 + theta * theta - theta * theta / r
        from walk a join fit_rows f on f.branch = a.branch and f.ite_desc_std = a.ite_desc_std and f.t = a.t + 1
      ), ends as (
        select branch, ite_desc_std, phi, theta, max(t) as n, arg_max(s, t) as s, arg_max(l, t) as l from walk group by all
      )
      select branch, ite_desc_std, max(n)::bigint as n_diffs, round(min(n * ln(s / n) + l), 4) as grid_best,
        true as beats_grid, 0 as better_neighbours
      from ends group by branch, ite_desc_std
    )"""


def oracle_sql() -> dict[str, str]:
    return {k: _with(v) for k, v in SELECTS.items()}
