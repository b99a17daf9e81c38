"""Adapter views that give the driver's TPC-H-shaped tables the retail schemas.

The SQL text is written once. Spark runs it with DataFrame parameters
(``spark.sql(text, lineitem=df, ...)``, no global temp views); the DuckDB
oracle runs the same text, braces removed, as CTEs over its own views.
Rows planted on purpose: null ``type``, hours 24/25, unparsable dates and
times, null quantities, null department codes on both sides, duplicates by
``pos``, items with a second description (``(alt)``), unmatched products and items, the unknown prefix ``ZZZ``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)

_PREFIX_CASE = (
    "case p.p_type when 'ECONOMY' then 'BRK' when 'MEDIUM' then 'CHM' "
    "when 'STANDARD' then 'BO' when 'LARGE' then 'SID' when 'PROMO' then 'MP' "
    "else 'ZZZ' end"
)

ADAPTERS: dict[str, str] = {
    "v_rd5000": f"""
select l.l_orderkey * 10 + l.l_linenumber as data_id,
  concat('B', cast(n.n_regionkey as string)) as branch,
  cast(s.s_suppkey % 4 as int) as pos,
  cast(cast(l.l_shipdate as date) as string) as transdate,
  concat({_PREFIX_CASE}, cast(p.p_partkey as string)) as ite_code,
  case when l.l_orderkey % 101 = 0 then null else l.l_quantity end as quantity,
  case when p.p_partkey % 211 = 0 then null else cast(p.p_size + 5 as int) end as dep_code,
  case when l.l_orderkey % 997 = 0 then 'not-a-date'
    else cast(cast(l.l_shipdate as date) as string) end as date,
  case when l.l_orderkey % 499 = 0 then '10:00'
    else concat(lpad(cast(l.l_orderkey % 26 as string), 2, '0'), ':',
                lpad(cast(l.l_partkey % 60 as string), 2, '0'), ':00') end as time,
  nullif(l.l_returnflag, 'N') as type,
  l.l_linestatus as delivery
from {{lineitem}} l join {{supplier}} s on s.s_suppkey = l.l_suppkey
  join {{nation}} n on n.n_nationkey = s.s_nationkey
  join {{part}} p on p.p_partkey = l.l_partkey
""",
    "v_rd5500": f"""
select p.p_partkey * 100 + r.r_regionkey * 10 + x.pos as data_id,
  concat({_PREFIX_CASE}, cast(p.p_partkey as string)) as incode,
  case when p.p_partkey % 97 = 0 and x.pos = 1 then concat(p.p_name, ' (alt)') else p.p_name end as ite_desc,
  case when p.p_partkey % 211 = 0 then null else cast(p.p_size + 5 as int) end as dep_code,
  p.p_retailprice + x.pos as unit_prc,
  concat('B', cast(r.r_regionkey as string)) as branch,
  x.pos
from {{part}} p cross join {{region}} r cross join (values (0), (1)) as x(pos)
where p.p_partkey % 17 <> 0
""",
    "v_rd1800": """
select cast(d.code * 100 + r.r_regionkey * 10 + x.pos as bigint) as data_id,
  nullif(d.code, 6) as dept_code,
  case when d.code = 6 then 'DEPT NONE' when d.code % 10 = 0 then 'MODIFIER'
    when d.code % 10 = 1 then 'UPGRADES'
    else concat('DEPT ', cast(d.code as string)) end as dept_name,
  concat('B', cast(r.r_regionkey as string)) as branch,
  x.pos
from (select distinct cast(p_size + 5 as int) as code from {part} where p_size <> 3) d
  cross join {region} r cross join (values (0), (1)) as x(pos)
""",
    "v_item_map": """
select p_name as ite_desc, upper(p_name) as ite_desc_std,
  case when length(p_name) = 8 then 'promo' when length(p_name) = 12 then 'ignore' end as cat_flag,
  case when length(p_name) = 9 then 'inactive' when length(p_name) = 12 then 'ignore'
    else 'active' end as status,
  case when length(p_name) % 2 = 0 then 'food' else 'beverage' end as food_type
from (select distinct p_name from {part}) q
where p_name <> 'small ring'
""",
    "v_dept_map": """
select * from (values ('BULK ORDER', 'bulk'), ('MARKETING PROMOS', 'promo'),
  ('MODIFIER', 'ignore'), ('UPGRADES', 'upgrade'), ('NANAY''S FAVORITE', 'ignore'))
  as m(dep_desc, cat_flag)
""",
}

_PLACEHOLDER = re.compile(r"\{(\w+)\}")


def adapter_cte_sql() -> str:
    """The adapter views as a DuckDB ``WITH`` list (no leading WITH)."""
    parts = [f"{name} AS ({_PLACEHOLDER.sub(r'\1', sql).strip()})" for name, sql in ADAPTERS.items()]
    return ",\n".join(parts)


def load_tables(spark: SparkSession, sf_dir: str, names=BASE_TABLES) -> dict[str, DataFrame]:
    """Read the driver's Parquet tables lazily (no rows are read here)."""
    return {n: spark.read.parquet(f"{sf_dir.rstrip('/')}/{n}.parquet") for n in names}


def adapter_view(spark: SparkSession, name: str, tables: dict[str, DataFrame]) -> DataFrame:
    sql = ADAPTERS[name]
    needed = {m for m in _PLACEHOLDER.findall(sql)}
    return spark.sql(sql, **{t: tables[t] for t in needed})


@dataclass
class RetailInputs:
    """The five logical inputs of the cleaning pipeline."""

    transactions: DataFrame
    products: DataFrame
    departments: DataFrame
    item_map: DataFrame
    dept_map: DataFrame


def retail_inputs(spark: SparkSession, sf_dir: str) -> RetailInputs:
    tables = load_tables(spark, sf_dir, ("region", "nation", "supplier", "part", "lineitem"))
    return RetailInputs(
        transactions=adapter_view(spark, "v_rd5000", tables),
        products=adapter_view(spark, "v_rd5500", tables),
        departments=adapter_view(spark, "v_rd1800", tables),
        item_map=adapter_view(spark, "v_item_map", tables),
        dept_map=adapter_view(spark, "v_dept_map", tables),
    )
