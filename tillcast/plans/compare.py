"""Order-insensitive comparison of a Spark result with a DuckDB oracle."""

from __future__ import annotations

import collections
import datetime as dt
import math

from tillcast.sources.fixtures import BASE_TABLES


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(float(v))
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    return str(v)


def rows_by_name(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [tuple(norm(r[i]) for i in order) for r in rows]


# DuckDB type name -> Spark simple type name, for the schema check.
DUCK_TO_SPARK = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "DATE": "date",
    "BOOLEAN": "boolean",
}


def duckdb_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(df, con, sql: str) -> dict:
    s_cols = df.columns
    s_types = dict(df.dtypes)
    s_rows = [tuple(r) for r in df.collect()]
    rel = con.execute(sql)
    o_cols = [d[0] for d in rel.description]
    o_types = {d[0]: DUCK_TO_SPARK.get(str(d[1]), str(d[1])) for d in rel.description}
    o_rows = rel.fetchall()
    a, b = collections.Counter(rows_by_name(s_cols, s_rows)), collections.Counter(rows_by_name(o_cols, o_rows))
    same_cols = sorted(s_cols) == sorted(o_cols)
    return {
        "rows": (len(s_rows), len(o_rows)),
        "columns_match": same_cols,
        "types_match": same_cols and all(s_types[c] == o_types[c] for c in s_cols),
        "type_pairs": sorted((c, s_types[c], o_types.get(c)) for c in s_cols if s_types[c] != o_types.get(c)),
        "values_match": same_cols and a == b,
        "only_spark": list((a - b).elements())[:3],
        "only_oracle": list((b - a).elements())[:3],
        "spark_columns": sorted(s_cols),
        "oracle_columns": sorted(o_cols),
    }
