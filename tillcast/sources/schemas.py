"""Explicit schemas of the logical tables (no inference anywhere)."""

from pyspark.sql import types as T

TRANSACTIONS = T.StructType(
    [
        T.StructField("data_id", T.LongType()),
        T.StructField("branch", T.StringType()),
        T.StructField("pos", T.IntegerType()),
        T.StructField("transdate", T.StringType()),
        T.StructField("ite_code", T.StringType()),
        T.StructField("quantity", T.DoubleType()),
        T.StructField("dep_code", T.IntegerType()),
        T.StructField("date", T.StringType()),
        T.StructField("time", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("delivery", T.StringType()),
    ]
)

PRODUCTS = T.StructType(
    [
        T.StructField("data_id", T.LongType()),
        T.StructField("incode", T.StringType()),
        T.StructField("ite_desc", T.StringType()),
        T.StructField("dep_code", T.IntegerType()),
        T.StructField("unit_prc", T.DoubleType()),
        T.StructField("branch", T.StringType()),
        T.StructField("pos", T.IntegerType()),
    ]
)

DEPARTMENTS = T.StructType(
    [
        T.StructField("data_id", T.LongType()),
        T.StructField("dept_code", T.IntegerType()),
        T.StructField("dept_name", T.StringType()),
        T.StructField("branch", T.StringType()),
        T.StructField("pos", T.IntegerType()),
    ]
)

# Mapping files are read as all-string; columns are then picked by name.
ITEM_MAP_COLUMNS = ("ite_desc", "ite_desc_std", "cat_flag", "status", "food_type")
DEPT_MAP_COLUMNS = ("dep_desc", "remarks", "cat_flag")

MASTER = T.StructType(
    [
        T.StructField("data_id", T.LongType()),
        T.StructField("branch", T.StringType()),
        T.StructField("quantity", T.DoubleType()),
        T.StructField("date", T.DateType()),
        T.StructField("time", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("dept_name_std", T.StringType()),
        T.StructField("ite_desc_std", T.StringType()),
        T.StructField("food_type", T.StringType()),
        T.StructField("cat_flag", T.StringType()),
    ]
)

DAILY = T.StructType(
    [
        T.StructField("branch", T.StringType()),
        T.StructField("ite_desc_std", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("quantity", T.DoubleType()),
    ]
)

FORECASTS = T.StructType(
    [
        T.StructField("branch", T.StringType()),
        T.StructField("ite_desc_std", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("forecast", T.DoubleType()),
        T.StructField("status", T.StringType()),
    ]
)
