"""Declared schemas of the star (S15). Types follow the mart DDL, but for the
generated keys, which are 64 bits wide: facts may pass 2^31 rows."""

from pyspark.sql.types import (DecimalType, IntegerType, LongType, StringType, StructField,
                               StructType)

METRIC = DecimalType(10, 2)

DIM_DATE = StructType([
    StructField("date_year", IntegerType(), False),
    StructField("date_string", StringType(), True),
    StructField("date_tens", StringType(), True),
])
DIM_COUNTRY = StructType([
    StructField("country_key", LongType(), False),
    StructField("country_id", StringType(), True),
    StructField("country_name", StringType(), True),
    StructField("region_name", StringType(), True),
    StructField("date_year", IntegerType(), True),
    StructField("income_name", StringType(), True),
])
DIM_REASON = StructType([
    StructField("reason_key", LongType(), False),
    StructField("reason_id", StringType(), True),
    StructField("reason_desc", StringType(), True),
    StructField("date_year", IntegerType(), True),
])
FACT_METRICS = StructType([
    StructField("metric_id", LongType(), False),
    StructField("indicator_name", StringType(), True),
    StructField("indicator_metric", METRIC, True),
    StructField("date_year", IntegerType(), True),
    StructField("country_key", LongType(), True),
])
FACT_REASONS = StructType([
    StructField("death_metric_id", LongType(), False),
    StructField("metric_id", LongType(), True),
    StructField("reason_key", LongType(), True),
    StructField("death_reason_metric", METRIC, True),
    StructField("date_year", IntegerType(), True),
])
STAR = {
    "dim_date": DIM_DATE,
    "dim_country": DIM_COUNTRY,
    "dim_reason": DIM_REASON,
    "fact_metrics": FACT_METRICS,
    "fact_metric_death_reasons": FACT_REASONS,
}

# Primary key and NOT NULL columns of each star table (the key's among them).
KEYS = {
    "dim_date": (["date_year"], ["date_year", "date_tens"]),
    "dim_country": (["country_key"], ["country_key", "country_id"]),
    "dim_reason": (["reason_key"], ["reason_key", "reason_id"]),
    "fact_metrics": (["metric_id"], ["metric_id"]),
    "fact_metric_death_reasons": (["death_metric_id"], ["death_metric_id"]),
}

# Exported dimension files (';'-separated) read with a fixed schema
DIM_DATE_EXPORT = StructType([
    StructField("date_year", IntegerType()),
    StructField("date_string", StringType()),
    StructField("date_tens", StringType()),
])
DIM_REASON_EXPORT = StructType([
    StructField("reason_key", LongType()),
    StructField("reason_id", StringType()),
    StructField("reason_desc", StringType()),
    StructField("date_year", IntegerType()),
])
# The cleaned country list
COUNTRY = StructType([
    StructField("country_id", IntegerType()),
    StructField("country_name", StringType()),
    StructField("iso2code", StringType()),
    StructField("iso3Code", StringType()),
    StructField("region_id", IntegerType()),
])
CELLS = StructType([
    StructField("nationkey", IntegerType()),
    StructField("year", IntegerType()),
    StructField("priority", StringType()),
    StructField("sum_qty", DecimalType(22, 2)),
    StructField("n_lines", LongType()),
    StructField("sum_price", DecimalType(22, 2)),
    StructField("n_orders", LongType()),
])
