"""Staging from landing files laid out as the modelled ingest writes them.

    <root>/WDI/Region.csv              ,index_region,region
    <root>/WDI/Income_group.csv        ,index_income,incomeLevel
    <root>/WDI/Country.csv             ,name,iso2Code,iso3Code,index_region
    <root>/WDI/Indicator.csv           ,id,name,sourceOrganization,sourceNote
    <root>/WDI/Under5_per_country.csv  ,value,year,indicator,index_country,name
    <root>/WDI/Gni_per_country.csv     ,value,year,indicator,index_country
    <root>/WDI/Income_boundaries.csv   ,income,year,lower_bound,upper_bound
    <root>/WHO/<cause>.csv             maybe a row number, then the country, then
                                       Y, Y, Y per year (or Y, Y.1, Y.2), three
                                       sub-header rows, then one row per country

Every WDI file starts with an unnamed row-number column (the position the
writer had); positions become ids where the modelled load relied on insert
order. All cause files are read in one scan. The result has the same tables
(names and columns) as the staging built from the driver's tables, so the
star, the views and every worksheet run on it unchanged:

    staging = staging_from_landing(spark, root)
    star = star_from_staging(spark, staging)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalmart.functions.stats import METRIC
from vitalmart.functions.text import income_code, map_names
from vitalmart.operators.keys import name_ids, with_position
from vitalmart.plans import staging as st
from vitalmart.plans import star as sr
from vitalmart.sources.csv_blocks import cells, read_quoted_csv, records
from vitalmart.sources.tables import read_csv

CAUSE_SUB_HEADER_ROWS = 3      # rows after the header row that are not data
AGE_BLOCK = 2                  # the ages 0-4 block of each year (Y, Y.1, Y.2)
YEAR_LABEL = r"^(\d{4})(?:\.(\d+))?$"


def wdi(spark: SparkSession, root: str, name: str, large: bool = False) -> DataFrame:
    """One WDI file; the leading unnamed column is the writer's row number. A
    ``large`` one (the series) is read by byte blocks, a list as one piece."""
    path = f"{root.rstrip('/')}/WDI/{name}.csv"
    df = read_quoted_csv(spark, path) if large else read_csv(spark, path, multi_line=True)
    return df.withColumnRenamed("_c0", "_row").withColumn("_row", F.col("_row").cast("long"))


def staging_from_landing(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    region = wdi(spark, root, "Region").select(
        F.col("index_region").cast("int").alias("region_id"),
        F.trim("region").alias("region_name"))
    income_group = wdi(spark, root, "Income_group").select(
        F.col("index_income").cast("int").alias("income_group_id"),
        F.col("incomeLevel").alias("income_name"))
    # countries get their auto-increment id in file order (index + 1)
    country = wdi(spark, root, "Country").select(
        (F.col("_row") + 1).cast("int").alias("country_id"),
        F.col("name").alias("country_name"), F.col("iso2Code").alias("iso2code"),
        F.col("iso3Code"), F.col("index_region").cast("int").alias("region_id"))
    indicator = wdi(spark, root, "Indicator").select(
        (F.col("_row") + 1).cast("int").alias("indicator_id"),
        F.col("name").alias("indicator_name"), F.col("id").alias("world_bank_ind_id"),
        F.col("sourceOrganization").alias("source_organization"),
        F.col("sourceNote").alias("source_note"))

    # under-5 rows are inserted first, then GNI rows: ids follow that order (T4)
    u5 = wdi(spark, root, "Under5_per_country", large=True)
    gni = wdi(spark, root, "Gni_per_country", large=True)

    def series(df: DataFrame, src: int, name) -> DataFrame:
        return df.select(F.lit(src).alias("_src"), "_row", name.alias("name"),
                         F.col("value").try_cast(METRIC).alias("value"),
                         F.col("year").try_cast("double").cast("int").alias("year"),
                         F.col("indicator").cast("int").alias("indicator_id"),
                         F.col("index_country").cast("int").alias("country_id"))
    numbered = with_position(
        series(u5, 0, F.col("name")).unionByName(series(gni, 1, F.lit(None).cast("string"))),
        ["_src", "_row"], "indicator_per_country_id")
    ipc = numbered.select(F.col("indicator_per_country_id").cast("bigint"), "value", "year",
                          "indicator_id", "country_id")
    u5_keys = numbered.where(F.col("_src") == 0).select(
        F.col("indicator_per_country_id").cast("bigint"), "name", "year")

    causes = _cause_values(spark, root)
    death_reason = name_ids(causes.select("reason_name"), "reason_name", "death_reason_id").select(
        F.col("death_reason_id").cast("int"), "reason_name")
    # cause rows: names through the dictionary, then (name, year) against the
    # under-5 rows
    ipcr = (causes.withColumn("name", map_names("name"))
            .join(u5_keys, ["name", "year"])
            .join(death_reason, "reason_name")
            .select("value_per_reason", F.col("death_reason_id").alias("reason_id"),
                    "indicator_per_country_id"))

    bounds = wdi(spark, root, "Income_boundaries")
    igy = bounds.select(
        (F.col("_row") + 1).cast("int").alias("income_group_year_id"),
        income_code("income").cast("int").alias("income_group_id"),
        F.col("year").try_cast("double").cast("int").alias("year"),
        F.col("lower_bound").try_cast("double").cast("bigint").alias("lower_bound"),
        F.col("upper_bound").try_cast("double").cast("bigint").alias("upper_bound"),
        F.col("income").alias("income_group_name"))
    igc = st.stg_income_group_country(ipc, igy)
    return {"region": region, "country": country, "income_group": income_group,
            "indicator": indicator, "indicator_per_country": ipc,
            "death_reason": death_reason, "indicator_per_country_per_reason": ipcr,
            "income_group_year": igy, "income_group_country": igc}


def _cause_layout(rows: DataFrame) -> DataFrame:
    """Per cause file, from its first row: where it starts, which column holds
    the country (the one before the first year) and the used column per year."""
    h = F.col("_header")
    label = lambda x: F.trim(F.coalesce(x, F.lit("")))
    year = lambda x: F.regexp_extract(label(x), YEAR_LABEL, 1).try_cast("int")

    def column(x, i):
        # A repeated year counts its occurrences; a written suffix is the count
        nth = F.size(F.filter(F.slice(h, 1, i), lambda y: label(y) == label(x)))
        suffix = F.regexp_extract(label(x), YEAR_LABEL, 2).try_cast("int")
        return F.struct(i.alias("pos"), year(x).alias("year"),   # i counts from 0
                        F.coalesce(suffix, nth).alias("block"))

    first = rows.groupBy("reason_name").agg(F.min("_mid").alias("_start"),
                                            F.min_by("_cells", "_mid").alias("_header"))
    cols = first.withColumn("_cols", F.transform(h, column))
    dated = F.filter("_cols", lambda c: c["year"].isNotNull())
    name_pos = F.try_element_at(dated, F.lit(1))["pos"] - 1
    return cols.select(
        "reason_name", "_start",
        F.when(name_pos.between(0, 1), name_pos).otherwise(F.raise_error(F.concat(
            F.lit("no country column before the years of "), "reason_name"))).alias("_name_pos"),
        F.filter(dated, lambda c: c["block"] == AGE_BLOCK).alias("_used"),
        F.filter("_cols", lambda c: c["year"].isNull() & (c["pos"] > name_pos)).alias("_other"))


def _cause_values(spark: SparkSession, root: str) -> DataFrame:
    """All cause files of a landing root; the file is named by its cause."""
    name = F.regexp_extract("file", r"([^/]+)\.csv$", 1)
    return cause_values(spark, f"{root.rstrip('/')}/WHO/*.csv", F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))))


def cause_values(spark: SparkSession, path: str, reason: Column) -> DataFrame:
    """All cause files in one scan -> (reason_name, name, year, value_per_reason).

    Every file is read by its own header: the years may differ and come in any
    order, and a leading row-number column may be there or not. A value in a
    column without a year is an error. Files are read by byte blocks and may
    be of any width. ``reason``: the cause's name out of the column ``file``.
    """
    rows = records(spark, path).select(reason.alias("reason_name"), cells("text").alias("_cells"), F.col("record").alias("_mid"))
    body = (rows.join(_cause_layout(rows), "reason_name")
            .where(F.col("_mid") - F.col("_start") > CAUSE_SUB_HEADER_ROWS))   # P12
    cell = lambda c: F.get("_cells", c["pos"])
    checked = F.when(F.exists("_other", lambda c: cell(c).isNotNull()), F.raise_error(F.concat(
        F.lit("a value in a column without a year in "), "reason_name"))).otherwise(
        F.get("_cells", F.col("_name_pos")))
    # One row per country and year, missing values kept
    long = body.select("reason_name", checked.alias("name"), F.inline(F.transform(
        "_used", lambda c: F.struct(c["year"].alias("year"), cell(c).alias("value_text")))))
    return long.select("reason_name", "name", "year",
                       F.col("value_text").try_cast(METRIC).alias("value_per_reason"))


def star_from_staging(spark: SparkSession, s: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Dimensions, facts and views from staging tables (the two load procedures).

    Keys come from ``with_position`` inside the dimension and fact builders;
    the fact loads read the dimensions they reference, so a caller persisting
    the result writes them in this order.
    """
    dim_date = sr.dim_date(spark, s["indicator_per_country"])
    dim_country = sr.dim_country(s["country"], s["region"], s["indicator_per_country"],
                                 s["income_group_country"], s["income_group_year"],
                                 s["income_group"])
    dim_reason = sr.dim_reason(s["death_reason"], s["indicator_per_country_per_reason"],
                               s["indicator_per_country"])
    fact_metrics = sr.fact_metrics(s["indicator_per_country"], s["indicator"], dim_country)
    fact_reasons = sr.fact_reasons(s["indicator_per_country"],
                                   s["indicator_per_country_per_reason"],
                                   dim_reason, dim_country, fact_metrics)
    return {"dim_date": dim_date, "dim_country": dim_country, "dim_reason": dim_reason,
            "fact_metrics": fact_metrics, "fact_metric_death_reasons": fact_reasons,
            "v1": sr.view_v1(fact_metrics, fact_reasons, dim_country, dim_reason, dim_date),
            "v2": sr.view_v2(fact_metrics, fact_reasons, dim_country, dim_reason, dim_date)}


def load(spark: SparkSession, root: str, out: str) -> list[str]:
    """Full refresh: staging and star from landing files, written as parquet
    under ``out`` in load order (facts after the dimensions they reference)."""
    staging = staging_from_landing(spark, root)
    written = []
    for name, df in staging.items():
        df.write.mode("overwrite").parquet(f"{out.rstrip('/')}/staging/{name}")
        written.append(f"staging/{name}")
    stg = {n: spark.read.parquet(f"{out.rstrip('/')}/staging/{n}") for n in staging}
    star = star_from_staging(spark, stg)
    for name in ["dim_date", "dim_country", "dim_reason", "fact_metrics",
                 "fact_metric_death_reasons", "v1", "v2"]:
        star[name].write.mode("overwrite").parquet(f"{out.rstrip('/')}/mart/{name}")
        written.append(f"mart/{name}")
    return written
