"""Worksheets as parameterised queries over the two views.

Each worksheet is filter -> groupBy -> agg -> orderBy over V1 or V2. The
views join bounded dimensions (broadcast) to the facts; aggregates are
partial + final, so a hot group never lands whole in one task.
Averages are ``mean`` (exact decimal sum as DOUBLE / count).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitalmart.constants import GNI, MORTALITY, NO_INCOME
from vitalmart.functions.dates import decade_bin, trunc_year, year_part, year_to_date
from vitalmart.functions.stats import Z95, mean
from vitalmart.operators.filters import apply_filters, manual_order, member_range, members
from vitalmart.plans.star import mart

# Default selections, adapted to the driver's tables (regions, years, reasons).
INCOMES = ["High income", "Upper middle income", "Lower middle income", "Low income"]
INCOME_ORDER = ["Low income", "Lower middle income", "Upper middle income", "High income",
                NO_INCOME]
REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
REGION_ORDER = ["ASIA", "AFRICA", "MIDDLE EAST", "AMERICA", "EUROPE"]
DECADES = ["1990s", "2000s"]
REASON_RANGE = ("2-high", "4-not specified")
# income sheet: a range of members united with one more member
INCOME_RANGE = ("High Income", "Lower middle income")
INCOME_EXTRA_MEMBER = "Upper middle income"
CI_REGION = "ASIA"
MAP_YEAR = 2000


def v1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mart(spark, sf_dir).v1()


def v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mart(spark, sf_dir).v2()


def _rank_desc(measure: str) -> F.Column:
    # the ranked input is one row per group member (bounded by the dimension)
    return F.rank().over(Window.orderBy(F.col(measure).desc_nulls_last())).alias("rank")


def ws_income(spark, sf_dir, **shared) -> DataFrame:
    df = apply_filters(v2(spark, sf_dir), **shared)
    df = df.where(member_range("income_name", *INCOME_RANGE)
                  | members("income_name", [INCOME_EXTRA_MEMBER]))
    return (df.groupBy("income_name")
            .agg(mean("death_reason_metric").alias("avg_death_reason_metric"))
            .orderBy(F.col("avg_death_reason_metric").desc(), "income_name"))


def ws_country_map(spark, sf_dir, **shared) -> DataFrame:
    df = apply_filters(v2(spark, sf_dir), **shared)
    return df.groupBy("country_name").agg(
        mean("death_reason_metric").alias("avg_death_reason_metric"))


def ws_trend(spark, sf_dir, indicator: str = MORTALITY, **shared) -> DataFrame:
    df = apply_filters(v2(spark, sf_dir), indicator=indicator, **shared)
    return (df.groupBy("indicator_name", "date_year")
            .agg(mean("indicator_metric").alias("avg_indicator_metric"))
            .orderBy("date_year"))


def ws_reason_rank(spark, sf_dir, **shared) -> DataFrame:
    df = apply_filters(v2(spark, sf_dir), **shared)
    g = df.groupBy("reason_desc").agg(mean("death_reason_metric").alias("avg_death_reason_metric"))
    return g.select("*", _rank_desc("avg_death_reason_metric")).orderBy(
        "rank", "reason_desc")


def ws_region_rank(spark, sf_dir, indicator: str = MORTALITY, **shared) -> DataFrame:
    df = apply_filters(v2(spark, sf_dir), indicator=indicator, **shared)
    g = df.groupBy("region_name").agg(mean("indicator_metric").alias("avg_indicator_metric"))
    return g.select("*", _rank_desc("avg_indicator_metric")).orderBy(
        "rank", "region_name")


def ws_country_decade(spark, sf_dir) -> DataFrame:
    df = v1(spark, sf_dir).where(F.col("indicator_name") == MORTALITY)
    return (df.groupBy(decade_bin("date_year").alias("decade"), "country_name", "income_name")
            .agg(mean("indicator_metric").alias("avg_indicator_metric"))
            .orderBy(manual_order("income_name", INCOME_ORDER), "country_name", "decade"))


def ws_region_decade(spark, sf_dir, incomes=tuple(INCOMES)) -> DataFrame:
    df = v1(spark, sf_dir).where((F.col("indicator_name") == MORTALITY)
                                 & members("income_name", incomes))
    return (df.groupBy("region_name", decade_bin("date_year").alias("decade"), "income_name")
            .agg(mean("indicator_metric").alias("avg_indicator_metric"))
            .orderBy("region_name", manual_order("income_name", INCOME_ORDER), "decade"))


def ws_country_reason_decade(spark, sf_dir, decades=tuple(DECADES)) -> DataFrame:
    df = v1(spark, sf_dir).where(F.col("indicator_name") == MORTALITY)
    df = df.withColumn("decade", decade_bin("date_year")).where(members("decade", decades))
    return (df.groupBy("decade", "country_name", "income_name")
            .agg(mean("death_reason_metric").alias("avg_death_reason_metric"))
            .orderBy(manual_order("income_name", INCOME_ORDER), "country_name", "decade"))


# A12 + F13 + F15: bars per reason and a mean line with a 95 % band over them
def ws_reasons_ci(spark, sf_dir, region: str = CI_REGION, incomes=tuple(INCOMES),
                  reason_range=REASON_RANGE) -> DataFrame:
    df = v1(spark, sf_dir).where((F.col("indicator_name") == MORTALITY)
                                 & (F.col("region_name") == region)
                                 & member_range("reason_desc", *reason_range)
                                 & members("income_name", incomes))
    bars = (df.groupBy("reason_desc")
            .agg(mean("death_reason_metric").alias("avg_death_reason_metric"))
            .where(F.col("avg_death_reason_metric").isNotNull()))
    # second-level statistics over the bars: one row per reason, bounded
    pane = Window.partitionBy()
    m = F.avg("avg_death_reason_metric").over(pane)
    s = F.stddev_samp("avg_death_reason_metric").over(pane)
    n = F.count("avg_death_reason_metric").over(pane)
    half = F.lit(Z95) * s / F.sqrt(n)
    return bars.select("reason_desc", "avg_death_reason_metric",
                       F.round(m, 6).alias("pane_mean"),
                       F.round(m - half, 6).alias("band_low"),
                       F.round(m + half, 6).alias("band_high")
                       ).orderBy(F.col("avg_death_reason_metric").desc(), "reason_desc")


def ws_reasons_over_time(spark, sf_dir) -> DataFrame:
    return (v1(spark, sf_dir).groupBy("date_year", "reason_desc")
            .agg(mean("death_reason_metric").alias("avg_death_reason_metric"))
            .orderBy("date_year", "reason_desc"))


def ws_year_map(spark, sf_dir, year: int = MAP_YEAR) -> DataFrame:
    df = v1(spark, sf_dir).where((F.col("indicator_name") == GNI) & (F.col("date_year") == year))
    return df.groupBy("country_name").agg(mean("indicator_metric").alias("avg_indicator_metric"))


# Relation table without a measure
def ws_income_groups(spark, sf_dir, year: int = MAP_YEAR) -> DataFrame:
    df = v1(spark, sf_dir).where((F.col("indicator_name") == GNI) & (F.col("date_year") == year))
    return (df.select("country_name", "income_name").distinct()
            .orderBy(manual_order("income_name", INCOME_ORDER), "country_name"))


def ws_country_map_v1(spark, sf_dir, incomes=tuple(INCOMES), **shared) -> DataFrame:
    df = apply_filters(v1(spark, sf_dir), indicator=MORTALITY, **shared)
    df = df.where(members("income_name", incomes))
    return df.groupBy("country_name").agg(mean("indicator_metric").alias("avg_indicator_metric"))


def ws_income_trend(spark, sf_dir, incomes=tuple(INCOMES), reason_range=REASON_RANGE,
                    **shared) -> DataFrame:
    df = apply_filters(v1(spark, sf_dir), indicator=MORTALITY, **shared)
    df = df.where(members("income_name", incomes) & member_range("reason_desc", *reason_range))
    return (df.groupBy("date_year", "income_name")
            .agg(mean("indicator_metric").alias("avg_indicator_metric"))
            .orderBy("date_year", F.col("avg_indicator_metric").desc(), "income_name"))


def _region_over_time(spark, sf_dir, indicator: str, regions) -> DataFrame:
    df = v1(spark, sf_dir).where((F.col("indicator_name") == indicator)
                                 & members("region_name", regions))
    return (df.groupBy("date_year", "region_name")
            .agg(mean("indicator_metric").alias("avg_indicator_metric"))
            .orderBy(manual_order("region_name", REGION_ORDER), "date_year"))


def ws_region_gni(spark, sf_dir, regions=tuple(REGIONS)) -> DataFrame:
    return _region_over_time(spark, sf_dir, GNI, regions)


def ws_region_mortality(spark, sf_dir, regions=tuple(REGIONS)) -> DataFrame:
    return _region_over_time(spark, sf_dir, MORTALITY, regions)


# V1 repeats a mortality row once per reason where reasons exist, so the
# worksheet mean above is weighted by that fan-out. This variant averages
# each metric once (facts joined to the country snapshot, no reason join).
def ws_region_mortality_unfanned(spark, sf_dir, regions=tuple(REGIONS)) -> DataFrame:
    m = mart(spark, sf_dir)
    fm = m.table("fact_metrics").where(F.col("indicator_name") == MORTALITY)
    dc = m.table("dim_country").where(members("region_name", regions))
    j = fm.join(dc, ["country_key", "date_year"])
    return (j.groupBy("date_year", "region_name")
            .agg(mean("indicator_metric").alias("avg_indicator_metric"))
            .orderBy(manual_order("region_name", REGION_ORDER), "date_year"))


# --- one mechanism each -----------------------------------------------------

# P16 + P17 + C16 + C12..C14: calculated fields on the all-left view
def ws_calc_fields(spark, sf_dir) -> DataFrame:
    df = v1(spark, sf_dir)
    d = year_to_date("date_year")
    return df.select(
        "metric_id", "death_metric_id",
        F.col("indicator_metric").alias("metric_value"),
        F.when(F.col("income_name") == "High income", F.lit("High Income"))
         .otherwise(F.col("income_name")).alias("income_label"),
        F.col("date_tens").try_cast("double").alias("date_tens_real"),
        year_part(d).alias("year_of_date"),
        trunc_year(d).alias("year_start"))


# O2: manual member order, unlisted members last
def ws_manual_order(spark, sf_dir) -> DataFrame:
    df = v1(spark, sf_dir).where(F.col("indicator_name") == MORTALITY)
    g = df.groupBy("income_name").agg(mean("indicator_metric").alias("avg_indicator_metric"))
    pos = manual_order("income_name", INCOME_ORDER[:-1])
    return g.select("income_name", "avg_indicator_metric", pos.alias("sort_position")
                    ).orderBy("sort_position", "income_name")


# F14 + F16: the shared selector set; None = all members
def ws_param_filters(spark, sf_dir, country=None, income=None, year=1999, region="EUROPE",
                     reason=None) -> DataFrame:
    df = apply_filters(v1(spark, sf_dir), country=country, income=income, year=year,
                       region=region, reason=reason, indicator=MORTALITY)
    return df.groupBy("country_name", "income_name").agg(
        mean("indicator_metric").alias("avg_indicator_metric"),
        F.count(F.lit(1)).alias("n_rows"))


# F11 (T6): case-insensitive member range keeps upper-case members a binary
# BETWEEN would lose
def ws_reason_range(spark, sf_dir, lo: str = REASON_RANGE[0], hi: str = REASON_RANGE[1]) -> DataFrame:
    df = v1(spark, sf_dir).where(member_range("reason_desc", lo, hi))
    return df.groupBy("reason_desc").agg(
        F.count(F.lit(1)).alias("n_rows"),
        mean("death_reason_metric").alias("avg_death_reason_metric"))


# J13 + J14: the inner star, counted per year and reason
def ws_reason_star(spark, sf_dir) -> DataFrame:
    return v2(spark, sf_dir).groupBy("date_year", "reason_desc").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("death_reason_metric").cast("double").alias("sum_death_reason_metric"))


# A8 + A9 + A10: the model's measure menu per indicator
def measure_menu(spark, sf_dir) -> DataFrame:
    return v1(spark, sf_dir).groupBy("indicator_name").agg(
        F.max("indicator_metric").cast("double").alias("max_indicator_metric"),
        F.sum("indicator_metric").cast("double").alias("sum_indicator_metric"),
        F.count(F.lit(1)).alias("number_of_records"),
        F.count("country_name").alias("count_country_name"),
        F.max(F.year(year_to_date("date_year"))).alias("max_year"))


# Region x decade grid
def region_decade_grid(spark, sf_dir, decades=tuple(DECADES)) -> DataFrame:
    df = v1(spark, sf_dir).where(F.col("indicator_name") == MORTALITY).withColumn(
        "decade", decade_bin("date_year"))
    return (df.groupBy("region_name").pivot("decade", list(decades))
            .agg(mean("indicator_metric")))


# The stored extract of the all-left view (written by the build, full
# refresh), counted per indicator and year
def extract(spark, sf_dir) -> DataFrame:
    return (mart(spark, sf_dir).table("extract_v1").groupBy("indicator_name", "date_year")
            .agg(F.count(F.lit(1)).alias("n_rows")))
