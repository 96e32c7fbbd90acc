"""The stated research questions that no worksheet answers directly."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitalmart.constants import GNI, MORTALITY
from vitalmart.functions.stats import mean
from vitalmart.plans.star import mart


def _mortality_by_country(spark, sf_dir) -> DataFrame:
    """Un-fanned mortality values with their country snapshot."""
    m = mart(spark, sf_dir)
    fm = m.table("fact_metrics").where(F.col("indicator_name") == MORTALITY)
    dc = m.table("dim_country")
    return fm.join(dc, ["country_key", "date_year"]).select(
        "country_name", "region_name", "income_name", "date_year", "indicator_metric")


# countries above a rate x for one cause
def above_threshold(spark, sf_dir, reason: str = "1-URGENT", x: float = 26.0) -> DataFrame:
    df = mart(spark, sf_dir).v1().where((F.col("reason_desc") == reason)
                                        & (F.col("death_reason_metric") > x))
    return df.select("country_name", "date_year", "death_reason_metric").distinct()


# W6 + O5: biggest fall of the rate over the last `span` years (top 1). The
# earlier value is found by an equi-join on year - span (exact year offset,
# not "span rows back"), so a missing year never shifts the comparison.
def biggest_decrease(spark, sf_dir, span: int = 5) -> DataFrame:
    v = _mortality_by_country(spark, sf_dir).select("country_name", "date_year",
                                                    "indicator_metric")
    last = v.agg(F.max("date_year").alias("y_to"))
    now = v.join(F.broadcast(last), v["date_year"] == last["y_to"]).select(
        "country_name", "y_to", F.col("indicator_metric").alias("value_to"))
    before = v.select("country_name", F.col("date_year").alias("y_from"),
                      F.col("indicator_metric").alias("value_from"))
    j = now.join(before, (now["country_name"] == before["country_name"])
                 & (before["y_from"] == now["y_to"] - span)).select(
        now["country_name"], "y_from", "y_to", "value_from", "value_to",
        (F.col("value_to") - F.col("value_from")).alias("change"))
    return j.orderBy(F.col("change").asc(), F.col("country_name").asc()).limit(1)


# Top-n causes of each selected year by mean rate
def top_causes_by_year(spark, sf_dir, years=(2001, 1997), n: int = 3) -> DataFrame:
    df = mart(spark, sf_dir).v1().where(F.col("date_year").isin(list(years))
                                        & F.col("reason_desc").isNotNull())
    g = df.groupBy("date_year", "reason_desc").agg(
        mean("death_reason_metric").alias("avg_death_reason_metric"))
    w = Window.partitionBy("date_year").orderBy(F.col("avg_death_reason_metric").desc_nulls_last())
    return (g.withColumn("rank", F.rank().over(w)).where(F.col("rank") <= n)
            .orderBy("date_year", "rank", "reason_desc"))


# Correlation of income (GNI) and the rate per region, paired on
# (country snapshot, year)
def corr_income(spark, sf_dir) -> DataFrame:
    m = mart(spark, sf_dir)
    fm = m.table("fact_metrics")
    mort = fm.where(F.col("indicator_name") == MORTALITY).select(
        "country_key", "date_year", F.col("indicator_metric").cast("double").alias("rate"))
    gni = fm.where(F.col("indicator_name") == GNI).select(
        "country_key", "date_year", F.col("indicator_metric").cast("double").alias("gni"))
    dc = m.table("dim_country").select("country_key", "region_name")
    pairs = mort.join(gni, ["country_key", "date_year"]).join(dc, "country_key")
    return pairs.groupBy("region_name").agg(
        F.count(F.lit(1)).alias("n_pairs"),
        F.round(F.corr("rate", "gni"), 6).alias("corr_rate_gni"))
