"""Staging layer built from the driver's tables (the mapping of SURVEY §7.2).

The only step whose cost grows with the data is ``cells``: one pass over
lineitem and orders, aggregated to (nation, year, priority). Everything
downstream is bounded by countries x years x reasons.

Plan of ``cells`` at scale:
  lineitem --partial agg by l_orderkey--> shuffle(l_orderkey)  (~4x fewer rows)
  orders ---------------------------------> shuffle(o_orderkey)  -> SMJ, left
  -> partial agg by (customer, year, priority), so that a hot customer is a
     few rows per task before anything is joined -> x customer(c_custkey)
  -> partial agg by (nation, year, priority) -> tiny final shuffle
All sums are DECIMAL, so partial aggregation order never changes a result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalmart.constants import (AGGREGATE_REGION, INCOME_BAND_TEXTS, INCOME_NAMES, INDICATORS,
                                 NAME_MAP)
from vitalmart.functions.stats import MONEY, cents_mean
from vitalmart.functions.text import bounds_from_parts, income_code, map_names, split_band
from vitalmart.operators.joins import interval_join
from vitalmart.operators.keys import first_seen_ids, name_ids, with_position
from vitalmart.sources.tables import table


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = (table(spark, sf_dir, "lineitem")
          .groupBy("l_orderkey")
          .agg(F.sum(F.col("l_quantity").cast(MONEY)).alias("qty"),
               F.count(F.lit(1)).alias("lines")))
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey",
        F.year("o_orderdate").alias("year"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_totalprice").cast(MONEY).alias("price"))
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    ol = (o.join(li, o["o_orderkey"] == li["l_orderkey"], "left")
          .select("o_custkey", "year", "priority", "price", "qty", "lines",
                  F.lit(1).cast("bigint").alias("orders")))
    # a hot customer would land whole in one join task: aggregated per
    # (customer, year, priority) first, it collapses map-side to at most
    # years x priorities rows
    ol = ol.groupBy("o_custkey", "year", "priority").agg(
        F.sum("price").alias("price"), F.sum("qty").alias("qty"),
        F.sum("lines").alias("lines"), F.sum("orders").alias("orders"))
    j = ol.join(c, ol["o_custkey"] == c["c_custkey"], "inner")
    return (j.groupBy(F.col("c_nationkey").alias("nationkey"), "year", "priority")
            .agg(F.sum("qty").alias("sum_qty"),
                 F.sum("lines").alias("n_lines"),
                 F.sum("price").alias("sum_price"),
                 F.sum("orders").alias("n_orders")))


def nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation x region names."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return n.join(r, n["n_regionkey"] == r["r_regionkey"]).select(
        "n_nationkey", "n_name", "n_regionkey", "r_name")


def _spelling(key, fallback, side: int):
    """Country name of nation ``key`` on one side of the name dictionary."""
    names = F.array(*[F.lit(pair[side]) for pair in NAME_MAP])
    return F.when(key < len(NAME_MAP), F.element_at(names, (key + 1).cast("int"))
                  ).otherwise(fallback)


def indicator_side_name(key, fallback):
    return _spelling(key, fallback, 1)


def cause_side_name(key, fallback):
    return _spelling(key, fallback, 0)


# Region ids by first appearance in the country list (the aggregate
# pseudo-region keeps its id, it is dropped from countries only). Names are
# trimmed here, once, so that later equality filters need no padding rules.
def stg_region(nat: DataFrame) -> DataFrame:
    return (first_seen_ids(nat, "r_name", "n_nationkey", "region_id")
            .select(F.col("region_id").cast("int"), F.trim("r_name").alias("region_name")))


# S5 + J1 + P5: countries with region ids; ``drop_region`` mirrors the
# removal of the aggregate rows (F1, NULL-safe "<>")
def stg_country(nat: DataFrame, region: DataFrame, drop_region: str | None = None) -> DataFrame:
    c = nat
    if drop_region is not None:
        c = c.where(~F.col("r_name").eqNullSafe(drop_region))
    c = c.join(region, F.trim(c["r_name"]) == region["region_name"], "inner")
    k = F.col("n_nationkey")
    return c.select(
        (k + 1).cast("int").alias("country_id"),
        indicator_side_name(k, F.col("n_name")).alias("country_name"),
        F.lpad(k.cast("string"), 2, "0").alias("iso2code"),
        F.concat(F.lit("N"), F.lpad(k.cast("string"), 2, "0")).alias("iso3Code"),
        F.col("region_id"))


def stg_income_group(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(INCOME_NAMES, "income_group_id int, income_name string")


INDICATOR_NOTES = {
    1: "exact mean of l_quantity per nation and order year",
    2: "exact mean of o_totalprice per nation and order year",
}


def stg_indicator(spark: SparkSession) -> DataFrame:
    rows = [(i, name, code, None, INDICATOR_NOTES[i]) for i, name, code in INDICATORS]
    return spark.createDataFrame(
        rows, "indicator_id int, indicator_name string, world_bank_ind_id string, "
              "source_organization string, source_note string")


def nation_years(cells_df: DataFrame) -> DataFrame:
    return (cells_df.groupBy("nationkey", "year")
            .agg(F.sum("sum_qty").alias("sum_qty"), F.sum("n_lines").alias("n_lines"),
                 F.sum("sum_price").alias("sum_price"), F.sum("n_orders").alias("n_orders")))


# S7 + F3 + P4 + U4: the two indicator series (by country name, as the
# series source names countries), one table, ids 1 and 2
def series(cells_df: DataFrame, nat: DataFrame) -> DataFrame:
    ny = nation_years(cells_df)
    ny = ny.join(nat.select("n_nationkey", "n_name"),
                 ny["nationkey"] == F.col("n_nationkey"))
    name = indicator_side_name(F.col("nationkey"), F.col("n_name")).alias("name")
    ind1 = ny.select(name, "year", F.lit(1).alias("indicator_id"),
                                  cents_mean("sum_qty", "n_lines").alias("value"))
    ind2 = ny.select(name, "year", F.lit(2).alias("indicator_id"),
                     cents_mean("sum_price", "n_orders").alias("value"))
    return ind1.unionByName(ind2).where(F.col("value").isNotNull())


# J2 + W3: series x countries by name (inner), then one row id per value,
# under-5 rows first (the id the cause rows refer to)
def stg_indicator_per_country(cells_df: DataFrame, nat: DataFrame, country: DataFrame) -> DataFrame:
    s = series(cells_df, nat).join(
        country.select("country_id", F.col("country_name").alias("name")),
        "name", "inner")
    s = with_position(s, ["indicator_id", "country_id", "year"], "indicator_per_country_id")
    return s.select(F.col("indicator_per_country_id").cast("bigint"), "value",
                    F.col("year").cast("int"), F.col("indicator_id").cast("int"), "country_id")


# Reason ids by binary name order, like a sorted file listing
def stg_death_reason(cells_df: DataFrame) -> DataFrame:
    return (name_ids(cells_df.select(F.col("priority").alias("reason_name")), "reason_name",
                     "death_reason_id")
            .select(F.col("death_reason_id").cast("int"), "reason_name"))


# Long cause values per (country as the cause source spells it, year,
# reason)
def reason_values(cells_df: DataFrame, nat: DataFrame) -> DataFrame:
    c = cells_df.join(nat.select("n_nationkey", "n_name"),
                      cells_df["nationkey"] == F.col("n_nationkey"))
    return c.select(
        cause_side_name(F.col("nationkey"), F.col("n_name")).alias("name"),
        F.col("year").cast("int").alias("year"),
        F.col("priority").alias("reason_name"),
        cents_mean("sum_qty", "n_lines").alias("value_per_reason"))


# C5 + J3: dictionary-mapped names x under-5 rows on (name, year)
def stg_indicator_per_country_per_reason(rv: DataFrame, ipc: DataFrame, country: DataFrame,
                                         reasons: DataFrame) -> DataFrame:
    rv = rv.withColumn("name", map_names("name"))
    u5 = (ipc.where(F.col("indicator_id") == 1)
          .join(country.select("country_id", F.col("country_name").alias("name")),
                "country_id")
          .select("indicator_per_country_id", "name", "year"))
    j = rv.join(u5, ["name", "year"], "inner").join(reasons, "reason_name")
    return j.select("value_per_reason", F.col("death_reason_id").alias("reason_id"),
                    "indicator_per_country_id")


# S4 + P11/P15 + C1..C8: the band sheet as long text rows per year, parsed
def band_texts(cells_df: DataFrame) -> DataFrame:
    years = cells_df.select("year").distinct()
    texts = F.array(*[F.struct(F.lit(lbl).alias("income"), F.lit(txt).alias("value"))
                      for lbl, txt in INCOME_BAND_TEXTS])
    return years.select("year", F.inline(texts))


def income_bounds(texts: DataFrame) -> DataFrame:
    # the split is its own projection, computed once per row; the bounds are
    # derived from its two parts (this also keeps generated code valid when
    # the input comes straight from an unpivot)
    lo_raw, hi_raw = split_band("value")
    parts = texts.select("income", "year", lo_raw.alias("lo_raw"), hi_raw.alias("hi_raw"))
    lo, hi = bounds_from_parts("lo_raw", "hi_raw")
    return parts.select("income", "year", lo.alias("lower_bound"), hi.alias("upper_bound"))


def stg_income_group_year(cells_df: DataFrame) -> DataFrame:
    b = income_bounds(band_texts(cells_df)).withColumn(
        "income_group_id", income_code("income"))
    b = with_position(b, ["year", "income_group_id"], "income_group_year_id")
    return b.select(F.col("income_group_year_id").cast("int"),
                    F.col("income_group_id").cast("int"), F.col("year").cast("int"),
                    "lower_bound", "upper_bound",
                    F.col("income").alias("income_group_name"))


# Each GNI value into the band of its year (body of the band procedure)
def stg_income_group_country(ipc: DataFrame, igy: DataFrame) -> DataFrame:
    gni = ipc.where(F.col("indicator_id") == 2).select("country_id", "year", "value")
    return (interval_join(gni, igy, "year", "value", "lower_bound", "upper_bound")
            .select("country_id", "income_group_year_id"))
