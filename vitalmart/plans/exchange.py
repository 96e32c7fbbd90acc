"""Tables written and read back through the file formats of the loads.

Each query writes a table of the mart once (published like the mart's own
tables) and returns what the reader makes of it, with the declared types.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitalmart.constants import AGGREGATE_REGION
from vitalmart.functions.dates import year_part, year_to_date
from vitalmart.functions.text import map_names
from vitalmart.operators.keys import delete_tables, noted_positions
from vitalmart.plans import staging as st
from vitalmart.plans.landing import cause_measures, file_ids
from vitalmart.plans.landing_files import cause_values, wdi
from vitalmart.plans.raw import landing_lists
from vitalmart.plans.star import mart
from vitalmart.schemas import COUNTRY, DIM_REASON_EXPORT, STAR
from vitalmart.sources.csv_blocks import read_quoted_csv
from vitalmart.sources.tables import read_csv, read_export, table
from vitalmart.sources.writers import append_table, create_empty, write_csv, write_export


def _published(m, name: str, write) -> str:
    if not m.exists(name):
        m.publish(name, write)
    return m.path(name)


# S1 + S13: the cleaned country list as headed CSV, read with its schema
def country_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = mart(spark, sf_dir)
    path = _published(m, "landing_country_csv", lambda p: write_csv(m.table("country"), p))
    return read_csv(spark, path, COUNTRY)


# The ';'-separated export of the reason dimension
def reason_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = mart(spark, sf_dir)
    path = _published(m, "export_dim_reason", lambda p: write_export(m.table("dim_reason"), p))
    return read_export(spark, path, DIM_REASON_EXPORT)


# The two series appended to one staging table, one after the other
def appended_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = mart(spark, sf_dir)
    ipc = m.table("indicator_per_country")

    def write(path):
        for indicator_id in (1, 2):
            append_table(ipc.where(F.col("indicator_id") == indicator_id), path)
    return spark.read.parquet(_published(m, "staging_appended_series", write))


# A star table made empty with its declared types, then filled
def declared_fact(spark: SparkSession, sf_dir: str, name: str = "fact_metrics") -> DataFrame:
    m = mart(spark, sf_dir)
    schema = STAR[name]

    def write(path):
        create_empty(spark, schema, path)
        append_table(m.table(name).select(
            *[F.col(f.name).cast(f.dataType) for f in schema.fields]), path)
    return spark.read.schema(schema).parquet(_published(m, f"declared_{name}", write))


# A year kept as a date on one side and as a number on the other
def retyped_year_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = mart(spark, sf_dir)
    dated = m.table("dim_date").where(F.col("date_year") > 0).select(
        year_to_date("date_year").alias("year_date"), "date_string", "date_tens")
    facts = m.table("fact_metrics").select("metric_id", "date_year")
    return facts.join(dated, F.col("date_year") == year_part(F.col("year_date"))).select(
        "metric_id", "date_year", "year_date", "date_string", "date_tens")


# raw -> landing: the country listing (a nation's income level is its band of
# the last year) to the three sheets, read back as the load reads them
def raw_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = mart(spark, sf_dir)
    sheets = ("Region", "Income_group", "Country")
    if not all(m.exists(f"raw/WDI/{s}.csv") for s in sheets):
        bands = m.table("income_group_year").select("income_group_year_id", "income_group_id", "year")
        last = (m.table("income_group_country").join(bands, "income_group_year_id")
                .join(m.table("income_group"), "income_group_id")
                .groupBy("country_id").agg(F.max_by("income_name", "year").alias("incomeLevel")))
        c = m.table("country").join(m.table("region"), "region_id").join(last, "country_id", "left")
        listing = c.select(
            F.col("country_id").alias("position"), F.col("iso3Code").alias("id"),
            F.col("iso2code").alias("iso2Code"), F.col("country_name").alias("name"),
            F.col("region_name").alias("region"),
            F.coalesce("incomeLevel", F.lit("Not classified")).alias("incomeLevel"))
        with noted_positions() as used:
            try:
                for name, sheet in landing_lists(listing, AGGREGATE_REGION).items():
                    _published(m, f"raw/WDI/{name}.csv",
                               lambda p, s=sheet: write_csv(s.withColumnRenamed("_row", ""), p))
            finally:
                delete_tables(spark, used)
    root = m.path("raw")
    return wdi(spark, root, "Country").select(
        (F.col("_row") + 1).cast("int").alias("country_id"), F.col("name").alias("country_name"),
        F.col("iso2Code").alias("iso2code"), "iso3Code",
        F.col("index_region").cast("int").alias("region_id"), F.col("region").alias("region_name"),
        F.col("index_income").cast("int").alias("income_id"), F.col("incomeLevel").alias("income_name"))


# S1 + S12: whole documents as headed CSV (line breaks, quotes and separators
# inside the texts), read back by byte blocks
def quoted_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")

    def write(path):
        (docs.write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False)
         .option("ignoreTrailingWhiteSpace", False).csv(path))
    back = read_quoted_csv(spark, _published(mart(spark, sf_dir), "landing_documents_csv", write))
    return back.select(F.col("doc_id").cast("bigint"), "source", "text")


# U3 + P13: one file per cause whose headers differ. The five kinds of header
# go round over the causes in name order: years rising; falling; rising without
# the first year; falling with a row-number column in front; rising with that
# column and the block numbers written out (Y, Y.1, Y.2).
def write_unlike_cause_files(spark: SparkSession, sf_dir: str) -> str:
    measures = cause_measures(spark, sf_dir)
    kinds = file_ids(spark, sf_dir).select("reason_name", ((F.col("death_reason_id") - 1) % 5).alias("kind"))
    rising = F.sort_array(F.collect_set("year"))  # of one cause: as many as there are years
    years = (measures.groupBy("reason_name").agg(rising.alias("years")).join(kinds, "reason_name")
             .withColumn("years", F.when(F.col("kind") == 2, F.slice("years", 2, F.size("years")))
                         .when(F.col("kind").isin(1, 3), F.reverse("years")).otherwise(F.col("years")))
             .withColumn("numbered", F.col("kind").isin(3, 4)))
    first = F.when(F.col("numbered"), F.array(F.lit(""), F.lit(""))).otherwise(F.array(F.lit("")))

    def blocks(of):  # three columns per year
        return F.flatten(F.transform("years", of))

    def sub_header(k):  # after the header, rows that aren't data
        return F.concat(first, blocks(lambda y: F.array(*[F.lit(f"sub {k}") for _ in range(3)])))

    label = blocks(lambda y: F.transform(F.array(F.lit(""), F.lit(".1"), F.lit(".2")), lambda s: F.concat(
        y.cast("string"), F.when(F.col("kind") == 4, s).otherwise(F.lit("")))))
    heads = years.select("reason_name", F.posexplode(F.array(F.concat(first, label), *map(sub_header, (1, 2, 3)))).alias("at", "cells"))
    value = F.struct(F.col("n_orders").cast("string"), F.col("n_lines").cast("string"), F.col("value_per_reason").cast("string"))
    of_year = F.map_from_entries(F.collect_list(F.struct("year", value.alias("v"))))
    per_row = measures.groupBy("reason_name", "name").agg(of_year.alias("of_year"))
    place = F.row_number().over(Window.partitionBy("reason_name").orderBy("name"))  # one row per country
    quoted = F.concat(F.lit('"'), F.replace("name", F.lit('"'), F.lit('""')), F.lit('"'))
    body = (per_row.join(years, "reason_name").withColumn("place", place)
            .select("reason_name", (F.col("place") + 3).alias("at"), F.concat(
                F.when(F.col("numbered"), F.array((F.col("place") - 1).cast("string"), quoted)).otherwise(F.array(quoted)),
                blocks(lambda y: F.transform(F.array(*[F.try_element_at("of_year", y)[c] for c in ("col1", "col2", "col3")]),
                                             lambda c: F.coalesce(c, F.lit(""))))).alias("cells")))
    out = (heads.unionByName(body).select("reason_name", "at", F.array_join("cells", ",").alias("line"))
           .repartition("reason_name").sortWithinPartitions("reason_name", "at").select("reason_name", "line"))
    return _published(mart(spark, sf_dir), "landing_unlike_causes", lambda p: out.write.partitionBy("reason_name").text(p))


def unlike_cause_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    reason = F.url_decode(F.replace(F.regexp_extract("file", "/reason_name=([^/]+)/", 1), F.lit("+"), F.lit("%2B")))
    long = cause_values(spark, write_unlike_cause_files(spark, sf_dir), reason)
    return long.select("reason_name", map_names("name").alias("name"), "year", "value_per_reason")
