"""Readers for the driver's parquet tables and for CSV landing files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table; Catalyst prunes columns and pushes filters into it."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# One headed CSV with a fixed schema (no inference pass over the data).
# Quotes inside a field are doubled. ``multi_line`` takes quoted line breaks;
# such a file is one task, so it is for lists, not for data-sized files.
def read_csv(spark: SparkSession, path: str, schema: StructType | None = None,
             header: bool = True, sep: str = ",", quote: str = '"',
             multi_line: bool = False) -> DataFrame:
    r = (spark.read.option("header", header).option("sep", sep).option("quote", quote)
         .option("escape", quote).option("multiLine", multi_line))
    if schema is not None:
        r = r.schema(schema)
    return r.csv(path)


# Many files in one scan; the file name becomes a column
def read_csv_files(spark: SparkSession, paths, schema: StructType | None = None,
                   header: bool = True) -> DataFrame:
    r = spark.read.option("header", header).option("escape", '"')
    if schema is not None:
        r = r.schema(schema)
    df = r.csv(paths)
    return df.withColumn("file_name", F.col("_metadata.file_name"))


def file_stem(c: Column) -> Column:
    """`Malaria.csv` -> `Malaria`."""
    return F.regexp_replace(c, r"\.csv$", "")


# A sheet exported as a headerless grid (_c0, _c1, ...); with a schema, a
# line may be shorter than it, and the file may hold quoted line breaks
def read_grid(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    r = spark.read.option("header", False).option("escape", '"')
    return (r.schema(schema).option("multiLine", True) if schema else r).csv(path)


# S9: ';'-separated, double-quoted export with a header (quotes doubled inside)
def read_export(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    r = (spark.read.option("header", True).option("sep", ";").option("quote", '"')
         .option("escape", '"'))
    if schema is not None:
        r = r.schema(schema)
    return r.csv(path)
