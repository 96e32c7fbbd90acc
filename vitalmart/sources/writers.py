"""Set-based writers (never row by row)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType


# A frame as CSV (no index column is written: positions, where they
# matter, are explicit columns)
def write_csv(df: DataFrame, path: str, header: bool = True, sep: str = ",") -> None:
    (df.write.mode("overwrite").option("header", header).option("sep", sep)
     .option("escape", '"').csv(path))


# Full-refresh table (CTAS semantics)
def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


# Append into a staging table
def append_table(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


# An empty table with its declared schema
def create_empty(spark: SparkSession, schema: StructType, path: str) -> DataFrame:
    df = spark.createDataFrame([], schema)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(schema).parquet(path)


# S9's counterpart: ';'-separated export with a header, string fields in
# double quotes (embedded quotes doubled), numbers bare; a headed file per task
def write_export(df: DataFrame, path: str) -> None:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, StringType):
            c = F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
        cols.append(c.cast("string").alias(f.name))
    (df.select(*cols).write.mode("overwrite")
     .option("header", True).option("sep", ";").option("quote", "")
     .option("nullValue", "").csv(path))
