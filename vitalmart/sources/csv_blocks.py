"""Quoted CSV read by many tasks, line breaks inside quotes included.

A text scan deals a file out by byte blocks; each block's lines know the block
they begin in. Whether a line begins inside quotes depends on the number of
quote marks in all of the file before it: each block counts its marks (odd or
even) and what it would hold under either start, and these rows, one per
block, are combined by a prefix sum per file. Every line then knows its record
by itself; only records of several lines are put together by a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitalmart.sources.tables import read_csv

#: A cell after its separator: quoted (marks inside are doubled) or plain.
CELL = r',("(?:[^"]++|"")*+"|[^,]*)'


def lines(spark: SparkSession, path) -> DataFrame:
    """(file, block, at, value): the lines of the files of ``path``; block is
    where the line's byte block starts, ``at`` rises along each block."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), "value")


def numbered_lines(spark: SparkSession, path) -> DataFrame:
    """(file, line, value): S4's position of a line in its file, from 0, from
    counts per block and their prefix sums; no sort of the file."""
    own = lines(spark, path)
    blocks = own.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("file", "block", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    # within a block a task's ids follow each other
    return own.join(starts, ["file", "block"]).select("file", (F.col("before") + F.col("at") - F.col("first")).alias("line"), "value")


def records(spark: SparkSession, path, quote: str = '"') -> DataFrame:
    """(file, record, text): the records of the CSV files of ``path``, numbered
    from 0 in each file; blank lines between records aren't any."""
    own = lines(spark, path).withColumn("marks", F.length("value") - F.length(F.replace("value", F.lit(quote), F.lit(""))))
    by = Window.partitionBy("file", "block").orderBy("at")
    odd = F.pmod(F.coalesce(F.sum("marks").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), F.lit(2)) == 1
    blank = F.trim(F.replace("value", F.lit("\r"), F.lit(""))) == ""
    own = own.withColumn("odd", odd).withColumn("blank", blank)  # as if the block began outside of quotes

    # per block: its parity, and the records that begin in it under either start
    shape = own.groupBy("file", "block").agg(
        F.pmod(F.sum("marks"), F.lit(2)).alias("parity"),
        F.count_if(~F.col("odd") & ~F.col("blank")).alias("if_outside"),
        F.count_if(F.col("odd") & ~F.col("blank")).alias("if_inside"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    shape = shape.withColumn("inside", F.pmod(F.coalesce(F.sum("parity").over(earlier), F.lit(0)), F.lit(2)) == 1)
    begun = F.when(F.col("inside"), F.col("if_inside")).otherwise(F.col("if_outside"))
    starts = shape.select("file", "block", "inside", F.coalesce(F.sum(begun).over(earlier), F.lit(0)).alias("before"))

    told = (own.join(starts, ["file", "block"])
            .withColumn("within", F.col("odd") != F.col("inside"))          # the line begins inside quotes
            .where(F.col("within") | ~F.col("blank")))
    upto = by.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    told = told.withColumn("record", F.col("before") + F.sum((~F.col("within")).cast("bigint")).over(upto) - 1)
    whole = ~F.col("within") & (F.pmod(F.col("marks"), F.lit(2)) == 0)
    tail = lambda c: F.regexp_replace(c, r"\r$", "")
    single = told.where(whole).select("file", "record", tail("value").alias("text"))
    broken = (told.where(~whole).groupBy("file", "record")
              .agg(F.sort_array(F.collect_list(F.struct("block", "at", "value"))).alias("parts"))
              .select("file", "record", tail(F.array_join(F.col("parts.value"), "\n")).alias("text")))
    return single.unionByName(broken)


def cells(text) -> Column:
    """The cells of a record; an empty one without quotes is NULL."""
    found = F.regexp_extract_all(F.concat(F.lit(","), text), F.lit(CELL), F.lit(1))
    return F.transform(found, lambda c: F.when(
        c.startswith('"'), F.replace(F.substring(c, F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"')))
        .when(c != "", c))


def read_quoted_csv(spark: SparkSession, path) -> DataFrame:
    """S1 for data-sized files: headed CSV files of one header, all columns as
    text, as ``read_csv(..., multi_line=True)`` gives them, by many tasks."""
    names = read_csv(spark, path, multi_line=True).columns  # reads the first record only
    body = records(spark, path).where("record > 0").select(cells("text").alias("c"))
    return body.select(*[F.get("c", F.lit(i)).alias(n) for i, n in enumerate(names)])
