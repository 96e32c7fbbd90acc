"""J12 against a plain double loop; its keys and its spread."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from vitalmart.operators.joins import interval_join


def plain(values, bands, left=False):
    out = Counter()
    for i, y, v in values:
        hits = [n for b, lo, hi, n in bands if y is not None and v is not None and b == y and lo is not None and hi is not None and lo <= v <= hi]
        out.update((i, y, v, n) for n in hits)
        if left and not hits:
            out[i, y, v, None] += 1
    return out


def case(seed=3):
    rnd = random.Random(seed)
    values = [(i, 2000 + i % 3, rnd.randrange(0, 20000) / 2) for i in range(900)]
    values += [(1000 + i, 2001, 480.0) for i in range(3000)]                     # one value, most of a year
    values += [(5000, None, 3.0), (5001, 2000, None), (5002, 1999, 5.0), (5003, 2000, 1e12), (5004, 2000, -1.0)]
    edges = [0, 480, 481, 2500, 2501, 6000, 6001, 1000000]
    bands = [(y, edges[k], edges[k + 1], f"b{k}") for y in (2000, 2001, 2002, 2010) for k in range(0, 8, 2)]
    bands += [(2001, 100, 7000, "wide"), (2000, None, 5, "no start"), (2002, 9, 1, "upside down"), (2001, 480, 480, "point"),
              (2001, 480, 480, "point")]
    return values, bands


@pytest.mark.parametrize("rows", [10, 100, 1 << 20])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_interval_join(spark, rows, how):
    values, bands = case()
    v = spark.createDataFrame(values, "i int, year int, v double").repartition(4)
    b = spark.createDataFrame(bands, "year int, lo bigint, hi bigint, name string")
    j = interval_join(v, b, "year", "v", "lo", "hi", how, rows=rows)
    assert j.columns == ["i", "year", "v", "lo", "hi", "name"]
    assert Counter((r.i, r.year, r.v, r.name) for r in j.collect()) == plain(values, bands, how == "left")


def test_empty_sides(spark):
    values, bands = case()
    v, b = spark.createDataFrame(values, "i int, year int, v double"), spark.createDataFrame(bands, "year int, lo bigint, hi bigint, name string")
    assert interval_join(v.where("false"), b, "year", "v", "lo", "hi").count() == 0
    assert interval_join(v, b.where("false"), "year", "v", "lo", "hi").count() == 0
    assert interval_join(v, b.where("false"), "year", "v", "lo", "hi", "left").count() == len(values)


def test_a_hot_year_is_spread(spark):
    """90 % of the values in one year, half of those one value: no (year,
    bucket, part) key keeps more than a few per cent of the rows."""
    v = spark.range(20000, numPartitions=4).select(
        F.when(F.col("id") % 10 > 0, 2001).otherwise(2002).alias("year"),
        F.when(F.col("id") % 2 == 0, 7.0).otherwise((F.col("id") % 9973).cast("double")).alias("v"))
    b = spark.createDataFrame([(2001, 0, 5000, "a"), (2001, 5001, 20000, "b"), (2002, 0, 20000, "c")],
                              "year int, lo bigint, hi bigint, name string")
    j = interval_join(v, b, "year", "v", "lo", "hi", rows=500)
    assert j.count() == 20000
    plan = j._jdf.queryExecution().optimizedPlan().toString()
    join = next(line for line in plan.splitlines() if "Join Inner" in line and "__part" in line)
    assert "__year" in join and "__bucket" in join
    # the left side's keys, as the join meets them
    left = j._jdf.queryExecution().analyzed().children().head().children().head()
    rows = spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, left)
    from pyspark.sql import DataFrame
    sizes = [r["count"] for r in DataFrame(rows, spark).groupBy("__year", "__bucket", "__part").count().collect()]
    assert sum(sizes) == 20000 and max(sizes) <= 1200 and len(sizes) > 25
