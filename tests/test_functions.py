from decimal import Decimal

from pyspark.sql import functions as F

from vitalmart.functions.dates import decade_bin, decade_case, trunc_year, year_part, year_to_date
from vitalmart.functions.stats import cents_mean, mean
from vitalmart.functions.text import (band_bounds, clean_name, income_code, key_to_name,
                                      map_names, nan_to_null, year_from_label)


def col_values(spark, values, expr, schema="v string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(expr("v")).collect()]


def test_band_bounds(spark):
    df = spark.createDataFrame([("<= 480",), ("1,941-6,000",), ("> 6,000",), ("n/a-x",)], "v string")
    lo, hi = band_bounds("v")
    got = [tuple(r) for r in df.select(lo, hi).collect()]
    assert got == [(0, 480), (1941, 6000), (6000, 1000000), (None, None)]


def test_income_code(spark):
    labels = ["High income (H)", "Low income (L)", "Lower middle income (LM)",
              "Upper middle income (UM)", "Other"]
    assert col_values(spark, labels, income_code) == [1, 2, 3, 4, 0]


def test_name_map_and_mojibake_key(spark):
    names = ["Czechia", "Republic of Korea", "CÃ´te d'Ivoire", "France", None]
    assert col_values(spark, names, map_names) == [
        "Czech Republic", "Korea, Rep.", "Cote d'Ivoire", "France", None]


def test_year_label(spark):
    assert col_values(spark, ["2017.2", "2000", "x"], year_from_label) == [2017, 2000, None]


def test_decades(spark):
    years = [1960, 1969, 2018, 2029, 2030, 1959]
    assert col_values(spark, years, decade_case, "v int") == [
        "1960", "1960", "2010", "2020", None, None]
    assert col_values(spark, [1987, 2018, 2019], decade_bin, "v int") == ["1980s", "2010s", "2019"]


def test_year_as_date(spark):
    df = spark.createDataFrame([(1995,)], "v int")
    d = year_to_date("v")
    r = df.select(d.alias("d"), year_part(d).alias("y"), trunc_year(d).alias("t")).first()
    assert str(r.d) == "1995-01-01" and r.y == 1995 and str(r.t) == "1995-01-01"


def test_clean_and_keys(spark):
    assert col_values(spark, [" HIV/AIDS"], clean_name) == ["HIVAIDS"]
    keys = ["WHO/Malaria.csv", "WHO/", "WDI/Region.csv"]
    assert col_values(spark, keys, key_to_name) == ["Malaria", None, None]


def test_nan_to_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.5,), (None,)], "v double")
    assert [r[0] for r in df.select(nan_to_null("v")).collect()] == [None, 1.5, None]


def test_cents_mean_rounds_half_up_exactly(spark):
    df = spark.createDataFrame(
        [(Decimal("10.70"), 4), (Decimal("0.05"), 2), (Decimal("1.00"), 3), (Decimal("5.00"), 0)],
        "s decimal(22,2), n bigint")
    got = [r[0] for r in df.select(cents_mean("s", "n")).collect()]
    # 2.675 -> 2.68 (a binary double would give 2.67), 0.025 -> 0.03
    assert got == [Decimal("2.68"), Decimal("0.03"), Decimal("0.33"), None]


def test_mean_skips_nulls(spark):
    df = spark.createDataFrame([(Decimal("1.00"),), (None,), (Decimal("2.00"),)], "v decimal(10,2)")
    assert df.agg(mean("v")).first()[0] == 1.5
    assert df.where(F.col("v").isNull()).agg(mean("v")).first()[0] is None


def test_date_typed_year_joins_int_year(spark):
    # A year the BI model parsed into a date joins an int year through year()
    dates = spark.createDataFrame([(1995,), (1996,)], "y int").select(year_to_date("y").alias("d"))
    years = spark.createDataFrame([(1995, "a"), (1997, "b")], "date_year int, tag string")
    j = dates.join(years, year_part("d") == F.col("date_year"))
    assert [r.tag for r in j.collect()] == ["a"]


def test_cents_mean_exact_beyond_double_precision(spark):
    from decimal import ROUND_HALF_UP
    # 2 * cents + n is above 2^53 here: a DOUBLE quotient would not be exact
    rows = [(Decimal("90071992547409.93"), 1000003), (Decimal("45035996273704.97"), 999999),
            (Decimal("99999999999999.99"), 1000001)]
    df = spark.createDataFrame(rows, "s decimal(22,2), n bigint")
    got = [r[0] for r in df.select(cents_mean("s", "n")).collect()]
    assert got == [(s / n).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP) for s, n in rows]
