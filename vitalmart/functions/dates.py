"""Years, decades and year-as-date helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitalmart.constants import (DECADE_BIN_FROM, DECADE_BIN_TO, DECADE_CASE_FROM,
                                 DECADE_CASE_TO)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def decade_start(y) -> Column:
    return (_c(y) - F.pmod(_c(y), F.lit(10))).cast("int")


# P7 + C10: the dimension's decade text; NULL outside [1960, 2030)
def decade_case(y) -> Column:
    y = _c(y)
    return F.when((y >= DECADE_CASE_FROM) & (y < DECADE_CASE_TO),
                  decade_start(y).cast("string"))


# The worksheet's decade bin '1960s'..'2010s' (ends at 2018); other
# years stay as their own text
def decade_bin(y) -> Column:
    y = _c(y)
    return F.when(y.between(DECADE_BIN_FROM, DECADE_BIN_TO),
                  F.concat(decade_start(y).cast("string"), F.lit("s"))
                  ).otherwise(y.cast("string"))


# C12: 'yyyy' -> date (1 January of that year)
def year_to_date(y) -> Column:
    return F.to_date(_c(y).cast("string"), "yyyy")


# C13
def year_part(d) -> Column:
    return F.year(_c(d))


# C14
def trunc_year(d) -> Column:
    return F.trunc(_c(d), "year")
