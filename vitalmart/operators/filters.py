"""Worksheet filters: members, member ranges, optional selectors, manual order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# member-union filter (NULL never matches)
def members(c: str, values) -> Column:
    return F.col(c).isin(list(values))


# range over member names in case-insensitive collation order, NULL out
def member_range(c: str, lo: str, hi: str) -> Column:
    return F.lower(F.col(c)).between(lo.lower(), hi.lower())


# F14 + F16: one optional selector per dimension; None means "all members"
def apply_filters(df: DataFrame, country: str | None = None, income: str | None = None,
                  year: int | None = None, region: str | None = None,
                  reason: str | None = None, indicator: str | None = None) -> DataFrame:
    preds = []
    for colname, v in (("country_name", country), ("income_name", income),
                       ("date_year", year), ("region_name", region),
                       ("reason_desc", reason), ("indicator_name", indicator)):
        if v is not None:
            preds.append(F.col(colname) == F.lit(v))
    for p in preds:
        df = df.where(p)
    return df


# O2: manual member order; members not listed sort last
def manual_order(c: str, order) -> Column:
    pos = F.array_position(F.array(*[F.lit(v) for v in order]), F.col(c))
    return F.when(pos.isNull() | (pos == 0), F.lit(len(order) + 1)).otherwise(pos).cast("int")
