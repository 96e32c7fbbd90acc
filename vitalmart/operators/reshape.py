"""Wide <-> long reshapes and header handling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# Wide -> long, NULL values kept (melt)
def melt(df: DataFrame, ids, values, var: str = "variable", val: str = "value") -> DataFrame:
    return df.unpivot(ids, values, var, val)


# R2: wide -> long, NULL values dropped (stack)
def stack(df: DataFrame, ids, values, var: str = "variable", val: str = "value") -> DataFrame:
    return melt(df, ids, values, var, val).where(F.col(val).isNotNull())


# Rows x column headers grid (one aggregate per cell)
def grid(df: DataFrame, rows, column: str, column_values, agg) -> DataFrame:
    return df.groupBy(*rows).pivot(column, list(column_values)).agg(agg)


# Repeated header names get pandas-style suffixes: 2017, 2017.1, 2017.2
def dedupe_headers(names) -> list[str]:
    seen: dict[str, int] = {}
    out = []
    for n in names:
        k = seen.get(n, 0)
        out.append(n if k == 0 else f"{n}.{k}")
        seen[n] = k + 1
    return out


# Strip a block suffix ('2017.2' -> '2017') from the selected columns
def strip_suffix(df: DataFrame, suffix: str) -> DataFrame:
    return df.withColumnsRenamed({c: c[: -len(suffix)] for c in df.columns if c.endswith(suffix)})


# The first row of a headerless grid becomes the header. Only that one
# row is fetched to the driver (a header, bounded by the column count).
def header_from_first_row(df: DataFrame, position: str) -> DataFrame:
    first = df.orderBy(position).limit(1).collect()[0]
    cols = [c for c in df.columns if c != position]
    names = dedupe_headers([str(first[c]) for c in cols])
    body = df.where(F.col(position) != first[position])
    return body.select(position, *[F.col(c).alias(n) for c, n in zip(cols, names)])
