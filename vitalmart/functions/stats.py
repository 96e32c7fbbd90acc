"""Aggregate expressions whose results are exact and engine-independent.

Money and quantities are summed as DECIMAL (exact, so partial aggregation in
any order gives one answer); a mean is the exact sum turned into DOUBLE and
divided once. Decimal rounding to cents is done in integer arithmetic.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(12,2)"
METRIC = "decimal(10,2)"

# Normal quantile of the 95 % band (no distribution is stated; normal assumed)
Z95 = 1.96


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def mean(c) -> Column:
    """AVG with NULLs skipped, as DOUBLE: sum(x) / count(x)."""
    return F.try_divide(F.sum(_c(c)).cast("double"), F.count(_c(c)))


def cents_mean(sum_col: str, n_col: str) -> Column:
    """Round-half-up of sum/n to two decimals, exactly, as DECIMAL(10,2).

    Integer arithmetic on cents with SQL's integral ``div`` (exact on BIGINT
    over its whole range, unlike a DOUBLE quotient above 2^53); NULL when
    n is 0 or NULL. Takes column names.
    """
    cents = f"CAST({sum_col} * 100 AS BIGINT)"
    n = f"CAST({n_col} AS BIGINT)"
    return F.expr(f"CASE WHEN {n} > 0 THEN CAST(CAST(({cents} * 2 + {n}) div ({n} * 2) "
                  f"AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,2)) END")
