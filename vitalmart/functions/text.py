"""Text cleaning: band texts to numbers, label codes, name dictionary, keys."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitalmart.constants import INCOME_CODES, NAME_MAP, OPEN_UPPER_BOUND


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Split in at most two parts on '-' or '<='
def split_band(text) -> tuple[Column, Column]:
    parts = F.split(_c(text), "-|<=", 2)
    return F.try_element_at(parts, F.lit(1)), F.try_element_at(parts, F.lit(2))


# C2 + C3 + C4 + C8: '<= 480' -> (0, 480); '1,941-6,000' -> (1941, 6000);
# '> 6,000' -> (6000, 1000000). Failing text becomes NULL (try_cast), never an error.
def band_bounds(text) -> tuple[Column, Column]:
    lo_raw, hi_raw = split_band(text)
    return bounds_from_parts(lo_raw, hi_raw)


def bounds_from_parts(lo_raw, hi_raw) -> tuple[Column, Column]:
    lo_raw, hi_raw = _c(lo_raw), _c(hi_raw)
    lo = F.replace(F.replace(lo_raw, F.lit(">"), F.lit("")), F.lit(","), F.lit(""))
    hi = F.replace(hi_raw, F.lit(","), F.lit(""))
    lower = F.when(F.trim(lo) == "", F.lit(0).cast("bigint")).otherwise(
        F.trim(lo).try_cast("bigint"))
    # no upper part: the open top band; an upper part that is not a number: NULL
    upper = F.when(hi.isNull(), F.lit(OPEN_UPPER_BOUND).cast("bigint")).otherwise(
        F.trim(hi).try_cast("bigint"))
    return lower, upper


# Income label -> code, 0 for anything else (looked up by label)
def income_code(label) -> Column:
    (first_text, first_code), *rest = INCOME_CODES
    expr = F.when(_c(label) == first_text, F.lit(first_code))
    for text, code in rest:
        expr = expr.when(_c(label) == text, F.lit(code))
    return expr.otherwise(F.lit(0))


# C5 + C17: whole-value replacement by the fixed dictionary. A map literal
# keeps the lookup inside generated code (no join, no UDF); the wrongly
# decoded spelling is simply one more key.
def map_names(c) -> Column:
    m = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in NAME_MAP))
    return F.coalesce(F.try_element_at(m, _c(c)), _c(c))


# C6: ' HIV/AIDS' -> 'HIVAIDS'
def clean_name(c) -> Column:
    return F.replace(F.trim(_c(c)), F.lit("/"), F.lit(""))


# F6 + C7: 'WHO/Malaria.csv' -> 'Malaria'; the folder key and other folders -> NULL
def key_to_name(key, prefix: str = "WHO") -> Column:
    k = _c(key)
    rest = F.substring(k, len(prefix) + 2, 1 << 30)
    ok = (F.substring(k, 1, len(prefix)) == prefix) & (rest != "")
    return F.when(ok, F.replace(rest, F.lit(".csv"), F.lit("")))


# NaN -> NULL
def nan_to_null(c) -> Column:
    return F.when(F.isnan(_c(c)), F.lit(None)).otherwise(_c(c))


# P9: '2017.2' -> 2017
def year_from_label(c) -> Column:
    return _c(c).try_cast("double").cast("int")


# case-insensitive keyword search
def contains_keyword(c, keyword: str) -> Column:
    return F.lower(_c(c)).contains(keyword.lower())
