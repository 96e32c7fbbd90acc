"""Declared keys of a table, checked in one aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_violations(df: DataFrame, key: list[str], not_null: list[str]) -> DataFrame:
    """(constraint_name, n_violations): key values that several rows have, and
    rows with NULL in a column that must not be. Rows are counted per key
    before and after one hash shuffle, so a value that a third of the rows
    have is one row per task; a key with NULL counts as NULL, not as repeated."""
    whole = F.lit(True)
    for c in key:
        whole = whole & F.col(c).isNotNull()
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("__n"), *[
        F.count_if(F.col(c).isNull()).alias(f"__null_{i}") for i, c in enumerate(not_null)])
    told = per_key.agg(F.count_if(whole & (F.col("__n") > 1)).alias("unique"), *[
        F.coalesce(F.sum(f"__null_{i}"), F.lit(0)).alias(f"null_{i}") for i in range(len(not_null))])
    found = [(f"PRIMARY KEY ({', '.join(key)})", "unique"), *[(f"{c} NOT NULL", f"null_{i}") for i, c in enumerate(not_null)]]
    pairs = [F.struct(F.lit(name).alias("constraint_name"), F.col(c).alias("n_violations")) for name, c in found]
    return told.select(F.inline(F.array(*pairs)))


class KeyViolation(ValueError):
    """A table breaks its declared keys."""


def require_keys(df: DataFrame, name: str, key: list[str], not_null: list[str]) -> None:
    broken = key_violations(df, key, not_null).where("n_violations > 0").collect()  # one row per constraint
    if broken:
        raise KeyViolation(f"{name}: " + "; ".join(f"{r.constraint_name}: {r.n_violations}" for r in broken))
