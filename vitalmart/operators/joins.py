"""Joins the modelled pipeline needs beyond a plain equi-join."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# Natural join on every common column; NULL keys match NULL keys (<=>)
def natural_join(a: DataFrame, b: DataFrame, how: str = "inner") -> DataFrame:
    common = [c for c in a.columns if c in b.columns]
    if not common:
        raise ValueError("natural join needs at least one common column")
    cond = reduce(lambda x, y: x & y, [a[c].eqNullSafe(b[c]) for c in common])
    rest_b = [b[c] for c in b.columns if c not in common]
    return a.join(b, cond, how).select(*[a[c] for c in a.columns], *rest_b)


# Value into [lower, upper] of the bands of the same year, both ends
# included. Joining on the year alone would send all values of a year to one
# task. A quantile sketch per year (one row a year, so it is broadcast) cuts its
# values into buckets of about ``rows`` rows; a value that fills several
# buckets by itself makes one that is dealt out to as many parts. Bands are
# repeated for the buckets and parts they cover, and the join is on (year,
# bucket, part) with the range as a residual: each value has one bucket and
# part, so it meets each covering band once.
GRID = 128  # quantiles of a year's sketch: its most buckets


def interval_join(values: DataFrame, bands: DataFrame, year: str, value: str, lower: str,
                  upper: str, how: str = "inner", rows: int = 1 << 20) -> DataFrame:
    """All columns of ``values`` and those of ``bands`` it has not; ``how`` is
    inner or left. Rows without year or value match nothing."""
    number = F.col(value).cast("double")
    sketch = (values.where(F.col(year).isNotNull() & number.isNotNull()).groupBy(F.col(year).alias("__year"))
              .agg(F.count(F.lit(1)).alias("__n"),
                   F.percentile_approx(number, [i / GRID for i in range(1, GRID)], 10_000).alias("__q")))
    step = F.floor(GRID / F.least(F.lit(GRID), F.ceil(F.col("__n") / rows)))
    sketch = sketch.withColumn("__borders", F.array_sort(F.array_distinct(
        F.filter("__q", lambda x, i: (i + 1) % step == 0))))

    def bucket(x):
        return F.size(F.filter("__borders", lambda y: y <= x))

    expected = lambda b: F.size(F.filter("__q", lambda x: bucket(x) == b)) * F.col("__n") / GRID
    sketch = sketch.select("__year", "__borders", F.transform(
        F.sequence(F.lit(0), F.size("__borders")),
        lambda b: F.greatest(F.lit(1), F.floor(expected(b) / rows))).alias("__parts"))

    v = (values.join(F.broadcast(sketch), F.col(year) == F.col("__year"), "left")
         .withColumn("__bucket", F.when(number.isNotNull(), bucket(number)))
         .withColumn("__part", F.pmod(F.monotonically_increasing_id(), F.get("__parts", F.col("__bucket"))))
         .drop("__borders", "__parts"))
    added = [c for c in bands.columns if c not in values.columns]
    names = {c: f"__band_{i}" for i, c in enumerate(dict.fromkeys([*added, lower, upper]))}
    b = (bands.where(F.col(lower) <= F.col(upper)).join(F.broadcast(sketch), F.col(year) == F.col("__year"))
         .withColumn("__bucket", F.explode(F.sequence(bucket(F.col(lower).cast("double")), bucket(F.col(upper).cast("double")))))
         .withColumn("__part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.get("__parts", F.col("__bucket")) - 1)))
         .select("__year", "__bucket", "__part", *[F.col(c).alias(n) for c, n in names.items()]))
    keys = ["__year", "__bucket", "__part"]
    cond = reduce(lambda x, y: x & y, [v[k] == b[k] for k in keys]) & F.col(value).between(F.col(names[lower]), F.col(names[upper]))
    return v.join(b, cond, how).select(*[v[c] for c in values.columns], *[b[names[c]].alias(c) for c in added])


# Rows whose foreign key has no parent (NULL keys are not violations)
def fk_violations(child: DataFrame, parent: DataFrame, child_keys, parent_keys) -> DataFrame:
    cond = reduce(lambda x, y: x & y,
                  [child[c] == parent[p] for c, p in zip(child_keys, parent_keys)])
    not_null = reduce(lambda x, y: x & y, [child[c].isNotNull() for c in child_keys])
    return child.where(not_null).join(parent, cond, "left_anti")


# (foreign_key, n_violations) of several keys of one child, which is read
# once: each parent's keys, once each, are joined on with a mark. ``keys``:
# (name, child columns, parent, parent columns).
def fk_violation_counts(child: DataFrame, keys) -> DataFrame:
    needed = list(dict.fromkeys(c for _, cols, _, _ in keys for c in cols))
    out, told = child.select(*needed), []
    for i, (name, child_keys, parent, parent_keys) in enumerate(keys):
        marked = parent.select(*[F.col(p).alias(f"__{i}_{p}") for p in parent_keys]).distinct().withColumn(f"__found_{i}", F.lit(True))
        cond = reduce(lambda x, y: x & y, [F.col(c) == F.col(f"__{i}_{p}") for c, p in zip(child_keys, parent_keys)])
        out = out.join(marked, cond, "left")
        not_null = reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in child_keys])
        told.append((name, F.count_if(not_null & F.col(f"__found_{i}").isNull()).alias(f"n_{i}")))
    counts = out.agg(*[c for _, c in told])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(name).alias("foreign_key"), F.col(f"n_{i}").alias("n_violations"))
                                            for i, (name, _) in enumerate(told)])))
