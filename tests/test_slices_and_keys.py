"""P12 without numbering the table, and all foreign keys of a child in one pass."""

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001
from vitalmart.operators.joins import fk_violation_counts, fk_violations
from vitalmart.operators.keys import RANGES, slice_by_ranges
from vitalmart.plans.landing import row_slice


@pytest.mark.parametrize("most", [3, 50, 100_000])
def test_slices(spark, most):
    rnd = random.Random(5)
    keys = rnd.sample(range(-10_000, 1_000_000), 3000)
    df = spark.createDataFrame([(k, f"v{k}") for k in keys] + [(None, "null")], "k bigint, v string").repartition(4)
    order = [None, *sorted(keys)]
    for start, stop in [(0, 1), (0, 5), (4, 9), (1499, 1502), (2990, 3001), (2999, 4000), (5000, 5005), (7, 7), (9, 4), (100, 400)]:
        got = sorted((r.pos, r.k, r.v) for r in slice_by_ranges(df, "k", start, stop, most=most).collect())
        want = [(p, order[p], f"v{order[p]}" if order[p] is not None else "null") for p in range(start, min(stop, 3001))]
        assert [g[0] for g in got] == [w[0] for w in want] and got == want, (start, stop)


def test_slice_of_nothing_and_of_ties(spark):
    assert slice_by_ranges(spark.createDataFrame([], "k bigint"), "k", 0, 5).collect() == []
    ties = spark.range(1000).select(F.lit(7).alias("k"))
    assert [r.pos for r in slice_by_ranges(ties, "k", 10, 13, most=1).orderBy("pos").collect()] == [10, 11, 12]


def test_a_slice_reads_its_ranges_only(spark):
    """The slice's plan filters the scan by the key and writes no copy."""
    df = spark.read.parquet(f"{SF001}/lineitem.parquet").groupBy("l_orderkey").count()
    n = df.count()
    plan = slice_by_ranges(df, "l_orderkey", n // 2, n // 2 + 3, most=10)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_orderkey" in plan and "LessThan(l_orderkey" in plan and "positions" not in plan
    assert RANGES < n and row_slice(spark, SF001).count() == 5


def test_all_foreign_keys_of_a_child(spark):
    child = spark.createDataFrame([(1, 10, "a"), (2, 99, "b"), (3, None, None), (None, 10, "a"), (9, 98, "z")], "x int, y int, z string")
    p = spark.createDataFrame([(1,), (2,), (3,), (3,), (None,)], "x int")
    q = spark.createDataFrame([(10, "a"), (99, "c"), (10, "a")], "k int, z string")
    keys = [("x", ["x"], p, ["x"]), ("yz", ["y", "z"], q, ["k", "z"]), ("y", ["y"], q, ["k"])]
    got = {r.foreign_key: r.n_violations for r in fk_violation_counts(child, keys).collect()}
    assert got == {n: fk_violations(child, parent, c, k).count() for n, c, parent, k in keys} == {"x": 1, "yz": 2, "y": 1}
