"""The audit of declared keys, and that a broken table isn't published."""

import pytest
from tests.conftest import SF001
from vitalmart.operators.constraints import KeyViolation, key_violations, require_keys
from vitalmart.plans.star import mart


def test_violations_of_all_kinds(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (1, None), (2, None), (None, "x"), (None, "x"), (3, "c")] + [(9, "z")] * 500,
                               "k int, v string").repartition(5)
    got = {r.constraint_name: r.n_violations for r in key_violations(df, ["k"], ["k", "v"]).collect()}
    assert got == {"PRIMARY KEY (k)": 2, "k NOT NULL": 2, "v NOT NULL": 2}
    got = {r.constraint_name: r.n_violations for r in key_violations(df, ["k", "v"], []).collect()}
    assert got == {"PRIMARY KEY (k, v)": 1}  # (9, z); keys with NULL aren't repeated
    none = {r.constraint_name: r.n_violations for r in key_violations(df.where("false"), ["k"], ["v"]).collect()}
    assert none == {"PRIMARY KEY (k)": 0, "v NOT NULL": 0}


def test_one_shuffle_for_all_constraints(spark):
    orders = spark.read.parquet(f"{SF001}/orders.parquet")
    plan = key_violations(orders, ["o_orderkey"], ["o_orderkey", "o_custkey"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_a_broken_table_is_refused(spark):
    with pytest.raises(KeyViolation, match=r"t: PRIMARY KEY \(k\): 1; k NOT NULL: 1"):
        require_keys(spark.createDataFrame([(1,), (1,), (None,)], "k int"), "t", ["k"], ["k"])
    m = mart(spark, SF001)
    good = m.table("dim_reason")
    broken = good.unionByName(good.limit(1))
    folder = m.path("dim_reason").rsplit("/", 1)[0]
    import os
    before = set(os.listdir(folder))
    with pytest.raises(KeyViolation, match="dim_reason"):
        m.publish("dim_reason", lambda p: broken.write.parquet(p))
    assert set(os.listdir(folder)) == before and m.table("dim_reason").count() == good.count()
