"""A hot key (one customer with a third of all orders) through `cells`,
with and without AQE's skew handling, against a plain pandas computation."""

import datetime
import os
from decimal import Decimal

import pandas as pd
import pytest

from vitalmart.plans.staging import cells


@pytest.fixture(scope="module")
def skewed_dir(tmp_path_factory):
    d = str(tmp_path_factory.mktemp("skewed"))
    n_orders = 600
    orders = pd.DataFrame({
        "o_orderkey": range(n_orders),
        "o_custkey": [7 if i % 3 == 0 else i % 50 for i in range(n_orders)],
        "o_orderstatus": "O",
        "o_totalprice": [1000.0 + (i * 37) % 997 + 0.25 for i in range(n_orders)],
        "o_orderdate": [datetime.datetime(1995 + i % 4, 1 + i % 12, 1) for i in range(n_orders)],
        "o_orderpriority": [f"{1 + i % 3}-P" for i in range(n_orders)],
    })
    lineitem = pd.DataFrame({
        "l_orderkey": [k for k in range(n_orders) for _ in range(1 + k % 3)],
    })
    lineitem["l_quantity"] = [float(1 + (i * 13) % 50) for i in range(len(lineitem))]
    customer = pd.DataFrame({"c_custkey": range(50), "c_nationkey": [i % 5 for i in range(50)]})
    for name, df in (("orders", orders), ("lineitem", lineitem), ("customer", customer)):
        df.to_parquet(os.path.join(d, f"{name}.parquet"), coerce_timestamps="us")
    return d, orders, lineitem, customer


def brute_force(orders, lineitem, customer):
    li = lineitem.groupby("l_orderkey").agg(qty=("l_quantity", "sum"), lines=("l_quantity", "size"))
    o = orders.merge(li, left_on="o_orderkey", right_index=True, how="left")
    o = o.merge(customer, left_on="o_custkey", right_on="c_custkey")
    o["year"] = o["o_orderdate"].dt.year
    g = o.groupby(["c_nationkey", "year", "o_orderpriority"]).agg(
        sum_qty=("qty", "sum"), n_lines=("lines", "sum"), sum_price=("o_totalprice", "sum"),
        n_orders=("o_orderkey", "size")).reset_index()
    return sorted((int(r.c_nationkey), int(r.year), r.o_orderpriority,
                   Decimal(str(round(r.sum_qty, 2))).quantize(Decimal("0.01")), int(r.n_lines),
                   Decimal(str(round(r.sum_price, 2))).quantize(Decimal("0.01")), int(r.n_orders))
                  for r in g.itertuples())


@pytest.mark.parametrize("skew_join", ["true", "false"])
def test_hot_customer(spark, skewed_dir, skew_join):
    d, orders, lineitem, customer = skewed_dir
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", skew_join)
    try:
        df = cells(spark, d)
        got = sorted(tuple(r) for r in df.collect())
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    assert got == brute_force(orders, lineitem, customer)
    if skew_join == "false":
        # rows are aggregated per (customer, year, priority) before the customer join
        assert plan.count("HashAggregate") >= 6
