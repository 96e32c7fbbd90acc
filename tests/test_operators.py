import random

from pyspark.sql import functions as F

from vitalmart.operators.filters import apply_filters, manual_order, member_range, members
from vitalmart.operators.joins import fk_violations, natural_join
from vitalmart.operators.keys import first_seen_ids, name_ids, noted_positions, with_position
from vitalmart.operators.reshape import (dedupe_headers, grid, header_from_first_row, melt,
                                         stack, strip_suffix)


def test_with_position_is_dense_and_ordered(spark):
    keys = list(range(1000))
    random.Random(7).shuffle(keys)
    df = spark.createDataFrame([(k, f"v{k}") for k in keys], "k int, v string").repartition(5)
    out = with_position(df, ["k"], "pos", partitions=7)
    got = sorted((r.k, r.pos) for r in out.collect())
    assert got == [(k, k + 1) for k in range(1000)]
    # 0-based start and a descending order
    out0 = with_position(df, [F.col("k").desc()], "pos", start=0, partitions=3)
    assert sorted((r.k, r.pos) for r in out0.collect()) == [(k, 999 - k) for k in range(1000)]


def test_with_position_is_range_partitioned(spark):
    df = spark.range(100)
    plan = with_position(df, ["id"], "pos")._jdf.queryExecution().executedPlan().toString()
    # rows come from one written range partitioning (a parquet table in the
    # checkpoint folder); the per-partition offsets are broadcast to them
    assert "Scan parquet" in plan and "BroadcastHashJoin" in plan
    assert "SinglePartition" not in plan.split("BroadcastExchange")[0]


def test_first_seen_ids(spark):
    df = spark.createDataFrame([(0, "B"), (1, "A"), (2, "B"), (3, "C"), (4, "A")], "pos int, v string")
    got = {r.v: r.id for r in first_seen_ids(df, "v", "pos").collect()}
    assert got == {"B": 1, "A": 2, "C": 3}


def test_name_ids_binary_order(spark):
    df = spark.createDataFrame([("Acute",), ("AIDS",), ("Malaria",), ("AIDS",)], "n string")
    got = {r.n: r.id for r in name_ids(df, "n").collect()}
    assert got == {"AIDS": 1, "Acute": 2, "Malaria": 3}


def test_melt_keeps_null_stack_drops(spark):
    df = spark.createDataFrame([("x", 1.0, None)], "name string, `2000` double, `2001` double")
    assert melt(df, ["name"], ["2000", "2001"]).count() == 2
    assert stack(df, ["name"], ["2000", "2001"]).count() == 1


def test_headers():
    assert dedupe_headers(["c", "2017", "2017", "2017", "2016"]) == [
        "c", "2017", "2017.1", "2017.2", "2016"]


def test_strip_suffix(spark):
    df = spark.createDataFrame([(1, 2)], "`2017.2` int, `2016.2` int")
    assert strip_suffix(df, ".2").columns == ["2017", "2016"]


def test_header_from_first_row(spark):
    df = spark.createDataFrame([(0, "income", "1990"), (1, "Low", "<= 480"), (2, "High", "> 6,000")],
                               "pos int, _c0 string, _c1 string")
    out = header_from_first_row(df, "pos")
    assert out.columns == ["pos", "income", "1990"]
    assert out.count() == 2


def test_grid(spark):
    df = spark.createDataFrame([("r1", "1990s", 1.0), ("r1", "2000s", 3.0), ("r2", "1990s", 5.0)],
                               "r string, d string, v double")
    g = {r.r: (r["1990s"], r["2000s"]) for r in grid(df, ["r"], "d", ["1990s", "2000s"], F.avg("v")).collect()}
    assert g == {"r1": (1.0, 3.0), "r2": (5.0, None)}


def test_natural_join_matches_null_keys(spark):
    a = spark.createDataFrame([("x", 1, "a1"), (None, 2, "a2")], "k string, y int, va string")
    b = spark.createDataFrame([("x", 1, "b1"), (None, 2, "b2"), ("z", 3, "b3")], "k string, y int, vb string")
    got = sorted((r.va, r.vb) for r in natural_join(a, b).collect())
    assert got == [("a1", "b1"), ("a2", "b2")]


def test_fk_violations(spark):
    parent = spark.createDataFrame([(1,), (2,)], "k int")
    child = spark.createDataFrame([(1,), (3,), (None,)], "k int")
    assert [r.k for r in fk_violations(child, parent, ["k"], ["k"]).collect()] == [3]


def test_filters(spark):
    df = spark.createDataFrame([("2-HIGH",), ("1-URGENT",), ("4-NOT SPECIFIED",), ("5-LOW",), (None,)],
                               "reason_desc string")
    kept = sorted(r[0] for r in df.where(member_range("reason_desc", "2-high", "4-not specified")).collect())
    assert kept == ["2-HIGH", "4-NOT SPECIFIED"]
    assert df.where(members("reason_desc", ["5-LOW", None])).count() == 1
    order = [r[0] for r in df.orderBy(manual_order("reason_desc", ["5-LOW", "1-URGENT"]), "reason_desc").collect()]
    assert order[:2] == ["5-LOW", "1-URGENT"]
    sel = spark.createDataFrame([("A", 2000), ("B", 2001)], "country_name string, date_year int")
    assert apply_filters(sel).count() == 2
    assert apply_filters(sel, country="A", year=2000).count() == 1


def test_noted_positions_are_those_of_the_innermost_use(spark):
    df = spark.createDataFrame([(3,), (1,)], "k int")
    with noted_positions() as outer:
        with_position(df, ["k"])
        with noted_positions() as inner:
            with_position(df, ["k"])
            with_position(df, ["k"])
    with_position(df, ["k"])
    assert (len(outer), len(inner)) == (1, 2) and not set(outer) & set(inner)
