"""Non-default parameters reach the plans: each call is compared with its
oracle SQL after changing the same literal there."""

import pytest

from tests.conftest import SF001
from tools.compare import duck, rows_of
from vitalmart.plans import questions as Q
from vitalmart.plans import worksheets as W
from vitalmart.plans.oracle import SQL


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


def same(spark_df, con, sql):
    assert sql not in SQL.values(), "the literal to change was not found"
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    return (sorted(spark_df.columns) == sorted(d_cols)
            and rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
            == rows_of(d_cols, res.fetchall()))


def test_year_map_year(spark, con):
    sql = SQL["q_ws_year_map"].replace("date_year = 2000", "date_year = 1998")
    assert same(W.ws_year_map(spark, SF001, year=1998), con, sql)


def test_top_causes_years_and_n(spark, con):
    sql = (SQL["q_top_causes_by_year"].replace("IN (2001, 1997)", "IN (1999, 2000)")
           .replace("rank <= 3", "rank <= 2"))
    assert same(Q.top_causes_by_year(spark, SF001, years=(1999, 2000), n=2), con, sql)


def test_biggest_decrease_span(spark, con):
    sql = SQL["q_biggest_decrease"].replace("a.date_year - 5", "a.date_year - 3")
    assert same(Q.biggest_decrease(spark, SF001, span=3), con, sql)


def test_above_threshold_reason_and_rate(spark, con):
    sql = (SQL["q_above_threshold"].replace("'1-URGENT'", "'5-LOW'")
           .replace("> 26.0", "> 25.0"))
    assert same(Q.above_threshold(spark, SF001, reason="5-LOW", x=25.0), con, sql)


def test_region_subset(spark, con):
    sql = SQL["q_ws_region_gni"].replace(
        "('AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST')", "('ASIA', 'EUROPE')")
    assert same(W.ws_region_gni(spark, SF001, regions=("ASIA", "EUROPE")), con, sql)
