import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.conftest import SF001
from tools.compare import compare, duck
from vitalmart.plans.star import mart

from vitalmart.plans.catalogue import QUERIES  # noqa: E402
from vitalmart.plans.oracle import SQL  # noqa: E402


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["region_name", "avg_indicator_metric", "rank"]
    assert df.count() == 5


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, con, name, QUERIES[name], SQL[name], SF001)
    assert ok, msg


def test_star_invariants(spark):
    m = mart(spark, SF001)
    fm, fr = m.table("fact_metrics"), m.table("fact_metric_death_reasons")
    n_reasons = m.table("death_reason").count()
    # V1 rows = metrics without reasons + reason rows
    with_reasons = fr.select("metric_id").distinct().count()
    assert m.v1().count() == fm.count() - with_reasons + fr.count()
    # at most one row per reason for a metric
    assert fr.groupBy("metric_id").count().agg(F.max("count")).first()[0] <= n_reasons
    # every foreign key resolves
    assert all(r.n_violations == 0 for r in QUERIES["q_fk_violations"](spark, SF001).collect())


def test_melt_row_count_is_rows_times_columns(spark):
    from vitalmart.plans.landing import cause_files, melt_causes, stack_causes
    w = cause_files(spark, SF001)
    n_years = len([c for c in w.columns if c.endswith(".2")])
    assert melt_causes(spark, SF001).count() == w.count() * n_years
    assert stack_causes(spark, SF001).count() < melt_causes(spark, SF001).count()


def test_cause_path_equals_staging(spark):
    """The landing path (wide files -> melt -> name map) gives the staged values."""
    from vitalmart.plans.landing import melt_causes
    m = mart(spark, SF001)
    ipcr = (m.table("indicator_per_country_per_reason")
            .join(m.table("death_reason"), F.col("reason_id") == F.col("death_reason_id"))
            .join(m.table("indicator_per_country"), "indicator_per_country_id")
            .join(m.table("country"), "country_id")
            .select("reason_name", F.col("country_name").alias("name"), "year", "value_per_reason"))
    melted = melt_causes(spark, SF001).join(ipcr.select("reason_name", "name", "year"),
                                            ["reason_name", "name", "year"])
    assert sorted(map(tuple, melted.collect()), key=repr) == sorted(map(tuple, ipcr.collect()), key=repr)


def test_views_broadcast_dimensions(spark):
    from vitalmart.plans.star import view_v1, view_v2
    m = mart(spark, SF001)
    t = m.table
    for view in (view_v1, view_v2):
        df = view(t("fact_metrics"), t("fact_metric_death_reasons"), t("dim_country"),
                  t("dim_reason"), t("dim_date"))
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # V2's right join is made inner by the inner joins that follow it
    plan = view_v2(t("fact_metrics"), t("fact_metric_death_reasons"), t("dim_country"),
                   t("dim_reason"), t("dim_date"))._jdf.queryExecution().optimizedPlan().toString()
    assert "RightOuter" not in plan


def test_no_python_evaluation_in_any_plan(spark):
    for name, fn in QUERIES.items():
        plan = fn(spark, SF001)._jdf.queryExecution().executedPlan().toString()
        assert "EvalPython" not in plan and "PythonUDF" not in plan, name
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_incomplete_reads_two_columns_of_all_orders(spark):
    plan = QUERIES["q_drop_incomplete"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double>" in plan and "o_orderdate" not in plan


def test_row_slice(spark):
    from vitalmart.plans.landing import position_slice
    from vitalmart.sources.tables import table
    p = table(spark, SF001, "part").select("p_partkey", "p_name")
    got = [r.p_partkey for r in position_slice(p, ["p_partkey"], 4, 9).orderBy("pos").collect()]
    want = [r.p_partkey for r in p.orderBy("p_partkey").collect()][4:9]
    assert got == want
