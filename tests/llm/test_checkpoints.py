"""After a query the shared folder holds the checkpoint of its result alone."""

import os

import pytest

import corpus_pipeline
from tests.conftest import SF001
from vitalmart.llm.common import freed, saved
from vitalmart.llm.queries import QUERIES


def stored(spark):
    top = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    return {f for f in os.listdir(top) if f.startswith("rdd-")}


def test_freed(spark):
    saved(spark.range(1))
    before = stored(spark)
    with freed(spark) as outer:
        one = saved(spark.range(3))
        with freed(spark) as inner:
            two = saved(one.selectExpr("id + 1 AS id"))
            saved(two)
            inner.remove(two)
        assert len(stored(spark) - before) == 2
        assert sorted(r.id for r in two.collect()) == [1, 2, 3] and len(outer) == 1
    assert len(stored(spark) - before) == 1


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_only_the_result_stays(spark, name):
    before = stored(spark)
    n = QUERIES[name](spark, SF001).count()
    assert n > 0 and len(stored(spark) - before) <= 1


def test_pipeline_leaves_none(spark):
    before = stored(spark)
    assert corpus_pipeline.run(spark, SF001).count() > 0
    assert stored(spark) == before
