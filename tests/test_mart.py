import os

from tests.conftest import SF001
from vitalmart.plans.star import Mart


def test_publish_first_writer_wins(spark):
    m = Mart(spark, SF001)
    m.publish("publish_probe", lambda p: spark.range(10).write.parquet(p))
    m.publish("publish_probe", lambda p: spark.range(5).write.parquet(p))
    assert m.exists("publish_probe")
    assert spark.read.parquet(m.path("publish_probe")).count() == 10
    siblings = os.listdir(os.path.dirname(m.path("publish_probe")))
    assert not [d for d in siblings if ".tmp-" in d]
    assert not [d for d in os.listdir(m.path("publish_probe")) if ".tmp-" in d]


def test_interrupted_folder_is_replaced(spark):
    m = Mart(spark, SF001)
    os.makedirs(m.path("half_written"), exist_ok=True)   # no _SUCCESS marker
    assert not m.exists("half_written")
    m.publish("half_written", lambda p: spark.range(3).write.parquet(p))
    assert m.exists("half_written") and spark.read.parquet(m.path("half_written")).count() == 3


def test_shuffle_partitions_sized_from_input(spark):
    from vitalmart.session import input_bytes, scoped_conf, shuffle_partitions_for
    paths = [f"{SF001}/lineitem.parquet", f"{SF001}/orders.parquet"]
    total = input_bytes(spark, paths)
    assert total == sum(os.path.getsize(p) for p in paths)
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert shuffle_partitions_for(spark, paths) == current          # small input: unchanged
    assert shuffle_partitions_for(spark, paths, target_bytes=1000) == -(-total // 1000)
    with scoped_conf(spark, {"spark.sql.shuffle.partitions": 123}):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "123"
    assert int(spark.conf.get("spark.sql.shuffle.partitions")) == current
