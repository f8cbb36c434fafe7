from pyspark.sql import functions as F

from tidemark.llm import store
from tidemark.session import path_exists


def test_stored_tables_can_be_released(spark):
    store.release(spark)
    kept = store.stored(spark.range(5).withColumn("x", F.lit("a")), "five")
    path = kept.inputFiles()[0].rsplit("/", 1)[0]
    assert kept.count() == 5 and path_exists(spark, path)
    assert store.release(spark) == 1 and not path_exists(spark, path)
    assert store.release(spark) == 0


def test_only_small_tables_are_broadcast(spark, monkeypatch):
    frame = store.stored(spark.range(50), "fifty")
    plan = lambda f: f._jdf.queryExecution().logical().toString()
    assert "broadcast" in plan(store.small_or_shuffled(frame))
    monkeypatch.setattr(store, "BROADCAST_ROWS", 49)
    assert "broadcast" not in plan(store.small_or_shuffled(frame))
