from datetime import datetime, timedelta, timezone

import pytest

from tidemark.operators.records import log_records
from tidemark.operators.routing import config_changes, current_config
from tidemark.operators.split import route_channels
from tidemark.plans.jobs import route_dimensions
from tidemark.sinks import channels, dimensions as dims
from tidemark.sources.text import kafka_columns, read_log
from test_records import ERR, PAGE, START, raw
from test_routing import CREATE, INSERT

COLUMNS = "id,name,n"


def routed(spark, rows):
    schema = "sink_table string, sink_primary_key string, type string, data map<string,string>, seq bigint"
    return spark.createDataFrame([("dim_a", "id", *r) for r in rows], schema)


def current(spark, path, **kw):
    return {tuple(r) for r in dims.read_dimension(spark, path, "dim_a", COLUMNS, **kw).collect()}


def test_channel_files_and_topics(spark, tmp_path):
    out = route_channels(log_records(raw(spark, [PAGE, START, ERR, "oops"])))
    path = str(tmp_path / "channels")
    channels.write_channels(out, path)
    counts = {r.channel: r["count"] for r in spark.read.parquet(path).groupBy("channel").count().collect()}
    assert counts == {"page": 1, "action": 1, "display": 2, "start": 1, "err": 1, "dirty": 1}
    rows = channels.to_topics(out).collect()
    assert {(r.topic, r.key) for r in rows} == {
        ("dwd_traffic_page_log", "m1"),
        ("dwd_traffic_action_log", "m1"),
        ("dwd_traffic_display_log", "m1"),
        ("dwd_traffic_start_log", "m2"),
        ("dwd_traffic_err_log", "m2"),
    }


def test_kafka_columns(spark):
    at = datetime(2024, 1, 1, tzinfo=timezone.utc)
    rows = [(bytearray(b"x"), 0, 5, at), (None, 0, 6, at), (None, 1, 2**62, at - timedelta(milliseconds=1)), (None, 12, 0, at)]
    df = kafka_columns(spark.createDataFrame(rows, "value binary, partition int, offset bigint, timestamp timestamp"))
    assert [(r.value, r.seq) for r in df.limit(2).collect()] == [("x", 5), (None, 6)]
    assert [(r.partition, r.seq) for r in df.orderBy("arrival").collect()] == [(1, 2**62), (0, 5), (0, 6), (12, 0)]
    with pytest.raises(ValueError):
        read_log(spark, {"kind": "other"})


def test_batch_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "changes")
    first = routed(spark, [("insert", {"id": "1", "name": "a"}, 1), ("update", {"id": "1", "name": "b"}, 2)])
    second = routed(spark, [("insert", {"id": "2", "name": "c"}, 3)])
    for _ in range(2):
        dims.append_changes(first, 0, path)
        dims.append_changes(second, 1, path)
        assert current(spark, path) == {("1", "b", None), ("2", "c", None)}
        assert dims.read_changes(spark, path).count() == 3


@pytest.mark.parametrize("compact", [False, True])
def test_upsert_sets_carried_columns_only(spark, tmp_path, compact):
    path = str(tmp_path / "changes")
    rows = [
        ("insert", {"id": "1", "name": "a", "n": "5"}, 1),
        ("update", {"id": "1", "name": None}, 2),
        ("insert", {"id": "2", "name": "it's"}, 3),
        ("delete", {"id": "2", "name": "it's"}, 4),
        ("insert", {"id": "3", "name": "x", "n": "1"}, 5),
        ("delete", {"id": "3", "name": "x", "n": "1"}, 6),
        ("insert", {"id": "3", "name": "y"}, 7),
    ]
    dims.append_changes(routed(spark, rows), 0, path)

    def read(on_delete):
        if not compact:
            return current(spark, path, on_delete=on_delete)
        folded = str(tmp_path / f"folded-{on_delete}")
        dims.compact_changes(spark, path, folded)
        return current(spark, folded, on_delete=on_delete)

    assert read("upsert") == {("1", None, "5"), ("2", "it's", None), ("3", "y", "1")}
    assert read("delete") == {("1", None, "5"), ("3", "y", None)}


def test_rows_without_a_key_are_left_out(spark, tmp_path):
    path = str(tmp_path / "changes")
    rows = routed(spark, [("insert", {"name": "a"}, 1), ("insert", {"id": "1", "name": "b"}, 2), ("insert", None, 3)])
    dims.append_changes(rows, 0, path)
    assert current(spark, path) == {("1", "b", None)}
    assert sorted(r.seq for r in dims.keyless(rows).collect()) == [1, 3]


def test_publish_follows_the_configuration(spark, tmp_path):
    spark.sql("DROP SCHEMA IF EXISTS dim_wide CASCADE")
    spark.sql(f"CREATE SCHEMA dim_wide LOCATION '{tmp_path}/warehouse'")
    path = str(tmp_path / "changes")
    assert current(spark, path) == set()
    dims.append_changes(routed(spark, [("insert", {"id": "1", "name": "a", "n": "5"}, 1)]), 0, path)
    for columns, expected in (("id,name", ("1", "a")), ("id,name,n", ("1", "a", "5")), ("id,n,", ("1", None, "5"))):
        name = dims.publish_dimension(spark, path, "dim_wide", "dim_a", columns, "id")
        assert [tuple(r) for r in spark.table(name).collect()] == [expected]
    spark.sql("DROP SCHEMA dim_wide CASCADE")


def test_uv_topic_rows(spark):
    rows = channels.uv_topic_rows(spark.createDataFrame([("m", "{}", 1)], "mid string, value string, seq bigint"))
    assert [tuple(r) for r in rows.collect()] == [("dwd_traffic_uv_log", "m", "{}")]


def test_create_and_publish(spark, tmp_path):
    spark.sql("DROP SCHEMA IF EXISTS dim_test CASCADE")
    spark.sql(f"CREATE SCHEMA dim_test LOCATION '{tmp_path}/warehouse'")
    config = current_config(config_changes(raw(spark, [CREATE])))
    for _ in range(2):
        assert dims.create_dimensions(spark, "dim_test", config) == ["`dim_test`.`dim_user_info`"]
    table = spark.table("dim_test.dim_user_info")
    assert table.schema == dims.dimension_schema("id,name,n")
    props = {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES dim_test.dim_user_info").collect()}
    assert props["primary_key"] == "id"

    path = str(tmp_path / "changes")
    out = route_dimensions(raw(spark, [INSERT, INSERT.replace('"a"', '"b"')]), raw(spark, [CREATE]), "shop")
    dims.append_changes(out, 0, path)
    for _ in range(2):
        name = dims.publish_dimension(spark, path, "dim_test", "dim_user_info", "id,name,n", "id")
        assert [tuple(r) for r in spark.table(name).collect()] == [("1", "b", None)]
    spark.sql("DROP SCHEMA dim_test CASCADE")
