"""Dimensions that a stream keeps current: incremental upserts, configuration as state, late configuration, views."""

import json
import os
import random

import pyarrow.parquet as pq
import pytest

from tidemark.sinks import dimensions as dims, upserts
from tidemark.sources.text import read_log
from tidemark.streaming.dimensions import ConfigVersions, DimensionTables, dimension_source
from tidemark.streaming.jobs import route_dimensions_stream, run_to_end
from tidemark.streaming.state import file_sink, read_sink
from test_routing import CREATE, DROP, INSERT

ROUTED = "sink_table string, sink_primary_key string, type string, data map<string,string>, seq bigint"


def change(i, table="user_info", kind="insert", **data):
    return json.dumps({"database": "shop", "table": table, "type": kind, "data": {"id": str(i), **data}})


def config(columns, op="u", table="user_info", sink="dim_user_info", key="id"):
    row = {"source_table": table, "sink_table": sink, "sink_columns": columns, "sink_primary_key": key, "sink_extend": None}
    return json.dumps({"op": op, "before": row if op == "d" else None, "after": None if op == "d" else row})


def store_rows(spark, store):
    return {(r.sink_table, r.row_key): r.data for r in upserts.live(upserts.read_store(spark, store)).collect()}


def random_changes(seed, n):
    rng = random.Random(seed)
    rows = []
    for seq in range(n):
        data = {"id": str(rng.randrange(12))}
        for c in ("a", "b", "c"):
            if rng.random() < 0.5:
                data[c] = rng.choice([None, str(seq)])
        rows.append((rng.choice(["dim_a", "dim_b"]), "id", rng.choice(["insert", "update", "update", "delete"]), data, seq))
    return rows


@pytest.mark.parametrize("on_delete", ["upsert", "delete"])
def test_batches_in_any_order_fold_to_the_history(spark, tmp_path, on_delete):
    """Late batches, batches that run again and hot rows give what a fold of all changes gives."""
    rows = random_changes(3, 300)
    store = str(tmp_path / "store")
    for part in (rows[100:200], rows[:100], rows[100:200], rows[200:]):
        upserts.upsert_changes(spark.createDataFrame(part, ROUTED), store, on_delete=on_delete, buckets=4)
    history = spark.createDataFrame(rows, ROUTED).withColumn("row_key", dims.row_key())
    expected = dims.fold_rows(history, ["id", "a", "b", "c"], ("sink_table", "row_key"), on_delete=on_delete).collect()
    got = store_rows(spark, store)
    assert {(r.sink_table, r.row_key): tuple(r)[2:] for r in expected} == {k: tuple(d.get(c) for c in ("id", "a", "b", "c")) for k, d in got.items()}


def test_a_batch_rewrites_its_buckets_only(spark, tmp_path):
    store = str(tmp_path / "store")
    rows = [("dim_a", "id", "insert", {"id": str(i)}, i) for i in range(400)]
    assert len(upserts.upsert_changes(spark.createDataFrame(rows, ROUTED), store, buckets=32)) == 32
    files = lambda: {os.path.join(d, f) for d, _, names in os.walk(store) for f in names if f.endswith(".parquet")}
    before = files()
    one = spark.createDataFrame([("dim_a", "id", "update", {"id": "7", "n": "x"}, 1000)], ROUTED)
    (touched,) = upserts.upsert_changes(one, store, buckets=32)
    gone = before - files()
    assert gone and all(f"/bucket={touched['bucket']}/" in f for f in gone) and len(files()) == len(before)
    assert len(store_rows(spark, store)) == 400 and store_rows(spark, store)[("dim_a", '["7"]')] == {"id": "7", "n": "x"}


def test_empty_batches_and_missing_keys(spark, tmp_path):
    store = str(tmp_path / "store")
    assert upserts.upsert_changes(spark.createDataFrame([], ROUTED), store) == []
    assert upserts.read_store(spark, store).collect() == []
    rows = [("dim_a", "id", "insert", {"n": "1"}, 1), ("dim_a", "id", "insert", None, 2), ("dim_a", "id,n", "insert", {"id": "1", "n": "2"}, 3)]
    upserts.upsert_changes(spark.createDataFrame(rows, ROUTED), store)
    assert store_rows(spark, store) == {("dim_a", '["1","2"]'): {"id": "1", "n": "2"}}


def text(spark, rows):
    return spark.createDataFrame(rows, "seq bigint, value string, is_config boolean")


def tables(spark, tmp_path, **options):
    return DimensionTables(spark, str(tmp_path / "ckpt"), "shop", str(tmp_path / "store"), **options)


def test_configuration_is_parsed_once(spark, tmp_path):
    versions = ConfigVersions(spark, str(tmp_path / "ckpt"), keep_all=False)
    frame = lambda rows: spark.createDataFrame(rows, "seq bigint, value string")
    versions.add(frame([(1, config("id")), (2, "oops")]), 0)
    versions.add(frame([]), 1)
    versions.add(frame([(9, config("id,n")), (5, config("", "d"))]), 2)
    assert [(r.seq, r.is_deleted) for r in versions.known(0).collect()] == [(1, False)]
    last = max(versions.known(2).collect(), key=lambda r: r.seq)
    assert (last.seq, last.sink_columns) == (9, "id,n")


def test_changes_wait_for_their_configuration(spark, tmp_path):
    job = tables(spark, tmp_path, as_of=True, park_batches=2)
    job.run(text(spark, [(10, change(1), False), (30, change(2), False), (31, change(9, "other"), False)]), 0)
    assert store_rows(spark, str(tmp_path / "store")) == {}
    for _ in range(2):
        job.run(text(spark, [(20, config("id"), True), (40, change(3), False)]), 1)
    assert {k[1] for k in store_rows(spark, str(tmp_path / "store"))} == {'["2"]', '["3"]'}
    # What still waits: the record before its table's first version, and that of the table without one.
    assert sorted(r.seq for r in job.parked.waiting(2).collect()) == [10, 31]
    job.run(text(spark, []), 2)
    assert job.parked.waiting(3).collect() == []


def test_views_follow_the_configuration(spark, tmp_path):
    spark.sql("DROP SCHEMA IF EXISTS dim_views CASCADE")
    job = tables(spark, tmp_path, schema="dim_views")
    view = lambda: [tuple(r) for r in spark.table("dim_views.dim_user_info").orderBy("id").collect()]
    job.run(text(spark, [(1, config("id,name"), True)]), 0)
    assert view() == [] and spark.table("dim_views.dim_user_info").columns == ["id", "name"]
    job.run(text(spark, [(2, change(1, name="a", n="5"), False)]), 1)
    assert view() == [("1", "a")]
    job.run(text(spark, [(3, config("id,name,n"), True), (4, change(2, name="b", n="6"), False)]), 2)
    assert view() == [("1", "a", None), ("2", "b", "6")]
    job.run(text(spark, [(5, config("n,id"), True)]), 3)
    assert spark.table("dim_views.dim_user_info").columns == ["n", "id", "name"]
    assert view() == [(None, "1", None), ("6", "2", None)]
    props = {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES dim_views.dim_user_info").collect()}
    assert props["primary_key"] == "id"
    # A new session's job publishes what it finds.
    spark.sql("DROP VIEW dim_views.dim_user_info")
    tables(spark, tmp_path, schema="dim_views").run(text(spark, []), 4)
    assert view() == [(None, "1", None), ("6", "2", None)]
    spark.sql("DROP SCHEMA dim_views CASCADE")


def test_no_row_stops_the_stream(spark, tmp_path):
    out = str(tmp_path / "dirty")
    job = tables(spark, tmp_path, dirty=file_sink(out), log=str(tmp_path / "log"))
    rows = [(1, config("id"), True), (2, "{", True), (3, "x", False), (4, None, False), (5, json.dumps({"database": "shop", "table": "user_info", "type": "insert", "data": {"n": 1}}), False)]
    job.run(text(spark, [*rows, (6, change(1), False)]), 0)
    assert store_rows(spark, str(tmp_path / "store")) == {("dim_user_info", '["1"]'): {"id": "1"}}
    found = {(r.kind, r.seq, r.problem) for r in read_sink(spark, out).collect()}
    assert found == {("config", 2, "unreadable"), ("change", 3, "unreadable"), ("change", 4, "unreadable"), ("change", 5, "no primary key value")}
    assert dims.read_changes(spark, str(tmp_path / "log")).count() == 1
    upserts.rebuild_store(spark, str(tmp_path / "log"), str(tmp_path / "again"))
    assert store_rows(spark, str(tmp_path / "again")) == store_rows(spark, str(tmp_path / "store"))


@pytest.mark.parametrize("as_of", [False, True])
def test_dimension_stream(spark, tmp_path, as_of):
    landed, settings = str(tmp_path / "landed"), str(tmp_path / "config")
    lines = [(10 * i, INSERT.replace('"1"', f'"{i}"')) for i in range(6)]
    for path, rows in ((landed, lines), (settings, [(15, CREATE), (45, DROP)] if as_of else [(15, CREATE)])):
        os.makedirs(path)
        pq.write_table(spark.createDataFrame(rows, "seq bigint, value string").toArrow(), f"{path}/part-0.parquet")
    read = lambda path: read_log(spark, {"kind": "landed", "path": path})
    store = str(tmp_path / "store")
    run_to_end(route_dimensions_stream(read(landed), read(settings), "shop", store, str(tmp_path / "ckpt"), as_of=as_of), 120)
    ids = {d["id"] for d in store_rows(spark, store).values()}
    assert ids == ({"2", "3", "4"} if as_of else {str(i) for i in range(6)})


def test_sources_become_one(spark):
    one = spark.createDataFrame([("a", 1)], "value string, seq int")
    assert {tuple(r) for r in dimension_source(one, one).collect()} == {("a", 1, False), ("a", 1, True)}
