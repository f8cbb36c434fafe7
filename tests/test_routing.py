import random

import pytest
from pyspark.sql import functions as F

import models
from tidemark.operators import sizes
from tidemark.operators.changelog import fold_changes, latest_per_key
from tidemark.operators.routing import (
    change_records,
    config_changes,
    current_config,
    judged_config,
    route_as_of,
    route_current,
)
from tidemark.plans.jobs import route_dimensions

INSERT = '{"database":"shop","table":"user_info","type":"insert","data":{"id":"1","name":"a","secret":"x","n":null}}'
CREATE = (
    '{"op":"c","before":null,"after":{"source_table":"user_info","sink_table":"dim_user_info",'
    '"sink_columns":"id,name,n","sink_primary_key":"id","sink_extend":null}}'
)
CAMEL = (
    '{"op":"u","before":null,"after":{"sourceTable":"user_info","sinkTable":"dim_user","sinkColumns":"id",'
    '"sinkPrimaryKey":"id","sinkExtend":"e"}}'
)
DROP = '{"op":"d","before":{"source_table":"user_info"},"after":null}'


def raw(spark, lines):
    return spark.createDataFrame([(s, v) for s, v in lines], "seq bigint, value string")


def test_change_records(spark):
    lines = [INSERT, '{"database":"shop","table":"t","type":"bootstrap-start"}', '{"database":"shop","table":"t","data":{}}',
             '{"database":"shop","table":"t","type":"insert"}', "oops", '{"database":"shop","table":"t","type":"update","data":{"a":1.50,"o":{"k":1}}}']
    rows = change_records(raw(spark, enumerate(lines))).orderBy("seq").collect()
    assert [r.is_dirty for r in rows] == [False, False, True, True, True, False]
    assert rows[0].data == {"id": "1", "name": "a", "secret": "x", "n": None}
    assert rows[5].data["o"] == '{"k":1}'


def test_config_changes(spark):
    rows = config_changes(raw(spark, enumerate([CREATE, CAMEL, DROP, "oops", "{}"]))).orderBy("seq").collect()
    assert [(r.seq, r.op, r.is_deleted, r.source_table, r.sink_table, r.sink_extend) for r in rows] == [
        (0, "c", False, "user_info", "dim_user_info", None),
        (1, "u", False, "user_info", "dim_user", "e"),
        (2, "d", True, "user_info", None, None),
    ]


@pytest.mark.parametrize(
    "log, expected",
    [
        ([CREATE], ["dim_user_info"]),
        ([CREATE, CAMEL], ["dim_user"]),
        ([CREATE, DROP], []),
        ([DROP, CREATE], ["dim_user_info"]),
        ([], []),
    ],
)
def test_current_config(spark, log, expected):
    changes = config_changes(raw(spark, enumerate(log)))
    assert [r.sink_table for r in current_config(changes).collect()] == expected


def test_route_dimensions(spark):
    lines = [
        INSERT,
        INSERT.replace("shop", "other"),
        INSERT.replace("user_info", "unknown"),
        INSERT.replace('"insert"', '"bootstrap-complete"'),
        INSERT.replace('"insert"', '"bootstrap-insert"'),
        INSERT.replace('"insert"', '"delete"'),
        "oops",
    ]
    out = route_dimensions(raw(spark, enumerate(lines)), raw(spark, [(0, CREATE)]), "shop").orderBy("seq").collect()
    assert [(r.seq, r.type, r.sink_table) for r in out] == [
        (0, "insert", "dim_user_info"),
        (4, "bootstrap-insert", "dim_user_info"),
        (5, "delete", "dim_user_info"),
    ]
    assert all(r.data == {"id": "1", "name": "a", "n": None} for r in out)


def test_route_as_of_text(spark):
    changes = raw(spark, [(0, INSERT), (2, INSERT), (4, INSERT), (6, INSERT)])
    config = raw(spark, [(1, CREATE), (3, CAMEL), (5, DROP)])
    out = route_dimensions(changes, config, "shop", as_of=True).orderBy("seq").collect()
    assert [(r.seq, r.sink_table, sorted(r.data)) for r in out] == [
        (2, "dim_user_info", ["id", "n", "name"]),
        (4, "dim_user", ["id"]),
    ]


@pytest.mark.parametrize("max_rows, group_rows", [(1000, 1000), (0, 1000), (0, 40)])
def test_route_current_paths(spark, max_rows, group_rows):
    rng = random.Random(5)
    tables = ["hot"] * 300 + [f"t{rng.randrange(60)}" for _ in range(600)]
    records = spark.createDataFrame(list(enumerate(tables)), "seq bigint, table string").repartition(4)
    known = ["hot"] + [f"t{i}" for i in range(30)]
    config = spark.createDataFrame([(t, f"dim_{t}") for t in known], "source_table string, sink_table string")
    out = route_current(records, config, max_rows=max_rows, group_rows=group_rows)
    got = {r.seq: (r.table, r.sink_table) for r in out.collect()}
    assert got == {s: (t, f"dim_{t}") for s, t in enumerate(tables) if t in set(known)}


@pytest.mark.parametrize("max_rows, group_rows", [(100_000, 1000), (0, 100_000), (0, 60), (0, 7), (0, 1)])
@pytest.mark.parametrize("hot_config", [False, True])
def test_route_as_of_equals_model(spark, max_rows, group_rows, hot_config):
    rng = random.Random(11)
    pick = lambda hot: "hot" if rng.random() < hot else f"t{rng.randrange(12)}"
    records = [(s, pick(0.4)) for s in range(0, 3000, 2)]
    seqs = rng.sample(range(5, 2800), 50)
    changes = [(s, pick(0.5 if hot_config else 0.02), rng.random() < 0.25, f"dim{s}") for s in seqs]
    out = route_as_of(
        spark.createDataFrame(records, "seq bigint, table string").repartition(4),
        spark.createDataFrame(changes, "seq bigint, source_table string, is_deleted boolean, sink_table string"),
        settings=("sink_table",),
        max_rows=max_rows,
        group_rows=group_rows,
    )
    rows = out.collect()
    got = {r.seq: r.sink_table for r in rows}
    assert len(rows) == len(got)
    assert got == models.as_of(records, changes)


def test_fold(spark):
    df = spark.createDataFrame(
        [("a", 1, "c"), ("a", 3, "d"), ("b", 2, "c"), ("b", 1, "d"), (None, 1, "c")], "k string, seq int, op string"
    )
    assert {(r.k, r.seq) for r in latest_per_key(df, ["k"], ["seq"]).collect()} == {("a", 3), ("b", 2), (None, 1)}
    assert {(r.k, r.seq) for r in fold_changes(df, ["k"], ["seq"], F.col("op") == "d").collect()} == {("b", 2), (None, 1)}


def test_route_as_of_with_sparse_arrival_numbers(spark):
    far = 10**15
    records = spark.createDataFrame([(i * far, "hot") for i in range(1, 9)], "seq bigint, table string")
    changes = spark.createDataFrame(
        [(far + 1, "hot", False, "a"), (5 * far, "hot", True, None), (7 * far - 1, "hot", False, "b")],
        "seq bigint, source_table string, is_deleted boolean, sink_table string",
    )
    out = route_as_of(records, changes, settings=("sink_table",), max_rows=0, group_rows=2)
    got = {r.seq // far: r.sink_table for r in out.collect()}
    assert got == {2: "a", 3: "a", 4: "a", 7: "b", 8: "b"}


def test_numbers_keep_their_digits(spark):
    data = '{"a":10.50,"b":100.00,"c":123456789012345678901234567890123456789012,"d":-0,"e":1E5,"f":"x: 1.50","g":{"h":[1.10,"2"]},"i":null,"j":true}'
    line = f'{{"database":"shop","table":"t","type":"insert","data":{data}}}'
    wrong = [line.replace("10.50", "010"), line.replace("10.50", "1 2"), line.replace("x", "\u0001")]
    rows = change_records(raw(spark, list(enumerate([line, *wrong])))).orderBy("seq").collect()
    assert [r.is_dirty for r in rows] == [False, True, True, True]
    assert rows[0].data == {
        "a": "10.50",
        "b": "100.00",
        "c": "123456789012345678901234567890123456789012",
        "d": "-0",
        "e": "1E5",
        "f": "x: 1.50",
        "g": '{"h":[1.10,"2"]}',
        "i": None,
        "j": "true",
    }


def test_configuration_that_does_not_count(spark):
    lines = ["oops", CREATE.replace('"sink_primary_key":"id"', '"sink_primary_key":"uid"'), CREATE, DROP]
    found = judged_config(raw(spark, list(enumerate(lines)))).orderBy("seq").collect()
    assert [r.problem for r in found] == ["unreadable", "no primary key among the columns", None, None]


def test_chunks_follow_the_rows_not_the_numbers(spark):
    rows = spark.range(1000).selectExpr("id * 1000000 AS seq", "'hot' AS k").union(spark.range(5).selectExpr("id AS seq", "'cold' AS k"))
    hot = sizes.hot_keys(rows, "k", 100, "seq")
    counts = {r._chunk: r["count"] for r in sizes.with_chunk(rows, "k", "seq", hot).where("k = 'hot'").groupBy("_chunk").count().collect()}
    assert len(counts) == 10 and max(counts.values()) <= 101
