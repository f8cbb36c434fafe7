import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

import models
from tidemark.operators import counts, sizes
from tidemark.operators.patterns import match_next, match_timeouts
from tidemark.operators.visits import first_entry_per_day, repair_first_visit
from tidemark.functions.paths import is_blank
from tidemark.sources.text import arrival_order

D1 = 1704070800000  # 2024-01-01 09:00 at +8
D2 = D1 + models.DAY_MS

SCHEMA = "seq bigint, mid string, ts bigint, is_new string, last_page_id string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def random_rows(n, keys, seed, hot=0.34):
    rng = random.Random(seed)
    rows = []
    for seq in range(n):
        mid = "m0" if rng.random() < hot else f"m{rng.randrange(keys)}"
        ts = D1 + seq * 4000 + rng.choice([0, 0, 0, 7000, -9000, models.DAY_MS, -models.DAY_MS])
        rows.append((seq, mid, ts, rng.choice("01"), rng.choice([None, None, "", "home"])))
    return rows


def repaired(df, **kw):
    return {r.seq: r.is_new for r in repair_first_visit(df, **kw).collect()}


@pytest.mark.parametrize(
    "rows, expected",
    [
        ([(D1, "1"), (D1, "1"), (D2, "1")], ["1", "1", "0"]),
        ([(D2, "0"), (D2, "1"), (D1, "1")], ["0", "0", "1"]),
        ([(D1, "0"), (D2, "0")], ["0", "0"]),
    ],
)
def test_repair_cases(spark, rows, expected):
    df = frame(spark, [(i, "m", ts, new, None) for i, (ts, new) in enumerate(rows)])
    assert [v for _, v in sorted(repaired(df).items())] == expected


@pytest.mark.parametrize("kw", [{}, {"max_rows": 0}, {"max_rows": 0, "group_rows": 50}])
def test_repair_equals_model(spark, kw):
    rows = random_rows(3000, 40, 1)
    expected = models.repair([r[:4] for r in rows])
    assert repaired(frame(spark, rows), **kw) == expected
    assert sum(expected[r[0]] != r[3] for r in rows) > 100


def test_repair_leaves_rows_without_device(spark):
    df = frame(spark, [(0, None, D1, "1", None), (1, None, D2, "1", None)])
    assert repaired(df) == {0: "1", 1: "1"}
    assert repaired(df, max_rows=0) == {0: "1", 1: "1"}


def uv(df, **kw):
    return {r.seq for r in first_entry_per_day(df, **kw).collect()}


@pytest.mark.parametrize(
    "rows, expected",
    [
        ([(D1, None), (D1, None), (D2, "home"), (D2, None)], {0, 3}),
        ([(D1, None), (D2, None), (D1, None)], {0, 1, 2}),
        ([(D1, "")], set()),
    ],
)
def test_uv_cases(spark, rows, expected):
    df = frame(spark, [(i, "m", ts, "0", lp) for i, (ts, lp) in enumerate(rows)])
    assert uv(df) == expected
    assert uv(df, group_rows=1) == expected


@pytest.mark.parametrize("group_rows", [4_000_000, 100, 7, 1])
def test_uv_equals_model(spark, group_rows):
    rows = random_rows(3000, 40, 2)
    expected = models.daily_uv([(r[0], r[1], r[2], r[4]) for r in rows])
    assert uv(frame(spark, rows), group_rows=group_rows) == expected
    distinct = {(r[1], models.day_of(r[2])) for r in rows if r[4] is None}
    assert len(expected) > len(distinct)


@pytest.mark.parametrize("spread", [lambda i: i, lambda i: i * 10**9, lambda i: i if i % 2 else 10**15 + i, lambda i: 10**15 if i == 0 else i])
def test_chunks_hold_about_as_many_rows(spark, spread):
    """However a hot device's numbers lie, its chunks are contiguous and hold at most twice the rows asked for."""
    rows = [("hot", spread(i)) for i in range(5000)] + [(f"m{i % 50}", i) for i in range(300)]
    df = spark.createDataFrame(rows, "mid string, seq bigint").repartition(4)
    found = sizes.with_chunk(df, "mid", "seq", sizes.hot_keys(df, "mid", 100, "seq"))
    chunks = found.groupBy("mid", "_chunk").agg(F.count("*").alias("n"), F.min("seq").alias("lo"), F.max("seq").alias("hi")).collect()
    hot = sorted((r for r in chunks if r.mid == "hot"), key=lambda r: r["_chunk"])
    assert len(hot) >= 50 and max(r.n for r in hot) <= 200
    assert all(a.hi < b.lo for a, b in zip(hot, hot[1:]))
    assert {r["_chunk"] for r in chunks if r.mid != "hot"} == {0}


def test_uv_by_time_partition_and_offset(spark):
    rows = [(i, "m0" if i % 3 else "m1", D1 + (i * 7919 % 40) * models.DAY_MS // 20, "0", None) for i in range(400)]
    order = arrival_order(F.expr("seq div 8"), F.col("seq") % 2, F.expr("seq div 2"))
    df = frame(spark, rows).withColumn("arrival", order)
    ranked = sorted(rows, key=lambda r: (r[0] // 8, r[0] % 2, r[0] // 2))
    expected = models.daily_uv([(k, r[1], r[2], r[4]) for k, r in enumerate(ranked)])
    for group_rows in (1000, 20):
        assert uv(df, order="arrival", group_rows=group_rows) == {ranked[k][0] for k in expected}


@pytest.mark.parametrize("bucket_ms", [None, 10_000, 13_001])
def test_timeouts_equal_model(spark, bucket_ms):
    rows = random_rows(1500, 6, 12)
    out = match_timeouts(frame(spark, rows), is_blank("last_page_id"), 10_000, columns=["seq"], bucket_ms=bucket_ms)
    assert sorted(r["first"].seq for r in out.collect()) == sorted(models.timeouts([(r[0], r[1], r[2], r[4]) for r in rows], 10_000))


def test_daily_counts_and_sketches(spark):
    rows = [(i, f"m{i * 31 % 4000}" if i % 50 else None, D1 + (i % 3) * models.DAY_MS, "0", None) for i in range(20_000)]
    visits = frame(spark, rows).withColumn("visit_date", F.from_unixtime(F.col("ts") / 1000 + 28_800, "yyyy-MM-dd"))
    exact = {r.visit_date: (r.n_visitors, r.n_visits) for r in counts.daily_visitors(visits).collect()}
    days = {d: [r for r in rows if models.day_of(r[2]) == d] for d in {models.day_of(r[2]) for r in rows}}
    assert exact == {d: (len({r[1] for r in own} - {None}), len(own)) for d, own in days.items()}
    sketches = counts.daily_sketches(visits)
    for r in counts.visitors_in(sketches, "visit_date").collect():
        assert abs(r.n_visitors - exact[r.visit_date][0]) <= 0.05 * exact[r.visit_date][0]
    whole = counts.visitors_in(sketches).first().n_visitors
    devices = len({r[1] for r in rows} - {None})
    assert abs(whole - devices) <= 0.05 * devices
    assert counts.daily_visitors(visits.limit(0)).collect() == [] and counts.daily_sketches(visits.limit(0)).collect() == []


def jumps(df, within_ms=10_000, **kw):
    entry = is_blank("last_page_id")
    out = match_next(df, entry, entry, within_ms, **kw)
    return {(r["first"].seq, r["second"].seq) for r in out.collect()}


@pytest.mark.parametrize(
    "rows, expected",
    [
        ([(0, None), (9_999, None)], {(0, 1)}),
        ([(0, None), (10_000, None)], set()),
        ([(0, None), (1000, None), (2000, None)], {(0, 1), (1, 2)}),
        ([(0, None), (1000, "home"), (2000, None)], set()),
        ([(0, ""), (0, None)], {(0, 1)}),
    ],
)
@pytest.mark.parametrize("offset", [0, 595_000, 599_999, -5000])
def test_jump_out_cases(spark, rows, expected, offset):
    df = frame(spark, [(i, "m", 600_000 + offset + ts, "0", lp) for i, (ts, lp) in enumerate(rows)])
    assert jumps(df) == expected


@pytest.mark.parametrize("bucket_ms", [None, 10_000, 13_001])
def test_jump_out_equals_model(spark, bucket_ms):
    rows = random_rows(3000, 6, 3)
    expected = models.jump_outs([(r[0], r[1], r[2], r[4]) for r in rows], 10_000)
    assert jumps(frame(spark, rows), bucket_ms=bucket_ms) == expected
    assert len(expected) > 100


def test_different_conditions(spark):
    df = frame(spark, [(0, "m", 0, "1", None), (1, "m", 5, "0", None), (2, "m", 9, "1", None)])
    out = match_next(df, F.col("is_new") == "1", F.col("is_new") == "0", 10_000, columns=["seq"])
    assert [(r["first"].seq, r["second"].seq) for r in out.collect()] == [(0, 1)]


row = st.tuples(
    st.sampled_from(["a", "b"]),
    st.integers(0, 3).map(lambda d: D1 + d * models.DAY_MS),
    st.integers(-20_000, 20_000),
    st.sampled_from("01"),
    st.sampled_from([None, "", "p"]),
)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(row, min_size=1, max_size=25), st.integers(1, 9))
def test_properties(spark, drawn, group_rows):
    rows = [(i, mid, day + off, new, lp) for i, (mid, day, off, new, lp) in enumerate(drawn)]
    df = frame(spark, rows).coalesce(2).cache()
    pages = [(r[0], r[1], r[2], r[4]) for r in rows]
    assert repaired(df) == models.repair([r[:4] for r in rows])
    assert uv(df, group_rows=group_rows) == models.daily_uv(pages)
    assert jumps(df, bucket_ms=15_000) == models.jump_outs(pages, 10_000)
    df.unpersist()
