import json
import os
import time

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import models
from test_visits import D1, frame, random_rows
from tidemark.functions.paths import is_blank
from tidemark.plans.jobs import daily_unique_visitors, jump_outs, split_traffic
from tidemark.sources.text import landed_text, read_log
from tidemark.streaming.jobs import (
    daily_unique_visitors_stream,
    jump_outs_stream,
    run_to_end,
    split_traffic_stream,
)
from tidemark.streaming import state
from tidemark.streaming.operators import (
    DailyVisits,
    NextMatches,
    distinct_entries_stream,
    first_entry_per_day_stream,
    match_next_stream,
    repair_first_visit_stream,
)
from tidemark.streaming.state import StateTable, file_sink, read_sink


@pytest.fixture(autouse=True)
def few_partitions(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def landed(spark, folder, df, parts):
    """Write ``df`` by arrival order as ``parts`` files with distinct times."""
    path = str(folder / "landed")
    os.makedirs(path)
    rows = df.orderBy("seq").toPandas()
    size = -(-len(rows) // parts)
    for i in range(parts):
        name = f"{path}/part-{i}.parquet"
        rows.iloc[i * size : (i + 1) * size].to_parquet(name, index=False)
        os.utime(name, (1_700_000_000 + 10 * i,) * 2)
    return path


def run(spark, folder, stream, *args, partitions=(), **kw):
    """Run a stream to its end and read what it emitted."""
    out = str(folder / "out")
    run_to_end(stream(*args, file_sink(out, *partitions), str(folder / "ckpt"), **kw), 300)
    return read_sink(spark, out)


def rest(spark, folder, within_ms, lateness_ms, key_type="string"):
    """Pairs that are open at the end of a stream, and the number of late rows."""
    last = spark.read.parquet(str(folder / "out")).agg(F.max("batch_id")).first()[0]
    matches = NextMatches(spark, str(folder / "ckpt"), key_type, within_ms, lateness_ms=lateness_ms)
    return matches.rest(last), matches.late_rows(last)


def stream_of(spark, folder, df, parts=3):
    path = landed(spark, folder, df, parts)
    schema = spark.read.parquet(path).schema.simpleString()[7:-1].replace(":", " ")
    return landed_text(spark, path, True, schema, files_per_trigger=1)


def test_repair_stream(spark, tmp_path):
    rows = random_rows(600, 12, 7)
    source = stream_of(spark, tmp_path, frame(spark, rows))
    got = {r.seq: r.is_new for r in run(spark, tmp_path, repair_first_visit_stream, source).collect()}
    assert got == models.repair([r[:4] for r in rows])


def test_uv_stream(spark, tmp_path):
    rows = random_rows(600, 12, 8)
    source = stream_of(spark, tmp_path, frame(spark, rows))
    got = [r.seq for r in run(spark, tmp_path, first_entry_per_day_stream, source).collect()]
    assert len(got) == len(set(got))
    assert set(got) == models.daily_uv([(r[0], r[1], r[2], r[4]) for r in rows])


def test_jump_out_stream(spark, tmp_path):
    rows = [(i, f"m{i % 5}", D1 + i * 900 + (i % 3), "0", [None, "", "p"][(i // 5) % 3]) for i in range(400)]
    source = stream_of(spark, tmp_path, frame(spark, rows))
    entry = is_blank("last_page_id")
    out = run(spark, tmp_path, match_next_stream, source, entry, entry, within_ms=10_000, row=F.col("mid"), lateness_ms=5_000)
    got = [(r.first_seq, r.second_seq) for r in out.unionByName(rest(spark, tmp_path, 10_000, 5_000)[0]).collect()]
    assert len(got) == len(set(got))
    assert set(got) == models.jump_outs([(r[0], r[1], r[2], r[4]) for r in rows], 10_000)


def line(seq, mid, ts, is_new, last_page):
    page = {"page_id": "p"} if last_page is None else {"page_id": "p", "last_page_id": last_page}
    record = {"common": {"mid": mid, "is_new": is_new}, "page": page, "ts": ts}
    if seq % 5 == 0:
        record["actions"] = [{"action_id": str(seq)}]
    return "oops" if seq % 11 == 0 else json.dumps(record, separators=(",", ":"))


def text_rows(spark, n, seed):
    rows = [(r[0], line(*r[:4], r[4])) for r in random_rows(n, 6, seed)]
    return spark.createDataFrame(rows, "seq bigint, value string")


def test_split_stream_equals_batch(spark, tmp_path):
    raw = text_rows(spark, 300, 4)
    source = read_log(spark, {"kind": "landed", "path": landed(spark, tmp_path, raw, 2), "files_per_trigger": 1})
    out = run(spark, tmp_path, split_traffic_stream, source, partitions=("channel",))
    key = lambda r: (r.seq, r.channel, r.position, r.mid, r.value)
    streamed = sorted(map(key, out.collect()), key=str)
    assert streamed == sorted(map(key, split_traffic(raw).collect()), key=str)
    assert {r[1] for r in streamed} == {"page", "action", "dirty"}


def test_page_jobs_stream_equal_batch(spark, tmp_path):
    raw = text_rows(spark, 300, 5)
    source = landed_text(spark, landed(spark, tmp_path, raw, 1), True)
    uv = run(spark, tmp_path / "uv", daily_unique_visitors_stream, source)
    assert {r.value for r in uv.collect()} == {r.value for r in daily_unique_visitors(raw).collect()}
    jumps = run(spark, tmp_path / "jump", jump_outs_stream, source)
    jumps = jumps.unionByName(rest(spark, tmp_path / "jump", 10_000, 60_000)[0])
    got = {(r.mid, r.first_row, r.second_row) for r in jumps.collect()}
    assert got == {(r.mid, r["first"].value, r["second"].value) for r in jump_outs(raw).collect()}
    assert got


def add_file(spark, path, index, rows, schema):
    os.makedirs(path, exist_ok=True)
    name = f"{path}/part-{index}.parquet"
    pq.write_table(spark.createDataFrame(rows, schema).toArrow(), name)
    os.utime(name, (1_700_000_000 + 10 * index,) * 2)


SCHEMA = "seq bigint, mid string, ts bigint, is_new string, last_page_id string"


def test_state_survives_a_restart(spark, tmp_path):
    rows = random_rows(400, 8, 9)
    path = str(tmp_path / "in")
    for index, part in enumerate((rows[:200], rows[200:])):
        add_file(spark, path, index, part, SCHEMA)
        out = run(spark, tmp_path, first_entry_per_day_stream, landed_text(spark, path, True, SCHEMA))
    got = [r.seq for r in out.collect()]
    assert len(got) == len(set(got))
    assert set(got) == models.daily_uv([(r[0], r[1], r[2], r[4]) for r in rows])


def test_state_is_folded_and_batches_run_again(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(state, "FOLD_EVERY", 2)
    latest = lambda rows: rows.groupBy("key").agg(F.max_by("v", "version").alias("v"), F.max("version").alias("version"))
    table = StateTable(spark, str(tmp_path / "ckpt"), "t", "key string, v int", latest)
    expected = {}
    for batch_id in range(7):
        for _ in range(2):
            assert {r.key: r.v for r in table.before(batch_id).collect()} == expected
            rows = [(f"k{batch_id % 3}", batch_id)]
            table.write(batch_id, spark.createDataFrame(rows, "key string, v int"))
        expected |= dict(rows)


def test_lateness(spark, tmp_path):
    """Rows within the lateness count wherever they come from; later ones are left out and counted."""
    path, entry = str(tmp_path / "in"), is_blank("last_page_id")
    row = lambda seq, ts: (seq, "m", D1 + ts, "0", None)
    add_file(spark, path, 0, [row(0, 0), row(1, 50_000)], SCHEMA)
    add_file(spark, path, 1, [row(2, 50_000), row(3, 1_000)], SCHEMA)
    add_file(spark, path, 2, [row(4, 90_000), row(5, 2_000), row(6, 50_000)], SCHEMA)
    add_file(spark, path, 3, [row(7, 190_000), row(8, 29_000), row(9, 51_000)], SCHEMA)
    source = landed_text(spark, path, True, SCHEMA, files_per_trigger=1)
    out = run(spark, tmp_path, match_next_stream, source, entry, entry, within_ms=10_000, row="mid", lateness_ms=60_000)
    left, late = rest(spark, tmp_path, 10_000, 60_000)
    assert late == 1
    assert {(r.first_seq, r.second_seq) for r in out.unionByName(left).collect()} == {(0, 3), (3, 5), (1, 2), (2, 6), (6, 9)}


def test_a_partition_behind_loses_nothing_within_the_lateness(spark, tmp_path):
    path, entry = str(tmp_path / "in"), is_blank("last_page_id")
    ahead = [(2 * i, "a", D1 + i * 4_000, "0", None) for i in range(60)]
    behind = [(2 * i + 1, "b", D1 + i * 4_000, "0", None) for i in range(60)]
    for batch in range(6):
        part = ahead[batch * 10 : batch * 10 + 10] + (behind[(batch - 1) * 10 : batch * 10] if batch else [])
        add_file(spark, path, batch, part + (behind[50:] if batch == 5 else []), SCHEMA)
    source = landed_text(spark, path, True, SCHEMA, files_per_trigger=1)
    out = run(spark, tmp_path, match_next_stream, source, entry, entry, within_ms=10_000, row="mid", lateness_ms=80_000)
    left, late = rest(spark, tmp_path, 10_000, 80_000)
    got = [(r.first_seq, r.second_seq) for r in out.unionByName(left).collect()]
    assert late == 0 and len(got) == len(set(got))
    assert set(got) == {(i, i + 2) for i in range(118)}


def test_rows_without_a_key_or_time_pass_the_repair(spark, tmp_path):
    path = str(tmp_path / "in")
    add_file(spark, path, 0, [(0, None, D1, "1", None), (1, "m", None, "1", None), (2, "m", D1, "1", None)], SCHEMA)
    out = run(spark, tmp_path, repair_first_visit_stream, landed_text(spark, path, True, SCHEMA))
    assert sorted((r.seq, r.mid, r.is_new) for r in out.collect()) == [(0, None, "1"), (1, "m", "1"), (2, "m", "1")]


def test_last_visit_expires(spark, tmp_path):
    path = str(tmp_path / "in")
    seen = []
    for index in range(3):
        add_file(spark, path, index, [(index, "m", D1, "0", None)], SCHEMA)
        out = run(spark, tmp_path, first_entry_per_day_stream, landed_text(spark, path, True, SCHEMA), ttl_ms=60_000 if index < 2 else 1)
        seen.append(sorted(r.seq for r in out.collect()))
    assert seen == [[0], [0], [0, 2]]


def test_stream_timeouts_equal_model(spark, tmp_path):
    rows = [(i, f"m{i % 5}", D1 + i * 2_900 + (i % 3), "0", [None, "", "p"][(i // 5) % 3]) for i in range(300)]
    source = stream_of(spark, tmp_path, frame(spark, rows), parts=4)
    entry = is_blank("last_page_id")
    out = run(spark, tmp_path, match_next_stream, source, entry, entry, within_ms=10_000, row=F.col("mid"), lateness_ms=5_000, timeouts=True)
    last = spark.read.parquet(str(tmp_path / "out")).agg(F.max("batch_id")).first()[0]
    left = NextMatches(spark, str(tmp_path / "ckpt"), "string", 10_000, lateness_ms=5_000, timeouts=True).rest(last)
    got = [(r.first_seq, r.second_seq) for r in out.unionByName(left).collect()]
    pages = [(r[0], r[1], r[2], r[4]) for r in rows]
    assert len(got) == len(set(got))
    assert {g for g in got if g[1] is not None} == models.jump_outs(pages, 10_000)
    assert sorted(g[0] for g in got if g[1] is None) == sorted(models.timeouts(pages, 10_000))


def test_distinct_entries_stream(spark, tmp_path):
    rows = random_rows(600, 12, 13)
    out = run(spark, tmp_path, distinct_entries_stream, stream_of(spark, tmp_path, frame(spark, rows)), lateness="30 days").collect()
    expected = {(r[1], models.day_of(r[2])) for r in rows if r[4] is None}
    assert sorted((r.mid, str(r.visit_date)) for r in out) == sorted(expected)
    # The exact form emits a device's day again where days are interleaved.
    assert len(expected) < len(models.daily_uv([(r[0], r[1], r[2], r[4]) for r in rows]))


def rows_scanned(df):
    """Rows that the scans of a plan without shuffles gave out."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(plan.apply(i).metrics().apply("numOutputRows").value() for i in range(plan.size()))


def test_a_small_batch_reads_little_of_a_large_state(spark, tmp_path):
    """1,000 of a million keys, here a tenth of ten million so that the test is short: blocks and pages are what counts."""
    table = StateTable(spark, str(tmp_path / "ckpt"), "t", "key string, day int")
    keys = spark.range(1_000_000).select(F.concat(F.lit("device-"), "id").alias("key"), F.lit(1).alias("day"))
    table.write(0, keys.repartition(4))
    batch = spark.range(0, 1_000_000, 10_000).select(F.concat(F.lit("device-"), "id").alias("key"))
    found = table.before(1, batch)
    assert rows_scanned(found) < 0.02 * 1_000_000
    assert found.join(batch, "key").count() == 100
    # A batch that touches more blocks than are worth asking for reads everything, with the same result.
    many = spark.range(0, 1_000_000, 100).select(F.concat(F.lit("device-"), "id").alias("key"))
    assert table.before(1, many).join(many, "key").count() == 10_000


def test_folders_of_a_long_state_stay_few():
    for count in (0, 1, 19, 20, 21, 399, 400, 401, 8123):
        parts = StateTable._covering(count)
        at = 0
        for level, start in parts:
            assert start == at
            at += state.FOLD_EVERY**level
        assert at == count and len(parts) <= 4 * state.FOLD_EVERY


def test_expired_periods_are_dropped_and_state_levels_off(spark, tmp_path):
    """With a lifetime of three batches, the rows of state stop growing; a batch that runs again gives the same rows."""
    now = [1_000_000]
    visits = DailyVisits(spark, str(tmp_path / "ckpt"), "string", ttl_ms=3_000, clock=lambda: now[0])
    kept, model, stored_rows = [], {}, []
    for batch_id in range(12):
        now[0] += 1_000
        rows = [(batch_id * 10 + i, f"m{(batch_id * 3 + i) % 40}", D1, "0", None) for i in range(10)]
        batch = spark.createDataFrame(rows, SCHEMA)
        got = sorted(r.seq for r in visits.fresh(batch, batch_id).collect())
        if batch_id % 4 == 3:
            now[0] += 200
            assert sorted(r.seq for r in visits.fresh(batch, batch_id).collect()) == got
            now[0] -= 200
        expected = []
        for seq, mid, *_ in rows:
            if mid not in model or model[mid] <= now[0] - 3_000:
                expected.append(seq)
                model[mid] = now[0]
        assert got == expected
        kept.append(got)
        stored_rows.append(spark.read.parquet(str(tmp_path / "ckpt-state" / "daily-visits")).count())
    assert sum(stored_rows[9:]) <= 1.2 * sum(stored_rows[6:9]) and max(stored_rows) <= 60 and len(os.listdir(tmp_path / "ckpt-state" / "daily-visits")) <= 3
