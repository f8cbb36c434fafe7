import random
from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from tidemark.functions import time as t
from tidemark.functions.paths import in_list, is_blank, is_missing, read_array, read_long, read_object, read_string

MS = 1704067200123  # 2024-01-01 00:00:00.123 UTC


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_epoch_to_text(spark):
    got = one(spark, t.to_date_text(F.lit(MS)), t.to_datetime_text(F.lit(MS)), t.to_datetime_text(F.lit(0)))
    assert got == ("2024-01-01", "2024-01-01 08:00:00", "1970-01-01 08:00:00")


def test_day_boundary(spark):
    midnight = 1704038400000  # 2024-01-01 00:00 at +8
    got = one(spark, t.to_date_text(F.lit(midnight)), t.to_date_text(F.lit(midnight - 1)), t.to_date_text(F.lit(-1)))
    assert got == ("2024-01-01", "2023-12-31", "1970-01-01")


@pytest.mark.parametrize("tz", ["Asia/Shanghai", "+08:00", "-03:30", "UTC", "Europe/Berlin", "America/Sao_Paulo"])
def test_zones_equal_python(spark, tz):
    rng = random.Random(3)
    values = [rng.randrange(-(10**12), 3 * 10**12) for _ in range(400)] + [694_224_000_000, 694_223_999_999, 0, -1]
    values += [521_000_000_000 + i * 3_600_000 for i in range(200)]  # 1986, clock changes in China
    rows = spark.createDataFrame([(v,) for v in values], "ms bigint").select(
        "ms", t.to_date_text("ms", tz).alias("d"), t.to_datetime_text("ms", tz).alias("dt"), t.local_date("ms", tz).alias("day")
    )
    if tz[0] in "+-":
        zone = timezone(int(tz[0] + "1") * timedelta(hours=int(tz[1:3]), minutes=int(tz[4:])))
    else:
        zone = ZoneInfo(tz)
    start = datetime(1970, 1, 1, tzinfo=timezone.utc)
    for r in rows.collect():
        local = (start + timedelta(milliseconds=r.ms)).astimezone(zone)
        assert (r.d, r.dt, r.day) == (local.strftime("%Y-%m-%d"), local.strftime("%Y-%m-%d %H:%M:%S"), local.date()), r.ms


def test_text_to_epoch(spark):
    got = one(
        spark,
        t.to_epoch_ms(F.lit("2024-01-01")),
        t.to_epoch_ms(F.lit("2024-01-01 08:00:00"), full=True),
        t.to_epoch_ms(F.lit("2024-1-1")),
        t.to_epoch_ms(F.lit("2024-01-01"), full=True),
        t.to_epoch_ms(F.lit("2024-13-01")),
    )
    assert got == (1704038400000, 1704067200000, None, None, None)


def test_round_trip_and_previous_day(spark):
    text = F.lit("2024-03-10 02:30:00")  # falls in a gap of the session zone
    back = t.to_datetime_text(t.to_epoch_ms(text, full=True))
    gap = F.lit("2024-03-10 02:30:00").cast("timestamp_ntz")
    assert one(spark, t.ntz_to_epoch_ms(gap)) == (1710037800000,)
    text_in_gap = t.to_datetime_text(t.to_epoch_ms(F.lit("2024-03-10 10:30:00"), full=True), "UTC")
    assert one(spark, text_in_gap) == ("2024-03-10 02:30:00",)
    prev = t.previous_local_date(F.lit(MS)).cast("string")
    assert one(spark, back, prev) == ("2024-03-10 02:30:00", "2023-12-31")


def test_paths(spark):
    text = '{"a":{"s":"x","n":7,"o":{"k":1}},"t":"42","l":[1,{"b":2}],"z":null}'
    record = F.parse_json(F.lit(text))
    got = one(
        spark,
        read_string(record, "a.s"),
        read_string(record, "a.n"),
        read_string(record, "a.o"),
        read_long(record, "t"),
        read_long(record, "a.s"),
        F.to_json(read_object(record, "a.o")),
        read_object(record, "z").isNull(),
        F.size(read_array(record, "l")),
        read_array(record, "a").isNull(),
    )
    assert got == ("x", "7", '{"k":1}', 42, None, '{"k":1}', True, 2, True)


def test_small_tests(spark):
    got = one(
        spark,
        in_list(F.lit("id"), F.lit("id,name")),
        in_list(F.lit("name"), F.lit("id, name")),
        is_blank(F.lit("")),
        is_blank(F.lit(None).cast("string")),
        is_blank(F.lit("x")),
        is_missing(F.lit("")),
        is_missing(F.lit(None).cast("string")),
    )
    assert got == (True, False, True, True, False, False, True)
