"""Epoch-millisecond and local-time conversions (SCA1-SCA5).

Everything works on ``TIMESTAMP_NTZ`` values, so the session time zone never
changes a result.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# Text forms, parse offset, display zone and one day in milliseconds.
DATE_TEXT = "yyyy-MM-dd"
DATETIME_TEXT = "yyyy-MM-dd HH:mm:ss"
PARSE_ZONE = "+08:00"
DISPLAY_ZONE = "Asia/Shanghai"
DAY_MS = 24 * 60 * 60 * 1000

# Zones whose offset has not changed since an instant: zone -> (offset, instant), in milliseconds.
# China has had +08:00 without clock changes since September 1991; the instant is 1992-01-01 UTC.
STEADY_ZONES = {"Asia/Shanghai": (8 * 3_600_000, 694_224_000_000)}

# Farthest instant from the epoch that Spark's timestamps hold, rounded down.
MAX_MS = 9_000_000_000_000_000

_DATETIME_SHAPE = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def ntz_to_epoch_ms(ts: Column | str) -> Column:
    """UTC wall-clock ``TIMESTAMP_NTZ`` to epoch milliseconds (truncating).

    Interval division, because ``timestampdiff`` goes through the session zone
    and is an hour off in its clock-change gaps.
    """
    return F.call_function("div", _col(ts) - _epoch(), F.expr("INTERVAL '0.001' SECOND"))


def _steady(tz: str) -> tuple[int, int | None] | None:
    """Offset of ``tz`` and the instant from which it holds (None: always); None if it changes."""
    if tz in ("UTC", "Z"):
        return 0, None
    fixed = re.fullmatch(r"([+-])(\d{2}):(\d{2})", tz)
    if fixed:
        sign, hours, minutes = fixed.groups()
        return int(f"{sign}1") * (int(hours) * 60 + int(minutes)) * 60_000, None
    return STEADY_ZONES.get(tz)


def _by_offset(ms: Column, tz: str, arithmetic, general: Column) -> Column:
    """``arithmetic`` on the shifted value where the offset is known, else ``general``.

    Zone rules cost several times as much per row as an addition.
    """
    steady = _steady(tz)
    if steady is None:
        return general
    offset, since = steady
    shifted = arithmetic(ms + F.lit(offset))
    return shifted if since is None else F.when(ms >= since, shifted).otherwise(general)


def _as_ntz(ms: Column) -> Column:
    return F.timestamp_add("MILLISECOND", ms, _epoch())


def epoch_ms_to_local(ms: Column | str, tz: str = DISPLAY_ZONE) -> Column:
    """Epoch milliseconds to the wall clock of ``tz`` as ``TIMESTAMP_NTZ``."""
    ms = _col(ms)
    general = F.convert_timezone(F.lit("UTC"), F.lit(tz), _as_ntz(ms))
    return _by_offset(ms, tz, _as_ntz, general)


def local_date(ms: Column | str, tz: str = DISPLAY_ZONE) -> Column:
    """Calendar day of an epoch-millisecond value, as ``DATE``.

    Operators compare and aggregate this form: a ``DATE`` is a fixed-width
    value, so ``min_by`` over it stays a hash aggregate.
    """
    ms = _col(ms)

    def day(shifted: Column) -> Column:
        whole = shifted - F.pmod(shifted, F.lit(DAY_MS))
        return F.date_from_unix_date(F.call_function("div", whole, F.lit(DAY_MS)).cast("int"))

    general = F.convert_timezone(F.lit("UTC"), F.lit(tz), _as_ntz(ms)).cast("date")
    return _by_offset(ms, tz, day, general)


def to_date_text(ms: Column | str, tz: str = DISPLAY_ZONE) -> Column:
    """SCA3: epoch milliseconds to ``yyyy-MM-dd``."""
    return local_date(ms, tz).cast("string")


def to_datetime_text(ms: Column | str, tz: str = DISPLAY_ZONE) -> Column:
    """SCA4: epoch milliseconds to ``yyyy-MM-dd HH:mm:ss``."""
    return F.substring(epoch_ms_to_local(ms, tz).cast("string"), 1, len(DATETIME_TEXT))


def to_epoch_ms(text: Column | str, full: bool = False, tz: str = PARSE_ZONE) -> Column:
    """SCA1/SCA2: date text (or date-time text when ``full``) to epoch milliseconds.

    Text of any other shape gives NULL.
    """
    text = _col(text)
    if not full:
        text = F.concat(text, F.lit(" 00:00:00"))
    parsed = F.when(text.rlike(_DATETIME_SHAPE), text).try_cast("timestamp_ntz")
    steady = _steady(tz)
    if steady and steady[1] is None:
        return ntz_to_epoch_ms(parsed) - F.lit(steady[0])
    return ntz_to_epoch_ms(F.convert_timezone(F.lit(tz), F.lit("UTC"), parsed))


def previous_local_date(ms: Column | str, tz: str = DISPLAY_ZONE) -> Column:
    """SCA5: calendar day of the instant 24 hours earlier, as ``DATE``."""
    return local_date(_col(ms) - F.lit(DAY_MS), tz)
