"""Typed reads from a parsed (``VARIANT``) record, and small text tests (SCA6-SCA8, FLT3-FLT4)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def read_string(record: Column | str, path: str) -> Column:
    """Text at ``path`` (``common.mid``); numbers and objects become their text form."""
    return F.try_variant_get(_col(record), f"$.{path}", "string")


def read_long(record: Column | str, path: str) -> Column:
    """64-bit integer at ``path``; numeric text is accepted."""
    return F.try_variant_get(_col(record), f"$.{path}", "bigint")


def read_object(record: Column | str, path: str) -> Column:
    """Sub-record at ``path`` as ``VARIANT``; a JSON null counts as missing."""
    part = F.try_variant_get(_col(record), f"$.{path}", "variant")
    return F.when(~F.is_variant_null(part), part)


def read_array(record: Column | str, path: str) -> Column:
    """Array at ``path`` as ``ARRAY<VARIANT>``; anything else gives NULL."""
    return F.try_variant_get(_col(record), f"$.{path}", "array<variant>")


def in_list(item: Column | str, listed: Column | str, separator: str = ",") -> Column:
    """SCA7: whether ``item`` is one of the (untrimmed) parts of ``listed``."""
    return F.array_contains(F.split(_col(listed), separator, -1), _col(item))


def is_blank(text: Column | str) -> Column:
    """SCA8/FLT4: NULL or empty."""
    return F.coalesce(F.length(_col(text)), F.lit(0)) == 0


def is_missing(text: Column | str) -> Column:
    """FLT3: NULL only; an empty string is present."""
    return _col(text).isNull()
