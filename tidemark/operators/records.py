"""Parsing raw text into records, with dirty rows kept apart (PRJ1, PRJ2, PRJ9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.time import MAX_MS

# Fields every traffic job reads: column -> (path, type).
LOG_FIELDS = {
    "mid": ("common.mid", "string"),
    "is_new": ("common.is_new", "string"),
    "ts": ("ts", "bigint"),
    "last_page_id": ("page.last_page_id", "string"),
}

# Fixed value: what JSON allows around a value.
JSON_SPACE = " \t\r\n"

# A noncharacter of Unicode, which no text holds, marks numbers that travel as strings; the others are control characters
# that JSON does not allow in text.
NUMBER_MARK = "\ufdd0"
OPENS, CLOSES = "\u0001", "\u0002"
STRING_OR_NUMBER = r'("[^"\\]*+(?:\\.[^"\\]*+)*+")|(-?(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?(?:[eE][+-]?[0-9]++)?)'


def parse_text(value: Column | str) -> Column:
    """Text to a one-element ``VARIANT`` array, NULL unless it is a JSON object.

    White space around it is allowed. The brackets make the parser see what
    follows the first value, which it would otherwise ignore. Repeated keys need
    ``spark.sql.variant.allowDuplicateKeys``; the last one wins.
    """
    value = F.col(value) if isinstance(value, str) else value
    body = F.btrim(value, F.lit(JSON_SPACE))
    shaped = body.startswith("{") & body.endswith("}")
    return F.when(shaped, F.try_parse_json(F.concat(F.lit("["), body, F.lit("]"))))


def parse_records(
    df: DataFrame,
    value: str = "value",
    record: str = "record",
    fields: dict[str, tuple[str, str]] | None = None,
) -> DataFrame:
    """PRJ1: add ``record VARIANT`` and typed ``fields`` read from it.

    NULL marks text that is not exactly one JSON object. The one-element
    ``explode`` steps are barriers: a filter on a parsed field would otherwise
    move below the projection and parse every row a second time.
    """
    parsed = df.withColumn("_parsed", F.explode(F.array(parse_text(value))))
    alone = F.try_variant_get("_parsed", "$[1]", "variant").isNull()
    first = F.when(alone, F.try_variant_get("_parsed", "$[0]", "variant"))
    read = [F.try_variant_get(record, f"$.{path}", dtype).alias(c) for c, (path, dtype) in (fields or {}).items()]
    return parsed.withColumn(record, F.explode(F.array(first))).select(*df.columns, record, *read)


def mark_numbers(value: Column) -> Column:
    """JSON text with every number as a marked string, so that parsing keeps its digits as they are written."""
    split = F.regexp_replace(value, STRING_OR_NUMBER, f"$1{OPENS}$2{CLOSES}")
    numbers = F.replace(split, F.lit(OPENS + CLOSES), F.lit(""))
    marked = F.replace(F.replace(numbers, F.lit(OPENS), F.lit(f'"{NUMBER_MARK}')), F.lit(CLOSES), F.lit(f'{NUMBER_MARK}"'))
    return F.when(value.contains(OPENS) | value.contains(CLOSES), value).otherwise(marked)


def unmark_numbers(text: Column) -> Column:
    """Undo :func:`mark_numbers`: in nested JSON text the quotes go too."""
    for mark in (f'"{NUMBER_MARK}', f'{NUMBER_MARK}"', NUMBER_MARK):
        text = F.replace(text, F.lit(mark), F.lit(""))
    return text


def is_instant(ts: str) -> Column:
    """Whether an epoch-millisecond value is present and within the range of timestamps."""
    return F.coalesce(F.col(ts).between(-MAX_MS, MAX_MS), F.lit(False))


def log_records(df: DataFrame, value: str = "value") -> DataFrame:
    """PRJ1/PRJ2: parse log lines into ``record, mid, is_new, ts, last_page_id, is_dirty``.

    A row is dirty when it does not parse or lacks the device, the new-visitor
    flag or the time. Its raw text stays in ``value`` and ``mid`` is NULL, so
    the keyed operators leave it alone; a time out of range is NULL as well.
    """
    parsed = parse_records(df, value, "record", LOG_FIELDS)
    parsed = parsed.withColumn("ts", F.when(is_instant("ts"), F.col("ts")))
    dirty = F.col("mid").isNull() | F.col("is_new").isNull() | F.col("ts").isNull()
    return parsed.withColumn("is_dirty", dirty).withColumn("mid", F.when(~F.col("is_dirty"), F.col("mid")))


def split_dirty(df: DataFrame, dirty: Column | str = "is_dirty") -> tuple[DataFrame, DataFrame]:
    """PRJ2: (clean rows, dirty rows)."""
    dirty = F.coalesce(F.col(dirty) if isinstance(dirty, str) else dirty, F.lit(True))
    return df.where(~dirty), df.where(dirty)


def to_text(record: Column | str) -> Column:
    """PRJ9: record, struct or map to JSON text."""
    return F.to_json(F.col(record) if isinstance(record, str) else record)
