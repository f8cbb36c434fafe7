"""Fanning a mixed log out into channels (RTE1, PRJ3, PRJ4, PRJ7, PRJ8, PRJ9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.paths import read_array, read_object, read_string

# Channel names and the topics they are published to.
CHANNEL_TOPICS = {
    "page": "dwd_traffic_page_log",
    "err": "dwd_traffic_err_log",
    "start": "dwd_traffic_start_log",
    "action": "dwd_traffic_action_log",
    "display": "dwd_traffic_display_log",
}
DIRTY = "dirty"


def set_is_new(common: Column, is_new: Column) -> Column:
    """PRJ3: the ``common`` object with its new-visitor flag replaced."""
    fields = common.try_cast("map<string,variant>")
    return F.to_variant_object(
        F.transform_values(
            fields, lambda name, field: F.when(name == "is_new", is_new.cast("variant")).otherwise(field)
        )
    )


def _object_text(*members: tuple[str, Column], others: Column | None = None) -> Column:
    """JSON object text from member names and JSON value texts; NULL values are left out."""
    texts = [F.concat(F.lit(f'"{name}":'), text) for name, text in members]
    texts += [] if others is None else [others]
    return F.concat(F.lit("{"), F.concat_ws(",", *texts), F.lit("}"))


def _other_members(record: Column, *left_out: str) -> Column:
    """The record's remaining members as JSON text without the outer braces; NULL if there are none."""
    fields = F.map_filter(record.try_cast("map<string,variant>"), lambda name, _: ~name.isin(*left_out))
    text = F.to_json(fields)
    return F.when(F.length(text) > 2, F.substring(text, F.lit(2), F.length(text) - 2))


def route_channels(
    df: DataFrame,
    context: str = "record",
    keep_start_context: bool = False,
) -> DataFrame:
    """RTE1: one row per output record, with ``channel, position, value``.

    Input is the output of ``log_records`` (after the repair, if any). An error
    record goes whole to ``err`` and nowhere else; a start record gives only
    its ``start`` object; any other record gives one ``page`` row without its
    ``actions`` and ``displays``, and one row per element of those arrays.
    Dirty rows keep their raw text in channel ``dirty``.

    ``context="record"`` gives actions and displays the page and common fields
    of their record, and the record time. ``context="element"`` reads page and
    common from the element and leaves the time out of action rows.
    ``keep_start_context`` adds common and time to start rows.

    The log is read once and not shuffled. Text is written only after the
    channels are known, so a filter on ``channel`` or a plan that ignores
    ``value`` saves that work; page and common fields are written once per
    record and reused for its elements.
    """
    if context not in ("record", "element"):
        raise ValueError("context is 'record' or 'element'")
    record, channel, item = F.col("record"), F.col("channel"), F.col("_item")
    kept = [c for c in df.columns if c not in ("value", "record", "is_dirty")]
    original = [c for c in df.columns if c != "is_dirty"]

    err, start, common = (read_object(record, name) for name in ("err", "start", "common"))
    repaired = F.col("is_new") != read_string(record, "common.is_new")
    channels = (
        F.when(F.col("is_dirty"), F.array(F.lit(DIRTY)))
        .when(err.isNotNull(), F.array(F.lit("err")))
        .when(start.isNotNull(), F.array(F.lit("start")))
        .otherwise(F.array(F.lit("page"), F.lit("action"), F.lit("display")))
    )
    facts = df.withColumns({"_channels": channels, "_repaired": F.coalesce(repaired, F.lit(False))})
    common_text = F.to_json(F.when(F.col("_repaired"), set_is_new(common, F.col("is_new"))).otherwise(common))
    page_text = F.to_json(read_object(record, "page"))
    has_text = F.element_at("_channels", 1) == "page"
    texts = facts.withColumns(
        {
            "_common": F.when(has_text | F.col("_repaired"), common_text),
            "_page": F.when(has_text, page_text),
        }
    )
    # The outer form keeps Spark from adding a "not empty" filter that works the list out twice.
    by_channel = texts.select(*original, "_repaired", "_common", "_page", F.explode_outer("_channels").alias("channel"))
    items = (
        F.when(channel == "action", read_array(record, "actions"))
        .when(channel == "display", read_array(record, "displays"))
        .otherwise(F.array(F.lit(None).cast("variant")))
    )
    rows = by_channel.select("*", F.posexplode(items).alias("position", "_item"))

    ts_text = F.col("ts").cast("string")
    element = {
        name: [("page", F.col("_page")), ("common", F.col("_common"))]
        if context == "record"
        else [(field, F.to_json(read_string(item, field).cast("variant"))) for field in ("page", "common")]
        for name in ("action", "display")
    }
    for name, members in element.items():
        members.append((name, F.to_json(item)))
        if name == "display" or context == "record":
            members.append(("ts", ts_text))
    # Records that nothing changes keep their text, which is cheaper than writing it anew.
    parts = F.coalesce(read_string(record, "actions"), read_string(record, "displays"))
    others = _other_members(record, "common", "page", "actions", "displays")
    main = _object_text(("common", F.col("_common")), ("page", F.col("_page")), others=others)
    whole = _object_text(("common", F.col("_common")), others=_other_members(record, "common"))
    start_object = F.to_json(read_object(record, "start"))
    start_text = (
        _object_text(
            ("common", F.coalesce("_common", F.to_json(common))), ("start", start_object), ("ts", ts_text)
        )
        if keep_start_context
        else start_object
    )
    value = (
        F.when(channel == "action", _object_text(*element["action"]))
        .when(channel == "display", _object_text(*element["display"]))
        .when((channel == "page") & (F.col("_repaired") | parts.isNotNull()), main)
        .when((channel == "err") & F.col("_repaired"), whole)
        .when(channel == "start", start_text)
        .otherwise(F.col("value"))
    )
    return rows.select(*kept, "channel", "position", value.alias("value"))
