"""The four warehouse jobs as batch plans over raw text (``value``) and an arrival number."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.paths import is_blank, is_missing
from tidemark.functions.time import DISPLAY_ZONE
from tidemark.operators.patterns import JUMP_OUT_MS, match_next
from tidemark.operators.records import is_instant, log_records, parse_records
from tidemark.operators.routing import (
    change_records,
    config_changes,
    current_config,
    from_database,
    judged_config,
    prune_data,
    route_as_of,
    route_current,
    without_maintenance,
)
from tidemark.operators.split import route_channels
from tidemark.operators.visits import first_entry_per_day, repair_first_visit


def split_traffic(
    raw: DataFrame,
    order: str = "seq",
    tz: str = DISPLAY_ZONE,
    context: str = "record",
    keep_start_context: bool = False,
) -> DataFrame:
    """Traffic split: parse, repair the new-visitor flag, fan out to channels."""
    repaired = repair_first_visit(log_records(raw), order=order, tz=tz)
    return route_channels(repaired, context, keep_start_context)


LAST_PAGE = "page.last_page_id"
PAGE_COLUMNS = ("mid", "ts", "last_page_id")


def judged_pages(pages: DataFrame, last_page: str = LAST_PAGE) -> DataFrame:
    """Page rows with ``mid, ts, last_page_id, is_dirty``.

    Rows of the page channel have these columns already and are not parsed
    again, unless ``last_page`` names another field than the channel's.
    """
    if last_page == LAST_PAGE and set(PAGE_COLUMNS) <= set(pages.columns):
        parsed = pages
    else:
        fields = {"mid": ("common.mid", "string"), "ts": ("ts", "bigint"), "last_page_id": (last_page, "string")}
        parsed = parse_records(pages.drop(*PAGE_COLUMNS), fields=fields).drop("record")
    return parsed.withColumn("is_dirty", ~F.coalesce(F.col("mid").isNotNull() & is_instant("ts"), F.lit(False)))


def page_records(pages: DataFrame, last_page: str = LAST_PAGE) -> DataFrame:
    """The clean rows of :func:`judged_pages`."""
    return judged_pages(pages, last_page).where(~F.col("is_dirty")).drop("is_dirty")


def rejected_pages(pages: DataFrame, last_page: str = LAST_PAGE) -> DataFrame:
    """The rows that the page jobs leave out, with their raw text."""
    return judged_pages(pages, last_page).where(F.col("is_dirty")).drop("is_dirty", *PAGE_COLUMNS)


def daily_unique_visitors(pages: DataFrame, order: str = "seq", tz: str = DISPLAY_ZONE) -> DataFrame:
    """Daily unique visitor: the page records that open a device's day."""
    return first_entry_per_day(page_records(pages), order=order, entry=is_missing("last_page_id"), tz=tz)


def jump_outs(
    pages: DataFrame,
    order: str = "seq",
    within_ms: int = JUMP_OUT_MS,
    last_page: str = LAST_PAGE,
) -> DataFrame:
    """Jump-out: two entry pages of a device in a row; the jump-out is ``first``."""
    entry = is_blank("last_page_id")
    return match_next(
        page_records(pages, last_page), entry, entry, within_ms, order=order, columns=["value", order, "ts"]
    )


def rejected_changes(changes: DataFrame) -> DataFrame:
    """Change rows that cannot be read, with their raw text."""
    return change_records(changes).where(F.col("is_dirty")).select(*changes.columns)


def rejected_config(config: DataFrame) -> DataFrame:
    """Configuration rows that do not count, with their raw text and the ``problem``."""
    return judged_config(config).where(F.col("problem").isNotNull()).select(*config.columns, "problem")


def route_dimensions(
    changes: DataFrame,
    config: DataFrame,
    database: str,
    order: str = "seq",
    as_of: bool = False,
) -> DataFrame:
    """Dimension routing: configured tables of one database, with only their configured columns.

    Both inputs are raw text; :func:`rejected_changes` and :func:`rejected_config`
    give the rows that are left out as unreadable. ``as_of`` replays the configuration as it was
    when each record arrived instead of using the one in force.
    """
    records = change_records(changes).where(~F.col("is_dirty")).drop("is_dirty", "value")
    wanted = without_maintenance(from_database(records, database))
    versions = config_changes(config)
    if as_of:
        routed = route_as_of(wanted, versions, order=order)
    else:
        routed = route_current(wanted, current_config(versions, order), spread=order)
    return routed.withColumn("data", prune_data())
