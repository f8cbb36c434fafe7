"""The physical plans keep the shape that large inputs need."""

import re

import pytest
from pyspark.sql import functions as F

from tidemark.functions.paths import is_blank
from tidemark.operators.changelog import latest_per_key
from tidemark.operators.records import log_records
from tidemark.operators.split import route_channels
from tidemark.operators.visits import first_entry_per_day, first_visit_dates, repair_first_visit
from tidemark.operators.patterns import match_next
from tidemark.plans import inputs, queries


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(plan):
    return re.findall(r"Exchange (\w+)", plan)


def test_repair_does_not_shuffle_the_log(spark, sf_dir):
    plan = plan_of(repair_first_visit(inputs.log_view(spark, sf_dir)))
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_first_visit_dates_is_one_combined_hash_aggregate(spark, sf_dir):
    plan = plan_of(first_visit_dates(inputs.log_view(spark, sf_dir)))
    assert plan.count("HashAggregate") == 2 and "SortAggregate" not in plan
    assert exchanges(plan) == ["hashpartitioning"]


def test_uv_keys_are_split_and_columns_pruned(spark, sf_dir):
    plan = plan_of(queries.daily_uv(spark, sf_dir))
    assert re.search(r"hashpartitioning\(mid#\d+L, _chunk#\d+L", plan)
    assert "partial_count" in plan
    assert "value" not in plan and "SinglePartition" not in plan


def test_jump_out_is_one_exchange_on_key_and_bucket(spark, sf_dir):
    entry = is_blank("last_page_id")
    plan = plan_of(match_next(inputs.log_view(spark, sf_dir), entry, entry, columns=["seq"]))
    assert exchanges(plan) == ["hashpartitioning"]
    assert re.search(r"hashpartitioning\(mid#\d+L, _bucket#\d+L", plan)


def test_latest_row_is_limited_before_the_shuffle(spark, sf_dir):
    plan = plan_of(latest_per_key(inputs.table(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderkey"]))
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_config_join_is_broadcast(spark, sf_dir):
    for query in (queries.config_join, queries.dimension_routing, queries.dimension_routing_asof):
        assert "BroadcastHashJoin" in plan_of(query(spark, sf_dir))


def test_routing_parses_once_without_shuffle(spark):
    raw = spark.createDataFrame([(1, "{}")], "seq bigint, value string")
    routed = route_channels(log_records(raw))
    plan = plan_of(routed.where(F.col("channel") == "page"))
    assert plan.count("parseJson") == 1 and not exchanges(plan)
    assert "StructsToJson" not in plan_of(routed.select("seq", "channel"))


@pytest.mark.parametrize("group_rows", [1, 1000])
def test_uv_has_no_join_besides_the_hot_key_marks(spark, sf_dir, group_rows):
    """One join marks the rows of hot keys; the other, below it, is with the same keys to find their chunks."""
    plan = plan_of(first_entry_per_day(inputs.log_view(spark, sf_dir), group_rows=group_rows))
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan
