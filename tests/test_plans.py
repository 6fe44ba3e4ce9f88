"""Plan guards over every registered query: the physical plan has no Cartesian product, no
Python UDF evaluation and no per-group list collection; nested-loop joins appear only
against the literal year-range table (a handful of rows)."""

import pytest

from tests.conftest import SF_SMALL
from vantage.plans.catalog import load_all

Q, _ = load_all()
FORBIDDEN = ("CartesianProduct", "BatchEvalPython", "ArrowEvalPython", "collect_list", "collect_set")
STREAMING = {"stream_capture", "stream_dedup", "stream_tumbling", "stream_capture_counts", "stream_redelivery"}


@pytest.mark.parametrize("key", sorted(k for k in Q if k not in STREAMING))
def test_plan_guards(spark, key):
    plan = Q[key](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    for bad in FORBIDDEN:
        assert bad not in plan, f"{key}: {bad}"
    if "BroadcastNestedLoopJoin" in plan:
        assert key == "age_examples", key


def test_scan_is_pruned_and_topk_is_map_side(spark):
    plan = Q["unique_aircraft"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<user_id:bigint>" in plan
    plan = Q["category_top_flights"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    plan = Q["top_flights"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_enriched_reports_reduce_before_the_registry_join(spark):
    import re
    for key in ("age_by_decade", "category_summary", "size_distribution", "age_by_type"):
        plan = Q[key](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        join = re.search(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin) \[hex", plan)
        assert join, key
        below = plan[join.start():]
        assert re.search(r"HashAggregate\(keys=\[hex#\d+\], functions=\[partial_count\(1\)\]", below), key


def test_paths_shuffle_points_once_without_broadcast(spark):
    """With broadcasting off, as for large inputs: points move by (hex, flight, bucket) only, so no
    aircraft or flight is one task."""
    import re
    from vantage.operators import paths as PA
    from vantage.sources import fixtures as fx
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "-1")
        for build in (PA.flight_paths, PA.path_segments, PA.path_features):
            plan = build(fx.obs(spark, SF_SMALL))._jdf.queryExecution().executedPlan().toString()
            assert "Broadcast" not in plan
            ordered = [x for x in plan.split("\n") if "Window [" in x and "pt#" in x]
            assert ordered and all(re.search(r"windowspecdefinition\(hex#\d+, flight#\d+, bucket", x) for x in ordered)
            moved = [x for x in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)]
            assert sum("bucket" not in x for x in moved) == 1       # the table of buckets, by path
        for build in (PA.path_endpoints, PA.path_altitude, PA.path_totals):
            plan = build(fx.obs(spark, SF_SMALL))._jdf.queryExecution().executedPlan().toString()
            assert "Join" not in plan and plan.count("Scan parquet") == 1 and "partial_" in plan
    finally:
        spark.conf.set(key, before)


def test_reports_scan_and_deduplicate_once(spark):
    for key in ("dedup_counts", "weekly_rollup", "backfill_weeks", "week_members"):
        plan = Q[key](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Scan parquet") <= (2 if key == "week_members" else 1), key
        assert plan.count("Window [row_number()") <= 1, key


def test_medical_activity_reduces_before_the_registry(spark):
    plan = Q["medical_activity"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Join"):]
    assert "partial_min(observation_time" in below and "partial_min(observation_time" not in plan[:plan.index("Join")]


def _unhinted(spark, build):
    """The plan without broadcasts that nobody asked for, as for large inputs."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "-1")
        return build()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, before)


def test_keyed_append_leaves_the_target_where_it_lies(spark):
    for key in ("keyed_append", "keyed_append_stats"):
        for plan in (Q[key](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString(),
                     _unhinted(spark, lambda key=key: Q[key](spark, SF_SMALL))):
            target = plan[plan.index("LeftAnti"):]
            target = target[target.rindex("+- Sort"):]
            assert "Bucketed: true" in target and "key_period" in target.split("PartitionFilters: [")[1].split("]")[0]
            assert "Exchange" not in target and plan.count("Exchange") == 1, key


def test_metadata_answers_without_reading_rows(spark):
    plan = Q["level_metadata"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), MIN(observation_epoch), MAX(observation_epoch)]" in plan
    assert "PushedGroupBy: [capture_date]" in plan


def test_sketches_are_merged_not_rescanned(spark):
    import re
    from vantage.operators import sketches as SK
    from vantage.sources import fixtures as fx
    from vantage.plans.keys_levels import daily
    from vantage.session import staged
    stored = staged(SK.level_sketches(daily(spark, SF_SMALL)), "sketches")
    plan = SK.weekly_summary(stored)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1 and "hex" not in re.findall(r"ReadSchema: (.*)", plan)[0]
    assert fx.obs(spark, SF_SMALL).count() > stored.count()


def test_fleet_and_daily_level_are_worked_out_once(spark):
    plan = _unhinted(spark, lambda: Q["medical_paths"](spark, SF_SMALL))
    assert plan.count("Scan parquet") <= 5 and plan.count("Exchange hashpartitioning") <= 12, plan.count("Scan parquet")
    plan = _unhinted(spark, lambda: Q["pipeline_status"](spark, SF_SMALL))
    assert plan.count("events.parquet") <= 2 * 3 and plan.count("Window [") <= 2
