"""Plan shape: built-in expressions only, pruned scans, bounded broadcasts."""

import pytest

from quayside import registry

SMALL = "/root/testdata/sf0.001"
# these run jobs while they are built: they write batches or the narrow rows of a running sum, count
# the bits of percentiles, or plan chunks from key statistics
EAGER = {"cdc_index_state", "snapshot_chunks_planned", "snapshot_chunks_uneven", "bulk_batches", "roll_by_size", "latency_summary",
         "cdc_incremental_snapshot", "cdc_chunk_rows", "cdc_index_compacted", "cdc_keyed_stream",
         "neighbours_stored", "graph_edges_stored"}


@pytest.fixture(scope="module")
def plans(spark):
    out = {}
    for name, fn in registry.QUERIES.items():
        out[name] = fn(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    return out


def test_no_row_at_a_time_python(plans):
    for name, plan in plans.items():
        for node in ("BatchEvalPython", "ArrowEvalPython", "MapInArrow", "MapInPandas", "FlatMapGroups"):
            assert node not in plan, (name, node)


def test_no_round_robin_and_no_single_partition_rows(plans):
    for name, plan in plans.items():
        assert "RoundRobinPartitioning" not in plan, name
        # what meets in one task are partial aggregates, or the bucket rows of a running sum or percentile
        for line in plan.splitlines():
            assert "LocalLimit" not in line or name == "peek_first_records", (name, line)


def test_building_a_query_starts_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    for name, fn in registry.QUERIES.items():
        if name in EAGER:
            continue
        spark.sparkContext.setJobGroup(f"build-{name}", name)
        fn(spark, SMALL)
        assert not list(tracker.getJobIdsForGroup(f"build-{name}")), name
    spark.sparkContext.setJobGroup("tests", "tests")


def test_public_ids_reach_the_scan(plans):
    for name in ("neighbours_fast", "neighbours_union_form", "graph_vertex_by_id"):
        assert "In(user_id, [1,2,3,4,5])" in plans[name], name
    for name in ("neighbours_medium", "neighbours_slow"):
        assert "In(o_custkey, [1,2,3,4,5])" in plans[name], name


def test_out_joins_each_table_once(plans):
    plan = plans["graph_out_values"]
    assert plan.count("Join") == 2 and plan.count("orders.parquet") == 2


def test_scans_are_pruned(plans):
    # lake rows read only the two columns they need from events
    assert "ReadSchema: struct<ts:timestamp_ntz,props:string>" in plans["lake_rows"]
    # the start position reaches Parquet as a pushed filter
    assert "GreaterThanOrEqual(ts,2024-01-15T00:00)" in plans["start_at_timestamp"]


def test_peek_is_top_n(plans):
    assert "TakeOrderedAndProject" in plans["peek_first_records"]


def test_latest_image_is_partial_aggregate(plans):
    plan = plans["cdc_latest_image"]
    assert "Window" not in plan and "max_by" in plan and "partial_max_by" in plan


def test_no_unpartitioned_window_over_rows(plans):
    """A window without PARTITION BY runs in one task; the only ones allowed are over one row per
    bucket: offsets of a running sum, and the counts that bracket percentiles."""
    import re
    for name, plan in plans.items():
        for spec in re.findall(r"windowspecdefinition\(([^,]*)", plan):
            if " ASC" in spec or " DESC" in spec:      # first argument is an ordering: no partition keys
                assert spec.startswith(("_qs_bucket", "_qs_b")), (name, spec)


def test_percentiles_need_no_order(plans):
    assert "Window" not in plans["latency_summary"] and "Sort" not in plans["latency_summary"]


def test_running_sums_read_their_input_once(plans):
    for name, table in (("bulk_batches", "lineitem"), ("roll_by_size", "events"), ("snapshot_chunks_uneven", "lineitem")):
        assert f"{table}.parquet" not in plans[name], name  # only the narrow rows that were written


def test_bounds_on_edge_values_need_no_join(plans):
    for name in ("neighbours_fast", "neighbours_union_form"):
        assert "Join" not in plans[name] and "Exchange" not in plans[name], name


def test_stored_edges_prune_labels_and_join_without_shuffle(spark):
    plan = registry.QUERIES["neighbours_stored"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "label" in filters and "view" in filters and "In(src, [1,2,3,4,5])" in plan
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = registry.QUERIES["graph_edges_stored"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "in_nation" in plan.split("PartitionFilters: [")[1].split("]")[0]
