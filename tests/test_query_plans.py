"""What the plans of the registered queries must and must not contain."""

import re

import pytest

from layerforge.workload import queries as entry_points

FORBIDDEN = (
    "CartesianProduct",
    "BroadcastNestedLoopJoin",
    "BatchEvalPython",
    "ArrowEvalPython",
    "PythonUDF",
    "MapInPandas",
    "RoundRobinPartitioning",
)


def lines(df):
    return df._jdf.queryExecution().executedPlan().toString().splitlines()


@pytest.mark.parametrize("name", sorted(entry_points.queries()))
def test_no_crossing_no_python_no_single_task(name, spark, sf_dir):
    plan = lines(entry_points.queries()[name](spark, sf_dir))
    for word in FORBIDDEN:
        assert not any(word in line for line in plan)
    for line, below in zip(plan, plan[1:]):
        # Everything meets in one task only after partial aggregation; the counts of the registry's buckets are a few rows.
        if "Exchange SinglePartition" in line:
            assert "functions=[partial_" in below or "keys=[__bucket" in below


@pytest.mark.parametrize(
    "name, shuffles",
    [
        ("silver_products", 1),
        ("silver_users", 1),
        # Keys are computed where the row is: one window by id, no join.
        ("dim_product", 1),
        ("dim_user", 1),
        ("dim_user_null_safe", 1),
        ("user_directory", 1),
        ("dedup_latest", 1),
        ("bronze_one_per_id", 1),
        ("fact_product_metrics_daily", 2),
        ("latest_dt_per_product", 1),
        ("json_line_validation", 1),
        ("category_taxonomy_map", 0),
        ("text_normalise", 0),
        ("ndjson_lines", 0),
    ],
)
def test_number_of_shuffles(name, shuffles, spark, sf_dir):
    plan = lines(entry_points.queries()[name](spark, sf_dir))
    assert sum("Exchange hashpartitioning" in line for line in plan) == shuffles


@pytest.mark.parametrize(
    "name, columns",
    [
        ("global_rating_mean", {"l_linenumber", "l_discount", "l_shipdate"}),
        ("latest_dt_per_product", {"l_partkey", "l_linenumber", "l_shipdate"}),
        ("phone_clean", {"c_custkey", "c_nationkey", "n_nationkey"}),
        ("dim_category", {"p_partkey", "p_type"}),
        # The rows are dealt into ranges and written first.
        ("raw_chunk_assignment", {"batch", "o_orderkey", "__row"}),
    ],
)
def test_scans_read_only_what_is_needed(name, columns, spark, sf_dir):
    plan = lines(entry_points.queries()[name](spark, sf_dir))
    read = set()
    for line in plan:
        found = re.search(r"FileScan parquet \[([^\]]*)\]", line)
        if found:
            read |= {c.split("#")[0] for c in found.group(1).split(",") if c}
    assert read == columns


def test_facts_close_days_without_sorting_them(spark, sf_dir):
    plan = lines(entry_points.queries()["fact_product_metrics_daily"](spark, sf_dir))
    assert not any("SortAggregate" in line for line in plan)
