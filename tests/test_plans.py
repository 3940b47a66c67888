"""Plans that must keep their shape at any size."""

import pytest
from plans_of import plan_of

from cellferry import registry

registry.load_all()
QUERIES = registry.QUERIES

# one row, or one row per partition, meets in one place
ONE_ROW = {
    "greatest_cursor_row", "exported_keys", "source_row_counts", "configured_exports", "sink_misfits", "sink_overflows", "first_ten",
    "ordered_keys", "sorted_layout_keys",
}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"split_points_of_sample", "split_points_by_bytes"}))
def test_no_python_and_no_single_task_steps(spark, small, name):
    plan = plan_of(QUERIES[name](spark, small))
    for node in ("Python", "InPandas", "CartesianProduct", "NestedLoopJoin"):
        assert node not in plan
    if name not in ONE_ROW:
        assert "SinglePartition" not in plan


def test_the_flagship_prunes_pushes_down_and_shuffles_once(spark, small):
    plan = plan_of(QUERIES["export_window"](spark, small))
    assert plan.count("Exchange") == 1
    assert "GreaterThanOrEqual(ts,2024-01-05T00:00)" in plan and "LessThan(ts,2024-01-12T00:00)" in plan
    assert "props" not in plan.split("ReadSchema")[1]
    assert plan.index("Exchange") < plan.index("WindowGroupLimit", plan.index("Exchange"))


@pytest.mark.parametrize(
    "name, pushed",
    [
        ("window_from", "GreaterThanOrEqual(ts,2024-01-12T00:00)"),
        ("window_after", "GreaterThan(o_orderdate,1997-05-28T00:00)"),
        ("key_range_scan", "GreaterThanOrEqual(ts,2024-01-05T00:00)"),
        ("control_rows", "EqualTo(c_mktsegment,MACHINERY)"),
        ("append_batch", "GreaterThan(o_orderdate,1998-10-03T00:00)"),
    ],
)
def test_filters_reach_the_scan(spark, small, name, pushed):
    assert pushed in plan_of(QUERIES[name](spark, small))


@pytest.mark.parametrize(
    "name, shuffles",
    [
        ("export_full", 1), ("latest_lineitem", 1), ("cells_to_records", 1), ("cells_upserted", 1), ("records_upserted", 1),
        ("order_cells", 0), ("table_standardised", 0), ("ids_upgraded", 0), ("range_identifiers", 1), ("run_log_state", 1),
        ("key_sample", 1), ("distinct_whole_records", 1), ("cells_per_key", 2), ("buckets_general", 2), ("sorted_order_cells", 2),
    ],
)
def test_number_of_shuffles(spark, small, name, shuffles):
    plan = plan_of(QUERIES[name](spark, small))
    assert plan.count("Exchange ") == shuffles, plan


def test_each_table_is_scanned_once_for_identifiers(spark, small):
    plan = plan_of(QUERIES["range_identifiers"](spark, small))
    assert plan.count("FileScan") == 3 and plan.count("PushedFilters: []") == 0
