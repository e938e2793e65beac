"""Plan guards over every registered query: no Python in the row path, no
cross product, no nested-loop join; column pruning at the scan."""

import pytest

from sensorflow.plans.catalog import QUERIES

from .conftest import SF_SMALL

FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct",
             "BroadcastNestedLoopJoin", "FlatMapGroupsInPandas", "MapInPandas")
# Queries that write files or run a stream first; their plans read those.
SIDE_EFFECTS = {"file_tree_wide", "long_table_wide", "stream_index_documents",
                "stream_routed_predictions", "stream_room_windows",
                "stream_windowed_accuracy", "stream_index_quarantine", "file_tree_salted",
                "stream_index_documents_json", "stream_dedupe", "stream_prediction_messages",
                "fit_and_score", "series_sorted", "stream_wide", "stream_upserts",
                "stream_running_accuracy", "wide_incremental", "rollup_range"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SIDE_EFFECTS))
def test_plan_is_jvm_only(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op}"
    # The events scan never reads the unused ``props`` column.
    assert "props" not in plan
