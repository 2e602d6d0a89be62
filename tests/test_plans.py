"""Physical-plan properties that matter at scale."""

import re

import pytest

from conftest import SF001
from listenlab.operators import exports, stage as st
from listenlab.plans.registry import QUERIES
from listenlab.sources import load_fixture, read_interactions

FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin",
             "FlatMapGroupsInPandas", "MapInPandas")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_udf_or_cartesian(spark, name):
    plan = _plan(QUERIES[name](spark, SF001))
    # the CSV text of floats is the one thing that no built-in function makes
    allowed = {"ArrowEvalPython"} if name.startswith("csv_") else set()
    for node in set(FORBIDDEN) - allowed:
        assert node not in plan, (name, node)


def test_session_window_is_split_and_fed_by_one_exchange(spark, tmp_path):
    load_fixture(spark, SF001).write.parquet(str(tmp_path / "src"))
    plan = _plan(st.stage_events(read_interactions(spark, str(tmp_path / "src"))))
    # the event-grain window is partitioned by user and time slice
    assert re.search(r"Window \[lag\(timestamp#\d+L?, -1, null\) windowspecdefinition\(uid#\d+L?, _slice", plan)
    # one exchange of event rows (after the union with the carry-over rows),
    # two small ones on the per-slice aggregate
    assert plan.count("Exchange hashpartitioning(") == 3
    # the carry-over branch reads two columns only
    assert "ReadSchema: struct<uid:bigint,timestamp:bigint>" in \
        st.stage_events(read_interactions(spark, str(tmp_path / "src")))._jdf.queryExecution() \
        .executedPlan().treeString()


def test_reliable_filter_reaches_the_scan(spark, tmp_path):
    from listenlab.plans.registry import Marts

    Marts(spark, SF001).track.write.parquet(str(tmp_path / "track"))
    t = spark.read.parquet(str(tmp_path / "track"))
    tree = exports.export_track_quality(t)._jdf.queryExecution().executedPlan().treeString()
    assert "PushedFilters: [IsNotNull(is_reliable_sample), EqualTo(is_reliable_sample,true)]" in tree


def test_retention_is_one_pass_without_join(spark, tmp_path):
    from listenlab.operators import retention

    load_fixture(spark, SF001).write.parquet(str(tmp_path / "src"))
    st.stage_events(read_interactions(spark, str(tmp_path / "src"))).write.parquet(str(tmp_path / "stage"))
    plan = _plan(retention.retention_cohort(spark.read.parquet(str(tmp_path / "stage"))))
    assert "Join" not in plan
    assert plan.count("Window [") == 3     # per-user cohort lookup + per-cohort gap fill
