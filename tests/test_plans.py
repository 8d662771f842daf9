"""Plan-shape checks: the physical strategies the operators rely on."""

import __spark_entry__ as E
from conftest import SMALL

Q = E.queries()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString() + df._jdf.queryExecution().optimizedPlan().toString()


def explain(df):
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_topn_uses_window_group_limit(spark):
    assert "WindowGroupLimit" in explain(Q["topn_per_group"](spark, SMALL))


def test_dimension_join_is_broadcast(spark):
    assert "BroadcastHashJoin" in explain(Q["join_broadcast_dim"](spark, SMALL))


def test_filters_and_pruning_reach_scan(spark):
    text = explain(Q["filter_compare"](spark, SMALL))
    assert "PushedFilters: [IsNotNull(c_acctbal), GreaterThan(c_acctbal,9000.0)]" in text
    text = explain(Q["agg_avg"](spark, SMALL))
    assert "ReadSchema: struct<l_orderkey:bigint,l_shipdate:timestamp_ntz>" in text


def test_no_row_at_a_time_python(spark):
    for key in ("cleaned_trips", "dashboard_panels", "violin_density", "win_row_number"):
        text = explain(Q[key](spark, SMALL))
        assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text


def test_queries_without_order_columns_still_read_orders(spark):
    assert "orders.parquet" in explain(Q["agg_count"](spark, SMALL))


def test_building_a_query_starts_no_job(spark):
    """Operators are lazy.  Queries that write by nature (CSV scan, saved table,
    the cleaning flow's de-duplicated table) are not in the list."""
    tracker, group = spark.sparkContext.statusTracker(), "build"
    for key in ("win_row_number", "win_rank", "win_lag", "win_ntile", "box_stats", "box_stats_topk", "mean_vs_median",
                "iqr_bounds", "win_partition_avg", "violin_density", "profile_describe"):
        spark.sparkContext.setJobGroup(f"{group}-{key}", key)
        Q[key](spark, SMALL)
        assert not [j for j in tracker.getJobIdsForGroup(f"{group}-{key}")
                    if not _listing(spark, j)], key
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def _listing(spark, job):
    """Schema reads of the given files are no work of the operators."""
    info = spark.sparkContext.statusTracker().getJobInfo(job)
    stages = [spark.sparkContext.statusTracker().getStageInfo(s) for s in (info.stageIds if info else [])]
    return all(s is None or s.name.startswith(("parquet", "load")) for s in stages)
