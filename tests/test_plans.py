"""The physical plans stay the ones the operators were written for."""

import pytest

from gatelens.plans.queries import QUERIES

DATA = "/root/testdata/sf0.001"


def plan(spark, name):
    frame = QUERIES[name](spark, DATA)
    frame.collect()
    text = frame._jdf.queryExecution().executedPlan().toString()
    return text.partition("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", ["group_terms", "group_terms_avg_desc", "availability_endpoint", "raw_terms"])
def test_top_terms_are_a_top_k(spark, name):
    text = plan(spark, name)
    assert "TakeOrderedAndProject" in text
    assert text.count("FileScan") == 1


@pytest.mark.parametrize("name", ["hist_field", "hist_multi"])
def test_terms_per_bucket_are_limited_before_the_shuffle(spark, name):
    text = plan(spark, name)
    assert "row_number(), 10, Partial" in text
    assert text.count("FileScan") == 1


@pytest.mark.parametrize("name", ["hist_avg", "hist_count", "health_hist_avg", "health_hist_avail", "health_hist_series", "group_ranges_overlap"])
def test_documents_are_read_once(spark, name):
    text = plan(spark, name)
    assert text.count("FileScan") == 1
    assert "partial_" in text
    assert "SortAggregate" not in text


INGESTING = {"bulk_ingest", "stream_ingest", "stream_ingest_many_files", "bulk_ingest_rejects"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - INGESTING))
def test_no_python_and_no_cross_join(spark, name):
    text = QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text and "Pandas" not in text


def test_columns_are_pruned(spark):
    text = plan(spark, "count_root_query")
    assert "props" not in text and "value" not in text


@pytest.mark.parametrize("name", ["scan_named_days", "scan_day_range", "scan_last_month"])
def test_days_reach_the_scan_as_times(spark, name):
    text = plan(spark, name)
    assert "GreaterThanOrEqual(ts" in text.partition("PushedFilters")[2]


@pytest.mark.parametrize("name", ["store_count", "store_group_by", "store_tabular", "store_health_logs", "store_latest", "store_missing_days"])
def test_stored_days_are_pruned(spark, name):
    text = plan(spark, name)
    assert "PartitionFilters: [isnotnull(day" in text or "PartitionFilters: [day" in text


def test_long_axis_is_built_by_many_tasks(spark):
    from datetime import datetime

    import gatelens as g
    from gatelens.operators import health
    from gatelens.schemas import table_schema

    names = table_schema("health").fieldNames()
    stamps = [datetime(2024, 1, 2), datetime(2024, 1, 2, 0, 10), None]
    rows = [tuple({"id": str(n), "ts": ts, "day": "2024.01.02", "api": "a"}.get(c) for c in names) for n, ts in enumerate(stamps)]
    docs = spark.createDataFrame(rows, table_schema("health"))
    span = g.between(datetime(2024, 1, 2), datetime(2024, 1, 2, 0, 1))
    dense = health.health_histogram_dense(docs, span, 1, api="a", now=int(datetime(2024, 1, 3).timestamp() * 1000))
    assert dense.agg({"count": "sum", "timestamp": "count"}).first()[:] == (2, 600_001)
