import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

import gatelens as g
from gatelens.functions.documents import from_document, table_columns
from gatelens.functions.time import to_millis

POOL = {"used_in_bytes": 1, "peak_used_in_bytes": 2, "max_in_bytes": 3, "peak_max_in_bytes": 4}


def sample(stamp, gateway="g1", heap=5550):
    return {
        "@timestamp": stamp,
        "gateway": gateway,
        "hostname": "node-a",
        "os": {
            "cpu": {"percent": 12, "load_average": {"1m": 1.5, "5m": 2.5, "15m": 3.5}},
            "mem": {"used_in_bytes": 70, "free_in_bytes": 30, "total_in_bytes": 100, "used_percent": 70, "free_percent": 30},
        },
        "process": {"timestamp": 1, "open_file_descriptors": 17, "max_file_descriptors": 900},
        "jvm": {
            "timestamp": 1500000000000,
            "uptime_in_millis": 60000,
            "threads": {"count": 6, "peak_count": 7},
            "gc": {
                "collectors": {
                    "young": {"collection_count": 3, "collection_time_in_millis": 33},
                    "old": {"collection_count": 1, "collection_time_in_millis": 44},
                }
            },
            "mem": {
                "heap_committed_in_bytes": 11, "heap_used_percent": 20, "heap_max_in_bytes": 12, "heap_used_in_bytes": heap,
                "non_heap_used_in_bytes": 13, "non_heap_committed_in_bytes": 14,
                "pools": {"young": POOL, "old": POOL, "survivor": POOL},
            },
        },
    }


@pytest.fixture(scope="module")
def docs(spark):
    samples = [
        ("m1", sample("2017-05-22T10:00:00.000Z")),
        ("m2", sample("2017-05-22T11:30:00.500Z", heap=1)),
        ("m3", sample("2017-05-22T11:30:00.500Z")),
        ("m4", sample("2017-05-22T01:00:00.000+02:00", heap=2)),
        ("m5", sample("2017-05-22T09:00:00.000Z", "g2", heap=3)),
        ("m6", sample("2017-05-21T09:00:00.000Z", "g3")),
    ]
    raw = spark.createDataFrame([(i, json.dumps(d)) for i, d in samples], "id string, source string")
    parsed = raw.select("id", from_document("monitor", F.col("source")).alias("document"))
    return parsed.select("id", *table_columns("monitor", "document"))


NOW = to_millis(datetime(2017, 5, 22, 23))


def test_latest_snapshot(docs):
    row = g.latest_snapshot(docs, "g1", NOW).first()
    assert len(row) == 38
    assert (row.gateway_id, row.hostname) == ("g1", "node-a")
    assert row.timestamp == to_millis(datetime(2017, 5, 22, 11, 30, 0, 500000))
    assert row.jvm_heap_used_in_bytes == 5550
    assert row.os_cpu_load_average == {"1m": 1.5, "5m": 2.5, "15m": 3.5}
    assert (row.jvm_gc_collectors_young_collection_count, row.jvm_gc_collectors_young_collection_time_in_millis) == (3, 33)
    assert (row.jvm_gc_collectors_old_collection_count, row.jvm_gc_collectors_old_collection_time_in_millis) == (1, 44)
    assert (row.jvm_process_open_file_descriptors, row.jvm_process_max_file_descriptors) == (17, 900)
    assert (row.os_mem_used_percent, row.os_mem_free_percent, row.os_cpu_percent) == (70, 30, 12)
    assert (row.jvm_mem_pool_old_used_in_bytes, row.jvm_mem_pool_survivor_peak_max_in_bytes) == (1, 4)
    assert (row.jvm_thread_count, row.jvm_thread_peak_count, row.jvm_uptime_in_millis) == (6, 7, 60000)


def test_only_today(docs):
    assert g.latest_snapshot(docs, "g3", NOW).count() == 0
    assert g.latest_snapshot(docs, "g3", NOW - 86_400_000).count() == 1
    assert g.latest_snapshot(docs, "nobody", NOW).count() == 0


def test_every_gateway(docs):
    rows = {r.gateway_id: r.jvm_heap_used_in_bytes for r in g.latest_per_gateway(docs, NOW).collect()}
    assert rows == {"g1": 5550, "g2": 3}
