from datetime import datetime

import pytest
from pyspark.sql import functions as F

import gatelens as g
from gatelens.functions.documents import health_steps
from gatelens.functions.time import to_millis
from gatelens.operators import health
from gatelens.schemas import table_schema

NOW = to_millis(datetime(2024, 3, 31, 12))
MINUTE, HOUR, DAY = 60_000, 3_600_000, 86_400_000


def checks(spark, *rows):
    """Rows are (age, endpoint, available, response time)."""
    schema = "id string, ms bigint, api string, gateway string, endpoint string, available boolean, response_time int"
    data = [(f"h{i}", NOW - age, "a", "gw", endpoint, up, rt) for i, (age, endpoint, up, rt) in enumerate(rows)]
    return spark.createDataFrame(data, schema).withColumn("ts", F.timestamp_millis("ms")).drop("ms")


def by_range(frame, value):
    found = {}
    for row in frame.collect():
        found.setdefault(row.key, {})[row.range] = row[value]
    return found


def test_availability_windows(spark):
    docs = checks(
        spark,
        (30_000, "x", True, 10),
        (30 * MINUTE, "x", False, 10),
        (5 * HOUR, "x", True, 10),
        (3 * DAY, "x", None, 10),
        (MINUTE, "y", False, 10),
        (-5 * MINUTE, "y", True, 10),  # later than now: windows have no end
        (31 * DAY + 5 * HOUR, "z", True, 10),  # on the first day read, before the month began
    )
    got = by_range(g.availability(docs, "a", now=NOW), "percent")
    assert got["x"] == {"1m": 100.0, "1h": 50.0, "1d": pytest.approx(200 / 3), "1w": pytest.approx(200 / 3), "1M": pytest.approx(200 / 3)}
    assert got["y"] == dict.fromkeys(("1m", "1h", "1d", "1w", "1M"), 50.0)
    assert got["z"] == dict.fromkeys(("1m", "1h", "1d", "1w", "1M"), 100.0)


def test_only_the_top_terms(spark):
    docs = checks(spark, *[(MINUTE, f"e{i:02}", True, i) for i in range(12)], (MINUTE, "e11", False, 1))
    ranks = {row.key: row["rank"] for row in g.availability(docs, "a", now=NOW).collect()}
    assert ranks == {"e11": 1, **{f"e{i:02}": i + 2 for i in range(9)}}
    # e00 is chosen before it is found to be all zero, and no other takes its place.
    kept = {row.key for row in g.average_response_time(docs, "a", now=NOW).collect()}
    assert kept == {"e11", *[f"e{i:02}" for i in range(1, 9)]}


def test_average_response_time(spark):
    docs = checks(spark, (30_000, "x", True, 10), (2 * HOUR, "x", True, 15), (2 * DAY, "y", True, 0))
    got = by_range(g.average_response_time(docs, "a", now=NOW), "value")
    assert got == {"x": {"1m": 10, "1h": 10, "1d": 12, "1w": 12, "1M": 12}}


def test_field_names(spark):
    docs = checks(spark, (30_000, "x", True, 10))
    assert {row.key for row in g.availability(docs, "a", "GATEWAY", now=NOW).collect()} == {"gw"}
    assert g.availability(docs, "b", now=NOW).count() == 0
    with pytest.raises(ValueError):
        g.availability(docs, "a", "id", now=NOW)


def dense(docs, bounds, *aggregations):
    frame = health.health_histogram_dense(docs, bounds, HOUR, aggregations, api="a", now=NOW)
    return [((row.timestamp - NOW) // HOUR, *row[1:]) for row in frame.orderBy("timestamp").collect()]


def test_axis_reaches_over_data_and_bounds(spark):
    docs = checks(spark, (5 * HOUR, "x", True, 10), (2 * HOUR, "x", False, 21), (2 * HOUR, "x", True, 10))
    bounds = g.TimeRange(NOW - 3 * HOUR, NOW)
    got = dense(docs, bounds, g.avg("response-time"), g.terms("available"), g.maximum("response-time"))
    assert got == [
        (-5, 1, 10.0, 100.0, 10.0),
        (-4, 0, None, None, None),
        (-3, 0, None, None, None),
        (-2, 2, 15.0, 50.0, 21.0),
        (-1, 0, None, None, None),
        (0, 0, None, None, None),
    ]


def test_axis_without_data_is_the_bounds(spark):
    assert dense(checks(spark, (HOUR, "x", True, 1)).where("false"), g.TimeRange(NOW - HOUR, NOW)) == [(-1, 0), (0, 0)]


def test_response(spark):
    docs = checks(spark, (2 * HOUR, "x", True, 10), (HOUR, "x", False, 30), (HOUR, "x", True, None))
    wanted = [g.terms("available"), g.avg("response-time"), g.avg("id_that_is_null")]
    docs = docs.withColumn("id_that_is_null", F.lit(None).cast("int"))
    bounds = g.TimeRange(NOW - 2 * HOUR, NOW)
    frame = health.health_histogram_dense(docs, bounds, HOUR, wanted, api="a", now=NOW)
    row = g.assemble_dense(frame, wanted).first()
    assert row.timestamps == [NOW - 2 * HOUR, NOW - HOUR, NOW]
    up, time, nothing = row["values"]
    assert (up.name, up.field, nothing) == ("by_available", "available", None)
    assert [tuple(p) for p in up.data["by_available"]] == [(NOW - 2 * HOUR, 100.0), (NOW - HOUR, 50.0)]
    assert [tuple(p) for p in time.data["avg_response-time"]] == [(NOW - 2 * HOUR, 10.0), (NOW - HOUR, 30.0)]
    empty = g.assemble_dense(health.health_histogram_dense(docs, bounds, HOUR, now=NOW), []).first()
    assert (len(empty.timestamps), empty["values"]) == (3, [])


def test_terms_that_are_not_true_are_failures(spark):
    docs = checks(spark, (HOUR, "true", None, 1), (HOUR, "x", None, 1), (0, "x", None, 1))
    numbers = docs.withColumn("available", F.when(F.col("endpoint") == "x", 0).otherwise(1))
    bounds = g.TimeRange(NOW - HOUR, NOW)
    wanted = g.terms("available"), g.terms("endpoint")
    assert dense(numbers, bounds, *wanted) == [(-1, 2, 50.0, 50.0), (0, 1, 0.0, 0.0)]
    assert dense(docs, bounds, g.terms("available")) == [(-1, 2, None), (0, 1, None)]


def test_points(spark):
    docs = checks(spark, (2 * HOUR, "x", False, 21))
    wanted = [g.terms("available"), g.minimum("response-time")]
    points = g.health_histogram(docs, g.TimeRange(NOW - DAY, NOW), HOUR, wanted, api="a", now=NOW)
    assert sorted((p.ordinal, p.key, p.value) for p in points.collect()) == [
        (0, "by_available", 0.0),
        (1, "min_response-time", 21.0),
    ]
    assert g.health_histogram(docs, g.TimeRange(0, 1), HOUR, [], now=NOW).count() == 0


def full_checks(spark, *rows):
    schema = table_schema("health")
    return spark.createDataFrame([tuple(row.get(name) for name in schema.fieldNames()) for row in rows], schema)


def stored(number, steps):
    return {
        "id": f"h{number}", "ts": datetime(2024, 3, 31, 10, number), "api": "a", "gateway": "gw", "endpoint": "x",
        "response_time": 5, "available": True, "success": True, "state": 2, "steps": steps, "day": "2024.03.31",
    }


def test_logs_and_steps(spark):
    headers = {"X": ["1", "2"]}
    new = (True, None, ("/new", "GET", "b", headers), (201, "r", headers), None, None, None)
    old = (False, "late", None, None, "/old", "post", 503)
    docs = full_checks(spark, stored(0, [new, old]), stored(1, [old]), stored(2, []), stored(3, None))
    logs = g.health_logs(docs, "a", page=1, size=3, now=NOW).collect()
    assert [(r.id, r.uri, r.method, r.status, r.total) for r in logs] == [
        ("h3", None, None, None, 4),
        ("h2", None, None, None, 4),
        ("h1", "/old", "POST", 503, 4),
    ]
    assert [r.id for r in g.health_logs(docs, "a", page=2, size=3, now=NOW).collect()] == ["h0"]
    steps = docs.where("id = 'h0'").select(health_steps().alias("steps")).first().steps
    assert steps[0].request.headers == headers and steps[0].response.status == 201 and steps[0].message is None
    assert (steps[1].request.uri, steps[1].request.method, steps[1].response.status) == ("/old", "POST", 503)
    found = {r.id: r.steps for r in g.find_health(docs, ["h1", "h3"], strict=True).collect()}
    assert len(found["h1"]) == 1 and found["h3"] is None
    with pytest.raises(Exception, match="no health check has the id h9"):
        g.find_health(docs, ["h1", "h9"], strict=True).collect()


def test_hourly_successes_over_two_days(spark):
    # Bucket positions and their numbers of successful checks.
    successes = {17: 5, 39: 1, 40: 1, 41: 3}
    start = NOW - 48 * HOUR
    rows = [(48 * HOUR - at * HOUR - 7 * MINUTE, "x", True, 1) for at, n in successes.items() for _ in range(n)]
    docs = checks(spark, *rows, (3 * HOUR, "x", False, 1))
    frame = health.health_histogram_dense(docs, g.TimeRange(start, NOW), HOUR, api="a", query="available:true", now=NOW)
    counts = [row["count"] for row in frame.orderBy("timestamp").collect()]
    assert counts == [successes.get(at, 0) for at in range(49)]
