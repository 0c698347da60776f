import pytest
from pyspark.sql import functions as F

import gatelens as g
from gatelens.functions.predicates import all_of, field_between, matches
from gatelens.operators import analytics, shaping

SCHEMA = "id string, ms bigint, api string, application string, status int, response_time double"
WHOLE = g.TimeRange(0, 99_999)


def requests(spark, *rows):
    docs = spark.createDataFrame([(str(i), *row) for i, row in enumerate(rows)], SCHEMA)
    return docs.withColumn("ts", F.timestamp_millis("ms")).drop("ms")


@pytest.fixture(scope="module")
def docs(spark):
    return requests(
        spark,
        (0, "a", "x", 199, 10.0),
        (500, "a", "x", 200, 15.5),
        (900, "a", "y", 100, None),
        (3000, "b", None, 150, float("nan")),
        (3500, "b", "y", None, 7.0),
        (9000, "b", "z", 299, float("nan")),
    )


def rows(frame):
    return sorted(tuple(row) for row in frame.collect())


def test_count(docs):
    count = lambda **filters: analytics.count(docs, **filters).first()[0]
    assert count() == 6
    assert count(time_range=g.TimeRange(500, 3000)) == 3
    assert count(root=("api", "b")) == 3
    assert count(query="api:b") == 3
    assert count(query='api:"b" AND application:y') == 1
    assert count(query="status:199") == 1
    assert count(query="response-time:7.0") == 1
    assert count(query="status > 199 OR application IS NULL") == 3
    assert count(query=F.col("api") == "a", root=("application", "x")) == 2
    assert count(default_scope="today", now=86_400_000) == 0
    assert count(default_scope="today", now=80_000_000) == 6
    with pytest.raises(ValueError):
        count(default_scope="yesterday")


def test_predicates(docs):
    assert docs.where(all_of([])).count() == 6
    assert docs.where(field_between("status", 150, 199)).count() == 2
    assert docs.where(field_between("status", lte=150)).count() == 2
    assert docs.where(matches("application:nobody")).count() == 0


def test_counts_are_dense(docs):
    counts = analytics.histogram_counts(docs, g.TimeRange(0, 6500), 1000, root=("api", "b"))
    assert rows(counts) == [(0, 0), (1000, 0), (2000, 0), (3000, 2), (4000, 0), (5000, 0), (6000, 0)]


def test_axis_floors_its_ends(spark):
    axis = analytics.histogram_axis(spark, g.TimeRange(-1500, 999), 1000)
    assert rows(axis) == [(-2000,), (-1000,), (0,)]


def test_metrics_are_truncated_and_finite(docs):
    wanted = [g.avg("response-time"), g.minimum("response-time"), g.maximum("response-time")]
    points = g.date_histogram(docs, WHOLE, 1000, wanted)
    got = {(p.timestamp, p.key): p.value for p in points.collect()}
    # The bucket of 9000 holds only NaN; in that of 3000 NaN spoils mean and maximum.
    assert got == {
        (0, "avg_response-time"): 12,
        (0, "min_response-time"): 10,
        (0, "max_response-time"): 15,
        (3000, "min_response-time"): 7,
    }


def test_truncation_is_toward_zero(spark):
    docs = requests(spark, (0, "a", "x", 1, -1.7))
    assert g.date_histogram(docs, WHOLE, 1000, [g.avg("response-time")]).first().value == -1


def test_terms_ignore_null_and_keep_the_first_ten(spark):
    many = [(0, "a", f"app-{i:02}", 1, 1.0) for i in range(15)]
    docs = requests(spark, *many, (0, "a", "app-14", 1, 1.0), (0, "a", None, 1, 1.0))
    points = g.date_histogram(docs, WHOLE, 1000, [g.terms("application")]).collect()
    assert sorted((p.key, p.value) for p in points) == [(f"app-{i:02}", 1) for i in range(9)] + [("app-14", 2)]
    assert g.date_histogram(docs, WHOLE, 1000, [g.terms("application")], term_limit=3).count() == 3


def test_many_series_in_request_order(docs):
    wanted = [g.terms("status"), g.avg("response-time"), g.terms("application"), g.terms("status")]
    got = {}
    for p in g.date_histogram(docs, WHOLE, 10_000, wanted).collect():
        got.setdefault((p.ordinal, p.aggregation, p.field), {})[p.key] = p.value
    status = {"100": 1, "150": 1, "199": 1, "200": 1, "299": 1}
    assert got == {
        (0, "field", "status"): status,
        (2, "field", "application"): {"x": 2, "y": 2, "z": 1},
        (3, "field", "status"): status,
    }


def test_a_field_may_be_measured_and_grouped_by(docs):
    points = g.date_histogram(docs, g.TimeRange(0, 999), 1000, [g.terms("status"), g.maximum("status")])
    assert sorted((p.key, p.value) for p in points.collect()) == [("100", 1), ("199", 1), ("200", 1), ("max_status", 200)]


def test_response_keeps_empty_slots(spark, docs):
    wanted = [g.avg("response-time"), g.avg("status"), g.terms("application")]
    time_range = g.TimeRange(2000, 9500)
    points = g.date_histogram(docs, time_range, 2000, wanted, root=("application", "z"))
    response = shaping.assemble_series(points, analytics.histogram_axis(spark, time_range, 2000), wanted)
    row = response.first()
    assert row.timestamps == [2000, 4000, 6000, 8000]
    empty, status, by = row["values"]
    assert empty is None
    assert (status.name, status.field) == ("avg_status", "status")
    assert {k: [tuple(p) for p in v] for k, v in status.data.items()} == {"avg_status": [(8000, 299)]}
    assert {k: [tuple(p) for p in v] for k, v in by.data.items()} == {"z": [(8000, 1)]}


def test_response_without_series(spark, docs):
    points = g.date_histogram(docs, WHOLE, 50_000, [])
    row = shaping.assemble_series(points, analytics.histogram_axis(spark, WHOLE, 50_000), []).first()
    assert (row.timestamps, row["values"]) == ([0, 50_000], [])


def test_nothing_matches(spark, docs):
    wanted = [g.avg("status"), g.terms("api")]
    none = dict(root=("api", "nobody"))
    points = g.date_histogram(docs, WHOLE, 50_000, wanted, **none)
    assert points.count() == 0
    assert points.columns == ["ordinal", "timestamp", "aggregation", "field", "key", "value"]
    row = shaping.assemble_series(points, analytics.histogram_axis(spark, WHOLE, 50_000), wanted).first()
    assert row["values"] == [None, None]
    assert g.group_by(docs, "status", WHOLE, **none).count() == 0
    assert analytics.count(docs, **none).first()[0] == 0


def test_group_by_terms(docs):
    assert rows(g.group_by(docs, "application", WHOLE)) == [
        ("application", "x", 2, 1),
        ("application", "y", 2, 2),
        ("application", "z", 1, 3),
    ]
    assert rows(g.group_by(docs, "application", WHOLE, limit=1)) == [("application", "x", 2, 1)]


def test_group_by_mean(docs):
    finite = docs.where("not isnan(response_time)")
    by = lambda order: rows(g.group_by(finite, "application", WHOLE, sort=g.Sort("response-time", order)))
    assert by("desc") == [("application", "x", 12, 1), ("application", "y", 7, 2)]
    assert by("asc") == [("application", "x", 12, 2), ("application", "y", 7, 1)]
    with pytest.raises(ValueError):
        g.Sort("status", kind="max")
    with pytest.raises(ValueError):
        g.Sort("status", "up")


def test_group_by_ranges(docs):
    got = rows(g.group_by(docs, "status", WHOLE, ranges=[(200, 299), (100, 199), (150, 250), (500, 600)]))
    # 199 is outside 100-199 and 299 outside 200-299: the upper bound is excluded.
    assert got == [
        ("status", "100.0-199.0", 2, 1),
        ("status", "150.0-250.0", 3, 2),
        ("status", "200.0-299.0", 1, 3),
        ("status", "500.0-600.0", 0, 4),
    ]


def test_range_labels_are_doubles(docs):
    rows = g.group_by(docs, "status", WHOLE, ranges=[(0, 0.5), (1, 20_000_000)]).collect()
    assert [r.key for r in rows] == ["0.0-0.5", "1.0-2.0E7"]


def test_unknown_aggregation():
    with pytest.raises(ValueError):
        g.Aggregation("median", "status")
