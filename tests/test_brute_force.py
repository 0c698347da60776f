"""Operators against plain Python over the same random documents."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import gatelens as g
from gatelens.functions.time import rolling_windows
from gatelens.operators import analytics, health, logs

NOW = 1_711_886_400_000  # 2024-03-31 12:00
HOUR, DAY = 3_600_000, 86_400_000
SCHEMA = (
    "id string, ms bigint, api string, endpoint string, gateway string, application string, status int, "
    "response_time double, available boolean"
)


@pytest.fixture(scope="module", params=[1, 2, 3])
def documents(request):
    pick = random.Random(request.param)
    often = ["a", "a", "a", "b", "c", None]
    return [
        {
            "id": f"d{n:04}",
            "ms": NOW - pick.choice([pick.randrange(40 * DAY), pick.randrange(2 * HOUR), pick.randrange(8) * HOUR]),
            "api": pick.choice(often),
            "endpoint": pick.choice([*often, *map(str, range(14))]),
            "gateway": pick.choice(often),
            "application": pick.choice([f"app-{i:02}" for i in range(13)] + [None]),
            "status": pick.choice([100, 199, 200, 299, 404, None]),
            "response_time": pick.choice([None, float("nan"), 0.0, -2.5, 7.9, pick.random() * 100]),
            "available": pick.choice([True, True, False, None]),
        }
        for n in range(600)
    ]


@pytest.fixture(scope="module")
def docs(spark, documents):
    frame = spark.createDataFrame([tuple(d.values()) for d in documents], SCHEMA)
    return frame.repartition(7).withColumn("ts", F.timestamp_millis("ms")).drop("ms")


def mean(values):
    values = [v for v in values if v is not None]
    return sum(values) / len(values) if values else None


def whole(value):
    return None if value is None or not math.isfinite(value) else math.trunc(value)


def top(counts, limit):
    return sorted(counts.items(), key=lambda item: (-item[1], item[0]))[:limit]


def test_histogram(docs, documents):
    time_range = g.TimeRange(NOW - 30 * DAY, NOW - HOUR)
    chosen = [d for d in documents if time_range.start <= d["ms"] <= time_range.end and d["api"] == "a"]
    buckets = defaultdict(list)
    for d in chosen:
        buckets[d["ms"] // (6 * HOUR) * 6 * HOUR].append(d)
    expected = set()
    for start, inside in buckets.items():
        value = whole(mean([d["response_time"] for d in inside]))
        if value is not None:
            expected.add((0, start, "avg_response-time", value))
        terms = Counter(d["application"] for d in inside if d["application"] is not None)
        expected.update((1, start, key, n) for key, n in top(terms, 10))
        statuses = [d["status"] for d in inside if d["status"] is not None]
        if statuses:
            expected.add((2, start, "min_status", min(statuses)))
    wanted = [g.avg("response-time"), g.terms("application"), g.minimum("status")]
    points = g.date_histogram(docs, time_range, 6 * HOUR, wanted, root=("api", "a"))
    assert {(p.ordinal, p.timestamp, p.key, p.value) for p in points.collect()} == expected
    counts = analytics.histogram_counts(docs, time_range, 6 * HOUR, root=("api", "a"))
    first, last = time_range.start // (6 * HOUR), time_range.end // (6 * HOUR)
    assert {tuple(r) for r in counts.collect()} == {
        (b * 6 * HOUR, len(buckets.get(b * 6 * HOUR, []))) for b in range(first, last + 1)
    }


def test_group_by(docs, documents):
    everything = g.TimeRange(0, NOW)
    terms = Counter(d["application"] for d in documents if d["application"] is not None)
    rows = g.group_by(docs, "application", everything, limit=5).collect()
    assert [(r.key, r.value, r["rank"]) for r in rows] == [(k, n, i) for i, (k, n) in enumerate(top(terms, 5), 1)]
    ranges = [(100, 199), (0, 300), (200, 200), (299, 405)]
    rows = g.group_by(docs, "status", everything, ranges=ranges).collect()
    statuses = [d["status"] for d in documents if d["status"] is not None]
    assert {r.key: r.value for r in rows} == {
        f"{float(a)}-{float(b)}": sum(a <= s < b for s in statuses) for a, b in ranges
    }
    finite = [d for d in documents if d["response_time"] is not None and not math.isnan(d["response_time"])]
    means = {}
    for term in terms:
        values = [d["response_time"] for d in finite if d["application"] == term]
        means[term] = mean(values)
    rows = g.group_by(
        docs.where("not isnan(response_time)"), "application", everything, sort=g.Sort("response-time", "asc")
    ).collect()
    assert [(r.key, r.value) for r in rows] == [(k, whole(v)) for k, v in sorted(means.items(), key=lambda i: i[1])]


def month(documents):
    # Whole days: 2024-02-29 00:00 to the end of 2024-03-31.
    return [d for d in documents if d["api"] == "a" and d["ms"] >= 1_709_164_800_000]


def test_windows(docs, documents):
    chosen = month(documents)
    terms = Counter(d["endpoint"] for d in chosen if d["endpoint"] is not None)
    expected_up, expected_time = {}, {}
    for term, _ in top(terms, 10):
        times = {}
        for label, start in rolling_windows(NOW):
            inside = [d for d in chosen if d["endpoint"] == term and d["ms"] >= start]
            known = [d["available"] for d in inside if d["available"] is not None]
            expected_up[term, label] = 100 * sum(known) / len(known) if known else 100.0
            times[label] = whole(mean([d["response_time"] for d in inside])) or 0
        if any(times.values()):
            expected_time.update({(term, label): value for label, value in times.items()})
    up = {(r.key, r.range): r.percent for r in g.availability(docs, "a", now=NOW).collect()}
    assert up == pytest.approx(expected_up)
    times = {(r.key, r.range): r.value for r in g.average_response_time(docs, "a", now=NOW).collect()}
    assert times == expected_time


def test_health_histogram(docs, documents):
    chosen = month(documents)
    bounds = g.TimeRange(NOW - 3 * DAY, NOW + DAY)
    frame = health.health_histogram_dense(
        docs, bounds, DAY, [g.terms("available"), g.maximum("status")], api="a", now=NOW
    )
    buckets = defaultdict(list)
    for d in chosen:
        buckets[d["ms"] // DAY].append(d)
    axis = range(min([bounds.start // DAY, *buckets]), max([bounds.end // DAY, *buckets]) + 1)
    expected = {}
    for b in axis:
        known = [d["available"] for d in buckets.get(b, []) if d["available"] is not None]
        statuses = [d["status"] for d in buckets.get(b, []) if d["status"] is not None]
        expected[b * DAY] = (
            len(buckets.get(b, [])),
            pytest.approx(100 * sum(known) / len(known)) if known else None,
            max(statuses, default=None),
        )
    assert {r.timestamp: tuple(r)[1:] for r in frame.collect()} == expected


@pytest.mark.parametrize("top_k_rows", [10_000, 0])
def test_pages(docs, documents, monkeypatch, top_k_rows):
    monkeypatch.setattr(logs, "TOP_K_ROWS", top_k_rows)
    ordered = sorted(documents, key=lambda d: (d["ms"], d["id"]), reverse=True)
    for page, size in ((1, 10), (7, 33), (100, 10)):
        rows = logs.page_of(docs, page, size).collect()
        assert [r.id for r in rows] == [d["id"] for d in ordered[(page - 1) * size : page * size]]
        with_day = docs.withColumn("day", F.date_format("ts", "yyyy.MM.dd"))
        rows = logs.page_of(with_day, page, size).collect()
        assert [r.id for r in rows] == [d["id"] for d in ordered[(page - 1) * size : page * size]]
