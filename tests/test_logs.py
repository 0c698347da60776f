from datetime import datetime

import pytest
from pyspark.sql import functions as F

import gatelens as g
from gatelens.functions.documents import decode_method, headers_map
from gatelens.functions.predicates import field_between, matches, select_documents
from gatelens.functions.time import to_millis
from gatelens.operators import logs
from gatelens.operators.analytics import top_terms
from gatelens.schemas import table_schema

DAY = g.between(datetime(2024, 1, 2), datetime(2024, 1, 2, 23, 59))


def frame(spark, doc_type, *rows):
    schema = table_schema(doc_type)
    return spark.createDataFrame([tuple(row.get(name) for name in schema.fieldNames()) for row in rows], schema)


def request(number, second, **fields):
    return {
        "id": f"r{number}", "ts": datetime(2024, 1, 2, 10, 0, second), "day": "2024.01.02", "api": "a",
        "method": "3", "status": 200, "response_time": 4, **fields,
    }


@pytest.fixture(scope="module")
def requests(spark):
    return frame(
        spark,
        "request",
        request(1, 1, client_request_headers={"A": ["b"]}),
        request(2, 3, method="POST", api_response_time=2),
        request(3, 3, method="9"),
        request(4, 2, api="b", tenant="t"),
        request(5, 9, day="2024.01.03", ts=datetime(2024, 1, 3)),
    )


@pytest.fixture(scope="module")
def payloads(spark):
    headers = {"X-User": ["7", "8"]}
    return frame(
        spark,
        "log",
        {"id": "r1", "day": "2024.01.02", "client_request": ("/u", "GET", "body", headers)},
        {"id": "r2", "day": "2024.01.05", "client_request": ("/other-day", "GET", None, None)},
        {"id": "r4", "day": "2024.01.02", "client_response": (200, None, headers)},
    )


def test_page(requests):
    page = lambda n, **filters: g.tabular(requests, DAY, page=n, size=2, codes={3: "GET"}, **filters).collect()
    assert [(r.id, r.method, r.total) for r in page(1)] == [("r3", None, 4), ("r2", "POST", 4)]
    assert [(r.id, r.method, r.tenant) for r in page(2)] == [("r4", "GET", "t"), ("r1", "GET", None)]
    assert page(3) == []
    assert [r.id for r in page(1, root=("api", "b"))] == ["r4"]
    assert [r.id for r in page(1, query="tenant:t")] == ["r4"]
    row = page(1)[1]
    assert len(row) == 21
    assert (row.api_response_time, row.request_content_length, row.response_content_length) == (2, 0, 0)
    assert row.timestamp == to_millis(datetime(2024, 1, 2, 10, 0, 3))
    with pytest.raises(ValueError):
        page(0)


def test_payload_columns_are_dropped(requests):
    assert "client_request_headers" in requests.columns
    assert "client_request_headers" not in g.tabular(requests, DAY).columns


def test_find_with_payload(requests, payloads):
    found = {r.id: r for r in g.find_requests(requests, payloads, ["r1", "r2", "r4"], {3: "GET"}).collect()}
    assert found["r1"].client_request.headers == {"X-User": ["7", "8"]}
    assert found["r1"].method == "GET"
    assert found["r1"].client_response is None
    assert found["r2"].client_request is None  # logged under the same id on another day
    assert found["r4"].client_response.status == 200


def test_find_by_frame_is_the_same(spark, requests, payloads):
    ids = spark.createDataFrame([("r1",), ("r4",), ("r9",)], "id string")
    by_frame = g.find_requests(requests, payloads, ids)
    by_list = g.find_requests(requests, payloads, ["r1", "r4", "r9"])
    assert sorted(by_frame.select("id", "day").collect()) == sorted(by_list.select("id", "day").collect())
    assert by_frame.count() == 2
    many = [f"r{n}" for n in range(logs.LITERAL_IDS + 1)]
    assert g.find_requests(requests, payloads, many).count() == 5


def test_missing(spark, requests, payloads):
    assert [r.id for r in g.missing_ids(requests, ["r1", "r8", "r8"]).collect()] == ["r8"]
    with pytest.raises(Exception, match="no request has the id r8"):
        g.find_requests(requests, payloads, ["r1", "r8"], strict=True).collect()
    assert g.find_requests(requests, payloads, ["r1"], strict=True).first().id == "r1"


def test_methods(spark):
    texts = spark.createDataFrame([("3",), ("GET",), ("77",), (None,)], "m string")
    decoded = texts.select(decode_method(F.col("m"), {3: "GET"}).alias("d"), decode_method(F.col("m"), None).alias("raw"))
    assert [tuple(r) for r in decoded.collect()] == [("GET", "3"), ("GET", "GET"), (None, "77"), (None, None)]


def test_headers(spark):
    row = spark.createDataFrame([('{"A":["1","2"],"B":[]}',)], "h string").select(headers_map(F.col("h")).alias("m")).first()
    assert row.m == {"A": ["1", "2"], "B": []}


def test_raw_search(spark):
    # Eleven checks of a day, seven of one API, one of another, three of none.
    apis = ["one"] * 7 + ["two"] + [None] * 3
    rows = [
        {"id": f"h{n}", "api": api, "ts": datetime(2024, 1, 2, 10, n), "day": "2024.01.02"} for n, api in enumerate(apis)
    ]
    docs = frame(spark, "health", *rows, {"id": "late", "api": "one", "ts": datetime(2024, 1, 2, 20), "day": "2024.01.02"})
    chosen = docs.where(field_between("@timestamp", "2024-01-02T10:00:00.000+01:00", "2024-01-02T19:00:00.000+01:00"))
    same = select_documents(docs, g.between(datetime(2024, 1, 2, 9), datetime(2024, 1, 2, 18)))
    assert sorted(r.id for r in chosen.collect()) == sorted(r.id for r in same.collect())
    hits = logs.with_total(logs.newest_first(chosen).limit(3).select("id"), chosen).collect()
    assert [(r.id, r.total) for r in hits] == [("h10", 11), ("h9", 11), ("h8", 11)]
    assert [(r.key, r.value) for r in top_terms(chosen, "api", 10).collect()] == [("one", 7), ("two", 1)]


@pytest.mark.parametrize("partitioned", [False, True])
@pytest.mark.parametrize("ids", ["r{:05}", "a-very-long-common-prefix-of-all-the-ids-{:05}"])
def test_all_pages_are_the_sorted_documents(spark, monkeypatch, partitioned, ids):
    """Shallow and deep pages, with shared, missing and null keys, are pieces of one order."""
    rows = []
    for n in range(120):
        ts = None if n % 9 == 0 else datetime(2024, 1, 1 + n % 3, 10, 0, n % 4)
        rows.append((ids.format(n), ts, "2024.01.0" + str(1 + n % 3)))
    docs = spark.createDataFrame(rows, "id string, ts timestamp, day string")
    docs = docs if partitioned else docs.drop("day")
    expected = [r.id for r in logs.newest_first(docs).collect()]
    assert expected[-1] == ids.format(0) and len(expected) == 120
    for limit in (10_000, 0, 40):
        monkeypatch.setattr(logs, "TOP_K_ROWS", limit)
        for size in (17, 50):
            pages = [[r.id for r in logs.page_of(docs, page, size).collect()] for page in range(1, 120 // size + 2)]
            assert [i for page in pages for i in page] == expected, (limit, size)


@pytest.mark.parametrize("size", [7, 50, 200])
def test_pages_of_one_ordering(spark, tmp_path, size):
    """Shared, missing and null keys and rows that repeat: pages are slices of the sorted documents."""
    rows = []
    for n in range(120):
        ms = None if n % 9 == 0 else 1_700_000_000_000 + n % 4
        rows += [(None if n % 13 == 0 else f"r{n:03}", ms, n)] * (1 + n % 2)
    docs = spark.createDataFrame(rows, "id string, timestamp long, n int").repartition(6)
    order = [F.col("timestamp").desc_nulls_last(), F.col("id").desc_nulls_last()]
    expected = [(r.id, r.timestamp) for r in docs.orderBy(*order).collect()]
    pages = logs.Pages(docs, size, str(tmp_path / "pages"))
    count = -(-len(expected) // size)
    assert [(r.id, r.timestamp) for k in range(1, count + 1) for r in pages.page(k).collect()] == expected
    assert pages.page(count + 1).collect() == []
    whole = pages.all()
    assert whole.columns == ["page", "id", "timestamp", "n", "total"]
    assert {r.total for r in whole.collect()} == {len(expected)} and sorted(r.n for r in whole.collect()) == sorted(r[2] for r in rows)
    with pytest.raises(ValueError):
        logs.Pages(docs, 0, str(tmp_path / "none"))


def test_pages_of_nothing(spark, tmp_path):
    pages = logs.Pages(spark.createDataFrame([], "id string, timestamp long"), 5, str(tmp_path / "pages"))
    assert pages.all().collect() == [] and pages.page(1).collect() == []


def test_a_deep_page_counts_what_a_shallow_one_does(spark, requests, monkeypatch):
    span = g.TimeRange(0, 4_000_000_000_000)
    before = [tuple(r) for r in g.tabular(requests, span, page=2, size=2).collect()]
    assert before and before[0][-1] == requests.where("ts is not null").count()
    monkeypatch.setattr(logs, "TOP_K_ROWS", 0)
    assert [tuple(r) for r in g.tabular(requests, span, page=2, size=2).collect()] == before


def test_broadcast_limits_change_plans_only(spark, requests, payloads, monkeypatch):
    many = [f"r{n}" for n in range(logs.LITERAL_IDS + 1)]
    before = sorted(r.id for r in g.find_requests(requests, payloads, many).collect())
    monkeypatch.setattr(logs, "BROADCAST_IDS", 1)
    assert sorted(r.id for r in g.find_requests(requests, payloads, many).collect()) == before
    assert [r.id for r in logs.page_of(requests, 1, 2).collect()] == ["r5", "r3"]


@pytest.mark.parametrize(
    ("query", "expected"),
    [
        ('api:a AND method:"POST"', ["r2"]),
        ("api:b OR method:9", ["r3", "r4"]),
        ("api:b method:9", ["r3", "r4"]),
        ("NOT tenant:t", ["r1", "r2", "r3", "r5"]),
        ("api:a AND NOT (method:POST OR method:9)", ["r1", "r5"]),
        ("method:P*T", ["r2"]),
        ("method:?", ["r1", "r3", "r4", "r5"]),
        ("method:*", ["r1", "r2", "r3", "r4", "r5"]),
        ("_exists_:tenant", ["r4"]),
        ("response-time:[4 TO 5] AND response-time:{3 TO *]", ["r1", "r2", "r3", "r4", "r5"]),
        ("response-time:>4", []),
        ('tenant:"x AND y"', []),
        ("api_response_time = 2 OR tenant = 't:u'", ["r2"]),
    ],
)
def test_query_strings(requests, query, expected):
    assert sorted(r.id for r in requests.where(matches(query)).collect()) == expected


@pytest.mark.parametrize("query", ["api:a AND foo", "api:[1 TO", "api:abc~2", "+api:a"])
def test_other_query_strings_are_refused(requests, query):
    with pytest.raises(ValueError, match="not understood|not a range|not supported"):
        requests.where(matches(query)).collect()
