"""The registered queries: every operation over the whole ``events`` views."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gatelens.functions import documents, time
from gatelens.functions.predicates import field_between, select_documents
from gatelens.operators import analytics, health, logs, monitoring, shaping
from gatelens.schemas import DOCUMENT_FIELDS, column_name
from gatelens.session import passing_folder
from gatelens.sources import bulk, tables, views
from gatelens.store import GatewayStore

TEN_DAYS = time.between(datetime(2024, 1, 10), datetime(2024, 1, 20, 12))
PAST_DATA = time.between(datetime(2023, 12, 31), datetime(2024, 1, 31, 12))
HOUR = time.hours(1)
NOW = time.to_millis(datetime(2024, 1, 30, 23, 59))
MID_FEBRUARY = time.to_millis(datetime(2024, 2, 15, 8))
ROOT = ("api", "api-1")
CODES = {0: "CONNECT", 1: "DELETE", 2: "GET"}  # a caller's list; code 3 stays unknown
NAMED_DAYS = ["2024.01.02", "2024.01.17", "2031.12.31"]
STATUS_RANGES = [(100, 199), (200, 299), (300, 399)]
OVERLAPPING = [(0, 50), (25, 75), (50, 100), (5000, 6000)]

MULTI = [
    analytics.avg("response-time"),
    analytics.terms("application"),
    analytics.maximum("api-response-time"),
    analytics.terms("status"),
]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def registered(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


# --- scans -------------------------------------------------------------------


def per_day(docs: DataFrame) -> DataFrame:
    docs = docs if "day" in docs.columns else views.with_day(docs)
    return docs.groupBy("day").agg(F.count("*").alias("documents"))


@registered
def scan_day_range(spark, sf_dir):
    return per_day(time.restrict_days(views.requests(spark, sf_dir), date(2024, 1, 5), date(2024, 1, 20)))


@registered
def scan_today(spark, sf_dir):
    return per_day(time.restrict_today(views.monitor(spark, sf_dir), NOW))


@registered
def scan_all_days(spark, sf_dir):
    return per_day(views.requests(spark, sf_dir))


@registered
def scan_named_days(spark, sf_dir):
    return per_day(time.restrict_named_days(views.requests(spark, sf_dir), NAMED_DAYS))


@registered
def scan_last_month(spark, sf_dir):
    return per_day(time.restrict_last_month(views.health(spark, sf_dir), MID_FEBRUARY))


@registered
def scan_all_types(spark, sf_dir):
    union = tables.union_types(
        {
            "request": views.requests(spark, sf_dir),
            "log": views.logs(spark, sf_dir),
            "health": views.health(spark, sf_dir),
            "monitor": views.monitor(spark, sf_dir),
        }
    )
    return union.groupBy("doc_type").agg(
        F.count("*").alias("documents"),
        F.count("api").alias("with_api"),
        F.count("gateway").alias("with_gateway"),
        F.count("hostname").alias("with_hostname"),
    )


@registered
def day_sequence(spark, sf_dir):
    """Users active around each day: from their first to their last request."""
    spans = views.requests(spark, sf_dir).groupBy("application").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    covered = spans.select(F.explode(time.day_sequence(F.col("a"), F.col("b"))).alias("day"))
    return covered.groupBy("day").agg(F.count("*").alias("applications"))


# --- count -------------------------------------------------------------------


@registered
def count_all(spark, sf_dir):
    return analytics.count(views.requests(spark, sf_dir))


@registered
def count_today(spark, sf_dir):
    return analytics.count(views.requests(spark, sf_dir), default_scope="today", now=NOW)


@registered
def count_range(spark, sf_dir):
    return analytics.count(views.requests(spark, sf_dir), TEN_DAYS)


@registered
def count_root_query(spark, sf_dir):
    return analytics.count(views.requests(spark, sf_dir), TEN_DAYS, ROOT, "endpoint:click AND tenant:acme")


@registered
def count_query_or_not(spark, sf_dir):
    query = 'endpoint:click OR (NOT tenant:acme AND gateway:"gw-1") OR status:404'
    return analytics.count(views.requests(spark, sf_dir), TEN_DAYS, query=query)


@registered
def count_query_wildcard(spark, sf_dir):
    return analytics.count(views.requests(spark, sf_dir), query="application:app-1?* AND _exists_:message AND uri:/*r*")


@registered
def count_query_range(spark, sf_dir):
    query = "response-time:[20 TO 80} AND (status:>=300 status:{100 TO *])"
    return analytics.count(views.requests(spark, sf_dir), TEN_DAYS, query=query)


@registered
def count_expression(spark, sf_dir):
    return analytics.count(views.requests(spark, sf_dir), TEN_DAYS, query="status >= 400 OR response_time > 100")


# --- date histogram ----------------------------------------------------------


@registered
def hist_count(spark, sf_dir):
    return analytics.histogram_counts(views.requests(spark, sf_dir), PAST_DATA, HOUR)


def histogram(spark, sf_dir, *aggregations, **filters):
    return analytics.date_histogram(views.requests(spark, sf_dir), TEN_DAYS, HOUR, aggregations, **filters)


@registered
def hist_avg(spark, sf_dir):
    return histogram(
        spark, sf_dir, analytics.avg("response-time"), analytics.avg("api-response-time"), query="api:api-1"
    )


@registered
def hist_min(spark, sf_dir):
    return histogram(spark, sf_dir, analytics.minimum("response-time"), root=ROOT)


@registered
def hist_max(spark, sf_dir):
    return histogram(spark, sf_dir, analytics.maximum("response-time"), root=ROOT)


@registered
def hist_field(spark, sf_dir):
    return histogram(spark, sf_dir, analytics.terms("application"))


@registered
def hist_multi(spark, sf_dir):
    return histogram(spark, sf_dir, *MULTI)


@registered
def hist_legacy_app(spark, sf_dir):
    points = histogram(spark, sf_dir, analytics.terms("application"), root=("api", "api-2"))
    return points.select("timestamp", F.col("key").alias("application"), F.col("value").alias("documents"))


@registered
def hist_series(spark, sf_dir):
    """The nested response, flattened to text: slot, name, key and its points."""
    docs = views.requests(spark, sf_dir)
    wanted = [analytics.avg("response-time"), analytics.avg("proxy-latency"), analytics.terms("endpoint")]
    # Failed requests have no latency, so the second slot is empty and stays.
    points = analytics.date_histogram(docs, PAST_DATA, 6 * HOUR, wanted, query="endpoint:error")
    axis = analytics.histogram_axis(spark, PAST_DATA, 6 * HOUR)
    return flat_rows(shaping.joined_chunks(shaping.series_chunks(points, wanted, 6 * HOUR)), axis)


CHUNK = 7


@registered
def hist_chunks(spark, sf_dir):
    """The series in pieces of a few buckets, each piece a row."""
    docs = views.requests(spark, sf_dir)
    wanted = [analytics.avg("response-time"), analytics.avg("proxy-latency"), analytics.terms("endpoint")]
    points = analytics.date_histogram(docs, PAST_DATA, 6 * HOUR, wanted, query="endpoint:error")
    chunks = shaping.series_chunks(points, wanted, 6 * HOUR, CHUNK)
    return chunks.select("slot", "key", "chunk_start", points_text().alias("points"))


@registered
def hist_axis_chunks(spark, sf_dir):
    """The axis that goes with them."""
    counts = analytics.histogram_counts(views.requests(spark, sf_dir), PAST_DATA, 6 * HOUR)
    chunks = shaping.axis_chunks(counts, 6 * HOUR, CHUNK)
    return chunks.select("chunk_start", F.size("timestamps").alias("buckets"), F.element_at("timestamps", -1).alias("last"))


@registered
def hist_response(spark, sf_dir):
    """The same as one nested row."""
    docs = views.requests(spark, sf_dir)
    wanted = [analytics.avg("response-time"), analytics.avg("proxy-latency"), analytics.terms("endpoint")]
    points = analytics.date_histogram(docs, PAST_DATA, 6 * HOUR, wanted, query="endpoint:error")
    response = shaping.assemble_series(points, analytics.histogram_axis(spark, PAST_DATA, 6 * HOUR), wanted)
    return flat_response(response)


@registered
def hist_nothing_found(spark, sf_dir):
    """No document matches: every series keeps its empty slot."""
    docs = views.requests(spark, sf_dir)
    wanted = [analytics.avg("response-time"), analytics.terms("endpoint")]
    points = analytics.date_histogram(docs, PAST_DATA, 6 * HOUR, wanted, query="endpoint:none")
    return flat_rows(shaping.series_rows(points, wanted), analytics.histogram_axis(spark, PAST_DATA, 6 * HOUR))


@registered
def hist_not_a_number(spark, sf_dir):
    """Means that are NaN or infinite have no point."""
    event = F.col("id").cast("bigint")
    value = F.when(event % 97 == 0, F.lit(float("nan"))).when(event % 89 == 0, F.lit(float("inf")))
    docs = views.requests(spark, sf_dir).withColumn("response_time", value.otherwise(F.col("response_time")).cast("double"))
    points = analytics.date_histogram(docs, TEN_DAYS, HOUR, [analytics.avg("response-time")])
    return points.select("timestamp", "value")


def points_text() -> Column:
    return F.array_join(
        F.transform("points", lambda p: F.concat_ws(":", p["timestamp"].cast("string"), p["value"].cast("string"))), " "
    )


def flat_rows(rows: DataFrame, axis: DataFrame) -> DataFrame:
    size = axis.agg(F.count("*").cast("int").alias("axis")).scalar()
    has_points = F.col("key").isNotNull()
    return rows.select(size.alias("axis"), "slot", F.when(has_points, F.col("name")).alias("name"), "key", points_text().alias("points"))


def flat_response(response: DataFrame) -> DataFrame:
    slots = response.select(F.size("timestamps").alias("axis"), F.posexplode("values").alias("slot", "series"))
    flat = slots.select(
        "axis", "slot", F.col("series.name").alias("name"), F.explode_outer("series.data").alias("key", "points")
    )
    return flat.select("axis", "slot", "name", "key", points_text().alias("points"))


# --- group by ----------------------------------------------------------------


@registered
def group_terms(spark, sf_dir):
    return analytics.group_by(views.requests(spark, sf_dir), "application", TEN_DAYS, query="api:api-1")


@registered
def group_terms_avg_desc(spark, sf_dir):
    sort = analytics.Sort("response-time", "desc")
    return analytics.group_by(views.requests(spark, sf_dir), "application", TEN_DAYS, sort=sort)


@registered
def group_terms_avg_asc(spark, sf_dir):
    sort = analytics.Sort("api-response-time", "asc")
    return analytics.group_by(views.requests(spark, sf_dir), "endpoint", TEN_DAYS, root=ROOT, sort=sort)


@registered
def group_terms_uri(spark, sf_dir):
    """A field with as many terms as documents: only ties, settled by the term."""
    return analytics.group_by(views.requests(spark, sf_dir), "transaction", TEN_DAYS)


@registered
def group_ranges(spark, sf_dir):
    return analytics.group_by(
        views.requests(spark, sf_dir), "status", TEN_DAYS, query="api:api-1", ranges=STATUS_RANGES
    )


@registered
def group_ranges_overlap(spark, sf_dir):
    return analytics.group_by(views.requests(spark, sf_dir), "response-time", TEN_DAYS, ranges=OVERLAPPING)


@registered
def raw_terms(spark, sf_dir):
    docs = select_documents(views.health(spark, sf_dir), TEN_DAYS)
    return analytics.top_terms(docs, "api", 10)


@registered
def raw_search(spark, sf_dir):
    docs = views.requests(spark, sf_dir).where(field_between("response-time", 50, 60))
    hits = logs.newest_first(docs).limit(25).select("id", "response_time")
    return logs.with_total(hits, docs)


# --- request logs ------------------------------------------------------------


@registered
def tabular_page(spark, sf_dir):
    return logs.tabular(views.requests(spark, sf_dir), TEN_DAYS, page=3, size=25, root=ROOT, codes=CODES)


@registered
def tabular_deep_page(spark, sf_dir):
    """Beyond the rows a top-k would carry: located by counting."""
    docs = views.requests(spark, sf_dir)
    return logs.tabular(docs, PAST_DATA, page=2, size=9_000).select("id", "timestamp", "total")


@registered
def tabular_total(spark, sf_dir):
    return logs.hits_total(select_documents(views.requests(spark, sf_dir), TEN_DAYS, ROOT))


@registered
def tabular_without_payloads(spark, sf_dir):
    """Tabular page of documents that carry their payloads, as old ones did."""
    docs = views.requests(spark, sf_dir).withColumn("client_request_headers", F.create_map(F.lit("a"), F.array("uri")))
    return logs.tabular(docs, TEN_DAYS, page=1, size=10, query='application:"app-7"').drop("total")


@registered
def decode_method(spark, sf_dir):
    method = documents.decode_method(F.col("method"), CODES)
    return views.requests(spark, sf_dir).groupBy(method.alias("method")).agg(F.count("*").alias("documents"))


def ids_of(spark, sf_dir, table: str, column: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").select(F.col(column).cast("string").alias("id"))


@registered
def request_by_ids(spark, sf_dir):
    """Requests whose number is also a customer's, with their payloads."""
    found = logs.find_requests(
        views.with_day(views.requests(spark, sf_dir)),
        views.with_day(views.logs(spark, sf_dir)),
        ids_of(spark, sf_dir, "customer", "c_custkey"),
        CODES,
    )
    return found.select(
        "id", "day", "method", "api_response_time", "client_request.uri", "client_request.body", "client_response.status"
    )


@registered
def request_missing_ids(spark, sf_dir):
    return logs.missing_ids(views.requests(spark, sf_dir), ids_of(spark, sf_dir, "orders", "o_orderkey"))


@registered
def request_day_with_log(spark, sf_dir):
    """All days: each request beside what was logged of it on its day."""
    docs = views.with_day(views.requests(spark, sf_dir))
    joined = logs.request_with_log(docs, views.with_day(views.logs(spark, sf_dir)))
    return joined.select(
        "id",
        "day",
        "timestamp",
        "transaction",
        "message",
        F.col("client_request.uri").alias("logged_uri"),
        F.element_at(F.col("client_request.headers")["X-User"], 1).alias("logged_user"),
        F.col("proxy_request").isNull().alias("no_proxy_request"),
    )


@registered
def headers_map(spark, sf_dir):
    """Header names and values of all logged answers."""
    docs = views.logs(spark, sf_dir).select(F.explode("client_response.headers").alias("name", "sizes"))
    return docs.groupBy("name", F.element_at("sizes", 1).alias("size")).agg(F.count("*").alias("documents"))


# --- health checks -----------------------------------------------------------


@registered
def availability_endpoint(spark, sf_dir):
    return health.availability(views.health(spark, sf_dir), "api-1", "ENDPOINT", now=NOW)


@registered
def availability_gateway(spark, sf_dir):
    return health.availability(views.health(spark, sf_dir), "api-2", "GATEWAY", now=NOW)


@registered
def avg_response_time(spark, sf_dir):
    return health.average_response_time(views.health(spark, sf_dir), "api-1", "endpoint", now=NOW)


@registered
def avg_response_time_gateway(spark, sf_dir):
    """Long after the data: recent windows are empty and count 0."""
    return health.average_response_time(views.health(spark, sf_dir), "api-3", "gateway", now=MID_FEBRUARY)


@registered
def avg_response_time_zero(spark, sf_dir):
    """An endpoint all of whose means are 0 is left out."""
    docs = views.health(spark, sf_dir)
    zero = F.when(F.col("endpoint") == "click", F.lit(0)).otherwise(F.col("response_time"))
    return health.average_response_time(docs.withColumn("response_time", zero), "api-1", "endpoint", now=NOW)


@registered
def availability_cut(spark, sf_dir):
    """More endpoints than the ten that are reported."""
    docs = views.health(spark, sf_dir).withColumn("endpoint", F.concat("endpoint", F.lit("-"), F.col("id").cast("bigint") % 4))
    return health.availability(docs, "api-1", "ENDPOINT", now=NOW)


def health_histogram(spark, sf_dir, *aggregations):
    return health.health_histogram(views.health(spark, sf_dir), TEN_DAYS, HOUR, aggregations, api="api-1", now=NOW)


@registered
def health_hist_count(spark, sf_dir):
    """The data reaches beyond the bounds, so the axis does."""
    return health.health_histogram_dense(views.health(spark, sf_dir), TEN_DAYS, HOUR, api="api-1", now=NOW)


@registered
def health_hist_axis(spark, sf_dir):
    """The axis of the response, by position."""
    dense = health.health_histogram_dense(views.health(spark, sf_dir), TEN_DAYS, HOUR, api="api-2", now=NOW)
    first = dense.agg(F.min("timestamp")).scalar()
    return dense.select(((F.col("timestamp") - first) / HOUR).cast("int").alias("position"), "timestamp")


@registered
def health_hist_avg(spark, sf_dir):
    return health_histogram(spark, sf_dir, analytics.avg("response-time"))


@registered
def health_hist_avail(spark, sf_dir):
    return health_histogram(spark, sf_dir, analytics.terms("available"))


@registered
def health_hist_minmax(spark, sf_dir):
    return health_histogram(spark, sf_dir, analytics.minimum("response-time"), analytics.maximum("response-time"))


@registered
def health_hist_series(spark, sf_dir):
    """The nested response of a health histogram, flattened to text."""
    wanted = [analytics.maximum("response-time"), analytics.avg("state"), analytics.minimum("response-time")]
    docs = views.health(spark, sf_dir).withColumn("state", F.lit(None).cast("int"))  # the second slot is empty
    dense = health.health_histogram_dense(docs, TEN_DAYS, 6 * HOUR, wanted, api="api-1", now=NOW)
    return flat_rows(shaping.joined_chunks(shaping.series_chunks(health.health_points(dense, wanted), wanted, 6 * HOUR)), dense)


@registered
def health_hist_response(spark, sf_dir):
    """The same as one nested row."""
    wanted = [analytics.maximum("response-time"), analytics.avg("state"), analytics.minimum("response-time")]
    docs = views.health(spark, sf_dir).withColumn("state", F.lit(None).cast("int"))
    dense = health.health_histogram_dense(docs, TEN_DAYS, 6 * HOUR, wanted, api="api-1", now=NOW)
    return flat_response(shaping.assemble_dense(dense, wanted))


@registered
def health_hist_undated(spark, sf_dir):
    """Checks without a timestamp belong to no bucket."""
    docs = views.with_day(views.health(spark, sf_dir)).withColumn("ts", F.when(F.col("id").cast("bigint") % 7 > 0, F.col("ts")))
    return health.health_histogram_dense(docs, TEN_DAYS, HOUR, api="api-1", now=NOW)


@registered
def health_logs_page(spark, sf_dir):
    return health.health_logs(views.health(spark, sf_dir), "api-1", page=2, size=30, now=NOW)


PAGE = 9_000


@registered
def health_logs_all_pages(spark, sf_dir):
    """All pages one after the other, shallow and deep, with checks that have no timestamp: nothing is lost."""
    ts = F.when(F.col("id").cast("bigint") % 10 > 0, F.col("ts"))
    docs = views.with_day(views.health(spark, sf_dir)).withColumn("ts", ts)
    pages = health.health_log_pages(docs, None, PAGE, f"{passing_folder(spark)}/pages", now=NOW)
    return pages.all().select("page", "id", "timestamp", "total")


@registered
def tabular_all_pages(spark, sf_dir):
    """All pages of request logs of one ordering."""
    pages = logs.tabular_pages(views.requests(spark, sf_dir), TEN_DAYS, PAGE // 4, f"{passing_folder(spark)}/pages", root=ROOT)
    return pages.all().select("page", "id", "timestamp", "status", "total")


@registered
def tabular_page_of_many(spark, sf_dir):
    """One of them, as a slice."""
    pages = logs.tabular_pages(views.requests(spark, sf_dir), TEN_DAYS, 20, f"{passing_folder(spark)}/pages", root=ROOT)
    return pages.page(3).select("id", "timestamp", "status", "total")


@registered
def health_by_ids(spark, sf_dir):
    found = health.find_health(views.health(spark, sf_dir), ids_of(spark, sf_dir, "customer", "c_custkey"))
    return found.withColumn("steps", F.size("steps"))


@registered
def health_steps(spark, sf_dir):
    docs = views.health(spark, sf_dir).select("id", F.posexplode(documents.health_steps()).alias("position", "step"))
    return docs.select(
        "id",
        "position",
        "step.success",
        "step.message",
        F.col("step.request.uri").alias("uri"),
        F.col("step.request.method").alias("method"),
        F.col("step.response.status").alias("status"),
        F.col("step.response.body").alias("body"),
    )


# --- monitoring --------------------------------------------------------------


def flat_load(snapshot: DataFrame) -> DataFrame:
    load = F.col("os_cpu_load_average")
    return snapshot.select(
        "*", load["1m"].alias("load_1m"), load["5m"].alias("load_5m"), load["15m"].alias("load_15m")
    ).drop("os_cpu_load_average")


@registered
def latest_snapshot(spark, sf_dir):
    return flat_load(monitoring.latest_snapshot(views.monitor(spark, sf_dir), "gw-1", NOW))


@registered
def latest_per_gateway(spark, sf_dir):
    return flat_load(monitoring.latest_per_gateway(views.monitor(spark, sf_dir), NOW))


# --- ingestion ---------------------------------------------------------------


def request_feed(docs: DataFrame, status=None) -> DataFrame:
    """Bulk records of requests, as a gateway would send them."""
    sent = views.with_day(docs)
    document = F.to_json(
        F.struct(
            F.date_format("ts", documents.TIMESTAMP_TEXT).alias("@timestamp"),
            "api",
            "gateway",
            "endpoint",
            "transaction",
            F.col("method").cast("int").alias("method"),
            (F.col("status") if status is None else F.lit(status)).alias("status"),
            F.col("response_time").alias("response-time"),
            F.col("api_response_time").alias("api-response-time"),
        )
    )
    return bulk.bulk_lines(sent, "request", "traffic", document)


def resent(docs: DataFrame) -> DataFrame:
    """The failed requests again, with another status."""
    return request_feed(docs.where(F.col("endpoint") == views.FAILED_ENDPOINT), 599)


INGESTED = ["id", "day", "timestamp", "api", "endpoint", "method", "status", "response_time", "api_response_time"]


def ingested(rows: DataFrame) -> DataFrame:
    return rows.withColumn("timestamp", F.unix_millis("ts")).select(*INGESTED)


@registered
def bulk_parse(spark, sf_dir):
    """A feed in which the failed requests come twice: the later one is kept."""
    docs = views.requests(spark, sf_dir)
    place = lambda turn: F.struct(F.lit(turn).alias("turn"))
    feed = request_feed(docs).withColumn("place", place(1)).unionByName(resent(docs).withColumn("place", place(2)))
    return ingested(bulk.typed_rows(bulk.last_actions(bulk.parse_bulk(feed)), "request"))


@registered
def bulk_ingest(spark, sf_dir):
    """Two bulk files written, read and upserted one after the other."""
    docs, folder = views.requests(spark, sf_dir), passing_folder(spark)
    store = GatewayStore(spark, f"{folder}/store")
    for turn, feed in (("1", request_feed(docs)), ("2", resent(docs))):
        feed.write.text(f"{folder}/feed-{turn}")
        store.ingest(f"{folder}/feed-{turn}")
    return ingested(store.documents("request"))


@registered
def bulk_ingest_rejects(spark, sf_dir):
    """A feed with bad records among good ones, and with spaces in its actions: bad ones are counted per reason."""
    docs, folder = views.requests(spark, sf_dir), passing_folder(spark)
    store = GatewayStore(spark, f"{folder}/store")
    feed = request_feed(docs).withColumn("n", F.monotonically_increasing_id())
    action, document = F.element_at(F.split("value", "\n"), 1), F.element_at(F.split("value", "\n"), 2)
    event = F.regexp_extract("value", '"_id":"([0-9]+)"', 1).cast("bigint")
    action = F.when(event % 11 == 0, F.regexp_replace(action, '"_id":"[0-9]+"', '"x":1')).otherwise(action)
    action = F.when(event % 13 == 0, F.regexp_replace(action, '"request"', '"other"')).otherwise(action)
    document = F.when(event % 17 == 0, F.regexp_replace(document, '"status":[0-9]+', '"status":70000')).otherwise(document)
    document = F.when(event % 19 == 0, F.regexp_replace(document, '"@timestamp":"[^"]*"', '"@timestamp":"soon"')).otherwise(document)
    spaced = F.regexp_replace(action, r'^\{"index":', '{ "index" : ')
    feed.select(F.concat(spaced, F.lit("\n"), document).alias("value")).write.text(f"{folder}/feed")
    store.ingest(f"{folder}/feed")
    stored = store.documents("request").agg(F.lit("stored").alias("reason"), F.count("*").alias("records"))
    return store.rejects().groupBy("reason").agg(F.count("*").alias("records")).unionByName(stored)


@registered
def stream_ingest(spark, sf_dir):
    """The same through the stream: a second file arrives, the query resumes."""
    docs, folder = views.requests(spark, sf_dir), passing_folder(spark)
    store = GatewayStore(spark, f"{folder}/store")
    for feed in (request_feed(docs), resent(docs)):
        feed.write.mode("append").text(f"{folder}/landing")
        store.start_ingest(f"{folder}/landing", f"{folder}/progress").awaitTermination()
    return ingested(store.documents("request"))


@registered
def stream_ingest_many_files(spark, sf_dir):
    """Files whose names sort against their arrival, taken two at a time and all at once: the last to arrive wins."""
    docs, folder = views.requests(spark, sf_dir), passing_folder(spark)
    feed, again = request_feed(docs), resent(docs)
    for name, part in (("z-first", feed), ("a-second", again)):
        part.write.text(f"{folder}/landing/{name}")
    results = []
    for files in (2, 1_000):
        store = GatewayStore(spark, f"{folder}/store-{files}")
        store.start_ingest(f"{folder}/landing/*", f"{folder}/progress-{files}", max_files=files).awaitTermination()
        results.append(ingested(store.documents("request")).withColumn("max_files", F.lit(files)))
    return results[0].unionByName(results[1])


# --- the operations over an ingested store -----------------------------------

_stores: dict[tuple[str, str], str] = {}
FEED_RECORDS = 100_000  # per file of the feed; a compressed file is read by one task


def stored_documents(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "request": views.requests(spark, sf_dir),
        "log": views.logs(spark, sf_dir),
        "health": views.health(spark, sf_dir),
        "monitor": views.monitor(spark, sf_dir),
    }


def store_of_all(spark: SparkSession, sf_dir: str) -> GatewayStore:
    """All events as documents of all four types, sent as a bulk feed and ingested; once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stores:
        folder = passing_folder(spark)
        store = GatewayStore(spark, f"{folder}/store", codes=CODES)
        for doc_type, docs in stored_documents(spark, sf_dir).items():
            fields = []
            for field in DOCUMENT_FIELDS[doc_type]:
                if field == "@timestamp":
                    fields.append(F.date_format("ts", documents.TIMESTAMP_TEXT).alias(field))
                elif column_name(field) in docs.columns:
                    fields.append(F.col(column_name(field)).alias(field))
            feed = bulk.bulk_lines(views.with_day(docs), doc_type, "traffic", F.to_json(F.struct(*fields)))
            feed.write.option("maxRecordsPerFile", FEED_RECORDS).text(f"{folder}/feed/{doc_type}", compression="gzip")
        store.ingest(*[f"{folder}/feed/{doc_type}" for doc_type in DOCUMENT_FIELDS])
        _stores[key] = store.root
    return GatewayStore(spark, _stores[key], codes=CODES)


@registered
def store_count(spark, sf_dir):
    return store_of_all(spark, sf_dir).count(TEN_DAYS, root=ROOT, query="endpoint:click AND tenant:acme")


@registered
def store_histogram(spark, sf_dir):
    """The response in pieces, put together."""
    wanted = [analytics.avg("response-time"), analytics.avg("proxy-latency"), analytics.terms("endpoint")]
    store = store_of_all(spark, sf_dir)
    chunks = store.date_histogram(PAST_DATA, 6 * HOUR, wanted, query="endpoint:error")
    return flat_rows(shaping.joined_chunks(chunks), store.histogram_axis(PAST_DATA, 6 * HOUR).select(F.explode("timestamps")))


@registered
def store_group_by(spark, sf_dir):
    return store_of_all(spark, sf_dir).group_by("application", TEN_DAYS, query="api:api-1")


@registered
def store_tabular(spark, sf_dir):
    return store_of_all(spark, sf_dir).tabular(TEN_DAYS, page=3, size=25, root=ROOT)


FOUND = ["id", "method", "api_response_time", "client_request.uri", "client_request.body", "client_response.status"]


@registered
def store_find_requests(spark, sf_dir):
    """By a frame of ids: the payloads of the days found are read, no others."""
    found = store_of_all(spark, sf_dir).find_requests(ids_of(spark, sf_dir, "customer", "c_custkey"), strict=False)
    return found.select("day", *FOUND)


STORED_IDS = [str(n) for n in range(100, 1_000, 7)]


@registered
def store_find_requests_listed(spark, sf_dir):
    """By a list of ids, all of which must exist."""
    return store_of_all(spark, sf_dir).find_requests(STORED_IDS).select("day", *FOUND)


@registered
def store_availability(spark, sf_dir):
    return store_of_all(spark, sf_dir).availability("api-1", "ENDPOINT", now=NOW)


@registered
def store_response_time(spark, sf_dir):
    return store_of_all(spark, sf_dir).average_response_time("api-1", "endpoint", now=NOW)


@registered
def store_health_histogram(spark, sf_dir):
    wanted = [analytics.maximum("response-time"), analytics.minimum("response-time")]
    store = store_of_all(spark, sf_dir)
    chunks = store.health_histogram("api-1", TEN_DAYS, 6 * HOUR, wanted, now=NOW)
    return flat_rows(shaping.joined_chunks(chunks), store.health_axis("api-1", TEN_DAYS, 6 * HOUR, now=NOW).select(F.explode("timestamps")))


@registered
def store_health_logs(spark, sf_dir):
    return store_of_all(spark, sf_dir).health_logs("api-1", page=2, size=30, now=NOW)


@registered
def store_find_health(spark, sf_dir):
    found = store_of_all(spark, sf_dir).find_health(STORED_IDS)
    return found.withColumn("steps", F.size("steps"))


@registered
def store_latest(spark, sf_dir):
    return flat_load(store_of_all(spark, sf_dir).latest_per_gateway(NOW))


@registered
def store_all_types(spark, sf_dir):
    return store_of_all(spark, sf_dir).all_types().groupBy("doc_type").agg(
        F.count("*").alias("documents"),
        F.count("api").alias("with_api"),
        F.count("gateway").alias("with_gateway"),
        F.count("hostname").alias("with_hostname"),
    )


@registered
def store_missing_days(spark, sf_dir):
    """Named days of which one was never stored."""
    return per_day(store_of_all(spark, sf_dir).named_days("request", NAMED_DAYS))
