"""The four document types as views over an ``events`` table.

    event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, value DOUBLE, props STRING

Every event is taken as a gateway request, a payload log (where the endpoint logs
payloads), a health check and a monitoring sample.  Views are plain projections,
so filters on ``ts`` and column pruning reach the events scan.  ``day`` is only
derived where a query needs it as a column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gatelens.functions.documents import headers_map
from gatelens.functions.time import day_of
from gatelens.schemas import EXCHANGE_REQUEST, EXCHANGE_RESPONSE, STEP

# The schema is declared, so no file is opened for inference, and the wall-clock
# microseconds are read as UTC instants in any session time zone.
EVENTS = "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"

UNLOGGED_ENDPOINT = "view"
FAILED_ENDPOINT = "error"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def text(prefix: str, value: Column) -> Column:
    return F.concat(F.lit(prefix), value.cast("string"))


def with_day(docs: DataFrame) -> DataFrame:
    return docs.withColumn("day", day_of(F.col("ts")))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    event, user, kind, value = F.col("event_id"), F.col("user_id"), F.col("event_type"), F.col("value")
    response_time = value.cast("int")
    api_response_time = F.when(kind != FAILED_ENDPOINT, (value / 2).cast("int"))
    return events(spark, sf_dir).select(
        event.cast("string").alias("id"),
        "ts",
        text("tx-", event).alias("transaction"),
        text("api-", user % 5).alias("api"),
        text("app-", user).alias("application"),
        kind.alias("endpoint"),
        text("gw-", user % 3).alias("gateway"),
        (event % 4).cast("string").alias("method"),
        (100 * (1 + event % 5) + event % 3).cast("smallint").alias("status"),
        response_time.alias("response_time"),
        api_response_time.alias("api_response_time"),
        (response_time - api_response_time).alias("proxy_latency"),
        F.length("props").alias("request_content_length"),
        F.when(kind != FAILED_ENDPOINT, (value * 10).cast("int")).alias("response_content_length"),
        text("/", kind).alias("uri"),
        text("10.0.0.", user % 3).alias("local_address"),
        text("192.168.0.", user % 200).alias("remote_address"),
        F.when(user % 2 == 0, F.lit("acme")).alias("tenant"),
        text("plan-", user % 4).alias("plan"),
        F.lit(None).cast("string").alias("api_key"),
        F.when(kind == FAILED_ENDPOINT, F.col("props")).alias("message"),
    )


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads of the endpoints that log them; the others have no row here."""
    user, kind, value = F.col("user_id"), F.col("event_type"), F.col("value")
    headers = F.create_map(F.lit("X-User"), F.array(user.cast("string")))
    status = (100 * (1 + F.col("event_id") % 5) + F.col("event_id") % 3).cast("int")
    client_request = F.struct(
        text("/", kind).alias("uri"),
        F.lit("GET").alias("method"),
        F.col("props").alias("body"),
        headers.alias("headers"),
    )
    answer = F.struct(
        status.alias("status"),
        F.lit(None).cast("string").alias("body"),
        headers_map(F.concat(F.lit('{"X-Size":["'), (value * 10).cast("int").cast("string"), F.lit('"]}'))).alias("headers"),
    )
    return (
        events(spark, sf_dir)
        .where(kind != UNLOGGED_ENDPOINT)
        .select(
            F.col("event_id").cast("string").alias("id"),
            "ts",
            client_request.alias("client_request"),
            F.lit(None).cast(EXCHANGE_REQUEST).alias("proxy_request"),
            answer.alias("client_response"),
            F.lit(None).cast(EXCHANGE_RESPONSE).alias("proxy_response"),
        )
    )


def health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks with new-shape, old-shape and no steps."""
    event, user, kind, value = F.col("event_id"), F.col("user_id"), F.col("event_type"), F.col("value")
    available = value < 100
    status = F.when(available, 200).otherwise(503)
    headers = F.lit(None).cast("map<string,array<string>>")
    body = F.lit(None).cast("string")

    def step(shape: str) -> Column:
        new = shape == "new"
        request = F.struct(
            text("/", kind).alias("uri"), F.lit("GET").alias("method"), body.alias("body"), headers.alias("headers")
        )
        response = F.struct(status.alias("status"), F.col("props").alias("body"), headers.alias("headers"))
        return F.struct(
            available.alias("success"),
            F.when(~available, F.lit("too slow")).alias("message"),
            (request if new else F.lit(None).cast(EXCHANGE_REQUEST)).alias("request"),
            (response if new else F.lit(None).cast(EXCHANGE_RESPONSE)).alias("response"),
            F.lit(None if new else "/probe").cast("string").alias("uri"),
            F.lit(None if new else "get").cast("string").alias("method"),
            (F.lit(None) if new else status).cast("int").alias("status"),
        )

    steps = F.when(event % 3 == 0, F.array(step("new"))).when(event % 3 == 1, F.array(step("old"), step("old")))
    return events(spark, sf_dir).select(
        event.cast("string").alias("id"),
        "ts",
        text("api-", user % 5).alias("api"),
        kind.alias("endpoint"),
        text("gw-", user % 3).alias("gateway"),
        value.cast("int").alias("response_time"),
        available.alias("available"),
        available.alias("success"),
        (event % 3).cast("int").alias("state"),
        F.coalesce(steps, F.array().cast(f"array<{STEP}>")).alias("steps"),
    )


def monitor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples whose counters are multiples of ``value``."""
    event, user = F.col("event_id"), F.col("user_id")
    size = F.floor(F.col("value") * 100).cast("bigint")

    def counters(**factors: int) -> Column:
        return F.struct(*[(size * factor).alias(name) for name, factor in factors.items()])

    def pool(factor: int) -> Column:
        return counters(
            max_in_bytes=factor * 4, peak_max_in_bytes=factor * 5, peak_used_in_bytes=factor * 2, used_in_bytes=factor
        )

    load = F.create_map(F.lit("1m"), F.col("value"), F.lit("5m"), F.col("value") / 2, F.lit("15m"), F.col("value") / 4)
    os = F.struct(
        F.struct(load.alias("load_average"), (event % 100).alias("percent")).alias("cpu"),
        counters(
            free_in_bytes=3, free_percent=1, total_in_bytes=10, used_in_bytes=7, used_percent=2
        ).alias("mem"),
    )
    memory = F.struct(
        *[
            (size * factor).alias(name)
            for name, factor in (
                ("heap_committed_in_bytes", 20),
                ("heap_max_in_bytes", 21),
                ("heap_used_in_bytes", 22),
                ("heap_used_percent", 23),
                ("non_heap_committed_in_bytes", 24),
                ("non_heap_used_in_bytes", 25),
            )
        ],
        F.struct(pool(30).alias("old"), pool(40).alias("survivor"), pool(50).alias("young")).alias("pools"),
    )
    collectors = F.struct(
        counters(collection_count=60, collection_time_in_millis=61).alias("old"),
        counters(collection_count=62, collection_time_in_millis=63).alias("young"),
    )
    jvm = F.struct(
        F.unix_millis("ts").alias("timestamp"),
        (size * 70).alias("uptime_in_millis"),
        counters(count=71, peak_count=72).alias("threads"),
        F.struct(collectors.alias("collectors")).alias("gc"),
        memory.alias("mem"),
    )
    process = F.struct(
        (size * 80).alias("max_file_descriptors"),
        (size * 81).alias("open_file_descriptors"),
        F.unix_millis("ts").alias("timestamp"),
    )
    return events(spark, sf_dir).select(
        event.cast("string").alias("id"),
        "ts",
        text("gw-", user % 3).alias("gateway"),
        text("host-", user % 3).alias("hostname"),
        os.alias("os"),
        process.alias("process"),
        jvm.alias("jvm"),
    )
