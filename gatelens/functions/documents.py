"""Projections of stored documents to the rows a user sees."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatelens.schemas import DOCUMENT_FIELDS, EXCHANGE_REQUEST, EXCHANGE_RESPONSE, column_name, document_ddl

# Fixed value: text form in which gateways write a document's timestamp.
TIMESTAMP_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"


def read_timestamp(text: Column) -> Column:
    """TIMESTAMP of ISO text or of epoch milliseconds, to the millisecond; null for anything else.

    Text without an offset is UTC, whatever the session zone is.
    """
    iso = text.rlike(r"^\d{4}-\d\d-\d\d(T\d\d:\d\d:\d\d([.]\d+)?(Z|[+-]\d\d:?\d\d)?)?$")
    rest = F.substr(text, F.lit(11))  # what follows the date of such a text
    zoned = F.contains(rest, F.lit("Z")) | F.contains(rest, F.lit("+")) | F.contains(rest, F.lit("-"))
    missing = F.when(~F.contains(text, F.lit("T")), F.lit("T00:00:00Z")).when(zoned, F.lit("")).otherwise(F.lit("Z"))
    millis = (
        F.when(iso, F.unix_millis(F.concat(text, missing).try_cast("timestamp")))
        .when(text.rlike(r"^-?\d+$"), text.try_cast("bigint"))
    )
    return F.timestamp_millis(millis)


def parse_timestamp(text: Column) -> Column:
    """The same; bad text fails the query.

    The failure is raised here and not left to ANSI mode, so a session that
    switched it off does not silently store nulls.
    """
    parsed = read_timestamp(text)
    message = F.concat(F.lit("not a timestamp: "), text)
    return F.when(text.isNotNull() & parsed.isNull(), F.raise_error(message)).otherwise(parsed)


UNREADABLE = "_unreadable"


def from_document(doc_type: str, source: Column) -> Column:
    """Typed struct of a JSON document; a malformed one fails the query."""
    return F.from_json(source, document_ddl(doc_type), {"mode": "FAILFAST"})


def try_document(doc_type: str, source: Column) -> Column:
    """Typed struct of a JSON document; of a malformed one the text is in the field ``UNREADABLE``."""
    schema = f"{document_ddl(doc_type)}, `{UNREADABLE}` string"
    return F.from_json(source, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": UNREADABLE})


def table_columns(doc_type: str, document: str, stamp: Column | None = None) -> list[Column]:
    """Table columns out of the typed document struct; ``stamp`` is its timestamp where that has been read already."""
    columns = []
    for field in DOCUMENT_FIELDS[doc_type]:
        value = F.col(f"{document}.`{field}`")
        if field == "@timestamp":
            value = parse_timestamp(value) if stamp is None else stamp
        elif (doc_type, field) == ("health", "steps"):
            value = F.coalesce(value, single_step(document))
        columns.append(value.alias(column_name(field)))
    return columns


def single_step(document: str) -> Column:
    """The one step of an old health document, which named its target ``url``."""
    part = lambda field: F.col(f"{document}.`{field}`")
    step = F.struct(
        part("success").alias("success"),
        part("message").alias("message"),
        F.lit(None).cast(EXCHANGE_REQUEST).alias("request"),
        F.lit(None).cast(EXCHANGE_RESPONSE).alias("response"),
        part("url").alias("uri"),
        part("method").alias("method"),
        part("status").cast("int").alias("status"),
    )
    return F.when(part("url").isNotNull(), F.array(step))


def headers_map(text: Column) -> Column:
    """JSON object of arrays -> multimap."""
    return F.from_json(text, "map<string,array<string>>")


def decode_method(method: Column, codes: Mapping[int, str] | None) -> Column:
    """Method name: numeric codes by lookup (unknown ones null), text as it is.

    The code list is the caller's and a handful of entries, so it travels inside
    the expression: no join, no broadcast.
    """
    if not codes:
        return method
    table = F.create_map(*[F.lit(part) for code, name in codes.items() for part in (str(code), name)])
    return F.when(method.rlike("^[0-9]+$"), F.try_element_at(table, method)).otherwise(method)


def zero_default(name: str) -> Column:
    return F.coalesce(F.col(name).cast("bigint"), F.lit(0).cast("bigint")).alias(name)


def request_columns(codes: Mapping[int, str] | None = None) -> list[Column]:
    """The twenty columns of a request log."""
    return [
        F.col("id"),
        F.col("transaction"),
        F.col("gateway"),
        F.unix_millis("ts").alias("timestamp"),
        F.col("uri"),
        decode_method(F.col("method"), codes).alias("method"),
        F.col("status").cast("int").alias("status"),
        F.col("response_time").cast("bigint").alias("response_time"),
        zero_default("api_response_time"),
        zero_default("request_content_length"),
        zero_default("response_content_length"),
        F.col("local_address"),
        F.col("remote_address"),
        F.col("tenant"),
        F.col("application"),
        F.col("api"),
        F.col("plan"),
        F.col("api_key"),
        F.col("endpoint"),
        F.col("message"),
    ]


EXCHANGES = ("client_request", "proxy_request", "client_response", "proxy_response")



def step_request(step: Column) -> Column:
    """A step's request; steps of the old shape hold uri and method themselves."""
    own = F.struct(
        step["uri"].alias("uri"),
        F.upper(step["method"]).alias("method"),
        F.lit(None).cast("string").alias("body"),
        F.lit(None).cast("map<string,array<string>>").alias("headers"),
    )
    return F.coalesce(step["request"], own)


def step_response(step: Column) -> Column:
    own = F.struct(
        step["status"].alias("status"),
        F.lit(None).cast("string").alias("body"),
        F.lit(None).cast("map<string,array<string>>").alias("headers"),
    )
    return F.when(step["request"].isNull(), own).otherwise(step["response"])


def health_columns() -> list[Column]:
    """Health log columns; uri, method and status come from the first step."""
    first = F.try_element_at(F.col("steps"), F.lit(1))
    request, response = step_request(first), step_response(first)
    return [
        F.col("id"),
        F.col("gateway"),
        F.unix_millis("ts").alias("timestamp"),
        F.col("endpoint"),
        F.col("response_time").cast("bigint").alias("response_time"),
        F.col("available"),
        F.col("state").cast("int").alias("state"),
        F.col("success"),
        F.when(first.isNotNull(), request["uri"]).alias("uri"),
        F.when(first.isNotNull(), F.upper(request["method"])).alias("method"),
        F.when(first.isNotNull(), response["status"]).alias("status"),
    ]


def health_steps() -> Column:
    """All steps in the one shape ``{success, message, request, response}``."""
    return F.transform(
        F.col("steps"),
        lambda step: F.struct(
            step["success"].alias("success"),
            step["message"].alias("message"),
            step_request(step).alias("request"),
            step_response(step).alias("response"),
        ),
    )


def extended_health_columns() -> list[Column]:
    kept = ("id", "gateway", "timestamp", "endpoint", "response_time", "available", "state", "success")
    columns = dict(zip(kept, health_columns()))
    return [*columns.values(), health_steps().alias("steps")]


# Flat monitoring columns and where each sits in the document.
MONITORING_FIELDS = {
    "os_cpu_percent": "os.cpu.percent",
    "os_cpu_load_average": "os.cpu.load_average",
    "os_mem_used_in_bytes": "os.mem.used_in_bytes",
    "os_mem_free_in_bytes": "os.mem.free_in_bytes",
    "os_mem_total_in_bytes": "os.mem.total_in_bytes",
    "os_mem_used_percent": "os.mem.used_percent",
    "os_mem_free_percent": "os.mem.free_percent",
    "jvm_process_open_file_descriptors": "process.open_file_descriptors",
    "jvm_process_max_file_descriptors": "process.max_file_descriptors",
    "jvm_uptime_in_millis": "jvm.uptime_in_millis",
    "jvm_timestamp": "jvm.timestamp",
    "jvm_heap_committed_in_bytes": "jvm.mem.heap_committed_in_bytes",
    "jvm_heap_used_percent": "jvm.mem.heap_used_percent",
    "jvm_heap_max_in_bytes": "jvm.mem.heap_max_in_bytes",
    "jvm_heap_used_in_bytes": "jvm.mem.heap_used_in_bytes",
    "jvm_non_heap_committed_in_bytes": "jvm.mem.non_heap_committed_in_bytes",
    "jvm_non_heap_used_in_bytes": "jvm.mem.non_heap_used_in_bytes",
    **{
        f"jvm_mem_pool_{pool}_{counter}": f"jvm.mem.pools.{pool}.{counter}"
        for pool in ("young", "old", "survivor")
        for counter in ("used_in_bytes", "peak_used_in_bytes", "max_in_bytes", "peak_max_in_bytes")
    },
    "jvm_thread_count": "jvm.threads.count",
    "jvm_thread_peak_count": "jvm.threads.peak_count",
    **{
        f"jvm_gc_collectors_{collector}_{counter}": f"jvm.gc.collectors.{collector}.{counter}"
        for collector in ("young", "old")
        for counter in ("collection_count", "collection_time_in_millis")
    },
}


def monitoring_columns() -> list[Column]:
    """Flat snapshot: 37 scalars, counters widened to BIGINT, and the load map."""
    columns = [F.col("gateway").alias("gateway_id"), F.unix_millis("ts").alias("timestamp"), F.col("hostname")]
    for name, path in MONITORING_FIELDS.items():
        value = F.col(path) if name == "os_cpu_load_average" else F.col(path).cast("bigint")
        columns.append(value.alias(name))
    return columns


def drop_payloads(docs: DataFrame) -> DataFrame:
    """Without the client and proxy payload columns, for tabular pages."""
    return docs.drop(*[name for name in docs.columns if name.startswith(("client_", "proxy_re"))])
