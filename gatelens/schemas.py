"""Declared field types of the four document types.

Each type has two faces: the JSON document as it arrives (dashed names, text
timestamps) and the table row (snake_case names, ``ts TIMESTAMP``, plus the
``id`` and ``day`` every row carries).  Nothing is ever inferred from data.
"""

from __future__ import annotations

from pyspark.sql import types as T

HEADERS = "map<string,array<string>>"
EXCHANGE_REQUEST = f"struct<uri:string,method:string,body:string,headers:{HEADERS}>"
EXCHANGE_RESPONSE = f"struct<status:int,body:string,headers:{HEADERS}>"
STEP = (
    f"struct<success:boolean,message:string,request:{EXCHANGE_REQUEST},"
    f"response:{EXCHANGE_RESPONSE},uri:string,method:string,status:int>"
)
POOL = "struct<max_in_bytes:bigint,peak_max_in_bytes:bigint,peak_used_in_bytes:bigint,used_in_bytes:bigint>"
COLLECTOR = "struct<collection_count:bigint,collection_time_in_millis:bigint>"

# Field names and types of the stored documents.
DOCUMENT_FIELDS: dict[str, dict[str, str]] = {
    "request": {
        "@timestamp": "string",
        "api": "string",
        "api-key": "string",
        "api-response-time": "int",
        "application": "string",
        "endpoint": "string",
        "gateway": "string",
        "hostname": "string",
        "local-address": "string",
        "message": "string",
        "method": "string",
        "plan": "string",
        "proxy-latency": "int",
        "remote-address": "string",
        "request-content-length": "int",
        "response-content-length": "int",
        "response-time": "int",
        "status": "smallint",
        "subscription": "string",
        "tenant": "string",
        "transaction": "string",
        "uri": "string",
        "user": "string",
        "client-request-headers": HEADERS,
        "client-response-headers": HEADERS,
        "proxy-request-headers": HEADERS,
        "proxy-response-headers": HEADERS,
    },
    "log": {
        "client-request": EXCHANGE_REQUEST,
        "client-response": EXCHANGE_RESPONSE,
        "proxy-request": EXCHANGE_REQUEST,
        "proxy-response": EXCHANGE_RESPONSE,
    },
    "health": {
        "@timestamp": "string",
        "api": "string",
        "available": "boolean",
        "endpoint": "string",
        "gateway": "string",
        "hostname": "string",
        "message": "string",
        "method": "string",
        "response-time": "int",
        "state": "int",
        "status": "smallint",
        "steps": f"array<{STEP}>",
        "success": "boolean",
        "url": "string",
    },
    "monitor": {
        "@timestamp": "string",
        "gateway": "string",
        "hostname": "string",
        "os": "struct<cpu:struct<load_average:map<string,double>,percent:bigint>,"
        "mem:struct<free_in_bytes:bigint,free_percent:bigint,total_in_bytes:bigint,"
        "used_in_bytes:bigint,used_percent:bigint>>",
        "process": "struct<max_file_descriptors:bigint,open_file_descriptors:bigint,timestamp:bigint>",
        "jvm": "struct<timestamp:bigint,uptime_in_millis:bigint,"
        "threads:struct<count:bigint,peak_count:bigint>,"
        f"gc:struct<collectors:struct<old:{COLLECTOR},young:{COLLECTOR}>>,"
        "mem:struct<heap_committed_in_bytes:bigint,heap_max_in_bytes:bigint,heap_used_in_bytes:bigint,"
        "heap_used_percent:bigint,non_heap_committed_in_bytes:bigint,non_heap_used_in_bytes:bigint,"
        f"pools:struct<old:{POOL},survivor:{POOL},young:{POOL}>>>",
    },
}

DOC_TYPES = tuple(DOCUMENT_FIELDS)

# How rows are laid out inside a day: the columns queries filter on come first,
# so Parquet row-group statistics can skip.
CLUSTERING = {
    "request": ("api", "ts"),
    "log": ("id",),
    "health": ("api", "ts"),
    "monitor": ("gateway", "ts"),
}


def column_name(field: str) -> str:
    """Table column of a document field: ``response-time`` -> ``response_time``."""
    return "ts" if field == "@timestamp" else field.replace("-", "_")


def document_ddl(doc_type: str) -> str:
    """Schema of the JSON document."""
    return ", ".join(f"`{name}` {kind}" for name, kind in DOCUMENT_FIELDS[doc_type].items())


def table_schema(doc_type: str) -> T.StructType:
    """Schema of the stored table; ``day`` is its partition column."""
    columns = ["id string"]
    for name, kind in DOCUMENT_FIELDS[doc_type].items():
        columns.append(f"{column_name(name)} {'timestamp' if name == '@timestamp' else kind}")
    columns.append("day string")
    return T.StructType.fromDDL(", ".join(columns))
