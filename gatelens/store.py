"""The twelve operations over a store of day-partitioned tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from gatelens.functions import time as t
from gatelens.operators import analytics, health, logs, monitoring
from gatelens.operators.shaping import assemble_dense, assemble_series, axis_chunks, response_fits, series_chunks
from gatelens.session import passing_folder
from gatelens.sources import bulk, tables
from gatelens.streaming.ingest import start_ingest


class GatewayStore:
    """Tables under one root, read per call, so new files are always seen.

    ``zone`` names the time zone whose days the tables are partitioned by and
    ``codes`` maps numeric method codes to names.
    """

    def __init__(
        self, spark: SparkSession, root: str, zone: str = "UTC", codes: Mapping[int, str] | None = None
    ):
        self.spark, self.root, self.zone, self.codes = spark, root, zone, codes

    # --- scans ---

    def documents(self, doc_type: str, time_range: t.TimeRange | None = None) -> DataFrame:
        """All days of a type, or the days a time range touches."""
        if time_range is None:
            return tables.scan(self.spark, self.root, doc_type)
        return tables.scan_span(self.spark, self.root, doc_type, *t.day_span(time_range, self.zone))

    def last_month(self, doc_type: str, now: int) -> DataFrame:
        return self.documents(doc_type, t.TimeRange(t.month_before(now, self.zone), now))

    def today(self, doc_type: str, now: int) -> DataFrame:
        return self.documents(doc_type, t.TimeRange(now, now))

    def named_days(self, doc_type: str, days: Iterable[str]) -> DataFrame:
        return tables.scan(self.spark, self.root, doc_type, days)

    def all_types(self, days: Iterable[str] | None = None) -> DataFrame:
        return tables.scan_all_types(self.spark, self.root, days)

    # --- analytics ---

    def count(self, time_range: t.TimeRange | None = None, default_scope: str = "all", now: int | None = None, **filters):
        now = t.current_millis() if now is None else now
        if time_range is None and default_scope == "today":
            docs = self.today("request", now)
        else:
            docs = self.documents("request", time_range)
        return analytics.count(docs, time_range, default_scope=default_scope, now=now, zone=self.zone, **filters)

    def date_histogram(self, time_range: t.TimeRange, interval: int, aggregations=(), **filters) -> DataFrame:
        """The requested series in pieces: ``slot, name, field, key, chunk_start, points``; see ``histogram_axis``."""
        docs = self.documents("request", time_range)
        points = analytics.date_histogram(docs, time_range, interval, aggregations, zone=self.zone, **filters)
        return series_chunks(points, aggregations, interval)

    def histogram_axis(self, time_range: t.TimeRange, interval: int) -> DataFrame:
        """The dense axis in pieces: ``chunk_start, timestamps``."""
        return axis_chunks(analytics.histogram_axis(self.spark, time_range, interval), interval)

    def date_histogram_response(self, time_range: t.TimeRange, interval: int, aggregations=(), **filters) -> DataFrame:
        """The same as one row, axis and a slot per requested series, for up to ``RESPONSE_POINTS`` points."""
        response_fits((time_range.end - time_range.start) // interval + 2, aggregations)
        docs = self.documents("request", time_range)
        points = analytics.date_histogram(docs, time_range, interval, aggregations, zone=self.zone, **filters)
        return assemble_series(points, analytics.histogram_axis(self.spark, time_range, interval), aggregations)

    def group_by(self, field: str, time_range: t.TimeRange, **options) -> DataFrame:
        return analytics.group_by(self.documents("request", time_range), field, time_range, zone=self.zone, **options)

    # --- request logs ---

    def tabular(self, time_range: t.TimeRange, page: int = 1, size: int = 20, **filters) -> DataFrame:
        docs = self.documents("request", time_range)
        return logs.tabular(docs, time_range, page, size, codes=self.codes, zone=self.zone, **filters)

    def find_requests(self, ids: DataFrame | Iterable[str], strict: bool = True) -> DataFrame:
        return logs.find_requests(self._parts("request"), self._parts("log"), ids, self.codes, strict)

    def tabular_pages(self, time_range: t.TimeRange, size: int = 20, **filters) -> logs.Pages:
        """All pages of one ordering; it is written to the shared folder once, and each page is a slice of it."""
        docs = self.documents("request", time_range)
        folder = f"{passing_folder(self.spark)}/pages"
        return logs.tabular_pages(docs, time_range, size, folder, codes=self.codes, zone=self.zone, **filters)

    def _parts(self, doc_type: str) -> DataFrame:
        """All days of a type with the part of each document, by which lookups prune."""
        return tables.scan_parts(self.spark, self.root, doc_type)

    # --- health checks ---

    def availability(self, api: str, field: str = "endpoint", now: int | None = None, **options) -> DataFrame:
        now = t.current_millis() if now is None else now
        return health.availability(self.last_month("health", now), api, field, now=now, zone=self.zone, **options)

    def average_response_time(self, api: str, field: str = "endpoint", now: int | None = None, **options) -> DataFrame:
        now = t.current_millis() if now is None else now
        docs = self.last_month("health", now)
        return health.average_response_time(docs, api, field, now=now, zone=self.zone, **options)

    def health_histogram(
        self, api: str, time_range: t.TimeRange, interval: int, aggregations=(), now: int | None = None, **options
    ) -> DataFrame:
        """The requested series in pieces: ``slot, name, field, key, chunk_start, points``; see ``health_axis``."""
        dense = self._health_dense(api, time_range, interval, aggregations, now, options)
        return series_chunks(health.health_points(dense, aggregations), aggregations, interval)

    def health_axis(self, api: str, time_range: t.TimeRange, interval: int, now: int | None = None, **options) -> DataFrame:
        """The dense axis in pieces: ``chunk_start, timestamps``."""
        return axis_chunks(self._health_dense(api, time_range, interval, (), now, options), interval)

    def health_histogram_response(
        self, api: str, time_range: t.TimeRange, interval: int, aggregations=(), now: int | None = None, **options
    ) -> DataFrame:
        """The same as one row; its axis covers the bounds and a month of days, for up to ``RESPONSE_POINTS`` points."""
        response_fits((time_range.end - time_range.start + t.days(health.MONTH_DAYS)) // interval + 2, aggregations)
        return assemble_dense(self._health_dense(api, time_range, interval, aggregations, now, options), aggregations)

    def _health_dense(self, api, time_range, interval, aggregations, now, options) -> DataFrame:
        now = t.current_millis() if now is None else now
        docs = self.last_month("health", now)
        return health.health_histogram_dense(docs, time_range, interval, aggregations, api, now=now, zone=self.zone, **options)

    def health_logs(self, api: str, page: int = 1, size: int = 20, now: int | None = None, **options) -> DataFrame:
        now = t.current_millis() if now is None else now
        return health.health_logs(self.last_month("health", now), api, page, size, now=now, zone=self.zone, **options)

    def find_health(self, ids: DataFrame | Iterable[str], strict: bool = True) -> DataFrame:
        return health.find_health(self._parts("health"), ids, strict)

    def health_log_pages(self, api: str, size: int = 20, now: int | None = None, **options) -> logs.Pages:
        """All pages of one ordering, as ``tabular_pages``."""
        now = t.current_millis() if now is None else now
        folder = f"{passing_folder(self.spark)}/pages"
        return health.health_log_pages(self.last_month("health", now), api, size, folder, now=now, zone=self.zone, **options)

    # --- monitoring ---

    def latest_snapshot(self, gateway: str, now: int | None = None) -> DataFrame:
        now = t.current_millis() if now is None else now
        return monitoring.latest_snapshot(self.today("monitor", now), gateway, now, self.zone)

    def latest_per_gateway(self, now: int | None = None) -> DataFrame:
        now = t.current_millis() if now is None else now
        return monitoring.latest_per_gateway(self.today("monitor", now), now, self.zone)

    # --- ingestion ---

    def ingest(self, *paths: str, on_error: str = "reject") -> list[str]:
        """Upserts bulk files, later paths over earlier ones; returns the document types they held.

        Bad records are set aside (see ``rejects``); with ``on_error="fail"`` one of them fails the batch.
        """
        return bulk.ingest(bulk.read_bulk(self.spark, *paths), self.root, on_error)

    def index(self, text: str, on_error: str = "reject") -> list[str]:
        """Upserts one bulk request given as a string."""
        return bulk.ingest(bulk.text_records(self.spark, text), self.root, on_error)

    def rejects(self) -> DataFrame | None:
        """Records that could not be stored: reason, place and text; None if there are none."""
        return bulk.rejects(self.spark, self.root)

    def start_ingest(self, landing: str, checkpoint: str, **options):
        return start_ingest(self.spark, landing, self.root, checkpoint, **options)
