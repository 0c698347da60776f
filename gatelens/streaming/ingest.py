"""Bulk files of a landing folder, upserted as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from gatelens.sources.bulk import ACTION, ingest, located, placed, separator


def start_ingest(
    spark: SparkSession,
    landing: str,
    root: str,
    checkpoint: str,
    max_files: int = 1_000,
    trigger: dict | None = None,
    opening: str = ACTION,
    on_error: str = "reject",
) -> StreamingQuery:
    """Starts the stream; each micro-batch is one upsert.

    Files are taken, and within a batch ordered, by their age, so the later file
    wins however many a batch takes.  A batch replayed after a failure writes the
    same rows again, which an upsert by id does not notice. ``opening`` is how the
    producer's actions begin; others are understood too, but files aren't cut at
    them for reading. Bad records are set aside, and the stream goes on.
    """
    records = located(
        spark.readStream.format("text")
        .option("lineSep", separator(opening))
        .option("maxFilesPerTrigger", max_files)
        .load(landing)
    )

    def upsert_batch(batch: DataFrame, _: int) -> None:
        ingest(placed(batch, opening), root, on_error)

    return (
        records.writeStream.foreachBatch(upsert_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
