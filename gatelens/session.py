"""Session settings the engine is designed for; a cluster's own settings win."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Parquet timestamps with statistics, so time ranges skip row groups.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # Lists of ids reach the Parquet bloom filters up to this length.
    "spark.sql.parquet.pushdown.inFilterThreshold": "1000",
    # Terms per bucket are limited before the shuffle up to this many.
    "spark.sql.optimizer.windowGroupLimitThreshold": "100000",
}


def session(app: str = "gatelens", **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str | None:
    """The folder all executors reach, as the cluster names it."""
    return spark.conf.get("spark.checkpoint.dir", None)


def passing_folder(spark: SparkSession) -> str:
    """A new folder under the one all executors share, removed when the application ends.

    Where the cluster names none, a local master uses the machine's temporary folder.
    """
    shared = shared_folder(spark)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor reaches")
        shared = tempfile.gettempdir()
    folder = f"{shared.rstrip('/')}/gatelens-{uuid.uuid4().hex}"
    target = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(target)
    files.deleteOnExit(target)
    return folder
