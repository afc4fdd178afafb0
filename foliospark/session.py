"""Session settings and the shared work folder."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every cluster should run the library with. None depends on the data size: AQE sizes
# the shuffle partitions from what was written and splits skewed join partitions.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Repeated keys in a saved state file: the last one counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Python workers get batches bounded in bytes: rows here are whole texts.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
}


def build_session(master: str | None = None, app_name: str = "foliospark", **extra: str):
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def shuffles_freed(spark: SparkSession):
    """Within, the shuffle files of each query go when it ends, not when the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder the cluster names in ``spark.checkpoint.dir``.

    Where that setting is missing, below the session's warehouse, which is shared as well.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/work"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
