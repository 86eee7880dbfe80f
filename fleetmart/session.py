"""Session settings and the shared working folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


def build_session(app: str = "fleetmart", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's settings; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Where all written work tables lie, below the folder named in ``spark.checkpoint.dir``.

    Executors on other machines must reach it. A session that names none uses its warehouse, which
    they reach as well; the rule is the same in local mode and on a cluster.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/fleetmart"


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder for written tables."""
    return f"{shared_root(spark)}/{purpose}-{uuid.uuid4().hex}"
