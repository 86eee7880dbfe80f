"""Registration of the corpus queries, and the few things that all of them need."""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Callable
from datetime import timedelta
from functools import wraps
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmart.sources import files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the workers this library, once per application, so that they need no path to it of their own."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    top = Path(__file__).resolve().parent.parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
        for source in sorted(top.rglob("*.py")):
            archive.write(source, source.relative_to(top.parent))
    uri = f"{shared_folder(spark, 'code')}/{top.name}.zip"
    write_file(spark, uri, packed.getvalue())
    context.addPyFile(uri)
    _SHIPPED.add(context.applicationId)


def write_file(spark: SparkSession, uri: str, data: bytes) -> None:
    """Write a small file where all executors can read it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    try:
        out.write(bytearray(data))
    finally:
        out.close()


def query(key: str, oracle: str | None = None):
    """Register ``f(spark, folder)`` under a key, with SQL for the same rows where there is any."""

    def register(build: Callable[[SparkSession, str], DataFrame]):
        @wraps(build)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            ship(spark)
            return build(spark, folder)

        QUERIES[key] = run
        if oracle is not None:
            ORACLE[key] = oracle
        return build

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which the driver and all executors can reach.

    Where the setting is missing, as in a plain local session, the folder lies in the warehouse.
    """
    return f"{_work_root(spark)}/{purpose}-{uuid.uuid4().hex}"


def _work_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/fleetmart-llm"


def expire_work(spark: SparkSession, older_than: timedelta) -> int:
    """Delete the work folders of ended runs, those last written before that time; how many there were.

    Staged frames, lexicons, shipped code and the queries' ledgers lie there, so it should exceed the longest application. A
    lasting ledger belongs elsewhere.
    """
    return files.expire_work(spark, older_than, _work_root(spark))


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """The frame, written to the shared folder and read again: computed once, safe against lost executors."""
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))
