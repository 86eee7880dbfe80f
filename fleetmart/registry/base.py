"""Registration of queries with their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

TABLES = "region nation customer supplier part orders lineitem events".split()
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


SCHEMAS: dict[str, StructType] = {}


class Tables:
    """The given tables of one folder, as frames or inside SQL text."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        path = f"{self.folder}/{name}.parquet"
        # Reading the schema from the files takes a job, so it is done once per file.
        if path not in SCHEMAS:
            SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(SCHEMAS[path]).parquet(path)

    def sql(self, text: str) -> DataFrame:
        """Run SQL in which ``{orders}`` stands for a given table."""
        for name in TABLES:
            if "{" + name + "}" in text:
                getattr(self, name).createOrReplaceTempView(f"given_{name}")
                text = text.replace("{" + name + "}", f"given_{name}")
        return self.spark.sql(text)


def plain(text: str) -> str:
    """The same SQL for the checking engine, where the tables are views."""
    for name in TABLES:
        text = text.replace("{" + name + "}", name)
    return text.replace("TIMESTAMP_NTZ", "TIMESTAMP")


def query(key: str, oracle: str | None = None):
    """Register a function of :class:`Tables` under a key, with SQL for the same result."""

    def register(build: Callable[[Tables], DataFrame]):
        if key in QUERIES:
            raise ValueError(f"{key} is registered twice")
        QUERIES[key] = lambda spark, folder: build(Tables(spark, folder))
        if oracle is not None:
            ORACLE[key] = plain(oracle)
        return build

    return register


def second(c: Column | str) -> Column:
    """Timestamp as text to the second, independent of the session's zone."""
    return F.left((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(19))


def shown(df: DataFrame, *times: str) -> DataFrame:
    """The frame with the named timestamps as text."""
    return df.select(*[second(c).alias(c) if c in times else F.col(c) for c in df.columns])
