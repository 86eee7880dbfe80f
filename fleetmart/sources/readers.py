"""Warehouse tables as DataFrames, from parquet or over JDBC."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from fleetmart.schemas import SOURCES, struct_of


def read_parquet(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A source table; declared columns keep their types, others are passed through."""
    found = spark.read.parquet(path)
    declared = {f.name: f.dataType for f in struct_of(name).fields}
    return found.select(
        *[found[c].cast(declared[c]).alias(c) if c in declared else found[c] for c in found.columns]
    )


def read_jdbc(
    spark: SparkSession,
    url: str,
    name: str,
    table: str,
    *,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
    column: str = "ManagedEntityRowId",
    **options: str,
) -> DataFrame:
    """A source table read in parallel ranges of its key (rows outside ``bounds`` included)."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    if bounds:
        reader = (
            reader.option("partitionColumn", column)
            .option("lowerBound", bounds[0])
            .option("upperBound", bounds[1])
            .option("numPartitions", partitions)
        )
    wanted = [f.name for f in struct_of(name).fields]
    return reader.options(**options).load().select(*wanted)


def type_catalogue(types: DataFrame) -> DataFrame:
    """The six listed columns of the entity-type catalogue."""
    return types.select(*[f.name for f in struct_of("ManagedEntityType").fields])


@dataclass
class Warehouse:
    """The warehouse tables a refresh reads."""

    entities: DataFrame
    properties: DataFrame
    dictionary: DataFrame
    alerts: DataFrame
    windows: DataFrame

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str) -> Warehouse:
        names = [
            "ManagedEntity",
            "ManagedEntityProperty",
            "ManagedEntityTypeProperty",
            "AlertDetail",
            "MaintenanceModeHistory",
        ]
        assert set(names) <= set(SOURCES)
        return cls(*[read_parquet(spark, f"{root}/{n}", n) for n in names])
