"""Derived columns of the reporting tables, computed by joins over distinct values."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmart.functions import columns as X
from fleetmart.operators.lookups import domain_dimension, key_lookup, with_customer, with_support


@dataclass
class Lookups:
    """The small tables behind the derived columns."""

    customers: DataFrame
    domains: DataFrame
    versions: DataFrame
    support: DataFrame
    database_types: DataFrame

    def domain_names(self) -> DataFrame:
        return domain_dimension(self.domains, self.customers)


def with_server_columns(servers: DataFrame, lookups: Lookups, as_of: datetime) -> DataFrame:
    take = {"SQLMandantNameShort": "CustomerShortName", "SQLMandantName": "CustomerName"}
    named = with_customer(servers, "Domain", lookups.domain_names(), take, width=X.DOMAIN_WIDTH)
    dated = with_support(named, "Version", lookups.versions, lookups.support)
    return dated.select(
        "*",
        X.missing_days(F.col("NotFoundSince"), as_of).alias("NotFoundSinceDay"),
        X.build_path(F.col("Path")).alias("tempPath"),
    )


def with_computer_columns(computers: DataFrame, lookups: Lookups, as_of: datetime) -> DataFrame:
    take = {"SQLCustomer": "CustomerName"}
    named = with_customer(
        computers, "DomainDnsName", lookups.domain_names(), take, width=X.DOMAIN_WIDTH
    )
    days = X.missing_days(F.col("NotFoundSince"), as_of)
    return named.withColumn("NotFoundSinceDays", days)


def with_database_columns(databases: DataFrame, lookups: Lookups, as_of: datetime) -> DataFrame:
    typed = key_lookup(
        databases,
        "ManagedEntityTypeRowId",
        lookups.database_types,
        "ManagedEntityTypeRowId",
        {"DatabaseType": "ManagedEntityTypeSystemName"},
    )
    return typed.select(
        "*",
        X.missing_days(F.col("NotFoundSince"), as_of).alias("NotFoundSinceDays"),
        X.build_path(F.col("Path")).alias("tempPath"),
    )


def with_domain_counts(customers: DataFrame, domains: DataFrame) -> DataFrame:
    """Customers with their number of domains, 0 if none."""
    counts = domains.groupBy(F.col("CustomerId").alias("_id")).agg(F.count("*").alias("_n"))
    joined = customers.join(counts, customers["CustomerId"] == counts["_id"], "left")
    number = F.coalesce("_n", F.lit(0)).cast("int")
    return joined.withColumn("Domains", number).drop("_id", "_n")
