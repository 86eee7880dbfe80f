"""The three inventories and the two histories: what each refresh step reads and writes."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmart.functions import columns as X
from fleetmart.operators import events as E
from fleetmart.operators.joins import active_types, exclude_names, of_types, only_known, same_name
from fleetmart.operators.properties import current_only
from fleetmart.operators.sync import keep_first, sync_snapshot, update_from

OS_TYPE = 62  # fixed value: entity type of an operating system


def change_counts(properties: DataFrame) -> DataFrame:
    """Per entity: number of property versions, whether one is current, and since when.

    One aggregate over the history instead of a join that fans out and a count beside it.
    """
    current = F.col("ToDateTime").isNull()
    return properties.groupBy("ManagedEntityRowId").agg(
        F.count("*").alias("Changes"),
        F.max(current).alias("_current"),
        F.max(F.when(current, F.col("DWCreatedDateTime"))).alias("_created"),
    )


def server_source(
    entities: DataFrame, properties: DataFrame, types: DataFrame, changes: DataFrame | None = None
) -> DataFrame:
    """Servers to list: entities of an active type that have a current property version.

    ``changes`` are the ``change_counts`` of the properties, where they have been counted before.
    """
    wanted = of_types(entities, active_types(types, "Aktiv")).drop("DWCreatedDateTime")
    facts = (change_counts(properties) if changes is None else changes).where("_current")
    return wanted.join(facts, "ManagedEntityRowId").select(
        "ManagedEntityRowId",
        "TopLevelHostManagedEntityRowId",
        "ManagedEntityDefaultName",
        "FullName",
        X.entity_path(F.col("FullName"), X.NAME_WIDTH).alias("Path"),
        X.machine_of(F.col("Name"), width=X.NAME_WIDTH).alias("Maschine"),
        X.domain_of(F.col("FullName"), X.NAME_WIDTH).alias("Domain"),
        X.minute_of(F.col("_created")).alias("DWCreatedDateTime"),
        F.col("Changes").cast("int").alias("Changes"),
    )


def sync_servers(
    target: DataFrame, source: DataFrame, as_of: datetime, match_host: bool = False, **options
) -> DataFrame:
    """``match_host`` compares the stored entity id with the source's *host* id, the
    original rule; such rows never find themselves again when the two differ."""
    return sync_snapshot(
        target,
        source,
        key="ManagedEntityRowId",
        match_on="TopLevelHostManagedEntityRowId" if match_host else None,
        as_of=as_of,
        defaults={"Inserted": X.moment(as_of), "IsSCOM": F.lit(True)},
        **options,
    )


def computer_source(entities: DataFrame, types: DataFrame, servers: DataFrame) -> DataFrame:
    """Computers that host a listed server."""
    wanted = of_types(entities, active_types(types))
    hosts = same_name(wanted, "Name", servers, "Maschine")
    return hosts.select(
        "ManagedEntityRowId",
        "TopLevelHostManagedEntityRowId",
        "Path",
        "FullName",
        "DisplayName",
        X.machine_of(F.col("Name"), width=X.NAME_WIDTH).alias("Maschine"),
        "ManagedEntityTypeRowId",
        "ManagedEntityDefaultName",
        X.minute_of(F.col("DWCreatedDateTime")).alias("DWCreatedDateTime"),
    )


def sync_computers(target: DataFrame, source: DataFrame, as_of: datetime, **options) -> DataFrame:
    synced = sync_snapshot(
        target,
        source,
        key="ManagedEntityRowId",
        as_of=as_of,
        defaults={"Inserted": X.moment(as_of), "IsSCOM": F.lit(False)},
        **options,
    )
    return keep_first(synced, ["ManagedEntityRowId"], ["ID"])


def update_os(computers: DataFrame, entities: DataFrame, os_type: int = OS_TYPE) -> DataFrame:
    """Operating system of a computer: the entity of that type on the same host, the one with the
    highest id if there are several."""
    systems = entities.where(F.col("ManagedEntityTypeRowId") == os_type)
    named = systems.groupBy("TopLevelHostManagedEntityRowId").agg(
        F.max(F.struct("ManagedEntityRowId", "ManagedEntityDefaultName")).alias("_row")
    )
    names = named.select(
        "TopLevelHostManagedEntityRowId", F.col("_row.ManagedEntityDefaultName").alias("os")
    )
    host = "TopLevelHostManagedEntityRowId"
    return update_from(computers, names, on=host, values_key=host, set_cols={"WindowsOS": "os"})


def database_source(
    entities: DataFrame,
    properties: DataFrame,
    types: DataFrame,
    excluded: DataFrame,
    changes: DataFrame | None = None,
) -> DataFrame:
    """Databases to list: active types with a current property version, system names left out.

    ``changes`` are the ``change_counts`` of the properties, where they have been counted before.
    """
    wanted = of_types(entities, active_types(types, "Aktive"))
    versions = current_only(properties) if changes is None else changes.where("_current")
    current = versions.select("ManagedEntityRowId").distinct()
    live = wanted.join(current, "ManagedEntityRowId", "left_semi")
    return exclude_names(live, "DisplayName", excluded).select(
        "ManagedEntityRowId",
        "TopLevelHostManagedEntityRowId",
        X.database_path(F.col("Path")).alias("Path"),
        "ManagedEntityTypeRowId",
        "DisplayName",
    )


def sync_databases(target: DataFrame, source: DataFrame, as_of: datetime, **options) -> DataFrame:
    return sync_snapshot(
        target,
        source,
        key="ManagedEntityRowId",
        as_of=as_of,
        modified_col="Modified",
        defaults={"Inserted": X.moment(as_of)},
        **options,
    )


def repair_paths(databases: DataFrame, servers: DataFrame) -> DataFrame:
    """Path of a database from its server; if a server is listed twice, from its first row."""
    first = keep_first(
        servers.select("ManagedEntityRowId", "ID", "Path"), ["ManagedEntityRowId"], ["ID"]
    )
    return update_from(
        databases,
        first,
        on="TopLevelHostManagedEntityRowId",
        values_key="ManagedEntityRowId",
        set_cols={"Path": "Path"},
    )


def alert_source(details: DataFrame, known: DataFrame) -> DataFrame:
    """Alerts of known entities with readable codes."""
    return only_known(details, known).select(
        X.guid_key(F.col("AlertGuid")).alias("AlertGuid"),
        "ManagedEntityRowId",
        "Category",
        F.col("MonitoringObjectDisplayName").alias("DisplayName"),
        F.col("AlertName").alias("Alertname"),
        "AlertDescription",
        "RaisedDateTime",
        X.severity_label(F.col("Severity")).alias("Severity"),
        X.priority_label(F.col("Priority")).alias("Priority"),
        "RepeatCount",
    )


def plan_alerts(
    history: DataFrame, source: DataFrame, as_of: datetime, days: int = E.ALERT_DAYS, **options
) -> DataFrame:
    return E.plan_upsert(history, source, as_of=as_of, days=days, **{**E.ALERT_RULES, **options})


def maintenance_source(windows: DataFrame, entities: DataFrame, computers: DataFrame) -> DataFrame:
    """Maintenance windows of known computers, named after their entity."""
    names = entities.select("ManagedEntityRowId", "ManagedEntityDefaultName")
    known = only_known(windows, computers)
    return known.join(names, "ManagedEntityRowId").select(
        F.col("MaintenanceModeRowId").alias("MaintenanceRowId"),
        "ManagedEntityRowId",
        F.col("ManagedEntityDefaultName").alias("DisplayName"),
        "StartDateTime",
        "EndDateTime",
        "ScheduledEndDateTime",
        "UserId",
        F.col("Comments").alias("Comment"),
    )


def plan_maintenance(
    history: DataFrame,
    source: DataFrame,
    as_of: datetime,
    days: int = E.MAINTENANCE_DAYS,
    **options,
) -> DataFrame:
    rules = {**E.MAINTENANCE_RULES, **options}
    return E.plan_upsert(history, source, as_of=as_of, days=days, **rules)


def kept_rows(planned: DataFrame) -> DataFrame:
    """The history a planned load leaves behind."""
    return planned.where(F.col("_action") != E.PURGED).drop("_action")
