"""The whole refresh: ten steps in order, one commit at the end."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmart.functions.columns import VALUE_WIDTH
from fleetmart.operators import evolve
from fleetmart.operators.events import ALERT_DAYS, MAINTENANCE_DAYS
from fleetmart.operators.joins import active_types, known_entities
from fleetmart.operators.joins import staged as written_once
from fleetmart.operators.properties import current_only, named, shred, writable_columns, write_back
from fleetmart.plans import inventory as I
from fleetmart.plans.histories import load_history
from fleetmart.schemas import DERIVED, PROTECTED, struct_of
from fleetmart.sources.commitlog import AppendedTable
from fleetmart.sources.readers import Warehouse
from fleetmart.sources.snapshots import Snapshots

INVENTORIES = ["SQLServer", "Computer", "SQLDatabase"]


@dataclass
class TypeTables:
    """Entity types to follow, and database names to leave out."""

    servers: DataFrame
    computers: DataFrame
    databases: DataFrame
    excluded: DataFrame

    def settled(self) -> TypeTables:
        """The same tables, computed once for the several steps that read them."""
        tables = (self.servers, self.computers, self.databases, self.excluded)
        return TypeTables(*[written_once(df.distinct()) for df in tables])

    def active(self) -> dict[str, DataFrame]:
        return {
            "SQLServer": active_types(self.servers, "Aktiv"),
            "Computer": active_types(self.computers),
            "SQLDatabase": active_types(self.databases, "Aktive"),
        }


class Journal:
    """Steps that a run has ended, with what came out of each: staged paths, columns, counts.

    An entry belongs to a run's tag and to the commit the run began at, so it counts only while that state is in force.
    """

    def __init__(self, store: Snapshots, run: str):
        self.run, self.base = run, store.last_commit()
        self._table = AppendedTable(store.spark, f"{store.root}/journal", "run string, base long, step string, outcome string")
        rows = [r for r in self._table.rows() if (r["run"], r["base"]) == (run, self.base)]
        self.ended: dict[str, dict] = {r["step"]: json.loads(r["outcome"]) for r in rows}

    def once(self, step: str, make: Callable[[], dict]) -> dict:
        """The outcome of a step, from the journal if it has ended before."""
        if step not in self.ended:
            outcome = make()
            self._table.append([(self.run, self.base, step, json.dumps(outcome))])
            self.ended[step] = outcome
        return self.ended[step]


@dataclass
class RefreshReport:
    commit: int = 0
    added: dict[str, list[str]] = field(default_factory=dict)
    failed: dict[str, list[str]] = field(default_factory=dict)
    metrics: dict[str, dict[str, int]] = field(default_factory=dict)


def new_columns(
    dictionary: DataFrame, types: TypeTables, targets: dict[str, DataFrame]
) -> dict[str, DataFrame]:
    """Columns each inventory lacks; derived columns count as present."""
    active = types.active()
    return {
        t: evolve.missing_columns(dictionary, active[t], t, [*targets[t].columns, *DERIVED[t]])
        for t in INVENTORIES
    }


def fillable(dictionary: DataFrame, targets: dict[str, DataFrame]) -> dict[str, list[str]]:
    """Columns of each inventory that the dictionary can fill; the others need no work."""
    columns = {
        t: writable_columns(df, [*PROTECTED, *DERIVED[t]]) for t, df in targets.items()
    }
    wanted = sorted({c.lower() for cols in columns.values() for c in cols})
    names = dictionary.select(F.lower("PropertySystemName").alias("name"))
    listed = {r["name"] for r in names.where(F.col("name").isin(wanted)).distinct().collect()}
    return {t: [c for c in cols if c.lower() in listed] for t, cols in columns.items()}


def declared(df: DataFrame, table: str) -> DataFrame:
    """The columns of a source table that the schema names."""
    names = {f.name.lower() for f in struct_of(table).fields}
    return df.select(*[df[c] for c in df.columns if c.lower() in names])


def refresh(
    store: Snapshots,
    warehouse: Warehouse,
    types: TypeTables,
    as_of: datetime,
    *,
    alert_days: int = ALERT_DAYS,
    maintenance_days: int = MAINTENANCE_DAYS,
    match_host: bool = False,
    value_width: int | None = VALUE_WIDTH,
) -> RefreshReport:
    """Extend the schemas, sync each inventory with its properties, load both histories.

    Each step writes a staged version that the next one reads, which also keeps the plans short;
    the last ones become current together at the end. A failed run leaves the former state, and a journal of the steps
    it ended: called again with the same ``as_of``, before any other commit, it goes on at the step that failed. Of
    the histories only the changed days are written. ``value_width=None`` keeps property values whole.
    """
    spark, report = store.spark, RefreshReport()
    attempt = f"v{store.last_commit() + 1:08d}"
    tag = f"refresh {as_of.isoformat()}"
    steps = Journal(store, tag)
    staged: dict[str, str] = {}

    def stage(table: str, df: DataFrame, step: str) -> dict:
        return {"paths": {table: store.stage(table, df, f"{attempt}/{step}")}}

    def done(step: str, make: Callable[[], dict]) -> dict:
        outcome = steps.once(step, make)
        staged.update(outcome.get("paths", {}))
        return outcome

    def read(table: str) -> DataFrame:
        return spark.read.parquet(staged[table])

    def claim(table: str) -> Callable[[int, int], int]:
        return lambda count, used: store.claim_ids(table, count, used)

    def with_properties(table: str) -> dict:
        filled = write_back(read(table), values, as_of, columns=columns[table])
        return stage(table, filled, "properties")

    types = types.settled()
    dictionary = written_once(warehouse.dictionary.distinct())
    targets = store.read_all(INVENTORIES)

    def find_columns() -> dict:
        names = evolve.column_names(new_columns(dictionary, types, targets).values())
        outcomes = {t: evolve.extend_schema(targets[t], names.get(t, [])) for t in INVENTORIES}
        columns = fillable(dictionary, {t: o.df for t, o in outcomes.items()})
        return {
            "added": {t: o.added for t, o in outcomes.items()},
            "failed": {t: o.failed for t, o in outcomes.items()},
            "columns": columns,
        }

    found = done("extend schemas", find_columns)
    report.added, report.failed, columns = found["added"], found["failed"], found["columns"]
    targets = {t: evolve.extend_schema(targets[t], report.added[t]).df for t in INVENTORIES}

    def read_once(table: str, df: DataFrame) -> DataFrame:
        """A frame that several steps read: it is computed once, and a rerun finds it."""
        path = done(f"write {table}", lambda: {"written": store.stage(table, df, attempt)})["written"]
        return spark.read.schema(df.schema).parquet(path)

    # The warehouse's tables may be views; entities and the history of properties are read by most steps.
    entities = read_once("Entities", declared(warehouse.entities, "ManagedEntity"))
    changes = read_once("PropertyChanges", I.change_counts(warehouse.properties))

    # Every XML text is taken apart once, where it is read; all inventories share the values.
    wanted = sorted({c for names in columns.values() for c in names})

    def take_apart() -> dict:
        items = named(shred(current_only(warehouse.properties), value_width), dictionary, wanted)
        return {"values": store.stage("PropertyValues", items, attempt)}

    values = spark.read.parquet(done("take properties apart", take_apart)["values"])

    def servers_step() -> dict:
        source = I.server_source(entities, warehouse.properties, types.servers, changes)
        synced = I.sync_servers(targets["SQLServer"], written_once(source), as_of, match_host, claim=claim("SQLServer"))
        return stage("SQLServer", synced, "sync")

    def computers_step() -> dict:
        source = I.computer_source(entities, types.computers, read("SQLServer"))
        synced = I.sync_computers(targets["Computer"], written_once(source), as_of, claim=claim("Computer"))
        return stage("Computer", synced, "sync")

    def databases_step() -> dict:
        source = I.database_source(
            entities, warehouse.properties, types.databases, types.excluded, changes
        )
        synced = I.sync_databases(targets["SQLDatabase"], written_once(source), as_of, claim=claim("SQLDatabase"))
        return stage("SQLDatabase", synced, "sync")

    def load_step(table: str, source: Callable[[], DataFrame], days: int) -> Callable[[], dict]:
        def load() -> dict:
            loaded = load_history(store, table, written_once(source()), as_of, attempt, days=days)
            return {"paths": loaded.paths, "metrics": loaded.metrics}

        return load

    done("sync servers", servers_step)
    done("server properties", lambda: with_properties("SQLServer"))
    done("sync computers", computers_step)
    done("computer properties", lambda: with_properties("Computer"))
    done("operating systems", lambda: stage("Computer", I.update_os(read("Computer"), entities), "system"))
    done("sync databases", databases_step)
    done("database properties", lambda: with_properties("SQLDatabase"))

    def alerts() -> DataFrame:
        return I.alert_source(warehouse.alerts, known_entities(read("SQLServer"), read("Computer")))

    def windows() -> DataFrame:
        return I.maintenance_source(warehouse.windows, entities, read("Computer"))

    loads = {"AlertHistory": (alerts, alert_days), "MaintenanceHistory": (windows, maintenance_days)}
    for table, (source, days) in loads.items():
        report.metrics[table] = done(f"load {table}", load_step(table, source, days))["metrics"]

    report.commit = store.commit(staged, tag=tag)
    return report


def repair_paths(store: Snapshots) -> int:
    """The optional path repair, as a commit of its own."""
    repaired = I.repair_paths(store.read("SQLDatabase"), store.read("SQLServer"))
    return store.write({"SQLDatabase": repaired}, tag="repair paths")


def empty_tables(store: Snapshots) -> dict[str, DataFrame]:
    """Empty inventories and histories, for a first run."""
    names = [*INVENTORIES, "AlertHistory", "MaintenanceHistory"]
    return {t: store.spark.createDataFrame([], struct_of(t)) for t in names}
