"""Incremental loads of the two histories: micro-batches through the same upsert."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from fleetmart.plans import inventory as I
from fleetmart.plans.histories import load_history
from fleetmart.sources.snapshots import GONE, Snapshots

Source = Callable[[DataFrame], DataFrame]
#: Commits after which the small days of a history are put together.
PACK_EVERY = 24


def start_upsert(
    stream: DataFrame, store: Snapshots, table: str, source: Source, as_of: datetime, checkpoint: str, days: int | None
) -> StreamingQuery:
    """Feed every micro-batch into a history, then stop when the input is used up.

    Each batch becomes one commit; it reads the days that may hold one of its keys and writes those it changes. A batch that
    is delivered again after a failure finds its tag in the commit log and is skipped, so each one counts once.
    """

    def upsert(batch: DataFrame, batch_id: int) -> None:
        tag = f"{checkpoint}#{batch_id}"
        if store.has_tag(tag):
            return
        number = store.last_commit() + 1
        load = load_history(store, table, source(batch), as_of, f"v{number:08d}", days=days)
        # A batch that changes nothing is on record, too.
        store.commit(load.paths or {f"{table}-batch": GONE}, tag, number)
        if (batch_id + 1) % PACK_EVERY == 0:
            store.pack(table)

    return (
        stream.writeStream.foreachBatch(upsert)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_alerts(
    details: DataFrame,
    store: Snapshots,
    known: DataFrame,
    as_of: datetime,
    checkpoint: str,
    days: int | None = None,
) -> StreamingQuery:
    """Alert details as a stream; late alerts beyond the retention window are left out."""

    def source(batch: DataFrame) -> DataFrame:
        return I.alert_source(batch, known)

    return start_upsert(details, store, "AlertHistory", source, as_of, checkpoint, days)


def stream_maintenance(
    windows: DataFrame,
    store: Snapshots,
    entities: DataFrame,
    computers: DataFrame,
    as_of: datetime,
    checkpoint: str,
    days: int | None = None,
) -> StreamingQuery:
    """Maintenance windows as a stream."""

    def source(batch: DataFrame) -> DataFrame:
        return I.maintenance_source(batch, entities, computers)

    return start_upsert(windows, store, "MaintenanceHistory", source, as_of, checkpoint, days)
