"""Files of the shared folder, on any file system Spark reaches."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.sql import SparkSession

from fleetmart.session import shared_root


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _at(spark, path)
    return system.exists(place)


def children(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """(name, whether it is a folder) of what lies in a folder, hidden files left out; nothing if there is none."""
    system, place = _at(spark, path)
    if not system.exists(place):
        return []
    found = [(s.getPath().getName(), s.isDirectory()) for s in system.listStatus(place)]
    return sorted((name, folder) for name, folder in found if not name.startswith((".", "_SUCCESS")))


def count_files(spark: SparkSession, path: str) -> int:
    """Data files below a folder."""
    return sum(
        count_files(spark, f"{path}/{name}") if folder else 1 for name, folder in children(spark, path)
    )


def delete(spark: SparkSession, path: str) -> bool:
    system, place = _at(spark, path)
    return system.delete(place, True)


def expire_work(spark: SparkSession, older_than: timedelta, root: str | None = None) -> int:
    """Delete the work folders of ended runs: those below the shared folder, or ``root``, last written before that time.

    Frames that were staged that long ago can no longer be read, so it should exceed the longest run.
    """
    root, limit = root or shared_root(spark), (datetime.now(UTC) - older_than).timestamp() * 1000
    system, place = _at(spark, root)
    if not system.exists(place):
        return 0
    old = [s.getPath() for s in system.listStatus(place) if s.getModificationTime() < limit]
    return sum(bool(system.delete(p, True)) for p in old)
