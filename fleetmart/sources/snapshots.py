"""Versioned parquet snapshots: read version n, write n + 1, then commit.

A table version is a folder that is written once. The commit log says which folder is current, so a
run that fails leaves the former state in force and a reader never sees half a table. One writer
at a time is assumed.

The two event histories are kept by day: each day has its own entry in the log, so a load replaces
the days it changes and drops the days it purges. A few days are written to a folder each; many are put
together in files of ``PACK_ROWS`` rows or so, in which a day lasts until its entry points elsewhere. Rows
without a date form one more day. ``pack`` puts small days together later, ``sources.expiry`` deletes
what no kept commit reaches.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Collection, Iterable, Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmart.operators.joins import staged
from fleetmart.schemas import EVENT_TIMES, struct_of
from fleetmart.sources.commitlog import AppendedTable, CommitLog
from fleetmart.sources.keyindex import DAY, DayFacts, KeyIndex

LOAD, PACK, NO_DAY = "_load", "_pack", "__HIVE_DEFAULT_PARTITION__"
GONE = ""  # path of a day that has no rows any more
#: Days that one load writes to a folder each; more of them are packed.
LOOSE = 16
#: Rows from which a pack is full.
PACK_ROWS = 1_000_000


def _name(table: str, day: date | None) -> str:
    return f"{table}/{DAY}={NO_DAY if day is None else day.isoformat()}"


def _day(name: str) -> date | None:
    text = name.rsplit("=", 1)[1]
    return None if text == NO_DAY else date.fromisoformat(text)


def _load(path: str) -> str:
    """Name of the load that wrote a day's folder."""
    return next(p for p in path.split("/") if p.startswith(f"{LOAD}="))[len(LOAD) + 1 :]


def among(days: Collection[date | None]) -> Column:
    """Whether a row belongs to one of the days, None among them for rows without a date."""
    dated = sorted(d.isoformat() for d in set(days) if d is not None)
    wanted = F.expr(f"{DAY} IN ({', '.join(f"DATE'{d}'" for d in dated)})") if dated else F.lit(False)
    return wanted | F.col(DAY).isNull() if None in days else wanted


class Snapshots:
    """Tables below one root folder, on any file system Spark reaches."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._log = CommitLog(spark, self.root)
        self._ids = AppendedTable(spark, f"{self.root}/ids", "table string, upto long")
        self._indexes: dict[str, KeyIndex] = {}

    def log(self) -> DataFrame:
        return self._log.frame()

    def entries(self) -> list:
        return self._log.entries()

    def checkpoint_log(self, rows: Iterable, number: int) -> None:
        self._log.checkpoint(rows, number)

    def last_commit(self) -> int:
        return max((r["commit"] for r in self.entries()), default=0)

    def has_tag(self, tag: str) -> bool:
        return any(r["tag"] == tag for r in self.entries())

    def paths(self, commit: int | None = None) -> dict[str, str]:
        """Folder of every table, or of each of its days, as of now or of an earlier commit.

        One row per table and kept day: bounded by the retention window, not by the events.
        """
        latest: dict[str, tuple[int, str]] = {}
        for r in self.entries():
            if (commit is None or r["commit"] <= commit) and r["commit"] >= latest.get(r["table"], (0,))[0]:
                latest[r["table"]] = r["commit"], r["path"]
        return {table: path for table, (_, path) in latest.items() if path != GONE}

    def read_all(self, tables: Sequence[str], commit: int | None = None) -> dict[str, DataFrame]:
        """Versions of several tables that belong together; empty ones before the first commit."""
        paths = self.paths(commit)
        return {
            t: self._by_day(t, paths).drop(DAY)
            if t in EVENT_TIMES
            else self.spark.read.parquet(paths[t])
            if t in paths
            else self.spark.createDataFrame([], struct_of(t))
            for t in tables
        }

    def read_days(self, table: str, days: Iterable[date | None] | None = None) -> DataFrame:
        """An event history with the day each row is kept under; of the given days only, if any are named.

        Filters on the day prune folders, and in packs the row groups.
        """
        return self._by_day(table, self.paths(), days)

    def days(self, table: str, paths: Mapping[str, str] | None = None) -> dict[date | None, str]:
        """Folder of each day of a history."""
        paths = self.paths() if paths is None else paths
        return {_day(name): path for name, path in paths.items() if name.startswith(f"{table}/{DAY}=")}

    def _by_day(
        self, table: str, paths: Mapping[str, str], only: Iterable[date | None] | None = None
    ) -> DataFrame:
        held = self.days(table, paths)
        if only is not None:
            held = {d: held[d] for d in set(only) & held.keys()}
        loose = [p for p in held.values() if f"/{DAY}=" in p]
        packs = defaultdict(list)
        for day, path in held.items():
            if f"/{DAY}=" not in path:
                packs[path].append(day)
        frames = []
        if loose:
            found = self.spark.read.option("basePath", f"{self.root}/{table}").parquet(*sorted(loose)).drop(LOAD)
            if found.schema[DAY].dataType.typeName() != "date":  # only rows without a date
                found = found.withColumn(DAY, F.col(DAY).cast("date"))
            frames.append(found)
        for path, days in sorted(packs.items()):
            frames.append(self.spark.read.parquet(path).where(among(days)))
        if not frames:
            empty = self.spark.createDataFrame([], struct_of(table))
            return empty.withColumn(DAY, F.lit(None).cast("date"))
        out = frames[0]
        for more in frames[1:]:
            out = out.unionByName(more)
        return out

    def read(self, table: str, commit: int | None = None) -> DataFrame:
        return self.read_all([table], commit)[table]

    def stage(self, table: str, df: DataFrame, attempt: str) -> str:
        """Write a version that is not current yet; ``attempt`` keeps runs apart."""
        path = f"{self.root}/{table}/{attempt}"
        df.write.mode("overwrite").parquet(path)
        return path

    def stage_days(
        self,
        table: str,
        df: DataFrame,
        attempt: str,
        days: Mapping[date | None, bool],
        sizes: Mapping[date | None, int] | None = None,
    ) -> dict[str, str]:
        """Write the days for which ``days`` holds true; log entries for these and the dropped rest.

        ``df`` carries the day of each row. A large day is spread over several tasks and files; many days are
        packed by ``sizes``, their numbers of rows as far as these are known.
        """
        attempt = f"{attempt}-{uuid.uuid4().hex[:8]}"  # facts of a failed run must not pass for those of its rerun
        root = f"{self.root}/{table}/{LOAD}={attempt}"
        kept = [day for day, held in days.items() if held]
        out = {_name(table, day): GONE for day in days}
        if not kept:
            return out
        if len(kept) <= LOOSE:
            df.hint("rebalance", F.col(DAY)).write.mode("overwrite").partitionBy(DAY).parquet(root)
            out |= {name: f"{root}/{name.split('/')[1]}" for name in (_name(table, d) for d in kept)}
        else:
            number = self._pack_numbers(kept, sizes or {})
            bounds = sorted({n: min(d for d in number if d and number[d] == n) for n in set(number.values())}.items())
            pack = sum((F.coalesce(F.col(DAY) >= F.lit(first), F.lit(False)).cast("int") for _, first in bounds[1:]), F.lit(0))
            spread = df.withColumn(PACK, pack).hint("rebalance", F.col(PACK)).sortWithinPartitions(PACK, DAY)
            spread.write.mode("overwrite").partitionBy(PACK).parquet(root)
            out |= {_name(table, d): f"{root}/{PACK}={n}" for d, n in number.items()}
        written = self._by_day(table, {_name(table, d): out[_name(table, d)] for d in kept})
        self.index(table).add(written, attempt)
        found = self.index(table).facts((d, attempt) for d in kept)
        return out | {_name(table, d): GONE for d in kept if d not in found}  # no row was left for them

    @staticmethod
    def _pack_numbers(days: Sequence[date | None], sizes: Mapping[date | None, int]) -> dict[date | None, int]:
        """Neighbouring days share a pack until it is full; rows without a date go into the first one."""
        out, number, rows = {None: 0} if None in days else {}, 0, 0
        for day in sorted(d for d in days if d is not None):
            if rows >= PACK_ROWS:
                number, rows = number + 1, 0
            out[day] = number
            rows += sizes.get(day, 0)
        return out

    def index(self, table: str) -> KeyIndex:
        if table not in self._indexes:
            self._indexes[table] = KeyIndex(self.spark, self.root, table)
        return self._indexes[table]

    def facts(self, table: str) -> dict[date | None, DayFacts]:
        """Facts of the current days; days written before there was an index have none."""
        return self.index(table).facts((d, _load(p)) for d, p in self.days(table).items())

    def days_holding(self, table: str, keys: DataFrame) -> set[date | None]:
        """Current days that may hold one of the keys, the frame's only column."""
        return self.index(table).holding(keys, ((d, _load(p)) for d, p in self.days(table).items()))

    def pack(self, table: str) -> int:
        """Put the small days of a history together, as a commit of its own; days in full packs stay where they are.

        Returns the number of the commit, 0 if there is nothing to put together.
        """
        held, facts = self.days(table), self.facts(table)
        rows = defaultdict(int)
        for day, path in held.items():
            rows[path] += facts[day].rows if day in facts else 0
        small = [d for d, p in held.items() if rows[p] < PACK_ROWS // 2]
        if len({held[d] for d in small}) < 2 or len(small) <= LOOSE:
            return 0
        sizes = {d: facts[d].rows for d in small if d in facts}
        number = self.last_commit() + 1
        paths = self.stage_days(table, self.read_days(table, small), f"v{number:08d}", dict.fromkeys(small, True), sizes)
        return self.commit(paths, f"pack {table}", number)

    def claim_ids(self, table: str, count: int, used: int) -> int:
        """The number after which ``count`` fresh ids of a table follow, claimed before they are written.

        ``used`` is the highest id in the table. A claim outlasts its run and the rows it was made for, so an id
        never comes back: a failed run leaves a gap, a purge of the newest rows nothing to give out again. Without
        a ``count`` the ids in use are put on record, before rows that hold them go.
        """
        claimed = max((r["upto"] for r in self._ids.rows() if r["table"] == table), default=0)
        after = max(claimed, used)
        if after + count > claimed:
            self._ids.append([(table, after + count)])
        return after

    def commit(self, paths: Mapping[str, str], tag: str = "", number: int | None = None) -> int:
        """Make staged versions current, all in one append."""
        number = number or self.last_commit() + 1
        self._log.append([(number, tag, table, path) for table, path in paths.items()])
        return number

    def write(self, tables: Mapping[str, DataFrame], tag: str = "") -> int:
        """Stage and commit."""
        number = self.last_commit() + 1
        paths: dict[str, str] = {}
        for table, df in tables.items():
            if table in EVENT_TIMES:
                paths |= self._all_days(table, df, f"v{number:08d}")
            else:
                paths[table] = self.stage(table, df, f"v{number:08d}")
        return self.commit(paths, tag, number)

    def _all_days(self, table: str, df: DataFrame, attempt: str) -> dict[str, str]:
        dated = staged(df.withColumn(DAY, F.to_date(EVENT_TIMES[table])), "days")  # counted, then written
        sizes = {row[DAY]: row["count"] for row in dated.groupBy(DAY).count().collect()}
        days = dict.fromkeys(self.days(table), False) | dict.fromkeys(sizes, True)
        return self.stage_days(table, dated, attempt, days, sizes)
