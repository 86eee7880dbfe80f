"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

from fleetmart.registry import QUERIES  # noqa: E402
from fleetmart.session import build_session  # noqa: E402

HEADLINE = [
    "dist_mandant",
    "dist_version",
    "lookup_contains",
    "lookup_prefix",
    "support_lookup",
    "host_semi",
    "exclude_names",
    "change_count",
    "dedup_keep_first",
    "surrogate_ids",
    "sync_merge",
    "sync_servers",
    "sync_computers",
    "sync_databases",
    "property_shred",
    "property_refresh_servers",
    "property_refresh_computers",
    "property_refresh_databases",
    "property_list",
    "os_update",
    "path_repair",
    "alert_import",
    "maintenance_import",
    "stream_alert_upsert",
    "stream_maintenance_upsert",
    "event_scan",
    "property_shred_mixed",
    "sql_functions",
    "audit_tables",
    "databases_list",
    "audit_duplicates",
    "refresh_all",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="12g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(key: str) -> float:
        start = time.perf_counter()
        QUERIES[key](spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    run("scan_entities")
    run("sync_merge")
    keys = [k for k in sys.argv[1:] if k in QUERIES] or HEADLINE
    times = {key: run(key) for key in keys}
    spark.stop()
    total = round(sum(times.values()), 3)
    result = {
        "metric": "headline queries, total wall clock",
        "value": total,
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(folder.rstrip("/")),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
