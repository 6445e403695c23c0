"""Time the headline queries; prints one JSON line.

    BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8)
"""

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidelog.operators import history, snapshots  # noqa: E402
from tidelog.operators.timeline import load_timeline  # noqa: E402
from workload import fixtures as fx  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

HEADLINE = [
    "upsert_merge",
    "commit_timeline",
    "snapshot_latest",
    "snapshot_as_of",
    "validity_intervals",
    "history_long",
    "history_map",
    "metric_change",
    "history_table",
    "history_table_located",
    "trend_summary",
    "trend_from_map",
    "display_rows",
    "history_key_points",
    "explore_page",
    "explore_page_deep",
    "export_csv_rows",
    "nearby_search",
    "enrich_details",
    "pages_dedup",
    "envelope_nest",
    "upsert_log",
    "full_cycle",
]


def timed(build):
    """Seconds to plan and run, all rows computed and none kept."""
    started = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - started, 3)


def maps_by(spark, sf_dir, unit):
    """History maps with one commit per `unit`: 30 commits a month by day, 720 by hour."""
    seen = fx.short_observations(spark, sf_dir, unit)
    line = load_timeline(seen)
    intervals = snapshots.validity_intervals(snapshots.upsert_merge(seen), line)
    return history.history_map(intervals, line)


def table_over(spark, sf_dir, location):
    """History tables with the given column as location: few locations, or as many as users."""
    seen = fx.observations(spark, sf_dir, "hour").withColumn("location_key", F.col(location).cast("string"))
    line = load_timeline(seen, ["location_key"])
    intervals = snapshots.validity_intervals(snapshots.upsert_merge(seen, fx.LOCATED), line, fx.LOCATED)
    return history.history_table(intervals, line, fx.LOCATED)


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tidelog-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    # The first queries of a session pay for class loading; take that out of the numbers.
    for name in ("history_map", "upsert_log"):
        timed(lambda: QUERIES[name](spark, sf_dir))
    seconds = {name: timed(lambda: QUERIES[name](spark, sf_dir)) for name in HEADLINE}
    scaling = {
        f"history_map_by_{unit}": timed(lambda: maps_by(spark, sf_dir, unit))
        for unit in ("day", "hour")
    }
    scaling |= {
        f"history_table_by_{name}": timed(lambda: table_over(spark, sf_dir, column))
        for name, column in (("event_type", "location_key"), ("user", "entity_id"))
    }
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall clock",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "scaling": scaling,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
