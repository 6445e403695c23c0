"""The physical plans keep the shape that holds at scale."""

import re

from pyspark.sql import functions as F

from tests.conftest import day
from tidelog.operators import explore, history, snapshots, trends
from tidelog.operators.timeline import load_timeline
from tidelog.sources import buckets
from tidelog.sources import log as log_store


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return len(re.findall(r"[^t]Exchange (hash|range|single|round)", plan(df)))


def stored(spark, path):
    """A log on disk, so that only the operator's own shuffles count."""
    rows = spark.range(2000).select(
        (F.col("id") % 100).alias("entity_id"),
        F.concat(F.lit("202501"), F.lpad((F.col("id") % 20 + 1).cast("string"), 2, "0"), F.lit("000000000")).alias("commit"),
        "id",
        (F.col("id") % 5).cast("double").alias("metric"),
        F.lit("n").alias("name"),
        F.lit(1.0).alias("latitude"),
        F.lit(1.0).alias("longitude"),
        F.lit("u").alias("url"),
    ).withColumnRenamed("id", "seq")
    rows.write.parquet(path)
    return spark.read.parquet(path)


def log_exchanges(df):
    """Exchanges by entity; those of the timeline go by commit, day and chunk."""
    return len(re.findall(r"[^t]Exchange hashpartitioning\(entity_id", plan(df)))


def built(log, line):
    intervals = snapshots.validity_intervals(log, line)
    return [
        intervals,
        snapshots.history_long(intervals, line, present_only=True),
        history.history_map(intervals, line),
        history.history_table(intervals, line),
        history.metric_change(log, line),
        trends.trend_summary(intervals, line, day(10)),
        trends.recent_or_all(intervals, line, day(10)),
    ]


def test_history_takes_one_shuffle_of_the_log(spark, tmp_path):
    log = stored(spark, str(tmp_path / "log"))
    for df in built(log, load_timeline(log)):
        assert log_exchanges(df) <= 1 and "SortMergeJoin" not in plan(df), plan(df)
        assert "Cartesian" not in plan(df) and "NestedLoop" not in plan(df)


def test_no_broadcast_is_forced_and_length_does_not_change_the_plan(spark, tmp_path):
    log = stored(spark, str(tmp_path / "log"))
    seconds = spark.range(10_000_000).select(
        F.date_format(F.timestamp_seconds(F.col("id") + 1_700_000_000), "yyyyMMddHHmmss'000'").alias("commit")
    )
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shapes = []
        for commits in (log, seconds):  # 20 commits, and 10 million
            plans = [plan(df) for df in built(log, load_timeline(commits))]
            assert not any("Broadcast" in p for p in plans)
            shapes.append([[p.count(x) for x in ("Exchange hash", "SortMergeJoin", "Window [")] for p in plans])
        assert shapes[0] == shapes[1]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_rows_from_a_published_history_need_no_shuffle(spark, tmp_path):
    df = spark.createDataFrame([("a", "{}")], "entity_id string, history string")
    assert exchanges(trends.display_rows(df, day(1))) == 0


def test_history_carries_no_instant_text_through_the_shuffle(spark, tmp_path):
    log = stored(spark, str(tmp_path / "log"))
    line = load_timeline(log)
    dense = snapshots.history_long(snapshots.validity_intervals(log, line), line)
    shuffled = next(
        below for above, below in zip(plan(dense).split("\n"), plan(dense).split("\n")[1:]) if "Exchange hash" in above
    )
    assert "commit" not in re.sub("n_commits", "", shuffled)


def test_fixed_width_upsert_and_trend_use_hash_aggregation(spark, tmp_path):
    log = stored(spark, str(tmp_path / "log"))
    line = load_timeline(log)
    merged = snapshots.upsert_merge(log.select("entity_id", "commit", "seq", "metric"))
    trend = trends.trend_summary(snapshots.validity_intervals(log, line), line, day(10))
    for df in (merged, trend):
        assert "HashAggregate" in plan(df) and "SortAggregate" not in plan(df)
    assert "WindowGroupLimit" in plan(snapshots.upsert_merge(log))
    assert plan(snapshots.snapshot_latest(log)).count("WindowGroupLimit") == 2


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    log = stored(spark, str(tmp_path / "log"))
    as_of = plan(snapshots.snapshot_as_of(log, day(3)).select("entity_id", "metric"))
    assert "LessThanOrEqual(commit" in as_of
    assert "name" not in re.search(r"ReadSchema: (.*)", as_of).group(1)
    spark.conf.set("spark.sql.maxMetadataStringLength", 1000)
    near = plan(explore.nearby(log, 1.0, 1.0, 100.0))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(latitude" in near and "LessThanOrEqual(longitude" in near


def test_a_page_is_a_top_k(spark, tmp_path):
    log = stored(spark, str(tmp_path / "log"))
    top = explore.page(log, explore.sort_order("metric"), 2)
    assert "TakeOrderedAndProject(limit=10, offset=5" in plan(top)


def test_location_and_instant_prune_folders(spark, tmp_path):
    rows = spark.createDataFrame(
        [("25.0_121.5", day(1), "r", 0, "p", "n", "a", 1.0, 2.0, "u", 4.0, ["t"])],
        "location_key string, commit string, source string, seq long, place_id string, name string,"
        "address string, latitude double, longitude double, url string, metric double, types array<string>",
    )
    root = str(tmp_path / "root")
    log_store.append_batch(rows, root, "b1")
    spark.conf.set("spark.sql.maxMetadataStringLength", 1000)
    scan = plan(log_store.read_log(spark, root, "25.0_121.5", until=day(2)))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pruned = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", scan).group(1)
    assert "= 25.0_121.5" in pruned and f"<= {day(2)}" in pruned


PLACES = (
    "location_key string, commit string, source string, seq long, place_id string, name string,"
    "address string, latitude double, longitude double, url string, metric double, types array<string>"
)


def observed(spark, root):
    """Two locations; one entity is observed at every commit, the others now and then."""
    rows = [
        (place, day(d), "r", e, "p", f"n{e}", "a", 1.0, 2.0, "u", float(d), ["t"])
        for place in ("A", "B")
        for d in range(1, 11)
        for e in range(12)
        if e == 0 or (d + e) % 4 == 0
    ]
    log_store.append_batch(spark.createDataFrame(rows, PLACES), root, "b1")


def test_a_bucketed_log_is_not_exchanged_by_entity_any_more(spark, tmp_path):
    root = str(tmp_path / "root")
    observed(spark, root)
    buckets.write_bucketed(spark, root, "own_log", buckets=4)
    spark.sql("DROP TABLE own_log")  # as in another session: the folder stays
    log = buckets.read_bucketed(spark, root, "own_log", buckets=4)
    assert sorted(log.collect()) == sorted(log_store.read_log(spark, root).collect())
    line = load_timeline(log_store.read_commits(spark, root), ["location_key"]).settled()
    intervals = snapshots.validity_intervals(log, line, log_store.KEY)
    for df in (
        snapshots.snapshot_latest(log, log_store.KEY, ["commit"]),
        snapshots.snapshot_as_of(log, day(5), log_store.KEY, ["commit"]),
        intervals,
        history.history_table(intervals, line, log_store.KEY),
    ):
        assert "entity_id" not in "".join(re.findall(r"Exchange hashpartitioning\(.*?\)", plan(df))), plan(df)
    want = history.history_table(
        snapshots.validity_intervals(log_store.read_log(spark, root), line, log_store.KEY), line, log_store.KEY
    )
    same = [sorted(map(str, t.collect())) for t in (want, history.history_table(intervals, line, log_store.KEY))]
    assert same[0] == same[1] and len(same[0]) == 24
    spark.sql("DROP TABLE own_log")


def test_one_batch_per_commit_is_read_without_an_exchange(spark, tmp_path):
    root = str(tmp_path / "root")
    observed(spark, root)
    log = log_store.read_log(spark, root)
    log.collect()
    final = plan(log).split("Initial Plan")[0]
    # Records of commits from one batch come first; those of shared ones, none here, are ranked after.
    passed, ranked = final.split("Window", 1)
    assert "entity_id" not in "".join(re.findall(r"Exchange .*", passed)) and "FileScan" in passed
    assert "entity_id" in "".join(re.findall(r"Exchange .*", ranked))


def test_building_history_exchanges_of_the_log(spark, tmp_path):
    """With broadcasts off: records meet the timeline and go by entity; chunks of them meet its names, and come back."""
    root = str(tmp_path / "root")
    observed(spark, root)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        line = load_timeline(log_store.read_commits(spark, root), ["location_key"]).settled()
        log = spark.read.parquet(f"{root}/log/batch=b1").withColumn("commit", F.col("commit").cast("string"))
        table = history.history_table(snapshots.validity_intervals(log, line, log_store.KEY), line, log_store.KEY)
        by = re.findall(r"[^t]Exchange hashpartitioning\((.*?)\)", plan(table))
        assert len([b for b in by if "entity_id" in b]) == 2, by
        # Of these, one side of each is the timeline.
        assert len([b for b in by if "commit" in b]) == 2 and len([b for b in by if "__chunk" in b]) == 2, by
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_entities_are_grouped_once_from_narrow_rows(spark, tmp_path):
    """One grouping by entity, of commits cut out before it and with no identity but in one row a version."""
    log = stored(spark, str(tmp_path / "log"))
    line = load_timeline(log, chunk=7)
    table = history.history_table(snapshots.validity_intervals(log, line), line)
    listed = [row for row in plan(table).split("\n") if "Aggregate(keys=[entity_id" in row]
    assert listed and not any("__chunk" in row or "slice(" in row for row in listed), listed
    assert "slice(" in plan(table)
    # The timeline is known where it is used: no exchange by its chunks is left for the log.
    settled = line.settled()
    table = history.history_table(snapshots.validity_intervals(log, settled), settled)
    assert len(re.findall(r"[^t]Exchange hashpartitioning\(__chunk", plan(table))) == 1
