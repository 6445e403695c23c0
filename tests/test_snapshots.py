import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import day
from tidelog.operators import history, snapshots, trends
from tidelog.operators.latest import latest_per_key
from tidelog.operators.timeline import commit_timeline, load_timeline

C1, C2, C3 = day(1), day(2), day(3)


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def dense(log):
    line = load_timeline(log)
    return snapshots.history_long(snapshots.validity_intervals(log, line), line)


def random_rows(seed, entities=12, commits=9):
    rng = random.Random(seed)
    out = []
    for e in range(entities):
        for c in range(1, commits + 1):
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                metric = None if rng.random() < 0.25 else rng.randint(10, 50) / 10
                out.append((f"e{e}", day(c), metric))
    rng.shuffle(out)
    return out


def brute_state(observed, instant):
    """Whole-record state at an instant, straight from the definition."""
    state = {}
    for seq, (entity, commit, metric) in enumerate(observed):
        if commit <= instant and (entity not in state or (commit, seq) > state[entity][0]):
            state[entity] = ((commit, seq), metric)
    return {e: m for e, (_, m) in state.items()}


def test_greatest_sequence_wins_within_a_commit(make_log):
    merged = snapshots.upsert_merge(make_log(("a", C1, 4.0), ("a", C1, None), ("b", C1, 2.0)))
    assert rows(merged, "entity_id", "commit", "seq") == [("a", C1, 1), ("b", C1, 2)]
    assert rows(merged.filter("entity_id = 'a'"), "metric") == [(None,)]


@pytest.mark.parametrize("wide", [False, True])
def test_latest_per_key_takes_one_whole_record(spark, wide):
    data = [(k, s, float(s), k * 10 + s) for k in range(5) for s in range(7)] + [(9, None, 1.5, 3)]
    df = spark.createDataFrame(data, "k long, seq long, a double, b long")
    if wide:  # a string value takes the other plan
        df = df.withColumn("text", F.col("b").cast("string"))
    got = rows(latest_per_key(df, ["k"], ["seq"]), "k", "seq", "a", "b")
    assert got == [(k, 6, 6.0, k * 10 + 6) for k in range(5)] + [(9, None, 1.5, 3)]


def test_carried_forward_and_late_entities(make_log):
    log = make_log(("a", C1, 4.0), ("b", C1, 3.0), ("b", C2, 3.5), ("c", C3, 1.0))
    assert rows(dense(log), "entity_id", "commit", "metric") == [
        ("a", C1, 4.0),
        ("a", C2, 4.0),
        ("a", C3, 4.0),
        ("b", C1, 3.0),
        ("b", C2, 3.5),
        ("b", C3, 3.5),
        ("c", C3, 1.0),
    ]


def test_a_null_metric_replaces_a_known_one(make_log):
    log = make_log(("a", C1, 4.0), ("a", C2, None), ("b", C3, 1.0))
    got = {r["commit"]: r["metric"] for r in dense(log).filter("entity_id = 'a'").collect()}
    assert got == {C1: 4.0, C2: None, C3: None}


def test_as_of_reads_include_the_instant(make_log):
    log = make_log(("a", C1, 4.0), ("a", C2, 5.0))
    assert rows(snapshots.snapshot_as_of(log, C1), "metric") == [(4.0,)]
    assert rows(snapshots.snapshot_as_of(log, C2), "metric") == [(5.0,)]
    assert snapshots.snapshot_as_of(log, day(1, year=2024)).isEmpty()
    assert rows(snapshots.snapshot_latest(log), "metric") == [(5.0,)]


@pytest.mark.parametrize("seed", range(3))
def test_history_agrees_with_as_of_reads(make_log, seed):
    observed = random_rows(seed)
    log = snapshots.upsert_merge(make_log(*observed))
    line = load_timeline(log)
    commits = [r["commit"] for r in line.rows.orderBy("ordinal").collect()]
    got = {(r[0], r[1]): r[2] for r in dense(log).collect()}
    want = {(e, c): m for c in commits for e, m in brute_state(observed, c).items()}
    assert got == want
    change = {r[0]: r[1] for r in history.metric_change(log, line).collect()}
    last, before = brute_state(observed, commits[-1]), brute_state(observed, commits[-2])
    for entity, value in change.items():
        a, b = last[entity], before.get(entity)
        assert value == (0.0 if a is None or b is None else a - b)


def located(log):
    return log.withColumn(
        "location_key", F.when(F.col("entity_id") < "e5", F.lit("x")).otherwise(F.lit("y"))
    )


def as_text(df):
    return sorted(str(tuple(r)) for r in df.collect())


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("location", [(), ("location_key",)])
def test_the_length_of_a_chunk_does_not_show(make_log, seed, location):
    log = located(snapshots.upsert_merge(make_log(*random_rows(seed))))
    key = [*location, "entity_id"]
    start = day(6)

    def everything(chunk):
        line = load_timeline(log, location, chunk)
        intervals = snapshots.validity_intervals(log, line, key)
        yield intervals
        yield snapshots.history_long(intervals, line, key)
        yield snapshots.history_long(intervals, line, key, present_only=True)
        yield history.history_map(intervals, line, key)
        yield history.history_table(intervals, line, key, identity=["seq"])
        yield history.metric_change(log, line, key)
        yield trends.trend_summary(intervals, line, start, key)
        yield trends.recent_or_all(intervals, line, start, key)
        yield snapshots.retain_commits(log, line, 4, key)

    for whole, *cut in zip(*(everything(n) for n in (1024, 1, 2, 4)), strict=True):
        for other in cut:
            assert as_text(other) == as_text(whole)


def test_the_timeline_by_hand_over_many_days(spark):
    rng = random.Random(4)
    instants = [f"2025{rng.randint(1, 3):02d}{rng.randint(1, 28):02d}{rng.randint(0, 23):02d}{rng.randint(0, 59):02d}00000"
                for _ in range(80)]
    data = [(rng.choice("xy"), i) for i in instants]
    line = load_timeline(spark.createDataFrame(data, "location_key string, commit string"), ["location_key"], 3)
    want = []
    for place in "xy":
        own = sorted({c for p, c in data if p == place})
        want += [(place, c, n, len(own), own[n - 2] if n > 1 else None, own[-1]) for n, c in enumerate(own, 1)]
    assert sorted(map(str, want)) == as_text(line.rows)
    listed = {(r[0], r[1]): r[2] for r in line.chunks().collect()}
    own = sorted({c for p, c in data if p == "x"})
    assert [listed["x", k] for k in range(-(-len(own) // 3))] == [own[i : i + 3] for i in range(0, len(own), 3)]


def test_compressed_history_keeps_change_points(make_log):
    log = make_log(("a", C1, 4.0), ("a", C2, 4.0), ("a", C3, None), ("a", day(4), 4.0))
    line = load_timeline(log)
    intervals = snapshots.validity_intervals(log, line)
    kept = snapshots.history_long(intervals, line, compress=True)
    assert [r["commit"] for r in kept.orderBy("commit").collect()] == [C1, C3, day(4)]
    present = snapshots.history_long(intervals, line, compress=True, present_only=True)
    assert [r["commit"] for r in present.orderBy("commit").collect()] == [C1, day(4)]


def test_ordinals_count_per_location(spark):
    data = [("x", C1), ("x", C3), ("y", C2), ("y", C2)]
    commits = spark.createDataFrame(data, "location_key string, commit string")
    got = rows(commit_timeline(commits, ["location_key"]), "location_key", "commit", "ordinal")
    assert got == [("x", C1, 1), ("x", C3, 2), ("y", C2, 1)]
    assert rows(commit_timeline(commits), "commit", "ordinal") == [(C1, 1), (C2, 2), (C3, 3)]


@pytest.mark.parametrize("keep", [1, 3, 100])
def test_retention_leaves_later_reads_unchanged(make_log, keep):
    observed = random_rows(11)
    log = snapshots.upsert_merge(make_log(*observed))
    line = load_timeline(log)
    kept = snapshots.retain_commits(log, line, keep)
    commits = [r["commit"] for r in line.rows.orderBy("ordinal").collect()][-keep:]
    assert {r[0] for r in kept.select("commit").distinct().collect()} <= set(commits)
    for commit in commits:
        got = {r["entity_id"]: r["metric"] for r in snapshots.snapshot_as_of(kept, commit).collect()}
        assert got == brute_state(observed, commit)
    with pytest.raises(ValueError):
        snapshots.retain_commits(log, line, 0)
