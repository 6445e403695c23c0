import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import day
from tests.test_snapshots import random_rows
from tidelog.functions import instants
from tidelog.operators import history, snapshots, trends
from tidelog.operators.timeline import load_timeline


def parts(make_log, *observed):
    log = snapshots.upsert_merge(make_log(*observed))
    line = load_timeline(log)
    intervals = snapshots.validity_intervals(log, line)
    everyone = log.select("entity_id").distinct()
    maps = everyone.join(history.history_map(intervals, line), "entity_id", "left")
    return intervals, line, maps


def one(make_log, metrics, start=day(1, year=2000)):
    observed = [("a", day(i + 1), m) for i, m in enumerate(metrics)]
    intervals, line, _ = parts(make_log, *observed)
    return trends.trend_summary(intervals, line, start).first()


@pytest.mark.parametrize(
    "metrics, value, text",
    [
        ([3.0, 5.0, 4.0], 1.0, "+1.0"),
        ([5.0, 4.0], -1.0, "-1.0"),
        ([4.0, 4.0], 0.0, "0.0"),
        ([4.2], 0.0, "0.0"),
        ([2.0, None], 0.0, "0.0"),
    ],
)
def test_signed_range(make_log, metrics, value, text):
    row = one(make_log, metrics)
    assert (row["range_value"], row["range_text"]) == (value, text)
    assert row["range_magnitude"] == abs(value)


def test_entity_without_any_metric(make_log):
    row = one(make_log, [None, None]).asDict()
    assert row.pop("entity_id") == "a" and row.pop("range_magnitude") == 0.0
    assert set(row.values()) == {None}


def test_window_limits_low_and_high_only(make_log):
    row = one(make_log, [1.0, 5.0, 3.0, 4.0], start=day(3))
    assert (row["low"], row["high"], row["range_value"]) == (3.0, 4.0, 1.0)
    assert row["first_commit"] == day(1) and row["latest_commit"] == day(4)
    assert row["range_period"] == "Jan 1, 2025 → Jan 4, 2025"


def test_empty_window_falls_back_to_everything(make_log):
    row = one(make_log, [1.0, 3.0], start=day(1, year=2030))
    assert (row["low"], row["high"]) == (1.0, 3.0)


def test_window_start_is_inclusive_and_clamped(spark):
    dates = [datetime(2025, 8, 31), datetime(2024, 8, 31, 10), datetime(2025, 7, 1)]
    df = spark.createDataFrame([(d,) for d in dates], "d timestamp_ntz")
    got = [r[0] for r in df.select(instants.window_start(F.col("d"))).collect()]
    assert got == ["20250228000000000", "20240229100000000", "20250101000000000"]


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("start", [day(1), day(6), day(9), day(1, year=2030)])
def test_both_forms_agree_with_the_definition(make_log, seed, start):
    intervals, line, maps = parts(make_log, *random_rows(seed))
    from_log = {r["entity_id"]: r.asDict() for r in trends.trend_summary(intervals, line, start).collect()}
    with_map = {r["entity_id"]: r.asDict() for r in trends.with_trend(maps, start).collect()}
    observed = {e: sorted((r.pop("history") or {}).items()) for e, r in with_map.items()}
    assert from_log == with_map
    points = {}
    for r in trends.key_points(maps, start).collect():
        points.setdefault(r["entity_id"], []).append((r["commit"], r["metric"]))
    kept = {}
    for r in trends.recent_or_all(intervals, line, start).collect():
        kept.setdefault(r["entity_id"], []).append((r["commit"], r["metric"]))
    for entity, seen in observed.items():
        if not seen:
            assert entity not in points and entity not in kept
            continue
        window = [o for o in seen if o[0] >= start] or seen
        assert sorted(kept[entity]) == window
        low = min(window, key=lambda o: (o[1], o[0]))
        high = max(window, key=lambda o: (o[1], o[0]))
        assert from_log[entity]["low"] == low[1] and from_log[entity]["high"] == high[1]
        assert from_log[entity]["current_metric"] == seen[-1][1]
        assert points[entity] == sorted({seen[-1], seen[0], low, high}, reverse=True)


def test_display_rows_show_key_points(spark):
    rows = [("a", '{"20250101093000123":4.0,"20250203140500000":4.5,"bad":1.0}'), ("b", "oops")]
    df = spark.createDataFrame(rows, "entity_id string, history string")
    a, b = trends.display_rows(df, day(1)).orderBy("entity_id").collect()
    assert a["history_details"] == (
        "Feb 3, 2025 • 2:05 PM  →  4.5\nJan 1, 2025 • 9:30 AM  →  4.0"
    )
    assert a["current_metric"] == 4.5 and a["range_text"] == "+0.5" and a["history"] == rows[0][1]
    assert b["history_details"] == "" and b["current_metric"] is None and b["range_magnitude"] == 0.0


def test_window_compares_whole_minutes(spark):
    df = spark.createDataFrame(
        [("a", '{"20250101093059999":2.0,"20250102000000000":3.0}')], "entity_id string, history string"
    )
    within = trends.display_rows(df, "20250101093000000").first()
    assert within["low"] == 2.0
    after = trends.display_rows(df, "20250101093000001").first()
    assert after["low"] == 3.0


def test_random_instants_are_judged_like_a_calendar(spark):
    rng = random.Random(3)
    texts = []
    for _ in range(400):
        y, mo, d = rng.choice(["1999", "2024", "2025"]), rng.randint(0, 13), rng.randint(0, 32)
        h, mi, s = rng.randint(0, 24), rng.randint(0, 60), rng.randint(0, 59)
        texts.append(f"{y}{mo:02d}{d:02d}{h:02d}{mi:02d}{s:02d}{rng.randint(0, 999):03d}")
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", instants.is_instant(F.col("t")), instants.parse_instant(F.col("t"))).collect()
    for text, valid, parsed in got:
        try:
            want = datetime.strptime(text[:14], "%Y%m%d%H%M%S").replace(second=0)
        except ValueError:
            want = None
        assert (valid, parsed) == (want is not None, want), text
