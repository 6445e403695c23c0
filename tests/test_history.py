import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import day
from tidelog.functions import maps
from tidelog.operators import history, snapshots
from tidelog.operators.timeline import load_timeline

C1, C2, C3 = day(1), day(2), day(3)


def table(log):
    """Entity -> (history, change)."""
    line = load_timeline(log)
    with_identity = log.withColumns({c: F.col("commit") for c in history.IDENTITY})
    intervals = snapshots.validity_intervals(with_identity, line)
    got = history.with_history_json(history.history_table(intervals, line))
    return {r["entity_id"]: (json.loads(r["history"]), r["metric_change"], r["name"]) for r in got.collect()}


def test_carried_value_changes_by_nothing(make_log):
    got = table(make_log(("a", C1, 4.0), ("b", C1, 3.0), ("b", C2, 3.5)))
    assert got["a"] == ({C1: 4.0, C2: 4.0}, 0.0, C1)
    assert got["b"] == ({C1: 3.0, C2: 3.5}, 0.5, C2)


def test_null_overwrite_leaves_the_later_instants_out(make_log):
    got = table(make_log(("a", C1, 4.0), ("a", C2, None), ("b", C3, 1.0)))
    assert got["a"] == ({C1: 4.0}, 0.0, C2)
    assert got["b"] == ({C3: 1.0}, 0.0, C3)


def test_late_entity_and_entity_never_rated(make_log):
    got = table(make_log(("a", C1, None), ("b", C2, 5.0)))
    assert got["a"] == ({}, 0.0, C1)
    assert got["b"] == ({C2: 5.0}, 0.0, C2)


def test_one_commit_has_no_change(make_log):
    assert table(make_log(("a", C1, 4.2))) == {"a": ({C1: 4.2}, 0.0, C1)}


def test_wide_view_and_back(make_log):
    log = make_log(("a", C1, 4.0), ("a", C2, 4.5), ("b", C1, None), ("b", C3, 2.0))
    line = load_timeline(log)
    dense = snapshots.history_long(snapshots.validity_intervals(log, line), line)
    wide = history.history_wide(dense, [C1, C2, C3])
    assert wide.columns == ["entity_id", f"metric_{C1}", f"metric_{C2}", f"metric_{C3}"]
    back = {r["entity_id"]: (r["history"], r["metric_change"]) for r in history.wide_to_history(wide).collect()}
    assert back == {"a": ({C1: 4.0, C2: 4.5, C3: 4.5}, 0.0), "b": ({C3: 2.0}, 0.0)}
    only = history.wide_to_history(wide.select("entity_id", f"metric_{C1}"))
    assert {r["metric_change"] for r in only.collect()} == {0.0}
    with pytest.raises(ValueError):
        history.wide_to_history(wide.select("entity_id"))
    with pytest.raises(ValueError):
        history.history_wide(dense, [])


def test_history_text_parses_tolerantly(spark):
    bad = [("oops",), ("",), ("null",), (None,), ("[1]",)]
    df = spark.createDataFrame(bad + [(json.dumps({C1: 4.0}),)], "t string")
    got = [r[0] for r in df.select(maps.parse_history(F.col("t"))).collect()]
    assert got == [{}] * 5 + [{C1: 4.0}]


def test_history_as_text(spark):
    texts = [json.dumps({C2: 4.26, C1: 3.0, "abc": None}), "oops", None, "{}"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(maps.history_text(F.col("t"))).collect()]
    assert got == ["abc: N/A; Jan 1, 2025: 3.0; Jan 2, 2025: 4.3", "oops", "", ""]
