"""As-of join of requests and versions against the definition."""

import random
import re

import pytest

from tests.conftest import day
from tidelog.operators.asof import as_of_join
from tidelog.operators.snapshots import snapshot_as_of

VERSIONS = "entity_id string, commit string, metric double, note string"
REQUESTS = "entity_id string, at string, number int"


def instant(d, hour):
    return f"{day(d)[:8]}{hour:02d}0000000"


def by_definition(requests, versions):
    out = []
    for e, at, n in requests:
        seen = [v for v in versions if at is not None and e is not None and v[0] == e and v[1] is not None and v[1] <= at]
        best = max(seen, key=lambda v: v[1], default=(None,) * 4)
        out.append((e, at, n, *best[1:]))
    return sorted(out, key=str)


@pytest.mark.parametrize("stretch", [4, 8, 10, 17])
def test_every_request_meets_the_version_in_force(spark, stretch):
    rng = random.Random(stretch)
    versions = {(f"e{rng.randrange(6)}", instant(rng.randrange(1, 25), rng.randrange(24))) for _ in range(60)}
    versions = [(e, c, rng.choice([None, 1.0, 2.0]), rng.choice([None, "x"])) for e, c in sorted(versions)]
    versions.append(("e1", None, 9.0, "never"))
    requests = [(f"e{rng.randrange(8)}", instant(rng.randrange(1, 28), rng.randrange(24)), i) for i in range(150)]
    requests += [(versions[0][0], versions[0][1], 900), requests[0], (None, instant(3, 1), 901), ("e1", None, 902)]
    # A hot entity: most requests are of one.
    requests += [("e2", instant(1 + i % 27, i % 24), 1000 + i) for i in range(200)]
    frame = spark.createDataFrame(requests, REQUESTS)
    joined = as_of_join(frame, spark.createDataFrame(versions, VERSIONS), "at", ["commit", "metric", "note"], stretch=stretch)
    assert joined.columns == ["entity_id", "at", "number", "commit", "metric", "note"]
    got = sorted((tuple(r) for r in joined.collect()), key=str)
    assert got == by_definition(requests, versions)


def test_one_instant_is_an_as_of_read(spark):
    versions = [("a", day(1), 1.0, "n"), ("a", day(5), None, "n"), ("b", day(6), 2.0, "n")]
    log = spark.createDataFrame(versions, VERSIONS)
    asked = spark.createDataFrame([("a", day(5), 0), ("b", day(5), 0)], REQUESTS)
    got = {(r.entity_id, r.commit) for r in as_of_join(asked, log, "at", ["commit"]).collect() if r.commit}
    want = {(r.entity_id, r.commit) for r in snapshot_as_of(log, day(5), order=["commit"]).collect()}
    assert got == want == {("a", day(5))}


def test_empty_sides_and_clashing_names(spark):
    log = spark.createDataFrame([("a", day(1), 1.0, "n")], VERSIONS)
    asked = spark.createDataFrame([("a", day(2), 1)], REQUESTS)
    assert as_of_join(asked.limit(0), log, "at", ["metric"]).collect() == []
    assert as_of_join(asked, log.limit(0), "at", ["metric"]).first().metric is None
    with pytest.raises(ValueError):
        as_of_join(asked.withColumnRenamed("number", "metric"), log, "at", ["metric"])


def test_there_is_no_range_join_and_a_hot_entity_is_dealt_out(spark):
    log = spark.createDataFrame([("a", day(1), 1.0, "n")], VERSIONS)
    asked = spark.createDataFrame([("a", day(2), 1)], REQUESTS)
    plan = as_of_join(asked, log, "at", ["metric"])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Join" not in plan
    # Only the one row per stretch goes by entity alone.
    walks = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)
    assert any("__stretch" in w for w in walks)


def test_a_request_carries_its_entity_and_instant_once(spark):
    log = spark.createDataFrame([("a", day(1), 1.0, "n")], VERSIONS)
    asked = spark.createDataFrame([("a", day(2), 1)], REQUESTS)
    joined = as_of_join(asked, log, "at", ["metric"])
    plan = joined._jdf.queryExecution().analyzed().toString()
    carried = [line for line in plan.split("\n") if "AS __request" in line and "number" in line]
    assert carried and not any("at, at#" in line or "entity_id, entity_id#" in line for line in carried)
    assert joined.collect() == [("a", day(2), 1, 1.0)]
