"""As-of reads from bases and the history in segments: equal to a full build, whatever the order of batches."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import day
from tidelog.operators.snapshots import snapshot_latest
from tidelog.plans import jobs
from tidelog.schemas import HISTORY
from tidelog.sources import bases, segments
from tidelog.sources import log as log_store

PLACES = (
    "location_key string, commit string, source string, seq long, place_id string, name string, address string,"
    "latitude double, longitude double, url string, metric double, types array<string>"
)


def place(location, commit, name, metric, seq=0, source="r", latitude=1.0):
    return (location, commit, source, seq, "p", name, "a", latitude, 2.0, f"u{commit[6:8]}", metric, ["t"])


def append(spark, root, batch, rows, runs=()):
    stood = spark.createDataFrame(list(runs), "location_key string, commit string")
    return log_store.append_batch(spark.createDataFrame(rows, PLACES), root, batch, runs=stood)


def random_batches(seed, days=10):
    """Batches of a few days each, one late by several batches, commits without rows, two locations."""
    rng = random.Random(seed)
    batches = []
    for first in range(1, days, 3):
        rows = [
            place(location, day(d), f"n{e}", rng.choice([None, 1.0, 2.0, 3.5]), e)
            for d in range(first, min(first + 3, days + 1))
            for location in ("A", "B")
            if not (location == "B" and d % 2)
            for e in range(8)
            if rng.random() < 0.35
        ]
        batches.append((f"b{first:02d}", rows, [("A", day(first))]))
    late = [place("A", day(d), f"n{e}", 9.0, 99, "z") for d in (2, 5, 6) for e in (1, 4)]
    batches.insert(3, ("late", late, [("B", day(3))]))
    return batches


def state(df):
    return sorted(tuple(r) for r in df.select("location_key", "entity_id", "commit", "metric", "url").collect())


def table(df):
    return sorted(tuple(r) for r in df.select(HISTORY.names).collect())


def by_definition(spark, root, instant, location=None):
    log = log_store.read_log(spark, root, location, until=instant)
    return snapshot_latest(log, log_store.KEY, ["commit"])


def test_as_of_reads_and_history_equal_a_full_build_after_each_batch(spark, tmp_path):
    root = str(tmp_path / "root")
    for n, (batch, rows, runs) in enumerate(random_batches(1)):
        append(spark, root, batch, rows, runs)
        if n % 2 == 0:
            bases.maintain_bases(spark, root, every=3)
            segments.update_history(spark, root, f"r{n:03d}")
            built = table(jobs.build_history(spark, root))
            assert table(segments.read_history(spark, root)) == built
    for instant in (day(1), day(4), day(9), day(28)):
        assert state(bases.read_as_of(spark, root, instant)) == state(by_definition(spark, root, instant))
    assert state(bases.read_as_of(spark, root, day(9), "B")) == state(by_definition(spark, root, day(9), "B"))
    assert len(bases.base_instants(spark, root)) >= 3


def test_replays_change_nothing_and_open_nothing(spark, tmp_path):
    root = str(tmp_path / "root")
    batches = random_batches(3, days=6)
    for batch, rows, runs in batches:
        append(spark, root, batch, rows, runs)
    bases.maintain_bases(spark, root, every=2)
    assert segments.update_history(spark, root, "r1") > 1
    before = table(segments.read_history(spark, root))
    for batch, rows, runs in batches:
        append(spark, root, batch, rows, runs)
    assert bases.maintain_bases(spark, root, every=2) == []
    assert segments.update_history(spark, root, "r2") == 0
    assert table(segments.read_history(spark, root)) == before


def test_one_new_commit_opens_one_segment_and_a_late_one_those_it_lasts_through(spark, tmp_path):
    root = str(tmp_path / "root")
    rows = [place("A", day(d), n, float(d), i) for d in range(1, 7) for i, n in enumerate(("often", f"once{d}"))]
    append(spark, root, "b1", rows)
    bases.maintain_bases(spark, root, every=2)
    assert bases.base_instants(spark, root) == [day(2), day(4), day(6)]
    # The last base closes the third segment and nothing lies behind it.
    assert segments.update_history(spark, root, "r1") == 3
    append(spark, root, "b7", [place("A", day(7), "often", 13.0)])
    assert segments.update_history(spark, root, "r2") == 1
    # Replaced at the next commit already: the late value stays in the first segment.
    append(spark, root, "late1", [place("A", day(1), "often", 0.5, 9, "z")])
    assert segments.update_history(spark, root, "r3") == 1
    # Never observed again: it lasts through all of them.
    append(spark, root, "late2", [place("A", day(1), "once1", 0.5, 9, "z")])
    assert segments.update_history(spark, root, "r4") == 4
    assert table(segments.read_history(spark, root)) == table(jobs.build_history(spark, root))


def test_bases_that_come_after_the_history_move_its_segments(spark, tmp_path):
    root = str(tmp_path / "root")
    append(spark, root, "b", [place("A", day(d), f"n{d % 3}", float(d)) for d in range(1, 10)])
    assert segments.update_history(spark, root, "r1") == 1
    bases.maintain_bases(spark, root, every=2)
    assert segments.update_history(spark, root, "r2") == 5
    built = table(jobs.build_history(spark, root))
    assert table(segments.read_history(spark, root)) == built


def test_files_opened_do_not_grow_with_history(spark, tmp_path):
    """The base and what follows it, whatever lies before; folders of older batches are not listed."""
    root, opened, scanned = str(tmp_path / "root"), [], []
    for d in range(1, 10):
        append(spark, root, f"b{d:02d}", [place("A", day(d), f"n{e}", float(d)) for e in range(3)])
        bases.maintain_bases(spark, root, every=3)
        df = bases.read_as_of(spark, root, day(28))
        files = df.inputFiles()
        opened.append(len({m for f in files for m in re.findall(r"batch=b\d+|base=\d+", f)}))
        scanned.append(len(files))
    assert max(opened) <= 3 and opened[-1] == opened[2] and max(scanned[6:]) <= max(scanned[3:6])
    early = bases.read_as_of(spark, root, day(4)).inputFiles()
    assert {m for f in early for m in re.findall(r"batch=b\d+|base=\d+", f)} == {f"base={day(3)}", "batch=b04"}


def test_a_base_is_used_only_once_it_is_complete(spark, tmp_path):
    root = str(tmp_path / "root")
    append(spark, root, "b1", [place("A", day(1), "n", 1.0), place("A", day(2), "n", 2.0)])
    spark.range(1).write.parquet(f"{root}/bases/base={day(2)}/location_key=A")  # no marker: left by a crash
    assert state(bases.read_as_of(spark, root, day(2))) == state(by_definition(spark, root, day(2)))
    assert bases.maintain_bases(spark, root, every=2) == [day(2)]
    assert state(bases.read_as_of(spark, root, day(2))) == state(by_definition(spark, root, day(2)))
    with pytest.raises(ValueError):
        bases.maintain_bases(spark, root, every=0)


def test_nothing_ingested_and_instants_before_everything(spark, tmp_path):
    root = str(tmp_path / "root")
    append(spark, root, "b1", [])
    assert bases.maintain_bases(spark, root) == [] and segments.update_history(spark, root, "r") == 0
    assert segments.read_history(spark, root).collect() == []
    append(spark, root, "b2", [place("A", day(5), "n", 1.0)])
    assert bases.read_as_of(spark, root, day(1)).collect() == []


def test_runs_without_usable_rows_are_commits(spark, tmp_path):
    """Two good runs, one with nothing, one with rejected rows only: history goes on, the change is 0."""
    root = str(tmp_path / "root")
    append(spark, root, "b1", [place("A", day(1), "n", 4.0)])
    append(spark, root, "b2", [place("A", day(2), "n", 2.0)])
    assert append(spark, root, "b3", [], [("A", day(3))]) == {"read": 0, "rejected": 0, "kept": 0}
    assert append(spark, root, "b4", [place("A", day(4), None, 5.0)])["rejected"] == 1
    commits = {r.commit: r.rows for r in log_store.read_commits(spark, root).collect()}
    assert commits == {day(1): 1, day(2): 1, day(3): 0, day(4): 0}
    row = jobs.build_history(spark, root).first()
    assert row.metric_change == 0.0
    assert row.history == f'{{"{day(1)}":4.0,"{day(2)}":2.0,"{day(3)}":2.0,"{day(4)}":2.0}}'
    # A replay, of whatever it would now bring, is left alone.
    append(spark, root, "b3", [place("A", day(3), "n", 7.0)])
    assert append(spark, root, "b5", []) == {"read": 0, "rejected": 0, "kept": 0}
    assert append(spark, root, "b5", [place("A", day(9), "n", 7.0)])["read"] == 0
    assert jobs.build_history(spark, root).first() == row
    target = str(tmp_path / "target")
    log_store.rewrite_log(spark, root, target, "all")
    assert jobs.build_history(spark, target).first() == row
    log_store.rewrite_log(spark, root, str(tmp_path / "kept"), "kept", keep=2)
    kept = log_store.read_commits(spark, str(tmp_path / "kept")).orderBy("commit").collect()
    assert [r.commit for r in kept] == [day(3), day(4)]
    assert jobs.build_history(spark, str(tmp_path / "kept")).first().metric_change == 0.0


def test_documents_without_places_and_jobs_without_documents_are_commits(spark, tmp_path):
    landed, root = str(tmp_path / "landed"), str(tmp_path / "root")
    spark.sql(
        f"select 'r1' request_id, '{day(1)}' commit, struct(25.0D lat, 121.5D lng) location, 5000 radius,"
        "  array(struct('p' place_id, 'n' name, struct(struct(1.0D lat, 2.0D lng) location) geometry, 4.0D rating)) places"
        f" union all select 'r2', '{day(2)}', struct(25.0D, 121.5D), 5000, array()"
    ).write.json(landed)
    jobs.ingest_documents(spark, landed, root, "b1", multi_line=False)
    empty = str(tmp_path / "empty")
    spark.range(0).write.json(empty)
    jobs.ingest_documents(spark, empty, root, "b2", commit=day(3), multi_line=False, location=(25.0, 121.5))
    assert [r.commit for r in log_store.read_commits(spark, root).orderBy("commit").collect()] == [day(1), day(2), day(3)]
    assert jobs.build_history(spark, root).first().history == f'{{"{day(1)}":4.0,"{day(2)}":4.0,"{day(3)}":4.0}}'


def test_commits_of_one_batch_are_not_ranked_and_shared_ones_are(spark, tmp_path):
    root = str(tmp_path / "root")
    append(spark, root, "b1", [place("A", day(1), "n", 1.0), place("A", day(2), "n", 2.0)])
    append(spark, root, "b2", [place("A", day(2), "n", 3.0, 5, "s"), place("B", day(2), "n", 4.0)])
    append(spark, root, "b3", [place("A", day(2), "n", 9.0, 4, "s")])
    got = {(r.location_key, r.commit, r.metric) for r in log_store.read_log(spark, root).collect()}
    assert got == {("A", day(1), 1.0), ("A", day(2), 3.0), ("B", day(2), 4.0)}
    assert log_store.read_log(spark, root).where(F.col("location_key") == "B").count() == 1
