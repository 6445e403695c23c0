import json
import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import day
from tidelog.operators import ingest, pages
from tidelog.operators.latest import duplicate_keys
from tidelog.plans import jobs
from tidelog.sources import history as published
from tidelog.sources import locations
from tidelog.sources import log as log_store
from tidelog.sources import raw
from tidelog.streaming.ingest import start_ingest, stream_documents


def place(name, lat, lng, rating, place_id=None):
    return {
        "place_id": place_id or f"id {name}",
        "name": name,
        "formatted_address": f"address of {name}",
        "geometry": {"location": {"lat": lat, "lng": lng}},
        "url": f"url/{name}",
        "rating": rating,
        "types": ["cafe"],
    }


def document(places, request="r", commit=None, lat=25.0):
    doc = {"request_id": request, "location": {"lat": lat, "lng": 121.5}, "radius": 5000, "places": places}
    return doc if commit is None else {**doc, "commit": commit}


def land(folder, name, doc):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(json.dumps(doc, indent=2))
    return str(folder / name)


SHOP1 = ("Mill Bakery", 48.2081, 16.3713)
SHOP2 = ("Dock Diner", 48.2104, 16.3702)


def test_two_commits_from_document_to_view(spark, tmp_path):
    root = str(tmp_path / "root")
    first = land(tmp_path / "raw", "1.json", document([place(*SHOP1, 3.1), place(*SHOP2, 4.7)]))
    second = land(tmp_path / "raw", "2.json", document([place(*SHOP1, 3.9), place(*SHOP2, 4.4)]))
    for n, path in enumerate((first, second), 1):
        counts = jobs.ingest_documents(spark, path, root, f"b{n}", commit=day(n))
        assert counts == {"read": 2, "rejected": 0, "kept": 2}
    assert jobs.run_history(spark, root, day(3)) == 2
    rows = {r["name"]: r for r in jobs.view(spark, root, day(1)).collect()}
    assert json.loads(rows["Mill Bakery"]["history"]) == {day(1): 3.1, day(2): 3.9}
    assert rows["Mill Bakery"]["metric_change"] == pytest.approx(0.8, abs=0.01)
    assert rows["Dock Diner"]["metric_change"] == pytest.approx(-0.3, abs=0.01)
    assert rows["Dock Diner"]["location_key"] == "25.0_121.5"
    assert rows["Dock Diner"]["range_text"] == "-0.3"


def unplaced(doc):
    """A document as some collectors write it: without request, instant and location."""
    return {"places": doc["places"]}


def test_two_commits_of_documents_without_location(spark, tmp_path):
    root, folder = str(tmp_path / "root"), tmp_path / "raw"
    for n, (a, b) in enumerate(((3.1, 4.7), (3.9, 4.4)), 1):
        path = land(folder, f"{n}.json", unplaced(document([place(*SHOP1, a), place(*SHOP2, b)])))
        counts = jobs.ingest_documents(spark, path, root, f"b{n}", day(n), location=(48.2, 16.4))
        assert counts == {"read": 2, "rejected": 0, "kept": 2}
    rows = {r["name"]: r for r in jobs.build_history(spark, root).collect()}
    assert {r["location_key"] for r in rows.values()} == {"48.2_16.4"}
    assert rows["Mill Bakery"]["metric_change"] == pytest.approx(0.8, abs=0.01)
    assert rows["Dock Diner"]["metric_change"] == pytest.approx(-0.3, abs=0.01)


def test_rows_without_any_location_are_counted_and_set_aside(spark, tmp_path):
    root = str(tmp_path / "root")
    assert log_store.read_rejected(spark, root).isEmpty()
    path = land(tmp_path / "raw", "1.json", unplaced(document([place(*SHOP1, 4.2), place(*SHOP2, 1.0)])))
    counts = jobs.ingest_documents(spark, path, root, "b1", commit=day(1))
    assert counts == {"read": 2, "rejected": 2, "kept": 0}
    reasons = [r["reject_reason"] for r in log_store.read_rejected(spark, root).collect()]
    assert reasons == ["missing location"] * 2


def test_the_greatest_number_of_a_request_wins_over_its_parts(spark, tmp_path):
    root, folder = str(tmp_path / "root"), tmp_path / "raw"
    for start, rating in ((20, 4.0), (0, 3.0), (40, 2.0)):
        doc = {**document([place(*SHOP1, rating)], "q", day(1)), "first_seq": start}
        land(folder, f"{start}.json", doc)
    jobs.ingest_documents(spark, str(folder), root, "b1")
    row = log_store.read_log(spark, root).first()
    assert (row["metric"], row["seq"]) == (2.0, 40)


def test_documents_without_request_are_told_apart_by_file(spark, tmp_path):
    folder, got = tmp_path / "raw", set()
    for name, rating in (("b.json", 2.0), ("a.json", 3.0)):
        land(folder, name, {**document([place(*SHOP1, rating)], commit=day(1)), "request_id": None})
    for n in range(2):
        root = str(tmp_path / f"root{n}")
        jobs.ingest_documents(spark, str(folder), root, "b1")
        row = log_store.read_log(spark, root).first()
        got.add((row["metric"], row["source"].rsplit("/", 1)[1]))
    assert got == {(2.0, "b.json")}


def test_one_commit_has_no_change(spark, tmp_path):
    root = str(tmp_path / "root")
    shops = [place(*SHOP1, 4.2), place(*SHOP2, 3.8), place("Hill Books", 25.1, 121.6, 4.5)]
    path = land(tmp_path / "raw", "1.json", document(shops))
    jobs.ingest_documents(spark, path, root, "b1", commit=day(1))
    got = jobs.build_history(spark, root)
    assert [r["metric_change"] for r in got.collect()] == [0.0] * 3
    wanted = {"entity_id", "name", "latitude", "longitude", "url", "history", "metric_change"}
    assert wanted <= set(got.columns)


def test_flatten_keeps_order_and_skips_empty_lists(spark, tmp_path):
    folder = tmp_path / "raw"
    land(folder, "1.json", document([place(*SHOP1, 4), place(*SHOP2, 3)], "a", day(1)))
    land(folder, "2.json", document([], "b", day(1)))
    land(folder, "3.json", {"request_id": "c"})
    rows = ingest.flatten_places(raw.read_documents(spark, str(folder))).orderBy("seq").collect()
    assert [(r["name"], r["seq"], r["metric"]) for r in rows] == [("Mill Bakery", 0, 4.0), ("Dock Diner", 1, 3.0)]
    assert rows[0]["types"] == ["cafe"] and rows[0]["location_key"] == "25.0_121.5"
    info = ingest.basic_info(spark.createDataFrame(rows))
    assert "types" not in info.columns and {len(r[0]) for r in info.select("entity_id").collect()} == {12}


def test_rows_without_identity_are_set_aside(spark, tmp_path):
    root = str(tmp_path / "root")
    bad = [place(None, 1.0, 2.0, 3.0), place("x", None, 2.0, 3.0)]
    path = land(tmp_path / "raw", "1.json", document([place(*SHOP1, 4.2), *bad]))
    counts = jobs.ingest_documents(spark, path, root, "b1", commit=day(1))
    assert counts == {"read": 3, "rejected": 2, "kept": 1}
    reasons = [r[0] for r in log_store.read_rejected(spark, root).select("reject_reason").collect()]
    assert sorted(reasons) == ["missing latitude", "missing name"]
    unusable = land(tmp_path / "raw", "2.json", document([place(*SHOP2, 4.2)], commit="2025"))
    assert jobs.ingest_documents(spark, unusable, root, "b2")["rejected"] == 1


def test_duplicates_within_a_batch(spark, tmp_path):
    root = str(tmp_path / "root")
    twice = [place(*SHOP1, 4.2, "old"), place(*SHOP1, 4.9, "new")]
    path = land(tmp_path / "raw", "1.json", document(twice))
    assert jobs.ingest_documents(spark, path, root, "b1", commit=day(1))["kept"] == 1
    row = log_store.read_log(spark, root).first()
    assert (row["place_id"], row["metric"]) == ("new", 4.9)


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "root")
    path = land(tmp_path / "raw", "1.json", document([place(*SHOP1, 4.2)]))
    for _ in range(2):
        jobs.ingest_documents(spark, path, root, "b1", commit=day(1))
    assert log_store.read_log(spark, root).count() == 1
    assert log_store.read_commits(spark, root).count() == 1


def test_a_document_without_places_is_a_commit(spark, tmp_path):
    root = str(tmp_path / "root")
    full = land(tmp_path / "raw", "1.json", document([place(*SHOP1, 4.2)]))
    empty = land(tmp_path / "raw", "2.json", document([]))
    jobs.ingest_documents(spark, full, root, "b1", commit=day(1))
    counts = jobs.ingest_documents(spark, empty, root, "b2", commit=day(2))
    assert counts == {"read": 0, "rejected": 0, "kept": 0}
    commits = {r["commit"]: r["rows"] for r in log_store.read_commits(spark, root).collect()}
    assert commits == {day(1): 1, day(2): 0}


def test_unpublished_rows_are_invisible(spark, tmp_path):
    root = str(tmp_path / "root")
    path = land(tmp_path / "raw", "1.json", document([place(*SHOP1, 4.2)]))
    jobs.ingest_documents(spark, path, root, "b1", commit=day(1))
    written = spark.read.parquet(f"{root}/log/batch=b1")
    # A writer that died before its commit rows.
    written.withColumn("commit", F.lit(day(2))).write.partitionBy("location_key", "commit").parquet(
        f"{root}/log/batch=b2"
    )
    assert [r["commit"] for r in log_store.read_log(spark, root).collect()] == [day(1)]


def test_several_batches_of_one_commit(spark, tmp_path):
    root = str(tmp_path / "root")
    folder = tmp_path / "raw"
    one = land(folder, "1.json", document([place(*SHOP1, 4.2)], "a", day(1)))
    two = land(folder, "2.json", document([place(*SHOP1, 4.4), place(*SHOP2, 3.0)], "b", day(1)))
    three = land(folder, "3.json", document([place(*SHOP2, 3.1)], "c", day(2)))
    for n, path in enumerate((two, one, three)):
        jobs.ingest_documents(spark, path, root, f"b{n}")
    got = log_store.read_log(spark, root).select("commit", "name", "metric").collect()
    assert sorted(map(tuple, got)) == [
        (day(1), "Dock Diner", 3.0),
        (day(1), "Mill Bakery", 4.4),
        (day(2), "Dock Diner", 3.1),
    ]
    until = log_store.read_log(spark, root, until=day(1))
    assert until.count() == 2


def test_a_document_without_instant_takes_that_of_its_file(spark, tmp_path):
    root = str(tmp_path / "root")
    path = land(tmp_path / "raw", "1.json", document([place(*SHOP1, 4.2)]))
    os.utime(path, (1748180150, 1748180150))  # 2025-05-25 13:35:50 UTC
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Taipei")
    try:
        jobs.ingest_documents(spark, path, root, "b1")
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert log_store.read_commits(spark, root).first()["commit"] == "20250525133550000"


def test_rewriting_the_log_keeps_its_contents(spark, tmp_path):
    root, folder = str(tmp_path / "root"), tmp_path / "raw"
    for d, rating in ((1, 4.0), (2, 4.5), (3, 3.0)):
        path = land(folder, f"{d}.json", document([place(*SHOP1, rating)], f"r{d}", day(d)))
        jobs.ingest_documents(spark, path, root, f"b{d}")
    whole, short = str(tmp_path / "whole"), str(tmp_path / "short")
    assert log_store.rewrite_log(spark, root, whole, "base") == 3
    before, after = (sorted(map(tuple, log_store.read_log(spark, r).collect())) for r in (root, whole))
    assert before == after
    assert log_store.rewrite_log(spark, root, short, "base", keep=2) == 2
    history = json.loads(jobs.build_history(spark, short).first()["history"])
    assert history == {day(2): 4.5, day(3): 3.0}


def test_a_log_without_commit_folders(spark, tmp_path):
    root, flat, folder = str(tmp_path / "root"), str(tmp_path / "flat"), tmp_path / "raw"
    for d, rating in ((1, 4.0), (2, 4.5)):
        path = land(folder, f"{d}.json", document([place(*SHOP1, rating)], f"r{d}", day(d)))
        jobs.ingest_documents(spark, path, root, f"b{d}")
    layout = ("location_key",)
    assert log_store.rewrite_log(spark, root, flat, "base", layout=layout) == 2
    before, after = (sorted(map(tuple, log_store.read_log(spark, r).collect())) for r in (root, flat))
    assert before == after
    path = land(folder, "3.json", document([place(*SHOP1, 3.0)], "r3", day(3)))
    jobs.ingest_documents(spark, path, flat, "b3", layout=layout)
    assert json.loads(jobs.build_history(spark, flat).first()["history"]) == {
        day(1): 4.0,
        day(2): 4.5,
        day(3): 3.0,
    }
    early = log_store.read_log(spark, flat, until=day(1))
    assert early.count() == 1
    assert "LessThanOrEqual(commit" in early._jdf.queryExecution().executedPlan().toString()


def test_each_location_has_its_own_timeline(spark, tmp_path):
    root, folder = str(tmp_path / "root"), tmp_path / "raw"
    north = [land(folder, f"n{d}.json", document([place(*SHOP1, r)], f"n{d}", day(d), 25.0)) for d, r in ((1, 4.0), (3, 4.5))]
    south = [land(folder, f"s{d}.json", document([place(*SHOP1, r)], f"s{d}", day(d), 20.0)) for d, r in ((1, 3.0), (2, 2.0))]
    for n, path in enumerate(north + south):
        jobs.ingest_documents(spark, path, root, f"b{n}")
    rows = {r["location_key"]: r for r in jobs.build_history(spark, root).collect()}
    assert json.loads(rows["25.0_121.5"]["history"]) == {day(1): 4.0, day(3): 4.5}
    assert rows["25.0_121.5"]["metric_change"] == 0.5
    assert rows["20.0_121.5"]["metric_change"] == -1.0
    only = jobs.build_history(spark, root, "20.0_121.5").collect()
    assert [r["location_key"] for r in only] == ["20.0_121.5"]


def test_stream_ingests_each_document_once(spark, tmp_path):
    root, folder, checkpoint = str(tmp_path / "root"), tmp_path / "raw", str(tmp_path / "check")

    def run():
        query = start_ingest(stream_documents(spark, str(folder), files_per_batch=1), root, checkpoint)
        query.awaitTermination()
        assert query.exception() is None

    # Documents land out of order; the commit is in the document.
    land(folder, "z.json", document([place(*SHOP1, 4.5)], "b", day(2)))
    land(folder, "y.json", document([place(*SHOP1, 4.2)], "a", day(1)))
    run()
    run()
    assert log_store.read_log(spark, root).count() == 2
    land(folder, "x.json", document([place(*SHOP1, 4.1), place(*SHOP2, 3.0)], "c", day(3)))
    run()
    history = jobs.build_history(spark, root).filter("name = 'Mill Bakery'").first()
    assert json.loads(history["history"]) == {day(1): 4.2, day(2): 4.5, day(3): 4.1}
    assert history["metric_change"] == pytest.approx(-0.4)


def test_the_newest_complete_run_is_read_whole(spark, tmp_path):
    root = str(tmp_path / "root")
    path = land(tmp_path / "raw", "1.json", document([place(*SHOP1, 4.2), place(*SHOP2, 3.0)]))
    jobs.ingest_documents(spark, path, root, "b1", commit=day(1))
    jobs.run_history(spark, root, day(5))
    jobs.run_history(spark, root, day(6))
    # A later run that died before its marker.
    part = jobs.build_history(spark, root).limit(1)
    part.write.partitionBy("location_key").parquet(f"{root}/history/run={day(7)}")
    assert [r["run"] for r in published.latest_runs(spark, root).collect()] == [day(6)]
    assert published.read_latest_history(spark, root).count() == 2
    assert published.read_latest_history(spark, root, location="nowhere").isEmpty()


def test_a_run_of_one_location_leaves_the_others(spark, tmp_path):
    root, folder = str(tmp_path / "root"), tmp_path / "raw"

    def collect(number, lat, rating):
        doc = document([place(*SHOP1, rating)], f"r{number}", day(number), lat)
        jobs.ingest_documents(spark, land(folder, f"{number}.json", doc), root, f"b{number}")

    collect(1, 25.0, 4.0)
    collect(2, 20.0, 3.0)
    assert jobs.run_history(spark, root, day(5)) == 2
    collect(6, 20.0, 3.5)
    assert jobs.run_history(spark, root, day(7), location="20.0_121.5") == 1
    got = {r["location_key"]: r["metric_change"] for r in published.read_latest_history(spark, root).collect()}
    assert got == {"25.0_121.5": 0.0, "20.0_121.5": 0.5}
    one = published.read_latest_history(spark, root, "25.0_121.5", columns=["name"])
    assert one.columns == ["name"] and one.count() == 1


def test_a_batch_cut_off_before_publishing_is_written_again(spark, tmp_path):
    root = str(tmp_path / "root")
    path = land(tmp_path / "raw", "1.json", document([place(*SHOP1, 4.2)]))
    jobs.ingest_documents(spark, path, root, "b1", commit=day(1))
    # Left behind by a writer that died: another file under the batch to come.
    remains = spark.read.parquet(f"{root}/log/batch=b1").withColumn("commit", F.lit(day(2)))
    remains.write.partitionBy("location_key", "commit").parquet(f"{root}/log/batch=b2")
    again = land(tmp_path / "raw", "2.json", document([place(*SHOP1, 4.9)]))
    jobs.ingest_documents(spark, again, root, "b2", commit=day(3))
    got = [(r["commit"], r["metric"]) for r in log_store.read_log(spark, root).collect()]
    assert sorted(got) == [(day(1), 4.2), (day(3), 4.9)]


def test_documents_round_trip_in_bounded_parts(spark, tmp_path):
    rows = spark.range(25).select(
        F.col("id").alias("n"), F.lit("q").alias("request"), F.concat(F.lit("p"), "id").alias("name")
    )
    element = F.struct(
        F.col("n").cast("string").alias("place_id"),
        "name",
        F.lit("a").alias("formatted_address"),
        F.struct(F.struct(F.lit(1.0).alias("lat"), F.lit(2.0).alias("lng")).alias("location")).alias("geometry"),
        F.lit("u").alias("url"),
        F.lit(4.0).alias("rating"),
        F.array(F.lit("t")).alias("types"),
    )
    header = [
        F.concat("request", F.lit("-"), F.col("part").cast("string")).alias("request_id"),
        F.lit(day(1)).alias("commit"),
        F.struct(F.lit(25.0).alias("lat"), F.lit(121.0).alias("lng")).alias("location"),
        F.lit(100).alias("radius"),
    ]
    documents = ingest.nest_documents(rows, ["request"], "n", header, element, max_places=10)
    for one_per_file in (True, False):
        path = str(tmp_path / f"docs-{one_per_file}")
        raw.write_documents(documents, path, one_per_file)
        back = raw.read_documents(spark, path, multi_line=one_per_file)
        assert sorted(r["n"] for r in back.select(F.size("places").alias("n")).collect()) == [5, 10, 10]
        flat = ingest.flatten_places(back).orderBy("source", "seq").collect()
        assert [r["place_id"] for r in flat] == [str(i) for i in range(25)]


def test_details_override(spark):
    base = spark.createDataFrame(
        [("a", "A", 1.0, "x"), ("b", "B", 2.0, "y"), (None, "C", 3.0, "z")],
        "place_id string, name string, metric double, tag string",
    )
    details = spark.createDataFrame([("a", "AA", None)], "place_id string, name string, metric double")
    got = lambda strict: sorted(map(tuple, ingest.enrich_details(base, details, strict=strict).collect()))
    assert got(False) == [("a", "AA", 1.0, "x"), ("b", "B", 2.0, "y")]
    assert got(True) == [("a", "AA", None, "x"), ("b", "B", 2.0, "y")]


def test_documents_from_landed_responses(spark, tmp_path):
    def page(number, status, *places, request="q"):
        return {
            "request_id": request,
            "commit": day(1),
            "location": {"lat": 25.0, "lng": 121.5},
            "radius": 500,
            "page": number,
            "status": status,
            "results": list(places),
        }

    found = [place(*SHOP1, 4.0, "a"), place(*SHOP2, 3.0, "b"), place("Lost", 1.0, 1.0, 1.0, "c")]
    del found[0]["url"]
    lines = [page(1, "OK", found[1]), page(0, "OK", found[0]), page(2, "OVER_QUERY_LIMIT", found[2])]
    lines.append({**page(0, "ZERO_RESULTS"), "request_id": "none"})
    found_again = {**found[0], "rating": 2.0}
    lines.append({**page(0, "OK", found_again, request="later"), "commit": day(8)})
    known = {"request_id": "q", "place_id": "a", "status": "OK", "result": {"url": "u", "rating": 4.4, "ignored": 1}}
    details = [
        known,
        known,
        {**known, "request_id": "later", "result": {"rating": 2.2}},
        {"request_id": "q", "place_id": "b", "status": "NOT_FOUND", "error_message": "gone"},
    ]
    for name, rows in (("search", lines), ("details", details)):
        (tmp_path / name).write_text("\n".join(json.dumps(r) for r in rows))
    path = str(tmp_path / "raw")
    for _ in range(2):  # a replay replaces what was written
        jobs.collect(spark, str(tmp_path / "search"), str(tmp_path / "details"), path)
    got, later = raw.read_documents(spark, path, multi_line=False).orderBy("commit").collect()
    assert [(p["place_id"], p["rating"], p["url"]) for p in later["places"]] == [("a", 2.2, None)]
    failed = raw.read_failed(spark, path).orderBy("kind").collect()
    assert [(r["kind"], r["place_id"], r["page"], r["status"], r["error_message"]) for r in failed] == [
        ("details", "b", None, "NOT_FOUND", "gone"),
        ("search", None, 2, "OVER_QUERY_LIMIT", None),
    ]
    assert raw.read_failed(spark, str(tmp_path / "nothing")).isEmpty()
    assert (got["request_id"], got["radius"]) == ("q", 500)
    places = [(p["place_id"], p["name"], p["rating"], p["url"]) for p in got["places"]]
    assert places == [("a", "Mill Bakery", 4.4, "u"), ("b", "Dock Diner", 3.0, "url/Dock Diner")]


def test_statuses(spark):
    df = spark.createDataFrame([("OK",), ("ZERO_RESULTS",), ("DENIED",), (None,)], "status string")
    assert ingest.successful(df, ingest.SEARCH_OK).count() == 2
    assert ingest.successful(df, ingest.DETAILS_OK).count() == 1
    assert ingest.unsuccessful(df, ingest.SEARCH_OK).count() == 2


def test_pages(spark):
    a = spark.createDataFrame([(1, "x", 0)], "id long, name string, page int")
    b = spark.createDataFrame([(1, 1), (2, 1)], "id long, page int")
    union = pages.union_pages([a, b])
    assert union.count() == 3
    assert [tuple(r) for r in duplicate_keys(union, ["id"]).collect()] == [(1, 2)]
    unique = pages.unique_rows(union, ["id"], ["page"])
    assert sorted(map(tuple, unique.collect())) == [(1, None, 1), (2, None, 1)]
    with pytest.raises(ValueError):
        pages.union_pages([])


def test_daily_rows(spark, tmp_path):
    path = tmp_path / "d.json"
    path.write_text('{"date":"2025-01-01","current_popularity":3}\n{"date":"2025-01-02","current_popularity":4.5}\n')
    got = raw.read_daily(spark, str(path)).orderBy("date").collect()
    assert [tuple(r) for r in got] == [("2025-01-01", 3.0), ("2025-01-02", 4.5)]


def test_locations_have_names(spark, tmp_path):
    path = tmp_path / "centres.json"
    centres = [
        {"name": "Old Town", "latitude": 25.0, "longitude": 121.5, "radius": 500},
        {"name": "A", "latitude": 25.0, "longitude": 121.5},
        {"name": " ", "latitude": 1.0, "longitude": 2.0}, {"name": "nowhere", "latitude": 1.0},
    ]
    path.write_text(json.dumps(centres))
    known = locations.read_locations(spark, str(path))
    assert known.count() == 2
    rows = spark.createDataFrame([("25.0_121.5", 1), ("1.0_2.0", 2), ("9.0_9.0", 3), (None, 4)], "location_key string, n int")
    got = {r.n: r.location_name for r in locations.with_location_names(rows, known).collect()}
    assert got == {1: "Old Town", 2: "1.0_2.0", 3: "9.0_9.0", 4: None}


def test_rewriting_meets_the_timeline_without_moving_records_by_location(spark, tmp_path):
    root, target = str(tmp_path / "root"), str(tmp_path / "target")
    path = land(tmp_path / "raw", "1.json", document([place(*SHOP1, 4.0)], "r1", day(1)))
    jobs.ingest_documents(spark, path, root, "b1")
    log_store.rewrite_log(spark, root, target, "base", keep=1)
    store = spark._jsparkSession.sharedState().statusStore().executionsList()
    plans = [store.apply(i).physicalPlanDescription() for i in range(store.size())]
    # Executions of other tests in the session may have no plan to tell.
    own = next(p for p in plans if p and f"{target}/log" in p and "InsertIntoHadoopFs" in p)
    assert "BroadcastHashJoin LeftOuter" in own and "SortMergeJoin LeftOuter" not in own
