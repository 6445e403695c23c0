"""The batch jobs: responses to documents, documents to log, log to history, history to view."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.operators.history import history_table, with_history_json
from tidelog.operators.ingest import (
    PAGE_SIZE,
    collect_documents,
    document_runs,
    failed_responses,
    file_instant,
    file_origin,
    flatten_places,
)
from tidelog.operators.snapshots import validity_intervals
from tidelog.operators.timeline import load_timeline
from tidelog.operators.trends import display_rows
from tidelog.sources.bases import EVERY, maintain_bases
from tidelog.sources.history import publish_history, read_latest_history
from tidelog.sources.locations import with_location_names
from tidelog.sources.log import LAYOUT, append_batch, read_commits, read_log
from tidelog.sources.raw import (
    read_details,
    read_documents,
    read_search_pages,
    write_batch,
    write_failed,
)
from tidelog.sources.segments import update_history

KEY = ("location_key", "entity_id")


def collect(
    spark: SparkSession,
    search: str,
    details: str,
    path: str,
    page_size: int = PAGE_SIZE,
    batch: str = "all",
) -> None:
    """Join landed search pages and details responses and write raw documents, one per line.

    Failed responses are written beside them (`read_failed`).  The same batch again replaces
    its own files only.
    """
    responses, known = read_search_pages(spark, search), read_details(spark, details)
    write_batch(collect_documents(responses, known, page_size), path, batch)
    write_failed(failed_responses(responses, known), path, batch)


def ingest_documents(
    spark: SparkSession,
    path: str,
    root: str,
    batch: str,
    commit: str | None = None,
    multi_line: bool = True,
    layout: Sequence[str] = LAYOUT,
    location: tuple[float, float] | None = None,
) -> dict[str, int]:
    """Flatten, identify and upsert all documents under `path` as one batch.

    `commit`: the instant of the whole batch; without it each document's own, or when its
    file was written.  `location`: latitude and longitude of the search centre of the whole
    batch; without it each document's own.  Documents without usable places are commits, too, and
    with both given the batch is one even without documents.
    """
    documents = read_documents(spark, path, multi_line)
    instant = file_instant() if commit is None else F.lit(commit)
    places = flatten_places(documents, instant, location, file_origin())
    runs = document_runs(documents, instant, location)
    if commit is not None and location is not None:
        runs = runs.union(document_runs(spark.range(1), instant, location))
    return append_batch(places, root, batch, layout, runs)


def build_history(spark: SparkSession, root: str, location: str | None = None) -> DataFrame:
    """History table of every location in the log, or of one, as it is published."""
    commits = read_commits(spark, root)
    if location is not None:
        commits = commits.filter(F.col("location_key") == location)
    timeline = load_timeline(commits, ["location_key"]).settled()
    log = read_log(spark, root, location)
    intervals = validity_intervals(log, timeline, KEY)
    return with_history_json(history_table(intervals, timeline, KEY))


def run_history(
    spark: SparkSession, root: str, published_at: str, location: str | None = None
) -> int:
    """Build and publish; returns the rows written."""
    return publish_history(build_history(spark, root, location), root, published_at)


def keep_history(spark: SparkSession, root: str, run: str, every: int = EVERY) -> int:
    """Bring bases and history segments up to the log; returns the segments that were opened.

    The incremental form of `run_history`: what is read and written goes by what is new.  Read it
    with `segments.read_history`, or publish that.
    """
    maintain_bases(spark, root, every)
    return update_history(spark, root, run)


def view(
    spark: SparkSession,
    root: str,
    start: str,
    location: str | None = None,
    locations: DataFrame | None = None,
) -> DataFrame:
    """Display rows of the newest published history; filter, sort, page or export from here.

    `locations` (see `sources.locations`): adds the location's name.
    """
    rows = display_rows(read_latest_history(spark, root, location), start)
    return rows if locations is None else with_location_names(rows, locations)
