"""The dense history in segments, kept up from new commits only.

    <root>/segments/run=<id>/segment=<start>/location_key=<key>/*.parquet   commits and metrics per entity
    <root>/segment_runs/run=<id>/*.parquet   written last: what commits of what batches each segment holds

A segment is what lies after one base and up to the next.  A run rebuilds the segments of a
location whose commits are not those that were built, each from the state at its start and the
commits in it: as a rule the last one alone.  A late batch opens the segments of its own commits
and those through which its values last.  All other segments stay as they are on disk; readers take
the newest build of each.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions.maps import HISTORY_TYPE
from tidelog.operators.history import IDENTITY, history_map, with_history_json
from tidelog.operators.latest import latest_per_key
from tidelog.operators.snapshots import validity_intervals
from tidelog.operators.timeline import load_timeline
from tidelog.schemas import HISTORY, RECORD_COLUMNS
from tidelog.sources.bases import base_instants, read_deltas, state_as_of
from tidelog.sources.log import KEY, ORDER, read_commits
from tidelog.sources.raw import read_or_none
from tidelog.sources.scratch import durable

#: Start of the segment before any base.
FIRST = "0" * 17

_HELD = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("segment", "location_key", "commit", "batch", "run")]
)
_PARTS = T.StructType(
    [
        T.StructField("entity_id", T.StringType()),
        T.StructField("history", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("run", T.StringType()),
        T.StructField("segment", T.StringType()),
        T.StructField("location_key", T.StringType()),
    ]
)


def _segment_of(commit: Column, starts: list[str]) -> Column:
    """The segment of a commit; a base's own commit closes the segment before it."""
    before = F.filter(F.array(*[F.lit(s) for s in starts]), lambda s: s < commit)
    return F.array_max(before)


def read_held(spark: SparkSession, root: str) -> DataFrame:
    """segment, location_key, commit, batch, run: what the newest build of each segment holds."""
    built = read_or_none(spark, _HELD, "parquet", f"{root}/segment_runs")
    place = ["segment", "location_key"]
    newest = built.groupBy(*place).agg(F.max("run").alias("run"))
    return built.join(newest, [*place, "run"], "left_semi").select(*_HELD.names)


def update_history(spark: SparkSession, root: str, run: str) -> int:
    """Build the segments that new batches or bases changed; returns how many segments were opened.

    Runs order as text.  With nothing new nothing is written.  One job per segment opened.
    """
    starts = [FIRST, *base_instants(spark, root)]
    commits = durable(read_commits(spark, root))
    current = durable(
        commits.select(_segment_of(F.col("commit"), starts).alias("segment"), "location_key", "commit", "batch")
    )
    held = durable(read_held(spark, root).filter("commit IS NOT NULL").drop("run"))
    added, gone = current.exceptAll(held), held.exceptAll(current)
    opened = added.union(gone).select("segment", "location_key").distinct()
    opened = durable(opened.union(_lasting(spark, root, commits, added, held, starts)).distinct())
    segments = [r["segment"] for r in opened.select("segment").distinct().orderBy("segment").collect()]
    for start in segments:
        later = [s for s in starts if s > start]
        places = opened.filter(F.col("segment") == start).select("location_key")
        _build(spark, root, commits, places, start, later[0] if later else None).write.mode(
            "overwrite"
        ).partitionBy("location_key").parquet(f"{root}/segments/run={run}/segment={start}")
    if segments:
        # An opened segment without commits any more keeps a row, so that its old build is not read.
        markers = opened.join(current, ["segment", "location_key"], "left").select(
            "segment", "location_key", "commit", "batch"
        )
        markers.repartition(1).write.mode("overwrite").parquet(f"{root}/segment_runs/run={run}")
    return len(segments)


def _lasting(
    spark: SparkSession,
    root: str,
    commits: DataFrame,
    added: DataFrame,
    held: DataFrame,
    starts: list[str],
) -> DataFrame:
    """segment, location_key: built segments that values of new records last through.

    Up to the entity's next record.  Only records before the last segment built can: of new batches
    alone, and of the log no more than the later versions of the same entities.
    """
    built = held.select("segment", "location_key").distinct()
    newest = built.agg(F.max("segment")).first()[0]
    if newest is None:
        return built
    late = added.filter(F.col("segment") < newest)
    late = durable(late.join(commits.select("batch", "location_key", "commit", "rows"), ["batch", "location_key", "commit"]))
    if not late.head(1):
        return built.limit(0)
    new = read_deltas(spark, root, late, F.lit(True)).join(
        late.select("batch", "location_key", "commit"), ["batch", "location_key", "commit"], "left_semi"
    )
    new = new.select(*KEY, "commit").distinct()
    entities = durable(new.groupBy(*KEY).agg(F.min("commit").alias("__from")))
    since = late.agg(F.min("commit")).first()[0]
    later = commits.filter(F.col("commit") > since).join(late.select("location_key").distinct(), "location_key", "left_semi")
    versions = read_deltas(spark, root, later, F.col("commit") > since).select(*KEY, F.col("commit").alias("__next"))
    following = versions.join(entities.select(*KEY), list(KEY), "left_semi").distinct()
    # Both are versions of the same few entities; the earliest one after each new record counts.
    ends = (
        new.join(following, list(KEY), "left")
        .groupBy(*KEY, "commit")
        .agg(F.min(F.when(F.col("__next") > F.col("commit"), F.col("__next"))).alias("__next"))
    )
    listed = F.array(*[F.lit(s) for s in starts])
    shown = F.filter(
        listed, lambda s: (s >= F.col("commit")) & (F.col("__next").isNull() | (s < F.col("__next")))
    )
    lasting = ends.select(F.explode(shown).alias("segment"), "location_key").distinct()
    return lasting.join(built, ["segment", "location_key"], "left_semi")


def _build(
    spark: SparkSession, root: str, commits: DataFrame, places: DataFrame, start: str, end: str | None
) -> DataFrame:
    """location_key, entity_id, history: commit -> metric in one segment, of the given locations.

    The state at the start stands in for all records before: it moves to the first commit of the
    segment, where a record of that commit replaces it.
    """
    inside = F.col("commit") > start
    if end is not None:
        inside &= F.col("commit") <= end
    own = durable(commits.join(places, "location_key", "left_semi").filter(inside))
    line = load_timeline(own, ["location_key"]).settled()
    rows = read_deltas(spark, root, own, inside)
    if start != FIRST:
        before = state_as_of(spark, root, commits.filter(F.col("commit") <= start), start)
        rows = before.select(rows.columns).union(rows)
    firsts = own.groupBy("location_key").agg(F.min("commit").alias("__first"))
    moved = rows.join(firsts, "location_key").withColumn("__at", F.greatest("commit", "__first"))
    newest = latest_per_key(moved.select(*moved.columns), [*KEY, "__at"], ORDER)
    versions = newest.select(*KEY, F.col("__at").alias("commit"), "metric")
    return history_map(validity_intervals(versions, line, KEY), line, KEY)


def read_segments(spark: SparkSession, root: str, location: str | None = None) -> DataFrame:
    """location_key, entity_id, segment, history: the newest build of each segment."""
    here = F.lit(True) if location is None else F.col("location_key") == location
    place = ["segment", "location_key", "run"]
    newest = read_held(spark, root).filter(here).select(*place).distinct()
    parts = read_or_none(spark, _PARTS, "parquet", f"{root}/segments").filter(here)
    return parts.join(newest, place, "left_semi").select(*KEY, "segment", "history")


def read_history(spark: SparkSession, root: str, location: str | None = None) -> DataFrame:
    """The history table put together from the segments, as a full build would give it.

    Identity and entities are those of the state at the newest commit that was built.
    """
    here = F.lit(True) if location is None else F.col("location_key") == location
    held = durable(read_held(spark, root).filter(here).filter("commit IS NOT NULL"))
    commits = read_commits(spark, root).join(
        held.select("location_key", "commit", "batch"), ["location_key", "commit", "batch"], "left_semi"
    )
    last = held.agg(F.max("commit")).first()[0]
    if last is None:
        return spark.createDataFrame([], HISTORY)
    current = state_as_of(spark, root, commits.select(read_commits(spark, root).columns), last, location)
    line = load_timeline(held, ["location_key"])
    ends = line.rows.filter(F.col("ordinal") == F.col("n_commits")).select(
        "location_key", "last_commit", "previous_commit"
    )
    # Keys of different segments differ, and follow each other in the order of the segments.
    parts = F.struct("segment", F.map_entries("history").alias("entries"))
    joined = F.flatten(F.transform(F.sort_array(F.collect_list(parts)), lambda p: p["entries"]))
    maps = read_segments(spark, root, location).groupBy(*KEY).agg(
        F.map_from_entries(joined).cast(HISTORY_TYPE).alias("history")
    )
    at = lambda commit: F.try_element_at("history", F.col(commit))
    rows = (
        current.select(*KEY, *IDENTITY)
        .join(maps, list(KEY), "left")
        .join(ends, "location_key")
        .withColumn("history", F.coalesce("history", F.create_map().cast(HISTORY_TYPE)))
        .withColumn("metric_change", F.coalesce(at("last_commit") - at("previous_commit"), F.lit(0.0)))
    )
    return with_history_json(rows).select(*HISTORY.names)
