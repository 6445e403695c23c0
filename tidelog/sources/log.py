"""The snapshot log on disk.

    <root>/log/batch=<id>/location_key=<key>/commit=<instant>/*.parquet
    <root>/commits/batch=<id>/*.parquet      written last: the publish marker
    <root>/rejected/batch=<id>/*.parquet     rows without identity, instant or location

Writing a batch again replaces its own folders only, so a replay changes nothing, and
readers see a batch once its commit rows are there.  A run that brought no usable record is a
commit, too: its row in `commits` says 0.
"""

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions.instants import is_instant
from tidelog.operators.ingest import accepted, identified, rejected
from tidelog.operators.latest import latest_per_key
from tidelog.operators.snapshots import retain_commits
from tidelog.operators.timeline import load_timeline
from tidelog.schemas import COMMITS, LOG, RECORD_COLUMNS, REJECTED
from tidelog.sources.raw import read_or_none
from tidelog.sources.scratch import durable

KEY = ("location_key", "entity_id")

# Of an entity's records the greatest in this order is in force.
ORDER = ("commit", "source", "seq", "batch")

# Folders below a batch.  With many small commits give ("location_key",) instead: the commit
# is then a sorted column that row-group statistics prune.  One choice holds for a whole root.
LAYOUT = ("location_key", "commit")


def append_batch(
    places: DataFrame,
    root: str,
    batch: str,
    layout: Sequence[str] = LAYOUT,
    runs: DataFrame | None = None,
) -> dict[str, int]:
    """Upsert flattened places as batch `batch`; returns the rows read, rejected and kept.

    One pass over the input: identified rows are written out once, and rejected rows, records
    and all counts come from there.  A batch that is published already is left alone.  Rows that
    agree in source and seq (documents without a request in one file) are settled by their
    contents, so a replay gives the same winner.

    Commits are the places' own locations and instants, those of rejected places included, and
    `runs` (location_key, commit): what the batch ran for, whether or not anything was found.
    """
    spark = places.sparkSession
    if _published(spark, root, batch):
        return {"read": 0, "rejected": 0, "kept": 0}
    rows = durable(identified(places))
    tallies = F.count(F.lit(1)).alias("read"), F.count("reject_reason").alias("rejected")
    counts = rows.agg(*tallies).first().asDict()
    order = ["source", "seq", "place_id", "metric", "name", "url"]
    records = latest_per_key(accepted(rows), [*KEY, "commit"], order)
    kept = _write(records, root, batch, layout)
    if counts["rejected"]:
        rejected(rows).write.mode("overwrite").parquet(f"{root}/rejected/batch={batch}")
    own = rows.select("location_key", "commit")
    _publish(spark, root, batch, own if runs is None else own.union(runs.select("location_key", "commit")))
    return {**counts, "kept": kept}


def rewrite_log(
    spark: SparkSession,
    root: str,
    target: str,
    batch: str,
    keep: int | None = None,
    layout: Sequence[str] = LAYOUT,
) -> int:
    """Copy the published log to the new root `target` as one batch; returns its rows.

    Merges the files of many small batches.  `keep`: only the last commits of each
    location, older records folded into one base snapshot.
    """
    records, runs = read_log(spark, root), read_commits(spark, root)
    if keep is not None:
        # Written out, so that its size is known: else all records of a location meet it in one task.
        timeline = load_timeline(runs, ["location_key"]).settled()
        records = retain_commits(records, timeline, keep, KEY)
        runs = timeline.rows.filter(F.col("ordinal") > F.col("n_commits") - keep)
    kept = _write(records, target, batch, layout)
    _publish(spark, target, batch, runs.select("location_key", "commit"))
    return kept


def _folder(root: str, batch: str) -> str:
    return f"{root}/log/batch={batch}"


def _written(spark: SparkSession, root: str, batch: str) -> DataFrame:
    return spark.read.schema(_log_schema(without="batch")).parquet(_folder(root, batch))


def _write(records: DataFrame, root: str, batch: str, layout: Sequence[str]) -> int:
    """Write a batch, not yet visible; its rows are counted from the file footers."""
    (
        records.select("location_key", "commit", *RECORD_COLUMNS)
        # Sizes the files: small partitions are merged, a hot location is split.
        .hint("rebalance", *layout)
        .sortWithinPartitions("location_key", "commit")
        .write.mode("overwrite")
        .partitionBy(*layout)
        .parquet(_folder(root, batch))
    )
    return _written(records.sparkSession, root, batch).count()


def _publish(spark: SparkSession, root: str, batch: str, runs: DataFrame) -> None:
    """Make a written batch visible: one row per location and commit of it or of `runs`.

    One more row names neither, so that a batch that ran for nothing is known as published, too.
    The rows are one file, which appears at once.
    """
    dated = F.coalesce(is_instant(F.col("commit")), F.lit(False)) & F.col("location_key").isNotNull()
    stood = runs.filter(dated).distinct().select("location_key", "commit", F.lit(0).alias("rows"))
    written = _written(spark, root, batch).select("location_key", "commit", F.lit(1).alias("rows"))
    found = written.union(stood).groupBy("location_key", "commit").agg(F.sum("rows").alias("rows"))
    nowhere = F.lit(None).cast("string")
    published = spark.range(1).select(nowhere.alias("location_key"), nowhere.alias("commit"), F.lit(0).alias("rows"))
    markers = found.union(published).repartition(1)
    markers.write.mode("overwrite").parquet(f"{root}/commits/batch={batch}")


def _log_schema(without: str = "") -> T.StructType:
    return T.StructType([f for f in LOG.fields if f.name != without])


def _published(spark: SparkSession, root: str, batch: str) -> bool:
    try:
        return not spark.read.schema(COMMITS).parquet(f"{root}/commits/batch={batch}").isEmpty()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def read_commits(spark: SparkSession, root: str) -> DataFrame:
    """Published commits: location_key, commit, rows (0: none usable), batch."""
    return spark.read.schema(COMMITS).parquet(f"{root}/commits").filter("location_key IS NOT NULL")


def read_log(
    spark: SparkSession, root: str, location: str | None = None, until: str | None = None
) -> DataFrame:
    """Published records, one per location, entity and commit.

    `location` and `until` (an instant, included) prune folders, or row groups where the
    layout keeps them in the files.
    """
    wanted = F.lit(True)
    if location is not None:
        wanted &= F.col("location_key") == location
    if until is not None:
        wanted &= F.col("commit") <= until
    commits = read_commits(spark, root).filter(wanted)
    return settled(read_batches(spark, root, commits).filter(wanted), commits).select(*_record_fields())


def read_batches(spark: SparkSession, root: str, commits: DataFrame) -> DataFrame:
    """Records of the batches in `commits`, with `batch`; a commit may have an entity several times."""
    rows = spark.read.schema(LOG).parquet(f"{root}/log")
    return rows.join(commits.select("batch").distinct(), "batch", "left_semi")


def settled(records: DataFrame, commits: DataFrame) -> DataFrame:
    """Of an entity's rows in one commit, from several batches, the last in order.

    Commits that one batch brought, nearly all of them, pass as they are; the others, listed by the
    commit table, are ranked.
    """
    key = ["location_key", "commit"]
    several = (
        commits.filter("rows > 0").groupBy(*key).agg(F.countDistinct("batch").alias("batches"))
    ).filter("batches > 1")
    shared = records.join(several.select(*key), key, "left_semi").select(records.columns)
    newest = Window.partitionBy(*KEY, "commit").orderBy(*[F.col(c).desc() for c in ORDER[1:]])
    last = shared.withColumn("__rank", F.row_number().over(newest)).filter("__rank = 1").drop("__rank")
    once = records.join(several.select(*key), key, "left_anti").select(records.columns)
    return once.union(last)


def _record_fields() -> list[str]:
    return ["location_key", "commit", *RECORD_COLUMNS]


def read_rejected(spark: SparkSession, root: str) -> DataFrame:
    """Rows without identity, instant or location, with the reason; none if there never were any."""
    return read_or_none(spark, REJECTED, "parquet", f"{root}/rejected")
