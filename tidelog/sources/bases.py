"""Base snapshots of the log: an as-of read opens one base and the commits after it.

    <root>/bases/base=<instant>/location_key=<key>/*.parquet   the whole state at that instant
    <root>/covered/base=<instant>/*.parquet   written last: the batches the base holds

A base is never changed.  A batch that comes later with commits before a base is not among the
batches the base holds; reads from that base add it, and the next base holds it.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.operators.latest import latest_per_key
from tidelog.operators.timeline import load_timeline
from tidelog.schemas import LOG, RECORD_COLUMNS
from tidelog.sources.log import KEY, ORDER, read_commits
from tidelog.sources.raw import read_or_none
from tidelog.sources.scratch import durable

#: Commits from one base to the next: the most that a read opens beside it.
EVERY = 64

_COLUMNS = [*RECORD_COLUMNS, "batch", "location_key", "commit"]
_COVERED = T.StructType([T.StructField("batch", T.StringType()), T.StructField("base", T.StringType())])


def read_bases(spark: SparkSession, root: str) -> DataFrame:
    """base, batch: the batches that each usable base holds."""
    return read_or_none(spark, _COVERED, "parquet", f"{root}/covered")


def base_instants(spark: SparkSession, root: str) -> list[str]:
    """All bases in order: one in `EVERY` commits."""
    return sorted(r["base"] for r in read_bases(spark, root).select("base").distinct().collect())


def write_base(spark: SparkSession, root: str, instant: str) -> bool:
    """Write the state at `instant` as a base, from the base before it; False if there is one already."""
    if read_bases(spark, root).filter(F.col("base") == instant).head(1):
        return False
    # What the base holds is settled first: a batch published meanwhile is not in it.
    commits = durable(read_commits(spark, root).filter(F.col("commit") <= instant))
    state = state_as_of(spark, root, commits, instant)
    (
        state.hint("rebalance", "location_key")
        .write.mode("overwrite")
        .partitionBy("location_key")
        .parquet(f"{root}/bases/base={instant}")
    )
    held = commits.select("batch").distinct().repartition(1)
    held.write.mode("overwrite").parquet(f"{root}/covered/base={instant}")
    return True


def maintain_bases(spark: SparkSession, root: str, every: int = EVERY) -> list[str]:
    """Write a base at each `every`-th commit since the newest one; returns the new ones.

    Instants of all locations count, each once.  A backlog is worked off base by base, each from
    the one before.
    """
    if every < 1:
        raise ValueError("a base needs at least one commit")
    known = base_instants(spark, root)
    commits = read_commits(spark, root)
    fresh = load_timeline(commits.filter(F.col("commit") > known[-1]) if known else commits)
    due = fresh.rows.filter(F.col("ordinal") % every == 0).orderBy("commit").select("commit").collect()
    return [r["commit"] for r in due if write_base(spark, root, r["commit"])]


def read_as_of(
    spark: SparkSession, root: str, instant: str, location: str | None = None
) -> DataFrame:
    """Records in force at `instant`, that commit included: one per location and entity."""
    commits = read_commits(spark, root).filter(F.col("commit") <= instant)
    state = state_as_of(spark, root, commits, instant, location)
    return state.select("location_key", "commit", *RECORD_COLUMNS)


def state_as_of(
    spark: SparkSession, root: str, commits: DataFrame, instant: str, location: str | None = None
) -> DataFrame:
    """As `read_as_of`, with `batch`, of the batches in `commits` alone."""
    here = F.lit(True) if location is None else F.col("location_key") == location
    wanted = commits.filter((F.col("commit") <= instant) & here)
    usable = _usable_base(spark, root, commits, instant)
    if usable is None:
        rows = read_deltas(spark, root, wanted, F.col("commit") <= instant)
        return latest_per_key(rows.filter(here), KEY, ORDER)
    held = read_bases(spark, root).filter(F.col("base") == usable).select("batch")
    late = wanted.filter(F.col("commit") <= usable).join(held, "batch", "left_anti")
    after = wanted.filter(F.col("commit") > usable).select(late.columns)
    rows = read_deltas(spark, root, after.union(late), F.col("commit") <= instant, newer=usable, late=late)
    schema = T.StructType([f for f in LOG.fields if f.name != "location_key"] + [LOG["location_key"]])
    base = spark.read.schema(schema).parquet(f"{root}/bases/base={usable}").select(*_COLUMNS)
    return latest_per_key(base.union(rows).filter(here), KEY, ORDER)


def _usable_base(spark: SparkSession, root: str, commits: DataFrame, instant: str) -> str | None:
    """The newest base up to `instant` that holds no batch beyond those of `commits`."""
    bases = read_bases(spark, root).filter(F.col("base") <= instant)
    unknown = bases.join(commits.select("batch").distinct(), "batch", "left_anti").select("base")
    newest = bases.join(unknown.distinct(), "base", "left_anti").agg(F.max("base")).first()
    return newest[0]


def _names(commits: DataFrame) -> list[str]:
    """Batches with records: after a base, those of at most `EVERY` commits and late ones."""
    return [r["batch"] for r in commits.filter("rows > 0").select("batch").distinct().collect()]


def read_deltas(
    spark: SparkSession,
    root: str,
    commits: DataFrame,
    within: Column,
    newer: str | None = None,
    late: DataFrame | None = None,
) -> DataFrame:
    """Records of the batches in `commits` `within` a range of instants, with `batch`.

    Batches are opened by name: neither their folders nor those of others are listed further.  With
    `newer` only commits after it, but for the batches of `late`.
    """
    names = _names(commits)
    if not names:
        return spark.createDataFrame([], LOG).select(*_COLUMNS)
    rows = spark.read.schema(LOG).option("basePath", f"{root}/log")
    found = rows.parquet(*[f"{root}/log/batch={name}" for name in names]).filter(within)
    if newer is not None:
        added: Sequence[str] = _names(late) if late is not None else []
        fresh = F.col("commit") > newer
        found = found.filter(fresh | F.col("batch").isin(added) if added else fresh)
    return found.select(*_COLUMNS)
