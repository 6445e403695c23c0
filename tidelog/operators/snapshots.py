"""As-of reads, validity intervals and the dense history of a keyed log.

A log holds at most one row per entity and commit (see `upsert_merge`).  A record
stays in force until the entity's next one, nulls included; nothing is ever deleted.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.operators.latest import latest_per_key
from tidelog.operators.timeline import Timeline

ENTITY = ("entity_id",)


def upsert_merge(
    batch: DataFrame, entity: Sequence[str] = ENTITY, order: Sequence[str] = ("seq",)
) -> DataFrame:
    """One row per entity and commit: the greatest `order` wins."""
    return latest_per_key(batch, [*entity, "commit"], order)


def snapshot_latest(
    log: DataFrame, entity: Sequence[str] = ENTITY, order: Sequence[str] = ("commit", "seq")
) -> DataFrame:
    """Current state: the newest record of each entity."""
    return latest_per_key(log, entity, order)


def snapshot_as_of(
    log: DataFrame,
    instant: str,
    entity: Sequence[str] = ENTITY,
    order: Sequence[str] = ("commit", "seq"),
) -> DataFrame:
    """State as it was at `instant`, that commit included."""
    return snapshot_latest(log.filter(F.col("commit") <= instant), entity, order)


# Columns of the following version; separate ones, so that unused ones are pruned.
_NEXT = {"__ordinal": "ordinal", "__commit": "commit", "__previous": "previous_commit"}


def validity_intervals(
    log: DataFrame, timeline: Timeline, entity: Sequence[str] = ENTITY
) -> DataFrame:
    """Add to each record when it is in force.

    `valid_to`: commit of the next record, null while current; `visible_until`: last
    commit that still shows this record; `ordinal`, `next_ordinal`: the same as numbers.
    """
    ahead = Window.partitionBy(*entity).orderBy("ordinal")
    versions = timeline.numbered(log).withColumns({n: F.lead(c).over(ahead) for n, c in _NEXT.items()})
    return versions.select(
        *log.columns,
        "ordinal",
        F.coalesce("__ordinal", F.col("n_commits") + 1).alias("next_ordinal"),
        "n_commits",
        F.col("__commit").alias("valid_to"),
        F.when(F.col("__ordinal").isNull(), F.col("last_commit"))
        .otherwise(F.col("__previous"))
        .alias("visible_until"),
    )


def chunks_shown(timeline: Timeline, shown: Column) -> Column:
    """Chunks of the timeline that a version is visible in; the first one alone unless `shown`."""
    first = timeline.chunk_of(F.col("ordinal"))
    last = timeline.chunk_of(F.col("next_ordinal") - 1)
    # next_ordinal > ordinal always, so the sequence never counts down.
    return F.explode(F.sequence(first, F.when(shown, last).otherwise(first))).alias("__chunk")


def slice_of_chunk(timeline: Timeline, ordinal: Column, next_ordinal: Column) -> tuple[Column, Column]:
    """Where a version's commits begin in the list of `__chunk` (from 1), and how many they are."""
    start = F.col("__chunk") * timeline.chunk
    begin = F.greatest(ordinal - 1, start)
    end = F.least(next_ordinal - 1, start + timeline.chunk)
    return (begin - start + 1).cast("int"), (end - begin).cast("int")


def history_long(
    intervals: DataFrame,
    timeline: Timeline,
    entity: Sequence[str] = ENTITY,
    metric: str = "metric",
    present_only: bool = False,
    compress: bool = False,
) -> DataFrame:
    """One row per entity and commit from its first appearance on.

    `present_only` leaves out commits with a null metric; `compress` keeps only the
    commits at which the metric differs from the one before.
    """
    if compress:
        before = Window.partitionBy(*entity).orderBy("ordinal")
        first = F.row_number().over(before) == 1
        same = F.col(metric).eqNullSafe(F.lag(metric).over(before))
        changes = intervals.withColumn("__kept", first | ~same).filter("__kept")
        if present_only:
            changes = changes.filter(F.col(metric).isNotNull())
        return changes.select(*entity, "commit", metric)
    if present_only:
        intervals = intervals.filter(F.col(metric).isNotNull())
    kept = list(dict.fromkeys([*timeline.location, *entity, metric]))
    spread = intervals.select(*kept, "ordinal", "next_ordinal", chunks_shown(timeline, F.lit(True)))
    begin, length = slice_of_chunk(timeline, F.col("ordinal"), F.col("next_ordinal"))
    return (
        spread.join(timeline.chunks(), [*timeline.location, "__chunk"])
        .withColumn("commit", F.explode(F.slice("__names", begin, length)))
        .select(*entity, "commit", metric)
    )


def retain_commits(
    log: DataFrame,
    timeline: Timeline,
    keep: int,
    entity: Sequence[str] = ENTITY,
) -> DataFrame:
    """Drop all but the last `keep` commits; older records fold into one base snapshot.

    The base sits at the oldest commit kept, so every as-of read from there on is unchanged.
    """
    if keep < 1:
        raise ValueError("keep at least one commit")
    base = timeline.rows.filter(
        F.col("ordinal") == F.greatest(F.col("n_commits") - (keep - 1), F.lit(1))
    )
    moved = timeline.with_place(log, base, F.max("commit"), "__base").withColumn(
        "__kept", F.greatest("commit", "__base")
    )
    newest = latest_per_key(moved, [*entity, "__kept"], ["commit"])
    return newest.withColumn("commit", F.col("__kept")).select(*log.columns)
