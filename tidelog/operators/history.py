"""History of a metric per entity: map, change, wide view, history table."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.maps import HISTORY_TYPE, history_json
from tidelog.operators.snapshots import ENTITY, chunks_shown, slice_of_chunk
from tidelog.operators.timeline import Timeline, as_number

IDENTITY = ("name", "latitude", "longitude", "url")


def _parts(
    intervals: DataFrame, timeline: Timeline, entity: Sequence[str], metric: str, *more: str
) -> DataFrame:
    """One row per version and chunk of the timeline that shows it: `__commits`, as numbers, and the metric.

    No row is made per entity and commit, and what entities are grouped from is narrow: beside the
    commits it has the columns `more` in the version's first row alone.
    """
    keys, own = dict.fromkeys([*timeline.location, *entity]), F.col("__chunk") == timeline.chunk_of(F.col("ordinal"))
    shown = intervals.select(
        *keys, "ordinal", "next_ordinal", metric, *more, chunks_shown(timeline, F.col(metric).isNotNull())
    )
    named = shown.withColumns({c: F.when(own, F.col(c)) for c in more}).join(
        timeline.chunks(numbers=True), [*timeline.location, "__chunk"]
    )
    part = F.slice("__names", *slice_of_chunk(timeline, F.col("ordinal"), F.col("next_ordinal")))
    commits = F.when(F.col(metric).isNotNull(), part)
    return named.select(*entity, F.col(metric).alias("__metric"), *more, commits.alias("__commits"))


def _as_map() -> Column:
    """The parts of an entity as one map, in commit order; a version's metric is repeated inside the cell."""
    # Asked twice for the commits, Spark cuts them out before it groups: whole chunks stay behind.
    listed = F.collect_list(F.when(F.col("__commits").isNotNull(), F.struct("__commits", "__metric")))
    ordered = F.sort_array(listed)
    metrics = F.transform(ordered, lambda p: F.array_repeat(p["__metric"], F.size(p["__commits"])))
    return F.map_from_arrays(F.flatten(ordered["__commits"]), F.flatten(metrics)).cast(HISTORY_TYPE)


def history_map(
    intervals: DataFrame,
    timeline: Timeline,
    entity: Sequence[str] = ENTITY,
    metric: str = "metric",
) -> DataFrame:
    """`history`: commit -> metric for each entity that ever had one, nulls left out."""
    present = intervals.filter(F.col(metric).isNotNull())
    return _parts(present, timeline, entity, metric).groupBy(*entity).agg(_as_map().alias("history"))


def metric_change(
    log: DataFrame,
    timeline: Timeline,
    entity: Sequence[str] = ENTITY,
    metric: str = "metric",
) -> DataFrame:
    """Metric at the last commit of the table minus the one before; 0.0 if either is missing.

    One fixed-width aggregation over the log: neither snapshots nor joins of them; of the
    timeline only each location's last commit takes part.
    """
    at = as_number("commit")
    earlier = F.when(at < F.col("__last"), at)
    change = F.max_by(metric, at) - F.max_by(metric, earlier)
    return (
        timeline.with_last(log, "__last")
        .groupBy(*entity)
        .agg(F.coalesce(change, F.lit(0.0)).alias("metric_change"))
    )


def history_table(
    intervals: DataFrame,
    timeline: Timeline,
    entity: Sequence[str] = ENTITY,
    identity: Sequence[str] = IDENTITY,
    metric: str = "metric",
) -> DataFrame:
    """Current identity columns, history map and change, one row per entity.

    Intervals come hash-partitioned by entity, so this adds no shuffle to theirs.  An
    entity whose metric was always null keeps a row with an empty map.
    """
    ordinal, end = F.col("ordinal"), F.col("n_commits")
    current = F.col("next_ordinal") > end
    # The versions in force at the last commit and at the one before; both are the same, as a rule.
    tail = F.struct(
        F.when(current, F.struct(*identity)).alias("identity"),
        F.when(current, F.col(metric)).alias("last"),
        F.when((ordinal < end) & (F.col("next_ordinal") >= end), F.col(metric)).alias("earlier"),
    )
    tailed = intervals.withColumn("__tail", F.when(F.col("next_ordinal") >= end, tail))
    grouped = (
        _parts(tailed, timeline, entity, metric, "__tail")
        .groupBy(*entity)
        .agg(
            F.first("__tail.identity", ignorenulls=True).alias("__identity"),
            F.max("__tail.last").alias("__last"),
            F.max("__tail.earlier").alias("__earlier"),
            _as_map().alias("history"),
        )
        .withColumn("metric_change", F.coalesce(F.col("__last") - F.col("__earlier"), F.lit(0.0)))
    )
    fields = [F.col(f"__identity.{c}").alias(c) for c in identity]
    return grouped.select(*entity, *fields, "history", "metric_change")


def with_history_json(history: DataFrame) -> DataFrame:
    """The map as JSON text, the published form."""
    return history.withColumn("history", history_json(F.col("history")))


def history_wide(
    dense: DataFrame,
    commits: Sequence[str],
    entity: Sequence[str] = ENTITY,
    metric: str = "metric",
    prefix: str = "metric_",
) -> DataFrame:
    """One column per listed commit; an optional view, as wide as the list."""
    if not commits:
        raise ValueError("a wide history needs at least one commit")
    wide = dense.groupBy(*entity).pivot("commit", list(commits)).agg(F.max(metric))
    return wide.select(*entity, *[F.col(c).alias(f"{prefix}{c}") for c in commits])


def _wide_commits(wide: DataFrame, prefix: str) -> list[str]:
    commits = sorted(c.removeprefix(prefix) for c in wide.columns if c.startswith(prefix))
    if not commits:
        raise ValueError(f"no column starts with {prefix!r}")
    return commits


def wide_to_history(
    wide: DataFrame, entity: Sequence[str] = ENTITY, prefix: str = "metric_"
) -> DataFrame:
    """History map and change from a wide view; row-local."""
    commits = _wide_commits(wide, prefix)
    cells = F.create_map(*[c for i in commits for c in (F.lit(i), F.col(f"{prefix}{i}"))])
    change = F.lit(0.0)
    if len(commits) > 1:
        before, last = (F.col(f"{prefix}{i}") for i in commits[-2:])
        change = F.coalesce(last - before, change)
    return wide.select(
        *entity,
        F.map_filter(cells, lambda _, value: value.isNotNull()).alias("history"),
        change.alias("metric_change"),
    )
