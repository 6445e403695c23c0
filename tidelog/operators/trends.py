"""Current value, range in a recent window and key points of each entity's history.

The summary has two forms with the same results: over validity intervals (cost follows
the log, the dense history is never built) and row-local over a published history map.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.functions import instants, maps, text
from tidelog.operators.snapshots import ENTITY, history_long
from tidelog.operators.timeline import Timeline, as_number

TREND_COLUMNS = (
    "current_metric",
    "low",
    "high",
    "first_commit",
    "latest_commit",
    "range_value",
    "range_text",
    "range_period",
    "range_magnitude",
)


def signed_range(latest: Column, low: Column, high: Column) -> Column:
    """Rise from the low, else drop from the high, else 0; in that order."""
    return (
        F.when(latest > low, latest - low)
        .when(latest < high, latest - high)
        .when(latest.isNotNull(), F.lit(0.0))
    )


def range_text(value: Column) -> Column:
    return F.when(value.isNotNull(), text.signed_text(value))


def range_period(first: Column, latest: Column) -> Column:
    period = F.concat(instants.format_date(first), F.lit(" → "), instants.format_date(latest))
    return F.when(first.isNotNull(), period)


def _described(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Add the columns that follow from latest, low, high, first and latest commit."""
    with_range = df.withColumn(
        "range_value", signed_range(F.col("current_metric"), F.col("low"), F.col("high"))
    )
    return with_range.withColumns(
        {
            "range_text": range_text(F.col("range_value")),
            "range_period": range_period(F.col("first_commit"), F.col("latest_commit")),
            "range_magnitude": F.coalesce(F.abs("range_value"), F.lit(0.0)),
        }
    ).select(*keep, *TREND_COLUMNS)


def _in_window(metric: str) -> Column:
    """Whether a present metric is shown by a commit of the window, which begins at `__from`."""
    present = F.col(metric).isNotNull() & F.col("__from").isNotNull()
    return present & (F.col("valid_to").isNull() | (as_number("valid_to") > F.col("__from")))


def trend_summary(
    intervals: DataFrame,
    timeline: Timeline,
    start: str,
    entity: Sequence[str] = ENTITY,
    metric: str = "metric",
) -> DataFrame:
    """Trend columns per entity; low and high from `start` on, or from everything when
    the entity has no observation there.

    All aggregates are fixed-width; of the timeline only the first commit in the window of
    each location takes part.
    """
    value = F.col(metric)
    marked = timeline.with_first_from(intervals, start, "__from")
    recent = F.when(_in_window(metric), value)
    present = value.isNotNull()
    first = F.min(F.when(present, as_number("commit")))
    latest = F.max(F.when(present, as_number("visible_until")))
    grouped = marked.groupBy(*entity).agg(
        F.max_by(value, F.when(present, F.col("ordinal"))).alias("current_metric"),
        F.coalesce(F.min(recent), F.min(value)).alias("low"),
        F.coalesce(F.max(recent), F.max(value)).alias("high"),
        first.cast("string").alias("first_commit"),
        latest.cast("string").alias("latest_commit"),
    )
    return _described(grouped, entity)


def _observed(history: DataFrame, history_map: Column, start: str) -> DataFrame:
    """Add the usable observations and those of the window, each worked out once."""
    return history.withColumn("__observed", maps.entries(history_map)).withColumn(
        "__window", maps.recent_or_all(F.col("__observed"), F.lit(start))
    )


def _trend_columns(observed: DataFrame, keep: Sequence[str]) -> DataFrame:
    values = F.transform("__window", lambda o: o["metric"])
    first, last = (F.try_element_at("__observed", F.lit(i)) for i in (1, -1))
    described = observed.withColumns(
        {
            "current_metric": last["metric"],
            "low": F.array_min(values),
            "high": F.array_max(values),
            "first_commit": first["commit"],
            "latest_commit": last["commit"],
        }
    )
    return _described(described, keep)


def with_trend(history: DataFrame, start: str, history_col: str = "history") -> DataFrame:
    """Add the trend columns to rows that carry a history map; no shuffle."""
    return _trend_columns(_observed(history, F.col(history_col), start), history.columns)


def display_rows(history: DataFrame, start: str, history_col: str = "history") -> DataFrame:
    """A published history row as the explorer shows it: trend columns and key points text.

    `history` stays the published JSON text.
    """
    observed = _observed(history, maps.parse_history(F.col(history_col)), start)
    points = maps.key_points(F.col("__observed"), F.col("__window"))
    shown = observed.withColumn("history_details", maps.points_text(points))
    return _trend_columns(shown, [*history.columns, "history_details"])


def recent_or_all(
    intervals: DataFrame,
    timeline: Timeline,
    start: str,
    entity: Sequence[str] = ENTITY,
    metric: str = "metric",
) -> DataFrame:
    """Observations from `start` on; all observations of an entity that has none there."""
    # The window needs only the entity's partitioning, which the intervals already have.
    some = F.max(_in_window(metric)).over(Window.partitionBy(*entity))
    flagged = timeline.with_first_from(intervals, start, "__from").withColumn("__recent", some)
    dense = history_long(flagged, timeline, [*entity, "__recent"], metric, present_only=True)
    seen = instants.minute(F.col("commit")) >= start
    return dense.filter(~F.col("__recent") | seen).drop("__recent")


def key_points(
    history: DataFrame, start: str, keep: Sequence[str] = ENTITY, history_col: str = "history"
) -> DataFrame:
    """Latest, highest, lowest and first observation of each row's history, one row each."""
    points = maps.key_points(F.col("__observed"), F.col("__window"))
    return (
        _observed(history, F.col(history_col), start)
        .select(*keep, F.explode(points).alias("__point"))
        .select(*keep, "__point.commit", "__point.metric")
    )
