"""Statistics from mergeable states: counts, sums and bounds that are added up, not worked out again.

A state has one row per group (a location, a day).  States of parts merge to the state of the
whole, so statistics over anything published never open the rows themselves.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATE = ("rows", "present", "total", "low", "high")


def state_of(rows: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """keys, rows, present (with a value), total, low, high."""
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(value).alias("present"),
        F.sum(value).alias("total"),
        F.min(value).alias("low"),
        F.max(value).alias("high"),
    )


def merge_states(states: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The states of coarser groups; without keys of everything, one row even of none."""
    return states.groupBy(*keys).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("present"), F.lit(0)).alias("present"),
        F.sum("total").alias("total"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
    )


def summary_from(states: DataFrame) -> DataFrame:
    """As `explore.summary_stats` over the rows."""
    return merge_states(states).select(
        F.col("rows").alias("total_rows"),
        F.col("present").alias("rows_with_metric"),
        F.round(F.try_divide("total", "present"), 2).alias("average_metric"),
        F.col("low").alias("min_metric"),
        F.col("high").alias("max_metric"),
    )


def options_from(states: DataFrame) -> DataFrame:
    """As `explore.filter_options` over the rows."""
    bounds = merge_states(states).select(
        F.coalesce(F.floor("low"), F.lit(0)).cast("bigint").alias("min_metric"),
        F.coalesce(F.ceil("high"), F.lit(5)).cast("bigint").alias("max_metric"),
    )
    low, high = F.col("min_metric"), F.col("max_metric")
    return bounds.withColumn("steps", F.array(low, low + 1, low + 2, low + 3, high))


def average_from(states: DataFrame, key: str, name: str) -> DataFrame:
    """Average of each group."""
    return merge_states(states, [key]).select(key, F.try_divide("total", "present").alias(name))
