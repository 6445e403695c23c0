"""Row numbers over a whole table without a single-task window."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.sources.scratch import durable

_PART, _START, _ID = "__part", "__start", "__id"


def number_rows(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Add the 1-based position of each row in the order of the whole table.

    Range-partition and sort once, keep each row's range and place in it, and add the size of
    the ranges before.  `order` should end in a unique column, so that no range is one big tie.
    """
    # Written out once: both uses below must see the same ranges, also after a lost executor.
    # The id is the range in its upper bits and the place in it, from 0, in the lower 33.
    sorted_ranges = df.repartitionByRange(*order).sortWithinPartitions(*order)
    marked = durable(sorted_ranges.withColumn(_ID, F.monotonically_increasing_id()))
    ranged = marked.withColumns(
        {_PART: F.shiftright(_ID, 33), _ID: F.col(_ID).bitwiseAND(F.lit((1 << 33) - 1))}
    )
    sizes = ranged.groupBy(_PART).agg((F.max(_ID) + 1).alias("__size"))
    # One row per range, so this window and the broadcast hold at most a few thousand rows.
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(_PART, F.coalesce(F.sum("__size").over(before), F.lit(0)).alias(_START))
    return (
        ranged.join(F.broadcast(starts), _PART)
        .withColumn(name, F.col(_START) + F.col(_ID) + 1)
        .drop(_PART, _START, _ID)
    )
