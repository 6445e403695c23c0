"""Latest record per key and key-uniqueness checks."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_RANK = "__rank"
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FIXED_WIDTH = (
    *_WHOLE,
    T.BooleanType,
    T.FloatType,
    T.DoubleType,
    T.DateType,
    T.TimestampType,
    T.TimestampNTZType,
)
_BEFORE_ALL = -(2**63 - 1)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest `order` columns of each key, whole record.

    Either way a hot key sends one row per map task through the shuffle, not all its rows.
    """
    values = [c for c in df.columns if c not in keys and c not in order]
    if (
        len(order) == 1
        and isinstance(df.schema[order[0]].dataType, _WHOLE)
        and all(isinstance(df.schema[c].dataType, _FIXED_WIDTH) for c in values)
    ):
        # Fixed-width state: a hash aggregation, without sorting the input.
        rank = F.coalesce(F.col(order[0]), F.lit(_BEFORE_ALL))
        newest = [F.max_by(c, rank).alias(c) for c in values]
        grouped = df.groupBy(*keys).agg(F.max(order[0]).alias(order[0]), *newest)
        return grouped.select(*df.columns)
    # Spark turns the `== 1` filter into a group limit on both sides of the shuffle.
    newest_first = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return (
        df.withColumn(_RANK, F.row_number().over(newest_first))
        .filter(F.col(_RANK) == 1)
        .drop(_RANK)
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)
