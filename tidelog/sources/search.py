"""Substring search by an index of three-letter pieces.

    <path>/bucket=<n>/*.parquet    piece, key: the rows whose name has the piece

A search reads the buckets of its needle's pieces, keeps the keys that have all of them, and looks
at those names alone.  Needles of one or two letters have no piece: they look at all names.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.operators.explore import explore_filter

BUCKETS = 64
#: Tasks that a piece of all names is dealt out over when it is written.
SALTS = 32


def _pieces(text: Column) -> Column:
    """Distinct three-letter pieces of a text in lower case; none of a shorter one."""
    low = F.lower(text)
    starts = F.sequence(F.lit(1), F.greatest(F.length(low) - 2, F.lit(1)))
    pieces = F.transform(starts, lambda i: F.substring(low, i, 3))
    return F.when(F.length(low) >= 3, F.array_distinct(pieces)).otherwise(F.array().cast("array<string>"))


def _bucket(piece: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(piece), F.lit(buckets)).cast("int")


def write_postings(
    rows: DataFrame, path: str, key: Sequence[str] = ("entity_id",), name: str = "name", buckets: int = BUCKETS
) -> None:
    """Write the index of `rows`; a piece of a third of all names is that many short rows, no list.

    A row has each of its pieces once.  Pieces of rows that share a key are not put together: that
    would hold all pieces of a task's input at once; searches do not count what comes twice.
    """
    (
        rows.select(*key, F.explode(_pieces(F.col(name))).alias("piece"))
        .withColumns(
            {"bucket": _bucket(F.col("piece"), buckets), "__salt": F.pmod(F.xxhash64(*key), F.lit(SALTS))}
        )
        .hint("rebalance", "bucket", "__salt")
        .drop("__salt")
        .sortWithinPartitions("bucket", "piece")
        .write.mode("overwrite")
        .partitionBy("bucket")
        .parquet(path)
    )


def search(
    spark: SparkSession,
    rows: DataFrame,
    path: str,
    needle: str,
    threshold: float | None = None,
    key: Sequence[str] = ("entity_id",),
    name: str = "name",
    metric: str = "current_metric",
    buckets: int = BUCKETS,
) -> DataFrame:
    """The rows of `explore_filter` for the needle, found by the index."""
    # The needle's own pieces and buckets, by the expressions that wrote the index.
    own = F.struct(F.col("p").alias("piece"), _bucket(F.col("p"), buckets).alias("bucket"))
    parts = spark.range(1).select(F.explode(_pieces(F.lit(needle))).alias("p")).select(own.alias("own")).collect()
    if not parts:
        return explore_filter(rows, needle, threshold, name, metric)
    pieces, opened = [r["own"]["piece"] for r in parts], {r["own"]["bucket"] for r in parts}
    postings = spark.read.parquet(path).filter(F.col("bucket").isin(sorted(opened)) & F.col("piece").isin(pieces))
    # One flag per piece and key.  By key first: on the map side a task would hold a state for nearly
    # each posting it reads, as the postings of one piece have no key twice.
    flags = [F.max(F.col("piece") == p).alias(f"__has{n}") for n, p in enumerate(pieces)]
    by_key = postings.repartition(*key).groupBy(*key).agg(*flags)
    have_all = by_key.filter(" AND ".join(f"__has{n}" for n in range(len(pieces))))
    found = rows.join(have_all.select(*key), list(key), "left_semi").select(rows.columns)
    return explore_filter(found, needle, threshold, name, metric)
