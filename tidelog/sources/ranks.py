"""Rank index: rows of a published table in blocks of a given order.

    <path>/block=<n>/*.parquet    rows n * size + 1 to (n + 1) * size, with their position

A page opens the block it lies in, the last page as well as the first.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.operators.numbering import number_rows

#: Rows of a block, as large as a file is read well.
BLOCK_ROWS = 100_000
POSITION = "position"


def write_ranked(
    rows: DataFrame, path: str, order: Sequence[Column], block_rows: int = BLOCK_ROWS
) -> None:
    """Number the rows in `order`, which should end in a unique column, and write them in blocks."""
    block = F.floor((F.col(POSITION) - 1) / block_rows).cast("long")
    (
        number_rows(rows, order, POSITION)
        .withColumn("block", block)
        # Ranges of the order stay together: a block is written by the task or two that hold it.
        .sortWithinPartitions("block", POSITION)
        .write.mode("overwrite")
        .partitionBy("block")
        .parquet(path)
    )


def read_page(
    spark: SparkSession, path: str, number: int, size: int = 5, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Rows of page `number` (from 1) with their position; beyond the end there are none."""
    if number < 1 or size < 1:
        raise ValueError("page number and size start at 1")
    first, last = (number - 1) * size + 1, number * size
    blocks = F.col("block").between((first - 1) // block_rows, (last - 1) // block_rows)
    rows = spark.read.parquet(path).filter(blocks & F.col(POSITION).between(first, last))
    return rows.drop("block").orderBy(POSITION)
