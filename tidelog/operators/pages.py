"""Result pages: append and make keys unique."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame

from tidelog.operators.latest import latest_per_key


def union_pages(pages: Sequence[DataFrame]) -> DataFrame:
    """All rows of all pages by column name; a column a page lacks is null there."""
    if not pages:
        raise ValueError("no pages")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), pages)


def unique_rows(rows: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the greatest `order` columns win."""
    return latest_per_key(rows, key, order)
