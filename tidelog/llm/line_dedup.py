"""Boilerplate lines by their frequency within a site.

Per host: the pages that contain a line, divided by the pages of the host.  Lines above a
ratio are boilerplate of that host and are dropped there.  All stock expressions.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.sources.scratch import durable


def _lines(text: str) -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n")


def _key(line: Column) -> Column:
    """96 bits of the trimmed line; lines travel as these, not as text."""
    trimmed = F.trim(line)
    return F.struct(F.xxhash64(trimmed).alias("a"), F.hash(trimmed).alias("b"))


def boilerplate_lines(
    docs: DataFrame, host: str, text: str, ratio: float = 0.1, min_pages: int = 2
) -> DataFrame:
    """One row per host with boilerplate: host and the keys of its lines.

    A host has at most (mean lines a page / ratio) such lines, whatever its size.
    """
    present = F.array_distinct(
        F.transform(F.filter(_lines(text), lambda x: F.trim(x) != ""), _key)
    )
    # Both counts are summed on the map side: a host with a third of all pages, or a line
    # on all of them, sends one row per task.
    pages = docs.where(F.col(host).isNotNull()).select(F.col(host).alias("host"), present.alias("keys"))
    totals = pages.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    counts = (
        pages.select("host", F.explode("keys").alias("key"))
        .groupBy("host", "key")
        .agg(F.count(F.lit(1)).alias("found"))
        .where(F.col("found") >= min_pages)
    )
    return (
        counts.join(totals, "host")
        .where(F.col("found") > ratio * F.col("pages"))
        .groupBy("host")
        .agg(F.collect_list("key").alias("boilerplate"))
    )


def drop_boilerplate(
    docs: DataFrame,
    host: str = "source",
    text: str = "text",
    ratio: float = 0.1,
    min_pages: int = 2,
    id_col: str = "doc_id",
    salts: int = 32,
) -> DataFrame:
    """`docs` with boilerplate lines cut out of `text`, and lines_dropped added.

    A line is dropped when it is on more than `ratio` of the pages of its host, and on
    `min_pages` at least: a line seen once repeats nothing.  Lines compare without surrounding blanks; one page counts a line once;
    repeated rows are pages of their own.  Empty lines, lines of rows without a host, and null
    texts stay as they are.  A text that loses all its lines becomes empty; its row stays.

    Pages of one host are dealt out over `salts` join keys by their id, and the host's short
    list of lines is repeated for each: a host with a third of all pages is no hot partition.
    """
    # Written first: where the table is small its size is known, and texts stay where they are.
    known = durable(
        boilerplate_lines(docs, host, text, ratio, min_pages).toDF("__host", "__boilerplate")
    ).withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salt = F.pmod(F.xxhash64(id_col), F.lit(salts)).cast("int")
    none = F.array().cast("array<struct<a:bigint,b:int>>")
    bad = F.coalesce(F.col("__boilerplate"), none)
    kept = F.filter(
        _lines(text), lambda x: (F.trim(x) == "") | ~F.array_contains(bad, _key(x))
    )
    changed = F.col("lines_dropped") > 0
    return (
        docs.join(known, (F.col(host) == F.col("__host")) & (salt == F.col("__salt")), "left")
        .withColumn("__kept", F.when(F.size(bad) > 0, kept))
        .withColumn(
            "lines_dropped",
            F.coalesce(F.size(_lines(text)) - F.size("__kept"), F.lit(0)).cast("long"),
        )
        .withColumn(text, F.when(changed, F.array_join("__kept", "\n")).otherwise(F.col(text)))
        .drop("__host", "__salt", "__kept", "__boilerplate")
    )
