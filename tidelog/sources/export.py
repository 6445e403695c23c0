"""CSV, JSON and report export of display rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions import maps, text
from tidelog.operators.explore import summary_stats

# The header of the CSV file.
CSV_HEADER = [
    "Name",
    "URL",
    "Current Rating",
    "Rating Difference",
    "Rating Range Period",
    "Rating History",
    "Latitude",
    "Longitude",
]


def export_rows(rows: DataFrame) -> DataFrame:
    """The eight text columns of the CSV export; missing values are empty.

    A zero metric means unrated and is empty as well.
    """
    rated = F.when(F.col("current_metric") != 0, F.col("current_metric"))
    values = [
        F.col("name"),
        F.col("url"),
        text.fixed_text(rated, 1),
        text.fixed_text(F.col("range_value"), 1),
        F.col("range_period"),
        maps.history_text(F.col("history")),
        text.fixed_text(F.col("latitude"), 4),
        text.fixed_text(F.col("longitude"), 4),
    ]
    return rows.select(
        *[F.coalesce(v, F.lit("")).alias(title) for v, title in zip(values, CSV_HEADER)]
    )


def write_csv(rows: DataFrame, path: str) -> None:
    """Quotes inside a value are doubled (RFC 4180)."""
    export_rows(rows).write.option("header", True).option("escape", '"').option(
        "emptyValue", ""
    ).csv(path)


def write_json(rows: DataFrame, path: str) -> None:
    """All columns, one JSON object per line, nulls written out."""
    rows.write.option("ignoreNullFields", False).json(path)


def summary_report(
    rows: DataFrame,
    generated_at: str,
    location: str = "Unknown",
    data_source: str = "Unknown",
    metric: str = "current_metric",
) -> DataFrame:
    """One row: provenance and summary statistics."""
    return summary_stats(rows, metric).select(
        F.lit(generated_at).alias("generated_at"),
        F.lit(location).alias("location"),
        F.lit(data_source).alias("data_source"),
        "*",
    )


def write_report(rows: DataFrame, path: str, generated_at: str, **provenance: str) -> None:
    """The summary and, beside it, the rows; never all rows in one document.

    The summary is of the rows as written: they are worked out once.
    """
    write_json(rows, f"{path}/rows")
    written = rows.sparkSession.read.schema(rows.schema).json(f"{path}/rows")
    summary = summary_report(written, generated_at, **provenance)
    summary.write.option("ignoreNullFields", False).json(f"{path}/summary")
