"""Published history tables.

    <root>/history/run=<instant>/location_key=<key>/*.parquet
    <root>/states/run=<instant>/*.parquet         statistics of the run by location
    <root>/runs/published=<instant>/*.parquet     written last: the publish marker

A run may hold all locations or some; the newest run of each location is the one read.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.schemas import HISTORY, RUNS, STATES


def publish_history(history: DataFrame, root: str, run: str) -> int:
    """Write one run and make it the newest of its locations; returns the rows written."""
    spark = history.sparkSession
    located = ["location_key"] if "location_key" in history.columns else []
    folder = f"{root}/history/run={run}"
    # Sizes the files: small partitions are merged, a hot location is split.
    history.hint("rebalance", *located).write.mode("overwrite").partitionBy(*located).parquet(folder)
    # Counted from the file footers, not by running the history again.
    counts = spark.read.schema(history.schema).parquet(folder).groupBy(*located)
    markers = counts.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(run).alias("run"),
        (F.col("location_key") if located else F.lit(None).cast("string")).alias("location_key"),
        "rows",
    )
    path = f"{root}/runs/published={run}"
    markers.write.mode("overwrite").parquet(path)
    return spark.read.schema(RUNS).parquet(path).agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]


def publish_states(states: DataFrame, root: str, run: str) -> None:
    """Write the states (`operators.states`) of a run, by location_key, before the run is published.

    The same run again replaces its own.
    """
    states.write.mode("overwrite").parquet(f"{root}/states/run={run}")


def read_states(spark: SparkSession, root: str) -> DataFrame:
    """The states of the newest run of each location; history files are not opened."""
    return spark.read.schema(STATES).parquet(f"{root}/states").join(
        latest_runs(spark, root), ["location_key", "run"], "left_semi"
    ).select(*[n for n in STATES.names if n != "run"])


def latest_runs(spark: SparkSession, root: str) -> DataFrame:
    """Newest complete run of each location: location_key, run."""
    runs = spark.read.schema(RUNS).parquet(f"{root}/runs")
    return runs.groupBy("location_key").agg(F.max("run").alias("run"))


def read_latest_history(
    spark: SparkSession,
    root: str,
    location: str | None = None,
    columns: Sequence[str] | None = None,
    schema: T.StructType = HISTORY,
) -> DataFrame:
    """The newest run of each location, or of one, all its files.

    Runs and location select folders, `columns` the scan.
    """
    newest = latest_runs(spark, root)
    if location is not None:
        newest = newest.filter(F.col("location_key") == location)
    elif newest.isEmpty():
        raise ValueError(f"no published history under {root}")
    rows = spark.read.schema(T.StructType([*schema, RUNS["run"]])).parquet(f"{root}/history")
    if location is not None:
        rows = rows.filter(F.col("location_key") == location)
    # One row per location: while it is small, its runs prune the folders of the scan.
    same = ["location_key", "run"] if "location_key" in schema.names else ["run"]
    rows = rows.join(newest.select(*same), same, "left_semi")
    return rows.select(*(columns or schema.names))
