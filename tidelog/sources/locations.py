"""The search centres: a small table with a name for each location of the log."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.identity import location_key
from tidelog.operators.latest import latest_per_key
from tidelog.schemas import LOCATIONS


def read_locations(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """location_key, name, latitude, longitude, radius from configured centres, as JSON.

    A list of centres, or one a line.  A centre without a position is no location; of several with
    one position the greatest name counts.
    """
    listed = spark.read.schema(LOCATIONS).option("multiLine", multi_line).json(path)
    keyed = listed.select(location_key(F.col("latitude"), F.col("longitude")).alias("location_key"), *LOCATIONS.names)
    return latest_per_key(keyed.filter("location_key IS NOT NULL"), ["location_key"], ["name", "radius"])


def with_location_names(rows: DataFrame, locations: DataFrame, column: str = "location_name") -> DataFrame:
    """`rows` with the name of their location; the key itself where none is known.

    One row per location: this side grows with locations only, and Spark broadcasts it by its size.
    """
    named = locations.select(F.col("location_key"), F.col("name").alias("__name"))
    joined = rows.join(named, "location_key", "left")
    shown = F.when(F.trim("__name") != "", F.col("__name")).otherwise(F.col("location_key"))
    return joined.withColumn(column, shown).select(*rows.columns, column)
