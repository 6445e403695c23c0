"""Frames over the driver tables that stand for observations, places and responses.

Every frame reads its whole table.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.instants import to_instant
from tidelog.operators.ingest import flatten_places, nest_documents
from tidelog.operators.snapshots import upsert_merge, validity_intervals
from tidelog.operators.timeline import Timeline, load_timeline

# Start of the recent window of the trend queries; the data spans 2024-01-01 to 2024-01-30.
WINDOW_START = "20240120000000000"
# Only the last commit: entities without a metric there fall back to their whole history.
LAST_DAY_START = "20240130000000000"
# A run after all others that found nothing usable.
EMPTY_RUN = "20240201000000000"
AS_OF = "20240115000000000"
CENTRE = (25.041171, 121.035)
RADIUS_M = 5000.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _grid_metric(number: Column) -> Column:
    """1.0 ... 5.0 in steps of 0.1."""
    return (F.lit(10) + F.floor(number) % 41) / 10.0


def observations(spark: SparkSession, sf_dir: str, unit: str = "day") -> DataFrame:
    """Each event is an observation of its user; an `error` observes a null metric.

    Events of one `unit` of time are one commit.
    """
    user = F.col("user_id")
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("location_key"),
        user.alias("entity_id"),
        to_instant(F.date_trunc(unit, "ts")).alias("commit"),
        F.col("event_id").alias("seq"),
        F.when(F.col("event_type") != "error", _grid_metric(F.col("value"))).alias("metric"),
        F.concat(F.lit("User "), user.cast("string")).alias("name"),
        (F.lit(25.0) + (user % 1000) / 10000.0).alias("latitude"),
        (F.lit(121.0) + (user % 700) / 10000.0).alias("longitude"),
        F.concat(F.lit("event/"), F.col("event_id").cast("string")).alias("url"),
    )


def short_observations(spark: SparkSession, sf_dir: str, unit: str = "day") -> DataFrame:
    return observations(spark, sf_dir, unit).select("entity_id", "commit", "seq", "metric")


def daily_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert_merge(short_observations(spark, sf_dir))


def daily_log_and_timeline(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Timeline]:
    seen = short_observations(spark, sf_dir)
    return upsert_merge(seen), load_timeline(seen).settled()


def daily_intervals(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Timeline]:
    log, timeline = daily_log_and_timeline(spark, sf_dir)
    return validity_intervals(log, timeline), timeline


def full_intervals(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Timeline]:
    """As `daily_intervals`, with the identity columns."""
    seen = observations(spark, sf_dir).drop("location_key")
    timeline = load_timeline(seen).settled()
    return validity_intervals(upsert_merge(seen), timeline), timeline


LOCATED = ("location_key", "entity_id")


def located_intervals(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Timeline]:
    """One location per event type, one commit per hour: locations differ in their commits,
    and at location `error` no metric is ever present."""
    seen = observations(spark, sf_dir, "hour")
    timeline = load_timeline(seen, ["location_key"]).settled()
    return validity_intervals(upsert_merge(seen, LOCATED), timeline, LOCATED), timeline


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer is a place; a negative balance means unrated."""
    key, balance = F.col("c_custkey"), F.col("c_acctbal")
    return table(spark, sf_dir, "customer").select(
        key.alias("place_id"),
        F.col("c_name").alias("name"),
        (F.lit(25.0) + (key % 1000) / 10000.0).alias("latitude"),
        (F.lit(121.0) + (key % 700) / 10000.0).alias("longitude"),
        F.when(balance >= 0, _grid_metric(balance)).alias("metric"),
        F.col("c_mktsegment").alias("category"),
        F.col("c_nationkey").alias("nation"),
        balance.alias("balance"),
    )


def _element(place_id: Column, metric: str, latitude: Column, category: Column) -> Column:
    """A place element of a raw document."""
    position = F.struct(latitude.alias("lat"), F.col("longitude").alias("lng"))
    return F.struct(
        place_id.cast("string").alias("place_id"),
        "name",
        F.concat(F.lit("Address of "), F.col("name")).alias("formatted_address"),
        F.struct(position.alias("location")).alias("geometry"),
        F.concat(F.lit("place/"), place_id.cast("string")).alias("url"),
        F.col(metric).alias("rating"),
        F.array(F.lower(category)).alias("types"),
    )


def _document(request: Column, commit: Column, lat: Column, lng: Column) -> list[Column]:
    return [
        request.alias("request_id"),
        commit.alias("commit"),
        F.struct(lat.alias("lat"), lng.alias("lng")).alias("location"),
        F.lit(5000).alias("radius"),
    ]


def place_documents(
    spark: SparkSession, sf_dir: str, max_places: int = 10_000, dirty: bool = False
) -> DataFrame:
    """One document per nation, or several when it has many places.

    `dirty`: places with a negative balance have no latitude.
    """
    rows = places(spark, sf_dir)
    known = F.when(F.col("balance") >= 0, F.col("latitude")) if dirty else F.col("latitude")
    return nest_documents(
        rows,
        ["nation"],
        "place_id",
        _document(
            F.format_string("n%02d-%08d", "nation", "part"),
            F.lit("20240101000000000"),
            F.lit(25.0),
            F.lit(121.0) + F.col("nation"),
        ),
        _element(F.col("place_id"), "metric", known, F.col("category")),
        max_places,
    )


def observation_documents(
    spark: SparkSession, sf_dir: str, max_places: int = 1000, one_request: bool = False
) -> DataFrame:
    """Documents of at most `max_places` observations, one commit per day.

    `one_request`: all documents of a day are parts of one request.
    """
    seen = observations(spark, sf_dir)
    name = F.col("commit") if one_request else F.format_string("%s-%012d", "commit", "part")
    return nest_documents(
        seen,
        ["commit"],
        "seq",
        _document(
            name,
            F.col("commit"),
            F.lit(25.0),
            F.lit(121.5),
        ),
        _element(F.col("entity_id"), "metric", F.col("latitude"), F.col("location_key")),
        max_places,
    )


def flattened_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_places(place_documents(spark, sf_dir))


def detail_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A details response per customer; a negative balance means not found."""
    status = F.when(F.col("balance") >= 0, F.lit("OK")).otherwise(F.lit("NOT_FOUND"))
    return places(spark, sf_dir).select(
        "place_id",
        status.alias("status"),
        F.upper("name").alias("name"),
        # A details response without this field: null here.
        F.when(F.col("category") != "BUILDING", F.col("metric")).alias("metric"),
    )


def search_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per nation, its customers on pages of 100 consecutive keys; a page with a
    balance below -900 has failed."""
    element = _element(F.col("place_id"), "metric", F.col("latitude"), F.col("category"))
    paged = places(spark, sf_dir).select(
        "nation",
        F.floor(F.col("place_id") / 100).cast("bigint").alias("page"),
        "balance",
        F.struct("place_id", element.alias("place")).alias("item"),
    )
    # At most 100 items in a group, by the width of a page.
    grouped = paged.groupBy("nation", "page").agg(
        F.min("balance").alias("worst"), F.sort_array(F.collect_list("item")).alias("items")
    )
    return grouped.select(
        F.format_string("n%02d", "nation").alias("request_id"),
        F.lit("20240101000000000").alias("commit"),
        F.struct(F.lit(25.0).alias("lat"), (F.lit(121.0) + F.col("nation")).alias("lng")).alias("location"),
        F.lit(5000).alias("radius"),
        "page",
        F.when(F.col("worst") < -900, F.lit("UNKNOWN_ERROR")).otherwise(F.lit("OK")).alias("status"),
        F.transform("items", lambda i: i["place"]).alias("results"),
    )


def details_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Details of each customer: other name and link, no metric; unknown for BUILDING."""
    key = F.col("place_id").cast("string")
    element = _element(F.col("place_id"), "metric", F.col("latitude"), F.col("category"))
    rows = places(spark, sf_dir).withColumn("place", element)
    result = F.struct(
        F.upper("name").alias("name"),
        "place.formatted_address",
        "place.geometry",
        F.lit(None).cast("double").alias("rating"),
        F.concat(F.lit("details/"), key).alias("url"),
    )
    known = F.col("category") != "BUILDING"
    return rows.select(
        F.format_string("n%02d", "nation").alias("request_id"),
        key.alias("place_id"),
        F.when(known, F.lit("OK")).otherwise(F.lit("NOT_FOUND")).alias("status"),
        F.when(known, result).alias("result"),
    )


def run_responses(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Search pages and details of two weekly runs over all customers.

    Each run has its own details, with a metric of its own, and every one of them twice.
    """
    run = F.explode(F.array(F.lit(1), F.lit(8))).alias("run")
    request = F.format_string("%s-%d", "request_id", "run")
    searched = search_responses(spark, sf_dir).select("*", run)
    searched = searched.withColumns(
        {"request_id": request, "commit": F.format_string("202401%02d000000000", "run")}
    ).drop("run")
    detailed = details_responses(spark, sf_dir).select("*", run)
    rating = (F.lit(10) + (F.col("place_id").cast("long") * 7 + F.col("run") * 13) % 41) / 10.0
    known = F.col("result").isNotNull()
    detailed = detailed.withColumns(
        {
            "request_id": request,
            "result": F.when(known, F.col("result").withField("rating", rating)),
        }
    ).drop("run")
    return searched, detailed.union(detailed)


def unplaced_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of `place_documents`; those of nations with an odd key have no location."""
    placed = F.substring("request_id", 2, 2).cast("int") % 2 == 0
    return place_documents(spark, sf_dir).withColumn("location", F.when(placed, F.col("location")))


def search_pages(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Pages of three searches: every customer is found twice, every supplier once.

    The supplier search returns no category.
    """
    customers = places(spark, sf_dir).select("place_id", "name", "category", "nation")
    suppliers = table(spark, sf_dir, "supplier").select(
        (-1 - F.col("s_suppkey")).alias("place_id"),
        F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nation"),
    )
    by_nation = customers.withColumn("page", F.col("nation").cast("bigint"))
    by_segment = customers.withColumn("page", (F.length("category") + 100).cast("bigint")).drop("nation")
    by_supplier = suppliers.withColumn("page", (F.col("nation") + 200).cast("bigint"))
    return [by_nation, by_segment, by_supplier]


def customer_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions of customers: the greatest metric of what was shipped to each on a day."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate", "l_extendedprice")
    owners = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    seen = lines.join(owners, "l_orderkey").select(
        F.col("o_custkey").alias("entity_id"),
        to_instant(F.col("l_shipdate")).alias("commit"),
        _grid_metric(F.col("l_extendedprice")).alias("metric"),
    )
    return seen.groupBy("entity_id", "commit").agg(F.max("metric").alias("metric"))


def supplier_centres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each supplier is a search centre; radii of 100 to 900 metres."""
    key = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        key.alias("centre_id"),
        (F.lit(25.0) + (key * 37 % 1000) / 10000.0).alias("centre_lat"),
        (F.lit(121.0) + (key * 11 % 700) / 10000.0).alias("centre_lng"),
        (F.lit(100.0) + key % 5 * 200.0).alias("radius_m"),
    )
