"""Explicit schemas of every table the package reads or writes."""

from pyspark.sql import types as T

_GEOMETRY = T.StructType(
    [
        T.StructField(
            "location",
            T.StructType([T.StructField("lat", T.DoubleType()), T.StructField("lng", T.DoubleType())]),
        )
    ]
)

# One observed place inside a raw document.
PLACE = T.StructType(
    [
        T.StructField("place_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("formatted_address", T.StringType()),
        T.StructField("geometry", _GEOMETRY),
        T.StructField("url", T.StringType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("types", T.ArrayType(T.StringType())),
    ]
)

# One landed document: a search centre and what was found around it.  `commit` and `location`
# are optional; a document without them gets its instant from the caller or the file, its
# location from the caller.  `first_seq` numbers its first place where a request has several
# documents.
RAW_DOCUMENT = T.StructType(
    [
        T.StructField("request_id", T.StringType()),
        T.StructField("commit", T.StringType()),
        T.StructField(
            "location",
            T.StructType([T.StructField("lat", T.DoubleType()), T.StructField("lng", T.DoubleType())]),
        ),
        T.StructField("radius", T.IntegerType()),
        T.StructField("first_seq", T.LongType()),
        T.StructField("places", T.ArrayType(PLACE)),
    ]
)

# One landed page of a search: the request it belongs to, the provider's status and results.
SEARCH_RESPONSE = T.StructType(
    [
        T.StructField("request_id", T.StringType()),
        T.StructField("commit", T.StringType()),
        T.StructField("location", RAW_DOCUMENT["location"].dataType),
        T.StructField("radius", T.IntegerType()),
        T.StructField("page", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("results", T.ArrayType(PLACE)),
    ]
)

# The fields asked of the details service.
DETAIL_FIELDS = ("name", "formatted_address", "geometry", "rating", "url")

# One landed details response; it belongs to the run of its request.
DETAILS_RESPONSE = T.StructType(
    [
        T.StructField("request_id", T.StringType()),
        T.StructField("place_id", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("result", T.StructType([PLACE[name] for name in DETAIL_FIELDS])),
    ]
)

# The entity record, as flattened from a document and kept in the log.
RECORD_COLUMNS = [
    "entity_id",
    "place_id",
    "name",
    "address",
    "latitude",
    "longitude",
    "url",
    "metric",
    "source",
    "seq",
]

# The last three columns are directory names, hence strings by declaration:
# partition discovery would read an instant as a number.
LOG = T.StructType(
    [
        T.StructField("entity_id", T.StringType()),
        T.StructField("place_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("address", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("url", T.StringType()),
        T.StructField("metric", T.DoubleType()),
        T.StructField("source", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("batch", T.StringType()),
        T.StructField("location_key", T.StringType()),
        T.StructField("commit", T.StringType()),
    ]
)

# A row that no identity could be made for.
REJECTED = T.StructType(
    [
        T.StructField("location_key", T.StringType()),
        T.StructField("commit", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("place_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("address", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("url", T.StringType()),
        T.StructField("metric", T.DoubleType()),
        T.StructField("types", T.ArrayType(T.StringType())),
        T.StructField("entity_id", T.StringType()),
        T.StructField("reject_reason", T.StringType()),
        T.StructField("batch", T.StringType()),
    ]
)

# A search page or details response without usable results.
FAILED = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("request_id", T.StringType()),
        T.StructField("page", T.LongType()),
        T.StructField("place_id", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("batch", T.StringType()),
    ]
)

# Publish marker of the log: a batch is visible once its rows are here.
COMMITS = T.StructType(
    [
        T.StructField("location_key", T.StringType()),
        T.StructField("commit", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("batch", T.StringType()),
    ]
)

HISTORY = T.StructType(
    [
        T.StructField("entity_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("url", T.StringType()),
        T.StructField("history", T.StringType()),
        T.StructField("metric_change", T.DoubleType()),
        T.StructField("location_key", T.StringType()),
    ]
)

# Publish marker of the history output, per location; a null key is a table without locations.
RUNS = T.StructType(
    [
        T.StructField("run", T.StringType()),
        T.StructField("location_key", T.StringType()),
        T.StructField("rows", T.LongType()),
    ]
)

# A configured search centre; the radius is in metres.
LOCATIONS = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("radius", T.IntegerType()),
    ]
)

# Mergeable statistics of a run, per location.
STATES = T.StructType(
    [
        T.StructField("location_key", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("present", T.LongType()),
        T.StructField("total", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("run", T.StringType()),
    ]
)

DAILY = T.StructType(
    [T.StructField("date", T.StringType()), T.StructField("current_popularity", T.DoubleType())]
)
