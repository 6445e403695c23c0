"""Raw documents to entity records."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.identity import location_key, reject_reason, stable_id
from tidelog.functions.instants import is_instant, to_instant
from tidelog.operators.latest import latest_per_key
from tidelog.schemas import DETAIL_FIELDS, PLACE

BASIC_INFO = (
    "place_id",
    "name",
    "address",
    "latitude",
    "longitude",
    "url",
    "metric",
)

# Greatest number of results on a page of the search provider.
PAGE_SIZE = 20


def flatten_places(
    documents: DataFrame,
    commit: Column | None = None,
    location: tuple[float, float] | None = None,
    origin: Column | None = None,
) -> DataFrame:
    """One row per place, in document order; a null or empty list gives none.

    `commit`: the instant of each document; by default the document's own.  `location`: the
    search centre of all documents, instead of their own.  `origin`: where a document comes
    from; it stands for the request of a document without one.  `seq` runs through all
    documents of a request.
    """
    request = F.col("request_id") if origin is None else F.coalesce("request_id", origin)
    several = "first_seq" in documents.columns
    before = F.coalesce("first_seq", F.lit(0)) if several else F.lit(0)
    elements = documents.select(
        _searched(location).alias("location_key"),
        (F.col("commit") if commit is None else commit).alias("commit"),
        request.alias("source"),
        before.cast("bigint").alias("first_seq"),
        F.posexplode("places").alias("at", "place"),
    ).withColumn("seq", F.col("first_seq") + F.col("at"))
    places = elements.select("location_key", "commit", "source", "seq", "place.*")
    return places.select(
        "location_key",
        "commit",
        "source",
        "seq",
        "place_id",
        "name",
        F.col("formatted_address").alias("address"),
        F.col("geometry.location.lat").alias("latitude"),
        F.col("geometry.location.lng").alias("longitude"),
        "url",
        F.col("rating").alias("metric"),
        "types",
    )


def _searched(location: tuple[float, float] | None) -> Column:
    """Key of a document's search centre, its own or the given one."""
    if location is None:
        return location_key(F.col("location.lat"), F.col("location.lng"))
    return location_key(*(F.lit(float(c)) for c in location))


def document_runs(
    documents: DataFrame,
    commit: Column | None = None,
    location: tuple[float, float] | None = None,
) -> DataFrame:
    """`location_key, commit` of each document, with places or without: the runs they stand for."""
    instant = F.col("commit") if commit is None else commit
    return documents.select(_searched(location).alias("location_key"), instant.alias("commit"))


def file_instant() -> Column:
    """The document's instant, or when its file was written, in UTC."""
    written = F.to_utc_timestamp(F.col("_metadata.file_modification_time"), F.current_timezone())
    return F.coalesce(F.col("commit"), to_instant(written))


def file_origin() -> Column:
    """Path of the file a document was read from."""
    return F.col("_metadata.file_path")


def basic_info(places: DataFrame, columns: Sequence[str] = BASIC_INFO) -> DataFrame:
    """The stored columns of a place with its stable id; drops the labels."""
    identity = stable_id(F.col("name"), F.col("latitude"), F.col("longitude"))
    return places.select(identity.alias("entity_id"), *columns)


def identified(places: DataFrame) -> DataFrame:
    """Add `entity_id` and `reject_reason`; rows to keep have a null reason."""
    parts = [F.col(c) for c in ("name", "latitude", "longitude")]
    undated = F.when(~F.coalesce(is_instant(F.col("commit")), F.lit(False)), F.lit("invalid commit"))
    unplaced = F.when(F.col("location_key").isNull(), F.lit("missing location"))
    return places.withColumns(
        {
            "entity_id": stable_id(*parts),
            "reject_reason": F.coalesce(reject_reason(*parts), undated, unplaced),
        }
    )


def accepted(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("reject_reason").isNotNull())


def nest_documents(
    places: DataFrame,
    request: Sequence[str],
    seq: str,
    document: Sequence[Column],
    place: Column,
    max_places: int = 10_000,
) -> DataFrame:
    """Gather rows into raw documents, in `seq` order.

    A document holds at most `max_places` consecutive values of the unique `seq`; a
    larger request becomes several documents (`part`), so that no group and no file
    grows with the size of a request; `first_seq` keeps their places numbered through.
    """
    part = F.floor(F.col(seq) / max_places).cast("bigint")
    grouped = (
        places.select(
            *request,
            part.alias("part"),
            F.struct(F.col(seq).alias("at"), place.alias("place")).alias("item"),
        )
        .groupBy(*request, "part")
        .agg(F.sort_array(F.collect_list("item")).alias("items"))
    )
    return grouped.select(
        *document,
        (F.col("part") * max_places).alias("first_seq"),
        F.transform("items", lambda i: i["place"]).alias("places"),
    )


def successful(responses: DataFrame, statuses: Sequence[str], status: str = "status") -> DataFrame:
    """Responses whose status is one of the successful ones."""
    return responses.filter(F.col(status).isin(*statuses))


def unsuccessful(responses: DataFrame, statuses: Sequence[str], status: str = "status") -> DataFrame:
    """The rest, a missing status included."""
    return responses.filter(~F.coalesce(F.col(status).isin(*statuses), F.lit(False)))


# The statuses that carry usable results.
SEARCH_OK = ("OK", "ZERO_RESULTS")
DETAILS_OK = ("OK",)


def enrich_details(
    base: DataFrame,
    details: DataFrame,
    key: str | Sequence[str] = "place_id",
    fields: Sequence[str] = (*DETAIL_FIELDS, "address", "metric"),
    strict: bool = False,
) -> DataFrame:
    """Left join; a detail replaces the base value, without details the base row stays.

    `strict`: a null detail of a matched row replaces the base value as well.  Rows
    without a key are dropped.  `details` must have one row per key.
    """
    keys = [key] if isinstance(key, str) else list(key)
    columns = [c for c in fields if c in details.columns and c in base.columns]
    matches = details.select(
        *keys, F.lit(True).alias("__found"), *[F.col(c).alias(f"__{c}") for c in columns]
    )
    joined = base.dropna(subset=keys).join(matches, keys, "left")

    def merged(column: str) -> Column:
        if column not in columns:
            return F.col(column)
        if strict:
            found = F.when(F.col("__found"), F.col(f"__{column}"))
            return found.otherwise(F.col(column)).alias(column)
        return F.coalesce(f"__{column}", column).alias(column)

    return joined.select(*[merged(c) for c in base.columns])


def search_results(responses: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """Places of the successful pages with their request; `seq` numbers them over its pages.

    A page with more than `page_size` results raises: the numbers of two pages would meet.
    """
    found = successful(responses, SEARCH_OK).select(
        "request_id",
        "commit",
        "location",
        "radius",
        "page",
        F.posexplode("results").alias("at", "place"),
    )
    too_many = F.raise_error(F.lit(f"a page has more than {page_size} results")).cast("bigint")
    seq = F.col("page") * page_size + F.when(F.col("at") < page_size, F.col("at")).otherwise(too_many)
    return found.select(
        "request_id", "commit", "location", "radius", seq.alias("seq"), "place.*"
    )


def failed_responses(responses: DataFrame, details: DataFrame) -> DataFrame:
    """Search pages and details responses without usable results, with status and message."""
    none = F.lit(None)
    pages = unsuccessful(responses, SEARCH_OK).select(
        F.lit("search").alias("kind"),
        "request_id",
        "page",
        none.cast("string").alias("place_id"),
        "status",
        "error_message",
    )
    places = unsuccessful(details, DETAILS_OK).select(
        F.lit("details").alias("kind"),
        "request_id",
        none.cast("bigint").alias("page"),
        "place_id",
        "status",
        "error_message",
    )
    return pages.union(places)


def collect_documents(
    responses: DataFrame,
    details: DataFrame,
    page_size: int = PAGE_SIZE,
    max_places: int = 10_000,
) -> DataFrame:
    """Raw documents from landed search pages and details responses.

    Details belong to the run of their request; of several for one place and run the one
    that is greatest as text counts.  Places of failed pages are left out (see
    `failed_responses`), places without successful details stay as found.  A request without
    places gives no document.
    """
    run = F.coalesce("request_id", F.lit("")).alias("__run")
    found = search_results(responses, page_size).select("*", run)
    known = successful(details, DETAILS_OK).select(
        run, "place_id", "result.*", F.to_json("result").alias("__text")
    )
    one = latest_per_key(known, ["__run", "place_id"], ["__text"])
    enriched = enrich_details(found, one, ["__run", "place_id"], DETAIL_FIELDS)
    request = ["request_id", "commit", "location", "radius"]
    place = F.struct(*PLACE.names)
    return nest_documents(enriched, request, "seq", [F.col(c) for c in request], place, max_places)
