"""The registered queries: each runs an operator over whole driver tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions import bands, identity, instants, maps, text
from tidelog.operators import asof, explore, history, ingest, pages, snapshots, states, timeline, trends
from tidelog.operators.latest import duplicate_keys
from tidelog.operators.numbering import number_rows
from tidelog.plans import jobs
from tidelog.schemas import HISTORY
from tidelog.sources import bases, buckets, export, locations, ranks, raw, search, segments
from tidelog.sources import history as published
from tidelog.sources import log as log_store
from tidelog.sources.scratch import scratch_path
from tidelog.streaming.ingest import start_ingest, stream_documents
from workload import fixtures as fx

# --- documents and ingest ---------------------------------------------------------


def raw_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "raw")
    raw.write_documents(fx.place_documents(spark, sf_dir), path)
    return raw.read_documents(spark, path).select(
        "request_id",
        "commit",
        F.col("location.lat").alias("lat"),
        F.col("location.lng").alias("lng"),
        F.col("radius").cast("bigint").alias("radius"),
        F.size("places").cast("bigint").alias("n_places"),
    )


def daily_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "daily")
    fx.table(spark, sf_dir, "events").select(
        F.date_format("ts", "yyyy-MM-dd").alias("date"), F.col("value").alias("current_popularity")
    ).write.json(path)
    return raw.read_daily(spark, path)


def places_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.flattened_places(spark, sf_dir).select(
        "location_key",
        "commit",
        "place_id",
        "name",
        "address",
        "latitude",
        "longitude",
        "url",
        "metric",
        F.array_join("types", ",").alias("types"),
    )


def basic_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.basic_info(fx.flattened_places(spark, sf_dir))


def stable_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = identity.stable_id(F.col("name"), F.col("latitude"), F.col("longitude"))
    return fx.places(spark, sf_dir).select("place_id", key.alias("entity_id"))


def envelope_nest(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Small documents, so that a nation takes several.
    documents = fx.place_documents(spark, sf_dir, max_places=400)
    ids = F.transform("places", lambda p: p["place_id"].cast("bigint"))
    return documents.select(
        "request_id", F.size("places").cast("bigint").alias("n"), F.to_json(ids).alias("ids")
    )


def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = fx.place_documents(spark, sf_dir, dirty=True)
    rows = ingest.identified(ingest.flatten_places(documents))
    return ingest.rejected(rows).select("place_id", "name", "reject_reason")


def batch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = fx.place_documents(spark, sf_dir, dirty=True)
    places = ingest.flatten_places(documents)
    counts = log_store.append_batch(places, scratch_path(spark, "log"), "b1")
    names = ["read", "rejected", "kept"]
    schema = T.StructType([T.StructField(n, T.LongType()) for n in names])
    return spark.createDataFrame([tuple(counts[n] for n in names)], schema)


def location_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "log")
    log_store.append_batch(fx.flattened_places(spark, sf_dir), root, "b1")
    return log_store.read_log(spark, root).select(
        "location_key", "commit", "entity_id", "place_id", "name", "metric"
    )


def location_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One location of the log; the others' folders are not opened."""
    root = scratch_path(spark, "log")
    log_store.append_batch(fx.flattened_places(spark, sf_dir), root, "b1")
    return log_store.read_log(spark, root, location="25.0_124.0").select(
        "location_key", "commit", "entity_id", "place_id", "name", "metric"
    )


def location_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All places with the name of their search centre; nations with an odd key have none configured."""
    path = scratch_path(spark, "centres")
    nations = fx.table(spark, sf_dir, "nation").filter(F.col("n_nationkey") % 2 == 0)
    nations.select(
        F.col("n_name").alias("name"),
        F.lit(25.0).alias("latitude"),
        (F.lit(121.0) + F.col("n_nationkey")).alias("longitude"),
    ).write.json(path)
    centres = locations.read_locations(spark, path, multi_line=False)
    rows = fx.flattened_places(spark, sf_dir).select("place_id", "location_key")
    return locations.with_location_names(rows, centres)


def ingest_unplaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with and without location: every row is read back, as kept or as rejected."""
    root = scratch_path(spark, "log")
    log_store.append_batch(ingest.flatten_places(fx.unplaced_documents(spark, sf_dir)), root, "b1")
    kept = log_store.read_log(spark, root).select(
        "place_id", "location_key", F.lit(None).cast("string").alias("reject_reason")
    )
    rejected = log_store.read_rejected(spark, root)
    return kept.union(rejected.select("place_id", "location_key", "reject_reason"))


_INGESTED = ["commit", "entity_id", "place_id", "name", "metric"]


def upsert_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "log")
    observed = ingest.flatten_places(fx.observation_documents(spark, sf_dir))
    log_store.append_batch(observed, root, "b1")
    return log_store.read_log(spark, root).select(*_INGESTED)


def upsert_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As `upsert_log`, each day one request in many documents: the greatest number wins."""
    root = scratch_path(spark, "log")
    documents = fx.observation_documents(spark, sf_dir, max_places=20, one_request=True)
    log_store.append_batch(ingest.flatten_places(documents), root, "b1")
    return log_store.read_log(spark, root).select(*_INGESTED)


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed, root = scratch_path(spark, "landed"), scratch_path(spark, "log")
    raw.write_documents(fx.observation_documents(spark, sf_dir), landed, one_per_file=False)
    # Few files per micro-batch, so that commits arrive in more than one.
    documents = stream_documents(spark, landed, files_per_batch=4, multi_line=False)
    query = start_ingest(documents, root, scratch_path(spark, "checkpoint"))
    query.awaitTermination()
    return log_store.read_log(spark, root).select(*_INGESTED)


def log_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, target = scratch_path(spark, "log"), scratch_path(spark, "log")
    observed = ingest.flatten_places(fx.observation_documents(spark, sf_dir))
    log_store.append_batch(observed, root, "b1")
    log_store.rewrite_log(spark, root, target, "base", keep=10)
    return log_store.read_log(spark, target).select(*_INGESTED)


# --- snapshots --------------------------------------------------------------------


def upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.daily_log(spark, sf_dir)


def commit_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline.commit_timeline(fx.short_observations(spark, sf_dir))


def commit_timeline_located(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline.commit_timeline(fx.observations(spark, sf_dir, "hour"), ["location_key"])


def snapshot_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.snapshot_latest(fx.short_observations(spark, sf_dir))


def snapshot_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.snapshot_as_of(fx.short_observations(spark, sf_dir), fx.AS_OF)


def validity_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.daily_intervals(spark, sf_dir)[0]


def retain_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.retain_commits(*fx.daily_log_and_timeline(spark, sf_dir), keep=10)


def log_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As `snapshot_as_of`, from a log on disk, reading only the folders up to the instant."""
    root = scratch_path(spark, "log")
    log_store.append_batch(
        ingest.flatten_places(fx.observation_documents(spark, sf_dir)), root, "b1"
    )
    log = log_store.read_log(spark, root, until=fx.AS_OF)
    return snapshots.snapshot_latest(log, log_store.KEY, ["commit"]).select(*_INGESTED)


def _landed_in_turns(spark: SparkSession, sf_dir: str) -> list[tuple[str, DataFrame]]:
    """All observations in three batches: two stretches of days, between them late rows of the first."""
    observed = ingest.flatten_places(fx.observation_documents(spark, sf_dir))
    first = F.col("commit") < "20240116"
    late = first & (F.pmod(F.xxhash64("place_id", "seq"), F.lit(5)) == 0)
    return [
        ("b1", observed.filter(first & ~late)),
        ("b2", observed.filter(late)),
        ("b3", observed.filter(~first)),
    ]


def as_of_bases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As `log_as_of`, from a base, the commits after it and a late batch with commits before it."""
    root = scratch_path(spark, "log")
    for batch, places in _landed_in_turns(spark, sf_dir):
        log_store.append_batch(places, root, batch)
        bases.maintain_bases(spark, root, every=10)
    return bases.read_as_of(spark, root, fx.AS_OF).select(*_INGESTED)


_HISTORY_ROWS = ["location_key", "entity_id", "name", "latitude", "longitude", "history", "metric_change"]


def history_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history table kept up batch by batch, a late and a replayed one among them."""
    root = scratch_path(spark, "log")
    turns = _landed_in_turns(spark, sf_dir)
    for n, (batch, places) in enumerate([*turns, turns[1]]):
        log_store.append_batch(places, root, batch)
        jobs.keep_history(spark, root, f"r{n}", every=10)
    return segments.read_history(spark, root).select(*_HISTORY_ROWS)


def history_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history table from a log bucketed by entity."""
    root = scratch_path(spark, "log")
    log_store.append_batch(ingest.flatten_places(fx.observation_documents(spark, sf_dir)), root, "b1")
    name = f"bucketed_{root.rsplit('-', 1)[-1]}"
    buckets.write_bucketed(spark, root, name, buckets=8)
    line = timeline.load_timeline(log_store.read_commits(spark, root), ["location_key"]).settled()
    log = buckets.read_bucketed(spark, root, name, buckets=8)
    intervals = snapshots.validity_intervals(log, line, log_store.KEY)
    table = history.history_table(intervals, line, log_store.KEY)
    return history.with_history_json(table).select(*_HISTORY_ROWS)


def commits_without_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run whose rows are all rejected is a commit: history goes on to it, the change is 0."""
    root = scratch_path(spark, "log")
    observed = ingest.flatten_places(fx.observation_documents(spark, sf_dir))
    log_store.append_batch(observed, root, "b1")
    unusable = observed.withColumns(
        {"name": F.lit(None).cast("string"), "commit": F.lit(fx.EMPTY_RUN)}
    )
    log_store.append_batch(unusable, root, "b2")
    return jobs.build_history(spark, root).select(*_HISTORY_ROWS)


# --- history ----------------------------------------------------------------------


def history_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.history_long(*fx.daily_intervals(spark, sf_dir))


def history_long_compressed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.history_long(*fx.daily_intervals(spark, sf_dir), compress=True)


def _history_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.history_map(*fx.daily_intervals(spark, sf_dir))


def history_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.with_history_json(_history_maps(spark, sf_dir))


def history_table_chunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As `history_table_located`, with a timeline cut into chunks of seven commits."""
    seen = fx.observations(spark, sf_dir, "hour")
    line = timeline.load_timeline(seen, ["location_key"], chunk=7).settled()
    log = snapshots.upsert_merge(seen, fx.LOCATED)
    intervals = snapshots.validity_intervals(log, line, fx.LOCATED)
    return history.with_history_json(history.history_table(intervals, line, fx.LOCATED))


def metric_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.metric_change(*fx.daily_log_and_timeline(spark, sf_dir))


def metric_change_located(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = fx.observations(spark, sf_dir, "hour")
    line = timeline.load_timeline(seen, ["location_key"]).settled()
    merged = snapshots.upsert_merge(seen, fx.LOCATED)
    return history.metric_change(merged, line, fx.LOCATED)


def _wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    intervals, line = fx.daily_intervals(spark, sf_dir)
    return history.history_wide(snapshots.history_long(intervals, line), line.instants())


def history_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _wide(spark, sf_dir)


def history_wide_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.with_history_json(history.wide_to_history(_wide(spark, sf_dir)))


def _history_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.with_history_json(history.history_table(*fx.full_intervals(spark, sf_dir)))


def history_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _history_table(spark, sf_dir)


def history_table_located(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = history.history_table(*fx.located_intervals(spark, sf_dir), fx.LOCATED)
    return history.with_history_json(table)


def _fixture_history_schema() -> T.StructType:
    """The published schema with the numeric ids of the driver tables, without location."""
    fields = [f for f in HISTORY.fields if f.name not in ("entity_id", "location_key")]
    return T.StructType([T.StructField("entity_id", T.LongType()), *fields])


def history_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "history")
    published.publish_history(_history_table(spark, sf_dir), root, "20240131000000000")
    return published.read_latest_history(
        spark,
        root,
        columns=["entity_id", "name", "metric_change"],
        schema=_fixture_history_schema(),
    )


def latest_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "history")
    table = _history_table(spark, sf_dir)
    # An earlier run with other contents must not show.
    earlier = table.withColumn("metric_change", F.lit(-1.0))
    published.publish_history(earlier, root, "20240130000000000")
    published.publish_history(table, root, "20240131000000000")
    return published.read_latest_history(spark, root, schema=_fixture_history_schema())


def full_cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents on disk to log, log to published history, history to display rows."""
    landed, root = scratch_path(spark, "landed"), scratch_path(spark, "root")
    raw.write_documents(fx.observation_documents(spark, sf_dir), landed, one_per_file=False)
    jobs.ingest_documents(spark, landed, root, "b1", multi_line=False)
    jobs.run_history(spark, root, "20240131000000000")
    return jobs.view(spark, root, fx.WINDOW_START).select(
        "location_key",
        "entity_id",
        "name",
        "history",
        "metric_change",
        "current_metric",
        "range_value",
        "range_period",
    )


# --- trends -----------------------------------------------------------------------


def trend_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trends.trend_summary(*fx.daily_intervals(spark, sf_dir), fx.WINDOW_START)


def trend_summary_located(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trends.trend_summary(
        *fx.located_intervals(spark, sf_dir), fx.WINDOW_START, fx.LOCATED
    )


def trend_from_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trends.with_trend(_history_maps(spark, sf_dir), fx.LAST_DAY_START).drop("history")


def _display(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trends.display_rows(_history_table(spark, sf_dir), fx.WINDOW_START)


def display_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _display(spark, sf_dir)


def recency_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trends.recent_or_all(*fx.daily_intervals(spark, sf_dir), fx.LAST_DAY_START)


def history_key_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trends.key_points(_history_maps(spark, sf_dir), fx.WINDOW_START)


def history_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    text_form = maps.history_text(F.col("history"))
    return history_map(spark, sf_dir).select("entity_id", text_form.alias("history_text"))


def history_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = maps.parse_history(F.col("history"))
    return history_map(spark, sf_dir).select(
        "entity_id", F.explode(parsed).alias("commit", "metric")
    )


def tolerant_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event properties as a map; those of an error are cut short, hence unreadable."""
    props = F.when(F.col("event_type") == "error", F.substring("props", 1, 4)).otherwise(
        F.col("props")
    )
    parsed = maps.parse_history(props)
    return fx.table(spark, sf_dir, "events").select(
        "event_id", F.size(parsed).cast("bigint").alias("keys"), parsed["k"].alias("k")
    )


def instant_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instants of all events, malformed in a way that depends on the event type."""
    full = instants.to_instant(F.col("ts"))
    kind = F.col("event_type")
    written = (
        F.when(kind == "view", F.substring(full, 1, 14))
        .when(kind == "click", F.substring(full, 1, 8))
        .when(kind == "error", F.concat(F.substring(full, 1, 4), F.lit("13"), F.substring(full, 7, 11)))
        .otherwise(full)
    )
    instant = F.col("instant")
    return (
        fx.table(spark, sf_dir, "events")
        .select("event_id", written.alias("instant"))
        .select(
            "event_id",
            "instant",
            F.date_format(instants.parse_instant(instant), "yyyy-MM-dd HH:mm:ss").alias("at"),
            instants.format_date(instant).alias("date"),
            instants.format_date_time(instant).alias("date_time"),
            instants.date_label(instant).alias("label"),
            instants.tooltip_date(instant).alias("tooltip"),
        )
    )


def window_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.table(spark, sf_dir, "orders").select(
        "o_orderkey", instants.window_start(F.col("o_orderdate")).alias("start")
    )


def signed_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    change = F.col("metric_change")
    return metric_change(spark, sf_dir).select(
        "entity_id",
        text.signed_text(change).alias("change_text"),
        bands.direction(change).alias("direction"),
    )


def metric_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    metric = F.col("metric")
    return fx.places(spark, sf_dir).select(
        "place_id",
        bands.percent_of_scale(metric).alias("percent"),
        bands.band(metric).alias("band"),
        bands.direction(metric - 3.0).alias("direction"),
        text.signed_text(metric - 3.0).alias("signed"),
    )


def label_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    spaced = F.replace(F.col("p_name"), F.lit(" "), F.lit("_"))
    labels = F.array(F.concat_ws("_", spaced, F.lower("p_type")), F.lower("p_brand"))
    return fx.table(spark, sf_dir, "part").select(
        "p_partkey",
        text.label_text(labels).alias("labels"),
        text.label_text_from_json(F.to_json(labels)).alias("labels_from_json"),
        text.label_text_from_json(F.col("p_name")).alias("plain"),
    )


# --- explore and export -----------------------------------------------------------


def explore_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.explore_filter(
        fx.places(spark, sf_dir), search="R#0000001", threshold=3.0, metric="metric"
    ).select("place_id", "name", "metric")


def explore_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows in the default order, the place in it as a column."""
    order = explore.sort_order("range_magnitude", descending=True)
    rows = trend_summary(spark, sf_dir).select("entity_id", "range_magnitude")
    return number_rows(rows, order, "position")


def explore_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = explore.sort_order("range_magnitude", descending=True)
    return explore.page(trend_summary(spark, sf_dir), order, number=2).select(
        "entity_id", "current_metric", "range_value", "range_magnitude"
    )


def explore_page_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page from a rank index of small blocks, two of which it touches."""
    path = scratch_path(spark, "ranks")
    order = explore.sort_order("metric", tie="place_id")
    rows = fx.places(spark, sf_dir).select("place_id", "name", "metric")
    ranks.write_ranked(rows, path, order, block_rows=64)
    return ranks.read_page(spark, path, 3, 40, block_rows=64).drop(ranks.POSITION)


def page_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.page_count(fx.places(spark, sf_dir))


def summary_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.summary_stats(fx.places(spark, sf_dir), "metric")


def filter_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    options = explore.filter_options(fx.places(spark, sf_dir), "metric")
    return options.withColumn("steps", F.to_json("steps"))


def summary_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.summary_report(
        trend_summary(spark, sf_dir), "2024-01-31T00:00:00.000Z", data_source="events"
    )


def avg_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = fx.table(spark, sf_dir, "events").withColumn("d", F.date_format("ts", "yyyy-MM-dd"))
    # Rounded: the last bits of a sum depend on its order.
    return explore.avg_by_day(daily, "d", "value").withColumn(
        "avg_value", F.round("avg_value", 6)
    )


def rows_for_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = fx.table(spark, sf_dir, "events").select(
        "event_id", F.date_format("ts", "yyyy-MM-dd").alias("d"), "value"
    )
    return explore.rows_for_day(daily, "2024-01-15", "d")


def orders_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order with the version of its customer that was in force then."""
    orders = fx.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_custkey").alias("entity_id"),
        instants.to_instant(F.col("o_orderdate")).alias("at"),
    )
    versions = fx.customer_versions(spark, sf_dir)
    # Dates spread over years: by month a customer has a few orders.
    return asof.as_of_join(orders, versions, "at", ["commit", "metric"], stretch=6)


def nearby_centres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All places around each of many centres, those of two categories."""
    found = explore.nearby_many(
        fx.places(spark, sf_dir),
        fx.supplier_centres(spark, sf_dir),
        keywords="Building machinery",
        text=["name", "category"],
        columns=["place_id"],
        digits=3,
    )
    return found.select("centre_id", "place_id", "distance_m")


def search_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As `explore_filter`, by the index of three-letter pieces."""
    path, rows = scratch_path(spark, "postings"), fx.places(spark, sf_dir)
    search.write_postings(rows, path, key=["place_id"])
    found = search.search(spark, rows, path, "R#0000001", 3.0, key=["place_id"], metric="metric")
    return found.select("place_id", "name", "metric")


def summary_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As `summary_stats`, merged from published states; an earlier and a repeated run do not count."""
    root = scratch_path(spark, "states")
    placed = fx.places(spark, sf_dir).withColumn("location_key", F.col("nation").cast("string"))
    for run, rows in (("1", placed.withColumn("metric", F.lit(99.0))), ("2", placed), ("2", placed)):
        published.publish_states(states.state_of(rows, "metric", ["location_key"]), root, run)
        published.publish_history(rows.select("location_key", "place_id", "metric"), root, run)
    return states.summary_from(published.read_states(spark, root))


def options_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As `filter_options`, from one state per nation."""
    by_nation = states.state_of(fx.places(spark, sf_dir), "metric", ["nation"])
    return states.options_from(by_nation).withColumn("steps", F.to_json("steps"))


def avg_by_day_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As `avg_by_day`, from states per event type and day."""
    daily = fx.table(spark, sf_dir, "events").withColumn("d", F.date_format("ts", "yyyy-MM-dd"))
    parts = states.state_of(daily, "value", ["event_type", "d"])
    return states.average_from(parts, "d", "avg_value").withColumn("avg_value", F.round("avg_value", 6))


def nearby_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = explore.nearby(
        fx.places(spark, sf_dir),
        *fx.CENTRE,
        fx.RADIUS_M,
        keywords="Building machinery",
        text=["name", "category"],
    )
    return found.select("place_id", F.round("distance_m", 3).alias("distance_m"))


def export_csv_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.export_rows(_display(spark, sf_dir))


def export_json_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "json")
    rows = trend_summary(spark, sf_dir)
    export.write_json(rows, path)
    return spark.read.schema(rows.schema).json(path)


# --- pages and details ------------------------------------------------------------


def pages_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.union_pages(fx.search_pages(spark, sf_dir)).select(
        "place_id", "name", "category", "nation", "page"
    )


def pages_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.unique_rows(pages_union(spark, sf_dir), ["place_id"], ["page"])


def pages_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_keys(pages_union(spark, sf_dir), ["place_id"])


def collect_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    search, details, path = (scratch_path(spark, n) for n in ("search", "details", "raw"))
    fx.search_responses(spark, sf_dir).write.json(search)
    fx.details_responses(spark, sf_dir).write.json(details)
    jobs.collect(spark, search, details, path, page_size=100)
    documents = raw.read_documents(spark, path, multi_line=False)
    return ingest.flatten_places(documents).select(
        "location_key", "commit", "source", "place_id", "name", "metric", "url"
    )


def _collected_runs(spark: SparkSession, sf_dir: str) -> str:
    search, details, path = (scratch_path(spark, n) for n in ("search", "details", "raw"))
    searched, detailed = fx.run_responses(spark, sf_dir)
    searched.write.json(search)
    detailed.write.json(details)
    for _ in range(2):  # a replay changes nothing
        jobs.collect(spark, search, details, path, page_size=100)
    return path


def collect_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs with details of their own: the change is between the details of the runs."""
    root = scratch_path(spark, "root")
    jobs.ingest_documents(spark, _collected_runs(spark, sf_dir), root, "b1", multi_line=False)
    return jobs.build_history(spark, root).select("location_key", "name", "metric_change")


def failed_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = raw.read_failed(spark, _collected_runs(spark, sf_dir))
    return failed.select("kind", "request_id", "page", "place_id", "status")


def status_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    responses = fx.detail_responses(spark, sf_dir)
    return ingest.unsuccessful(responses, ingest.DETAILS_OK).select("place_id", "status")


def _enriched(spark: SparkSession, sf_dir: str, strict: bool) -> DataFrame:
    details = ingest.successful(fx.detail_responses(spark, sf_dir), ingest.DETAILS_OK)
    base = fx.places(spark, sf_dir).select("place_id", "name", "metric", "category")
    return ingest.enrich_details(base, details, strict=strict)


def enrich_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _enriched(spark, sf_dir, strict=False)


def enrich_details_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _enriched(spark, sf_dir, strict=True)


QUERIES = {
    f.__name__: f
    for f in (
        raw_scan,
        daily_scan,
        places_flatten,
        basic_info,
        stable_id,
        envelope_nest,
        rejected_rows,
        batch_counts,
        location_partition,
        location_read,
        location_names,
        ingest_unplaced,
        upsert_log,
        upsert_parts,
        stream_ingest,
        log_rewrite,
        upsert_merge,
        commit_timeline,
        commit_timeline_located,
        snapshot_latest,
        snapshot_as_of,
        log_as_of,
        as_of_bases,
        history_increments,
        history_bucketed,
        commits_without_rows,
        validity_intervals,
        retain_commits,
        history_long,
        history_long_compressed,
        history_map,
        metric_change,
        metric_change_located,
        history_wide,
        history_wide_map,
        history_table,
        history_table_located,
        history_table_chunked,
        history_scan,
        latest_output,
        full_cycle,
        trend_summary,
        trend_summary_located,
        trend_from_map,
        display_rows,
        recency_fallback,
        history_key_points,
        history_text,
        history_parse,
        tolerant_parse,
        instant_parse,
        window_start,
        signed_text,
        metric_bands,
        label_text,
        explore_filter,
        explore_sorted,
        explore_page,
        explore_page_deep,
        page_count,
        summary_stats,
        filter_options,
        summary_report,
        avg_by_day,
        rows_for_day,
        nearby_search,
        nearby_centres,
        orders_as_of,
        search_indexed,
        summary_merged,
        options_merged,
        avg_by_day_merged,
        export_csv_rows,
        export_json_rows,
        pages_union,
        pages_dedup,
        pages_duplicates,
        collect_documents,
        collect_runs,
        failed_responses,
        status_rejected,
        enrich_details,
        enrich_details_strict,
    )
}
