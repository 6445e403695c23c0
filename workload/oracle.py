"""The SQL each registered query must agree with, over the same tables."""

from workload.fixtures import AS_OF, CENTRE, EMPTY_RUN, LAST_DAY_START, RADIUS_M, WINDOW_START

_INSTANT = "%Y%m%d%H%M%S%g"


def _observations(unit: str) -> str:
    return f"""
    obs AS (
      SELECT event_type AS location_key, user_id AS entity_id,
             strftime(date_trunc('{unit}', ts), '{_INSTANT}') AS commit, event_id AS seq,
             CASE WHEN event_type <> 'error' THEN (10 + floor(value)::BIGINT % 41) / 10.0 END AS metric,
             'User ' || user_id::VARCHAR AS name,
             25.0::DOUBLE + (user_id % 1000) / 10000.0 AS latitude,
             121.0::DOUBLE + (user_id % 700) / 10000.0 AS longitude,
             'event/' || event_id::VARCHAR AS url
      FROM events)"""


def _history(unit: str = "day", key: str = "entity_id", place: str = "", empty: str = "") -> str:
    """CTEs obs, log, commits, iv, dense, hist; `place` is the location column, if any.

    `empty`: a commit without observations.
    """
    same = f"AND iv.{place} = c.{place}" if place else ""
    listed = f"{place}, commit" if place else "commit"
    part = f"PARTITION BY {place}" if place else ""
    return f"""
    {_observations(unit)},
    log AS (SELECT * FROM obs
            QUALIFY row_number() OVER (PARTITION BY {key}, commit ORDER BY seq DESC) = 1),
    commits AS (SELECT *, row_number() OVER ({part} ORDER BY commit) AS ordinal,
                       count(*) OVER ({part}) AS n_commits,
                       max(commit) OVER ({part}) AS last_commit,
                       lag(commit) OVER ({part} ORDER BY commit) AS previous_commit
                FROM (SELECT DISTINCT {listed} FROM obs{f" UNION SELECT '{empty}'" if empty else ""})),
    iv AS (SELECT *, lead(commit) OVER (PARTITION BY {key} ORDER BY commit) AS valid_to FROM log),
    dense AS (SELECT iv.* EXCLUDE (commit), c.commit, c.ordinal, c.n_commits
              FROM iv JOIN commits c
                ON c.commit >= iv.commit AND (iv.valid_to IS NULL OR c.commit < iv.valid_to) {same}),
    hist AS (SELECT * FROM dense WHERE metric IS NOT NULL)"""


_JSON = "CAST(to_json(map(list(commit ORDER BY commit), list(metric ORDER BY commit))) AS VARCHAR)"


def _fixed(x: str, digits: int) -> str:
    return f"CAST(CAST(round({x}, {digits}) AS DECIMAL(30,{digits})) AS VARCHAR)"


def _signed(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN '-' WHEN {x} > 0 THEN '+' || {_fixed(x, 1)} ELSE {_fixed(x, 1)} END"


def _date(x: str, form: str = "%b %-d, %Y") -> str:
    return f"strftime(strptime(substr({x}, 1, 12), '%Y%m%d%H%M'), '{form}')"


_DATE_TIME = "%b %-d, %Y • %-I:%M %p"


def _tables(key: str = "entity_id", place: str = "") -> str:
    """CTEs maps, change and history_rows on top of `_history`."""
    return f"""
    maps AS (SELECT {key}, {_JSON} AS history FROM hist GROUP BY {key}),
    change AS (SELECT {key},
                 coalesce(max(metric) FILTER (ordinal = n_commits)
                          - max(metric) FILTER (ordinal = n_commits - 1), 0.0) AS metric_change
               FROM dense GROUP BY {key}),
    latest AS (SELECT * FROM log
               QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY commit DESC) = 1),
    history_rows AS (
      SELECT {", ".join("latest." + k.strip() for k in key.split(","))}, name, latitude, longitude, url,
             coalesce(history, '{{}}') AS history, metric_change
      FROM latest LEFT JOIN maps USING ({key}) JOIN change USING ({key}))"""


def _trend(start: str, key: str = "entity_id", source: str = "hist", everyone: str = "log") -> str:
    """CTE trend on top of `_history`: one row per entity of `everyone`."""
    return f"""
    spans AS (
      SELECT {key}, arg_max(metric, commit) AS current_metric,
             coalesce(min(metric) FILTER (commit >= '{start}'), min(metric)) AS low,
             coalesce(max(metric) FILTER (commit >= '{start}'), max(metric)) AS high,
             min(commit) AS first_commit, max(commit) AS latest_commit
      FROM {source} GROUP BY {key}),
    ranged AS (
      SELECT *, CASE WHEN current_metric > low THEN current_metric - low
                     WHEN current_metric < high THEN current_metric - high
                     WHEN current_metric IS NOT NULL THEN 0.0 END AS range_value
      FROM (SELECT DISTINCT {key} FROM {everyone}) LEFT JOIN spans USING ({key})),
    trend AS (
      SELECT *, CASE WHEN range_value IS NOT NULL THEN {_signed("range_value")} END AS range_text,
             {_date("first_commit")} || ' → ' || {_date("latest_commit")} AS range_period,
             coalesce(abs(range_value), 0.0) AS range_magnitude
      FROM ranged)"""


def _points(start: str) -> str:
    """CTE points on top of `_history`: key points of each entity."""
    return f"""
    flagged AS (SELECT *, commit >= '{start}' AS recent,
                       bool_or(commit >= '{start}') OVER (PARTITION BY entity_id) AS any_recent
                FROM hist),
    windowed AS (SELECT * FROM flagged WHERE recent OR NOT any_recent),
    points AS (
      SELECT entity_id, commit, metric FROM hist
        QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY commit DESC) = 1
      UNION
      SELECT entity_id, commit, metric FROM windowed
        QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY metric DESC, commit DESC) = 1
      UNION
      SELECT entity_id, commit, metric FROM windowed
        QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY metric, commit) = 1
      UNION
      SELECT entity_id, commit, metric FROM hist
        QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY commit) = 1)"""


_HISTORY_TEXT = (
    f"string_agg({_date('commit')} || ': ' || {_fixed('metric', 1)}, '; ' ORDER BY commit)"
)

_PLACES = """
    place AS (
      SELECT c_custkey AS place_id, c_name AS name,
             25.0::DOUBLE + (c_custkey % 1000) / 10000.0 AS latitude,
             121.0::DOUBLE + (c_custkey % 700) / 10000.0 AS longitude,
             CASE WHEN c_acctbal >= 0 THEN (10 + floor(c_acctbal)::BIGINT % 41) / 10.0 END AS metric,
             c_mktsegment AS category, c_nationkey AS nation, c_acctbal AS balance
      FROM customer)"""


def _id(name: str = "name", lat: str = "latitude", lng: str = "longitude") -> str:
    return (
        f"substr(sha256(concat(lower(trim({name})), '_', CAST(round({lat}, 4) AS VARCHAR), '_', "
        f"CAST(round({lng}, 4) AS VARCHAR))), 1, 12)"
    )


_OBSERVED = f"""
    observed AS (SELECT commit, {_id()} AS entity_id, entity_id::VARCHAR AS place_id, name, metric FROM log)"""

_TREND_COLUMNS = """entity_id, current_metric, low, high, first_commit, latest_commit,
             range_value, range_text, range_period, range_magnitude"""

_DISPLAY = f"""
    shown AS (
      SELECT h.*, t.* EXCLUDE (entity_id), coalesce(d.details, '') AS history_details,
             coalesce(x.history_text, '') AS history_text
      FROM history_rows h JOIN trend t USING (entity_id)
      LEFT JOIN (SELECT entity_id,
                        string_agg({_date("commit", _DATE_TIME)} || '  →  ' || {_fixed("metric", 1)},
                                   chr(10) ORDER BY commit DESC) AS details
                 FROM points GROUP BY entity_id) d USING (entity_id)
      LEFT JOIN (SELECT entity_id, {_HISTORY_TEXT} AS history_text
                 FROM hist GROUP BY entity_id) x USING (entity_id))"""

_PAGES = """
    page AS (
      SELECT place_id, name, category, nation, nation::BIGINT AS page FROM place
      UNION ALL SELECT place_id, name, category, NULL, (length(category) + 100)::BIGINT FROM place
      UNION ALL SELECT -1 - s_suppkey, s_name, NULL, s_nationkey, (s_nationkey + 200)::BIGINT FROM supplier)"""

_DETAILS = """
    details AS (SELECT place_id, upper(name) AS name,
                       CASE WHEN category <> 'BUILDING' THEN metric END AS metric
                FROM place WHERE balance >= 0)"""

_EVENTS_INSTANT = f"""
    written AS (
      SELECT event_id, event_type, strftime(ts, '{_INSTANT}') AS t FROM events),
    spoiled AS (
      SELECT event_id, CASE event_type WHEN 'view' THEN substr(t, 1, 14)
               WHEN 'click' THEN substr(t, 1, 8)
               WHEN 'error' THEN substr(t, 1, 4) || '13' || substr(t, 7)
               ELSE t END AS instant FROM written),
    parsed AS (
      SELECT *, CASE WHEN regexp_full_match(instant, '[0-9]{{17}}')
                     THEN date_trunc('minute', try_strptime(substr(instant, 1, 14), '%Y%m%d%H%M%S')) END AS m
      FROM spoiled)"""

# The thirty days of the events table, the columns of the wide view.
_DAYS = [f"202401{day:02d}000000000" for day in range(1, 31)]
_WIDE = ", ".join(f"max(CASE WHEN commit = '{d}' THEN metric END) AS metric_{d}" for d in _DAYS)

_LOCATED = "location_key, entity_id"
_LAT, _LNG = CENTRE

ORACLE = {
    "raw_scan": f"""WITH {_PLACES}
      SELECT 'n' || lpad(nation::VARCHAR, 2, '0') || '-' || lpad((place_id // 10000)::VARCHAR, 8, '0') AS request_id,
             '20240101000000000' AS commit, 25.0::DOUBLE AS lat, 121.0::DOUBLE + nation AS lng,
             5000::BIGINT AS radius, count(*) AS n_places
      FROM place GROUP BY nation, place_id // 10000""",
    "daily_scan": """SELECT strftime(ts, '%Y-%m-%d') AS date, value AS current_popularity FROM events""",
    "places_flatten": f"""WITH {_PLACES}
      SELECT '25.0_' || (121.0::DOUBLE + nation)::VARCHAR AS location_key, '20240101000000000' AS commit,
             place_id::VARCHAR AS place_id, name, 'Address of ' || name AS address, latitude, longitude,
             'place/' || place_id::VARCHAR AS url, metric, lower(category) AS types
      FROM place""",
    "basic_info": f"""WITH {_PLACES}
      SELECT {_id()} AS entity_id, place_id::VARCHAR AS place_id, name, 'Address of ' || name AS address,
             latitude, longitude, 'place/' || place_id::VARCHAR AS url, metric
      FROM place""",
    "stable_id": f"WITH {_PLACES} SELECT place_id, {_id()} AS entity_id FROM place",
    "envelope_nest": f"""WITH {_PLACES}
      SELECT 'n' || lpad(nation::VARCHAR, 2, '0') || '-' || lpad((place_id // 400)::VARCHAR, 8, '0') AS request_id,
             count(*) AS n, CAST(to_json(list(place_id ORDER BY place_id)) AS VARCHAR) AS ids
      FROM place GROUP BY nation, place_id // 400""",
    "rejected_rows": f"""WITH {_PLACES}
      SELECT place_id::VARCHAR AS place_id, name, 'missing latitude' AS reject_reason
      FROM place WHERE balance < 0""",
    "batch_counts": """SELECT count(*) AS read, count(*) FILTER (c_acctbal < 0) AS rejected,
             count(*) FILTER (c_acctbal >= 0) AS kept FROM customer""",
    "location_partition": f"""WITH {_PLACES}
      SELECT '25.0_' || (121.0::DOUBLE + nation)::VARCHAR AS location_key, '20240101000000000' AS commit,
             {_id()} AS entity_id, place_id::VARCHAR AS place_id, name, metric FROM place""",
    "location_read": f"""WITH {_PLACES}
      SELECT '25.0_' || (121.0::DOUBLE + nation)::VARCHAR AS location_key, '20240101000000000' AS commit,
             {_id()} AS entity_id, place_id::VARCHAR AS place_id, name, metric FROM place WHERE nation = 3""",
    "ingest_unplaced": f"""WITH {_PLACES}
      SELECT place_id::VARCHAR AS place_id,
             CASE WHEN nation % 2 = 0 THEN '25.0_' || (121.0::DOUBLE + nation)::VARCHAR END AS location_key,
             CASE WHEN nation % 2 = 1 THEN 'missing location' END AS reject_reason
      FROM place""",
    "location_names": f"""WITH {_PLACES}, keyed AS (
        SELECT place_id::VARCHAR AS place_id, nation,
               '25.0_' || (121.0::DOUBLE + nation)::VARCHAR AS location_key FROM place)
      SELECT place_id, location_key, coalesce(n_name, location_key) AS location_name
      FROM keyed LEFT JOIN nation ON n_nationkey = nation AND n_nationkey % 2 = 0""",
    "upsert_log": f"WITH {_history()}, {_OBSERVED} SELECT * FROM observed",
    "upsert_parts": f"WITH {_history()}, {_OBSERVED} SELECT * FROM observed",
    "stream_ingest": f"WITH {_history()}, {_OBSERVED} SELECT * FROM observed",
    "log_rewrite": f"""WITH {_history()},
      base AS (SELECT commit AS kept_from FROM commits WHERE ordinal = n_commits - 9)
      SELECT greatest(commit, kept_from) AS commit, {_id()} AS entity_id, entity_id::VARCHAR AS place_id,
             name, metric FROM log, base
      QUALIFY row_number() OVER (PARTITION BY log.entity_id, greatest(log.commit, kept_from)
                                 ORDER BY log.commit DESC) = 1""",
    "upsert_merge": f"WITH {_history()} SELECT entity_id, commit, seq, metric FROM log",
    "commit_timeline": f"WITH {_history()} SELECT commit, ordinal FROM commits",
    "commit_timeline_located": f"""WITH {_history("hour", _LOCATED, "location_key")}
      SELECT location_key, commit, ordinal FROM commits""",
    "snapshot_latest": f"""WITH {_observations("day")} SELECT entity_id, commit, seq, metric FROM obs
      QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY commit DESC, seq DESC) = 1""",
    "snapshot_as_of": f"""WITH {_observations("day")} SELECT entity_id, commit, seq, metric FROM obs
      WHERE commit <= '{AS_OF}'
      QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY commit DESC, seq DESC) = 1""",
    "log_as_of": f"""WITH {_history()}
      SELECT commit, {_id()} AS entity_id, entity_id::VARCHAR AS place_id, name, metric FROM log
      WHERE commit <= '{AS_OF}'
      QUALIFY row_number() OVER (PARTITION BY log.entity_id ORDER BY commit DESC) = 1""",
    "as_of_bases": f"""WITH {_history()}
      SELECT commit, {_id()} AS entity_id, entity_id::VARCHAR AS place_id, name, metric FROM log
      WHERE commit <= '{AS_OF}'
      QUALIFY row_number() OVER (PARTITION BY log.entity_id ORDER BY commit DESC) = 1""",
    "history_increments": f"""WITH {_history()}, {_tables()}
      SELECT '25.0_121.5' AS location_key, {_id()} AS entity_id, name, latitude, longitude,
             history, metric_change FROM history_rows""",
    "history_bucketed": f"""WITH {_history()}, {_tables()}
      SELECT '25.0_121.5' AS location_key, {_id()} AS entity_id, name, latitude, longitude,
             history, metric_change FROM history_rows""",
    "commits_without_rows": f"""WITH {_history(empty=EMPTY_RUN)}, {_tables()}
      SELECT '25.0_121.5' AS location_key, {_id()} AS entity_id, name, latitude, longitude,
             history, metric_change FROM history_rows""",
    "validity_intervals": f"""WITH {_history()}
      SELECT iv.entity_id, iv.commit, iv.seq, iv.metric, c.ordinal,
             coalesce(n.ordinal, c.n_commits + 1) AS next_ordinal, c.n_commits, iv.valid_to,
             coalesce(n.previous_commit, c.last_commit) AS visible_until
      FROM iv JOIN commits c USING (commit) LEFT JOIN commits n ON n.commit = iv.valid_to""",
    "retain_commits": f"""WITH {_history()},
      base AS (SELECT commit AS kept_from FROM commits WHERE ordinal = n_commits - 9)
      SELECT entity_id, greatest(commit, kept_from) AS commit, seq, metric FROM log, base
      QUALIFY row_number() OVER (PARTITION BY entity_id, greatest(commit, kept_from)
                                 ORDER BY log.commit DESC) = 1""",
    "history_long": f"WITH {_history()} SELECT entity_id, commit, metric FROM dense",
    "history_long_compressed": f"""WITH {_history()}
      SELECT entity_id, commit, metric FROM dense
      QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY commit) = 1
           OR metric IS DISTINCT FROM lag(metric) OVER (PARTITION BY entity_id ORDER BY commit)""",
    "history_map": f"WITH {_history()} SELECT entity_id, {_JSON} AS history FROM hist GROUP BY entity_id",
    "metric_change": f"WITH {_history()}, {_tables()} SELECT * FROM change",
    "metric_change_located": f"""WITH {_history("hour", _LOCATED, "location_key")},
      {_tables(_LOCATED)} SELECT * FROM change""",
    "history_wide": f"WITH {_history()} SELECT entity_id, {_WIDE} FROM dense GROUP BY entity_id",
    "history_wide_map": f"""WITH {_history()}, {_tables()}
      SELECT entity_id, history, metric_change FROM history_rows""",
    "history_table": f"WITH {_history()}, {_tables()} SELECT * FROM history_rows",
    "history_table_located": f"""WITH {_history("hour", _LOCATED, "location_key")},
      {_tables(_LOCATED)} SELECT * FROM history_rows""",
    "history_table_chunked": f"""WITH {_history("hour", _LOCATED, "location_key")},
      {_tables(_LOCATED)} SELECT * FROM history_rows""",
    "history_scan": f"""WITH {_history()}, {_tables()}
      SELECT entity_id, name, metric_change FROM history_rows""",
    "latest_output": f"WITH {_history()}, {_tables()} SELECT * FROM history_rows",
    "full_cycle": f"""WITH {_history()}, {_tables()}, {_trend(WINDOW_START)}
      SELECT '25.0_121.5' AS location_key, {_id("h.name", "h.latitude", "h.longitude")} AS entity_id,
             h.name, h.history, h.metric_change, t.current_metric, t.range_value, t.range_period
      FROM history_rows h JOIN trend t USING (entity_id)""",
    "trend_summary": f"WITH {_history()}, {_trend(WINDOW_START)} SELECT {_TREND_COLUMNS} FROM trend",
    "trend_summary_located": f"""WITH {_history("hour", _LOCATED, "location_key")},
      {_trend(WINDOW_START, _LOCATED)} SELECT location_key, {_TREND_COLUMNS} FROM trend""",
    "trend_from_map": f"""WITH {_history()}, {_trend(LAST_DAY_START, everyone="hist")}
      SELECT {_TREND_COLUMNS} FROM trend""",
    "display_rows": f"""WITH {_history()}, {_tables()}, {_trend(WINDOW_START)}, {_points(WINDOW_START)},
      {_DISPLAY} SELECT * EXCLUDE (history_text) FROM shown""",
    "recency_fallback": f"""WITH {_history()}, {_points(LAST_DAY_START)}
      SELECT entity_id, commit, metric FROM windowed""",
    "history_key_points": f"WITH {_history()}, {_points(WINDOW_START)} SELECT * FROM points",
    "history_text": f"""WITH {_history()}
      SELECT entity_id, {_HISTORY_TEXT} AS history_text FROM hist GROUP BY entity_id""",
    "history_parse": f"WITH {_history()} SELECT entity_id, commit, metric FROM hist",
    "tolerant_parse": """SELECT event_id, CASE WHEN event_type = 'error' THEN 0 ELSE 1 END::BIGINT AS keys,
             CASE WHEN event_type <> 'error' THEN CAST(json_extract(props, '$.k') AS DOUBLE) END AS k
      FROM events""",
    "instant_parse": f"""WITH {_EVENTS_INSTANT}
      SELECT event_id, instant, strftime(m, '%Y-%m-%d %H:%M:%S') AS at,
             coalesce(strftime(m, '%b %-d, %Y'), substr(instant, 1, 10)) AS date,
             coalesce(strftime(m, '{_DATE_TIME}'), instant) AS date_time,
             coalesce(strftime(m, '%b %-d, %Y'), 'Invalid date') AS label,
             CASE WHEN m IS NOT NULL THEN strftime(m, '{_DATE_TIME}')
                  WHEN length(instant) = 14 THEN substr(instant, 1, 4) || '-' || substr(instant, 5, 2) || '-' ||
                    substr(instant, 7, 2) || ' • ' || substr(instant, 9, 2) || ':' || substr(instant, 11, 2)
                  WHEN length(instant) = 8 THEN substr(instant, 1, 4) || '-' || substr(instant, 5, 2) || '-' ||
                    substr(instant, 7, 2)
                  ELSE instant END AS tooltip
      FROM parsed""",
    "window_start": f"""SELECT o_orderkey, strftime(o_orderdate - INTERVAL 6 MONTH, '{_INSTANT}') AS start
      FROM orders""",
    "signed_text": f"""WITH {_history()}, {_tables()}
      SELECT entity_id, {_signed("metric_change")} AS change_text,
             CASE WHEN metric_change > 0 THEN 'positive' ELSE 'negative' END AS direction
      FROM change""",
    "metric_bands": f"""WITH {_PLACES}
      SELECT place_id, CASE WHEN metric IS NULL THEN 0.0 ELSE least(greatest(metric * 20, 0), 100) END AS percent,
             CASE WHEN metric IS NULL THEN '' WHEN metric >= 4.5 THEN 'excellent' WHEN metric >= 4.0 THEN 'good'
                  WHEN metric >= 3.0 THEN 'average' ELSE 'poor' END AS band,
             CASE WHEN metric IS NULL THEN '' WHEN metric > 3 THEN 'positive' ELSE 'negative' END AS direction,
             {_signed("(metric - 3.0)")} AS signed
      FROM place""",
    "label_text": """WITH words AS (
        SELECT p_partkey, p_name, [replace(p_name, ' ', '_') || '_' || lower(p_type), lower(p_brand)] AS labels
        FROM part),
      shown AS (
        SELECT p_partkey, p_name, array_to_string(list_transform(labels, lambda w:
          upper(w[1:1]) || CASE WHEN contains(w[2:], '_')
            THEN w[2:instr(w, '_') - 1] || ' ' || w[instr(w, '_') + 1:] ELSE w[2:] END), ', ') AS labels
        FROM words)
      SELECT p_partkey, labels, labels AS labels_from_json, p_name AS plain FROM shown""",
    "explore_filter": f"""WITH {_PLACES} SELECT place_id, name, metric FROM place
      WHERE name IS NOT NULL AND name <> '' AND contains(lower(name), 'r#0000001')
        AND metric <> 0 AND metric >= 3""",
    "explore_sorted": f"""WITH {_history()}, {_trend(WINDOW_START)}
      SELECT entity_id, range_magnitude,
             row_number() OVER (ORDER BY range_magnitude DESC NULLS LAST, entity_id) AS position
      FROM trend""",
    "explore_page": f"""WITH {_history()}, {_trend(WINDOW_START)}
      SELECT entity_id, current_metric, range_value, range_magnitude FROM trend
      ORDER BY range_magnitude DESC NULLS LAST, entity_id LIMIT 5 OFFSET 5""",
    "explore_page_deep": f"""WITH {_PLACES} SELECT place_id, name, metric FROM place
      ORDER BY metric ASC NULLS LAST, place_id LIMIT 40 OFFSET 80""",
    "page_count": """SELECT count(*) AS rows, CAST(ceil(count(*) / 5.0) AS BIGINT) AS pages FROM customer""",
    "summary_stats": f"""WITH {_PLACES}
      SELECT count(*) AS total_rows, count(metric) AS rows_with_metric, round(avg(metric), 2) AS average_metric,
             min(metric) AS min_metric, max(metric) AS max_metric FROM place""",
    "filter_options": f"""WITH {_PLACES}, bounds AS (
        SELECT CAST(coalesce(floor(min(metric)), 0) AS BIGINT) AS lo,
               CAST(coalesce(ceil(max(metric)), 5) AS BIGINT) AS hi FROM place)
      SELECT lo AS min_metric, hi AS max_metric,
             CAST(to_json([lo, lo + 1, lo + 2, lo + 3, hi]) AS VARCHAR) AS steps FROM bounds""",
    "summary_report": f"""WITH {_history()}, {_trend(WINDOW_START)}
      SELECT '2024-01-31T00:00:00.000Z' AS generated_at, 'Unknown' AS location, 'events' AS data_source,
             count(*) AS total_rows, count(current_metric) AS rows_with_metric,
             round(avg(current_metric), 2) AS average_metric, min(current_metric) AS min_metric,
             max(current_metric) AS max_metric FROM trend""",
    "avg_by_day": """SELECT strftime(ts, '%Y-%m-%d') AS d, round(avg(value), 6) AS avg_value
      FROM events GROUP BY 1""",
    "rows_for_day": """SELECT event_id, strftime(ts, '%Y-%m-%d') AS d, value FROM events
      WHERE ts >= TIMESTAMP '2024-01-15' AND ts < TIMESTAMP '2024-01-16'""",
    "nearby_search": f"""WITH {_PLACES}, measured AS (
        SELECT place_id, 2 * 6371000.0 * asin(sqrt(least(
                 sin(radians(latitude - {_LAT}) / 2) * sin(radians(latitude - {_LAT}) / 2)
                 + cos(radians({_LAT})) * cos(radians(latitude))
                   * sin(radians(longitude - {_LNG}) / 2) * sin(radians(longitude - {_LNG}) / 2), 1.0))) AS metres
        FROM place WHERE category IN ('BUILDING', 'MACHINERY'))
      SELECT place_id, round(metres, 3) AS distance_m FROM measured WHERE metres <= {RADIUS_M}""",
    "nearby_centres": f"""WITH {_PLACES}, centre AS (
        SELECT s_suppkey AS centre_id, 25.0::DOUBLE + (s_suppkey * 37 % 1000) / 10000.0 AS lat,
               121.0::DOUBLE + (s_suppkey * 11 % 700) / 10000.0 AS lng, 100.0 + s_suppkey % 5 * 200.0 AS radius
        FROM supplier),
      measured AS (
        SELECT centre_id, place_id, radius, 2 * 6371000.0 * asin(sqrt(least(
                 sin(radians(latitude - lat) / 2) * sin(radians(latitude - lat) / 2)
                 + cos(radians(lat)) * cos(radians(latitude))
                   * sin(radians(longitude - lng) / 2) * sin(radians(longitude - lng) / 2), 1.0))) AS metres
        FROM place, centre WHERE category IN ('BUILDING', 'MACHINERY'))
      SELECT centre_id, place_id, round(metres, 3) AS distance_m FROM measured WHERE metres <= radius""",
    "orders_as_of": f"""WITH version AS (
        SELECT o_custkey AS entity_id, strftime(l_shipdate, '{_INSTANT}') AS commit,
               max((10 + floor(l_extendedprice)::BIGINT % 41) / 10.0) AS metric
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1, 2),
      asked AS (SELECT o_orderkey, o_custkey AS entity_id, strftime(o_orderdate, '{_INSTANT}') AS at FROM orders)
      SELECT a.o_orderkey, a.entity_id, a.at, v.commit, v.metric
      FROM asked a ASOF LEFT JOIN version v ON a.entity_id = v.entity_id AND a.at >= v.commit""",
    "search_indexed": f"""WITH {_PLACES} SELECT place_id, name, metric FROM place
      WHERE name IS NOT NULL AND name <> '' AND contains(lower(name), 'r#0000001')
        AND metric <> 0 AND metric >= 3""",
    "summary_merged": f"""WITH {_PLACES}
      SELECT count(*) AS total_rows, count(metric) AS rows_with_metric, round(avg(metric), 2) AS average_metric,
             min(metric) AS min_metric, max(metric) AS max_metric FROM place""",
    "options_merged": f"""WITH {_PLACES}, bounds AS (
        SELECT CAST(coalesce(floor(min(metric)), 0) AS BIGINT) AS lo,
               CAST(coalesce(ceil(max(metric)), 5) AS BIGINT) AS hi FROM place)
      SELECT lo AS min_metric, hi AS max_metric,
             CAST(to_json([lo, lo + 1, lo + 2, lo + 3, hi]) AS VARCHAR) AS steps FROM bounds""",
    "avg_by_day_merged": """SELECT strftime(ts, '%Y-%m-%d') AS d, round(avg(value), 6) AS avg_value
      FROM events GROUP BY 1""",
    "export_csv_rows": f"""WITH {_history()}, {_tables()}, {_trend(WINDOW_START)}, {_points(WINDOW_START)},
      {_DISPLAY}
      SELECT name AS "Name", url AS "URL",
             CASE WHEN current_metric <> 0 THEN {_fixed("current_metric", 1)} ELSE '' END AS "Current Rating",
             coalesce({_fixed("range_value", 1)}, '') AS "Rating Difference",
             coalesce(range_period, '') AS "Rating Range Period", history_text AS "Rating History",
             {_fixed("latitude", 4)} AS "Latitude", {_fixed("longitude", 4)} AS "Longitude"
      FROM shown""",
    "export_json_rows": f"""WITH {_history()}, {_trend(WINDOW_START)} SELECT {_TREND_COLUMNS} FROM trend""",
    "pages_union": f"WITH {_PLACES}, {_PAGES} SELECT * FROM page",
    "pages_dedup": f"""WITH {_PLACES}, {_PAGES} SELECT * FROM page
      QUALIFY row_number() OVER (PARTITION BY place_id ORDER BY page DESC) = 1""",
    "pages_duplicates": f"""WITH {_PLACES}, {_PAGES}
      SELECT place_id, count(*) AS copies FROM page GROUP BY place_id HAVING count(*) > 1""",
    "collect_documents": f"""WITH {_PLACES},
      paged AS (SELECT *, min(balance) OVER (PARTITION BY nation, place_id // 100) AS worst FROM place)
      SELECT '25.0_' || (121.0::DOUBLE + nation)::VARCHAR AS location_key, '20240101000000000' AS commit,
             'n' || lpad(nation::VARCHAR, 2, '0') AS source, place_id::VARCHAR AS place_id,
             CASE WHEN category <> 'BUILDING' THEN upper(name) ELSE name END AS name, metric,
             CASE WHEN category <> 'BUILDING' THEN 'details/' ELSE 'place/' END || place_id::VARCHAR AS url
      FROM paged WHERE worst >= -900""",
    "collect_runs": f"""WITH {_PLACES},
      paged AS (SELECT *, min(balance) OVER (PARTITION BY nation, place_id // 100) AS worst FROM place)
      SELECT '25.0_' || (121.0::DOUBLE + nation)::VARCHAR AS location_key,
             CASE WHEN category <> 'BUILDING' THEN upper(name) ELSE name END AS name,
             CASE WHEN category <> 'BUILDING' THEN (10 + (place_id * 7 + 8 * 13) % 41) / 10.0
                       - (10 + (place_id * 7 + 13) % 41) / 10.0 ELSE 0.0 END AS metric_change
      FROM paged WHERE worst >= -900""",
    "failed_responses": f"""WITH {_PLACES},
      paged AS (SELECT nation, place_id // 100 AS page, min(balance) AS worst FROM place GROUP BY ALL),
      runs AS (SELECT unnest([1, 8]) AS run)
      SELECT 'search' AS kind, 'n' || lpad(nation::VARCHAR, 2, '0') || '-' || run AS request_id,
             page, NULL::VARCHAR AS place_id, 'UNKNOWN_ERROR' AS status
      FROM paged, runs WHERE worst < -900
      UNION ALL
      SELECT 'details', 'n' || lpad(nation::VARCHAR, 2, '0') || '-' || run, NULL, place_id::VARCHAR, 'NOT_FOUND'
      FROM place, runs, (SELECT unnest([1, 2])) WHERE category = 'BUILDING'""",
    "status_rejected": """SELECT c_custkey AS place_id, 'NOT_FOUND' AS status FROM customer
      WHERE c_acctbal < 0""",
    "enrich_details": f"""WITH {_PLACES}, {_DETAILS}
      SELECT p.place_id, coalesce(d.name, p.name) AS name, coalesce(d.metric, p.metric) AS metric, p.category
      FROM place p LEFT JOIN details d USING (place_id)""",
    "enrich_details_strict": f"""WITH {_PLACES}, {_DETAILS}
      SELECT p.place_id, CASE WHEN d.place_id IS NOT NULL THEN d.name ELSE p.name END AS name,
             CASE WHEN d.place_id IS NOT NULL THEN d.metric ELSE p.metric END AS metric, p.category
      FROM place p LEFT JOIN details d ON d.place_id = p.place_id""",
}
