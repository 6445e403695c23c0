"""Search, filter, sort, page and summarise rows."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.functions import geo

#: Rows of one position in a block of `nearby_many`.
BLOCK = 1024


def explore_filter(
    rows: DataFrame,
    search: str = "",
    threshold: float | None = None,
    name: str = "name",
    metric: str = "current_metric",
) -> DataFrame:
    """Named rows whose name contains `search` (any case, literal) and whose metric
    reaches `threshold`; with a threshold, a null or zero metric never passes."""
    kept = F.col(name).isNotNull() & (F.col(name) != "")
    if search:
        kept &= F.contains(F.lower(F.col(name)), F.lower(F.lit(search)))
    if threshold is not None:
        kept &= (F.col(metric) != 0) & (F.col(metric) >= threshold)
    return rows.filter(kept)


def sort_order(column: str, descending: bool = False, tie: str = "entity_id") -> list[Column]:
    """Nulls last both ways, ties by the unique `tie` column."""
    key = F.col(column)
    return [key.desc_nulls_last() if descending else key.asc_nulls_last(), F.col(tie).asc()]


def next_order(
    column: str, current: tuple[str, bool] = ("range_magnitude", True)
) -> tuple[str, bool]:
    """Sort after a click on `column`: the same column toggles, another starts ascending."""
    return (column, not current[1]) if column == current[0] else (column, False)


def explore(
    rows: DataFrame,
    search: str = "",
    threshold: float | None = None,
    sort: str = "range_magnitude",
    descending: bool = True,
    tie: str = "entity_id",
    **columns: str,
) -> DataFrame:
    """Filter, then sort; by default the largest range first."""
    return explore_filter(rows, search, threshold, **columns).orderBy(
        *sort_order(sort, descending, tie)
    )


def page(rows: DataFrame, order: Sequence[Column], number: int, size: int = 5) -> DataFrame:
    """Rows of page `number` (from 1) in the given order: a top-k of the rows up to its end.

    Right near the front, where pages are turned.  To open any page of a published table at the
    cost of that page, keep a rank index (`sources.ranks`).
    """
    if number < 1 or size < 1:
        raise ValueError("page number and size start at 1")
    return rows.orderBy(*order).offset((number - 1) * size).limit(size)


def page_count(rows: DataFrame, size: int = 5) -> DataFrame:
    return rows.agg(
        F.count(F.lit(1)).alias("rows"), F.ceil(F.count(F.lit(1)) / size).alias("pages")
    )


def summary_stats(rows: DataFrame, metric: str = "current_metric") -> DataFrame:
    """One row; average, minimum and maximum are null when no row has the metric."""
    return rows.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count(metric).alias("rows_with_metric"),
        F.round(F.avg(metric), 2).alias("average_metric"),
        F.min(metric).alias("min_metric"),
        F.max(metric).alias("max_metric"),
    )


def filter_options(rows: DataFrame, metric: str = "current_metric") -> DataFrame:
    """Whole-number bounds of the metric and the five steps offered; 0 and 5 when empty."""
    bounds = rows.agg(
        F.coalesce(F.floor(F.min(metric)), F.lit(0)).cast("bigint").alias("min_metric"),
        F.coalesce(F.ceil(F.max(metric)), F.lit(5)).cast("bigint").alias("max_metric"),
    )
    low, high = F.col("min_metric"), F.col("max_metric")
    return bounds.withColumn("steps", F.array(low, low + 1, low + 2, low + 3, high))


def avg_by_day(rows: DataFrame, day: str = "date", value: str = "current_popularity") -> DataFrame:
    return rows.groupBy(day).agg(F.avg(value).alias(f"avg_{value}"))


def rows_for_day(rows: DataFrame, wanted: str, day: str = "date") -> DataFrame:
    return rows.filter(F.col(day) == wanted)


def with_keywords(rows: DataFrame, keywords: str, text: Sequence[str]) -> DataFrame:
    """Rows whose text has any of the blank-separated keywords; all rows without any."""
    words = keywords.lower().split()
    if not words:
        return rows
    haystack = F.lower(F.concat_ws(" ", *text))
    wanted = F.lit(False)
    for word in words:
        wanted |= F.contains(haystack, F.lit(word))
    return rows.filter(wanted)


def nearby(
    rows: DataFrame,
    centre_lat: float,
    centre_lng: float,
    radius_m: float,
    keywords: str = "",
    text: Sequence[str] = ("name",),
    latitude: str = "latitude",
    longitude: str = "longitude",
) -> DataFrame:
    """Rows within the radius whose text has any of the blank-separated keywords.

    Adds `distance_m`.  The box goes down to the scan; the exact distance decides.
    """
    lat, lng = F.col(latitude), F.col(longitude)
    boxed = with_keywords(
        rows.filter(
            geo.bounding_box(lat, lng, centre_lat, centre_lng, radius_m) & lat.isNotNull() & lng.isNotNull()
        ),
        keywords,
        text,
    )
    distance = geo.haversine(lat, lng, centre_lat, centre_lng)
    return boxed.withColumn("distance_m", distance).filter(F.col("distance_m") <= radius_m)


def _blocks(rows: DataFrame, by: Sequence[str], kept: Sequence[str], salts: int, name: str) -> DataFrame:
    """`by`, `__salt` and the list `name`: rows that agree on `by`, at most `BLOCK` of them, as structs of `kept`.

    A position with a third of all rows is dealt out over `salts` tasks.
    """
    # By contents, so that a repeated task deals and numbers alike; maps have no hash.
    contents = [f.name for f in rows.schema if "map<" not in f.dataType.simpleString()]
    dealt = rows.withColumn("__hash", F.xxhash64(*contents)).withColumn(
        "__salt", F.pmod("__hash", F.lit(salts)).cast("int")
    )
    numbered = F.row_number().over(Window.partitionBy(*by, "__salt").orderBy("__hash"))
    blocked = dealt.withColumn("__block", F.floor((numbered - 1) / BLOCK))
    listed = F.collect_list(F.struct(*kept)).alias(name)
    return blocked.groupBy(*by, "__salt", "__block").agg(listed).drop("__block")


def nearby_many(
    rows: DataFrame,
    centres: DataFrame,
    keywords: str = "",
    text: Sequence[str] = ("name",),
    latitude: str = "latitude",
    longitude: str = "longitude",
    salts: int = 8,
    columns: Sequence[str] | None = None,
    digits: int | None = None,
) -> DataFrame:
    """Rows within the radius of each of many centres: `rows`, the centre's other columns, `distance_m`.

    `centres`: centre_lat, centre_lng, radius_m and any more.  Circles are covered by cells of a grid
    whose size follows their radius (powers of two), rows fall into one cell per size, and both meet
    by an equi-join; the exact distance decides.  Rows of one position, and centres of one circle, meet
    as blocks: their distance is worked out (and rounded to `digits`) once, and the pairs are made
    after that.  The blocks of a cell are dealt out over `salts` keys: a cell with a third of all rows is
    no hot partition.  Rows and centres without a position or radius meet nothing; each pair comes
    once.  `columns`: those of `rows` to return, by default all.
    """
    spark, kept = rows.sparkSession, rows.columns if columns is None else list(columns)
    circle = ["centre_lat", "centre_lng", "radius_m"]
    level = F.greatest(F.ceil(F.log2(F.greatest("radius_m", F.lit(1.0)))), F.lit(0)).cast("int")
    north, east = geo.reach_of(F.col("centre_lat"), F.col("radius_m"))
    placed = centres.filter("centre_lat IS NOT NULL AND centre_lng IS NOT NULL AND radius_m >= 0")
    # One row per size of circle there is: at most 25, from a metre to the whole earth.
    levels = sorted(r["__level"] for r in placed.select(level.alias("__level")).distinct().collect())
    circles = _blocks(placed, circle, centres.columns, salts, "__centres").drop("__salt")
    sized = circles.withColumns({"__level": level, "__north": north, "__east": east})
    here = F.col("__level")
    bands = sized.withColumn(
        "__band",
        F.explode(
            F.sequence(
                geo.band_of(F.col("centre_lat") - F.col("__north"), here),
                geo.band_of(F.col("centre_lat") + F.col("__north"), here),
            )
        ),
    ).withColumn("__around", geo.cells_around(F.col("__band"), here))
    first = geo.cell_of(F.col("centre_lng") - F.col("__east"), F.col("__around"))
    last = geo.cell_of(F.col("centre_lng") + F.col("__east"), F.col("__around"))
    cells = F.sequence(first, F.least(last, first + F.col("__around") - 1))
    covered = bands.withColumn("__cell", F.explode(cells)).withColumns(
        {
            "__cell": F.pmod("__cell", "__around"),
            "__salt": F.explode(F.sequence(F.lit(0), F.lit(salts - 1))),
        }
    )
    lat, lng = F.col(latitude), F.col(longitude)
    located = with_keywords(rows.filter(lat.isNotNull() & lng.isNotNull()), keywords, text)
    needed = list(dict.fromkeys([*kept, latitude, longitude]))
    at = located.select(*needed, lat.alias("__lat"), lng.alias("__lng"))
    spots = _blocks(at, ["__lat", "__lng"], kept, salts, "__rows")
    lat, lng = F.col("__lat"), F.col("__lng")
    each = F.explode(F.array(*[F.lit(n) for n in levels]).cast("array<int>"))
    in_cells = spots.withColumn("__level", each).withColumn("__band", geo.band_of(lat, here))
    around = geo.cells_around(F.col("__band"), here)
    in_cells = in_cells.withColumn("__cell", F.pmod(geo.cell_of(lng, around), around))
    distance = geo.haversine(lat, lng, F.col("centre_lat"), F.col("centre_lng"))
    # A given number of tasks: by their few bytes the blocks would be put in one, which makes all pairs.
    key, tasks = ["__level", "__band", "__cell", "__salt"], int(spark.conf.get("spark.sql.shuffle.partitions"))
    met = (
        in_cells.repartition(tasks, *key)
        .join(covered.repartition(tasks, *key), key)
        .withColumn("distance_m", distance)
        .filter(F.col("distance_m") <= F.col("radius_m"))
    )
    if digits is not None:
        met = met.withColumn("distance_m", F.round("distance_m", digits))
    pairs = met.select("__rows", "distance_m", F.explode("__centres").alias("__centre")).select(
        F.explode("__rows").alias("__row"), "__centre", "distance_m"
    )
    return pairs.select(
        *[F.col("__row")[c].alias(c) for c in kept],
        *[F.col("__centre")[c].alias(c) for c in centres.columns],
        "distance_m",
    )
