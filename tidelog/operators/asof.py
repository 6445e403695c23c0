"""As-of join: each request meets the version that was in force at its instant.

Versions and requests are put in one order and walked once; there is no range join and no read
per instant.  The walk goes by entity and stretch of time (the first characters of an instant,
by default the day), so that an entity with a third of all requests is dealt out over its days.  What
holds when a stretch begins is the last version of the stretches before: one row per entity and
stretch is enough to know it.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.operators.snapshots import ENTITY

#: Characters of an instant that name a day.
DAY = 8


def as_of_join(
    requests: DataFrame,
    versions: DataFrame,
    at: str,
    columns: Sequence[str],
    entity: Sequence[str] = ENTITY,
    commit: str = "commit",
    stretch: int = DAY,
) -> DataFrame:
    """`requests` with `columns` of the entity's last version at or before `at`; null before the first.

    `at` and `commit` are instants as text.  Versions: at most one per entity and commit (see
    `upsert_merge`).  Requests may repeat; one with a null entity or instant keeps its row.
    """
    key = list(entity)
    clash = set(columns) & set(requests.columns)
    if clash:
        raise ValueError(f"both sides have {sorted(clash)}")
    payload = F.struct(*columns)
    known = versions.filter(F.col(commit).isNotNull()).select(
        *key, F.col(commit).alias("__at"), payload.alias("__version")
    )
    # The entity and the instant travel once, as keys of the walk.
    rest = [c for c in requests.columns if c not in (*key, at)]
    carried_on = F.struct(F.lit(True).alias("__asked"), *rest).alias("__request")
    asked = requests.select(*key, F.col(at).alias("__at"), carried_on)
    part = F.substring("__at", 1, stretch)
    known, asked = (df.withColumn("__stretch", part) for df in (known, asked))
    none_asked = F.lit(None).cast(asked.schema["__request"].dataType)
    none_known = F.lit(None).cast(known.schema["__version"].dataType)
    columns_of = [*key, "__stretch", "__at", "__rank", "__version", "__request"]
    rows = known.withColumns({"__rank": F.lit(1), "__request": none_asked}).select(columns_of)
    # At one instant the version comes before the request.
    rows = rows.union(
        asked.withColumns({"__rank": F.lit(2), "__version": none_known}).select(columns_of)
    )
    # The last version of each stretch, carried on to all later stretches of the entity.
    ends = known.groupBy(*key, "__stretch").agg(F.max_by("__version", "__at").alias("__end"))
    touched = asked.filter("__at IS NOT NULL").select(*key, "__stretch").distinct()
    axis = ends.unionByName(touched.withColumn("__end", none_known))
    axis = axis.groupBy(*key, "__stretch").agg(F.first("__end", ignorenulls=True).alias("__end"))
    earlier = Window.partitionBy(*key).orderBy("__stretch").rowsBetween(Window.unboundedPreceding, -1)
    carried = axis.select(
        *key,
        "__stretch",
        F.lit("").alias("__at"),
        F.lit(0).alias("__rank"),
        F.last("__end", ignorenulls=True).over(earlier).alias("__version"),
        none_asked.alias("__request"),
    ).filter("__version IS NOT NULL")
    walk = Window.partitionBy(*key, "__stretch").orderBy("__at", "__rank")
    so_far = walk.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.union(carried.select(columns_of)).withColumn(
        "__version", F.last("__version", ignorenulls=True).over(so_far)
    )
    usable = F.col("__at").isNotNull()
    found = [F.when(usable, F.col(f"__version.{c}")).alias(c) for c in columns]
    kinds = {f.name: f.dataType for f in requests.schema}

    def own(c: str) -> Column:
        held = F.col("__request")[c] if c in rest else F.col(c if c in key else "__at")
        return held.cast(kinds[c]).alias(c)

    return placed.filter("__rank = 2").select(*[own(c) for c in requests.columns], *found)
