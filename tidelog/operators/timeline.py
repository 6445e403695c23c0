"""Commit timeline: the ordered instants of each location."""

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.functions import instants
from tidelog.sources.scratch import durable

# Commits per chunk of a timeline: what one row of `Timeline.chunks` lists.
CHUNK_COMMITS = 1024
# An instant as a number, without the time of day: 17 digits, 9 of them after the date.
_DAY = 10**9


def as_number(commit: Column | str) -> Column:
    """An instant as a number: orders as the text does, at a fixed width."""
    return (F.col(commit) if isinstance(commit, str) else commit).cast("long")


@dataclass(frozen=True)
class Timeline:
    """The distinct commits of each location, as tables that are worked out where they are used.

    One plan for any length: nothing is counted first, nothing is forced to be broadcast, and
    no window group is longer than the commits of one day or the days of one location.
    """

    commits: DataFrame
    location: tuple[str, ...]
    chunk: int = CHUNK_COMMITS
    table: DataFrame | None = None

    def settled(self) -> "Timeline":
        """The same, its rows written out: worked out once, and of a size that is known to joins."""
        table = durable(self.rows)
        return replace(self, table=table, commits=table.select(*self.location, "commit"))

    @property
    def rows(self) -> DataFrame:
        """`location..., commit, ordinal, n_commits, previous_commit, last_commit`."""
        if self.table is not None:
            return self.table
        place = list(self.location)
        at = self.commits.select(*place, as_number("commit").alias("__at"))
        at = at.withColumn("__day", F.col("__at") - F.col("__at") % _DAY)
        days = at.groupBy(*place, "__day").agg(
            F.count(F.lit(1)).alias("__count"), F.max("__at").alias("__end")
        )
        whole = Window.partitionBy(*place)
        order = whole.orderBy("__day")
        days = days.select(
            *place,
            "__day",
            F.coalesce(F.sum("__count").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"),
            F.lag("__end").over(order).alias("__end_before"),
            F.sum("__count").over(whole).alias("n_commits"),
            F.max("__end").over(whole).alias("__last"),
        )
        within = Window.partitionBy(*place, "__day").orderBy("__at")
        placed = at.withColumns(
            {"__row": F.row_number().over(within), "__previous": F.lag("__at").over(within)}
        )
        return placed.join(days, [*place, "__day"]).select(
            *place,
            F.col("__at").cast("string").alias("commit"),
            (F.col("__before") + F.col("__row")).alias("ordinal"),
            "n_commits",
            F.coalesce("__previous", "__end_before").cast("string").alias("previous_commit"),
            F.col("__last").cast("string").alias("last_commit"),
        )

    def chunk_of(self, ordinal: Column) -> Column:
        """Number of the chunk that lists the commit with this ordinal."""
        return F.floor((ordinal - 1) / self.chunk)

    def chunks(self, numbers: bool = False) -> DataFrame:
        """`location..., __chunk, __names`: the commits in order, `chunk` of them a row.

        `numbers`: as numbers, a quarter of the text's bytes in an exchange.
        """
        name = as_number("commit") if numbers else F.col("commit")
        listed = F.sort_array(F.collect_list(name)).alias("__names")
        numbered = self.rows.withColumn("__chunk", self.chunk_of(F.col("ordinal")))
        return numbered.groupBy(*self.location, "__chunk").agg(listed)

    def numbered(self, log: DataFrame) -> DataFrame:
        """`log` with the ordinal, count and neighbours of each row's commit."""
        return log.join(self.rows, [*self.location, "commit"])

    def with_place(self, df: DataFrame, chosen: DataFrame, value: Column, name: str) -> DataFrame:
        """`df` with a value of its location's `chosen` commits; null where there is none.

        One row per location: whatever the timeline's length, this side grows with locations only.
        """
        if not self.location:
            return df.withColumn(name, chosen.agg(value).scalar())
        one = chosen.groupBy(*self.location).agg(value.alias(name))
        return df.join(one, list(self.location), "left")

    def with_last(self, df: DataFrame, name: str) -> DataFrame:
        """`df` with the last commit of its location, as a number."""
        return self.with_place(df, self.commits, F.max(as_number("commit")), name)

    def with_first_from(self, df: DataFrame, start: str, name: str) -> DataFrame:
        """`df` with the first commit of its location from `start` on, null if there is none."""
        recent = self.commits.filter(instants.minute(F.col("commit")) >= start)
        return self.with_place(df, recent, F.min(as_number("commit")), name)

    def instants(self) -> list[str]:
        """All commits of a timeline without locations, in order: the columns of a wide view."""
        if self.location:
            raise ValueError("each location has its own commits")
        return [row["commit"] for row in self.commits.orderBy("commit").collect()]


def load_timeline(
    commits: DataFrame, location: Sequence[str] = (), chunk: int = CHUNK_COMMITS
) -> Timeline:
    """The timeline of a commit table, or of a log: its distinct instants per location."""
    place = tuple(location)
    listed = commits.select(*place, "commit").filter("commit is not null").distinct()
    return Timeline(listed, place, chunk)


def commit_timeline(commits: DataFrame, location: Sequence[str] = ()) -> DataFrame:
    """Completed commits in ascending order with their ordinal."""
    return load_timeline(commits, location).rows.select(*location, "commit", "ordinal")
