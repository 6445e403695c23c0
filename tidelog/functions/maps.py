"""Row-local expressions over a history map (instant -> metric).

A map is one cell and holds at most one entry per commit, so everything here
stays inside a projection: no shuffle.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidelog.functions import instants, text

HISTORY_TYPE = "map<string,double>"


def parse_history(json_text: Column) -> Column:
    """History text to a map; bad, empty or null text gives an empty map."""
    return F.coalesce(F.from_json(json_text, HISTORY_TYPE), F.create_map().cast(HISTORY_TYPE))


def history_json(history: Column) -> Column:
    return F.to_json(history)


def entries(history: Column) -> Column:
    """Usable observations in time order: valid instant, metric present."""
    pairs = F.transform(
        F.map_entries(history),
        lambda e: F.struct(e["key"].alias("commit"), e["value"].alias("metric")),
    )
    return F.sort_array(
        F.filter(pairs, lambda e: e["metric"].isNotNull() & instants.is_instant(e["commit"]))
    )


def recent_or_all(observations: Column, start: Column) -> Column:
    """Observations from `start` on, or all of them when there is none."""
    recent = F.filter(observations, lambda e: instants.minute(e["commit"]) >= start)
    return F.when(F.size(recent) > 0, recent).otherwise(observations)


def key_points(observations: Column, window: Column) -> Column:
    """Latest, highest, lowest and first observation, newest first, without repeats.

    High and low are those of `window`: the lowest is the earliest instant of the low,
    the highest the latest instant of the high.
    """
    ranked = F.transform(
        window, lambda e: F.struct(e["metric"].alias("metric"), e["commit"].alias("commit"))
    )

    def point(e: Column) -> Column:
        return F.struct(e["commit"].alias("commit"), e["metric"].alias("metric"))

    picks = F.array(
        point(F.try_element_at(observations, F.lit(-1))),
        point(F.array_max(ranked)),
        point(F.array_min(ranked)),
        point(F.try_element_at(observations, F.lit(1))),
    )
    present = F.filter(F.array_distinct(picks), lambda e: e["commit"].isNotNull())
    return F.sort_array(present, asc=False)


def points_text(points: Column, separator: str = "\n") -> Column:
    """One line `date and time → value` per point."""

    def line(e: Column) -> Column:
        return F.concat(
            instants.tooltip_date(e["commit"]), F.lit("  →  "), text.fixed_text(e["metric"], 1)
        )

    return F.array_join(F.transform(points, line), separator)


def history_text(json_text: Column) -> Column:
    """`date: value` items in time order; unreadable text is shown as it is.

    Items with an unreadable instant come first.
    """
    parsed = F.from_json(json_text, HISTORY_TYPE)
    items = F.transform(
        F.map_entries(parsed),
        lambda e: F.struct(
            F.coalesce(instants.parse_instant(e["key"]), F.lit(0).cast("timestamp")).alias("at"),
            e["key"].alias("commit"),
            F.concat(
                instants.format_date(e["key"]),
                F.lit(": "),
                F.coalesce(text.fixed_text(e["value"], 1), F.lit("N/A")),
            ).alias("item"),
        ),
    )
    joined = F.array_join(F.transform(F.sort_array(items), lambda i: i["item"]), "; ")
    return F.coalesce(joined, json_text, F.lit(""))
