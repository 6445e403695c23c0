"""Commit instants: 17-digit UTC strings, ordered as text."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The instant and display formats.
INSTANT_PATTERN = "^[0-9]{17}$"
PLAIN_INSTANT = (
    "^[0-9]{4}(0[1-9]|1[0-2])(0[1-9]|1[0-9]|2[0-8])([01][0-9]|2[0-3])[0-5][0-9][0-5][0-9]{4}$"
)
INSTANT_FORMAT = "yyyyMMddHHmmssSSS"
SECONDS_FORMAT = "yyyyMMddHHmmss"
DATE_FORMAT = "MMM d, yyyy"
DATE_TIME_FORMAT = "MMM d, yyyy • h:mm a"


def to_instant(moment: Column) -> Column:
    return F.date_format(moment, INSTANT_FORMAT)


def parse_instant(instant: Column) -> Column:
    """Timestamp at minute precision; null unless exactly 17 digits naming a real time."""
    # The default parser gives null for the full pattern, so milliseconds are cut first.
    seconds = F.when(instant.rlike(INSTANT_PATTERN), F.substring(instant, 1, 14))
    return F.date_trunc("minute", F.try_to_timestamp(seconds, F.lit(SECONDS_FORMAT)))


def is_instant(instant: Column) -> Column:
    """Whether `parse_instant` gives a time; null counts as no.

    Up to the 28th the digits alone decide, which spares most rows the parsing.
    """
    return F.when(instant.rlike(PLAIN_INSTANT), F.lit(True)).otherwise(
        parse_instant(instant).isNotNull()
    )


def minute(instant: Column) -> Column:
    """The instant without its seconds."""
    return F.concat(F.substring(instant, 1, 12), F.lit("00000"))


def window_start(as_of: Column, months: int = 6) -> Column:
    """Instant `months` before `as_of`; a month end is clamped (31 Aug -> 28/29 Feb)."""
    return to_instant(as_of - F.make_ym_interval(F.lit(0), F.lit(months)))


def format_date(instant: Column) -> Column:
    """Date for display; an invalid instant shows its first ten characters."""
    return F.coalesce(
        F.date_format(parse_instant(instant), DATE_FORMAT),
        F.nullif(F.substring(instant, 1, 10), F.lit("")),
        F.lit("Invalid date"),
    )


def format_date_time(instant: Column) -> Column:
    """Date and time for display; an invalid instant shows as it is."""
    return F.coalesce(
        F.date_format(parse_instant(instant), DATE_TIME_FORMAT),
        F.nullif(instant, F.lit("")),
        F.lit("Invalid date"),
    )


def date_label(instant: Column) -> Column:
    """Strict date for display: `N/A` when absent, `Invalid date` when unreadable."""
    absent = instant.isNull() | (instant == "")
    return F.when(absent, F.lit("N/A")).otherwise(
        F.coalesce(F.date_format(parse_instant(instant), DATE_FORMAT), F.lit("Invalid date"))
    )


def tooltip_date(instant: Column) -> Column:
    """Date and time for display; 14- and 8-digit strings are laid out as written."""
    day = F.concat_ws(
        "-", F.substring(instant, 1, 4), F.substring(instant, 5, 2), F.substring(instant, 7, 2)
    )
    clock = F.concat_ws(":", F.substring(instant, 9, 2), F.substring(instant, 11, 2))
    return (
        F.when(is_instant(instant), F.date_format(parse_instant(instant), DATE_TIME_FORMAT))
        .when(instant.rlike("^[0-9]{14}$"), F.concat(day, F.lit(" • "), clock))
        .when(instant.rlike("^[0-9]{8}$"), day)
        .otherwise(F.coalesce(F.nullif(instant, F.lit("")), F.lit("Invalid date")))
    )
