"""Content-derived identity of an entity."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# They decide the ids, so changing one changes every id.
COORDINATE_DIGITS = 4
ID_LENGTH = 12


def stable_id(name: Column, latitude: Column, longitude: Column) -> Column:
    """Short hash of the normalised name and the rounded position.

    Null when any input is null; route such rows away with `reject_reason`.
    """

    def grid(position: Column) -> Column:
        return F.round(position, COORDINATE_DIGITS).cast("string")

    identity = F.concat(
        F.lower(F.trim(name)), F.lit("_"), grid(latitude), F.lit("_"), grid(longitude)
    )
    return F.substring(F.sha2(identity, 256), 1, ID_LENGTH)


def reject_reason(name: Column, latitude: Column, longitude: Column) -> Column:
    """Why a row can have no identity; null for a usable row."""
    return (
        F.when(name.isNull(), F.lit("missing name"))
        .when(latitude.isNull(), F.lit("missing latitude"))
        .when(longitude.isNull(), F.lit("missing longitude"))
    )


def location_key(latitude: Column, longitude: Column) -> Column:
    """Directory-safe key of a search centre."""
    return F.concat(latitude.cast("string"), F.lit("_"), longitude.cast("string"))
