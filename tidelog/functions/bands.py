"""Classes of a metric on the 0-5 scale and of its change."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lower bounds of the bands, highest first.
BANDS = [(4.5, "excellent"), (4.0, "good"), (3.0, "average")]
LOWEST_BAND = "poor"
PERCENT_PER_POINT = 20


def percent_of_scale(metric: Column, factor: float = PERCENT_PER_POINT) -> Column:
    scaled = F.least(F.greatest(metric * F.lit(float(factor)), F.lit(0.0)), F.lit(100.0))
    return F.when(metric.isNull(), F.lit(0.0)).otherwise(scaled)


def band(metric: Column) -> Column:
    chain = F.when(metric.isNull(), F.lit(""))
    for bound, label in BANDS:
        chain = chain.when(metric >= bound, F.lit(label))
    return chain.otherwise(F.lit(LOWEST_BAND))


def direction(change: Column) -> Column:
    """Only a rise is positive: no change counts as negative."""
    return (
        F.when(change.isNull(), F.lit(""))
        .when(change > 0, F.lit("positive"))
        .otherwise(F.lit("negative"))
    )
