"""Traffic measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
SPEED_OFFSET = 0.01
INDEX_DECIMALS = 2
VOLUME_SPREAD = 0.15
SPEED_SPREAD = 3.0
# (first hour, last hour, factor): morning rush, midday, evening rush, late and early night.
HOUR_BANDS = [
    (7, 9, 2.2),
    (12, 14, 1.5),
    (17, 19, 2.5),
    (22, 23, 0.5),
    (0, 5, 0.5),
]
BASE_FACTOR = 1.0


def congestion_index(vehicles: str, speed: str) -> Column:
    """Vehicles per unit of speed. The offset keeps standing traffic finite; a mean speed
    that cancels it gives NULL instead of stopping the job."""
    ratio = F.try_divide(F.col(vehicles), F.col(speed) + F.lit(SPEED_OFFSET))
    return F.round(ratio, INDEX_DECIMALS)


def traffic_factor(time: str) -> Column:
    """Expected demand for the hour of day, relative to the base; NULL without a time."""
    hour = F.hour(time)
    factor = F.when(hour.isNull(), F.lit(None).cast("double"))
    for first, last, value in HOUR_BANDS:
        factor = factor.when(hour.between(first, last), F.lit(value))
    return factor.otherwise(F.lit(BASE_FACTOR))


def z_score(observed: str, expected: str, spread: Column) -> Column:
    return F.try_divide(F.col(observed) - F.col(expected), spread)
