"""Sums and means of doubles that do not depend on the order of addition.

A double is cut into whole multiples of 1, 2^-30 and 2^-60. Each part is a whole number below 2^30
with the double's sign, and whole numbers are summed exactly, in any order and any grouping: over
partitions, micro-batches or stored partial sums. Only the finished sums are put together as a
double, in fixed steps, so equal inputs give equal bits. All of it is Spark's own sums in
fixed-width buffers, which hash aggregates reduce before a shuffle.

Range: values below 2^30 in size. What a value has below 2^-60 is cut off (values from 2^-8 on have
nothing there). Up to 2^33 values a group; more raise an overflow error. Values beyond the range,
infinities and NaN are summed as doubles beside the parts, as a plain sum would be. Putting the
parts together rounds a few times, each time by at most half a unit in the last place.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kerbstream.schemas import EXACT_STATE

STEP = 2.0 ** 30  # from one part to the next, and the range
PARTS = EXACT_STATE.names[:3]


def _parts(size: Column) -> list[Column]:
    """Of a value without its sign. Remainders of doubles by powers of two, and their products
    with them, are exact."""
    return [F.floor(size), F.floor((size % F.lit(1.0)) * F.lit(STEP)),
            F.floor((size % F.lit(1 / STEP)) * F.lit(STEP * STEP))]


def exact_state(name: str) -> Column:
    """Aggregate: what ``state_mean`` needs, which can be stored and merged."""
    value = F.col(name).cast("double")
    size = F.abs(value)
    inside, sign = size < F.lit(STEP), F.signum(value).cast("long")
    sums = [F.coalesce(F.sum(F.when(inside, sign * part)), F.lit(0).cast("long"))
            for part in _parts(size)]
    return F.struct(*[s.alias(part) for s, part in zip(sums, PARTS)],
                    F.sum(F.when(~inside, value)).alias("beyond"), F.count(value).alias("values"))


def merged_state(name: str) -> Column:
    """Aggregate: one state from many."""
    return F.struct(*[F.sum(F.col(name)[field]).alias(field) for field in EXACT_STATE.names])


def state_sum(state: Column) -> Column:
    """The sum of a state; NULL without values."""
    whole, middle, low = [state[part].cast("double") for part in PARTS]
    total = (low / F.lit(STEP) + middle) / F.lit(STEP) + whole
    return F.when(state["values"] > 0, total + F.coalesce(state["beyond"], F.lit(0.0)))


def state_mean(state: Column) -> Column:
    """The mean of a state; NULL without values."""
    return F.try_divide(state_sum(state), state["values"])


def exact_mean(name: str) -> Column:
    """Aggregate: the mean of a column of doubles. NULLs do not count."""
    return state_mean(exact_state(name))
