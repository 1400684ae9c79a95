"""Row numbers over a whole table, without a one-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbstream.session import materialise


def numbered(df: DataFrame, *order: Column | str, name: str = "position") -> DataFrame:
    """Add 1, 2, 3, ... in the given total order.

    The sort is a range shuffle, so equal leading values spread over tasks by the columns that
    follow. Each task numbers its own rows from some start; the rows before it are a running sum
    over one count per sort partition, which is all that is broadcast. The sorted rows are
    written once, while the plan is built, so both steps see the same partitions even if a task
    is run again.
    """
    sorted_rows = materialise(
        df.orderBy(*order).withColumns({
            "_part": F.spark_partition_id(), "_slot": F.monotonically_increasing_id()}),
        "numbered")
    sizes = sorted_rows.groupBy("_part").agg(
        F.count("*").alias("_rows"), F.min("_slot").alias("_first"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", "_first", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    return (sorted_rows.join(F.broadcast(offsets), "_part")
            .select(*df.columns,
                    (F.col("_offset") + F.col("_slot") - F.col("_first") + 1).alias(name)))
