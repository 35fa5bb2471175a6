"""Gapless positions of rows inside large groups, without one window over a group.

Rows of a group are dealt to buckets of about ``PER_BUCKET`` rows; a row's position is
its rank in its bucket plus the sizes of the buckets before it.
"""

from pyspark.sql import DataFrame, Window, functions as F

PER_BUCKET = 256


def positions(rows: DataFrame, group: str, bucket: str, order: list[str]) -> DataFrame:
    """Add ``pos``, from 0 in each group. ``rows`` should be a stored table: it is read twice."""
    sizes = rows.groupBy(group, bucket).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    inside = Window.partitionBy(group, bucket).orderBy(*order)
    ranked = rows.withColumn("_rank", F.row_number().over(inside) - 1)
    joined = ranked.join(starts, [group, bucket])
    return joined.withColumn("pos", (F.col("_start") + F.col("_rank")).cast("long")).drop("_start", "_rank")
