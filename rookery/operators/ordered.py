"""Order-dependent lookups that do not put one key's whole history in one task."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from rookery.plans.scratch import Scratch


def latest(value: str | Column, *order: str) -> Column:
    """Aggregate: the value of the row that comes last; mergeable, so combined map-side."""
    return F.max_by(value, F.struct(*order))


def previous_value(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, chunk: Column, name: str
) -> DataFrame:
    """Adds ``name``: the value on the key's preceding row, null on its first row.

    ``chunk`` is a non-decreasing function of the order. Rows look back within their
    (key, chunk); only the last value of each chunk travels between chunks, so a key
    with very many rows spreads over its chunks.
    """
    chunked = df.withColumn("_chunk", chunk)
    group = [*keys, "_chunk"]
    inside = Window.partitionBy(*group).orderBy(*order)
    looked = chunked.withColumns(
        {"_previous": F.lag(value).over(inside), "_position": F.row_number().over(inside)}
    )
    ends = chunked.groupBy(*group).agg(latest(value, *order).alias("_end"))
    carried = ends.select(
        *group, F.lag("_end").over(Window.partitionBy(*keys).orderBy("_chunk")).alias("_carried")
    )
    found = F.when(F.col("_position") == 1, F.col("_carried")).otherwise(F.col("_previous"))
    return looked.join(carried, group).withColumn(name, found).drop(
        "_chunk", "_previous", "_position", "_carried"
    )


def range_parts(rows: DataFrame, order: Sequence[str | Column], scratch: Scratch, label: str) -> DataFrame:
    """The rows as a stored table of equal ranges of ``order``, each with its number ``part``.

    The table fixes which row lies in which part, so later plans agree on it. Range
    borders come from a sample of the rows, hence ``rows`` should be cheap to read twice.
    """
    dealt = rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    return scratch.save(dealt, label)


def positions(
    rows: DataFrame,
    order: Sequence[str | Column],
    scratch: Scratch,
    label: str,
    per: Sequence[str] = (),
    name: str = "position",
) -> DataFrame:
    """Adds the row's place in ``order``, from 1, counted anew for each ``per`` value.

    ``order`` should be total but for equal rows, and start with the ``per`` columns. Rows
    are ranked inside range parts of equal size and a part adds the sizes of those before
    it, so no task reads all rows of a busy value.
    """
    parts = range_parts(rows, order, scratch, label)
    group = [*per, "part"]
    sizes = parts.groupBy(*group).agg(F.count(F.lit(1)).alias("_size"))
    # as many rows as a value has parts, at most the number of shuffle partitions
    earlier = Window.partitionBy(*per).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*group, F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start"))
    ranked = parts.withColumn("_rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    matched = [ranked[c].eqNullSafe(starts[c]) for c in group]
    joined = ranked.join(starts, matched)
    place = (F.col("_start") + F.col("_rank")).cast("bigint").alias(name)
    return joined.select(*[ranked[c] for c in rows.columns], place)


def running_total(
    parts: DataFrame, order: Sequence[str | Column], value: Column, name: str, per: Sequence[str] = ()
) -> DataFrame:
    """Adds the sum of a whole number over the rows up to this one, anew for each ``per`` value.

    ``parts`` comes from ``range_parts`` with the same order. Sums run inside a part and a part
    adds the totals of those before it.
    """
    group = [*per, "part"]
    valued = parts.withColumn("_value", value.cast("bigint"))
    totals = valued.groupBy(*group).agg(F.sum("_value").alias("_total"))
    earlier = Window.partitionBy(*per).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(*group, F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_start"))
    so_far = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = valued.withColumn("_sum", F.sum("_value").over(so_far))
    joined = summed.join(starts, [summed[c].eqNullSafe(starts[c]) for c in group])
    kept = [summed[c] for c in parts.columns if c != "part"]
    return joined.select(*kept, (F.col("_start") + F.col("_sum")).cast("bigint").alias(name))
