"""Joins of a long table with a list of keys, where a few keys have very many rows."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

ROWS_PER_SALT = 1 << 16


def hot_keys(rows: DataFrame, key: str, limit: int) -> DataFrame:
    """(key, salts) of the keys with more than ``limit`` rows; at most one in ``limit`` rows is listed."""
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit)
    return counts.select(key, F.ceil(F.col("n") / limit).alias("salts"))


def fan_out(
    rows: DataFrame, readers: DataFrame, key: str, spread_by: Sequence[str], limit: int = ROWS_PER_SALT
) -> DataFrame:
    """Every row to every reader of its ``key``: an inner join on a column both have.

    The rows of a hot key are dealt over salts by a hash of ``spread_by``, and only such a
    key's readers are copied, once per salt. So its rows spread over as many tasks as it takes.
    """
    hot = hot_keys(rows, key, limit)
    salts = F.coalesce("salts", F.lit(1).cast("bigint"))
    dealt = rows.join(hot, key, "left").withColumn("_salt", F.pmod(F.xxhash64(*spread_by), salts)).drop("salts")
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), salts - 1))
    copied = readers.join(hot, key, "left").withColumn("_salt", every).drop("salts")
    return dealt.join(copied, [key, "_salt"]).drop("_salt")
