"""Stored tables: users, friendships, and keyed reads."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rookery.functions.scalar import as_set
from rookery.schemas import FRIEND, USER

SET_COLUMNS = ("interests", "likednewsarticles", "seenarticles")


def read_users(spark: SparkSession, path: str) -> DataFrame:
    users = spark.read.schema(USER).parquet(path)
    return users.withColumns({name: as_set(F.col(name)) for name in SET_COLUMNS})


def read_friends(spark: SparkSession, path: str) -> DataFrame:
    friends = spark.read.schema(FRIEND).parquet(path)
    return friends.withColumn("timestamp", F.col("timestamp").cast("bigint"))


def lookup(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``keys`` (a frame with the same column)."""
    return df.join(keys.select(key), key, "left_semi")


def explode_set(df: DataFrame, set_col: str, value_col: str, key: str = "username") -> DataFrame:
    """One row per (key, element) of a set column, without the empty marker."""
    values: Column = F.explode(as_set(F.col(set_col)))
    return df.select(key, values.alias(value_col)).distinct()
