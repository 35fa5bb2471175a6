"""Written tables that cut the lineage of iterative plans.

Tables go to the folder named by ``spark.checkpoint.dir``, which every executor
can reach, so a lost executor costs a re-read and never a recomputation. A session
without that setting uses a folder below its warehouse, which on a cluster must not be a
local one.
"""

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


# Spark's own setting: the shuffle files of a write go when it ends, not at some garbage collection.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def scratch_root(spark: SparkSession) -> str:
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    master = spark.conf.get("spark.master", "")
    if warehouse.startswith(("file:", "/")) and not master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{warehouse.rstrip('/')}/_scratch"


class Scratch:
    """One run's folder of intermediate tables."""

    def __init__(self, spark: SparkSession, name: str):
        self._spark = spark
        self._folder = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"

    def path(self, label: str) -> str:
        return f"{self._folder}/{label}"

    def save(self, df: DataFrame, label: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
        path = self.path(label)
        with shuffles_dropped(self._spark):
            df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
        return self.read(label, df.schema)

    def read(self, label: str, schema: StructType) -> DataFrame:
        return self._spark.read.schema(schema).parquet(self.path(label))

    def drop(self, label: str) -> None:
        """Remove a table that no later plan reads."""
        self._delete(self.path(label))

    def close(self) -> None:
        """Remove the whole folder; frames read from it end here."""
        self._delete(self._folder)

    def _delete(self, folder: str) -> None:
        self._spark.range(0, 0, 1, 1).write.mode("overwrite").parquet(folder)
