"""From raw documents to packed training sequences: five stages over the whole corpus.

Each stage takes (spark, docs, sf_dir), works on all that the stage before it kept, and
is written as Parquet and read again as the next stage's input. All but the last return
the columns of ``documents``.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rookery.llm.decontaminate import drop_contaminated
from rookery.llm.exact import drop_copies
from rookery.llm.minhash import drop_near_copies
from rookery.llm.packing import pack
from rookery.llm.quality import keep_good
from rookery.plans.scratch import Scratch


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("exact dedup", exact_dedup),
    ("near dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("packing", packing),
]

ORACLE_SQL = None  # the classifier, MinHash and BM25 stages have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = scratch.save(stage(spark, docs, sf_dir), f"stage_{number}")
    return docs
