"""Article corpus (one JSON object per line) and stop-word list."""

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rookery.functions.scalar import publish_date
from rookery.plans.scratch import Scratch
from rookery.schemas import ARTICLE_RAW


def read_articles(spark: SparkSession, path: str, shift_months: int = 48) -> DataFrame:
    """Scan the corpus with a fixed schema; dates move by ``shift_months``.

    Lines that cannot be used (no JSON, or no link, category or date) stay in the
    frame; ``usable_articles`` and ``rejected_articles`` separate them.
    """
    raw = spark.read.schema(ARTICLE_RAW).json(path)
    return raw.select(
        F.col("authors").alias("author"),
        "category",
        publish_date(F.col("date"), shift_months).alias("date"),
        "headline",
        "link",
        F.col("short_description").alias("description"),
    )


def _usable() -> Column:
    return F.col("link").isNotNull() & F.col("category").isNotNull() & F.col("date").isNotNull()


def usable_articles(articles: DataFrame) -> DataFrame:
    return articles.where(_usable())


def rejected_articles(articles: DataFrame) -> DataFrame:
    return articles.where(~_usable())


def published_by(articles: DataFrame, as_of: date) -> DataFrame:
    return articles.where(F.col("date") <= F.lit(as_of))


def published_on(articles: DataFrame, as_of: date) -> DataFrame:
    return articles.where(F.col("date") == F.lit(as_of))


def one_per_link(articles: DataFrame, columns: Sequence[str], scratch: Scratch) -> DataFrame:
    """(link, columns) of the article that represents each link: the smallest (headline, category).

    Few links have several rows. Only those meet in an aggregate with their texts; all others
    stay where they are. The list of such links is stored, so its size is known to the join.
    """
    articles = articles.where("link is not null")
    counts = articles.groupBy("link").agg(F.count(F.lit(1)).alias("n"))
    repeated = scratch.save(counts.where("n > 1").select("link"), "repeated_links")
    wanted = ["link", *columns]
    single = articles.join(repeated, "link", "left_anti").select(*wanted)
    rest = ["headline", "category", "author", "date", "description"]
    several = articles.join(repeated, "link", "left_semi").groupBy("link").agg(F.min(F.struct(*rest)).alias("a"))
    return single.unionByName(several.select("link", *[F.col(f"a.{c}").alias(c) for c in columns]))


def read_stopwords(spark: SparkSession, path: str) -> DataFrame:
    """One word per line, any line ending."""
    words = spark.read.text(path).select(F.trim("value").alias("word"))
    return words.where(F.col("word") != "").distinct()
