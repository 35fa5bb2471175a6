"""The scheduled refresh: graph, adsorption, scores, recommendations, stored tables."""

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from rookery.operators.adsorption import MAX_ITER, TOLERANCE, run_adsorption
from rookery.operators.graph import social_graph
from rookery.operators.ranking import MIN_WEIGHT, recommend, score_articles, update_seen
from rookery.plans.scratch import Scratch, shuffles_dropped
from rookery.sources.articles import published_by
from rookery.sources.sinks import write_snapshot
from rookery.sources.versions import VersionedTables


@dataclass
class SocialTables:
    """What a refresh reads: sets are (username, element) frames."""

    users: DataFrame
    interests: DataFrame
    likes: DataFrame
    seen: DataFrame
    friends: DataFrame
    articles: DataFrame


@dataclass
class Refresh:
    scores: DataFrame
    recommendations: DataFrame
    seen: DataFrame
    rounds: int
    converged: bool
    scratch: Scratch


def refresh(
    tables: SocialTables,
    as_of: date,
    max_iter: int = MAX_ITER,
    tol: float | None = TOLERANCE,
    min_weight: float = MIN_WEIGHT,
    seed: int = 0,
    source_filter: bool = True,
) -> Refresh:
    """Rank and recommend as of one day.

    ``source_filter=False`` with ``min_weight=0`` is the variant that lets articles
    from after ``as_of`` take part in the propagation.
    """
    articles = published_by(tables.articles, as_of) if source_filter else tables.articles
    edges = social_graph(tables.users, tables.interests, tables.likes, tables.friends, articles)
    run = run_adsorption(edges, tables.users, max_iter, tol)
    # written before anything is stored, since the seen table is read here and replaced then
    scratch = Scratch(edges.sparkSession, "refresh")
    scores = scratch.save(score_articles(run.heavier(min_weight, "article"), articles, as_of, min_weight), "scores")
    run.scratch.close()
    recs = scratch.save(recommend(scores, tables.seen, as_of, seed), "recommendations")
    seen = scratch.save(update_seen(tables.seen, recs), "seen")
    return Refresh(scores, recs, seen, run.rounds, run.converged, scratch)


STORED = ("scores", "recommendations", "seen")


def store_refresh(result: Refresh, folder: str) -> None:
    """Replace the score, recommendation and seen tables at once, and drop the run's own copies.

    A new version of all three is written, then published, so a reader never sees scores of
    one refresh with recommendations of another, nor half a table.
    """
    store = VersionedTables(result.scores.sparkSession, folder)
    version, key = store.current() + 1, ["username", "link"]
    for table in STORED:
        with shuffles_dropped(result.scores.sparkSession):
            write_snapshot(getattr(result, table), store.path(table, version), key, cluster_by=key)
    store.publish(version, STORED)
    result.scratch.close()


def read_stored(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A stored table as of the last whole refresh."""
    return VersionedTables(spark, folder).read(table)
