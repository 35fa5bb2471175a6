"""Walls, home pages, status feeds and comment threads.

A feed's rows carry ``position``, the place in the reader's order from 1. Positions are
counted over range parts of (reader, time, id), so a reader with very many rows is no one
task's; a poster with very many rows is salted before the rows fan out to readers.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rookery.operators.ordered import positions
from rookery.operators.salting import ROWS_PER_SALT, fan_out
from rookery.plans.scratch import Scratch

POST = ("posterusername", "postuniqueid", "timestamp", "content", "wallusername", "flipped")
STATUS = ("posterusername", "postuniqueid", "timestamp", "content")


def _friend_pairs(friends: DataFrame) -> DataFrame:
    """The stored friendships, keyed by pair."""
    return friends.select("username1", "username2")


def _placed(feed: DataFrame, reader: Sequence[str], first: Sequence[str | Column]) -> DataFrame:
    """The feed with positions: ordered by ``first``, then by all other columns."""
    scratch = Scratch(feed.sparkSession, "feed")
    stored = scratch.save(feed, "rows")
    rest = [c for c in feed.columns if c not in reader]
    return positions(stored, [*reader, *first, *rest], scratch, "placed", per=reader)


def _newest_first(feed: DataFrame, *reader: str) -> DataFrame:
    return _placed(feed, reader, [F.desc("timestamp"), "postuniqueid"])


def home_feed(wallposts: DataFrame, friends: DataFrame, limit: int = ROWS_PER_SALT) -> DataFrame:
    """Friends' posts on their own walls, and the reader's rows about friends' walls."""
    pairs = _friend_pairs(friends)
    posts = wallposts.select(*POST)
    readers = pairs.select(F.col("username1").alias("username"), F.col("username2").alias("posterusername"))
    on_own_wall = posts.where("wallusername = posterusername")
    by_friends = fan_out(on_own_wall, readers, "posterusername", ["postuniqueid"], limit).select("username", *POST)
    elsewhere = posts.where("wallusername <> posterusername")
    toward_friends = elsewhere.join(
        pairs,
        (elsewhere["posterusername"] == pairs["username1"]) & (elsewhere["wallusername"] == pairs["username2"]),
        "left_semi",
    ).select(F.col("posterusername").alias("username"), *POST)
    return _newest_first(by_friends.unionByName(toward_friends), "username")


def wall_rows(wallposts: DataFrame, friends: DataFrame) -> DataFrame:
    """What a wall shows: the owner's own posts, and friends' posts on it."""
    posts = wallposts.select(*POST)
    own = posts.where("wallusername = posterusername")
    mirrored = posts.where("flipped and wallusername <> posterusername")
    pairs = _friend_pairs(friends)
    from_friends = mirrored.join(
        pairs,
        (mirrored["posterusername"] == pairs["username1"]) & (mirrored["wallusername"] == pairs["username2"]),
        "left_semi",
    )
    return own.unionByName(from_friends)


def visible_walls(visits: DataFrame, friends: DataFrame) -> DataFrame:
    """Visits ``(viewer, owner)`` that may see the wall: one's own, or a friend's."""
    wanted = visits.select("viewer", "owner").distinct()
    pairs = _friend_pairs(friends)
    own = wanted.where("viewer = owner")
    friendly = wanted.where("viewer <> owner").join(
        pairs,
        (F.col("viewer") == pairs["username1"]) & (F.col("owner") == pairs["username2"]),
        "left_semi",
    )
    return own.unionByName(friendly)


def wall_feed(
    wallposts: DataFrame, friends: DataFrame, visits: DataFrame, limit: int = ROWS_PER_SALT
) -> DataFrame:
    """The wall of each allowed visit, newest first; refused visits give no rows."""
    shown = wall_rows(wallposts, friends)
    allowed = visible_walls(visits, friends).withColumn("posterusername", F.col("owner"))
    feed = fan_out(shown, allowed, "posterusername", ["postuniqueid"], limit)
    return _newest_first(feed.select("viewer", "owner", *POST), "viewer", "owner")


def status_feed(statusposts: DataFrame, friends: DataFrame, limit: int = ROWS_PER_SALT) -> DataFrame:
    """Status posts of all friends, oldest first."""
    pairs = _friend_pairs(friends)
    readers = pairs.select(F.col("username1").alias("username"), F.col("username2").alias("posterusername"))
    feed = fan_out(statusposts.select(*STATUS), readers, "posterusername", ["postuniqueid"], limit)
    return _placed(feed.select("username", *STATUS), ["username"], ["timestamp", "postuniqueid"])


def own_status(statusposts: DataFrame) -> DataFrame:
    return _newest_first(statusposts.select(*STATUS), "posterusername")


def comment_threads(posts: DataFrame, comments: DataFrame) -> DataFrame:
    """Comments of the given posts, one per (post, time, commenter), newest first."""
    thread = (
        comments.join(posts.select("postuniqueid").distinct(), "postuniqueid", "left_semi")
        .groupBy("postuniqueid", "timestamp", "usernameofcommentor")
        .agg(F.min("content").alias("content"))
    )
    return _placed(thread, ["postuniqueid"], [F.desc("timestamp"), "usernameofcommentor"])
