"""Friend lists, presence, profiles, networks and user search."""

from pyspark.sql import DataFrame, Window, functions as F

from rookery.functions.scalar import MILLIS_PER_DAY

# Fixed value: how many suggestions a user search shows.
SUGGESTIONS = 5


def _friend_pairs(friends: DataFrame) -> DataFrame:
    """The stored friendships, keyed by pair."""
    return friends.select(F.col("username1").alias("username"), F.col("username2").alias("friend"))


def online_friends(friends: DataFrame, users: DataFrame) -> DataFrame:
    online = users.where("loggedin").select(F.col("username").alias("friend"))
    return _friend_pairs(friends).join(online, "friend", "left_semi").select("username", "friend")


def friend_status(friends: DataFrame, users: DataFrame) -> DataFrame:
    """Every friend as online or offline; a friend without an account is offline."""
    flags = users.select(F.col("username").alias("friend"), "loggedin")
    status = F.when(F.coalesce("loggedin", F.lit(False)), "online").otherwise("offline")
    return _friend_pairs(friends).join(flags, "friend", "left").select("username", "friend", status.alias("status"))


def recent_friendships(friends: DataFrame, as_of_ms: int, window_ms: int = MILLIS_PER_DAY) -> DataFrame:
    """Friendships younger than the window at ``as_of_ms``."""
    return friends.where(F.lit(as_of_ms) - F.col("timestamp") < window_ms).select(
        F.col("username1").alias("username"), F.col("username2").alias("friend"), "timestamp"
    )


def are_friends(pairs: DataFrame, friends: DataFrame) -> DataFrame:
    """The given (username, friend) pairs that are friendships."""
    return pairs.join(_friend_pairs(friends), ["username", "friend"], "left_semi")


def affiliated_friends(friends: DataFrame, users: DataFrame, visits: DataFrame) -> DataFrame:
    """For each visit (viewer, owner): the owner's friends with the viewer's affiliation."""
    affiliation = users.select("username", "affiliation")
    wanted = visits.select("viewer", "owner").distinct().join(
        affiliation.withColumnRenamed("username", "viewer"), "viewer"
    )
    friends_of = (
        _friend_pairs(friends)
        .withColumnRenamed("username", "owner")
        .join(affiliation.withColumnRenamed("username", "friend"), "friend")
    )
    return wanted.join(friends_of, ["owner", "affiliation"]).select("viewer", "owner", "friend", "affiliation")


def ego_network(friends: DataFrame, users: DataFrame) -> DataFrame:
    """The network around each user as (id, name, child_id, child_name) rows.

    Id and name are the username on both levels; a user without friends has one row
    without a child. One row per child keeps users with very many friends splittable.
    """
    centre = users.select("username")
    pairs = _friend_pairs(friends)
    return (
        centre.join(pairs, "username", "left")
        .select(
            F.col("username").alias("id"),
            F.col("username").alias("name"),
            F.col("friend").alias("child_id"),
            F.col("friend").alias("child_name"),
        )
        .orderBy("id", "child_id")
    )


def user_details(users: DataFrame) -> DataFrame:
    return users.select("username", "firstname", "lastname", "birthday", "affiliation", "interests")


def suggest_users(usersearch: DataFrame, terms: DataFrame, k: int = SUGGESTIONS) -> DataFrame:
    """The first ``k`` users, by username, whose full name contains the term.

    The term's first character is upper-cased and matching respects case. Full names
    are cut into their substrings of the lengths that occur among the terms, so the
    containment test is an equality join on the distinct terms, and each task keeps
    only its best ``k`` rows per term before the shuffle.
    """
    needle = F.concat(F.upper(F.substring("term", 1, 1)), F.substr("term", F.lit(2)))
    asked = terms.select("term", needle.alias("needle")).where(F.length("needle") > 0).distinct()
    needles = asked.select("needle").distinct()
    lengths = needles.agg(F.collect_set(F.length("needle")).alias("lengths")).scalar()

    cut = usersearch.select("username", "fullname", F.explode(lengths).alias("n")).where(
        F.length("fullname") >= F.col("n")
    )
    starts = F.sequence(F.lit(1), F.length("fullname") - F.col("n") + 1)
    pieces = F.array_distinct(F.transform(starts, lambda i: F.substr("fullname", i, F.col("n"))))
    found = cut.select("username", "fullname", F.explode(pieces).alias("needle")).join(
        needles, "needle", "left_semi"
    )
    order = Window.partitionBy("needle").orderBy("username", "fullname")
    best = found.withColumn("position", F.row_number().over(order)).where(F.col("position") <= k)
    return asked.join(best, "needle").select("term", "position", "username", "fullname")
