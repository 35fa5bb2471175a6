"""Rooms, members and message histories."""

from pyspark.sql import DataFrame, functions as F

from rookery.functions.scalar import conversation_key, member_key
from rookery.operators.ordered import positions
from rookery.plans.scratch import Scratch


def _members(membership: DataFrame) -> DataFrame:
    return membership.select("roomuniqueid", "member").distinct()


def participants(membership: DataFrame) -> DataFrame:
    """The members of each room, in order."""
    return _members(membership).orderBy("roomuniqueid", "member")


def rooms_by_user(membership: DataFrame, users: DataFrame | None = None) -> DataFrame:
    """The rooms of each user with their number of members."""
    members = _members(membership)
    sizes = members.groupBy("roomuniqueid").agg(F.count("*").alias("n_members"))
    mine = members.withColumnRenamed("member", "username")
    if users is not None:
        mine = mine.join(users.select("username"), "username", "left_semi")
    return mine.join(sizes, "roomuniqueid").select("username", "roomuniqueid", "n_members")


def room_rosters(membership: DataFrame, users: DataFrame) -> DataFrame:
    """All members of the rooms that contain any of ``users``.

    Each room is listed once, however many of the users are in it.
    """
    members = _members(membership)
    theirs = members.join(users.select(F.col("username").alias("member")), "member", "left_semi")
    return members.join(theirs.select("roomuniqueid").distinct(), "roomuniqueid", "left_semi")


def find_room(membership: DataFrame, groups: DataFrame) -> DataFrame:
    """For each ``(group_id, members)`` the lowest room with exactly these members, or null.

    Member lists are built only for rooms as large as some requested group.
    """
    asked = groups.select("group_id", F.array_distinct("members").alias("members"))
    members = _members(membership)
    sizes = members.groupBy("roomuniqueid").agg(F.count("*").alias("n"))
    wanted_sizes = asked.select(F.size("members").cast("bigint").alias("n")).distinct()
    candidates = sizes.join(wanted_sizes, "n", "left_semi")
    keyed = (
        members.join(candidates, "roomuniqueid", "left_semi")
        .groupBy("roomuniqueid")
        .agg(member_key(F.collect_list("member")).alias("key"))
        .groupBy("key")
        .agg(F.min("roomuniqueid").alias("roomuniqueid"))
    )
    return (
        asked.withColumn("key", member_key(F.col("members")))
        .join(keyed, "key", "left")
        .select("group_id", F.col("key").alias("member_key"), "roomuniqueid")
    )


def _history(messages: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Messages with their ``position`` in their group, from 1; a busy group spreads over range parts."""
    return positions(messages, [group, *order], Scratch(messages.sparkSession, "history"), "placed", per=[group])


def chat_history(messages: DataFrame) -> DataFrame:
    """Messages of each room in time order, as rows."""
    rows = messages.select("roomuniqueid", "timestamp", "sender", "content")
    return _history(rows, "roomuniqueid", ["timestamp", "sender", "content"])


def direct_history(messages: DataFrame) -> DataFrame:
    """Direct messages under the key of their two participants, in time order."""
    key = conversation_key(F.col("fromuser"), F.col("touser"))
    rows = messages.select(key.alias("conversation"), "timestamp", "fromuser", "touser", "message")
    return _history(rows, "conversation", ["timestamp", "fromuser", "message"])


def invitable_users(friends: DataFrame, membership: DataFrame) -> DataFrame:
    """For each member of each room: friends who are not in that room."""
    members = _members(membership)
    pairs = friends.select(
        F.col("username1").alias("username"), F.col("username2").alias("friend")
    ).distinct()
    invited = members.withColumnRenamed("member", "username").join(pairs, "username")
    inside = members.withColumnRenamed("member", "friend")
    return invited.join(inside, ["roomuniqueid", "friend"], "left_anti").select(
        "roomuniqueid", "username", "friend"
    )


def message_deliveries(messages: DataFrame, membership: DataFrame) -> DataFrame:
    """Each message once for every other member of its room."""
    return (
        messages.join(_members(membership), "roomuniqueid")
        .where("member <> sender")
        .select("roomuniqueid", "timestamp", "sender", F.col("member").alias("receiver"), "content")
    )
