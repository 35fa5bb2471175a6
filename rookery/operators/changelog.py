"""Current state from logs of user actions, and the rules actions must pass.

Logs carry ``timestamp`` (epoch ms) and ``seq``, which orders actions of the same
millisecond. Current state is a grouped maximum per key, so it combines map-side.
"""

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from rookery.functions.scalar import (
    capitalize_name,
    clean_link,
    full_name,
    post_id,
    sha256_hex,
)
from rookery.operators.ordered import latest, previous_value, range_parts
from rookery.plans.scratch import Scratch

# The categories an account may declare.
VALID_CATEGORIES = (
    "ARTS", "ARTS & CULTURE", "BLACK VOICES", "BUSINESS", "COLLEGE", "COMEDY", "CRIME",
    "CULTURE & ARTS", "DIVORCE", "EDUCATION", "ENTERTAINMENT", "ENVIRONMENT", "FIFTY",
    "FOOD & DRINK", "GOOD NEWS", "GREEN", "HEALTHY LIVING", "HOME & LIVING", "IMPACT",
    "LATINO VOICES", "MEDIA", "MONEY", "PARENTING", "PARENTS", "POLITICS", "QUEER VOICES",
    "RELIGION", "SCIENCE", "SPORTS", "STYLE", "STYLE & BEAUTY", "TASTE", "TECH",
    "THE WORLDPOST", "TRAVEL", "WEDDINGS", "WEIRD NEWS", "WELLNESS", "WOMEN", "WORLD NEWS",
    "WORLDPOST",
)

# Reasons a signup is refused, in the order they are checked.
INVALID_INTEREST_1 = "invalidnewsinterest1"
INVALID_INTEREST_2 = "invalidnewsinterest2"
SAME_INTERESTS = "bothnewsinterestsaresame"
BLANK_REASONS = {
    "username": "usernameIsBlank",
    "password": "passwordIsBlank",
    "firstname": "firstnameIsBlank",
    "lastname": "lastnameIsBlank",
    "email": "emailaddressIsBlank",
    "affiliation": "affiliationIsBlank",
    "birthday": "birthdayIsBlank",
}
NAME_TAKEN = "usernameAlreadyTaken"

# Texts of the status posts that profile changes produce.
AFFILIATION_POST = "Changed affiliation to "
INTEREST_ADDED_POST = "Added news interest: "
INTEREST_DELETED_POST = "Delete news interest: "

# Fixed value: an interest may be deleted only from a set of at least this size.
MIN_INTERESTS_TO_DELETE = 3


def current_friends(log: DataFrame) -> DataFrame:
    """Both directions of every friendship whose last action is ``add``."""
    both = F.explode(
        F.array(
            F.struct(F.col("username1").alias("a"), F.col("username2").alias("b")),
            F.struct(F.col("username2").alias("a"), F.col("username1").alias("b")),
        )
    )
    last = (
        log.select(both.alias("p"), "action", "timestamp", "seq")
        .groupBy(F.col("p.a").alias("username1"), F.col("p.b").alias("username2"))
        .agg(latest(F.struct("action", "timestamp"), "timestamp", "seq").alias("last"))
    )
    return last.where("last.action = 'add'").select(
        "username1", F.col("last.timestamp").alias("timestamp"), "username2"
    )


def mirror_wallposts(posts: DataFrame) -> DataFrame:
    """Each post under its poster, and swapped under the wall's owner with ``flipped``.

    A post on one's own wall has equal keys both times; the flipped row replaces it.
    """
    rest = ("postuniqueid", "timestamp", "content")

    def row(poster: str, wall: str, flipped: bool) -> Column:
        return F.struct(
            F.col(poster).alias("posterusername"), F.col(wall).alias("wallusername"), F.lit(flipped).alias("flipped")
        )

    plain = row("posterusername", "wallusername", False)
    swapped = row("wallusername", "posterusername", True)
    rows = F.when(F.col("posterusername") == F.col("wallusername"), F.array(swapped)).otherwise(
        F.array(plain, swapped)
    )
    return posts.select(F.explode(rows).alias("r"), *rest).select(
        "r.posterusername", *rest, "r.wallusername", "r.flipped"
    )


def current_sets(log: DataFrame) -> DataFrame:
    """(username, element) whose last action is ``add``."""
    last = log.groupBy("username", "element").agg(latest("action", "timestamp", "seq").alias("action"))
    return last.where("action = 'add'").select("username", "element")


def current_likes(log: DataFrame) -> DataFrame:
    """Liked links from the click log; white space in a link is removed first."""
    cleaned = log.withColumn("element", clean_link(F.col("element")))
    return current_sets(cleaned).withColumnRenamed("element", "link")


def in_whitelist(df: DataFrame, column: str, allowed: Sequence[str] = VALID_CATEGORIES) -> DataFrame:
    return df.where(F.col(column).isin(*allowed))


def not_in_whitelist(df: DataFrame, column: str, allowed: Sequence[str] = VALID_CATEGORIES) -> DataFrame:
    return df.where(~F.coalesce(F.col(column).isin(*allowed), F.lit(False)))


def decide_interest(current: set[str], exists: bool, action: str, category: str, allowed: frozenset[str]) -> str:
    """The outcome of one interest change; an accepted one changes the set of ``current`` interests."""
    if not exists:
        return "unknown_user"
    if action == "add":
        if category in current:
            return "already_interested"
        if category not in allowed:
            return "invalid_category"
        current.add(category)
    else:
        if len(current) < MIN_INTERESTS_TO_DELETE:
            return "too_few"
        if category not in current:
            return "not_interested"
        current.remove(category)
    return "accepted"


def held_interests(interests: DataFrame, users: DataFrame) -> DataFrame:
    """(username, held): the interests of each user as a sorted array, empty when there are none."""
    held = interests.groupBy("username").agg(F.array_sort(F.collect_set("category")).alias("held"))
    known = F.coalesce(F.filter("held", lambda c: c.isNotNull()), F.array().cast("array<string>"))
    return users.select("username").distinct().join(held, "username", "left").select("username", known.alias("held"))


def _fold_interests(
    batches: Iterator[pd.DataFrame], allowed: frozenset[str], states_only: bool
) -> Iterator[pd.DataFrame]:
    """Reads sorted rows: a start row with the held set, then that key's changes in order.

    Yields the outcome of every change, or with ``states_only`` the set each key ends
    with. One key's set is the only state kept between batches.
    """
    key, exists, current = None, False, set()
    for batch in batches:
        outcomes, ended = [], []
        columns = (batch[c] for c in ("username", "chunk", "held", "action", "category"))
        for name, chunk, held, action, category in zip(*columns):
            if (name, chunk) != key:
                if exists:
                    ended.append((*key, sorted(current)))
                key, exists, current = (name, chunk), False, set()
            if held is not None:
                exists, current, outcome = True, set(held), None
            else:
                outcome = decide_interest(current, exists, action, category, allowed)
            outcomes.append(outcome)
        if states_only:
            yield pd.DataFrame(ended, columns=["username", "chunk", "held"])
        else:
            decided = batch.assign(outcome=outcomes)
            yield decided[decided["outcome"].notna()].drop(columns=["chunk", "stage", "held"])
    if states_only and exists:
        yield pd.DataFrame([(*key, sorted(current))], columns=["username", "chunk", "held"])


def _run_fold(starts: DataFrame, changes: DataFrame, allowed: Sequence[str], states_only: bool) -> DataFrame:
    """``starts(username, chunk, held)`` and ``changes`` with a chunk, folded per chunk."""
    first = starts.withColumn("stage", F.lit(0))
    rest = changes.withColumn("stage", F.lit(1))
    ordered = (
        first.unionByName(rest, allowMissingColumns=True)
        .select("username", "chunk", "stage", "timestamp", "seq", "action", "category", "held")
        .repartition("username", "chunk")
        .sortWithinPartitions("username", "chunk", "stage", "timestamp", "seq")
    )
    schema = (
        "username string, chunk bigint, held array<string>"
        if states_only
        else "username string, timestamp bigint, seq bigint, action string, category string, outcome string"
    )
    allowed_set = frozenset(allowed)
    return ordered.mapInPandas(lambda it: _fold_interests(it, allowed_set, states_only), schema)


def apply_interest_changes(
    interests: DataFrame,
    log: DataFrame,
    users: DataFrame,
    allowed: Sequence[str] = VALID_CATEGORIES,
    chunks: int | None = None,
) -> DataFrame:
    """The outcome of every logged interest change.

    An ``add`` must be new and allowed; a ``delete`` needs at least three current
    interests and the category among them. Outcomes depend on all earlier ones of the
    user, so each log is read in order, streaming through a task batch by batch.

    The whole log is cut into ranges of equal row counts by (user, time, sequence), as many
    as ``chunks`` or the session say; so a user's burst is cut as finely as its rows ask.
    Pieces run side by side. Each first starts from the user's stored set; then every
    piece whose start differs from the end of the one before runs again, until none
    does. That end is exact: the first piece starts right, and so then does the next. Only
    users with several pieces take part in these turns.
    """
    scratch = Scratch(log.sparkSession, "interests")
    base = scratch.save(held_interests(interests, users), "base")
    order = ("username", "timestamp", "seq")
    changes = log.select("username", "timestamp", "seq", "action", F.upper("category").alias("category"))
    dealt = changes.repartitionByRange(*order) if chunks is None else changes.repartitionByRange(chunks, *order)
    chunked = scratch.save(dealt.withColumn("chunk", F.spark_partition_id().cast("bigint")), "changes")
    keys = ["username", "chunk"]
    by_user = Window.partitionBy("username")  # as many rows as a user has pieces
    pieces = chunked.select(*keys).distinct().withColumns(
        {"previous": F.lag("chunk").over(by_user.orderBy("chunk")), "last": F.max("chunk").over(by_user)}
    )
    pieces = scratch.save(pieces, "pieces")
    several = pieces.where("previous is not null or chunk <> last")
    starts = scratch.save(several.select(*keys).join(base, "username"), "starts_0")
    unfinished = several.where("chunk <> last").select(*keys)

    def fold_ends(starting: DataFrame) -> DataFrame:
        open_starts = starting.join(unfinished, keys, "left_semi")
        return _run_fold(open_starts, chunked.join(open_starts.select(*keys), keys, "left_semi"), allowed, True)

    ends = scratch.save(fold_ends(starts), "ends_0")
    follow = several.where("previous is not null").select(*keys, "previous")
    turn = 0
    while True:
        turn += 1
        carried = ends.select("username", F.col("chunk").alias("previous"), F.col("held").alias("carried"))
        due = starts.join(follow, keys).join(carried, ["username", "previous"]).where("carried <> held")
        due = scratch.save(due.select(*keys, F.col("carried").alias("held")), f"due_{turn}")
        if due.isEmpty():
            break
        again = fold_ends(due)
        ends = scratch.save(ends.join(due.select(*keys), keys, "left_anti").unionByName(again), f"ends_{turn}")
        starts = scratch.save(starts.join(due.select(*keys), keys, "left_anti").unionByName(due), f"starts_{turn}")
        scratch.drop(f"ends_{turn - 1}")
        scratch.drop(f"starts_{turn - 1}")
    whole = pieces.where("previous is null and chunk = last").select(*keys).join(base, "username")
    return _run_fold(whole.unionByName(starts), chunked, allowed, False)


def interest_status_posts(outcomes: DataFrame) -> DataFrame:
    """The status post of every accepted interest change."""
    text = F.when(F.col("action") == "add", F.lit(INTEREST_ADDED_POST)).otherwise(F.lit(INTEREST_DELETED_POST))
    return outcomes.where("outcome = 'accepted'").select(
        F.col("username").alias("posterusername"),
        post_id(F.col("timestamp"), F.col("username")).alias("postuniqueid"),
        "timestamp",
        F.concat(text, F.col("category")).alias("content"),
    )


def affiliation_events(log: DataFrame, users: DataFrame) -> DataFrame:
    """A status post for every logged affiliation that differs from the one before.

    The first change of a user compares with the account's own affiliation. The log is cut
    into range parts by (user, time, sequence), so a user's busy day spreads over as many
    tasks as its rows ask; one value per user and part passes to the next part.
    """
    changes = log.select("username", "affiliation", "timestamp", "seq")
    scratch = Scratch(log.sparkSession, "affiliations")
    parts = range_parts(changes, ["username", "timestamp", "seq"], scratch, "changes")
    before = previous_value(parts, ["username"], ["timestamp", "seq"], "affiliation", F.col("part"), "before")
    first = users.select("username", F.col("affiliation").alias("initial"))
    changed = before.join(first, "username").where(
        ~F.coalesce("before", "initial").eqNullSafe(F.col("affiliation"))
    )
    return affiliation_posts(changed)


def affiliation_posts(changed: DataFrame) -> DataFrame:
    """The status posts of (username, affiliation, timestamp) rows that changed something."""
    return changed.select(
        F.col("username").alias("posterusername"),
        post_id(F.col("timestamp"), F.col("username")).alias("postuniqueid"),
        "timestamp",
        F.concat(F.lit(AFFILIATION_POST), F.col("affiliation")).alias("content"),
    )


PROFILE_FIELDS = ("affiliation", "email", "password")


def current_profile(log: DataFrame) -> DataFrame:
    """The last value of each profile field per user; null where never set."""

    def last_of(field: str) -> Column:
        here = F.col("field") == field
        order = F.when(here, F.struct("timestamp", "seq"))
        return F.max_by("value", order).alias(field)

    return log.groupBy("username").agg(*[last_of(f) for f in PROFILE_FIELDS])


def presence(log: DataFrame) -> DataFrame:
    """Whether each user is logged in: the last of their logins and logouts."""
    return log.groupBy("username").agg(latest("loggedin", "timestamp", "seq").alias("loggedin"))


def with_refusal(signups: DataFrame, allowed: Sequence[str] = VALID_CATEGORIES) -> DataFrame:
    """Adds ``_failed``: the first failed check that needs nothing but the row itself, or null."""
    interest_1, interest_2 = F.upper("newsinterest1"), F.upper("newsinterest2")
    checks = [
        (~interest_1.isin(*allowed), INVALID_INTEREST_1),
        (~interest_2.isin(*allowed), INVALID_INTEREST_2),
        (interest_1 == interest_2, SAME_INTERESTS),
        *[(F.length(field) == 0, reason) for field, reason in BLANK_REASONS.items()],
    ]
    failed = F.coalesce(*[F.when(F.coalesce(test, F.lit(True)), reason) for test, reason in checks])
    return signups.withColumn("_failed", failed)


def validate_signups(
    signups: DataFrame, users: DataFrame, allowed: Sequence[str] = VALID_CATEGORIES
) -> DataFrame:
    """Signups with ``reason``: the first failed check, null when accepted.

    A username belongs to its existing account, else to the first otherwise valid
    signup by ``seq``.
    """
    checked = with_refusal(signups, allowed)
    owners = (
        users.select("username", F.lit(None).cast("bigint").alias("seq"), F.lit(True).alias("taken"))
        .unionByName(
            checked.where("_failed is null").select(
                "username", F.col("seq").cast("bigint").alias("seq"), F.lit(False).alias("taken")
            )
        )
        .groupBy("username")
        .agg(F.min("seq").alias("_first"), F.max("taken").alias("_taken"))
    )
    lost = F.coalesce("_taken", F.lit(False)) | (F.col("seq") != F.col("_first"))
    reason = F.coalesce("_failed", F.when(lost, NAME_TAKEN))
    return checked.join(owners, "username", "left").withColumn("reason", reason).drop(
        "_failed", "_first", "_taken"
    )


def new_accounts(validated: DataFrame) -> DataFrame:
    """Account rows of the accepted signups; empty sets are empty arrays."""
    nothing = F.array().cast("array<string>")
    return validated.where("reason is null").select(
        "username",
        sha256_hex(F.col("password")).alias("password"),
        capitalize_name(F.col("firstname")).alias("firstname"),
        capitalize_name(F.col("lastname")).alias("lastname"),
        "email",
        "affiliation",
        "birthday",
        F.array(F.upper("newsinterest1"), F.upper("newsinterest2")).alias("interests"),
        F.lit(True).alias("loggedin"),
        nothing.alias("likednewsarticles"),
        nothing.alias("seenarticles"),
    )


def search_rows(accounts: DataFrame) -> DataFrame:
    return accounts.select(full_name(F.col("firstname"), F.col("lastname")).alias("fullname"), "username")


def current_membership(log: DataFrame) -> DataFrame:
    """(room, member) whose last action is ``join``."""
    last = log.groupBy("roomuniqueid", "member").agg(latest("action", "timestamp", "seq").alias("action"))
    return last.where("action = 'join'").select("roomuniqueid", "member")


def latest_messages(messages: DataFrame) -> DataFrame:
    """One message per (room, timestamp): the last one written."""
    last = messages.groupBy("roomuniqueid", "timestamp").agg(
        F.max(F.struct("seq", "sender", "content")).alias("m")
    )
    return last.select("roomuniqueid", "timestamp", "m.sender", "m.content")
