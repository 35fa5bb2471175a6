"""Streams of actions whose outcome depends on earlier ones, with state keyed by user.

Each rule keeps one small value per key in Spark's state store: a set of interests, that a
name is taken, the last affiliation. The rows of a key that arrive together are decided in
the order of their logs (timestamp, sequence); what arrives in a later micro-batch is
decided later, whatever its time. A micro-batch is the most a key can bring at once, so the
source's limits (``maxFilesPerTrigger``, ``maxBytesPerTrigger``) bound what one task holds.
"""

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StringType, StructType

from rookery.operators.changelog import (
    NAME_TAKEN,
    VALID_CATEGORIES,
    affiliation_posts,
    decide_interest,
    held_interests,
    with_refusal,
)

Frames = Iterator[pd.DataFrame]
Rule = Callable[[tuple, Frames, GroupState], Frames]


def _stateful(rows: DataFrame, key: str, rule: Rule, output: str | StructType, state: str) -> DataFrame:
    return rows.groupBy(key).applyInPandasWithState(rule, output, state, "append", GroupStateTimeout.NoTimeout)


def _in_order(frames: Frames) -> pd.DataFrame:
    return pd.concat(list(frames)).sort_values(["timestamp", "seq"], kind="stable")


def stream_interest_changes(
    changes: DataFrame, interests: DataFrame, users: DataFrame, allowed: Sequence[str] = VALID_CATEGORIES
) -> DataFrame:
    """The outcome of every arriving interest change, as in ``apply_interest_changes``.

    ``interests`` and ``users`` are the stored tables: a user's set is read from them at the
    first change and kept as state from then on.
    """
    allowed_set = frozenset(allowed)

    def fold(key: tuple, frames: Frames, state: GroupState) -> Frames:
        rows = _in_order(frames)
        if state.exists:
            held = list(state.get[0])
        else:
            held = rows["held"].iloc[0]
        exists = held is not None
        current = set(held) if exists else set()
        decided = [
            decide_interest(current, exists, action, category, allowed_set)
            for action, category in zip(rows["action"], rows["category"], strict=True)
        ]
        if exists:
            state.update((sorted(current),))
        columns = ["username", "timestamp", "seq", "action", "category"]
        yield rows[columns].assign(outcome=decided)

    known = held_interests(interests, users)
    arriving = changes.select("username", "timestamp", "seq", "action", F.upper("category").alias("category"))
    output = "username string, timestamp bigint, seq bigint, action string, category string, outcome string"
    return _stateful(arriving.join(known, "username", "left"), "username", fold, output, "held array<string>")


def stream_signups(signups: DataFrame, users: DataFrame, allowed: Sequence[str] = VALID_CATEGORIES) -> DataFrame:
    """Arriving signups with ``reason``, as in ``validate_signups``.

    A name belongs to its stored account, else to the first otherwise valid signup: the
    earliest micro-batch, then the smallest ``seq``. Signups that fail by themselves need no
    state and skip the shuffle by name, blank names among them. Of a contested name one
    candidate is held at a time.
    """
    columns = signups.columns

    def first_wins(key: tuple, frames: Frames, state: GroupState) -> Frames:
        taken, best = state.exists, None
        for frame in frames:
            taken = taken or bool(frame["_taken"].iloc[0])
            rows = frame[columns]
            if not taken:
                rows = rows if best is None else pd.concat([best, rows])
                first = rows["seq"] == rows["seq"].min()
                best, rows = rows[first], rows[~first]
            yield rows.assign(reason=NAME_TAKEN)
        if best is not None:
            yield best.assign(reason=None)
            state.update((True,))

    checked = with_refusal(signups, allowed)
    refused = checked.where("_failed is not null").withColumnRenamed("_failed", "reason")
    owned = users.select("username").distinct().withColumn("_owned", F.lit(True))
    valid = checked.where("_failed is null").drop("_failed").join(owned, "username", "left")
    valid = valid.select(*columns, F.coalesce("_owned", F.lit(False)).alias("_taken"))
    output = StructType(list(signups.schema.fields)).add("reason", StringType())
    decided = _stateful(valid, "username", first_wins, output, "taken boolean")
    return refused.unionByName(decided)


def stream_affiliations(log: DataFrame, users: DataFrame) -> DataFrame:
    """A status post for every arriving affiliation that differs from the user's last one."""

    def changed(key: tuple, frames: Frames, state: GroupState) -> Frames:
        rows = _in_order(frames)
        last = state.get[0] if state.exists else None
        differs = []
        for affiliation, initial in zip(rows["affiliation"], rows["initial"], strict=True):
            differs.append((initial if last is None else last) != affiliation)
            last = affiliation
        state.update((last,))
        yield rows.loc[differs, ["username", "affiliation", "timestamp"]]

    first = users.select("username", F.col("affiliation").alias("initial"))
    arriving = log.select("username", "affiliation", "timestamp", "seq").join(first, "username")
    output = "username string, affiliation string, timestamp bigint"
    return affiliation_posts(_stateful(arriving, "username", changed, output, "last string"))
