"""Streams that carry state between micro-batches, against the batch operators."""

import os
import random

import pytest
from pyspark.sql import functions as F

from rookery.operators import changelog
from rookery.operators.ordered import positions, range_parts, running_total
from rookery.plans.scratch import Scratch
from rookery.streaming import rules, tables as streams

ALLOWED = ["A", "B", "C", "D"]
ACTIONS = "username string, action string, category string, timestamp bigint, seq bigint"
SIGNUPS = (
    "username string, password string, firstname string, lastname string, email string, affiliation string, "
    "birthday string, newsinterest1 string, newsinterest2 string, seq bigint"
)


@pytest.fixture
def arriving(spark, tmp_path):
    """A stream that brings each list of rows as one micro-batch."""

    def make(batches, schema):
        folder = str(tmp_path / f"in-{len(os.listdir(tmp_path))}")
        os.makedirs(folder)
        for k, rows in enumerate(batches):
            table = spark.createDataFrame(rows, schema)
            path = f"{folder}/part-{k:03}.parquet"
            table.toPandas().to_parquet(path, index=False)
            os.utime(path, (1e9 + k, 1e9 + k))  # files arrive in the order of their times
        return streams.file_stream(spark, folder, table.schema, files_per_trigger=1)

    return make


def test_interest_stream_equals_batch(spark, arriving):
    rng = random.Random(11)
    start = [(u, c) for u in ("u", "v", "w") for c in ALLOWED if rng.random() < 0.5]
    users = spark.createDataFrame([("u",), ("v",), ("w",), ("bare",)], "username string")
    interests = spark.createDataFrame(start, "username string, category string")
    log = [
        (rng.choice(["u", "v", "w", "bare", "ghost"]), rng.choice(["add", "delete"]), rng.choice(["a", "b", "C", "d", "zzz"]), t, t)
        for t in range(160)
    ]
    batches = [log[:50], log[50:90], log[90:]]
    for part in batches:
        rng.shuffle(part)
    stream = rules.stream_interest_changes(arriving(batches, ACTIONS), interests, users, ALLOWED)
    got = sorted(map(tuple, streams.run_appends(stream).collect()))
    batch = changelog.apply_interest_changes(interests, spark.createDataFrame(log, ACTIONS), users, ALLOWED)
    assert got == sorted(map(tuple, batch.collect()))
    assert {r[-1] for r in got} >= {"unknown_user", "accepted", "too_few"}


def signup(name, seq, interest="A"):
    return (name, "p", "f", "l", "e", "a", "1/1/1990", interest, "B", seq)


def test_a_name_belongs_to_the_first_batch(spark, arriving):
    users = spark.createDataFrame([("old",)], "username string")
    batches = [
        [signup("x", 5), signup("x", 3), signup("y", 4, "no"), signup("", 1), signup("old", 2), signup("x", 9)],
        [signup("x", 1), signup("y", 6), signup("y", 7), signup("old", 8), signup("", 10), signup("", 11)],
        [signup("y", 2), signup("z", 12)],
    ]
    decided = streams.run_appends(rules.stream_signups(arriving(batches, SIGNUPS), users, ALLOWED))
    got = {r.seq: r.reason for r in decided.collect()}
    taken, blank = "usernameAlreadyTaken", "usernameIsBlank"
    # seq 1 comes twice: a blank name in the first batch, a taken one in the second
    rows = sorted(((r.username, r.seq, r.reason) for r in decided.collect()), key=str)
    assert rows == sorted(
        [
            ("x", 3, None), ("x", 5, taken), ("x", 9, taken), ("x", 1, taken), ("y", 4, "invalidnewsinterest1"),
            ("y", 6, None), ("y", 7, taken), ("y", 2, taken), ("", 1, blank), ("", 10, blank), ("", 11, blank),
            ("old", 2, taken), ("old", 8, taken), ("z", 12, None),
        ],
        key=str,
    )
    assert got[12] is None


def test_signup_stream_equals_batch(spark, arriving):
    rng = random.Random(5)
    rows = [signup(rng.choice(["a", "b", "c", "d", "e", ""]), k, rng.choice(["A", "C", "no", "B"])) for k in range(60)]
    users = spark.createDataFrame([("e",)], "username string")
    stream = rules.stream_signups(arriving([rows[:20], rows[20:]], SIGNUPS), users, ALLOWED)
    got = {(r.seq, r.username, r.reason) for r in streams.run_appends(stream).collect()}
    batch = changelog.validate_signups(spark.createDataFrame(rows, SIGNUPS), users, ALLOWED)
    assert got == {(r.seq, r.username, r.reason) for r in batch.collect()}


LOG = "username string, affiliation string, timestamp bigint, seq bigint"


def affiliation_log(n, seed):
    """All rows of one day; one user has most of them."""
    rng = random.Random(seed)
    names = ["hot"] * 6 + ["u", "v", "ghost"]
    return [(rng.choice(names), rng.choice(["x", "y", "z", None]), 1000 + t // 3, t) for t in range(n)]


def plain_affiliations(log, first):
    last, posts = {}, []
    for name, affiliation, ts, _ in sorted(log, key=lambda r: r[2:]):
        if name not in first:
            continue
        before = last.get(name)
        if (first[name] if before is None else before) != affiliation:
            posts.append((name, f"{ts}-{name}", ts, None if affiliation is None else "Changed affiliation to " + affiliation))
        last[name] = affiliation
    return sorted(posts, key=str)


def test_affiliations_in_batch_and_stream(spark, arriving, rows):
    first = {"hot": "x", "u": "y", "v": "z"}
    users = spark.createDataFrame(list(first.items()), "username string, affiliation string")
    log = affiliation_log(300, 3)
    want = plain_affiliations(log, first)
    assert rows(changelog.affiliation_events(spark.createDataFrame(log, LOG), users)) == want
    stream = rules.stream_affiliations(arriving([log[:100], log[100:101], log[101:]], LOG), users)
    assert rows(streams.run_appends(stream)) == want


def test_a_busy_day_spreads_over_parts(spark):
    log = spark.createDataFrame(affiliation_log(4000, 4), LOG)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        parts = range_parts(log, ["username", "timestamp", "seq"], Scratch(spark, "t"), "parts")
        sizes = [r["count"] for r in parts.where("username = 'hot'").groupBy("part").count().collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) >= 5 and max(sizes) < 1000


def test_positions_restart_per_value(spark):
    rng = random.Random(6)
    data = [(rng.choice(["a", "a", "a", "b", None]), rng.randint(0, 40), k) for k in range(500)]
    frame = spark.createDataFrame(data, "reader string, t int, id int")
    scratch = Scratch(spark, "t")
    got = positions(frame, ["reader", F.desc("t"), "id"], scratch, "per", per=["reader"]).collect()
    want = {}
    for reader in ("a", "b", None):
        mine = sorted((r for r in data if r[0] == reader), key=lambda r: (-r[1], r[2]))
        want.update({r[2]: k for k, r in enumerate(mine, 1)})
    assert {r.id: r.position for r in got} == want and len(got) == len(data)
    total = positions(frame, ["id"], scratch, "all").collect()
    assert all(r.position == r.id + 1 for r in total)


def test_profile_and_membership_streams(spark, arriving, rows):
    log = [("u", "email", "a", 1, 0), ("u", "email", "b", 2, 0), ("v", "affiliation", "q", 1, 1), ("u", "password", "s", 3, 0)]
    schema = "username string, field string, value string, timestamp bigint, seq bigint"
    profile = streams.run_upserts(streams.stream_profile(arriving([log[1:2], log[:1], log[2:]], schema)), ["username"])
    assert rows(profile) == rows(changelog.current_profile(spark.createDataFrame(log, schema)))
    joined = [(1, "u", "join", 1, 0), (1, "u", "leave", 2, 0), (1, "v", "join", 1, 1), (2, "u", "join", 1, 2)]
    schema = "roomuniqueid bigint, member string, action string, timestamp bigint, seq bigint"
    last = streams.run_upserts(streams.stream_membership(arriving([joined[:2], joined[2:]], schema)), ["roomuniqueid", "member"])
    assert rows(last.where("action = 'join'"), "roomuniqueid", "member") == [(1, "v"), (2, "u")]


def test_running_totals(spark):
    rng = random.Random(12)
    data = [(rng.choice(["a", "b", None]), k, rng.randint(0, 9)) for k in range(300)]
    rng.shuffle(data)
    frame = spark.createDataFrame(data, "key string, t int, v int")
    parts = range_parts(frame, ["key", "t"], Scratch(spark, "t"), "totals")
    got = {r.t: r.total for r in running_total(parts, ["key", "t"], F.col("v"), "total", per=["key"]).collect()}
    sums, want = {}, {}
    for key, t, v in sorted(data, key=lambda r: r[1]):
        want[t] = sums[key] = sums.get(key, 0) + v
    assert got == want
