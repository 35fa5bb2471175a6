import random

import pytest
from pyspark.sql import functions as F

from rookery.functions.scalar import display_time
from rookery.operators import changelog


def test_friend_log(spark, rows):
    log = spark.createDataFrame(
        [("a", "b", "add", 1, 0), ("b", "a", "remove", 2, 0), ("a", "c", "add", 3, 0), ("a", "b", "add", 2, 1)],
        "username1 string, username2 string, action string, timestamp bigint, seq bigint",
    )
    assert rows(changelog.current_friends(log)) == [("a", 2, "b"), ("a", 3, "c"), ("b", 2, "a"), ("c", 3, "a")]


def test_mirrored_posts(spark, rows):
    posts = spark.createDataFrame(
        [("a", "1-a", 1, "x", "b"), ("a", "2-a", 2, "y", "a")],
        "posterusername string, postuniqueid string, timestamp bigint, content string, wallusername string",
    )
    got = rows(changelog.mirror_wallposts(posts), "posterusername", "postuniqueid", "wallusername", "flipped")
    assert got == [("a", "1-a", "b", False), ("a", "2-a", "a", True), ("b", "1-a", "a", True)]


def test_sets_and_links(spark, rows):
    log = spark.createDataFrame(
        [("u", " l1\n", "add", 1, 0), ("u", "l1", "delete", 2, 0), ("u", "l 2", "add", 1, 0)],
        "username string, element string, action string, timestamp bigint, seq bigint",
    )
    assert rows(changelog.current_likes(log)) == [("u", "l2")]


def fold(current, log, allowed):
    """The interest rules, one user at a time."""
    outcomes = []
    for action, category in log:
        if action == "add":
            if category in current:
                outcomes.append("already_interested")
            elif category not in allowed:
                outcomes.append("invalid_category")
            else:
                current.add(category)
                outcomes.append("accepted")
        elif len(current) < 3:
            outcomes.append("too_few")
        elif category in current:
            current.remove(category)
            outcomes.append("accepted")
        else:
            outcomes.append("not_interested")
    return outcomes


@pytest.mark.parametrize("chunks", [1, 4, 50])
def test_interest_rules_equal_a_plain_fold(spark, chunks):
    rng = random.Random(7)
    allowed = ["A", "B", "C", "D"]
    start = {u: {c for c in allowed if rng.random() < 0.5} for u in ("u", "v", "w")}
    log = [
        (rng.choice(["u", "v", "w", "ghost"]), rng.choice(["add", "delete"]), rng.choice(["a", "b", "C", "d", "zzz"]), t, t)
        for t in range(150)
    ]
    got = changelog.apply_interest_changes(
        spark.createDataFrame([(u, c) for u, s in start.items() for c in s], "username string, category string"),
        spark.createDataFrame(log, "username string, action string, category string, timestamp bigint, seq bigint"),
        spark.createDataFrame([(u,) for u in start], "username string"),
        allowed,
        chunks,
    ).collect()
    assert len(got) == len(log)
    by_user = {}
    for r in sorted(got, key=lambda r: r.seq):
        by_user.setdefault(r.username, []).append(r.outcome)
    assert set(by_user.pop("ghost")) == {"unknown_user"}
    for user, outcomes in by_user.items():
        asked = [(a, c.upper()) for u, a, c, _, _ in log if u == user]
        assert outcomes == fold(start[user], asked, allowed)


def test_interest_posts(spark, rows):
    outcomes = spark.createDataFrame(
        [("u", 5, 0, "add", "ARTS", "accepted"), ("u", 6, 0, "delete", "TECH", "accepted"), ("u", 7, 0, "add", "X", "invalid_category")],
        "username string, timestamp bigint, seq bigint, action string, category string, outcome string",
    )
    assert rows(changelog.interest_status_posts(outcomes), "postuniqueid", "content") == [
        ("5-u", "Added news interest: ARTS"),
        ("6-u", "Delete news interest: TECH"),
    ]


def test_affiliation_changes_across_chunks(spark):
    rng = random.Random(3)
    log = [("u", rng.choice("xyz"), t, t) for t in range(60)] + [("v", "x", 5, 100), ("ghost", "x", 1, 101)]
    users = spark.createDataFrame([("u", "x"), ("v", "x")], "username string, affiliation string")
    frame = spark.createDataFrame(log, "username string, affiliation string, timestamp bigint, seq bigint")
    got = [(r.posterusername, r.timestamp, r.content) for r in changelog.affiliation_events(frame, users).collect()]
    current, want = "x", []
    for _, value, t, _ in log[:60]:
        if value != current:
            want.append(("u", t, "Changed affiliation to " + value))
        current = value
    assert sorted(got) == sorted(want)


def test_profile_and_presence(spark, rows):
    log = spark.createDataFrame(
        [("u", "email", "e1", 1, 0), ("u", "email", "e2", 1, 1), ("u", "affiliation", "x", 9, 0), ("v", "password", "p", 1, 0)],
        "username string, field string, value string, timestamp bigint, seq bigint",
    )
    assert rows(changelog.current_profile(log)) == [("u", "x", "e2", None), ("v", None, None, "p")]
    logins = spark.createDataFrame([("u", True, 1, 0), ("u", False, 2, 0), ("v", True, 2, 0)], "username string, loggedin boolean, timestamp bigint, seq bigint")
    assert rows(changelog.presence(logins)) == [("u", False), ("v", True)]


def test_signups(spark, rows):
    good = dict(username="new", password="p", firstname="aNN", lastname="lEE", email="e", affiliation="x", birthday="d", newsinterest1="arts", newsinterest2="Tech")
    cases = [
        (dict(newsinterest1="nope", username=""), "invalidnewsinterest1"),
        (dict(newsinterest2="nope"), "invalidnewsinterest2"),
        (dict(newsinterest2="ARTS"), "bothnewsinterestsaresame"),
        (dict(username="", password=""), "usernameIsBlank"),
        (dict(password=""), "passwordIsBlank"),
        (dict(firstname=""), "firstnameIsBlank"),
        (dict(lastname=""), "lastnameIsBlank"),
        (dict(email=""), "emailaddressIsBlank"),
        (dict(affiliation=""), "affiliationIsBlank"),
        (dict(birthday=""), "birthdayIsBlank"),
        (dict(username="old"), "usernameAlreadyTaken"),
        (dict(), None),
        (dict(), "usernameAlreadyTaken"),
        (dict(username="other", email=None), "emailaddressIsBlank"),
    ]
    names = [*good, "seq"]
    frame = spark.createDataFrame(
        [tuple({**good, **change, "seq": i}[n] for n in names) for i, (change, _) in enumerate(cases)],
        ", ".join(f"{n} {'bigint' if n == 'seq' else 'string'}" for n in names),
    )
    users = spark.createDataFrame([("old",)], "username string")
    checked = changelog.validate_signups(frame, users)
    assert rows(checked, "seq", "reason") == sorted([(i, reason) for i, (_, reason) in enumerate(cases)], key=str)
    accounts = changelog.new_accounts(checked)
    (account,) = accounts.collect()
    assert (account.firstname, account.lastname, account.interests) == ("Ann", "Lee", ["ARTS", "TECH"])
    assert account.password == "148de9c5a7a44d19e56cd9ae1a554bf67847afb0c58f6e12fa29ac7ddfca9940"
    assert account.likednewsarticles == [] and account.loggedin
    assert rows(changelog.search_rows(accounts)) == [("Ann Lee", "new")]


def test_membership_messages_and_whitelist(spark, rows):
    log = spark.createDataFrame(
        [(1, "a", "join", 1, 0), (1, "a", "leave", 2, 0), (1, "b", "join", 1, 0)],
        "roomuniqueid bigint, member string, action string, timestamp bigint, seq bigint",
    )
    assert rows(changelog.current_membership(log)) == [(1, "b")]
    messages = spark.createDataFrame(
        [(1, 5, 0, "a", "old"), (1, 5, 1, "b", "new")], "roomuniqueid bigint, timestamp bigint, seq bigint, sender string, content string"
    )
    assert rows(changelog.latest_messages(messages)) == [(1, 5, "b", "new")]
    picks = spark.createDataFrame([("ARTS",), ("arts",), (None,)], "c string")
    assert rows(changelog.in_whitelist(picks, "c")) == [("ARTS",)]
    assert changelog.not_in_whitelist(picks, "c").count() == 2


def test_page_times(spark):
    shown = spark.range(1).select(display_time(F.lit(1705294805000)).alias("t")).first().t
    assert shown == "1/15/2024, 12:00:05 AM"
