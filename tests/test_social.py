from rookery.operators import chat, feeds, people, salting

FRIENDS = [("a", 10, "b"), ("b", 10, "a"), ("a", 90, "c"), ("c", 90, "a")]
USERS = [
    ("a", "Ann", "Lee", "1/1/1990", "x", True),
    ("b", "Bob", "Lee", "1/1/1991", "y", False),
    ("c", "Cy", "Anders", "1/1/1992", "x", True),
    ("d", "Dee", "Ray", "1/1/1993", "x", True),
]


def friends(spark):
    return spark.createDataFrame(FRIENDS, "username1 string, timestamp bigint, username2 string")


def users(spark):
    return spark.createDataFrame(
        USERS, "username string, firstname string, lastname string, birthday string, affiliation string, loggedin boolean"
    )


def wallposts(spark):
    """(poster, id, time, text, wall, flipped), mirrored rows included."""
    posts = [
        ("a", "1-a", 1, "a to b", "b", False), ("b", "1-a", 1, "a to b", "a", True),
        ("b", "2-b", 2, "b own", "b", True),
        ("a", "3-a", 3, "a own", "a", True),
        ("b", "4-b", 4, "b to d", "d", False), ("d", "4-b", 4, "b to d", "b", True),
        ("d", "5-d", 5, "d to a", "a", False), ("a", "5-d", 5, "d to a", "d", True),
    ]
    return spark.createDataFrame(
        posts, "posterusername string, postuniqueid string, timestamp bigint, content string, wallusername string, flipped boolean"
    )


def ordered(feed):
    return sorted(feed.collect(), key=lambda r: r.position)


def test_home_feed(spark):
    feed = ordered(feeds.home_feed(wallposts(spark), friends(spark)))
    # b's own post and a's row on b's wall; not a's own post, not b's post to d, not d's
    assert [r.content for r in feed if r.username == "a"] == ["b own", "a to b"]
    assert [r.content for r in feed if r.username == "b"] == ["a own", "a to b"]


def test_wall_feed(spark):
    visits = spark.createDataFrame([("a", "b"), ("d", "b"), ("a", "a"), ("b", "a")], "viewer string, owner string")
    feed = ordered(feeds.wall_feed(wallposts(spark), friends(spark), visits))
    seen = {}
    for r in feed:
        seen.setdefault((r.viewer, r.owner), []).append(r.content)
    # strangers' posts on a wall do not show, nor does a wall to strangers
    assert seen == {("a", "b"): ["b own", "a to b"], ("a", "a"): ["a own"], ("b", "a"): ["a own"]}


def test_status_feeds(spark):
    posts = spark.createDataFrame(
        [("b", "1-b", 1, "one"), ("c", "0-c", 0, "zero"), ("a", "2-a", 2, "mine")],
        "posterusername string, postuniqueid string, timestamp bigint, content string",
    )
    feed = ordered(feeds.status_feed(posts, friends(spark)))
    assert [r.content for r in feed if r.username == "a"] == ["zero", "one"]
    assert [(r.posterusername, r.position) for r in ordered(feeds.own_status(posts))] == [("a", 1), ("b", 1), ("c", 1)]


def test_comment_threads(spark):
    posts = spark.createDataFrame([("p1",), ("p2",)], "postuniqueid string")
    comments = spark.createDataFrame(
        [("u", "p1", 1, "hi"), ("u", "p1", 1, "hi again"), ("v", "p1", 2, "yo"), ("u", "other", 3, "no")],
        "usernameofcommentor string, postuniqueid string, timestamp bigint, content string",
    )
    got = [(r.postuniqueid, r.usernameofcommentor, r.content) for r in ordered(feeds.comment_threads(posts, comments))]
    assert got == [("p1", "v", "yo"), ("p1", "u", "hi")]


def test_people(spark, rows):
    f, u = friends(spark), users(spark)
    assert rows(people.online_friends(f, u)) == [("a", "c"), ("b", "a"), ("c", "a")]
    status = rows(people.friend_status(f, u.where("username <> 'b'")))
    assert status == [("a", "b", "offline"), ("a", "c", "online"), ("b", "a", "online"), ("c", "a", "online")]
    # strictly younger than the window
    assert rows(people.recent_friendships(f, as_of_ms=100, window_ms=90)) == [("a", "c", 90), ("c", "a", 90)]
    visits = spark.createDataFrame([("d", "a"), ("b", "a"), ("ghost", "a")], "viewer string, owner string")
    assert rows(people.affiliated_friends(f, u, visits)) == [("b", "a", "b", "y"), ("d", "a", "c", "x")]
    network = rows(people.ego_network(f, u))
    assert ("d", "d", None, None) in network and ("a", "a", "b", "b") in network and len(network) == 5


def test_suggestions(spark, rows):
    names = [(f"Ann Number{i}", f"n{i}") for i in range(9)] + [("Joanna Ann", "x"), ("Bob annal", "y")]
    search = spark.createDataFrame(names, "fullname string, username string")
    terms = spark.createDataFrame([("ann",), ("Number3",), ("nobody",), ("",), ("o",), ("Joanna Ann and more",)], "term string")
    got = rows(people.suggest_users(search, terms), "term", "position", "username")
    assert got == sorted(
        [("ann", i + 1, f"n{i}") for i in range(5)] + [("Number3", 1, "n3")], key=str
    )


def test_rooms(spark, rows):
    membership = spark.createDataFrame(
        [(1, "a"), (1, "b"), (2, "b"), (2, "a"), (2, "c"), (7, "a"), (7, "b"), (9, "d")],
        "roomuniqueid bigint, member string",
    )
    assert rows(chat.rooms_by_user(membership)) == sorted(
        [("a", 1, 2), ("b", 1, 2), ("a", 2, 3), ("b", 2, 3), ("c", 2, 3), ("a", 7, 2), ("b", 7, 2), ("d", 9, 1)], key=str
    )
    only_c = spark.createDataFrame([("c",)], "username string")
    assert rows(chat.rooms_by_user(membership, only_c)) == [("c", 2, 3)]
    assert rows(chat.room_rosters(membership, only_c)) == [(2, "a"), (2, "b"), (2, "c")]
    groups = spark.createDataFrame(
        [(1, ["b", "a"]), (2, ["c", "a", "b"]), (3, ["a"]), (4, ["d", "d"])], "group_id int, members array<string>"
    )
    assert rows(chat.find_room(membership, groups), "group_id", "roomuniqueid") == [(1, 1), (2, 2), (3, None), (4, 9)]
    assert rows(chat.invitable_users(friends(spark), membership)) == [(1, "a", "c"), (7, "a", "c")]


def test_messages(spark):
    messages = spark.createDataFrame(
        [(1, 5, "b", "later"), (1, 2, "a", "first"), (2, 1, "c", "other")],
        "roomuniqueid bigint, timestamp bigint, sender string, content string",
    )
    assert [r.content for r in sorted(chat.chat_history(messages).collect(), key=lambda r: (r.roomuniqueid, r.position))] == [
        "first", "later", "other"
    ]
    membership = spark.createDataFrame([(1, "a"), (1, "b"), (1, "c"), (2, "c")], "roomuniqueid bigint, member string")
    sent = {(r.content, r.receiver) for r in chat.message_deliveries(messages, membership).collect()}
    assert sent == {("later", "a"), ("later", "c"), ("first", "b"), ("first", "c")}
    direct = spark.createDataFrame([("b", "a", 2, "two"), ("a", "b", 1, "one")], "fromuser string, touser string, timestamp bigint, message string")
    assert [(r.conversation, r.message) for r in ordered(chat.direct_history(direct))] == [("a__b", "one"), ("a__b", "two")]


def test_a_hot_poster_spreads_and_loses_no_row(spark, rows):
    """A third of all posts are one user's, whom everybody reads."""
    posts = [("hot", f"{i}-hot", i, f"p{i}") for i in range(300)] + [(f"u{i % 40}", f"{i}-u", i, "x") for i in range(600)]
    statuses = spark.createDataFrame(posts, "posterusername string, postuniqueid string, timestamp bigint, content string")
    pairs = [(f"u{i}", "hot") for i in range(40)] + [("hot", "u1"), ("u2", "u1")]
    reading = spark.createDataFrame(pairs, "username1 string, username2 string")
    plain = rows(feeds.status_feed(statuses, reading))
    assert rows(feeds.status_feed(statuses, reading, limit=16)) == plain
    assert len(plain) == 300 * 40 + 2 * 15
    hot = salting.hot_keys(statuses, "posterusername", 16).collect()
    assert [tuple(r) for r in hot] == [("hot", 19)]
    walls = spark.createDataFrame([(*p, p[0], False) for p in posts], "posterusername string, postuniqueid string, timestamp bigint, content string, wallusername string, flipped boolean")
    assert rows(feeds.home_feed(walls, reading, limit=16)) == rows(feeds.home_feed(walls, reading))
    visits = spark.createDataFrame(pairs, "viewer string, owner string")
    assert rows(feeds.wall_feed(walls, reading, visits, limit=16)) == rows(feeds.wall_feed(walls, reading, visits))
