import glob
import random
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from rookery.operators.adsorption import run_adsorption
from rookery.operators.graph import adjacency, build_edges, degree_counts, edge_weights, social_graph
from rookery.plans.scratch import SHUFFLE_CLEANUP, Scratch
from tests.dense import dense_labels


def frames(spark, users, interests=(), likes=(), friends=(), articles=()):
    return (
        spark.createDataFrame([(u,) for u in users], "username string"),
        spark.createDataFrame(list(interests), "username string, category string"),
        spark.createDataFrame(list(likes), "username string, link string"),
        spark.createDataFrame(list(friends), "username1 string, username2 string"),
        spark.createDataFrame(list(articles), "category string, link string"),
    )


def edge_map(spark, *args, **kwargs):
    edges = social_graph(*frames(spark, *args, **kwargs))
    found = edges.collect()
    assert len({(r.src_type, r.src, r.dst_type, r.dst) for r in found}) == len(found)
    return {(r.src_type, r.src, r.dst_type, r.dst): r.w for r in found}


def test_all_three_kinds_share_30_40_30(spark):
    e = edge_map(spark, ["a", "b"], [("a", "X"), ("a", "Y")], [("a", "l1")], [("a", "b")], [("X", "l1"), ("Y", "l2")])
    assert e["user", "a", "category", "X"] == pytest.approx(0.15)
    assert e["user", "a", "article", "l1"] == pytest.approx(0.4)
    assert e["user", "a", "user", "b"] == pytest.approx(0.3)


@pytest.mark.parametrize(
    "kinds, expected",
    [
        ({"interests"}, {"category": 1.0}),
        ({"likes"}, {"article": 1.0}),
        ({"friends"}, {"user": 1.0}),
        ({"interests", "friends"}, {"category": 0.5, "user": 0.5}),
        ({"interests", "likes"}, {"category": 3 / 7, "article": 4 / 7}),
        ({"likes", "friends"}, {"article": 4 / 7, "user": 3 / 7}),
    ],
)
def test_missing_kinds_rescale(spark, kinds, expected):
    have = {"interests": [("a", "X")], "likes": [("a", "l1")], "friends": [("a", "b")]}
    e = edge_map(spark, ["a", "b"], articles=[("X", "l1")], **{k: have[k] for k in kinds})
    from_a = {dst_type: w for (st, s, dst_type, _), w in e.items() if (st, s) == ("user", "a")}
    assert from_a == pytest.approx(expected)


def test_category_shares_and_repeated_rows(spark):
    e = edge_map(
        spark, ["a"], [("a", "X"), ("a", "Empty")], [], [], [("X", "l1"), ("X", "l1"), ("X", "l2"), ("Lonely", "l3")]
    )
    assert e["category", "X", "user", "a"] == pytest.approx(0.5)
    # two rows of l1 count twice in the degree and give one edge
    assert e["category", "X", "article", "l1"] == pytest.approx(0.5 / 3)
    assert e["category", "Lonely", "article", "l3"] == pytest.approx(1.0)
    assert not [k for k in e if k[:2] == ("category", "Empty")]
    assert e["user", "a", "category", "Empty"] == pytest.approx(0.5)
    assert e["article", "l1", "category", "X"] == pytest.approx(1.0)


def test_zero_degrees_are_listed_and_unknown_users_do_not_send(spark):
    users, *rest = frames(spark, ["a", "idle"], [("a", "X")], [], [("ghost", "a"), ("a", "ghost")], [("X", "l1")])
    arcs = adjacency(users, *rest)
    degrees = {(r.node_type, r.node): tuple(r)[2:] for r in degree_counts(arcs, users).collect()}
    assert degrees["user", "idle"] == (0, 0, 0)
    assert degrees["user", "a"] == (1, 1, 0)
    assert ("user", "ghost") not in degrees
    edges = build_edges(arcs, edge_weights(degree_counts(arcs, users)))
    assert edges.where("src = 'ghost'").count() == 0
    assert edges.where("dst = 'ghost'").count() == 1


def propagate(spark, graph, **kwargs):
    inputs = frames(spark, **graph)
    edges = social_graph(*inputs)
    run = run_adsorption(edges, inputs[0], **kwargs)
    got = {(r.node_type, r.node, r.label): r.weight for r in run.labels.collect()}
    plain = [((r.src_type, r.src), (r.dst_type, r.dst), r.w) for r in edges.collect()]
    return got, run, plain


def assert_same(got, want):
    assert set(got) == set(want)
    for key, value in want.items():
        assert got[key] == pytest.approx(value, abs=1e-9)


def random_graph(seed):
    rng = random.Random(seed)
    users = [f"u{i}" for i in range(rng.randint(2, 7))]
    categories = ["A", "B", "C", "D"]
    links = [f"l{i}" for i in range(rng.randint(2, 12))]

    def pairs(left, right, share):
        return [(a, b) for a in left for b in right if rng.random() < share]

    friends = [(a, b) for a, b in pairs(users, users + ["ghost"], 0.3) if a != b]
    return dict(
        users=users,
        interests=pairs(users, categories, 0.3),
        likes=pairs(users, links[: len(links) // 2] + ["unlisted"], 0.2),
        friends=friends,
        articles=pairs(categories[:3], links, 0.3) * rng.choice([1, 2]) + [("C", "solo1"), ("C", "solo2"), ("C", "solo3")],
    )


@pytest.mark.parametrize("seed, limits", [(1, {}), (2, {"fan_limit": 20}), (3, {"fan_limit": 2})])
def test_sparse_equals_dense(spark, seed, limits):
    graph = random_graph(seed)
    got, run, plain = propagate(spark, graph, max_iter=4, **limits)
    want, rounds = dense_labels(plain, graph["users"], max_iter=4)
    assert run.rounds == rounds
    assert_same(got, want)


def test_fixed_rounds_without_stop_test(spark):
    graph = random_graph(6)
    got, run, plain = propagate(spark, graph, max_iter=2, tol=None)
    want, _ = dense_labels(plain, graph["users"], max_iter=2, tol=-1.0)
    assert run.rounds == 2
    assert_same(got, want)


def test_user_without_in_edges_leaves(spark):
    graph = dict(users=["a", "b"], interests=[("a", "Empty"), ("b", "X")], articles=[("X", "l1")])
    got, _, _ = propagate(spark, graph)
    assert ("user", "a", "a") not in got
    assert got["user", "b", "b"] == pytest.approx(1.0)


def test_stops_as_soon_as_nothing_moves(spark):
    graph = dict(users=["b"], interests=[("b", "X")], articles=[("X", "l1")])
    got, run, plain = propagate(spark, graph)
    want, rounds = dense_labels(plain, graph["users"])
    assert run.converged and run.rounds == rounds < 15
    assert_same(got, want)


def test_slow_graph_runs_to_the_cap(spark):
    graph = dict(users=["a", "b"], likes=[("a", "l1"), ("b", "l1")], friends=[("a", "b")])
    got, run, plain = propagate(spark, graph, max_iter=6, tol=1e-12)
    want, rounds = dense_labels(plain, graph["users"], max_iter=6, tol=1e-12)
    assert run.rounds == rounds == 6 and not run.converged
    assert_same(got, want)


@pytest.mark.parametrize("seed", [4, 5])
def test_many_chunks_and_parts_equal_dense(spark, seed):
    graph = random_graph(seed)
    got, run, plain = propagate(spark, graph, max_iter=4, cells=8, arc_limit=3, fan_limit=2)
    assert run.graph.parts > 1
    want, rounds = dense_labels(plain, graph["users"], max_iter=4)
    assert run.rounds == rounds
    assert_same(got, want)


def test_article_vectors_are_not_stored_and_superseded_rounds_go(spark):
    users, links = [f"u{i}" for i in range(4)], [f"l{i}" for i in range(40)]
    graph = dict(
        users=users, interests=[(u, "X") for u in users], likes=[(u, x) for u in users for x in links],
        articles=[("X", x) for x in links],
    )
    got, run, plain = propagate(spark, graph, max_iter=4, tol=None)
    assert {kind for kind, _, _ in got} == {"user", "category", "article"}
    assert run.vectors.where("pmod(node, 4) = 2").isEmpty()
    assert spark.read.schema(run.vectors.schema).parquet(run.scratch.path("labels_2")).isEmpty()


@pytest.mark.parametrize("max_iter, tol", [(2, None), (4, 0.05)])
def test_blocks_of_chunks_equal_dense(spark, max_iter, tol):
    graph = random_graph(4)
    got, run, plain = propagate(spark, graph, max_iter=max_iter, tol=tol, cells=8, arc_limit=3, fan_limit=2, block=1)
    assert run.graph.blocks == run.graph.chunks > 1
    want, rounds = dense_labels(plain, graph["users"], max_iter=max_iter, tol=-1.0 if tol is None else tol)
    assert run.rounds == rounds
    assert_same(got, want)


def test_the_vectors_of_a_second_and_last_round_are_not_stored(spark):
    graph = random_graph(5)
    _, run, _ = propagate(spark, graph, max_iter=2, tol=None)
    stored = {p.rsplit("/", 2)[1] for p in glob.glob(run.scratch.path("*/block=0"))}
    assert "labels_1" in stored and "labels_2" not in stored
    assert not run.vectors.isEmpty()


def test_edges_between_articles(spark):
    weighted = [
        ("user", "a", "article", "p", 1.0), ("article", "p", "article", "q", 0.5), ("article", "p", "user", "b", 0.5),
        ("article", "q", "user", "a", 1.0), ("user", "b", "article", "q", 0.4), ("user", "b", "category", "X", 0.6),
        ("category", "X", "article", "p", 1.0),
    ]
    edges = spark.createDataFrame(weighted, "src_type string, src string, dst_type string, dst string, w double")
    run = run_adsorption(edges, spark.createDataFrame([("a",), ("b",)], "username string"), max_iter=5, tol=1e-9)
    got = {(r.node_type, r.node, r.label): r.weight for r in run.labels.collect()}
    plain = [((e[0], e[1]), (e[2], e[3]), e[4]) for e in weighted]
    want, rounds = dense_labels(plain, ["a", "b"], max_iter=5, tol=1e-9)
    assert run.rounds == rounds
    assert_same(got, want)


def test_a_write_leaves_no_shuffle_files(spark):
    scratch, root = Scratch(spark, "shuffles"), shuffle_root(spark)
    setting, before = spark.conf.get(SHUFFLE_CLEANUP), set(glob.glob(f"{root}/**/shuffle_*.data", recursive=True))
    scratch.save(spark.range(1000).groupBy((F.col("id") % 10).alias("k")).agg(F.count("*").alias("n")), "counts")
    for _ in range(50):  # files go in the background
        left = set(glob.glob(f"{root}/**/shuffle_*.data", recursive=True)) - before
        if not left:
            break
        time.sleep(0.1)
    assert not left
    assert spark.conf.get(SHUFFLE_CLEANUP) == setting


def shuffle_root(spark):
    return spark.conf.get("spark.local.dir", None) or tempfile.gettempdir()
