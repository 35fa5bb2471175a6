"""The weighted graph of users, categories and articles.

Everything is derived from one adjacency frame
``(src_type, src, dst_type, dst, copies)``: out-degrees are a grouped sum over it
and the edge list is one join of it with the per-source shares.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from rookery.plans.scratch import Scratch

# Base shares of a user's outgoing weight, and of a category's.
USER_SHARES = {"category": 0.3, "article": 0.4, "user": 0.3}
CATEGORY_SHARE = 0.5


def category_article_pairs(articles: DataFrame) -> DataFrame:
    """(category, link) rows, repeated rows kept."""
    return articles.select("category", "link")


def _arc(src_type: str, src: str, dst_type: str, dst: str, copies: Column | int = 1) -> Column:
    count = copies if isinstance(copies, Column) else F.lit(copies)
    return F.struct(
        F.lit(src_type).alias("src_type"),
        F.col(src).alias("src"),
        F.lit(dst_type).alias("dst_type"),
        F.col(dst).alias("dst"),
        count.cast("bigint").alias("copies"),
    )


def _both_ways(pairs: DataFrame, there: Column, back: Column) -> DataFrame:
    return pairs.select(F.inline(F.array(there, back)))


def adjacency(
    users: DataFrame,
    interests: DataFrame,
    likes: DataFrame,
    friends: DataFrame,
    articles: DataFrame,
) -> DataFrame:
    """Distinct arcs of all seven kinds.

    ``interests(username, category)`` and ``likes(username, link)`` are sets of the
    listed users. ``copies`` counts repeated (category, link) rows, which enlarge the
    category's out-degree but give one edge; it is 1 on every other arc.
    """
    interests = interests.select("username", "category").distinct()
    likes = likes.select("username", "link").distinct()
    friendships = (
        friends.select("username1", "username2")
        .distinct()
        .join(users.select(F.col("username").alias("username1")), "username1", "left_semi")
    )
    listed = category_article_pairs(articles).groupBy("category", "link").agg(
        F.count("*").alias("copies")
    )
    kinds = [
        friendships.select(F.inline(F.array(_arc("user", "username1", "user", "username2")))),
        _both_ways(
            interests,
            _arc("user", "username", "category", "category"),
            _arc("category", "category", "user", "username"),
        ),
        _both_ways(
            likes,
            _arc("user", "username", "article", "link"),
            _arc("article", "link", "user", "username"),
        ),
        _both_ways(
            listed,
            _arc("category", "category", "article", "link", F.col("copies")),
            _arc("article", "link", "category", "category"),
        ),
    ]
    return reduce(DataFrame.unionByName, kinds)


def degree_counts(arcs: DataFrame, users: DataFrame) -> DataFrame:
    """Out-degree of every node by kind of neighbour, users without arcs included."""
    own = users.select(
        F.lit("user").alias("src_type"),
        F.col("username").alias("src"),
        F.lit(None).cast("string").alias("dst_type"),
        F.lit(None).cast("string").alias("dst"),
        F.lit(0).cast("bigint").alias("copies"),
    )

    def toward(kind: str) -> Column:
        return F.sum(F.when(F.col("dst_type") == kind, F.col("copies")).otherwise(0))

    return (
        arcs.unionByName(own)
        .groupBy(F.col("src_type").alias("node_type"), F.col("src").alias("node"))
        .agg(
            toward("user").alias("n_user"),
            toward("category").alias("n_category"),
            toward("article").alias("n_article"),
        )
    )


def edge_weights(degrees: DataFrame) -> DataFrame:
    """Weight of one edge from each node toward each kind of neighbour.

    A user's shares go to the kinds that occur, in proportion; a category halves
    between users and articles, or gives all to articles when nobody is interested;
    an article spreads evenly. Categories without articles do not send.
    """
    n_user, n_category, n_article = F.col("n_user"), F.col("n_category"), F.col("n_article")
    counts = {"user": n_user, "category": n_category, "article": n_article}

    occurring = reduce(
        lambda a, b: a + b,
        [F.when(counts[k] > 0, F.lit(share)).otherwise(0.0) for k, share in USER_SHARES.items()],
    )

    def from_user(kind: str) -> Column:
        return F.when(counts[kind] > 0, F.lit(USER_SHARES[kind]) / occurring / counts[kind]).otherwise(0.0)

    category_to_user = F.when(n_user > 0, F.lit(CATEGORY_SHARE) / n_user).otherwise(0.0)
    category_to_article = F.when(n_user > 0, F.lit(CATEGORY_SHARE)).otherwise(1.0) / n_article
    from_article = F.lit(1.0) / (n_user + n_category)

    def by_type(user: Column, category: Column, article: Column) -> Column:
        node_type = F.col("node_type")
        return F.when(node_type == "user", user).when(node_type == "category", category).otherwise(article)

    zero = F.lit(0.0)
    return degrees.where((F.col("node_type") != "category") | (n_article > 0)).select(
        "node_type",
        "node",
        by_type(from_user("user"), category_to_user, from_article).alias("w_user"),
        by_type(from_user("category"), zero, from_article).alias("w_category"),
        by_type(from_user("article"), category_to_article, zero).alias("w_article"),
    )


def build_edges(arcs: DataFrame, weights: DataFrame) -> DataFrame:
    """``(src_type, src, dst_type, dst, w)``; arcs of nodes that do not send drop out."""
    sending = weights.withColumnsRenamed({"node_type": "src_type", "node": "src"})
    toward = (
        F.when(F.col("dst_type") == "user", F.col("w_user"))
        .when(F.col("dst_type") == "category", F.col("w_category"))
        .otherwise(F.col("w_article"))
    )
    return arcs.join(sending, ["src_type", "src"]).select(
        "src_type", "src", "dst_type", "dst", toward.alias("w")
    )


def social_graph(
    users: DataFrame,
    interests: DataFrame,
    likes: DataFrame,
    friends: DataFrame,
    articles: DataFrame,
) -> DataFrame:
    """The weighted edge list straight from the stored tables.

    The arcs are written once, since degrees and edges both read them.
    """
    scratch = Scratch(users.sparkSession, "graph")
    arcs = scratch.save(adjacency(users, interests, likes, friends, articles), "arcs")
    return build_edges(arcs, edge_weights(degree_counts(arcs, users)))
