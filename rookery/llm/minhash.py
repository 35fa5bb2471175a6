"""Near-duplicate detection with DartMinHash signatures of weighted word shingles.

The elements of a text are its five-word shingles, weighted by how often they occur, so
similarity is the weighted (multiset) Jaccard coefficient. Each unit of an element's
weight is a strip of the plane; hashed darts fall on it as a Poisson process whose ranks
are sums of exponential gaps, so equal strips get equal darts in every text. A text
throws only the darts below a rank that its total weight sets (about K ln K + 2K of
them), and each coordinate keeps the earliest dart. Coordinates left empty throw again
with twice the rank, so a signature is always full.

Signatures are cut into bands; texts that share a band are candidates. Bands are long, so
texts well below the threshold seldom meet: two texts of similarity 0.8 share one of the 36
bands of 11 with probability 0.96, of 0.85 with 0.998, of 0.65 with 0.27. In a band group the
text that shares most bands with others is the pivot, every other member of a fitting size
is compared with it, and verified links are united. Groups that still hold several components
go on with 8, 64, ... new pivots until one component or no uncompared pair is left: no
group is expanded into all pairs while a few pivots connect it, and no link between members
of one group is lost. Steps of this ladder are skipped while a turn's pairs stay below
64 for each row of the first groups, so groups of moderate size need two turns. After the first turn the shingles of the texts still in play are
counted, once: those found in one text only can be in no overlap, so a text cannot overlap
another by more than the rest, and texts (and then pairs) that cannot reach the threshold
leave uncompared, in this turn and the next ones. Edited copies just below the threshold end there, since their edits are their
own. A pair that meets in several bands or turns is compared once. Copies (equal words) are
one node throughout. Superseded tables are dropped as the turns go on.

Defined results: a null text is empty; a text without words is in a class of its own;
shorter texts than a shingle are one shingle; rows that repeat a doc_id are in the class of
their own text; an empty table gives an empty result; further columns are ignored.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import BinaryType, DoubleType

from rookery.llm.components import components
from rookery.llm.words import GOLD, batches, mix, shingle_hashes, word_hashes
from rookery.plans.scratch import Scratch

SHINGLE, SIMILARITY, BANDS, ROWS = 5, 0.8, 36, 11
WIDER, PAIRS = 8, 64  # pivots of a turn for each of the turn before; pairs of a turn for each member of the first one
SKETCH = "doc_id long, content binary, size int, bands array<long>"


def strips(hashes: np.ndarray) -> np.ndarray:
    """Sorted identifiers of the unit strips of one text's weighted elements."""
    values, counts = np.unique(hashes, return_counts=True)
    if len(values) == len(hashes):
        return values
    first = np.cumsum(counts) - counts
    nth = np.arange(len(hashes)) - np.repeat(first, counts)
    spread = np.repeat(values, counts)
    return np.sort(np.where(nth == 0, spread, mix(spread + nth.astype(np.uint64) * GOLD)))


def _throw(strip, owner, theta, n_texts, k, seed, best, value):
    """Darts of all strips up to each text's rank; keeps the earliest of each coordinate."""
    rank, alive = np.zeros(len(strip)), np.arange(len(strip))
    turn = 0
    while len(alive):
        turn += 1
        dart = mix(strip[alive] ^ mix(np.full(1, turn * 1000003 + seed, np.uint64))[0])
        rank = rank - np.log(((dart >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53))
        inside = rank <= theta[owner[alive]]
        alive, rank, dart = alive[inside], rank[inside], dart[inside]
        scrambled = mix(dart + GOLD)
        slot = owner[alive] * k + (scrambled % np.uint64(k)).astype(np.int64)
        np.minimum.at(best, slot, rank)
        won = rank == best[slot]
        value[slot[won]] = scrambled[won]


def signatures(strip_lists: list[np.ndarray], k: int, seed: int = 1) -> np.ndarray:
    """One row of ``k`` values for each text; texts without elements keep zeros."""
    n = len(strip_lists)
    sizes = np.array([len(s) for s in strip_lists], np.int64)
    strip = np.concatenate(strip_lists) if n else np.empty(0, np.uint64)
    owner = np.repeat(np.arange(n), sizes)
    best, value = np.full(n * k, np.inf), np.zeros(n * k, np.uint64)
    darts = k * np.log(k) + 2 * k
    wanting = sizes > 0
    while wanting.any():
        best.reshape(n, k)[wanting] = np.inf
        theta = np.where(wanting, darts / np.maximum(sizes, 1), -1.0)
        chosen = wanting[owner]
        _throw(strip[chosen], owner[chosen], theta, n, k, seed, best, value)
        wanting = wanting & np.isinf(best.reshape(n, k)).any(axis=1)
        darts *= 2
    return value.reshape(n, k)


def _sketch(bands: int, rows: int):
    weights = mix(np.arange(1, rows + 1, dtype=np.uint64) * GOLD) | np.uint64(1)
    names = mix(np.arange(1, bands + 1, dtype=np.uint64))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for ids, texts in batches(frame["text"], frame["doc_id"]):
                words, bounds = word_hashes(texts)
                hashes, cuts = shingle_hashes(words, bounds, SHINGLE)
                lists = [strips(hashes[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                keys = np.empty((len(texts), bands), np.uint64)
                # a strip of a short text throws many darts, so texts of like sizes go together
                order = np.argsort(np.diff(cuts), kind="stable")
                for at in range(0, len(texts), 256):
                    some = order[at : at + 256]
                    part = signatures([lists[i] for i in some], bands * rows)
                    keys[some] = mix((part.reshape(-1, bands, rows) * weights).sum(axis=2) + names)
                keys = keys.view(np.int64)
                sizes = [len(s) for s in lists]
                yield pd.DataFrame(
                    {"doc_id": pd.array(ids, "Int64"), "content": _contents(words, bounds), "size": sizes, "bands": list(keys)}
                )

    return run


def _contents(words: np.ndarray, bounds: np.ndarray) -> list[bytes | None]:
    """A 128-bit name of each text's words, none without words."""
    return [
        hashlib.blake2b(words[a:b].tobytes(), digest_size=16).digest() if b > a else None
        for a, b in zip(bounds[:-1], bounds[1:], strict=True)
    ]


def _weighed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for _, texts in batches(frame["text"], frame["doc_id"]):
            words, bounds = word_hashes(texts)
            hashes, cuts = shingle_hashes(words, bounds, SHINGLE)
            lists = [strips(hashes[a:b]).view(np.int64) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pd.DataFrame({"content": _contents(words, bounds), "strips": lists})


@F.pandas_udf(DoubleType())
def _similarity(left: pd.Series, right: pd.Series) -> pd.Series:
    def one(x, y):
        both = len(np.intersect1d(x, y, assume_unique=True))
        return both / max(1, len(x) + len(y) - both)

    return pd.Series([one(a, b) for a, b in zip(left, right, strict=True)])


def _verified(pairs: DataFrame, weighed: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose texts are similar enough; both tables name a pair or text once."""
    left = weighed.select(F.col("content").alias("a"), F.col("strips").alias("x"))
    right = weighed.select(F.col("content").alias("b"), F.col("strips").alias("y"))
    joined = pairs.join(left, "a").join(right, "b")
    return joined.where(_similarity("x", "y") >= similarity - 1e-12).select("a", "b")


def _reach(shared, size, other, similarity: float):
    """Whether ``shared`` common strips can make texts of these sizes similar enough."""
    return shared >= similarity * (size + other - shared) - 1e-9


def _shared(members: DataFrame, weighed: DataFrame) -> DataFrame:
    """Members with ``shared``: how many of their strips another text in play has too."""
    live = members.select("content").distinct()
    strip = weighed.join(live, "content", "left_semi").select("content", F.explode("strips").alias("strip"))
    owners = strip.groupBy("strip").agg(F.count(F.lit(1)).alias("n"), F.any_value("content").alias("content"))
    own = owners.where("n = 1").groupBy("content").agg(F.count(F.lit(1)).alias("own"))
    members = members.drop("shared").join(own, "content", "left")
    return members.withColumn("shared", F.col("size") - F.coalesce("own", F.lit(0))).drop("own")


def _able(members: DataFrame, similarity: float) -> DataFrame:
    """Members that may have a link to another member."""
    # the least partner of a member is the least text of its group, and of a fitting size
    least = members.groupBy("key").agg(F.min("size").alias("least"))
    other = F.greatest("least", F.col("size") * similarity)
    return members.join(least, "key").where(_reach(F.col("shared"), F.col("size"), other, similarity)).drop("least")


def _undecided(members: DataFrame) -> DataFrame:
    """Members of the groups that still hold several components, with ``n``, their group's size."""
    size = F.count(F.lit(1)).alias("n")
    roots = members.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), size).where("lo != hi")
    return members.drop("n").join(roots.select("key", "n"), "key")


def _wider(members: DataFrame, width: int, most: int) -> int:
    """Pivots of each group in the next turn, none without members."""
    widths = [width * WIDER**k for k in range(1, 8)]
    pairs = members.agg(*(F.sum(F.least("n", F.lit(w))).alias(str(w)) for w in widths)).first()
    if pairs[0] is None:
        return 0
    return max([widths[0], *(w for w in widths if pairs[str(w)] <= most)])


def _links(members: DataFrame, weighed: DataFrame, similarity: float, scratch: Scratch) -> DataFrame:
    """(node, root) of every text that is linked to a root; ``members(key, content, size, fame)``."""
    linked, compared, turn, width = None, None, 0, 1
    pairs_most = PAIRS * members.count()
    members = members.withColumn("root", F.col("content")).withColumn("shared", F.col("size").cast("long"))
    columns = ("fame", "content", "root", "size", "shared")
    pivot = [F.col(c).alias(f"pivot_{c}") for c in columns]
    while True:
        if turn == 0:
            most = members.groupBy("key").agg(F.max(F.struct(*columns)).alias("p"))
            pivots = most.select("key", "p.*").select("key", *pivot)
        else:
            famous = Window.partitionBy("key").orderBy(F.desc("fame"), F.desc("content"))
            pivots = members.withColumn("nth", F.row_number().over(famous)).where(F.col("nth") <= width)
            pivots = pivots.select("key", *pivot)
        pivots = scratch.save(pivots, f"pivots_{turn}")
        # sizes and shared strips bound the similarity before any comparison
        fits = _reach(F.least("shared", "pivot_shared"), F.col("size"), F.col("pivot_size"), similarity)
        # every pair from its more famous side, so two pivots meet once
        below = F.struct("fame", "content") < F.struct("pivot_fame", "pivot_content")
        pairs = members.join(pivots, "key").where((F.col("root") != F.col("pivot_root")) & fits & below).select(
            F.greatest("content", "pivot_content").alias("a"), F.least("content", "pivot_content").alias("b")
        )
        pairs = pairs.distinct()
        if compared is not None:
            pairs = pairs.join(compared, ["a", "b"], "left_anti")
        pairs = scratch.save(pairs, f"pairs_{turn}")
        compared = pairs if compared is None else compared.unionByName(pairs)
        found = scratch.save(_verified(pairs, weighed, similarity), f"links_{turn}")
        found = found if linked is None else _rooted(_rooted(found, "a", linked), "b", linked)
        union = components(found, scratch, f"components_{turn}")
        # nodes of former turns are no roots any more, so none has two rows
        linked = union if linked is None else _rooted(linked, "root", union).unionByName(union)
        # compared pivots leave; groups of one component are done
        past = pivots.select("key", F.col("pivot_content").alias("content"))
        rest = _rooted(members.join(past, ["key", "content"], "left_anti"), "root", union)
        rest = scratch.save(rest, f"rest_{turn}")
        open_ = scratch.save(_undecided(rest), f"open_{turn}")
        if open_.isEmpty():
            return linked
        if turn == 0:
            open_ = scratch.save(_shared(open_, weighed), "shared")
        members = scratch.save(_undecided(_able(open_, similarity)), f"members_{turn}")
        superseded = [f"members_{turn - 1}"] if turn else ["shared"]
        for label in (f"pivots_{turn}", f"links_{turn}", f"rest_{turn}", f"open_{turn}", *superseded):
            scratch.drop(label)
        turn += 1
        width = _wider(members, width, pairs_most)
        if not width:
            return linked


def _classes(docs: DataFrame, similarity: float, bands: int, rows: int) -> DataFrame:
    """One row per document: doc_id, content, class_id, class_size, kept."""
    scratch = Scratch(docs.sparkSession, "near")
    sketch = docs.select("doc_id", "text").mapInPandas(_sketch(bands, rows), SKETCH)
    sketch = scratch.save(sketch, "sketch")
    known = sketch.where("content is not null")
    # equal texts have equal bands, so one row of each text is enough
    nodes = known.groupBy("content").agg(
        F.min("doc_id").alias("id"), F.any_value("size").alias("size"), F.any_value("bands").alias("bands")
    )
    nodes = scratch.save(nodes, "nodes")
    banded = nodes.select("content", "size", F.explode("bands").alias("key"))
    sizes = banded.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # a text has a row a band at most
    fame = F.sum("n").over(Window.partitionBy("content"))
    members = banded.join(scratch.save(sizes, "sizes"), "key").withColumn("fame", fame).drop("n")
    members = scratch.save(members, "famed")
    wanted = nodes.join(members.select("content").distinct(), "content", "left_semi").select("id")
    # a repeated id brings further texts along, which no pair asks for
    texts = docs.select("doc_id", "text").join(wanted.hint("merge"), F.col("doc_id").eqNullSafe(F.col("id")), "left_semi")
    weighed = scratch.save(texts.mapInPandas(_weighed, "content binary, strips array<long>").dropDuplicates(["content"]), "weighed")
    for label in ("nodes", "sizes"):
        scratch.drop(label)
    linked = _links(members, weighed, similarity, scratch)
    scratch.drop("weighed")
    placed = scratch.save(_rooted(known.select("doc_id", "content", F.col("content").alias("root")), "root", linked), "placed")
    # the row that stays: the smallest id, a null one last, then the smallest text name
    first = F.min(F.struct(F.col("doc_id").isNull().alias("gap"), "doc_id", "content")).alias("first")
    classes = placed.groupBy("root").agg(first, F.count(F.lit(1)).alias("class_size"))
    named = placed.join(scratch.save(classes, "classes"), "root")
    kept = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("content") == F.col("first.content"))
    named = named.select("doc_id", "content", F.col("first.doc_id").alias("class_id"), "class_size", kept.alias("kept"))
    alone = sketch.where("content is null").select(
        "doc_id", "content", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"), F.lit(True).alias("kept")
    )
    return scratch.save(named.unionByName(alone), "result")


def near_classes(
    docs: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """One row per document: doc_id, class_id, class_size, kept.

    ``class_id`` is the smallest doc_id of the class, and ``kept`` marks the document that has
    it. Of rows that repeat the id with several texts, that of the smallest text name is meant.
    """
    return _classes(docs, similarity, bands, rows).drop("content")


def _rooted(rows: DataFrame, column: str, union: DataFrame) -> DataFrame:
    """``rows`` with the nodes in a column replaced by their roots."""
    named = union.select(F.col("node").alias(column), F.col("root").alias("_root"))
    return rows.join(named, column, "left").withColumn(column, F.coalesce("_root", column)).drop("_root")


@F.pandas_udf(BinaryType())
def _name(texts: pd.Series) -> pd.Series:
    """The name of a text's words, empty without words."""
    words, bounds = word_hashes([t or "" for t in texts])
    return pd.Series([c or b"" for c in _contents(words, bounds)])


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """One document of each class, with the columns it came with.

    Rows are told apart by id where it is their own. Those that repeat an id or have none are
    decided by id and text, and of equal ones with words one stays.
    """
    scratch = Scratch(docs.sparkSession, "near_kept")
    ids = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or doc_id is null")
    shared = scratch.save(ids.select(F.col("doc_id").alias("_id")), "shared_ids")
    decided = _classes(docs, SIMILARITY, BANDS, ROWS)
    gone = scratch.save(decided.where("not kept").select(F.col("doc_id").alias("_id")).distinct(), "gone")

    def same(other: DataFrame):
        return docs["doc_id"].eqNullSafe(other["_id"])

    own = docs.join(shared, same(shared), "left_anti").join(gone.hint("merge"), same(gone), "left_anti")
    several = docs.join(shared, same(shared), "left_semi").withColumn("_content", _name("text"))
    several = scratch.save(several, "several")
    stays = decided.where("kept and content is not null").select(F.col("doc_id").alias("_id"), F.col("content").alias("_name"))
    chosen = several["doc_id"].eqNullSafe(stays["_id"]) & (several["_content"] == stays["_name"])
    chosen = several.join(stays.hint("merge"), chosen, "left_semi").dropDuplicates(["doc_id", "_content"])
    bare = several.where(F.length("_content") == 0)
    return own.unionByName(chosen.unionByName(bare).select(*docs.columns))
