"""Label propagation (adsorption) over the social graph.

Each user starts with a label of weight 1 on their own node. A round sends every
node's labels along its edges, lifts a user's own label to at least 1, and scales
each node's labels to sum 1. A node that has no in-edge from a node still in play
leaves the graph, own label included.

How a round is laid out:

* Users are numbered without gaps, and labels are cut by number into chunks of ``width``. Labels never mix, so
  a group of a round is one chunk of all senders and a part of the arcs; it adds up what
  arrives in memory as a matrix of nodes and labels. With one part its sums are whole and are written at once;
  with more, only sums are shuffled. The width falls as nodes grow and the number of parts
  rises with arcs, so a group stays within ``cells`` weights and about ``arc_limit`` arcs.
* Chunks go through a round in blocks, one job after the other, so the shuffle files and copies of
  arcs of one block at a time are on disk, however many labels there are. The stop tests take the blocks in turn too.
* A block of vectors goes as soon as the block two rounds later is written, where no stop test reads it.
* If the last round is one of the first two, its vectors are not stored, since what it reads is sparse: only own
  labels are kept of it, from the arcs that carry them, and it runs again, block by block, when its labels are asked
  for above some weight.
* Vectors of articles are not stored. Nearly all of them receive from users and
  categories only ("reached" nodes), so their vectors of the round before follow from
  the stored ones of two rounds before, inside the group that sends them on. Only an article with an
  in-edge from another article is stored.
* A node's scale is known without reading the labels: scaled labels sum to 1, so a
  node receives exactly the weight of its edges from nodes that carry labels, plus
  what the own-label lift adds. Stored sums are not scaled; the scales of a round are a list that meets them where
  they are read. So arcs are listed once, as soon as no node leaves any more.
* The stop test looks at own labels first, then at the stored vectors of two rounds, and only
  when neither moved at the reached nodes, which it sums up once more.
* Non-user nodes whose only in-edge comes from the same source have equal labels in
  every round (the many articles nobody liked), so one of them stands for all.
* The arcs of a part travel sorted by target, in rows of about ``fan_limit``; they are sorted once, not in each chunk.
"""

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.group_ops import PandasCogroupedOps

from rookery.operators import packed
from rookery.operators.ordered import positions
from rookery.plans.scratch import Scratch, shuffles_dropped

# Node type codes in the two low bits of an id.
TYPE_CODES = {"user": 0, "category": 1, "article": 2}

MAX_ITER = 15
TOLERANCE = 0.05
FAN_LIMIT = 1 << 16
CHUNK, WIDEST, NARROW = 128, 512, 32  # labels of a chunk: usual and most; the least that many reached nodes leave
REACHED_CELLS = 4  # times as many weights of reached nodes as of others in a group
CHUNKS = 48  # chunks are wider than usual only if there are so many
CELLS, ARC_LIMIT = 1 << 22, 1 << 20  # weights of one kind, and arcs, of a group
PARTITIONS = 8  # times the usual number of them, at most, that groups are dealt over
BLOCK = 1 << 26  # weights or copies of arcs that one job shuffles, about


def _kind(id_column: str) -> Column:
    return F.pmod(id_column, F.lit(4))


def _type_code(name: str) -> Column:
    code = F.when(F.col(name) == "user", 0).when(F.col(name) == "category", 1).otherwise(2)
    return code.cast("bigint")


def initial_labels(users: DataFrame) -> DataFrame:
    """The non-zero starting labels: each user carries their own with weight 1."""
    return users.select(
        F.lit("user").alias("node_type"),
        F.col("username").alias("node"),
        F.col("username").alias("label"),
        F.lit(1.0).alias("weight"),
    ).distinct()


class _Graph:
    """Integer-coded edges of one run, after equal nodes were merged."""

    def __init__(
        self,
        edges: DataFrame,
        users: DataFrame,
        scratch: Scratch,
        fan_limit: int,
        cells: int,
        arc_limit: int,
        block: int,
    ):
        edges = scratch.save(edges, "given")
        self.names = scratch.save(self._number(edges, users, scratch), "names")
        coded = scratch.save(self._encode(edges), "coded")
        self.twins = scratch.save(self._twins(coded), "twins")
        self.edges = scratch.save(self._laned(scratch.save(self._merge(coded), "merged")), "edges")
        n_users, n_stored, n_reached, self.n_fed = self._counts()
        n_arcs = self.edges.count()
        usual = min(WIDEST, max(CHUNK, n_users // CHUNKS))
        width = max(1, min(usual, cells // max(1, n_stored)))
        self.width = max(min(width, NARROW), min(width, REACHED_CELLS * cells // max(1, n_reached)))
        self.n_users, self.chunks = n_users, max(1, -(-n_users // self.width))
        self.parts = max(1, -(-n_arcs // arc_limit), -(-n_reached * self.width // (REACHED_CELLS * cells)))
        self.fan_limit = fan_limit
        self.blocks = -(-self.chunks // max(1, block // max(1, n_arcs, n_stored * self.width * self.parts)))
        self.block = -(-self.chunks // self.blocks)
        self.blocks = -(-self.chunks // self.block)

    @staticmethod
    def _number(edges: DataFrame, users: DataFrame, scratch: Scratch) -> DataFrame:
        """Give every node of the label set an id; unknown users are not in the set.

        The ids of users are four times their gapless label numbers.
        """
        senders = edges.select(F.col("src_type").alias("node_type"), F.col("src").alias("name"))
        receivers = edges.select(F.col("dst_type").alias("node_type"), F.col("dst").alias("name"))
        names = users.select(F.col("username").alias("name")).unionByName(
            senders.where("node_type = 'user'").select("name")
        )
        numbered = positions(scratch.save(names.distinct(), "users"), ["name"], scratch, "numbered")
        people = numbered.select(F.lit("user").alias("node_type"), "name", ((F.col("position") - 1) * 4).alias("id"))
        others = senders.unionByName(receivers).where("node_type <> 'user'").distinct()
        return people.unionByName(
            others.withColumn("id", F.monotonically_increasing_id() * 4 + _type_code("node_type"))
        )

    def _encode(self, edges: DataFrame) -> DataFrame:
        src = self.names.select(
            F.col("node_type").alias("src_type"), F.col("name").alias("src"), F.col("id").alias("src_id")
        )
        dst = self.names.select(
            F.col("node_type").alias("dst_type"), F.col("name").alias("dst"), F.col("id").alias("dst_id")
        )
        return (
            edges.join(dst, ["dst_type", "dst"])
            .join(src, ["src_type", "src"])
            .select(F.col("src_id").alias("src"), F.col("dst_id").alias("dst"), "w")
        )

    @staticmethod
    def _twins(coded: DataFrame) -> DataFrame:
        """(node, stand_in) for every non-user node that another node stands for.

        They are of one type and share one in-edge: same source, same weight, and no other.
        """
        lone = (
            coded.where(_kind("dst") != TYPE_CODES["user"])
            .groupBy(F.col("dst").alias("node"))
            .agg(F.count("*").alias("n"), F.min("src").alias("src"), F.min("w").alias("w"))
            .where("n = 1")
        )
        lone = lone.withColumn("kind", _kind("node"))
        leader = lone.groupBy("src", "w", "kind").agg(F.min("node").alias("stand_in"))
        return lone.join(leader, ["src", "w", "kind"]).where("node <> stand_in").select("node", "stand_in")

    def _merge(self, coded: DataFrame) -> DataFrame:
        kept = coded.join(self.twins.select(F.col("node").alias("dst")), "dst", "left_anti")
        moved = kept.join(self.twins.select(F.col("node").alias("src"), "stand_in"), "src", "left")
        return moved.groupBy(F.coalesce("stand_in", "src").alias("src"), "dst").agg(F.sum("w").alias("w"))

    @staticmethod
    def _laned(edges: DataFrame) -> DataFrame:
        """Adds the lane of each edge: between stored nodes, into a reached one, or out of it."""
        is_article = _kind("id") == TYPE_CODES["article"]
        fed = edges.where((_kind("src") == TYPE_CODES["article"]) & (_kind("dst") == TYPE_CODES["article"]))
        fed = fed.select(F.col("dst").alias("id"), F.lit(True).alias("fed")).distinct()

        def reached(side: str) -> DataFrame:
            ids = edges.select(F.col(side).alias("id")).distinct().join(fed, "id", "left")
            return ids.where(is_article & F.col("fed").isNull()).select(F.col("id").alias(side), F.lit(True).alias(f"{side}_reached"))

        lane = F.when(F.col("dst_reached"), packed.BEFORE).when(F.col("src_reached"), packed.ONWARD).otherwise(packed.NOW)
        both = edges.join(reached("dst"), "dst", "left").join(reached("src"), "src", "left")
        return both.select("src", "dst", "w", lane.alias("lane"))

    def _counts(self) -> tuple[int, int, int, int]:
        """Users, nodes whose vectors are stored at most, reached nodes, and articles that are stored."""
        kind = _kind("id")
        n_users, n_others = self.names.agg(
            F.count_if(kind == TYPE_CODES["user"]), F.count_if(kind == TYPE_CODES["category"])
        ).first()
        n_reached = self.edges.where(F.col("lane") == packed.BEFORE).select("dst").distinct().count()
        fed = self.edges.where((_kind("dst") == TYPE_CODES["article"]) & (F.col("lane") != packed.BEFORE))
        n_fed = fed.select("dst").distinct().count()
        return n_users, n_users + n_others + n_fed, n_reached, n_fed

    def within(self, df: DataFrame, block: int) -> DataFrame:
        """The vectors of one block of chunks."""
        return df.where(F.col("block") == block)

    def arcs(self, live: DataFrame) -> DataFrame:
        """Lists of ``live(src, dst, w, lane)``. The arcs into and out of a reached node are of one part."""
        bare = F.when(F.col("lane") == packed.ONWARD, F.col("src")).otherwise(F.col("dst"))
        part = F.pmod(F.xxhash64(bare), F.lit(self.parts))
        rows = live.select(part.alias("part"), F.col("lane").alias("kind"), "src", "dst", "w")
        return rows.groupBy("part", "kind").applyInArrow(packed.listed(self.fan_limit), packed.LISTED)

    def totals(self, nodes: DataFrame, lane: int) -> DataFrame:
        """Lists of the nodes in play with their scale, for vectors of one lane; every part gets all."""
        return self._listed(nodes, packed.TOTALS + lane)

    def staying(self, arriving: DataFrame) -> DataFrame:
        """Lists of the users in play, who keep their own label."""
        users = arriving.where(_kind("node") == TYPE_CODES["user"])
        return self._listed(users.select("node", F.lit(0.0).alias("total")), packed.STAYING)

    def _listed(self, nodes: DataFrame, kind: int) -> DataFrame:
        rows = nodes.select("node", "total").mapInArrow(lambda batches: packed.listed_nodes(batches, kind), packed.LISTED)
        return rows.withColumn("part", _each(0, self.parts))

    def cogrouped(self, states: dict[int, DataFrame], lists: list[DataFrame], block: int) -> PandasCogroupedOps:
        """Stored vectors by lane met with lists, by chunk of a block and part of the arcs."""
        first = block * self.block
        end = min(first + self.block, self.chunks)
        dealt = reduce(DataFrame.unionByName, lists).withColumn("chunk", _each(first, end))
        columns = ("chunk", "nodes", "rows", "places", "mass")
        vectors = [
            self.within(labels, block).select(*columns, F.lit(lane).alias("lane")) for lane, labels in states.items()
        ]
        rows = reduce(DataFrame.unionByName, vectors).withColumn("part", _each(0, self.parts))
        # groups are few and each is much work, so they are not left to Spark's sizes of partitions
        usual = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        n = min(2 * (end - first) * self.parts, PARTITIONS * usual)
        both = [x.repartition(n, "chunk", "part").groupBy("chunk", "part") for x in (rows, dealt)]
        return both[0].cogroup(both[1])


def _each(start: int, end: int) -> Column:
    return F.explode(F.sequence(F.lit(start).cast("bigint"), F.lit(end - 1).cast("bigint")))


def _arriving(graph: _Graph, nodes: DataFrame) -> DataFrame:
    """Nodes that stay in play, with the weight of their edges from nodes that carry labels."""
    senders = nodes.withColumnsRenamed({"node": "src", "total": "src_total"})
    return (
        graph.edges.join(senders, "src")
        .join(nodes.select(F.col("node").alias("dst")), "dst", "left_semi")
        .groupBy(F.col("dst").alias("node"))
        .agg(F.sum(F.when(F.col("src_total") > 0, F.col("w")).otherwise(0.0)).alias("base"))
    )


def _live(graph: _Graph, nodes: DataFrame, arriving: DataFrame) -> DataFrame:
    """Edges from nodes that carry labels to nodes that stay."""
    senders = nodes.where("total > 0").select(F.col("node").alias("src"))
    receivers = arriving.select(F.col("node").alias("dst"))
    return graph.edges.join(senders, "src", "left_semi").join(receivers, "dst", "left_semi")


def _into_reached(arcs: DataFrame, lane: int) -> DataFrame:
    """The lists of arcs into reached nodes, as arcs of one lane."""
    return arcs.where(F.col("kind") == packed.BEFORE).withColumn("kind", F.lit(lane))


def propagate_step(
    graph: _Graph,
    states: dict[int, DataFrame],
    lists: list[DataFrame],
    block: int,
    own_only: bool = False,
) -> DataFrame:
    """One round of label flow for one block: slabs of the stored nodes, own labels lifted.

    ``states`` are the stored vectors of now and before, ``lists`` their arcs and scales, and the users in
    play, who keep their own label. ``own_only`` finds nothing but what arrives of own labels.
    """
    whole = graph.parts == 1
    sums = graph.cogrouped(states, lists, block).applyInArrow(packed.spread(graph.width, whole, own_only), packed.SLAB)
    if whole:
        return sums
    return sums.groupBy("chunk").applyInArrow(packed.gather(graph.width, own_only), packed.SLAB)


def _scales(arriving: DataFrame, labels: DataFrame, before: DataFrame | None, tol: float | None) -> DataFrame:
    """(node, total, mine, shifted): scale, own scaled label, and whether that moved by more than ``tol``."""
    own = labels.select(F.explode(F.arrays_zip("users", "own")).alias("o")).select(F.col("o.users").alias("node"), "o.own")
    lift = F.coalesce(F.greatest(F.lit(1.0) - F.col("own"), F.lit(0.0)), F.lit(0.0))
    scaled = arriving.join(own, "node", "left").withColumn("total", F.col("base") + lift)
    scaled = scaled.select("node", "total", (F.greatest("own", F.lit(1.0)) / F.col("total")).alias("all"), "own")
    scaled = scaled.select("node", "total", F.when(F.col("own").isNotNull(), F.col("all")).alias("mine"))
    if tol is None:
        return scaled.withColumn("shifted", F.lit(False))
    both = scaled.join(before.select("node", F.col("mine").alias("was")), "node", "left")
    return both.select("node", "total", "mine", (F.abs(F.col("mine") - F.col("was")) > tol).alias("shifted"))


@dataclass
class Adsorption:
    """How a run ended, and its labels.

    They are read from ``scratch``; closing it ends them.
    """

    graph: _Graph
    block_vectors: Callable[[int], DataFrame]
    nodes: DataFrame
    senders: DataFrame | None  # vectors of the round before, their nodes, and the last round's arcs
    sending: DataFrame | None
    arcs: DataFrame | None
    rounds: int
    converged: bool
    scratch: Scratch

    @property
    def vectors(self) -> DataFrame:
        """Weights of the nodes that have stored vectors, not scaled, all blocks."""
        width = self.graph.width
        slabs = reduce(DataFrame.unionByName, [self.block_vectors(k) for k in range(self.graph.blocks)])
        return slabs.mapInArrow(lambda batches: packed.unpacked(batches, width), packed.WEIGHED)

    @property
    def labels(self) -> DataFrame:
        """All non-zero labels ``(node_type, node, label, weight)``."""
        return self.heavier(0.0)

    def heavier(self, min_weight: float, node_type: str | None = None) -> DataFrame:
        """Labels above a weight, of one type of node if named; no other ever becomes a row."""
        graph, name = self.graph, f"heavier_{uuid.uuid4().hex}"
        kind = None if node_type is None else TYPE_CODES[node_type]
        states, lists = {}, [graph.totals(self.nodes, packed.LAST)]
        if self.senders is not None and node_type in (None, "article"):
            states[packed.NOW] = self.senders
            lists += [_into_reached(self.arcs, packed.LAST), graph.totals(self.sending, packed.NOW)]
        stored = node_type != "article" or graph.n_fed or not states

        def weighed(block: int) -> DataFrame:
            last = {packed.LAST: self.block_vectors(block).withColumn("block", F.lit(block))} if stored else {}
            met = graph.cogrouped(states | last, lists, block)
            return met.applyInArrow(packed.weights(min_weight, graph.width, kind), packed.WEIGHED)

        return _named(graph, _blocks_saved(graph, self.scratch, name, weighed))


def _blocks_saved(
    graph: _Graph, scratch: Scratch, label: str, made: Callable[[int], DataFrame], superseded: str | None = None
) -> DataFrame:
    """A table written block by block, which its column ``block`` tells apart.

    A block of the ``superseded`` table goes once its successor is written.
    """
    for block in range(graph.blocks):
        schema = scratch.save(made(block), f"{label}/block={block}").schema
        if superseded is not None:
            scratch.drop(f"{superseded}/block={block}")
    return scratch.read(label, schema.add("block", "integer"))


def run_adsorption(
    edges: DataFrame,
    users: DataFrame,
    max_iter: int = MAX_ITER,
    tol: float | None = TOLERANCE,
    fan_limit: int = FAN_LIMIT,
    cells: int = CELLS,
    arc_limit: int = ARC_LIMIT,
    block: int = BLOCK,
) -> Adsorption:
    """Propagate until no label moves by more than ``tol``, at most ``max_iter`` rounds.

    ``tol=None`` runs exactly ``max_iter`` rounds. A list holds about ``fan_limit`` arcs, a
    group ``cells`` weights and ``arc_limit`` arcs, a block about ``block`` of either.
    """
    scratch = Scratch(edges.sparkSession, "adsorption")
    graph = _Graph(edges, users, scratch, fan_limit, cells, arc_limit, block)

    is_user = _kind("id") == TYPE_CODES["user"]
    ids = graph.names.select(F.col("id").alias("node"), is_user.alias("user"))
    standing = ids.join(graph.twins.select("node"), "node", "left_anti")
    nodes = standing.select(
        "node", F.when(F.col("user"), 1.0).otherwise(0.0).alias("total"), F.when(F.col("user"), 1.0).alias("mine")
    )

    width, n_users = graph.width, graph.n_users
    chunks = edges.sparkSession.range(graph.chunks).select(F.col("id").alias("chunk"))
    labels = chunks.mapInArrow(lambda batches: packed.starting(batches, width, n_users), packed.SLAB)
    labels = labels.withColumn("block", F.expr(f"chunk div {graph.block}").cast("int"))
    vectors = partial(graph.within, labels)
    older, older_nodes, old_nodes, arcs, rounds, converged = None, None, None, None, 0, False
    arriving, in_play, all_carry, settled = None, None, False, False
    while rounds < max_iter and not converged:
        rounds += 1
        old_arcs = arcs
        if not settled:
            arriving = scratch.save(_arriving(graph, nodes), f"arriving_{rounds}")
            before, carried = in_play, all_carry
            in_play, carriers = arriving.agg(
                F.count("*"), F.count_if((F.col("base") > 0) | (_kind("node") == TYPE_CODES["user"]))
            ).first()
            all_carry = carriers == in_play
            # nobody left and every sender had labels: all later rounds see the same
            settled = in_play == before and carried
            arcs = scratch.save(graph.arcs(_live(graph, nodes, arriving)), f"arcs_{rounds}")
            if rounds > 2:
                scratch.drop(f"arcs_{rounds - 2}")
        old, older_nodes, old_nodes = labels, old_nodes, nodes
        states, lists = {packed.NOW: old}, [arcs.where(F.col("kind") != packed.BEFORE), graph.totals(old_nodes, packed.NOW)]
        if older is not None:
            states[packed.BEFORE] = older
            lists += [_into_reached(old_arcs, packed.BEFORE), graph.totals(older_nodes, packed.BEFORE)]
        lists.append(graph.staying(arriving))
        step, last = partial(propagate_step, graph, states, lists), rounds == max_iter
        tested = tol is not None and not last
        if last and rounds < 3:
            vectors = step
            labels = _blocks_saved(graph, scratch, "own", partial(step, own_only=True))
        else:
            superseded = f"labels_{rounds - 2}" if rounds > 2 and not tested else None
            labels = _blocks_saved(graph, scratch, f"labels_{rounds}", step, superseded)
            vectors = partial(graph.within, labels)
        nodes = scratch.save(_scales(arriving, labels, old_nodes, tol if tested else None), f"nodes_{rounds}")
        if tested:
            with shuffles_dropped(edges.sparkSession):
                converged = nodes.where("shifted").isEmpty() and not _moved(
                    graph, {packed.NOW: labels, packed.BEFORE: old},
                    [graph.totals(nodes, packed.NOW), graph.totals(old_nodes, packed.BEFORE)],
                    packed.stored_moved(tol, graph.width),
                )
                if converged:
                    lists = [_into_reached(arcs, packed.LAST), graph.totals(nodes, packed.LAST), graph.totals(old_nodes, packed.NOW)]
                    if older is not None:
                        lists += [_into_reached(old_arcs, packed.BEFORE), graph.totals(older_nodes, packed.BEFORE)]
                    converged = not _moved(graph, states, lists, packed.reached_moved(tol, graph.width))
        if rounds > 2:
            scratch.drop(f"labels_{rounds - 2}")
        older = old

    return Adsorption(graph, vectors, nodes, older, old_nodes, arcs, rounds, converged, scratch)


def _moved(graph: _Graph, states: dict[int, DataFrame], lists: list[DataFrame], test: Callable) -> bool:
    """Whether the test finds a node, block by block."""
    return any(
        not graph.cogrouped(states, lists, k).applyInArrow(test, packed.MOVED).isEmpty() for k in range(graph.blocks)
    )


def _named(graph: _Graph, weighed: DataFrame) -> DataFrame:
    """Labels by name, with stand-ins expanded to the nodes they stand for."""
    members = graph.names.join(
        graph.twins.withColumnRenamed("node", "id"), "id", "left"
    ).select(F.coalesce("stand_in", "id").alias("node"), "node_type", F.col("name").alias("node_name"))
    labelled = graph.names.where("node_type = 'user'").select(
        F.expr("id div 4").alias("label"), F.col("name").alias("label_name")
    )
    return (
        weighed.join(members, "node")
        .join(labelled, "label")
        .select("node_type", F.col("node_name").alias("node"), F.col("label_name").alias("label"), "weight")
    )


def adsorption(
    edges: DataFrame,
    users: DataFrame,
    max_iter: int = MAX_ITER,
    tol: float | None = TOLERANCE,
) -> DataFrame:
    return run_adsorption(edges, users, max_iter, tol).labels
