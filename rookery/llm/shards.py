"""Sharding by balanced label propagation.

Documents that share a group (here: equal texts) should meet in one shard. Labels start
as a hash; in each round every group proposes its commonest label, a document takes the
proposal with the most members, and moves are admitted by quotas: what two shards swap
is always admitted, what remains only while a shard's linked rows stay below its quota of
rows (rows without links fill what is left). Groups stand
for their links, so no pair of documents is ever a row. At the end the surplus of every
shard, documents without links first, fills the gaps, so that row counts differ by at
most one. Everything is built-in expressions; what reaches the driver or is broadcast
has at most ``n_shards`` squared rows.

Defined results: a null text has size 1 and is equal to an empty text; rows that repeat
a doc_id start with the same label, and each has a slot; an empty table gives an empty result; further columns are
ignored. A group too large for one shard is spread over several.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from rookery.llm.ranking import PER_BUCKET, positions
from rookery.plans.scratch import Scratch

N_SHARDS, ROUNDS, SEED = 16, 5, 7


def _unit(*columns: Column | str) -> Column:
    """A hash in [0, 1)."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 30)) / float(1 << 30)


def propagate(
    scratch: Scratch, start: DataFrame, members: DataFrame, limit: float, rounds: int
) -> DataFrame:
    """(node, label) of linked nodes after some rounds.

    ``start`` has (node, label, rows) of linked nodes, ``members`` (node, grp); no label
    should get more than ``limit`` rows.
    """
    labels = start
    loads = {r["label"]: r["rows"] for r in start.groupBy("label").agg(F.sum("rows").alias("rows")).collect()}
    for turn in range(rounds):
        placed = scratch.save(members.join(labels.select("node", "label"), "node"), f"placed_{turn}")
        votes = placed.groupBy("grp", "label").count()
        commonest = Window.partitionBy("grp").orderBy(F.desc("count"), F.xxhash64("grp", "label"))  # n_shards rows a group
        plural = votes.withColumn("nth", F.row_number().over(commonest)).where("nth = 1")
        plural = scratch.save(plural.select("grp", F.col("label").alias("proposal"), "count"), f"plural_{turn}")
        wishes = placed.join(plural, "grp").groupBy("node", "proposal").agg(F.sum("count").alias("weight"))
        wish = wishes.groupBy("node").agg(F.max(F.struct("weight", -F.col("proposal"))).alias("best"))
        wish = wish.select("node", (-F.col("best").getField("col2")).alias("proposal"))
        moves = scratch.save(labels.join(wish, "node", "left"), f"moves_{turn}")
        flows = moves.where("label != proposal").groupBy("label", "proposal").agg(F.sum("rows").alias("rows")).collect()
        quotas = _quotas({(r["label"], r["proposal"]): r["rows"] for r in flows}, loads, limit)
        if not quotas:
            return labels
        table = members.sparkSession.createDataFrame(  # at most n_shards squared rows
            [(a, b, float(q)) for (a, b), q in quotas.items()], "label int, proposal int, share double"
        )
        admitted = moves.join(F.broadcast(table), ["label", "proposal"], "left").withColumn(
            "go", F.coalesce(_unit("node", F.lit(turn), F.lit(SEED)) < F.col("share"), F.lit(False))
        )
        labels = scratch.save(
            admitted.select("node", F.when(F.col("go"), F.col("proposal")).otherwise(F.col("label")).alias("label"), "rows", F.col("label").alias("left")),
            f"labels_{turn}",
        )
        for r in labels.where("label != left").groupBy("left", "label").agg(F.sum("rows").alias("rows")).collect():
            loads[r["left"]] -= r["rows"]
            loads[r["label"]] = loads.get(r["label"], 0) + r["rows"]
        labels = labels.drop("left")
    return labels


def _quotas(flows: dict[tuple[int, int], int], loads: dict[int, int], limit: float) -> dict[tuple[int, int], float]:
    """The share of each wished move (from, to) that is admitted."""
    swapped = {(a, b): min(n, flows.get((b, a), 0)) for (a, b), n in flows.items()}
    waiting: dict[int, int] = {}
    for (a, b), n in flows.items():
        waiting[b] = waiting.get(b, 0) + n - swapped[a, b]
    room = {b: max(0.0, limit - loads.get(b, 0)) for b in waiting}
    extra = {b: min(1.0, room[b] / w) if w else 0.0 for b, w in waiting.items()}
    shares = {(a, b): (swapped[a, b] + extra[b] * (n - swapped[a, b])) / n for (a, b), n in flows.items()}
    return {k: v for k, v in shares.items() if v > 0}


def assign(rows: DataFrame, groups: str, n_shards: int = N_SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """``rows`` (doc_id, a group column, others) with ``shard`` and a gapless ``slot``."""
    scratch = Scratch(rows.sparkSession, "shards")
    keyed = rows.withColumn("node", F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit(SEED)))
    keyed = scratch.save(keyed.withColumn("label", F.pmod("node", F.lit(n_shards)).cast("int")), "rows")
    large = keyed.groupBy(F.col(groups).alias("grp")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("grp")
    large = scratch.save(large, "large")
    linked = keyed.withColumnRenamed(groups, "grp").join(large, "grp", "left_semi")
    members = scratch.save(linked.select("node", "grp").distinct(), "members")
    start = members.select("node").distinct().join(keyed, "node").groupBy("node").agg(
        F.min("label").alias("label"), F.count(F.lit(1)).alias("rows")
    )
    start = scratch.save(start, "start")
    total = keyed.count()
    moved = propagate(scratch, start, members, total / n_shards, rounds)
    final = scratch.save(moved.select("node", F.col("label").alias("moved")), "final")
    parts = max(1, -(-total // (n_shards * PER_BUCKET)))
    # linked rows come first, so that a surplus is cut from rows without links
    part = F.pmod(F.xxhash64("node"), F.lit(parts)) + F.when(F.col("moved").isNull(), parts).otherwise(0)
    placed = keyed.join(final, "node", "left")
    placed = placed.withColumn("part", part).withColumn("label", F.coalesce("moved", "label")).drop("moved")
    others = [c for c in rows.columns if c != "doc_id"]
    ranked = scratch.save(positions(scratch.save(placed, "placed"), "label", "part", ["doc_id", *others]), "ranked")
    held = dict.fromkeys(range(n_shards), 0) | {r["label"]: r["count"] for r in ranked.groupBy("label").count().collect()}
    quota = {s: total // n_shards + (s < total % n_shards) for s in range(n_shards)}
    surplus_from, gap_from, surplus, gap = {}, {}, 0, 0
    for s in range(n_shards):
        surplus_from[s], gap_from[s] = surplus, gap
        surplus += max(0, held[s] - quota[s])
        gap += max(0, quota[s] - held[s])

    def of(values: dict[int, int], key: Column) -> Column:
        return F.element_at(F.array(*[F.lit(int(values[s])).cast("long") for s in range(n_shards)]), key + 1)

    home = F.col("label")
    number = of(surplus_from, home) + F.col("pos") - of(quota, home)  # among all surplus rows
    goes = F.lit(None).cast("int")
    for s in (s for s in range(n_shards) if held[s] < quota[s]):
        goes = F.when(number >= gap_from[s], F.lit(s)).otherwise(goes)
    stays = F.col("pos") < of(quota, home)
    shard = F.when(stays, home).otherwise(goes)
    slot = F.when(stays, F.col("pos")).otherwise(of(held, F.col("shard")) + number - of(gap_from, F.col("shard")))
    return ranked.withColumn("shard", shard).withColumn("slot", slot.cast("long")).drop("node", "label", "part", "pos")


def shard_documents(docs: DataFrame, n_shards: int = N_SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard: equal row counts, equal texts together."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("same"),
    )
    return assign(rows, "same", n_shards).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
