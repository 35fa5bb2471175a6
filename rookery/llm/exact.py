"""Exact deduplication by content-defined chunk recipes.

A text is cut where its own content says so (a line or sentence end, 256 to 4,352
characters in), and its recipe is the ordered list of chunk keys. Only texts whose
recipes and lengths collide move: their chunks are grouped by key, and a key is a
verified identifier when all chunks that carry it are the same string; chunks under a
key that fails get identifiers of their own. Texts are equal when their lists of
verified identifiers are. Everything is built-in expressions; a hot group of copies
meets partial aggregates and joins that can be split, never one task.

Defined results: a null text is an empty text; all empty texts are equal; letters other
than A-Z keep their case; rows that repeat a doc_id with the same text are copies of
each other and share one decision; a null doc_id takes part but never wins against a
known one; an empty table gives an empty result; further columns are ignored.
"""

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from rookery.plans.scratch import Scratch

CHUNKS = r"(?s).{256,4096}?(?:\n|[.!?] )|.{1,4352}"


def normalized(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def chunk_key(chunk: Column) -> Column:
    return F.xxhash64(chunk)


def _chunks(text: str) -> Column:
    return F.regexp_extract_all(F.col(text), F.lit(CHUNKS), F.lit(0))


def fingerprints(docs: DataFrame, key: Callable[[Column], Column] = chunk_key) -> DataFrame:
    """(doc_id, text_sha256, length, recipe): one row per input row."""
    texts = docs.select("doc_id", normalized(F.col("text")).alias("norm"))
    return texts.select(
        "doc_id",
        F.sha2(F.col("norm"), 256).alias("text_sha256"),
        F.octet_length("norm").cast("long").alias("length"),
        F.xxhash64(F.transform(_chunks("norm"), key)).alias("recipe"),
    )


def _identifiers(scratch: Scratch, chunks: DataFrame) -> DataFrame:
    """(doc_id, text_sha256, pos, id) with verified identifiers."""
    failed = (
        chunks.groupBy("key").agg(F.min("chunk").alias("lo"), F.max("chunk").alias("hi")).where("lo != hi").select("key")
    )
    failed = scratch.save(failed, "failed_keys")
    row = ["doc_id", "text_sha256", "pos"]
    verified = chunks.select(*row, "key").join(failed, "key", "left_anti").select(*row, F.col("key").cast("string").alias("id"))
    mixed = chunks.join(failed, "key", "left_semi")
    names = mixed.groupBy("key", "chunk").agg(F.lit(1)).select("key", "chunk").withColumn(
        "nth", F.row_number().over(Window.partitionBy("key").orderBy("chunk"))
    )
    named = mixed.join(names, ["key", "chunk"]).select(*row, F.concat_ws(":", "key", "nth").alias("id"))
    return verified.unionByName(named)


def exact_groups(docs: DataFrame, key: Callable[[Column], Column] = chunk_key) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    scratch = Scratch(docs.sparkSession, "exact")
    prints = scratch.save(fingerprints(docs, key), "fingerprints")
    same = prints.groupBy("length", "recipe").count().where("count > 1").select("length", "recipe")
    same = scratch.save(same, "colliding")
    # rows that repeat both id and text are one candidate that counts several times
    candidates = prints.join(same, ["length", "recipe"], "left_semi").groupBy("doc_id", "text_sha256").agg(
        F.count(F.lit(1)).alias("copies")
    )
    candidates = scratch.save(candidates, "candidates")
    wanted = candidates.select(F.col("doc_id").alias("wanted_id")).distinct().hint("merge")  # one plan at every size
    texts = (
        docs.select("doc_id", "text")
        .join(wanted, F.col("doc_id").eqNullSafe(F.col("wanted_id")), "left_semi")
        .select("doc_id", normalized(F.col("text")).alias("norm"))
        .withColumn("text_sha256", F.sha2("norm", 256))
    )
    chunks = (
        texts.select("doc_id", "text_sha256", F.posexplode(_chunks("norm")).alias("pos", "chunk"))
        .withColumn("key", key(F.col("chunk")))
    )
    chunks = scratch.save(chunks, "chunks")
    listed = _identifiers(scratch, chunks).distinct().groupBy("doc_id", "text_sha256").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "id"))), lambda x: x["id"]), ",").alias("ids")
    )
    one = F.col("c.doc_id").eqNullSafe(F.col("l.doc_id")) & (F.col("c.text_sha256") == F.col("l.text_sha256"))
    recipes = candidates.alias("c").join(listed.alias("l"), one, "left").select(
        "c.doc_id", "c.text_sha256", "c.copies", F.coalesce("l.ids", F.lit("")).alias("ids")
    )
    recipes = scratch.save(recipes, "recipes")
    groups = recipes.groupBy("ids").agg(F.max("doc_id").alias("keep_id"), F.sum("copies").alias("group_size"))
    groups = scratch.save(groups.where("group_size > 1"), "groups")
    decided = scratch.save(recipes.join(groups, "ids").select("doc_id", "text_sha256", "keep_id", "group_size"), "decided")
    found = F.col("p.doc_id").eqNullSafe(F.col("d.doc_id")) & (F.col("p.text_sha256") == F.col("d.text_sha256"))
    alone = F.col("d.group_size").isNull()
    keep = F.when(alone, F.col("p.doc_id")).otherwise(F.col("d.keep_id"))
    return prints.alias("p").join(decided.alias("d"), found, "left").select(
        "p.doc_id",
        keep.alias("keep_id"),
        F.coalesce("d.group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("p.doc_id").eqNullSafe(keep).alias("kept"),
        "p.text_sha256",
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """The documents that stay, with the columns they came with.

    Rows that repeat an id with an equal text are copies too: one of them stays.
    """
    scratch = Scratch(docs.sparkSession, "exact_kept")
    groups = scratch.save(exact_groups(docs).select("doc_id", "text_sha256", "kept"), "groups")
    names = [F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha")]
    gone = scratch.save(groups.where("not kept").select(*names).distinct(), "gone")
    repeated = groups.where("kept").groupBy("doc_id", "text_sha256").count().where("count > 1")
    repeated = scratch.save(repeated.select(*names), "repeated")
    texts = docs.withColumn("_text_sha", F.sha2(normalized(F.col("text")), 256))

    def same(other: DataFrame) -> Column:
        return texts["doc_id"].eqNullSafe(other["_id"]) & (texts["_text_sha"] == other["_sha"])

    once = texts.join(repeated, same(repeated), "left_anti").join(gone.hint("merge"), same(gone), "left_anti")
    more = texts.join(repeated, same(repeated), "left_semi").dropDuplicates(["doc_id", "_text_sha"])
    return once.unionByName(more).select(*docs.columns)
