"""Packing into length buckets that are optimal for the corpus.

Texts become sequences of at most ``max_len`` tokens (longer ones are cut into pieces,
none is lost). A piece has its tokens' text with the white space after them, so the pieces
of a document joined in order are its text again. The exact histogram of sequence lengths, at most ``max_len`` rows, goes
to the driver, where dynamic programming picks the bucket lengths that minimise padding
over the whole corpus. Batches hold as many sequences of one bucket as the token budget
allows. Positions in a bucket come from sub-buckets sized by the histogram, so a bucket
with most of the rows is never one window. Texts wait in a stored table while the plan is
made and join it by row number.

Defined results: a null text is an empty one, which is one sequence of its end token; rows that repeat
a doc_id are packed once each; an empty table gives an empty result; further columns are
ignored. ``max_len``, ``n_buckets`` and ``budget`` must be positive.
"""

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from rookery.llm.ranking import PER_BUCKET, positions
from rookery.plans.scratch import Scratch

MAX_LEN, N_BUCKETS, TOKEN_BUDGET = 2048, 16, 32768


def word_tokens(text: Column) -> Column:
    """Words between ASCII white space, and one end token."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")) + 1


def optimal_bounds(lengths: list[int], counts: list[int], n_buckets: int) -> list[int]:
    """Bucket lengths, ascending, with the least total padding; the last is the longest length."""
    if not lengths:
        return []
    order = np.argsort(lengths)
    size = np.asarray(lengths, np.int64)[order]
    rows = np.concatenate([[0], np.cumsum(np.asarray(counts, np.int64)[order])])
    m = len(size)
    # padded tokens instead of padding: the real tokens are the same in every choice
    best = np.concatenate([[0], size * rows[1:]]).astype(np.float64)
    choice = []
    for _ in range(1, min(n_buckets, m)):
        new, took = best.copy(), np.full(m + 1, -1)
        for j in range(1, m + 1):
            cost = best[:j] + size[j - 1] * (rows[j] - rows[:j])
            i = int(np.argmin(cost))
            if cost[i] < new[j]:
                new[j], took[j] = cost[i], i
        choice.append(took)
        best = new
    bounds, j = [], m
    for took in reversed(choice):
        if j and took[j] >= 0:
            bounds.append(int(size[j - 1]))
            j = int(took[j])
    if j:
        bounds.append(int(size[j - 1]))
    return sorted(bounds)


def sequences(docs: DataFrame, tokens: Column, pieces: Column, max_len: int) -> DataFrame:
    """(doc_id, piece, start, n_tokens, text): every document in pieces of at most ``max_len``.

    ``pieces`` lists the text of each token, all of the text in order; it is only looked at
    where a document is cut.
    """
    counted = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), tokens.cast("long").alias("total"), pieces.alias("listed"))
    numbers = F.sequence(F.lit(0), F.greatest(F.ceil(F.col("total") / max_len) - 1, F.lit(0)).cast("int"))
    listed = F.when(F.col("total") > max_len, F.col("listed"))
    cut = counted.select("doc_id", "text", "total", listed.alias("listed"), F.explode(numbers).alias("piece"))
    start = F.col("piece").cast("long") * max_len
    some = F.array_join(F.slice("listed", start.cast("int") + 1, F.lit(max_len)), "")
    return cut.select(
        "doc_id", "piece", start.alias("start"), F.least(F.lit(max_len).cast("long"), F.col("total") - start).alias("n_tokens"),
        F.coalesce(some, F.col("text")).alias("text"),
    )


def word_pieces(text: Column) -> Column:
    """The words with the white space after them; leading white space goes to the first one."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"(?:\A[\x20\x09-\x0D]+)?[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"), 0)


def pack(
    docs: DataFrame,
    tokens: Column | None = None,
    pieces: Column | None = None,
    max_len: int = MAX_LEN,
    n_buckets: int = N_BUCKETS,
    budget: int = TOKEN_BUDGET,
) -> DataFrame:
    """One row per sequence: doc_id, piece, start, n_tokens, bucket, bucket_len, batch, slot, padding, text.

    ``tokens`` counts a document's tokens with its end token and ``pieces`` lists their texts
    without it; both are words where they are not given.

    ``batch`` counts from 0 inside a bucket; a batch's rows times ``bucket_len`` stay
    within ``budget`` unless one row alone is longer.
    """
    scratch = Scratch(docs.sparkSession, "pack")
    if tokens is None:
        tokens, pieces = word_tokens(docs["text"]), word_pieces(docs["text"])
    whole = sequences(docs, tokens, pieces, max_len).withColumn("row", F.monotonically_increasing_id())
    whole = scratch.save(whole, "sequences")
    rows = whole.drop("text")
    histogram = rows.groupBy("n_tokens").count().orderBy("n_tokens").collect()  # at most max_len rows
    lengths, counts = [r["n_tokens"] for r in histogram], [r["count"] for r in histogram]
    bounds = optimal_bounds(lengths, counts, n_buckets) or [max_len]
    totals = [0] * len(bounds)
    for length, n in zip(lengths, counts, strict=True):
        totals[int(np.searchsorted(bounds, length))] += n

    def by_bucket(values: list[int]) -> Column:
        return F.element_at(F.array(*[F.lit(int(v)) for v in values]), F.col("bucket") + 1)

    bucket = F.coalesce(*[F.when(F.col("n_tokens") <= b, F.lit(i)) for i, b in enumerate(bounds)])
    split = by_bucket([-(-n // PER_BUCKET) or 1 for n in totals]).cast("long")
    dealt = rows.withColumn("bucket", bucket).withColumn("part", F.pmod(F.xxhash64("doc_id", "piece"), split))
    placed = positions(scratch.save(dealt, "dealt"), "bucket", "part", ["doc_id", "piece", "row"])
    per_batch = by_bucket([max(1, budget // b) for b in bounds])
    return placed.join(whole.select("row", "text"), "row").select(
        "doc_id", "piece", "start", "n_tokens", "bucket", by_bucket(bounds).alias("bucket_len"),
        F.floor(F.col("pos") / per_batch).alias("batch"),
        (F.col("pos") % per_batch).cast("int").alias("slot"),
        (by_bucket(bounds) - F.col("n_tokens")).alias("padding"),
        "text",
    )
