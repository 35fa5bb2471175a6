"""Documents as compressed batches, for operators that exchange keys with the whole corpus.

A batch is one row: the ids, byte lengths and compressed texts of some whole documents.
An operator asks the corpus about the keys of a batch: request rows (batch, bucket, keys)
meet by bucket, and answers return by batch. A key appears once in a batch however often
it occurs there, so a hot key costs one entry a batch. The number of buckets follows the
data, so a bucket stays small, and there are never more request rows than keys.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, functions as F

from rookery.plans.scratch import Scratch

BATCH_BYTES, BUCKET_BYTES = 4 << 20, 8 << 20
NO_ID = np.iinfo(np.int64).max  # stands for a null id, after every other one


def _batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    ids, parts, size = [], [], 0

    def row():
        lens = np.array([len(p) for p in parts], np.int64)
        blob = zstandard.ZstdCompressor(level=3).compress(b"".join(parts))
        return pd.DataFrame({"ids": [np.array(ids, np.int64)], "lens": [lens], "n_bytes": [int(lens.sum())], "blob": [blob]})

    for frame in frames:
        missing = frame["doc_id"].isna()
        for i, gap, text in zip(frame["doc_id"], missing, frame["text"], strict=True):
            data = (text or "").encode("utf-8", "replace")
            if parts and size + len(data) > BATCH_BYTES:
                yield row()
                ids, parts, size = [], [], 0
            ids.append(NO_ID if gap else int(i))
            parts.append(data)
            size += len(data) + 16
    if parts:
        yield row()


def store_batches(docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, int]:
    """(batch, ids, lens, n_bytes, blob) of all documents, and a number of buckets for their keys."""
    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    made = wanted.mapInPandas(_batches, "ids array<long>, lens array<long>, n_bytes long, blob binary")
    table = scratch.save(made.withColumn("batch", F.monotonically_increasing_id()), "batches")
    total = table.agg(F.coalesce(F.sum("n_bytes"), F.lit(0)).alias("n")).first()["n"]
    return table, max(8, -(-total // BUCKET_BYTES))


def unpacked(ids, lens, blob) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Ids, bounds (one more than documents) and the joined texts of a batch."""
    data = zstandard.ZstdDecompressor().decompress(blob, max_output_size=max(1, int(np.sum(lens))))
    return np.asarray(ids, np.int64), np.concatenate([[0], np.cumsum(np.asarray(lens, np.int64))]), data


def pieces(bounds: np.ndarray, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of documents of about ``limit`` bytes."""
    a = 0
    while a < len(bounds) - 1:
        b = max(a + 1, int(np.searchsorted(bounds, bounds[a] + limit, side="right")) - 1)
        yield a, b
        a = b


def compress(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def expand(blob: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompressobj().decompress(blob), dtype)


def by_bucket(buckets: np.ndarray, *columns: np.ndarray) -> Iterator[tuple[int, list[np.ndarray]]]:
    """The rows of each bucket, from arrays of equal length."""
    order = np.argsort(buckets, kind="stable")
    if not len(order):
        return
    at = np.flatnonzero(np.concatenate([[True], np.diff(buckets[order]) != 0]))
    for a, b in zip(at, [*at[1:], len(order)], strict=True):
        yield int(buckets[order[a]]), [c[order[a:b]] for c in columns]
