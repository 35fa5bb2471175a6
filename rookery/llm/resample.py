"""Importance resampling of documents towards a target, over hashed word features.

Features are all runs of one or two consecutive words, repeats counted; a feature's bucket is
the CRC-32 of its bytes modulo ``BUCKETS``. Raw documents and target texts each give counts
of all buckets; a bucket's gain is the smoothed log ratio of both, and a document's weight the
mean gain of its features. Gumbel noise drawn from the doc_id turns the highest scores into a
draw without replacement in proportion to exp(weight).

Texts are scanned with an Aho-Corasick automaton over the distinct words of a batch, each
between two blanks, so a match is always a whole word. A word's payload is its CRC-32 and its
length in bytes. Checksums compose: the CRC of "v w" is that of v moved on by 1 + |w| zero
bytes, xor that of " w", so the bucket of two adjacent words comes from their payloads and no
feature text is ever built. A word over ``LONG_WORD`` characters stands in the scanned text
as a short token, so the automaton stays small whatever the words.

Each task adds up its counts before the shuffle. What reaches the driver and returns to the
tasks is ``BUCKETS`` gains, 80 kB at every size. Ranks are positions over range partitions.

Odd cases: a null or empty text has no words, no features, weight 0 and is never drawn by the
standard lower bound of words. A null doc_id draws its noise as an empty one and comes last of
equal scores. Repeated rows are ranked one by one. Further columns are dropped. An empty
target gives the gains of zero counts; an empty table gives an empty result.
"""

import zlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from rookery.llm.words import batches
from rookery.operators.ordered import positions
from rookery.plans.scratch import Scratch

BUCKETS = 10_000
SEED, MIN_WORDS, PERCENT = 7, 20, 25
LONG_WORD = 256
BATCH_CHARS = 1 << 21
POLYNOMIAL = 0xEDB88320  # fixed value: CRC-32, bits reversed

# a blank for every byte that is in no word, A-Z in lower case
_PLAIN = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def _moved_tables(powers: int) -> np.ndarray:
    """[p, k, v]: what value v in byte k of a checksum turns into after 2^p zero bytes."""
    single = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        single = np.where(single & 1, (single >> 1) ^ np.uint32(POLYNOMIAL), single >> 1).astype(np.uint32)
    tables = np.zeros((powers, 4, 256), np.uint32)
    for k in range(4):
        value = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
        tables[0, k] = single[value & 255] ^ (value >> np.uint32(8))
    for p in range(1, powers):
        for k in range(4):
            tables[p, k] = _apply(tables[p - 1], tables[p - 1, k])
    return tables


def _apply(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    out = table[0][values & 255]
    for k in range(1, 4):
        out = out ^ table[k][(values >> np.uint32(8 * k)) & np.uint32(255)]
    return out


_MOVED = _moved_tables(32)
_BLANK = np.uint32(zlib.crc32(b" "))


def moved(checksums: np.ndarray, zeros: np.ndarray) -> np.ndarray:
    """Checksums after so many zero bytes each."""
    out = checksums.astype(np.uint32)
    for p in range(int(zeros.max(initial=0)).bit_length()):
        here = np.flatnonzero((zeros >> p) & 1)
        out[here] = _apply(_MOVED[p], out[here])
    return out


def combined(first: np.ndarray, second: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Checksums of "v w" from those of v and w, and the length of w in bytes."""
    return moved(moved(first, np.ones(len(first), np.int64)) ^ _BLANK, lengths) ^ second


def _scan(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Checksums and lengths of all words in order, and where each text's words start."""
    parts, stand_ins = [], {}
    for text in texts:
        plain = text.encode("utf-8", "replace").translate(_PLAIN).decode("utf-8")
        own = plain.split(" ") if len(plain) > LONG_WORD else ()
        if any(len(w) > LONG_WORD for w in own):
            plain = " ".join(
                stand_ins.setdefault(w, f"\x01{len(stand_ins)}") if len(w) > LONG_WORD else w for w in own
            )
        parts.append(f" {plain} ")
    automaton = ahocorasick.Automaton()
    long_words = {token: word for word, token in stand_ins.items()}
    for word in dict.fromkeys(w for part in parts for w in part.split(" ")):
        if word:
            data = long_words.get(word, word).encode("utf-8")
            automaton.add_word(f" {word} ", zlib.crc32(data) | len(data) << 32)
    starts = np.zeros(len(parts) + 1, np.int64)
    if not len(automaton):
        return np.empty(0, np.uint32), np.empty(0, np.int64), starts
    automaton.make_automaton()
    payloads = []
    for k, part in enumerate(parts):
        payloads += [payload for _, payload in automaton.iter(part)]
        starts[k + 1] = len(payloads)
    found = np.array(payloads, np.int64)
    return (found & 0xFFFFFFFF).astype(np.uint32), found >> 32, starts


def features(texts: list[str], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all single words and of all word pairs, with the bounds of each text's words and pairs."""
    checksums, lengths, starts = _scan(texts)
    singles = checksums % np.uint32(buckets)
    last = np.zeros(len(checksums), np.bool_)
    last[starts[1:][np.diff(starts) > 0] - 1] = True
    at = np.flatnonzero(~last)
    pairs = combined(checksums[at], checksums[at + 1], lengths[at + 1]) % np.uint32(buckets)
    return singles.astype(np.int64), pairs.astype(np.int64), starts, np.searchsorted(at, starts)


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) over all rows of a ``text`` column; empty buckets are left out."""

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(buckets, np.int64)
        for frame in frames:
            for _, some in batches(frame["text"], frame["text"], BATCH_CHARS):
                singles, pairs, _, _ = features(some, buckets)
                total += np.bincount(singles, minlength=buckets) + np.bincount(pairs, minlength=buckets)
        used = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": used, "n": total[used]})

    per_task = texts.select(F.coalesce("text", F.lit("")).alias("text")).mapInPandas(work, "bucket long, n long")
    return per_task.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Thousandths of the log ratio of both smoothed bucket shares, floored, for each bucket."""
    counts = []
    for texts in (target, docs):
        rows = bucket_counts(texts, buckets).toPandas()
        full = np.zeros(buckets, np.float64)
        full[rows["bucket"].to_numpy(np.int64)] = rows["n"].to_numpy(np.float64)
        counts.append(full)
    t, s = counts
    ratio = (t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weigh(docs: DataFrame, gains: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row; weight is the floored mean gain."""
    buckets = len(gains)

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for ids, some in batches(frame["text"], frame["doc_id"], BATCH_CHARS):
                singles, pairs, words, seconds = features(some, buckets)
                total = sum(
                    np.diff(np.concatenate([[0], np.cumsum(gains[found])])[bounds])
                    for found, bounds in ((singles, words), (pairs, seconds))
                )
                n = np.diff(words) + np.diff(seconds)
                weight = np.where(n > 0, total // np.maximum(n, 1), 0)
                yield pd.DataFrame({"doc_id": ids, "n_words": np.diff(words), "n_features": n, "weight": weight})

    # ids travel as text: a null among whole numbers would turn a pandas column into floats
    wanted = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    made = wanted.mapInPandas(work, "doc_id string, n_words long, n_features long, weight long")
    return made.withColumn("doc_id", F.col("doc_id").cast("long"))


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every document; rank is null for one not drawn.

    Of the N documents with at least ``min_words`` words, the floor(percent * N / 100) of the
    highest scores are drawn, ties to the smaller doc_id.
    """
    scratch = Scratch(docs.sparkSession, "resample")
    # eight hexadecimal digits, as a number
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    scored = weigh(docs, bucket_gains(docs, target)).withColumn("score", (F.col("weight") + noise).cast("long"))
    scored = scratch.save(scored, "scored")
    able = scored.where(F.col("n_words") >= min_words)
    wanted = able.count() * percent // 100
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    ranked = positions(able, order, scratch, "ranked").withColumn("rank", F.when(F.col("position") <= wanted, F.col("position")))
    rest = scored.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.select(*rest.columns).unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank")
