"""Periodic runs of words, by Baier's suffix grouping.

A run is a stretch of consecutive words with smallest period q (words q apart are equal),
at least two periods and ``min_length`` words long, that no neighbouring word extends.

The first phase of Baier's suffix sorter groups suffixes by their longest Lyndon word, so
the group lengths it ends with are the Lyndon array. It runs once with the words in one
order and once in the opposite order: every run has a Lyndon root that one of the two
arrays names. Each root is extended to both sides by its longest common extensions, which
are read off names of all stretches of 1, 2, 4, ... words; equal names mean equal words,
so nothing is hashed at this step.

In a run at least ceil(min_length / 2) consecutive words equal those one period later, so
all its words lie in windows of that many words that occur twice in the text. Words outside
such windows are cut out before the sorter; runs are whole in what is left.

Texts are worked on in batches of about ``BATCH_CHARS`` characters, a longer text alone;
memory is some two hundred bytes a word of the batch, whatever the corpus. Nothing is
shuffled.

Odd cases: a null or empty text has no words and no run. Equal runs of repeated rows are
found once per row. Further columns are dropped. An empty table gives an empty result.
"""

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rookery.llm.words import GOLD, mix

MIN_LENGTH = 12
BATCH_CHARS = 1 << 21
RUN = "struct<start:bigint,length:bigint,period:bigint>"


def lyndon_lengths(symbols: np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon word at each position.

    ``symbols`` are integers, 0 a separator below all others; the first one must be 0. Groups
    of suffixes are handled from the greatest to the least. When a group with common prefix u
    is done, each position left of its members whose own group is lower takes on its u's: p
    followed by k of them moves to a new group just above its old one, k times |u| longer.
    """
    order = np.argsort(symbols, kind="stable")
    cuts = np.flatnonzero(np.diff(symbols[order])) + 1
    members = [part.tolist() for part in np.split(order, cuts)]
    group = np.empty(len(symbols), np.int64)
    group[order] = np.repeat(np.arange(len(members)), [len(m) for m in members])
    group = group.tolist()
    prefix = [1] * len(members)
    below, above = list(range(-1, len(members) - 1)), list(range(1, len(members) + 1))
    done, smaller, length = bytearray(len(symbols)), [0] * len(symbols), [1] * len(symbols)
    top = len(members) - 1
    while top > 0:
        size = prefix[top]
        hits: dict[int, int] = {}
        for at in members[top]:
            if group[at] != top:
                continue
            left = at - 1
            while done[left]:
                left = smaller[left]
            smaller[at], done[at], length[at] = left, 1, size
            if group[left]:
                hits[left] = hits.get(left, 0) + 1
        members[top] = None
        moves: dict[tuple[int, int], list[int]] = {}
        for left, times in hits.items():
            moves.setdefault((times, group[left]), []).append(left)
        for times, old in sorted(moves, reverse=True):
            moved, new = sorted(moves[times, old]), len(members)
            members.append(moved)
            prefix.append(prefix[old] + times * size)
            below.append(old)
            above.append(above[old])
            below[above[old]] = above[old] = new
            for left in moved:
                group[left] = new
        top = below[top]
    return np.array(length, np.int64)


def _names(symbols: np.ndarray) -> list[np.ndarray]:
    """For k = 0, 1, ...: names of the stretches of 2^k symbols; 0 where it holds a separator or occurs once."""
    levels, at = [], np.flatnonzero(symbols)
    codes = symbols[at].astype(np.int64)
    while len(at):
        _, inverse, counts = np.unique(codes, return_inverse=True, return_counts=True)
        named = np.zeros(len(symbols), np.int64)
        named[at] = np.where(counts[inverse] > 1, inverse + 1, 0)
        if not named.any():
            break
        levels.append(named)
        half = 1 << (len(levels) - 1)
        at = np.flatnonzero(named[:-half] * named[half:]) if half < len(named) else at[:0]
        codes = named[at] * (int(named.max()) + 1) + named[at + half] if len(at) else codes[:0]
    return levels


def _extensions(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray, leftward: bool) -> np.ndarray:
    """How many symbols match from each a and b on, to the right or (excluding both) to the left."""
    total = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        step = 1 << k
        x = a - total - step if leftward else a + total
        y = b - total - step if leftward else b + total
        inside = (x >= 0) & (y + step <= len(levels[k]))
        first, second = levels[k][np.where(inside, x, 0)], levels[k][np.where(inside, y, 0)]
        total += np.where(inside & (first > 0) & (first == second), step, 0)
    return total


def runs_of_symbols(symbols: np.ndarray, min_length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs between separators, by start, then period."""
    found = []
    levels = _names(symbols)
    highest = int(symbols.max()) + 1
    for ranks in (symbols, np.where(symbols > 0, highest - symbols, 0)):
        period = lyndon_lengths(ranks)
        at = np.flatnonzero(ranks)
        period = period[at]
        right = _extensions(levels, at, at + period, False)
        left = _extensions(levels, at, at + period, True)
        length = period + left + right
        kept = (length >= 2 * period) & (length >= min_length)
        found.append(np.stack([at[kept] - left[kept], period[kept], length[kept]], axis=1))
    start, period, length = np.unique(np.concatenate(found), axis=0).T
    return start, length, period


def _suspects(ids: np.ndarray, bounds: np.ndarray, window: int) -> np.ndarray:
    """Words inside a window that occurs more than once in its text."""
    n = len(ids)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    starts = np.flatnonzero(np.arange(n) + window <= bounds[1:][text]) if n else np.empty(0, np.int64)
    value = (text[starts].astype(np.uint64) + np.uint64(1)) * GOLD
    for k in range(window):
        value = mix(value + ids[starts + k].astype(np.uint64))
    order = np.argsort(value)
    twice = np.zeros(len(starts), np.bool_)
    same = value[order][1:] == value[order][:-1]
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts[twice], 1)
    np.add.at(change, starts[twice] + window, -1)
    return np.cumsum(change[:-1]) > 0


def runs_of_texts(
    words: list[list[bytes]], min_length: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length, period) of all runs of all texts, by text, start, period."""
    bounds = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)
    numbers = {w: i for i, w in enumerate(dict.fromkeys(chain.from_iterable(words)), 1)}
    ids = np.fromiter(map(numbers.__getitem__, chain.from_iterable(words)), np.int64, int(bounds[-1]))
    suspect = np.flatnonzero(_suspects(ids, bounds, -(-min_length // 2)))
    if not len(suspect):
        return tuple(np.empty(0, np.int64) for _ in range(4))
    text = np.searchsorted(bounds, suspect, side="right") - 1
    breaks = np.concatenate([[True], (np.diff(suspect) > 1) | (np.diff(text) > 0)])
    place = np.arange(len(suspect)) + np.cumsum(breaks)  # one separator before each stretch
    symbols = np.zeros(int(place[-1]) + 2, np.int64)
    symbols[place] = ids[suspect]
    origin = np.zeros(len(symbols), np.int64)
    origin[place] = suspect
    start, length, period = runs_of_symbols(symbols, min_length)
    text = np.searchsorted(bounds, origin[start], side="right") - 1
    return text, origin[start] - bounds[text], length, period


def _batch(ids: list, texts: list[bytes], min_length: int) -> pa.RecordBatch:
    words = [t.split() for t in texts]  # bytes split at \x20 and \x09-\x0D
    text, start, length, period = runs_of_texts(words, min_length)
    ends = np.searchsorted(text, np.arange(len(texts) + 1))
    collapsed = []
    for k, own in enumerate(words):
        if ends[k] < ends[k + 1]:
            gone = np.zeros(len(own) + 1, np.int64)
            mine = slice(ends[k], ends[k + 1])
            np.add.at(gone, start[mine] + period[mine], 1)
            np.add.at(gone, start[mine] + length[mine], -1)
            own = [own[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0)]
        collapsed.append(b" ".join(own))
    runs = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in (start, length, period)], ["start", "length", "period"])
    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), runs)
    columns = [pa.array(ids, pa.int64()), pa.array([len(w) for w in words], pa.int64()), lists, pa.array(collapsed, pa.string())]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "collapsed"])


def find_runs(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every row.

    ``runs`` has every run of at least ``min_length`` words by start, then period;
    ``collapsed`` the text without each word that some run holds after its first period, words
    joined by one space.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size = [], [], 0
        for batch in batches:
            bodies = batch.column("text").cast(pa.binary()).to_pylist()
            for i, body in zip(batch.column("doc_id").to_pylist(), bodies, strict=True):
                if texts and size + len(body) > BATCH_CHARS:
                    yield _batch(ids, texts, min_length)
                    ids, texts, size = [], [], 0
                ids.append(i)
                texts.append(body)
                size += len(body) + 64
        if texts:
            yield _batch(ids, texts, min_length)

    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return wanted.mapInArrow(work, f"doc_id long, n_words long, runs array<{RUN}>, collapsed string")


def digests(found: DataFrame) -> DataFrame:
    """Number of runs, the longest one (ties: smallest start, then period) and digests, per row."""
    ranked = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    length = -F.col("best.less")
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    listed = F.array_join(F.transform(lines, lambda line: F.concat(line, F.lit("\n"))), "")
    return found.withColumn("best", ranked).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        length.alias("length"),
        F.col("best.period").alias("period"),
        F.expr("-best.less * 1000 div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """Documents of which about every tenth ends in a repeated stretch of its own words.

    With h the CRC-32 of the decimal doc_id and g = floor(h / 10): if h mod 10 is 0, each word
    i >= a becomes word a + (i - a) mod p, where a = g mod n and p = 1 + floor((n - a) / (3 + g mod 8)).
    A null doc_id plants nothing.
    """
    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def planted(own: Column, g: Column) -> Column:
        n = F.size(own).cast("long")
        a = F.when(n > 0, g % n).otherwise(0).cast("long")
        p = F.floor((n - a) / (F.lit(3) + g % 8)).cast("long") + 1
        source = lambda w, i: F.when(i < a, w).otherwise(F.get(own, (a + (i - a) % p).cast("int")))
        return F.array_join(F.transform(own, source), " ")

    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = docs.select("doc_id", "text", h.alias("h")).withColumn("words", F.when(F.col("h") % 10 == 0, words))
    text = F.when(F.col("words").isNotNull(), planted(F.col("words"), F.floor(F.col("h") / 10).cast("long")))
    return chosen.select("doc_id", F.coalesce(text, F.col("text")).alias("text"))
