"""Removal of repeated byte strings by prefix-free parsing.

A rolling hash over ``GRAM`` bytes places triggers: every window of ``LENGTH`` bytes has
the least hash of its grams as its trigger value, which depends on the window alone.
Neighbouring windows with one trigger value form a phrase, and a phrase overlaps the next
one by ``LENGTH - 1`` bytes, so each window lies in one phrase. Equal windows have equal
triggers; phrases whose trigger no other document has are finished. The other distinct
phrases are the dictionary: it is dealt by trigger, its suffixes (cut at ``LENGTH``
bytes) are sorted in byte order, neighbours that are equal byte by byte are one string, and
the least document of a string is the least of the phrases that hold it. Answers return
to the documents, which drop the bytes that a string of a smaller document covers.

A passage of many documents makes many phrases at its edges, where trigger bytes are shared
and the bytes around them are not. The windows of each trigger's distinct phrases are
counted first; a trigger with more than ``HOT`` has its phrases cut into single windows,
which are dealt by a hash of their bytes. Equal windows have equal triggers, so they still
meet, and no group grows with how common a passage is, but for one entry a batch.

Triggers are exchanged as 32 bits within a bucket, which can only add phrases to the
dictionary; what is removed is decided on bytes.

Defined results: a null text is empty; texts shorter than ``LENGTH`` keep all bytes; rows
that repeat a doc_id do not remove from each other; a null doc_id comes after all others;
an empty table gives an empty result; further columns are ignored.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from rookery.llm.batched import NO_ID, by_bucket, compress, expand, pieces, store_batches, unpacked
from rookery.llm.words import mix
from rookery.plans.scratch import Scratch

LENGTH, GRAM = 50, 24
HOT = 1 << 19  # windows of one trigger that are compared in one group
PIECE = 1 << 17  # bytes of whole documents hashed at once, so that the arrays stay in cache
_rng = np.random.Generator(np.random.PCG64(977))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_TIMES = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)


def _sliding(values: np.ndarray, n: int, join) -> np.ndarray:
    """``join`` of every ``n`` neighbours: join(left, right, width of left)."""
    powers, width = {1: values}, 1
    while width * 2 <= n:
        v = powers[width]
        powers[width * 2] = join(v[:-width], v[width:], width)
        width *= 2
    out, done = powers[width], width
    while done < n:
        take = max(w for w in powers if w <= n - done)
        m = len(values) - done - take + 1
        out = join(out[:m], powers[take][done : done + m], done)
        done += take
    return out


def triggers(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> np.ndarray:
    """The trigger value of each window of ``length`` bytes."""
    if len(data) < length:
        return np.empty(0, np.uint64)
    grams = mix(_sliding(_BYTE[data], gram, lambda a, b, w: a * _TIMES[w] + b))
    return mix(_sliding(grams, length - gram + 1, lambda a, b, _: np.minimum(a, b)))


def phrases(data: bytes, bounds: np.ndarray, a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(trigger, document, first window, last window) of the phrases of documents a to b; offsets into ``data``."""
    base = int(bounds[a])
    value = triggers(np.frombuffer(data, np.uint8)[base : int(bounds[b])])
    counts = np.diff(bounds[a : b + 1])
    windows = np.maximum(counts - LENGTH + 1, 0)
    doc = np.repeat(np.arange(a, b), windows)
    first = np.cumsum(windows) - windows
    start = np.repeat(bounds[a:b] - base - first, windows) + np.arange(len(doc))
    value = value[start]
    if not len(value):
        none = np.empty(0, np.int64)
        return value, none, none, none
    head = np.concatenate([[True], (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])])
    at = np.flatnonzero(head)
    last = np.concatenate([at[1:], [len(value)]]) - 1
    return value[at], doc[at], start[at] + base, start[last] + base


def _codes(value: np.ndarray, n_buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, 32-bit key) of trigger values."""
    return (value % np.uint64(n_buckets)).astype(np.int64), (value >> np.uint64(32)).astype(np.uint32)


def _ask_triggers(n_buckets: int):
    """Each trigger of a batch, with the number of windows in its distinct phrases."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for batch, ids, lens, blob in frame[["batch", "ids", "lens", "blob"]].itertuples(index=False):
                _, bounds, data = unpacked(ids, lens, blob)
                parts = [phrases(data, bounds, a, b) for a, b in pieces(bounds, PIECE)]
                value, _, first, last = (np.concatenate(x) for x in zip(*parts, strict=True))
                if not len(value):
                    continue
                bucket, key = _codes(value, n_buckets)
                code = (bucket.astype(np.uint64) << np.uint64(32)) | key.astype(np.uint64)
                order = np.argsort(code, kind="stable")
                code, first, last = code[order], first[order], last[order]
                head = np.concatenate([[True], code[1:] != code[:-1]])
                at, of = np.flatnonzero(head), np.cumsum(head) - 1
                # only phrases of a trigger that occurs again can be equal
                again = np.flatnonzero(~(head & np.append(head[1:], True)))
                names = [hash(data[f : e + LENGTH]) for f, e in zip(first[again].tolist(), last[again].tolist(), strict=True)]
                names = mix(np.array(names, np.int64).view(np.uint64) ^ code[again])
                windows = last - first + 1
                copies = np.ones(len(again), bool)
                copies[np.unique(names, return_index=True)[1]] = False
                windows[again[copies]] = 0
                windows = np.bincount(of, windows).astype(np.int64)
                bucket, key = bucket[order[at]], key[order[at]]
                rows = [(k, x.tobytes(), compress(n)) for k, (x, n) in by_bucket(bucket, key, windows)]
                yield pd.DataFrame(rows, columns=["bucket", "keys", "windows"]).assign(batch=batch)

    return run


def _shared_triggers(hot: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        """For each batch, the keys of a bucket that another batch has too, and which of them are hot."""
        lists = [np.frombuffer(k, np.uint32) for k in group["keys"]]
        keys, which, counts = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
        windows = np.bincount(which, np.concatenate([expand(w, np.int64) for w in group["windows"]]), len(keys))
        shared = keys[counts > 1]
        many = keys[(counts > 1) & (windows > hot)]
        rows = []
        for batch, own in zip(group["batch"], lists, strict=True):
            found = np.intersect1d(own, shared, assume_unique=True)
            if len(found):
                rows.append((batch, found.tobytes(), np.intersect1d(found, many, assume_unique=True).tobytes()))
        return pd.DataFrame(rows, columns=["batch", "keys", "hot"]).assign(bucket=int(group["bucket"].iloc[0]))

    return run


def _member(sorted_values: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(values), bool)
    at = np.searchsorted(sorted_values, values)
    at[at == len(sorted_values)] = 0
    return sorted_values[at] == values


def _told(answers: list, name: str) -> np.ndarray:
    """The codes (bucket and key) of a batch's answers, in order."""
    codes = [(np.uint64(r["bucket"]) << np.uint64(32)) | np.frombuffer(r[name], np.uint32).astype(np.uint64) for r in answers]
    return np.sort(np.concatenate(codes)) if codes else np.empty(0, np.uint64)


def _words(texts: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """The windows at ``starts`` as big-endian words, the last one shorter."""
    view = np.lib.stride_tricks.sliding_window_view(np.concatenate([texts, np.zeros(8, np.uint8)]), 8)
    words = []
    for k in range(0, LENGTH, 8):
        word = np.ascontiguousarray(view[starts + k]).view(">u8").ravel().astype(np.uint64)
        words.append(word >> np.uint64(8 * max(0, 8 - (LENGTH - k))))
    return words


class Dictionary:
    """The distinct phrases of a batch whose trigger another document has too; of hot triggers, their windows."""

    def __init__(self, ids, bounds, data, answers, n_buckets: int):
        parts = [phrases(data, bounds, a, b) for a, b in pieces(bounds, PIECE)]
        value, doc, first, last = (np.concatenate(x) for x in zip(*parts, strict=True))
        bucket, key = _codes(value, n_buckets)
        code = (bucket.astype(np.uint64) << np.uint64(32)) | key.astype(np.uint64)
        shared = _member(_told(answers, "keys"), code)
        # triggers that several documents of this batch have
        order = np.lexsort((doc, code))
        c, d = code[order], doc[order]
        change = (c[1:] == c[:-1]) & (d[1:] != d[:-1])
        shared |= _member(np.unique(c[1:][change]), code)
        hot = _member(_told(answers, "hot"), code)
        keep, cut = np.flatnonzero(shared & ~hot), np.flatnonzero(hot)
        windows = last[cut] - first[cut] + 1
        single = np.repeat(first[cut] - (np.cumsum(windows) - windows), windows) + np.arange(int(windows.sum()))
        self.doc = np.concatenate([doc[keep], np.repeat(doc[cut], windows)])
        self.first, self.last = np.concatenate([first[keep], single]), np.concatenate([last[keep], single])
        bucket = np.concatenate([bucket[keep], _window_buckets(data, single, n_buckets)])
        seen: dict[bytes, int] = {}
        texts, buckets, least, most = [], [], [], []
        entry = np.empty(len(bucket), np.int64)
        for n, (i, f, e, k) in enumerate(zip(ids[self.doc].tolist(), self.first.tolist(), self.last.tolist(), bucket.tolist(), strict=True)):
            text = data[f : e + LENGTH]
            at = seen.get(text)
            if at is None:
                at = seen[text] = len(texts)
                texts.append(text)
                buckets.append(k)
                least.append(i)
                most.append(i)
            else:
                least[at] = min(least[at], i)
                most[at] = max(most[at], i)
            entry[n] = at
        self.entry, self.texts = entry, texts
        self.bucket, self.least, self.most = np.array(buckets, np.int64), np.array(least, np.int64), np.array(most, np.int64)


def _window_buckets(data: bytes, starts: np.ndarray, n_buckets: int) -> np.ndarray:
    """Buckets of single windows, from all their bytes."""
    code = np.zeros(len(starts), np.uint64)
    if len(starts):
        for word in _words(np.frombuffer(data, np.uint8), starts):
            code = mix(code ^ word)
    return (code % np.uint64(n_buckets)).astype(np.int64)


def _ask_phrases(n_buckets: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for batch, ids, lens, blob, answers in frame[["batch", "ids", "lens", "blob", "answers"]].itertuples(index=False):
                ids, bounds, data = unpacked(ids, lens, blob)
                own = Dictionary(ids, bounds, data, _listed(answers), n_buckets)
                numbers = np.arange(len(own.texts))
                for bucket, (which,) in by_bucket(own.bucket, numbers):
                    texts = [own.texts[i] for i in which]
                    yield pd.DataFrame({
                        "batch": [batch], "bucket": [bucket],
                        "numbers": [compress(which.astype(np.int32))],
                        "sizes": [compress(np.array([len(t) for t in texts], np.int32))],
                        "least": [compress(own.least[which])], "most": [compress(own.most[which])],
                        "texts": [compress(np.frombuffer(b"".join(texts), np.uint8))],
                    })

    return run


ASK = "batch long, bucket long, numbers binary, sizes binary, least binary, most binary, texts binary"


def least_documents(texts: np.ndarray, starts: np.ndarray, least: np.ndarray) -> np.ndarray:
    """For windows of ``LENGTH`` bytes at ``starts``: the least value among equal windows.

    Windows are sorted in byte order, as big-endian words.
    """
    if not len(starts):
        return np.empty(0, np.int64)
    words = _words(texts, starts)
    order = np.argsort(words[0], kind="stable")
    # most windows differ in their first words, so only ties are sorted by the others
    first = words[0][order]
    tied = np.zeros(len(order), bool)
    tied[1:] = first[1:] == first[:-1]
    tied[:-1] |= tied[1:].copy()
    some = order[tied]
    order[tied] = some[np.lexsort(tuple(w[some] for w in reversed(words)))]
    differs = np.zeros(len(order), bool)
    differs[0] = True
    for w in words:
        s = w[order]
        differs[1:] |= s[1:] != s[:-1]
    at = np.flatnonzero(differs)
    group = np.cumsum(differs) - 1
    out = np.empty(len(starts), np.int64)
    out[order] = np.minimum.reduceat(least[order], at)[group]
    return out


def _sorted_suffixes(group: pd.DataFrame) -> pd.DataFrame:
    """For each batch, the least document of each window of its phrases, where that can remove something."""
    sizes = [expand(s, np.int32) for s in group["sizes"]]
    least = [expand(s, np.int64) for s in group["least"]]
    texts = np.concatenate([expand(t, np.uint8) for t in group["texts"]])
    size = np.concatenate(sizes).astype(np.int64)
    start = np.cumsum(size) - size
    # equal phrases of several batches are one entry of the dictionary
    views, distinct, which = memoryview(texts.tobytes()), {}, np.empty(len(size), np.int64)
    for n, (a, m) in enumerate(zip(start.tolist(), size.tolist(), strict=True)):
        which[n] = distinct.setdefault(bytes(views[a : a + m]), len(distinct))
    owner = np.full(len(distinct), NO_ID)
    np.minimum.at(owner, which, np.concatenate(least))
    entry_size = np.empty(len(distinct), np.int64)
    entry_start = np.empty(len(distinct), np.int64)
    entry_size[which], entry_start[which] = size, start
    windows = entry_size - LENGTH + 1
    offset = np.cumsum(windows) - windows
    at = np.repeat(entry_start - offset, windows) + np.arange(int(windows.sum()))
    found = least_documents(texts, at, np.repeat(owner, windows))
    lowest = np.minimum.reduceat(found, offset) if len(found) else found
    rows, done = [], 0
    for batch, numbers, most in zip(group["batch"], group["numbers"], group["most"], strict=True):
        numbers, most = expand(numbers, np.int32), expand(most, np.int64)
        own = which[done : done + len(numbers)]
        done += len(numbers)
        useful = np.flatnonzero(lowest[own] < most)
        if not len(useful):
            continue
        own = own[useful]
        spread = np.repeat(offset[own] - (np.cumsum(windows[own]) - windows[own]), windows[own]) + np.arange(int(windows[own].sum()))
        rows.append((batch, compress(numbers[useful]), compress(windows[own].astype(np.int32)), compress(found[spread])))
    return pd.DataFrame(rows, columns=["batch", "numbers", "windows", "found"])


def _listed(answers) -> list:
    return [] if answers is None else list(answers)


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _removed(n_buckets: int, keep_text: bool):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["batch", "ids", "lens", "blob", "answers", "found"]
        for frame in frames:
            for _, ids, lens, blob, answers, found in frame[names].itertuples(index=False):
                ids, bounds, data = unpacked(ids, lens, blob)
                starts = np.zeros(len(data) + 1, np.int8)
                if found := _listed(found):
                    own = Dictionary(ids, bounds, data, _listed(answers), n_buckets)
                    numbers = np.concatenate([expand(r["numbers"], np.int32) for r in found])
                    windows = np.concatenate([expand(r["windows"], np.int32) for r in found]).astype(np.int64)
                    least = np.concatenate([expand(r["found"], np.int64) for r in found])
                    place = np.full(len(own.texts), -1)
                    place[numbers] = np.arange(len(numbers))
                    offset = np.cumsum(windows) - windows
                    at = place[own.entry]
                    hit = np.flatnonzero(at >= 0)
                    count = windows[at[hit]]
                    inside = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
                    smaller = least[np.repeat(offset[at[hit]], count) + inside] < np.repeat(ids[own.doc[hit]], count)
                    starts[(np.repeat(own.first[hit], count) + inside)[smaller]] = 1
                total = np.concatenate([[0], np.cumsum(starts[:-1], dtype=np.int64)])
                covered = total[1:] > total[np.maximum(np.arange(len(data)) - LENGTH + 1, 0)]
                view = np.frombuffer(data, np.uint8)
                rows = []
                for i, a, b in zip(ids.tolist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                    gone = covered[a:b]
                    n = int(gone.sum())
                    runs = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
                    kept = view[a:b][~gone].tobytes() if n else data[a:b]
                    rows.append((None if i == NO_ID else i, b - a, n, runs, hashlib.sha256(kept).hexdigest(), kept if keep_text else None))
                yield pd.DataFrame(rows, columns=[c.split()[0] for c in RESULT.split(", ")]).astype({"doc_id": "Int64"})

    return run


def remove_repeats(docs: DataFrame, keep_text: bool = True, hot: int = HOT) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the ``kept`` bytes."""
    scratch = Scratch(docs.sparkSession, "repeats")
    table, n_buckets = store_batches(docs, scratch)
    asked = table.mapInPandas(_ask_triggers(n_buckets), "bucket long, keys binary, windows binary, batch long")
    shared = asked.groupBy("bucket").applyInPandas(_shared_triggers(hot), "batch long, keys binary, hot binary, bucket long")
    shared = scratch.save(shared, "shared")
    # a batch gets back at most what it asked
    answers = shared.groupBy("batch").agg(F.collect_list(F.struct("bucket", "keys", "hot")).alias("answers"))
    answers = scratch.save(answers, "answers").hint("merge")
    told = table.join(answers, "batch", "left")
    asked = told.mapInPandas(_ask_phrases(n_buckets), ASK)
    found = asked.groupBy("bucket").applyInPandas(_sorted_suffixes, "batch long, numbers binary, windows binary, found binary")
    found = scratch.save(found, "found")
    both = found.groupBy("batch").agg(F.collect_list(F.struct("numbers", "windows", "found")).alias("found"))
    both = scratch.save(answers.join(both, "batch", "full"), "both").hint("merge")
    return table.join(both, "batch", "left").mapInPandas(_removed(n_buckets, keep_text), RESULT)
