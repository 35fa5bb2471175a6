"""Benchmark decontamination with a BM25 index and block-max pruning.

The test items form an inverted index, the training passages are the queries. An item is
indexed in units of at most ``UNIT`` words, a passage is a window of two units' words
that moves by one unit, so every unit of a leaked item lies in some window whole. Term
weights are BM25 weights over the unit's own score: a window that holds all of a unit's
words scores 1. Retrieval returns every unit above the threshold, in the steps of a
block-max WAND, each over many windows at once: (1) windows whose terms' maximum weights
cannot reach the threshold end; (2) terms are taken in order of their maximum, those that
cannot reach the threshold together open no block; (3) blocks whose own maxima cannot
reach it end; (4) the rest are scored exactly. Then the item is verified against the
whole document: the shares of its question's and of its answer's five-word shingles
(an item's last sentence is its answer; a shingle belongs to where it ends) must both
reach the similarity.

The index is cut into shards of bounded size; each is broadcast and read by one pass over
the documents. Document frequencies count all items.

Defined results: null texts are empty; items of less than five words match nothing; an
item without a second sentence has no answer and is judged on its question; repeated
items or documents give each pair of ids once; empty tables give no matches; further
columns are ignored.
"""

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BooleanType

from rookery.llm.words import batches, shingle_hashes, word_hashes
from rookery.plans.scratch import Scratch

SHINGLE, SIMILARITY, RETRIEVE, UNIT, BLOCK = 5, 0.8, 0.5, 64, 8
K1, B = 1.2, 0.75
SHARD_BYTES = 8 << 20  # text of the items in one broadcast index

_SENTENCE = re.compile(r"(?<=[.!?])\s+")
MATCH = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"


def question_words(text: str) -> int:
    """How many words come before the last sentence; all of them when there is one sentence."""
    sentences = [s for s in _SENTENCE.split(text.strip()) if s]
    words, bounds = word_hashes(sentences)
    counts = np.diff(bounds)
    filled = np.flatnonzero(counts)
    return int(bounds[-1] if len(filled) < 2 else bounds[filled[-1]])


@dataclass
class Index:
    """Units of items with weights by term, block maxima, and shingles for the verification."""

    item_ids: list[int]
    questions: list[np.ndarray]
    answers: list[np.ndarray]
    unit_item: np.ndarray
    terms: np.ndarray  # sorted hashes
    ceiling: np.ndarray  # maximum weight of each term
    block_ptr: np.ndarray  # term -> entries of (block, maximum)
    block_id: np.ndarray
    block_max: np.ndarray
    post_ptr: np.ndarray  # entry -> postings (unit, weight)
    post_unit: np.ndarray
    post_weight: np.ndarray


def build_index(items: list[tuple[int, str]], frequency: Callable[[np.ndarray], np.ndarray], n_items: int, mean_words: float) -> Index:
    """``frequency`` gives the number of items that hold each term."""
    ids, questions, answers, unit_item, units = [], [], [], [], []
    for item_id, text in items:
        words, bounds = word_hashes([text])
        if len(words) < SHINGLE:
            continue
        shingles, _ = shingle_hashes(words, bounds, SHINGLE)
        cut = max(0, question_words(text) - SHINGLE + 1)
        questions.append(np.unique(shingles[:cut] if cut else shingles))
        answers.append(np.unique(shingles[cut:]) if cut else np.empty(0, np.uint64))
        n_units = -(-len(words) // UNIT)
        edges = np.linspace(0, len(words), n_units + 1).astype(int)
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            unit_item.append(len(ids))
            units.append(words[a:b])
        ids.append(item_id)
    rows = []
    for u, words in enumerate(units):
        terms, counts = np.unique(words, return_counts=True)
        df = frequency(terms)
        idf = np.log(1 + (n_items - df + 0.5) / (df + 0.5))
        weight = idf * counts * (K1 + 1) / (counts + K1 * (1 - B + B * len(words) / max(1.0, min(mean_words, UNIT))))
        rows.append((terms, np.full(len(terms), u), weight / weight.sum()))
    if not rows:
        none, zero = np.empty(0), np.zeros(1, np.int64)
        return Index([], [], [], none.astype(int), none.astype(np.uint64), none, zero, none.astype(int), none, zero, none.astype(int), none)
    term, unit, weight = (np.concatenate(x) for x in zip(*rows, strict=True))
    order = np.lexsort((unit, term))
    term, unit, weight = term[order], unit[order], weight[order]
    terms, at = np.unique(term, return_index=True)
    block = unit // BLOCK
    opens = np.flatnonzero(np.concatenate([[True], (term[1:] != term[:-1]) | (block[1:] != block[:-1])]))
    return Index(
        ids, questions, answers, np.array(unit_item), terms, np.maximum.reduceat(weight, at),
        np.searchsorted(opens, np.concatenate([at, [len(term)]])), block[opens], np.maximum.reduceat(weight, opens),
        np.concatenate([opens, [len(term)]]), unit, weight,
    )


def _spread(ptr: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For CSR rows ``keys``: (which key, entry) of all their entries."""
    counts = ptr[keys + 1] - ptr[keys]
    which = np.repeat(np.arange(len(keys)), counts)
    start = np.repeat(ptr[keys] - (np.cumsum(counts) - counts), counts)
    return which, start + np.arange(len(which))


def retrieve(index: Index, words: np.ndarray, bounds: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, unit, score) of all units that some window of a text reaches the threshold with."""
    none = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    if not len(index.terms) or not len(words):
        return none
    threshold = threshold - 1e-9
    counts = np.diff(bounds)
    term = np.searchsorted(index.terms, words)
    term[term == len(index.terms)] = 0
    known = np.flatnonzero(index.terms[term] == words)
    windows = counts // UNIT + 1  # of each text
    first_window = np.cumsum(windows) - windows
    text = np.repeat(np.arange(len(counts)), counts)[known]
    step = (known - bounds[:-1][text]) // UNIT
    window, term = first_window[text] + step, term[known]
    earlier = step > 0
    n_terms = len(index.terms)
    key = np.unique(np.concatenate([window * n_terms + term, (window[earlier] - 1) * n_terms + term[earlier]]))
    window, term = key // n_terms, key % n_terms
    n_windows = int(windows.sum())
    # (1) windows that cannot reach the threshold
    reach = np.bincount(window, index.ceiling[term], n_windows)
    alive = reach[window] >= threshold
    window, term = window[alive], term[alive]
    if not len(window):
        return none
    # (2) essential terms: those from which the sum of maxima, in ascending order, reaches the threshold
    order = np.lexsort((index.ceiling[term], window))
    window, term = window[order], term[order]
    sums = np.cumsum(index.ceiling[term])
    opens = np.flatnonzero(np.concatenate([[True], window[1:] != window[:-1]]))
    before = np.repeat(sums[opens] - index.ceiling[term[opens]], np.diff(np.concatenate([opens, [len(window)]])))
    essential = sums - before >= threshold
    n_blocks = int(index.block_id.max()) + 1
    which, entry = _spread(index.block_ptr, term[essential])
    open_blocks = np.unique(window[essential][which] * n_blocks + index.block_id[entry])
    # (3) block maxima
    which, entry = _spread(index.block_ptr, term)
    block_key = window[which] * n_blocks + index.block_id[entry]
    place = np.searchsorted(open_blocks, block_key)
    place[place == len(open_blocks)] = 0
    opened = open_blocks[place] == block_key
    place, entry = place[opened], entry[opened]
    good = np.bincount(place, index.block_max[entry], len(open_blocks)) >= threshold
    place, entry = place[good[place]], entry[good[place]]
    # (4) exact scores
    which, posting = _spread(index.post_ptr, entry)
    n_units = len(index.unit_item)
    unit_key = (open_blocks[place[which]] // n_blocks) * n_units + index.post_unit[posting]
    keys, inverse = np.unique(unit_key, return_inverse=True)
    score = np.bincount(inverse, index.post_weight[posting], len(keys))
    hit = score >= threshold
    text = np.searchsorted(first_window, keys[hit] // n_units, side="right") - 1
    return text, keys[hit] % n_units, score[hit]


def find_matches(index: Index, texts: list[str], threshold: float, similarity: float) -> list[tuple[int, int, float, float, float | None]]:
    """(text number, item number, score, question overlap, answer overlap) of verified matches."""
    words, bounds = word_hashes(texts)
    best: dict[tuple[int, int], float] = {}
    for t, u, s in zip(*retrieve(index, words, bounds, threshold), strict=True):
        pair = int(t), int(index.unit_item[u])
        best[pair] = max(best.get(pair, 0.0), float(s))
    found, current, shingles = [], None, None
    for t, i in sorted(best):
        if t != current:
            part = words[bounds[t] : bounds[t + 1]]
            current, shingles = t, np.unique(shingle_hashes(part, np.array([0, len(part)]), SHINGLE)[0])

        def overlap(wanted: np.ndarray) -> float:
            at = np.searchsorted(shingles, wanted)
            at[at == len(shingles)] = 0
            return float((shingles[at] == wanted).mean())

        question = overlap(index.questions[i])
        answer = overlap(index.answers[i]) if len(index.answers[i]) else None
        if question >= similarity and (answer is None or answer >= similarity):
            found.append((t, i, best[t, i], question, answer))
    return found


def _item_terms(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        rows = [(i, np.unique(word_hashes([t])[0]).view(np.int64)) for i, t in enumerate(frame["text"])]
        yield pd.DataFrame({
            "shard": np.repeat(frame["shard"].to_numpy(), [len(x) for _, x in rows]),
            "term": np.concatenate([x for _, x in rows]) if rows else np.empty(0, np.int64),
        })


def indexes(benchmark: DataFrame, shard_bytes: int = SHARD_BYTES) -> Iterator[Index]:
    """Index shards of all items, each from at most about ``shard_bytes`` of text."""
    scratch = Scratch(benchmark.sparkSession, "benchmark")
    items = benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text")).distinct()
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    n_shards = int(size // shard_bytes) + 1
    shard = F.pmod(F.xxhash64("item_id", "text"), F.lit(n_shards)).cast("int")
    items = scratch.save(items.withColumn("shard", shard), "items")
    # each item counts once for each of its terms
    terms = scratch.save(items.mapInPandas(_item_terms, "shard int, term long").groupBy("shard", "term").count(), "terms")
    frequencies = scratch.save(terms.groupBy("term").agg(F.sum("count").alias("df")), "frequencies")
    total = items.agg(F.count(F.lit(1)).alias("n"), F.sum(F.regexp_count("text", F.lit(r"[^\W_]+"))).alias("words")).first()
    n_items, mean = total["n"], (total["words"] or 0) / max(1, total["n"])
    for s in range(n_shards):
        own = terms.where(F.col("shard") == s).select("term")
        df = {r["term"]: r["df"] for r in frequencies.join(own, "term", "left_semi").collect()}  # terms of one shard
        texts = [(r["item_id"], r["text"]) for r in items.where(F.col("shard") == s).orderBy("item_id", "text").collect()]
        yield build_index(
            texts, lambda t, df=df: np.array([df[x] for x in t.view(np.int64).tolist()], np.float64), n_items, mean
        )


def contaminated(
    docs: DataFrame, benchmark: DataFrame, threshold: float = RETRIEVE, similarity: float = SIMILARITY,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """Pairs of a document and an item that it leaks, with score and overlaps."""
    context, found = docs.sparkSession.sparkContext, None
    for index in indexes(benchmark, shard_bytes):
        shared = context.broadcast(index)

        def run(frames: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            for frame in frames:
                for ids, texts in batches(frame["text"], frame["doc_id"]):
                    rows = find_matches(shared.value, texts, threshold, similarity)
                    if rows:
                        named = [(ids[t], shared.value.item_ids[i], s, q, a) for t, i, s, q, a in rows]
                        out = pd.DataFrame(named, columns=[c.split()[0] for c in MATCH.split(", ")])
                        yield out.astype({"doc_id": "Int64", "item_id": "Int64", "answer_overlap": "Float64"})

        part = docs.select("doc_id", "text").mapInPandas(run, MATCH)
        found = part if found is None else found.unionByName(part)
    return found.groupBy("doc_id", "item_id").agg(
        *[F.max(c).alias(c) for c in ("score", "question_overlap", "answer_overlap")]
    )


def _leaks(shared, threshold: float, similarity: float):
    @F.pandas_udf(BooleanType())
    def run(texts: pd.Series) -> pd.Series:
        flags = np.zeros(len(texts), bool)
        for rows, part in batches(texts, range(len(texts))):
            flags[[rows[t] for t, *_ in find_matches(shared.value, part, threshold, similarity)]] = True
        return pd.Series(flags)

    return run


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, threshold: float = RETRIEVE, similarity: float = SIMILARITY,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """The documents that leak no item, with the columns they came with; no text moves."""
    context = docs.sparkSession.sparkContext
    for index in indexes(benchmark, shard_bytes):
        shared = context.broadcast(index)

        docs = docs.where(~_leaks(shared, threshold, similarity)(F.coalesce(docs["text"], F.lit(""))))
    return docs
