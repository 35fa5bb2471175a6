"""Periodic runs against direct searches."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from rookery.llm import queries, runs

FOLDER = "/root/testdata/sf0.001"


def brute_lyndon(s):
    return [max(j - i for j in range(i + 1, len(s) + 1) if all(s[i:j] < s[k:j] for k in range(i + 1, j))) for i in range(len(s))]


def brute_runs(words, min_length):
    """(start, length, period) by trying every period."""
    found = set()
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(min_length, 2 * q) and not any((i, j + q - i, p) in found for p in range(1, q)):
                found.add((i, j + q - i, q))
            i = j
    return sorted(found, key=lambda r: (r[0], r[2]))


def test_lyndon_lengths_by_definition():
    chance = random.Random(3)
    for _ in range(300):
        s = [chance.randint(1, chance.randint(1, 4)) for _ in range(chance.randint(1, 20))]
        assert runs.lyndon_lengths(np.array([0, *s, 0]))[1:-1].tolist() == brute_lyndon(s)


@pytest.mark.parametrize("min_length", [2, 5, 12])
def test_runs_equal_brute_force(min_length):
    chance = random.Random(4)
    for _ in range(150):
        texts = []
        for _ in range(chance.randint(1, 5)):
            words = []
            for _ in range(chance.randint(0, 5)):
                unit = [b"%d" % chance.randint(0, chance.choice([1, 3, 30])) for _ in range(chance.randint(1, 9))]
                words += unit * chance.randint(1, 6)
            texts.append(words)
        got = list(zip(*(c.tolist() for c in runs.runs_of_texts(texts, min_length)), strict=True))
        assert got == [(k, *r) for k, words in enumerate(texts) for r in brute_runs(words, min_length)]


def test_long_periodic_texts():
    alike = [b"a"] * 200_000
    pair = [b"a", b"b"] * 100_000 + [b"a"]
    text, start, length, period = runs.runs_of_texts([alike, pair], 12)
    assert list(zip(text, start, length, period, strict=True)) == [(0, 0, 200_000, 1), (1, 0, 200_001, 2)]


def brute_row(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
    found = brute_runs(words, 12)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    digest = hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in found).encode()).hexdigest()
    kept = hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest()
    return (doc_id, len(found), *best, best[1] and 1000 * best[1] // best[2], digest, kept)


def test_query_equals_brute_force(spark):
    frame = queries.op11_periodic_runs(spark, FOLDER)
    assert frame.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    # every period is tried, so the very long texts are left to the test above
    small = {r["doc_id"] for r in docs if len(r["text"] or "") < 12_000}
    want = {brute_row(*r) for r in docs if r["doc_id"] in small}
    got = [tuple(r) for r in frame.collect()]
    assert len(got) == len(docs) and len(small) > 0.9 * len(docs)
    assert {r for r in got if r[0] in small} == want
    assert sum(r[1] > 0 for r in got) > 10


def test_odd_rows(spark, odd_docs, odd_rows):
    got = sorted((tuple(r) for r in runs.digests(runs.find_runs(odd_docs)).collect()), key=str)
    plain = [(None if i is None else i, t) for i, t in odd_rows if (t or "") and len(t) < 50_000]
    want = {}
    for i, text in plain:
        found = brute_runs(text.encode().split(), 12)
        want[i, len(found)] = want.get((i, len(found)), 0) + 1
    for (i, n), times in want.items():
        assert sum(r[0] == i and r[1] == n for r in got) >= times
    assert len(got) == len(odd_rows)
    empty = next(r for r in got if r[0] == 1)
    nothing = hashlib.sha256(b"").hexdigest()
    assert empty == (1, 0, None, None, None, None, nothing, nothing)


def test_empty_table_and_planting(spark, no_docs):
    assert runs.digests(runs.find_runs(no_docs)).collect() == []
    assert runs.with_planted_runs(no_docs).collect() == []
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0]
    rows = [(ids[0], "one"), (ids[1], None), (ids[2], " \n "), (None, "a b c"), (ids[3], " ".join(f"w{k}" for k in range(50)))]
    planted = {r["doc_id"]: r["text"] for r in runs.with_planted_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert planted[ids[0]] == "one" and planted[None] == "a b c" and not (planted[ids[1]] or "").split() and not planted[ids[2]].split()
    h = zlib.crc32(str(ids[3]).encode())
    a = h // 10 % 50
    p = 1 + (50 - a) // (3 + h // 10 % 8)
    assert planted[ids[3]].split() == [f"w{i if i < a else a + (i - a) % p}" for i in range(50)]
