"""Importance resampling against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np

from rookery.llm import resample

DOCS = "doc_id long, text string"


def plain_features(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    joined = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
    return len(words), [zlib.crc32(f.encode()) % 10_000 for f in joined]


def plain_resample(docs, target):
    raw, wanted = Counter(), Counter()
    for _, text in docs:
        raw.update(plain_features(text)[1])
    for _, text in target:
        wanted.update(plain_features(text)[1])
    s_all, t_all = raw.total(), wanted.total()
    rows = []
    for doc, text in docs:
        words, found = plain_features(text)
        gains = [math.floor(1000 * math.log((wanted[b] + 1) * (s_all + 10_000) / ((raw[b] + 1) * (t_all + 10_000)))) for b in found]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((doc, len(found), weight, score, words >= 20))
    able = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    ranks = {}
    for place, r in enumerate(able[: len(able) * 25 // 100], 1):
        ranks.setdefault(r[:4], []).append(place)
    return sorted(((*r[:4], ranks[r[:4]].pop() if ranks.get(r[:4]) else None) for r in rows), key=str)


def test_features_of_odd_texts():
    chance = random.Random(1)
    letters = "abcXYZ09 ,.\n\x01\x00é中😀_["
    for _ in range(100):
        texts = ["".join(chance.choices(letters, k=chance.randint(0, 60))) for _ in range(4)]
        texts += ["q" * 300 + " a " + "Q" * 300 + " " + "é" * 999, "", "a"]
        singles, pairs, words, seconds = resample.features(texts)
        for k, text in enumerate(texts):
            got = singles[words[k] : words[k + 1]].tolist() + pairs[seconds[k] : seconds[k + 1]].tolist()
            assert got == plain_features(text)[1]


def test_checksums_compose():
    for a, b in ((b"", b""), (b"a", b"bc"), (b"x" * 1000, b"y" * 70_000), ("é".encode(), b"1")):
        numbers = (np.array([zlib.crc32(p)], np.uint32) for p in (a, b))
        assert resample.combined(*numbers, np.array([len(b)]))[0] == zlib.crc32(a + b" " + b)


def test_draw_equals_plain_python(spark):
    chance = random.Random(8)
    words = [f"v{i}" for i in range(300)] + ["Größe", "中文", "A1"]
    docs = [(i, " ".join(chance.choices(words, k=chance.randint(0, 90)))) for i in range(400)]
    docs += [(None, docs[0][1]), (None, None), (7, docs[7][1]), (7, docs[7][1]), (500, "x" * 5000 + " y"), (501, "")]
    target = [(i, " ".join(chance.choices(words[:40], k=30))) for i in range(20)] + [(None, None), (3, "")]
    got = resample.resample(spark.createDataFrame(docs, DOCS), spark.createDataFrame(target, "item_id long, text string"))
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_resample(docs, target)


def test_odd_rows(spark, odd_docs, odd_rows, no_docs):
    got = resample.resample(odd_docs, odd_docs)
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_resample(odd_rows, odd_rows)
    assert resample.resample(no_docs, odd_docs).collect() == []
    alone = resample.resample(odd_docs, no_docs)
    assert sorted((tuple(r) for r in alone.collect()), key=str) == plain_resample(odd_rows, [])


def test_draw_prefers_the_target(spark):
    chance = random.Random(9)
    near, far = [f"n{i}" for i in range(50)], [f"f{i}" for i in range(50)]
    docs = [(i, " ".join(chance.choices(near if i % 4 == 0 else far, k=60))) for i in range(400)]
    target = [(0, " ".join(chance.choices(near, k=2000)))]
    rows = resample.resample(spark.createDataFrame(docs, DOCS), spark.createDataFrame(target, "item_id long, text string")).collect()
    drawn = [r["doc_id"] for r in rows if r["rank"] is not None]
    assert len(drawn) == 100 and sum(i % 4 == 0 for i in drawn) > 70
