"""Exact, near and substring deduplication, and sharding, against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rookery.llm import batched, exact, minhash, repeats, shards
from rookery.plans.scratch import Scratch

FOLDER = "/root/testdata/sf0.001"


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def check_exact(rows, got):
    groups = defaultdict(list)
    for i, t in rows:
        groups[lowered(t)].append(i)
    want = []
    for i, t in rows:
        same = groups[lowered(t)]
        keep = max((x for x in same if x is not None), default=None)
        want.append((i, keep, len(same), i == keep, hashlib.sha256(lowered(t).encode()).hexdigest()))
    assert sorted(got, key=str) == sorted(want, key=str)


COLUMNS = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def test_exact_groups_of_odd_documents(odd_docs, odd_rows):
    check_exact(odd_rows, [tuple(r) for r in exact.exact_groups(odd_docs).select(*COLUMNS).collect()])


def test_exact_groups_survive_colliding_chunk_keys(spark):
    rows = [(i, random.Random(i % 7).choice("abc") * 40 + f"{i % 7:04d}. " * 80) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = exact.exact_groups(docs, key=lambda chunk: F.length(chunk).cast("long"))
    check_exact(rows, [tuple(r) for r in got.select(*COLUMNS).collect()])


def test_exact_drop_keeps_one_row_of_each_text(odd_docs, odd_rows):
    kept = exact.drop_copies(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(lowered(r["text"]) for r in kept.collect()) == sorted({lowered(t) for _, t in odd_rows})


def multiset(text):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    return Counter(tuple(words[i : i + 5]) for i in range(max(min(len(words), 1), len(words) - 4)))


def similar(a, b):
    both, union = sum((a & b).values()), sum((a | b).values())
    return bool(union) and both / union >= 0.8


def brute_classes(rows, meet=lambda i, j: True):
    sets = [multiset(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if meet(i, j) and similar(sets[i], sets[j]):
                root[find(i)] = find(j)
    ids = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        ids[find(i)].append(d)
    return sorted(tuple(sorted(x, key=str)) for x in ids.values())


def got_classes(rows):
    groups = defaultdict(list)
    for n, r in enumerate(rows):
        alone = r["class_size"] == 1
        groups[("alone", n) if alone else r["class_id"]].append(r["doc_id"])
    return sorted(tuple(sorted(x, key=str)) for x in groups.values())


def test_near_classes_of_edited_copies(spark):
    chance = random.Random(11)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(12):
        words = chance.choices(vocabulary, k=chance.randint(5, 200))
        for _ in range(chance.randint(1, 8)):
            copy = list(words)
            for _ in range(chance.randint(0, max(1, len(words) // 60))):
                copy[chance.randrange(len(copy))] = chance.choice(vocabulary)
            rows.append((len(rows), " ".join(copy)))
    got = minhash.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert got_classes(got) == brute_classes(rows)
    assert all(r["kept"] == (r["class_id"] == r["doc_id"]) for r in got)


def edited_family(seed, n):
    """Copies with edits of their own, most below the threshold of each other; some share an edit."""
    chance = random.Random(seed)
    words = [f"f{i}" for i in range(150)]
    common = [(chance.randrange(150), f"s{k}") for k in range(4)]
    texts = []
    for i in range(n):
        copy = list(words)
        for k in range(chance.randint(1, 6)):
            copy[chance.randrange(150)] = f"e{i}x{k}"
        for at, word in chance.sample(common, chance.randint(0, 2)):
            copy[at] = word
        texts.append(" ".join(copy))
    return texts


def test_near_classes_of_a_family_around_the_threshold(spark):
    """Every link between texts that share a band is found."""
    rows = list(enumerate(edited_family(8, 120) + edited_family(9, 60)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sketch = docs.mapInPandas(minhash._sketch(minhash.BANDS, minhash.ROWS), minhash.SKETCH).collect()
    bands = {r["doc_id"]: set(r["bands"]) for r in sketch}
    got = minhash.near_classes(docs).collect()
    assert got_classes(got) == brute_classes(rows, lambda i, j: bool(bands[i] & bands[j]))


@pytest.mark.parametrize(("pairs", "turns"), [(minhash.PAIRS, 2), (0, 3)])
def test_groups_of_moderate_size_take_two_turns(spark, monkeypatch, pairs, turns):
    """The links are the same however many turns they take."""
    rows = list(enumerate(edited_family(8, 120)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sketch = docs.mapInPandas(minhash._sketch(minhash.BANDS, minhash.ROWS), minhash.SKETCH).collect()
    bands = {r["doc_id"]: set(r["bands"]) for r in sketch}
    labels, save = [], Scratch.save
    monkeypatch.setattr(Scratch, "save", lambda self, df, label: labels.append(label) or save(self, df, label))
    monkeypatch.setattr(minhash, "PAIRS", pairs)
    got = minhash.near_classes(docs).collect()
    assert got_classes(got) == brute_classes(rows, lambda i, j: bool(bands[i] & bands[j]))
    assert sum(x.startswith("pivots_") for x in labels) == turns


def test_members_that_leave_uncompared_have_no_link(spark):
    texts = edited_family(5, 80)
    weighed = spark.createDataFrame([(0, t) for t in texts], "doc_id long, text string")
    weighed = weighed.mapInPandas(minhash._weighed, "content binary, strips array<long>").cache()
    members = weighed.select(F.lit(1).alias("key"), "content", F.size("strips").alias("size"))
    counted = minhash._shared(members.withColumn("shared", F.col("size")), weighed)
    able = {bytes(r["content"]): r["shared"] for r in minhash._able(counted, 0.8).collect()}
    sets = [(bytes(r["content"]), set(r["strips"])) for r in weighed.collect()]
    linked = set()
    for a, x in sets:
        others = set().union(*(y for b, y in sets if b != a))
        if a in able:
            assert able[a] == len(x & others)
        linked |= {a for b, y in sets if b != a and len(x & y) >= 0.8 * len(x | y)}
    assert linked <= able.keys() and len(able) < len(texts)


def test_links_that_the_pivot_does_not_have_are_found(spark):
    """A chain: each text is like the next one only, and all share bands with a hub text."""
    chance = random.Random(4)
    words = [f"t{chance.randrange(5000)}" for _ in range(300)]
    rows = []
    for i in range(12):
        rows.append((i, " ".join(words)))
        at = (i * 23) % 290
        words = words[:at] + [f"n{i}{k}" for k in range(20)] + words[at + 20 :]
    got = minhash.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert got_classes(got) == brute_classes(rows)


def test_bands_find_nine_of_ten_links_at_the_threshold(spark):
    """Pairs just above 0.8 that nothing but their own bands can bring together."""
    chance = random.Random(21)
    rows, pairs = [], 0
    while pairs < 250:
        words = [f"p{pairs}w{i}" for i in range(chance.randint(60, 200))]
        other = list(words)
        while True:
            trial = list(other)
            trial[chance.randrange(len(trial))] = f"p{pairs}n{len(rows)}x{chance.randrange(10**6)}"
            if not similar(multiset(" ".join(words)), multiset(" ".join(trial))):
                break
            other = trial
        rows += [(2 * pairs, " ".join(words)), (2 * pairs + 1, " ".join(other))]
        pairs += 1
    got = minhash.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = sum(r["class_size"] == 2 for r in got) / 2
    assert found >= 0.9 * pairs
    assert {r["class_id"] // 2 - r["doc_id"] // 2 for r in got} == {0}


def test_dropping_decides_shared_ids_by_text(spark):
    base = [f"w{i}" for i in range(100)]

    def text(k, *edits):
        words = [f"{w}t{k}" for w in base]
        for e in edits:
            words[e] = f"edit{k}x{e}"
        return " ".join(words)

    rows = [
        (None, text(1)), (None, text(1, 50)), (None, text(2)), (7, text(3)), (7, text(4)), (8, text(4, 9)), (6, text(3, 9)),
        (9, text(5)), (9, text(5)), (9, text(5, 3)), (None, ""), (None, None), (5, ""), (5, " "), (4, text(2, 1)),
    ]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, n int")
    kept = minhash.drop_near_copies(docs)
    assert kept.columns == docs.columns
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    sure = [(7, text(4)), (6, text(3, 9)), (4, text(2, 1)), (None, ""), (None, None), (5, ""), (5, " ")]
    assert all(r in got for r in sure) and len(got) == len(sure) + 2
    assert sum(r in got for r in [(None, text(1)), (None, text(1, 50))]) == 1
    assert sum(r in got for r in [(9, text(5)), (9, text(5, 3))]) == 1


def test_near_classes_of_odd_documents(odd_docs, odd_rows):
    got = minhash.near_classes(odd_docs).collect()
    assert len(got) == len(odd_rows)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[4]["class_id"] == by_id[5]["class_id"] == by_id[6]["class_id"] == 4
    assert by_id[9]["class_id"] == by_id[10]["class_id"] == 9
    assert by_id[1]["class_size"] == by_id[2]["class_size"] == by_id[7]["class_size"] == 1


def test_dart_signatures_estimate_weighted_similarity():
    chance = np.random.default_rng(2)
    pool = chance.integers(1, 1 << 63, 900, dtype=np.uint64)
    a = np.concatenate([pool[:600], pool[:200]])  # weights of two
    b = np.concatenate([pool[100:700], pool[100:300]])
    left, right = minhash.strips(a), minhash.strips(b)
    truth = len(np.intersect1d(left, right)) / len(np.union1d(left, right))
    agree = np.mean([(minhash.signatures([left, right], 500, seed=s)[0] == minhash.signatures([left, right], 500, seed=s)[1]).mean() for s in range(4)])
    assert abs(agree - truth) < 0.04
    assert (minhash.signatures([pool[:1]], 125) != 0).all()


def brute_removed(rows):
    first = {}
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        data = (t or "").encode()
        for k in range(len(data) - 49):
            first.setdefault(data[k : k + 50], i)
    out = []
    for i, t in rows:
        data = (t or "").encode()
        gone = bytearray(len(data))
        for k in range(len(data) - 49):
            least = first[data[k : k + 50]]
            if least is not None and (i is None or least < i):
                gone[k : k + 50] = b"\1" * 50
        kept = bytes(x for x, g in zip(data, gone, strict=True) if not g)
        runs = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((i, len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


REMOVED = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@pytest.mark.parametrize("hot", [0, 300, repeats.HOT])
def test_repeats_equal_brute_force(spark, hot):
    chance = random.Random(8)
    shared = ["".join(chance.choices("abcd é\n", k=chance.randint(30, 160))) for _ in range(6)] + ["ab" * 60, "a" * 90]
    rows = []
    for i in range(60):
        text = "".join(chance.choice(shared) if chance.random() < 0.5 else "".join(chance.choices("abcdé ", k=chance.randint(0, 90))) for _ in range(5))
        rows.append((chance.randrange(50), text))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = repeats.remove_repeats(docs, hot=hot).select(*REMOVED, "kept").collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == brute_removed(rows)
    assert all(hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] for r in got)


def test_windows_of_a_common_passage_are_dealt():
    chance = random.Random(3)
    passage = chance.randbytes(120)
    texts = [chance.randbytes(80) + passage + chance.randbytes(80) for _ in range(40)]
    batches = [texts[:20], texts[20:]]
    frames = [
        pd.DataFrame({
            "batch": [n], "ids": [np.arange(20) + 20 * n], "lens": [np.array([len(t) for t in own])],
            "blob": [batched.compress(np.frombuffer(b"".join(own), np.uint8))],
        })
        for n, own in enumerate(batches)
    ]
    asked = pd.concat(repeats._ask_triggers(8)(iter(frames)))
    parts = [g for _, g in asked.groupby("bucket")]
    for hot, largest in ((10**9, False), (100, True)):
        told = pd.concat([repeats._shared_triggers(hot)(g) for g in parts])
        for frame in frames:
            frame["answers"] = [told[told["batch"] == frame["batch"][0]].to_dict("records")]
        out = pd.concat(repeats._ask_phrases(8)(iter(frames)))
        sizes = [np.concatenate([batched.expand(b, np.int32) for b in g["sizes"]]) for _, g in out.groupby("bucket")]
        windows = [int((x - repeats.LENGTH + 1).sum()) for x in sizes]
        assert sum(windows) >= 2 * (120 - repeats.LENGTH + 1)
        # edge windows differ in every text: by trigger they share few buckets, by bytes all of them
        assert (len(windows) == 8 and max(windows) < 0.3 * sum(windows)) == largest


def test_repeats_of_odd_documents(odd_docs, odd_rows):
    rows = [(i, t) for i, t in odd_rows if len(t or "") < 10_000]
    docs = odd_docs.where("length(coalesce(text, '')) < 10000")
    got = repeats.remove_repeats(docs, keep_text=False).select(*REMOVED).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_removed(rows)
    assert repeats.remove_repeats(odd_docs).where("doc_id = 10").first()["n_removed"] > 100_000


def check_shards(rows, n_shards):
    counts = Counter(r["shard"] for r in rows)
    assert set(counts) <= set(range(n_shards))
    sizes = [counts.get(s, 0) for s in range(n_shards)]
    assert max(sizes) - min(sizes) <= 1
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_shards_are_even_and_keep_small_groups_together(spark):
    rows = [(i, f"text {i // 3 if i < 300 else i}") for i in range(1600)]
    got = shards.shard_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    check_shards(got, 16)
    where = defaultdict(set)
    for r in got:
        if r["doc_id"] < 300:
            where[r["doc_id"] // 3].add(r["shard"])
    assert sum(len(x) == 1 for x in where.values()) >= 80


def test_a_group_of_half_the_rows_is_spread(spark):
    rows = [(i, "same" if i % 2 else f"text {i}") for i in range(800)]
    check_shards(shards.shard_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect(), 16)


def test_shards_of_odd_documents(odd_docs, odd_rows):
    got = shards.shard_documents(odd_docs).collect()
    assert len(got) == len(odd_rows)
    check_shards(got, 16)
    assert {r["size"] for r in got if r["doc_id"] in (1, 2)} == {1}


def test_no_documents(no_docs):
    assert exact.exact_groups(no_docs).count() == 0
    assert exact.drop_copies(no_docs).count() == 0
    assert minhash.near_classes(no_docs).count() == 0
    assert minhash.drop_near_copies(no_docs).count() == 0
    assert repeats.remove_repeats(no_docs).count() == 0
    assert shards.shard_documents(no_docs).count() == 0
