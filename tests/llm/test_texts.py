"""Decontamination, packing, chat, language model, quality and personal data against plain Python."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from rookery.llm import batched, chat, decontaminate, lm, packing, pii, quality, queries

FOLDER = "/root/testdata/sf0.001"


# decontamination
def shingles(words):
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute_leaks(docs, items):
    found = set()
    for item, text in items:
        words = re.findall(r"[^\W_]+", (text or "").lower())
        if len(words) < 5:
            continue
        cut = decontaminate.question_words(text)
        runs = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        question = set(runs[: max(0, cut - 4)]) or set(runs)
        answer = set(runs[max(0, cut - 4) :]) if cut > 4 else set()
        for doc, body in docs:
            own = shingles(re.findall(r"[^\W_]+", (body or "").lower()))
            if len(question & own) / len(question) >= 0.8 and (not answer or len(answer & own) / len(answer) >= 0.8):
                found.add((doc, item))
    return found


@pytest.mark.parametrize("shard_bytes", [500, 1 << 23])
def test_leaks_equal_brute_force(spark, shard_bytes):
    chance = random.Random(5)
    words = [f"v{i}" for i in range(150)]

    def sentence(n):
        return " ".join(chance.choices(words, k=n)) + "."

    items = [(i, sentence(chance.randint(4, 30)) + " " + sentence(chance.randint(1, 12))) for i in range(12)]
    items += [(12, sentence(200) + " " + sentence(9)), (13, "too short"), (14, None), (12, ""), (15, sentence(20))]
    docs = []
    for i in range(60):
        text = sentence(chance.randint(0, 150))
        if chance.random() < 0.6:
            leak = chance.choice(items)[1] or ""
            if leak and chance.random() < 0.4:
                parts = leak.split()
                parts[chance.randrange(max(1, len(parts)))] = "changed"
                leak = " ".join(parts)
            text += " " + leak.upper() + " " + sentence(chance.randint(0, 90))
        docs.append((i, text))
    docs.append((None, items[0][1]))
    got = decontaminate.contaminated(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"),
        shard_bytes=shard_bytes,
    )
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == brute_leaks(docs, items)


def test_pruning_loses_no_unit():
    """All units above the threshold, against scores without any pruning."""
    chance = random.Random(1)
    words = [f"v{i}" for i in range(60)]
    items = [(i, " ".join(chance.choices(words, k=chance.randint(5, 150)))) for i in range(40)]
    index = decontaminate.build_index(items, lambda t: np.full(len(t), 3.0), 40, 50.0)
    texts = [" ".join(chance.choices(words, k=chance.randint(0, 400))) for _ in range(30)]
    hashes, bounds = decontaminate.word_hashes(texts)
    got = {(int(t), int(u)) for t, u, _ in zip(*decontaminate.retrieve(index, hashes, bounds, 0.5), strict=True)}
    want = set()
    for t, (a, b) in enumerate(itertools.pairwise(bounds)):
        for k in range((b - a) // decontaminate.UNIT + 1):
            window = hashes[a + k * decontaminate.UNIT : min(b, a + (k + 2) * decontaminate.UNIT)]
            score = Counter()
            for term in np.unique(window):
                at = np.searchsorted(index.terms, term)
                if at < len(index.terms) and index.terms[at] == term:
                    for e in range(index.block_ptr[at], index.block_ptr[at + 1]):
                        for p in range(index.post_ptr[e], index.post_ptr[e + 1]):
                            score[int(index.post_unit[p])] += index.post_weight[p]
            want |= {(t, u) for u, s in score.items() if s >= 0.5 - 1e-9}
    assert got == want and want


def test_decontamination_of_odd_tables(spark, odd_docs, odd_rows, no_docs):
    items = spark.createDataFrame([(1, odd_rows[3][1]), (None, "a b c d e f g"), (2, None)], "item_id long, text string")
    hit = {4, 5, 6, None, 15, 13}  # 13 holds all distinct shingles of the repeated sentence
    assert {r["doc_id"] for r in decontaminate.contaminated(odd_docs, items).collect()} == hit
    assert decontaminate.contaminated(no_docs, items).count() == 0
    assert decontaminate.contaminated(odd_docs, items.limit(0)).count() == 0
    kept = decontaminate.drop_contaminated(odd_docs, items)
    assert kept.columns == odd_docs.columns and 1 in {r["doc_id"] for r in kept.collect()}


# packing
def brute_padding(lengths, counts, k):
    order = sorted(zip(lengths, counts, strict=True))
    best = math.inf
    for m in range(1, min(k, len(order)) + 1):
        for cut in itertools.combinations(range(len(order) - 1), m - 1):
            bounds = [order[i][0] for i in cut] + [order[-1][0]]
            best = min(best, sum((next(b for b in bounds if b >= n) - n) * c for n, c in order))
    return best


def test_bounds_have_the_least_padding():
    chance = random.Random(3)
    for _ in range(40):
        lengths = sorted(chance.sample(range(1, 60), chance.randint(1, 9)))
        counts = [chance.randint(1, 20) for _ in lengths]
        k = chance.randint(1, 5)
        bounds = packing.optimal_bounds(lengths, counts, k)
        assert len(bounds) <= k and bounds[-1] == lengths[-1]
        padding = sum((next(b for b in bounds if b >= n) - n) * c for n, c in zip(lengths, counts, strict=True))
        assert padding == brute_padding(lengths, counts, k)
    assert packing.optimal_bounds([], [], 4) == []


def test_packing_keeps_every_token(odd_docs, odd_rows, no_docs):
    rows = packing.pack(odd_docs, max_len=100, n_buckets=4, budget=400).collect()
    want = Counter()
    for i, t in odd_rows:
        want[i] += len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) + 1
    got = Counter()
    for r in rows:
        got[r["doc_id"]] += r["n_tokens"]
        assert r["n_tokens"] + r["padding"] == r["bucket_len"] and 0 <= r["padding"]
        assert r["start"] == r["piece"] * 100
    assert got == want
    places = defaultdict(list)
    for r in rows:
        places[r["bucket"], r["batch"]].append(r["slot"])
    for (bucket, _), slots in places.items():
        length = next(r["bucket_len"] for r in rows if r["bucket"] == bucket)
        assert sorted(slots) == list(range(len(slots))) and len(slots) * length <= 400
    assert packing.pack(no_docs).count() == 0


@pytest.mark.parametrize("max_len", [1, 3, 100])
def test_pieces_join_to_the_text(spark, max_len):
    chance = random.Random(2)
    texts = ["", "  ", " a", "a b c ", "\n one\ttwo  three\x0bfour é\u00a0x ", "w" * 50]
    texts += ["".join(chance.choices("ab \n", k=chance.randint(0, 400))) for _ in range(20)]
    docs = spark.createDataFrame([*enumerate(texts), (99, None)], "doc_id long, text string")
    found = defaultdict(list)
    for r in packing.pack(docs, max_len=max_len).collect():
        found[r["doc_id"]].append((r["piece"], r["n_tokens"], r["text"]))
    for i, text in [*enumerate(texts), (99, "")]:
        pieces = sorted(found[i])
        assert "".join(t for _, _, t in pieces) == text
        assert [p for p, _, _ in pieces] == list(range(len(pieces)))
        own = [len(re.findall(r"[^\x20\x09-\x0D]+", t)) for _, _, t in pieces]
        assert [n for _, n, _ in pieces] == [*own[:-1], own[-1] + 1]


# chat
def test_escaping_is_reversible_and_leaves_no_control_string():
    chance = random.Random(9)
    atoms = [*chat.CONTROLS, "\\", "<", "[", "s>", "INST]", "a", "é", "\n", "|", "/"]
    for _ in range(3000):
        text = "".join(chance.choices(atoms, k=chance.randint(0, 12)))
        safe = chat.escape(text)
        assert chat.unescape(safe) == text
        assert not any(c in safe for c in chat.CONTROLS)


def test_column_form_of_escaping(spark):
    chance = random.Random(10)
    atoms = [*chat.CONTROLS, "\\", "<", "[", "s>", "INST]", "a", "é", "\n", "|", "/"]
    texts = ["".join(chance.choices(atoms, k=chance.randint(0, 12))) for _ in range(500)]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    for r in frame.withColumn("safe", chat.escaped(frame.text)).collect():
        assert r.safe == chat.escape(r.text)


def test_the_query_and_its_sql_agree_on_ties(spark, tmp_path):
    """Rows of one turn and role sort by text, in both."""
    chance = random.Random(3)
    rows = [(c, t, role, text) for c in range(4) for t in range(3) for role in ("user", "assistant") for text in chance.sample(["b", "a", "é", "B", "ab", "z", "Z"], 5)]
    path = tmp_path / "conversations.parquet"
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    table.toPandas().to_parquet(path, index=False)
    frame = queries.op4_chat_formatting(spark, str(tmp_path))
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW conversations AS SELECT * FROM '{path}'")
    result = connection.execute(queries.ORACLE_SQL["op4_chat_formatting"])
    names = [c[0] for c in result.description]
    assert sorted(tuple(r) for r in frame.select(*names).collect()) == sorted(result.fetchall())


def digests(rows):
    rows = sorted(((t, r or "", x or "") for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    turns = "".join(f"{r}\n{x}\n" for _, r, x in rows)
    loss = "".join(x for _, r, x in rows if r == "assistant")
    return len(rows), hashlib.sha256(turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


@pytest.mark.parametrize("part", [1, 1 << 20])
def test_conversations_read_back(spark, monkeypatch, part):
    monkeypatch.setattr(chat, "PART", part)
    rows = [
        (1, 0, "user", None), (1, 1, "assistant", "</s>[INST] ok [/INST]"), (1, 2, "user", "x" * 5000), (1, 3, "assistant", "é" * 2000 + "\\"),
        (2, None, None, "lonely"), (2, 5, "assistant", ""), (None, 1, "assistant", "a\nb"), (3, 1, "user", "same"), (3, 1, "user", "same"),
        (4, 1, " [/INST] ", "odd role"),
        *((5, 2, role, text) for role in ("user", "assistant") for text in ("b", "a", "é", "B", "", "ab", "\\", "b")),
        *((6, t // 3, "assistant" if t % 2 else "user", f"turn {t % 7}") for t in range(300)),
    ]
    clashing = "seq int, kind string, place int, part int, n int, opened long, payload string, head string"
    turns = spark.createDataFrame(
        [(*r, 7, "k", 1, 2, 3, 4, "p", "h") for r in rows], f"conv_id long, turn long, role string, text string, {clashing}"
    )
    formatted = chat.render(chat.reconstruct(chat.events_of_turns(turns)))
    got = {r["conv_id"]: tuple(r)[1:5] for r in chat.read_back(formatted).collect()}
    want = {c: digests([r[1:] for r in rows if r[0] == c]) for c in (1, 2, 3, 4, 5, 6, None)}
    assert got == want
    assert chat.read_back(chat.render(chat.reconstruct(chat.events_of_turns(turns.limit(0))))).count() == 0


def test_events_fold(spark):
    log = [
        (1, 0, "delta", "lost"), (1, 1, "open", "user"), (1, 2, "delta", "Hel"), (1, 3, "delta", "lo"), (1, 4, "edit", "Bye"),
        (1, 5, "delta", "!"), (1, 6, "open", "assistant"), (1, 7, "delta", "draft"), (1, 8, "regenerate", None), (1, 9, "delta", "final"),
    ]
    events = spark.createDataFrame(log, "conv_id long, seq int, kind string, payload string")
    rows = sorted(chat.reconstruct(events, ("seq",)).collect(), key=lambda r: r["n"])
    assert [(r["role"], r["text"]) for r in rows] == [("user", "Bye!"), ("assistant", "final")]


# language model
def words_of(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower()) + [b""]


def check_base(rows, got):
    learned = [t for i, t in rows if i is None or zlib.crc32(str(i).encode()) % 5 != 1]
    counts = Counter(w for t in learned for w in words_of(t))
    total, distinct = sum(counts.values()), len(counts)
    want = Counter()
    for i, t in rows:
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in words_of(t))
        held = i is not None and zlib.crc32(str(i).encode()) % 5 == 1
        want[i, held, len(words_of(t)), sum(counts[w] > 0 for w in words_of(t)), total, round(base, 5)] += 1
    found = Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5)) for r in got)
    assert found == want


def test_base_scores_and_order_of_scores(spark):
    chance = random.Random(2)
    vocabulary = ["".join(chance.choices("abcdefgh", k=chance.randint(2, 7))) for _ in range(300)]
    rows = [(i, " ".join(chance.choices(vocabulary, k=80))) for i in range(400)] + [(1003, "qzx" * 130)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = lm.score_documents(docs).collect()
    check_base(rows, got)
    held = [r for r in got if r["held_out"] and r["doc_id"] < 400]
    assert all(r["score"] < 0 for r in got)
    assert np.mean([r["bits_per_byte"] for r in held]) < 3
    assert next(r for r in got if r["doc_id"] == 1003)["bits_per_byte"] > 3
    again = {r["doc_id"]: r["score"] for r in lm.score_documents(docs.repartition(1)).collect()}
    assert all(abs(r["score"] - again[r["doc_id"]]) < 1e-6 * abs(r["score"]) for r in got)


def test_model_scores_are_probabilities():
    """Over all texts of one bit path the probabilities of both bits sum to one."""
    chance = np.random.default_rng(0)
    inputs = chance.integers(-127, 127, (lm.PREDICTORS, 3000)).astype(np.int8)
    bits = chance.integers(0, 2, 3000).astype(np.int8)
    shorter = lm.mixed_bits(inputs[:, :-1], bits[:-1], np.array([0, 2999]))[0]
    ends = [lm.mixed_bits(inputs, np.concatenate([bits[:-1], [b]]).astype(np.int8), np.array([0, 3000]))[0] - shorter for b in (0, 1)]
    assert abs(2 ** -ends[0] + 2 ** -ends[1] - 1) < 1e-4


def test_documents_do_not_mix():
    chance = np.random.default_rng(1)
    inputs = chance.integers(-60, 60, (lm.PREDICTORS, 9000)).astype(np.int8)
    bits = chance.integers(0, 2, 9000).astype(np.int8)
    edges = np.array([0, 1, 4000, 4000, 4100, 9000])
    together = lm.mixed_bits(inputs, bits, edges)
    alone = [lm.mixed_bits(inputs[:, a:b], bits[a:b], np.array([0, b - a]))[0] for a, b in itertools.pairwise(edges)]
    assert np.allclose(together, alone, rtol=1e-6)


def test_lm_of_odd_documents(odd_docs, odd_rows, no_docs):
    check_base(odd_rows, lm.score_documents(odd_docs).collect())
    assert lm.score_documents(no_docs).count() == 0


def test_contexts_are_counted_apart_however_many_there_are():
    """Over 2^22 pairs of context and node: a node has odds where training has its context only."""
    chance = np.random.default_rng(3)
    learned, other = (chance.integers(32, 128, n, dtype=np.uint8).tobytes() for n in (1 << 20, 4000))
    tree = lm.forest(np.ones((lm.END, lm.END + 1), np.int64))
    own, asked = (lm.batch_keys(t, np.array([0, len(t)]), tree)[0][2] for t in (learned, other))
    keys = np.unique(np.concatenate([own, asked]))
    counts = np.searchsorted(np.sort(own), keys, "right") - np.searchsorted(np.sort(own), keys)
    length, odds = lm.path_odds(keys, counts, tree)
    assert length.sum() > 1 << 22
    at = (np.cumsum(length) - length)[np.searchsorted(keys, asked)]
    known = {learned[i - 6 : i] for i in range(6, len(learned) + 1)}
    assert [odds[i] != 0 for i in at[6:]] == [other[i - 6 : i] in known for i in range(6, len(other) + 1)]


def test_odds_of_a_path_are_those_of_its_context():
    """Answers of buckets against counts in plain Python."""
    texts = [b"abracadabra", b"abrab", b"", b"cadabrax"]
    pairs = np.zeros((lm.END, lm.END + 1), np.int64)
    tree = lm.forest(pairs)
    first, bits = tree[:2]
    counted = Counter()
    paths = [[(t[max(0, i - 2) : i].rjust(2, b"\0"), t[i] if i < len(t) else lm.END) for i in range(len(t) + 1)] for t in texts]
    for before, symbol in itertools.chain(*paths):
        code = bits[slice(*first[before[-1] * 257 + symbol : before[-1] * 257 + symbol + 2])].tolist()
        counted.update((before, *code[:d], "=", code[d]) for d in range(len(code)))
    data, bounds = b"".join(texts), np.cumsum([0] + [len(t) for t in texts])
    n_buckets, told = 3, {}
    all_keys = [np.unique(k, return_counts=True) for k in lm.batch_keys(data, bounds, tree)[0]]
    keys, counts = (np.concatenate(x) for x in zip(*all_keys, strict=True))
    for k, (x, n) in batched.by_bucket(lm._bucket(keys, n_buckets), keys, counts):
        told[k] = batched.compress(lm.path_odds(x, n, tree)[1])
    ((_, _, inputs, _, _),) = lm.batch_inputs(data, bounds, tree, told, n_buckets)
    want = []
    for before, symbol in itertools.chain(*paths):
        code = bits[slice(*first[before[-1] * 257 + symbol : before[-1] * 257 + symbol + 2])].tolist()
        for d in range(len(code)):
            zeros, ones = (counted[(before, *code[:d], "=", b)] for b in (0, 1))
            odds = math.log((ones + 0.1) / (zeros + 0.1)) * lm.UNIT
            want.append(max(-127, min(127, round(odds) if abs(odds) >= 1 else -1 if odds < 0 else 1)))
    assert inputs[0].tolist() == want


def test_huffman_paths_are_a_prefix_code():
    first, nodes, bits = lm.huffman(np.array([5, 1, 1, 0, 9]))
    codes = [tuple(bits[first[s] : first[s + 1]].tolist()) for s in range(5)]
    assert sum(2.0 ** -len(c) for c in codes) == 1 and len(set(codes)) == 5
    assert all(nodes[first[s]] == 0 for s in range(5))


# quality
def test_quality_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    scores = {r["doc_id"]: r for r in quality.score_quality(docs, labels).collect()}
    held = [(r["quality"], scores[r["doc_id"]]) for r in labels.collect() if scores[r["doc_id"]]["held_out"]]
    assert all(s["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0) for d, s in scores.items())
    assert np.mean([q == s["predicted"] for q, s in held]) > 0.95
    assert docs.count() == len(scores)


def test_quality_of_odd_tables(spark, odd_docs, odd_rows, no_docs):
    labels = spark.createDataFrame([(4, 1, 3), (None, 0, 3), (9, None, 3), (5, 7, 1)], "doc_id long, quality int, x int")
    for some, want in ((labels, 1.0), (labels.where("quality = 0"), 0.5)):
        got = quality.score_quality(odd_docs, some).collect()
        assert len(got) == len(odd_rows) and {r["score"] for r in got} == {want}
    assert quality.score_quality(no_docs, labels).count() == 0
    assert quality.keep_good(odd_docs, labels).columns == odd_docs.columns


# personal data
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_spans(text):
    found = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 12 <= len(digits) <= 19 and pii.luhn(digits), "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                found.append((kind, m.start(), m.end()))
    return sorted(found, key=lambda s: (s[1], list(PATTERNS).index(s[0])))


def test_plain_spans_equal_the_patterns():
    chance = random.Random(3)
    for _ in range(20_000):
        text = "".join(chance.choice("aB1.2@3-+ %0() \n4é") for _ in range(chance.randint(0, 40)))
        base, spans = pii.find_spans(text)
        assert base == brute_spans(text) and set(base) <= set(spans)


@pytest.mark.parametrize(
    ("text", "kind", "part"),
    [
        ("write to john.doe at example dot com now", "email", "john.doe at example dot com"),
        ("or joe[at]mail.example.com.", "email", "joe[at]mail.example.com"),
        ("jоhn@exаmple.com", "email", "jоhn@exаmple.com"),
        ("ip １９２.１６８.０.１ x", "ip", "１９２.１６８.０.１"),
        ("ip one nine two dot one six eight dot one dot two", "ip", "one nine two dot one six eight dot one dot two"),
        ("call plus four nine one seven one two three four five six", "phone", "plus four nine one seven one two three four five six"),
        ("card 4111-1111​-1111-1111", "card", "4111-1111​-1111-1111"),
        ("four one one one one one one one one one one one one one one one", "card", "four" + " one" * 15),
    ],
)
def test_disguised_spans_map_back(text, kind, part):
    base, spans = pii.find_spans(text)
    assert [(k, text[a:b]) for k, a, b in spans if (k, a, b) not in base] == [(kind, part)] or (
        [(k, text[a:b]) for k, a, b in spans] == [(kind, part)]
    )


@pytest.mark.parametrize("n", [1, 30, 400])
def test_long_disguised_addresses_are_whole(n):
    local = " dot ".join(["john"] * n)
    for at, dot in ((" at ", " dot "), (" [at] ", " (dot) "), ("(at)", "[dot]")):
        part = local + at + dot.join(["mail"] * n + ["com"])
        text = f"Write to: {part}, please."
        assert pii.find_spans(text) == ([], [("email", 10, 10 + len(part))]), (n, at)


def test_many_spans_in_one_text():
    one = "joe at example dot com; a.b@c.de, "
    base, spans = pii.find_spans(one * 20_000)
    assert len(base) == 20_000 and len(spans) == 40_000
    assert spans[:2] == [("email", 0, 22), ("email", 24, 32)]
    assert spans[-1] == ("email", 19_999 * len(one) + 24, 19_999 * len(one) + 32)


def test_prose_has_no_spans():
    for text in ("Meet me at noon. The dot is small.", "one two three", "at the end", "He looked at it. Com", "", "3.14 at 5"):
        assert pii.find_spans(text) == ([], [])


def test_personal_data_of_odd_documents(odd_docs, odd_rows, no_docs):
    got = pii.personal_data(odd_docs).collect()
    assert len(got) == len(odd_rows)
    row = next(r for r in got if r["doc_id"] == -5)
    assert (row["n_email"], row["n_phone"]) == (1, 1) and row["spans"] == "email:5:13,phone:17:32"
    assert pii.personal_data(no_docs).count() == 0


# the pipeline
@pytest.mark.skipif(corpus_pipeline.ORACLE_SQL is not None, reason="has SQL")
def test_pipeline_equals_its_stages_in_plain_python(spark):
    from tests.llm.test_dedup import brute_classes, lowered

    folder = FOLDER
    docs, labels, items = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels", "benchmark"))
    good = {r["doc_id"] for r in quality.score_quality(docs, labels).where("predicted = 1").collect()}
    rows = [(r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] in good]
    last = {}
    for i, t in rows:
        last[lowered(t)] = max(i, last.get(lowered(t), i))
    rows = [(i, t) for i, t in rows if last[lowered(t)] == i]
    stay = {c[0] if len(c) == 1 else min(c) for c in brute_classes(rows)}
    rows = [(i, t) for i, t in rows if i in stay]
    leaked = {d for d, _ in brute_leaks(rows, [(r["item_id"], r["text"]) for r in items.collect()])}
    want = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) + 1 for i, t in rows if i not in leaked}
    got = Counter()
    for r in corpus_pipeline.run(spark, folder).collect():
        got[r["doc_id"]] += r["n_tokens"]
    assert got == want
