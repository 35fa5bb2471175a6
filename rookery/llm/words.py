"""Hashes of words and word shingles of many texts at once, in numpy.

A word is a run of letters, digits and non-ASCII characters of the lower-cased text.
Word hashes are sums of per-byte random values times per-offset odd multipliers, mixed
with the length; shingles hash the words in order. All hashes have 64 bits.
"""

import numpy as np

GOLD = np.uint64(0x9E3779B97F4A7C15)
_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_STEP = _rng.integers(1, 1 << 63, 4096, dtype=np.uint64) | np.uint64(1)
_ORDER = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
_WORD = np.zeros(256, np.bool_)
_WORD[128:] = True
for _span in (b"09", b"az", b"AZ"):
    _WORD[_span[0] : _span[1] + 1] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def run_hashes(data: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, starts and ends of the maximal runs of bytes that are ``inside``."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).view(np.int8)))
    starts, ends = edge[0::2], edge[1::2]
    if not len(starts):
        return np.empty(0, np.uint64), starts, ends
    lengths = ends - starts
    at = np.flatnonzero(inside)
    first = np.cumsum(lengths) - lengths
    offset = np.arange(len(at)) - np.repeat(first, lengths)
    values = _BYTE[data[at]] * _STEP[offset & 4095]
    return mix(np.add.reduceat(values, first) + lengths.astype(np.uint64) * GOLD), starts, ends


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and where each text's words start (one more entry than texts)."""
    parts = [t.lower().encode("utf-8", "replace") for t in texts]
    sizes = np.fromiter((len(p) + 1 for p in parts), np.int64, len(parts))
    starts_of_texts = np.concatenate([[0], np.cumsum(sizes)])
    data = np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)
    if not parts:
        return np.empty(0, np.uint64), np.zeros(1, np.int64)
    hashes, starts, _ = run_hashes(data, _WORD[data])
    return hashes, np.searchsorted(starts, starts_of_texts)


def shingle_hashes(words: np.ndarray, bounds: np.ndarray, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` words in each text, with bounds; a shorter text is one run."""
    counts = np.diff(bounds)
    per_text = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    out = np.concatenate([[0], np.cumsum(per_text)])
    if not len(words):
        return np.empty(0, np.uint64), out
    padded = np.concatenate([words, np.zeros(n, np.uint64)])
    left = np.repeat(bounds[1:], counts) - np.arange(len(words))  # words up to the text's end
    total = np.zeros(len(words), np.uint64)
    for k in range(n):
        total += np.where(left > k, padded[k : k + len(words)], np.uint64(0)) * _ORDER[k]
    total = mix(total + np.minimum(left, n).astype(np.uint64))
    position = np.arange(len(words)) - np.repeat(bounds[:-1], counts)
    return total[position < np.repeat(per_text, counts)], out


def batches(texts, ids, limit: int = 1 << 21):
    """Lists of (ids, texts) of about ``limit`` characters each."""
    some_ids, some, size = [], [], 0
    for i, t in zip(ids, texts, strict=True):
        t = t or ""
        some_ids.append(i)
        some.append(t)
        size += len(t) + 64
        if size >= limit:
            yield some_ids, some
            some_ids, some, size = [], [], 0
    if some:
        yield some_ids, some
