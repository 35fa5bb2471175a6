"""Quality classifier: regularised quadratic discriminant analysis of document statistics.

Every text becomes a vector of transformed statistics (log lengths and log shares of byte
classes, of distinct words and of distinct lines). Class means and covariances come from
mergeable sums over all labelled training rows; covariances are shrunk towards the
pooled one and towards its mean variance. The driver keeps one Cholesky factor a class,
and a score is the difference of the classes' log densities (Mahalanobis distances by
triangular factors) plus the log prior ratio, through the logistic function. Labels,
language, source and id are no inputs.

Defined results: a null text is an empty text, and both get a score; a null or other label
than 0 and 1 is no label; a doc_id with several labels counts once for each; with no
training rows of one class the score is the other class, with none at all 0.5; an empty
table gives an empty result; further columns are ignored.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from rookery.plans.scratch import Scratch

THRESHOLD, FOLDS, SHRINK, RIDGE = 0.3, 5, 0.3, 0.1
FLOOR = 3e-3  # a share this small counts as none

_CLASSES = np.zeros((256, 9))
for _name, _bytes in enumerate(
    (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n", b".,;:", b"!?", b"|/\\_=<>[]{}~^`", b"#$%&*@+")
):
    _CLASSES[list(_bytes), _name] = 1
_CLASSES[128:, 8] = 1
N_FEATURES = 9 + 6


def features(texts: list[str]) -> np.ndarray:
    """One row of transformed statistics for each text."""
    histograms = np.zeros((len(texts), 256))
    rest = np.zeros((len(texts), 5))
    for i, text in enumerate(texts):
        data = text.encode("utf-8", "replace")
        histograms[i] = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
        words, lines = data.split(), data.split(b"\n")
        rest[i] = len(data), len(words), len(set(words)), len(lines), len(set(lines))
    size, words, distinct, lines, distinct_lines = rest.T
    shares = histograms @ _CLASSES / np.maximum(size, 1)[:, None]
    upper_words = shares[:, 0] * size / np.maximum(words, 1)
    return np.column_stack([
        np.log(shares + FLOOR), np.log1p(size), np.log1p(words), np.log(size / np.maximum(words, 1) + 1),
        np.log(distinct / np.maximum(words, 1) + 0.02), np.log(distinct_lines / np.maximum(lines, 1) + 0.02),
        np.log(upper_words + 0.05),
    ])


def _described(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        texts = [t or "" for t in frame["text"]]
        yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "x": list(features(texts))})


def described(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInPandas(
        _described, "doc_id long, x array<double>"
    )


def held_out(doc_id: Column, folds: int = FOLDS) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def _sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Count, sums and products of each class in a partition."""
    total: dict[int, np.ndarray] = {}
    for frame in frames:
        for label, rows in frame.groupby("label"):
            x = np.column_stack([np.ones(len(rows)), np.stack(rows["x"].to_numpy())])
            total[int(label)] = total.get(int(label), 0) + x.T @ x
    if total:
        yield pd.DataFrame({"label": list(total), "products": [m.ravel() for m in total.values()]})


@dataclass
class Discriminant:
    """Class means and inverse Cholesky factors; ``constant`` decides when a class is missing."""

    means: np.ndarray
    factors: np.ndarray
    offsets: np.ndarray
    constant: float | None = None

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        density = []
        for mean, factor, offset in zip(self.means, self.factors, self.offsets, strict=True):
            z = (x - mean) @ factor.T
            density.append(offset - 0.5 * (z * z).sum(axis=1))
        return 1 / (1 + np.exp(np.clip(density[0] - density[1], -500, 500)))


def discriminant(products: dict[int, np.ndarray], shrink: float = SHRINK, ridge: float = RIDGE) -> Discriminant:
    """From the (1, x)-products of both classes."""
    present = [c for c in (0, 1) if c in products and products[c][0, 0] > 0]
    if len(present) < 2:
        return Discriminant(np.empty(0), np.empty(0), np.empty(0), float(present[0]) if present else 0.5)
    counts = np.array([products[c][0, 0] for c in (0, 1)])
    means = np.stack([products[c][0, 1:] / products[c][0, 0] for c in (0, 1)])
    covs = np.stack([products[c][1:, 1:] / products[c][0, 0] - np.outer(m, m) for c, m in zip((0, 1), means, strict=True)])
    pooled = np.tensordot(counts / counts.sum(), covs, axes=1)
    scale = np.diag(np.diag(pooled) + 1e-9)
    factors, offsets = [], []
    for c in (0, 1):
        cov = (1 - shrink - ridge) * covs[c] + shrink * pooled + ridge * scale
        lower = np.linalg.cholesky(cov)
        factors.append(np.linalg.inv(lower))
        offsets.append(np.log(counts[c] / counts.sum()) - np.log(np.diag(lower)).sum())
    return Discriminant(means, np.stack(factors), np.array(offsets))


def fit(described_docs: DataFrame, labels: DataFrame) -> Discriminant:
    """From every labelled row; what reaches the driver has a fixed size."""
    labels = labels.select(F.col("doc_id").alias("labelled"), F.col("quality").cast("int").alias("label")).where("label in (0, 1)")
    rows = described_docs.join(labels, F.col("doc_id") == F.col("labelled")).select("label", "x")
    parts = rows.mapInPandas(_sums, "label int, products array<double>")
    cells = parts.select("label", F.posexplode("products").alias("at", "value"))
    sums = cells.groupBy("label", "at").agg(F.sum("value").alias("value")).collect()  # 2 x (1 + N_FEATURES) squared
    width = N_FEATURES + 1
    products: dict[int, np.ndarray] = {}
    for r in sums:
        products.setdefault(r["label"], np.zeros(width * width))[r["at"]] = r["value"]
    return discriminant({c: m.reshape(width, width) for c, m in products.items()})


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every document; held-out rows are not learned from."""
    scratch = Scratch(docs.sparkSession, "quality")
    rows = scratch.save(described(docs), "features")
    model = fit(rows.where(~held_out(F.col("doc_id"))), labels)

    def scored(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "score": model.score(np.stack(frame["x"].to_numpy()))})

    scores = rows.mapInPandas(scored, "doc_id long, score double")
    return scores.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents predicted to be good, with the columns they came with.

    The model is fitted on the documents' statistics and applied to the texts as they
    pass, so no text moves.
    """
    scratch = Scratch(docs.sparkSession, "quality_kept")
    rows = scratch.save(described(docs), "features")
    model = fit(rows.where(~held_out(F.col("doc_id"))), labels)

    @F.pandas_udf("boolean")
    def good(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(features([t or "" for t in texts])) >= threshold)

    return docs.where(good(F.coalesce(docs["text"], F.lit(""))))
