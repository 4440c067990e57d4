"""Quality classifier learned from positive and unlabelled texts."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rules import text_stats
from .substring import RollingHash, WordHashes, split_words

# Bounds of the samples that the classifier is fitted on.
POSITIVES = 6_000
UNLABELLED = 12_000
BINS = 12
STEPS = 200
RATE = 0.1
DECAY = 1e-4


def char_kinds(text: str) -> tuple[int, int, int]:
    """Numbers of capitals, digits and letters."""
    times = np.bincount(np.frombuffer(text.encode("utf-32-le"), np.uint32))
    upper = digits = letters = 0
    for code in np.flatnonzero(times).tolist():
        kind, count = unicodedata.category(chr(code)), int(times[code])
        upper += count if kind == "Lu" else 0
        digits += count if kind == "Nd" else 0
        letters += count if kind[0] == "L" else 0
    return upper, digits, letters


def held_out(doc_id: str = "doc_id") -> Column:
    """A third of the documents, by a checksum of their ids. Rows without id are not in it."""
    remainder = F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3
    return F.coalesce(remainder == 1, F.lit(False))


def features(text: str | None, hashed: WordHashes, rolling: RollingHash) -> list[float]:
    """Numbers that describe how a whole text is written; its words themselves play no part."""
    text = text or ""
    n, chars, symbols, dup, repeat, lines = text_stats(text, hashed, rolling)
    words = split_words(text)
    least, size = max(1, n), max(1, chars)
    upper, digits, letters = char_kinds(text)
    return [
        np.log1p(n),
        chars / least,
        symbols / least,
        dup / max(1, lines),
        repeat / least,
        len(set(words)) / least,
        sum(a == b for a, b in zip(words, words[1:])) / least,
        upper / size,
        digits / size,
        (chars - letters - digits) / size,
        max(map(len, words), default=0) / size,
    ]


def featured(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and ``x``, the features of ``text``."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed, rolling = WordHashes(), RollingHash(5)
        for part in parts:
            found = [features(text.as_py(), hashed, rolling) for text in part.column("text")]
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in keep), pa.array(found, pa.list_(pa.float64()))],
                [*keep, "x"],
            )

    kinds = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep)
    return docs.select(*keep, "text").mapInArrow(run, kinds + "x array<double>")


@dataclass
class Model:
    """A sum of one step function per feature, and a constant."""

    edges: np.ndarray
    weights: np.ndarray
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        margin = (design(x, self.edges) @ self.weights).astype(np.float64)
        return 1 / (1 + np.exp(-np.clip(margin, -40, 40)))


def design(x: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """0/1 columns: is each feature above each of its edges; and a column of ones."""
    above = x[:, :, None] > edges[None, :, :]
    return np.hstack([above.reshape(len(x), -1), np.ones((len(x), 1))]).astype(np.float32)


def _descend(gradient, size: int, steps: int = STEPS) -> np.ndarray:
    """Adam: full-batch steps, with the gradient of the whole sample."""
    w, m, v = (np.zeros(size, np.float32) for _ in range(3))
    for t in range(1, steps + 1):
        g = gradient(w) + DECAY * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def class_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives among the unlabelled, from scores of samples not fitted on.

    Among the highest scores nearly all are positive, so there the ratio of the two tails is the
    share. The cut is the one whose ratio, with its sampling error, is least.
    """
    cuts = np.quantile(positive, np.linspace(0.02, 0.98, 97))
    p = (positive[None, :] >= cuts[:, None]).mean(axis=1)
    u = (unlabelled[None, :] >= cuts[:, None]).mean(axis=1)
    error = np.sqrt(1 / len(positive)) + np.sqrt(1 / len(unlabelled))
    bound = u / np.maximum(p, 1e-9) + error / np.maximum(p, 1e-9)
    return float(np.clip((u / np.maximum(p, 1e-9))[int(np.argmin(bound))], 0.05, 0.99))


def fit(positive: np.ndarray, unlabelled: np.ndarray) -> Model:
    """Minimise the non-negative unbiased risk of positive and unlabelled samples.

    First positives are told from unlabelled ones on one half, which gives scores for the prior on
    the other. With the prior, the risk of negatives is what unlabelled texts cost as negatives
    less what the positives among them do; below zero it has been fitted too far, and its gradient
    is turned round.
    """
    both = np.vstack([positive, unlabelled])
    edges = np.quantile(both, np.linspace(0, 1, BINS + 1)[:-1], axis=0).T
    # Rare values beyond almost all others matter most here: edges in the tails as well.
    tails = np.quantile(both, [0.96, 0.98, 0.99, 0.995], axis=0).T
    edges = np.hstack([edges, tails])
    p, u = design(positive, edges), design(unlabelled, edges)

    def told_apart(w: np.ndarray) -> np.ndarray:
        a, b = p[::2], u[::2]
        return b.T @ _sigmoid(b @ w) / len(b) - a.T @ _sigmoid(-(a @ w)) / len(a)

    first = _descend(told_apart, p.shape[1], STEPS // 3)
    prior = class_prior(p[1::2] @ first, u[1::2] @ first)

    def gradient(w: np.ndarray) -> np.ndarray:
        zp, zu = p @ w, u @ w
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        down = u.T @ _sigmoid(zu) / len(u) - prior * (p.T @ _sigmoid(zp)) / len(p)
        if negative < 0:
            return -down
        return down - prior * (p.T @ _sigmoid(-zp)) / len(p)

    return Model(edges, _descend(gradient, p.shape[1]), prior)


def train(
    docs: DataFrame,
    labels: DataFrame,
    *,
    positives: int = POSITIVES,
    unlabelled: int = UNLABELLED,
) -> Model | None:
    """Fit on bounded samples of ``docs`` outside the held-out third; None without positives.

    Trusted positives are documents with ``quality`` 1, the unlabelled are any. Both samples are
    drawn by a hash of the id, ``positives`` and ``unlabelled`` documents at most; an id with
    several rows gives the one whose features are least. No other label is read.
    """
    learn = ~held_out() & F.col("doc_id").isNotNull()
    trusted = labels.filter((F.col("quality") == 1) & learn).select("doc_id").distinct()
    ids = docs.select("doc_id").filter(learn).distinct()
    drawn = [
        frame.orderBy(F.xxhash64(F.lit(seed), "doc_id")).limit(most).withColumn("p", F.lit(seed))
        for seed, most, frame in (
            (1, positives, trusted.join(ids, "doc_id", "left_semi")),
            (0, unlabelled, ids),
        )
    ]
    # At most ``positives + unlabelled`` ids.
    sample = F.broadcast(drawn[0].unionByName(drawn[1]))
    rows = featured(docs.select("doc_id", "text").join(sample, "doc_id"), ["doc_id", "p"])
    # One row for each id drawn, however often it occurs.
    rows = rows.groupBy("doc_id", "p").agg(F.min("x").alias("x")).collect()
    x = np.array([row["x"] for row in rows], np.float64)
    is_positive = np.array([row["p"] for row in rows], bool)
    if is_positive.sum() < 2 or (~is_positive).sum() < 2:
        return None
    return fit(x[is_positive], x[~is_positive])


def score_quality(docs: DataFrame, labels: DataFrame, **bounds: int) -> DataFrame:
    """The columns of ``docs`` with ``held_out``, ``score`` and ``predicted``.

    ``score`` (0 to 1) is the chance that a text is of quality 1, from its whole text alone;
    ``predicted`` is 1 from 0.5 on. NULL and empty texts get scores as well. Without positives to
    learn from all scores are 0.5. Repeated rows get equal scores; rows of NULL id are scored and
    not held out. An empty table gives no rows. Input columns named like those added are replaced.
    """
    model = train(docs, labels, **bounds)
    added = ["held_out", "score", "predicted"]
    others = [c for c in docs.columns if c not in added]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed, rolling = WordHashes(), RollingHash(5)
        for part in parts:
            texts = part.column("text")
            scores = np.full(len(texts), 0.5)
            if model is not None and len(texts):
                x = [features(text.as_py(), hashed, rolling) for text in texts]
                scores = model.score(np.array(x, np.float64))
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in others), pa.array(scores)], [*others, "score"]
            )

    kinds = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in others)
    scored = docs.select(*others).mapInArrow(run, kinds + "score double")
    return scored.select(
        *others,
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
