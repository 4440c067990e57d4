"""Hard negatives by exact inner products in Kronecker-packed integers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shared_folder, written
from .topk import matrix, quantised

K = 5
POSITIVES = 5
EVERY = 100
LEAST = 80
SCALE = 256
# Components of the data, and anchors, that one task holds.
PART = 1 << 21
ANCHORS = 8_192
# Scores that a task holds at once.
SCORES = 1 << 22
WORD = 64
NONE = np.iinfo(np.int64).min
LAST = np.iinfo(np.int64).max


class PackedProducts:
    """Exact inner products of anchors with candidates, several candidates to a multiplication.

    Components of both sides are biased to be non-negative. For each dimension, several
    candidates' components lie side by side in fields of one integer, wide enough for a whole inner
    product; so an anchor's component, times that integer, is its product with each of them, and
    the sums over all dimensions never run into each other's fields. Taking the biases off again
    leaves the scores. Fields lie in 64-bit words while two or more fit; beyond that one integer of
    any length holds all candidates.
    """

    def __init__(self, anchors: np.ndarray, candidates: np.ndarray) -> None:
        self.n, self.dim = candidates.shape
        self.shift_a = -min(0, int(anchors.min()))
        self.shift_c = -min(0, int(candidates.min()))
        most_a = int(anchors.max()) + self.shift_a
        most_c = int(candidates.max()) + self.shift_c
        self.width = max(1, (self.dim * most_a * most_c).bit_length())
        self.fields = WORD // self.width
        self.narrow = self.fields >= 2
        kind = np.int64 if self.narrow else object
        self.anchors = anchors.astype(kind) + self.shift_a
        biased = candidates.astype(kind) + self.shift_c
        # What the biases add to a score, but for the part of the anchor.
        self.extra = biased.sum(axis=1) * self.shift_a
        self.packed = self._words(biased) if self.narrow else self._integers(biased)

    def _words(self, biased: np.ndarray) -> np.ndarray:
        words = -(-self.n // self.fields)
        filled = np.zeros((self.dim, words * self.fields), np.uint64)
        filled[:, : self.n] = biased.T
        shifts = np.arange(self.fields, dtype=np.uint64) * np.uint64(self.width)
        fields = filled.reshape(self.dim, words, self.fields) << shifts
        return np.bitwise_or.reduce(fields, axis=2)

    def _integers(self, biased: np.ndarray) -> list[int]:
        size = -(-self.width // 8)
        packed = []
        for column in biased.T:
            fields = b"".join(int(value).to_bytes(size, "little") for value in column)
            packed.append(int.from_bytes(fields, "little"))
        return packed

    def scores(self, first: int, last: int) -> np.ndarray:
        """Scores of the anchors from ``first`` to ``last``, a row for each."""
        own = self.anchors[first:last]
        found = self._narrow(own) if self.narrow else self._wide(own)
        own_extra = (own.sum(axis=1) - self.dim * self.shift_a) * self.shift_c
        return (found - self.extra[None, :] - own_extra[:, None]).astype(np.int64)

    def _narrow(self, own: np.ndarray) -> np.ndarray:
        sums = np.zeros((len(own), self.packed.shape[1]), np.uint64)
        for column, packed in zip(own.T.astype(np.uint64), self.packed):
            sums += column[:, None] * packed[None, :]
        shifts = np.arange(self.fields, dtype=np.uint64) * np.uint64(self.width)
        mask = np.uint64((1 << self.width) - 1)
        fields = (sums[:, :, None] >> shifts) & mask
        return fields.reshape(len(own), -1)[:, : self.n].astype(np.int64)

    def _wide(self, own: np.ndarray) -> np.ndarray:
        size = -(-self.width // 8)
        found = np.empty((len(own), self.n), object)
        for at, row in enumerate(own):
            total = sum(int(value) * packed for value, packed in zip(row, self.packed))
            raw = total.to_bytes(size * self.n, "little")
            for j in range(self.n):
                found[at, j] = int.from_bytes(raw[j * size : (j + 1) * size], "little")
        return found


def best_columns(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of each row's ``k`` greatest scores; ties go to the first column.

    Scores of ``NONE`` are no scores.
    """
    n = scores.shape[1]
    if not scores.size:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    kth = np.partition(scores, n - k, axis=1)[:, n - k] if n > k else scores.min(axis=1)
    row, column = np.nonzero((scores >= kth[:, None]) & (scores > NONE))
    order = np.lexsort((column, -scores[row, column], row))
    row, column = row[order], column[order]
    nth = np.arange(len(row)) - np.searchsorted(row, row)
    return row[nth < k], column[nth < k]


def _grid(anchors: DataFrame, rows: DataFrame, by: list[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides cut into blocks, ``slot`` of anchors and ``part`` of rows, each pair of blocks once.

    Blocks are hash shares of a group of ``by``, in number as the group has rows, so a label with
    a third of all rows is many blocks. The counts are joined, not collected.
    """
    least = F.greatest(F.lit(1), F.floor(F.lit(PART) / F.col("dim")))
    sizes = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    asked = anchors.groupBy(*by).agg(F.count(F.lit(1)).alias("asked"))
    sizes = sizes.join(asked, by).select(
        *by,
        F.ceil(F.col("n") / least).cast("int").alias("parts"),
        F.ceil(F.col("asked") / ANCHORS).cast("int").alias("slots"),
    )

    def share(count: str) -> Column:
        return F.pmod(F.xxhash64("rid"), F.col(count)).cast("int")

    def each(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    left = anchors.join(sizes, by).withColumn("slot", share("slots")).withColumn("part", each("parts"))
    right = rows.join(sizes, by).withColumn("part", share("parts")).withColumn("slot", each("slots"))
    # Both come from one table: names of their own keep the sides apart.
    own = [F.col(c).alias(f"a_{c}") for c in (*anchors.columns, "slot", "part")]
    return left.select(*own), right.drop("parts", "slots")


def _ordered(right: pa.Table) -> pa.Table:
    """Candidates in the order in which ties are broken: by id, NULL last."""
    return right.sort_by([("vec_id", "ascending"), ("rid", "ascending")])


def _positives(anchors: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """``anchor, rid, vec_id, score``: the ``k`` best other rows of each anchor's label."""
    names = ["anchor", "rid", "vec_id", "score"]

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return pa.table([pa.array([], pa.int64())] * 4, names)
        right = _ordered(right)
        products = PackedProducts(matrix(left.column("a_v")), matrix(right.column("v")))
        own, other = left.column("a_rid").to_numpy(), right.column("rid").to_numpy()
        step, found = max(1, SCORES // len(other)), []
        for first in range(0, len(own), step):
            scores = products.scores(first, first + step)
            scores[own[first : first + step, None] == other[None, :]] = NONE
            row, column = best_columns(scores, k)
            found.append((row + first, column, scores[row, column]))
        row, column, score = (np.concatenate(c) for c in zip(*found))
        ids = right.column("vec_id").take(pa.array(column)).combine_chunks()
        return pa.table([pa.array(own[row]), pa.array(other[column]), ids, pa.array(score)], names)

    left, right = _grid(anchors, rows, ["dim", "label"])
    unit = ["dim", "label", "slot", "part"]
    found = (
        left.groupBy(*(f"a_{name}" for name in unit))
        .cogroup(right.groupBy(*unit))
        .applyInArrow(search, "anchor bigint, rid bigint, vec_id bigint, score bigint")
    )
    return _first(found, ["anchor"], "score", "vec_id", "rid", k)


def _negatives(anchors: DataFrame, rows: DataFrame, k: int, least: int) -> DataFrame:
    """The ``k`` best rows of other labels in the band below each positive's score."""
    names = ["anchor", "positive", "rid", "negative_id", "negative_score"]

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return pa.table([pa.array([], pa.int64())] * 5, names)
        right = _ordered(right)
        products = PackedProducts(matrix(left.column("a_v")), matrix(right.column("v")))
        own, other = left.column("a_rid").to_numpy(), right.column("rid").to_numpy()
        own_label, label = left.column("a_label").to_numpy(), right.column("label").to_numpy()
        positives = left.column("a_positives").to_pylist()
        step, found = max(1, SCORES // len(other)), []
        for first in range(0, len(own), step):
            scores = products.scores(first, first + step)
            scores[own_label[first : first + step, None] == label[None, :]] = NONE
            part = positives[first : first + step]
            for nth in range(max(map(len, part))):
                at = np.array([i for i, held in enumerate(part) if nth < len(held)])
                high = [part[i][nth]["score"] for i in at]
                # Python's integers: the products below may need more than 64 bits.
                low = np.array([-(-least * score // 100) for score in high], np.int64)
                some = scores[at]
                band = (some >= low[:, None]) & (some <= np.array(high, np.int64)[:, None])
                row, column = best_columns(np.where(band, some, NONE), k)
                held = np.array([part[i][nth]["rid"] for i in at], np.int64)
                found.append((own[first:][at[row]], held[row], column, some[row, column]))
        if not found:
            return pa.table([pa.array([], pa.int64())] * 5, names)
        anchor, positive, column, score = (np.concatenate(c) for c in zip(*found))
        ids = right.column("vec_id").take(pa.array(column)).combine_chunks()
        columns = [pa.array(anchor), pa.array(positive), pa.array(other[column])]
        return pa.table([*columns, ids, pa.array(score)], names)

    left, right = _grid(anchors, rows, ["dim"])
    unit = ["dim", "slot", "part"]
    found = (
        left.groupBy(*(f"a_{name}" for name in unit))
        .cogroup(right.groupBy(*unit))
        .applyInArrow(search, ", ".join(f"{name} bigint" for name in names))
    )
    return _first(found, ["anchor", "positive"], "negative_score", "negative_id", "rid", k)


def _first(found: DataFrame, by: list[str], score: str, key: str, rid: str, k: int) -> DataFrame:
    order = [F.desc(score), F.asc_nulls_last(key), F.asc(rid)]
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame,
    *,
    k: int = K,
    positives: int = POSITIVES,
    every: int = EVERY,
    least: int = LEAST,
    scale: int = SCALE,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``vectors`` has ``vec_id``, ``embedding`` and an integer ``label``; other columns are not read.
    Components are taken as ``floor(scale * x)``, scores are integer inner products, exact at any
    size; those returned must fit into 64 bits. Anchors are the rows whose id ``every`` divides. An
    anchor's positives are its ``positives`` best other rows of the same label. For each of them,
    the ``k`` best rows of other labels are returned whose score is ``least`` per cent of the
    positive's or more, and not above it. Ties go to the smaller id, a NULL id last.

    Every row meets every anchor in blocks: first the rows of its label, then all, so each pair is
    scored in one task. Rows with a NULL label or vector, an empty one or one with NULL or
    non-finite components take no part. Vectors of different lengths never meet. Repeated rows are
    rows like others, also as anchors. Rows with NULL ids are no anchors. A positive with a score
    below zero has no negatives. An empty table gives no rows.
    """
    both = F.struct("vec_id", F.col("label").cast("bigint").alias("label")).alias("vec_id")
    labelled = vectors.filter(F.col("label").isNotNull()).select(both, "embedding")
    # Written, so the row numbers stay what they are.
    rows = written(
        quantised(labelled, scale).select(
            F.monotonically_increasing_id().alias("rid"),
            F.col("vec_id.vec_id").cast("bigint").alias("vec_id"),
            F.col("vec_id.label").alias("label"),
            F.size("v").alias("dim"),
            "v",
        ),
        folder := shared_folder(vectors.sparkSession),
    )
    anchors = rows.filter(F.coalesce(F.col("vec_id") % every == 0, F.lit(False)))
    found = written(_positives(anchors, rows, positives), folder)
    held = F.collect_list(F.struct("rid", "score")).alias("positives")
    ranked = found.groupBy(F.col("anchor").alias("rid")).agg(held)
    mined = _negatives(anchors.join(ranked, "rid"), rows, k, least)
    pairs = found.select(
        "anchor",
        F.col("rid").alias("positive"),
        F.col("vec_id").alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    ids = anchors.select(F.col("rid").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return (
        mined.join(pairs, ["anchor", "positive"])
        .join(ids, "anchor")
        .select(
            "anchor_id",
            "positive_id",
            F.col("rank").cast("int").alias("rank"),
            "negative_id",
            "positive_score",
            "negative_score",
        )
    )
