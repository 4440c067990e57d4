"""SimHash near-dedup by meet-in-the-middle ball hashing."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_prefix, hash128, shared_folder, written
from .components import connected_components

SHINGLE = 4
SEED = 42
BITS = 64
RADIUS = 4
# Variants that a task of the collision step holds at once.
VARIANTS_PER_TASK = 4_000_000


def shingle_hashes(text: str | None, shingle: int) -> Iterator[bytes]:
    """Hashes of a text's word shingles in turn, many at a time, 8 bytes each; none without words."""
    words = (text or "").encode("utf-8").lower().split()  # bytes: A-Z and ASCII space only
    if not words:
        return
    joined = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    stops = ends[len(words) - n :].tolist()
    digest = xxhash.xxh64_digest
    for at in range(0, n, 1 << 16):
        spans = zip(starts[at : at + (1 << 16)], stops[at : at + (1 << 16)])
        yield b"".join([digest(joined[i:j], SEED) for i, j in spans])


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of a text's word shingles, as a signed number; 0 without words."""
    n, counts = 0, np.zeros(BITS, np.int64)
    for hashes in shingle_hashes(text, shingle):
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
        n += len(bits)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, r1, r2, fp``: the fingerprint of each row, next to a hash of its content."""
    r1, r2 = hash128("doc_id", "text")
    keyed = docs.select("doc_id", r1.alias("r1"), r2.alias("r2"), "text")

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = [fingerprint(text.as_py(), shingle) for text in part.column("text")]
            columns = [part.column(i) for i in range(3)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(found, pa.int64())], ["doc_id", "r1", "r2", "fp"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return keyed.mapInArrow(batches, f"doc_id {kind}, r1 bigint, r2 bigint, fp bigint")


def flips(bits: int, most: int) -> list[int]:
    """All masks of ``bits`` bits with ``most`` ones at most, by number of ones."""
    ones = (c for k in range(most + 1) for c in combinations(range(bits), k))
    return [sum(1 << bit for bit in chosen) for chosen in ones]


def prefix_bits(distinct: int, radius: int = RADIUS) -> int:
    """Length of the variants' prefixes: tasks of a like size, whatever the number of texts."""
    variants = distinct * len(flips(BITS, radius // 2))
    return min(24, max(8, math.ceil(math.log2(max(1, variants / VARIANTS_PER_TASK)))))


def links(fps: DataFrame, radius: int = RADIUS, prefix: int | None = None) -> DataFrame:
    """Pairs ``a, b`` of distinct fingerprints that connect all within ``radius`` bits.

    Fingerprints at ``radius`` bits or less share a variant at half the radius from both. Each
    one emits all its variants; they meet by variant. What is shuffled is a row per variant
    prefix: it stands for all variants of the fingerprint with that prefix, and the task that gets
    them spells them out, sorts them and finds the collisions. So a fingerprint costs a few dozen
    rows of 12 bytes, not two thousand.

    Those who share a variant are all within ``radius`` of each other. They are linked to the
    smallest among them, not pair by pair: that keeps every component whole, at a row per
    collision. Pairs are deduplicated and their distance is verified. ``radius`` must be even: at
    an odd distance no variant lies at half the way.
    """
    if radius % 2:
        raise ValueError(f"radius must be even, not {radius}")
    half = radius // 2
    fps = fps.select("fp").distinct()
    t = prefix if prefix is not None else prefix_bits(fps.count(), radius)
    masks = F.array(*(F.lit(mask) for mask in flips(t, half)))
    prefixed = fps.select(
        "fp", F.explode(F.transform(masks, lambda m: _prefix(t).bitwiseXOR(m))).alias("prefix")
    )
    found = prefixed.groupBy("prefix").applyInPandas(_collider(t, half), "a bigint, b bigint")
    return found.distinct().filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)


def _prefix(bits: int):
    return F.shiftrightunsigned("fp", BITS - bits).cast("int")


def _collider(t: int, half: int):
    def collide(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        fps = group["fp"].to_numpy().view(np.uint64)
        pairs = [p for p in collisions(np.sort(fps), int(key[0]), t, half) if len(p)]
        found = np.unique(np.concatenate(pairs), axis=0) if pairs else np.empty((0, 2), np.uint64)
        found = np.ascontiguousarray(found).view(np.int64)
        return pd.DataFrame({"a": found[:, 0], "b": found[:, 1]})

    return collide


def collisions(
    fps: np.ndarray, prefix: int, t: int, half: int, most: int = 2 * VARIANTS_PER_TASK
) -> Iterator[np.ndarray]:
    """Pairs (smallest, other) of those who share a variant that starts with the prefix.

    Where a prefix has more variants than ``most``, it is split by its next bit, so memory is
    bounded also where fingerprints lie close together.
    """
    low = BITS - t
    used = np.bitwise_count((fps >> np.uint64(low) if low < BITS else fps * 0) ^ np.uint64(prefix))
    left = half - used.astype(np.int64)
    fps, left = fps[left >= 0], left[left >= 0]
    if len(fps) < 2:
        return
    sizes = [sum(math.comb(low, i) for i in range(k + 1)) for k in range(half + 1)]
    if low and sum(sizes[k] * int((left == k).sum()) for k in range(half + 1)) > most:
        for bit in (0, 1):
            yield from collisions(fps, 2 * prefix + bit, t + 1, half, most)
        return
    rest = fps & np.uint64((1 << low) - 1)
    all_masks = np.array(flips(low, half), np.uint64)

    def expand(k: int) -> np.ndarray:
        return (rest[left == k][:, None] ^ all_masks[None, : sizes[k]]).ravel()

    variants = np.sort(np.concatenate([expand(k) for k in range(half + 1)]))
    met = np.unique(variants[1:][variants[1:] == variants[:-1]])
    if not len(met):
        return
    hits, owners = [], []
    for k in range(half + 1):
        own = expand(k)
        at = np.searchsorted(met, own)
        at[at == len(met)] = 0
        hit = np.flatnonzero(met[at] == own)
        hits.append(at[hit])
        owners.append(fps[left == k][hit // sizes[k]])
    at, owner = np.concatenate(hits), np.concatenate(owners)
    order = np.lexsort((owner, at))
    at, owner = at[order], owner[order]
    first = np.concatenate(([True], at[1:] != at[:-1]))
    heads = owner[first][np.cumsum(first) - 1]
    yield np.unique(np.stack([heads, owner], axis=1)[~first], axis=0)


def near_duplicates(
    docs: DataFrame, *, shingle: int = SHINGLE, radius: int = RADIUS, folder: str | None = None
) -> DataFrame:
    """``doc_id, r1, r2, fp, root, component_id`` for each row of ``docs`` (``doc_id``, ``text``).

    Rows whose fingerprints differ in ``radius`` bits or less are linked. ``root``, the smallest
    fingerprint that links reach, identifies the component; ``component_id`` is its smallest id,
    which components share where rows of one id differ or where none has an id. NULL, empty and
    blank texts have fingerprint 0 and are linked like any others. Repeated rows stay, in one
    component. NULL ids count only where a component has no other; it is NULL then. An empty table
    gives no rows. Other columns are not returned. Texts may be of any length: a task holds one at a
    time, with eight bytes for each of its words.
    """
    folder = folder or shared_folder(docs.sparkSession)
    fps = written(fingerprints(docs, shingle), folder)
    least = written(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), folder)
    roots = connected_components(links(least, radius), folder)
    root = F.coalesce("root", "fp").alias("root")
    rooted = least.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", root
    )
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = rooted.select("fp", "root").join(ids, "root")
    return fps.join(labels, "fp").select("doc_id", "r1", "r2", "fp", "root", "component_id")


def drop_near_duplicates(
    docs: DataFrame, *, shingle: int = SHINGLE, radius: int = RADIUS
) -> DataFrame:
    """One row of each component stays: the smallest id; among its rows, the smallest hash.

    The columns are those of ``docs``. Repeated rows leave one. Rows that lack an id, or share one,
    are told apart by their texts like any others.
    """
    folder = shared_folder(docs.sparkSession)
    groups = written(near_duplicates(docs, shingle=shingle, radius=radius, folder=folder), folder)
    return first_of_each(docs, groups)


def first_of_each(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """The first row of ``docs`` for each ``root`` of ``groups`` (``doc_id, r1, r2, root``)."""
    # Copies of a text share a root: minima are combined before they are shuffled, and no
    # component is ever gathered in a task.
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "r1", "r2")).alias("first")
    kept = groups.groupBy("root").agg(first).select("first.r1", "first.r2")
    r1, r2 = hash128("doc_id", "text")
    own = [free_prefix(docs) + name for name in ("r1", "r2")]
    keyed = docs.withColumns(dict(zip(own, (r1, r2))))
    on = (keyed[own[0]] == kept["r1"]) & (keyed[own[1]] == kept["r2"])
    one = keyed.join(kept, on, "left_semi").dropDuplicates(own)
    return one.select(*docs.columns)
