"""Substring dedup by fixed-block anchors."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_prefix, hash128, shared_folder, written

WINDOW = 35
# Hash buckets at least; more where the cluster shuffles into more partitions.
BUCKETS = 256
# Windows that a task holds at once before it sends them off.
FLUSH = 1_500_000
WORD = regex.compile("[^\\x20\\x09-\\x0D]+")


def split_words(text: str | None) -> list[bytes]:
    """Words of a text as UTF-8; white space is ASCII, as ``bytes.split`` has it."""
    return (text or "").encode("utf-8").split()


class WordHashes:
    """64-bit hashes of words, remembered for a bounded number of them."""

    def __init__(self, most: int = 300_000) -> None:
        self.known: dict[bytes, int] = {}
        self.most = most

    def __call__(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > self.most:
            known.clear()
        for word in set(words).difference(known):
            raw = hashlib.blake2b(word, digest_size=8).digest()
            known[word] = int.from_bytes(raw, "little")
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


class RollingHash:
    """64-bit polynomial hashes of word windows."""

    def __init__(self, seed: int) -> None:
        digest = hashlib.blake2b(b"%d" % seed, digest_size=8).digest()
        self.base = int.from_bytes(digest, "little") | 1
        self.inverse = pow(self.base, -1, 1 << 64)
        self.powers = np.ones(1, np.uint64)
        self.inverses = np.ones(1, np.uint64)

    def windows(self, values: np.ndarray, size: int) -> np.ndarray:
        """Hash of each window of ``size`` values, mixed; equal windows have equal hashes."""
        n = len(values) - size + 1
        if n <= 0:
            return np.empty(0, np.uint64)
        self._grow(len(values))
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.inverses[: len(values)], out=sums[1:])
        hashes = (sums[size:] - sums[:-size]) * self.powers[:n]
        # Finalizer of a common 64-bit mixer: every input bit reaches the high bits.
        hashes ^= hashes >> np.uint64(33)
        hashes *= np.uint64(0xFF51AFD7ED558CCD)
        hashes ^= hashes >> np.uint64(33)
        hashes *= np.uint64(0xC4CEB9FE1A85EC53)
        hashes ^= hashes >> np.uint64(33)
        return hashes

    def _grow(self, n: int) -> None:
        if n > len(self.powers):
            size = 1 << n.bit_length()
            for name, base in (("powers", self.base), ("inverses", self.inverse)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))


def bucket_bits(docs: DataFrame) -> int:
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(BUCKETS.bit_length() - 1, (4 * parts - 1).bit_length())


def anchors(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``t1, block``: reference blocks whose words also start somewhere else.

    Reference blocks are half a window long and do not overlap, so every window holds a whole one.
    Every rolling window of that length is a probe. A task sends its probes by hash bucket as
    packed, sorted 32-bit rests of their hashes, split by whether the task saw them once or more
    often: four bytes a word. Blocks carry their text's key and number as well. A block recurs if
    its hash was probed at least twice, as it is a probe itself. A chance collision only adds work
    for the next step.

    What a task has probed twice recurs for sure. Such blocks need not meet others; they go by
    their text's key, which spreads a passage that very many texts share.
    """
    size = (window + 1) // 2
    bits = bucket_bits(docs)
    keyed = docs.select(F.xxhash64("text").alias("t1"), "text")
    shift = np.uint64(64 - bits)

    def send(probes: list, blocks: list) -> Iterator[pa.RecordBatch]:
        if not probes:
            return
        seen, times = np.unique(np.concatenate(probes), return_counts=True)
        keep = np.uint64(32 - bits) if bits < 32 else np.uint64(0)
        block = np.concatenate([b[0] for b in blocks])
        key = np.concatenate([np.full(len(b[0]), b[1], np.int64) for b in blocks])
        number = np.concatenate([np.arange(len(b[0]), dtype=np.int32) for b in blocks])
        sure = times[np.searchsorted(seen, block)] > 1
        sure_key, sure_number = _distinct(key[sure].view(np.uint64), number[sure])
        block, key, number = block[~sure], key[~sure], number[~sure]
        order = np.argsort(block, kind="stable")
        block, key, number = block[order], key[order], number[order]
        edges = np.arange(1 << bits, dtype=np.uint64) << shift
        cut = [*np.searchsorted(seen, edges).tolist(), len(seen)]
        cut_block = [*np.searchsorted(block, edges).tolist(), len(block)]
        cut_sure = [*np.searchsorted(sure_key, edges).tolist(), len(sure_key)]
        rest, many, block_rest = _rest(seen, keep), times > 1, _rest(block, keep)
        rows: list[tuple] = []
        for b in range(1 << bits):
            i, j, p, q = cut[b], cut[b + 1], cut_block[b], cut_block[b + 1]
            s, t = cut_sure[b], cut_sure[b + 1]
            if i < j or s < t:
                part, more = rest[i:j], many[i:j]
                packed = (part[~more], part[more], block_rest[p:q], key[p:q], number[p:q])
                packed += (sure_key[s:t], sure_number[s:t])
                rows.append((b, *(x.tobytes() for x in packed)))
        names = ["bucket", "once", "more", "block", "key", "number", "sure_key", "sure_number"]
        kinds = [pa.int32(), *[pa.binary()] * 7]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names
        )

    def probe(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed, rolling, probes, blocks, held = WordHashes(), RollingHash(1), [], [], 0
        for part in parts:
            for key, text in zip(part.column("t1").to_pylist(), part.column("text")):
                words = split_words(text.as_py())
                if len(words) >= window:
                    hashes = rolling.windows(hashed(words), size)
                    probes.append(hashes)
                    blocks.append((hashes[::size], key))
                    held += len(hashes)
                if held >= FLUSH:
                    yield from send(probes, blocks)
                    probes, blocks, held = [], [], 0
        yield from send(probes, blocks)

    def meet(_key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        once = np.concatenate([np.frombuffer(b, np.uint32) for b in group["once"]])
        more = [np.frombuffer(b, np.uint32) for b in group["more"]]
        seen, times = np.unique(once, return_counts=True)
        repeated = np.union1d(seen[times > 1], np.concatenate(more))
        # Seen once by one task and more often by another counts as well: it is in ``more``.
        block = np.concatenate([np.frombuffer(b, np.uint32) for b in group["block"]])
        key = np.concatenate([np.frombuffer(b, np.int64) for b in group["key"]])
        number = np.concatenate([np.frombuffer(b, np.int32) for b in group["number"]])
        hit = np.isin(block, repeated)
        sure_key = [np.frombuffer(b, np.int64) for b in group["sure_key"]]
        sure_number = [np.frombuffer(b, np.int32) for b in group["sure_number"]]
        key, number = np.concatenate([key[hit], *sure_key]), np.concatenate([number[hit], *sure_number])
        return pd.DataFrame({"t1": key, "block": number}).drop_duplicates()

    sent = keyed.mapInArrow(
        probe,
        "bucket int, once binary, more binary, block binary, key binary, number binary,"
        " sure_key binary, sure_number binary",
    )
    return sent.groupBy("bucket").applyInPandas(meet, "t1 bigint, block int")


def _rest(hashes: np.ndarray, shift: np.uint64) -> np.ndarray:
    """The 32 bits below the bucket's."""
    return (hashes >> shift).astype(np.uint32)


def _distinct(key: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs in order, each once."""
    order = np.lexsort((number, key))
    key, number = key[order], number[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (number[1:] != number[:-1])
    return key[new], number[new]


def anchored(docs: DataFrame, window: int, folder: str) -> DataFrame:
    """``rid, t1, t2, text, blocks``: texts with anchors, next to the numbers of these."""
    blocks = anchors(docs, window).groupBy("t1").agg(F.collect_set("block").alias("blocks"))
    t1, t2 = hash128("text")
    texts = docs.select(t1.alias("t1"), t2.alias("t2"), "text").filter(F.col("text").isNotNull())
    # Written, so the row numbers stay what they are.
    return written(
        texts.join(blocks, "t1").withColumn("rid", F.monotonically_increasing_id()), folder
    )


def candidates(words: int, blocks: np.ndarray, window: int) -> np.ndarray:
    """Starts of the windows whose first whole reference block is an anchor."""
    size = (window + 1) // 2
    starts = blocks.astype(np.int64)[:, None] * size - np.arange(size)[None, ::-1]
    starts = np.unique(starts)
    return starts[(starts >= 0) & (starts <= words - window)]


def refuted(texts: DataFrame, window: int, bits: int) -> DataFrame:
    """``rid, starts``: candidate windows that start nowhere else.

    Anchors are extended on both sides to all windows around them; these meet by hash bucket, 64
    bits of hash below the bucket's own independent ones. Only those that are alone come back,
    which is what lies at the ends of repeats; so a group of copies is never paired off. Windows
    that a task itself has met twice are not alone: it sends their hash once and not their places,
    so however many texts share a passage, a bucket gets one hash from each task.
    """
    shift = np.uint64(64 - bits)

    def send(held: list) -> Iterator[pa.RecordBatch]:
        if not held:
            return
        spread, hashes, rid, start = (np.concatenate(c) for c in zip(*held))
        order = np.lexsort((hashes, spread))
        spread, hashes, rid, start = (c[order] for c in (spread, hashes, rid, start))
        same = (hashes[1:] == hashes[:-1]) & (spread[1:] == spread[:-1])
        repeats, followed = np.insert(same, 0, False), np.append(same, False)
        single, head = ~(repeats | followed), followed & ~repeats
        edges = np.arange(1 << bits)
        cut = [*np.searchsorted(spread[single], edges).tolist(), int(single.sum())]
        cut_head = [*np.searchsorted(spread[head], edges).tolist(), int(head.sum())]
        places, met = (hashes[single], rid[single], start[single]), hashes[head]
        rows: list[tuple] = []
        for b in range(1 << bits):
            i, j, p, q = cut[b], cut[b + 1], cut_head[b], cut_head[b + 1]
            if i < j or p < q:
                rows.append((b, *(c[i:j].tobytes() for c in places), met[p:q].tobytes()))
        names = ["bucket", "hash", "rid", "start", "met"]
        kinds = [pa.int32(), *[pa.binary()] * 4]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names
        )

    def extend(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed, one, two, held, n = WordHashes(), RollingHash(2), RollingHash(3), [], 0
        for part in parts:
            for rid, text, blocks in zip(*(part.column(c) for c in ("rid", "text", "blocks"))):
                words = split_words(text.as_py())
                at = candidates(len(words), np.array(blocks.as_py()), window)
                if len(at):
                    values = hashed(words)
                    spread = one.windows(values, window)[at] >> shift
                    hashes = two.windows(values, window)[at]
                    own = np.full(len(at), rid.as_py(), np.int64)
                    held.append((spread.astype(np.int32), hashes, own, at.astype(np.int32)))
                    n += len(at)
                if n >= FLUSH:
                    yield from send(held)
                    held, n = [], 0
        yield from send(held)

    def confirm(_key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        hashes = np.concatenate([np.frombuffer(b, np.uint64) for b in group["hash"]])
        rid = np.concatenate([np.frombuffer(b, np.int64) for b in group["rid"]])
        start = np.concatenate([np.frombuffer(b, np.int32) for b in group["start"]])
        order = np.argsort(hashes, kind="stable")
        same = hashes[order][1:] == hashes[order][:-1]
        alone = np.ones(len(hashes), bool)
        alone[:-1] &= ~same
        alone[1:] &= ~same
        alone = order[alone]
        met = np.concatenate([np.frombuffer(b, np.uint64) for b in group["met"]])
        alone = alone[~np.isin(hashes[alone], met)]
        return pd.DataFrame({"rid": rid[alone], "start": start[alone]})

    sent = texts.select("rid", "text", "blocks").mapInArrow(
        extend, "bucket int, hash binary, rid binary, start binary, met binary"
    )
    alone = sent.groupBy("bucket").applyInPandas(confirm, "rid bigint, start int")
    return alone.groupBy("rid").agg(F.collect_list("start").alias("starts"))


def cover(words: int, starts: np.ndarray, window: int) -> np.ndarray:
    """Which words windows at these starts cover."""
    change = np.zeros(words + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + window, -1)
    return np.cumsum(change[:-1]) > 0


def cut_words(text: str, removed: np.ndarray) -> str:
    """A text without the marked words, each of which goes with the white space after it."""
    spans, parts, at = [m.start() for m in WORD.finditer(text)], [], 0
    edges = np.flatnonzero(np.diff(np.concatenate(([0], removed.astype(np.int8), [0]))))
    for first, last in edges.reshape(-1, 2).tolist():
        parts.append(text[at : spans[first]])
        at = spans[last] if last < len(spans) else len(text)
    return "".join([*parts, text[at:]])


def repeated_texts(docs: DataFrame, *, window: int = WINDOW) -> DataFrame:
    """``t1, t2, kept, n_removed``: what is left of each distinct text that holds a repeat.

    ``t1, t2`` are ``hash128("text")``. Each text is in one row; texts that keep all their words
    have none. Reads ``text`` of ``docs`` only.
    """
    folder = shared_folder(docs.sparkSession)
    texts = anchored(docs, window, folder)
    alone = refuted(texts, window, bucket_bits(docs))
    joined = texts.join(alone, "rid", "left").select("t1", "t2", "text", "blocks", "starts")

    def clean(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows: list[tuple] = []
            for t1, t2, text, blocks, starts in zip(*part.columns):
                text = text.as_py()
                words = len(split_words(text))
                at = candidates(words, np.array(blocks.as_py()), window)
                at = np.setdiff1d(at, np.array(starts.as_py() or [], np.int64))
                if len(at):
                    removed = cover(words, at, window)
                    rows.append(
                        (t1.as_py(), t2.as_py(), cut_words(text, removed), int(removed.sum()))
                    )
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64()]
            columns = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["t1", "t2", "kept", "n_removed"]
            )

    cleaned = joined.mapInArrow(clean, "t1 bigint, t2 bigint, kept string, n_removed bigint")
    # Copies of a text have the same result.
    return written(cleaned, folder).dropDuplicates(["t1", "t2"])


def dedup_substrings(docs: DataFrame, *, window: int = WINDOW) -> DataFrame:
    """Remove every word that a window covers which also starts somewhere else.

    ``docs`` needs ``text``; other columns are kept. ``text`` holds what is left and ``n_removed``
    is added (an input column of this name is replaced). A window is ``window`` words in a row;
    it recurs if the same words start anywhere else, in this document, too. All occurrences go,
    repeated rows included; windows are judged on the input. NULL texts stay NULL; texts of fewer
    words than a window stay as they are. Texts may be of any length: a task holds one at a time. An
    empty table gives no rows.
    """
    own = free_prefix(docs)
    cleaned = repeated_texts(docs, window=window)
    cleaned = cleaned.select(*(F.col(c).alias(own + c) for c in cleaned.columns))
    t1, t2 = hash128("text")
    on = (t1 == cleaned[f"{own}t1"]) & (t2 == cleaned[f"{own}t2"])
    out = docs.join(cleaned, on, "left").withColumns(
        {
            "text": F.coalesce(f"{own}kept", "text"),
            "n_removed": F.coalesce(f"{own}n_removed", F.lit(0)),
        }
    )
    return out.select(*docs.columns, *(c for c in ("n_removed",) if c not in docs.columns))


def word_digests(docs: DataFrame, text: str = "text") -> DataFrame:
    """The other columns of ``docs``, with ``n_words`` and ``words_sha256`` of the words of a text.

    The digest is that of the words joined by one space, in lowercase hex.
    """
    others = [c for c in docs.columns if c != text]

    def digest(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            words = [split_words(value.as_py()) for value in part.column(text)]
            counts = pa.array([len(w) for w in words], pa.int64())
            hashes = pa.array([hashlib.sha256(b" ".join(w)).hexdigest() for w in words])
            columns = [*(part.column(c) for c in others), counts, hashes]
            names = [*others, "n_words", "words_sha256"]
            yield pa.RecordBatch.from_arrays(columns, names)

    kinds = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in others)
    return docs.select(*others, text).mapInArrow(
        digest, f"{kinds}n_words bigint, words_sha256 string"
    )
