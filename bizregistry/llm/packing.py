"""Best-fit packing by large-item matching, planned on the histogram of lengths."""

from __future__ import annotations

import heapq
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .byte_bpe import ByteBpe
from .common import shared_folder, written

CAPACITY = 1024
END_ID = 2
# Parts in which each length is counted at least, and pieces that one holds: a frequent length is
# numbered by many tasks.
PARTS = 64
PART = 250_000


@dataclass
class Run:
    """Sequences filled alike: how many, and the lengths in each, in order."""

    count: int
    items: tuple[int, ...]


def pack_lengths(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Run]:
    """Fill sequences of ``capacity`` with items of these lengths; few sequences, all items.

    Items above a third of the capacity fit at most two to a sequence. They are matched greedily,
    from the longest: each takes the longest one left that fits beside it. The smaller ones follow,
    longest first, each into the fullest sequence with room for it; a new one is begun only if
    there is none. Equal sequences are handled together, so the work depends on the number of
    different lengths, not of items.
    """
    left = {size: count for size, count in histogram.items() if count > 0}
    large = sorted(size for size in left if 3 * size > capacity)
    gaps: dict[int, list[Run]] = {}
    rooms: list[int] = []

    def put(run: Run, gap: int) -> None:
        if gap not in gaps:
            gaps[gap] = []
            insort(rooms, gap)
        gaps[gap].append(run)

    while large:
        size = large[-1]
        at = bisect_left(large, capacity - size + 1) - 1
        if at < 0:
            large.pop()
            put(Run(left[size], (size,)), capacity - size)
            continue
        other = large[at]
        if other == size:
            pairs = left[size] // 2
            left[size] -= 2 * pairs
        else:
            pairs = min(left[size], left[other])
            left[size] -= pairs
            left[other] -= pairs
        if pairs:
            put(Run(pairs, (size, other)), capacity - size - other)
        if other == size and left[size]:
            # A single one is left of this length: the next shorter one is its match.
            large.pop()
            if large:
                shorter = large[-1]
                left[size] -= 1
                left[shorter] -= 1
                put(Run(1, (size, shorter)), capacity - size - shorter)
                if not left[shorter]:
                    large.pop()
            else:
                put(Run(1, (size,)), capacity - size)
            continue
        for done in {size, other}:
            if not left[done]:
                large.pop(bisect_left(large, done))

    for size in sorted((s for s in left if 3 * s <= capacity), reverse=True):
        count = left[size]
        while count:
            at = bisect_left(rooms, size)
            if at == len(rooms):
                fit = capacity // size
                full, rest = divmod(count, fit)
                if full:
                    put(Run(full, (size,) * fit), capacity - fit * size)
                if rest:
                    put(Run(1, (size,) * rest), capacity - rest * size)
                break
            gap = rooms[at]
            run = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap]
                rooms.pop(at)
            fit = gap // size
            full, rest = divmod(count, fit)
            full = min(full, run.count)
            if full:
                put(Run(full, run.items + (size,) * fit), gap - fit * size)
                count -= full * fit
            if full < run.count:
                if rest := min(count, fit - 1):
                    put(Run(1, run.items + (size,) * rest), gap - rest * size)
                    count -= rest
                if spare := run.count - full - bool(rest):
                    put(Run(spare, run.items), gap)
    return [run for runs in gaps.values() for run in runs]


def places(runs: list[Run]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length: first ranks, first sequences and offsets of the stretches of its items.

    The item of rank ``r`` in a stretch that begins at ``f`` is in sequence ``s + r - f``.
    """
    taken: dict[int, int] = {}
    found: dict[int, list[tuple[int, int, int]]] = {}
    sequence = 0
    for run in runs:
        offset = 0
        for size in run.items:
            rank = taken.get(size, 0)
            found.setdefault(size, []).append((rank, sequence, offset))
            taken[size] = rank + run.count
            offset += size
        sequence += run.count
    return {size: tuple(np.array(c, np.int64) for c in zip(*at)) for size, at in found.items()}


def pieces(
    docs: DataFrame,
    tokenizer: str,
    *,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` (and ``ids``) of each document's pieces.

    A document is the ids of its text (NULL: none) and ``end_id``. It is cut only if it is longer
    than ``capacity``; then its first piece may be shorter than that, and the others are full.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 6 if with_ids else 5]

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ByteBpe(tokenizer)
        for part in parts:
            owner, rows, ids = [], [], array("I")
            for at, text in enumerate(part.column("text")):
                tokens = encoder.encode(text.as_py())
                tokens.append(end_id)
                n, first = len(tokens), len(tokens) % capacity or min(capacity, len(tokens))
                bounds = [0, *range(first, n + 1, capacity)]
                data = memoryview(tokens).cast("B")
                for number, (i, j) in enumerate(zip(bounds, bounds[1:])):
                    owner.append(at)
                    rows.append((number, i, j - i, zlib.crc32(data[4 * i : 4 * j])))
                if with_ids:
                    ids += tokens
            if not rows:
                continue
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
            if with_ids:
                # Numbers stay in one buffer: as objects they would need ten times the memory.
                ends = np.cumsum([0, *(row[2] for row in rows)], dtype=np.int32)
                values = pa.array(np.frombuffer(ids, np.int32))
                columns.append(pa.ListArray.from_arrays(pa.array(ends), values))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").take(pa.array(owner)), *columns], names
            )

    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
    return docs.select("doc_id", "text").mapInArrow(
        cut, schema + (", ids array<int>" if with_ids else "")
    )


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    *,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """Pack documents (``doc_id``, ``text``) into sequences of ``capacity`` tokens at most.

    Returns a row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` and,
    on demand, ``ids``. Full pieces, which most are where documents are long, are sequences of their
    own and take no part in what follows: their ids come from their places in the table, without a
    shuffle. The plan for the others is made from the number of pieces of each length, fewer than
    ``capacity`` numbers however large the table. Pieces of a length are numbered in parts, in number
    as there are pieces, so that a length which most of them have is spread as well.

    NULL and empty texts are a document of ``end_id`` alone. Repeated rows are packed each; pieces
    that are equal in all columns may change places. Texts may be of any length. An empty table gives
    no rows.
    """
    spark = docs.sparkSession
    cut = pieces(docs, tokenizer, capacity=capacity, end_id=end_id, with_ids=with_ids)
    # Written, so the row numbers stay what they are.
    cut = written(cut.withColumn("rid", F.monotonically_increasing_id()), shared_folder(spark))
    kept = [f for f in cut.schema.fields if f.name != "rid"]
    full = cut.filter(F.col("length") == capacity).select(
        *(f.name for f in kept),
        (-1 - F.col("rid")).alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"),
    )
    short = cut.filter(F.col("length") < capacity)
    # Fewer rows than the capacity; then as many as there are parts.
    histogram = dict(map(tuple, short.groupBy("length").count().collect()))
    parts_of = {size: max(PARTS, -(-count // PART)) for size, count in histogram.items()}
    number = F.pmod(F.xxhash64("rid"), _constant(parts_of)[F.col("length")]).cast("int")
    parted = short.withColumn("part", number)
    counts = sorted(map(tuple, parted.groupBy("length", "part").count().collect()))
    first = {size: np.zeros(n, np.int64) for size, n in parts_of.items()}
    seen: dict[int, int] = {}
    for size, part, count in counts:
        first[size][part] = seen.get(size, 0)
        seen[size] = seen.get(size, 0) + count
    plan = places(pack_lengths(histogram, capacity))
    numbered = parted.selectExpr(
        "*",
        "row_number() OVER (PARTITION BY length, part ORDER BY doc_id, piece, ids_crc32, rid) - 1"
        " AS nth",
    )

    def place(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            size, part, nth = (batch.column(c).to_numpy() for c in ("length", "part", "nth"))
            sequence, offset = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
            for one in np.unique(size).tolist():
                rows = size == one
                rank = first[one][part[rows]] + nth[rows]
                ranks, sequences, offsets = plan[one]
                at = np.searchsorted(ranks, rank, side="right") - 1
                sequence[rows] = sequences[at] + rank - ranks[at]
                offset[rows] = offsets[at]
            names = [c for c in batch.schema.names if c not in ("part", "nth", "rid")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(sequence), pa.array(offset)],
                [*names, "sequence_id", "offset"],
            )

    kinds = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in kept)
    placed = numbered.mapInArrow(place, kinds + "sequence_id bigint, offset bigint")
    return placed.unionByName(full)


def _constant(values: dict[int, int]) -> Column:
    pairs = [F.lit(v).cast("bigint") for pair in values.items() for v in pair]
    return F.create_map(*pairs) if pairs else F.create_map().cast("map<bigint,bigint>")


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids``: the packed sequences, from pieces with their ids."""
    inside = F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("inside")
    return packed.groupBy("sequence_id").agg(inside).select(
        "sequence_id", F.flatten(F.col("inside.ids")).alias("ids")
    )
