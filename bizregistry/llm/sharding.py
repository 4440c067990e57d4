"""Sharding by fixed virtual slots, in DataFrame operations only."""

from __future__ import annotations

import heapq
import json
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_folder, written

SLOTS = 4096
SHARDS = 40
OVERHEAD = 16
# A slot of more bytes than this share of a mean shard is cut into parts.
PARTS_PER_SHARD = 64
MAP_KINDS = {"vslot": "int", "part": "int", "shard": "int", "first": "bigint"}


def slotted(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``doc_id, size, text_crc32, vslot`` of each row: its bytes and its virtual slot.

    The slot is a hash of id and text. It never changes, however many shards there are. Rows of
    one hot id, or without an id, still spread by their texts, and equal texts by their ids.
    """
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        "doc_id",
        (F.octet_length(text) + F.lit(OVERHEAD)).cast("bigint").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(slots)).cast("int").alias("vslot"),
    )


def split(records: DataFrame, parts: dict[int, int]) -> DataFrame:
    """Records with ``part``: the share of their slot that a row falls into, by its number ``rid``."""
    # At most one row per slot; those of one part need none.
    several = [(slot, n) for slot, n in parts.items() if n > 1]
    counts = records.sparkSession.createDataFrame(several, "vslot int, parts int")
    part = F.pmod(F.xxhash64("rid"), F.col("parts")).cast("int")
    joined = records.join(F.broadcast(counts), "vslot", "left")
    return joined.withColumn("part", F.coalesce(part, F.lit(0))).drop("parts")


def parts_of(loads: dict[int, int], shards: int) -> dict[int, int]:
    """Into how many parts each slot goes, so that none is more than a fraction of a shard."""
    share = sum(loads.values()) / (shards * PARTS_PER_SHARD)
    return {slot: max(1, round(size / share)) for slot, size in loads.items() if size}


def even_map(shards: int, slots: int = SLOTS) -> list[int]:
    """The first version of a map: slots in turn."""
    return [slot % shards for slot in range(slots)]


def rebalance(placed: list[int], loads: dict[int, int], shards: int) -> list[int]:
    """The next version of a slot-to-shard map, with near equal bytes per shard.

    An edit of the map before: shards above the mean give up slots until they are at it, the
    lightest shards take these, largest first, and single moves and swaps even out the rest.
    Other slots stay. ``shards`` may be more or fewer than before. Works on one number per slot,
    whatever the number of records.
    """
    mean = sum(loads.values()) / shards
    held: list[list[int]] = [[] for _ in range(shards)]
    pool: list[int] = []
    for slot, shard in enumerate(placed):
        (held[shard] if shard < shards else pool).append(slot)
    load = [sum(loads.get(s, 0) for s in own) for own in held]
    for shard, own in enumerate(held):
        for slot in sorted(own, key=lambda s: -loads.get(s, 0)):
            if loads.get(slot, 0) and load[shard] - loads[slot] >= mean:
                own.remove(slot)
                pool.append(slot)
                load[shard] -= loads[slot]
    lightest = [(load[shard], shard) for shard in range(shards)]
    heapq.heapify(lightest)
    for slot in sorted(pool, key=lambda s: (-loads.get(s, 0), s)):
        _, shard = heapq.heappop(lightest)
        held[shard].append(slot)
        load[shard] += loads.get(slot, 0)
        heapq.heappush(lightest, (load[shard], shard))
    for _ in range(8 * len(placed)):
        if not _even_out(held, load, loads):
            break
    after = list(placed)
    for shard, own in enumerate(held):
        for slot in own:
            after[slot] = shard
    return after


def _even_out(held: list[list[int]], load: list[int], loads: dict[int, int]) -> bool:
    """One move or swap that lowers the heaviest shard or lifts the lightest."""
    order = sorted(range(len(load)), key=load.__getitem__)
    ends = [(order[-1], low) for low in order[:-1]]
    ends += [(high, order[0]) for high in reversed(order[1:-1])]
    for high, low in ends:
        gap = load[high] - load[low]
        if gap < 2:
            continue
        gives = sorted((loads.get(s, 0), s) for s in held[high])
        takes = [(0, -1), *sorted((loads.get(s, 0), s) for s in held[low])]
        best, at = None, 0
        for size, slot in gives:
            while at + 1 < len(takes) and size - takes[at + 1][0] >= gap / 2:
                at += 1
            for back, other in takes[at : at + 2]:
                if 0 < size - back < gap and (best is None or abs(2 * (size - back) - gap) < best[0]):
                    best = (abs(2 * (size - back) - gap), slot, other, size - back)
        if best is None:
            continue
        _, slot, other, moved = best
        held[high].remove(slot)
        held[low].append(slot)
        if other >= 0:
            held[low].remove(other)
            held[high].append(other)
        load[high] -= moved
        load[low] += moved
        return True
    return False


@dataclass(frozen=True)
class SlotMap:
    """A version of the map: the shard of each unit, a unit being a slot or a part of one.

    ``units`` are ``(vslot, part)``, by slot and part; ``placed`` has their shards.
    """

    version: int
    units: list[tuple[int, int]]
    placed: list[int]

    @property
    def parts(self) -> dict[int, int]:
        return dict(Counter(slot for slot, _ in self.units))

    def with_parts(self, parts: dict[int, int]) -> SlotMap:
        """Slots cut into more parts, where more are asked for; these start where the slot is."""
        placed = dict(zip(self.units, self.placed))
        counts = {slot: max(n, parts.get(slot, 1)) for slot, n in self.parts.items()}
        units = [(slot, part) for slot, n in counts.items() for part in range(n)]
        shards = [placed.get(unit, placed[unit[0], 0]) for unit in units]
        return SlotMap(self.version, units, shards)

    def edited(self, loads: dict[tuple[int, int], int], shards: int) -> SlotMap:
        """The next version, rebalanced for these bytes per unit."""
        numbers = {unit: at for at, unit in enumerate(self.units)}
        by_number = {numbers[unit]: size for unit, size in loads.items()}
        return SlotMap(self.version + 1, self.units, rebalance(self.placed, by_number, shards))


def _folder(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def save_map(
    spark: SparkSession, folder: str, slot_map: SlotMap, rows: dict[tuple[int, int], int]
) -> None:
    """Store one version: ``vslot, part, shard, first``, the first place of the unit in its shard.

    ``rows`` are those of each unit. A version is never written over.
    """
    places: Counter = Counter()
    columns: dict[str, list[int]] = {"vslot": [], "part": [], "shard": [], "first": []}
    for unit, shard in zip(slot_map.units, slot_map.placed):
        for name, value in zip(columns, (*unit, shard, places[shard])):
            columns[name].append(value)
        places[shard] += rows.get(unit, 0)
    lists = [
        F.from_json(F.lit(json.dumps(values)), f"array<{MAP_KINDS[name]}>").alias(name)
        for name, values in columns.items()
    ]
    entries = spark.range(1).select(F.explode(F.arrays_zip(*lists)).alias("at")).select("at.*")
    entries.coalesce(1).write.mode("error").parquet(f"{folder}/version={slot_map.version}")


def load_map(spark: SparkSession, folder: str, version: int) -> DataFrame:
    kinds = ", ".join(f"{name} {kind}" for name, kind in MAP_KINDS.items())
    return spark.read.schema(kinds).parquet(f"{folder}/version={version}")


def latest_map(spark: SparkSession, folder: str) -> SlotMap | None:
    """The highest version stored in a folder whole, if there is one."""
    path, store = _folder(spark, folder)
    if not store.exists(path):
        return None
    names = [status.getPath().getName() for status in store.listStatus(path)]
    versions = [int(name.removeprefix("version=")) for name in names if name.startswith("version=")]
    for version in sorted(versions, reverse=True):
        if store.exists(_folder(spark, f"{folder}/version={version}/_SUCCESS")[0]):
            # A row per unit, which a parameter bounds.
            rows = load_map(spark, folder, version).orderBy("vslot", "part").collect()
            units = [(row["vslot"], row["part"]) for row in rows]
            return SlotMap(version, units, [row["shard"] for row in rows])
    return None


def shard_documents(
    docs: DataFrame, *, shards: int = SHARDS, slots: int = SLOTS, folder: str | None = None
) -> DataFrame:
    """Place the rows of ``docs`` (``doc_id``, ``text``) into shards of near equal bytes.

    Returns ``doc_id, size, text_crc32, shard, slot``; ``slot`` is the place in the shard, gapless
    from 0. A record's virtual slot is fixed. The map from slots to shards is kept in ``folder`` in
    versions: the first call stores version 1, slots in turn, and edits it by the bytes per slot
    into version 2. A later call begins with the highest version there, whatever the number of
    shards was, and stores the next one; slots that need not move stay (``slots`` is then that of the
    first call).

    A slot is heavy where rows repeat very often, as equal rows share it, or where a text is very
    long. Slots of more than a fraction of a shard are cut into parts, which the map places one by
    one, and rows are dealt to these by their number: rows that are equal may lie in several
    shards, and may change places from call to call. Records are numbered within slots and parts,
    thousands of groups of like size, and a part's first place comes from the map, so no task holds
    a shard, nor all copies of a row.

    NULL texts count as empty. Ties are numbered in any order. A text of more bytes than a shard's
    share makes its shard larger than the others. An empty table gives no rows. Other columns of
    ``docs`` are not returned.
    """
    spark = docs.sparkSession
    folder = folder or shared_folder(spark)
    # Written, so the row numbers stay what they are.
    numbered = slotted(docs, slots).withColumn("rid", F.monotonically_increasing_id())
    records = written(numbered, shared_folder(spark))
    before = latest_map(spark, f"{folder}/map")
    if before is None:
        units = [(slot, 0) for slot in range(slots)]
        before = SlotMap(1, units, even_map(shards, slots))
        save_map(spark, f"{folder}/map", before, {})
    if len(before.parts) != slots:
        raise ValueError(f"the stored map has {len(before.parts)} slots, not {slots}")
    # At most one row per slot, then per unit, however large the table.
    sizes = records.groupBy("vslot").agg(F.sum("size").alias("bytes")).collect()
    whole = before.with_parts(parts_of({r["vslot"]: r["bytes"] for r in sizes}, shards))
    placed = split(records, whole.parts)
    count = F.count(F.lit(1)).alias("rows")
    stats = placed.groupBy("vslot", "part").agg(F.sum("size").alias("bytes"), count).collect()
    after = whole.edited({(r["vslot"], r["part"]): r["bytes"] for r in stats}, shards)
    save_map(spark, f"{folder}/map", after, {(r["vslot"], r["part"]): r["rows"] for r in stats})
    order = "doc_id, text_crc32, size, rid"
    ranked = placed.selectExpr(
        "*", f"row_number() OVER (PARTITION BY vslot, part ORDER BY {order}) - 1 AS nth"
    )
    # The map has one row per unit: small by its parameters.
    stored = F.broadcast(load_map(spark, f"{folder}/map", after.version))
    return ranked.join(stored, ["vslot", "part"]).select(
        "doc_id",
        "size",
        "text_crc32",
        "shard",
        (F.col("first") + F.col("nth")).cast("bigint").alias("slot"),
    )
