"""Self-join of texts on the Jaccard similarity of their word n-grams, by rare-first prefixes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import shared_folder, written
from .components import connected_components
from .substring import RollingHash, WordHashes

SHINGLE = 5
# Per cent of the union that the intersection must have.
SIMILARITY = 80
# Shingles that a task counts together, and those that it sends off together.
RANGE = 2_000_000
CHUNK = 1_000_000
CHUNK_DOCS = 65_535
# Digests that a task remembers, so as to send copies once.
SEEN = 1_000_000
# Partners of a text that one task compares.
PARTNERS = 4_096
REST_BITS = 40
REST_BYTES = REST_BITS // 8
CELLS = 8


class Shingles:
    """Sorted, distinct 64-bit hashes of a text's word n-grams; the whole text if it is shorter."""

    def __init__(self, size: int) -> None:
        self.size, self.hashed, self.rolling = size, WordHashes(), RollingHash(5)

    def __call__(self, text: str | None) -> np.ndarray:
        # ``bytes.lower`` and ``bytes.split`` know ASCII only.
        words = (text or "").encode("utf-8").lower().split()
        size = min(self.size, len(words))
        if not size:
            return np.empty(0, np.uint64)
        return np.unique(self.rolling.windows(self.hashed(words), size))


def digest_of(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def members(docs: DataFrame, size: int) -> DataFrame:
    """``doc_id, n, digest`` of each row: the number of its shingles and the digest of their set."""

    def measure(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(size)
        for part in parts:
            sets = [shingles(text.as_py()) for text in part.column("text")]
            counts = pa.array([len(s) for s in sets], pa.int64())
            digests = pa.array([digest_of(s) for s in sets], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), counts, digests], ["doc_id", "n", "digest"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    source = docs.select("doc_id", "text")
    return source.mapInArrow(measure, f"doc_id {kind}, n bigint, digest binary")


def least_overlap(n: int, similarity: int) -> int:
    """Shingles that two sets of ``n`` together must have in common."""
    return -(-similarity * n // (100 + similarity))


def probe_prefix(n: int, similarity: int) -> int:
    return n - -(-similarity * n // 100) + 1


def pack(hashes: np.ndarray) -> bytes:
    """The low bytes of each hash."""
    return hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :REST_BYTES].tobytes()


def unpack(data: bytes) -> np.ndarray:
    low = np.frombuffer(data, np.uint8).reshape(-1, REST_BYTES)
    full = np.zeros((len(low), 8), np.uint8)
    full[:, :REST_BYTES] = low
    return full.reshape(-1).view("<u8")


def range_of(hashes: np.ndarray, ranges: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)


def tokens_of(number: np.ndarray | int, rest: np.ndarray) -> np.ndarray:
    """Shingles as positive numbers: their range, then the low bits of their hash."""
    return ((np.uint64(number) << np.uint64(REST_BITS)) | rest).astype(np.int64)


def _chunks(docs: DataFrame, size: int, ranges: int) -> DataFrame:
    """The sets of all texts, cut into chunks of texts and ranges of hashes.

    A row has the shingles of a chunk in a range: ``one``, those of one text of the chunk, by
    ``text`` numbers with ``sizes``, and ``many``, those of several, with the ``times`` these have
    them; so a shingle that very many texts share comes once from each chunk. Which texts those
    are stays with the chunk: one of its rows carries them as ``home``, next to the digests and
    sizes of its sets.
    """

    def send(chunk: int, sets: list[tuple[bytes, np.ndarray]]) -> pa.RecordBatch:
        sizes = np.array([len(s) for _, s in sets], np.int64)
        hashes = np.concatenate([s for _, s in sets])
        text = np.repeat(np.arange(len(sets), dtype=np.uint16), sizes)
        order = np.argsort(hashes, kind="stable")
        ordered = hashes[order]
        head = np.concatenate(([True], ordered[1:] != ordered[:-1]))
        spots = np.flatnonzero(head)
        times = np.diff(np.concatenate((spots, [len(ordered)])))
        several = np.repeat(times > 1, times)
        many, many_times = ordered[spots[times > 1]], times[times > 1].astype(np.uint32)
        single = np.zeros(len(hashes), bool)
        single[order[~several]] = True
        one, own = hashes[single], text[single]
        number = range_of(one, ranges)
        by_range = np.argsort(number, kind="stable")
        one, own, number = one[by_range], own[by_range], number[by_range]
        edges = np.arange(ranges + 1, dtype=np.uint64)
        cut = np.searchsorted(number, edges).tolist()
        many_range = range_of(many, ranges)
        cut_many = np.searchsorted(many_range, edges).tolist()
        home = (
            b"".join(d for d, _ in sets),
            sizes.astype(np.uint32).tobytes(),
            tokens_of(many_range, many & np.uint64((1 << REST_BITS) - 1)).tobytes(),
            many_times.tobytes(),
            text[order[several]].tobytes(),
        )
        rows = []
        for r in range(ranges):
            i, j, p, q = cut[r], cut[r + 1], cut_many[r], cut_many[r + 1]
            here = r == chunk % ranges
            if i < j or p < q or here:
                texts, counts = _stretches(own[i:j])
                rows.append(
                    (chunk, r, pack(one[i:j]), texts.tobytes(), counts.tobytes(),
                     pack(many[p:q]), many_times[p:q].tobytes(), home if here else None)
                )
        return _batch(rows, SENT)

    def gather(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, seen = Shingles(size), set()
        chunk, sets, held = TaskContext.get().partitionId() << 32, [], 0
        for part in parts:
            for text in part.column("text"):
                hashes = shingles(text.as_py())
                digest = digest_of(hashes)
                if not len(hashes) or digest in seen:
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(digest)
                sets.append((digest, hashes))
                held += len(hashes)
                if held >= CHUNK or len(sets) >= CHUNK_DOCS:
                    yield send(chunk, sets)
                    chunk, sets, held = chunk + 1, [], 0
        if sets:
            yield send(chunk, sets)

    kinds = "chunk bigint, range int, one binary, text binary, sizes binary, many binary, times binary"
    homes = "digests binary, n binary, tokens binary, times binary, texts binary"
    return docs.select("text").mapInArrow(gather, f"{kinds}, home struct<{homes}>")


HOME = pa.struct([(c, pa.binary()) for c in ("digests", "n", "tokens", "times", "texts")])
SENT = pa.schema(
    [("chunk", pa.int64()), ("range", pa.int32())]
    + [(c, pa.binary()) for c in ("one", "text", "sizes", "many", "times")]
    + [("home", HOME)]
)
COUNTED = pa.schema(
    [("chunk", pa.int64()), ("range", pa.int32())]
    + [(c, pa.binary()) for c in ("one", "text", "sizes", "seen", "many")]
    + [("home", HOME)]
)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    named = [dict(zip(HOME.names, h)) if isinstance(h, tuple) else h for h in columns[-1]]
    arrays = [pa.array(c, f.type) for c, f in zip([*columns[:-1], named], schema)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _stretches(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal neighbours as one: their value and their number."""
    if not len(values):
        return values, np.empty(0, np.uint32)
    spots = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    return values[spots], np.diff(np.concatenate((spots, [len(values)]))).astype(np.uint32)


def _counted(sent: DataFrame) -> DataFrame:
    """How many texts have each shingle; those of a single text go no further."""

    def count(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        one, many = [unpack(r["one"]) for r in rows], [unpack(r["many"]) for r in rows]
        times = np.concatenate([np.frombuffer(r["times"], np.uint32) for r in rows])
        values = np.concatenate([*one, *many])
        weight = np.concatenate([np.ones(len(values) - len(times), np.int64), times])
        _, at = np.unique(values, return_inverse=True)
        total = np.bincount(at, weights=weight)[at] if len(at) else np.empty(0)
        total = np.minimum(total, np.iinfo(np.uint32).max).astype(np.uint32)
        found, i, j = [], 0, len(values) - len(times)
        for row, own, shared in zip(rows, one, many):
            seen = total[i : i + len(own)]
            texts = np.frombuffer(row["text"], np.uint16)
            texts = np.repeat(texts, np.frombuffer(row["sizes"], np.uint32))
            kept = seen > 1
            texts, sizes = _stretches(texts[kept])
            counts = total[j : j + len(shared)].tobytes()
            i, j = i + len(own), j + len(shared)
            home = row["home"] and tuple(row["home"][c] for c in HOME.names)
            found.append(
                (row["chunk"], row["range"], pack(own[kept]), texts.tobytes(), sizes.tobytes(),
                 seen[kept].tobytes(), counts, home)
            )
        return pa.Table.from_batches([_batch(found, COUNTED)])

    kinds = "chunk bigint, range int, one binary, text binary, sizes binary, seen binary, many binary"
    homes = "digests binary, n binary, tokens binary, times binary, texts binary"
    return sent.groupBy("range").applyInArrow(count, f"{kinds}, home struct<{homes}>")


def _ordered(counted: DataFrame, similarity: int) -> DataFrame:
    """Sets whose prefix has a shingle of another text.

    ``digest, n, alone, tokens, cells``: ``alone`` shingles come first, as no other text has them;
    then the others as ``tokens``, the rarest first, ties by token. ``cells`` are for those in the
    longer prefix: how many of the tokens after each lie in each of eight cells, a byte for each.
    """

    def order(group: pa.Table) -> pa.Table:
        token, text, seen = [], [], []
        rows = sorted(group.to_pylist(), key=lambda row: row["range"])
        home = next(row["home"] for row in rows if row["home"])
        for row in rows:
            token.append(tokens_of(row["range"], unpack(row["one"])))
            texts = np.frombuffer(row["text"], np.uint16)
            text.append(np.repeat(texts, np.frombuffer(row["sizes"], np.uint32)))
            seen.append(np.frombuffer(row["seen"], np.uint32))
        times = np.frombuffer(home["times"], np.uint32)
        # The chunk's own list of shared shingles is in order of range and hash, as are the counts.
        token.append(np.repeat(np.frombuffer(home["tokens"], np.int64), times))
        many = np.concatenate([np.frombuffer(row["many"], np.uint32) for row in rows])
        seen.append(np.repeat(many, times))
        text.append(np.frombuffer(home["texts"], np.uint16))
        token, text, seen = (np.concatenate(c) for c in (token, text, seen))
        by = np.lexsort((token, seen, text))
        token, text = token[by], text[by]
        sizes = np.frombuffer(home["n"], np.uint32).tolist()
        edges = np.searchsorted(text, np.arange(len(sizes) + 1)).tolist()
        found = []
        for at, n in enumerate(sizes):
            own = token[edges[at] : edges[at + 1]]
            alone = n - len(own)
            prefix = probe_prefix(n, similarity) - alone
            if prefix > 0 and len(own):
                digest = home["digests"][16 * at : 16 * at + 16]
                found.append((digest, n, alone, own, suffix_cells(own, prefix)))
        columns = list(zip(*found)) or [()] * 5
        kinds = [pa.binary(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        names = ["digest", "n", "alone", "tokens", "cells"]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return counted.groupBy("chunk").applyInArrow(
        order, "digest binary, n int, alone int, tokens array<bigint>, cells array<bigint>"
    )


def suffix_cells(tokens: np.ndarray, prefix: int) -> np.ndarray:
    """For each token of the prefix, counts of those after it by cell, up to 255, in one number."""
    cell = (tokens & (CELLS - 1)).astype(np.int64)
    hits = np.zeros((len(tokens) + 1, CELLS), np.int64)
    hits[np.arange(len(tokens)), cell] = 1
    after = hits[::-1].cumsum(axis=0)[::-1][1 : prefix + 1]
    small = np.minimum(after, 255).astype(np.uint8)
    return np.ascontiguousarray(small).view("<i8").ravel()


def _postings(sets: DataFrame, similarity: int) -> DataFrame:
    """``token, id, n, alone, place, cells, indexed, root`` for the tokens of each prefix."""
    pairs = F.arrays_zip(F.expr("slice(tokens, 1, size(cells))").alias("token"), "cells")
    listed = sets.select("id", "n", "alone", F.posexplode(pairs).alias("nth", "pair"))
    shorter = F.expr(f"n - ({2 * similarity} * n + {99 + similarity}) div {100 + similarity} + 1")
    place = F.col("alone") + F.col("nth")
    return listed.select(
        F.col("pair.token").alias("token"),
        "id",
        "n",
        "alone",
        place.alias("place"),
        F.col("pair.cells").alias("cells"),
        (place < shorter).alias("indexed"),
        F.col("id").alias("root"),
    )


def _promising(a: str, b: str, similarity: int) -> Column:
    """May two texts be similar, if this is the first token that they share?

    Both sides are posting structs. The shorter text must have the token in its shorter prefix;
    then the length filter, the positional and the suffix filter, which splits what comes after
    the token into cells: the differences of their sizes add up to what the suffixes differ in.
    """
    first = f"({a}.n < {b}.n OR ({a}.n = {b}.n AND {a}.id < {b}.id))"
    indexed = f"if({first}, {a}.indexed, {b}.indexed)"
    lengths = f"100L * least({a}.n, {b}.n) >= {similarity}L * greatest({a}.n, {b}.n)"
    both = f"{similarity}L * ({a}.n + {b}.n)"
    need = f"(({both} + {99 + similarity}) div {100 + similarity})"
    left_a, left_b = f"({a}.n - {a}.place - 1)", f"({b}.n - {b}.place - 1)"
    positional = f"1 + least({left_a}, {left_b}) >= {need}"
    apart = " + ".join(
        f"abs((shiftrightunsigned({a}.cells, {8 * i}) & 255L)"
        f" - (shiftrightunsigned({b}.cells, {8 * i}) & 255L))"
        for i in range(CELLS)
    )
    suffix = f"{apart} <= {left_a} + {left_b} - 2 * ({need} - 1)"
    return F.expr(f"{indexed} AND {lengths} AND {positional} AND {suffix}")


POSTING = ("id", "n", "place", "cells", "indexed", "root")


def _starred(postings: DataFrame, rank: Column, similarity: int) -> DataFrame:
    """Candidates ``a, b``: each token's texts with the first of them by ``rank``.

    Texts that are in its component (``root``) already are left out.
    """
    leaders = (
        postings.groupBy("token")
        .agg(F.min_by(F.struct(*POSTING), rank).alias("x"), F.count(F.lit(1)).alias("k"))
        .filter("k > 1")
        .select("token", "x")
    )
    met = postings.select("token", F.struct(*POSTING).alias("y")).join(leaders, "token")
    met = met.filter("x.root <> y.root").filter(_promising("x", "y", similarity))
    return met.select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))


def _crossing(postings: DataFrame, similarity: int) -> DataFrame:
    """Candidates ``a, b``: texts of different components (``root``) that share a token.

    A token's texts of one component are described by their sizes and by ``reach``, the size of the
    largest partner that the positional filter lets any of them have. Most components are turned
    down by that alone. Those left meet the texts of the larger one, a component of one text by the
    filters themselves.
    """
    reach = F.expr(f"({100 + similarity}L * (n - place)) div {similarity} - n")
    ranged = postings.withColumn("reach", reach)
    held = ranged.groupBy("token", "root").agg(
        F.count(F.lit(1)).alias("k"),
        F.min("n").alias("low"),
        F.max("n").alias("high"),
        F.max("reach").alias("reach"),
        F.min_by(F.struct(*POSTING), "id").alias("y"),
    )
    sides = [
        held.select("token", F.struct("k", "root", "low", "high", "reach", "y").alias(side))
        for side in ("g", "h")
    ]

    def fits(low: str, high: str, reach: str) -> str:
        return (
            f"{low} <= h.reach AND h.low <= {reach} AND {similarity}L * {low} <= 100L * h.high"
            f" AND {similarity}L * h.low <= 100L * {high}"
        )

    larger = "(g.k > h.k OR (g.k = h.k AND g.root > h.root))"
    pairs = sides[0].join(sides[1], "token")
    pairs = pairs.filter(f"{larger} AND {fits('g.low', 'g.high', 'g.reach')}")
    members = ranged.select("token", "root", "reach", F.struct(*POSTING).alias("x"))
    one = members.join(pairs.select("token", F.col("g.root").alias("root"), "h"), ["token", "root"])
    exact = F.when(F.col("h.k") == 1, _promising("x", "h.y", similarity))
    one = one.filter(exact.otherwise(F.expr(fits("x.n", "x.n", "reach"))))
    two = members.select("token", F.col("root").alias("other"), F.col("x").alias("y"))
    many = one.filter("h.k > 1").select("token", F.col("h.root").alias("other"), "x")
    met = many.join(two, ["token", "other"]).filter(_promising("x", "y", similarity))
    alone = one.filter("h.k = 1").select("x", F.col("h.y").alias("y"))
    return met.select("x", "y").unionByName(alone).select(
        F.col("x.id").alias("a"), F.col("y.id").alias("b")
    )


def _verified(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """The pairs ``a, b`` that are similar.

    The partners of a text come to it in blocks of a few thousand, so its own set is sent once per
    block, and a text with very many partners is many blocks.
    """
    sizes = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PARTNERS).alias("blocks"))
    block = F.pmod(F.xxhash64("b"), F.col("blocks"))
    asked = pairs.join(sizes, "a").select("a", block.alias("block"), "b")
    partner = sets.select(F.col("id").alias("b"), "n", "tokens")
    own = sets.select(F.col("id").alias("a"), "n", "tokens")
    right = asked.join(partner, "b").select("a", "block", "b", "n", "tokens")
    left = asked.select("a", "block").distinct().join(own, "a")
    left = left.select("a", "block", F.lit(None).cast("bigint").alias("b"), "n", "tokens")
    streamed = (
        left.unionByName(right).repartition("a", "block").sortWithinPartitions("a", "block", "b")
    )

    def compare(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, size = np.empty(0, np.int64), 0
        for part in parts:
            found = []
            tokens = part.column("tokens")
            values, edges = tokens.values.to_numpy(), tokens.offsets.to_numpy()
            ids = zip(*(part.column(c).to_pylist() for c in ("a", "b", "n")))
            for at, (a, b, n) in enumerate(ids):
                these = values[edges[at] : edges[at + 1]]
                if b is None:
                    own, size = np.sort(these), n
                    continue
                spot = np.searchsorted(own, these)
                spot[spot == len(own)] = 0
                common = int((own[spot] == these).sum())
                if common >= least_overlap(size + n, similarity):
                    found.append((a, b))
            columns = list(zip(*found)) or [()] * 2
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], ["a", "b"]
            )

    return streamed.mapInArrow(compare, "a bigint, b bigint")


def similar_texts(
    docs: DataFrame, *, shingle: int = SHINGLE, similarity: int = SIMILARITY
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for each row of ``docs`` (``doc_id``, ``text``).

    A text's set has the distinct sequences of ``shingle`` words (A-Z lower-cased, stretches of
    anything but ASCII white space); with fewer words, the whole sequence. Texts are linked when
    the intersection of their sets has ``similarity`` per cent of the union or more. ``component_id``
    is the smallest id that links reach. NULL, empty and blank texts have no shingles and are linked
    with nothing: their own id is their component. Rows with equal sets, repeated rows among them,
    are one text to the join. NULL ids count only where a component has no other; it is NULL then.
    An empty table gives no rows. Other columns are not returned. Texts may be of any length.

    Each shingle is counted over all texts, and a set's shingles are put in order, the rarest first.
    Similar sets share one in the prefix of each; the shorter set's prefix can be half as long. So
    shingles that many texts share come into no prefix, unless a text has hardly others. Texts meet
    by the tokens of their prefixes, pass the length, positional and suffix filters and are compared
    once. In a group of near copies all meet: so first each token's texts meet one of them, that
    with the fewest shingles of its own, then another one at random, and then only those meet that
    are not yet in one component. That loses no component, and copies are not paired off.
    """
    folder = shared_folder(docs.sparkSession)
    rows = written(members(docs, shingle), folder)
    total = rows.agg(F.sum("n")).first()[0] or 0
    ranges = max(1, -(-total // RANGE))
    counted = _counted(_chunks(docs, shingle, ranges))
    distinct = _ordered(counted, similarity).dropDuplicates(["digest"])
    # Written, so the numbers of the sets stay what they are.
    sets = written(distinct.withColumn("id", F.monotonically_increasing_id()), folder)
    roots = _joined(sets, similarity, folder)
    names = sets.select(F.col("id").alias("root"), F.col("digest").alias("root_digest"))
    named = sets.select("id", "digest").join(roots, "id").join(names, "root")
    least = rows.filter("n > 0").groupBy("digest").agg(F.min("doc_id").alias("least"))
    rooted = written(
        least.join(named.select("digest", "root_digest"), "digest", "left").select(
            "digest", "least", F.coalesce("root_digest", "digest").alias("root")
        ),
        folder,
    )
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = rooted.select("digest", "root").join(ids, "root").drop("root")
    labelled = rows.join(labels, "digest", "left")
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return labelled.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


def _joined(sets: DataFrame, similarity: int, folder: str) -> DataFrame:
    """``id, root`` of the sets that are similar to another one."""
    postings = _postings(sets, similarity)
    everyone = F.struct("alone", "id")
    tested = written(_starred(postings, everyone, similarity).distinct(), folder)
    links = written(_verified(tested, sets, similarity), folder)
    roots = written(_roots(links, folder), folder)
    parted = written(_parted(postings, roots), folder)
    anyone = F.struct(F.xxhash64("token", "id"), "id")
    more = written(_untested(_starred(parted, anyone, similarity), tested), folder)
    links = written(links.unionByName(_verified(more, sets, similarity)), folder)
    roots = written(_roots(links, folder), folder)
    left = written(_parted(parted, roots), folder)
    rest = _untested(_crossing(left, similarity), tested.unionByName(more))
    rest = written(rest, folder)
    links = links.unionByName(_verified(rest, sets, similarity))
    return _roots(links, folder)


def _roots(links: DataFrame, folder: str) -> DataFrame:
    return connected_components(links, folder).select(F.col("node").alias("id"), "root")


def _parted(postings: DataFrame, roots: DataFrame) -> DataFrame:
    """Postings with the ``root`` of their text, of tokens with texts of several components."""
    rooted = postings.drop("root").join(roots, "id", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "id"))
    several = rooted.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    return rooted.join(several.filter("low < high").select("token"), "token", "left_semi")


def _untested(pairs: DataFrame, tested: DataFrame) -> DataFrame:
    """Candidates that have not been compared yet, once each, the smaller id first."""
    both = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    return pairs.select(*both).distinct().join(tested.select(*both), ["a", "b"], "left_anti")
