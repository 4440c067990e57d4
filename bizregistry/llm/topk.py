"""Exact top-k inner products by a dual-tree search over cover trees."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shared_folder, written

K = 5
SCALE = 256
# Cells of the top level, and the bounded sample that their centres are taken from.
CELLS = 64
SAMPLE = 4_096
# Vectors in one block of a cell, queries met at once by a block, vectors in a leaf. Leaves meet in one
# matrix product, which costs less than telling smaller leaves apart where few can be left out.
BLOCK = 8_192
QUERY_BLOCK = 32_768
LEAF = 1_024
FANOUT = 16
# Scores of two leaves that are held at once: a leaf of equal rows may be large.
SCORES = 1 << 21
LAST = np.iinfo(np.int64).max
# Its negative must exist too.
NONE = np.iinfo(np.int64).min + 1


@dataclass
class Node:
    """A part of the rows: its centre is at most ``radius`` from each of them."""

    rows: np.ndarray
    center: np.ndarray
    norm: float
    radius: float
    children: list[Node]


def farthest_first(points: np.ndarray, most: int, stop: float = 0.0) -> np.ndarray:
    """Rows that are far from each other, until all are within ``stop`` of one."""
    chosen, near = [0], np.linalg.norm(points - points[0], axis=1)
    while len(chosen) < most and near.max() > stop:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, np.linalg.norm(points - points[chosen[-1]], axis=1))
    return np.array(chosen)


def cover_tree(points: np.ndarray, rows: np.ndarray | None = None) -> Node:
    """Children's centres are apart from each other and cover all, at about half the radius."""
    rows = np.arange(len(points)) if rows is None else rows
    own = points[rows]
    center = own[0]
    distance = np.linalg.norm(own - center, axis=1)
    node = Node(rows, center, float(np.linalg.norm(center)), float(distance.max()), [])
    if len(rows) <= LEAF or node.radius == 0:
        return node
    centers = own[farthest_first(own, FANOUT, node.radius / 2)]
    to = np.stack([np.linalg.norm(own - c, axis=1) for c in centers], axis=1).argmin(axis=1)
    node.children = [cover_tree(points, rows[to == i]) for i in range(len(centers))]
    return node


def bound(a: Node, b: Node) -> float:
    """No row of one has a greater inner product with a row of the other."""
    top = float(a.center @ b.center) + a.radius * b.norm + b.radius * a.norm + a.radius * b.radius
    return top + 1e-9 * (abs(top) + a.norm * b.norm) + 1e-6


class Best:
    """The best ``k`` of each query so far: score, then smaller id, NULL ids last."""

    def __init__(self, queries: int, k: int, floor: np.ndarray) -> None:
        self.score = np.full((queries, k), NONE, np.int64)
        self.id = np.full((queries, k), LAST, np.int64)
        self.row = np.full((queries, k), -1, np.int64)
        # Scores that k others are known to reach elsewhere.
        self.floor = floor

    def worst(self, rows: np.ndarray) -> int:
        return int(np.maximum(self.score[rows, -1], self.floor[rows]).min())

    def offer(self, rows: np.ndarray, score: np.ndarray, ids: np.ndarray, row: np.ndarray) -> None:
        """Scores of some queries with the rows ``row``; those that are NONE are no candidates."""
        k = self.score.shape[1]
        least = np.maximum(np.maximum(self.score[rows, -1], self.floor[rows]), NONE + 1)
        fits = score >= least[:, None]
        many = np.flatnonzero(np.count_nonzero(fits, axis=1) > k)
        if len(many):
            # Only the best k and their ties go on to be sorted.
            top = np.partition(score[many], -k, axis=1)[:, -k]
            fits[many] &= score[many] >= top[:, None]
        some = np.flatnonzero(fits.any(axis=1))
        if not len(some):
            return
        nth, at = np.nonzero(fits[some])
        rows = rows[some]
        query = np.concatenate([np.repeat(np.arange(len(some)), k), nth])
        held = {
            "score": np.concatenate([self.score[rows].ravel(), score[some[nth], at]]),
            "id": np.concatenate([self.id[rows].ravel(), ids[at]]),
            "row": np.concatenate([self.row[rows].ravel(), row[at]]),
        }
        order = np.lexsort((held["row"], held["id"], -held["score"], query))
        sorted_query = query[order]
        place = np.arange(len(order)) - np.searchsorted(sorted_query, sorted_query)
        kept = order[place < k]
        for name, value in held.items():
            getattr(self, name)[rows] = value[kept].reshape(-1, k)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products; by floating point only where that is exact."""
    top = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if top < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def dual_search(
    queries: np.ndarray,
    query_rows: np.ndarray,
    floor: np.ndarray,
    data: np.ndarray,
    data_rows: np.ndarray,
    data_ids: np.ndarray,
    k: int,
) -> Best:
    """Best ``k`` rows of ``data`` for each query but the query's own row.

    Both sides are cover trees. A pair of nodes is left out if no inner product in it can reach
    the worst k-th score of the query node; the most promising pairs come first.
    """
    best = Best(len(queries), k, floor)
    q_tree = cover_tree(queries.astype(np.float64))
    d_tree = cover_tree(data.astype(np.float64))
    heap, count = [(-bound(q_tree, d_tree), 0, q_tree, d_tree)], 0
    while heap:
        top, _, q, d = heapq.heappop(heap)
        if -top < best.worst(q.rows):
            continue
        if not q.children and not d.children:
            step = max(1, SCORES // len(d.rows))
            for start in range(0, len(q.rows), step):
                some = q.rows[start : start + step]
                score = products(queries[some], data[d.rows])
                score[query_rows[some][:, None] == data_rows[d.rows][None, :]] = NONE
                best.offer(some, score, data_ids[d.rows], data_rows[d.rows])
            continue
        for one in q.children or [q]:
            for other in d.children or [d]:
                reach = bound(one, other)
                if reach >= best.worst(one.rows):
                    count += 1
                    heapq.heappush(heap, (-reach, count, one, other))
    return best


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id, v``: ``floor(scale * x)`` of each component; bad vectors are left out."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    infinite = [F.lit(float(s)) for s in ("inf", "-inf")]
    fine = vectors.select("vec_id", x.alias("x")).filter(
        F.col("x").isNotNull()
        & (F.size("x") > 0)
        & F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & ~c.isin(*infinite))
    )
    return fine.select("vec_id", F.transform("x", lambda c: F.floor(c * scale)).alias("v"))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A column of equally long lists as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def with_cells(vectors: DataFrame, every: int) -> DataFrame:
    """``vec_id, v, is_query, dim, cell, distance``: each vector's cell of the top level.

    Centres come from a bounded sample; every vector goes to its nearest one. Vectors of other
    lengths than the sampled ones make a cell of their own, as do those of each length.
    """
    drawn = vectors.orderBy(F.xxhash64("v")).select("v").limit(SAMPLE).collect()
    by_dim: dict[int, list] = {}
    for row in drawn:
        by_dim.setdefault(len(row["v"]), []).append(row["v"])
    centers = {}
    for dim, rows in by_dim.items():
        points = np.array(rows, np.float64)
        centers[dim] = points[farthest_first(points, CELLS)]

    def assign(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            dims = part.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                some = part.take(pa.array(np.flatnonzero(dims == dim)))
                points = matrix(some.column("v")).astype(np.float64)
                pivots = centers.get(dim, np.zeros((1, dim)))
                far = np.stack([np.linalg.norm(points - c, axis=1) for c in pivots], axis=1)
                cell = far.argmin(axis=1)
                columns = [pa.array(cell.astype(np.int32)), pa.array(far.min(axis=1))]
                yield pa.RecordBatch.from_arrays(
                    [*some.columns, *columns], [*some.schema.names, "cell", "distance"]
                )

    marked = vectors.select(
        "vec_id",
        "v",
        F.coalesce(F.col("vec_id") % every == 0, F.lit(False)).alias("is_query"),
        F.size("v").alias("dim"),
    )
    found = marked.mapInArrow(
        assign,
        "vec_id bigint, v array<bigint>, is_query boolean, dim int, cell int, distance double",
    )
    return found


def _searched(queries: DataFrame, data: DataFrame, pairs: DataFrame, blocks: int, k: int):
    """Best ``k`` per query and data block, for the (query cell, data cell) pairs given.

    Data meet each block of queries once; queries go to the blocks of the cells they may find
    something in. A task holds one block of each, so a hot cell is many tasks.
    """
    unit = ["dim", "cell", "block", "query_block"]
    asked = (
        queries.join(pairs, ["dim", "cell"])
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("to_blocks") - 1)))
        .withColumn("cell", F.col("to_cell"))
        .select(F.col("rid").alias("q_rid"), F.col("v").alias("q_v"), "floor", *_renamed(unit))
    )
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    held = data.select("rid", "vec_id", "v", "dim", "cell", "block", every.alias("query_block"))

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["query", "rid", "vec_id", "score"]
        if not len(left) or not len(right):
            return pa.table([pa.array([], pa.int64())] * 4, names)
        query, rows = left.column("q_rid").to_numpy(), right.column("rid").to_numpy()
        ids = right.column("vec_id").fill_null(int(LAST)).to_numpy()
        floor = left.column("floor").to_numpy()
        best = dual_search(
            matrix(left.column("q_v")), query, floor, matrix(right.column("v")), rows, ids, k
        )
        at, nth = np.nonzero(best.row >= 0)
        found = best.id[at, nth]
        return pa.table(
            [
                pa.array(query[at]),
                pa.array(best.row[at, nth]),
                pa.array(found, mask=found == LAST),
                pa.array(best.score[at, nth]),
            ],
            names,
        )

    return (
        asked.groupBy(*(f"q_{name}" for name in unit))
        .cogroup(held.groupBy(*unit))
        .applyInArrow(search, "query bigint, rid bigint, vec_id bigint, score bigint")
    )


def _renamed(names: list[str]) -> list[Column]:
    return [F.col(name).alias(f"q_{name}") for name in names]


def _best(found: DataFrame, k: int) -> DataFrame:
    order = [F.desc("score"), F.asc_nulls_last("vec_id"), F.asc("rid")]
    rank = F.row_number().over(Window.partitionBy("query").orderBy(*order))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)


def top_k(vectors: DataFrame, *, k: int = K, every: int = 50, scale: int = SCALE) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` greatest inner products of each query.

    ``vectors`` has ``vec_id`` and ``embedding``; components are taken as ``floor(scale * x)``.
    Queries are the rows whose id ``every`` divides, candidates all rows but the query's own.
    Ties go to the smaller id, a NULL id last; equal rows of one id tie in any order.

    Queries and data share the cells of the top level, found on a sample; a cell's radii are
    measured over all of it. Each query first searches its own cell. Then pairs of cells are
    pruned by their radii against the query cell's worst k-th score, and within the pairs left
    cover trees of both sides are pruned the same way.

    Vectors that are NULL or empty or hold NULL or non-finite components take no part. Vectors of
    different lengths never meet. Repeated rows are candidates of each other. Rows with NULL ids
    are no queries. An empty table gives no rows. Scores must fit into 64 bits.
    """
    spark = vectors.sparkSession
    folder = shared_folder(spark)
    cells = with_cells(quantised(vectors, scale), every)
    # Written, so the row numbers stay what they are.
    rows = written(cells.withColumn("rid", F.monotonically_increasing_id()), folder)
    radius = F.max(F.when(F.col("is_query"), F.col("distance")))
    center = F.min_by("v", "distance")
    stats = (
        rows.groupBy("dim", "cell")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if("is_query").alias("queries"),
            F.max("distance").alias("radius"),
            radius.alias("query_radius"),
            center.alias("center"),
            F.min("distance").alias("off"),
        )
        .collect()  # A row per cell: bounded by CELLS.
    )
    sizes = {(s["dim"], s["cell"]): -(-s["n"] // BLOCK) for s in stats}
    query_blocks = max(1, -(-sum(s["queries"] for s in stats) // QUERY_BLOCK))
    if not stats or not any(s["queries"] for s in stats):
        schema = "query_id bigint, rank int, vec_id bigint, score bigint"
        return spark.createDataFrame([], schema)

    def pairs_of(found: list[tuple[int, int, int]]) -> DataFrame:
        listed = [(d, a, b, sizes[d, b]) for d, a, b in found]
        schema = "dim int, cell int, to_cell int, to_blocks int"
        return F.broadcast(spark.createDataFrame(listed, schema))

    blocks = spark.createDataFrame([(*c, n) for c, n in sizes.items()], "dim int, cell int, n int")
    block: Column = F.pmod(F.xxhash64("rid"), F.col("n")).cast("int")
    data = rows.join(F.broadcast(blocks), ["dim", "cell"]).withColumn("block", block)
    query_block = F.pmod(F.xxhash64("rid"), F.lit(query_blocks)).cast("int")
    queries = rows.filter("is_query").withColumn("query_block", query_block)
    home = [(s["dim"], s["cell"], s["cell"]) for s in stats if s["queries"]]
    unseeded = queries.withColumn("floor", F.lit(int(NONE)))
    first = written(
        _best(_searched(unseeded, data, pairs_of(home), query_blocks, k), k), folder
    )
    kth = first.filter(F.col("rank") == k).select(F.col("query").alias("rid"), "score")
    seeded = written(
        queries.join(kth, "rid", "left").withColumn(
            "floor", F.coalesce("score", F.lit(int(NONE)))
        ),
        folder,
    )
    worst = {
        (w["dim"], w["cell"]): w["floor"]
        for w in seeded.groupBy("dim", "cell").agg(F.min("floor").alias("floor")).collect()
    }

    def node(cell, radius: float) -> Node:
        # The cell's own innermost vector serves as centre, so the radius grows by its distance.
        center = np.array(cell["center"], np.float64)
        reach = radius + cell["off"]
        return Node(np.empty(0), center, float(np.linalg.norm(center)), reach, [])

    found = [
        (a["dim"], a["cell"], b["cell"])
        for a in stats
        for b in stats
        if a["queries"]
        and a["dim"] == b["dim"]
        and a["cell"] != b["cell"]
        and bound(node(a, a["query_radius"]), node(b, b["radius"])) >= worst[a["dim"], a["cell"]]
    ]
    every_one = first.drop("rank")
    if found:
        other = _searched(seeded, data, pairs_of(found), query_blocks, k)
        every_one = every_one.unionByName(other)
    ids = queries.select(F.col("rid").alias("query"), F.col("vec_id").alias("query_id"))
    return (
        _best(every_one, k)
        .join(ids, "query")
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
