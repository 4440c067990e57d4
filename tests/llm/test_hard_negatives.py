"""Hard negatives against brute force."""

import math
import random

import numpy as np
import pytest

from bizregistry.llm import hard_negatives as module
from bizregistry.llm.hard_negatives import PackedProducts, best_columns, hard_negatives

SCHEMA = "vec_id bigint, embedding array<double>, label int, extra string"


@pytest.mark.parametrize("top, narrow", [(3, True), (150, True), (1 << 20, False), (1 << 29, False)])
def test_packed_products_are_exact(top, narrow):
    rng = np.random.default_rng(3)
    anchors, rows = rng.integers(-top, top, (7, 13)), rng.integers(-top // 2, top, (23, 13))
    products = PackedProducts(anchors, rows)
    assert products.narrow == narrow and (not narrow or products.fields >= 2)
    want = [[sum(int(a) * int(b) for a, b in zip(x, y)) for y in rows] for x in anchors]
    assert products.scores(0, 7).tolist() == want
    assert products.scores(2, 4).tolist() == want[2:4]


def test_products_of_equal_signs_and_zeros():
    zeros = np.zeros((2, 3), np.int64)
    assert PackedProducts(zeros, zeros).scores(0, 2).tolist() == [[0, 0], [0, 0]]
    low = np.full((1, 2), -9)
    assert PackedProducts(low, low).scores(0, 1).tolist() == [[162]]


def test_best_columns_keep_the_first_of_ties():
    none = module.NONE
    row, column = best_columns(np.array([[5, 7, 7, 5, 7], [none, 1, none, none, none]]), 2)
    assert list(zip(row, column)) == [(0, 1), (0, 2), (1, 1)]


def brute(rows, k=5, positives=5, every=100, least=80):
    fine = [
        (i, [math.floor(256 * x) for x in v], label)
        for i, v, label, _ in rows
        if label is not None and v and all(x is not None and math.isfinite(x) for x in v)
    ]
    found = []
    for a, (i, v, label) in enumerate(fine):
        if i is None or i % every:
            continue
        scored = [
            (-sum(x * y for x, y in zip(v, w)), j is None, j or 0, b)
            for b, (j, w, _) in enumerate(fine)
            if b != a and len(v) == len(w)
        ]
        scored.sort()
        same = [s for s in scored if fine[s[3]][2] == label][:positives]
        for score, _, _, p in same:
            band = [
                s for s in scored
                if fine[s[3]][2] != label and -least * score <= -100 * s[0] <= -100 * score
            ]
            found += [
                (i, fine[p][0], rank, fine[b][0], -score, -other)
                for rank, (other, _, _, b) in enumerate(band[:k], 1)
            ]
    return sorted(found, key=str)


def table(seed, n=260, scale=1.0):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        v = [rng.gauss(0.05, 0.2) * scale for _ in range(6)]
        # A third of all rows have one label.
        rows.append((i * 10, v, 0 if rng.random() < 0.34 else rng.randrange(1, 5), "x"))
    rows += [rows[3], rows[10], (55, rows[10][1], 2, "x"), (56, rows[10][1], 2, "x")]
    rows += [(1000, [0.1, 0.2], 1, "y"), (7, [0.1, 0.3], 1, "y"), (8, [0.1, 0.2], 3, "y")]
    bad = [None, [], [None] * 6, [math.nan] * 6, [math.inf] + [0.0] * 5]
    rows += [(100 * j, v, 1, "z") for j, v in enumerate(bad)]
    return [*rows, (300, [0.1] * 6, None, "z"), (None, rows[20][1], 3, "z"), (600, [0.0] * 6, 1, "z")]


@pytest.mark.parametrize("part, anchors, scores", [(1 << 21, 8192, 1 << 22), (120, 3, 40)])
def test_hard_negatives(spark, monkeypatch, part, anchors, scores):
    for name, value in (("PART", part), ("ANCHORS", anchors), ("SCORES", scores)):
        monkeypatch.setattr(module, name, value)
    rows = table(1)
    got = hard_negatives(spark.createDataFrame(rows, SCHEMA)).collect()
    want = brute(rows)
    assert len(want) > 100 and sorted(map(tuple, got), key=str) == want


def test_other_settings_large_components_and_empty_tables(spark):
    rows = table(2, 120, 1e6)
    found = hard_negatives(spark.createDataFrame(rows, SCHEMA), k=2, positives=3, every=50, least=50)
    want = brute(rows, 2, 3, 50, 50)
    assert want and sorted(map(tuple, found.collect()), key=str) == want
    assert hard_negatives(spark.createDataFrame([], SCHEMA)).collect() == []
    alone = spark.createDataFrame([(100, [1.0], 1, ""), (101, [1.0], 2, "")], SCHEMA)
    assert hard_negatives(alone).collect() == []
