"""The n-gram join against brute force, and its counts of candidates."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from bizregistry.llm import ngram_join as module
from bizregistry.llm.ngram_join import Shingles, pack, similar_texts, suffix_cells, unpack


def sets_of(text, size=5):
    words = (text or "").encode().lower().split()
    spans = [tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    return frozenset(spans) if words else frozenset()


def brute(rows, size=5, similarity=80):
    sets = [sets_of(text, size) for _, text in rows]
    group = list(range(len(rows)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= similarity * len(a | sets[j]):
                group[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        ids = [x for x in (least.get(find(i)), doc_id) if x is not None]
        least[find(i)] = min(ids, default=None)
    return sorted(
        ((doc_id, len(s), least[find(i)]) for i, ((doc_id, _), s) in enumerate(zip(rows, sets))),
        key=str,
    )


def words(rng, n, vocabulary=4000):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def corpus(seed):
    rng = random.Random(seed)
    texts = [" ".join(words(rng, rng.randrange(3, 120))) for _ in range(60)]
    # Near copies of one text at all distances, with and without that text itself.
    for base in (words(rng, 150), words(rng, 300)):
        for _ in range(40):
            copy = list(base)
            for _ in range(rng.randrange(7)):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(10**6)}"
            texts.append(" ".join(copy[rng.randrange(6) : len(copy) - rng.randrange(6)]))
    texts.append(" ".join(base))
    # A chain, whose ends are not similar.
    long = words(rng, 400)
    texts += [" ".join(long[i : i + 200]) for i in range(0, 200, 12)]
    # A passage that all have, in texts of their own words.
    shared = words(rng, 60)
    texts += [" ".join([*shared, *words(rng, 40)]) for _ in range(40)]
    texts += [texts[0]] * 30 + [texts[3].upper(), texts[5].replace(" ", "\n\t")]
    texts += [None, "", " \n", "a b", "A  b", "a b c", "a b c d e", "é b", "É b", "a\x1cb"]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("seed, size, similarity", [(1, 5, 80), (2, 5, 50), (3, 2, 90), (4, 5, 100)])
def test_components(spark, docs_of, monkeypatch, seed, size, similarity):
    for name, value in (("RANGE", 900), ("CHUNK", 700), ("SEEN", 20), ("PARTNERS", 7)):
        monkeypatch.setattr(module, name, value)
    rows = corpus(seed)
    docs = docs_of(rows).repartition(5)
    found = similar_texts(docs, shingle=size, similarity=similarity).collect()
    assert sorted(map(tuple, found), key=str) == brute(rows, size, similarity)


def test_null_ids_repeated_rows_extra_columns_and_empty_tables(spark, docs_of):
    text = " ".join(words(random.Random(7), 50))
    rows = [(None, text), (9, text), (4, text), (4, text), (None, "alone one"), (7, ""), (None, None)]
    docs = docs_of(rows).withColumn("n", F.lit(1)).withColumn("digest", F.lit("d"))
    assert sorted(map(tuple, similar_texts(docs).collect()), key=str) == brute(rows)
    assert similar_texts(docs_of([])).collect() == []
    assert [tuple(r) for r in similar_texts(docs_of([(1, None)])).collect()] == [(1, 0, 1)]


def test_very_long_texts(docs_of):
    rng = random.Random(8)
    long = words(rng, 60_000, 10**6)
    changed = [w if i % 1000 else "other" for i, w in enumerate(long)]
    rows = [(5, " ".join(long)), (6, " ".join(changed)), (2, " ".join(long[:40_000]))]
    got = {r.doc_id: r.component_id for r in similar_texts(docs_of(rows)).collect()}
    assert got == {5: 5, 6: 5, 2: 2}


def candidates(docs, monkeypatch):
    """Pairs that were compared, in all rounds."""
    compared = []

    def counting(pairs, *rest):
        compared.append(pairs.count())
        return verified(pairs, *rest)

    verified = module._verified
    monkeypatch.setattr(module, "_verified", counting)
    found = similar_texts(docs).collect()
    return sum(compared), len({r.component_id for r in found})


def test_a_common_template_makes_no_candidates(docs_of, monkeypatch):
    rng = random.Random(9)
    template = words(rng, 300)
    rows = [(i, " ".join([*template, *words(rng, 60, 10**6)])) for i in range(300)]
    compared, groups = candidates(docs_of(rows), monkeypatch)
    assert groups == 300 and compared <= 300


def test_a_group_of_near_copies_is_not_paired_off(docs_of, monkeypatch):
    rng = random.Random(10)
    base, rows = words(rng, 300), []
    for i in range(300):
        copy = list(base)
        for _ in range(2):
            copy[rng.randrange(300)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(copy)))
    compared, groups = candidates(docs_of(rows), monkeypatch)
    # All 44 850 pairs are similar.
    assert groups == 1 and compared <= 12 * 300


def test_packing_and_cells():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 1 << 40, 50, dtype=np.uint64)
    assert (unpack(pack(values | np.uint64(7 << 40))) == values).all()
    tokens = rng.integers(0, 1 << 50, 600)
    cells = suffix_cells(tokens, 3).astype(np.int64)
    for at in range(3):
        want = np.bincount(tokens[at + 1 :] & 7, minlength=8)
        assert [int(cells[at]) >> 8 * i & 255 for i in range(8)] == want.tolist()
    assert suffix_cells(np.zeros(900, np.int64), 1)[0] & 255 == 255
    assert len(Shingles(5)("A b\x0bc")) == 1 and len(Shingles(5)(" ")) == 0
