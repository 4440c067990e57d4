"""Runs of repeated words against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from bizregistry.llm.period_runs import best_run, collapse, near_repeats, period_runs, runs_of
from bizregistry.llm.queries import op11_period_runs

WHITE = b" \t\n\x0b\f\r".decode()


def brute(x, exponent=4, least=6):
    n, found = len(x), []
    for q in range(1, n // exponent + 1):
        same = [i >= q and x[i] == x[i - q] for i in range(n)] + [False]
        i = q
        while i < n:
            if not same[i]:
                i += 1
                continue
            start = i - q
            while same[i]:
                i += 1
            part = x[start:i]
            smaller = any(part[r:] == part[:-r] for r in range(1, q))
            if len(part) >= max(least, exponent * q) and not smaller:
                found.append((start, len(part), q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def sequences(count):
    rng = random.Random(11)
    for _ in range(count):
        n, letters = rng.randrange(70), rng.choice([1, 2, 2, 3, 5, 30])
        x = [rng.randrange(letters) for _ in range(n)]
        if rng.random() < 0.6 and n > 8:
            at = rng.randrange(n)
            p = rng.randrange(1, max(2, (n - at) // 4 + 1))
            x = [x[i] if i < at else x[at + (i - at) % p] for i in range(n)]
            if rng.random() < 0.3:
                x[rng.randrange(n)] = 99
        yield x


@pytest.mark.parametrize("exponent, least", [(4, 6), (2, 2), (3, 7)])
def test_runs_and_the_stretches_that_hold_them(exponent, least):
    for x in sequences(400):
        want = brute(x, exponent, least)
        assert runs_of(x, exponent, least) == want
        hashes = np.array([v * 0x9E3779B97F4A7C15 % (1 << 64) for v in x], np.uint64)
        found = []
        for first, end in near_repeats(hashes, exponent, least):
            part = runs_of(x[first:end], exponent, least)
            found += [(first + start, length, q) for start, length, q in part]
        assert found == want


def test_long_periods_and_ties():
    rng = random.Random(2)
    block = [rng.randrange(500) for _ in range(3000)]
    assert runs_of([-2, *block * 5, -3]) == [(1, 15000, 3000)]
    assert best_run([(0, 8, 2), (3, 4, 1), (9, 12, 3)]) == (0, 8, 2)
    assert best_run([]) is None
    words = [b"x", *[b"a", b"b"] * 4, b"y"]
    assert collapse(words, [(1, 8, 2)]) == [b"x", b"a", b"b", b"y"]


def test_texts(spark, docs_of):
    long = " ".join(f"w{i % 9000}" for i in range(200_000))
    texts = [None, "", " \t", "one two", "a a a a a a b", "a a a a a", "x " * 4 + "y y y y y y y z",
             "a a a a a a b", "é é é é é é", "a\x1ca a\x1ca a\x1ca a\x1ca a\x1ca a\x1ca", long]
    docs = docs_of(list(enumerate(texts)) + [(None, "q r q r q r q r")])
    got = {r.doc_id: r for r in period_runs(docs).collect()}
    for at, text in enumerate(texts[:-1]):
        words = (text or "").encode().split()
        runs = brute(words)
        kept = b" ".join(collapse(words, runs)).decode()
        best = best_run(runs) or (None,) * 3
        row = got[at]
        assert (row.n_words, row.n_runs, row.start, row.length, row.period) == (len(words), len(runs), *best)
        assert [tuple(r) for r in row.runs] == runs and row.collapsed == kept
    assert tuple(got[10].runs[0]) == (0, 200_000, 9000)
    assert got[10].collapsed.split() == [f"w{i}" for i in range(9000)]
    assert (got[None].n_runs, got[None].collapsed) == (1, "q r")


def test_repeated_rows_clashing_names_and_empty_tables(spark, docs_of):
    rows = [(1, "a a a a a a", 5, 6), (1, "a a a a a a", 5, 6)]
    odd = spark.createDataFrame(rows, "doc_id bigint, text string, N_RUNS int, `we``ird` int")
    found = period_runs(odd)
    assert [c.lower() for c in found.columns].count("n_runs") == 1
    assert [tuple(r) for r in found.select("`we``ird`", "n_runs").collect()] == [(6, 1)] * 2
    assert period_runs(docs_of([])).collect() == []
    with pytest.raises(ValueError):
        period_runs(odd, exponent=1)


def test_query(spark, docs_of, tmp_path):
    rng = random.Random(4)
    rows = [(i, " ".join(f"v{rng.randrange(300)}" for _ in range(rng.randrange(160)))) for i in range(150)]
    rows += [(201, None), (202, ""), (210, " lead ing\n\nspace\x0b of words "), (None, "a b c")]
    docs_of(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in op11_period_runs(spark, str(tmp_path)).collect()}
    assert sum(r.n_runs for r in got.values()) > 5
    for doc_id, text in rows[:-1]:
        words = (text or "").encode().split()
        n, h = len(words), zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = brute(words)
        best = best_run(runs) or (None,) * 3
        listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        want = (
            doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256(listed.encode()).hexdigest(),
            hashlib.sha256(b" ".join(collapse(words, runs))).hexdigest(),
        )
        assert tuple(got[doc_id]) == want
