"""Quality rules: base columns against brute force, sketches against exact quantiles."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from bizregistry.llm.rules import GAMMA, apply_rules, merged, points, quantiles, sketches

COLUMNS = "doc_id bigint, text string, lang string, source string"
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def words(rng, n):
    return " ".join(f"{rng.choice(['al', 'be', 'cé', 'du'])}{rng.randrange(90)}" for _ in range(n))


def brute(text):
    text = text or ""
    found = re.findall("[^\x20\x09-\x0d]+", text)
    lines = [line for line in text.split("\n") if re.search("[^\x20\x09-\x0d]", line)]
    windows = [tuple(found[i : i + 8]) for i in range(len(found) - 7)]
    times, held = Counter(windows), set()
    for i, window in enumerate(windows):
        if times[window] > 1:
            held.update(range(i, i + 8))
    failed = len(found) < 20 or 100 * len(held) > 30 * len(found)
    return (
        len(found), sum(map(len, found)), sum(text.count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)), len(held), failed,
    )


def test_base_columns(spark):
    rng = random.Random(1)
    texts = [None, "", " \t", "😀 é\x1cé #", "a\n\na\n \nb\r\na", "x " * 30, words(rng, 40_000)]
    texts += [words(rng, rng.randrange(60)) for _ in range(50)]
    passage = words(rng, 12)
    texts += ["\n".join([passage, words(rng, rng.randrange(80)), passage, "# $ %"]) for _ in range(50)]
    rows = [(i, t, rng.choice(["en", None]), rng.choice(["s", "t", None])) for i, t in enumerate(texts)]
    got = {r.doc_id: r for r in apply_rules(spark.createDataFrame(rows, COLUMNS)).collect()}
    for i, text in enumerate(texts):
        assert tuple(got[i][c] for c in BASE) == brute(text)
        assert not (got[i].base_failed and got[i].kept)


def test_columns_of_the_caller_stay(spark):
    rng = random.Random(2)
    rows = [(i, words(rng, 40), "en", "s") for i in range(30)]
    mine = ["low", "high", "g_lang", "g_source", "usual", "metric", "bucket", "n", "c0", "we`ird"]
    docs = spark.createDataFrame(rows, COLUMNS)
    docs = docs.select("*", *(F.lit(f"mine {c}").alias(c) for c in mine), F.lit(1).alias("N_WORDS"))
    out = apply_rules(docs)
    assert [c for c in out.columns if c.lower() == "n_words"] == ["n_words"]
    for r in out.collect():
        assert all(r[c] == f"mine {c}" for c in mine) and r.n_words == 40 and r.kept


def stats_of(spark, values):
    rows = [(1, v, 0, 0, 0, 1) for v in values]
    kinds = "n_words int, word_chars int, n_symbols int, n_dup_lines int, n_repeat_words int, n_text_lines int"
    return spark.createDataFrame(rows, kinds).withColumn("usual", F.lit(True))


def test_quantiles_lie_within_the_error_of_a_sketch_and_merge(spark):
    rng = np.random.default_rng(3)
    values = np.sort(np.maximum(0, rng.lognormal(3, 1, 3000) - 8).astype(int))
    whole = sketches(stats_of(spark, values.tolist()), [], ["word_length"])
    shuffled = rng.permutation(values)
    parts = [sketches(stats_of(spark, p.tolist()), [], ["word_length"]) for p in np.array_split(shuffled, 3)]
    joined = merged(parts[0].unionByName(parts[1]).unionByName(parts[2]), [])
    assert sorted(map(tuple, joined.collect()), key=str) == sorted(
        map(tuple, whole.select(joined.columns).collect()), key=str
    )
    levels = {"a": 0.01, "b": 0.25, "c": 0.5, "d": 0.75, "e": 0.99, "f": 1.0}
    got = quantiles(whole, [], **levels).first()
    # A seed keeps the shape: its quantiles are those of the sketch, to a point and a bucket.
    seed = quantiles(points(whole, [], 7.0), [], **levels).first()
    assert points(whole, [], 7.0).agg(F.sum("n")).first()[0] == pytest.approx(7.0)
    for name, q in levels.items():
        exact = values[int(np.ceil(q * len(values))) - 1]
        assert exact / GAMMA <= got[name] <= exact * GAMMA
        low, high = (values[int(np.clip(q * len(values) + d, 0, len(values) - 1))] for d in (-61, 61))
        assert low / GAMMA <= seed[name] <= high * GAMMA


def grouped(rng, n, source, marks):
    """Texts of a source with a number of signs in each, at the ends of words."""
    rows = []
    for _ in range(n):
        text = words(rng, 60).split()
        for at in range(marks(rng)):
            text[at % 60] += "#"
        rows.append((" ".join(text), "en", source))
    return rows


@pytest.mark.parametrize("n", [150, 190, 210, 400])
def test_groups_of_any_size_are_judged_by_their_own_sketch(spark, n):
    """Signs that are usual in one source are odd in another, below and above 200 documents."""
    rng = random.Random(4)
    rows = grouped(rng, n, "code", lambda r: r.randrange(10, 14)) + grouped(rng, 3 * n, "prose", lambda r: 0)
    rows += [*grouped(rng, 1, "prose", lambda r: 12), *grouped(rng, 1, "code", lambda r: 60)]
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], COLUMNS)
    kept = {r.doc_id: r.kept for r in apply_rules(docs).collect()}
    assert [i for i, k in kept.items() if not k] == [4 * n, 4 * n + 1]


def test_a_small_group_leans_on_its_language(spark):
    """One document is no group of its own: it is judged mostly like the others of its language."""
    rng = random.Random(5)
    rows = grouped(rng, 600, "prose", lambda r: 0)
    long, other = (" ".join(w * 3 for w in words(rng, 60).split()) for _ in range(2))
    rows += [(long, "en", "new"), *grouped(rng, 1, "other", lambda r: 0), (other, "fr", "prose")]
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], COLUMNS)
    kept = {r.doc_id: r.kept for r in apply_rules(docs).collect()}
    assert [i for i, k in kept.items() if not k] == [600, 602]
    # Without the prior each is alone, and usual by definition.
    assert all(r.kept for r in apply_rules(docs, weight=1e-9).collect())
