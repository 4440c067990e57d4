"""Operators against brute force, on small tables with NULLs, ties and repeated rows."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from bizregistry.llm.components import connected_components
from bizregistry.llm.lengths import at_limits, length_histogram, token_counts
from bizregistry.llm import packing
from bizregistry.llm.lines import LineRuns, dedup_lines
from bizregistry.llm.packing import pack_documents, pack_lengths, places, sequences
from bizregistry.llm.quality import fit
from bizregistry.llm.rules import apply_rules
from bizregistry.llm.sharding import even_map, latest_map, rebalance, shard_documents
from bizregistry.llm.simhash import drop_near_duplicates, fingerprint, links, near_duplicates
from bizregistry.llm.substring import dedup_substrings, word_digests
from bizregistry.llm.topk import dual_search, products, top_k
from bizregistry.llm.word_bpe import Transducer, WordBpe, encoded

BYTE = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    None, "", " ", "  two  spaces ", "a\n\n b \t c\x1cd", "don't WE'LL 12½ ² ЖΣΑΣ İi é",
    "x<|endoftext|> y <|endoftext|>", "　wide space ", "😀😀 ok", "z" * 700, "a b" * 300,
]


def words(rng, n):
    return " ".join(rng.choice(["al", "be", "ce", "du", "ef", "gi"]) + str(rng.randrange(90)) for _ in range(n))


def test_fingerprint_bits():
    text = "One two  THREE four\nfive six é"
    parts = ["one two three four", "two three four five", "three four five six", "four five six é"]
    hashes = [xxhash.xxh64_intdigest(p.encode(), seed=42) for p in parts]
    want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > 4)
    assert fingerprint(text) % (1 << 64) == want
    assert fingerprint(None) == fingerprint(" \n") == 0


@pytest.mark.parametrize("prefix", [8, 12])
def test_links_connect_what_is_near(spark, prefix):
    rng = random.Random(1)
    fps = [rng.getrandbits(64) for _ in range(40)]
    for _ in range(160):
        fp = rng.choice(fps)
        for bit in rng.sample(range(64), rng.randrange(1, 7)):
            fp ^= 1 << bit
        fps.append(fp)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    found = links(spark.createDataFrame([(f,) for f in signed], "fp bigint"), prefix=prefix)
    got = {r.node: r.root for r in connected_components(found).collect()}
    group = {f: f for f in signed}
    for _ in range(len(fps)):
        for a, fa in zip(fps, signed):
            for b, fb in zip(fps, signed):
                if (a ^ b).bit_count() <= 4:
                    group[fa] = group[fb] = min(group[fa], group[fb])
        if all(group[group[f]] == group[f] for f in signed):
            break
    assert {f: got.get(f, f) for f in signed} == group


def test_links_refuse_odd_radii(spark):
    with pytest.raises(ValueError, match="even"):
        links(spark.createDataFrame([(0,), (1,)], "fp bigint"), radius=1)


def test_near_duplicates_edges(docs_of):
    rows = [(5, "a b c d e"), (2, "A b c d e"), (None, "a b c d e"), (7, None), (8, ""), (9, "q"), (9, "q")]
    got = near_duplicates(docs_of(rows)).select("doc_id", "component_id").collect()
    assert Counter(map(tuple, got)) == Counter([(5, 2), (2, 2), (None, 2), (7, 7), (8, 7), (9, 9), (9, 9)])
    kept = drop_near_duplicates(docs_of(rows).withColumn("fp", F.lit("x"))).collect()
    assert sorted(r.doc_id for r in kept) == [2, 7, 9]
    assert near_duplicates(docs_of([])).isEmpty()


def test_components_without_an_id_of_their_own_stay_apart(docs_of):
    rng = random.Random(2)
    a, b, c, d, e = (words(rng, 60) for _ in range(5))
    rows = [(None, a), (None, a), (None, b), (3, c), (3, d), (4, d), (None, e), (5, e)]
    kept = drop_near_duplicates(docs_of(rows)).collect()
    want = [(None, a), (None, b), (3, c), (3, d), (5, e)]
    assert Counter((r.doc_id, r.text) for r in kept) == Counter(want)


def test_lines(docs_of):
    line, other = "Shared line " * 5, "x" * 40
    rows = [(i, f"{line}\nown {i}\n {line.upper()}") for i in range(6)]
    rows += [(3, f"{line}\nown 3\n {line.upper()}"), (None, line), (8, None), (9, ""), (10, other), (11, other)]
    out = dedup_lines(docs_of(rows).withColumn("n_lines", F.lit("old"))).collect()
    got = {(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in out}
    assert len(out) == len(rows)
    want = {(i, f"own {i}", 3, 2) for i in range(5)}
    want |= {(5, f"{line}\nown 5\n {line.upper()}", 3, 0), (None, "", 1, 1), (8, None, 1, 0)}
    assert got == want | {(9, "", 1, 0), (10, other, 1, 0), (11, other, 1, 0)}
    assert dedup_lines(docs_of([])).isEmpty()


@pytest.mark.parametrize("parts", [1, 9])
def test_substrings(docs_of, parts):
    rng = random.Random(3)
    passage = words(rng, 50)
    texts = [f"{words(rng, i)} {passage}\n{words(rng, 3)}" for i in range(0, 60, 7)]
    texts += [passage, passage, words(rng, 34), None, "", f"{passage} {passage}", words(rng, 400)]
    rows = list(enumerate(texts)) + [(0, texts[0])]
    split = [(text or "").split() for _, text in rows]
    seen = Counter(tuple(w[i : i + 35]) for w in split for i in range(len(w) - 34))
    want = []
    for (doc, text), w in zip(rows, split):
        gone = {j for i in range(len(w) - 34) if seen[tuple(w[i : i + 35])] > 1 for j in range(i, i + 35)}
        want.append((doc, len(gone), tuple(x for i, x in enumerate(w) if i not in gone)))
    got = dedup_substrings(docs_of(rows).repartition(parts)).collect()
    assert Counter((r.doc_id, r.n_removed, tuple((r.text or "").split())) for r in got) == Counter(want)
    assert [r.text for r in got if r.doc_id == 12] == [None]
    assert dedup_substrings(docs_of([])).isEmpty()


def test_word_bpe_is_the_librarys(docs_of):
    library, rng = Tokenizer.from_file(WORD), random.Random(5)
    texts = [*ODD, *(words(rng, 30) for _ in range(5)), "".join(rng.choices("abcdeé", k=900))]
    got = {r.doc_id: r for r in encoded(docs_of(list(enumerate(texts))), WORD, most=20).collect()}
    for i, text in enumerate(texts):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert (got[i].n_tokens, got[i].ids) == (len(ids), ids), text
        assert got[i].decoded == library.decode(ids, skip_special_tokens=False)


def test_word_bpe_of_repeated_rows_and_empty_tables(docs_of):
    text = "Some words, some more: don't stop"
    got = encoded(docs_of([(1, text), (1, text), (None, text)]), WORD).collect()
    assert len(got) == 3 and len({(tuple(r.ids), r.decoded) for r in got}) == 1
    assert encoded(docs_of([]), WORD).isEmpty()


def test_word_bpe_forgets_nothing_that_counts():
    """A small memory gives the same ids as none."""
    library, rng, plain = Tokenizer.from_file(WORD), random.Random(6), WordBpe(WORD, known=5)
    texts = [*ODD, *(words(rng, 60).replace("7", ",") for _ in range(30))]
    for text in texts * 2:
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert plain.encode(text) == ids
        n, written, decoded = plain.written_out(text)
        assert (n, written) == (len(ids), " ".join(map(str, ids)))
        assert decoded == library.decode(ids, skip_special_tokens=False)
        assert len(plain.known) < 400


def test_transducer():
    lexicon = {w.encode(): [i, 2 * i] for i, w in enumerate(sorted(["a", "ab", "tops", "taps", "stops", "é"]))}
    entries = sorted(lexicon.items())
    automaton = Transducer(Transducer.compile(entries))
    assert {w: automaton.get(w) for w in lexicon} == lexicon
    assert [automaton.get(w) for w in (b"", b"t", b"top", b"topsy", b"x")] == [None] * 5
    plain = WordBpe(WORD)
    long = "ab" * 400 + "thing"
    assert plain.merge(long) == Tokenizer.from_file(WORD).encode(long).ids


def test_counts_and_packing(docs_of):
    library, rng = Tokenizer.from_file(BYTE), random.Random(7)
    texts = [*ODD, *(words(rng, rng.randrange(1, 700)) for _ in range(40))]
    texts += texts[-3:]
    docs = docs_of(list(enumerate(texts)))
    ids = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    sizes = np.array([len(i) for i in ids])
    counts = token_counts(length_histogram(docs, BYTE))
    for r in counts.collect():
        assert (r.n_docs, r.n_longer) == ((sizes == r.length).sum(), (sizes > r.length).sum())
        assert r.tokens_truncated == np.minimum(sizes, r.length).sum()
    for r in at_limits(counts, [0, 7, 500, 10**6]).collect():
        assert r.tokens_truncated == np.minimum(sizes, r.context_limit).sum()
    packed = pack_documents(docs, BYTE, with_ids=True)
    rows = packed.collect()
    whole = {}
    for r in sorted(rows, key=lambda r: r.piece):
        assert r.start == len(whole.setdefault(r.doc_id, [])) and r.length == len(r.ids) <= 1024
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        whole[r.doc_id] += r.ids
    assert whole == {i: [*x, 2] for i, x in enumerate(ids)}
    by_sequence = {}
    for r in sorted(rows, key=lambda r: r.offset):
        assert r.offset == len(by_sequence.setdefault(r.sequence_id, []))
        by_sequence[r.sequence_id] += r.ids
    assert {r.sequence_id: r.ids for r in sequences(packed).collect()} == by_sequence
    assert len(by_sequence) <= -(-sum(len(x) + 1 for x in ids) // 1024) + 1
    assert pack_documents(docs_of([]), BYTE).isEmpty()


def test_pack_lengths_keeps_all():
    rng = random.Random(9)
    histogram = {rng.randrange(1, 101): rng.randrange(1, 50) for _ in range(60)}
    runs = pack_lengths(histogram, 100)
    used = Counter()
    for run in runs:
        assert sum(run.items) <= 100 and sum(3 * i > 100 for i in run.items) <= 2
        for item in run.items:
            used[item] += run.count
    assert used == Counter(histogram)
    assert {s: int(r[-1]) < histogram[s] for s, (r, _, _) in places(runs).items()} == dict.fromkeys(histogram, True)


def test_sharding(docs_of):
    rng = random.Random(11)
    rows = [(i, "é" * rng.randrange(400)) for i in range(300)] + [(None, "t"), (None, None), (1, "t"), (1, "t")]
    got = shard_documents(docs_of(rows), shards=7, slots=256).collect()
    want = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    load = Counter()
    for shard in range(7):
        own = [r for r in got if r.shard == shard]
        assert sorted(r.slot for r in own) == list(range(len(own)))
        load[shard] = sum(r["size"] for r in own)
    assert max(load.values()) - min(load.values()) < 0.01 * max(load.values())
    loads = {s: rng.randrange(1, 1000) for s in range(256)}
    four = rebalance(even_map(4, 256), loads, 4)
    five = rebalance(four, loads, 5)
    assert sum(a != b for a, b in zip(four, five)) < 100
    assert shard_documents(docs_of([])).isEmpty()


def shards_of(rows, shards):
    """Bytes by shard; the places in each must be gapless."""
    held = {}
    for r in rows:
        held.setdefault(r.shard, []).append(r)
    for own in held.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    assert set(held) <= set(range(shards))
    return [sum(r.size for r in held.get(s, [])) for s in range(shards)]


def test_sharding_of_repeated_rows(docs_of):
    """A third of all rows are one row, whose slot is cut into parts."""
    rng = random.Random(12)
    rows = [(i, words(rng, rng.randrange(1, 40))) for i in range(4000)]
    rows += [(7, words(rng, 30))] * 2000 + [(None, None)] * 300
    got = shard_documents(docs_of(rows).repartition(6), shards=10, slots=256).collect()
    sizes = shards_of(got, 10)
    assert len(got) == len(rows) and max(sizes) - min(sizes) < 0.02 * sum(sizes) / 10
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)


def test_sharding_edits_the_stored_map(spark, docs_of, tmp_path):
    """More data, one more shard, then fewer: each call stores the next version."""
    rng, folder = random.Random(13), str(tmp_path)
    rows = [(i, words(rng, rng.randrange(1, 40))) for i in range(3000)]
    first = {r.doc_id: r.shard for r in shard_documents(docs_of(rows), shards=6, slots=256, folder=folder).collect()}
    assert latest_map(spark, f"{folder}/map").version == 2
    again = shard_documents(docs_of(rows), shards=6, slots=256, folder=folder).collect()
    assert {r.doc_id: r.shard for r in again} == first
    more = rows + [(9000 + i, words(rng, 20)) for i in range(500)] + [(5, words(rng, 9))] * 900
    got = shard_documents(docs_of(more), shards=7, slots=256, folder=folder).collect()
    sizes = shards_of(got, 7)
    assert max(sizes) - min(sizes) < 0.05 * sum(sizes) / 7
    moved = sum(first[r.doc_id] != r.shard for r in got if r.doc_id in first and r.doc_id != 5)
    assert moved < 0.4 * len(rows)
    sizes = shards_of(shard_documents(docs_of(rows), shards=3, slots=256, folder=folder).collect(), 3)
    assert max(sizes) - min(sizes) < 0.05 * sum(sizes) / 3
    assert latest_map(spark, f"{folder}/map").version == 5
    # A version that was not written whole does not count.
    (tmp_path / "map" / "version=9").mkdir()
    assert latest_map(spark, f"{folder}/map").version == 5
    with pytest.raises(ValueError):
        shard_documents(docs_of(rows), slots=128, folder=folder)


@pytest.mark.parametrize("text, share", [("word " * 3000, 0), ("a b c d", 1)])
def test_a_length_that_most_pieces_have_is_no_hot_task(spark, docs_of, monkeypatch, text, share):
    """Nine in ten pieces are full, or of one other length: none of them is sorted in one task."""
    monkeypatch.setattr(packing, "PART", 40)
    monkeypatch.setattr(packing, "PARTS", 8)
    rng = random.Random(21)
    docs = docs_of([(i, text) for i in range(900)] + [(1000 + i, words(rng, 1 + i)) for i in range(100)])
    packed = pack_documents(docs.repartition(6), BYTE)
    rows = packed.collect()
    held = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == held.get(r.sequence_id, 0)
        held[r.sequence_id] = r.offset + r.length
    assert max(held.values()) <= 1024 and Counter(r.doc_id for r in rows).keys() == set(range(900)) | set(range(1000, 1100))
    # No two pieces above half the capacity fit together.
    least = max(sum(r.length for r in rows) / 1024, sum(2 * r.length > 1024 for r in rows))
    assert len(held) <= least * 1.02 + 2
    full = sum(r.length == 1024 for r in rows)
    assert (full > 0.6 * len(rows)) == (not share)
    plan = packed._jdf.queryExecution().optimizedPlan().toString()
    window = plan.index("Window")
    assert "length" in plan[window:] and "< 1024" in plan[window:]
    if share:
        # 900 pieces of one length are numbered in 23 groups.
        groups = plan[plan.index("Map(") if "Map(" in plan else 0 :]
        assert Counter(r.length for r in rows).most_common(1)[0][1] >= 900 and "23" in groups


def test_lines_of_text_ids_and_clashing_names(spark, docs_of):
    line = "Shared line " * 5
    rows = [(f"d{i}", f"{line}\nown {i}", 7, 8) for i in range(6)] + [(None, line, 7, 8)]
    docs = spark.createDataFrame(rows, "doc_id string, text string, N_LINES int, `odd``name` int")
    out = dedup_lines(docs)
    assert [c.lower() for c in out.columns] == ["doc_id", "text", "odd`name", "n_lines", "n_dropped"]
    got = {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in out.collect()}
    want = {f"d{i}": (f"own {i}", 2, 1) for i in range(5)}
    assert got == want | {"d5": (f"{line}\nown 5", 2, 0), None: ("", 1, 1)}


def test_a_failed_line_dedup_leaves_no_tables(spark, docs_of, monkeypatch):
    line = "Shared line " * 5
    docs = docs_of([(i, f"{line}\nown {i}") for i in range(9)])
    store, calls = LineRuns._store, []

    def failing(self, run, level):
        if len(calls) == 2:
            raise OSError("no space")
        calls.append(level)
        store(self, run, level)

    monkeypatch.setattr(LineRuns, "_store", failing)
    with pytest.raises(OSError, match="no space"):
        dedup_lines(docs)
    assert calls and not [t.name for t in spark.catalog.listTables() if t.name.startswith("llm_run")]


def test_rules(spark):
    rng = random.Random(13)
    rows = [(i, words(rng, 60), "en", "s") for i in range(250)]
    rows += [(900, words(rng, 60).replace(" ", "### "), "en", "s"), (901, "a b " * 50, None, None)]
    rows += [(902, None, "en", None), (903, words(rng, 40), None, "t"), (904, "w\n" * 30 + words(rng, 90), "en", "s")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    got = {r.doc_id: r for r in apply_rules(docs).collect()}
    assert all(got[i].kept for i in range(250)) and got[903].kept
    assert not any(got[i].kept for i in (900, 901, 902))
    assert [got[i].base_failed for i in (900, 901, 902)] == [False, True, True]
    assert got[904].n_dup_lines == 29
    assert apply_rules(docs.limit(0)).isEmpty()


def test_each_rule_rejects_by_its_adaptive_threshold(spark):
    rng = random.Random(14)

    def lines():
        return [words(rng, 6) for _ in range(10)]

    texts = ["\n".join(lines()) for _ in range(400)]
    marked, doubled, passage = lines(), lines(), words(rng, 8)
    marked[4] += " #"
    doubled[7] = doubled[2]
    odd = {
        "symbols": "\n".join(marked),
        "dup_lines": "\n".join(doubled),
        "repeats": "\n".join([f"{passage} {passage}", *lines()]),
        "word_length": " ".join(w + "x" for w in " ".join(lines()).split()),
    }
    rows = [(str(i), t, "en", "s") for i, t in enumerate(texts)] + [(k, t, "en", "s") for k, t in odd.items()]
    docs = spark.createDataFrame(rows, "doc_id string, text string, lang string, source string")
    got = apply_rules(docs).collect()
    assert not any(r.base_failed for r in got)
    assert {r.doc_id for r in got if not r.kept} == set(odd)


def test_positive_unlabelled_fit():
    rng = np.random.default_rng(15)
    good, bad = rng.normal(0, 1, (2000, 3)), rng.normal(4, 1, (400, 3))
    model = fit(good[:800], np.vstack([good[800:], bad]))
    assert 0.6 < model.prior < 0.95
    assert (model.score(good) > 0.5).mean() > 0.97 and (model.score(bad) < 0.5).mean() > 0.9


def test_top_k(spark):
    rng = np.random.default_rng(17)
    base = rng.normal(0, 0.2, (12, 8))
    vectors = [(int(i), (base[i % 12] + rng.normal(0, 0.02, 8)).tolist()) for i in range(600)]
    vectors += [(50, vectors[7][1]), (601, None), (602, [float("nan")] * 8), (None, vectors[0][1]), (603, [])]
    vectors += [(604, [None] * 8), (605, [float("inf")] * 8), (606, vectors[0][1])]
    frame = spark.createDataFrame(vectors, "vec_id bigint, embedding array<double>")
    live = [(i, np.floor(256 * np.array(v)).astype(int)) for i, v in vectors if v and np.isfinite(np.array(v, float)).all()]
    want = Counter()
    for at, (i, v) in enumerate(live):
        if i is not None and i % 50 == 0:
            scored = [(-int(v @ w), j is None, j or 0) for n, (j, w) in enumerate(live) if n != at]
            for rank, (score, none, j) in enumerate(sorted(scored)[:5], 1):
                want[i, rank, None if none else j, -score] += 1
    got = top_k(frame).collect()
    assert Counter((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == want
    assert top_k(frame.limit(0)).isEmpty()


def test_dual_search_meets_leaves_in_few_products(monkeypatch):
    """Vectors in all directions leave nothing out, so the work is that of few large products."""
    rng = np.random.default_rng(5)
    data = rng.integers(-100, 101, (4000, 48))
    data[7::500] = data[7]
    rows, asked = np.arange(4000), np.arange(0, 4000, 8)
    met = []

    def counted(a, b):
        met.append(len(a) * len(b))
        return products(a, b)

    monkeypatch.setattr("bizregistry.llm.topk.products", counted)
    monkeypatch.setattr("bizregistry.llm.topk.SCORES", 50_000)
    floor = np.full(500, np.iinfo(np.int64).min + 1)
    best = dual_search(data[asked], asked, floor, data, rows, rows, 5)
    score = data[asked] @ data.T
    score[np.arange(500), asked] = np.iinfo(np.int64).min + 1
    want = np.lexsort((np.broadcast_to(rows, score.shape), -score), axis=1)[:, :5]
    assert (best.row == want).all() and (best.id == want).all()
    assert (best.score == np.take_along_axis(score, want, axis=1)).all()
    assert max(met) <= 50_000 and len(met) < 200


def test_dual_search_fewer_than_k():
    v = np.array([[1, 0], [0, 1]])
    rows = np.arange(2)
    best = dual_search(v, rows, np.full(2, -(2**62)), v, rows, rows, 5)
    assert (best.row[:, 0] == [1, 0]).all() and (best.row[:, 1:] == -1).all()


def test_word_digests(docs_of):
    got = {r.doc_id: r for r in word_digests(docs_of([(1, " a\tb\x1c"), (2, None), (3, "é")])).collect()}
    want = {1: (2, "a b\x1c"), 2: (0, ""), 3: (1, "é")}
    for doc_id, (n, text) in want.items():
        assert (got[doc_id].n_words, got[doc_id].words_sha256) == (n, hashlib.sha256(text.encode()).hexdigest())
