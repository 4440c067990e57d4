"""Runs of repeated word sequences by a suffix automaton with link-cut access."""

from __future__ import annotations

from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from .common import unclashing
from .substring import WordHashes, split_words

EXPONENT = 4
LENGTH = 6
# Words of whole texts that a task looks at together; a longer text is looked at alone.
CHUNK = 500_000

Run = tuple[int, int, int]


class LinkedAutomaton:
    """Suffix automaton of a growing sequence whose link tree is kept as a link-cut tree.

    The nodes on the path from the state of the whole sequence to the root are its suffixes.
    Preferred paths, kept as splay trees by depth, hold the nodes that occurred last at the same
    place: that place, a path's colour, is stored at the splay tree's root. Appending a word
    recolours the path of its state; each segment of another colour that this meets tells where
    the suffixes of up to a length occurred last before.
    """

    def __init__(self) -> None:
        # State 0 is none, 1 the empty sequence. The first transition of a state lies in arrays,
        # further ones, which few states have, in a dictionary.
        self.length, self.link = array("i", [0, 0]), array("i", [0, 0])
        self.word, self.target = array("i", [-1, -1]), array("i", [0, 0])
        self.more: dict[int, dict[int, int]] = {}
        self.up, self.shallow, self.deep = (array("i", [0, 0]) for _ in range(3))
        self.colour = array("i", [-1, -1])
        self.last, self.n = 1, 0

    def _state(self, length: int, link: int) -> int:
        self.length.append(length)
        self.link.append(link)
        self.word.append(-1)
        self.target.append(0)
        for child in (self.shallow, self.deep):
            child.append(0)
        self.up.append(link)
        self.colour.append(-1)
        return len(self.length) - 1

    def _next(self, state: int, word: int) -> int:
        if self.word[state] == word:
            return self.target[state]
        more = self.more.get(state)
        return more.get(word, 0) if more else 0

    def _set(self, state: int, word: int, target: int) -> None:
        if self.word[state] in (-1, word):
            self.word[state], self.target[state] = word, target
        else:
            self.more.setdefault(state, {})[word] = target

    def _splay(self, x: int) -> None:
        """Make a node the root of its path's splay tree; the colour moves with the root."""
        up, low, high, colour = self.up, self.shallow, self.deep, self.colour
        while True:
            p = up[x]
            if not p or (low[p] != x and high[p] != x):
                return
            g = up[p]
            turns = (x,)
            if g and (low[g] == p or high[g] == p):
                turns = (p, x) if (low[g] == p) == (low[p] == x) else (x, x)
            for y in turns:
                p = up[y]
                g = up[p]
                if low[p] == y:
                    inner = high[y]
                    low[p], high[y] = inner, p
                else:
                    inner = low[y]
                    high[p], low[y] = inner, p
                if inner:
                    up[inner] = p
                if g:
                    if low[g] == p:
                        low[g] = y
                    elif high[g] == p:
                        high[g] = y
                up[y], up[p] = g, y
                colour[y] = colour[p]

    def append(self, word: int) -> list[tuple[int, int]]:
        """Add a word; returns (end of the last occurrence before, longest such suffix) segments."""
        length, link = self.length, self.link
        state, p = self._state(length[self.last] + 1, 0), self.last
        while p and not self._next(p, word):
            self._set(p, word, state)
            p = link[p]
        if p:
            q = self._next(p, word)
            if length[p] + 1 < length[q]:
                q = self._split(p, q, word)
        else:
            q = 1
        link[state] = self.up[state] = q
        self.last = state
        return self._access(state)

    def _split(self, p: int, q: int, word: int) -> int:
        """A state for the shorter suffixes of ``q``, put between it and its link."""
        link = self.link
        clone = self._state(self.length[p] + 1, link[q])
        self.word[clone], self.target[clone] = self.word[q], self.target[q]
        if q in self.more:
            self.more[clone] = dict(self.more[q])
        # It occurred last where ``q`` did, so it joins that path, just above ``q``.
        self._splay(q)
        above = self.shallow[q]
        self.shallow[clone], self.shallow[q], self.up[clone] = above, clone, q
        if above:
            self.up[above] = clone
        link[q] = clone
        while p and self._next(p, word) == q:
            self._set(p, word, clone)
            p = link[p]
        return clone

    def _access(self, state: int) -> list[tuple[int, int]]:
        up, deep, colour, length = self.up, self.deep, self.colour, self.length
        met, below, x = [], 0, state
        while x:
            self._splay(x)
            if colour[x] >= 0 and length[x]:
                met.append((colour[x], length[x]))
            cut = deep[x]
            if cut:
                colour[cut] = colour[x]
            deep[x] = below
            below, x = x, up[x]
        colour[below] = self.n
        self.n += 1
        return met


def runs_of(words: Sequence[int], exponent: int = EXPONENT, least: int = LENGTH) -> list[Run]:
    """(start, length, period) of each run, by start, then period.

    Where suffixes of up to ``size`` words ended ``period`` words before, the last ``size`` +
    ``period`` words have that period, and it is their smallest: a smaller one would have shown a
    later occurrence. With ``size`` at least ``period`` that is a square. While the next words
    keep the period its start stays, so the run grows to its end.
    """
    automaton, ends = LinkedAutomaton(), {}
    for at, word in enumerate(words):
        for end, size in automaton.append(word):
            period = at - end
            if size + period >= least and size >= (exponent - 1) * period:
                ends[at - size - period + 1, period] = at
    return [(start, end - start + 1, period) for (start, period), end in sorted(ends.items())]


def near_repeats(
    hashes: np.ndarray, exponent: int = EXPONENT, least: int = LENGTH
) -> list[tuple[int, int]]:
    """Stretches (first, end) of a sequence that hold all its runs; elsewhere there is none.

    A run of period ``q`` has, after its first ``q`` words, only windows of up to ``q`` words that
    occurred ``q`` words before. Periods are taken by powers of two, with windows half as long as
    the longest of them. Windows that occur once make no longer ones that occur twice, so few
    positions are left soon. A chance collision of hashes only makes a stretch longer.
    """
    n, size = len(hashes), 1
    places, values, found = np.arange(n), hashes, []
    while len(places) > 1:
        order = np.argsort(values, kind="stable")
        ordered, spots = values[order], places[order]
        same = ordered[1:] == ordered[:-1]
        gaps = np.full(len(places), n, np.int64)
        gaps[order[1:][same]] = (spots[1:] - spots[:-1])[same]
        # Single words serve periods of one, too.
        for lowest, reach in ((1, 1), (2, 2)) if size == 1 else ((size + 1, 2 * size),):
            periods = range(lowest, min(reach, max(lowest, -(-least // exponent))) + 1)
            need = max(1, min(max(least, exponent * q) - q - size + 1 for q in periods))
            marked = places[gaps <= reach]
            if len(marked):
                breaks = np.flatnonzero(np.diff(marked) > 1)
                first = marked[np.concatenate(([0], breaks + 1))]
                last = marked[np.concatenate((breaks, [len(marked) - 1]))]
                long = last - first + 1 >= need
                found += zip((first[long] - reach).tolist(), (last[long] + size).tolist())
        # Windows twice as long: both halves must occur more than once.
        twice = np.zeros(len(places), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        kept, own = places[twice], values[twice]
        if not len(kept):
            break
        at = np.searchsorted(kept, kept + size)
        at[at == len(kept)] = 0
        both = kept[at] == kept + size
        values = own[both] * np.uint64(0x9E3779B97F4A7C15) + own[at[both]]
        values ^= values >> np.uint64(29)
        values *= np.uint64(0xBF58476D1CE4E5B9)
        places, size = kept[both], 2 * size
    merged: list[tuple[int, int]] = []
    for first, end in sorted(found):
        first = max(0, first)
        if merged and first < merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((first, end))
    return merged


def best_run(runs: list[Run]) -> Run | None:
    """The run with the greatest length by period; ties go to the smaller start, then period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapse(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words that no run holds after its first period."""
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return [words[at] for at in np.flatnonzero(kept).tolist()] if runs else words


def _runs_of_texts(
    texts: list[list[bytes]], hashed: WordHashes, exponent: int, least: int
) -> list[list[Run]]:
    """The runs of each text, looked for together in the stretches that may hold some."""
    odd = 0xC2B2AE3D27D4EB4F
    own = [hashed(words) + np.uint64(at * odd % (1 << 64)) for at, words in enumerate(texts)]
    bounds = np.cumsum([0, *map(len, texts)])
    found: list[list[Run]] = [[] for _ in texts]
    for first, end in near_repeats(np.concatenate(own), exponent, least):
        # A stretch that goes over the end of a text is cut there.
        at = int(np.searchsorted(bounds, first, side="right")) - 1
        while at < len(texts) and bounds[at] < end:
            base = int(bounds[at])
            low, high = max(first, base) - base, min(end, int(bounds[at + 1])) - base
            if high - low >= least:
                ids: dict[bytes, int] = {}
                part = [ids.setdefault(word, len(ids)) for word in texts[at][low:high]]
                runs = runs_of(part, exponent, least)
                found[at] += [(start + low, length, period) for start, length, period in runs]
            at += 1
    return found


ADDED = StructType(
    [
        StructField("n_words", LongType()),
        StructField("n_runs", LongType()),
        StructField("start", LongType()),
        StructField("length", LongType()),
        StructField("period", LongType()),
        StructField(
            "runs",
            ArrayType(
                StructType([StructField(c, LongType()) for c in ("start", "length", "period")])
            ),
        ),
        StructField("collapsed", StringType()),
    ]
)


def period_runs(docs: DataFrame, *, exponent: int = EXPONENT, least: int = LENGTH) -> DataFrame:
    """Runs of repeated word sequences in each text, and the text without the repeats.

    A run is a stretch of words with smallest period ``q`` and a length of ``exponent`` * ``q`` and
    of ``least`` words at least, which neither neighbour extends. ``docs`` needs ``text``; other
    columns are kept, but for those named like the added ones, in any case of letters, which are
    replaced. Added are ``n_words``, ``n_runs``, ``start`` (number of a word, from 0), ``length`` and
    ``period`` of the run with the greatest length by period (ties: smallest start, then period;
    NULL without a run), ``runs``, all of them by start and period, and ``collapsed``: the words
    that lie in no run after its first period, joined by one space.

    Words are stretches of anything but ASCII white space, compared as they are. A NULL, empty or
    blank text has no words and no runs, and ``collapsed`` is empty. Repeated rows have equal
    results. An empty table gives no rows. A row is looked at by itself, without a shuffle, however
    long its text is; memory grows with the longest stretch that closely repeats itself, some 300
    bytes a word. ``exponent`` is 2 or more.
    """
    if exponent < 2:
        raise ValueError(f"exponent must be 2 or more, not {exponent}")
    kept = unclashing(docs, ADDED.names)
    # Plain names on the way through Python: a column's name may hold any character.
    others = [f"c{i}" for i in range(len(kept.columns))]
    source = kept.toDF(*others).withColumn("text", F.col(others[kept.columns.index("text")]))
    fields = [StructField(c, f.dataType) for c, f in zip(others, kept.schema.fields)]
    run_kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
    arrow = [pa.int64()] * 5 + [run_kind, pa.string()]

    def rows(texts: list[list[bytes]], hashed: WordHashes) -> Iterator[tuple]:
        for words, runs in zip(texts, _runs_of_texts(texts, hashed, exponent, least)):
            best = best_run(runs) or (None, None, None)
            text = b" ".join(collapse(words, runs)).decode("utf-8")
            yield len(words), len(runs), *best, [dict(zip(names, r)) for r in runs], text

    names = ("start", "length", "period")

    def find(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = WordHashes()
        for part in parts:
            texts, at, held = part.column(len(others)), 0, 0
            words: list[list[bytes]] = []
            for nth, text in enumerate(texts, 1):
                words.append(split_words(text.as_py()))
                held += len(words[-1])
                if held >= CHUNK or nth == len(texts):
                    found = list(zip(*rows(words, hashed)))
                    own = part.slice(at, nth - at)
                    columns = [own.column(i) for i in range(len(others))]
                    added = [pa.array(c, k) for c, k in zip(found, arrow)]
                    yield pa.RecordBatch.from_arrays(
                        [*columns, *added], [*others, *ADDED.names]
                    )
                    words, at, held = [], nth, 0

    found = source.mapInArrow(find, StructType([*fields, *ADDED.fields]))
    return found.toDF(*kept.columns, *ADDED.names)
