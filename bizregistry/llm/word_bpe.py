"""Word-end BPE with a minimal acyclic transducer for frequent words."""

from __future__ import annotations

import gc
import hashlib
import heapq
import json
import mmap
import os
import re
import tempfile
import unicodedata
import uuid
from array import array
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .byte_bpe import SPACE, byte_alphabet
from .common import file_key, per_worker, shared_folder, written

WORD_END = "</w>"
# The pre-tokenizer's pattern; fixed value.
PIECE = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+")
# ``str.split`` takes these for white space, the pattern does not.
SEPARATORS = re.compile("[\x1c-\x1f]")
# Words in the lexicon. Others are merged, so the number changes no result.
LEXICON = 65_536
ID_BITS = 24
# A byte that the vocabulary lacks: it joins no pair, and gives no id.
NO_ID = (1 << ID_BITS) - 1
# Number of ids, the ids in decimal, their decoded text.
Written = tuple[int, str, str]
BYTES = [bytes((b,)) for b in range(256)]


class Transducer:
    """Minimal acyclic automaton over UTF-8 bytes; words give ids.

    States with the same continuations are one, so suffixes are shared. Each arc knows how many
    words come before those that take it, so a path adds up to the word's number, and the number
    leads to its ids. It is one block of bytes, mapped into memory from a file.
    """

    def __init__(self, data: bytes | mmap.mmap) -> None:
        head = array("I", data[:20])
        self.root, states, arcs, words, outputs = head
        view, at = memoryview(data), 20
        sections = []
        for count in (states + 1, arcs, arcs, words + 1, outputs):
            sections.append(view[at : at + 4 * count].cast("I"))
            at += 4 * count
        self.first, self.target, self.before, self.starts, self.ids = sections
        self.data, self.final, self.labels = data, at, at + states

    @staticmethod
    def compile(lexicon: Iterable[tuple[bytes, Iterable[int]]]) -> bytes:
        """Build from words in byte order, each with its ids."""
        known: dict[tuple, int] = {}
        states: list[tuple[bool, tuple[tuple[int, int], ...]]] = []
        size: list[int] = []

        def state(final: bool, arcs: list[tuple[int, int]]) -> int:
            key = (final, tuple(arcs))
            if key not in known:
                known[key] = len(states)
                states.append(key)
                size.append(final + sum(size[to] for _, to in arcs))
            return known[key]

        # The path of the last word, still open: is it final, its arcs so far, the label to it.
        path: list[list] = [[False, [], 0]]
        starts, ids, last = array("I", [0]), array("I"), None

        def close(depth: int) -> None:
            while len(path) > depth + 1:
                final, arcs, label = path.pop()
                path[-1][1].append((label, state(final, arcs)))

        for word, output in lexicon:
            if last is not None and word <= last:
                raise ValueError("words must be in order")
            shared = len(os.path.commonprefix([word, last or b""]))
            close(shared)
            path += [[False, [], label] for label in word[shared:]]
            path[-1][0] = True
            ids.extend(output)
            starts.append(len(ids))
            last = word
        close(0)
        root = state(path[0][0], path[0][1])
        first, target, before = array("I", [0]), array("I"), array("I")
        finals, labels = bytearray(), bytearray()
        for final, arcs in states:
            passed = int(final)
            finals.append(final)
            for label, to in arcs:
                labels.append(label)
                target.append(to)
                before.append(passed)
                passed += size[to]
            first.append(len(target))
        head = array("I", [root, len(states), len(target), len(starts) - 1, len(ids)])
        parts = (head, first, target, before, starts, ids)
        return b"".join([*(p.tobytes() for p in parts), bytes(finals), bytes(labels)])

    @classmethod
    def load(cls, path: str) -> Transducer:
        with open(path, "rb") as file:
            return cls(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ))

    def get(self, word: bytes) -> list[int] | None:
        at, number, labels = self.root, 0, self.labels
        first, target, before, find = self.first, self.target, self.before, self.data.find
        for label in word:
            arc = find(BYTES[label], labels + first[at], labels + first[at + 1]) - labels
            if arc < 0:
                return None
            number += before[arc]
            at = target[arc]
        if not self.data[self.final + at]:
            return None
        return self.ids[self.starts[number] : self.starts[number + 1]].tolist()


class WordBpe:
    """Encoder and decoder for a word-end BPE file of the tokenizers library."""

    def __init__(self, path: str, lexicon: Transducer | None = None, known: int = 300_000) -> None:
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model = content["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {token["content"]: token["id"] for token in content["added_tokens"]}
        self.tokens = {i: t for t, i in (self.vocab | self.special).items()}
        # Pairs of ids as one number; of each merge its rank and its result.
        self.ranks: dict[int, int] = {}
        self.results: list[int] = []
        for left, right in model["merges"]:
            key = self.vocab[left] << ID_BITS | self.vocab[right]
            self.ranks[key] = len(self.results)
            self.results.append(self.vocab[left + right])
        letters = {byte: char for char, byte in byte_alphabet().items()}
        self.inner = [self.vocab.get(letters[b], NO_ID) for b in range(256)]
        self.last = [self.vocab.get(letters[b] + WORD_END, NO_ID) for b in range(256)]
        none = len(self.results)
        # Ranks of all pairs of bytes, within a word and at its end.
        self.first_ranks, self.last_ranks = (
            [[self.ranks.get(a << ID_BITS | b, none) for b in ends] for a in self.inner]
            for ends in (self.inner, self.last)
        )
        # Decimal number and token of each id.
        self.written = {i: (str(i), token) for i, token in self.tokens.items()}
        self.lexicon, self.most = lexicon, known
        # What was met last, in two halves, so that frequent words are never forgotten.
        self.known, self.older = _Memory(self._written_part), _Memory(self._written_part)
        self.literal = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")

    def parts(self, text: str | None) -> list[str]:
        """A normalized text in parts that no pre-token leaves, and the special tokens in it."""
        found: list[str] = []
        for number, piece in enumerate(self.literal.split(text or "")):
            if number % 2:
                found.append(piece)
                continue
            if not piece.isascii():
                # Characters are lower-cased one by one: the form of a final sigma is not used.
                piece = unicodedata.normalize("NFC", piece).replace("Σ", "σ")
            piece = piece.lower()
            found += PIECE.findall(piece) if SEPARATORS.search(piece) else piece.split()
        return found

    def merge(self, word: str) -> list[int]:
        """Ids of one pre-token: the pair of lowest rank, leftmost first, is merged until none."""
        return self._merge(word.encode("utf-8"))

    def _merge(self, data: bytes) -> list[int]:
        inner = self.inner
        ids = [inner[b] for b in data]
        ids[-1] = self.last[data[-1]]
        if len(ids) > 256:
            return self._merge_long(ids)
        if len(ids) == 1:
            return [i for i in ids if i != NO_ID]
        rank, results, none = self.ranks.get, self.results, len(self.results)
        first = self.first_ranks
        pairs = [first[a][b] for a, b in zip(data, data[1:])]
        pairs[-1] = self.last_ranks[data[-2]][data[-1]]
        while pairs and (best := min(pairs)) < none:
            at = pairs.index(best)
            ids[at] = new = results[best]
            del ids[at + 1], pairs[at]
            if at:
                pairs[at - 1] = rank(ids[at - 1] << ID_BITS | new, none)
            if at < len(pairs):
                pairs[at] = rank(new << ID_BITS | ids[at + 1], none)
        return [i for i in ids if i != NO_ID] if NO_ID in ids else ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap and a linked list: time does not grow with the square."""
        after = [*range(1, len(ids)), -1]
        prior = [*range(-1, len(ids) - 1)]
        gone = [False] * len(ids)
        heap: list[tuple[int, int]] = []

        def pair(at: int) -> int | None:
            if at < 0 or gone[at] or after[at] < 0:
                return None
            return self.ranks.get(ids[at] << ID_BITS | ids[after[at]])

        def offer(at: int) -> None:
            if (rank := pair(at)) is not None:
                heapq.heappush(heap, (rank, at))

        for at in range(len(ids) - 1):
            offer(at)
        while heap:
            rank, at = heapq.heappop(heap)
            if pair(at) != rank:
                continue
            other = after[at]
            ids[at], gone[other], after[at] = self.results[rank], True, after[other]
            if after[at] >= 0:
                prior[after[at]] = at
            offer(prior[at])
            offer(at)
        return [i for i, out in zip(ids, gone) if not out and i != NO_ID]

    def ids_of(self, piece: str) -> list[int]:
        """Ids of a pre-token, or of a special token."""
        if piece in self.special:
            return [self.special[piece]]
        data = piece.encode("utf-8")
        found = self.lexicon.get(data) if self.lexicon else None
        return self._merge(data) if found is None else found

    def pieces(self, part: str) -> list[str]:
        return [part] if part.isalpha() or part in self.special else PIECE.findall(part)

    def encode(self, text: str | None) -> list[int]:
        """Ids of a whole text; none for NULL."""
        return [
            i for part in self.parts(text) for piece in self.pieces(part) for i in self.ids_of(piece)
        ]

    def decode(self, ids: Iterable[int]) -> str:
        """Tokens joined by one space, as the file names no decoder."""
        return " ".join(self.tokens[i] for i in ids)

    def written_out(self, text: str | None) -> Written:
        """Number of ids of a text, the ids in decimal and their decoded text."""
        if len(self.known) > self.most:
            # Those met since then move on from the older half when they are met again.
            self.older, self.known = self.known, _Memory(self._written_part)
        return _joined(map(self.known.__getitem__, self.parts(text)))

    def _written_part(self, part: str) -> Written:
        if found := self.older.get(part):
            return found
        pieces = self.pieces(part)
        if pieces != [part]:
            # The pieces are remembered, too: a word before a comma.
            return _joined(map(self.known.__getitem__, pieces))
        pairs = [self.written[i] for i in self.ids_of(part)]
        return len(pairs), " ".join([pair[0] for pair in pairs]), " ".join([pair[1] for pair in pairs])


class _Memory(dict):
    """Values made when they are first asked for."""

    def __init__(self, make: Callable[[str], Written]) -> None:
        super().__init__()
        self.make = make

    def __missing__(self, key: str) -> Written:
        self[key] = value = self.make(key)
        return value


def _joined(found: Iterable[Written]) -> Written:
    found = list(found)
    counts = [one[0] for one in found]
    if 0 in counts:
        # A piece that has no ids, as its bytes are in no vocabulary, leaves no space either.
        found = [one for one in found if one[0]]
    return sum(counts), " ".join([one[1] for one in found]), " ".join([one[2] for one in found])


def frequent_words(docs: DataFrame, most: int = LEXICON) -> list[str]:
    """The most frequent words of all texts, stretches of letters in lower case.

    Counted by Spark's own functions, in tasks first. Pre-tokens are found by other rules in some
    places, such as a letter with its accent apart: those are merged instead.
    """
    words = docs.select(F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("word"))
    total = written(
        words.filter("word <> ''").groupBy("word").agg(F.count(F.lit(1)).alias("n")),
        shared_folder(docs.sparkSession),
    )
    # Classes of counts, some hundreds: as many from the top as the lexicon has room for.
    step = F.floor(F.log2("n") * 16).alias("step")
    classes = total.groupBy(step).count().collect()
    room, least = most, None
    for step_of, words in sorted(map(tuple, classes), reverse=True):
        room -= words
        if room < 0:
            break
        least = step_of
    # Bounded by the size of the lexicon.
    rows = total.filter(step >= least).select("word").collect() if least is not None else []
    return [row["word"] for row in rows]


def ship_lexicon(docs: DataFrame, tokenizer: str, most: int = LEXICON) -> str:
    """Compile the lexicon of a corpus and hand it to all executors; returns the file's name.

    Spark copies the file to each executor once, also to those that join later. All workers on a
    machine map the same pages.
    """
    encoder = WordBpe(tokenizer)
    words = sorted(word.encode("utf-8") for word in frequent_words(docs, most))
    data = Transducer.compile((w, encoder.merge(w.decode("utf-8"))) for w in words)
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    folder = os.path.realpath(tempfile.mkdtemp(prefix="lexicon-"))
    with open(f"{folder}/{name}", "wb") as file:
        file.write(data)
    docs.sparkSession.sparkContext.addFile(f"{folder}/{name}")
    return name


def encoded(docs: DataFrame, tokenizer: str, *, most: int = LEXICON) -> DataFrame:
    """The columns of ``docs`` but ``text``, with ``n_tokens``, ``ids`` and ``decoded``.

    NULL and empty texts have no ids and decode to an empty text. Input columns named like those
    added are replaced. Repeated rows stay, and an empty table gives no rows. Texts may be of any
    length, and words, too: a long one is merged with a heap.
    """
    return _per_text(docs, tokenizer, most, _full, "n_tokens bigint, ids array<int>, decoded string")


def encoded_digests(docs: DataFrame, tokenizer: str, *, most: int = LEXICON) -> DataFrame:
    """The same with ``ids_sha256`` and ``decoded_sha256`` in place of ids and text."""
    return _per_text(
        docs, tokenizer, most, _digest, "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )


def _full(found: Written) -> tuple:
    return found[0], list(map(int, found[1].split())), found[2]


def _digest(found: Written) -> tuple:
    return found[0], *(hashlib.sha256(x.encode("utf-8")).hexdigest() for x in found[1:])


def _per_text(docs: DataFrame, tokenizer: str, most: int, make, added: str) -> DataFrame:
    name = ship_lexicon(docs, tokenizer, most)
    new = [field.split(" ")[0] for field in added.split(", ")]
    others = [c for c in docs.columns if c != "text" and c not in new]
    int_lists = {"ids": pa.list_(pa.int32()), "n_tokens": pa.int64()}

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = SparkFiles.get(name)
        encoder = per_worker(
            "word_bpe",
            (file_key(tokenizer), path),
            lambda: WordBpe(tokenizer, Transducer.load(path)),
        )
        for part in parts:
            # What is remembered holds no cycles: looking through it for some costs a fifth.
            gc.disable()
            try:
                rows = [make(encoder.written_out(text.as_py())) for text in part.column("text")]
            finally:
                gc.enable()
            columns = [
                pa.array(c, int_lists.get(n, pa.string()))
                for n, c in zip(new, list(zip(*rows)) or [()] * 3)
            ]
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in others), *columns], [*others, *new]
            )

    kinds = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in others)
    return docs.select(*others, "text").mapInArrow(run, kinds + added)
