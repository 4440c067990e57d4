"""Byte-level BPE ids of whole texts, piece by piece with a bounded memory of seen pieces."""

from __future__ import annotations

import json
from array import array

import tiktoken

# White space as Unicode has it; fixed value.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
# The pre-tokenizer's pattern; fixed value.
PIECES = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    rf"| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)


def byte_alphabet() -> dict[str, int]:
    """Characters that stand for bytes in vocabulary files: printable ones for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(moved)}


class ByteBpe:
    """Encoder for a byte-level BPE file of the tokenizers library.

    A text is cut at single spaces. Each part with its space is encoded once and remembered, as
    words repeat; this changes no id, since no pre-token goes beyond such a part. Texts with runs
    of spaces, where pre-tokens may, are encoded as a whole.
    """

    def __init__(self, path: str, remembered: int = 200_000) -> None:
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        special = {token["content"]: token["id"] for token in model["added_tokens"]}
        alphabet = byte_alphabet()
        ranks = {
            bytes(alphabet[c] for c in token): number
            for token, number in model["model"]["vocab"].items()
            if token not in special
        }
        # Merges come in order of their ids, so ids serve as ranks.
        self.encoding = tiktoken.Encoding(
            "file", pat_str=PIECES, mergeable_ranks=ranks, special_tokens=special
        )
        self.special, self.remembered = special, remembered
        self.parts: dict[str, array] = {}

    def encode(self, text: str | None) -> array:
        """Ids of a text as unsigned 32-bit numbers; none for NULL. Added tokens keep their ids."""
        if not text:
            return array("I")
        if any(token in text for token in self.special):
            return array("I", self.encoding.encode(text, allowed_special="all"))
        if "  " in text or text[-1] == " ":
            return array("I", self.encoding.encode_ordinary(text))
        first, *rest = text.split(" ")
        known, ordinary = self.parts, self.encoding.encode_ordinary
        if len(known) > self.remembered:
            known.clear()
        for part in set(rest).difference(known):
            known[part] = array("I", ordinary(" " + part))
        ids = array("I", ordinary(first))
        ids.frombytes(b"".join(map(known.__getitem__, rest)))
        return ids

    def count(self, text: str | None) -> int:
        return len(self.encode(text))
