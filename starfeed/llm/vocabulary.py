"""Byte-level BPE vocabularies: how a text is cut into words, and its token ids by the tiktoken library."""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import regex
import tiktoken

#: Fixed value: the pattern of byte-level BPE that splits a text into words before the merges.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_alphabet() -> dict[int, str]:
    """byte -> the character that stands for it in a vocabulary file: itself
    where it prints in Latin-1, else the next one from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Vocabulary:
    """A ``tokenizers`` file of a byte-level BPE: tokens as bytes, merges as pairs of ids, special tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = {c: b for b, c in byte_alphabet().items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = spec["model"]["vocab"]
        self.ids = {bytes(map(letters.__getitem__, name)): i for name, i in names.items() if name not in self.special}
        pairs = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        self.merges = [(names[a], names[b], names[a + b]) for a, b in pairs]


class Encoder:
    """The ids that ``Tokenizer.encode(text, add_special_tokens=False)`` gives, a few times faster.

    Only for vocabularies whose ids rise with the order of the merges, as byte-level ones do; others are refused.
    The fast library gives up on a text with a run of about a million spaces; the ids of such a text come from ``Tokenizer`` itself.
    """

    def __init__(self, path: str):
        vocabulary = Vocabulary(path)
        made = [m[2] for m in vocabulary.merges]
        if any(a >= b for a, b in zip(made, made[1:])):
            raise ValueError(f"{path}: ids do not rise with the order of the merges")
        self.path = path
        self.encoding = tiktoken.Encoding(
            "vocabulary", pat_str=SPLIT, mergeable_ranks=vocabulary.ids, special_tokens=vocabulary.special
        )

    @cached_property
    def tokenizer(self):
        from tokenizers import Tokenizer  # workers that never need it do not hold it

        tokenizer = Tokenizer.from_file(self.path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        return tokenizer

    def one(self, text: str | None) -> np.ndarray:
        try:
            return self.encoding.encode_to_numpy(text or "", allowed_special="all")
        except ValueError:  # its regular expressions have run out of room
            return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)


class SplitWords:
    """Cuts a text into special tokens and the words that byte-level BPE works on."""

    def __init__(self, special: dict[str, int]):
        self.special = special
        self.words = regex.compile(SPLIT)
        marks = sorted(special, key=len, reverse=True)
        self.marks = regex.compile("|".join(map(regex.escape, marks)) if marks else r"(?!)")

    def pieces(self, text: str | None) -> Iterator[list[str] | int]:
        """Lists of words, and between them the ids of the special tokens whose strings the text holds."""
        if not text:
            return
        at = 0
        for mark in self.marks.finditer(text):
            yield self.words.findall(text[at : mark.start()])
            yield self.special[mark.group()]
            at = mark.end()
        yield self.words.findall(text[at:] if at else text)
