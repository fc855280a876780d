"""Token ids of whole texts, by the ``tokenizers`` library, one unit of text at a time.

The tokenizers used here never join characters across certain cuts, so a text's ids are the
ids of its units one after another. Natural text repeats its units, so a distinct unit is
encoded once per worker and remembered, in two generations of half of ``limit`` units: when the
younger is full the older goes, and a unit met again moves from the older to the younger.
A unit that is one run of plain Latin letters is a single pre-token and goes straight to the
library's model; one with ASCII symbols after the letters is the ids of both parts, which the
pre-tokenizers never join; anything else goes through the whole tokenizer.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable

import numpy as np

#: White space as Unicode defines it (Python's ``\s`` also takes the four separators 1C-1F).
_SPACE = " \t\n\x0b\x0c\r\x85\xa0  -     　"
_UNIT = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")
_RARE_SPACE = re.compile(r"[^\S \n]")
_SEPARATORS = re.compile(r"[\x1c-\x1f]")
_LETTERS = re.compile("[ \n]?[A-Za-zÀ-ÖØ-öø-įı-ſ]+")
_SYMBOL_TAIL = re.compile(r"[!-/:-@\[-`{-~]+")
_ENCODERS: dict[str, "UnitEncoder"] = {}


def byte_level_units(text: str) -> list[str]:
    """Units for byte-level pre-tokenizers: a run of white space with the word after it.

    Their tokens never reach from other characters into white space, so every such place is a
    safe cut. Texts with single spaces and newlines only take the quicker way to the same ids.
    """
    if (any(two in text for two in ("  ", "\n\n", " \n", "\n ")) or _RARE_SPACE.search(text)):
        return _UNIT.findall(text)
    out: list[str] = []
    for no, line in enumerate(text.split("\n")):
        if no:
            out.append("\n")
        words = line.split(" ")
        if words[0]:
            out.append(words[0])
        out += [" " + w for w in words[1:]]
    return out


def lower_word_units(text: str) -> list[str]:
    """Units for lower-casing pre-tokenizers that drop white space: the words."""
    return [text] if _SEPARATORS.search(text) else text.split()


def _byte_symbols() -> dict[int, str]:
    """The published rule of byte-level vocabularies: printable bytes stand for themselves, the
    others are numbered upwards from 256."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


_SYMBOLS = _byte_symbols()


class UnitEncoder(dict):
    """unit -> its ids as little-endian unsigned 32-bit bytes."""

    #: tokenizer file -> (units of a text, whether it lower-cases)
    KINDS: dict[str, tuple[Callable[[str], list[str]], bool]] = {
        "byte_bpe_50k.json": (byte_level_units, False),
        "word_bpe_49k.json": (lower_word_units, True),
    }

    def __init__(self, path: str, limit: int = 1_200_000) -> None:
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.model = self.tokenizer.model
        self.packed = [n.to_bytes(4, "little") for n in range(self.tokenizer.get_vocab_size())]
        self.known = os.path.basename(path) in self.KINDS
        self.units, self.lower = self.KINDS.get(os.path.basename(path), (lambda t: [t], False))
        self.limit = limit
        self.before: dict[str, bytes] = {}  # the generation that was remembered before this one

    def __missing__(self, unit: str) -> bytes:
        ids = self.before.get(unit)
        if ids is None:
            ids = self._first(unit)
        if len(unit) <= 200:
            if len(self) >= self.limit // 2:
                self.before = dict(self)
                self.clear()
            self[unit] = ids
        return ids

    def _first(self, unit: str) -> bytes:
        """The ids of a unit met for the first time."""
        if self.known and (letters := _LETTERS.match(unit)):
            end = letters.end()
            if end < len(unit) and _SYMBOL_TAIL.fullmatch(unit, end):
                return self[unit[:end]] + self[unit[end:]]
            if end == len(unit) and unit[0] != "\n":
                plain = unit.lower() if self.lower else unit
                symbols = (plain.replace(" ", _SYMBOLS[32]) if plain.isascii()
                           else plain.encode().decode("latin-1").translate(_SYMBOLS))
                return b"".join([self.packed[t.id] for t in self.model.tokenize(symbols)])
        return np.array(self.tokenizer.encode(unit, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, self.units(text)))


def encoder(path: str) -> UnitEncoder:
    """This worker process's encoder for a tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = UnitEncoder(path)
    return _ENCODERS[path]
