"""Which characters a tokenizer takes for letters, numbers and white space, asked of the tokenizer itself.

The tables of Unicode that a library is built on are those of its own time: a letter assigned since is no letter to it. So its
pre-tokenizer is shown every code point once, on the driver, and the classes are handed on as ranges, some 20 kB.
It has to be one that joins letters with letters and other characters with others, and drops or separates white space.
"""

from __future__ import annotations

import functools
import unicodedata
from dataclasses import dataclass
from itertools import groupby

import regex

_AT_ONCE = 1 << 16


@dataclass(frozen=True)
class Classes:
    """Bodies of regular-expression classes, without the brackets."""

    letters: str
    numbers: str
    white: str
    #: Characters that ``\\p{L}`` and ``\\p{N}`` of the ``regex`` module here put elsewhere than the tokenizer does.
    differs: str
    #: Characters that the tokenizer's normalizer puts into lower case otherwise than ``str.lower`` does here.
    lower: dict[int, str]


def _ranges(flags: bytearray, value: int) -> str:
    parts, at = [], 0
    for flag, run in groupby(flags):
        n = sum(1 for _ in run)
        if flag == value:
            parts.append(f"\\U{at:08X}-\\U{at + n - 1:08X}")
        at += n
    return "".join(parts)


_OTHER, _LETTER, _NUMBER, _WHITE, _DIFFERS = range(5)


def _kinds(tokenizer) -> bytearray:
    """The class of each code point. Neighbours that end up in one piece are of one class, so one of them is tried out."""
    pieces: list[tuple[int, int]] = []
    out = bytearray([_WHITE]) * 0x110000  # what is in no piece was dropped
    for k in range(0, 0x110000, _AT_ONCE):
        points = [p for p in range(k, k + _AT_ONCE) if not 0xD800 <= p < 0xE000]
        for _, (a, b) in tokenizer.pre_tokenizer.pre_tokenize_str("".join(map(chr, points))):
            pieces.append((points[a], points[b - 1] + 1))
    out[0xD800:0xE000] = bytes([_OTHER]) * 0x800

    def joins(before: str) -> set[int]:
        """Pieces whose first character stands in one piece with ``before``."""
        tried = "".join(f"{before}{chr(a)}\n" for a, _ in pieces)
        return {a // 3 for _, (a, b) in tokenizer.pre_tokenizer.pre_tokenize_str(tried) if a % 3 == 0 and b - a == 2}

    letters, others = joins("a"), joins("!")
    for k, (a, b) in enumerate(pieces):
        kind = _LETTER if k in letters else _OTHER if k in others else _WHITE if chr(a).isspace() else _NUMBER
        out[a:b] = bytes([kind]) * (b - a)
    return out


def _lower(tokenizer) -> dict[int, str]:
    """Single characters that do not change under composition, as far as only one of the two changes their case, or changes it otherwise."""
    if tokenizer.normalizer is None:
        return {}
    points = [p for p in range(0x80, 0x110000) if not 0xD800 <= p < 0xE000 and unicodedata.is_normalized("NFC", chr(p))]
    theirs = tokenizer.normalizer.normalize_str("!".join(map(chr, points))).split("!")
    own = [chr(p).lower() for p in points]
    return {p: b for p, a, b in zip(points, own, theirs, strict=True) if a != b and not chr(p).isspace()}


@functools.cache
def classes(path: str) -> Classes:
    """The classes of the tokenizer file at ``path``; a second or so, once a process."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    kinds = _kinds(tokenizer)
    differs = bytearray(0x110000)
    everything = "".join(chr(p) if not 0xD800 <= p < 0xE000 else "!" for p in range(0x110000))
    for name, kind in (("L", _LETTER), ("N", _NUMBER)):
        here = bytearray(0x110000)
        for m in regex.finditer(rf"\p{{{name}}}+", everything):
            here[m.start() : m.end()] = bytes([1]) * (m.end() - m.start())
        for p, (own, theirs) in enumerate(zip(here, kinds, strict=True)):
            if own != (theirs == kind):
                differs[p] = 1
    lower = _lower(tokenizer)
    for p in lower:
        differs[p] = 1
    return Classes(*(_ranges(kinds, k) for k in (_LETTER, _NUMBER, _WHITE)), _ranges(differs, 1), lower)
