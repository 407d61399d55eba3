"""Exact BPE encoding and decoding by dynamic programming over prefixes.

A greedy-by-rank BPE has a useful property: the tokens of a prefix of a word do
not depend on what follows, and each prefix has exactly one last token. The encoder
therefore goes through a word once. An automaton over the vocabulary (a trie with
suffix links) reports, for every prefix, the tokens that are its suffixes. One of them is
the last token: the one before which the prefix ends in a token that is *compatible*
with it, which means that no merge joins the two across their border before
the merges that build them. Following the stored last tokens back from the end of
the word gives the ids. Whether two tokens are compatible is a property of the
vocabulary, so it is worked out once for each pair and remembered.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Callable
from itertools import chain

import ahocorasick
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField

from opsmart.llm.common import map_texts, tokenizer_path
from opsmart.llm.unicode_classes import Classes, classes

#: White space as the vocabulary's normalizer and splitter know it (Unicode's property).
_WS = "\\t-\\r\\x20\\x85\\xA0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000"
_SPACE = regex.compile(f"[{_WS}]+")
#: ``str.split`` also splits at these; the vocabulary's white space does not hold them.
_SEPARATORS = re.compile("[\x1c-\x1f]")
#: The splitter's pattern; a fixed value. What it does not match is dropped.
_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[{0}]+|[{1}]|[^{2}{0}{1}]+"
_PIECES = regex.compile(_PATTERN.format("\\p{L}", "\\p{N}", _WS))
#: The same for ASCII in lower case.
_ASCII = re.compile(_PATTERN.format("a-z", "0-9", "\\t-\\r\\x20"))
#: Runs that a worker remembers at most; words are two thirds as many, token pairs a third more. Workers live as long as
#: their executor, so this is what they hold (about 250 MB) whatever runs in them next.
_REMEMBERED = 300_000
#: Longer runs and words hardly come again and are not remembered.
_LONGEST = 100
_FOREVER = 1 << 60
#: The last symbol of a word is a symbol of its own; it is moved by this much.
_FINAL = 0x10000


def _byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself if it is printable, else one from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class _Remembered(dict):
    """What ``make`` returned for the texts asked for last, ``most`` of them at most.

    Half of them are in use; once they are full they become the older half, from which those that are
    asked for again come back. So frequent texts stay, however many others there are.
    """

    def __init__(self, make: Callable, most: int):
        super().__init__()
        self._make, self._half, self._older = make, most // 2, {}

    def __missing__(self, text: str):
        found = self._older.get(text)
        if found is None:
            found = self._make(text)
        if len(text) <= _LONGEST:
            if len(self) >= self._half:
                self._older = dict(self)
                self.clear()
            self[text] = found
        return found


class PrefixEncoder:
    """BPE with word ends, from a ``tokenizers`` file of that kind."""

    def __init__(self, path: str, known: Classes | None = None):
        known = known or classes(path)
        #: The splitter of texts with characters that are of another class to the library than to ``_PIECES``.
        self._exact = re.compile(_PATTERN.format(known.letters, known.numbers, known.white))
        self._differs = re.compile(f"([{known.differs}])") if known.differs else None
        self._lower = known.lower
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        vocab: dict[str, int] = model["vocab"]
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: t for t, i in vocab.items()} | {i: t for t, i in self.specials.items()}
        self._split = regex.compile("(" + "|".join(map(regex.escape, self.specials)) + ")") if self.specials else None
        self._symbols = {b: c for b, c in enumerate(_byte_symbols())}
        #: For each token: when it is made, and of which two. Single symbols are there from the start.
        self._made: dict[int, tuple[int, int, int]] = {}
        self._rank: dict[tuple[int, int], int] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            a, b, both = vocab[left], vocab[right], vocab[left + right]
            self._rank.setdefault((a, b), rank)
            self._made.setdefault(both, (rank, a, b))
        #: Finds, for every prefix, the tokens it ends in.
        self._automaton = ahocorasick.Automaton()
        for token, i in vocab.items():
            key = token
            if token.endswith(self.end) and token != self.end:
                body = token[: -len(self.end)]
                key = body[:-1] + chr(ord(body[-1]) + _FINAL)
            if i in self._made or len(key) == 1:  # a token that no merge makes never comes out
                self._automaton.add_word(key, (i, len(key)))
        self._automaton.make_automaton()
        self._fits: dict[tuple[int, int], bool] = {}
        self._words = _Remembered(self.word, 2 * _REMEMBERED // 3)
        self._known = _Remembered(self._run, _REMEMBERED)

    def _compatible(self, a: int, b: int) -> bool:
        """Whether ``a`` then ``b`` stay two tokens.

        Undo the merges of both in reverse order. The part of ``a`` at the border lives until the
        merge that takes it up, and so does that of ``b``. A merge of two parts that live at
        the same time happens if it is due before either is taken up; of two equally
        ranked merges the left one comes first.
        """
        until_a = until_b = _FOREVER
        while True:
            rank = self._rank.get((a, b))
            if rank is not None and rank < until_a and rank <= until_b:
                return False
            made_a, made_b = self._made.get(a), self._made.get(b)
            born_a = made_a[0] if made_a else -1
            born_b = made_b[0] if made_b else -1
            if born_a < 0 and born_b < 0:
                return True
            if born_a > born_b:
                until_a, a = born_a, made_a[2]
            else:
                until_b, b = born_b, made_b[1]

    def word(self, piece: str) -> tuple[int, ...]:
        """Ids of one piece, with its word end."""
        symbols = "".join(map(self._symbols.__getitem__, piece.encode()))
        text = symbols[:-1] + chr(ord(symbols[-1]) + _FINAL)
        n = len(text)
        last = [-1] * (n + 1)
        size = [0] * (n + 1)
        fits = self._fits
        for at, (token, length) in self._automaton.iter(text):
            end = at + 1
            if last[end] >= 0:
                continue
            begin = end - length
            if begin:
                pair = (last[begin], token)
                good = fits.get(pair)
                if good is None:
                    if len(fits) >= 4 * _REMEMBERED // 3:
                        fits.clear()
                    good = fits[pair] = self._compatible(*pair)
                if not good:
                    continue
            last[end], size[end] = token, length
        ids = []
        while n:
            ids.append(last[n])
            n -= size[n]
        return tuple(reversed(ids))

    def pieces(self, text: str) -> list[str]:
        """The pieces of ordinary text, normalised."""
        if text.isascii():
            return _ASCII.findall(text.lower())
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # no special final sigma
        text = _SPACE.sub(" ", text)
        if not (self._differs and self._differs.search(text)):
            return _PIECES.findall(text.lower())
        # Characters whose case the library changes otherwise stand aside while the others are put into lower case.
        parts = [self._lower[ord(x)] if len(x) == 1 and ord(x) in self._lower else x.lower() for x in self._differs.split(text)]
        return self._exact.findall("".join(parts))

    def _ids(self, text: str) -> list[int]:
        """Ids of ordinary text."""
        words = self._words
        return list(chain.from_iterable([words[x] for x in self.pieces(text)]))

    def _segments(self, text: str):
        """``(is special, part)``: the strings of special tokens and what stands between them."""
        if not any(s in text for s in self.specials):
            return [(False, text)]
        return [(k % 2 == 1, part) for k, part in enumerate(self._split.split(text))]

    def encode(self, text: str) -> list[int]:
        return list(
            chain.from_iterable([self.specials[x]] if special else self._ids(x) for special, x in self._segments(text))
        )

    def decode(self, ids) -> str:
        """The vocabulary has no decoder of its own: its strings are joined by spaces."""
        return " ".join(map(self.strings.__getitem__, ids))

    def _run(self, run: str) -> tuple[int, str, str]:
        """Count, ids and decoded text of a run of ordinary text between white space."""
        ids = self._ids(run)
        return len(ids), " ".join(map(str, ids)), self.decode(ids)

    def _runs(self, text: str) -> list[tuple[int, str, str]]:
        """Count, ids and decoded text of every run of ordinary text between white space.

        No piece crosses white space and normalisation does not look across it, so a run
        has the same ids wherever it stands.
        """
        runs = text.split() if not _SEPARATORS.search(text) else [x for x in _SPACE.split(text) if x]
        known = self._known
        return [known[x] for x in runs]

    def digests(self, text: str) -> tuple[int, str, str]:
        """Number of tokens, and the SHA-256 of the ids and of the decoded text."""
        parts = []
        for special, x in self._segments(text):
            parts += [(1, str(self.specials[x]), x)] if special else self._runs(x)
        return (
            sum([x[0] for x in parts]),
            hashlib.sha256(" ".join([x[1] for x in parts]).encode()).hexdigest(),
            hashlib.sha256(" ".join([x[2] for x in parts]).encode()).hexdigest(),
        )


_ENCODERS: dict[str, PrefixEncoder] = {}


def encoder(path: str, known: Classes) -> PrefixEncoder:
    """One encoder for each worker process, so that tasks share what it remembers."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PrefixEncoder(path, known)
    return _ENCODERS[path]


def bpe_round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` for every row of ``docs``.

    A null text counts as empty, which has no tokens and the digests of an empty
    string. Every row is encoded by itself; repeated rows give repeated results and
    an empty table an empty one.
    """
    path = path or tokenizer_path("word_bpe_49k.json")
    known = classes(path)

    def worker():
        coder = encoder(path, known)

        def score(texts: list) -> dict:
            found = [coder.digests(t or "") for t in texts]
            return {
                "n_tokens": [x[0] for x in found],
                "ids_sha256": [x[1] for x in found],
                "decoded_sha256": [x[2] for x in found],
            }

        return score

    return map_texts(
        docs,
        worker,
        [StructField("n_tokens", LongType()), StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType())],
    )


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, ids, decoded``: the token ids themselves and the text they decode to."""
    from pyspark.sql.types import ArrayType, IntegerType

    path = path or tokenizer_path("word_bpe_49k.json")
    known = classes(path)

    def worker():
        coder = encoder(path, known)

        def score(texts: list) -> dict:
            ids = [coder.encode(t or "") for t in texts]
            return {"ids": ids, "decoded": [coder.decode(x) for x in ids]}

        return score

    return map_texts(docs, worker, [StructField("ids", ArrayType(IntegerType())), StructField("decoded", StringType())])
