"""Token counts of whole documents, with huge documents encoded in overlapping chunks.

A document longer than ``chunk`` characters is encoded piece by piece. The end of a
piece is encoded again, with ``overlap`` characters on either side, and the two
encodings are spliced at a character position that is a token boundary in both and
that no context can move: a byte-level pre-tokenizer has no match that goes on
from a character other than white space into white space, and none that holds a
letter and a digit. The next piece starts there. If the overlap holds no such position
it is doubled, and at last the piece itself, so a text without any boundary is
encoded in one go rather than wrongly.
"""

from __future__ import annotations

import os
import re
from itertools import accumulate

import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, LongType, StructField

from opsmart.llm.common import map_texts, tokenizer_path

#: White space of the byte-level pre-tokenizer (Unicode's property, so without the separators U+001C to U+001F).
_WS = "\\t-\\r\\x20\\x85\\xA0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000"
#: The byte-level pre-tokenizer's pattern; a fixed value.
_PIECES = regex.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?\\p{{L}}+| ?\\p{{N}}+| ?[^{_WS}\\p{{L}}\\p{{N}}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+"
)
#: Positions at which every pre-tokenization splits; matched between two characters.
_STABLE = regex.compile(f"(?<=[^{_WS}])(?=[{_WS}])|(?<=\\p{{L}})(?=\\p{{N}})|(?<=\\p{{N}})(?=\\p{{L}})")
_BLANK_AFTER_SPACE = re.compile("\\s ")
#: Distinct pieces a worker remembers at most; then it starts anew.
_REMEMBERED = 1_200_000


class ChunkedCounter:
    """Counts tokens as ``tokenizer`` gives them for the whole text.

    The library encodes each distinct piece (what its pre-tokenizer yields) once; BPE
    never merges across pieces, so the tokens of a chunk are those of its pieces.
    """

    def __init__(self, tokenizer, chunk: int = 1 << 16, overlap: int = 512):
        if not 0 < overlap < chunk:
            raise ValueError("the overlap must be shorter than the chunk")
        self.tokenizer, self.chunk, self.overlap = tokenizer, chunk, overlap
        self.marks = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        self._split = regex.compile("(" + "|".join(map(regex.escape, self.marks)) + ")") if self.marks else None
        self._known: dict[str, int] = {}
        self._runs: dict[str, int] = {}

    def count(self, texts: list[str]) -> list[int]:
        return [self._long(t) if len(t) > self.chunk else self._short(t) for t in texts]

    def _short(self, text: str) -> int:
        """A blank after a character that is not white space always begins a piece: split there."""
        if any(mark in text for mark in self.marks) or _BLANK_AFTER_SPACE.search(text):
            return sum(self._sizes(self._pieces(text)))
        first, *rest = text.split(" ")
        known = self._runs
        try:
            total = sum([known[x] for x in rest])
        except KeyError:
            new = list({x for x in rest if x not in known})
            if len(known) + len(new) > _REMEMBERED:
                known.clear()
                new = list(set(rest))
            found = self.tokenizer.encode_batch_fast([" " + x for x in new], add_special_tokens=False)
            known.update(zip(new, map(len, found), strict=True))
            total = sum([known[x] for x in rest])
        return total + sum(self._sizes(self._pieces(first)))

    def _pieces(self, text: str) -> list[str]:
        if not any(mark in text for mark in self.marks):
            return _PIECES.findall(text)
        parts = self._split.split(text)
        return [x for k, part in enumerate(parts) for x in ([part] if k % 2 else _PIECES.findall(part))]

    def _sizes(self, pieces: list[str]) -> list[int]:
        """Tokens of each piece."""
        known = self._known
        try:
            return [known[x] for x in pieces]
        except KeyError:
            new = list({x for x in pieces if x not in known})
            if len(known) + len(new) > _REMEMBERED:
                known.clear()
                new = list(set(pieces))
            found = self.tokenizer.encode_batch_fast(new, add_special_tokens=False)
            known.update(zip(new, map(len, found), strict=True))
            return [known[x] for x in pieces]

    def _encode(self, text: str, start: int, end: int) -> tuple[list[int], list[int]]:
        """Where the pieces of ``text[start:end]`` end, and the tokens up to there."""
        pieces = self._pieces(text[start:end])
        ends = list(accumulate(map(len, pieces), initial=start))
        return ends, list(accumulate(self._sizes(pieces), initial=0))

    def _long(self, text: str) -> int:
        total, start, size = 0, 0, self.chunk
        while True:
            end = self._clear(text, min(len(text), start + size))
            ends, sums = self._encode(text, start, end)
            if end == len(text):
                return total + sums[-1]
            upto = dict(zip(ends, sums, strict=True))
            splice = self._splice(text, upto, start, end)
            if splice is None:  # nothing to align with: a longer piece from the same start
                size *= 2
                continue
            total += upto[splice]
            start, size = splice, self.chunk

    def _splice(self, text: str, upto: dict[int, int], start: int, end: int) -> int | None:
        """The last stable position at which this chunk and one that overlaps it both have a boundary."""
        overlap = self.overlap
        while overlap < end - start:
            begin = end - overlap
            other = set(self._encode(text, begin, self._clear(text, min(len(text), end + overlap)))[0])
            common = [m.start() for m in _STABLE.finditer(text, begin, end) if begin < m.start() < end]
            for at in reversed(common):
                if at in upto and at in other:
                    return at
            overlap *= 2
        return None

    def _clear(self, text: str, end: int) -> int:
        """Move an end that falls inside a special token's string past it."""
        for mark in self.marks:
            at = text.find(mark, max(0, end - len(mark) + 1), min(len(text), end + len(mark) - 1))
            if 0 <= at < end < at + len(mark):
                return at + len(mark)
        return end


_COUNTERS: dict[tuple, ChunkedCounter] = {}


def _counter(path: str, chunk: int, overlap: int) -> ChunkedCounter:
    """One counter for each worker process, so that tasks share what it remembers."""
    key = (path, chunk, overlap)
    if key not in _COUNTERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        _COUNTERS[key] = ChunkedCounter(tokenizer, chunk, overlap)
    return _COUNTERS[key]


def token_counts(
    docs: DataFrame,
    path: str | None = None,
    limit: int = 512,
    chunk: int = 1 << 16,
    overlap: int = 512,
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row of ``docs``.

    A null text counts as empty: no bytes, no tokens, not over the limit. Rows are
    independent, so repeated rows give repeated results and an empty table an empty
    one. The strings of special tokens inside a text are handled as the library
    does by default, that is, as one token each.
    """
    path = path or tokenizer_path("byte_bpe_50k.json")

    def worker():
        counter = _counter(path, chunk, overlap)

        def score(texts: list) -> dict:
            texts = [t or "" for t in texts]
            counts = counter.count(texts)
            return {
                "n_bytes": [len(t.encode()) for t in texts],
                "n_tokens": counts,
                "over_limit": [n > limit for n in counts],
            }

        return score

    return map_texts(
        docs,
        worker,
        [StructField("n_bytes", LongType()), StructField("n_tokens", LongType()), StructField("over_limit", BooleanType())],
    )
