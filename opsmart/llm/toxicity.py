"""Toxicity from the nearest labelled examples, by exact TF-IDF cosine.

The examples are a bounded sample of the labelled rows that may be learned from. The vector space has
all words of the examples and those beginnings of words that tell the classes apart in the sample (chi-square), with
document frequencies counted over all documents; the terms that tell the classes apart count three times. Words that no example has are one more term: they cannot
change which example is nearest, they only set what a text shares with the examples against its length. The examples stand in an inverted index whose posting lists are cut into blocks of
examples, each with the largest weight in it. A text is compared block by block, those with the largest
possible similarity first, until no block left can hold a nearer example than those found, so the
neighbours are exact. They vote with weights that fall with their distance, and the share of the votes
becomes a probability by an isotonic fit to what the examples themselves get when each is left out.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, DoubleType, IntegerType, StringType, StructField, StructType

from opsmart.llm.common import held_out, labelled_sample
from opsmart.session import shared_dir

_WORD = re.compile(r"\w+")
#: Besides whole words, their beginnings of these lengths are terms.
_HEADS = (5, 7)
_BLOCK = 32
#: Blocks looked at first, those that may hold the nearest examples.
_FIRST = 6
#: Examples that others gather around, so that a block holds examples that are alike and its bounds are close.
_CENTRES = 48
#: How much more a term that tells the classes apart counts: of 3, 6, 12 and 24 the one that finds most when the examples are left out.
_TELLING = 3.0
#: What a neighbour's vote falls by with its distance, and the weight of the vote for the prior.
_NEAR, _PRIOR_VOTE = 0.15, 0.3


def words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def terms_of(word: str) -> list[str]:
    """The word, and its longer beginnings marked by a star."""
    return [word, *(word[:n] + "*" for n in _HEADS if len(word) > n)]


def telling_terms(sample: list[tuple[list[str], int]], least: float = 20.0, rows: int = 5) -> list[str]:
    """Terms whose presence depends on the class: a chi-square of ``least`` or more, in at least ``rows`` texts."""
    sizes = [0, 0]
    seen: tuple[Counter, Counter] = (Counter(), Counter())
    for found, label in sample:
        sizes[label] += 1
        seen[label].update({t for w in set(found) for t in terms_of(w)})
    total = sum(sizes)
    kept = []
    for term in seen[0].keys() | seen[1].keys():
        n0, n1 = seen[0][term], seen[1][term]
        n = n0 + n1
        if n < rows or n == total or not all(sizes):
            continue
        gap = abs(n1 * (sizes[0] - n0) - n0 * (sizes[1] - n1)) - total / 2
        if gap > 0 and total * gap * gap / (n * (total - n) * sizes[0] * sizes[1]) >= least:
            kept.append(term)
    return sorted(kept)


def all_terms(sample: list[tuple[list[str], int]]) -> list[str]:
    """Every word of the sample, and the telling beginnings of words."""
    return sorted({w for found, _ in sample for w in found}.union(telling_terms(sample)))


class Vocabulary:
    """Terms by number; the number after the last stands for all words without a term."""

    def __init__(self, terms: list[str]):
        self.number = {t: i for i, t in enumerate(terms)}
        self.known = {w: self._of(w) for w in terms}
        #: A word that is no term itself can only hold one if it begins like one.
        self.heads = {t[: _HEADS[0]] for t in terms if t.endswith("*")}
        self.other = len(terms)

    def _of(self, word: str) -> tuple[int, ...]:
        return tuple(self.number[t] for t in terms_of(word) if t in self.number)

    def count(self, found: list[str]) -> Counter:
        """How often each term occurs; a word without any counts as other."""
        counts: Counter = Counter()
        other = 0
        for w, n in Counter(found).items():
            have = self.known.get(w)
            if have is None:
                have = self._of(w) if w[: _HEADS[0]] in self.heads else ()
            for t in have:
                counts[t] += n
            if not have:
                other += n
        if other:
            counts[self.other] = other
        return counts


#: Terms in ascending order, and their weights.
Vector = tuple[np.ndarray, np.ndarray]


def counted(vocabulary: Vocabulary, found: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The terms of some words in ascending order, and how often each occurs."""
    counts = vocabulary.count(found)
    terms = np.fromiter(counts.keys(), np.int64, len(counts))
    order = np.argsort(terms)
    return terms[order], np.fromiter(counts.values(), np.int64, len(counts))[order]


@dataclass
class Index:
    """Block-max inverted index of labelled examples."""

    vocabulary: Vocabulary
    idf: np.ndarray
    #: Examples with equal vectors are one: the share of toxic ones among them, their number, a name.
    labels: np.ndarray
    sizes: np.ndarray
    names: list[str]
    prior: float
    neighbours: int = 15
    #: The posting lists one after the other: examples, their weights, the lengths of the lists, and where each block of each list starts.
    holders: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    lengths: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    blocks: int = 0
    starts: np.ndarray = field(default_factory=lambda: np.zeros((0, 1), np.int64))
    block_max: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    curve: tuple[np.ndarray, np.ndarray] = field(default_factory=lambda: (np.zeros(1), np.zeros(1)))

    def vector(self, found: list[str]) -> Vector:
        """Unit TF-IDF vector; empty for a text without words."""
        return self.weighted(*counted(self.vocabulary, found))

    def weighted(self, terms: np.ndarray, counts: np.ndarray) -> Vector:
        raw = (1 + np.log(counts)) * self.idf[terms]
        return terms, raw / (np.sqrt((raw * raw).sum()) if len(raw) else 1.0)

    def add(self, vectors: list[Vector]) -> None:
        blocks, size = -(-len(vectors) // _BLOCK), self.vocabulary.other + 1
        lengths = [len(t) for t, _ in vectors]
        terms = np.concatenate([np.zeros(0, np.int64), *(t for t, _ in vectors)])
        weights = np.concatenate([np.zeros(0), *(x for _, x in vectors)])
        holders = np.repeat(np.arange(len(vectors)), lengths)
        order = np.lexsort((holders, terms))
        terms, self.holders, self.weights = terms[order], holders[order].astype(np.int32), weights[order]
        self.blocks, self.lengths = blocks, np.bincount(terms, minlength=size).astype(np.int32)
        self._cut()

    def _cut(self) -> None:
        """Where the blocks of each list start, and their largest weights."""
        size, blocks = len(self.lengths), self.blocks
        terms = np.repeat(np.arange(size), self.lengths)
        self.block_max = np.zeros((size, blocks), np.float32)
        np.maximum.at(self.block_max, (terms, self.holders // _BLOCK), self.weights * (1 + 1e-6))  # rounded up
        cells = np.bincount(terms * blocks + self.holders // _BLOCK, minlength=size * blocks)
        self.starts = np.zeros((size, blocks + 1), np.int32)
        ends = np.cumsum(cells).reshape(size, blocks)
        self.starts[:, 1:] = ends
        self.starts[1:, 0] = ends[:-1, -1] if blocks else 0

    def __getstate__(self) -> dict:
        """All but the tables of blocks, which have a cell a term and block: workers make them from the lists."""
        return {k: v for k, v in vars(self).items() if k not in ("block_max", "starts")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._cut()

    def nearest(self, vector: Vector, without: int = -1) -> list[tuple[float, int]]:
        """``(similarity, example)`` of the nearest examples, ties by position; ``without`` is passed over if it is a single one."""
        terms, own = vector
        if not len(terms):
            return []
        bound = own.astype(np.float32) @ self.block_max[terms]
        skipped = without if without >= 0 and self.sizes[without] == 1 else -1
        order = np.argsort(-bound, kind="stable")
        likely, rest = order[:_FIRST], order[_FIRST:]
        similar = self._similar(terms, own, likely)
        best = self._closest(similar, skipped)
        least = best[-1][0] * (1 - 1e-5) if len(best) == self.neighbours else 0.0
        rest = rest[bound[rest] >= max(least, 1e-12)]
        if len(rest):  # blocks that may hold a nearer example, or one as near
            best = self._closest(similar + self._similar(terms, own, rest), skipped)
        return best

    def _similar(self, terms: np.ndarray, own: np.ndarray, blocks: np.ndarray) -> np.ndarray:
        """Similarities of the examples in some blocks, from the parts of the posting lists in them; 0 elsewhere."""
        rows = self.starts[terms]
        if len(blocks) == self.block_max.shape[1]:
            first, last = rows[:, 0], rows[:, -1]
        else:
            first, last = rows[:, blocks].ravel(), rows[:, blocks + 1].ravel()
            own = np.repeat(own, len(blocks))
        sizes = (last - first).astype(np.int64)
        at = np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        return np.bincount(self.holders[at], np.repeat(own, sizes) * self.weights[at], len(self.sizes))

    def _closest(self, similar: np.ndarray, skipped: int) -> list[tuple[float, int]]:
        at = np.flatnonzero(similar)
        at = at[at != skipped]
        if len(at) > self.neighbours:  # all that are as near as the last neighbour stay in
            least = np.partition(similar[at], -self.neighbours)[-self.neighbours]
            at = at[similar[at] >= least]
        at = at[np.lexsort((at, -similar[at]))][: self.neighbours]
        return list(zip(similar[at].tolist(), at.tolist(), strict=True))

    def votes(self, near: list[tuple[float, int]], without: int = -1, label: int = 0) -> float:
        """Share of the votes for toxic; a neighbour's vote falls with its distance, and the prior votes too.

        One row with ``label`` is taken out of the example ``without``.
        """
        total, toxic = _PRIOR_VOTE, _PRIOR_VOTE * self.prior
        for similarity, i in near:
            vote = (_NEAR / (_NEAR + max(0.0, 1 - similarity))) ** 2
            share = self.labels[i]
            if i == without:
                share = (share * self.sizes[i] - label) / (self.sizes[i] - 1)
            total += vote
            toxic += vote * share
        return toxic / total

    def score(self, near: list[tuple[float, int]]) -> float:
        return float(np.interp(self.votes(near), *self.curve))


def isotonic(raw: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-decreasing fit of the label to the raw score (pool adjacent violators), as points of a curve."""
    order = np.argsort(raw, kind="stable")
    pools: list[list[float]] = []  # sum of raw, of label, of weight
    for i in order:
        pools.append([raw[i] * weight[i], label[i] * weight[i], weight[i]])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    if not pools:
        return np.zeros(1), np.zeros(1)
    return np.array([p[0] / p[2] for p in pools]), np.array([p[1] / p[2] for p in pools])


def packed(terms: np.ndarray, counts: np.ndarray) -> bytes:
    """Gaps between the terms and counts as 32-bit integers, byte planes one after the other: most planes are zeros, which compress away."""
    numbers = np.concatenate([np.diff(terms, prepend=0), counts]).astype("<u4")
    return np.ascontiguousarray(numbers.view(np.uint8).reshape(-1, 4).T).tobytes()


def unpacked(planes: bytes) -> tuple[np.ndarray, np.ndarray]:
    """What :func:`packed` was given."""
    numbers = np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<u4").astype(np.int64).reshape(2, -1)
    return np.cumsum(numbers[0]), numbers[1]


def term_counts(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``doc_id, packed`` of every row, and rows ``partial`` with ``terms, counts``, the document frequencies of a task.

    Written to the shared folder: texts are cut into words once, for the frequencies and for the scores.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # the words of the sample
    rows = docs.select("doc_id", "text")
    numbers = ArrayType(IntegerType())
    out = StructType([rows.schema["doc_id"], StructField("partial", BooleanType()), StructField("packed", BinaryType()), StructField("terms", numbers), StructField("counts", numbers)])
    arrow = to_arrow_schema(out)

    def made(ids: list, partial: bool, planes: list, terms: list, counts: list) -> pa.RecordBatch:
        columns = [ids, [partial] * len(ids), planes, terms, counts]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total = shared.value, 0
        holders = np.zeros(known.other + 1, np.int64)
        for batch in batches:
            found = [counted(known, words(text)) for text in batch.column(1).to_pylist()]
            for terms, _ in found:
                holders[terms] += 1
            total += len(found)
            none = [None] * len(found)
            yield made(batch.column(0).to_pylist(), False, [packed(*f) for f in found], none, none)
        seen = np.flatnonzero(holders)
        yield made([None], True, [None], [np.append(seen, -1)], [np.append(holders[seen], total)])

    path = shared_dir(docs.sparkSession, "term-counts")
    rows.mapInArrow(count, out).write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(out).parquet(path)


def document_frequencies(counted_docs: DataFrame, size: int) -> tuple[int, np.ndarray]:
    """How many documents there are, and in how many of them each term stands."""
    parts = counted_docs.where("partial").select(F.explode(F.arrays_zip("terms", "counts")).alias("p")).select("p.terms", "p.counts")
    found = {r["terms"]: r["n"] for r in parts.groupBy("terms").agg(F.sum("counts").alias("n")).collect()}  # the terms of the sample
    return found.get(-1, 0), np.array([found.get(t, 0) for t in range(size)], float)


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 1500, neighbours: int = 15) -> tuple[Index, DataFrame]:
    """An index of at most ``2 * per_class`` labelled examples that are not held out, and the counted terms of all documents.

    A text that occurs often counts once with each label that it has.
    """
    once = {}
    for name, text, label in labelled_sample(docs, labels, "toxic", per_class):
        once.setdefault((text, label), (str(name), words(text), label))
    examples = list(once.values())
    sample = [(found, label) for _, found, label in examples]
    vocabulary = Vocabulary(all_terms(sample))
    all_counted = term_counts(docs, vocabulary)
    total, counts = document_frequencies(all_counted, vocabulary.other + 1)
    idf = np.log((1 + total) / (1 + counts)) + 1
    idf[[vocabulary.number[t] for t in telling_terms(sample)]] *= _TELLING
    usable = labels.where(~held_out(F.col("doc_id")) & F.col("toxic").isin(0, 1))
    prior = usable.agg(F.avg(F.col("toxic").cast("double"))).first()[0] or 0.0
    return build(vocabulary, idf, examples, prior, neighbours), all_counted


def _alike(vectors: list[Vector], toxic: np.ndarray, size: int) -> np.ndarray:
    """An order of the examples in which neighbours are alike: by class, then around the centre they are nearest to."""
    if not vectors:
        return np.zeros(0, np.int64)
    centres = np.zeros((size, min(_CENTRES, len(vectors))), np.float32)
    for k in range(centres.shape[1]):
        terms, own = vectors[k * len(vectors) // centres.shape[1]]
        centres[terms, k] = own
    near = np.array([own @ centres[terms] for terms, own in vectors]).reshape(len(vectors), -1)
    return np.lexsort((-near.max(axis=1), near.argmax(axis=1), toxic > 0.5))


def build(vocabulary: Vocabulary, idf: np.ndarray, examples: list[tuple[str, list[str], int]], prior: float, neighbours: int) -> Index:
    """Index and calibration from ``(name, words, label)`` examples."""
    index = Index(vocabulary, idf, np.zeros(0), np.zeros(0, np.int64), [], prior, neighbours)
    place: dict[tuple, int] = {}
    vectors, members, held = [], [], []
    for name, found, label in examples:
        vector = index.vector(found)
        key = (vector[0].tobytes(), vector[1].round(9).tobytes())
        if key not in place:
            place[key] = len(vectors)
            vectors.append(vector)
            index.names.append(name)
            held.append([])
        held[place[key]].append(label)
        members.append((place[key], label))
    order = _alike(vectors, np.array([sum(x) / len(x) for x in held]), vocabulary.other + 1)
    moved = np.empty(len(order), np.int64)
    moved[order] = np.arange(len(order))
    vectors, held, index.names = ([x[k] for k in order] for x in (vectors, held, index.names))
    members = [(int(moved[i]), label) for i, label in members]
    index.labels = np.array([sum(x) / len(x) for x in held])
    index.sizes = np.array([len(x) for x in held], np.int64)
    index.add(vectors)
    raw = np.array([index.votes(index.nearest(vectors[i], without=i), i, label) for i, label in members])
    labels = np.array([label for _, label in members], float)
    share = labels.mean() if len(labels) else 0.0
    # The sample is balanced; weights bring it back to the share of toxic rows.
    weight = np.where(labels == 1, prior / max(share, 1e-9), (1 - prior) / max(1 - share, 1e-9))
    index.curve = isotonic(raw, labels, np.maximum(weight, 1e-9))
    return index


def score_toxicity(counted_docs: DataFrame, index: Index) -> DataFrame:
    """``doc_id, score, evidence``; the evidence names the three nearest examples as ``id:label:similarity``."""
    shared = counted_docs.sparkSession.sparkContext.broadcast(index)  # bounded by the sample
    rows = counted_docs.where("NOT partial").select("doc_id", "packed")
    out = StructType([rows.schema["doc_id"], StructField("score", DoubleType()), StructField("evidence", StringType())])
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        plain: dict[bytes, tuple[float, str]] = {}  # texts of one kind of term all have the same vector

        def judge(terms: np.ndarray, counts: np.ndarray) -> tuple[float, str]:
            near = own.nearest(own.weighted(terms, counts))
            return own.score(near), ",".join(f"{own.names[i]}:{own.labels[i]:.2f}:{s:.3f}" for s, i in near[:3])

        for batch in batches:
            found = []
            for planes in batch.column(1).to_pylist():
                terms, counts = unpacked(planes)
                if len(terms) > 1:
                    found.append(judge(terms, counts))
                else:
                    key = terms.tobytes()
                    if key not in plain:
                        plain[key] = judge(terms, counts)
                    found.append(plain[key])
            columns = [batch.column(0), [x[0] for x in found], [x[1] for x in found]]
            yield pa.RecordBatch.from_arrays(
                [c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow
            )

    return rows.mapInArrow(run, out)


def classify(docs: DataFrame, labels: DataFrame, per_class: int = 1500, threshold: float = 0.7) -> DataFrame:
    """``doc_id, held_out, score, predicted, evidence`` for every row of ``docs``.

    A text without words (null or empty) has no neighbour; the prior decides. Rows without ``doc_id`` count as not held out, but no label is learned from them. Repeated rows
    get the same score, an empty table gives an empty result, and without labels every score is 0.
    Only ``text`` goes into a score.
    """
    index, all_counted = fit(docs, labels, per_class)
    scored = score_toxicity(all_counted, index)
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        "evidence",
    )
