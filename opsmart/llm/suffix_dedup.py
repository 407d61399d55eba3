"""Removal of repeated byte windows by a depth-limited radix sort of suffixes.

Two suffixes matter only through their first ``size`` bytes, so they are not sorted any deeper, and not
lexicographically either: a most-significant-digit radix sort puts suffixes into the same bucket when a digit is
equal, drops buckets of one, and goes on with the next digit; what is equal through ``size`` bytes in the end is a
repeated window. The digits are chosen so that a whole stretch of neighbouring suffixes shares a bucket:

1. The first digit of a suffix is its *anchor*, the ``KMER`` bytes within its window that have the smallest hash (the
   leftmost of equals). It is a function of the window's bytes, so equal windows have equal anchors at equal
   offsets. Neighbouring suffixes with one anchor form a *run*, one row for about a hundred suffixes.
   Runs whose anchor occurs once are done.
2. The second digit is the content of the run as a whole. Runs that are equal are repeated in all their windows.
   Only anchors with runs of different content need another pass, with one run of each content.
3. The last digit is the window itself, digested for all suffixes of the runs that share an anchor.

Buckets of an anchor are cut into salted parts of ``part`` runs at most, and no bucket is gathered except for such a part.
Windows that stay single in their part may have an equal in another. They are put off by a digit that stands between
the second and the last: what all windows of ``BLOCK`` neighbouring offsets have in common. Only where another part
has the same, the windows left in the block are digested one by one and counted across the parts. Counts are
aggregated before they are shuffled. A run's content is told apart by 64 bits within the bucket of a 64-bit anchor, a
window by 128 bits.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from opsmart.session import materialise

KMER = 32
#: Neighbouring offsets that are told apart together across the parts of a bucket.
BLOCK = 8
#: Odd constants of the hash.
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]
_STIR = np.uint64(0xBF58476D1CE4E5B9)
_HIGH = np.uint64(0xFFFFFFFF00000000)
#: A run is packed into a long: its start, how many more windows it has, and its anchor's offset.
_BITS = 10
_MASK = (1 << _BITS) - 1
#: Bytes of a text whose anchors are looked for at once.
_STRETCH = 1 << 20


def _kmer_hashes(x: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ``KMER`` bytes from every position on."""
    words = x.astype(np.uint64)
    for bits in (8, 16, 32):
        step = bits // 8
        words = words[:-step] | (words[step:] << np.uint64(bits))
    n = len(x) - KMER + 1
    h = np.zeros(n, np.uint64)
    for j, c in enumerate(_MIX):
        h = (h ^ (words[8 * j : 8 * j + n] * c)) if not j else ((h ^ words[8 * j : 8 * j + n]) * c)
        h ^= h >> np.uint64(29)
        h *= _STIR
    return h ^ (h >> np.uint64(32))


def runs(data: bytes, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First and last window, anchor position and anchor hash of every run of a text."""
    found = []
    flat = np.frombuffer(data, np.uint8)
    last = len(data) - size  # the last window's start
    width = size - KMER + 1
    for begin in range(0, last + 1, _STRETCH):
        stop = min(last, begin + _STRETCH - 1)
        h = _kmer_hashes(flat[begin : stop + size])
        v = (h & _HIGH) | np.arange(len(h), dtype=np.uint64)
        step = 1
        while step * 2 <= width:
            v = np.minimum(v[:-step], v[step:])
            step *= 2
        if width > step:
            v = np.minimum(v[: step - width], v[width - step :])
        at = (v & ~_HIGH).astype(np.int64)
        cut = np.flatnonzero(np.diff(at)) + 1
        low = np.concatenate(([0], cut))
        high = np.concatenate((cut - 1, [len(at) - 1]))
        found.append((low + begin, high + begin, at[low] + begin, h[at[low]]))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _key_fields(docs: DataFrame) -> list[StructField]:
    return [StructField("doc_id", docs.schema["doc_id"].dataType), StructField("text_hash", LongType())]


def _own_hash(data: bytes) -> int:
    return np.uint64(xxhash.xxh64_intdigest(data, 42)).astype(np.int64)


def _scan(docs: DataFrame, size: int) -> DataFrame:
    """``doc_id, text_hash, run, anchor, content`` of all runs of all texts."""
    schema = StructType([*_key_fields(docs), StructField("run", LongType()), StructField("anchor", LongType()), StructField("content", LongType())])
    arrow = to_arrow_schema(schema)

    def scan(batches):
        for batch in batches:
            rows, hashes, packed, anchors, contents = [], [], [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                data = (text or "").encode()
                if len(data) < size:
                    continue
                low, high, at, anchor = runs(data, size)
                rows.append(np.full(len(low), i))
                hashes.append(np.full(len(low), _own_hash(data)))
                packed.append((low << (2 * _BITS)) | ((high - low) << _BITS) | (at - low))
                anchors.append(anchor.view(np.int64))
                view = memoryview(data)
                digest = xxhash.xxh3_64_intdigest
                contents.append(
                    np.array([digest(view[a:b]) for a, b in zip(low.tolist(), (high + size).tolist(), strict=True)], np.uint64).view(np.int64)
                )
                if sum(map(len, rows)) > 1 << 18:
                    yield emit(batch, rows, hashes, packed, anchors, contents)
                    rows, hashes, packed, anchors, contents = [], [], [], [], []
            if rows:
                yield emit(batch, rows, hashes, packed, anchors, contents)

    def emit(batch, rows, *columns):
        ids = batch.column(0).take(pa.array(np.concatenate(rows))).cast(arrow.field(0).type)
        return pa.RecordBatch.from_arrays([ids, *[pa.array(np.concatenate(c)) for c in columns]], schema=arrow)

    return docs.select("doc_id", "text").mapInArrow(scan, schema)


def _bodies(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, body``: the compressed bytes, which is what is shuffled of a text."""
    schema = StructType([*_key_fields(docs), StructField("body", BinaryType())])
    arrow = to_arrow_schema(schema)

    def squeeze(batches):
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            data = [(t or "").encode() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(arrow.field(0).type),
                    pa.array([_own_hash(d) for d in data], pa.int64()),
                    pa.array([pack(d) for d in data], arrow.field(2).type),
                ],
                schema=arrow,
            )

    return docs.select("doc_id", "text").mapInArrow(squeeze, schema)


def _by_key(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join on the document's key; a null id is a key like any other."""
    right = right.select(*[F.col(c).alias("_" + c) if c in ("doc_id", "text_hash") else F.col(c) for c in right.columns])
    same = left["doc_id"].eqNullSafe(right["_doc_id"]) & (left["text_hash"] == right["_text_hash"])
    return left.join(right, same, how).drop("_doc_id", "_text_hash")


def _contexts(docs: DataFrame, chosen: DataFrame, size: int) -> DataFrame:
    """``doc_id, text_hash, run, anchor, salt, salts, single, bytes``: the bytes of the chosen runs."""
    wanted = chosen.groupBy("doc_id", "text_hash").agg(
        F.collect_list(F.struct("run", "anchor", "salt", "salts", "single")).alias("wanted")  # a document's own runs
    )
    extra = [StructField(n, LongType()) for n in ("run", "anchor", "salt", "salts", "single")]
    schema = StructType([*_key_fields(docs), *extra, StructField("bytes", BinaryType())])
    arrow = to_arrow_schema(schema)

    def cut(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            names = batch.schema.names
            own = {n: batch.column(names.index(n)) for n in ("doc_id", "text_hash", "body", "wanted")}
            for i in range(batch.num_rows):
                data = unpack(own["body"][i].as_py())
                wanted = own["wanted"][i].as_py()
                # A text may hold very many runs; they leave a thousand at a time.
                for k in range(0, len(wanted), 1000):
                    some = wanted[k : k + 1000]
                    parts = []
                    for w in some:
                        low = w["run"] >> (2 * _BITS)
                        parts.append(data[low : low + ((w["run"] >> _BITS) & _MASK) + size])
                    n = len(some)
                    yield pa.RecordBatch.from_arrays(
                        [
                            own["doc_id"].take(pa.array([i] * n)).cast(arrow.field(0).type),
                            pa.array([own["text_hash"][i].as_py()] * n, pa.int64()),
                            *[pa.array([w[f.name] for w in some], pa.int64()) for f in extra],
                            pa.array(parts, arrow.field(len(arrow) - 1).type),
                        ],
                        schema=arrow,
                    )

    return _by_key(_bodies(docs), wanted, "inner").mapInArrow(cut, schema)


def _settle(contexts: DataFrame, size: int) -> DataFrame:
    """Windows that stand twice in a part of a bucket, as spans; and what other parts of the bucket have to know.

    ``kind`` says what a row is. ``span``: repeated windows cover ``start:end``. For buckets of several parts, ``window``: the
    part holds the window ``digest`` more than once; ``left``: this run has the common bytes ``digest`` in a block, and of the block's
    windows those in the bits of ``mask`` are single, the first bit standing for a window at byte ``start``; ``seen``: runs of
    the part have ``digest`` in a block as well, but none with it is ``left``. Rows come in sorted by bucket and part.
    """
    schema = StructType(
        [
            *contexts.schema.fields[:2],
            *[StructField(n, LongType()) for n in ("run", "anchor", "salt")],
            StructField("kind", StringType()),
            StructField("digest", BinaryType()),
            *[StructField(n, LongType()) for n in ("mask", "start", "end")],
        ]
    )
    arrow = to_arrow_schema(schema)
    digest = xxhash.xxh3_128_digest

    def settle_part(part: list[dict], out: list[tuple]) -> None:
        several = part[0]["salts"] > 1
        if len(part) == 1 and not several:
            return
        first: dict[bytes, tuple[int, int]] = {}
        often: set[bytes] = set()
        marks = []
        for i, row in enumerate(part):
            data = memoryview(row["bytes"])
            n = len(data) - size + 1
            mark = np.zeros(n + 1, bool)
            marks.append(mark)
            for j in range(n):
                d = digest(data[j : j + size])
                seen = first.setdefault(d, (i, j))
                if seen != (i, j):
                    mark[j] = marks[seen[0]][seen[1]] = True
                    often.add(d)
        for row, mark in zip(part, marks, strict=True):
            if row["single"]:
                low = row["run"] >> (2 * _BITS)
                edges = np.flatnonzero(np.diff(np.concatenate(([False], mark)).astype(np.int8)))
                for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
                    out.append((row["doc_id"], row["text_hash"], None, row["anchor"], None, "span", None, None, low + a, low + b - 1 + size))
        if several:
            anchor, salt = part[0]["anchor"], part[0]["salt"]
            out += [(None, None, None, anchor, salt, "window", d, None, None, None) for d in often]
            seen_blocks: set[bytes] = set()
            left_blocks: set[bytes] = set()
            for row, mark in zip(part, marks, strict=True):
                low, at = row["run"] >> (2 * _BITS), row["run"] & _MASK
                n = len(mark) - 1
                data = row["bytes"]
                for block in range((at - n + 1) // BLOCK, at // BLOCK + 1):
                    # A window at j has its anchor at offset at - j; the block's offsets go from block * BLOCK up.
                    begin, end = at - block * BLOCK, at - block * BLOCK - BLOCK + 1
                    d = digest(data[begin : end + size])
                    seen_blocks.add(d)
                    places = range(max(0, end), min(n - 1, begin) + 1)
                    mask = sum(1 << (j - places[0]) for j in places if not mark[j])
                    if mask:
                        left_blocks.add(d)
                        out.append((row["doc_id"], row["text_hash"], row["run"], anchor, salt, "left", d, mask, low + places[0], None))
            out += [(None, None, None, anchor, salt, "seen", d, None, None, None) for d in seen_blocks - left_blocks]

    def settle(batches):
        part: list[dict] = []
        out: list[tuple] = []

        def flush():
            columns = list(zip(*out, strict=True))
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

        for batch in batches:
            for row in batch.to_pylist():
                if part and (row["anchor"], row["salt"]) != (part[0]["anchor"], part[0]["salt"]):
                    settle_part(part, out)
                    part = []
                    if len(out) >= 20_000:
                        yield flush()
                part.append(row)
        if part:
            settle_part(part, out)
        if out:
            yield flush()

    return contexts.mapInArrow(settle, schema)


def _across(settled: DataFrame, contexts: DataFrame, size: int) -> DataFrame:
    """``doc_id, text_hash, start``: windows single in their part that another part of their bucket has as well.

    A run that is repeated as a whole needs no answer (its ``start`` is null here), but others may equal its windows.
    """
    key = ["doc_id", "text_hash"]
    blocks = settled.where("kind IN ('seen', 'left')").groupBy("anchor", "digest")
    shared = blocks.agg(F.min("salt").alias("first"), F.max("salt").alias("last")).where("first < last")
    asked = (
        settled.where("kind = 'left'")
        .join(shared.select("anchor", "digest"), ["anchor", "digest"], "left_semi")
        .groupBy(*key, "run")
        .agg(F.collect_list(F.struct("start", "mask")).alias("asked"))  # the blocks of one run
    )
    known = _by_run(contexts.where("salts > 1"), asked)
    schema = StructType(
        [*contexts.schema.fields[:2], StructField("anchor", LongType()), StructField("salt", LongType()), StructField("digest", BinaryType()), StructField("start", LongType())]
    )
    arrow = to_arrow_schema(schema)

    def digests(batches):
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            for row in batch.to_pylist():
                low = row["run"] >> (2 * _BITS)
                data = row["bytes"]
                places = [a["start"] + k for a in row["asked"] for k in range(BLOCK) if a["mask"] >> k & 1]
                n = len(places)
                if n:
                    columns = [
                        [row["doc_id"]] * n,
                        [row["text_hash"]] * n,
                        [row["anchor"]] * n,
                        [row["salt"]] * n,
                        [digest(data[j - low : j - low + size]) for j in places],
                        places if row["single"] else [None] * n,
                    ]
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    open_windows = materialise(known.mapInArrow(digests, schema), "windows")
    every = open_windows.select("anchor", "salt", "digest").unionByName(settled.where("kind = 'window'").select("anchor", "salt", "digest"))
    again = every.distinct().groupBy("anchor", "digest").agg(F.count("*").alias("n")).where("n > 1").select("anchor", "digest")
    return open_windows.where("start IS NOT NULL").join(again, ["anchor", "digest"], "left_semi").select(*key, "start")


def _by_run(contexts: DataFrame, asked: DataFrame) -> DataFrame:
    asked = asked.select(F.col("doc_id").alias("_doc_id"), F.col("text_hash").alias("_text_hash"), F.col("run").alias("_run"), "asked")
    same = (
        contexts["doc_id"].eqNullSafe(asked["_doc_id"])
        & (contexts["text_hash"] == asked["_text_hash"])
        & (contexts["run"] == asked["_run"])
    )
    return contexts.join(asked, same).drop("_doc_id", "_text_hash", "_run")


def repeated_spans(docs: DataFrame, size: int = 400, part: int = 2048) -> DataFrame:
    """``doc_id, text_hash, start, end``: byte spans, possibly overlapping, that repeated windows cover."""
    if not KMER < size <= 1 << _BITS:
        raise ValueError(f"size must be above {KMER} and at most {1 << _BITS}")
    key = ["doc_id", "text_hash"]
    every = materialise(_scan(docs, size), "runs")
    # Written, so that the join below has two plain shuffles, of which adaptive execution splits the hot keys.
    shared = materialise(every.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"), "anchors")
    left = materialise(every.join(shared, "anchor", "left_semi"), "shared-anchors")
    contents = materialise(
        left.groupBy("anchor", "content").agg(
            F.count("*").alias("n"), F.first("doc_id").alias("doc_id"), F.first("text_hash").alias("text_hash"), F.first("run").alias("run")
        ),
        "contents",
    )
    size_of = (F.shiftright("run", _BITS).bitwiseAND(F.lit(_MASK)) + size).alias("len")
    start_of = F.shiftright("run", 2 * _BITS).alias("start")
    whole = left.join(contents.where("n > 1").select("anchor", "content"), ["anchor", "content"], "left_semi").select(*key, start_of, size_of)
    whole = whole.select(*key, "start", (F.col("start") + F.col("len")).alias("end"))
    mixed = materialise(
        contents.groupBy("anchor").agg(F.count("*").alias("kinds"), F.min("n").alias("least")).where("kinds > 1 AND least = 1"), "mixed"
    )
    salts = F.ceil(F.col("kinds") / part).cast("long")
    chosen = contents.join(mixed, "anchor").select(
        *key, "run", "anchor", F.pmod(F.xxhash64("content"), salts).alias("salt"), salts.alias("salts"), (F.col("n") == 1).cast("long").alias("single")
    )
    contexts = materialise(_contexts(docs, chosen, size), "contexts")
    parts = contexts.repartition("anchor", "salt").sortWithinPartitions("anchor", "salt")
    settled = materialise(_settle(parts, size), "settled")
    local = settled.where("kind = 'span'").select(*key, "start", "end")
    far = _across(settled, contexts, size).select(*key, "start", (F.col("start") + size).alias("end"))
    return whole.unionByName(local).unionByName(far)


def _merged(spans: list) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s in sorted((s["start"], s["end"]) for s in spans):
        if out and s[0] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], s[1])
        else:
            out.append(list(s))
    return [tuple(s) for s in out]


def _apply(docs: DataFrame, size: int, part: int, fields: list[StructField], finish) -> DataFrame:
    spans = repeated_spans(docs, size, part).groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    schema = StructType([_key_fields(docs)[0], *fields])
    arrow = to_arrow_schema(schema)

    def run(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            names = batch.schema.names
            ids, body, spans = (batch.column(names.index(n)) for n in ("doc_id", "body", "spans"))
            rows = []
            for i in range(batch.num_rows):
                data = unpack(body[i].as_py())
                rows.append(finish(data, _merged(spans[i].as_py() or [])))
            columns = list(zip(*rows, strict=True)) if rows else [[] for _ in fields]
            yield pa.RecordBatch.from_arrays(
                [ids.cast(arrow.field(0).type), *[pa.array(c, f.type) for c, f in zip(columns, list(arrow)[1:], strict=True)]], schema=arrow
            )

    return _by_key(_bodies(docs), spans, "left").mapInArrow(run, schema)


def _kept(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    at, parts = 0, []
    for a, b in spans:
        parts.append(data[at:a])
        at = b
    return b"".join([*parts, data[at:]])


def removed_windows(docs: DataFrame, size: int = 400, part: int = 2048) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for every row of ``docs``.

    A null text counts as empty; texts shorter than ``size`` bytes lose nothing. Rows that repeat an id and text are
    documents like any other, so all their windows are repeated. An empty table gives an empty result. Further
    columns are not read.
    """

    def finish(data: bytes, spans: list[tuple[int, int]]) -> tuple:
        return len(data), sum(b - a for a, b in spans), len(spans), hashlib.sha256(_kept(data, spans)).hexdigest()

    fields = [*[StructField(n, LongType()) for n in ("n_bytes", "n_removed", "n_spans")], StructField("kept_sha256", StringType())]
    return _apply(docs, size, part, fields, finish)


def deduplicated(docs: DataFrame, size: int = 400, part: int = 2048) -> DataFrame:
    """``doc_id, kept``: the remaining bytes, which need not be valid UTF-8 where a span began within a character."""
    return _apply(docs, size, part, [StructField("kept", BinaryType())], lambda data, spans: (_kept(data, spans),))
