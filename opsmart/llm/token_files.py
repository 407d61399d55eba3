"""Token ids in binary files: fixed-size blocks, cut into bit or byte planes, each plane compressed.

A file holds the ids of whole documents, one after the other. It is laid out as

* ``BPSF``, a version, the kind of planes and the ids in a block (16 bytes),
* the chunks, one for each block of ``block`` ids (the last one may be shorter): the block is transposed into
  planes, and each plane is a zstandard frame of its own,
* the chunk index: for each chunk its place and number of ids, and the size of each of its planes,
* a tail: number of ids, chunks and planes, place of the index and crc32 of the index (32 bytes).

So ids ``a`` to ``b`` are read by way of the tail, the index and the chunks that hold them. Planes above the
highest bit of a file are not stored. Byte planes are the default, as zstandard finds more in whole bytes
than in single bits; both kinds are read.

Documents are dealt out by ranges of ``doc_id`` and sorted, so partition by partition they are in
ascending order, and a partition (a *shard*) writes its files in one pass. Spark's Parquet writer commits them: a row
is a file (its bytes, and the directory of its documents), which works on any shared store and survives lost tasks.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from opsmart.llm.common import tokenizer_path
from opsmart.session import shared_dir

END_ID = 2
BLOCK = 1 << 14
#: Ids after which a file is closed, at the end of the document.
FILE_IDS = 1 << 20
_MAGIC, _VERSION = b"BPSF", 1
_HEAD = struct.Struct("<4sHHII")
_TAIL = struct.Struct("<QIIQII")
BYTE_PLANES, BIT_PLANES = 0, 1


# ---- the file format ---------------------------------------------------------


def _planes(ids: np.ndarray, kind: int, n: int) -> list[bytes]:
    """The ``n`` lowest planes of a block of unsigned 32-bit ids."""
    octets = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if kind == BYTE_PLANES:
        return [octets[:, k].tobytes() for k in range(n)]
    bits = np.unpackbits(octets, axis=1, bitorder="little")[:, :n]
    return [p.tobytes() for p in np.packbits(bits.T, axis=1, bitorder="little")]


def _from_planes(planes: list[bytes], kind: int, n_ids: int) -> np.ndarray:
    if kind == BYTE_PLANES:
        octets = np.zeros((n_ids, 4), np.uint8)
        for k, plane in enumerate(planes):
            octets[:, k] = np.frombuffer(plane, np.uint8)
        return octets.reshape(-1).view("<u4")
    bits = np.zeros((n_ids, 32), np.uint8)
    for k, plane in enumerate(planes):
        bits[:, k] = np.unpackbits(np.frombuffer(plane, np.uint8), bitorder="little")[:n_ids]
    return np.packbits(bits, axis=1, bitorder="little").reshape(-1).view("<u4")


def pack(ids: np.ndarray, block: int = BLOCK, kind: int = BYTE_PLANES, level: int = 3) -> bytes:
    """A file of these unsigned 32-bit ids."""
    ids = np.ascontiguousarray(ids, "<u4")
    high = int(ids.max()).bit_length() if len(ids) else 0
    n_planes = -(-high // 8) if kind == BYTE_PLANES else high
    squeeze = zstandard.ZstdCompressor(level=level, write_checksum=False)
    parts, index, at = [_HEAD.pack(_MAGIC, _VERSION, kind, block, 0)], [], _HEAD.size
    for k in range(0, len(ids), block):
        some = ids[k : k + block]
        frames = [squeeze.compress(p) for p in _planes(some, kind, n_planes)]
        index.append(struct.pack(f"<QI{n_planes}I", at, len(some), *map(len, frames)))
        parts += frames
        at += sum(map(len, frames))
    table = b"".join(index)
    tail = _TAIL.pack(len(ids), len(index), n_planes, at, zlib.crc32(table), 0)
    return b"".join([*parts, table, tail])


@dataclass(frozen=True)
class Chunk:
    first: int
    n_ids: int
    place: int
    sizes: tuple[int, ...]


class IdFile:
    """Reads a file; ``ids(a, b)`` touches only the chunks that hold positions ``a`` to ``b``."""

    def __init__(self, data: bytes):
        self._data = memoryview(data)
        if len(data) < _HEAD.size + _TAIL.size:
            raise ValueError("not a file of token ids: too short")
        magic, version, self.kind, self.block, _ = _HEAD.unpack_from(data, 0)
        if magic != _MAGIC or version != _VERSION:
            raise ValueError("not a file of token ids")
        self.n_ids, n_chunks, n_planes, at, check, _ = _TAIL.unpack_from(data, len(data) - _TAIL.size)
        if zlib.crc32(self._data[at : len(data) - _TAIL.size]) != check:
            raise ValueError("the chunk index is damaged")
        entry = struct.Struct(f"<QI{n_planes}I")
        self.chunks: list[Chunk] = []
        first = 0
        for k in range(n_chunks):
            place, n, *sizes = entry.unpack_from(data, at + k * entry.size)
            self.chunks.append(Chunk(first, n, place, tuple(sizes)))
            first += n
        self._unsqueeze = zstandard.ZstdDecompressor()

    def chunk(self, k: int) -> np.ndarray:
        c = self.chunks[k]
        planes, at = [], c.place
        for size in c.sizes:
            planes.append(self._unsqueeze.decompress(self._data[at : at + size]))
            at += size
        return _from_planes(planes, self.kind, c.n_ids)

    def ids(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        stop = self.n_ids if stop is None else min(stop, self.n_ids)
        if start >= stop:
            return np.zeros(0, "<u4")
        low, high = start // self.block, (stop - 1) // self.block
        found = np.concatenate([self.chunk(k) for k in range(low, high + 1)])
        return found[start - low * self.block : stop - low * self.block]


# ---- encoding ----------------------------------------------------------------

#: White space of the byte-level pre-tokenizer (Unicode's property); a fixed value.
_WS = "\\t-\\r\\x20\\x85\\xA0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000"
#: A blank after white space does not begin a piece.
_AMBIGUOUS = re.compile(f"[{_WS}] ")
_UNITS = re.compile(f"[{_WS}]*[^{_WS}]+|[{_WS}]+")
#: Units of each kind that a worker remembers, twice: those in use, and those in use before these.
_REMEMBERED = 500_000
_LONGEST = 64
#: Characters of text that are encoded together (or one longer text).
_AT_ONCE = 1 << 23
#: Units in a line, and lines that the library is given at once.
_LINE, _LINES = 256, 64


class _Units:
    """Ids of units (with ``before`` in front), of which the lately used ones are remembered.

    Units with a blank in front are encoded in lines of many: the library's work for a call is
    saved, and the ids of a line fall apart where the bytes of its tokens add up to the end of a unit.
    """

    def __init__(self, tokenizer, before: str, remembered: int):
        self.tokenizer, self.before, self.remembered = tokenizer, before, remembered
        self._known: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        added = {i: t.content for i, t in tokenizer.get_added_tokens_decoder().items()}
        self._marks = list(added.values())
        vocabulary = tokenizer.get_vocab()
        self._bytes = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        for token, i in vocabulary.items():  # a character of a byte-level token is a byte
            self._bytes[i] = len(added[i].encode()) if i in added else len(token)

    def join(self, texts: list[list[str]]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text, given as its units."""
        if len(self._known) > self.remembered:
            self._known, self._older = {}, self._known
        known, older = self._known, self._older
        missing = set().union(*texts).difference(known)
        for x in [x for x in missing if x in older]:
            known[x] = older[x]
            missing.discard(x)
        new = list(missing)
        known.update(zip(new, self._encode(new), strict=True))
        out = [b"".join(map(known.__getitem__, units)) for units in texts]
        for x in new:
            if len(x) > _LONGEST:
                del known[x]
        return out

    def _encode(self, units: list[str]) -> list[bytes]:
        out: list[bytes | None] = [None] * len(units)
        if self.before == " ":
            # In a line, white space at either end of a unit would meet its neighbour's.
            fit = [k for k, x in enumerate(units) if x and not (x[0].isspace() or x[-1].isspace() or any(m in x for m in self._marks))]
            for at in range(0, len(fit), _LINE * _LINES):
                some = fit[at : at + _LINE * _LINES]
                for k, b in zip(some, self._in_lines([" " + units[k] for k in some]), strict=True):
                    out[k] = b
        rest = [k for k, b in enumerate(out) if b is None]
        got = self.tokenizer.encode_batch_fast([self.before + units[k] for k in rest], add_special_tokens=False)
        for k, e in zip(rest, got, strict=True):
            out[k] = np.array(e.ids, "<u4").tobytes()
        return out

    def _in_lines(self, units: list[str]) -> list[bytes | None]:
        lines = ["".join(units[k : k + _LINE]) for k in range(0, len(units), _LINE)]
        got = self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)
        ids = np.concatenate([np.array(e.ids, "<u4") for e in got])
        upto = np.cumsum(self._bytes[ids])
        ends = np.cumsum([len(x.encode()) for x in units])
        cuts = np.searchsorted(upto, ends)
        if upto[-1] != ends[-1] or (upto[cuts] != ends).any():
            return [None] * len(units)  # not a byte-level vocabulary
        data, cuts = ids.tobytes(), [0, *(4 * (cuts + 1)).tolist()]
        return [data[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


class IdEncoder:
    """Ids of whole texts as the library gives them, as little-endian unsigned 32-bit bytes.

    No piece of the pre-tokenizer goes on from a character into white space after it, and no merge
    crosses pieces. So a text falls into *units*, white space and what follows up to the next white space, whose
    ids never depend on their neighbours. The distinct units of many texts are encoded once, and the ids
    of the texts are gathered from them; a worker remembers the ids of short units.
    """

    def __init__(self, tokenizer, remembered: int = _REMEMBERED):
        self.tokenizer = tokenizer
        self._plain = _Units(tokenizer, "", remembered)
        self._after_blank = _Units(tokenizer, " ", remembered)

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """A blank after a character other than white space begins a unit, so most texts fall apart at their blanks."""
        out: list[bytes] = []
        some: list[str] = []
        size = 0
        for text in texts:
            if some and size + len(text) > _AT_ONCE:
                out += self._together(some)
                some, size = [], 0
            some.append(text)
            size += len(text)
        return out + self._together(some)

    def _together(self, texts: list[str]) -> list[bytes]:
        heads, rests = [], []
        for text in texts:
            if _AMBIGUOUS.search(text):
                heads.append(_UNITS.findall(text))
                rests.append([])
            else:
                first, *rest = text.split(" ")
                heads.append([first] if first else [])
                rests.append(rest)
        return [a + b for a, b in zip(self._plain.join(heads), self._after_blank.join(rests), strict=True)]


_ENCODERS: dict[str, IdEncoder] = {}


def _encoder(path: str) -> IdEncoder:
    """One for each worker process, so that tasks share what it remembers."""
    if path not in _ENCODERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        _ENCODERS[path] = IdEncoder(tokenizer)
    return _ENCODERS[path]


# ---- writing and reading -----------------------------------------------------


def write_token_files(
    docs: DataFrame,
    folder: str,
    path: str | None = None,
    end_id: int = END_ID,
    block: int = BLOCK,
    kind: int = BYTE_PLANES,
    file_ids: int = FILE_IDS,
) -> None:
    """Encode every text of ``docs``, append ``end_id`` to each, and write the files to ``folder``.

    Rows of the written table: ``shard, file, first`` (ids of the shard before the file), ``n_ids``, ``doc_ids`` and
    ``ends`` (the directory: documents in order and where their ids end in the file) and ``data``. Documents are in
    ascending ``doc_id``, those without one first; equal ids are ordered by a hash of their text, repeated rows are
    repeated. A null text counts as empty and has the end id only. An empty table writes no row. Further columns
    of ``docs`` are not read. A task holds a file's ids and one batch of texts.
    """
    path = path or tokenizer_path("byte_bpe_50k.json")
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("_tie"))
    dealt = rows.repartitionByRange("doc_id", "_tie").sortWithinPartitions("doc_id", "_tie").select("doc_id", "text")
    id_type = rows.schema["doc_id"].dataType
    out = StructType().add("shard", IntegerType()).add("file", IntegerType()).add("first", LongType()).add("n_ids", LongType())
    out = out.add("doc_ids", ArrayType(id_type)).add("ends", ArrayType(LongType())).add("data", BinaryType())
    arrow = to_arrow_schema(out)
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, shard = _encoder(path).encode_all, TaskContext.get().partitionId()
        number, first, size = 0, 0, 0
        names, ends, parts = [], [], []

        def close() -> pa.RecordBatch:
            data = pack(np.frombuffer(b"".join(parts), "<u4"), block, kind)
            row = [shard, number, first, size, list(names), list(ends), data]
            return pa.RecordBatch.from_arrays([pa.array([v], type=f.type) for v, f in zip(row, arrow, strict=True)], schema=arrow)

        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for name, ids in zip(batch.column(0).to_pylist(), encode(texts), strict=True):
                parts += ids, end
                size += len(ids) // 4 + 1
                names.append(name)
                ends.append(size)
                if size >= file_ids:
                    yield close()
                    number, first, size = number + 1, first + size, 0
                    names, ends, parts = [], [], []
        if names:
            yield close()

    # The planes are compressed already.
    dealt.mapInArrow(run, out).write.option("compression", "uncompressed").parquet(folder)


def _bases(files: DataFrame) -> DataFrame:
    """``shard, base``: ids of all shards before; there are as many rows as the writing stage had tasks."""
    totals = sorted(files.groupBy("shard").agg(F.sum("n_ids").alias("n")).collect())
    base, rows = 0, []
    for shard, n in totals:
        rows.append((shard, base))
        base += n
    return files.sparkSession.createDataFrame(rows, "shard int, base long")


def chunk_index(spark, folder: str) -> DataFrame:
    """``shard, file, chunk, start, n_ids, n_bytes`` of every chunk; ``start`` counts ids of all files in order."""
    files = spark.read.parquet(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in (batch.slice(k, 1).to_pylist()[0] for k in range(batch.num_rows)):
                cs = IdFile(r["data"]).chunks
                yield pa.RecordBatch.from_pydict(
                    {
                        "shard": pa.array([r["shard"]] * len(cs), pa.int32()),
                        "file": pa.array([r["file"]] * len(cs), pa.int32()),
                        "chunk": pa.array(range(len(cs)), pa.int32()),
                        "_at": pa.array([r["first"] + c.first for c in cs], pa.int64()),
                        "n_ids": pa.array([c.n_ids for c in cs], pa.int64()),
                        "n_bytes": pa.array([sum(c.sizes) for c in cs], pa.int64()),
                    }
                )

    found = files.select("shard", "file", "first", "data").mapInArrow(
        run, "shard int, file int, chunk int, _at long, n_ids long, n_bytes long"
    )
    return found.join(_bases(files), "shard").select(
        "shard", "file", "chunk", (F.col("base") + F.col("_at")).alias("start"), "n_ids", "n_bytes"
    )


def read_token_files(spark, folder: str, with_ids: bool = True) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` and, if asked for, ``ids`` of every document, from the files' bytes.

    ``ids`` are little-endian unsigned 32-bit integers, ``ids_crc32`` their checksum, ``start`` the ids of all documents before.
    """
    files = spark.read.parquet(folder)
    doc_id = files.schema["doc_ids"].dataType.elementType
    out = StructType([StructField("shard", files.schema["shard"].dataType), StructField("doc_id", doc_id)])
    out = out.add("_at", LongType()).add("n_tokens", LongType()).add("ids_crc32", LongType())
    out = out.add("ids", BinaryType()) if with_ids else out
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in (batch.slice(k, 1).to_pylist()[0] for k in range(batch.num_rows)):
                data = memoryview(IdFile(r["data"]).ids()).cast("B")
                starts = [0, *r["ends"]]
                cut = [data[4 * a : 4 * b] for a, b in zip(starts, r["ends"], strict=False)]
                columns = [
                    [r["shard"]] * len(cut),
                    r["doc_ids"],
                    [r["first"] + a for a in starts[:-1]],
                    [len(x) // 4 for x in cut],
                    [zlib.crc32(x) for x in cut],
                    *([map(bytes, cut)] if with_ids else []),
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    found = files.select("shard", "first", "doc_ids", "ends", "data").mapInArrow(run, out)
    return found.join(_bases(files), "shard").select(
        "doc_id", (F.col("base") + F.col("_at")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if with_ids else [])
    )


def token_files(docs: DataFrame, folder: str | None = None, with_ids: bool = True, **options) -> DataFrame:
    """Write the files of ``docs`` (to a fresh shared folder by default) and read them back as :func:`read_token_files` does."""
    folder = folder or shared_dir(docs.sparkSession, "token-files")
    write_token_files(docs, folder, **options)
    return read_token_files(docs.sparkSession, folder, with_ids)
