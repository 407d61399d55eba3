"""Compression of vectors to codes of four bytes: product quantisation over a trie of distinct parts.

Vectors are scaled to integers and cut into four parts. The distinct parts of a position, in lexicographic order, are the
leaves of a trie whose levels are the components of a part. Going through it depth first, a node holds the vector of distances
from its prefix to (the prefixes of) all entries of the codebook: that of its parent plus one square for each entry. So a
prefix that many parts share is measured once. At a leaf the vector holds the distances of the part, its argmin is the code, and the part
counts with the number of its rows in the sums that the entries move to.

On Spark, parts are counted first (with map-side sums, so a third of all rows with one vector is one row for each task), dealt out by hash,
sorted and written. A round goes over the sorted parts and sends the sums of each task, at most one row for each entry, to an
aggregate; 4 x 256 rows come back to the driver. The rows themselves are coded by tries over the parts of an Arrow batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsmart.session import materialise

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
#: Scaled components stay below this, so that squared distances of up to 4,096 components fit in a long.
LARGEST = 2**24
#: Leaves of the trie that are gone through together; bounds the memory for distance vectors.
_LEAVES = 2048


# ---- the trie ----------------------------------------------------------------


def nearest(parts: np.ndarray, entries: np.ndarray, leaves: int = _LEAVES) -> tuple[np.ndarray, np.ndarray]:
    """The nearest of ``entries`` to each of ``parts`` and its squared distance; ties go to the lower index.

    ``parts`` are in lexicographic order. The trie over them is never stored: a node of depth ``d`` begins where one of the first
    ``d`` components changes. Its subtrees are gone through from left to right, ``leaves`` of them at once, level by level.
    """
    n, width = parts.shape
    code, error = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for at in range(0, n, leaves):
        some = parts[at : at + leaves]
        new = np.zeros(len(some), bool)  # where a node of the current depth begins
        new[0] = True
        sums, parent = np.zeros((1, len(entries)), np.int64), np.zeros(len(some), np.int64)
        for d in range(width):
            new[1:] |= some[1:, d] != some[:-1, d]
            first = np.flatnonzero(new)
            values, which = np.unique(some[first, d], return_inverse=True)
            squares = (values[:, None] - entries[:, d]) ** 2
            sums = sums[parent[first]] + squares[which]
            parent = np.cumsum(new) - 1
        best = sums.argmin(axis=1)
        code[at : at + leaves], error[at : at + leaves] = best[parent], sums[np.arange(len(sums)), best][parent]
    return code, error


def _sorted_runs(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows in lexicographic order, and which of them each row is."""
    order = np.lexsort(parts.T[::-1])
    ranked = parts[order]
    new = np.ones(len(parts), bool)
    new[1:] = (ranked[1:] != ranked[:-1]).any(axis=1)
    place = np.empty(len(parts), np.int64)
    place[order] = np.cumsum(new) - 1
    return ranked[new], place


def _rows(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.int64).reshape(len(column), width)


# ---- on Spark ----------------------------------------------------------------


def _usable(embeddings: DataFrame) -> DataFrame:
    """``vec_id, label, x``: rows with a vector of finite components, as integers in a long array."""
    v = F.col("embedding")
    finite = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    wide = v.cast("array<double>")
    scaled = F.when(
        F.exists(wide, lambda x: F.abs(x) * SCALE >= LARGEST),
        F.raise_error(F.lit("a component is too large for squared distances that fit in a long")).cast("array<long>"),
    ).otherwise(F.transform(wide, lambda x: F.floor(x * F.lit(float(SCALE)))))
    return embeddings.where(finite).select("vec_id", "label", scaled.alias("x"))


def _padded(rows: DataFrame, width: int) -> DataFrame:
    """Vectors filled up with zeros to ``width``."""
    gap = F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("x"))
    return rows.withColumn("x", F.when(F.size("x") == width, F.col("x")).otherwise(F.concat("x", gap)))


def _round(parts: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after one round over the sorted, counted parts."""
    width = books[0].shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros(b.shape, object) for b in books]
        counts = [np.zeros(len(b), np.int64) for b in books]
        for batch in batches:
            position, weight = batch.column("position").to_numpy(), batch.column("n").to_numpy()
            values = _rows(batch.column("part"), width)
            for p in np.unique(position):
                mine = position == p
                code, _ = nearest(values[mine], books[p])
                total = np.zeros(books[p].shape, np.int64)
                np.add.at(total, code, values[mine] * weight[mine, None])
                sums[p] += total
                counts[p] += np.bincount(code, weight[mine], len(books[p])).astype(np.int64)
        for p in range(len(books)):
            used = np.flatnonzero(counts[p])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([p] * len(used), pa.int32()),
                    pa.array(used, pa.int32()),
                    pa.array(counts[p][used], pa.int64()),
                    pa.array([[int(v) for v in sums[p][e]] for e in used], pa.list_(pa.int64())),
                ],
                names=["position", "entry", "n", "total"],
            )

    found = parts.mapInArrow(run, "position int, entry int, n long, total array<long>")
    each = found.groupBy("position", "entry").agg(
        F.sum("n").alias("n"), *[F.sum(F.col("total")[k]).alias(f"t{k}") for k in range(width)]
    )
    moved = [b.copy() for b in books]
    for r in each.collect():  # a row for each entry at most
        moved[r["position"]][r["entry"]] = [r[f"t{k}"] // r["n"] for k in range(width)]
    return moved


def codebooks(rows: DataFrame, width: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[np.ndarray]:
    """A codebook for each position, trained on all of ``rows`` (padded, with at least one row)."""
    size = width // parts
    start = rows.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).select("x").collect()
    first = np.array([r["x"] for r in start], np.int64)
    books = [np.ascontiguousarray(first[:, p * size : (p + 1) * size]) for p in range(parts)]
    cut = F.array(*[F.slice("x", p * size + 1, size) for p in range(parts)])
    counted = rows.select(F.posexplode(cut).alias("position", "part")).groupBy("position", "part").agg(F.count("*").alias("n"))
    counted = materialise(counted.sortWithinPartitions("position", "part"), "parts")
    for _ in range(rounds):
        books = _round(counted, books)
    return books


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 over all components, by part, entry and position within the part."""
    return hashlib.sha256(",".join(str(v) for b in books for v in b.reshape(-1).tolist()).encode()).hexdigest()


def encode(rows: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """``vec_id, label, code, error`` for every row of ``rows`` (``vec_id, label, x``)."""
    size = books[0].shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = _rows(batch.column("x"), size * len(books))
            codes, errors = np.zeros((len(values), len(books)), np.uint8), np.zeros(len(values), np.int64)
            for p, book in enumerate(books):
                if len(values):
                    distinct, place = _sorted_runs(values[:, p * size : (p + 1) * size])
                    code, error = nearest(distinct, book)
                    codes[:, p] = code[place]
                    errors += error[place]
            text = pa.array([c.tobytes().hex() for c in codes], pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), text, pa.array(errors)], names=["vec_id", "label", "code", "error"]
            )

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.select("vec_id", "label", "x").mapInArrow(
        run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long"
    )


def decode(codes: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """``codes`` with a column ``vector``: the scaled integers that a code stands for."""
    tables = [F.array(*[F.array(*[F.lit(v) for v in e]) for e in b.tolist()]) for b in books]
    at = [F.conv(F.substring("code", 2 * p + 1, 2), 16, 10).cast("int") for p in range(len(books))]
    return codes.withColumn("vector", F.concat(*[F.element_at(t, k + 1) for t, k in zip(tables, at, strict=True)]))


def vector_codes(embeddings: DataFrame) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` for every row with a vector of finite components.

    Rows without a vector, or with a null or non-finite component, are dropped. Shorter vectors count as filled up with zeros, to
    the longest length rounded up to a multiple of four. A null id comes after all others in the choice of first entries; rows
    that share an id are ordered by their vectors, and repeated rows count as often as they are there. Null labels form one
    group. A component of 16,384 or more is an error, as distances would not fit in a long. An empty table gives an
    empty result. Other columns are not read.
    """
    rows = materialise(_usable(embeddings), "vectors")
    longest = rows.agg(F.max(F.size("x"))).first()[0]
    if longest is None:
        kind = rows.schema["vec_id"].dataType.simpleString()
        return embeddings.sparkSession.createDataFrame(
            [], f"vec_id {kind}, code string, error long, label_error long, codebooks_sha256 string"
        )
    width = max(PARTS, -(-longest // PARTS) * PARTS)
    full = _padded(rows, width)
    books = codebooks(full, width)
    coded = materialise(encode(full, books), "codes")
    by_label = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("_label"))).select(
        "vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")
    )


def _sql() -> str:
    """Four rounds spelled out; every part meets every entry, which is for small tables."""
    size = "len(x) // 4"
    nearest_of = """select position, part, arg_min(entry, (d, entry)) as entry, min(d) as d from (
        select p.position, p.part, b.entry, list_sum([(z[1] - z[2]) * (z[1] - z[2]) for z in list_zip(p.part, b.part)])::bigint as d
        from (select distinct position, part from parts) p join {0} b using (position)) group by 1, 2"""
    text = f"""
with kept as materialized (
    select row_number() over () as row, vec_id, label, [floor(1024 * c::double)::bigint for c in embedding] as x
    from embeddings where embedding is not null and len([c for c in embedding if c is null or not isfinite(c)]) = 0),
parts as materialized (
    select row, vec_id, label, i as position, x[i * ({size}) + 1 : (i + 1) * ({size})] as part from kept, range(4) t(i)),
b0 as materialized (
    select position, rank as entry, part from (
        select position, part, dense_rank() over (partition by position order by vec_id) - 1 as rank from parts) where rank < 256)"""
    for k in range(ROUNDS):
        text += f""",
a{k} as materialized ({nearest_of.format(f'b{k}')}),
s{k} as materialized (
    select position, entry, j, sum(part[j])::bigint as total, count(*) as n
    from parts join a{k} using (position, part), (select unnest(range(1, len(part) + 1)) as j from (select part from parts limit 1)) group by 1, 2, 3),
m{k} as materialized (select position, entry, list((total - ((total % n) + n) % n) // n order by j) as part from s{k} group by 1, 2),
b{k + 1} as materialized (
    select position, entry, coalesce(m.part, b.part) as part from b{k} b left join m{k} m using (position, entry))"""
    return text + f""",
a{ROUNDS} as materialized ({nearest_of.format(f'b{ROUNDS}')}),
c as (
    select row, vec_id, label, string_agg(lower(lpad(to_hex(a.entry), 2, '0')), '' order by position) as code, sum(a.d)::bigint as error
    from parts join a{ROUNDS} a using (position, part) group by 1, 2, 3),
h as (select sha256(string_agg(array_to_string(part, ','), ',' order by position, entry)) as codebooks_sha256 from b{ROUNDS})
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, codebooks_sha256 from c, h
"""


SQL = _sql()
