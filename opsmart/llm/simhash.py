"""SimHash near-duplicates, found through an inverted index of positional bytes.

A fingerprint has eight positional bytes. Two fingerprints that differ in two bits or fewer
share at least six of them. Lists for single bytes would hold a 256th of all fingerprints each
and meet in a number of pairs that grows with the square of the input, so a
posting is keyed by four positional bytes: the eight bytes form four groups of two, at least two
groups are untouched by two bit flips, and each of the six pairs of groups has its own lists.
A pair that meets in a list is counted once (under the first list that both are in), its shared
positional bytes are tallied, pairs below six are dropped, and the rest is verified bit by bit.

Lists longer than ``long_list`` are not paired. Within such a list four bytes are equal,
and two members differ in two of the other 32 bits at most exactly if some value lies within one
bit of both. So each member stands for itself and its 32 one-bit neighbours, and members are
linked to the smallest member that shares a value with them. That is linear in the list, and
it yields true links only, enough of them to connect all that are linked.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from opsmart.llm.common import map_texts
from opsmart.llm.components import connected_components
from opsmart.session import materialise

SEED = 42
#: Positional bytes that fingerprints at two bits' distance share at least.
SHARED_BYTES = 6
MAX_BITS = 2
#: The pairs of two-byte groups that are indexed.
_LISTS = list(combinations(range(4), 2))
_SHINGLES_AT_ONCE = 1 << 16


def fingerprint(text: str | None, words_in_shingle: int = 3) -> int:
    """Unsigned 64-bit fingerprint; zero for a text without words.

    ``bytes.lower`` and ``bytes.split`` know ASCII letters and ASCII white space only.
    """
    words = (text or "").encode().lower().split()
    n = len(words) - words_in_shingle + 1
    if not words:
        return 0
    joined = b" ".join(words)
    if n <= 1:
        return xxhash.xxh64_intdigest(joined, SEED)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[:n].tolist()
    ends = ends[words_in_shingle - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for k in range(0, n, _SHINGLES_AT_ONCE):
        some = zip(starts[k : k + _SHINGLES_AT_ONCE], ends[k : k + _SHINGLES_AT_ONCE], strict=True)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in some], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, fp`` (both as signed longs) for every row."""

    def worker():
        def score(texts: list) -> dict:
            own = [xxhash.xxh64_intdigest(t.encode(), SEED) if t is not None else SEED for t in texts]
            return {
                "text_hash": np.array(own, np.uint64).view(np.int64),
                "fp": np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64),
            }

        return score

    return map_texts(docs, worker, [StructField("text_hash", LongType()), StructField("fp", LongType())])


def _group(fp: Column, k: int) -> Column:
    return F.shiftrightunsigned(fp, 16 * k).bitwiseAND(F.lit(0xFFFF))


def _postings(fps: DataFrame) -> DataFrame:
    """One row for each of the six lists that a fingerprint stands in."""
    entries = F.array(
        *[
            F.struct(F.lit(i).alias("list"), F.shiftleft(_group(F.col("fp"), a), 16).bitwiseOR(_group(F.col("fp"), b)).alias("key"))
            for i, (a, b) in enumerate(_LISTS)
        ]
    )
    return fps.select("fp", F.explode(entries).alias("e")).select("fp", "e.list", "e.key")


def _first_list(diff: Column) -> Column:
    """The first list that two fingerprints with this exclusive or share."""
    found = F.lit(None).cast("int")
    for i, (a, b) in reversed(list(enumerate(_LISTS))):
        found = F.when((_group(diff, a) == 0) & (_group(diff, b) == 0), F.lit(i)).otherwise(found)
    return found


def _shared_bytes(diff: Column) -> Column:
    tally = F.lit(0)
    for k in range(8):
        tally = tally + (F.shiftrightunsigned(diff, 8 * k).bitwiseAND(F.lit(0xFF)) == 0).cast("int")
    return tally


def _free_flips() -> Column:
    """For each list, zero and the 32 one-bit changes that leave its four bytes alone."""

    def signed(bit: int) -> int:
        return (1 << bit) - (1 << 64 if bit == 63 else 0)

    rows = [
        [0] + [signed(16 * g + bit) for g in range(4) if g not in pair for bit in range(16)]
        for pair in _LISTS
    ]
    return F.array(*[F.array(*[F.lit(x).cast("long") for x in row]) for row in rows])


def links(fps: DataFrame, long_list: int = 32) -> DataFrame:
    """``a, b``: links that connect exactly the fingerprints reachable from each other."""
    postings = materialise(_postings(fps), "postings")
    # Written, so that adaptive execution can split a long list in the joins below.
    long = materialise(postings.groupBy("list", "key").count().where(F.col("count") > long_list).select("list", "key"), "long-lists")
    short_lists = postings.join(long, ["list", "key"], "left_anti")
    other = short_lists.select(F.col("fp").alias("b"), "list", "key")
    diff = F.col("a").bitwiseXOR(F.col("b"))
    pairs = (
        short_lists.withColumnRenamed("fp", "a")
        .join(other, ["list", "key"])
        .where("a < b")
        .where(_first_list(diff) == F.col("list"))
        .where(_shared_bytes(diff) >= SHARED_BYTES)
        .where(F.bit_count(diff) <= MAX_BITS)
        .select("a", "b")
    )
    near = (
        postings.join(long, ["list", "key"], "left_semi")
        .select("fp", "list", F.explode(F.element_at(_free_flips(), F.col("list") + 1)).alias("flip"))
        .select("fp", "list", F.col("fp").bitwiseXOR(F.col("flip")).alias("value"))
    )
    smallest = near.groupBy("list", "value").agg(F.min("fp").alias("b"), F.count("*").alias("n")).where("n > 1").drop("n")
    stars = near.join(smallest, ["list", "value"]).where("fp <> b").select(F.col("fp").alias("a"), "b")
    return pairs.unionByName(stars)


def near_duplicates(docs: DataFrame, long_list: int = 32) -> DataFrame:
    """``doc_id, text_hash, fp, root, component_id`` for every row of ``docs``.

    ``root`` names the component (its smallest fingerprint), ``component_id`` is the smallest
    ``doc_id`` in it. A text that is null or has no words has fingerprint zero and is
    linked like any other. Rows without ``doc_id`` take part, but a component of such
    rows only has a null id. Repeated rows are copies of each other. An empty table
    gives an empty result. Other columns of ``docs`` are not read.
    """
    rows = materialise(fingerprints(docs), "fingerprints")
    per_fp = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = connected_components(links(per_fp.select("fp"), long_list))
    named = per_fp.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    named = materialise(named, "roots")
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.join(named.join(ids, "root").select("fp", "root", "component_id"), "fp").select(
        "doc_id", "text_hash", "fp", "root", "component_id"
    )


def near_duplicate_components(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint, component_id`` as :func:`near_duplicates` finds them."""
    return near_duplicates(docs).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, less all but one row of each component.

    The row that stays has the smallest ``doc_id`` (then the smallest text hash; a null id comes last);
    of rows with equal id and text one stays.
    """
    found = near_duplicates(docs)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    kept = found.groupBy("root").agg(F.min(order).alias("k")).select(
        F.col("k.doc_id").alias("_id"), F.col("k.text_hash").alias("_hash")
    )
    same = docs["doc_id"].eqNullSafe(kept["_id"]) & (F.xxhash64(docs["text"]) == kept["_hash"])
    return docs.join(kept, same, "left_semi").dropDuplicates(["doc_id", "text"])
