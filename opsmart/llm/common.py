"""Helpers shared by the text operators."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

#: Words as the license and benchmark operators count them: digits, letters a-z
#: (either case, before lower-casing) and everything above ASCII.
WORD_CLASS = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
#: What lies between two such words.
WORD_GAP = WORD_CLASS.replace("^", "")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file; every machine has the package installed."""
    import public_tokenizers

    return os.fspath(public_tokenizers.path(name))


def map_texts(docs: DataFrame, worker: Callable[[], Callable[[list], dict]], fields: list[StructField]) -> DataFrame:
    """``doc_id`` plus ``fields`` for every row of ``docs``, computed from its whole text.

    ``worker()`` runs once per task and returns a function from the texts of one
    Arrow batch to the lists of the output columns. Only ``doc_id`` and ``text``
    are read, so further columns of ``docs``, whatever their names, cannot clash.
    """
    rows = docs.select("doc_id", "text")
    out = StructType([rows.schema["doc_id"], *fields])
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = worker()
        for batch in batches:
            columns = score(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(arrow.field(0).type)]
                + [pa.array(columns[f.name], type=f.type) for f in list(arrow)[1:]],
                schema=arrow,
            )

    return rows.mapInArrow(run, out)


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def held_out(doc_id: Column) -> Column:
    """Rows that no label is learned from: crc32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, per_class: int, longest: int = 20_000
) -> list[tuple[object, str, int]]:
    """``(doc_id, text, label)`` of at most ``per_class`` labelled rows of each class, chosen by a hash of the id.

    Held-out rows, rows without a label or text, ids with contradictory labels and texts of more
    than ``longest`` characters are left out, so the sample has a size that does not depend on the input. The ids are
    drawn from the narrow label table first: the join with the documents has a side of
    at most ``2 * per_class`` rows. The order is fixed, so that a fit gives the same model every time.
    """
    one = (
        labels.where(~held_out(F.col("doc_id")) & F.col(label).isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min(label).alias("_low"), F.max(label).alias("_high"))
        .where("_low = _high AND _low IN (0, 1)")
        .select("doc_id", F.col("_low").alias("_label"), F.xxhash64("doc_id").alias("_draw"))
    )
    ids = None
    for value in (0, 1):
        part = one.where(F.col("_label") == value).orderBy("_draw", "doc_id").limit(per_class)
        ids = part if ids is None else ids.unionByName(part)
    rows = (
        docs.select("doc_id", "text")
        .where(F.length("text") <= longest)
        .join(F.broadcast(ids), "doc_id")
        .groupBy("_draw", "doc_id", "_label")
        .agg(F.min("text").alias("text"))
        .collect()
    )
    return [(r["doc_id"], r["text"], int(r["_label"])) for r in sorted(rows, key=lambda r: (r["_draw"], r["doc_id"]))]
