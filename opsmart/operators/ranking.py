"""Sequence numbers inside a group, without sorting a hot group in one task.

``row_number() over (partition by key order by a, b)`` sends all rows of a key
to one task. Here the rows are range-partitioned by key and order, so a large key
lies in several neighbouring partitions, each with a stretch of its order. Rows
are numbered inside their partition, and each (key, partition) gets the number of
the key's rows in the partitions before it, which is a sum over one row for every
partition that the key reaches. There is one way for all keys, large and small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from opsmart.session import materialise_by


def materialise(df: DataFrame, purpose: str) -> DataFrame:
    return materialise_by(df, purpose, "_part")


def sequence_in_group(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, start: int = 1) -> DataFrame:
    """Add ``name``: the position of the row in its key, in ``order``.

    Equal to ``row_number()`` over the same order, minus ``1 - start``; the order
    should be unique inside the key. The ranges are sampled, so the partitioned
    rows are written to the shared folder and read from there for the count and
    for the numbers: the input itself is computed once. The table is bucketed by the partition, so rows are counted and numbered
    where they lie: they are shuffled once in all, with their own columns only. Of the
    keys in a partition only the first can have begun in an earlier one, so the counts that are added are one row a
    partition at most, and are broadcast.
    """
    by = [*keys, *order]
    ranged = materialise(df.repartitionByRange(*by).withColumn("_part", F.spark_partition_id()), "sequence")
    key = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)])  # in a struct a NULL equals a NULL
    counts = ranged.groupBy(key.alias("_key"), "_part").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("_key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("_key", F.col("_part").alias("_at"), F.sum("_n").over(earlier).alias("_before")).where("_before > 0")
    numbered = ranged.withColumn("_local", F.row_number().over(Window.partitionBy("_part", *keys).orderBy(*order)))
    numbered = numbered.join(F.broadcast(before), (F.col("_part") == F.col("_at")) & (key == F.col("_key")), "left")
    position = (F.coalesce("_before", F.lit(0)) + F.col("_local") - 1 + start).cast("bigint")
    return numbered.withColumn(name, position).drop("_key", "_part", "_at", "_local", "_before")
