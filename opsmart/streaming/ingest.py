"""File drops as streams.

``ingest_drops`` and ``dedupe_into`` are exact for late data: they look ids up in
the stored table, which is their only state. ``daily_event_counts`` keeps
windows in Spark's state; ``run_to_days`` runs it in update mode, in which a batch brings the figures of
the days it touched, and only those days are written. Without a watermark nothing is ever too late; the
state then holds one row for each day and event, as the result does.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from opsmart.sources.store import TableStore


def file_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                files_per_trigger: int | None = None) -> DataFrame:
    """Stream of files; ``path`` may be a folder or a glob."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def ingest_drops(stream: DataFrame, parse: Callable[[DataFrame], DataFrame], store: TableStore, table: str,
                 checkpoint: str, key: str = "_row_id", latest: str = "flip_if_new",
                 order: str | None = None) -> StreamingQuery:
    """Run all waiting drops through ``parse`` and the incremental load.

    Exactly once: a batch replayed after a failure finds its row ids already in
    the table. Rows repeated inside one batch are cut to one by the load.
    """

    def load(batch: DataFrame, _: int) -> None:
        store.load(table, parse(batch), key, latest, order)

    return (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _event_time(stream: DataFrame, ts: str, delay: str) -> DataFrame:
    # a watermark needs a zoned time stamp
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def dedupe_into(stream: DataFrame, key: str, store: TableStore, table: str, checkpoint: str) -> StreamingQuery:
    """Append the first delivery of every ``key`` to ``table``, however late it comes.

    Repeats inside a batch are cut to one row, repeats across batches are found in
    the table, where only the ids of the batch are looked up. A batch that is replayed after a
    failure finds its own rows there. Rows without a key are kept as they are.
    """

    def load(batch: DataFrame, _: int) -> None:
        store.load(table, batch, key, "keep")

    return (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def daily_event_counts(stream: DataFrame, ts: str, event: str, delay: str | None, values: dict[str, Column] | None = None) -> DataFrame:
    """Tumbling one-day windows per event: row count, plus sums of ``values``.
    Windows are UTC days, so run this in a UTC session. Rows more than ``delay`` late are left out;
    None keeps all."""
    sums = [F.sum(v).alias(n) for n, v in (values or {}).items()]
    timed = _event_time(stream, ts, delay) if delay else stream.withColumn(ts, F.col(ts).cast("timestamp"))
    return (
        timed.groupBy(F.window(ts, "1 day").alias("_w"), event)
        .agg(F.count(F.lit(1)).alias("event_count"), *sums)
        .withColumn("date", F.col("_w.start").cast("date"))
        .drop("_w")
    )


def run_to_folder(result: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Process what is waiting in append mode, write it to ``path``, and read
    that back. A window is written once the watermark has closed it."""
    query = (
        result.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return result.sparkSession.read.schema(result.schema).parquet(path)


def run_to_days(result: DataFrame, store: TableStore, table: str, checkpoint: str, event: str) -> DataFrame:
    """Process what is waiting in update mode: each batch puts the figures of the days it touched in the place
    of the stored ones, open windows included, and leaves the partitions of all other days alone."""
    query = (
        result.writeStream.outputMode("update")
        .foreachBatch(lambda batch, _: store.upsert(table, batch.persist(), "date", ["date", event]))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return store.spark.table(store.name(table))
