"""Scans of curated tables and raw CSV drops."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet scan. With a schema no file footer is read to infer one, and a
    column missing from old files comes back as NULL."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_drop(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> DataFrame:
    """CSV drops with lineage: ``_file`` and ``_modified`` come from the file
    itself; ``_line`` must be a column of the drop, since a split file has no
    line numbers. Malformed cells become NULL."""
    raw = spark.read.schema(schema).option("header", header).option("mode", "PERMISSIVE").csv(path)
    lineage = {}
    if "_file" not in raw.columns:
        lineage["_file"] = F.col("_metadata.file_name")
    if "_modified" not in raw.columns:
        lineage["_modified"] = F.col("_metadata.file_modification_time")
    return raw.withColumns(lineage) if lineage else raw


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Project ``{raw: curated}`` in that order; everything else is pruned."""
    return df.select(*[F.col(raw).alias(new) for raw, new in names.items()])


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Align to a curated schema: cast leniently, order, add missing columns as NULL."""

    def column(field: T.StructField) -> Column:
        if field.name not in df.columns:
            return F.lit(None).cast(field.dataType).alias(field.name)
        source = df.schema[field.name].dataType
        value = F.col(field.name)
        if source != field.dataType:
            value = value.try_cast(field.dataType)
        return value.alias(field.name)

    return df.select(*[column(f) for f in schema.fields])


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty table of the given schema (the start of an incremental load)."""
    return spark.createDataFrame([], schema)
