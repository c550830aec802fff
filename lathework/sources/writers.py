"""Sinks: Parquet with a declared schema, an upserted ledger, appended failures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of the schema, in its order and types; those that are missing are null."""
    return df.select(*((F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema))


def write_table(df: DataFrame, path: str, schema: T.StructType | None = None, *, files: int | None = None, by: tuple[str, ...] = ()) -> None:
    """Parquet, overwritten as a whole; an empty frame still writes its schema. ``files`` bounds the number of files."""
    out = conform(df, schema) if schema else df
    out = out.coalesce(files) if files else out
    out.write.mode("overwrite").partitionBy(*by).parquet(path)


def failures(rows: DataFrame, stage: str, ref: Column, error: str | Column, message: Column, *, retryable: bool) -> DataFrame:
    """Failure records of the rows: stage, input_ref, error_type, message, retryable."""
    kind = error if isinstance(error, Column) else F.lit(error)
    return rows.select(F.lit(stage).alias("stage"), ref.alias("input_ref"), kind.alias("error_type"), message.alias("message"), F.lit(retryable).alias("retryable"))


def append_failures(df: DataFrame, path: str) -> None:
    """Failures (stage, input_ref, error_type, message, retryable) with the time they are written, as text."""
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    df.withColumn("failed_at", now).write.mode("append").parquet(path)
