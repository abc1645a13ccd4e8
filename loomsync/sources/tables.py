"""Reading tables: projection, filters, counts and the change-window reads."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def scan(table: DataFrame, columns: list[str] | None = None, binds: Mapping[str, Any] | None = None) -> DataFrame:
    """Chosen columns of the rows equal to every bind; a NULL bind matches nothing.

    Filters come first, so a bind may name a column that is not selected and
    both reach the file scan.
    """
    if binds:
        table = table.filter(reduce(Column.__and__, [F.col(k) == F.lit(v) for k, v in binds.items()]))
    return table.select(*columns) if columns else table


def sql_query(
    spark: SparkSession, statement: str, tables: Mapping[str, DataFrame], binds: Mapping[str, Any] | None = None
) -> DataFrame:
    """Ad-hoc statement with ``:name`` binds over tables named in braces."""
    return spark.sql(statement, args=dict(binds or {}), **tables)


def row_count(table: DataFrame) -> DataFrame:
    return table.agg(F.count("*").alias("rows"))


def null_counts(table: DataFrame) -> DataFrame:
    """Rows where each column is NULL, all columns in one pass."""
    counted = table.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in table.columns])
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("null_rows")) for c in table.columns]
    )
    return counted.select(F.inline(pairs))


def live_rows(table: DataFrame, deleted: str, include_deleted: bool = False) -> DataFrame:
    return table if include_deleted else table.filter(F.col(deleted).isNull() | ~F.col(deleted))


def changed_between(table: DataFrame, stamp: str, start: str, end: str, deleted: str | None = None) -> DataFrame:
    """Rows changed in [start, end]; with ``deleted`` only those removed in it."""
    kind = dict(table.dtypes)[stamp]
    window = table.filter(F.col(stamp).between(F.lit(start).cast(kind), F.lit(end).cast(kind)))
    return window.filter(F.col(deleted)) if deleted else window


def get_by_key(table: DataFrame, column: str, value: Any) -> DataFrame:
    return table.filter(F.col(column) == F.lit(value))


def _one_line_base64(body: Column) -> Column:
    # The built-in breaks lines every 76 characters.
    return F.replace(F.base64(body), F.lit("\r\n"), F.lit(""))


def to_base64(table: DataFrame, column: str, name: str) -> DataFrame:
    return table.withColumn(name, _one_line_base64(F.col(column).cast("binary")))


def from_base64(table: DataFrame, column: str, name: str) -> DataFrame:
    return table.withColumn(name, F.unbase64(F.col(column)))


def binary_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Files of a folder with their body as base64 text."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    return files.select("path", "length", _one_line_base64(F.col("content")).alias("body"))


def parquet_export(rows: DataFrame, path: str, batch_rows: int = 50_000, mode: str = "error") -> None:
    """Write a result as Parquet files of at most ``batch_rows`` rows."""
    rows.write.mode(mode).option("maxRecordsPerFile", batch_rows).parquet(path)


def arrow_batches(rows: DataFrame, handle: Callable[[Iterator], Iterator], schema) -> DataFrame:
    """Hand the rows to ``handle`` as Arrow batches, inside the tasks."""
    return rows.mapInArrow(handle, schema)
