"""What the operators of this package share: session settings, inputs, row batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, StructField, StructType

from loomsync.operators.numbering import number_rows
from loomsync.session import configure

#: Rows per batch that Spark hands to Python; bounds a task's memory for long texts.
BATCH_ROWS = 1000


def prepare(spark: SparkSession) -> SparkSession:
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """The whole table ``table`` of ``folder``."""
    return prepare(spark).read.parquet(f"{folder}/{table}.parquet")


def extended(schema: StructType, **columns: str) -> StructType:
    """``schema`` with more columns of the given types."""
    added = StructType.fromDDL(", ".join(f"`{n}` {kind}" for n, kind in columns.items()))
    return StructType([*schema.fields, *added.fields])


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], dict | None], schema: str | StructType) -> DataFrame:
    """Apply ``fn`` to each batch; it returns the columns of the output by name, in any order."""
    spark_schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    names = spark_schema.names
    arrow_schema = to_arrow_schema(spark_schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (made := fn(batch)) is not None:
                columns = [pa.array(made[n], arrow_schema.field(n).type) if not isinstance(made[n], pa.Array) else made[n] for n in names]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow_schema)

    return df.mapInArrow(run, spark_schema)


def with_row_keys(df: DataFrame, name: str, key: str) -> DataFrame:
    """``df`` with a row number ``key`` in the order of the id ``name`` (null: last), unique where ids repeat or are null."""
    kept = df.withColumn("_none", F.col(name).isNull())
    return number_rows(kept, ["_none", name], key, 0).drop("_none")


def with_ids(found: DataFrame, keys: DataFrame, name: str, key: str, *columns: str) -> DataFrame:
    """``found`` with the row keys in ``columns`` turned back into ids."""
    for column in columns:
        ids = keys.select(F.col(key).alias(column), F.col(name).alias("_id"))
        found = found.join(ids, column).select(*[F.col("_id").alias(c) if c == column else F.col(c) for c in found.columns])
    return found


def squeezed(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the bytes of ``text`` compressed one by one, for texts that are to be shuffled; null stays null."""
    names = df.columns

    def run(batch: pa.RecordBatch) -> dict:
        press = zstandard.ZstdCompressor(3)
        values = [None if v is None else press.compress(v if isinstance(v, bytes) else v.encode()) for v in batch.column(text).to_pylist()]
        return {n: batch.column(n) for n in names} | {text: values}

    schema = StructType([StructField(f.name, BinaryType()) if f.name == text else f for f in df.schema.fields])
    return map_batches(df, run, schema)
