"""The staging folder drained as Structured Streaming micro-batches."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from loomsync.operators.loads import LayeredTable
from loomsync.plans import sync

_KEYS = {
    "members": ["member_id"],
    "addresses": ["member_id", "addr_id"],
    "phones": ["member_id", "phn_id"],
    "census": ["pid"],
}
COMPACT_AFTER = 64


class Processed:
    """The processed rows, one folder per micro-batch and no list of them: a batch's folder tells that it is done."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root

    def holds(self, batch_id: int) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/batch={batch_id}/_SUCCESS")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def add(self, rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.root}/batch={batch_id}")

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.root).drop("batch")


def state_tables(spark: SparkSession, root: str) -> dict[str, LayeredTable]:
    return {name: LayeredTable(spark, f"{root}/{name}", keys) for name, keys in _KEYS.items()}


def run_stream(
    spark: SparkSession,
    staging: str,
    root: str,
    initial: sync.State,
    references: Mapping[str, DataFrame],
    options: sync.Options = sync.Options(),
    *,
    max_files: int = 1000,
    compact_after: int = COMPACT_AFTER,
) -> DataFrame:
    """Process every file waiting in ``staging`` and return the processed rows so far.

    Each micro-batch is one sync run and writes only the rows it changes, as a
    layer numbered by the batch. A replayed batch reads the layers below its own
    number and finds its own layers in place, so it changes nothing; the
    checkpoint is the bookmark.
    """
    if options.max_records:
        raise ValueError("a stream has no cap on records: max_records belongs to a single run")
    tables = state_tables(spark, root)
    done = Processed(spark, f"{root}/processed")
    for name, table in tables.items():
        start = getattr(initial, name)
        if start is not None and not table.exists():
            table.base.write(start, "initial")

    def apply(batch: DataFrame, batch_id: int) -> None:
        if done.holds(batch_id):
            return
        for table in tables.values():
            if table.exists() and table.depth() >= compact_after:
                table.compact(batch_id)
        # A file may hold one row group, and a single task would hash, check and combine all of its rows.
        batch = batch.repartition("mq_id")
        before = sync.State(**{n: tb.read(batch_id) if tb.exists() else None for n, tb in tables.items()})
        outcome = sync.sync_batch(batch, before, references, options)
        if outcome is None:
            return
        changes = sync.touched_rows(before, outcome.rows, options.block_census)
        for name, table in tables.items():
            rows = getattr(changes, name)
            if rows is not None:
                table.add(rows, batch_id)
        done.add(outcome.rows, batch_id)

    schema = spark.read.parquet(staging).schema
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(staging)
    query = (
        source.writeStream.foreachBatch(apply)
        .option("checkpointLocation", f"{root}/_bookmark")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return done.read()
