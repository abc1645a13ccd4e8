"""Gap-free numbering and exact rank selection without a single-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomsync.session import staged

_SLOT_BITS = 33


def number_rows(df: DataFrame, order_by: list[str], name: str, start: int = 1) -> DataFrame:
    """Number rows start, start + 1, ... in the order of ``order_by``.

    ``order_by`` must be a total order, so that a value shared by many rows is
    still spread over range partitions. Rows are range-partitioned and sorted
    once, then written; positions inside a partition come from that written
    copy, and only one count per partition is summed up.
    """
    slot = f"_{name}_slot"
    ordered = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    written = staged(ordered.withColumn(slot, F.monotonically_increasing_id()), "numbered")
    part = F.shiftright(F.col(slot), _SLOT_BITS)
    sizes = written.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    position = F.col(slot).bitwiseAND(F.lit((1 << _SLOT_BITS) - 1))
    # One row per partition of the staged copy, so this side cannot grow with the data.
    return (
        written.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, (position + F.col("_offset") + F.lit(start)).cast("bigint"))
        .drop("_part", "_offset", slot)
    )


def chunk_by_count(df: DataFrame, order_by: list[str], size: int, name: str = "chunk") -> DataFrame:
    """Chunk number of every row, ``size`` rows to a chunk, the last one short."""
    numbered = number_rows(df, order_by, "_row", start=0)
    return numbered.withColumn(name, F.expr(f"_row div {int(size)}")).drop("_row")


def nth_smallest(df: DataFrame, column: str, n: int, buckets: int = 1024) -> int | None:
    """The n-th smallest integer of a column, the largest if there are fewer.

    Counts per bucket narrow the range until one value is left. Every pass
    brings at most ``buckets`` counts to the driver and shuffles no rows.
    """
    low, high, rows = df.agg(F.min(column), F.max(column), F.count(column)).first()
    if not rows:
        return None
    if n >= rows:
        return high
    while low < high:
        width = -(-(high - low + 1) // buckets)
        counts = (
            df.filter(F.col(column).between(low, high))
            .groupBy(F.expr(f"({column} - {low}) div {width}").alias("bucket"))
            .count()
            .collect()
        )
        for bucket, count in sorted((r["bucket"], r["count"]) for r in counts):
            if n <= count:
                low, high = low + bucket * width, min(high, low + (bucket + 1) * width - 1)
                break
            n -= count
    return low
