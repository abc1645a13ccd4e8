"""Shards of near equal bytes: a minimax contiguous partition of ordered atomic groups.

The atomic groups are the hash cells of the texts, so equal texts stay together. Their sizes,
in the order of the cells, are cut into contiguous shards whose largest is as small as can be:
the smallest feasible capacity is found by binary search, each try checked greedily.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomsync.session import staged

#: Hash cells of texts. The driver gets one size per cell at most, whatever the table holds.
CELLS = 1 << 18
#: Parts of a shard that are numbered apart, by a hash of the row.
STRIPES = 256
OVERHEAD = 16


def _reach(sums: np.ndarray, capacity: int, shards: int) -> list[int]:
    """Ends of the shards that a greedy pass fills up to ``capacity``."""
    ends, at = [], 0
    for _ in range(shards):
        at = int(np.searchsorted(sums, (sums[at - 1] if at else 0) + capacity, side="right"))
        ends.append(at)
    return ends


def minimax_cuts(sizes: np.ndarray, shards: int) -> list[int]:
    """Ends of ``shards`` contiguous runs of ``sizes`` whose largest sum is smallest."""
    sums = np.cumsum(sizes, dtype=np.int64)
    if not len(sums):
        return [0] * shards
    low, high = max(int(np.max(sizes)), -(-int(sums[-1]) // shards)), int(sums[-1])
    while low < high:
        middle = (low + high) // 2
        if _reach(sums, middle, shards)[-1] == len(sums):
            high = middle
        else:
            low = middle + 1
    return _levelled(sums, low, shards)


def _levelled(sums: np.ndarray, capacity: int, shards: int) -> list[int]:
    """Ends of shards within ``capacity``, each as near as it can be to the mean of what is left for it and the later ones."""
    total = int(sums[-1])
    before = np.concatenate(([0], sums))
    # Least place from which the rest fits into the later shards, filled from the right.
    least = [len(sums)]
    for _ in range(shards - 1):
        least.append(int(np.searchsorted(before, before[least[-1]] - capacity, side="left")))
    ends, at = [], 0
    for later in range(shards - 1, -1, -1):
        done = int(before[at])
        low = max(at, least[later])
        high = int(np.searchsorted(sums, done + capacity, side="right"))
        mean = done + (total - done) / (later + 1)
        near = int(np.searchsorted(before, mean))
        if near and mean - before[near - 1] <= before[min(near, len(sums))] - mean:
            near -= 1
        at = min(max(near, low), high)
        ends.append(at)
    return ends


def shard_by_bytes(docs: DataFrame, shards: int, doc_id: str = "doc_id", text: str = "text", cells: int = CELLS) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every row.

    Size is the UTF-8 length plus 16; a null text counts as none and is grouped with the empty
    ones. Equal texts share a shard. Slots are gapless from 0 in each shard, in the order of
    stripes and then of ``doc_id``. Fewer groups than shards leave shards empty, as does an
    empty table.
    """
    spark = docs.sparkSession
    data = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.select(F.col(doc_id).alias("doc_id"), data.alias("data")).select(
        "doc_id",
        (F.length("data") + OVERHEAD).cast("long").alias("size"),
        F.crc32("data").alias("text_crc32"),
        F.pmod(F.xxhash64("data"), F.lit(cells)).alias("cell"),
    )
    rows = staged(rows, "sizes")
    sums = rows.groupBy("cell").agg(F.sum("size").alias("size"))
    found = sums.toArrow()
    order = np.argsort(found["cell"].to_numpy())
    names, sizes = found["cell"].to_numpy()[order], found["size"].to_numpy()[order]
    ends = minimax_cuts(sizes, shards)
    # Shard of a cell: the number of shards that end at or before it.
    bounds = [int(names[e]) if e < len(names) else cells for e in ends[:-1]]
    shard = F.lit(0)
    for b in bounds:
        shard = shard + (F.col("cell") >= b).cast("int")
    placed = rows.select("*", shard.alias("shard"), F.pmod(F.xxhash64("doc_id", "size", "text_crc32"), F.lit(STRIPES)).cast("int").alias("stripe"))
    counts = {(r[0], r[1]): r[2] for r in placed.groupBy("shard", "stripe").count().collect()}
    offsets, at = [], {}
    for (s, t), n in sorted(counts.items()):
        offsets.append((s, t, at.get(s, 0)))
        at[s] = at.get(s, 0) + n
    offset = F.broadcast(spark.createDataFrame(offsets, "shard int, stripe int, first long"))
    numbered = placed.withColumn("nth", F.expr("row_number() OVER (PARTITION BY shard, stripe ORDER BY doc_id, size, text_crc32)"))
    return numbered.join(offset, ["shard", "stripe"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("first") + F.col("nth") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
