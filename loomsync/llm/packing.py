"""Packing of documents into training sequences by the sum-of-squares rule.

A piece goes where the sum over all gaps of the squared number of open sequences with that
gap becomes smallest: into an open sequence with some gap, or into a new one. Longer pieces
go first within a shard, so short ones close what is left. Pieces of full length are
sequences of their own. Shards are drawn at random and large, so that the sequences that
stay open at their ends are few beside the closed ones.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomsync.llm.common import extended, map_batches
from loomsync.llm.tokens import Added, _texts, known_pieces
from loomsync.session import staged

LIMIT = 2048
#: Pieces per shard.
SHARD = 40_000

_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


class SumOfSquares:
    """Open sequences by gap; ``place`` gives the sequence and the offset of a piece."""

    def __init__(self, limit: int) -> None:
        self.limit = limit
        self.open: list[list[int]] = [[] for _ in range(limit + 1)]
        self.count = np.zeros(limit + 1, np.int64)
        self.made = 0

    def place(self, length: int) -> tuple[int, int]:
        gaps = self.count[length:]
        # Moving a sequence from gap g to gap g - length changes the sum by 2(N[g - length] - N[g]) + 2;
        # a closed sequence counts for nothing, and a new one leaves no gap behind.
        change = 2 * self.count[: len(gaps)] - 2 * gaps + 2
        change[0] = -2 * gaps[0] + 1
        change[gaps == 0] = np.iinfo(np.int64).max
        change[-1] = 2 * self.count[self.limit - length] + 1 if length < self.limit else 0
        gap = length + int(np.argmin(change))
        if gap == self.limit:
            sequence = self.made
            self.made += 1
        else:
            sequence = self.open[gap].pop()
            self.count[gap] -= 1
        if gap > length:
            self.open[gap - length].append(sequence)
            self.count[gap - length] += 1
        return sequence, self.limit - gap


def token_pieces(
    docs: DataFrame, ranks_path: str, pattern: str, doc_id: str = "doc_id", text: str = "text", limit: int = LIMIT, end: int = 0, added: Added = ()
) -> DataFrame:
    """Pieces of at most ``limit`` tokens of each document, which ends with the id ``end``.

    Only longer documents are cut; their first piece takes what full pieces leave. A null or
    empty text is the one id ``end``. ``added`` tokens are read where their text stands. Gives ``doc_id, piece, start, length, ids_crc32``.
    """
    last = np.array([end], "<u4").tobytes()

    def run(batch: pa.RecordBatch) -> dict:
        made: dict = {n: [] for n in ("doc_id", "piece", "start", "length", "ids_crc32")}
        pieces = known_pieces(ranks_path, pattern, False, added)
        for name, whole in zip(batch.column(doc_id).to_pylist(), _texts(batch.column(text)), strict=True):
            ids = b"".join(pieces.values(whole)) + last
            total = len(ids) // 4
            edges = [0, *range(total % limit or limit, total + 1, limit)] if total > limit else [0, total]
            for i, (a, b) in enumerate(zip(edges, edges[1:])):
                for n, v in (("doc_id", name), ("piece", i), ("start", a), ("length", b - a), ("ids_crc32", zlib.crc32(ids[4 * a : 4 * b]))):
                    made[n].append(v)
        return made

    return map_batches(docs.select(doc_id, text), run, _PIECE)


def pack(pieces: DataFrame, limit: int = LIMIT, shard: int = SHARD) -> DataFrame:
    """``pieces`` (with ``doc_id``, ``piece`` and ``length`` in 1 to ``limit``) with ``sequence_id`` and ``offset``.

    Equal rows are packed each for itself; a null ``doc_id`` is a value like any other. An
    empty table gives no rows.
    """
    pieces = staged(pieces.drop("sequence_id", "offset"), "pieces")
    names = pieces.columns
    shards = max(1, round(pieces.where(F.col("length") < limit).count() / shard))
    # Full pieces are sequences of their own wherever they lie; the others are dealt evenly.
    mark = "_shard"
    while mark in names:
        mark += "_"
    dealt = pieces.withColumn(mark, F.pmod(F.xxhash64(*names), F.lit(shards)).cast("int"))
    dealt = dealt.repartition(shards, mark).sortWithinPartitions(mark, F.desc("length"), *[n for n in names if n != "length"])
    schema = extended(pieces.schema, sequence_id="long", offset="long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packers: dict[int, SumOfSquares] = {}
        for batch in batches:
            sequence, offset = [], []
            for at, length in zip(batch.column(mark).to_pylist(), batch.column("length").to_pylist(), strict=True):
                if at not in packers:
                    packers = {at: SumOfSquares(limit)}
                made, place = packers[at].place(length)
                sequence.append(made * shards + at)
                offset.append(place)
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())], [*names, "sequence_id", "offset"])

    return dealt.mapInArrow(run, schema)
