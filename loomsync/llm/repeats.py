"""Removal of long byte strings that occur more than once, by sharded suffix arrays.

Every start of a ``length``-byte window belongs to the anchor of its window: the place
whose next eight bytes have the smallest hash among the places at which ``ANCHOR`` bytes
still fit into the window. Equal windows have equal anchors, so the hash of the ``ANCHOR``
bytes there is a shard key under which all equal windows meet. Consecutive starts with one
key form a piece: the bytes of all their windows. A piece with one anchor whose key occurs
once holds no repeated window. A piece that occurs twice as a whole is repeated at every start. What is
left, different pieces with one key, goes in shards of whole keys to a suffix array built
by induced sorting; a start is repeated when it shares ``length`` bytes with a neighbour,
which the permuted common prefixes tell.

A key with more than ``hot`` different pieces (what surrounds a passage that very many
documents contain) is not put into one shard: each of its pieces is cut into runs of ``width``
starts by their distance to the anchor, and a run's key is the hash of the bytes that all its windows
share. Runs inside the passage are equal as a whole and so decided; runs that reach far out of it
have keys of their own; only those at its two edges still differ under one key, and are cut again into
narrower runs, at last into single windows, whose key is their content.

Equal texts are handled once, with a count. All windows, keys and counts cover all rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomsync.llm.common import extended, map_batches
from loomsync.llm.suffixes import permuted_lcp, suffix_array
from loomsync.session import staged

LENGTH = 400
ANCHOR = 64
#: Bytes of pieces in one suffix array, and of text cut at once.
SHARD_BYTES = 1 << 20
BLOCK_BYTES = 1 << 17
#: Different pieces of one key that one shard takes, and the starts in a run when larger keys are cut;
#: the first cut, 0, takes all starts of an anchor.
HOT = 500
WIDTHS = (0, 32, 4, 1)

_CUT = "uid binary, copies long, key array<long>, hash array<long>, start array<int>, count array<int>, spot array<int>"
_PIECE = "key long, hash long, copies long, spot int, piece binary"
_FOUND = "key long, hash long, runs array<struct<first:int,end:int>>"


def _window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each window of ``width`` values."""
    n = len(values)
    rows = -(-n // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    table = padded.reshape(rows, width)
    left = np.minimum.accumulate(table, axis=1).ravel()
    right = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - width + 1], left[width - 1 : n])


def _mix(words: np.ndarray, factor: int) -> np.ndarray:
    words = words * np.uint64(factor)
    return words ^ (words >> np.uint64(32))


def cut_pieces(texts: list[bytes], length: int, anchor: int, width: int = 0) -> list[list[np.ndarray]]:
    """Of each text, its pieces' keys, hashes, first starts, numbers of starts and anchor places.

    The place counts from the first start; it is -1 where several anchors share the key. With a
    ``width``, pieces are runs of at most so many starts of one anchor.
    """
    found: list[list[list[np.ndarray]]] = [[] for _ in texts]
    block: list[tuple[int, int, bytes]] = []
    size = 0
    for i, text in enumerate(texts):
        for at in range(0, max(1, len(text) - length + 1), BLOCK_BYTES):
            block.append((i, at, text[at : at + BLOCK_BYTES + length - 1]))
            size += len(block[-1][2])
            if size >= BLOCK_BYTES:
                _cut_block(block, found, length, anchor, width)
                block, size = [], 0
    _cut_block(block, found, length, anchor, width)
    return [[np.concatenate(c) for c in zip(*parts, strict=True)] if parts else [np.empty(0, np.int64)] * 5 for parts in found]


def _cut_block(block: list[tuple[int, int, bytes]], found: list, length: int, anchor: int, width: int) -> None:
    joined = b"".join(part for _, _, part in block)
    if len(joined) < length:
        return
    bounds = np.cumsum([0, *(len(part) for _, _, part in block)])
    words = np.ndarray((len(joined) - 7,), "<u8", joined, strides=(1,))
    rank = _mix(_mix(words, 0x9E3779B97F4A7C15), 0xD6E8FEB86659FD93) >> np.uint64(32) << np.uint64(32)
    rank |= np.arange(len(rank), dtype=np.uint64)  # leftmost of equal hashes
    places = _window_minima(rank, length - anchor + 1) & np.uint64(0xFFFFFFFF)
    valid = np.zeros(len(joined), bool)
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        valid[a : max(a, b - length + 1)] = True
    starts = np.flatnonzero(valid[: len(places)])
    if not len(starts):
        return
    at = places[starts].astype(np.int64)
    fresh = np.ones(len(starts), bool)
    fresh[1:] = (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)
    digest = xxhash.xxh3_64_intdigest
    if width:
        part = (at - starts) // width
        fresh[1:] |= part[1:] != part[:-1]
        first = np.flatnonzero(fresh)
        begin, part = starts[first], part[first]
        spot = at[first] - begin
        cores = (at[first] - part * width).tolist()
        key = np.fromiter((digest(joined[c : c + length - width + 1], seed=width << 32 | p) for c, p in zip(cores, part.tolist(), strict=True)), np.uint64, len(first)).view(np.int64)
        count = np.diff(np.append(first, len(starts)))
    else:
        first = np.flatnonzero(fresh)
        spot = at[first]
        key = np.zeros(len(spot), np.uint64)
        for k in range(0, anchor - 7, 8):
            key = _mix(key ^ words[spot + k], 0xC2B2AE3D27D4EB4F + 2 * k)
        key = _mix(key, 0xFF51AFD7ED558CCD)
        opens = np.ones(len(first), bool)
        opens[1:] = (key[1:] != key[:-1]) | (starts[first[1:]] != starts[first[1:] - 1] + 1)
        heads = np.flatnonzero(opens)
        anchors = np.diff(np.append(heads, len(first)))
        begin, key = starts[first[heads]], key[heads].view(np.int64)
        count = np.diff(np.append(first[heads], len(starts)))
        spot = np.where(anchors == 1, spot[heads] - begin, -1)
    spans = zip(begin.tolist(), (begin + count + length - 1).tolist(), strict=True)
    hashes = np.fromiter((digest(joined[a:b]) for a, b in spans), np.uint64, len(begin)).view(np.int64)
    edges = np.searchsorted(begin, bounds)
    for (i, offset, _), bound, a, b in zip(block, bounds[:-1], edges[:-1], edges[1:], strict=True):
        if b > a:
            found[i].append([key[a:b], hashes[a:b], begin[a:b] - bound + offset, count[a:b], spot[a:b]])


def _common(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    odd = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (odd.bit_length() + 7) // 8


def trimmed(group: list[tuple[bytes, int]], length: int) -> list[tuple[int, int]]:
    """Of pieces with one key, the part of each that can hold a repeated window.

    Around a shared anchor a window reaches no further than the longest common extension
    to either side, which a neighbour in sorted order has.
    """
    if any(spot < 0 for _, spot in group):
        return [(0, len(piece)) for piece, _ in group]
    reach = []
    for sides in ([p[s:] for p, s in group], [p[:s][::-1] for p, s in group]):
        order = sorted(range(len(group)), key=sides.__getitem__)
        most = [0] * len(group)
        for i, j in zip(order, order[1:]):
            n = _common(sides[i], sides[j])
            most[i], most[j] = max(most[i], n), max(most[j], n)
        reach.append(most)
    return [(s - left, s + right) if left + right >= length else (0, 0) for (_, s), right, left in zip(group, *reach, strict=True)]


def repeated_starts(pieces: list[bytes], length: int) -> list[list[tuple[int, int]]]:
    """Runs ``[from, to)`` of the starts in each piece whose window occurs elsewhere in the list."""
    bounds = np.cumsum([0, *(len(p) + 1 for p in pieces)])
    text = np.empty(bounds[-1] + 1, np.int32)
    for piece, at in zip(pieces, bounds, strict=False):
        text[at : at + len(piece)] = np.frombuffer(piece, np.uint8)
        text[at + len(piece)] = -1
    text += 2  # 1 ends a piece, 0 ends the text
    text[-1] = 0
    order = suffix_array(text)
    prefix = permuted_lcp(text, order)
    shared = prefix >= length
    shared[order[:-1]] |= prefix[order[1:]] >= length
    found = []
    for piece, at in zip(pieces, bounds, strict=False):
        inside = shared[at : at + max(0, len(piece) - length + 1)]
        edge = np.flatnonzero(np.diff(np.concatenate(([0], inside.view(np.int8), [0]))))
        found.append(list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)))
    return found


def _shards(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Repeated starts of the pieces, which come in the order of their keys.

    Parts of pieces that are equal once trimmed repeat each other at every start. One of them goes
    to the suffix array for the sake of the other parts, none if there is no other.
    """
    schema = pa.schema([("key", pa.int64()), ("hash", pa.int64()), ("runs", pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())])))])
    group: list[tuple] = []
    shard: list[tuple] = []  # key, hash (None: decided), offset, bytes
    decided: list[tuple] = []  # key, hash, runs
    size = 0

    def close() -> int:
        parts: dict[bytes, list[tuple]] = {}
        within = any(r[2] < 0 for r in group)  # several anchors of one key: a piece may repeat itself
        for row, (a, b) in zip(group, trimmed([(r[3], r[2]) for r in group], length), strict=True):
            if b - a >= length:
                parts.setdefault(row[3][a:b], []).append((row[0], row[1], a))
        group.clear()
        added = 0
        for part, rows in parts.items():
            if len(rows) > 1:
                decided.extend((k, h, [{"first": a, "end": a + len(part) - length + 1}]) for k, h, a in rows)
            if len(parts) > 1 or within:
                shard.append((rows[0][0], rows[0][1] if len(rows) == 1 else None, rows[0][2], part))
                added += len(part)
        return added

    def solve() -> pa.RecordBatch:
        runs = repeated_starts([row[3] for row in shard], length) if shard else []
        for (key, name, a, _), found in zip(shard, runs, strict=True):
            if name is not None:
                decided.append((key, name, [{"first": f + a, "end": e + a} for f, e in found]))
        made = pa.RecordBatch.from_arrays([pa.array([r[i] for r in decided], schema.field(i).type) for i in range(3)], schema=schema)
        shard.clear()
        decided.clear()
        return made

    for batch in batches:
        columns = [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in ("key", "hash", "spot", "piece")]
        for row in zip(*columns, strict=True):
            if group and group[0][0] != row[0]:
                size += close()
                if size >= SHARD_BYTES or len(decided) >= 10_000:
                    yield solve()
                    size = 0
            group.append(row)
    close()
    if shard or decided:
        yield solve()


def _runs(units: DataFrame, length: int, anchor: int, hot: int, level: int) -> DataFrame:
    """``uid, runs``: the runs of repeated starts of each distinct unit ``uid, text, copies``."""

    def cut(batch: pa.RecordBatch) -> dict:
        parts = cut_pieces(batch.column("text").to_pylist(), length, anchor, WIDTHS[level])
        names = ("key", "hash", "start", "count", "spot")
        return {"uid": batch.column("uid"), "copies": batch.column("copies")} | {n: [p[i] for p in parts] for i, n in enumerate(names)}

    long_enough = units.where(F.length("text") >= length)
    arrays = F.struct("key", "hash", "start", "count", "spot")
    cut_units = staged(
        map_batches(long_enough.select("uid", "text", "copies"), cut, _CUT).groupBy("uid").agg(F.sum("copies").alias("copies"), F.first(arrays).alias("p")).select("uid", "copies", "p.*"),
        "pieces",
    )
    zipped = F.arrays_zip("key", "hash", "start", "count", "spot")
    pieces = cut_units.select("uid", "copies", F.inline(zipped))
    shared = pieces.groupBy("key").agg(F.min("hash").alias("low"), F.max("hash").alias("high"), F.min("spot").alias("spot")).where("low < high or spot < 0").select("key", F.lit(True).alias("shared"))
    groups = pieces.groupBy("key", "hash").agg(F.sum("copies").alias("n"), F.min(F.struct("uid", "start", "count", "spot")).alias("at"))
    groups = staged(groups.join(shared, "key", "left").where("shared or n > 1").select("key", "hash", "n", F.coalesce("shared", F.lit(False)).alias("shared"), "at.*"), "groups")
    wanted = groups.where("shared").groupBy("uid").agg(F.collect_list(F.struct("key", "hash", "n", "start", "count", "spot")).alias("wanted"))

    def lift(batch: pa.RecordBatch) -> dict:
        made: dict = {n: [] for n in ("key", "hash", "copies", "spot", "piece")}
        for text, rows in zip(batch.column("text"), batch.column("wanted"), strict=True):
            text = text.as_py()
            for r in rows.as_py():
                made["key"].append(r["key"])
                made["hash"].append(r["hash"])
                made["copies"].append(r["n"])
                made["spot"].append(r["spot"])
                made["piece"].append(text[r["start"] : r["start"] + r["count"] + length - 1])
        return made

    found = map_batches(long_enough.select("uid", "text").join(wanted, "uid").select("text", "wanted"), lift, _PIECE)
    found = staged(found.groupBy("key", "hash").agg(*(F.first(c).alias(c) for c in ("copies", "spot", "piece"))), "shared")
    large = groups.where("shared").groupBy("key").agg(F.count(F.lit(1)).alias("d")).where(F.col("d") > hot).select("key")
    decided = []
    if level + 1 < len(WIDTHS) and large.limit(1).count():
        again = staged(found.join(large, "key").select(_pair_id("key", "hash").alias("uid"), "key", "hash", F.col("piece").alias("text"), "copies"), "hot")
        below = _runs(again.select("uid", "text", "copies"), length, anchor, hot, level + 1)
        decided.append(staged(below.join(again.select("uid", "key", "hash"), "uid").select("key", "hash", "runs"), "runs"))
        found = found.join(large, "key", "left_anti")
    volume = found.agg(F.sum(F.length("piece"))).first()[0] or 0
    sharded = found.select("key", "hash", "spot", "piece").repartition(1 + volume // (2 * SHARD_BYTES), "key").sortWithinPartitions("key", "hash")
    decided.append(sharded.mapInArrow(lambda batches: _shards(batches, length), _FOUND))
    for more in decided[1:]:
        decided[0] = decided[0].unionByName(more)
    whole = groups.where("n > 1").select("key", "hash", F.array(F.struct(F.lit(0).alias("first"), F.col("count").alias("end"))).alias("runs"))
    once = groups.where("n = 1 and shared").select("key", "hash")
    decided = whole.unionByName(decided[0].where(F.size("runs") > 0).join(once, ["key", "hash"], "left_semi"))
    placed = pieces.select("uid", "key", "hash", "start").join(decided, ["key", "hash"])
    placed = placed.select("uid", F.transform("runs", lambda r: F.struct((r["first"] + F.col("start")).alias("first"), (r["end"] + F.col("start")).alias("end"))).alias("runs"))
    return placed.groupBy("uid").agg(F.flatten(F.collect_list("runs")).alias("runs"))


def _pair_id(*names: str) -> Column:
    return F.concat(*(F.unhex(F.lpad(F.hex(n), 16, "0")) for n in names))


def remove_repeats(docs: DataFrame, text: str = "text", length: int = LENGTH, anchor: int = ANCHOR, hot: int = HOT, decoded: bool = False) -> DataFrame:
    """``docs`` with ``_bytes`` (UTF-8, null: empty), ``_removed``, ``_spans`` and ``_kept`` (what is left).

    ``_kept`` is binary or, ``decoded``, a string without the characters that were cut in part.

    Each byte that a ``length``-byte string covers which also starts anywhere else is removed.
    Texts shorter than ``length``, empty and null texts keep all; repeated rows are repeats of
    one another. An empty table gives an empty result. Columns of other names pass through; those
    named above, ``_text``, ``_uid`` and ``_runs`` are replaced.
    """
    docs = docs.drop("_bytes", "_removed", "_spans", "_kept", "_text", "_uid", "_runs")
    source = docs.withColumn("_text", F.coalesce(F.col(text), F.lit("")).cast("binary")).withColumn("_uid", F.unhex(F.md5("_text")))
    units = source.select(F.col("_uid").alias("uid"), F.col("_text").alias("text"), F.lit(1).cast("long").alias("copies"))
    runs = _runs(units, length, anchor, hot, 0).select(F.col("uid").alias("_uid"), F.col("runs").alias("_runs"))
    joined = source.join(runs, "_uid", "left").drop("_uid")
    schema = extended(joined.drop("_text", "_runs").schema, _bytes="long", _removed="long", _spans="long", _kept="string" if decoded else "binary")
    names = docs.columns

    def cut(batch: pa.RecordBatch) -> dict:
        made: dict = {n: batch.column(n) for n in names} | {n: [] for n in ("_bytes", "_removed", "_spans", "_kept")}
        for whole, runs in zip(batch.column("_text"), batch.column("_runs"), strict=True):
            whole, runs = whole.as_py(), runs.as_py() or []
            parts, at, spans, removed = [], 0, 0, 0
            for a, b in sorted((r["first"], r["end"] + length - 1) for r in runs):
                if a > at or not spans:
                    parts.append(whole[at:a])
                    spans += 1
                    removed -= a
                    removed += b
                elif b > at:
                    removed += b - at
                at = max(at, b)
            parts.append(whole[at:])
            kept = b"".join(parts)
            for n, v in (("_bytes", len(whole)), ("_removed", removed), ("_spans", spans), ("_kept", kept.decode("utf-8", "ignore") if decoded else kept)):
                made[n].append(v)
        return made

    return map_batches(joined, cut, schema)
