"""Token ids of whole texts by public byte-level vocabularies, and what is counted from them.

A text is cut before each single space into chunks. The split pattern never matches across
such a place unless white space stands on both sides of the space, so the ids of a text are
those of its chunks; the other texts are encoded whole. Ids of short chunks are remembered within
a worker, in a table of bounded bytes.
"""

from __future__ import annotations

import base64
import heapq
import json
import re
from array import array
from bisect import bisect_right
from collections.abc import Callable, Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomsync.llm.common import extended, map_batches

#: Remembered chunks per worker; the table starts anew beyond it.
MEMO = 400_000
#: Characters of a chunk that is worth remembering, so the bytes of the table are bounded as well.
SHORT = 48
#: Bytes of a word that is merged side by side with others, and of all words merged at once.
SIDE_BY_SIDE = 64
AT_ONCE = 1 << 20

#: Above every rank.
_NONE = 1 << 30

_UNSAFE = re.compile(r"\s \s|\s $")


class Chunks:
    """Values of texts put together from values of their chunks, which ``solve`` finds many at a time."""

    def __init__(self, solve: Callable[[list[str]], Iterable]) -> None:
        self.solve = solve
        self.memo: dict[str, object] = {}

    def values(self, texts: list[str]) -> list[list]:
        parts = []
        for text in texts:
            if _UNSAFE.search(text):
                parts.append([text] if text else [])
            else:
                first, *rest = text.split(" ")
                parts.append(([first] if first else []) + [" " + x for x in rest])
        if len(self.memo) > MEMO:
            self.memo.clear()
        memo = self.memo
        missing = list({x for chunks in parts for x in chunks if x not in memo})
        memo.update(zip(missing, self.solve(missing), strict=True))
        found = [[memo[x] for x in chunks] for chunks in parts]
        for x in missing:
            if len(x) > SHORT:
                del memo[x]
        return found


class MergeReplay:
    """Byte-pair merges of many words at once, in the order of their ranks.

    An inverted index maps each mergeable token pair, known by the rank of what it becomes,
    to the positions where it stands. The lowest rank goes first; a merge changes only the
    pairs with its two neighbours. Merges in different words do not touch, so short words, which
    are nearly all, go side by side: each round takes from the index the lowest rank of every word.
    """

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.spelled = {rank: piece for piece, rank in ranks.items()}
        self.pairs: dict[int, int] = {}
        keys, becomes = [], []
        for piece, rank in ranks.items():
            for cut in range(1, len(piece)):
                a, b = ranks.get(piece[:cut]), ranks.get(piece[cut:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    becomes.append(rank)
        order = np.argsort(np.array(keys, np.int64))
        self.keys = np.append(np.array(keys, np.int64)[order], np.iinfo(np.int64).max)
        self.becomes = np.append(np.array(becomes, np.int64)[order], -1)
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)

    def looked_up(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of the tokens that the pairs become, ``_NONE`` where there is none."""
        key = a << 32 | b
        at = self.keys.searchsorted(key)
        return np.where(self.keys[at] == key, self.becomes[at], _NONE)

    def side_by_side(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word as 32-bit little-endian bytes."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes)
        token = self.single[np.frombuffer(b"".join(words), np.uint8)]
        n = len(token)
        owner = np.repeat(np.arange(len(words)), sizes)
        place = np.arange(n)
        after, before = place + 1, place - 1
        after[ends - 1] = -1
        before[ends - sizes] = -1
        index = np.full(n, _NONE << 32)  # rank and place of the pair that begins at each position
        open_ = np.flatnonzero(after >= 0)
        index[open_] = self.looked_up(token[open_], token[open_ + 1]) << 32 | open_
        live = np.flatnonzero(index < _NONE << 32)
        while len(live):
            whose = owner[live]
            first = np.flatnonzero(np.concatenate(([True], whose[1:] != whose[:-1])))
            lowest = np.minimum.reduceat(index[live], first)
            i, rank = lowest & 0xFFFFFFFF, lowest >> 32
            j = after[i]
            right, left = after[j], before[i]
            token[i], after[i] = rank, right
            index[j] = index[i] = _NONE << 32
            token[j] = -1
            inner = right >= 0
            before[right[inner]] = i[inner]
            index[i[inner]] = self.looked_up(rank[inner], token[right[inner]]) << 32 | i[inner]
            inner = left >= 0
            index[left[inner]] = self.looked_up(token[left[inner]], rank[inner]) << 32 | left[inner]
            touched = np.zeros(n, bool)
            touched[live] = True
            touched[i] = True
            touched[left[inner]] = True
            live = np.flatnonzero(touched)
            live = live[index[live] < _NONE << 32]
        kept = token >= 0
        edges = np.concatenate(([0], np.cumsum(kept)))[np.concatenate(([0], ends))].tolist()
        data = token[kept].astype("<i4").tobytes()
        return [data[4 * a : 4 * b] for a, b in zip(edges, edges[1:])]

    def packed(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word as 32-bit little-endian bytes; no word is empty."""
        made: list[bytes | None] = []
        short, long = [], []
        for k, w in enumerate(words):
            rank = self.ranks.get(w)
            made.append(None if rank is None else rank.to_bytes(4, "little"))
            if rank is None:
                (short if len(w) <= SIDE_BY_SIDE else long).append(k)
        for group, solve in ((short, self.side_by_side), (long, lambda ws: [array("i", ids).tobytes() for ids in self.encode(ws)])):
            at = 0
            while at < len(group):
                size, stop = 0, at
                while stop < len(group) and size < AT_ONCE:
                    size += len(words[group[stop]])
                    stop += 1
                for k, ids in zip(group[at:stop], solve([words[k] for k in group[at:stop]]), strict=True):
                    made[k] = ids
                at = stop
        return made

    def pair(self, a: int, b: int) -> int:
        """Rank of the token that ``a`` and ``b`` become, -1 if there is none."""
        key = a << 32 | b
        rank = self.pairs.get(key)
        if rank is None:
            rank = self.pairs[key] = self.ranks.get(self.spelled[a] + self.spelled[b], -1)
        return rank

    def encode(self, words: list[bytes]) -> list[list[int]]:
        whole = [self.ranks.get(w) for w in words]
        open_ = [w for w, rank in zip(words, whole, strict=True) if rank is None and w]
        single = [self.ranks[bytes([b])] for b in range(256)]
        token = [single[b] for w in open_ for b in w]
        bounds = [0]
        for w in open_:
            bounds.append(bounds[-1] + len(w))
        after = list(range(1, len(token) + 1))
        before = list(range(-1, len(token) - 1))
        for a, b in zip(bounds, bounds[1:]):
            before[a], after[b - 1] = -1, -1
        index: dict[int, list[int]] = {}
        rank_at = [-1] * len(token)
        known = self.pairs
        for start, end in zip(bounds, bounds[1:]):
            left = token[start]
            for i in range(start, end - 1):
                right = token[i + 1]
                rank = known.get(left << 32 | right)
                if rank is None:
                    rank = self.pair(left, right)
                left = right
                if rank >= 0:
                    rank_at[i] = rank
                    if rank in index:
                        index[rank].append(i)
                    else:
                        index[rank] = [i]
        queue = list(index)
        heapq.heapify(queue)
        while queue:
            rank = heapq.heappop(queue)
            places = index.pop(rank, None)
            if places is None:
                continue
            places.sort()
            skip = -1
            for i in places:
                if rank_at[i] != rank:
                    continue
                if i < skip:  # a lower rank has come up in this word: it goes first
                    if rank not in index:
                        heapq.heappush(queue, rank)
                    index.setdefault(rank, []).append(i)
                    continue
                j = after[i]
                right, left = after[j], before[i]
                token[i], after[i] = rank, right
                token[j] = rank_at[j] = -1
                rank_at[i] = -1
                if right >= 0:
                    before[right] = i
                for a, b in ((i, right), (left, i)):
                    if a >= 0 and b >= 0:
                        new = known.get(token[a] << 32 | token[b])
                        if new is None:
                            new = self.pair(token[a], token[b])
                        rank_at[a] = new
                        if new >= 0:
                            if new not in index:
                                heapq.heappush(queue, new)
                                index[new] = []
                            index[new].append(a)
                            if new < rank:
                                skip = bounds[bisect_right(bounds, i)]
        solved = iter([[t for t in token[a:b] if t >= 0] for a, b in zip(bounds, bounds[1:])])
        return [[rank] if rank is not None else next(solved) if w else [] for w, rank in zip(words, whole, strict=True)]


@lru_cache(maxsize=4)
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


@lru_cache(maxsize=4)
def _replayed(path: str, pattern: str) -> Chunks:
    """Ids of chunks by merge replay, as 32-bit little-endian bytes."""
    replay, split = MergeReplay(load_ranks(path)), regex.compile(pattern)

    def solve(chunks: list[str]) -> list[bytes]:
        words = [split.findall(c) for c in chunks]
        new = list({w for ws in words for w in ws})
        known = dict(zip(new, replay.packed([w.encode() for w in new]), strict=True))
        return [known[ws[0]] if len(ws) == 1 else b"".join([known[w] for w in ws]) for ws in words]

    return Chunks(solve)


#: Added tokens of a vocabulary: text and id of each.
Added = tuple[tuple[str, int], ...]


def added_tokens(json_path: str) -> Added:
    """The added tokens of a ``tokenizers`` file, which it reads in any text before all else."""
    with open(json_path, encoding="utf-8") as file:
        return tuple((t["content"], t["id"]) for t in json.load(file)["added_tokens"])


class Pieces(dict):
    """Ids of a space and what follows it up to the next, as 32-bit bytes or, counted, their number."""

    def __init__(self, path: str, pattern: str, counted: bool, added: Added) -> None:
        encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=load_ranks(path), special_tokens={})
        self.counted = counted
        self.encode = encoding.encode_ordinary
        self.added = dict(added)
        longest_first = sorted(self.added, key=len, reverse=True)
        self.cut = re.compile(f"({'|'.join(map(re.escape, longest_first))})") if added else None

    def value(self, text: str):
        ids = self.encode(text)
        return len(ids) if self.counted else array("I", ids).tobytes()

    def __missing__(self, piece: str):
        value = self.value(" " + piece)
        if len(piece) <= SHORT:
            if len(self) > MEMO:
                self.clear()
            self[piece] = value
        return value

    def values(self, text: str) -> list:
        """Values of consecutive parts of ``text``."""
        if self.cut and self.cut.search(text):
            parts = self.cut.split(text)
            made = []
            for i, part in enumerate(parts):
                made += self.plain(part) if i % 2 == 0 else [1 if self.counted else array("I", [self.added[part]]).tobytes()]
            return made
        return self.plain(text)

    def plain(self, text: str) -> list:
        if _UNSAFE.search(text):
            return [self.value(text)]
        first, *rest = text.split(" ")
        return [self.value(first), *map(self.__getitem__, rest)]


@lru_cache(maxsize=4)
def known_pieces(path: str, pattern: str, counted: bool, added: Added) -> Pieces:
    return Pieces(path, pattern, counted, added)


def _texts(column: pa.Array) -> list[str]:
    return [x or "" for x in column.to_pylist()]


def encode(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the token ids of each whole text; null and empty texts have none.

    A column that is called as ``ids`` already is replaced; all others pass through.
    """
    docs = docs.drop(ids)
    names = docs.columns

    def run(batch: pa.RecordBatch) -> dict:
        packed = [b"".join(v) for v in _replayed(ranks_path, pattern).values(_texts(batch.column(text)))]
        edges = np.cumsum([0, *(len(p) // 4 for p in packed)], dtype=np.int32)
        flat = np.frombuffer(b"".join(packed), "<i4")
        return {n: batch.column(n) for n in names} | {ids: pa.ListArray.from_arrays(pa.array(edges), pa.array(flat))}

    return map_batches(docs, run, extended(docs.schema, **{ids: "array<int>"}))


def decode(df: DataFrame, ranks_path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``df`` with the bytes that the ids spell; no ids or null give no bytes."""
    df = df.drop(decoded)
    names = df.columns

    def run(batch: pa.RecordBatch) -> dict:
        rows = batch.column(ids)
        spelled = _spelled(ranks_path).take(rows.flatten())
        edges = np.cumsum(np.concatenate(([0], rows.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))))
        # Tokens of a row stand side by side, so its bytes do.
        bounds = np.frombuffer(spelled.buffers()[1], "<i4", len(spelled) + 1, 4 * spelled.offset)[edges] if len(spelled) else np.zeros(len(edges), "<i4")
        data = spelled.buffers()[2] if len(spelled) else pa.py_buffer(b"")
        return {n: batch.column(n) for n in names} | {decoded: pa.BinaryArray.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(bounds.astype("<i4")), data])}

    return map_batches(df, run, extended(df.schema, **{decoded: "binary"}))


@lru_cache(maxsize=4)
def _spelled(path: str) -> pa.BinaryArray:
    """The bytes of every rank."""
    ranks = load_ranks(path)
    pieces: list[bytes | None] = [None] * (max(ranks.values()) + 1)
    for piece, rank in ranks.items():
        pieces[rank] = piece
    return pa.array(pieces, pa.binary())


def count_tokens(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", count: str = "n_tokens", added: Added = ()) -> DataFrame:
    """``docs`` without the text, with its number of tokens; null and empty texts have 0, ``added`` tokens count as one each."""
    kept = docs.drop(count)
    names = [c for c in kept.columns if c != text]

    def run(batch: pa.RecordBatch) -> dict:
        pieces = known_pieces(ranks_path, pattern, True, added)
        return {n: batch.column(n) for n in names} | {count: [sum(pieces.values(t)) for t in _texts(batch.column(text))]}

    return map_batches(kept, run, extended(kept.drop(text).schema, **{count: "long"}))


def length_histogram(counts: DataFrame, count: str = "n_tokens") -> DataFrame:
    """For each occurring length ``context``: what a context limit of that many tokens means.

    ``documents`` and ``tokens`` have this length; ``documents_longer`` and ``tokens_longer``
    exceed it; ``truncated_tokens`` are left when every document is cut to it; ``quantile`` is
    the share of documents within it. A limit between two lengths has the sums of the lower
    one, plus one token per longer document for each step above it. Suffix sums run over the
    distinct lengths, of which there are at most as many as the longest text has tokens.
    An empty table gives no rows; a null count is no document.
    """
    lengths = counts.where(F.col(count).isNotNull()).groupBy(F.col(count).alias("context")).agg(F.count(F.lit(1)).alias("documents"))
    lengths = lengths.withColumn("tokens", F.col("context") * F.col("documents"))
    longer = Window.orderBy(F.col("context").desc()).rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.orderBy(F.col("context").desc()).rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy(F.col("context").desc()).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sums = lengths.select(
        "context",
        "documents",
        "tokens",
        F.coalesce(F.sum("documents").over(longer), F.lit(0)).alias("documents_longer"),
        F.coalesce(F.sum("tokens").over(longer), F.lit(0)).alias("tokens_longer"),
        F.sum("tokens").over(upto).alias("tokens_upto"),
        F.sum("documents").over(everything).alias("all_documents"),
    )
    return sums.select(
        "context",
        "documents",
        "tokens",
        "documents_longer",
        "tokens_longer",
        (F.col("tokens_upto") + F.col("documents_longer") * F.col("context")).alias("truncated_tokens"),
        (1 - F.col("documents_longer") / F.col("all_documents")).alias("quantile"),
    )
