"""Phrases whose words stand together more often than their parts let expect, by stripes.

A stripe is a prefix with a counter of the words that follow it. Each block of texts gives its
stripes, which are merged element by element; the merged stripes give the counts of all
phrases, and the largest entry of a stripe is the largest right extension of its prefix.

Most phrases are rare, and a rare one need not be spelled out. So hashes of phrases are counted first,
of two words and then of more, each only where all its parts may be frequent; what reaches
the wanted count goes into a filter with a fixed number of bits. Equal hashes add up and bits may be
shared, but never is a frequent phrase missed, so a full filter costs time and nothing else. Stripes
are made of phrases in the filter only, by their words, and decide exactly. A stripe is cut by a hash of
the next word into a fixed number of slices, so that no prefix is bound to one task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from loomsync.llm.common import map_batches
from loomsync.llm.words import mix
from loomsync.session import staged

LEAST = 100
LONGEST = 5
TOP = 2000
#: Bits of one filter, and text bytes counted at once.
FILTER_BITS = 1 << 25
BLOCK_BYTES = 1 << 23
#: Parts that stripes and the counts of hashes are dealt to; what a block has for one part is one row.
_DEALT = 1024
#: Slices of a stripe, by words of a phrase; prefixes of several words have few followers each.
_SLICES = {1: _DEALT, 2: 64, 3: 8}
_STRIPES = "part int, prefix array<string>, next array<string>, count array<long>"
#: Rows of the ranking are cut to the wanted number in so many parts per language first.
_PARTS = 64

_PIECE, _GAP = 2, 1
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = _GAP
_KIND[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = _PIECE
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _grown(hashes: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Hash of phrases from those of their prefixes and of their last words."""
    return mix(hashes * _STEP + words)


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _seed(lang: str) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(lang.encode())], np.uint64)


class Filter:
    """Which hashes may be among the frequent phrases of one length."""

    def __init__(self, cells: np.ndarray) -> None:
        self.cells = cells

    def __contains__(self, _) -> bool:
        raise TypeError("ask for many at once")

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        return (self.cells[hashes & np.uint64(len(self.cells) - 1)] >> (hashes >> np.uint64(58))) & np.uint64(1) == 1


def split_words(data: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct lower-case words, and per occurrence its word's number and its piece."""
    kind = _KIND[data]
    inside = kind == 0
    edge = np.diff(np.concatenate(([0], inside.view(np.int8), [0])))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    piece = np.cumsum(kind == _PIECE, dtype=np.int32)[starts]
    offsets = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(ends - starts, out=offsets[1:])
    found = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(_LOWER[data[inside]])]).dictionary_encode()
    return found.dictionary.to_pylist(), found.indices.to_numpy(zero_copy_only=False), piece


class Block:
    """The words of texts of one language, joined by piece ends."""

    def __init__(self, data: bytes, lang: str) -> None:
        self.words, self.ids, self.piece = split_words(np.frombuffer(data, np.uint8))
        self.hashes = _hashes(self.words)
        self.lang = lang

    def phrases(self, filters: list[Filter | None], longest: int) -> Iterator[tuple]:
        """Per length from 2 the distinct phrases whose parts may be frequent: number of the prefix among those one shorter, of the last
        word, hashes of the prefix and of the phrase, count, and whether it may be frequent itself.

        ``filters`` tell by length, from 1, which phrases may be; none lets all pass. Only what passes may be part of a longer one.
        """
        known = _grown(_seed(self.lang), self.hashes)
        alive = filters[0].holds(known)[self.ids]
        phrase = self.ids.astype(np.int64)
        for length in range(2, longest + 1):
            starts = alive[:-1] & alive[1:]
            if length == 2:
                starts &= self.piece[1:] == self.piece[:-1]
            at = np.flatnonzero(starts)
            if not len(at):
                return
            code = phrase[at] << 32 | self.ids[at + length - 1]
            distinct, number, counts = np.unique(code, return_inverse=True, return_counts=True)
            prefix, last = distinct >> 32, distinct & 0xFFFFFFFF
            stem = known[prefix]
            known = _grown(stem, self.hashes[last])
            ok = filters[length - 1].holds(known) if filters[length - 1] is not None else np.ones(len(known), bool)
            yield length, prefix, last, stem, known, counts, ok
            alive = np.zeros(len(starts), bool)
            alive[at] = ok[number]
            phrase = np.zeros(len(starts), np.int64)
            phrase[at] = number

    def single(self) -> tuple[list, list, list, list]:
        """Stripes of the empty prefix; an entry without a word is the number of all words."""
        if not self.words:
            return [], [], [], []
        counts = np.bincount(self.ids, minlength=len(self.words)).tolist()
        part = (self.hashes % np.uint64(_SLICES[1])).astype(np.int64)
        spelled = [w.decode() for w in self.words]
        return _packed(np.append(part, 0), [""] * (len(spelled) + 1), [*spelled, None], [*counts, len(self.ids)])

    def stripes(self, filters: list[Filter], longest: int) -> tuple[list, list, list, list]:
        """Stripes of the phrases in the filters, by part."""
        parts, prefixes, nexts, numbers = [np.empty(0, np.int64)], [], [], []
        names: list[bytes] = self.words
        for length, prefix, last, stem, _, counts, ok in self.phrases(filters, longest):
            p, w = prefix[ok].tolist(), last[ok].tolist()
            cut = mix(stem[ok] + self.hashes[last[ok]] % np.uint64(_SLICES.get(length, 1)))
            parts.append((cut % np.uint64(_DEALT)).astype(np.int64))
            prefixes += [names[x].decode() for x in p]
            nexts += [self.words[x].decode() for x in w]
            numbers += counts[ok].tolist()
            spelled = [b""] * len(prefix)
            for k, a, b in zip(np.flatnonzero(ok).tolist(), p, w, strict=True):
                spelled[k] = names[a] + b" " + self.words[b]
            names = spelled
        return _packed(np.concatenate(parts), prefixes, nexts, numbers)

    def hashed(self, filters: list[Filter | None], shortest: int, longest: int) -> tuple[list, list, list]:
        """Part, hashes and counts of the phrases of the given lengths."""
        found = [(known, counts) for length, _, _, _, known, counts, _ in self.phrases(filters, longest) if length >= shortest]
        if not found:
            return [], [], []
        known, counts = (np.concatenate(x) for x in zip(*found, strict=True))
        part = (known >> np.uint64(40)).astype(np.int64) % _DEALT
        order = np.argsort(part, kind="stable")
        part, known, counts = part[order], known[order].view(np.int64), counts[order].astype(np.int32)
        bounds = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(part)]
        spans = list(zip(bounds[:-1], bounds[1:], strict=True))
        return [int(part[a]) for a, _ in spans], [known[a:b] for a, b in spans], [counts[a:b] for a, b in spans]


def _packed(part: np.ndarray, prefixes: list[str], nexts: list[str | None], counts: list[int]) -> tuple[list, list, list, list]:
    """Entries of stripes, a row per part."""
    order = np.argsort(part, kind="stable")
    bounds = [0, *(np.flatnonzero(np.diff(part[order])) + 1).tolist(), len(order)] if len(order) else [0]
    spans = list(zip(bounds[:-1], bounds[1:], strict=True))
    first = part[order[bounds[:-1]]].tolist() if len(order) else []
    order = order.tolist()
    return first, *([[column[i] for i in order[a:b]] for a, b in spans] for column in (prefixes, nexts, counts))


def _segments(text: bytes, limit: int) -> Iterator[bytes]:
    """``text``, if longer than ``limit``, in parts that end where a piece ends."""
    while len(text) > limit:
        ends = np.flatnonzero(_KIND[np.frombuffer(text, np.uint8, limit)] == _PIECE)
        cut = int(ends[-1]) + 1 if len(ends) else None
        if cut is None:
            later = np.flatnonzero(_KIND[np.frombuffer(text, np.uint8)] == _PIECE)
            cut = int(later[0]) + 1 if len(later) else len(text)
        yield text[:cut]
        text = text[cut:]
    yield text


def _blocks(texts: DataFrame, make: Callable[[Block], tuple[list, ...]], schema: str, block: int) -> DataFrame:
    """What ``make`` gives of all blocks of the rows ``lang, text``; a column ``lang`` comes first."""
    schema = f"lang string, {schema}"
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}

        def close(lang: str) -> pa.RecordBatch:
            sizes.pop(lang)
            columns = make(Block(b"\n".join(held.pop(lang)), lang))
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(([lang] * len(columns[0]), *columns), arrow, strict=True)], schema=arrow)

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                for part in _segments(text, block):
                    held.setdefault(lang, []).append(part)
                    sizes[lang] = sizes.get(lang, 0) + len(part) + 1
                    if sizes[lang] >= block:
                        yield close(lang)
            while sum(sizes.values()) >= 2 * block:  # many languages: the fullest goes first
                yield close(max(sizes, key=sizes.get))
        for lang in list(held):
            yield close(lang)

    return texts.mapInArrow(run, schema)


def merged(stripes: DataFrame) -> DataFrame:
    """``lang, prefix, next, f``: the stripes added up element by element, where the parts of all blocks meet."""
    met = stripes.repartition("lang", "part").select("lang", "part", F.inline(F.arrays_zip("prefix", "next", "count")))
    return met.groupBy("lang", "part", "prefix", "next").agg(F.sum("count").alias("f")).drop("part")


def _filter(hashes: DataFrame, bits: int) -> Broadcast:
    """Filter of the column ``hash``; at most ``bits`` / 64 rows reach the driver."""
    cell, bit = F.col("hash").bitwiseAND(bits // 64 - 1), F.shiftrightunsigned("hash", 58).cast("int")
    cells = hashes.groupBy(cell.alias("cell")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("mask")).toArrow()
    made = np.zeros(bits // 64, np.uint64)
    made[cells["cell"].to_numpy()] = cells["mask"].to_numpy().view(np.uint64)
    return hashes.sparkSession.sparkContext.broadcast(Filter(made))


def _frequent(texts: DataFrame, filters: list[Broadcast | None], shortest: int, longest: int, least: int, block: int) -> DataFrame:
    """``hash`` of the phrases of the given lengths that may occur ``least`` times."""

    def make(part: Block) -> tuple[list, ...]:
        return part.hashed([f and f.value for f in filters], shortest, longest)

    dealt = _blocks(texts, make, "part int, hash array<long>, count array<int>", block).repartition("part")
    return dealt.select("part", F.inline(F.arrays_zip("hash", "count"))).groupBy("part", "hash").agg(F.sum("count").alias("f")).where(F.col("f") >= least).select("hash")


def _word_hashes(words: DataFrame) -> DataFrame:
    def place(batch: pa.RecordBatch) -> dict:
        seeds = np.concatenate([_seed(x) for x in batch.column("lang").to_pylist()])
        return {"hash": _grown(seeds, _hashes([w.encode() for w in batch.column("next").to_pylist()])).view(np.int64)}

    return map_batches(words.select("lang", "next"), place, "hash long")


def phrase_counts(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST, bits: int = FILTER_BITS, block: int = BLOCK_BYTES) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, prefix, words, f`` of all phrases of up to ``longest`` words that occur ``least`` times, and ``lang, n``.

    ``bits`` is a power of two. The texts are read four times: words, hashes of pairs, hashes of longer phrases, stripes.
    """
    texts = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    single = staged(merged(_blocks(texts, Block.single, _STRIPES, block)).where(F.col("next").isNull() | (F.col("f") >= least)), "stripes")
    totals = single.where(F.col("next").isNull()).select("lang", F.col("f").alias("n"))
    words = single.where(F.col("next").isNotNull())
    filters: list[Broadcast | None] = [_filter(_word_hashes(words), bits)]
    filters.append(_filter(_frequent(texts, [*filters, None], 2, 2, least, block), bits))
    if longest > 2:
        more = [None] * (longest - 2)
        filters += [_filter(_frequent(texts, [*filters, *more], 3, longest, least, block), bits)] * (longest - 2)

    def make(part: Block) -> tuple[list, ...]:
        return part.stripes([f.value for f in filters], longest)

    several = staged(merged(_blocks(texts, make, _STRIPES, block)).where(F.col("f") >= least), "stripes")
    size = F.size(F.split("prefix", " ")) + 1
    counts = words.select("lang", F.col("next").alias("phrase"), "prefix", F.lit(1).alias("words"), "f")
    return counts.unionByName(several.select("lang", F.concat("prefix", F.lit(" "), "next").alias("phrase"), "prefix", size.alias("words"), "f")), totals


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST, top: int = TOP, share: int = 100,
    bits: int = FILTER_BITS, block: int = BLOCK_BYTES,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of each language.

    Null texts are empty, null languages ``und``; texts without words and an empty table give nothing. Repeated rows
    count as often as they occur. Ties of score and count go to the phrase that is smaller in UTF-8. A
    phrase is left out if one that holds it has ``share`` percent of its occurrences; as counts fall with
    each added word, its extensions by one word at either end decide that.
    """
    counts, totals = phrase_counts(docs, text, lang, least, longest, bits, block)
    counts = staged(counts, "phrases")
    suffix = F.expr("substring(phrase, instr(phrase, ' ') + 1)")
    ends = counts.where("words > 2").select("lang", F.explode(F.array(F.col("prefix"), suffix)).alias("phrase"), "f")
    extended = ends.groupBy("lang", "phrase").agg(F.max("f").alias("most"))
    candidates = counts.where("words > 1").select("lang", "phrase", "words", F.col("f").alias("a")).join(extended, ["lang", "phrase"], "left")
    candidates = candidates.where(F.col("most").isNull() | (100 * F.col("most") < share * F.col("a")))
    parts = F.split("phrase", " ")
    cuts = candidates.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.withColumns({"left": F.array_join(F.slice(parts, 1, F.col("k")), " "), "right": F.array_join(F.slice(parts, F.col("k") + 1, F.col("words")), " ")})
    known = counts.select("lang", "phrase", "f")
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"]).join(totals, "lang")
    score = F.expr("(cast(1000 * a as decimal(38,0)) * cast(n as decimal(19,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    lowest = cuts.withColumn("score", score).groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    rows = lowest.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score", F.pmod(F.xxhash64("phrase"), F.lit(_PARTS)).alias("part"))
    first = rows.withColumn("rank", F.expr("row_number() OVER (PARTITION BY lang, part ORDER BY score DESC, a DESC, phrase)")).where(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.expr("row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)").cast("long"))
    return ranked.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
