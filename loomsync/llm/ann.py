"""Approximate nearest neighbours by inner product over balanced posting lists.

Vectors get one more component that makes all lengths equal, so the largest product is the
smallest distance. A bounded sample is halved again and again along the line between two
means, always at the median: the centroids of the even parts head the posting lists. Every
vector goes to the list of its nearest centroid and to those that are hardly farther, unless
a list already chosen is closer to that centroid than the vector is; it finds them by a beam
search in the centroids' neighbour graph, which each task holds in memory.

How many lists a query reads, and how many copies of a vector count, is not fixed: a bounded
set of queries is answered by brute force, and the cheapest pair that finds the wanted share
of their neighbours is taken, up to all lists. Without structure in the vectors that is a
large part of the table, at every size. Neighbouring lists share a cell, which is one task's
work for the queries that read any of them; long lists are cut over several cells.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomsync.llm.common import map_batches, with_ids, with_row_keys
from loomsync.llm.mtree import usable
from loomsync.session import staged


@dataclass(frozen=True)
class Settings:
    #: Vectors that centroids are fitted on, at most; centroids, at most; vectors per list aimed at.
    sample: int = 40_000
    centroids: int = 4_096
    list_size: int = 128
    #: Lists a vector is copied to, and how much farther (squared) they may be.
    copies: int = 4
    closure: float = 1.2
    #: Lists a query reads, at least; the probed queries settle up to what ratio of the nearest distance it reads more.
    lists: int = 8
    #: Queries answered by brute force, and the share of their neighbours to be found: 0.9 and a margin for the sample and the graph.
    probes: int = 256
    recall: float = 0.95
    degree: int = 24
    #: A query measures all centroids where it would ask the graph for more than one in so many.
    scan: int = 8
    #: Vectors of a cell: at least, unless the table is smaller, and at most.
    block: int = 4_096
    cell: int = 32_768


class Graph:
    """Centroids, with the nearest others of each and a few far ones."""

    def __init__(self, centroids: np.ndarray, degree: int) -> None:
        n = len(centroids)
        self.centroids = centroids
        near = _square(centroids, centroids)
        np.fill_diagonal(near, np.inf)
        k = min(degree, n - 1)
        close = np.argpartition(near, k - 1, 1)[:, :k] if k > 0 else np.zeros((n, 0), int)
        far = np.random.default_rng(7).integers(0, n, (n, 4))
        self.next = np.concatenate([close, far], 1)
        self.entries = np.unique(np.linspace(0, n - 1, min(n, 32)).astype(int))

    def search(self, queries: np.ndarray, width: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and squared distances of about the ``width`` nearest centroids per query, nearest first."""
        beam = max(beam, width)
        q, n = len(queries), len(self.centroids)
        rows = np.arange(q)
        found = np.tile(self.entries, (q, 1))
        away = _square(queries, self.centroids[self.entries])
        seen = np.zeros((q, n), bool)
        seen[:, self.entries] = True
        done = np.zeros(found.shape, bool)
        while True:
            cost = np.where(done, np.inf, away)
            best = cost.argmin(1)
            active = np.flatnonzero(np.isfinite(cost[rows, best]))
            if not len(active):
                break
            done[active, best[active]] = True
            around = self.next[found[active, best[active]]]
            fresh = ~seen[active[:, None], around]
            seen[active[:, None], around] = True
            distance = ((self.centroids[around] - queries[active][:, None]) ** 2).sum(2)
            distance[~fresh] = np.inf
            more = np.full((q, around.shape[1]), np.inf)
            more_ids = np.zeros((q, around.shape[1]), int)
            more[active], more_ids[active] = distance, around
            away, found = np.concatenate([away, more], 1), np.concatenate([found, more_ids], 1)
            done = np.concatenate([done, ~np.isfinite(more)], 1)
            if away.shape[1] > beam:
                keep = np.argpartition(away, beam - 1, 1)[:, :beam]
                away, found, done = (np.take_along_axis(x, keep, 1) for x in (away, found, done))
        order = np.argsort(away, 1, kind="stable")[:, :width]
        return np.take_along_axis(found, order, 1), np.take_along_axis(away, order, 1)


def _square(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1), 0)


def balanced_centroids(sample: np.ndarray, count: int) -> np.ndarray:
    """Means of ``count`` (a power of two) parts of the sample that differ in size by little."""
    rng = np.random.default_rng(11)
    parts = [sample]
    while len(parts) < count and all(len(p) > 1 for p in parts):
        halves = []
        for part in parts:
            a, b = part[rng.choice(len(part), 2, replace=False)]
            for _ in range(6):
                side = part @ (a - b)
                order = np.argsort(side, kind="stable")
                low, high = part[order[: len(part) // 2]], part[order[len(part) // 2 :]]
                b, a = low.mean(0), high.mean(0)
            halves += [low, high]
        parts = halves
    return np.stack([p.mean(0) for p in parts])


def _lengthened(vectors: np.ndarray, longest: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(longest**2 - (vectors**2).sum(1), 0))
    return np.concatenate([vectors, rest[:, None]], 1)


def _vectors(column: pa.Array, rows: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, -1)


def _directions(queries: np.ndarray, longest: float) -> np.ndarray:
    """Queries beside lengthened vectors and as long as these, which does not change the order of products."""
    queries = queries * (longest / np.sqrt((queries**2).sum(1, keepdims=True)))
    return np.concatenate([queries, np.zeros((len(queries), 1))], 1)


def _calibrated(used: DataFrame, postings: DataFrame, centroids: np.ndarray, k: int, longest: float, settings: Settings) -> tuple[float, int, int, np.ndarray]:
    """Ratio of (squared) distances up to which lists are read, the most lists that a query had within it, copies to keep, and
    the rows of each list with these copies.

    The neighbours of some queries are found by brute force; each lies in a list at some ratio to
    the nearest list of its query. The cheapest pair that finds the wanted share of them counts.
    No queries give ratio 0.
    """
    probes = used.where("asks").orderBy(F.xxhash64("vec_id"), "vec_id").limit(settings.probes).select("vec_id", "v").toArrow()
    if not len(probes):
        return 0, 0, 0, np.zeros(0)
    names, queries = probes["vec_id"].to_numpy(), _vectors(probes["v"].combine_chunks(), len(probes))

    def score(batch: pa.RecordBatch) -> dict:
        ids = batch.column("vec_id").to_numpy()
        products = queries @ _vectors(batch.column("v"), len(ids)).T
        products[names[:, None] == ids] = -np.inf
        top = np.argpartition(-products, k - 1, 1)[:, :k] if len(ids) > k else np.tile(np.arange(len(ids)), (len(names), 1))
        probe = np.repeat(np.arange(len(names)), top.shape[1])
        return {"probe": probe.tolist(), "vec_id": ids[top.ravel()].tolist(), "score": products[probe, top.ravel()].tolist()}

    best = map_batches(used.select("vec_id", "v"), score, "probe int, vec_id long, score double").where("score > double('-inf')")
    best = best.withColumn("n", F.expr("row_number() OVER (PARTITION BY probe ORDER BY score DESC, vec_id)")).where(F.col("n") <= k)
    best = best.select("probe", "vec_id")  # at most k rows per probe
    places = postings.select("vec_id", "nth", "list").join(F.broadcast(best), "vec_id").toArrow()
    rows = postings.groupBy("list", "nth").count().toArrow()
    per_copy = np.zeros((settings.copies, len(centroids)))
    per_copy[rows["nth"].to_numpy(), rows["list"].to_numpy()] = rows["count"].to_numpy()
    sizes = per_copy.cumsum(0)
    if not len(places):
        return 1.0, 1, 1, sizes[0]
    away = _square(_directions(queries, longest), centroids)
    ratio = away / np.maximum(away.min(1, keepdims=True), 1e-12 * longest**2)
    order = away.argsort(1, kind="stable").argsort(1)
    probe, nth = places["probe"].to_numpy(), places["nth"].to_numpy()
    place = ratio[probe, places["list"].to_numpy()]
    pair, which = np.unique(np.stack([probe, places["vec_id"].to_numpy()]), axis=1, return_inverse=True)
    choices = []
    for c in range(settings.copies):
        needed = np.full(pair.shape[1], np.inf)
        np.minimum.at(needed, which.ravel()[nth <= c], place[nth <= c])
        wanted = float(np.sort(needed)[int(np.ceil(settings.recall * len(needed))) - 1])
        read = (sizes[c][None] * ((ratio <= wanted) | (order < settings.lists))).sum(1).mean()
        choices.append((read, c, wanted))
    _, c, wanted = min(choices)
    return wanted, int((ratio <= wanted).sum(1).max()), c + 1, sizes[c]


def _cells(sizes: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """First cell and number of cells of each list: lists that follow each other share one, as far as they fit."""
    room = min(max(settings.block, int(sizes.sum()) // 64), settings.cell)
    first, blocks, cell, taken = np.zeros(len(sizes), int), np.ones(len(sizes), int), 0, 0
    for i, size in enumerate(sizes.astype(int)):
        if taken and taken + size > room:
            cell, taken = cell + 1, 0
        first[i], blocks[i] = cell, max(1, -(-size // room))
        taken += size
        if blocks[i] > 1:
            cell, taken = cell + blocks[i], 0
    return first, blocks


def _best(packed: tuple, centroids: np.ndarray, names: np.ndarray, queries: np.ndarray, far: np.ndarray, k: int, copies: int, longest: float) -> list:
    """The ``k`` largest products of each query in the lists of a cell that are as near as ``far``."""
    lists, ids, vectors = packed
    here, starts = np.unique(lists, return_index=True)
    wanted = _square(_directions(queries, longest), centroids[here]) <= far[:, None]
    rough = np.full((len(queries), len(ids)), -np.inf)
    for n, (low, high) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
        who = np.flatnonzero(wanted[:, n])
        rough[who, low:high] = queries[who] @ vectors[low:high].T
    rough[names[:, None] == ids] = -np.inf
    most = min(k * copies, len(ids))  # a vector may be in several lists of the cell
    floors = np.partition(rough, len(ids) - most, 1)[:, len(ids) - most]
    slack = 1e-9 * np.sqrt((queries**2).sum(1) * (vectors**2).sum(1).max())
    out = []
    for q, name in enumerate(names):
        top = np.flatnonzero((rough[q] >= floors[q] - slack[q]) & (rough[q] > -np.inf))
        top = top[np.unique(ids[top], return_index=True)[1]]
        exact = (vectors[top] * queries[q]).sum(1)  # row by row, so equal vectors score the same
        order = np.lexsort((ids[top], -exact))[:k]
        out.append((np.full(len(order), name), ids[top][order], exact[order]))
    return out


def nearest(table: DataFrame, is_query, k: int, vec_id: str = "vec_id", vector: str = "embedding", settings: Settings = Settings()) -> DataFrame:
    """``query_id, rank, vec_id, score``: about the ``k`` largest inner products of each query row.

    Rows where ``is_query`` holds are the queries; every other row is a candidate. Vectors that
    are null, zero or have null or non-finite components take no part. Scores are inner products
    of the given vectors in double precision; ties go to the smaller id, a null id coming last. Queries of one
    id have a list each, and rows of a query's id other than itself are candidates. Fewer candidates give
    fewer rows, an empty table none. Vectors must have one length. Of the true neighbours, about
    ``settings.recall`` are found, as measured on some of the queries before the lists are read.
    """
    spark = table.sparkSession
    used = table.where(usable(vector)).where(F.exists(vector, lambda x: x != 0))
    used = used.select(F.col(vec_id).cast("long").alias("name"), F.transform(vector, lambda x: x.cast("double")).alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    used = with_row_keys(used, "name", "vec_id")
    total, longest = used.agg(F.count(F.lit(1)), F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)))).first()
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    longest *= 1 + 1e-12
    share = int(min(1.0, 0.97 * settings.sample / total) * (1 << 30))
    sample = used.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) <= share).limit(settings.sample).select("v").toArrow()
    sample = _vectors(sample["v"].combine_chunks(), len(sample)) if len(sample) else np.zeros((0, 0))
    if not len(sample):
        sample = _vectors(used.limit(1).select("v").toArrow()["v"].combine_chunks(), 1)
    count = 1 << max(0, round(np.log2(max(1, min(total / settings.list_size, settings.centroids)))))
    graph = spark.sparkContext.broadcast(Graph(balanced_centroids(_lengthened(sample, longest), count), settings.degree))

    def assign(batch: pa.RecordBatch) -> dict:
        vectors = _lengthened(_vectors(batch.column("v"), batch.num_rows), longest)
        centroids = graph.value.centroids
        near, away = graph.value.search(vectors, 2 * settings.copies, 2 * settings.copies + 16)
        lists = []
        for ids, distance in zip(near, away, strict=True):
            chosen = [ids[0]]
            for c, d in zip(ids[1:], distance[1:], strict=True):
                if not np.isfinite(d) or d > settings.closure * distance[0] or len(chosen) == settings.copies:
                    break
                if all(((centroids[c] - centroids[o]) ** 2).sum() > d for o in chosen):
                    chosen.append(c)
            lists.append(chosen)
        return {"vec_id": batch.column("vec_id"), "v": batch.column("v"), "lists": lists}

    schema = "vec_id long, v array<double>, lists array<int>"
    postings = staged(map_batches(used.select("vec_id", "v"), assign, schema).select("vec_id", "v", F.posexplode("lists").alias("nth", "list")), "postings")
    ratio, width, copies, sizes = _calibrated(used, postings, graph.value.centroids, k, longest, settings)
    if not ratio:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    first, blocks = _cells(sizes, settings)
    layout = spark.createDataFrame([(i, int(first[i]), int(blocks[i])) for i in range(len(first))], "list int, first int, blocks int")

    def ask(batch: pa.RecordBatch) -> dict:
        """Cells of the lists within the ratio. The graph finds them where they are few beside all; to reach a large
        part of the centroids one by one would cost more than to measure every one."""
        directions, n = _directions(_vectors(batch.column("v"), batch.num_rows), longest), len(graph.value.centroids)
        beam = max(2 * width, settings.lists)
        while True:
            if settings.scan * beam >= n:
                away = _square(directions, graph.value.centroids)
                near = np.argsort(away, 1, kind="stable")
                away = np.take_along_axis(away, near, 1)
            else:
                near, away = graph.value.search(directions, beam, beam + 32)
            least = np.maximum(away[:, 0], 1e-12 * longest**2)
            far = np.maximum(ratio * least, away[:, min(settings.lists, away.shape[1]) - 1]) * (1 + 1e-9)
            if near.shape[1] >= n or (away[:, -1] > far).all():
                break
            beam *= 4
        cells = [np.unique(np.concatenate([np.arange(first[i], first[i] + blocks[i]) for i in row[d <= f]])).tolist() for row, d, f in zip(near, away, far, strict=True)]
        return {"vec_id": batch.column("vec_id"), "v": batch.column("v"), "far": far.tolist(), "cells": cells}

    stored = postings.where(F.col("nth") < copies).join(F.broadcast(layout), "list")  # a row per centroid
    stored = stored.select((F.col("first") + F.pmod(F.xxhash64("vec_id"), F.col("blocks"))).cast("int").alias("cell"), "list", "vec_id", "v", F.lit(0.0).alias("far"))
    asking = map_batches(used.where("asks").select("vec_id", "v"), ask, "vec_id long, v array<double>, far double, cells array<int>")
    asking = asking.select(F.explode("cells").alias("cell"), F.lit(len(first)).alias("list"), "vec_id", "v", "far")
    cells = stored.unionByName(asking).repartition("cell").sortWithinPartitions("cell", "list", "vec_id")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts, packed = None, [], None
        for batch in batches:
            out: list = []
            flat, names = _vectors(batch.column("v"), batch.num_rows), batch.column("vec_id").to_numpy()
            cell, lists, far = (batch.column(c).to_numpy() for c in ("cell", "list", "far"))
            asks = lists == len(first)
            ends = np.flatnonzero((cell[1:] != cell[:-1]) | (asks[1:] != asks[:-1])) + 1
            for low, high in zip([0, *ends], [*ends, len(cell)], strict=True):
                if cell[low] != at:
                    at, parts, packed = cell[low], [], None
                if not asks[low]:
                    parts.append((lists[low:high], names[low:high], flat[low:high]))
                    continue
                if packed is None and parts:
                    packed = tuple(np.concatenate(x) for x in zip(*parts, strict=True))
                for i in range(low, high if packed else low, 128):
                    j = min(high, i + 128)
                    out += _best(packed, graph.value.centroids, names[i:j], flat[i:j], far[i:j], k, copies, longest)
            found = zip(*out, strict=True) if out else ([], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x) if len(x) else [], t) for x, t in zip(found, (pa.int64(), pa.int64(), pa.float64()), strict=True)], ["query_id", "vec_id", "score"])

    found = cells.mapInArrow(read, "query_id long, vec_id long, score double").dropDuplicates(["query_id", "vec_id"])
    ranked = found.withColumn("rank", F.expr("row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)"))
    ranked = ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    return with_ids(ranked, used, "name", "vec_id", "query_id", "vec_id")
