"""Exact top-k by inner product over M-trees.

Each shard of the vectors is a tree of pages. A page entry holds a vector, the covering radius
of its subtree and its distance to the parent entry. For a query q and any x below an entry p,
q.x <= q.p + |q| r(p), and q.p itself is at most q.parent + |q| d(p, parent), so stored
distances rule out entries before their products are computed. The search takes the entry
with the highest bound first, and ends when no bound reaches the k-th score.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomsync.llm.common import with_ids, with_row_keys

PAGE = 64
#: Vectors of one tree, and queries that one task searches a tree for.
TREE = 16_384
QUERIES = 2_048


class Page:
    """Entries of a node: vectors, distances to the parent entry, and below, pages with covering radii or ids."""

    __slots__ = ("vectors", "to_parent", "radii", "below", "ids")

    def __init__(self, vectors, to_parent, radii, below, ids) -> None:
        self.vectors, self.to_parent, self.radii, self.below, self.ids = vectors, to_parent, radii, below, ids


def build(ids: np.ndarray, vectors: np.ndarray, page: int = PAGE) -> Page:
    """Tree over ``vectors``; subtrees are the Voronoi cells of spread-out routing vectors, kept even in size."""
    return _page(ids, vectors, np.zeros(len(ids)), page)


def _page(ids: np.ndarray, vectors: np.ndarray, to_parent: np.ndarray, page: int) -> Page:
    if len(ids) <= page:
        return Page(vectors, to_parent, None, None, ids)
    fan = min(page, -(-len(ids) // page))
    routes = vectors[np.linspace(0, len(ids) - 1, fan).astype(int)]
    routes = np.unique(routes, axis=0)
    square = (vectors * vectors).sum(1)[:, None] - 2 * vectors @ routes.T + (routes * routes).sum(1)
    own = square.argmin(1)
    if len(np.unique(own)) < 2:  # equal vectors, or nearly: pages of the given order
        own = np.arange(len(ids)) * fan // len(ids)
        routes = np.stack([vectors[own == c][0] for c in range(fan)])
    entries, radii, below = [], [], []
    for cell in np.unique(own):
        inside = np.flatnonzero(own == cell)
        away = np.sqrt(((vectors[inside] - routes[cell]) ** 2).sum(1))
        entries.append(routes[cell])
        radii.append(away.max())
        below.append(_page(ids[inside], vectors[inside], away, page))
    entries = np.stack(entries)
    # Distances of the entries to the parent are known only above; the root has none.
    return Page(entries, None, np.array(radii), below, None)


def _link(node: Page, parent: np.ndarray | None) -> None:
    """Store the distances of inner entries to the parent entry."""
    if node.below is not None:
        node.to_parent = None if parent is None else np.sqrt(((node.vectors - parent) ** 2).sum(1))
        for vector, child in zip(node.vectors, node.below, strict=True):
            _link(child, vector)


def search(root: Page, query: np.ndarray, k: int, skip: int | None) -> list[tuple[float, int]]:
    """The ``k`` best ``(score, id)``, best first, ties to the smaller id; ``skip`` is the query's own id."""
    norm = float(np.sqrt(query @ query))
    slack = 1e-9 * (1 + norm)
    best: list[tuple[float, int]] = []  # heap of (score, -id)
    queue: list[tuple[float, int, Page, float | None]] = [(-np.inf, 0, root, None)]
    pushed = 0
    while queue:
        bound, _, node, parent = heapq.heappop(queue)
        floor = best[0][0] if len(best) == k else -np.inf
        if -bound < floor:
            break
        rows = None
        if parent is not None and node.to_parent is not None:
            reach = parent + norm * node.to_parent
            if node.radii is not None:
                reach = reach + norm * node.radii
            rows = np.flatnonzero(reach * (1 + 1e-12) + slack >= floor)
            if not len(rows):
                continue
        products = node.vectors @ query if rows is None else node.vectors[rows] @ query
        rows = np.arange(len(node.vectors)) if rows is None else rows
        if node.below is None:
            good = products >= floor
            for score, name in zip(products[good].tolist(), node.ids[rows[good]].tolist(), strict=True):
                if name == skip:
                    continue
                if len(best) < k:
                    heapq.heappush(best, (score, -name))
                elif (score, -name) > best[0]:
                    heapq.heapreplace(best, (score, -name))
        else:
            bounds = products + norm * node.radii[rows] * (1 + 1e-12) + slack
            for b, p, r in zip(bounds.tolist(), products.tolist(), rows.tolist(), strict=True):
                if b >= floor:
                    pushed += 1
                    heapq.heappush(queue, (-b, pushed, node.below[r], p))
    return [(s, -n) for s, n in sorted(best, reverse=True)]


def usable(vector) -> F.Column:
    """Not null, and no component null, NaN or infinite."""
    return F.coalesce(F.col(vector).isNotNull() & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), F.lit(False))


def quantized(vector: str, factor: int = 1024) -> F.Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * factor).cast("long"))


def top_k(rows: DataFrame, asks, k: int, tree: int = TREE, block: int = QUERIES) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` highest integer inner products per query, exactly.

    ``rows`` have ``vec_id`` and an array of long ``vector``; those where ``asks`` holds are queries. Every row but
    the query's own is a candidate, also one of the same id, and queries of one id have a list each. Ties go
    to the smaller id, a null id coming last. Fewer candidates give fewer rows. Trees take
    ``tree`` vectors each and are met by blocks of ``block`` queries; each pair is one task's work,
    and only ``k`` rows per query leave it. Vectors must have one length, and products below 2**53.
    """
    spark = rows.sparkSession
    known = with_row_keys(rows.select(F.col("vec_id").alias("name"), "vector", F.coalesce(asks, F.lit(False)).alias("asks")), "name", "vec_id")
    vectors, asked = known.select("vec_id", "vector"), known.where("asks").select("vec_id", "vector")
    trees = max(1, -(-vectors.count() // tree))
    blocks = max(1, -(-asked.count() // block))
    across = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    stored = vectors.select(F.pmod(F.xxhash64("vec_id"), F.lit(trees)).alias("tree"), across.alias("block"), F.lit(0).alias("asks"), "vec_id", "vector")
    along = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(trees - 1).cast("long")))
    asking = asked.select(along.alias("tree"), F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int").alias("block"), F.lit(1).alias("asks"), "vec_id", "vector")
    spread = spark.sparkContext.defaultParallelism
    cells = stored.unionByName(asking).repartition(max(trees * blocks, spread), "tree", "block").sortWithinPartitions("tree", "block", "asks", "vec_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids, vecs, root = None, [], [], None
        for batch in batches:
            rows: dict = {"query_id": [], "vec_id": [], "score": []}
            flat = batch.column("vector")
            flat = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(batch.num_rows, -1)
            cell = list(zip(batch.column("tree").to_pylist(), batch.column("block").to_pylist(), strict=True))
            for i, (where, asks, name) in enumerate(zip(cell, batch.column("asks").to_pylist(), batch.column("vec_id").to_pylist(), strict=True)):
                if where != at:
                    at, ids, vecs, root = where, [], [], None
                if not asks:
                    ids.append(name)
                    vecs.append(flat[i])
                    continue
                if root is None and ids:
                    root = build(np.array(ids), np.stack(vecs))
                    _link(root, None)
                for score, found in search(root, flat[i], k, name) if root is not None else ():
                    rows["query_id"].append(name)
                    rows["vec_id"].append(found)
                    rows["score"].append(int(score))
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in rows.values()], list(rows))

    found = cells.mapInArrow(run, "query_id long, vec_id long, score long")
    ranked = found.withColumn("rank", F.expr("row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)"))
    ranked = ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    return with_ids(ranked, known, "name", "vec_id", "query_id", "vec_id")
