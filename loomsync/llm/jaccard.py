"""Exact Jaccard join of word shingle sets in metric space, down to connected classes.

Equal sets are one class. Two sets of similarity ``t`` or more share one of the first
``n - ceil(t n) + 1`` shingles of each in any common order, so classes that share such a
shingle form the root regions. Shingles come in the order of how many classes hold them, so
a class meets others only if too few of its shingles are its own; this keeps chance companions
apart at any size of the table. Classes of a region that may be linked, as far as the
bounds from those first shingles tell, are one cluster, over all regions.

Within a cluster the join is metric (Jaccard distance is a metric): pivots create Voronoi
regions; a document also goes to each region whose pivot is at most twice the radius farther
than its own, by the triangle inequality; regions are joined recursively. In a leaf, a
document is compared with those whose distances to the pivots differ by at most the radius,
until all that are left belong to the largest class. No pairs leave a task, only classes.

A cluster too large for one task is joined in blocks that share pivots; what is then outside
its largest class meets all blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomsync.llm.common import map_batches, squeezed
from loomsync.llm.components import components
from loomsync.llm.words import mix, shingle_sets
from loomsync.session import staged

THRESHOLD = Fraction(3, 4)
SHINGLE = 5
#: Documents that one task joins at once; leaf of the recursion and pivots per region.
CLUSTER = 6000
BLOCK = 1500
SHARED_PIVOTS = 48
LEAF = 48
PIVOTS = 6
#: A shingle is common when one document in so many holds it; at most this many times the mean set size are.
COMMON = 2000
#: Common shingles are looked for among those that so many documents of one batch hold.
LOCAL = 3
#: Prefix shingles in one bucket of the root regions; shingles in one bucket of the count of classes.
BUCKET = 1 << 21
CELL = 1 << 22
#: Parts in which the shingles of a bucket are sorted.
PARTS = 8
#: Rows of 64 bits that tell which documents are in clusters; bounds their broadcast.
WORDS = 1 << 19
#: Place of the common shingles in the order of all.
COMMON_LEVEL = 63


def _set_id(row: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(row.tobytes())).view(np.int64))


def _bytes(column: pa.Array) -> list[bytes]:
    return [b"" if v is None else v.encode() for v in column.to_pylist()]


class Region:
    """Sets of one cluster, with the classes found so far."""

    def __init__(self, sets: list[np.ndarray], threshold: Fraction) -> None:
        self.threshold = threshold
        self.radius = 1 - float(threshold)
        self.sizes = np.array([len(s) for s in sets])
        self.offsets = np.concatenate(([0], np.cumsum(self.sizes)))
        _, self.tokens = np.unique(np.concatenate(sets), return_inverse=True)
        self.marks = np.zeros(int(self.tokens.max()) + 1, bool)
        self.label = np.arange(len(sets))

    def shared(self, pivot: int, others: np.ndarray) -> np.ndarray:
        """Size of the intersection of ``pivot`` with each of ``others``."""
        own = self.tokens[self.offsets[pivot] : self.offsets[pivot + 1]]
        self.marks[own] = True
        sizes = self.sizes[others]
        ends = np.cumsum(sizes)
        flat = np.arange(ends[-1]) + np.repeat(self.offsets[others] - ends + sizes, sizes)
        found = np.add.reduceat(self.marks[self.tokens[flat]].astype(np.int64), ends - sizes)
        self.marks[own] = False
        return found

    def below(self, others: np.ndarray, limits: np.ndarray) -> np.ndarray:
        """How many members of each of ``others`` come before its limit in the order of the shingles."""
        sizes = self.sizes[others]
        ends = np.cumsum(sizes)
        flat = np.arange(ends[-1]) + np.repeat(self.offsets[others] - ends + sizes, sizes)
        return np.add.reduceat((self.tokens[flat] < np.repeat(limits, sizes)).astype(np.int64), ends - sizes)

    def distances(self, pivot: int, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distance of ``pivot`` to each of ``others``, and which of them are linked with it, exactly."""
        shared = self.shared(pivot, others)
        union = self.sizes[others] + self.sizes[pivot] - shared
        return 1 - shared / union, shared * self.threshold.denominator >= union * self.threshold.numerator

    def link(self, pivot: int, others: np.ndarray) -> None:
        merged = np.unique(np.append(self.label[others], self.label[pivot]))
        if len(merged) > 1:
            self.label[np.isin(self.label, merged)] = merged[0]

    def join(self, members: np.ndarray) -> None:
        """Merge the classes of all linked ``members``."""
        if len(members) < 2 or (self.label[members] == self.label[members[0]]).all():
            return
        pivots = members[np.linspace(0, len(members) - 1, min(PIVOTS, len(members))).astype(int)] if len(members) > LEAF else members[:1]
        table = np.empty((len(pivots), len(members)))
        for i, pivot in enumerate(pivots.tolist()):
            table[i], linked = self.distances(pivot, members)
            self.link(pivot, members[linked])
        if len(members) > LEAF:
            slack = 1e-9
            cells = table <= table.min(0) + 2 * self.radius + slack
            own = np.argmin(table, 0)
            cells[own, np.arange(len(members))] = True
            if cells.sum() <= 1.5 * len(members) and cells.sum(1).max() < len(members):
                for cell in cells:
                    self.join(members[cell])
                return
        self._leaf(members, table, np.isin(members, pivots))

    def _leaf(self, members: np.ndarray, table: np.ndarray, tested: np.ndarray) -> None:
        while True:
            labels = self.label[members]
            values, counts = np.unique(labels, return_counts=True)
            left = np.flatnonzero((labels != values[np.argmax(counts)]) & ~tested)
            if not len(left):
                return
            at = left[0]
            tested[at] = True
            near = (np.abs(table - table[:, at : at + 1]) <= self.radius + 1e-9).all(0) & (labels != labels[at])
            if near.any():
                _, linked = self.distances(int(members[at]), members[near])
                self.link(int(members[at]), members[near][linked])


def _signatures(docs: DataFrame, doc_id: str, text: str, threshold: Fraction, size: int) -> DataFrame:
    """Class and set size of every document, and per batch the shingles that several of its documents hold."""

    def scan(batch: pa.RecordBatch) -> dict:
        sets = shingle_sets(_bytes(batch.column(text)), size)
        tokens, counts = np.unique(np.concatenate([*sets, np.empty(0, np.uint64)]), return_counts=True)
        often = counts >= LOCAL
        n, m = len(sets), int(often.sum())
        return {
            "doc_id": pa.concat_arrays([batch.column(doc_id).cast(pa.int64()), pa.nulls(m, pa.int64())]),
            "cid": np.concatenate([np.array([_set_id(s) for s in sets], np.int64), tokens[often].view(np.int64)]),
            "n": np.concatenate([np.array([len(s) for s in sets], np.int64), counts[often]]),
            "is_doc": np.arange(n + m) < n,
        }

    return staged(map_batches(docs.select(doc_id, text), scan, "doc_id long, cid long, n long, is_doc boolean"), "signatures")


def _shingles(docs: DataFrame, text: str, common, buckets: int, threshold: Fraction, size: int) -> DataFrame:
    """Per batch and bucket the shingles of its classes: 32 bits each, with the classes, set sizes and counts they belong to.

    Common shingles come last in every set; of those only as many are sent as may be among the
    first that a set needs, in buckets of their own (below zero).
    """

    def scan(batch: pa.RecordBatch) -> dict:
        last = common.value
        keys, codes, cids, sizes, rares = [], [], [], [], []
        seen = set()
        for row in shingle_sets(_bytes(batch.column(text)), size):
            cid = _set_id(row)
            if not len(row) or cid in seen:
                continue
            seen.add(cid)
            bucket = (row >> np.uint64(32)) % np.uint64(buckets)
            token = row.astype(np.uint32)
            often = last[np.minimum(np.searchsorted(last, row), len(last) - 1)] == row if len(last) else np.zeros(len(row), bool)
            rare = int((~often).sum())
            tail = np.flatnonzero(often)
            tail = tail[np.lexsort((bucket[tail], token[tail]))][: max(0, _prefix(len(row), threshold) - rare)]
            keys.append(np.concatenate([token[~often], token[tail]]))
            codes.append(np.concatenate([bucket[~often], bucket[tail] + np.uint64(buckets)]))
            cids.append(cid)
            sizes.append(len(row))
            rares.append(rare)
        made: dict = {"bucket": [], "tokens": [], "cids": [], "sizes": [], "rares": [], "counts": []}
        if not keys:
            return made
        key, code, owner = np.concatenate(keys), np.concatenate(codes), np.repeat(np.arange(len(keys)), [len(k) for k in keys])
        order = np.argsort(code.astype(np.uint16) if 2 * buckets < 1 << 16 else code, kind="stable")
        key, code, owner = key[order], code[order].astype(np.int64), owner[order]
        cid, n, rare = np.array(cids, np.int64), np.array(sizes, np.uint32), np.array(rares, np.uint32)
        names, first = np.unique(code, return_index=True)
        made["bucket"] = np.where(names < buckets, names, buckets - 1 - names)
        for a, b in zip(first.tolist(), [*first[1:].tolist(), len(code)], strict=True):
            rows, counts = np.unique(owner[a:b], return_counts=True)  # tokens stay in the order of their documents
            for name, v in (("tokens", key[a:b]), ("cids", cid[rows]), ("sizes", n[rows]), ("rares", rare[rows]), ("counts", counts.astype(np.uint32))):
                made[name].append(v.tobytes())
        return made

    return map_batches(docs.select(text), scan, "bucket long, tokens binary, cids binary, sizes binary, rares binary, counts binary")


def _prefix(n: int, threshold: Fraction) -> int:
    """Of how many first shingles a set of ``n`` shares one with every set it is linked with."""
    return n - -(-threshold.numerator * n // threshold.denominator) + 1


def _parts(token: np.ndarray) -> Iterator[np.ndarray]:
    """Places of the 32-bit hashes ``token`` by ``PARTS`` ranges of their values, which bounds the memory of sorting them."""
    width = (1 << 32) // PARTS
    for low in range(0, 1 << 32, width):
        yield np.flatnonzero((token >= low) & (token <= low + width - 1))


def _levels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``cid, n, rare, bucket, marked`` rows: the shingles of a bucket that several classes hold.

    Each takes five bytes, the last one the order of magnitude of the number of classes.
    """
    held: list[tuple] = []
    at = None

    def close() -> pa.RecordBatch:
        token, cid, n, rare, count = (np.frombuffer(b"".join(r[i] for r in held), t) for i, t in enumerate((np.uint32, np.int64, np.uint32, np.uint32, np.uint32), 1))
        held.clear()
        new = np.zeros(len(cid), bool)
        new[np.unique(cid, return_index=True)[1]] = True  # a class that several batches sent counts once
        token, cid, n, rare, count = token[np.repeat(new, count)], cid[new], n[new], rare[new], count[new]
        if at >= 0:
            level = np.empty(len(token), np.uint8)
            for part in _parts(token):
                _, inverse, classes = np.unique(token[part], return_inverse=True, return_counts=True)
                level[part] = np.minimum(np.frexp(classes)[1] - 1, COMMON_LEVEL - 1).astype(np.uint8)[inverse]
        else:
            level = np.full(len(token), COMMON_LEVEL, np.uint8)
        shared = level > 0
        marked = np.empty((int(shared.sum()), 5), np.uint8)
        marked[:, :4] = token[shared].view(np.uint8).reshape(-1, 4)
        marked[:, 4] = level[shared]
        owner, held_by = np.unique(np.repeat(np.arange(len(cid)), count)[shared], return_counts=True)
        ends = np.concatenate(([0], np.cumsum(5 * held_by))).astype(np.int32)
        rows = pa.Array.from_buffers(pa.binary(), len(owner), [None, pa.py_buffer(ends), pa.py_buffer(marked.tobytes())])
        columns = [pa.array(cid[owner]), pa.array(n[owner].astype(np.int64)), pa.array(rare[owner].astype(np.int64)), pa.array(np.full(len(owner), at, np.int64)), rows]
        return pa.RecordBatch.from_arrays(columns, ["cid", "n", "rare", "bucket", "marked"])

    for batch in batches:
        for row in zip(*(batch.column(batch.schema.get_field_index(x)).to_pylist() for x in ("bucket", "tokens", "cids", "sizes", "rares", "counts")), strict=True):
            if row[0] != at and held:
                yield close()
            at = row[0]
            held.append(row)
    if held:
        yield close()


def _first(batches: Iterator[pa.RecordBatch], threshold: Fraction) -> Iterator[pa.RecordBatch]:
    """``cid, n, alone, sketch`` of every class that may be linked; rows come in the order of the classes.

    The order of the shingles is that of the magnitude of their number of classes, then of their
    hash; those ``alone`` in one class come first and are only counted. The sketch is what is
    left of the first shingles.
    """
    made: list[tuple] = []
    held: list[tuple] = []

    def close() -> None:
        cid, n, rare = held[0][:3]
        marked = [np.frombuffer(r[4], np.uint8).reshape(-1, 5) for r in held]
        bucket = np.repeat(np.array([r[3] for r in held], np.int64), [len(m) for m in marked])
        held.clear()
        rows = np.concatenate(marked)
        level = rows[:, 4].astype(np.uint64)
        alone = rare - int((bucket >= 0).sum())
        room = _prefix(n, threshold) - alone
        if room > 0:
            token = np.ascontiguousarray(rows[:, :4]).view(np.uint32).ravel().astype(np.uint64)
            place = np.where(bucket < 0, -1 - bucket, bucket).astype(np.uint64)
            key = np.sort(level << np.uint64(58) | token << np.uint64(26) | place & np.uint64((1 << 26) - 1))
            made.append((cid, n, alone, key[:room].tobytes()))

    def out() -> pa.RecordBatch:
        cid, n, alone, sketch = zip(*made, strict=True)
        made.clear()
        return pa.RecordBatch.from_arrays([pa.array(cid, pa.int64()), pa.array(n, pa.int64()), pa.array(alone, pa.int64()), pa.array(sketch, pa.binary())], ["cid", "n", "alone", "sketch"])

    for batch in batches:
        for row in zip(*(batch.column(batch.schema.get_field_index(x)).to_pylist() for x in ("cid", "n", "rare", "bucket", "marked")), strict=True):
            if held and held[0][0] != row[0]:
                close()
                if len(made) >= 1000:
                    yield out()
            held.append(row)
    if held:
        close()
    if made:
        yield out()


def _packed(sketches: DataFrame, buckets: int, threshold: Fraction) -> DataFrame:
    """The shingles of all sketches, per batch and bucket: low bits, with the classes, sizes and counts they belong to.

    The last bit tells whether the place in the sketch also serves links with larger sets.
    """
    p, q = threshold.numerator, threshold.denominator

    def scan(batch: pa.RecordBatch) -> dict:
        rows = [np.frombuffer(s, np.uint64) for s in batch.column("sketch").to_pylist()]
        key, owner = np.concatenate(rows), np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        cid, n, alone = (batch.column(x).to_numpy() for x in ("cid", "n", "alone"))
        key = mix(key)
        bucket = (key >> np.uint64(32)) % np.uint64(buckets)
        lengths = np.array([len(r) for r in rows])
        place = np.arange(len(key)) - np.repeat(np.cumsum(lengths) - lengths - alone, lengths)
        early = place <= (n - -(-2 * p * n // (p + q)))[owner]
        key = key & np.uint64(0xFFFFFFFE) | early.astype(np.uint64)
        order = np.argsort(bucket.astype(np.uint16) if buckets < 1 << 16 else bucket, kind="stable")
        key, owner, bucket = key[order].astype(np.uint32), owner[order], bucket[order].astype(np.int64)
        names, first = np.unique(bucket, return_index=True)
        made: dict = {"bucket": names, "tokens": [], "cids": [], "sizes": [], "counts": []}
        for a, b in zip(first.tolist(), [*first[1:].tolist(), len(bucket)], strict=True):
            docs, counts = np.unique(owner[a:b], return_counts=True)  # rows stay in the order of their documents
            for name, v in (("tokens", key[a:b]), ("cids", cid[docs]), ("sizes", n[docs].astype(np.uint32)), ("counts", counts.astype(np.uint32))):
                made[name].append(v.tobytes())
        return made

    return map_batches(sketches, scan, "bucket long, tokens binary, cids binary, sizes binary, counts binary")


def _fitting(n: np.ndarray, early: np.ndarray, threshold: Fraction) -> np.ndarray:
    """Which members of a region, sorted by size, have one there that they may be linked with.

    The smaller of two linked sets holds a shared shingle early in its sketch.
    """
    kept = np.zeros(len(n), bool)
    reach = np.searchsorted(n, n * threshold.denominator // threshold.numerator, side="right")
    for i in np.flatnonzero(early).tolist():
        if reach[i] > i + 1:
            kept[i : reach[i]] = True
        if i and n[i - 1] == n[i]:
            kept[np.searchsorted(n, n[i]) : reach[i]] = True
    return kept


def _regions(batches: Iterator[pa.RecordBatch], threshold: Fraction) -> Iterator[pa.RecordBatch]:
    """``rid, cid`` rows: each distinct set of classes of fitting sizes that share a prefix shingle."""
    held: list[tuple] = []
    at = None

    def regions(token: np.ndarray, cid: np.ndarray, n: np.ndarray) -> Iterator[np.ndarray]:
        early, token = token & 1 > 0, token >> 1
        order = np.lexsort((~early, cid, n, token))
        token, cid, n, early = token[order], cid[order], n[order].astype(np.int64), early[order]
        keep = np.ones(len(token), bool)
        keep[1:] = (token[1:] != token[:-1]) | (cid[1:] != cid[:-1])
        token, cid, n, early = token[keep], cid[keep], n[keep], early[keep]
        # Sorted by size, no link crosses a place where the size grows by more than the threshold allows.
        opens = np.ones(len(token), bool)
        opens[1:] = (token[1:] != token[:-1]) | (n[:-1] * threshold.denominator < n[1:] * threshold.numerator)
        first = np.flatnonzero(opens)
        count = np.diff(np.append(first, len(token)))
        served = (count > 2) | (count == 2) & (early[first] | early[np.minimum(first + 1, len(n) - 1)] & (n[first] == n[np.minimum(first + 1, len(n) - 1)]))
        for a, m in zip(first[served].tolist(), count[served].tolist(), strict=True):
            members = cid[a : a + m] if m == 2 else cid[a : a + m][_fitting(n[a : a + m], early[a : a + m], threshold)]
            if len(members) > 1:
                yield members

    def close() -> Iterator[pa.RecordBatch]:
        token, cid, n, count = (np.frombuffer(b"".join(r[i] for r in held), t) for i, t in ((1, np.uint32), (2, np.int64), (3, np.uint32), (4, np.uint32)))
        held.clear()
        owner = np.repeat(np.arange(len(cid), dtype=np.int32), count)
        known: dict[int, np.ndarray] = {}
        for part in _parts(token):
            for members in regions(token[part], cid[owner[part]], n[owner[part]]):
                known.setdefault(int(np.uint64(xxhash.xxh3_64_intdigest(members.tobytes())).view(np.int64)), members)
        if known:
            rid = np.repeat(np.array(list(known), np.int64), [len(m) for m in known.values()])
            yield pa.RecordBatch.from_arrays([pa.array(rid), pa.array(np.concatenate(list(known.values())))], ["rid", "cid"])

    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            if row[0] != at and held:
                yield from close()
            at = row[0]
            held.append(row)
    if held:
        yield from close()


def _companions(batches: Iterator[pa.RecordBatch], threshold: Fraction) -> Iterator[pa.RecordBatch]:
    """Edges ``a, b`` that connect the classes of each region which may be linked, as far as the sketches tell.

    Beyond the end of the sketch that ends first, two sets share at most what the smaller of
    them has left there.
    """
    group: dict[int, tuple] = {}
    at = None

    def close() -> tuple[np.ndarray, np.ndarray]:
        cids = np.array(list(group), np.int64)
        n, alone = (np.array([r[i] for r in group.values()]) for i in (0, 1))
        left = n - alone  # shingles of one class are never shared and come first
        rows = [np.frombuffer(r[2], np.uint32) for r in group.values()]
        group.clear()
        if len(cids) < 2:
            return cids[:0], cids[:0]
        sketches = Region(rows, threshold)
        last = sketches.tokens[sketches.offsets[1:] - 1]
        p, q = threshold.numerator, threshold.denominator
        label = np.arange(len(cids))
        for i in range(len(cids) - 1):
            others = np.flatnonzero(label != label[i])
            others = others[others > i]
            if not len(others):
                continue
            fitting = np.minimum(n[i], n[others]) * q >= p * np.maximum(n[i], n[others])
            others = others[fitting]
            if not len(others):
                continue
            # Up to where the first of the two sketches ends, both are known: a set holds
            # beyond it what its sketch does not hold before it.
            first = np.minimum(last[i], last[others])
            own = left[i] - np.searchsorted(sketches.tokens[sketches.offsets[i] : sketches.offsets[i + 1]], first)
            theirs = left[others] - sketches.below(others, first)
            fits = (sketches.shared(i, others) + np.minimum(own, theirs)) * (p + q) >= p * (n[i] + n[others])
            merged = np.append(label[others[fits]], label[i])
            label[np.isin(label, merged)] = merged.min()
        moved = label != np.arange(len(cids))
        return cids[moved], cids[label[moved]]

    for batch in batches:
        a, b = [], []
        for rid, cid, *row in zip(*(batch.column(batch.schema.get_field_index(x)).to_pylist() for x in ("rid", "cid", "n", "alone", "sketch")), strict=True):
            if rid != at and group:
                for out, made in zip((a, b), close(), strict=True):
                    out.append(made)
            at = rid
            group.setdefault(cid, row)
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])
    if group:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in close()], ["a", "b"])


def _grouped(batches: Iterator[pa.RecordBatch], threshold: Fraction, size: int, links: bool) -> Iterator[pa.RecordBatch]:
    """Join the documents of each group; rows come in the order of their groups.

    Gives each class its smallest document (``cid, component``), or with ``links`` the
    edges between each class and the smallest class id it is connected with.
    """
    group: list[tuple] = []

    def close() -> pa.RecordBatch:
        sets = shingle_sets([zstandard.decompress(r[3]) for r in group], size)
        kept = {}
        for (_, cid, doc, _), row in zip(group, sets, strict=True):
            if _set_id(row) == cid and len(row):  # another text may carry the same doc_id
                kept.setdefault(cid, (doc, row))
        group.clear()
        cids = np.array(list(kept), np.int64)
        docs = [d for d, _ in kept.values()]
        if not kept:
            return pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 2, ["cid", "component"])
        region = Region([s for _, s in kept.values()], threshold)
        region.join(np.arange(len(cids)))
        best: dict[int, int] = {}
        for label, value in zip(region.label.tolist(), cids.tolist() if links else docs, strict=True):
            best[label] = value if label not in best or (value is not None and (best[label] is None or value < best[label])) else best[label]
        return pa.RecordBatch.from_arrays([pa.array(cids), pa.array([best[x] for x in region.label.tolist()], pa.int64())], ["cid", "component"])

    for batch in batches:
        for row in zip(*(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in ("group", "cid", "doc_id", "text")), strict=True):
            if group and group[0][0] != row[0]:
                yield close()
            group.append(row)
    if group:
        yield close()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: Fraction = THRESHOLD, size: int = SHINGLE, cluster: int = CLUSTER, block: int = BLOCK) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document (row).

    The component is the smallest ``doc_id`` reachable over links. Null, empty and blank
    texts have no shingles and are their own component; a null ``doc_id`` is never the
    smallest one unless its class has no other. Rows repeated or of equal sets are linked.
    Other columns are not read. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    seen = _signatures(docs, "doc_id", "text", threshold, size)
    classes = seen.where("is_doc and n > 0").groupBy("cid").agg(F.min("doc_id").alias("doc_id"))
    total = seen.where("is_doc").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    often = seen.where("not is_doc").groupBy("cid").agg(F.sum("n").alias("n")).where(F.col("n") >= max(20, total[0] / COMMON))
    common = np.sort(np.array([r[0] for r in often.select("cid").collect()], np.int64).view(np.uint64))
    shared = spark.sparkContext.broadcast(common)
    buckets = max(12, int(total[1] * float(1 - threshold)) // BUCKET)
    cells = max(12, int(total[1]) // CELL)
    sent = _shingles(docs, "text", shared, cells, threshold, size).repartition("bucket").sortWithinPartitions("bucket")
    marked = sent.mapInArrow(_levels, "cid long, n long, rare long, bucket long, marked binary")
    marked = marked.repartition("cid").sortWithinPartitions("cid")
    sketches = staged(marked.mapInArrow(lambda batches: _first(batches, threshold), "cid long, n long, alone long, sketch binary"), "sketches")
    packed = _packed(sketches, buckets, threshold).repartition("bucket").sortWithinPartitions("bucket")
    regions = packed.mapInArrow(lambda batches: _regions(batches, threshold), "rid long, cid long").distinct()
    short = map_batches(sketches, lambda batch: {"cid": batch.column("cid"), "n": batch.column("n"), "alone": batch.column("alone"), "sketch": [(np.frombuffer(x, np.uint64) >> np.uint64(32)).astype(np.uint32).tobytes() for x in batch.column("sketch").to_pylist()]}, "cid long, n long, alone long, sketch binary")
    regions = staged(regions, "regions")
    rows = regions.join(short, "cid").repartition("rid").sortWithinPartitions("rid", "cid")
    edges = rows.select("rid", "cid", "n", "alone", "sketch").mapInArrow(lambda batches: _companions(batches, threshold), "a long, b long")
    clusters = components(edges).select(F.col("node").alias("cid"), F.col("label").alias("group"))
    clusters = staged(clusters.join(classes, "cid"), "clusters")
    counts = clusters.groupBy("group").agg(F.count(F.lit(1)).alias("members"))
    large = counts.where(F.col("members") > cluster).select("group")
    texts = squeezed(_likely(docs.where("text is not null"), clusters))
    small = clusters.join(large, "group", "left_anti").select("group", "cid", "doc_id")
    found = _joined(small, texts, threshold, size, links=False)
    if large.limit(1).count():
        found = found.unionByName(_large(clusters.join(large, "group", "left_semi"), texts, threshold, size, block))
    found = classes.join(found, "cid", "left").select("cid", F.coalesce("component", "doc_id").alias("component"))
    rows = seen.where("is_doc").select("doc_id", "n", F.when(F.col("n") > 0, F.col("cid")).alias("cid"))
    rows = rows.join(found, "cid", "left")
    return rows.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def _likely(docs: DataFrame, members: DataFrame) -> DataFrame:
    """``docs`` without most of those whose ``doc_id`` is not among ``members``, so that their texts are not shuffled.

    A hashed bit tells; all bits are at most ``WORDS`` rows, whatever the size of ``members``.
    """
    place = F.xxhash64("doc_id")
    word, bit = F.pmod(place, F.lit(WORDS)).alias("_word"), F.expr("shiftleft(1L, cast(pmod(shiftright(xxhash64(doc_id), 32), 64L) as int))")
    bits = members.select(word, bit.alias("_bit")).groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    found = docs.withColumn("_word", word).join(F.broadcast(bits), "_word")
    return found.where(F.col("_bits").bitwiseAND(bit) != 0).select(docs.columns)


def _joined(groups: DataFrame, texts: DataFrame, threshold: Fraction, size: int, links: bool) -> DataFrame:
    """Classes of each group of documents ``group, cid, doc_id``."""
    rows = groups.join(texts.withColumnRenamed("doc_id", "at"), F.col("doc_id").eqNullSafe(F.col("at"))).select("group", "cid", "doc_id", "text")
    rows = rows.repartition("group").sortWithinPartitions("group", "cid")
    return rows.mapInArrow(lambda batches: _grouped(batches, threshold, size, links), "cid long, component long")


def _large(members: DataFrame, texts: DataFrame, threshold: Fraction, size: int, block: int) -> DataFrame:
    """Classes of clusters too large for one task.

    Blocks are joined each with the same pivots of its cluster, which connect them. Then
    every class outside the largest of its cluster meets all blocks, as a link between two
    classes has an end there.
    """
    counts = members.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / block).cast("long").alias("blocks"))
    members = staged(members.join(counts, "group").withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks"))), "members")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block")
    pivots = members.where(F.pmod(F.xxhash64("cid", F.lit(1)), F.col("blocks") * block) < SHARED_PIVOTS)
    groups = members.select("group", "block", "cid", "doc_id").unionByName(pivots.select("group", every, "cid", "doc_id"))
    edges = staged(_edges(groups.select(F.xxhash64("group", "block").alias("group"), "cid", "doc_id"), texts, threshold, size), "links")
    labels = _labelled(members, edges)
    sizes = labels.groupBy("group", "label").agg(F.count(F.lit(1)).alias("m"))
    largest = sizes.groupBy("group").agg(F.max(F.struct("m", "label")).alias("most")).select("group", "most.label", F.lit(True).alias("most"))
    outside = staged(labels.join(largest, ["group", "label"], "left").where("most is null").select("group", "blocks", "cid", "doc_id"), "outside")
    parts = outside.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / block).cast("long").alias("parts"))
    outside = outside.join(parts, "group").withColumn("part", F.pmod(F.xxhash64("cid", F.lit(2)), F.col("parts")))
    asked = members.join(parts, "group").select("group", "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), "cid", "doc_id")
    groups = asked.unionByName(outside.select("group", every, "part", "cid", "doc_id")).distinct()
    more = _edges(groups.select(F.xxhash64("group", "block", "part").alias("group"), "cid", "doc_id"), texts, threshold, size)
    labels = _labelled(members, edges.unionByName(more))
    best = labels.groupBy("label").agg(F.min("doc_id").alias("component"))
    return labels.join(best, "label").select("cid", "component")


def _edges(groups: DataFrame, texts: DataFrame, threshold: Fraction, size: int) -> DataFrame:
    return _joined(groups, texts, threshold, size, links=True).select(F.col("cid").alias("a"), F.col("component").alias("b"))


def _labelled(members: DataFrame, edges: DataFrame) -> DataFrame:
    labels = components(edges).select(F.col("node").alias("cid"), "label")
    return members.join(labels, "cid", "left").withColumn("label", F.coalesce("label", "cid"))
