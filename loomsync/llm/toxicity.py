"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are the distinct hashes, to ``BITS`` bits, of its words, word pairs and
pairs with one word between. The model learns online with a rate per coordinate; its L1 part
keeps most weights at zero, so the weights are a short list that fits a broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomsync.llm.common import extended, map_batches
from loomsync.llm.words import mix, word_hashes

BITS = 20
#: Labelled rows that the model is fitted on, at most; a sample by hash where there are more.
TRAIN_ROWS = 20_000
THRESHOLD = 0.7
#: Texts whose features are worked out at a time in the fit; bounds its memory.
FIT_BATCH = 200

_BREAKS = np.ones(256, bool)
_BREAKS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


@dataclass(frozen=True)
class Rates:
    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 8.0
    l2: float = 0.0
    passes: int = 8
    #: Training rows that must hold a feature before it is learnt.
    least_rows: int = 8


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of all texts, with repeats, and the number of the text of each."""
    hashes, owner = word_hashes([t.lower() for t in texts], _BREAKS)
    found, owners = [hashes], [owner]
    for gap, factor in ((1, 0x9E3779B97F4A7C15), (2, 0xC2B2AE3D27D4EB4F)):
        same = owner[gap:] == owner[:-gap]
        found.append(mix(hashes[:-gap] * np.uint64(factor) + hashes[gap:])[same])
        owners.append(owner[gap:][same])
    return (np.concatenate(found) >> np.uint64(64 - BITS)).astype(np.int64), np.concatenate(owners)


def _texts(column: pa.Array) -> list[bytes]:
    return [(x or "").encode() for x in column.to_pylist()]


def _fit(batches: Iterator[pa.RecordBatch], rates: Rates) -> Iterator[pa.RecordBatch]:
    """Weights other than zero, from all rows ``text, label`` in the given order; -1 is the bias."""
    size = (1 << BITS) + 1
    rows, labels, seen = [], [], np.zeros(size, np.int32)
    for batch in (b.slice(at, FIT_BATCH) for b in batches for at in range(0, b.num_rows, FIT_BATCH)):
        index, owner = features(_texts(batch.column("text")))
        pairs = np.unique(owner << BITS | index)
        edges = np.searchsorted(pairs >> BITS, np.arange(batch.num_rows + 1))
        index = (pairs & ((1 << BITS) - 1)).astype(np.int32)
        rows += [index[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]
        np.add.at(seen, index, 1)
        labels += batch.column("label").to_pylist()
    held = seen >= rates.least_rows
    # In place, so that a batch's features go as soon as its last row is cut.
    for at, row in enumerate(rows):
        rows[at] = row[held[row]]
    z, n = np.zeros(size), np.zeros(size)
    bias = np.array([size - 1])

    def weights(at: np.ndarray) -> np.ndarray:
        pull = np.maximum(np.abs(z[at]) - rates.l1 * (at < size - 1), 0)
        return -np.sign(z[at]) * pull / ((rates.beta + np.sqrt(n[at])) / rates.alpha + rates.l2)

    for _ in range(rates.passes):
        for row, label in zip(rows, labels, strict=True):
            at = np.concatenate([row, bias])
            w = weights(at)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
            root = np.sqrt(n[at])
            n[at] += g * g
            z[at] += g - (np.sqrt(n[at]) - root) / rates.alpha * w
    final = weights(np.arange(size))
    kept = np.flatnonzero(final)
    yield pa.RecordBatch.from_arrays([pa.array(np.where(kept == size - 1, -1, kept)), pa.array(final[kept])], ["feature", "weight"])


def fit(labelled: DataFrame, text: str = "text", label: str = "label", key: str = "doc_id", rows: int = TRAIN_ROWS, rates: Rates = Rates()) -> list[tuple[int, float]]:
    """Weights ``feature, weight`` other than zero, from at most ``rows`` rows with a label of 0 or 1.

    Where there are more, rows are chosen by a hash of ``key`` alone. Rows without a label are
    passed over; no labelled row gives no weights. A null text has no features.
    """
    labelled = labelled.where(F.col(label).isin(0, 1))
    total = labelled.count()
    place = F.pmod(F.xxhash64(key), F.lit(1 << 30))
    chosen = labelled.where(place < int(min(1.0, 0.97 * rows / max(total, 1)) * (1 << 30)))
    chosen = chosen.select(F.col(text).alias("text"), F.col(label).cast("double").alias("label"), place.alias("place"), F.col(key).alias("key"))
    chosen = chosen.repartition(1).sortWithinPartitions("place", "key")
    fitted = chosen.mapInArrow(lambda batches: _fit(batches, rates), "feature long, weight double")
    return [tuple(r) for r in fitted.collect()]


def score(docs: DataFrame, weights: list[tuple[int, float]], text: str = "text", score: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1; a text without features gets that of the bias.

    A column that is called as ``score`` already is replaced; an empty table stays empty.
    """
    docs = docs.drop(score)
    names = docs.columns
    index, value = (np.array([w[i] for w in weights], kind) for i, kind in ((0, np.int64), (1, np.float64)))
    shared = docs.sparkSession.sparkContext.broadcast((index, value))

    def run(batch: pa.RecordBatch) -> dict:
        dense = np.zeros((1 << BITS) + 1)  # the last one, feature -1, is the bias
        dense[shared.value[0]] = shared.value[1]
        index, owner = features(_texts(batch.column(text)))
        hit = np.flatnonzero(dense[index])
        pairs = np.unique(owner[hit] << BITS | index[hit])
        total = np.bincount(pairs >> BITS, dense[pairs & ((1 << BITS) - 1)], batch.num_rows) + dense[-1]
        return {n: batch.column(n) for n in names} | {score: 1 / (1 + np.exp(-np.clip(total, -35, 35)))}

    return map_batches(docs, run, extended(docs.schema, **{score: "double"}))


def train_split(doc_id: str = "doc_id"):
    """Whether a row may be learnt from: the CRC of its id as text, modulo 3, is not 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 != 1, F.lit(True))


def toxic_weights(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, rates: Rates = Rates()) -> list[tuple[int, float]]:
    """Weights learnt from the rows of ``labels`` outside the held-out third, with their texts in ``docs``."""
    known = labels.where(train_split()).select("doc_id", F.col("toxic").alias("label"))
    total = known.where("label in (0, 1)").count()
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))  # as in fit(): the sample is drawn before the texts are joined
    known = known.where("label in (0, 1)").where(place < int(min(1.0, 0.97 * rows / max(total, 1)) * (1 << 30)))
    return fit(docs.select("doc_id", "text").join(known, "doc_id"), rows=2 * rows, rates=rates)
