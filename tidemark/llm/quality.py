"""Quality classifier: logistic regression on hashed word n-grams, trained with follow-the-regularised-leader updates."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.llm.store import stored
from tidemark.llm.text import MARKS, grams, slices, utf8, words

#: Labelled rows that training reads at most (in expectation; rows are picked by a hash of their id).
TRAIN_ROWS = 20_000
#: Parts in which the driver reads them, each epoch: of 20,000 rows about two megabytes.
FETCHES = 64
BITS = 18
THRESHOLD = 0.7
EPOCHS = 2
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.1

_MASK = np.uint64((1 << BITS) - 1)
_REPEATED = np.int32(1)
_BIAS = np.int32(0)


@dataclass
class Model:
    """Weights by hash bucket; bucket 0 is the bias. ``trained`` is False if the labels were not of both classes."""

    weights: np.ndarray
    trained: bool


def held_out(id_col: str = "doc_id") -> Column:
    """The quarter of all ids that training never sees."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def features(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words and word pairs of the rows, and the row of each.

    A word that repeats the one before is one fixed pair, whatever the word.
    """
    row = np.repeat(np.arange(len(counts)), counts)
    single = (hashes & _MASK).astype(np.int32)
    pair = (grams(hashes, 2) & _MASK).astype(np.int32)
    pair[hashes[1:] == hashes[:-1]] = _REPEATED
    within = row[1:] == row[:-1]
    return np.concatenate([single, pair[within]]), np.concatenate([row, row[1:][within]])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row's buckets, ascending, and how often each occurs."""
    for batch in batches:
        data, bounds = utf8(batch.column("text"))
        for i, j in slices(bounds):
            bucket, row = features(*words(data, bounds[i : j + 1], MARKS))
            order = np.argsort(row, kind="stable")
            bucket, at = bucket[order], np.searchsorted(row[order], np.arange(j - i + 1))
            counted = [np.unique(bucket[at[k] : at[k + 1]], return_counts=True) for k in range(j - i)]
            packed = [pa.array([x[k].astype("<i4").tobytes() for x in counted], pa.binary()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column("pick").slice(i, j - i), batch.column("label").slice(i, j - i), *packed], _PACKED)


_PACKED = ["pick", "label", "buckets", "times"]


def train(docs: DataFrame, labels: DataFrame, max_rows: int = TRAIN_ROWS, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """Fit the model on the whole texts of labelled rows outside the held-out quarter.

    About ``max_rows`` labelled rows are used, picked by a hash of their id. Labels other than 0 and 1 and rows without
    an id or a document are left out; a repeated label counts again. Without rows of both classes all weights are 0.

    The driver reads the rows once per epoch, in the order of their pick, and holds one at a time beside the weights: the
    sort is Spark's, and its partitions are fetched one after the other.
    """
    usable = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col))
    share = max_rows / max(usable.count(), max_rows)
    pick = F.pmod(F.xxhash64(id_col), F.lit(1 << 30))
    few = usable.where(pick < int(share * (1 << 30))).select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("label"))
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).join(F.broadcast(few), "_id")
    rows = rows.select(F.xxhash64("_id").alias("pick"), "label", "text").mapInArrow(_packed, "pick long, label int, buckets binary, times binary")
    sample = stored(rows, "training-rows")
    if sample.select("label").distinct().count() < 2:
        return Model(np.zeros(1 << BITS, np.float32), False)

    def epoch() -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        # By number, so that partitions stay small: the driver holds one of them.
        ordered = sample.repartitionByRange(FETCHES, "pick").sortWithinPartitions(*_PACKED).drop("pick")
        for r in ordered.toLocalIterator():
            yield r["label"], np.frombuffer(r["buckets"], "<i4"), np.frombuffer(r["times"], "<i4")

    return fit(epoch)


def fit(epoch: Callable[[], Iterable[tuple[int, np.ndarray, np.ndarray]]]) -> Model:
    """Follow-the-regularised-leader over the rows (label, buckets, times of each) in order, with one learning rate for each
    weight. ``epoch`` gives all rows anew."""
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    for _ in range(EPOCHS):
        for label, buckets, times in epoch():
            at = np.append(buckets, _BIAS)
            x = np.append(times / np.sqrt(max(1, times.sum())), 1.0)
            w = _leader(z[at], n[at])
            p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
            g = (p - label) * x
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA * w
            n[at] += g * g
    return Model(_leader(z, n).astype(np.float32), True)


def _leader(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def scores(model: Model, column: pa.Array) -> np.ndarray:
    """The probability of label 1 for every text."""
    data, bounds = utf8(column)
    out = np.zeros(len(bounds) - 1)
    for i, j in slices(bounds):
        bucket, row = features(*words(data, bounds[i : j + 1], MARKS))
        total = np.bincount(row, model.weights[bucket], minlength=j - i)
        out[i:j] = total / np.sqrt(np.maximum(1, np.bincount(row, minlength=j - i)))
    return 1 / (1 + np.exp(-np.clip(out + model.weights[_BIAS], -35, 35)))


def score_texts(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``_score``, the probability of label 1 by the whole text.

    Null and empty texts get the score of the bias alone. Rows are scored one by one, so repeated rows, null ids and
    further columns play no part; a column named ``_score`` is replaced. A text that is one of the columns travels once.
    """
    names = [c for c in docs.columns if c != "_score"]
    at = names.index(text_col) if text_col in names else len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in slices(utf8(batch.column(at))[1]):
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([*part.columns[: len(names)], pa.array(scores(model, part.column(at)))], [*names, "_score"])

    rows = docs.select(*names)
    schema = T.StructType([*rows.schema, T.StructField("_score", T.DoubleType())])
    return (rows if at < len(names) else docs.select(*names, F.col(text_col).alias("_text"))).mapInArrow(run, schema)
