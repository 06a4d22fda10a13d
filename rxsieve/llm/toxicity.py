"""Toxicity scores: logistic regression over hashed word n-grams, trained by FTRL-proximal.

A text's features are the words, pairs of neighbours and pairs with one word between them that it holds,
hashed into 2**22 coordinates; a feature counts once in a text. Each coordinate has its own learning rate, and the L1
penalty leaves all but the telling coordinates at zero, so the weights are a small table that is broadcast.

FTRL-proximal is an online method, one update after the other, so it runs in one task over a bounded
sample: the ``SAMPLE_ROWS`` labels with the least hashes of their doc_id. Scoring is a single pass without shuffle.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rxsieve.llm import words as w

BITS = 22
#: Labelled rows that the classifier is fitted on, at most; every row is scored.
SAMPLE_ROWS = 12_000
#: And their features in all, from which on further texts of the sample are left out.
SAMPLE_FEATURES = 1 << 25
EPOCHS = 3
ALPHA, BETA, L2 = 3.0, 1.0, 0.01
#: The L1 penalty, times the root of the number of texts: chance leaves gradients of that order.
L1 = 0.3
FOLDS = 5


class Weights(NamedTuple):
    """Coordinates that are not zero, their weights, and the intercept; no intercept means that there was nothing to learn from."""

    index: np.ndarray
    value: np.ndarray
    intercept: float | None


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from: crc32 of the doc_id as text, modulo 5, is 0; a NULL doc_id counts as ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def _features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Coordinate of each word, pair and skip-gram, and the row it belongs to; none crosses texts."""
    hashes, before = w.word_hashes(data, offsets, w.ALPHANUMERIC)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(before))
    values, rows = [hashes], [row]
    for step in (1, 2):
        left, right = hashes[:-step], hashes[step:]
        within = row[:-step] == row[step:]
        values.append(w.mixed(left * w.BASE + right + np.uint64(step))[within])
        rows.append(row[:-step][within])
    return (np.concatenate(values) >> np.uint64(64 - BITS)).astype(np.int64), np.concatenate(rows)


def _train(batches):
    texts, labels, size = [], [], 0
    for batch, data, offsets in w.chunks(batches):
        if size >= SAMPLE_FEATURES:
            continue
        index, row = _features(data, offsets)
        keys = np.unique(row << BITS | index)
        parts = np.searchsorted(keys, np.arange(1, len(batch)) << BITS)
        texts += [(part & ((1 << BITS) - 1)).astype(np.int32) for part in np.split(keys, parts)]
        labels += batch.column("label").to_pylist()
        size += len(keys)
    if not texts:
        return
    z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)
    intercept, l1 = 1 << BITS, L1 * np.sqrt(len(texts))

    def weights(at):
        """The last coordinate is the intercept, which is not penalised."""
        penalty = np.where(at == intercept, 0.0, l1)
        return np.where(np.abs(z[at]) <= penalty, 0.0, (np.sign(z[at]) * penalty - z[at]) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    for _ in range(EPOCHS):
        for text, label in zip(texts, labels, strict=True):
            at = np.append(text, intercept)
            now = weights(at)
            gradient = 1 / (1 + np.exp(-np.clip(now.sum(), -30, 30))) - label
            step = (np.sqrt(n[at] + gradient**2) - np.sqrt(n[at])) / ALPHA
            z[at] += gradient - step * now
            n[at] += gradient**2
    at = np.arange(intercept + 1)
    learned = weights(at)
    kept = np.flatnonzero((learned != 0) | (at == intercept))
    yield pa.RecordBatch.from_arrays([pa.array(kept), pa.array(learned[kept])], ["index", "weight"])


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Weights:
    """Weights learned from ``docs`` (doc_id, text) with ``labels`` (doc_id, toxic); held-out rows are never used.

    NULL labels and ids do not count; several labels of a document count as their largest; repeated documents
    are learned from each time. The sample's order is fixed, so a rerun gives the same weights.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("double").alias("label"))
    # the sample is chosen among the labels, so that only its texts travel; it is small by its bound
    chosen = known.withColumn("order", F.xxhash64("doc_id")).orderBy("order", "doc_id").limit(sample_rows)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    sample = rows.select("order", "text", "label").orderBy("order", "text").limit(sample_rows)
    found = sample.coalesce(1).sortWithinPartitions("order", "text").mapInArrow(_train, "index long, weight double").collect()
    if not found:
        return Weights(np.zeros(0, np.int64), np.zeros(0), None)
    table = sorted((r["index"], r["weight"]) for r in found)
    return Weights(np.array([i for i, _ in table[:-1]], np.int64), np.array([v for _, v in table[:-1]]), table[-1][1])


def scored(docs: DataFrame, weights: Weights, carried: list[str] | None = None) -> DataFrame:
    """Per row of ``docs`` (any columns, ``text`` among them) its ``row``, the ``carried`` columns or all, and ``score``, 0 to 1.

    NULL and empty texts get the score of the intercept; where nothing could be learned every score is 0.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tuple(weights))
    rows, text = w.rows_of(docs, carried)

    def score(batches):
        index, value, intercept = shared.value
        table = np.zeros(1 << BITS, np.float32)
        table[index] = value
        for batch, data, offsets in w.chunks(batches, text):
            at, row = _features(data, offsets)
            told = table[at] != 0
            keys = np.unique(row[told] << BITS | at[told])
            sums = np.bincount(keys >> BITS, table[keys & ((1 << BITS) - 1)], len(batch))
            total = np.zeros(len(batch)) if intercept is None else 1 / (1 + np.exp(-np.clip(sums + intercept, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(total)], ["row", "score"])

    return rows.mapInArrow(score, T.StructType([rows.schema["row"], T.StructField("score", T.DoubleType())]))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row ``doc_id``, ``held_out``, ``score``, ``predicted`` (1 from a score of 0.5 on); other columns are ignored."""
    scores = scored(docs, fit(docs, labels), ["doc_id"]).select("row.doc_id", "score")
    return scores.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, whatever their columns, whose text is not predicted to be toxic."""
    return scored(docs, fit(docs, labels)).where("score < 0.5").select("row.*")
