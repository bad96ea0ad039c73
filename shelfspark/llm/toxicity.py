"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams.

Features are the presence of hashed words, word pairs and skip-grams (pairs
with one or two words between).  FTRL-proximal keeps a learning rate per
coordinate; its L1 term leaves most weights at exactly zero, so the model that
is broadcast is a short list of (index, weight).

The classifier is fitted on a bounded sample of the labelled rows (parameters
``max_rows`` and ``max_bytes``, taken by a hash of doc_id), in one task; every
text is scored whole.

Defined results: null or empty text: the score of the bias alone; no label to
learn from: score 0.5 for all; rows with a null label are not learnt from;
repeated rows: one row each; empty table: empty result; further columns are
ignored."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import fresh, text_chunks

BITS = 20
MAX_ROWS = 10_000
MAX_BYTES = 48 << 20
CACHE_WORDS = 150_000
THRESHOLD = 0.7
_EDGE = b".,;:!?\"'()[]{}<>|*#%&$-_"
# odd 64-bit multipliers, one for each kind of pair: next word, one between, two between
_PAIR = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)]


class _Words(dict):
    """Word -> hash of the word in lower case without marks at its ends."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = xxhash.xxh64_intdigest(word.decode().lower().encode().strip(_EDGE))
        if len(word) <= 40:
            self[word] = value
        return value


def _features(texts: list[str | None], hash_of: _Words) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of every occurrence in the texts, not yet distinct."""
    words = [(t or "").encode().split() for t in texts]
    sizes = np.array([len(w) for w in words], np.int64)
    hashes = np.fromiter((hash_of[w] for ws in words for w in ws), np.uint64, int(sizes.sum()))
    rows = np.repeat(np.arange(len(texts)), sizes)
    every, of = [hashes * np.uint64(0xD6E8FEB86659FD93)], [rows]
    for gap, mult in enumerate(_PAIR, 1):
        same = rows[gap:] == rows[:-gap]
        mixed = (hashes[:-gap] * mult + hashes[gap:]) * np.uint64(0xD6E8FEB86659FD93)
        every.append(mixed[same])
        of.append(rows[gap:][same])
    return np.concatenate(of), np.concatenate([(x >> np.uint64(64 - BITS)).astype(np.int64) for x in every])


class Ftrl:
    """FTRL-proximal on binary features; coordinate 2**BITS is the bias (no L1)."""

    def __init__(self, alpha: float = 2.0, beta: float = 1.0, l1: float = 8.0, l2: float = 0.05):
        self.alpha, self.beta, self.l2 = alpha, beta, l2
        size = (1 << BITS) + 1
        self.z, self.n = np.zeros(size), np.zeros(size)
        self.l1 = np.full(size, l1)
        self.l1[-1] = 0.0

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, l1 = self.z[at], self.l1[at]
        w = -(z - np.sign(z) * l1) / ((self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2)
        return np.where(np.abs(z) <= l1, 0.0, w)

    def learn(self, at: np.ndarray, label: int, weight: float = 1.0) -> None:
        w = self.weights(at)
        g = weight * (_sigmoid(float(w.sum())) - label)
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.alpha
        self.z[at] += g - sigma * w
        self.n[at] += g * g


def _sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-x)) if x >= 0 else math.exp(x) / (1 + math.exp(x))


def fit(docs: DataFrame, known: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES, epochs: int = 8,
        positive_weight: float = 3.0) -> tuple[np.ndarray, np.ndarray]:
    """Learn from ``docs`` (doc_id, text) whose label is in ``known`` (doc_id,
    label 0/1, distinct doc_ids): (indices, weights) that are not zero."""
    known = known.where("label in (0, 1)")
    sizes = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).alias("b"))
    size = sizes.join(known, "doc_id").agg(F.count("*").alias("n"), F.sum("b").alias("bytes")).first()
    share = min(1.0, max_rows / max(1, size["n"]), max_bytes / max(1, size["bytes"] or 1))
    order = F.xxhash64(F.lit("toxicity"), "doc_id")
    # the sample is taken before the join, so that only its texts are shuffled
    limit = int((2 * share - 1) * (1 << 63)) if share < 1 else (1 << 63) - 1
    some = docs.where(order <= F.lit(limit)).join(known, "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hash_of = _Words()  # ends with the task
        seen: list[np.ndarray] = []
        labels: list[int] = []
        for batch in text_chunks(batches):
            of, at = _features(batch.column("text").to_pylist(), hash_of)
            order = np.argsort(of, kind="stable")
            ends = np.searchsorted(of[order], np.arange(batch.num_rows + 1))
            for a, b, label in zip(ends, ends[1:], batch.column("label").to_pylist()):
                own = np.sort(at[order[a:b]])
                seen.append(np.append(own[np.append(True, own[1:] != own[:-1])] if len(own) else own, 1 << BITS).astype(np.int32))
                labels.append(label)
        model = Ftrl()
        for _ in range(epochs if labels else 0):
            for own, label in zip(seen, labels):
                model.learn(own, label, positive_weight if label else 1.0)
        w = model.weights(np.arange((1 << BITS) + 1))
        kept = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(kept), pa.array(w[kept])], names=["at", "weight"])

    # bounded by max_rows and max_bytes: one task learns, in an order fixed by the hash
    told = (some.select("text", F.col("label").cast("int").alias("label"), order.alias("o"), "doc_id")
            .repartition(1).sortWithinPartitions("o", "doc_id", "text").select("text", "label")
            .mapInArrow(run, "at long, weight double").collect())  # at most 2**BITS + 1 rows
    return np.array([r["at"] for r in told], np.int64), np.array([r["weight"] for r in told])


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the score ``name`` instead of column ``text``."""
    at, weight = model
    keep = [c for c in docs.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hash_of, table = _Words(), np.zeros((1 << BITS) + 1)
        table[at] = weight
        for batch in text_chunks(batches, text):
            of, idx = _features(batch.column(text).to_pylist(), hash_of)
            hit = np.flatnonzero(table[idx])
            pair = np.sort(of[hit] << (BITS + 1) | idx[hit])
            if len(pair):
                pair = pair[np.append(True, pair[1:] != pair[:-1])]
            total = np.bincount(pair >> (BITS + 1), table[pair & ((1 << (BITS + 1)) - 1)], batch.num_rows) + table[-1]
            value = np.array([_sigmoid(x) for x in total.tolist()], float)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(value)], names=[*keep, name])

    schema = T.StructType([f for f in docs.schema.fields if f.name != text]).add(name, T.DoubleType())
    return docs.mapInArrow(run, schema)


def _learn(docs: DataFrame, labels: DataFrame, held_out_rest: int, **bounds) -> tuple[Column, tuple[np.ndarray, np.ndarray]]:
    """The held-out condition, and the model of the labelled rows outside it."""
    rest = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == held_out_rest
    held = F.coalesce(rest, F.lit(True))  # a null doc_id has no label
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("label")).where("label is not null")
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return held, fit(rows.where(~held), known, **bounds)


def classify(docs: DataFrame, labels: DataFrame, held_out_rest: int = 1, threshold: float = THRESHOLD, **bounds) -> DataFrame:
    """Score all documents, learning from the labels of those whose crc32(doc_id)
    mod 3 is not ``held_out_rest``: doc_id, held_out, score, predicted."""
    held, model = _learn(docs, labels, held_out_rest, **bounds)
    scored = score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model)
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame, held_out_rest: int = 1, threshold: float = THRESHOLD, **bounds) -> DataFrame:
    """The documents whose score is below the threshold, all columns kept."""
    _, model = _learn(docs, labels, held_out_rest, **bounds)
    copy, value = fresh(docs, "scored_text"), fresh(docs, "toxicity")
    scored = score(docs.withColumn(copy, F.col("text")), model, copy, value)
    return scored.where(F.col(value) < threshold).select(*docs.columns)
