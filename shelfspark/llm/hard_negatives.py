"""Hard negatives of anchors, mined by a secondary-sort shuffle.

Components become integers, scores are integer inner products.  Packed (anchor,
descending score, id) rows are dealt by anchor and sorted inside their partition;
a streaming iterator reads an anchor's rows in that order and holds no more than
its open windows.  It runs twice: over rows of the anchor's label it takes the
first ``positives``; over rows of other labels, with the positives sorted in
between, a positive opens a window, negatives that come by fall into the open
windows that cover their score, and a window closes when it is full or passed.

Which pairs are shuffled: each task scores its rows against all anchors, a tile
at a time, and passes on only rows that can matter: its first ``positives`` of an
anchor's label, then its first ``negatives`` for each window.  Whatever the whole
table would put first is first in its own task too, so nothing is lost.

Anchors travel to the tasks in chunks of at most about ``CHUNK_BYTES`` (measured), one
scan of the rows for each; the rows themselves are never shuffled.

Defined results: rows with a null vec_id or label, a null vector, or a null,
NaN or infinite component (also after scaling) take no part; vectors of another
length than the anchor's are not compared; rows that share the anchor's vec_id
are not others; equal rows are one anchor, but as many positives and negatives
as there are rows; rows of one vec_id that differ are anchors of their own; scores
beyond 64 bits stop at the largest; empty table: empty result; further columns are
ignored."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.session import shared_dir

from ._common import Best

CHUNK_BYTES = 8 << 20
TILE = 1_024, 4_096  # anchors and rows scored at once
SCALE = 256.0
LARGEST = np.iinfo(np.int64).max
PAIR = "chunk int, anchor int, anchor_id long, score long, kind int, other_id long"


def clean(rows: DataFrame) -> DataFrame:
    """(vec_id, label, v): rows that take part, components scaled and floored."""
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                       F.col("embedding").cast("array<double>").alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull())
    scaled = rows.withColumn("v", F.transform("v", lambda x: x * SCALE))
    return scaled.where(F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))))


class Vectors:
    """Vectors of one length, ordered by id, as integers in double precision."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, flat: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels = ids[order], labels[order]
        self.v = np.floor(flat.reshape(len(ids), -1))[order] if len(ids) else np.empty((0, 0))
        self.peak = float(np.abs(self.v).max(initial=0.0))

    def part(self, at: slice) -> Vectors:
        some = object.__new__(Vectors)
        some.ids, some.labels, some.v, some.peak = self.ids[at], self.labels[at], self.v[at], self.peak
        return some


def scores(a: Vectors, b: Vectors) -> np.ndarray:
    """Integer inner products; by doubles where those are exact, else by whole numbers."""
    if a.peak * b.peak * max(1, a.v.shape[1]) < 2.0 ** 52:
        return (a.v @ b.v.T).astype(np.int64)
    whole = [np.array([[int(x) for x in row] for row in m.v], object).reshape(m.v.shape) for m in (a, b)]
    return np.clip(whole[0] @ whole[1].T, -LARGEST, LARGEST).astype(np.int64)


def by_length(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, Vectors]]:
    """Rows in blocks of one vector length: (length, running numbers, vectors)."""
    done = 0
    for batch in batches:
        for at in range(0, batch.num_rows, TILE[1]):
            block = batch.slice(at, TILE[1])
            column = block.column("v")
            lengths = np.asarray(column.value_lengths())
            for length in np.unique(lengths).tolist():
                rows = np.flatnonzero(lengths == length)
                part = block.take(pa.array(rows))
                ids = part.column("vec_id").to_numpy()
                numbers = (done + rows)[np.argsort(ids, kind="stable")]
                yield length, numbers, Vectors(ids, part.column("label").to_numpy(), part.column("v").flatten().to_numpy())
            done += block.num_rows


def keep_first(best: Best, first: int, value: np.ndarray, fits: np.ndarray, ids: np.ndarray, numbers: np.ndarray, k: int,
               step: int = 1) -> None:
    """Of every line of ``value`` its ``k`` largest where ``fits``, equal ones by column,
    into groups ``first``, ``first + step``, ..."""
    lines, width = value.shape
    fits = fits & (value >= best.least[first:first + step * lines:step, None])
    many = fits.sum(1) > 4 * k
    for dense in (False, True):
        line = np.flatnonzero(many == dense)
        if not len(line):
            continue
        if dense:
            some, ok = value[line], fits[line]
            lowest = np.where(ok, some, -LARGEST - 1)
            edge = np.partition(lowest, width - k, axis=1)[:, width - k, None]  # the k-th largest
            over = ok & (some > edge)
            level = ok & (some == edge)
            level &= np.cumsum(level, 1) <= k - over.sum(1)[:, None]  # columns are ordered by id
            x, y = np.nonzero(over | level)
        else:
            x, y = np.nonzero(fits[line])
        best.add(first + step * line[x], value[line[x], y], ids[y], numbers[y])


def _anchors(chunk: DataFrame) -> dict[int, Vectors]:
    """The anchors of a chunk by vector length; their numbers follow (length, id)."""
    table = chunk.toArrow().combine_chunks()
    found = {}
    for batch in table.to_batches(max_chunksize=max(1, table.num_rows)):
        lengths = np.asarray(batch.column("v").value_lengths())
        for length in np.unique(lengths).tolist():
            part = batch.take(pa.array(np.flatnonzero(lengths == length)))
            found[length] = Vectors(part.column("vec_id").to_numpy(), part.column("label").to_numpy(), part.column("v").flatten().to_numpy())
    return found


def _firsts(anchors: dict[int, Vectors]) -> dict[int, int]:
    at, first = 0, {}
    for length in sorted(anchors):
        first[length] = at
        at += len(anchors[length].ids)
    return first


def _pairs(chunk: int, anchor_ids: np.ndarray, anchor: np.ndarray, score: np.ndarray, kind: int, other: np.ndarray) -> pa.RecordBatch:
    n = len(anchor)
    columns = [np.full(n, chunk, np.int32), anchor.astype(np.int32), anchor_ids[anchor], score, np.full(n, kind, np.int32), other]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[c.split()[0] for c in PAIR.split(", ")])


def _candidates(rows: DataFrame, chunk: int, shared: Broadcast, positives: int, negatives: int) -> DataFrame:
    """Pairs that can matter.  Without windows: rows of the anchor's label; with
    ``windows`` (low and high of each anchor, a line for each): rows of others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, windows = shared.value
        first = _firsts(anchors)
        anchor_ids = np.concatenate([anchors[x].ids for x in sorted(anchors)])
        each, k = (1, positives) if windows is None else (windows.shape[1], negatives)
        best = Best(len(anchor_ids) * each, k)
        for length, numbers, block in by_length(batches):
            known = anchors.get(length)
            for at in range(0, len(known.ids) if known else 0, TILE[0]):
                tile = known.part(slice(at, at + TILE[0]))
                score = scores(tile, block)
                same = tile.labels[:, None] == block.labels
                begin = first[length] + at
                if windows is None:
                    keep_first(best, begin, score, same & (tile.ids[:, None] != block.ids), block.ids, numbers, k)
                    continue
                for w in range(each):
                    low, high = windows[begin:begin + len(tile.ids), w, :].T
                    keep_first(best, begin * each + w, score, ~same & (score >= low[:, None]) & (score <= high[:, None])
                               & (tile.ids[:, None] != block.ids), block.ids, numbers, k, each)
        group, score, other, number = best.numbered()
        anchor = group // each
        if windows is not None and len(anchor):  # a row may lie in several windows of an anchor
            _, once = np.unique(np.stack([anchor, number]), axis=1, return_index=True)
            anchor, score, other = anchor[once], score[once], other[once]
        yield _pairs(chunk, anchor_ids, anchor, score, 1, other)

    return rows.mapInArrow(run, PAIR)


def secondary_sort(pairs: DataFrame) -> DataFrame:
    """Rows of an anchor together, highest scores first, positives before negatives, then by id."""
    return pairs.repartition("chunk", "anchor").sortWithinPartitions("chunk", "anchor", F.desc("score"), "kind", "other_id")


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    return chain.from_iterable(zip(*(c.to_pylist() for c in batch.columns)) for batch in batches)


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 10_000) -> Iterator[pa.RecordBatch]:
    some: list[tuple] = []
    for row in rows:
        some.append(row)
        if len(some) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some), schema)], schema=schema)
            some = []
    if some:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some), schema)], schema=schema)


_PAIR_SCHEMA = pa.schema([("chunk", pa.int32()), ("anchor", pa.int32()), ("anchor_id", pa.int64()), ("score", pa.int64()),
                          ("kind", pa.int32()), ("other_id", pa.int64())])
MINED = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
_MINED_SCHEMA = pa.schema([("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("rank", pa.int32()), ("negative_id", pa.int64()),
                           ("positive_score", pa.int64()), ("negative_score", pa.int64())])


def first_of_anchor(pairs: DataFrame, k: int) -> DataFrame:
    """The first ``k`` rows of each anchor, as positives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            now, seen = None, 0
            for chunk, anchor, anchor_id, score, _, other in _stream(batches):
                seen = seen + 1 if (chunk, anchor) == now else 1
                now = chunk, anchor
                if seen <= k:
                    yield chunk, anchor, anchor_id, score, 0, other
        yield from _batches(rows(), _PAIR_SCHEMA)

    return secondary_sort(pairs).mapInArrow(run, PAIR)


def window(positive_score: int, low: int, high: int) -> tuple[int, int]:
    """The scores ``low`` to ``high`` percent of a positive's, in whole numbers."""
    return -((-positive_score * low) // 100), (positive_score * high) // 100


def emit_negatives(pairs: DataFrame, negatives: int, low: int, high: int) -> DataFrame:
    """Positives (kind 0) open windows, negatives (kind 1) fall into them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            now, open_windows = None, []
            for chunk, anchor, anchor_id, score, kind, other in _stream(batches):
                if (chunk, anchor) != now:
                    now, open_windows = (chunk, anchor), []
                if kind == 0:
                    open_windows.append([*window(score, low, high), other, score, 0])
                    continue
                for w in open_windows:
                    if w[0] <= score <= w[1]:
                        w[4] += 1
                        yield anchor_id, w[2], w[4], other, w[3], score
                open_windows = [w for w in open_windows if w[4] < negatives and w[0] <= score]
        yield from _batches(rows(), _MINED_SCHEMA)

    return secondary_sort(pairs).mapInArrow(run, MINED)


def _windows(found: list, n: int, positives: int, low: int, high: int) -> np.ndarray:
    """Low and high of every anchor's windows; an absent one is empty (low above high)."""
    lines = np.empty((n, positives, 2), np.int64)
    lines[:, :, 0], lines[:, :, 1] = LARGEST, -LARGEST
    used = np.zeros(n, np.int64)
    for row in found:
        lines[row["anchor"], used[row["anchor"]]] = window(row["score"], low, high)
        used[row["anchor"]] += 1
    return lines


def mine(rows: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): of every
    row of ``anchors`` (vec_id, label, embedding) its first ``positives`` others of
    ``rows`` with its label, and for each of them the first ``negatives`` rows of other
    labels that score ``low`` to ``high`` percent of it."""
    spark = rows.sparkSession
    path = shared_dir(spark, "llm", "hard-negatives")
    rows, asked = clean(rows), clean(anchors).distinct()
    weight = asked.agg(F.sum(F.size("v") * 8 + 24)).first()[0] or 0
    chunks = max(1, -(-weight // CHUNK_BYTES))
    dealt = asked.withColumn("chunk", F.pmod(F.xxhash64("vec_id", "label", "v"), F.lit(chunks)))
    wrote = False
    for chunk in range(chunks):
        known = _anchors(dealt.where(F.col("chunk") == chunk).select("vec_id", "label", "v"))
        if not known:
            continue
        shared = spark.sparkContext.broadcast((known, None))
        first = first_of_anchor(_candidates(rows, chunk, shared, positives, negatives), positives)
        first.write.parquet(f"{path}/positives-{chunk}")
        first = spark.read.schema(PAIR).parquet(f"{path}/positives-{chunk}")
        n = sum(len(v.ids) for v in known.values())
        windows = _windows(first.select("anchor", "score").collect(), n, positives, low, high)  # a few rows for each anchor of the chunk
        shared = spark.sparkContext.broadcast((known, windows))
        found = _candidates(rows, chunk, shared, positives, negatives).unionByName(first)
        emit_negatives(found, negatives, low, high).write.mode("append").parquet(f"{path}/mined")
        wrote = True
    return spark.read.schema(MINED).parquet(f"{path}/mined") if wrote else spark.createDataFrame([], MINED)


def oracle() -> str:
    return """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
           FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS s
      FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
o AS (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY s DESC, other) AS r FROM p WHERE same),
n AS (SELECT o.anchor_id, o.other AS positive_id, p.other AS negative_id, o.s AS positive_score, p.s AS negative_score,
             CAST(row_number() OVER (PARTITION BY o.anchor_id, o.other ORDER BY p.s DESC, p.other) AS INTEGER) AS rank
      FROM o JOIN p ON o.anchor_id = p.anchor_id AND NOT p.same AND 50 * o.s <= 100 * p.s AND 100 * p.s <= 95 * o.s WHERE o.r <= 5)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3"""
