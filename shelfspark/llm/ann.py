"""Nearest neighbours by inner product with collision-counting hashing.

Largest inner product becomes smallest distance: vectors are divided by the
largest norm and get one more component that makes them unit vectors; queries
are normalised.  Each of ``projections`` random directions orders the vectors
by one number; the index holds the sorted numbers and the order, per block of
about ``BLOCK`` vectors, so every row is indexed and a block fits into a task.

A query looks at a window around its own projection in each sorted array.  A
vector inside enough windows (``share`` of them) is a candidate, and candidates
are verified by their exact inner product.  While a block has not verified
``probe`` of its vectors and twenty times ``k`` more, the windows are widened by the
factor ``GROWTH`` (virtual rehashing: only the new margins are counted), until
they cover the block at the latest.

Queries travel to the tasks in chunks of at most about ``CHUNK_BYTES`` (measured),
one scan of the index for each; the index is not shuffled.  A task merges the
blocks that it reads before it passes a query's best rows on.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components, and rows with a null vec_id, take no part; vectors of another
length are not compared; rows with the query's vec_id are its own; equal rows
are one; rows of one vec_id that differ all count, and are queries of their own; ties go to the smaller vec_id; fewer
than ``k`` others: all of them; empty table: empty result; further columns are
ignored."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfspark.session import shared_dir

from ._common import cut

BLOCK = 16_384
CHUNK_BYTES = 8 << 20
GROWTH = 1.4
SEED = 20_240_229


def directions(dim: int, projections: int) -> np.ndarray:
    return np.random.default_rng([SEED, dim]).standard_normal((projections, dim + 1))


def clean(vectors: DataFrame) -> DataFrame:
    """(vec_id, dim, v): usable vectors in double precision, equal rows once."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).where(finite & F.exists("v", lambda x: x != 0))
    return rows.distinct().select("vec_id", F.size("v").alias("dim"), "v")


def _matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    ids = table.column("vec_id").to_numpy()
    order = np.argsort(ids, kind="stable")
    column = table.column("v").combine_chunks()
    flat = column.flatten().to_numpy()
    return ids[order], flat.reshape(len(ids), -1)[order]


def build(rows: DataFrame, projections: int) -> DataFrame:
    """Index: (dim, ids, vectors, order, places), a row for each block."""
    sizes = rows.agg(F.count("*").alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: F.greatest(a, F.abs(x)))).alias("peak")).first()
    blocks, peak = max(1, -(-sizes["n"] // BLOCK)), sizes["peak"] or 1.0
    # norms of vectors scaled by the largest component neither overflow nor vanish
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + (x / peak) * (x / peak))
    largest = float(np.sqrt(rows.agg(F.max(norm)).first()[0] or 1.0))

    def block(table: pa.Table) -> pa.Table:
        ids, v = _matrix(table)
        unit = v / peak / largest
        last = np.sqrt(np.maximum(0.0, 1.0 - (unit * unit).sum(1)))
        values = directions(v.shape[1], projections) @ np.column_stack([unit, last]).T
        order = np.argsort(values, axis=1, kind="stable")
        cells = [ids.tobytes(), v.tobytes(), order.astype("<i4").tobytes(), np.take_along_axis(values, order, 1).tobytes()]
        return pa.table({"dim": pa.array([v.shape[1]], pa.int32()), **{n: pa.array([c], pa.binary()) for n, c in zip(_CELLS, cells)}})

    dealt = rows.withColumn("block", F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)).cast("int"))
    schema = "dim int, " + ", ".join(f"{c} binary" for c in _CELLS)
    return dealt.groupBy("dim", "block").applyInArrow(block, schema)


_CELLS = ("ids", "vectors", "order", "places")


class _Block:
    """A block of the index: its vectors, and the sorted arrays laid end to end so
    that one binary search finds a query's place in all of them."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, order: np.ndarray, places: np.ndarray):
        self.ids, self.vectors, self.order = ids, vectors, order.astype(np.intp).ravel()
        m, self.n = places.shape
        self.limit = float(np.abs(places).max()) + 1.0
        self.shift = np.arange(m) * (4 * self.limit)
        self.base = np.arange(m) * self.n
        self.flat = (places + self.shift[:, None]).ravel()
        self.width = float(np.median(places[:, -1] - places[:, 0])) / 20 or 1e-6

    def _ranks(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.flat, np.clip(at, -self.limit, self.limit) + self.shift)

    def search(self, query_id: int, q: np.ndarray, at: np.ndarray, k: int, least: int, enough: int) -> tuple[np.ndarray, np.ndarray]:
        """The best ``k``: candidates by collision counts, then exact products."""
        hits = np.zeros(self.n, np.int64)
        order = self.order
        lo = hi = self._ranks(at)
        width = self.width / GROWTH  # about what the queries before needed
        while True:
            a, b = self._ranks(at - width), self._ranks(at + width)
            new = [order[x:y] for x, y in zip(np.concatenate((a, hi)).tolist(), np.concatenate((lo, b)).tolist()) if x < y]
            lo, hi = a, b
            if new:
                hits += np.bincount(np.concatenate(new), minlength=self.n)
            found = np.flatnonzero(hits >= least)
            if len(found) >= enough or (hi - lo).sum() == len(order):
                break
            width *= GROWTH
        self.width += 0.2 * (width - self.width)
        found = found[self.ids[found] != query_id]
        return _first(self.ids[found], self.vectors[found] @ q, k)


def _first(ids: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` highest scores, equal ones by id."""
    if len(ids) > k:
        level = score >= np.partition(score, len(score) - k)[len(score) - k]
        ids, score = ids[level], score[level]
    best = np.lexsort((ids, -score))[:k]
    return ids[best], score[best]


def _merge(parts: list[tuple[np.ndarray, np.ndarray]], k: int) -> tuple[np.ndarray, np.ndarray]:
    return _first(*(np.concatenate(x) for x in zip(*parts)), k)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, projections: int = 56, share: float = 0.8,
            probe: float = 0.1) -> DataFrame:
    """(query_id, rank, vec_id, score): of every row of ``queries`` (vec_id,
    embedding) the ``k`` nearest of ``vectors`` found, its own vec_id left out."""
    spark = vectors.sparkSession
    rows = cut(clean(vectors), "vectors")
    index = cut(build(rows, projections), "ann-index")
    asked = clean(queries)
    weight = asked.agg(F.sum(F.col("dim") * 8 + 16)).first()[0] or 0
    chunks = max(1, -(-weight // CHUNK_BYTES))
    asked = asked.withColumn("chunk", F.pmod(F.xxhash64("vec_id", "v"), F.lit(chunks)))
    least = max(1, int(np.ceil(share * projections)))
    path = shared_dir(spark, "llm", "ann-found")
    schema = "query_id long, query int, vec_id long, score double"
    for chunk in range(chunks):
        some = asked.where(F.col("chunk") == chunk).select("vec_id", "v").toArrow().to_pylist()  # about CHUNK_BYTES
        by_dim: dict[int, list[tuple[int, int, np.ndarray]]] = {}
        for number, row in enumerate(some):
            by_dim.setdefault(len(row["v"]), []).append((number, row["vec_id"], np.array(row["v"])))
        shared = spark.sparkContext.broadcast(by_dim)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
            names: dict[int, int] = {}
            for batch in batches:
                for at in range(batch.num_rows):
                    row = batch.slice(at, 1).to_pylist()[0]
                    ids = np.frombuffer(row["ids"], np.int64)
                    v = np.frombuffer(row["vectors"]).reshape(len(ids), -1)
                    block = _Block(ids, v, np.frombuffer(row["order"], "<i4").reshape(projections, -1),
                                   np.frombuffer(row["places"]).reshape(projections, -1))
                    enough = 20 * k + int(probe * len(ids))
                    plain = directions(v.shape[1], projections)[:, :-1]
                    for number, query_id, q in shared.value.get(v.shape[1], []):
                        scaled = q / np.abs(q).max()
                        found = block.search(query_id, q, plain @ (scaled / np.sqrt(scaled @ scaled)), k, least, enough)
                        best[number] = _merge([best[number], found], k) if number in best else found
                        names[number] = query_id
            for number, (found, score) in best.items():
                n = len(found)
                cells = [np.full(n, names[number]), np.full(n, number, np.int32), found, score]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cells], names=["query_id", "query", "vec_id", "score"])

        found = index.mapInArrow(run, schema)
        rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
        found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score").write.mode("append").parquet(path)
    return spark.read.schema("query_id long, rank int, vec_id long, score double").parquet(path)
