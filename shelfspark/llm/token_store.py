"""Token-id files with a minimal perfect hash index.

Documents are range-partitioned by doc_id; each partition writes its ids, in
ascending doc_id order, as shards of about ``SHARD_TOKENS`` ids.  The container
is Parquet (so Spark's commit protocol and any Hadoop file system apply); a row
is a shard:

    part, shard     place in the order (ascending doc_id)
    first_key, last_key, n_docs, n_tokens, start (ids before it in its part)
    payload         raw ids, little-endian unsigned 32-bit, end id included
    keys            the distinct keys in ascending order (little-endian int64)
    index           the hash index, see ``build_index``

The index is a leveled bit-map hash: a level has two bits per key left; keys
alone on a bit set it, the others go to the next level.  A key's slot is the
rank of its bit.  A slot stores a 32-bit fingerprint of its key (a foreign key
is refused but for one in 2^32), the place of the key's first document and how
many it has.  A lookup takes a constant number of steps and reads no other
key.

Defined results: null text: just the end id; empty table: an empty store;
repeated doc_ids: each row is a document, ordered by text; null doc_id: sorts
first and is stored in shards of its own, which have no keys; further columns
are ignored."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._common import text_chunks
from .tokens import default_tokenizer, encoder

SHARD_TOKENS = 1 << 19
LEVELS = 40
SCHEMA = ("part int, shard int, first_key long, last_key long, n_docs long, n_tokens long, start long, "
          "payload binary, keys binary, index binary")
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15))


def _hash(keys: np.ndarray, seed: int) -> np.ndarray:
    """SplitMix64 finaliser of the keys, one function per seed."""
    x = keys.view(np.uint64) + np.uint64((seed + 1) * int(_MIX[2]) & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def _tag(keys: np.ndarray) -> np.ndarray:
    return (_hash(keys, LEVELS + 1) >> np.uint64(32)).astype("<u4")


def build_index(keys: np.ndarray, first: np.ndarray, count: np.ndarray, ends: np.ndarray) -> bytes:
    """Index of distinct int64 ``keys``; key i has documents first[i] .. +count[i],
    and document j ends before token ends[j].

    Layout (little-endian): uint32 n keys, n documents, n levels, bits of each
    level; the levels' bits, each padded to bytes; per slot fingerprint, first,
    count (uint32 each); ends (uint32)."""
    left, levels = keys, []
    while len(left):
        if len(levels) == LEVELS:
            raise RuntimeError("keys are not distinct")
        size = 2 * len(left)
        at = (_hash(left, len(levels)) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        levels.append(alone)
        left = left[~alone[at]]
    head = np.array([len(keys), len(ends), len(levels), *map(len, levels)], "<u4").tobytes()
    body = b"".join(np.packbits(x, bitorder="little").tobytes() for x in levels)
    slot = _slots(keys, levels)
    table = np.zeros((len(keys), 3), "<u4")
    table[slot] = np.column_stack([_tag(keys), first, count])
    return head + body + table.tobytes() + ends.astype("<u4").tobytes()


def _slots(keys: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Slot of each key, -1 where no level has its bit."""
    slot = np.full(len(keys), -1, np.int64)
    todo, base = np.arange(len(keys)), 0
    for n, level in enumerate(levels):
        at = (_hash(keys[todo], n) % np.uint64(len(level))).astype(np.int64)
        hit = level[at]
        slot[todo[hit]] = base + (np.cumsum(level) - 1)[at[hit]]
        base += int(level.sum())
        todo = todo[~hit]
    return slot


def lookup(index: bytes, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first document, number of documents) of each key, 0 documents for an
    unknown one, and the documents' ends."""
    n_keys, n_docs, n_levels = np.frombuffer(index, "<u4", 3).tolist()
    sizes = np.frombuffer(index, "<u4", n_levels, 12).tolist()
    at, levels = 12 + 4 * n_levels, []
    for size in sizes:
        wide = -(-size // 8)
        levels.append(np.unpackbits(np.frombuffer(index, np.uint8, wide, at), count=size, bitorder="little").astype(bool))
        at += wide
    table = np.frombuffer(index, "<u4", 3 * n_keys, at).reshape(-1, 3)
    ends = np.frombuffer(index, "<u4", n_docs, at + 12 * n_keys).astype(np.int64)
    slot = _slots(keys, levels)
    known = slot >= 0
    known[known] = table[slot[known], 0] == _tag(keys[known])
    first, count = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
    first[known], count[known] = table[slot[known], 1], table[slot[known], 2]
    return first, count, ends


def _shard(part: int, shard: int, start: int, docs: list, blobs: list[bytes]) -> pa.RecordBatch:
    ends = np.cumsum([len(b) // 4 for b in blobs])
    if docs[0] is None:
        keys, index = np.empty(0, np.int64), build_index(*[np.empty(0, np.int64)] * 3, ends)
    else:
        every = np.array(docs, np.int64)
        first = np.flatnonzero(np.concatenate(([True], every[1:] != every[:-1])))
        keys = every[first]
        index = build_index(keys, first, np.diff(np.append(first, len(every))), ends)
    row = [part, shard, docs[0], docs[-1], len(docs), int(ends[-1]), start, b"".join(blobs), keys.tobytes(), index]
    types = [pa.int32(), pa.int32(), *[pa.int64()] * 5, *[pa.binary()] * 3]
    names = [f.split()[0] for f in SCHEMA.split(",")]
    return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types)], names=names)


def write(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 2) -> None:
    """Write the ids of ``docs`` (doc_id, text) as a store at ``path``."""
    tokenizer = tokenizer or default_tokenizer()
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, shard, start, size = TaskContext.get().partitionId(), 0, 0, 0
        words, ids, blobs = encoder(tokenizer), [], []
        for batch in text_chunks(batches):
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                # a key's documents stay together unless they alone exceed a shard
                if ids and (size >= SHARD_TOKENS and doc != ids[-1] or size >= 8 * SHARD_TOKENS
                            or (ids[-1] is None) != (doc is None)):
                    yield _shard(part, shard, start, ids, blobs)
                    shard, start, size, ids, blobs = shard + 1, start + size, 0, [], []
                blob = words.encode(text) + end
                ids.append(doc)
                blobs.append(blob)
                size += len(blob) // 4
        if ids:
            yield _shard(part, shard, start, ids, blobs)

    dealt = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange("doc_id")
    (dealt.sortWithinPartitions("doc_id", "text").mapInArrow(run, SCHEMA)
     .write.option("compression", "zstd").option("maxRecordsPerFile", 64).parquet(path))


def _shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, through the index;
    ``start`` counts the ids of all documents before it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys = np.frombuffer(row["keys"], np.int64)
                first, count, ends = lookup(row["index"], keys)
                if row["first_key"] is None:
                    docs, at = [None] * len(ends), np.arange(len(ends))
                else:
                    if not count.all():
                        raise ValueError(f"shard {row['part']}/{row['shard']}: a key is not in its index")
                    docs = np.repeat(keys, count)
                    at = np.repeat(first, count) + np.arange(len(docs)) - np.repeat(np.cumsum(count) - count, count)
                starts = np.concatenate(([0], ends))
                crc = [zlib.crc32(row["payload"][4 * a:4 * b]) for a, b in zip(starts[at], starts[at + 1])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["part"]] * len(docs), pa.int32()), pa.array(docs, pa.int64()),
                     pa.array(row["start"] + starts[at]), pa.array(starts[at + 1] - starts[at]), pa.array(crc, pa.int64())],
                    names=["part", "doc_id", "start", "n_tokens", "ids_crc32"])

    shards = _shards(spark, path)
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))  # one row per partition written
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    rows = shards.drop("shard", "n_docs", "last_key").mapInArrow(
        run, "part int, doc_id long, start long, n_tokens long, ids_crc32 long")
    return rows.join(base, "part").select("doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids_crc32")


SPAN_BYTES = 64 << 20


def _asked(spans: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc_id, part, shard): the shards whose span of keys holds a wanted key, found by
    binary search in the list of spans, which is as short as the number of shards."""
    held = spans.orderBy("first_key", "last_key").toArrow()
    first, last, part, shard = (held.column(c).to_numpy() for c in ("first_key", "last_key", "part", "shard"))
    shared = spans.sparkSession.sparkContext.broadcast((first, np.maximum.accumulate(last) if len(last) else last, part, shard))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, last, part, shard = shared.value
        for batch in batches:
            keys = batch.column("doc_id").to_numpy()
            lo, hi = np.searchsorted(last, keys, "left"), np.searchsorted(first, keys, "right")
            n = np.maximum(hi - lo, 0)
            at = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(keys, n)), pa.array(part[at]), pa.array(shard[at])], names=["doc_id", "part", "shard"])

    return wanted.mapInArrow(run, "doc_id long, part int, shard int")


def get(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """Keyed access: (doc_id, ids) of the documents whose doc_id is in ``keys``.  A key's
    shard comes from the list of the shards' first and last keys, its place there
    from the perfect hash index.  A list above ``SPAN_BYTES`` is joined instead."""
    spans = _shards(spark, path).where("first_key is not null").select("part", "shard", "first_key", "last_key")
    wanted = keys.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    if spans.count() * 24 <= SPAN_BYTES:
        found = _asked(spans, wanted)
    else:
        found = wanted.join(spans, F.col("doc_id").between(F.col("first_key"), F.col("last_key")))
    asked = found.groupBy("part", "shard").agg(F.collect_list("doc_id").alias("ask"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                asks = np.array(row["ask"], np.int64)
                first, count, ends = lookup(row["index"], asks)
                starts = np.concatenate(([0], ends))
                docs, ids = [], []
                for key, a, n in zip(asks.tolist(), first.tolist(), count.tolist()):
                    for j in range(a, a + n):
                        docs.append(key)
                        ids.append(np.frombuffer(row["payload"], "<u4")[starts[j]:starts[j + 1]].astype(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(ids, pa.list_(pa.int64()))],
                                                 names=["doc_id", "ids"])

    found = _shards(spark, path).select("part", "shard", "payload", "index").join(asked, ["part", "shard"])
    return found.select("ask", "payload", "index").mapInArrow(run, "doc_id long, ids array<long>")
