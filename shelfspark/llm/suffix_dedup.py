"""Repeated byte strings by prefix-free parsing and suffix order.

A rolling hash over ``GRAM`` bytes triggers where it is smallest among the
grams of a ``width``-byte string, so each string of that length has a trigger,
and equal strings have equal ones.  The triggers cut a text into phrases; a
*unit* is the run of strings with one trigger value, that is a phrase with the
bytes that its last string reaches into the next ones.  Units of one trigger
hold all occurrences of a repeated string, so:

1. texts are gathered into chunks (a stored table; a text is never split);
2. per chunk the distinct trigger values go to their bucket, which returns
   those that more than one document has: most of the corpus ends here;
3. per chunk the distinct units of the returned triggers (the dictionary, with
   the smallest document of each) go to buckets.  A bucket orders all suffixes
   of its dictionary by their first ``width`` bytes (prefix doubling: ranks by
   8, 16, 32, then ``width`` bytes), so equal strings are neighbours, and takes
   the smallest document of each class: the corpus order as far as it matters;
4. chunks take the classes' smallest documents back along their parse and
   remove what a smaller doc_id already has.

A unit travels once per chunk however often it occurs there, so a passage that
a third of all documents share does not weigh on one task.  Only ranks decide;
hashes select buckets and never equate strings.

Defined results: null or empty text, texts under ``width`` bytes: nothing
removed; rows with one doc_id are not smaller than each other; a null doc_id
counts as larger than any other; empty table: empty result; further columns
are ignored."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import CHUNK_BYTES, cut, text_bytes, text_chunks

WIDTH = 50
GRAM = 20
CHUNK = 12 << 20
BLOCK = 2 << 20
LAST = np.iinfo(np.int64).max
_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def _pack(*arrays: np.ndarray | bytes) -> bytes:
    """Arrays (or bytes) as one compressed blob, each with its length."""
    raw = [a if isinstance(a, bytes) else np.ascontiguousarray(a).tobytes() for a in arrays]
    head = np.array([len(raw), *map(len, raw)], "<i8").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(raw))


def _unpack(blob: bytes) -> list[bytes]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    ends = np.cumsum(np.frombuffer(raw, "<i8", n, 8)) + 8 * (n + 1)
    return [raw[a:b] for a, b in zip([8 * (n + 1), *ends[:-1].tolist()], ends.tolist())]


def _words64(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position on as an unsigned integer (big-endian order)."""
    raw = np.concatenate([data, np.zeros(16, np.uint8)])
    out = np.empty(len(data) + 8, np.uint64)
    for s in range(8):
        part = np.frombuffer(raw, ">u8", (len(raw) - s) // 8, s)
        view = out[s::8]
        n = min(len(view), len(part))
        view[:n] = part[:n]
    return out[:len(data)]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _M[3]
    return x ^ (x >> np.uint64(29))


def units(data: np.ndarray, offsets: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, ...]:
    """(trigger value, document, first byte, number of strings) of each unit of the
    documents data[offsets[d]:offsets[d + 1]]; first byte within the document."""
    lengths = np.diff(offsets)
    out: list[tuple[np.ndarray, ...]] = []
    at = 0
    while at < len(lengths):  # blocks of documents, to bound the arrays
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + BLOCK, "right")) - 1)
        block, begin = data[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at]
        at, first = to, at
        n = len(block) - width + 1
        if n < 1:
            continue
        w = _words64(block)
        size = len(block) - GRAM + 1
        h = _mix((w[:size] * _M[0]) ^ _mix(w[8:size + 8] * _M[1]) ^ (w[GRAM - 8:size + GRAM - 8] * _M[2]))
        span, low = 1, h
        while 2 * span <= width - GRAM + 1:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        rest = width - GRAM + 1 - span
        low = np.minimum(low[:n], low[rest:rest + n])
        marks = np.zeros(n + 1, np.int32)  # strings that would cross a document's end
        np.add.at(marks, np.minimum(np.maximum(begin[1:] - width + 1, begin[:-1]), n), 1)
        np.add.at(marks, np.minimum(begin[1:], n), -1)
        inside = np.cumsum(marks[:n]) == 0
        fresh = np.append(True, low[1:] != low[:-1])
        fresh[1:] |= ~inside[:-1]
        starts = np.flatnonzero(inside & fresh)
        stops = np.flatnonzero(inside & np.append(fresh[1:] | ~inside[1:], True)) + 1
        doc = np.searchsorted(begin, starts, "right") - 1
        out.append((_mix(low[starts]) >> np.uint64(16), doc + first, starts - begin[doc], stops - starts))
    if not out:
        return tuple(np.empty(0, t) for t in (np.uint64, np.int64, np.int64, np.int64))
    return tuple(np.concatenate(x) for x in zip(*out))


def chunked(docs: DataFrame, chunk_bytes: int = CHUNK) -> DataFrame:
    """Stored table of chunks: chunk, n_bytes, docs (doc_ids, offsets, bytes; compressed)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        ids: list = []
        data: list[np.ndarray] = []
        sizes: list[np.ndarray] = []

        def chunk() -> pa.RecordBatch:
            known = np.array([i is not None for i in ids], np.uint8)
            whole = np.concatenate(data)
            offsets = np.concatenate(([0], np.cumsum(np.concatenate(sizes))))
            blob = _pack(np.array([LAST if i is None else i for i in ids], np.int64), known, offsets, whole)
            return pa.RecordBatch.from_arrays([pa.array([(part << 32) + seq]), pa.array([len(whole)]), pa.array([blob])],
                                              names=["chunk", "n_bytes", "docs"])

        for batch in text_chunks(batches, limit=min(CHUNK_BYTES, chunk_bytes)):
            raw, offsets = text_bytes(batch.column("text"))
            if ids and sum(map(len, data)) + len(raw) > chunk_bytes:
                yield chunk()
                seq, ids, data, sizes = seq + 1, [], [], []
            ids += batch.column("doc_id").to_pylist()
            data.append(raw)
            sizes.append(np.diff(offsets))
        if ids:
            yield chunk()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return cut(rows.mapInArrow(run, "chunk long, n_bytes long, docs binary"), "chunks")


def _load(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    ids, known, offsets, data = _unpack(blob)
    return np.frombuffer(ids, np.int64), np.frombuffer(known, np.uint8), np.frombuffer(offsets, np.int64), np.frombuffer(data, np.uint8)


def _first(sorted_values: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.append(True, sorted_values[1:] != sorted_values[:-1])) if len(sorted_values) else np.empty(0, np.int64)


def _buckets(values: np.ndarray, n: int) -> np.ndarray:
    """Bucket of 48-bit values, by range: ascending for sorted values."""
    return ((values >> np.uint64(16)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def shared_triggers(chunks: DataFrame, buckets: int, width: int) -> DataFrame:
    """(chunk, triggers): per chunk and bucket the trigger values that another
    chunk, or another document of the chunk, has too."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, blob in zip(batch.column("chunk").to_pylist(), batch.column("docs")):
                ids, _, offsets, data = _load(blob.as_py())
                value, doc, _, _ = units(data, offsets, width)
                order = np.argsort(value, kind="stable")
                value, owner = value[order], ids[doc[order]]
                first = _first(value)
                if not len(first):
                    continue
                several = np.minimum.reduceat(owner, first) != np.maximum.reduceat(owner, first)
                value = value[first]
                bucket = _buckets(value, buckets)
                ends = np.append(_first(bucket), len(bucket))
                rows = [_pack(np.diff(value[a:b], prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T, several[a:b])
                        for a, b in zip(ends, ends[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket[ends[:-1]].astype(np.int32)), pa.array([chunk] * len(rows)), pa.array(rows)],
                    names=["bucket", "chunk", "found"])

    def meet(table: pa.Table) -> pa.Table:
        values, flags = [], []
        for blob in table.column("found").to_pylist():
            planes, several = _unpack(blob)
            deltas = np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(8, -1).T).view(np.uint64).ravel()
            values.append(np.cumsum(deltas, dtype=np.uint64))
            flags.append(np.frombuffer(several, bool))
        every = np.sort(np.concatenate(values))
        twice = every[1:][every[1:] == every[:-1]]
        common = twice[_first(twice)]
        chunks, out = [], []
        for chunk, value, several in zip(table.column("chunk").to_pylist(), values, flags):
            at = np.searchsorted(common, value)
            kept = several | (np.append(common, np.uint64(LAST))[at] == value)
            if kept.any():
                chunks.append(chunk)
                out.append(_pack(value[kept]))
        return pa.table({"chunk": pa.array(chunks, pa.int64()), "triggers": pa.array(out, pa.binary())})

    sent = chunks.select("chunk", "docs").mapInArrow(send, "bucket int, chunk long, found binary")
    return sent.groupBy("bucket").applyInArrow(meet, "chunk long, triggers binary")


def rank_prefixes(data: np.ndarray, width: int, room: np.ndarray | None = None) -> np.ndarray:
    """Rank of the ``width`` bytes from each position on among all of them, that
    is the suffix order of ``data`` cut at ``width`` bytes (``width`` > 16).  With
    ``room``, the bytes from each position to its unit's end, prefixes that reach
    beyond it are not ordered: no string needs them (their rank is 0)."""

    def dense(key: np.ndarray, at: np.ndarray | slice) -> np.ndarray:
        order = np.argsort(key)
        ordered = key[order]
        rank = np.zeros(len(data), np.uint64)
        rank[order if isinstance(at, slice) else at[order]] = np.cumsum(np.append(False, ordered[1:] != ordered[:-1])).astype(np.uint64)
        return rank

    def held(span: int) -> np.ndarray | slice:
        return slice(None) if room is None else np.flatnonzero(room >= span)

    at = held(8)
    rank, span = dense(_words64(data)[at], at), 8
    while span < width:
        step = min(span, width - span)
        span += step
        at = held(span)
        later = np.concatenate([rank[step:], np.zeros(min(step, len(rank)), np.uint64)])
        rank = dense((rank[at] << np.uint64(32)) | later[at], at)
    return rank


def smallest_owners(contents: list[bytes], owner: np.ndarray, width: int) -> list[np.ndarray]:
    """For each distinct unit: per string the smallest document among all units."""
    sizes = np.array([len(c) for c in contents], np.int64)
    data = np.frombuffer(b"".join(contents), np.uint8)
    ends = np.cumsum(sizes)
    rank = rank_prefixes(data, width, np.repeat(ends, sizes) - np.arange(len(data)))
    starts = ends - sizes
    count = sizes - width + 1
    total = np.cumsum(count)
    strings = np.arange(int(total[-1])) + np.repeat(starts - (total - count), count)
    of = np.repeat(owner, count)
    group = rank[strings]
    order = np.argsort(group)
    first = _first(group[order])
    least = np.minimum.reduceat(of[order], first)
    out = np.empty(len(strings), np.int64)
    out[order] = np.repeat(least, np.diff(np.append(first, len(order))))
    return np.split(out, total[:-1])


def owners(chunks: DataFrame, shared: DataFrame, buckets: int, width: int) -> DataFrame:
    """(chunk, found): per chunk and bucket, runs of strings of its dictionary units
    with the smallest document that has them (where that is not the unit's own)."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, blob, lists in zip(batch.column("chunk").to_pylist(), batch.column("docs"), batch.column("triggers")):
                wanted = np.sort(np.concatenate([np.frombuffer(_unpack(b)[0], np.uint64) for b in lists.as_py()]))
                bucket, rows = [], []
                for b, unit in _dictionary(_load(blob.as_py()), wanted, width, buckets):
                    bucket.append(b)
                    rows.append(unit)
                yield pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), pa.array([chunk] * len(rows), pa.int64()),
                                                  pa.array(rows, pa.binary())], names=["bucket", "chunk", "units"])

    def meet(table: pa.Table) -> pa.Table:
        index: dict[bytes, int] = {}
        owner: list[int] = []
        parts = []
        for blob in table.column("units").to_pylist():
            sizes, least, most, raw = _unpack(blob)
            ends = np.cumsum(np.frombuffer(sizes, np.uint32).astype(np.int64)).tolist()
            least = np.frombuffer(least, np.int64)
            mine = np.empty(len(ends), np.int64)
            a = 0
            for i, b in enumerate(ends):
                content = raw[a:b]
                a = b
                at = index.setdefault(content, len(owner))
                if at == len(owner):
                    owner.append(int(least[i]))
                elif least[i] < owner[at]:
                    owner[at] = int(least[i])
                mine[i] = at
            parts.append((mine, np.frombuffer(most, np.int64)))
        found = smallest_owners(list(index), np.array(owner, np.int64), width)
        chunks, out = [], []
        for chunk, (mine, most) in zip(table.column("chunk").to_pylist(), parts):
            runs: list[tuple[int, int, int, int]] = []
            for i, at in enumerate(mine.tolist()):
                least = found[at]
                if least.min() < most[i]:
                    cuts = [0, *(np.flatnonzero(least[1:] != least[:-1]) + 1).tolist(), len(least)]
                    runs += [(i, a, b, int(least[a])) for a, b in zip(cuts, cuts[1:]) if least[a] < most[i]]
            if runs:
                chunks.append(chunk)
                out.append(_pack(np.array(runs, np.int64)))
        return pa.table({"chunk": pa.array(chunks, pa.int64()), "bucket": pa.array([table.column("bucket")[0].as_py()] * len(chunks), pa.int32()),
                         "found": pa.array(out, pa.binary())})

    both = chunks.select("chunk", "docs").join(shared.groupBy("chunk").agg(F.collect_list("triggers").alias("triggers")), "chunk")
    sent = both.mapInArrow(send, "bucket int, chunk long, units binary")
    return sent.groupBy("bucket").applyInArrow(meet, "chunk long, bucket int, found binary")


def _chosen(data: np.ndarray, offsets: np.ndarray, wanted: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """Units whose trigger is in ``wanted`` (sorted), by trigger value."""
    value, doc, start, count = units(data, offsets, width)
    at = np.searchsorted(wanted, value)
    keep = np.append(wanted, np.uint64(LAST))[at] == value
    value, doc, start, count = (x[keep] for x in (value, doc, start, count))
    order = np.argsort(value, kind="stable")
    return tuple(x[order] for x in (value, doc, start, count))


def _parse(chunk: tuple, wanted: np.ndarray, width: int, buckets: int) -> Iterator[tuple[int, list[bytes], np.ndarray, tuple]]:
    """Per bucket: the chunk's distinct units, and the unit number, document and
    first byte of each occurrence.  The same on every call."""
    _, _, offsets, data = chunk
    value, doc, start, count = _chosen(data, offsets, wanted, width)
    bucket = _buckets(value, buckets)
    ends = np.append(_first(bucket), len(bucket))
    raw = data.tobytes()
    begin = (offsets[doc] + start)
    stop = begin + count + width - 1
    for a, b in zip(ends, ends[1:]):
        if a == b:
            continue
        index: dict[bytes, int] = {}
        number = np.fromiter((index.setdefault(raw[x:y], len(index)) for x, y in zip(begin[a:b].tolist(), stop[a:b].tolist())), np.int64, b - a)
        yield int(bucket[a]), list(index), number, (doc[a:b], start[a:b])


def _dictionary(chunk: tuple, wanted: np.ndarray, width: int, buckets: int) -> Iterator[tuple[int, bytes]]:
    ids = chunk[0]
    for bucket, contents, number, (doc, _) in _parse(chunk, wanted, width, buckets):
        least, most = np.full(len(contents), LAST), np.full(len(contents), np.iinfo(np.int64).min)
        np.minimum.at(least, number, ids[doc])
        np.maximum.at(most, number, ids[doc])
        yield bucket, _pack(np.array([len(c) for c in contents], np.uint32), least, most, b"".join(contents))


def removed_mask(chunk: tuple, wanted: np.ndarray, found: dict[int, np.ndarray], width: int, buckets: int) -> np.ndarray:
    """True for each byte of the chunk that a smaller document already has."""
    ids, _, offsets, data = chunk
    edges = np.zeros(len(data) + 1, np.int64)
    for bucket, contents, number, (doc, start) in _parse(chunk, wanted, width, buckets):
        if bucket not in found:
            continue
        runs = found[bucket]  # unit, first string, end, smallest document
        order = np.argsort(number, kind="stable")
        lo, hi = np.searchsorted(number[order], runs[:, 0]), np.searchsorted(number[order], runs[:, 0], "right")
        times = hi - lo
        run = np.repeat(np.arange(len(runs)), times)
        at = order[np.arange(len(run)) + np.repeat(lo - (np.cumsum(times) - times), times)]
        gone = runs[run, 3] < ids[doc[at]]
        base = (offsets[doc[at]] + start[at])[gone]
        np.add.at(edges, base + runs[run, 1][gone], 1)
        np.add.at(edges, base + runs[run, 2][gone] + width - 1, -1)
    return np.cumsum(edges[:-1]) > 0


def _dealt(docs: DataFrame, width: int, chunk_bytes: int) -> tuple[DataFrame, int]:
    """Chunks with their wanted triggers and found owners, and the number of buckets."""
    chunks = chunked(docs, chunk_bytes)
    total = chunks.agg(F.sum("n_bytes")).first()[0] or 0
    first, second = max(8, total >> 25), max(16, total >> 22)
    shared = cut(shared_triggers(chunks, first, width), "triggers")
    found = owners(chunks, shared, second, width)
    lists = shared.groupBy("chunk").agg(F.collect_list("triggers").alias("triggers"))
    runs = found.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "found")).alias("found"))
    return chunks.select("chunk", "docs").join(lists.join(runs, "chunk"), "chunk", "left"), second


def _rows(docs: DataFrame, width: int, chunk_bytes: int, row, schema: str) -> DataFrame:
    """One row per document from ``row(bytes, removed mask)``."""
    dealt, buckets = _dealt(docs, width, chunk_bytes)
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob, lists, runs in zip(batch.column("docs"), batch.column("triggers").to_pylist(), batch.column("found").to_pylist()):
                chunk = ids, known, offsets, data = _load(blob.as_py())
                if runs:
                    wanted = np.sort(np.concatenate([np.frombuffer(_unpack(b)[0], np.uint64) for b in lists]))
                    found = {r["bucket"]: np.frombuffer(_unpack(r["found"])[0], np.int64).reshape(-1, 4) for r in runs}
                    gone = removed_mask(chunk, wanted, found, width, buckets)
                else:
                    gone = np.zeros(len(data), bool)
                rows = [(int(i) if k else None, *row(data[a:b], gone[a:b]))
                        for i, k, a, b in zip(ids, known, offsets, offsets[1:])]
                fields = pa.schema([("doc_id", pa.int64()), *[(n, _TYPES[t.split()[1]]) for n, t in zip(names, schema.split(", "))]])
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), fields)], schema=fields)

    return dealt.select("docs", "triggers", "found").mapInArrow(run, "doc_id long, " + schema)


_TYPES = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}


def _digest(data: np.ndarray, gone: np.ndarray) -> tuple[int, int, int, str]:
    spans = int(np.count_nonzero(np.diff(gone.astype(np.int8), prepend=0) == 1))
    return len(data), int(gone.sum()), spans, hashlib.sha256(data[~gone].tobytes()).hexdigest()


def repeated(docs: DataFrame, width: int = WIDTH, chunk_bytes: int = CHUNK) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    return _rows(docs, width, chunk_bytes, _digest, "n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def deduplicated(docs: DataFrame, width: int = WIDTH, chunk_bytes: int = CHUNK) -> DataFrame:
    """One row per document: doc_id and the bytes that are kept."""
    return _rows(docs, width, chunk_bytes, lambda data, gone: (data[~gone].tobytes(),), "kept binary")
