"""Best-fit packing by exact-complement hashing.

Documents become pieces of at most ``capacity`` tokens.  What goes where is
decided on the histogram of piece lengths, which has at most ``capacity``
entries however many documents there are: starting with the longest length
still available, index its gap's single, pair and triple complements and use
up each combination as many times as the counts allow; what has no exact
complement is placed best-fit, longest first.  The plan is a list of slots
(length, first rank, number, sequence, offset); each piece looks up its slot by
its length and its rank among the pieces of that length.

Defined results: a null text has no tokens but its end token; empty table:
empty result; repeated rows are packed each for itself; a null doc_id is kept;
further columns are ignored."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._common import cut, text_chunks
from .tokens import default_tokenizer, encoder

PIECE_SCHEMA = ("part int, rank long, doc_id long, piece int, start long, length long, "
                "ids_crc32 long, ids binary")


def pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, keep_ids: bool = False) -> DataFrame:
    """One row per piece; ``rank`` counts pieces of a length within ``part``."""
    schema = PIECE_SCHEMA if keep_ids else PIECE_SCHEMA.replace(", ids binary", "")
    end = np.array([end_id], "<u4").tobytes()
    width = 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = np.zeros(capacity + 1, np.int64)
        part = TaskContext.get().partitionId()
        words = encoder(tokenizer)
        for batch in text_chunks(batches):
            cols: list[list] = [[], [], [], [], [], [], []]
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = words.encode(text) + end
                for piece, at in enumerate(range(0, len(ids), width)):
                    blob = ids[at:at + width]
                    n = len(blob) // 4
                    for col, value in zip(cols, (int(ranks[n]), doc, piece, at // 4, n, zlib.crc32(blob), blob)):
                        col.append(value)
                    ranks[n] += 1
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            arrays = [pa.array([part] * len(cols[0]), pa.int32())]
            arrays += [pa.array(c, t) for c, t in zip(cols, types)]
            names = [f.strip().split(" ")[0] for f in schema.split(",")]
            yield pa.RecordBatch.from_arrays(arrays[:len(names)], names=names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


class _Lengths:
    """Counts of lengths, with a bit set of the available ones and its mirror image."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.counts, self.capacity = dict(counts), capacity
        self.bits = self.mirror = 0
        for n, c in counts.items():
            if c:
                self.bits |= 1 << n
                self.mirror |= 1 << (capacity - n)

    def take(self, n: int, times: int) -> None:
        self.counts[n] -= times
        if not self.counts[n]:
            self.bits ^= 1 << n
            self.mirror ^= 1 << (self.capacity - n)

    def put(self, n: int) -> None:
        self.counts[n] += 1
        self.bits |= 1 << n
        self.mirror |= 1 << (self.capacity - n)

    def has(self, n: int) -> bool:
        return n > 0 and bool(self.bits >> n & 1)

    def pair(self, total: int) -> tuple[int, int] | None:
        """Available a <= b with a + b = total, b as long as possible."""
        if total < 2:
            return None
        both = self.bits & (self.mirror >> (self.capacity - total))
        if total % 2 == 0 and self.counts.get(total // 2, 0) == 1:
            both &= ~(1 << (total // 2))
        if not both:
            return None
        b = both.bit_length() - 1
        return total - b, b

    def triple(self, total: int) -> tuple[int, int, int] | None:
        """Available a, b, c with a + b + c = total, the longest as long as possible."""
        left = self.bits & ((1 << max(total - 1, 1)) - 1)
        while left:
            c = left.bit_length() - 1
            if 3 * c < total:
                return None
            left ^= 1 << c
            rest = total - c
            both = self.bits & (self.mirror >> (self.capacity - rest)) if rest >= 2 else 0
            while both:
                b = both.bit_length() - 1
                a = rest - b
                if a > b:
                    break
                both ^= 1 << b
                if all(self.counts[x] >= (a, b, c).count(x) for x in {a, b, c}):
                    return a, b, c
        return None


def complements(histogram: dict[int, int], capacity: int) -> tuple[list[tuple[tuple[int, ...], int]], dict[int, int]]:
    """Patterns that fill a sequence exactly, how many sequences have each, and the
    counts of lengths without a complement."""
    have, patterns, rest = _Lengths(histogram, capacity), [], {}
    for n in sorted(histogram, reverse=True):
        while have.counts[n]:
            gap = capacity - n
            have.take(n, 1)  # the one at hand is not its own complement
            found: tuple[int, ...] | None
            if not gap:
                found = ()
            elif have.has(gap):
                found = (gap,)
            else:
                found = have.pair(gap) or have.triple(gap)
            have.put(n)
            if found is None:
                rest[n] = have.counts[n]
                have.take(n, have.counts[n])
                break
            used = (n, *found)
            times = min(have.counts[x] // used.count(x) for x in set(used))
            for x in set(used):
                have.take(x, times * used.count(x))
            patterns.append((used, times))
    return patterns, rest


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths of one sequence) and how many sequences have each: the
    complements with best-fit for the rest, or best-fit for all if that is fewer
    (few or skewed lengths: exact complements use up what others would need)."""
    patterns, rest = complements(histogram, capacity)
    patterns += best_fit(rest, capacity)
    plain = best_fit(histogram, capacity)
    return min(patterns, plain, key=lambda p: sum(times for _, times in p))


def best_fit(rest: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on counts: equal sequences are handled as one group."""
    by_gap: dict[int, list[list]] = {}
    gaps = 0
    for n in sorted(rest, reverse=True):
        left = rest[n]
        while left:
            fits = gaps >> n
            if fits:
                gap = n + (fits & -fits).bit_length() - 1
                group = by_gap[gap][-1]
                each = min(gap // n, max(1, left // group[1]))
                times = min(group[1], left // each)
                group[1] -= times
                if not group[1]:
                    by_gap[gap].pop()
                    if not by_gap[gap]:
                        gaps ^= 1 << gap
                used = group[0]
            else:
                gap, used = capacity, ()
                each = min(capacity // n, left)
                times = left // each
            left -= each * times
            to = gap - each * n
            by_gap.setdefault(to, []).append([(*used, *[n] * each), times])
            if to:
                gaps |= 1 << to
    return [(used, times) for groups in by_gap.values() for used, times in groups]


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> np.ndarray:
    """(length, first rank, sequence of that rank, offset) by length and first rank."""
    used: dict[int, int] = {}
    out, sequence = [], 0
    for lengths, times in patterns:
        offset = 0
        for n in lengths:
            out.append((n, used.get(n, 0), sequence, offset))
            used[n] = used.get(n, 0) + times
            offset += n
        sequence += times
    return np.array(sorted(out), np.int64).reshape(-1, 4)


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = 4096, end_id: int = 1,
         keep_ids: bool = False) -> DataFrame:
    """Pack ``docs`` (doc_id, text) into sequences of at most ``capacity`` tokens.

    One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset, and the piece's ids with ``keep_ids``."""
    table = cut(pieces(docs, tokenizer or default_tokenizer(), capacity, end_id, keep_ids), "pieces")
    counts = table.groupBy("part", "length").agg(F.count("*").alias("n"))
    total = counts.groupBy("length").agg(F.sum("n").alias("n")).collect()  # at most `capacity` rows
    index = slots(plan({r["length"]: r["n"] for r in total}, capacity))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * keep_ids]
    ranked = table.join(base, ["part", "length"]).select(*names, (F.col("rank") + F.col("base")).alias("rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = np.searchsorted(index[:, 0], np.arange(capacity + 2))
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            at = np.empty(len(rank), np.int64)
            order = np.argsort(length, kind="stable")
            cuts = np.flatnonzero(np.diff(length[order])) + 1
            for rows in np.split(order, cuts) if len(order) else []:
                n = int(length[rows[0]])
                lo, hi = first[n], first[n + 1]
                at[rows] = lo + np.searchsorted(index[lo:hi, 1], rank[rows], "right") - 1
            sequence = index[at, 2] + rank - index[at, 1]
            cols = [batch.column(x) for x in names] + [pa.array(sequence), pa.array(index[at, 3])]
            yield pa.RecordBatch.from_arrays(cols, names=[*names, "sequence_id", "offset"])

    schema = ("doc_id long, piece int, start long, length long, ids_crc32 long"
              + ", ids binary" * keep_ids + ", sequence_id long, offset long")
    return ranked.mapInArrow(place, schema)
