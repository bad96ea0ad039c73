"""Near-duplicates by SimHash with a byte-position inverted index.

A 64-bit fingerprint is eight positional bytes.  ``k`` differing bits touch at
most ``k`` bytes, so linked fingerprints share at least ``8 - k`` positional
bytes.  Posting lists keyed by a single byte would hold 1/256 of all
fingerprints each; they are keyed by several positions at once instead.  With
the positions split into ``g`` halves or quarters, ``8 - k`` shared positions
cannot be spread so thinly that no list of them is met (pigeonhole): for three
bits, any five shared positions of eight include three of one half, so the
eight triples of the two halves (24 bits each) reach every pair.

Within a posting list the shared positional bytes of a pair are tallied; only
pairs reaching the guaranteed minimum are verified by their bit distance.  A list
is cut into chunks of about ``CHUNK`` fingerprints, and each pair of chunks is
worked off by itself, so that no list has to fit into one task.  A list of more
than ``LARGE`` is keyed anew first: by the guaranteed number of positions, then
also by a block of the bits left over (of ``k + 1`` blocks one has no differing
bit).  A unit gives a spanning forest of its links, not all of them: the
components stay the same, and the output stays linear in the fingerprints read.

Equal fingerprints are one node; documents are counted by node only.

Defined results: null or empty text: fingerprint zero, linked like any other;
fewer words than a shingle: the whole sequence is the one shingle; repeated
rows: one row each; null doc_id: kept, never a representative unless alone;
empty table: empty result; further columns are ignored.  ``keep_one`` keeps one row
of each component: of the smallest doc_id (a null one last), then of the smallest
text hash, then any of equal ones."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import cut, fresh, text_chunks
from .components import components

CHUNK = 1024
LARGE = 32 * CHUNK
SEED = 42
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of the word shingles of a text: a bit is set if over half the
    shingle hashes (XXH64, seed 42) have it."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(g, SEED) for g in grams], "<u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        block = hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, more: dict[str, Column] | None = None) -> DataFrame:
    """(doc_id, fp, ...): the fingerprint as a signed long; ``more`` are long columns of ``docs``."""
    extra = list(more or {})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches):
            fps = np.array([fingerprint(t, shingle) for t in batch.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps.view(np.int64)), *map(batch.column, extra)],
                                             names=["doc_id", "fp", *extra])

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *[c.alias(k) for k, c in (more or {}).items()])
    return read.mapInArrow(run, "doc_id long, fp long" + "".join(f", {k} long" for k in extra))


def position_sets(max_distance: int) -> list[tuple[int, ...]]:
    """Sets of byte positions, one of which every linked pair shares wholly."""
    shared = 8 - max_distance
    if shared < 1:
        raise ValueError("max_distance must be at most 7")
    groups = 2 if shared > 4 else 4 if shared == 4 else 8
    size = -(-shared // groups)
    width = 8 // groups
    return [c for g in range(groups) for c in combinations(range(g * width, (g + 1) * width), size)]


def _mask(positions: tuple[int, ...]) -> int:
    return sum(0xFF << (8 * p) for p in positions)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def key_masks(max_distance: int) -> list[dict[int, list[int]]]:
    """Bits that key the posting lists, level by level: each mask of a level with the
    masks that key a large list of it anew.  A pair within ``max_distance`` that
    shares the bits of a mask shares those of one of its successors."""
    shared = 8 - max_distance
    first, finer = {}, {}
    for positions in position_sets(max_distance):
        rest = [p for p in range(8) if p not in positions]
        wider = [positions + more for more in combinations(rest, shared - len(positions))]
        first[_mask(positions)] = sorted({_mask(w) for w in wider})
    for mask in sorted({m for masks in first.values() for m in masks}):
        free = [bit for bit in range(64) if not mask >> bit & 1]
        blocks = [free[i::max_distance + 1] for i in range(max_distance + 1)]
        finer[mask] = [mask | sum(1 << bit for bit in block) for block in blocks]
    return [first, finer, {m: [] for masks in finer.values() for m in masks}]


def _near(apart: np.ndarray, max_distance: int) -> np.ndarray:
    """Places of the pairs (given as the bits in which they differ) that are linked:
    tally of shared positional bytes first, then the bit distance of those left."""
    shared = (apart.view(np.uint8).reshape(-1, 8) == 0).sum(1)
    able = np.flatnonzero(shared >= 8 - max_distance)
    return able[np.bitwise_count(apart[able]) <= max_distance]


def _forest(fps: np.ndarray, max_distance: int) -> list[tuple[int, int]]:
    """Spanning forest of the links among the fingerprints of one unit.  Where the
    unit has two chunks it still walks all of them: links within a chunk only
    help to join its members."""
    left = fps.copy()
    edges: list[tuple[int, int]] = []
    while len(left):
        queue, left = [left[-1]], left[:-1]
        while queue and len(left):
            at = queue.pop()
            near = _near(left ^ at, max_distance)
            if len(near):
                found = left[near]
                edges += [(int(at), int(x)) for x in found.view(np.int64)]
                queue += list(found)
                left = np.delete(left, near)
    return edges


def units_of(nodes: DataFrame, max_distance: int) -> DataFrame:
    """(fp, s, v, i, j): fingerprints dealt to units of work, pairs of chunks ``i`` and ``j``
    of the list of fingerprints whose bits under the mask ``s`` are ``v``."""
    levels = key_masks(max_distance)
    postings = nodes.select("fp", F.explode(F.array(*[F.lit(_signed(m)) for m in levels[0]])).alias("s"))
    units = None
    for at, masks in enumerate(levels):
        postings = postings.withColumn("v", F.col("fp").bitwiseAND(F.col("s")))
        lists = cut(postings.groupBy("s", "v").count().where("count > 1"), "simhash-lists")
        large = lists.where(F.col("count") > LARGE) if at + 1 < len(levels) else lists.where("false")
        small = lists.join(large, ["s", "v"], "left_anti") if at + 1 < len(levels) else lists
        met = postings.join(small.withColumn("chunks", F.ceil(F.col("count") / CHUNK).cast("int")), ["s", "v"])
        met = met.withColumn("c", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int"))
        # chunk c takes part in the units (c, j) and (j, c) for every chunk j
        dealt = met.select("fp", "s", "v", "c", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("j")).select(
            "fp", "s", "v", F.least("c", "j").alias("i"), F.greatest("c", "j").alias("j"))
        units = dealt if units is None else units.unionByName(dealt)
        if at + 1 == len(levels) or large.isEmpty():
            return units
        successors = F.create_map(*[F.lit(x) for m, more in masks.items() for x in (_signed(m), [_signed(y) for y in more])])
        again = postings.join(large.select("s", "v"), ["s", "v"]).select("fp", F.explode(successors[F.col("s")]).alias("s"))
        postings = cut(again.distinct(), "simhash-postings")
    raise AssertionError("the last level returns")


def links(nodes: DataFrame, max_distance: int = 3) -> DataFrame:
    """Edges (a, b) that join every pair of distinct fingerprints ``fp`` within
    ``max_distance`` bits, directly or by way of others."""
    units = units_of(nodes, max_distance)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        names = ["s", "v", "i", "j", "fp"]

        def done(rows: np.ndarray) -> pa.RecordBatch:
            key = rows[:, :4]
            ends = np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1
            fps = np.ascontiguousarray(rows[:, 4])
            sizes = np.diff(np.concatenate(([0], ends, [len(rows)])))
            starts = np.concatenate(([0], ends))
            twos = starts[sizes == 2]  # most lists: one pair, all at once
            near = twos[_near((fps[twos] ^ fps[twos + 1]).view(np.uint64), max_distance)]
            a, b = [fps[near]], [fps[near + 1]]
            for at, size in zip(starts[sizes > 2], sizes[sizes > 2]):
                found = _forest(fps[at:at + size].view(np.uint64), max_distance)
                if found:
                    pairs = np.array([(_signed(x), y) for x, y in found], np.int64)
                    a.append(pairs[:, 0])
                    b.append(pairs[:, 1])
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.column_stack([batch.column(n).to_numpy().astype(np.int64) for n in names])
            held.append(rows)
            rows = np.concatenate(held)
            last = np.flatnonzero((rows[:, :4] != rows[-1, :4]).any(1))
            to = int(last[-1]) + 1 if len(last) else 0
            if to:
                yield done(rows[:to])
            held = [rows[to:]]
        if held and len(held[0]):
            yield done(held[0])

    dealt = units.repartition("s", "v", "i", "j").sortWithinPartitions("s", "v", "i", "j", "fp")
    return dealt.mapInArrow(run, "a long, b long")


def classes(prints: DataFrame, max_distance: int) -> DataFrame:
    """(fp, component_id) of a table of fingerprints (doc_id, fp)."""
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    roots = components(links(nodes, max_distance))
    named = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return named.join(smallest, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = 3, max_distance: int = 3) -> DataFrame:
    """One row per document: doc_id, fingerprint (hex), component_id (smallest
    doc_id reachable over links of at most ``max_distance`` differing bits)."""
    prints = cut(fingerprints(docs, shingle), "fingerprints")
    return prints.join(classes(prints, max_distance), "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, max_distance: int = 3) -> DataFrame:
    """One row of each component, all its columns kept."""
    digest, number = fresh(docs, "digest"), fresh(docs, "number")
    text_of = F.xxhash64("text")
    prints = cut(fingerprints(docs, shingle, {"digest": text_of}), "fingerprints")
    rows = (prints.join(classes(prints, max_distance).select("fp", "root"), "fp")
            .groupBy("root", "doc_id", "digest").agg(F.count("*").alias("n")))
    rows = cut(rows.withColumn("order", F.struct(F.col("doc_id").isNull(), "doc_id", "digest")), "simhash-rows")
    first = rows.groupBy("root").agg(F.min("order").alias("first"))
    judged = rows.join(first, "root").select(F.col("doc_id").alias(number), F.col("digest").alias("_digest"), "n",
                                             (F.col("order") == F.col("first")).alias("stays"))
    judged = cut(judged.where("not stays or n > 1"), "simhash-judged")
    tagged = docs.withColumn(digest, text_of)
    same = tagged["doc_id"].cast("long").eqNullSafe(F.col(number)) & (tagged[digest] == F.col("_digest"))
    kept = tagged.join(judged, same, "left_anti").select(*docs.columns)
    repeated = judged.where("stays")
    if repeated.isEmpty():
        return kept
    once = tagged.join(repeated, same, "left_semi").dropDuplicates(["doc_id", digest]).select(*docs.columns)
    return kept.unionByName(once)
