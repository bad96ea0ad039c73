"""Benchmark decontamination with DataFrame operations only.

Windows of a document as long as a benchmark item are compared with the item by
SimHash; a multi-index over blocks of the fingerprints finds every window
within the radius (radius + 1 blocks: one at least is untouched), and the
exact similarity of the weighted shingles (weight: how often a shingle occurs;
sum of minima over sum of maxima) decides.

Which windows are fingerprinted: a window of ``s`` shingles (as many as the
item's ``m``, fewer at the end of a text) has similarity ``t`` only if it shares
t(s+m)/(1+t) shingles with the item, so only windows holding that many positions
whose shingle is in the item can pass, and a best one starts at such a position
(moving a window right over a position without loses nothing).  This cut is
exact; without it every position of the corpus would be fingerprinted once per
item length.

Which texts are looked at: a match holds ``similarity`` of an item's ``m`` shingles, so
of any m - ceil(similarity m) + 1 of them one at least.  The ones that the fewest
items have nominate texts for their item; a shingle that many items share fans out
over items in nominated texts only.

The benchmark's shingles are broadcast only below ``BROADCAST_BYTES``; beyond,
the join shuffles.  Verdicts belong to texts, so copies are judged once.

Defined results: null or empty text: clean; an item without words matches
nothing; a text or item with fewer words than a shingle is one shingle; empty
tables: no match; repeated rows: one row each; further columns are ignored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._common import cut, fresh

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 20
BROADCAST_BYTES = 32 << 20


def words(text: Column) -> Column:
    """Lower-cased runs of characters that are neither white space nor ASCII marks."""
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\s\p{Punct}]+")
    return F.array_remove(parts, "")


def shingles(column: str, width: int) -> Column:
    """Hashes of the word shingles of array ``column``; none for no words."""
    starts = F.sequence(F.lit(1), F.greatest(F.size(column) - width + 1, F.lit(1)))
    return F.when(F.size(column) > 0, F.transform(starts, lambda i: F.xxhash64(F.slice(F.col(column), i, width)))).otherwise(
        F.array().cast("array<bigint>"))


def text_key() -> list[Column]:
    """Two hashes that stand for a text: its verdict is the same wherever it occurs."""
    return [F.xxhash64("text").alias("k1"), F.xxhash64(F.lit(7), F.col("text")).alias("k2")]


def fingerprints(each: DataFrame, by: list[str], name: str) -> DataFrame:
    """SimHash of the hashes ``h`` of each group (a row for each occurrence): the
    bits set in over half.  Each sum counts two bits, one in each half of a long."""
    two = F.lit((1 << 32) + 1)
    sums = [F.sum(F.shiftrightunsigned("h", b).bitwiseAND(two)).alias(f"s{b}") for b in range(32)]
    counted = each.groupBy(*by).agg(F.count("*").alias("n"), *sums)

    def bit(b: int) -> Column:
        ones = F.col(f"s{b % 32}").bitwiseAND(F.lit((1 << 32) - 1)) if b < 32 else F.shiftrightunsigned(f"s{b % 32}", 32)
        return F.when(2 * ones > F.col("n"), F.lit(1 << b if b < 63 else -(1 << 63))).otherwise(F.lit(0).cast("long"))

    bits = F.array(*[bit(b) for b in range(64)])
    return counted.select(*by, F.aggregate(bits, F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x)).alias(name))


def blocks(fp: str, radius: int) -> Column:
    """(block number, its bits): radius + 1 disjoint blocks of the fingerprint."""
    edges = [64 * i // (radius + 1) for i in range(radius + 2)]
    return F.array(*[F.struct(F.lit(i).alias("block"),
                              F.shiftrightunsigned(F.col(fp), a).bitwiseAND(F.lit((1 << (b - a)) - 1)).alias("bits"))
                     for i, (a, b) in enumerate(zip(edges, edges[1:]))])


def _bounded(df: DataFrame, bytes_per_row: int, arrays: str | None = None) -> DataFrame:
    """Broadcast ``df`` if its checked size allows (eight bytes for each element of the
    column ``arrays``), else leave the join to shuffle."""
    size = F.lit(bytes_per_row) + (F.lit(0) if arrays is None else 8 * F.size(arrays))
    return F.broadcast(df) if (df.agg(F.sum(size.cast("long"))).first()[0] or 0) <= BROADCAST_BYTES else df


def nominators(bench: DataFrame, similarity: float) -> DataFrame:
    """(h, item_id): of each item the shingles that the fewest items have, so many of
    its occurrences that a match cannot miss them all."""
    common = bench.select("item_id", "h").distinct().groupBy("h").agg(F.count("*").alias("items"))
    place = F.row_number().over(Window.partitionBy("item_id").orderBy("items", "h"))
    ranked = bench.join(common, "h").withColumn("place", place)
    return ranked.where(F.col("place") <= F.col("m") - F.ceil(F.col("m") * similarity - 1e-9) + 1).select("h", "item_id").distinct()


def matches(docs: DataFrame, items: DataFrame, width: int = SHINGLE, similarity: float = SIMILARITY,
            radius: int = RADIUS) -> DataFrame:
    """(k1, k2, item_id, start, similarity): windows of texts that match an item."""
    bench = items.select("item_id", words(F.col("text")).alias("w")).select("item_id", shingles("w", width).alias("s"))
    bench = bench.select("item_id", F.size("s").alias("m"), F.explode_outer("s").alias("h"))
    bench = cut(bench.where("h is not null"), "benchmark-shingles")

    def need(start: Column) -> Column:
        """Positions that the window at ``start`` has to hold, by the size it has there."""
        size = F.least(F.col("m"), F.col("total") - start)
        return F.ceil((size + F.col("m")) * (similarity / (1 + similarity)) - 1e-9).cast("int")

    # texts that hold a nominating shingle of an item (outer: the plain form makes
    # Catalyst add a filter that computes the words once more for every shingle)
    total = F.greatest(F.size("w") - width + 1, F.lit(1)).alias("total")
    rows = docs.select(*text_key(), words(F.col("text")).alias("w")).select("k1", "k2", shingles("w", width).alias("s"))
    rare = cut(nominators(bench, similarity), "benchmark-nominators")
    hits = rows.select("k1", "k2", F.explode_outer("s").alias("h")).join(_bounded(rare, 16), "h")
    nominated = cut(hits.select("k1", "k2", "item_id").distinct(), "nominated")
    texts = _bounded(nominated.select("k1", "k2").distinct(), 16)
    rows = docs.select(*text_key(), "text").join(texts, ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"])
    rows = rows.select("k1", "k2", words(F.col("text")).alias("w")).select("k1", "k2", total, shingles("w", width).alias("s"))
    rows = cut(rows, "nominated-texts")

    # their positions whose shingle is in such an item
    wanted = bench.select("h", "item_id", "m").distinct()
    at = rows.select("k1", "k2", "total", F.posexplode("s").alias("pos", "h"))
    anchors = at.join(_bounded(wanted, 24), "h").join(nominated, ["k1", "k2", "item_id"], "left_semi").select(
        "k1", "k2", "total", "item_id", "m", "pos")
    # a window of similarity t has t * m shingles at least, all of them shared
    groups = (anchors.groupBy("k1", "k2", "total", "item_id", "m").agg(F.sort_array(F.collect_set("pos")).alias("p"))
              .where(F.size("p") >= F.ceil(F.col("m") * similarity - 1e-9)))
    enough = F.filter("p", lambda x, i: F.get("p", i + need(x) - 1) <= x + F.col("m") - 1)
    starts = groups.select("k1", "k2", "item_id", "m", enough.alias("starts")).where(F.size("starts") > 0)
    starts = cut(starts, "window-starts")

    # the shingles of those windows
    windows = (rows.join(starts, ["k1", "k2"]).select("k1", "k2", "item_id", "m", "s", F.explode("starts").alias("start"))
               .select("k1", "k2", "item_id", "start", F.slice("s", F.col("start") + 1, F.col("m")).alias("s")))
    windows = cut(windows, "windows")
    window = ["k1", "k2", "item_id", "start"]

    # multi-index: one equal block at least, then the distance
    each = windows.select(*window, F.explode_outer("s").alias("h"))
    prints = fingerprints(each, window, "fp")
    item_prints = fingerprints(bench, ["item_id"], "item_fp")
    left = prints.select(*window, "fp", F.explode(blocks("fp", radius)).alias("b")).select(*window, "fp", "b.*")
    right = item_prints.select("item_id", "item_fp", F.explode(blocks("item_fp", radius)).alias("b")).select("item_id", "item_fp", "b.*")
    near = (left.join(right, ["item_id", "block", "bits"])
            .where(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= radius).select(*window).distinct())

    # exact similarity of the weighted shingles
    weights = each.groupBy(*window, "h").agg(F.count("*").alias("n"))
    item_weights = bench.groupBy("item_id", "m", "h").agg(F.count("*").alias("item_n"))
    sizes = windows.select(*window, F.size("s").alias("size"))
    shared = (weights.join(item_weights, ["item_id", "h"]).groupBy(*window, "m").agg(F.sum(F.least("n", "item_n")).alias("both")))
    exact = shared.join(sizes, window).withColumn("similarity", F.col("both") / (F.col("size") + F.col("m") - F.col("both")))
    return near.join(exact, window).where(F.col("similarity") >= similarity).select(*window, "similarity")


def decontaminate(docs: DataFrame, items: DataFrame, **how) -> DataFrame:
    """One row per document: doc_id, contaminated, n_items, items, similarity (the best)."""
    found = (matches(docs, items, **how).groupBy("k1", "k2", "item_id").agg(F.max("similarity").alias("similarity"))
             .groupBy("k1", "k2").agg(F.sort_array(F.collect_set("item_id")).alias("items"), F.max("similarity").alias("similarity")))
    found = cut(found, "contaminated")
    rows = docs.select("doc_id", *text_key())
    return rows.join(_bounded(found, 64, "items"), ["k1", "k2"], "left").select(
        "doc_id", F.col("items").isNotNull().alias("contaminated"), F.coalesce(F.size("items"), F.lit(0)).alias("n_items"),
        F.coalesce("items", F.array().cast("array<bigint>")).alias("items"), "similarity")


def keep_clean(docs: DataFrame, items: DataFrame, **how) -> DataFrame:
    """The documents in which no item was found, all columns kept."""
    found = cut(matches(docs, items, **how).select("k1", "k2").distinct(), "contaminated")
    one, two = fresh(docs, "k1"), fresh(docs, "k2")
    keyed = docs.select("*", *[c.alias(n) for c, n in zip(text_key(), (one, two))])
    gone = _bounded(found.select(F.col("k1").alias(one), F.col("k2").alias(two)), 16)
    return keyed.join(gone, [one, two], "left_anti").select(*docs.columns)
