"""Ranked lexical search by scanning the documents with one automaton.

All terms of all items are patterns of an Aho-Corasick automaton, each between
two blanks (the boundary guards).  A document becomes one string in which every
separator is a blank, so a match is a whole term and the automaton alone counts
``tf``; there is no index of the documents.  Two scans: the first sums document
frequencies and lengths, the second scores every document for the items that
the matched terms map to and keeps the best ``k`` of each item per task; what
tasks found is merged in two steps (tasks in groups, then groups).

Items are dealt into parts so that the terms of a part, which travel to every
task, stay below ``part_bytes`` (measured; an item larger than that is a part of
its own).  Every part scans the documents twice.

Score, in integers: a term's weight is floor(1000 ln((2N+2)/(2df+1))), its share
w * ((10^9 tf) div (1000 tf + 8 m)) with m = 10 + (90 n N) div L.

Defined results: null or termless documents count nowhere; items with one
item_id (null is one too) are one item with all their terms; an item without
terms, or whose terms occur nowhere, has no rows; every row of ``docs`` is a
document of its own, also under a repeated or null doc_id (nulls come last
among equals); empty tables: empty result; further columns are ignored."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._common import Best, cut, text_bytes, text_chunks

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MERGE = 64  # tasks whose best rows meet first
RESULT = "item_id long, doc_id long, score long"


def terms(text: Column) -> Column:
    """The terms of a text, in order."""
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(TERM), 0)


def _plain_bytes() -> np.ndarray:
    """Byte table: letters lower-cased, every separator a blank."""
    table = np.arange(256, dtype=np.uint8)
    for c in range(128):
        table[c] = ord(chr(c).lower()) if chr(c).isalnum() else 32
    return table


class Scanner:
    """The automaton of a list of terms, and the documents as it reads them."""

    def __init__(self, patterns: list[str]):
        self.automaton = ahocorasick.Automaton()
        for at, term in enumerate(patterns):
            self.automaton.add_word(f" {term} ", at)
        if patterns:
            self.automaton.make_automaton()
        self.table = _plain_bytes()

    def read(self, texts: pa.Array) -> Iterator[tuple[int, int, Counter]]:
        """(row, number of terms, tf of each pattern found) of documents with terms."""
        data, offsets = text_bytes(texts)
        data = self.table[data]
        inside = np.zeros(len(data) + 1, bool)  # inside[0]: before the first byte
        np.not_equal(data, 32, out=inside[1:])
        before = inside[:-1].copy()
        before[offsets[:-1][offsets[:-1] < len(data)]] = False  # a document never continues the one before
        starts = np.concatenate(([0], np.cumsum(inside[1:] & ~before)))
        counts = starts[offsets[1:]] - starts[offsets[:-1]]
        raw, second = data.tobytes(), itemgetter(1)
        for row in np.flatnonzero(counts).tolist():
            text = " " + raw[offsets[row]:offsets[row + 1]].decode("utf-8", "replace") + " "
            found = Counter(map(second, self.automaton.iter(text))) if len(self.automaton) else Counter()
            yield row, int(counts[row]), found


def parts_of(pairs: DataFrame, part_bytes: int) -> tuple[DataFrame, int]:
    """``pairs`` (item_id, term) with their part, and the number of parts."""
    sized = pairs.groupBy("item_id").agg(F.sum(F.octet_length("term") + 16).alias("size"))
    n = max(1, -(-(sized.agg(F.sum("size")).first()[0] or 0) // part_bytes))
    while True:
        part = F.pmod(F.xxhash64("item_id"), F.lit(n)).cast("int")
        over = sized.groupBy(part).agg(F.sum("size").alias("size"), F.count("*").alias("items"))
        if over.where(f"size > {2 * part_bytes} and items > 1").isEmpty():
            return pairs.withColumn("part", part), n
        n *= 2


def _frequencies(docs: DataFrame, patterns: list[str]) -> tuple[np.ndarray, int, int]:
    """df of each pattern, number of documents with terms, number of their terms."""
    shared = docs.sparkSession.sparkContext.broadcast(patterns)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner, n_docs, n_terms = Scanner(shared.value), 0, 0
        df = np.zeros(len(shared.value), np.int64)
        for chunk in text_chunks(batches):
            for _, n, found in scanner.read(chunk.column("text")):
                n_docs += 1
                n_terms += n
                df[list(found)] += 1
        used = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(([-2, -1], used))), pa.array(np.concatenate(([n_docs, n_terms], df[used])))],
                                         names=["term", "n"])

    # one row for each pattern: as bounded as the part
    found = dict(docs.mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n")).collect())
    df = np.zeros(len(patterns), np.int64)
    for term, n in found.items():
        if term >= 0:
            df[term] = n
    return df, found.get(-2, 0), found.get(-1, 0)


def _rank_part(docs: DataFrame, rows: list[Row], k: int) -> DataFrame:
    """The best ``k`` documents that each task holds for each item of a part."""
    spark = docs.sparkSession
    patterns = sorted({r["term"] for r in rows})
    at = {term: i for i, term in enumerate(patterns)}
    items = list(dict.fromkeys(r["item_id"] for r in rows))
    place = {item: i for i, item in enumerate(items)}
    df, n_docs, n_terms = _frequencies(docs, patterns)
    if not n_docs:
        return spark.createDataFrame([], RESULT)
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)
    links = np.array(sorted((at[r["term"]], place[r["item_id"]]) for r in rows), np.int64)
    first = np.searchsorted(links[:, 0], np.arange(len(patterns) + 1))
    shared = spark.sparkContext.broadcast((patterns, items, weight, links[:, 1].copy(), first))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns, items, weight, linked, first = shared.value
        scanner, best = Scanner(patterns), Best(len(items), k)
        total = np.zeros(len(items), np.int64)
        for chunk in text_chunks(batches):
            ids = chunk.column("doc_id")
            for row, n, found in scanner.read(chunk.column("text")):
                if not found:
                    continue
                m = 10 + (90 * n * n_docs) // n_terms
                term, tf = np.fromiter(found, np.int64, len(found)), np.fromiter(found.values(), np.int64, len(found))
                share = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
                lengths = first[term + 1] - first[term]
                steps = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
                total[:] = 0
                np.add.at(total, linked[np.repeat(first[term], lengths) + steps], np.repeat(share, lengths))
                hit = np.flatnonzero((total > 0) & (total >= best.least))
                best.add(hit, total[hit], ids[row].as_py())
        group, value, doc = best.rows()
        yield pa.RecordBatch.from_arrays([pa.array([items[g] for g in group.tolist()], pa.int64()), doc, pa.array(value)],
                                         names=["item_id", "doc_id", "score"])

    return docs.mapInArrow(score, RESULT)


def search(docs: DataFrame, items: DataFrame, k: int = 10, part_bytes: int = 8 << 20) -> DataFrame:
    """(item_id, rank, doc_id, score): of every item of ``items`` (item_id, text) its
    ``k`` highest-scoring documents of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    pairs = cut(items.select(F.col("item_id").cast("long").alias("item_id"), F.explode(terms(F.col("text"))).alias("term")).distinct(),
                "item-terms")
    dealt, n = parts_of(pairs, part_bytes)
    found = spark.createDataFrame([], RESULT)
    for part in range(n):
        rows = dealt.where(F.col("part") == part).select("item_id", "term").collect()  # below 2 x part_bytes, or one item
        if rows:
            found = found.unionByName(_rank_part(docs, rows, k))
    found = found.withColumn("group", F.floor(F.spark_partition_id() / MERGE))
    order = (F.desc("score"), F.asc_nulls_last("doc_id"))
    for keys in (["item_id", "group"], ["item_id"]):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)
    return found.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def oracle() -> str:
    found = f"regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}')"
    return f"""
WITH d AS (SELECT doc_id, {found} AS t FROM documents),
n AS (SELECT row_number() OVER () AS r, doc_id, t, len(t) AS n FROM d WHERE len(t) > 0),
g AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM n),
q AS (SELECT DISTINCT item_id, unnest({found}) AS term FROM benchmark),
u AS (SELECT r, doc_id, n, unnest(t) AS term FROM n),
f AS (SELECT r, doc_id, n, term, count(*) AS tf FROM u WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
      FROM f, g GROUP BY term, docs),
c AS (SELECT r, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms))) AS share
      FROM f JOIN w USING (term), g),
s AS (SELECT item_id, r, doc_id, CAST(sum(share) AS BIGINT) AS score FROM q JOIN c USING (term) GROUP BY ALL),
k AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 10"""
