"""Mixing sources to target weights by weighted fair queueing.

Each source's documents stand in a queue in shuffled order (by a digest of id
and text, the same in every run), once per epoch.  A queued document's virtual
finish time is the tokens of its source up to its own end, divided by the
source's target.  All queues are range-sorted by finish time into one and cut
where the total budget is used up; the document on the cut gives its first
words only.  At any point of the merged queue every source has had the same
share of its target, give or take the document in service.

Targets: the budget (``percent`` of all tokens) is shared by weight; a source
stops at ``epochs`` times its own size and the rest is shared again, by rounds
over the table of sources, until none is above.

Hot sources: a queue is cut into buckets by the leading bits of the digest, about
as many as the square root of the number of documents, so neither a bucket nor
the list of a source's bucket sums grows faster than that.

Defined results: size is the number of words (null text: 0); documents without
words and sources without words take 0; a null source is a source, the last
one; rows with a repeated or null doc_id are documents of their own, and equal
rows are interchangeable; empty table: empty result; further columns are
ignored."""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfspark.sinks.writers import dense_index

from ._common import cut

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
PERCENT, EPOCHS = 150, 2
UP_TO_HERE = (Window.unboundedPreceding, 0)
BEFORE = (Window.unboundedPreceding, -1)


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, digest, queue); ``queue`` names the source, null included."""
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select("doc_id", F.col("source").cast("string").alias("source"), words.alias("size"),
                       F.md5(F.concat_ws(":", F.col("doc_id").cast("string"), "text")).alias("digest"),
                       F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n")).alias("queue"))


def targets(rows: DataFrame, weights: tuple[int, ...], percent: int, epochs: int) -> DataFrame:
    """(queue, place, source_size, target): a row for each source."""
    each = rows.groupBy("source", "queue").agg(F.sum("size").alias("source_size"))
    placed = dense_index(each, [F.col("source").isNull(), F.col("source")], start=0, id_col="place")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod("place", F.lit(len(weights))) + 1).cast("int"))
    placed = cut(placed.select("queue", "place", "source_size", weight.cast("long").alias("weight")), "mix-sources")
    total, all_weights = placed.agg(F.sum("source_size"), F.sum("weight")).first()
    size, w, full = F.col("source_size"), F.col("weight"), (0, all_weights)
    while True:  # a round caps more sources than the one before, or is the last
        capped, free = full
        level = (percent * (total or 0) - 100 * epochs * capped) / (100 * free) if free else math.inf
        above = w * F.lit(level) > epochs * size
        now = placed.agg(F.coalesce(F.sum(F.when(above, size)), F.lit(0)), F.coalesce(F.sum(F.when(~above, w)), F.lit(0))).first()
        if free is None or tuple(now) == full or not free:
            break
        full = tuple(now)
    return placed.select("queue", "place", "source_size", F.when(above, epochs * size).otherwise(w * F.lit(level)).cast("double").alias("target"))


def queues(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """(doc_id, size, place, source_size, target, upto): documents with words, and the
    tokens of their source up to their own end."""
    rows = rows.where("size > 0")
    bits = min(32, math.ceil(math.log2(max(1, rows.count())) / 2))
    bucket = F.shiftright(F.conv(F.substring("digest", 1, 8), 16, 10).cast("long"), 32 - bits)
    rows = rows.withColumn("bucket", bucket)
    own = F.sum("size").over(Window.partitionBy("queue", "bucket").orderBy("digest", "doc_id", "size").rowsBetween(*UP_TO_HERE))
    sums = rows.groupBy("queue", "bucket").agg(F.sum("size").alias("held"))
    earlier = F.coalesce(F.sum("held").over(Window.partitionBy("queue").orderBy("bucket").rowsBetween(*BEFORE)), F.lit(0))
    offsets = sums.select("queue", "bucket", earlier.alias("earlier")).join(sources, "queue")
    return rows.withColumn("own", own).join(offsets, ["queue", "bucket"]).select(
        "doc_id", "size", "place", "source_size", "target", (F.col("earlier") + F.col("own")).alias("upto"))


def finish(epoch: Column | int) -> Column:
    """Virtual finish time of a document in an epoch (0 is the first); null without a target."""
    return F.try_divide((F.lit(epoch) * F.col("source_size") + F.col("upto")).cast("double"), F.col("target"))


class Cut(NamedTuple):
    """The entry at which the merged queue ends, and the words it still gives."""

    finish: float
    place: int
    words: int

    def taken(self, at: Column) -> Column:
        """Words the mix takes of an entry with finish time ``at``."""
        before = (at < self.finish) | ((at == self.finish) & (F.col("place") < self.place))
        return F.when(before, F.col("size")).when((at == self.finish) & (F.col("place") == self.place), F.lit(self.words)).otherwise(
            F.lit(0)).cast("long")


def truncate(queue: DataFrame, budget: int, epochs: int) -> Cut:
    """Where the range-sorted entries of all queues have used up ``budget``."""
    times = F.explode(F.array(*[finish(e) for e in range(epochs)])).alias("finish")
    entries = queue.select(times, "place", "size").repartitionByRange("finish", "place").withColumn("range", F.spark_partition_id())
    entries = cut(entries, "mix-entries")
    held = entries.groupBy("range").agg(F.sum("size").alias("held"))  # a row for each range
    upto = held.withColumn("upto", F.sum("held").over(Window.orderBy("range").rowsBetween(*UP_TO_HERE)))
    at = upto.where(F.col("upto") >= budget).orderBy("range").first()
    if at is None:
        return Cut(math.inf, 0, 0)
    first = at["upto"] - at["held"]
    inside = F.lit(first) + F.sum("size").over(Window.orderBy("finish", "place").rowsBetween(*UP_TO_HERE))
    last = entries.where(F.col("range") == at["range"]).withColumn("upto", inside).where(F.col("upto") >= budget).orderBy("upto").first()
    return Cut(last["finish"], last["place"], budget - (last["upto"] - last["size"]))


def _mixed(docs: DataFrame, weights: tuple[int, ...], percent: int, epochs: int) -> tuple[DataFrame, DataFrame, DataFrame, Cut]:
    rows = cut(sizes(docs), "mix-sizes")
    sources = cut(targets(rows, weights, percent, epochs), "mix-targets")
    queue = cut(queues(rows, sources), "mix-queue")
    total = rows.agg(F.sum("size")).first()[0] or 0
    budget = percent * total // 100
    return rows, sources, queue, truncate(queue, budget, epochs) if budget else Cut(-math.inf, 0, 0)


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, percent: int = PERCENT, epochs: int = EPOCHS) -> DataFrame:
    """(doc_id, size, source_size, target, taken): a row for each document of ``docs``
    (doc_id, source, text) with the words that the mix takes of it."""
    rows, sources, queue, end = _mixed(docs, weights, percent, epochs)
    taken = sum((end.taken(finish(e)) for e in range(1, epochs)), end.taken(finish(0)))
    idle = rows.where("size = 0").join(sources, "queue").withColumn("taken", F.lit(0).cast("long"))
    columns = ("doc_id", "size", "source_size", "target", "taken")
    return queue.withColumn("taken", taken).select(*columns).unionByName(idle.select(*columns))


def schedule(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, percent: int = PERCENT, epochs: int = EPOCHS) -> DataFrame:
    """The mix itself: (doc_id, epoch, finish, words), a row for each time a document
    is taken, range-sorted by finish time."""
    _, _, queue, end = _mixed(docs, weights, percent, epochs)
    each = F.explode(F.array(*[F.struct(F.lit(e).alias("epoch"), finish(e).alias("finish")) for e in range(epochs)]))
    drawn = queue.withColumn("entry", each).withColumn("words", end.taken(F.col("entry.finish"))).where("words > 0")
    return drawn.select("doc_id", "entry.epoch", "entry.finish", "words", "place").orderBy("finish", "place").drop("place")


def oracle() -> str:
    queue = "PARTITION BY d.source ORDER BY digest, doc_id, size"
    return f"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS BIGINT) AS size,
                  md5(concat_ws(':', CAST(doc_id AS VARCHAR), text)) AS digest FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
      FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][1 + place % 3] AS weight, CAST(sum(source_size) OVER () AS BIGINT) AS total FROM s),
c AS (SELECT *, coalesce(sum(source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
             sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free,
             row_number() OVER o AS pos FROM w WINDOW o AS (ORDER BY source_size / weight, place)),
l AS (SELECT *, CAST(150 * total - 200 * capped AS DOUBLE) / CAST(100 * free AS DOUBLE) AS level FROM c),
t AS (SELECT source, place, source_size, total, least(weight * (SELECT arg_min(level, pos) FROM l WHERE weight * level <= 2 * source_size),
             CAST(2 * source_size AS DOUBLE)) AS target FROM l),
q AS (SELECT doc_id, size, source_size, target, total, place, row_number() OVER () AS r,
             CAST(sum(size) OVER ({queue} ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (SELECT *, CAST(epoch * source_size + upto AS DOUBLE) / target AS finish FROM q, (VALUES (0), (1)) v(epoch) WHERE size > 0),
m AS (SELECT *, CAST(sum(size) OVER (ORDER BY finish, place ROWS UNBOUNDED PRECEDING) AS BIGINT) AS used FROM e),
k AS (SELECT r, CAST(sum(greatest(0, least(size, 150 * total // 100 - (used - size)))) AS BIGINT) AS taken FROM m GROUP BY r)
SELECT doc_id, size, source_size, target, coalesce(taken, 0) AS taken FROM q LEFT JOIN k USING (r)"""
