import math
import zlib

import xxhash
from pyspark.sql import functions as F

from shelfspark.llm import toxicity as T

from .conftest import prose

INSULTS = ["grunk", "blorf", "snarg", "vexil"]


def corpus(spark, n=900):
    texts = []
    for i in range(n):
        bad = i % 4 == 0
        extra = f" {INSULTS[i % 3]} {INSULTS[(i // 4) % 4]}! " if bad else " "
        texts.append((i, prose(40, i) + extra + prose(30, 5000 + i), int(bad)))
    docs = spark.createDataFrame([t[:2] for t in texts], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in texts if i % 10 != 9], "doc_id long, quality int, toxic int")
    return docs, labels, {i: y for i, _, y in texts}


def test_held_out_accuracy(spark):
    docs, labels, truth = corpus(spark)
    out = T.classify(docs, labels).collect()
    assert len(out) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in out)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in out)
    test = [r for r in out if r.held_out]
    assert sum(r.predicted == truth[r.doc_id] for r in test) >= 0.95 * len(test)
    kept = {r.doc_id for r in T.keep_clean(docs, labels).collect()}
    assert kept == {r.doc_id for r in out if not r.predicted}


def test_held_out_labels_are_never_learnt(spark):
    docs, labels, _ = corpus(spark, 300)
    lied = labels.rdd.map(lambda r: (r.doc_id, 1, 1 - r.toxic if zlib.crc32(str(r.doc_id).encode()) % 3 == 1 else r.toxic)).toDF(labels.schema)
    a = {r.doc_id: r.score for r in T.classify(docs, labels).collect()}
    b = {r.doc_id: r.score for r in T.classify(docs, lied).collect()}
    assert a == b


def test_same_result_whatever_the_partitions_and_within_the_bound(spark):
    docs, labels, _ = corpus(spark, 300)
    a = {r.doc_id: round(r.score, 9) for r in T.classify(docs, labels).collect()}
    b = {r.doc_id: round(r.score, 9) for r in T.classify(docs.repartition(7), labels.repartition(5)).collect()}
    assert a == b
    few = T.classify(docs, labels, max_rows=50).collect()
    assert len(few) == 300


def test_edge_rows(spark, docs, empty):
    labels = spark.createDataFrame([(1, 0), (2, 1), (3, None), (2, 1), (77, 1), (None, 1), (5, 0), (6, 1)], "doc_id long, toxic int")
    out = T.classify(docs, labels)
    assert out.count() == docs.count()
    kept = T.keep_clean(docs, labels)
    assert kept.columns == docs.columns
    none = labels.where("false")
    assert {r.score for r in T.classify(docs, none).collect()} == {0.5}
    assert T.keep_clean(docs, none).count() == docs.count()
    assert T.classify(empty, labels).collect() == []


def test_l1_leaves_a_short_list(spark):
    docs, labels, _ = corpus(spark)
    at, weight = T.fit(docs, labels.selectExpr("doc_id", "toxic as label"))
    assert 0 < len(at) < 2000 and (weight != 0).all()


def plain_features(text):
    """Hashed words, pairs and skip-grams, one at a time, on whole numbers."""
    low = 2**64 - 1
    h = [xxhash.xxh64_intdigest(w.decode().lower().encode().strip(T._EDGE)) for w in (text or "").encode().split()]
    out = {(x * 0xD6E8FEB86659FD93 & low) >> 44 for x in h}
    for gap, mult in ((1, 0x9E3779B97F4A7C15), (2, 0xC2B2AE3D27D4EB4F), (3, 0x165667B19E3779F9)):
        out |= {((h[i] * mult + h[i + gap] & low) * 0xD6E8FEB86659FD93 & low) >> 44 for i in range(len(h) - gap)}
    return sorted(out) + ["bias"]


def plain_ftrl(examples, alpha=2.0, beta=1.0, l1=8.0, l2=0.05, epochs=8, positive_weight=3.0):
    z, n = {}, {}

    def weight(f):
        cut = 0.0 if f == "bias" else l1
        v = z.get(f, 0.0)
        return 0.0 if abs(v) <= cut else -(v - math.copysign(cut, v)) / ((beta + math.sqrt(n.get(f, 0.0))) / alpha + l2)

    def probability(features):
        return 1 / (1 + math.exp(-sum(map(weight, features))))

    for _ in range(epochs):
        for features, label in examples:
            w = {f: weight(f) for f in features}
            g = (positive_weight if label else 1.0) * (1 / (1 + math.exp(-sum(w.values()))) - label)
            for f in features:
                sigma = (math.sqrt(n.get(f, 0.0) + g * g) - math.sqrt(n.get(f, 0.0))) / alpha
                z[f] = z.get(f, 0.0) + g - sigma * w[f]
                n[f] = n.get(f, 0.0) + g * g
    return probability


def test_scores_equal_plain_ftrl(spark, docs):
    some, labels, truth = corpus(spark, 160)
    more = docs.select(F.col("doc_id") + 10000, "text").where("doc_id is not null").dropDuplicates()
    every = some.union(more)
    told = {r.doc_id: r.toxic for r in labels.collect()}
    texts = [(r.doc_id, r.text, r.o) for r in every.select("doc_id", "text", F.xxhash64(F.lit("toxicity"), "doc_id").alias("o")).collect()]
    learnt = sorted((o, i, t) for i, t, o in texts if i in told and zlib.crc32(str(i).encode()) % 3 != 1)
    probability = plain_ftrl([(plain_features(t), told[i]) for _, i, t in learnt])
    got = {r.doc_id: r.score for r in T.classify(every, labels).collect()}
    assert len(got) == len(texts) and {round(s, 2) for s in got.values()} != {0.5}
    for i, t, _ in texts:
        assert abs(got[i] - probability(plain_features(t))) < 1e-9, i
