import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfspark.llm import lexical
from shelfspark.llm._common import Best

from .conftest import WORDS, rows


def terms_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def plain(docs, items, k=10):
    """Every document scored for every item."""
    texts = [(i, terms_of(t)) for i, t in docs]
    texts = [(i, t) for i, t in texts if t]
    n, length = len(texts), sum(len(t) for _, t in texts)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms_of(text))
    out = []
    for item, words in wanted.items():
        found = []
        for doc, t in texts:
            score = 0
            for w in words & set(t):
                df = sum(w in other for _, other in texts)
                weight = math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))
                tf, m = t.count(w), 100 - 90 + (90 * len(t) * n) // length
                score += weight * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        out += [(item, r, f[3], -f[0]) for r, f in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


def items_df(spark, items):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in items], "item_id long, text string, rank string, score int")


ITEMS = [(1, "Alba, bruma cielo7!"), (2, None), (3, " -- "), (4, "nowhere"), (5, "漢字 ß ñ É"), (1, "duna DUNA"), (None, "eco faro"),
         (6, " ".join(WORDS)), (7, "uno"), (7, "uno")]


def test_against_every_document_scored(spark, docs):
    given = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = lexical.search(docs, items_df(spark, ITEMS))
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(rows(got), key=str) == plain(given, ITEMS)


def test_small_parts_find_the_same(spark, docs):
    items = items_df(spark, ITEMS)
    whole = sorted(rows(lexical.search(docs, items)), key=str)
    pairs = items.select("item_id", F.explode(lexical.terms(F.col("text"))).alias("term")).distinct()
    dealt, n = lexical.parts_of(pairs, 64)
    sizes = {}
    for r in dealt.collect():
        sizes.setdefault(r.part, {}).setdefault(r.item_id, []).append(len(r.term.encode()) + 16)
    assert n > 3 and all(len(part) == 1 or sum(map(sum, part.values())) <= 128 for part in sizes.values())
    assert sorted(rows(lexical.search(docs, items, part_bytes=64)), key=str) == whole


def test_neighbouring_and_nested_terms_are_whole_terms(spark):
    given = [(1, "a a a"), (2, "aa a"), (3, "xa"), (4, "a\x00a a"), (5, "A-a"), (6, "b" * 100_000 + " a")]
    docs = spark.createDataFrame(given, "doc_id long, text string")
    items = [(1, "a"), (2, "aa xa")]
    assert sorted(rows(lexical.search(docs, items_df(spark, items))), key=str) == plain(given, items)


def test_equal_scores_by_id_over_many_partitions(spark):
    given = [(i, "same words here") for i in range(300)] + [(None, "same words here"), (300, "other")]
    docs = spark.createDataFrame(given, "doc_id long, text string").repartition(150)
    got = sorted(rows(lexical.search(docs, items_df(spark, [(9, "words other")]))), key=str)
    assert got == plain(given, [(9, "words other")])


def test_empty_tables(spark, docs, empty):
    none = items_df(spark, []).where("item_id is not null")
    assert rows(lexical.search(empty, items_df(spark, ITEMS))) == []
    assert rows(lexical.search(docs, none)) == []
    assert rows(lexical.search(docs.where("text is null"), items_df(spark, ITEMS))) == []


@pytest.mark.parametrize("limit", [5, 1 << 17])
def test_best_keeps_the_first_of_each_group(limit, monkeypatch):
    monkeypatch.setattr(Best, "LIMIT", limit)
    rnd = random.Random(limit)
    given, best = [], Best(3, 2)
    for _ in range(200):
        n = rnd.randrange(4)
        g, v = [rnd.randrange(3) for _ in range(n)], [rnd.choice([-2**63, -5, 0, 3, 2**63 - 1]) for _ in range(n)]
        i = rnd.choice([None, rnd.randrange(30)])
        given += [(a, -b, i is None, i or 0) for a, b in zip(g, v)]
        best.add(np.array(g, np.int64), np.array(v, np.int64), i)
    group, value, ids = best.rows()
    got = [(a, -b, c is None, c or 0) for a, b, c in zip(group.tolist(), value.tolist(), ids.to_pylist())]
    assert got == [x for a in range(3) for x in sorted(y for y in given if y[0] == a)[:2]]
