import hashlib

import pytest
from pyspark.sql import functions as F

from shelfspark.llm import mixing

from .conftest import prose, rows, words_of


def plain(docs, weights=(5, 2, 1), percent=150, epochs=2):
    """One list of queue entries, sorted and cut."""
    each = {}
    for doc, source, text in docs:
        each.setdefault(source, []).append((hashlib.md5(":".join(str(x) for x in (doc, text) if x is not None).encode()).hexdigest(), doc,
                                            len(words_of(text))))
    names = sorted(each, key=lambda s: (s is None, s or ""))
    size = [sum(d[2] for d in each[s]) for s in names]
    weight = [weights[i % len(weights)] for i in range(len(names))]
    capped = set()
    while True:
        free = sum(w for i, w in enumerate(weight) if i not in capped)
        if not free:
            break
        level = (percent * sum(size) - 100 * epochs * sum(size[i] for i in capped)) / (100 * free)
        now = {i for i in range(len(names)) if weight[i] * level > epochs * size[i]}
        if now == capped:
            break
        capped = now
    target = [float(epochs * size[i]) if i in capped else weight[i] * level for i in range(len(names))]
    entries, taken = [], {}
    for place, name in enumerate(names):
        for epoch in range(epochs):
            upto = epoch * size[place]
            for digest, doc, n in sorted(each[name], key=str):
                upto += n
                if n:
                    entries.append((upto / target[place], place, digest, doc, n))
    left = percent * sum(size) // 100
    for _, place, digest, doc, n in sorted(entries, key=lambda e: e[:2]):
        taken[place, digest, doc] = taken.get((place, digest, doc), 0) + min(n, left)
        left -= min(n, left)
    return sorted(((doc, n, size[p], target[p], taken.get((p, digest, doc), 0)) for p, s in enumerate(names) for digest, doc, n in each[s]), key=str)


def sample(spark):
    given = [(i, f"s{i % 4}" if i % 3 else "hot", prose(1 + i * 7 % 60, i)) for i in range(240)]
    given += [(900, None, prose(40, 1)), (901, None, None), (902, "S", ""), (903, "tiny", "one"), (None, "hot", "x y"), (904, "ñ", " \t")]
    df = spark.createDataFrame([(*g, 3, 1.0) for g in given], "doc_id long, source string, text string, size int, target double")
    return given, df.repartition(7)


def test_against_one_sorted_list(spark):
    given, docs = sample(spark)
    got = mixing.mix(docs)
    assert got.columns == ["doc_id", "size", "source_size", "target", "taken"]
    got = sorted(rows(got), key=str)
    assert got == plain(given)
    assert got == sorted(rows(mixing.mix(docs.repartition(3))), key=str)
    assert sum(r[4] for r in got) == 150 * sum(r[1] for r in got) // 100
    assert all(r[4] <= 2 * r[1] for r in got)


def test_sources_come_near_their_targets(spark):
    _, docs = sample(spark)
    got = mixing.mix(docs)
    for r in got.groupBy("source_size", "target").agg(F.sum("taken").alias("taken"), F.max("size").alias("most")).collect():
        assert abs(r.taken - r.target) <= r.most


def test_schedule_holds_the_mix(spark):
    _, docs = sample(spark)
    drawn = mixing.schedule(docs)
    per_doc = drawn.where("doc_id is not null").groupBy("doc_id").agg(F.sum("words").alias("taken"))
    want = mixing.mix(docs).where("taken > 0 and doc_id is not null").select("doc_id", "taken")
    assert sorted(rows(per_doc)) == sorted(rows(want))
    times = [r.finish for r in drawn.collect()]
    assert times == sorted(times)


@pytest.mark.parametrize("percent,epochs", [(0, 2), (60, 1), (100, 1), (200, 2), (250, 2), (170, 3)])
def test_other_budgets(spark, percent, epochs):
    given, docs = sample(spark)
    got = sorted(rows(mixing.mix(docs, percent=percent, epochs=epochs)), key=str)
    assert sum(r[4] for r in got) == min(percent, 100 * epochs) * sum(r[1] for r in got) // 100
    if percent:
        assert got == plain(given, percent=percent, epochs=epochs)


def test_common_documents(spark, docs, empty):
    got = rows(mixing.mix(docs))
    assert len(got) == docs.count() and sum(r[4] for r in got) == 150 * sum(r[1] for r in got) // 100
    assert rows(mixing.mix(empty)) == []
    assert [r[4] for r in rows(mixing.mix(docs.where("doc_id in (5, 6, 9)")))] == [0, 0, 0]
