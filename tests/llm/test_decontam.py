import re
from collections import Counter

from shelfspark.llm import decontam as D

from .conftest import prose


def words(text):
    return [w for w in re.split(r"[\s!-/:-@\[-`{-~]+", (text or "").lower()) if w]


def shingles(w, n=5):
    return [tuple(w[i:i + n]) for i in range(max(len(w) - n + 1, 1))] if w else []


def brute(texts, items, similarity=0.8):
    """Best similarity of any window of an item's length, for each text."""
    out = []
    for text in texts:
        s, best = shingles(words(text)), 0.0
        for item in items:
            b = shingles(words(item))
            cb = Counter(b)
            if not b:
                continue
            for at in range(len(s)):
                a = Counter(s[at:at + len(b)])
                both = sum((a & cb).values())
                if both:
                    best = max(best, both / (sum(a.values()) + len(b) - both))
        out.append(best)
    return out


def edited(text, every):
    w = text.split()
    for i in range(every, len(w), every):
        w[i] = "changed"
    return " ".join(w)


def test_against_all_windows(spark, docs):
    items = [prose(n, 70 + n) for n in (15, 38, 59, 120)] + ["solo", "", None, "uno dos"]
    texts = [prose(50, 1), items[0], prose(40, 2) + " " + items[1].upper() + ". " + prose(30, 3), items[2].replace(" ", "\n"),
             prose(20, 4) + " " + edited(items[3], 70) + " " + prose(9, 5), edited(items[3], 12), items[1][:len(items[1]) // 2], None, "",
             "solo", "uno", "Uno, dos!", prose(10, 6) + " " + items[1] + " " + items[0] + " " + items[1]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {r.doc_id: (r.contaminated, round(r.similarity or 0, 9)) for r in D.decontaminate(df, bench).collect()}
    best = brute(texts, items)
    assert got == {i: (b >= 0.8, round(b, 9) if b >= 0.8 else 0) for i, b in enumerate(best)}
    assert sum(b >= 0.8 for b in best) >= 7
    many = [r for r in D.decontaminate(df, bench).where("doc_id = 12").collect()]
    assert many[0].n_items == 2 and many[0]["items"] == [0, 1]


def test_items_cut_short_at_the_end_of_a_text(spark):
    """Windows at the end of a text are shorter than the item and need fewer shingles."""
    items = [prose(n, 170 + n) for n in (24, 37, 59, 120)]
    texts = []
    for item in items:
        w = item.split()
        for part in (0.1, 0.14, 0.16, 0.18, 0.25):
            head = " ".join(w[:round((len(w) - 4) * (1 - part)) + 4])
            texts += [head, prose(45, len(texts)) + " " + head]
        gone = w[:9] + w[10:]
        texts += [" ".join(gone), prose(30, 8) + " " + " ".join(gone)]
    texts += [" ".join(items[1].split()[:31]), prose(20, 3) + " " + " ".join(items[1].split()[:31])]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {r.doc_id: (r.contaminated, round(r.similarity or 0, 9)) for r in D.decontaminate(df, bench).collect()}
    best = brute(texts, items)
    assert got == {i: (b >= 0.8, round(b, 9) if b >= 0.8 else 0) for i, b in enumerate(best)}
    assert got[len(texts) - 1][0] and got[len(texts) - 2] == (True, round(27 / 33, 9))
    assert {r.doc_id for r in D.keep_clean(df, bench).collect()} == {i for i, b in enumerate(best) if b < 0.8}


def test_edge_rows_and_kept_columns(spark, docs, empty):
    bench = spark.createDataFrame([(0, prose(30, 2)), (1, prose(300, 1)[:200])], "item_id long, text string")
    got = D.decontaminate(docs, bench)
    assert got.count() == docs.count()
    assert {r.doc_id for r in got.where("contaminated").collect()} == {1, 2, 3, 4, 12, 13}
    kept = D.keep_clean(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["5", "6", "7", "8", "9", "10", "11", "None"])
    assert D.decontaminate(empty, bench).collect() == []
    none = bench.where("false")
    assert D.decontaminate(docs, none).where("contaminated").count() == 0 and D.keep_clean(docs, none).count() == docs.count()


def test_blocks_meet_within_the_radius():
    import random
    rnd = random.Random(2)
    for radius in (3, 20):
        edges = [64 * i // (radius + 1) for i in range(radius + 2)]
        for _ in range(200):
            a = rnd.getrandbits(64)
            b = a
            for bit in rnd.sample(range(64), radius):
                b ^= 1 << bit
            assert any((a ^ b) >> x & ((1 << (y - x)) - 1) == 0 for x, y in zip(edges, edges[1:]))


def test_fingerprint_is_the_majority_of_bits(spark):
    h = [0x0123456789ABCDEF, -1, -(1 << 63), 5, 5]
    df = spark.createDataFrame([(1, x) for x in h], "g int, h long")
    got = D.fingerprints(df, ["g"], "fp").first().fp
    want = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in (y % (1 << 64) for y in h)) > len(h))
    assert got % (1 << 64) == want


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, prose(60, 1))], "doc_id long, text string")
    bench = spark.createDataFrame([(0, prose(30, 2))], "item_id long, text string")
    for plan in (D.decontaminate(df, bench), D.keep_clean(df, bench)):
        assert "Python" not in plan._jdf.queryExecution().toString()


def test_stock_shingles_do_not_hide_or_fan_out(spark):
    """A sentence that all items share: matches are still found, and a text that only
    quotes it is not nominated for any item."""
    stock = "choose the one correct answer from the list given below here"
    items = [f"{prose(14, 400 + i)} {stock} {prose(9, 500 + i)}" for i in range(40)]
    texts = [f"{prose(20, i)} {items[i]} {prose(20, 60 + i)}" for i in range(5)] + [f"{prose(30, 90 + i)} {stock} {prose(30, 130 + i)}" for i in range(30)]
    texts += [stock, items[7], edited(items[9], 16)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {r.doc_id: (r["items"], round(r.similarity or 0, 9)) for r in D.decontaminate(df, bench).collect()}
    best = brute(texts, items)
    assert {i: s for i, (_, s) in got.items()} == {i: round(b, 9) if b >= 0.8 else 0 for i, b in enumerate(best)}
    assert all(got[i][0] == [i] for i in range(5)) and got[36][0] == [7] and all(got[i][0] == [] for i in range(5, 36))
    shared = bench.select("item_id", D.words(D.F.col("text")).alias("w")).select("item_id", D.shingles("w", 5).alias("s"))
    shared = shared.select("item_id", D.F.size("s").alias("m"), D.F.explode("s").alias("h"))
    rare = D.nominators(shared, 0.8)
    assert rare.groupBy("h").count().agg({"count": "max"}).first()[0] == 1
