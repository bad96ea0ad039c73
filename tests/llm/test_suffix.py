import hashlib

import numpy as np

from shelfspark.llm import suffix_dedup as S

from .conftest import prose, rows


def brute(items, width):
    first, out = {}, []
    for doc, text in items:
        b = (text or "").encode()
        for p in range(len(b) - width + 1):
            s = b[p:p + width]
            first[s] = min(first.get(s, S.LAST), S.LAST if doc is None else doc)
    for doc, text in items:
        b = (text or "").encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - width + 1):
            if first[b[p:p + width]] < (S.LAST if doc is None else doc):
                gone[p:p + width] = True
        spans = int(np.count_nonzero(np.diff(gone.astype(np.int8), prepend=0) == 1))
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out.append((doc, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def key(r):
    return (r[0] is None, r[0] or 0, r[1:])


def check(spark, items, width=50, **how):
    df = spark.createDataFrame(items, "doc_id long, text string").repartition(3)
    got = sorted(rows(S.repeated(df, width, **how)), key=key)
    assert got == sorted(brute(items, width), key=key)


def test_edge_rows(spark, docs, empty):
    items = rows(docs.select("doc_id", "text"))
    assert sorted(rows(S.repeated(docs)), key=key) == sorted(brute(items, 50), key=key)
    assert S.repeated(empty).collect() == []


def test_passages_overlaps_and_runs_over_many_chunks(spark):
    p, q = prose(30, 1), prose(20, 2)
    items = [(i, prose(40, 100 + i)) for i in range(30)]
    items += [(40, p + q), (41, "x" + p[5:80] + "y" + q), (42, p[:49]), (43, p[:50]), (44, p[:30] + q[:60] + p[30:]),
              (45, "a" * 400), (46, "b" + "a" * 120), (47, "a" * 49), (48, "ab" * 100), (49, "ba" * 60), (50, "ñ" * 60 + p), (39, q[3:70])]
    check(spark, items)
    check(spark, items, chunk_bytes=500)
    check(spark, items, width=30, chunk_bytes=2000)


def test_a_hot_passage(spark):
    p = prose(25, 3)
    check(spark, [(i, prose(10, 200 + i) + p + prose(10, 900 + i)) for i in range(120)] + [(i, p) for i in range(500, 600)], chunk_bytes=3000)


def test_rank_prefixes_is_the_suffix_order():
    rnd = np.random.default_rng(1)
    data = rnd.integers(97, 99, 400).astype(np.uint8)
    rank = S.rank_prefixes(data, 20)
    raw = data.tobytes()
    n = len(raw) - 20
    strings = [raw[i:i + 20] for i in range(n)]
    order = sorted(range(n), key=lambda i: strings[i])
    for a, b in zip(order, order[1:]):
        assert (rank[a] == rank[b]) == (strings[a] == strings[b]) and rank[a] <= rank[b]


def test_kept_bytes(spark):
    p = prose(30, 5)
    df = spark.createDataFrame([(1, p), (2, "ä" + p + "z")], "doc_id long, text string")
    assert {r.doc_id: bytes(r.kept).decode() for r in S.deduplicated(df).collect()} == {1: p, 2: "äz"}


def test_ranks_within_units_order_their_strings_alike():
    rnd = np.random.default_rng(6)
    sizes = np.append([80, 80], rnd.integers(50, 90, 60))
    data = rnd.integers(97, 99, int(sizes.sum())).astype(np.uint8)
    data[80:160] = data[:80]
    ends = np.cumsum(sizes)
    room = np.repeat(ends, sizes) - np.arange(len(data))
    strings = np.flatnonzero(room >= 50)
    ranks = S.rank_prefixes(data, 50, room)
    texts = [data[p:p + 50].tobytes() for p in strings]
    assert len(set(texts)) < len(texts)
    place = {t: i for i, t in enumerate(sorted(set(texts)))}
    assert ranks[strings].tolist() == [place[t] for t in texts]
    assert not ranks[room < 50].any(), "prefixes that leave their unit are not ordered"
