import numpy as np
import xxhash

from shelfspark.llm import simhash_dedup as S
from shelfspark.llm.components import components

from .conftest import rows, words_of


def brute_print(text, n=3):
    w = words_of(text)
    grams = [" ".join(w[i:i + n]) for i in range(len(w) - n + 1)] if len(w) >= n else ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(items, k):
    """items: {id: fingerprint}; smallest id reachable."""
    root = {i: i for i in items}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(items)
    for i in ids:
        for j in ids:
            if i < j and (items[i] ^ items[j]).bit_count() <= k:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_near_duplicates_equal_brute_force(docs, empty):
    got = rows(S.near_duplicates(docs).select("doc_id", "fingerprint", "component_id"))
    texts = {i: t for i, t in rows(docs.select("doc_id", "text")) if i is not None}
    prints = {i: brute_print(t) for i, t in texts.items()}
    want = brute_components(prints, 3)
    assert len(got) == docs.count()
    for doc, fp, comp in got:
        if doc is not None:
            assert (fp, comp) == (format(prints[doc], "016x"), want[doc])
    assert prints[5] == prints[6] == prints[9] == 0 and want[9] == 5
    assert S.near_duplicates(empty).collect() == []


def test_planted_distances(spark):
    """Chains of 1 to 3 flipped bits over distinct fingerprints, in every position."""
    rnd = np.random.default_rng(4)
    prints = {}
    for g in range(60):
        fp = int(rnd.integers(0, 2**63)) * 2 + g % 2
        for step in range(4):
            prints[len(prints)] = fp
            for bit in rnd.choice(64, g % 5, replace=False):  # up to four bits: not linked
                fp ^= 1 << int(bit)
    nodes = {}
    for i, fp in prints.items():
        nodes.setdefault(fp, i)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([(signed(fp),) for fp in nodes], "fp long")
    for k in (1, 2, 3, 4):
        roots = {r.node: r.root for r in components(S.links(df, k)).collect()}
        want = brute_components({i: fp for fp, i in nodes.items()}, k)
        groups = {}
        for fp, i in nodes.items():
            groups.setdefault(want[i], set()).add(roots.get(signed(fp), signed(fp)))
        assert all(len(x) == 1 for x in groups.values()) and len({next(iter(x)) for x in groups.values()}) == len(groups), k


def test_a_large_posting_list_is_cut_into_chunks(spark):
    base = 0x0123456789ABCDEF
    fps = sorted({base ^ (i << 40) for i in range(5000)})  # all share five bytes
    df = spark.createDataFrame([(x,) for x in fps], "fp long").repartition(4)
    edges = S.links(df, 3)
    assert edges.count() < 40 * len(fps)
    roots = {r.root for r in components(edges).collect()}
    assert len(roots) == 1


def test_components_of_a_long_path(spark):
    n = 300
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(1000, 1001), (1001, 1000), (5, 5)], "a long, b long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert {got[i] for i in range(1, n + 1)} == {0} and got[1001] == 1000


def test_keep_one(docs):
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=lambda x: (x is None, x))
    assert 2 in ids and 3 not in ids and 4 not in ids and 1 in ids and 10 in ids and None in ids


def test_keep_one_decides_by_row(spark):
    """Repeated ids, null ids and one id with two texts: one row of each component."""
    from .conftest import prose
    a, b, c, d = (prose(60, 900 + i) for i in range(4))
    given = [(1, a), (1, a), (1, b), (None, c), (None, c), (2, c), (None, d), (None, d), (3, None), (4, ""), (None, None), (5, b), (5, b)]
    df = spark.createDataFrame([(*g, i, "x") for i, g in enumerate(given)], "doc_id long, text string, digest int, number string").repartition(4)
    kept = S.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(1, a), (1, b), (2, c), (None, d), (3, None)], key=str)


def test_key_masks_reach_every_pair_at_every_level():
    rnd = np.random.default_rng(9)
    for k in (1, 2, 3, 4):
        levels = S.key_masks(k)
        for _ in range(300):
            apart = sum(1 << int(b) for b in rnd.choice(64, rnd.integers(1, k + 1), replace=False))
            met = [m for m in levels[0] if not m & apart]
            assert met
            for masks in levels[:2]:  # whichever list met it is keyed anew
                assert all(any(not x & apart for x in masks[m]) for m in met)
                met = [x for m in met for x in masks[m] if not x & apart]


def test_large_lists_keyed_anew_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(S, "CHUNK", 8)
    monkeypatch.setattr(S, "LARGE", 32)
    rnd = np.random.default_rng(10)
    fps = {0x0123456789ABCDEF ^ (int(x) << 37) for x in rnd.integers(0, 1 << 12, 700)}  # seven alike bytes and fewer
    fps |= {int(x) for x in rnd.integers(0, 1 << 62, 100)}
    fps |= {f ^ (1 << int(b)) for f in list(fps)[:200] for b in rnd.choice(64, 2)}
    df = spark.createDataFrame([(S._signed(f),) for f in fps], "fp long").repartition(3)
    assert S.units_of(df, 3).select("s").distinct().count() > 8  # lists of finer keys took part
    roots = {r.node: r.root for r in components(S.links(df, 3)).collect()}
    want = brute_components(dict(enumerate(sorted(fps))), 3)
    groups = {}
    for i, f in enumerate(sorted(fps)):
        groups.setdefault(want[i], set()).add(roots.get(S._signed(f), S._signed(f)))
    assert all(len(g) == 1 for g in groups.values()) and len(set().union(*groups.values())) == len(groups)
