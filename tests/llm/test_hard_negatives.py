import math
import random

import pytest

from shelfspark.llm import hard_negatives as hn

from .conftest import rows

SCHEMA = "vec_id long, label int, embedding array<double>, score int, kind string, chunk double"


def plain(given, anchors):
    def ok(r):
        return r[0] is not None and r[1] is not None and r[2] is not None and all(
            x is not None and math.isfinite(x) and math.isfinite(256 * x) for x in r[2])
    usable = [(i, label, tuple(math.floor(256.0 * x) for x in v)) for i, label, v in filter(ok, given)]
    out = []
    for a in {(i, label, tuple(math.floor(256.0 * x) for x in v)) for i, label, v in filter(ok, anchors)}:
        scored = [(sum(x * y for x, y in zip(a[2], r[2])), r) for r in usable if r[0] != a[0] and len(r[2]) == len(a[2])]
        scored = [(max(-2**63 + 1, min(2**63 - 1, s)), r) for s, r in scored]
        scored.sort(key=lambda x: (-x[0], x[1][0]))
        for ps, p in [x for x in scored if x[1][1] == a[1]][:5]:
            found = [(s, r) for s, r in scored if r[1] != a[1] and 50 * ps <= 100 * s <= 95 * ps][:3]
            out += [(a[0], p[0], k, r[0], ps, s) for k, (s, r) in enumerate(found, 1)]
    return sorted(out)


def table(spark, given):
    return spark.createDataFrame([(*g, 1, "k", 2.5) for g in given], SCHEMA).repartition(5)


def sample(seed=1, n=400, dim=6):
    rnd = random.Random(seed)
    base = [rnd.gauss(0, 1) for _ in range(dim)]
    given = [(i, rnd.choice([0, 0, 0, 1, 2]), [b + rnd.choice([0.0, 0.0, 0.25, -0.5]) for b in base]) for i in range(n)]
    given += [(1000 + i, i % 3, base) for i in range(60)]                       # equal scores
    given += [(50, 1, base), (50, 1, base), (100, 2, [9.0] * dim), (77, 0, base), (77, 0, base)]  # repeated ids
    given += [(2000, None, base), (2050, 0, None), (2100, 0, [None] + base[1:]), (2150, 0, [math.nan] + base[1:]),
              (2200, 0, [math.inf] + base[1:]), (None, 0, base), (2250, 0, []), (2300, 1, []), (2350, 0, [1e306] * dim), (2400, 0, [0.0] * dim),
              (2450, 1, [1.0, 2.0]), (2451, 1, [1.0, 2.0]), (2452, 0, [1.0, 1.2])]
    return given


def run(spark, given, **limits):
    df = table(spark, given)
    return sorted(rows(hn.mine(df, df.where("vec_id % 50 = 0"), **limits)))


def want(given):
    return plain(given, [g for g in given if g[0] is not None and g[0] % 50 == 0])


def test_against_every_pair(spark):
    given = sample()
    got = run(spark, given)
    assert got == want(given) and len(got) > 50


def test_chunks_and_tiles_change_nothing(spark, monkeypatch):
    given = sample(2)
    monkeypatch.setattr(hn, "CHUNK_BYTES", 200)
    monkeypatch.setattr(hn, "TILE", (3, 17))
    assert run(spark, given) == want(given)


@pytest.mark.parametrize("scale", [1e-170, 1e6, 1e150])
def test_tiny_and_huge_components(spark, scale):
    given = [(i, label, v and [x and x * scale for x in v]) for i, label, v in sample(3, 120)]
    assert run(spark, given) == want(given)


def test_window_bounds():
    for score in (-7, 0, 1, 2, 19, 20, 21, 2**62):
        low, high = hn.window(score, 50, 95)
        assert 100 * low >= 50 * score > 100 * (low - 1) and 100 * high <= 95 * score < 100 * (high + 1)


def test_empty_tables(spark):
    none = table(spark, sample()).where("vec_id < -1")
    assert rows(hn.mine(none, none)) == []
    some = table(spark, sample(4, 60))
    assert rows(hn.mine(some, some.where("vec_id < -1"))) == []
    assert rows(hn.mine(none, some)) == []
