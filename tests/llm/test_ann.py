import numpy as np

from shelfspark.llm import ann

from .conftest import rows


def brute(items, queries, k):
    out = {}
    for qid, q in queries.items():
        near = sorted(((-float(np.dot(v, q)), i) for i, v in items.items() if i != qid and len(v) == len(q)))[:k]
        out[qid] = [(i, -s) for s, i in near]
    return out


def result(df):
    out = {}
    for q, rank, v, s in sorted(rows(df.select("query_id", "rank", "vec_id", "score"))):
        assert rank == len(out.setdefault(q, [])) + 1
        out[q].append((v, s))
    return out


def test_small_input_is_exact_with_odd_rows(spark):
    rnd = np.random.default_rng(1)
    items = {i: rnd.integers(-3, 4, 6).astype(float).tolist() for i in range(60)}  # many ties
    items = {i: v for i, v in items.items() if any(v)}
    odd = [(1000, None), (1001, []), (1002, [0.0] * 6), (1003, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (1004, [float("nan")] * 6),
           (1005, [float("inf")] * 6), (None, [1.0] * 6), (1006, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, 0) for i, v in [*items.items(), *odd]], "vec_id long, embedding array<float>, rank int")
    df = df.union(df.where("vec_id = 3"))  # a repeated row
    got = result(ann.nearest(df, df.where("vec_id % 5 = 0 or vec_id = 1006"), k=20))
    want = brute({**{i: np.array(v) for i, v in items.items()}, 1006: np.array([1.0, 2.0])},
                 {i: np.array(v) for i, v in items.items() if i % 5 == 0}, 20)
    assert got == {q: [(i, s) for i, s in v] for q, v in want.items()}
    none = df.where("false")
    assert ann.nearest(none, none).collect() == []
    assert ann.nearest(df.where("vec_id = 7"), df.where("vec_id = 7")).collect() == []


def test_recall_and_exact_scores(spark):
    rnd = np.random.default_rng(2)
    centres = rnd.standard_normal((40, 24))
    v = (centres[rnd.integers(0, 40, 6000)] + 0.7 * rnd.standard_normal((6000, 24))) * rnd.uniform(0.5, 2, (6000, 1))
    v = v.astype(np.float32)
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<float>")
    got = result(ann.nearest(df, df.where("vec_id % 100 = 0"), k=20))
    wide = v.astype(float)
    want = brute(dict(enumerate(wide)), {i: wide[i] for i in range(0, 6000, 100)}, 20)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 20 * len(want)
    assert all(abs(s - wide[i] @ wide[q]) < 1e-9 for q in got for i, s in got[q])


def test_a_third_of_all_vectors_alike(spark):
    rnd = np.random.default_rng(3)
    v = rnd.standard_normal((3000, 8))
    v[::3] = v[0]
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    got = result(ann.nearest(df, df.where("vec_id in (0, 1)"), k=20))
    assert [i for i, _ in got[0]] == list(range(3, 63, 3))  # equal scores: by vec_id


def test_tiny_and_huge_components_end(spark):
    """Squares of these vanish or overflow; enough vectors that no block is small."""
    rnd = np.random.default_rng(4)
    for scale in (1e-170, 1e-310, 1e153):
        v = rnd.standard_normal((700, 6)) * scale
        df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
        got = result(ann.nearest(df, df.where("vec_id % 100 = 0"), k=3))
        assert len(got) == 7 and all(len(x) == 3 for x in got.values())
        if scale > 1:
            want = brute(dict(enumerate(v)), {i: v[i] for i in range(0, 700, 100)}, 3)
            assert all({i for i, _ in got[q]} & {i for i, _ in want[q]} for q in want)
    mixed = [(i, [float(x) for x in row]) for i, row in enumerate(np.vstack([rnd.standard_normal((500, 4)), np.full((5, 4), 1e-200)]))]
    df = spark.createDataFrame(mixed, "vec_id long, embedding array<double>")
    assert len(result(ann.nearest(df, df.where("vec_id >= 500"), k=4))) == 5


def test_rows_of_one_id_that_differ_all_count(spark):
    given = [(1, [1.0, 0.0]), (1, [3.0, 0.0]), (1, [3.0, 0.0]), (2, [2.0, 0.0]), (20, [1.0, 1.0]), (20, [1.0, -1.0]), (3, [0.0, 5.0])]
    df = spark.createDataFrame(given, "vec_id long, embedding array<double>")
    got = sorted(rows(ann.nearest(df, df.where("vec_id % 20 = 0"), k=3)))
    assert got == sorted([(20, 1, 3, 5.0), (20, 2, 1, 3.0), (20, 3, 2, 2.0), (20, 1, 1, 3.0), (20, 2, 2, 2.0), (20, 3, 1, 1.0)])


def test_query_chunks_and_blocks_change_nothing_where_all_is_verified(spark, monkeypatch):
    rnd = np.random.default_rng(6)
    v = rnd.standard_normal((300, 5))
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    monkeypatch.setattr(ann, "CHUNK_BYTES", 300)
    monkeypatch.setattr(ann, "BLOCK", 64)
    got = result(ann.nearest(df, df.where("vec_id % 20 = 0"), k=20))
    want = brute(dict(enumerate(v)), {i: v[i] for i in range(0, 300, 20)}, 20)
    assert {q: [i for i, _ in x] for q, x in got.items()} == {q: [i for i, _ in x] for q, x in want.items()}
