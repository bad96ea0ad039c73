import math
import os
import random
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfspark.llm import lm_pst as L

from .conftest import prose, rows, words_of

END = "\n"


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


class Plain:
    """The model by its definition: dictionaries, one state at a time."""

    def __init__(self, texts, depth, gain, discount=L.DISCOUNT):
        self.depth, self.discount = depth, discount
        self.next = {}
        for ws in texts:
            run = [END] + ws
            for i in range(1, len(run)):
                for d in range(depth + 1):
                    if i - d >= 0:
                        self.next.setdefault(tuple(run[i - d:i]), Counter())[run[i]] += 1
        c = self.next.get((), Counter())
        self.c, self.n, self.v = c, sum(c.values()), len(c)
        self.r = min(max(sum(x == 1 for x in c.values()) / max(1, self.v), 0.05), 0.95)
        self.kept = {()}
        for d in range(1, depth + 1):
            self.kept |= {s for s in self.next if len(s) == d and s[1:] in self.kept and self.diverges(s) >= gain}

    def listed(self, s):
        return {w: m for w, m in self.next[s].items() if m > 1}

    def escape(self, s):
        return 1 - sum(m - self.discount for m in self.listed(s).values()) / sum(self.next[s].values())

    def of_state(self, s, w):
        if not s:
            return (self.c[w] - self.r) / self.n if self.c[w] else self.r * self.v / self.n
        own = self.escape(s) * self.of_state(s[1:], w)
        return own + (self.listed(s)[w] - self.discount) / sum(self.next[s].values()) if w in self.listed(s) else own

    def diverges(self, s):
        again = {w: m - 1 for w, m in self.listed(s).items()}
        return (sum(m * math.log2(self.of_state(s, w) / self.of_state(s[1:], w)) for w, m in again.items())
                + (sum(self.next[s].values()) - sum(again.values())) * math.log2(self.escape(s))) if again else -1.0

    def state(self, before):
        return next(s for s in (tuple(before[len(before) - d:]) for d in range(min(self.depth, len(before)), -1, -1)) if s in self.kept)

    def score(self, ws):
        run = [END] + ws
        return sum(math.log10(self.of_state(self.state(run[:i]), run[i])) for i in range(1, len(run))) if self.n else 0.0


def check(df, **settings):
    """Every column against plain computation."""
    items = rows(df.select("doc_id", "text"))
    toks = [(i, words_of(t) + [END]) for i, t in items]
    plain = Plain([ws for i, ws in toks if not held(i)], settings.get("depth", L.DEPTH), settings.get("gain", L.GAIN))
    c, n, v = plain.c, plain.n, plain.v
    want = sorted((i is None, i or 0, held(i), len(ws), sum(c[w] > 0 for w in ws), n,
                   round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 5), round(plain.score(ws), 5)) for i, ws in toks)
    out = L.score(df, **settings).collect()
    got = sorted((r.doc_id is None, r.doc_id or 0, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5), round(r.score, 5) + 0.0)
                 for r in out)
    assert [g[:6] for g in got] == [w[:6] for w in want]
    assert np.allclose([g[6:] for g in got], [w[6:] for w in want], atol=2e-5)
    return out, plain


def test_edge_rows_equal_plain_computation(docs, empty):
    check(docs)
    assert L.score(empty).collect() == []


@pytest.mark.parametrize("depth,gain,head", [(0, 8.0, 50), (1, 8.0, 50_000), (1, 2.0, 50), (2, 4.0, 20), (3, 2.0, 100)])
def test_scores_equal_plain_computation(spark, depth, gain, head):
    rnd = random.Random(depth)
    vocabulary = [f"w{k}" for k in range(30)]
    items = [(i, " ".join(rnd.choice(vocabulary[:rnd.choice((4, 12, 30))]) for _ in range(rnd.randrange(40)))) for i in range(60)]
    items += [(100 + i, prose(60, i % 3)) for i in range(9)] + [(200, None), (201, ""), (None, "w1 W2 w3"), (7, "new words only")]
    # what follows x or y depends on the tokens before it, up to three
    items += [(300 + i, " ".join(f"{a} {b} {c} {'pqrs'[(a + b + c).count('x')]}" for a, b, c in (rnd.choices("xy", k=3) for _ in range(60))))
              for i in range(6)]
    out, plain = check(spark.createDataFrame(items, "doc_id long, text string").repartition(3), depth=depth, gain=gain, head=head)
    lengths = {len(s) for s in plain.kept}
    assert lengths == set(range(depth + 1)), "states of every length"
    assert depth == 0 or any(s not in plain.kept for s in plain.next if len(s) <= depth), "some contexts fail the test"


def test_states_sum_to_one(spark):
    plain = Plain([prose(200, s % 4).split() + [END] for s in range(8)], 2, 4.0)
    assert any(len(s) == 2 for s in plain.kept)
    for s in plain.kept:
        assert abs(sum(plain.of_state(s, w) for w in plain.c) + plain.of_state(s, "other symbol") - 1) < 1e-9


def test_tree_grows_with_the_corpus(spark):
    def states(texts):
        rnd = random.Random(5)
        sets = [[f"{k}-{x}" for x in range(40)] for k in range(texts)]
        return sum(len(s) == 1 for s in Plain([[rnd.choice(s[:6]) for _ in range(60)] for s in sets], 1, L.GAIN).kept)

    assert states(40) > 3 * states(10) > 0


def test_a_text_that_occurs_twice_scores_apart(spark):
    rnd = random.Random(3)
    train = [i for i in range(400) if not held(i)]
    once = {i: " ".join(f"w{min(int(rnd.paretovariate(0.4)), 20000)}" for _ in range(80)) for i in train}
    once[train[-1]] = once[train[0]]
    out = {r.doc_id: (r.score - r.base_score) / r.n_tokens for r in L.score(spark.createDataFrame(list(once.items()), "doc_id long, text string")).collect()}
    assert min(out[train[0]], out[train[-1]]) > max(v for i, v in out.items() if i not in (train[0], train[-1]))


def test_keys_are_those_of_spark(spark):
    rnd = np.random.default_rng(1)
    a, b = rnd.integers(-2**63, 2**63 - 1, (2, 50))
    df = spark.createDataFrame([(int(x), int(y)) for x, y in zip(a, b)], "a long, b long").coalesce(1)
    assert [r[0] for r in df.select(F.xxhash64("a", "b")).collect()] == L._pair(a, b).tolist()


def test_grams_stay_within_texts():
    keys = np.arange(1, 8)
    sizes = np.array([1, 4, 2])
    end = int(np.uint64(L.END_TOKEN).view(np.int64))
    two, three = L._grams(keys, sizes, 2)
    assert two[0].tolist() == list(range(7)) and two[2].tolist() == [end, end, 2, 3, 4, end, 6] and two[3].tolist() == keys.tolist()
    assert three[0].tolist() == [2, 3, 4, 6]


def test_counter_hands_out_everything():
    rnd = np.random.default_rng(2)
    counter, total, seen = L._Counter(limit=200), Counter(), Counter()
    for _ in range(20):
        a, b = rnd.integers(0, 40, (2, 100))
        seen.update(zip(a.tolist(), b.tolist()))
        for _, x, y, n in counter.add(L._pair(a, b), a, b):
            for p in zip(x.tolist(), y.tolist(), n.tolist()):
                total[p[:2]] += p[2]
    for _, x, y, n in counter.rest():
        for p in zip(x.tolist(), y.tolist(), n.tolist()):
            total[p[:2]] += p[2]
    assert total == seen


def test_better_than_the_base_on_held_out_texts(spark):
    rnd = random.Random(1)
    syllables = [a + b for a in "bdfglmnprst" for b in "aeiou"]

    def word():  # a few frequent words, and many that occur once
        return rnd.choice(syllables[:20]) if rnd.random() < 0.5 else "".join(rnd.choices(syllables, k=rnd.randrange(2, 5)))

    items = [(i, " ".join(word() for _ in range(120))) for i in range(400)]
    df = spark.createDataFrame(items, "doc_id long, text string").repartition(4)
    out = [r for r in check(df)[0] if r.held_out]
    assert len(out) > 20 and sum(r.score for r in out) > sum(r.base_score for r in out)


def test_nothing_to_learn_from(spark):
    only = [i for i in range(200) if held(i)][:3]
    out, _ = check(spark.createDataFrame([(i, "a b") for i in only], "doc_id long, text string"))
    assert all(r.base_score == 0 == r.score for r in out)


def test_default_depth_sees_three_tokens_back(spark):
    """What follows is set by the three tokens before it; of the false texts only the third is at odds."""
    assert L.DEPTH >= 3
    rnd = random.Random(9)

    def text(turned=False):
        runs = [rnd.choices("xy", k=3) for _ in range(60)]
        return " ".join(f"{a} {b} {c} {'pqrs'[((a == 'x') != turned) if b == c else 2 + (b == 'x')]}" for a, b, c in runs)

    train = [i for i in range(120) if not held(i)]
    tests = [i for i in range(400) if held(i)][:20]
    items = [(i, text()) for i in train] + [(i, text(turned=k % 2 == 1)) for k, i in enumerate(tests)]
    out = {r.doc_id: r.score / r.n_tokens for r in L.score(spark.createDataFrame(items, "doc_id long, text string")).collect()}
    assert min(out[i] for i in tests[::2]) > max(out[i] for i in tests[1::2]) + 0.1


def test_marks_hold_every_key(spark):
    rnd = np.random.default_rng(4)
    keys = np.append(rnd.integers(-2**63, 2**63 - 1, 5000), [-1, 0, 2**63 - 1, -2**63])
    other = rnd.integers(-2**63, 2**63 - 1, 20000)
    df = spark.createDataFrame([(int(k),) for k in keys], "key long")
    found = L.marks(df)
    assert L._marked(found, keys).all() and L._marked(found, other).mean() < 0.15
    assert not L._marked(L.marks(df.limit(0)), other).any()


def test_tokens_are_words_of_the_text():
    rnd = random.Random(6)
    words = ["a", "A", "ab", "ba", "é", "É", "x" * 70, "x" * 69 + "X", "x" * 71, "y" * 63 + "z", "y" * 64 + "z", "漢字", "\x00", "a\x00"]
    texts = [None, "", " \t\n\x0b\x0c\r ", "a", " a", "a ", " a b"]
    texts += ["".join(rnd.choice(words) + rnd.choice(" \t\n\r\x0b\x0c") * rnd.randrange(3) for _ in range(rnd.randrange(40))) for _ in range(60)]
    plain = [words_of(t) + [END] for t in texts]
    for step in (1, 50, 1 << 18):
        for column in (L.pa.array(texts), L.pa.array(["q"] + texts).slice(1), L.pa.array(texts, L.pa.large_string())):
            keys, sizes = L._tokens(column, step)
            assert sizes.tolist() == [len(t) for t in plain]
            pairs = set(zip(keys.tolist(), sum(plain, [])))
            assert len(pairs) == len({k for k, _ in pairs}) == len({w for _, w in pairs})
            assert all((k % 2**64 == L.END_TOKEN) == (w == END) for k, w in pairs)


def shuffled(spark):
    """Bytes of the shuffle files that lie on this process's disks."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n")
    return sum(os.path.getsize(f) for f in files if "/shuffle_" in f and os.path.exists(f))


def test_shuffle_files_do_not_pile_up(spark):
    rnd = random.Random(8)
    pool = [" ".join(f"w{rnd.randrange(3000)}" for _ in range(200)) for _ in range(600)]
    items = list(enumerate(pool + pool))
    spark._jvm.System.gc()
    time.sleep(3)
    before = shuffled(spark)
    L.score(spark.createDataFrame(items, "doc_id long, text string").repartition(4).select("doc_id", "text"))
    for _ in range(20):  # they are taken away beside the work
        left = shuffled(spark) - before
        if left < sum(len(t) for _, t in items) / 2:
            break
        time.sleep(0.5)
    assert left < sum(len(t) for _, t in items) / 2
