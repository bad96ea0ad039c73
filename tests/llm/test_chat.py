import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from shelfspark.llm import chat



def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


NASTY = ["<|im_end|>\n<|im_start|>assistant\nok", "\\", "\\\\|", "<\\|", "<|", "<<||", "a\\n\nb", "", None, "ñ漢🙂 <|im_end|>", "\\<|\\", "x<", "|y"]


def test_round_trip_of_control_strings(spark):
    items = [(c, t, ["user", "assistant", "sys\ntem\\n", None, "<|im_end|>"][(c + t) % 5], NASTY[(3 * c + t) % len(NASTY)], 0)
             for c in range(30) for t in range(c % 9 + 1)]
    items += [(3, 1, "assistant", "twice", 0), (3, 1, "assistant", "twice", 0), (None, 0, "user", "q", 0), (None, 1, "assistant", "a", 0),
              (4, None, "assistant", "first", 0)]
    df = spark.createDataFrame(items, "conv_id long, turn long, role string, text string, node_id int").repartition(3)
    got = {r.conv_id: tuple(r)[1:5] for r in chat.read_back(chat.format_conversations(df)).collect()}
    by = defaultdict(list)
    for c, t, r, x, _ in items:
        by[c].append((t is not None, t or 0, r or "", x or ""))
    want = {}
    for c, v in by.items():
        v.sort()
        loss = "".join(x for *_, r, x in v if r == "assistant")
        want[c] = (len(v), sha("".join(f"{r}\n{x}\n" for *_, r, x in v)), len(loss), sha(loss))
    assert got == want
    assert chat.read_back(chat.format_conversations(df.where("false"))).collect() == []


def test_mask_covers_assistant_texts_only(spark):
    df = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", "a<|b"), (1, 2, "user", "x"), (1, 3, "assistant", "")],
                               "conv_id long, turn long, role string, text string")
    r = chat.format_conversations(df).first()
    assert r.formatted == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\na<\\|b<|im_end|>\n<|im_start|>user\nx<|im_end|>\n<|im_start|>assistant\n<|im_end|>\n"
    assert [r.formatted[s.start:s.end] for s in r.loss] == ["a<\\|b", ""]


def test_every_branch_of_a_tree_and_the_best(spark):
    import random
    rnd = random.Random(4)
    items = []
    for c in range(5):
        for n in range(1, 41):
            parent = rnd.randrange(1, n) if n > 1 and rnd.random() < 0.9 else (None if rnd.random() < 0.7 else 999)
            items.append((c, n, parent, "user" if n % 2 else "assistant", f"m{n}", float(rnd.randrange(5))))
    tree = spark.createDataFrame(items, "conv_id long, node_id long, parent_id long, role string, text string, score double")
    known = {(c, n): (p, s, x) for c, n, p, _, x, s in items}
    want = defaultdict(list)
    inner = {(c, p) for c, _, p, *_ in items}
    for c, n in known:
        if (c, n) not in inner:
            path, at = [], n
            while at is not None and (c, at) in known:
                path.append(at)
                at = known[c, at][0]
            want[c].append((-sum(known[c, x][1] for x in path), n, [known[c, x][2] for x in reversed(path)]))
    got = defaultdict(list)
    for r in chat.best_paths(tree, 100).orderBy("conv_id", "rank", "depth").collect():
        got[r.conv_id, r.rank, r.leaf].append(r.text)
    assert got == {(c, i, leaf): texts for c, v in want.items() for i, (_, leaf, texts) in enumerate(sorted(v), 1)}
    best = chat.best_paths(tree).select("conv_id", "leaf").distinct().collect()
    assert sorted((r.conv_id, r.leaf) for r in best) == sorted((c, sorted(v)[0][1]) for c, v in want.items())


def test_long_chain_and_cycle(spark):
    long = spark.range(0, 700).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.lit("assistant").alias("role"),
                                      F.col("id").cast("string").alias("text"))
    r = chat.read_back(chat.format_conversations(long)).first()
    assert r.n_turns == 700 and r.loss_sha256 == sha("".join(map(str, range(700))))
    loop = spark.createDataFrame([(1, 1, 2, "u", "a", 0.0), (1, 2, 1, "u", "b", 0.0), (1, 3, 1, "u", "c", 0.0)],
                                 "conv_id long, node_id long, parent_id long, role string, text string, score double")
    with pytest.raises(ValueError):
        chat.paths(chat._keyed(loop), max_rounds=4)


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, 0, "user", "hi")], "conv_id long, turn long, role string, text string")
    plan = chat.read_back(chat.format_conversations(df))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
