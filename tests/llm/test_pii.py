import hashlib
import re
from collections import Counter


from shelfspark.llm import pii

from .conftest import prose, rows

GOOD = "4111 1111 1111 1111"


def brute(text):
    """The contract's patterns, applied plainly."""
    text = text or ""
    out = []
    for kind, pattern in (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
                          ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"),
                          ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(x) > 255 for x in m.group().split(".")):
                continue
            if kind == "card":
                total = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits)))
                if not 13 <= len(digits) <= 19 or total % 10:
                    continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


TEXTS = [None, "", f"ä {GOOD}, a.b+c@x-y.example.com. 1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 +1 (988) 555-2485", "a@b @c.d x@y.z@w.v",
         "4111 1111 1111 1112 4111-1111-1111-1111", "+12 +123456789 +1234567890123456 ++1 555 555 5555", "0.0.0.0 00000000000000000001.2.3.4",
         "9" * 5000, "1.1.1." * 900 + "1", "+1" * 3000, prose(3000, 1) + " q@w.er " + prose(2000, 2)]


def test_base_spans_equal_brute_force(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    for r in pii.find(df).collect():
        want = brute(TEXTS[r.doc_id])
        written = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r.base_sha256 == hashlib.sha256(written.encode()).hexdigest() and r.spans == written, TEXTS[r.doc_id]
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in want) for k in pii.KINDS]


def test_edge_rows(docs, empty):
    assert pii.find(docs).count() == docs.count()
    assert pii.find(empty).collect() == []
    out = pii.sanitise(docs)
    assert out.columns == docs.columns
    assert sorted(map(str, rows(out.drop("text")))) == sorted(map(str, rows(docs.drop("text"))))


def planted(spark):
    """'Zorblax' stands by one address in four different passages and nowhere else;
    'luna' stands by it as often but is everywhere."""
    items = [(i, f"{prose(20, i)} zorblax luna boss@corp.example.com {prose(20, 50 + i)}") for i in range(4)]
    items += [(10 + i, f"{prose(20, 80)} copia boss2@corp.example.com {prose(10, 81)}") for i in range(9)]  # copies of one passage
    items += [(100 + i, prose(60, 300 + i) + " luna") for i in range(80)]
    return spark.createDataFrame(items, "doc_id long, text string")


def test_terms_that_disclose_an_entity(spark):
    df = planted(spark)
    got = {r.doc_id: r.terms for r in pii.disclosing_terms(df).collect()}
    assert set(got) == {0, 1, 2, 3}
    assert all(t == {"zorblax": "remove"} for t in got.values())
    found = {r.doc_id: (r.n_term, r.n_email, r.spans) for r in pii.find(df).collect()}
    assert all(found[i][:2] == (1, 1) and ",remove:" in found[i][2] for i in range(4))
    assert all(found[i][0] == 0 for i in found if i > 3)
    out = {r.doc_id: r.text for r in pii.sanitise(df).collect()}
    assert all("zorblax" not in out[i] and "corp" not in out[i] and "[EMAIL]" in out[i] and "luna" in out[i] for i in range(4))
    assert all("copia [EMAIL]" in out[10 + i] for i in range(9))
    clean = {r.doc_id: r.text for r in df.where("doc_id >= 100").collect()}
    assert all(out[i] == t for i, t in clean.items())


def test_a_name_far_from_the_value_discloses_it(spark):
    """'Zorblax' is greeted in the first line, the address stands in the signature."""
    far = [f"zorblax {prose(400, i)} boss@corp.example.com" for i in range(4)]
    copies = [f"mirvok {prose(150, 40)} chief@corp.example.com"] * 4
    items = far + copies + [prose(60, 300 + i) + " boss" for i in range(80)]
    df = spark.createDataFrame(list(enumerate(items)) + [(None, far[0])], "doc_id long, text string")
    got = {r.doc_id: r.terms for r in pii.disclosing_terms(df).collect()}
    assert set(got) == {0, 1, 2, 3} and all(t.get("zorblax") == "remove" for t in got.values())
    assert all("corp" not in t and "boss" not in t for t in got.values())  # words of the value itself
    out = {r.doc_id: r.text for r in pii.sanitise(df).collect()}
    assert all("zorblax" not in out[i] for i in range(4)) and "mirvok" in out[4]


def test_pruned_candidates_equal_plain_pmi(spark):
    """The statistics against a plain computation."""
    import math
    far = [(500 + i, f"quorble {prose(90, 600 + i)} deep@corp.example.com {prose(9, 700 + i)} tindle") for i in range(5)]
    df = planted(spark).union(spark.createDataFrame(far + [(600 + i, "quorble " + prose(30, i)) for i in range(8)], "doc_id long, text string"))
    docs_of, near, ctx = {}, {}, {}
    texts = rows(df)
    for doc, text in texts:
        for w in set(re.findall(r"[^\W\d_]+", text.lower())):
            docs_of.setdefault(w, set()).add(doc)
        spans = pii.base_spans(text)
        outside = list(text)
        for _, a, b in spans:
            outside[a:b] = " " * (b - a)
        words = re.findall(r"[^\W\d_]+", "".join(outside).lower())
        for _, a, b in spans:
            for w in set(words):
                near.setdefault((text[a:b], w), set()).add(doc)
                ctx.setdefault((text[a:b], w), set()).add(tuple(words))
            near.setdefault((text[a:b], None), set()).add(doc)
    want = set()
    for (e, w), d in near.items():
        if w is None or len(ctx[e, w]) < 3:
            continue
        ic = math.log2(len(texts) / len(near[e, None]))
        if math.log2(len(d) * len(texts) / (len(near[e, None]) * len(docs_of[w]))) >= 0.9 * ic:
            want |= {(x, w) for x in near[e, None]}
    got = {(r.doc_id, t) for r in pii.disclosing_terms(df).collect() for t in r.terms}
    assert got == want and (500, "tindle") in got and (500, "quorble") not in got and (0, "zorblax") in got


def test_both_ways_to_count_terms(spark, monkeypatch):
    df = planted(spark).union(spark.createDataFrame([(900, None), (901, ""), (902, "Luna luna@corp.example.com zorblax@corp.example.com")],
                                                    "doc_id long, text string"))
    wanted = spark.createDataFrame([("luna",), ("zorblax",), ("corp",), ("nowhere",)], "term string")
    few = sorted(rows(pii.term_counts(df, wanted)))
    monkeypatch.setattr(pii, "WANTED_BYTES", 0)
    assert few == sorted(rows(pii.term_counts(df, wanted)))
    want = Counter()
    for _, text in rows(df):
        for _, a, b in reversed(sorted(pii.base_spans(text or ""), key=lambda s: s[1])):
            text = text[:a] + " " * (b - a) + text[b:]
        want.update({"luna", "zorblax", "corp", "nowhere"} & set(re.findall(r"[^\W\d_]+", (text or "").lower())))
    assert few == sorted(want.items()) and want["zorblax"] == 4 and want["luna"] >= 85


def test_patterns_equal_brute_force_on_random_runs():
    import random
    rnd = random.Random(8)
    pieces = ["a", "9", "99", ".", "@", "-", "+", "_", " ", "b.c", "1.2", "@x.y", "ñ", "%", "(", "4111 1111 1111 1111", "1.2.3.4", "@.", "..", "x@y.z"]
    for _ in range(4000):
        text = "".join(rnd.choice(pieces) for _ in range(rnd.randrange(1, 25)))
        assert pii.base_spans(text) == brute(text), text


def test_long_runs_cost_their_length():
    import time
    n = 1 << 20
    for text in ("9" * n, "a" * n + " x@y.z", "a" * n, ("a" * 999 + "@") * (n // 1000), "1." * (n // 2), "@" * n, "+" * n, "+1" * (n // 2), "+1" + "(" * n,
                 "a@" + "b" * n, "a@b" + ".c" * (n // 2), "9." * 2 + "9" * n + " " + "9" * n, "1 " * (n // 2), "x@" * (n // 2)):
        began = time.process_time()
        pii.base_spans(text)
        assert time.process_time() - began < 3, text[:20]


def test_overlapping_spans_are_replaced_once():
    assert pii.sanitised(f"x +{GOOD.replace(' ', '')[:15]}1 y", {}) .count("[") <= 2
    assert pii.sanitised("a@b.c 1.2.3.4", {}) == "[EMAIL] [IP]"
