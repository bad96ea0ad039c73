import pytest

WORDS = "alba bruma cielo duna eco faro gota hoja isla jade kilo luna mar nube oro pino quena rio sol tren uva vela yodo zorro".split()


def prose(n, seed):
    import random
    rnd = random.Random(seed)
    return " ".join(rnd.choice(WORDS) + (str(rnd.randrange(90)) if rnd.random() < 0.5 else "") for _ in range(n))


@pytest.fixture(scope="session")
def docs(spark):
    """Documents with nulls, empty and long texts, copies, near copies, repeated
    rows, a null id and columns whose names clash with the operators' own."""
    base = prose(300, 1)
    texts = {1: prose(80, 2), 2: base, 3: base, 4: base.replace("alba", "Alba", 1), 5: None, 6: "", 7: "uno", 8: "uno dos",
             9: " \t\n ", 10: prose(40000, 3), 11: "é ü ñ İ ß 漢字 " + prose(60, 4), 12: base + " " + prose(3, 5), 13: prose(60, 6) + base}
    rows = [(i, t, "en", "s", 0, "k", 1.5, {"x": "y"}, 7) for i, t in texts.items()] + [(3, base, "en", "s", 0, "k", 1.5, {"x": "y"}, 7)]
    rows.append((None, prose(50, 7), "en", "s", 0, None, None, None, None))
    schema = ("doc_id long, text string, lang string, source string, n_chars long, k1 string, score double, terms map<string,string>, "
              "chunk int")
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def words_of(text):
    import re
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x20\x09-\x0d]+", low)


def rows(df):
    return [tuple(r) for r in df.collect()]
