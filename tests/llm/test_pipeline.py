import corpus_pipeline
from shelfspark.llm import decontam, packing, pii, simhash_dedup, toxicity
from shelfspark.sources.tables import load

from .conftest import prose, rows
from .test_simhash import brute_components, brute_print

SF = "/root/testdata/sf0.001"


def test_stages_take_effect_in_order(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "personal_data", "packing"]
    raw = load(spark, SF, "documents")
    labels, bench = load(spark, SF, "labels"), load(spark, SF, "benchmark")
    columns, kept = raw.columns, {r.doc_id: r for r in raw.collect()}
    docs = raw
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = stage(spark, docs, SF).persist()
        assert docs.columns == columns
        now = {r.doc_id: r for r in docs.collect()}
        if name == "toxicity":
            gone = {r.doc_id for r in toxicity.classify(before, labels).where("predicted = 1").collect()}
        elif name == "near_duplicates":
            gone = {r.doc_id for r in simhash_dedup.near_duplicates(before).collect() if r.doc_id != r.component_id}
        elif name == "decontamination":
            gone = {r.doc_id for r in decontam.decontaminate(before, bench).where("contaminated").collect()}
        else:
            gone = set()
            for i, r in now.items():
                assert not pii.base_spans(r.text) and r.n_chars == len(r.text)
                assert pii.base_spans(kept[i].text) or r.text == kept[i].text
        assert set(now) == set(kept) - gone, name
        assert gone or name == "personal_data"
        kept = now
    packed = rows(packing.pack(docs))
    assert {r[0] for r in packed} == set(kept)


def test_run_is_registered_and_packs_what_is_left(spark):
    import __spark_entry__ as E

    assert "pipeline" in E.queries() and corpus_pipeline.ORACLE_SQL is None
    out = E.queries()["pipeline"](spark, SF)
    assert {"doc_id", "sequence_id", "offset", "length"} <= set(out.columns) and out.count() > 0


def test_thirteen_operators_are_registered():
    import __spark_entry__ as E

    names = E.queries()
    assert all(any(q.startswith(f"op{n}_") for q in names) for n in range(1, 14))
    assert {"op11_lexical", "op12_mixing", "op13_hard_negatives"} <= set(E.oracle_sql())


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def tables(spark, folder, docs, labels=(), bench=()):
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(bench), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_empty_tables(spark, tmp_path, docs):
    none = spark.createDataFrame([], SCHEMA)
    out = corpus_pipeline.run(spark, tables(spark, tmp_path / "a", none))
    assert out.collect() == [] and "sequence_id" in out.columns
    some = docs.select("doc_id", "text", "lang", "source", "n_chars")
    out = corpus_pipeline.run(spark, tables(spark, tmp_path / "b", some))  # no label, no item
    prints = {r.doc_id: brute_print(r.text) for r in some.where("doc_id is not null").collect()}
    assert {r.doc_id for r in out.collect()} == {None, *brute_components(prints, 3).values()}


def test_nulls_repeated_rows_and_clashing_columns(spark, tmp_path):
    """Every text null or repeated, ids null or shared, columns named as the stages' own."""
    text, item, toxic = prose(60, 1), prose(50, 2), " ".join(["grunk blorf snarg"] * 20)
    given = [(1, None), (2, ""), (3, text), (3, text), (3, prose(60, 3)), (4, text + " x"), (None, None), (None, prose(60, 4)), (None, prose(60, 4)),
             (5, prose(20, 5) + " " + item + " " + prose(20, 6)), (6, prose(70, 7) + " mail a.b@c.de now")]
    labels = [(1000 + i, 1, i % 2) for i in range(200)] + [(None, None, None), (3, None, 0), (3, 1, 0)]
    given += [(1000 + i, (toxic + f" {i} " if i % 2 else prose(30, 800 + i)) + prose(9, 2000 + i)) for i in range(200)]
    rows_ = [(i, t, "en", "s", 7, "a", 1.5, {"x": "y"}, 9, 8, 7, "f", 3, 4.0) for i, t in given]
    names = SCHEMA + (", k1 string, score double, terms map<string,string>, digest int, number long, chunk int, fp string, "
                      "scored_text int, toxicity double")
    docs = spark.createDataFrame(rows_, names).repartition(4)
    sf_dir = tables(spark, tmp_path / "t", docs, labels, [(0, item), (1, None), (2, "")])
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, sf_dir).persist()
        assert now.columns == docs.columns, name
    left = [(r.doc_id, r.text) for r in now.collect()]
    assert not any(i is not None and i >= 1000 and i % 2 for i, _ in left)             # toxic
    assert sum(1 for i, t in left if t in (None, "")) == 1                            # one of the empty ones
    assert (3, text) in left and (4, text + " x") not in left and (3, prose(60, 3)) in left
    assert len([1 for i, t in left if i is None]) == 1                                # the null ids' one text, once
    assert not any(i == 5 for i, _ in left) and any(i == 6 and "[EMAIL]" in t for i, t in left)
    assert {r.n_chars for r in now.where("text is not null and doc_id = 3").collect()} == {len(text), len(prose(60, 3))}
    packed = corpus_pipeline.run(spark, sf_dir)
    assert packed.where("piece = 0").count() == len(left)
