import json
import os
import shutil
import subprocess
import sys

import __spark_entry__ as E

REPO = os.path.dirname(os.path.abspath(E.__file__))


def test_reference_queries_stay_without_the_training_data_folders(tmp_dir):
    """The entry point serves every query of the reference's own operators when
    both ``llm`` folders are gone, with or without the pipeline's module."""
    from shelfspark.plans.catalog import REGISTRY
    for name, left_out in (("pipeline_stays", ()), ("pipeline_gone", ("corpus_pipeline.py",))):
        copy = f"{tmp_dir}/{name}"
        shutil.copytree(REPO, copy, ignore=shutil.ignore_patterns("llm", ".git", "__pycache__", ".pytest_cache", *left_out))
        said = subprocess.run([sys.executable, "-c", "import json, __spark_entry__ as e; print(json.dumps([sorted(e.queries()), sorted(e.oracle_sql())]))"],
                              cwd=copy, env=os.environ | {"PYTHONPATH": copy}, capture_output=True, text=True, check=True).stdout
        served, with_sql = json.loads(said.splitlines()[-1])
        assert served == sorted(REGISTRY)
        assert with_sql == sorted(k for k, (_, sql) in REGISTRY.items() if sql)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["sucursal_id", "nombre_sucursal", "provincia"]


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_queries_run_on_smoke_data(spark):
    for name, fn in E.queries().items():
        fn(spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()


def test_schemas_are_stable_across_calls(spark):
    pure = ["store_text_parse", "branch_facts", "branch_facts_documents", "crawl_cutoff", "status_summary",
            "price_change_pct", "page_verdict", "option_group", "branch_spine", "card_prices"]
    for name in pure:
        fn = E.queries()[name]
        assert fn(spark, "/root/testdata/sf0.001").schema == fn(spark, "/root/testdata/sf0.001").schema, name
    assert E.entry(spark).schema == E.entry(spark).schema
