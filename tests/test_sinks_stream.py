import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from shelfspark.operators import joins, quality
from shelfspark.sinks import writers
from shelfspark.sources.envelopes import read_envelopes, read_json_docs
from shelfspark.streaming import ingest

TS = dt.datetime(2025, 6, 16, 6, 0)


def raw_rows(spark, n=3):
    return spark.createDataFrame([(f'"item {i}"', TS.date(), TS, "VEA", "dulce_de_leche") for i in range(n)],
                                 "raw_data string, scraped_date date, scraped_datetime timestamp, "
                                 "store_name string, category string")


def test_append_doubles_and_run_id_idempotent(spark, tmp_dir):
    p = os.path.join(tmp_dir, "prices")
    assert writers.append_prices(raw_rows(spark), p)
    assert writers.append_prices(raw_rows(spark), p)
    assert spark.read.parquet(p).count() == 6
    assert writers.append_prices(raw_rows(spark).where("false"), p) is False
    q = os.path.join(tmp_dir, "prices_run")
    writers.append_prices(raw_rows(spark), q, run_id="r1")
    writers.append_prices(raw_rows(spark), q, run_id="r1")
    assert spark.read.parquet(q).count() == 3


def test_replace_snapshot_guard(spark, tmp_dir):
    p = os.path.join(tmp_dir, "snap")
    assert writers.replace_snapshot(raw_rows(spark, 3), p)
    assert writers.replace_snapshot(raw_rows(spark, 2), p)
    assert writers.replace_snapshot(raw_rows(spark).where("false"), p) is False
    assert writers.read_snapshot(spark, p).count() == 2
    bad = raw_rows(spark, 3).withColumn("store_name", F.lit(None).cast("string"))
    with pytest.raises(Exception):  # the failed refresh leaves the snapshot
        writers.replace_snapshot(bad, p, required=["store_name"])
    assert writers.read_snapshot(spark, p).count() == 2


def test_surrogate_ids_raise_on_a_failed_read(spark, tmp_dir):
    p = os.path.join(tmp_dir, "seed")
    batch = spark.range(0, 5).withColumnRenamed("id", "k")
    writers.append_with_surrogate_id(batch, p, ["k"])
    with open(os.path.join(p, "part-broken.parquet"), "wb") as fh:
        fh.write(b"not parquet")
    with pytest.raises(Exception):
        writers.append_with_surrogate_id(batch, p, ["k"])


def test_malformed_envelopes_fail(spark, tmp_dir):
    landing, table, ckpt = (os.path.join(tmp_dir, x) for x in ("landing", "table", "ckpt"))
    os.makedirs(landing)
    with open(os.path.join(landing, "a.json"), "w") as fh:
        fh.write('{"items": ["x $ 1"')
    with pytest.raises(Exception):
        read_envelopes(spark, landing).collect()
    with pytest.raises(Exception):
        ingest.ingest_new_envelopes(spark, landing, table, ckpt, "VEA")


def test_indented_envelopes_are_ingested(spark, tmp_dir):
    landing, table, ckpt = (os.path.join(tmp_dir, x) for x in ("landing", "table", "ckpt"))
    os.makedirs(landing)
    with open(os.path.join(landing, "a.json"), "w") as fh:
        json.dump({"items": ["x $ 1", "y $ 2"], "pages_processed": 1, "total_items": 2, "timestamp": "2025-06-16T06:00:00"}, fh, indent=2)
    ingest.ingest_new_envelopes(spark, landing, table, ckpt, "VEA")
    assert spark.read.parquet(table).count() == 2


def test_checkpoint_folder_is_required_off_local_mode():
    from shelfspark import session

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Session())


def test_branch_documents_keep_branches_without_facts(spark):
    branches = spark.createDataFrame([(1, "a"), (2, "b")], "k int, n string")
    facts = spark.createDataFrame([(1, 2, "y"), (1, 1, 'x "q"')], "fk int, o int, item string")
    got = {r.k: r.raw_data for r in joins.branch_documents(branches, facts, "k", "fk", "o", "item").collect()}
    assert got == {1: '["x \\"q\\"", "y"]', 2: "[]"}


def test_surrogate_ids_consecutive_across_partitions(spark, tmp_dir):
    p = os.path.join(tmp_dir, "seed")
    df = spark.range(0, 1000).repartition(7).withColumn("nombre", F.concat(F.lit("n"), F.col("id").cast("string")))
    df = df.withColumnRenamed("id", "k")
    writers.append_with_surrogate_id(df, p, ["k"])
    writers.append_with_surrogate_id(df, p, ["k"])
    got = sorted((r.id, r.k) for r in spark.read.parquet(p).select("id", "k").collect())
    assert [i for i, _ in got] == list(range(1, 2001))
    assert all(k == (i - 1) % 1000 for i, k in got)


def test_enforce_required(spark):
    df = spark.createDataFrame([("a", None), ("b", "x")], "a string, b string")
    with pytest.raises(quality.RequiredColumnViolation):
        quality.enforce_required(df, ["a", "b"])
    audit = {r.column_name: r.null_rows for r in quality.not_null_audit(df, ["a", "b"]).collect()}
    assert audit == {"a": 0, "b": 1}


def test_skew_safe_left_join_equals_left_join(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, lv string")
    right = spark.createDataFrame([(1, i) for i in range(50)] + [(3, 7), (None, 9)], "rk int, rv int")
    got = sorted(map(tuple, joins.skew_safe_left_join(left, right, "k", "rk").collect()), key=str)
    want = sorted(map(tuple, left.join(right, left.k == right.rk, "left").collect()), key=str)
    assert got == want


def test_read_envelopes_multiline(spark, tmp_dir):
    d = os.path.join(tmp_dir, "env")
    os.makedirs(d)
    doc = {"items": ["Dulce 400g $ 1.000", "Otro $ 2"], "pages_processed": 2, "total_items": 2,
           "timestamp": "2025-06-16T06:00:00.123456"}
    with open(os.path.join(d, "run1.json"), "w", encoding="utf-8") as fh:
        json.dump(doc, fh, indent=2, ensure_ascii=False)
    env = read_envelopes(spark, d).first()
    assert env.items == doc["items"] and env.total_items == 2
    docs = read_json_docs(spark, d).first()
    assert docs.source == "run1"


def test_stream_ingest_exactly_once(spark, tmp_dir):
    landing, table, ckpt = (os.path.join(tmp_dir, x) for x in ("landing", "table", "ckpt"))
    os.makedirs(landing)

    def land(name, items):
        with open(os.path.join(landing, name), "w", encoding="utf-8") as fh:
            fh.write(json.dumps({"items": items, "pages_processed": 1, "total_items": len(items),
                                 "timestamp": "2025-06-16T06:00:00"}) + "\n")
    land("a.json", ["x $ 1", "y $ 2"])
    ingest.ingest_new_envelopes(spark, landing, table, ckpt, "VEA")
    land("b.json", ["z $ 3"])
    ingest.ingest_new_envelopes(spark, landing, table, ckpt, "VEA")
    ingest.ingest_new_envelopes(spark, landing, table, ckpt, "VEA")
    got = sorted(r.raw_data for r in spark.read.parquet(table).collect())
    assert got == ['"x $ 1"', '"y $ 2"', '"z $ 3"']


def test_append_with_null_in_required_column_writes_nothing(spark, tmp_dir):
    p = os.path.join(tmp_dir, "prices_req")
    good = raw_rows(spark, 2)
    writers.append_prices(good, p, required=["raw_data", "store_name"])
    bad = good.withColumn("store_name", F.when(F.col("raw_data") == '"item 1"', F.lit(None))
                          .otherwise(F.col("store_name")))
    with pytest.raises(Exception):
        writers.append_prices(bad, p, required=["raw_data", "store_name"])
    assert spark.read.parquet(p).count() == 2


def test_partitioned_append_clusters_small_values_and_splits_a_hot_one(spark, tmp_dir):
    import glob
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16KB")
    try:
        df = (spark.range(0, 30000, numPartitions=8).select(
            F.concat(F.lit('"item '), F.col("id").cast("string"), F.lit('"')).alias("raw_data"),
            F.when(F.col("id") % 3 == 0, F.lit("2025-06-16"))
             .otherwise(F.concat(F.lit("2025-07-"), F.lpad((F.col("id") % 20 + 1).cast("string"), 2, "0")))
             .cast("date").alias("scraped_date"),
            F.lit(TS).alias("scraped_datetime"),
            F.when(F.col("id") % 3 == 0, F.lit("VEA")).otherwise(F.lit("JUMBO")).alias("store_name"),
            F.lit("dl").alias("category")))
        writers.append_prices(df, os.path.join(tmp_dir, "with"))
        df.write.partitionBy("scraped_date", "store_name").parquet(os.path.join(tmp_dir, "without"))

        def files(label):
            out = {}
            for d in glob.glob(os.path.join(tmp_dir, label, "scraped_date=*", "store_name=*")):
                out[d.split(label + os.sep, 1)[1]] = len(glob.glob(os.path.join(d, "*.parquet")))
            return out
        w, wo = files("with"), files("without")
        hot = os.path.join("scraped_date=2025-06-16", "store_name=VEA")
        assert w[hot] > 1                                    # the hot value is split over tasks
        small_w = sum(v for k, v in w.items() if k != hot)
        small_wo = sum(v for k, v in wo.items() if k != hot)
        assert small_w < small_wo                            # fewer small files
        assert spark.read.parquet(os.path.join(tmp_dir, "with")).count() == 30000
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
