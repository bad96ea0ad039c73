"""Writers that share a table, checked streaming, grouped facts, partitioned feeds."""

import datetime as dt
import glob
import json
import os
import threading

import pytest
from pyspark.sql import functions as F

from shelfspark.functions import patterns as P
from shelfspark.operators import facts, joins, models, prices, quality
from shelfspark.plans import flows
from shelfspark.sinks import writers
from shelfspark.sinks.ledger import Ledger
from shelfspark.streaming import ingest

from .test_flows import NESTED
from .test_plans import physical, plan

TS = dt.datetime(2025, 6, 16, 6, 0)
RAW = "raw_data string, scraped_date date, scraped_datetime timestamp, store_name string, category string"


def together(*jobs):
    failed = []

    def run(job):
        try:
            job()
        except BaseException as e:  # noqa: BLE001
            failed.append(e)
    threads = [threading.Thread(target=run, args=(j,)) for j in jobs]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed, failed


# ----------------------------------------------------------------- ledger ----
def test_ledger_numbers_follow_and_records_stay(spark, tmp_dir):
    ledger = Ledger(spark, f"{tmp_dir}/ledger")
    assert ledger.last() is None and ledger.numbers() == []
    for i in range(3):
        ledger.claim(lambda last: {"sum": (last["sum"] if last else 0) + 5})
    assert ledger.numbers() == [1, 2, 3] and ledger.last()["sum"] == 15 and ledger.read(1)["sum"] == 5


def test_ledger_lost_race_goes_on_to_the_next_number(spark, tmp_dir):
    """Another writer takes the number between the look and the claim."""
    one, other = (Ledger(spark, f"{tmp_dir}/ledger") for _ in range(2))
    calls = []

    def slow(last):
        calls.append(last)
        if len(calls) == 1:
            other.claim(lambda _: {"who": "other"})
        return {"who": "one", "after": last and last["who"]}
    number, record = one.claim(slow)
    assert number == 2 and record["after"] == "other" and len(calls) == 2
    assert one.read(1)["who"] == "other"


# --------------------------------------------------------------- snapshots ----
def test_overlapping_replaces_leave_one_whole_snapshot(spark, tmp_dir):
    p = f"{tmp_dir}/snap"
    a, b = (spark.range(n).select("id", F.lit(name).alias("who")) for n, name in ((500, "a"), (300, "b")))
    together(lambda: writers.replace_snapshot(a, p), lambda: writers.replace_snapshot(b, p))
    now = {(r.who, r["count"]) for r in writers.read_snapshot(spark, p).groupBy("who").count().collect()}
    assert now in ({("a", 500)}, {("b", 300)})
    assert len(Ledger(spark, f"{p}/_versions").numbers()) == 2


def test_old_versions_go_and_the_schema_may_change(spark, tmp_dir):
    p = f"{tmp_dir}/snap"
    for n in range(1, 6):
        assert writers.replace_snapshot(spark.range(n).withColumn(f"c{n}", F.lit(n)), p)
    assert writers.read_snapshot(spark, p).columns == ["id", "c5"] and writers.read_snapshot(spark, p).count() == 5
    assert len(glob.glob(f"{p}/data-*")) == 2
    assert writers.replace_snapshot(spark.range(0), p) is False
    with pytest.raises(Exception):
        writers.replace_snapshot(spark.range(3).select(F.when(F.col("id") < 2, F.col("id")).alias("id")), p, required=["id"])
    with pytest.raises(quality.RequiredColumnViolation, match="id=1"):
        writers.replace_snapshot(spark.range(3).select(F.when(F.col("id") < 2, F.col("id")).alias("id")), p, not_null=["id"])
    assert len(glob.glob(f"{p}/data-*")) == 2 and writers.read_snapshot(spark, p).count() == 5


def test_no_snapshot_yet(spark, tmp_dir):
    with pytest.raises(FileNotFoundError):
        writers.read_snapshot(spark, f"{tmp_dir}/none")


def test_branch_flow_evaluates_the_model_once(spark, tmp_dir):
    nested = spark.createDataFrame([({"BA": [{"id": "1", "nombre": "A", "provincia": "BA", "raw_data": ["Calle 1"]}]},)], NESTED)
    spark.sparkContext.setJobGroup("branch-flow", "")
    try:
        model = flows.branch_flow(nested, "m", f"{tmp_dir}/b", F.lit(TS))
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("branch-flow")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) == 2  # the raw rows, and the model with its audit
    assert "from_json" not in physical(model) and model.first().direccion_principal == "Calle 1"


# --------------------------------------------------------------------- ids ----
def test_two_appenders_share_no_id(spark, tmp_dir):
    p = f"{tmp_dir}/seed"
    batches = [spark.range(n).select(F.col("id").alias("k"), F.lit(n).alias("n")) for n in (700, 400, 0, 50)]
    together(*[lambda b=b: writers.append_with_surrogate_id(b, p, ["k"]) for b in batches])
    rows = spark.read.parquet(p)
    assert sorted(r.id for r in rows.collect()) == list(range(1, 1151))
    for r in rows.groupBy("n").agg(F.max("id").alias("hi"), F.min("id").alias("lo"), F.max(F.col("id") - F.col("k")).alias("off")).collect():
        assert r.hi - r.lo + 1 == r.n and r.off == r.lo  # one range, in order


def test_ids_stay_above_rows_that_came_another_way(spark, tmp_dir):
    p = f"{tmp_dir}/seed"
    spark.range(41, 43).write.parquet(p)
    writers.append_with_surrogate_id(spark.range(2).withColumnRenamed("id", "k"), p, ["k"])
    assert sorted(r.id for r in spark.read.parquet(p).select("id").collect()) == [41, 42, 43, 44]


def test_highest_id_comes_from_footers(spark, tmp_dir, monkeypatch):
    p = f"{tmp_dir}/seed"
    spark.range(10).write.parquet(p)
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    assert writers.highest_id(spark, p, "id") == 9
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
    try:
        spark.conf.set("spark.sql.sources.useV1SourceList", "")
        spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
        assert "PushedAggregation: [MAX(id)]" in plan(spark.read.parquet(p).agg(F.max("id")))
    finally:
        spark.conf.set("spark.sql.sources.useV1SourceList", before)
        spark.conf.unset("spark.sql.parquet.aggregatePushdown")


# --------------------------------------------------------------- streaming ----
def land(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w", encoding="utf-8") as fh:
        fh.write(text)


def envelope(items, at="2025-06-16T06:00:00", **more):
    return json.dumps({"items": items, "pages_processed": 1, "total_items": 1, "timestamp": at} | more, indent=2, ensure_ascii=False)


def test_a_bad_document_is_recorded_and_the_others_arrive(spark, tmp_dir):
    landing, table, rejects, ckpt = (f"{tmp_dir}/{x}" for x in ("landing", "table", "rejects", "ckpt"))
    land(landing, "a.json", envelope(["ñandú $ 1", "y\n$ 2"]))
    land(landing, "b.json", '{"items": ["x $ 1"')
    land(landing, "c.json", envelope(["z $ 3", None]))
    land(landing, "d.json", envelope(["z $ 4"], at="ayer"))
    land(landing, "e.json", '{"timestamp": "2025-06-16T06:00:00"}')
    land(landing, "f.json", " \n")
    land(landing, "empty.json", "")  # holds no document
    land(landing, "g.json", "no json")
    land(landing, "h.json", envelope([]))
    ingest.ingest_checked(spark, landing, table, rejects, ckpt, "VEA")
    assert sorted(r.raw_data for r in spark.read.parquet(table).collect()) == ['"y\\n$ 2"', '"ñandú $ 1"']
    bad = {r.source_file.rsplit("/", 1)[1]: r.reason for r in spark.read.schema(ingest.REJECT_SCHEMA).parquet(rejects).collect()}
    assert bad == {"b.json": "malformed", "c.json": "null item", "d.json": "no timestamp", "e.json": "no items", "f.json": "malformed",
                   "g.json": "malformed"}
    land(landing, "i.json", envelope(["w $ 5"]))
    ingest.ingest_checked(spark, landing, table, rejects, ckpt, "VEA")
    assert spark.read.parquet(table).count() == 3


def test_a_replayed_batch_adds_nothing(spark, tmp_dir):
    table, rejects = f"{tmp_dir}/table", f"{tmp_dir}/rejects"
    batch = spark.createDataFrame([(envelope(["x $ 1", "y $ 2"]), "file:/a.json"), ("{", "file:/b.json")], "value string, source_file string")
    for batch_id in (0, 0, 1, 1, 0):
        ingest.write_batch(batch, batch_id, table, rejects, "VEA")
    assert spark.read.parquet(table).count() == 4 and spark.read.parquet(rejects).count() == 2


# ------------------------------------------------------------------ facts ----
ITEMS = [" Av. Mitre 5 ", None, "Lunes 9:00 a 18:30", "", "Tel: 4444-5555", "calle 'x' \"y\"", "desde 8:15", "\t"]


def test_grouped_facts_equal_the_array_form(spark):
    rows = [(k, i, ITEMS[(i * 7 + j) % len(ITEMS)]) for j, (k, n) in enumerate([("hot", 3000), ("b", 5), ("c", 1)]) for i in range(n)]
    long = spark.createDataFrame(rows, "sucursal_id string, pos int, item string").repartition(9)
    branches = spark.createDataFrame([(k, f" {k} ", "BA", TS, "f") for k in ("hot", "b", "c", "none")],
                                     "sucursal_id string, nombre string, provincia string, fecha_extraccion timestamp, fuente string")
    arrays = {}
    for k, i, item in rows:
        arrays.setdefault(k, []).append(item)
    raw = branches.join(spark.createDataFrame([(k, json.dumps(arrays.get(k, []))) for k in ("hot", "b", "c", "none")],
                                              "sucursal_id string, raw_data string"), "sucursal_id")
    want = sorted(map(tuple, models.parse_branch_json(raw).collect()))
    got = sorted(map(tuple, models.parse_branch_long(branches, long, "sucursal_id", "pos", "item").collect()))
    assert got == want and len(got) == 4


def test_grouped_lists_spread_a_hot_key_over_tasks(spark):
    rows = spark.range(0, 60000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
                                        F.col("id"), F.concat(F.lit("x"), F.col("id")).alias("t"))
    out = facts.ordered_listagg(rows, ["k"], "id", {"all": "t"}, " | ")
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        txt = physical(out)
        assert txt.count("Exchange") == 2 and "SortAggregate" not in txt
        # the first exchange deals by key and block
        assert "_block" in [line for line in plan(out).splitlines() if line.startswith("Arguments: hashpartitioning")][0]
        hot = [r["all"] for r in out.where("k = 'hot'").collect()]
        assert hot == [" | ".join(f"x{i}" for i in range(0, 60000, 3))]
    finally:
        spark.conf.set(key, old)


def test_branch_documents_escape_order_and_null_items(spark):
    rows = [(1, i, f'x "{i}"   ñ') for i in range(2500)] + [(1, 2500, None), (3, 1, "z")]
    found = spark.createDataFrame(rows, "fk int, o int, item string").repartition(6)
    branches = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, n string")
    got = {r.k: r.raw_data for r in joins.branch_documents(branches, found, "k", "fk", "o", "item").collect()}
    assert got[2] == got[None] == "[]" and got[1] == json.dumps([item for k, _, item in rows if k == 1], ensure_ascii=False)


# ------------------------------------------------------------------- feeds ----
def test_a_chain_view_reads_its_own_folders(spark, tmp_dir):
    rows = spark.createDataFrame([(f'"{i}"', TS.date(), TS, chain, "dl") for i, chain in enumerate([*P.CHAIN_CONFIGS] * 3)], RAW)
    writers.append_prices(rows, f"{tmp_dir}/feed", partition_cols=("store_name", "scraped_date"))
    views = writers.partitioned_feed(spark, f"{tmp_dir}/feed", RAW, list(P.CHAIN_CONFIGS), "raw_test")
    for chain, view in views.items():
        assert {r.store_name for r in view.collect()} == {chain} and view.count() == 3
        txt = plan(view)
        assert "PartitionFilters: [isnotnull(store_name" in txt and "Filter (" not in txt
        assert all(f"store_name={chain}/" in r.f for r in view.select(F.input_file_name().alias("f")).collect())
    assert spark.table("raw_test_jumbo").count() == 3


def test_bucketed_previous_price_with_null_keys(spark):
    rows = [(None if i % 2 else "a", None if i % 3 else 1, i, float(i)) for i in range(60)]
    df = spark.createDataFrame(rows, "store string, kind int, at int, price double")
    plain = {r.at: r.prev_price for r in prices.with_previous_price(df, ["store", "kind"], "at").collect()}
    out = prices.with_previous_price_bucketed(df, ["store", "kind"], "at", F.floor(F.col("at") / 7))
    assert {r.at: r.prev_price for r in out.collect()} == plain and out.columns == [*df.columns, "prev_price"]


def test_broadcast_is_bounded_in_rows_and_bytes(spark, monkeypatch):
    few = spark.range(3).withColumn("x", F.repeat(F.lit("y"), 1000))
    assert joins.fits(few, 3) and not joins.fits(few, 2)
    monkeypatch.setattr(joins, "MAX_BROADCAST_BYTES", 100)
    assert not joins.fits(few, 10, joins.MAX_BROADCAST_BYTES) and joins.fits(spark.range(0), 10)
